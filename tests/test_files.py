"""Sources and sinks, there and back."""

import pytest

from slicewise.operators import images
from slicewise.sources import files, tiff


def test_images_are_found_and_decoded(spark, tmp_path):
    import numpy as np

    for name in ("NF0014_raw_images/C2-1/a_405_ZS000.tif", "NF0014_raw_images/C2-1/b.TIFF", "x/c.png"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(tiff.encode([np.full((2, 3), 9, "u2")]))
    found = images.decoded(files.image_files(spark, str(tmp_path))).collect()
    assert len(found) == 2 and all((r.height, r.width, sum(r.pixels)) == (2, 3, 54) for r in found)


def test_measurements_survive_csv(spark, tmp_path):
    row = ("p", None, 3, "ZS001", None, *[1.5] * 9)
    files.write_measurements(spark.createDataFrame([row], files.MEASUREMENTS), f"{tmp_path}/a_qc/out")
    back = files.read_measurements(spark, f"{tmp_path}/*/out", ["plate", "well", "slope_dna", "pctmax_dna"])
    assert [tuple(r) for r in back.collect()] == [("p", None, None, 1.5, "out")]
    with pytest.raises(Exception, match="already exists"):
        files.write_measurements(spark.createDataFrame([row], files.MEASUREMENTS), f"{tmp_path}/a_qc/out")


def test_plates_of_unlike_headers_are_one_table(spark, tmp_path):
    plates = {
        "A": "Metadata_Plate,Metadata_Site,ImageQuality_Slope_DNA,Remark\nA,1,-1.5,x\nA,,NaN,\n",
        "B": '\ufeffRemark,"ImageQuality_Slope_DNA",Metadata_Site,Metadata_Plate,Count_Cells\r\n"a, b",-2,2,B,9\r\n',
        "C": "ImageQuality_Slope_Mito,Metadata_Plate,Metadata_Plate\n3,C,again\n",
        "D": "Metadata_Plate,Metadata_Site,ImageQuality_Slope_DNA,Remark\nD,4,0.5,y\n",
        "E": "",
        "F": "Metadata_Well\n",
    }
    for plate, text in plates.items():
        (tmp_path / f"{plate}_results").mkdir()
        (tmp_path / f"{plate}_results" / "Image.csv").write_bytes(text.encode())
    (tmp_path / "A_results" / "Other.csv").write_text("Metadata_Plate\nno\n")
    got = files.read_csv_by_prefix(spark, f"{tmp_path}/*/Image.csv", ["Metadata", "ImageQuality_Slope"])
    assert got.columns == ["Metadata_Plate", "Metadata_Site", "Metadata_Plate.1", "Metadata_Well", "ImageQuality_Slope_DNA", "ImageQuality_Slope_Mito", "source"]
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted([
        ("A", 1, None, None, -1.5, None, "A_results"), ("A", None, None, None, None, None, "A_results"), ("B", 2, None, None, -2.0, None, "B_results"),
        ("C", None, "again", None, None, 3.0, "C_results"), ("D", 4, None, None, 0.5, None, "D_results")], key=str)
    by_header = files.headers(spark, [f"{tmp_path}/*/Image.csv"])
    assert sorted(len(p) for p in by_header.values()) == [1, 1, 1, 2]  # one scan for each header
    plan = got.select("Metadata_Plate")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 4 and "ReadSchema: struct<Remark" not in plan and "Count_Cells" not in plan.split("ReadSchema", 1)[1]
    narrow = files.read_measurements(spark, f"{tmp_path}/*/Image.csv", ["plate", "site"])
    assert narrow.columns == ["plate", "site", "source"] and narrow.where("plate is not null").count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_csv_by_prefix(spark, f"{tmp_path}/*/None.csv", ["Metadata"])


def test_slices_there_and_back(spark, tmp_path):
    rows = [(s, z, y, x, 10 * y + x) for s in (1, 2) for z in (0, 1) for y in range(2) for x in range(3)]
    df = spark.createDataFrame(rows, "stack int, z int, y int, x int, v int")
    files.write_slices(df, f"{tmp_path}/slices")
    assert sorted(tuple(r) for r in files.read_slices(spark, f"{tmp_path}/slices").collect()) == rows


@pytest.mark.parametrize("scheme", ["", "file:", "viewfs://store"])
def test_files_are_written_whole_on_any_store(spark, tmp_path, scheme):
    import random

    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}")
    folder = f"{scheme}{'/in' if scheme.startswith('view') else tmp_path}/out"
    rng = random.Random(4)
    contents = {f"f{i}.bin": rng.randbytes(rng.choice([1, 2, 900, 70_000])) for i in range(40)} | {
        "C2-1/C2-1_405.tif": bytes(range(256)), "a b=c%.gif": b"\n\r\n\xff\xfe\n", "empty": b"", "none": None, "zero": b"\0\0", "utf": "é\u6f22".encode()}
    found = spark.createDataFrame([(k, v) for k, v in contents.items()], "path string, content binary").repartition(5)
    files.write_files(found, folder)
    files.write_files(found.where("path = 'zero' or path = 'empty'").union(found.where("path = 'zero'")), folder)  # again, and twice in one call
    here = tmp_path / "out"
    assert {str(p.relative_to(here)): p.read_bytes() for p in here.rglob("*") if p.is_file() and not p.name.endswith(".crc")} == {k: v or b"" for k, v in contents.items()}
    assert not [p for p in here.iterdir() if p.name.startswith(".staged")]


def test_a_repeated_task_leaves_one_file(spark, tmp_path):
    """Attempts of a task write under names of their own, of which Spark's commit lets one stand."""
    folder = tmp_path / "out"
    flag = tmp_path / "failed"
    flag.mkdir()

    def once(batches):
        from pyspark import TaskContext

        for b in batches:
            yield b
        mark = flag / str(TaskContext.get().partitionId())
        if not mark.exists() and TaskContext.get().attemptNumber() == 0:
            mark.touch()
            raise RuntimeError("lost")

    rows = spark.createDataFrame([(f"f{i}", bytes([i, 9])) for i in range(8)], "path string, content binary").repartition(2)
    try:
        files.write_files(rows.mapInArrow(once, rows.schema), str(folder))
    except Exception:  # local Spark doesn't repeat tasks: nothing is there, and a second call does all
        assert not folder.exists() or not [p for p in folder.iterdir() if not p.name.startswith(".")]
        files.write_files(rows.mapInArrow(once, rows.schema), str(folder))
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == [f"f{i}" for i in range(8)]


def test_animations_are_read_again():
    import numpy as np

    from slicewise.sources import gif

    rng = np.random.default_rng(2)
    for shape in ((1, 1), (40, 61), (200, 300)):
        frames = [rng.integers(0, 256, shape).astype("u1") for _ in range(2)] + [np.full(shape, 7, "u1")]
        back = gif.decode(gif.encode(frames))
        assert len(back) == 3 and all(np.array_equal(a, b) for a, b in zip(back, frames))
    # growing codes: one pixel value throughout, as other writers pack it
    codes, out, table = [4], [], {bytes([i]): i for i in range(4)}
    pixels, size, run = [1] * 3000 + [2, 3, 0, 1] * 300, 3, b""
    number, sizes = 6, [3]
    for p in map(lambda v: bytes([v]), pixels):
        if run + p in table:
            run += p
            continue
        codes.append(table[run])
        sizes.append(size)
        table[run + p] = number
        number += 1
        size = max(size, (number - 1).bit_length())
        run = p
    codes += [table[run], 5]
    sizes += [size, size]
    bits = at = 0
    for c, n in zip(codes, sizes):
        bits, at = bits | c << at, at + n
    packed = bits.to_bytes((at + 7) // 8, "little")
    blocks = b"".join(bytes([len(packed[i : i + 255])]) + packed[i : i + 255] for i in range(0, len(packed), 255)) + b"\0"
    data = b"GIF89a" + bytes([60, 0, 70, 0, 0x81, 0, 0]) + bytes(12) + b"\x2c" + bytes([0, 0, 0, 0, 60, 0, 70, 0, 0]) + b"\x02" + blocks + b";"
    assert gif.decode(data)[0].ravel().tolist() == pixels
    with pytest.raises(ValueError):
        gif.decode(b"nothing")


def test_a_table_is_overwritten_with_its_own_result(spark, tmp_path):
    table = files.Versions(spark, f"{tmp_path}/table")
    assert table.latest() == 0
    assert table.overwrite(spark.range(5), 0) == 1
    assert table.overwrite(table.read().where("id > 1"), 1) == 2
    assert table.overwrite(table.read().union(table.read()), 2) == 3
    assert sorted(r.id for r in table.read().collect()) == [2, 2, 3, 3, 4, 4] and table.read(1).count() == 5
    with pytest.raises(files.Conflict):
        table.overwrite(spark.range(1), 2)
    assert table.read().count() == 6
    table.expire(keep=1)
    assert table.read().count() == 6 and len([p for p in (tmp_path / "table").iterdir() if p.name.startswith("data-")]) == 1


def test_of_two_writers_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    table = files.Versions(spark, f"{tmp_path}/table")
    for base in range(3):
        def write(i):
            try:
                return table.overwrite(spark.range(i, i + 1), base), i
            except files.Conflict:
                return None, i

        with ThreadPoolExecutor(4) as pool:
            done = [i for version, i in pool.map(write, range(4)) if version]
        assert len(done) == 1 and table.latest() == base + 1 and table.read().first().id == done[0]
    store = files.Store(spark, str(tmp_path))
    assert store.put_new(f"{tmp_path}/x", b"1") and not store.put_new(f"{tmp_path}/x", b"2") and store.text(f"{tmp_path}/x") == "1"
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.other.link./in", f"file://{tmp_path}")
    far = files.Store(spark, "viewfs://other/in")
    assert far.put_new("viewfs://other/in/y", b"1") and not far.put_new("viewfs://other/in/y", b"2") and far.text("viewfs://other/in/y") == "1"


def test_working_tables_go_when_the_driver_ends(tmp_path):
    import os
    import subprocess
    import sys
    import time
    from pathlib import Path

    code = (
        "from pyspark.sql import SparkSession\n"
        "from slicewise.sources.shared import stored\n"
        f"spark = SparkSession.builder.master('local').config('spark.checkpoint.dir', 'file://{tmp_path}').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('ROWS', stored(spark.range(7)).count())\n"
        f"import os; print('TABLES', sum(n.endswith('-tables') for n in os.listdir('{tmp_path}')))\n"
        "spark.stop()\n")
    root = str(Path(__file__).resolve().parents[1])
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=200).stdout
    assert "ROWS 7" in out and "TABLES 1" in out
    for _ in range(100):  # the JVM ends a little later
        if not list(tmp_path.glob("*-tables")):
            break
        time.sleep(0.2)
    assert not list(tmp_path.glob("*-tables"))


def test_platemap(spark, tmp_path):
    (tmp_path / "platemap.csv").write_text("well_position,treatment,dose,WellRow,WellCol\nC2,drug,1,C,2\n")
    assert [tuple(r) for r in files.read_platemap(spark, str(tmp_path / "platemap.csv")).collect()] == [("C2", "drug", "1")]
