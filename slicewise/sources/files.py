"""Reading and writing of images, measurements and result tables."""

from __future__ import annotations

import csv
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewise import schema
from slicewise.sources.shared import scratch, stored
from slicewise.sources.store import Store, in_threads

#: Columns of this library's measurement files; missing values are written NaN.
MEASUREMENTS = T.StructType(
    [T.StructField(k, T.IntegerType() if k == "site" else T.StringType()) for k in schema.ZSLICE]
    + [T.StructField(f"{p}_{c}", T.DoubleType()) for c in schema.CHANNELS for p in ("slope", "pctmax")]
)
#: Types of columns by the beginning of their names, the first that fits; others are text.
KINDS = {"site": "int", "slope": "double", "pctmax": "double", "Metadata_Site": "int", "ImageQuality": "double", "Count": "double"}


def image_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, modificationTime, length, content) of all TIFF files below ``root``, in any case.

    ``content`` is read only where a query uses it; path filters prune files first.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return found.where(F.lower("path").endswith(".tif") | F.lower("path").endswith(".tiff"))


def headers(spark: SparkSession, patterns: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The CSV files that ``patterns`` name, by their header; of each only the first line is read.

    A name that a header repeats gets a number; files without any text are left out.
    """
    stores = [Store(spark, p) for p in patterns]
    files = [(s, path) for s, p in zip(stores, patterns) for path in s.found(p)]
    first: dict[str, bytes] = {}

    def read(one):
        first[one[1]] = one[0].head(one[1])

    in_threads(read, files)
    out: dict[tuple[str, ...], list[str]] = {}
    for _, path in files:
        line, seen, names = first[path].decode("utf-8-sig").strip(), {}, []
        for name in next(csv.reader([line]), []):
            seen[name] = seen.get(name, -1) + 1
            names.append(f"{name}.{seen[name]}" if seen[name] else name)
        if names:
            out.setdefault(tuple(names), []).append(path)
    return out


def read_csv_by_prefix(spark: SparkSession, patterns: str | list[str], prefixes: list[str], kinds: dict[str, str] = KINDS) -> DataFrame:
    """CSV files of unlike headers as one table: the columns whose names begin with one of ``prefixes``, and ``source``.

    Files may have further columns, lack some, or have them in any order. Files with one header are one scan, of which
    only the wanted columns are parsed; scans are united by name, what a file lacks is null. NaN and empty cells are null.
    Columns come in the order of ``prefixes``, then as the headers first have them. ``source`` is a file's folder.
    """
    by_header = headers(spark, [patterns] if isinstance(patterns, str) else patterns)
    rank = lambda c: next((i for i, p in enumerate(prefixes) if c.startswith(p)), None)
    kind = lambda c: next((k for p, k in kinds.items() if c.startswith(p)), "string")
    wanted = list(dict.fromkeys(c for h in by_header for c in h if rank(c) is not None))
    wanted.sort(key=rank)
    parts = []
    for header, paths in by_header.items():
        whole = T.StructType([T.StructField(c, T._parse_datatype_string(kind(c))) for c in header])
        rows = spark.read.csv(paths, header=True, schema=whole, nullValue="NaN")
        own = [F.col(f"`{c}`") if c in header else F.lit(None).cast(kind(c)).alias(c) for c in wanted]
        parts.append(rows.select(*own, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("source")))
    if not parts:
        raise FileNotFoundError(f"no CSV file with a header: {patterns}")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def read_measurements(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Measurement CSV files of many plates with their ``source`` folder; only ``columns`` are parsed, null where a file lacks them."""
    wanted = columns or MEASUREMENTS.names
    found = read_csv_by_prefix(spark, paths, wanted)
    return found.select(*(F.col(c) if c in found.columns else F.lit(None).cast(MEASUREMENTS[c].dataType).alias(c) for c in wanted), "source")


def write_measurements(df: DataFrame, path: str) -> None:
    """CSV with a header, missing values as NaN; a path that exists is an error."""
    df.write.csv(path, header=True, nullValue="NaN", mode="errorifexists")


def read_platemap(spark: SparkSession, path: str) -> DataFrame:
    kinds = "well_position string, treatment string, dose string, wellrow string, wellcol string"
    return spark.read.csv(path, header=True, schema=kinds).drop("wellrow", "wellcol")


def write_slices(voxels: DataFrame, path: str, value: str = "v", keys: list[str] = ["stack", "z"]) -> None:
    """A Parquet row for each slice, its values as an array in row order; the keys may go on to pseudo-slices.

    Rows are in ranges of the keys, so files and row groups are pruned by a filter on them, however many stacks there are.
    """
    rows = F.sort_array(F.collect_list(F.struct("y", "x", value)))
    slices = voxels.groupBy(*keys).agg(rows.alias("_rows"))
    slices.select(*keys, F.col(f"_rows.{value}").alias("pixels"), (F.array_max("_rows.x") + 1).alias("width")).repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)


def read_slices(spark: SparkSession, path: str, value: str = "v", keys: list[str] = ["stack", "z"]) -> DataFrame:
    """Voxel rows of slices that ``write_slices`` wrote."""
    long = spark.read.parquet(path).select(*keys, "width", F.posexplode("pixels").alias("_at", value))
    return long.select(*keys, F.expr("cast(_at div width as int)").alias("y"), (F.col("_at") % F.col("width")).alias("x"), value)


def write_files(found: DataFrame, folder: str) -> None:
    """Each (path, content) as a file of ``folder``, on any file system that Spark writes to; paths may have folders.

    Executors write the bytes by Spark's own writer, a file for each row, and its commit protocol lets one attempt of a
    task stand; the driver then gives each file its name by a rename, so a file is there whole or not at all. Files of those names are
    replaced. A writer of text ends each record with a separator: it gets the content without its last byte, and that
    byte as the separator, so contents are written by their last bytes, 256 at most. Of equal paths one stands; a null content is empty.
    """
    spark = found.sparkSession
    store, staged = Store(spark, folder), f"{folder}/.staged-{uuid4().hex}"
    last = F.expr("hex(substring(content, length(content), 1))")
    rows = found.select(F.col("path").alias("name"), F.coalesce("content", F.lit(b"")).alias("content")).withColumn("last", last)
    rows = stored(rows.dropDuplicates(["name"]))
    for end in [r["last"] for r in rows.select("last").distinct().collect()]:
        own = rows.where(F.col("last") == end)
        if not end:
            in_threads(lambda r: store.write(f"{folder}/{r['name']}"), own.select("name").toLocalIterator())
            continue
        body = own.select("name", F.expr("cast(substring(content, 1, length(content) - 1) as string)").alias("value"))
        body.write.partitionBy("name").option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", chr(int(end, 16))).text(f"{staged}/{end}")
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def publish(path):
        parent, _, file = path.rpartition("/")
        if file.startswith("part-"):
            store.move(path, f"{folder}/{unescape(parent.rpartition('/name=')[2])}")

    if store.exists(staged):
        in_threads(publish, store.files(staged))
        store.delete(staged)


class Conflict(RuntimeError):
    """Another writer has overwritten the table since it was read."""


class Versions:
    """A Parquet table that may be overwritten with a result of its own: each version has a folder, and a pointer names it.

    Readers take the latest pointer. A writer says which version its result comes from; the next pointer is made only if there is
    none, so of two writers on one version the second gets ``Conflict`` and the first one's rows stay.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.store = spark, root.rstrip("/"), Store(spark, root)

    def latest(self) -> int:
        """The number of the latest version; 0 if there is none."""
        return max((int(n) for n in self.store.names(f"{self.root}/_versions") if n.isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        return self.spark.read.parquet(f"{self.root}/{self.store.text(f'{self.root}/_versions/{version:06d}')}")

    def overwrite(self, df: DataFrame, based_on: int) -> int:
        """Write ``df`` as the version after ``based_on`` and return its number; the earlier ones stay readable."""
        folder = f"data-{uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        if self.latest() != based_on or not self.store.put_new(f"{self.root}/_versions/{based_on + 1:06d}", folder.encode()):
            self.store.delete(f"{self.root}/{folder}")
            raise Conflict(f"{self.root} is at version {self.latest()}, not {based_on}")
        return based_on + 1

    def expire(self, keep: int = 2) -> None:
        """Delete the data of all but the latest ``keep`` versions, and folders of writers that failed; their readers must be done."""
        last = self.latest()
        kept = {self.store.text(f"{self.root}/_versions/{v:06d}") for v in range(max(1, last - keep + 1), last + 1)}
        for name in self.store.names(self.root):
            if name.startswith("data-") and name not in kept:
                self.store.delete(f"{self.root}/{name}")


__all__ = [
    "KINDS", "MEASUREMENTS", "Conflict", "Versions", "headers", "image_files", "read_csv_by_prefix", "read_measurements", "read_platemap",
    "read_slices", "scratch", "write_files", "write_measurements", "write_slices",
]
