"""Vector code compression: a codebook for each part of a vector, trained by Yinyang Lloyd rounds in whole numbers."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewise.llm.common import checkpointed, stored
from slicewise.llm.vectors import matrix, whole_vectors

#: Whole numbers of a vector stay below 2^BITS, so sums of squares over 2^10 components fit a long.
BITS = 25
#: Entries of a codebook for each of its groups, and rounds that sort entries into groups.
GROUPED, SORTING = 10, 5
#: Share by which a stored bound is lowered, more than float32 rounds, and the largest whole number of a float64.
MARGIN, EXACT = 1e-6, 2**53
#: Labels whose sums are sent to every task; more are joined by a shuffle.
FEW_LABELS = 50_000


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows from all entries; float64 products where they are whole numbers that it holds."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.square(x[:, None, :] - entries[None, :, :]).sum(axis=2)


class Codebooks:
    """Entries (k, dim) of all parts; part p has the columns ``edges[p]`` to ``edges[p + 1]``.

    The entries of a part are in groups, found once from the first codebook and kept, as in Yinyang k-means.
    Without ``groups`` they are sorted into max(1, k // GROUPED) groups by a few Lloyd rounds among entries.
    """

    def __init__(self, entries: np.ndarray, parts: int, groups: list[np.ndarray] | None = None):
        self.entries, self.parts = entries, parts
        self.edges = np.cumsum([0, *(len(c) for c in np.array_split(np.arange(entries.shape[1]), parts))]).tolist()
        self.n_groups = max(1, len(entries) // GROUPED)
        self.groups = groups or [self.sorted_groups(self.part(entries, p)) for p in range(parts)]

    def part(self, rows: np.ndarray, p: int) -> np.ndarray:
        return rows[:, self.edges[p] : self.edges[p + 1]]

    def sorted_groups(self, entries: np.ndarray) -> np.ndarray:
        centres = entries[np.arange(self.n_groups) * len(entries) // self.n_groups].astype(float)
        for _ in range(SORTING):
            group = np.square(entries[:, None, :] - centres[None]).sum(axis=2).argmin(axis=1)
            for g in np.unique(group):
                centres[g] = entries[group == g].mean(axis=0)
        return group

    def replaced(self, entries: np.ndarray) -> Codebooks:
        return Codebooks(entries, self.parts, self.groups)

    def drifts(self, later: Codebooks) -> np.ndarray:
        """(parts, groups): at least the farthest that an entry of the group has moved."""
        out = np.zeros((self.parts, self.n_groups))
        for p in range(self.parts):
            moved = np.sqrt(np.square((self.part(later.entries, p) - self.part(self.entries, p)).astype(float)).sum(axis=1)) * (1 + MARGIN)
            np.maximum.at(out[p], self.groups[p], moved)
        return out

    def nearest(self, x: np.ndarray, code: np.ndarray | None = None, bounds: np.ndarray | None = None, drift: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(code, bounds, squared distance of each row over all parts, distances computed).

        ``code`` (rows, parts) and ``bounds`` (rows, parts, groups) are of the codebook before and ``drift`` how far
        its groups have moved since. A bound is at most the distance of every entry of the group but the
        row's own, so a group whose bound, less its drift, is over the best distance so far has neither a
        nearer entry nor one as near; every other group is scanned. Distances are compared as whole
        numbers, ties go to the lower index. Without ``code`` all groups are scanned.
        """
        n, k = len(x), len(self.entries)
        new, low = np.empty((n, self.parts), np.uint8), np.empty((n, self.parts, self.n_groups), np.float32)
        total, scanned = np.zeros(n, np.int64), 0
        for p in range(self.parts):
            mine, entries, group = np.ascontiguousarray(self.part(x, p)), self.part(self.entries, p), self.groups[p]
            if code is None:
                old, own = np.full(n, k), np.full(n, np.iinfo(np.int64).max)
                bound = np.full((n, self.n_groups), -1.0)
            else:
                old = code[:, p].astype(np.int64)
                own = np.square(mine - entries[old]).sum(axis=1)
                bound = bounds[:, p].astype(np.float64) - drift[p]
            best, at = own.copy(), old.copy()
            first, second, which = (np.full((n, self.n_groups), v) for v in (np.inf, np.inf, -1.0))
            seen = np.zeros((n, self.n_groups), bool)
            for g in range(self.n_groups):
                members = np.flatnonzero(group == g)
                if not len(members):
                    seen[:, g] = True  # nothing is nearer in an empty group
                    continue
                rows = np.flatnonzero(~((bound[:, g] > 0) & (np.square(bound[:, g]) > best * (1 + 1e-12))))
                if not len(rows):
                    continue
                d = squared(mine[rows], entries[members])
                scanned += d.size
                i = d.argmin(axis=1)
                least = d[np.arange(len(rows)), i]
                i = members[i]
                better = (least < best[rows]) | (least == best[rows]) & (i < at[rows])
                best[rows[better]], at[rows[better]] = least[better], i[better]
                first[rows, g], which[rows, g], seen[rows, g] = least, i, True
                if len(members) > 1:
                    second[rows, g] = np.partition(d, 1, axis=1)[:, 1]
            # of a scanned group: the nearest entry that isn't the row's own; of others the old bound, and the entry just left
            fresh = np.sqrt(np.where(which == at[:, None], second, first))
            bound = np.where(seen, fresh, bound)
            left = np.flatnonzero((at != old) & (old < k))
            g = group[old[left]]
            known = ~seen[left, g]
            bound[left[known], g[known]] = np.minimum(bound[left[known], g[known]], np.sqrt(own[left[known]].astype(float)))
            low[:, p] = np.maximum(bound, 0) * (1 - MARGIN)
            new[:, p] = at
            total += best
        return new, low, total, scanned

    def digest(self) -> str:
        numbers = (str(v) for p in range(self.parts) for entry in self.part(self.entries, p).tolist() for v in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _assigned(rows: DataFrame, books: Codebooks, drift: np.ndarray | None) -> DataFrame:
    """Rows (id, label, x[, code, bounds]) with the code and bounds of ``books``. No shuffle."""
    dim, parts, groups = books.entries.shape[1], books.parts, books.n_groups

    def work(batches):
        for b in batches:
            x, n, state = matrix(b["x"], dim).astype(np.int64), b.num_rows, (None, None, None)
            if drift is not None:
                state = (_bytes(b["code"], np.uint8).reshape(n, parts), _bytes(b["bounds"], np.float32).reshape(n, parts, groups), drift)
            code, low, *_ = books.nearest(x, *state)
            yield pa.RecordBatch.from_arrays([b["id"], b["label"], b["x"], _cells(code), _cells(low)], names=["id", "label", "x", "code", "bounds"])

    kinds = [*(rows.schema[c] for c in ("id", "label", "x")), T.StructField("code", T.BinaryType()), T.StructField("bounds", T.BinaryType())]
    return rows.mapInArrow(work, T.StructType(kinds))


def _bytes(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _cells(values: np.ndarray) -> pa.Array:
    """A binary cell for each row."""
    raw, n = values.tobytes(), len(values)
    size = len(raw) // n if n else 0
    return pa.array([raw[i * size : (i + 1) * size] for i in range(n)], pa.binary())


def _updated(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks with each used entry at the floor of its parts' mean. What is collected is of a codebook's size."""
    k, dim = books.entries.shape

    def work(batches):
        total, n = np.zeros((k, dim), np.int64), np.zeros((k, books.parts), np.int64)
        for b in batches:
            x, code = matrix(b["x"], dim).astype(np.int64), _bytes(b["code"], np.uint8).reshape(b.num_rows, books.parts)
            for p in range(books.parts):
                np.add.at(books.part(total, p), code[:, p], books.part(x, p))
                n[:, p] += np.bincount(code[:, p], minlength=k)
        of = np.repeat(np.arange(books.parts), np.diff(books.edges))
        entry, place = np.nonzero(n[:, of])
        made = [pa.array(c) for c in (entry, place, n[:, of][entry, place], total[entry, place])]
        yield pa.RecordBatch.from_arrays(made, names=["entry", "place", "n", "total"])

    sums = rows.select("x", "code").mapInArrow(work, "entry long, place long, n long, total long")
    entries = books.entries.copy()
    for r in sums.groupBy("entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        entries[r.entry, r.place] = r.total // r.n
    return books.replaced(entries)


def compressed(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256): product codes of all usable vectors, exactly as plain Lloyd gives them.

    Components become floor(scale * x); vectors are cut into ``parts`` consecutive parts (the first ones longer by
    one where the length isn't a multiple). Each part's codebook starts as that part of the ``entries`` (at most
    256) vectors with the smallest ids and is moved by ``rounds`` Lloyd rounds of whole numbers; then all parts are
    assigned. Rows keep, between rounds, their code and a lower bound for each group of entries (see
    ``Codebooks.nearest``) in the shared folder. Only codebooks travel: of ``entries`` x length numbers, whatever the rows.

    Vectors that are null, empty, hold null or non-finite components, or aren't of the most frequent length go
    (see ``vectors.whole_vectors``). Null ids come last and equal ids go by their numbers; repeated rows each have a code. Equal
    labels, nulls too, share ``label_error`` (null where it passes a long). With fewer vectors than entries the codebook is
    smaller; an empty table gives none. Other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits, so a codebook has 1 to 256 entries")
    rows, dim = whole_vectors(vectors, vector, scale, 0, BITS, (id, "id"), (label, "label"))
    rows = rows.withColumn("x", F.col("x").cast("array<int>"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    schema = T.StructType([T.StructField(id, rows.schema["id"].dataType), *(T.StructField(c, k) for c, k in (("code", T.StringType()), ("error", T.LongType()), ("label_error", T.LongType()), ("codebooks_sha256", T.StringType())))])
    if not first:
        return vectors.sparkSession.createDataFrame([], schema)
    books, drift = Codebooks(np.array([r.x for r in first], np.int64), parts), None
    for _ in range(rounds):
        rows = stored(_assigned(rows, books, drift))
        later = _updated(rows, books)
        books, drift = later, books.drifts(later)

    def finish(batches):
        for b in batches:
            n, state = b.num_rows, (None, None, None)
            if drift is not None:
                state = (_bytes(b["code"], np.uint8).reshape(n, parts), _bytes(b["bounds"], np.float32).reshape(n, parts, books.n_groups), drift)
            code, _, error, _ = books.nearest(matrix(b["x"], dim).astype(np.int64), *state)
            yield pa.RecordBatch.from_arrays([b["id"], b["label"], pa.array([r.tobytes().hex() for r in code], pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    coded = stored(rows.mapInArrow(finish, T.StructType([rows.schema["id"], rows.schema["label"], schema["code"], schema["error"]])))
    sums = checkpointed(coded.groupBy(F.col("label").alias("_label")).agg(F.expr("try_sum(error)").alias("label_error")))
    if sums.count() <= FEW_LABELS:
        sums = F.broadcast(sums)
    done = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return done.select(F.col("id").alias(id), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _round(k: int) -> str:
    """Codebook b<k + 1> from b<k>: parts of all rows assigned to the nearest entry, then the floors of the means."""
    mean = ", ".join(f"cast(floor(sum(v[{i}]) / count(*)) as bigint)" for i in range(1, 5))
    return f"m{k} as (select part, entry, [{mean}] c from {_nearest(k)} group by all), b{k + 1} as (select part, entry, coalesce(m{k}.c, b{k}.c) c from b{k} left join m{k} using (part, entry))"


def _nearest(k: int) -> str:
    d = " + ".join(f"(v[{i}] - c[{i}]) * (v[{i}] - c[{i}])" for i in range(1, 5))
    return f"(select vec_id, part, any_value(v) v, arg_min(entry, ({d}) * 64 + entry) entry, min({d}) d from parts join b{k} using (part) group by vec_id, part)"


#: The query in DuckDB, for vectors of 64 components with distinct ids.
SQL = (
    "with good as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) x from embeddings "
    "where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0), "
    "parts as (select vec_id, cast(part as int) part, x[4 * part + 1 : 4 * part + 4] v from good, (select unnest(range(16)) part)), "
    "b0 as (select part, row_number() over (partition by part order by vec_id) - 1 entry, v c from parts join (select vec_id from good order by vec_id limit 64) using (vec_id)), "
    f"{_round(0)}, {_round(1)}, coded as (select vec_id, string_agg(printf('%02x', entry), '' order by part) code, cast(sum(d) as bigint) error from {_nearest(2)} group by vec_id), "
    "book as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) codebooks_sha256 from b2) "
    "select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded join good using (vec_id), book"
)
