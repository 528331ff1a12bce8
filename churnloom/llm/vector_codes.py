"""Vector code compression: a small codebook per part of a vector, searched by equal averages.

Vectors become whole numbers and are cut into consecutive parts. Each round gives every part to its nearest entry
and moves the entries to the floor of their parts' means; only sums and counts leave the tasks. The nearest entry is
found by the entries' component sums: since (sum x - sum c)^2 <= width * |x - c|^2, a search that walks outward from
the part's own sum may stop on a side as soon as the squared gap strictly exceeds width times the best distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import attach
from .common import append_columns, c, materialize, small_batches

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Whole components beyond this are held at it; all whole numbers up to it are exact in doubles.
LARGEST = 2**53
_LONG = 2**63 - 1
CODE_FIELDS = T.StructType([T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])


@dataclass(frozen=True)
class Book:
    """The entries of one part, in index order and sorted by their component sums (ties by index)."""

    entries: np.ndarray
    order: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Book:
        sums = entries.sum(axis=1)
        order = np.array(sorted(range(len(entries)), key=lambda i: (sums[i], i)), dtype=np.int64)
        return cls(entries, order, sums[order])


def bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    """Start and end of each part; the parts of a length that does not divide evenly differ by one component."""
    return [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def nearest_entry(x: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of the nearest entry for each row of ``x`` (ties to the lower index).

    Also returns how many distances were computed. All numbers are whole; where 64 bits could overflow, Python
    integers are used.
    """
    entries, sums = book.entries, book.sums
    width, k = x.shape[1], len(entries)
    top = 2 * int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))) + 1
    if (width * top) ** 2 > _LONG:
        x, entries, sums = x.astype(object), entries.astype(object), sums.astype(object)
        none = width * width * top * top + 1
    else:
        none = _LONG
    own = x.sum(axis=1) if width else np.zeros(len(x), np.int64)
    right = np.searchsorted(sums, own)
    left = right - 1
    # The squared sum gap that a better or equal entry cannot exceed: width times the best distance so far.
    reach = np.full(len(x), none, dtype=x.dtype)
    best, which = reach.copy(), np.full(len(x), k, np.int64)
    open_left, open_right = np.ones(len(x), bool), np.ones(len(x), bool)
    computed = 0
    while True:
        for side, at, step in ((open_left, left, -1), (open_right, right, 1)):
            side &= (at >= 0) & (at < k)
            rows = np.flatnonzero(side)
            gap = own[rows] - sums[at[rows]]
            near = (gap * gap <= reach[rows]).astype(bool)
            side[rows[~near]] = False
            rows = rows[near]
            index = book.order[at[rows]]
            apart = x[rows] - entries[index]
            d = (apart * apart).sum(axis=1)
            computed += len(rows)
            better = ((d < best[rows]) | ((d == best[rows]) & (index < which[rows]))).astype(bool)
            won = rows[better]
            best[won], which[won], reach[won] = d[better], index[better], width * d[better]
            at[rows] += step
        if not (open_left.any() or open_right.any()):
            return which, best, computed


def whole_vectors(column: pa.Array, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, row numbers, whole components)`` for each vector length of a column of number lists.

    Null vectors and vectors with a null or non-finite component are left out.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.cast(column.flatten(), pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64) if len(size) else np.empty(0, np.int64)
    broken = np.bincount(np.repeat(np.arange(len(size)), size), weights=~np.isfinite(flat), minlength=len(size))
    sound = pc.is_valid(column).to_numpy(zero_copy_only=False) & (broken == 0)
    for dim in np.unique(size[sound]):
        rows = np.flatnonzero(sound & (size == dim))
        with np.errstate(over="ignore"):
            x = np.floor(flat[start[rows][:, None] + np.arange(dim)] * scale)
        yield int(dim), rows, np.clip(x, -LARGEST, LARGEST).astype(np.int64)


def _first_rows(rows: DataFrame, entries: int) -> list[list[float]]:
    """Vectors of the smallest distinct keys (nulls last, as one key), each key's smallest vector."""
    found: list[list[float]] = []
    last = None
    while len(found) < entries:
        left = rows if last is None else rows.where(F.col("key") > F.lit(last))
        got = left.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries - len(found)).collect()
        for i, row in enumerate(got):
            if i == 0 or row["key"] != got[i - 1]["key"]:
                found.append(row["vector"])
        if not got or got[-1]["key"] is None:
            break
        last = got[-1]["key"]
    return found


def _sums(rows: DataFrame, books: dict[int, list[Book]], parts: int, scale: int) -> dict[tuple[int, int, int, int], tuple[int, int]]:
    """Count and component sum of the parts that each entry is nearest to, by (length, part, entry, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = {d: [np.zeros(len(b.entries), np.int64) for b in bs] for d, bs in books.items()}
        total = {d: [np.zeros(b.entries.shape, object) for b in bs] for d, bs in books.items()}
        for batch in batches:
            for dim, _, x in whole_vectors(batch.column(0), scale):
                for p, (a, z) in enumerate(bounds(dim, parts)):
                    which, _, _ = nearest_entry(x[:, a:z], books[dim][p])
                    count[dim][p] += np.bincount(which, minlength=len(count[dim][p]))
                    # Components are at most 2^53 and a batch holds few rows: halves of 27 bits keep the sums exact.
                    for shift, half in ((2**27, x[:, a:z] >> 27), (1, x[:, a:z] & (2**27 - 1))):
                        some = np.zeros(total[dim][p].shape, np.int64)
                        np.add.at(some, which, half)
                        total[dim][p] += some.astype(object) * shift
        out: list[tuple] = []
        for dim, by_part in total.items():
            for p, table in enumerate(by_part):
                for e in np.flatnonzero(count[dim][p]).tolist():
                    n = int(count[dim][p][e])
                    out += [(dim, p, e, i, n, int(v) >> 32, int(v) & (2**32 - 1)) for i, v in enumerate(table[e])]
        names = ["dim", "part", "entry", "place", "n", "high", "low"]
        kinds = [pa.int32()] * 4 + [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out) if out else [[]] * 7, kinds)], names=names)

    by = ["dim", "part", "entry", "place"]
    sums = rows.select("vector").mapInArrow(run, "dim int, part int, entry int, place int, n long, high long, low long")
    got = sums.groupBy(*by).agg(*[F.sum(v).alias(v) for v in ("n", "high", "low")]).collect()
    return {tuple(r[v] for v in by): (r["n"], (r["high"] << 32) + r["low"]) for r in got}


def learn(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> dict[int, list[Book]]:
    """Codebooks by vector length: one ``Book`` for each part.

    Rows whose vector is null or holds a null or non-finite component take no part; vectors of each length have
    codebooks of their own. A codebook starts from the ``entries`` smallest distinct keys (null keys last; of a
    repeated key its smallest vector) and has fewer entries if there are fewer. Repeated rows count as often as they
    occur. Whole components beyond 2^53 are held at it. Reads ``vectors`` once per round; a task returns one row for
    each component of each entry, whatever its rows.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(c(key).alias("key"), c(vector).cast("array<double>").alias("vector")).where(_sound("vector"))
    books: dict[int, list[Book]] = {}
    for (dim,) in rows.select(F.size("vector").alias("dim")).distinct().collect():
        first = pa.array(_first_rows(rows.where(F.size("vector") == dim), entries), pa.list_(pa.float64()))
        ((_, _, x),) = whole_vectors(first, scale)
        books[dim] = [Book.of(x[:, a:z]) for a, z in bounds(dim, parts)]
    for _ in range(rounds if books else 0):
        sums = _sums(rows, books, parts, scale)
        moved = {d: [b.entries.copy() for b in bs] for d, bs in books.items()}
        for (dim, part, entry, place), (n, total) in sums.items():
            moved[dim][part][entry, place] = total // n
        books = {d: [Book.of(e) for e in es] for d, es in moved.items()}
    return books


def _sound(vector: str):
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def encode(vectors: DataFrame, books: dict[int, list[Book]], vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """All columns of ``vectors`` with ``code`` (entry indices in part order) and ``error`` (summed squared distances).

    Columns of these names are replaced. Both are null where the vector is null, holds a null or non-finite component
    or has a length without codebooks. Errors beyond 64 bits are held at 2^63 - 1. No rows move.
    """

    def compute(column: pa.Array) -> list[pa.Array]:
        codes: list = [None] * len(column)
        errors: list = [None] * len(column)
        for dim, rows, x in whole_vectors(column, scale):
            if dim not in books:
                continue
            spans = bounds(dim, len(books[dim]))
            found = [nearest_entry(x[:, a:z], b) for (a, z), b in zip(spans, books[dim])]
            table = np.stack([which for which, _, _ in found], axis=1).tolist()
            far = sum((d.astype(object) for _, d, _ in found), np.zeros(len(rows), object))
            for i, code, error in zip(rows.tolist(), table, far.tolist()):
                codes[i], errors[i] = code, min(int(error), _LONG)
        return [pa.array(codes, pa.list_(pa.int32())), pa.array(errors, pa.int64())]

    return append_columns(vectors, vector, CODE_FIELDS, compute)


def with_group_error(coded: DataFrame, label: str, error: str = "error", out: str = "label_error") -> DataFrame:
    """Adds the error summed over the rows of equal ``label`` (nulls together), held at 2^63 - 1.

    Sums are combined before the shuffle and attached to the rows; labels with very many rows are broadcast apart.
    """
    keyed = coded.withColumns({"_no_label": c(label).isNull(), "_label": F.coalesce(c(label).cast("string"), F.lit(""))})
    total = F.least(F.sum(c(error).cast("decimal(20,0)")), F.lit(_LONG).cast("decimal(20,0)")).cast("long")
    sums = keyed.groupBy("_no_label", "_label").agg(F.count(F.lit(1)).alias("_rows"), total.alias(out))
    return attach(keyed, sums, ["_no_label", "_label"], weight="_rows").drop("_no_label", "_label", "_rows")


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, dict[int, list[Book]]]:
    """Key, label, ``code``, ``error`` and ``label_error`` of every sound vector, and the codebooks.

    Rows and codebooks as in ``learn`` and ``encode``; rows that would have no code are dropped. The sound vectors are
    written once, since every round reads them. No rows: an empty table and no codebooks.
    """
    kept = vectors.select(c(key).alias("_key"), c(vector).cast("array<double>").alias("_vector"), c(label).alias("_group"))
    kept = materialize(kept.where(_sound("_vector")), "vectors")
    books = learn(kept, "_key", "_vector", parts, entries, rounds, scale)
    coded = materialize(encode(kept, books, "_vector", scale).drop("_vector"), "codes")
    out = with_group_error(coded, "_group").select(
        F.col("_key").alias(key), F.col("_group").alias(label), "code", "error", "label_error"
    )
    return out, books


def components(books: dict[int, list[Book]]) -> Iterator[int]:
    """All components of all entries by vector length, part, entry and place."""
    for dim in sorted(books):
        for book in books[dim]:
            for entry in book.entries.tolist():
                yield from map(int, entry)
