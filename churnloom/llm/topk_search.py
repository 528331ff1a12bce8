"""Exact top-k by inner product with vector-approximation files, block against block."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import c, give_back, materialize

CELL_BITS = 6
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
#: Blocks of vectors that a task takes, and bytes of queries that all tasks hold at once.
TASK_BLOCKS = 64
ROUND_BYTES = 32_000_000
_EXACT = 2.0**53
_FIRST_READ = 64


def _exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in doubles while every sum stays exact, else in Python integers."""
    top = (np.abs(q).max(initial=0) + 1) * (np.abs(x).max(initial=0) + 1) * max(x.shape[1], 1)
    if top < _EXACT:
        return (x @ q).astype(np.int64)
    wide = [[int(v) for v in r] for r in x.tolist()]
    qi = [int(v) for v in q.tolist()]
    limit = 2**63 - 1
    return np.array([max(-limit - 1, min(limit, sum(a * b for a, b in zip(r, qi)))) for r in wide], dtype=np.int64)


def cells(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell numbers of each component, with the low end and the width of each dimension's cells."""
    low = x.min(axis=0)
    width = np.maximum((x.max(axis=0) - low) / (2**bits), 1e-9)
    return np.minimum((x - low) // width, 2**bits - 1).astype(np.uint8), low, width


def _improve(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, k: int, bits: int, best: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Takes one block of vectors into ``best``, the k best (vector ids, scores) so far of each query.

    Bounds of all scores come from the cells alone. Exact vectors are read by falling upper bound, until the k-th
    best exact score is above every bound that is left (equal bounds are read too, for ties by id). What earlier
    blocks gave counts from the start, so a block without a bound that high is not read for the query.
    """
    code, low, width = cells(x, bits)
    middle = code * width + (low + width / 2)
    reach = np.abs(q) @ (width / 2)
    # Rounding of the float sums stays far below this slack.
    slack = 1e-9 * (np.abs(q) @ np.abs(middle).max(axis=0, initial=0)) + 1e-6
    upper = q @ middle.T + (reach + slack)[:, None]
    least = np.array([float(s[-1]) if len(s) == k else -np.inf for _, s in best])
    # A bound that is not a number rules nothing out.
    open_ = ~(upper < least[:, None])
    for j in np.flatnonzero(open_.any(axis=1)):
        bound = upper[j]
        alive = np.flatnonzero(open_[j] & (vid != qid[j]))
        got_v, got_s = best[j]
        size = max(_FIRST_READ, 4 * k)
        while len(alive):
            take = alive if len(alive) <= size else alive[np.argpartition(-bound[alive], size)[:size]]
            got_v, got_s = np.append(got_v, vid[take]), np.append(got_s, _exact_scores(q[j], x[take]))
            first = np.lexsort((got_v, -got_s))[:k]
            got_v, got_s = got_v[first], got_s[first]
            left = np.ones(len(x), bool)
            left[take] = False
            alive = alive[left[alive]]
            if len(got_s) == k:
                alive = alive[bound[alive] >= got_s[-1]]
            size *= 2
        best[j] = got_v, got_s


def _nothing(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(n)]


def _listed(qid: np.ndarray, best: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) arrays of all queries."""
    if not best:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return np.repeat(qid, [len(v) for v, _ in best]), np.concatenate([v for v, _ in best]), np.concatenate([s for _, s in best])


def search_block(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, k: int, bits: int):
    """The k best rows of one block for each query: (query id, vector id, score) arrays."""
    best = _nothing(len(q))
    _improve(qid, q, vid, x, k, bits, best)
    return _listed(qid, best)


def _pack(x: np.ndarray) -> tuple[str, bytes]:
    """Whole components in the narrowest type that holds them."""
    top = np.abs(x).max(initial=0)
    kind = "<i2" if top < 2**15 else "<i4" if top < 2**31 else "<f8"
    return kind, x.astype(kind).tobytes()


def _unpack(kind: str, data: bytes | pa.Buffer, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, dim).astype(float)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    scale: int = 1024,
    bits: int = CELL_BITS,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows of highest integer inner product.

    Components become floor(scale * x). ``is_query`` is a condition on the columns of ``vectors``. Rows with a
    null key, a null vector, or a null or non-finite component take no part; vectors of another length than the
    query's are not compared with it. Exact repeats of a row (same key and vector) count once; rows that share a
    query's key are not its candidates. Ties go to the smaller key. Scores beyond 64 bits are clipped. Fewer
    than k candidates give fewer rows.

    Vectors are dealt into blocks of about ``block_rows`` by a hash and packed. Queries go to every task, at most
    ``ROUND_BYTES`` at once; a task takes its blocks one after the other, ``query_rows`` queries at a time, and returns k
    rows per query for all of them. So what is shuffled and held follows the vectors and queries, not their pairs.
    """
    given = vectors.select(c(key).cast("long").alias("id"), c(vector).alias("vector"), is_query.alias("is_query"))
    if given.schema["vector"].dataType != T.ArrayType(T.FloatType()):
        given = given.withColumn("vector", F.col("vector").cast("array<double>"))
    fine = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = given.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(fine)
    sizes = {
        r["dim"]: (r["n"], r["m"])
        for r in given.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("m")).collect()
    }
    blocks = F.create_map(*[F.lit(v) for d, (n, _) in sizes.items() for v in (d, -(-n // block_rows))]) if sizes else F.create_map(F.lit(0), F.lit(1))
    total = sum(-(-n // block_rows) for n, _ in sizes.values())
    spark = vectors.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BLOCKS))
    dealt = (
        given.groupBy("id", "vector")
        .agg(F.max("is_query").alias("is_query"))
        .withColumn("dim", F.size("vector"))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(7), "id", "vector"), blocks[F.col("dim")].cast("long")))
        .repartition(tasks, "dim", "block")
    )

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("id").to_numpy().astype(np.int64)
        dim = table.column("dim")[0].as_py()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
        x = np.floor(flat.reshape(len(ids), dim) * scale)
        asked = np.flatnonzero(table.column("is_query").fill_null(False).to_numpy())
        kind, data = _pack(x)
        row = {
            "dim": [dim], "block": [table.column("block")[0].as_py()], "kind": [kind], "ids": [ids.tobytes()], "data": [data],
            "asked_ids": [ids[asked].tobytes()], "asked": [x[asked].astype(kind).tobytes()],
        }
        return pa.table(row, schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("kind", pa.string()), *[(n, pa.binary()) for n in ("ids", "data", "asked_ids", "asked")]]))

    packed = materialize(
        dealt.groupBy("dim", "block").applyInArrow(pack, "dim int, block long, kind string, ids binary, data binary, asked_ids binary, asked binary"), "vectors"
    )

    def ask(rounds: int, r: int) -> DataFrame:
        asking = packed.where((F.length("asked_ids") > 0) & (F.pmod(F.xxhash64("dim", "block"), F.lit(rounds)) == r))
        lists: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for row in asking.select("dim", "kind", "asked_ids", "asked").collect():
            ids = np.frombuffer(row["asked_ids"], np.int64)
            lists.setdefault(row["dim"], []).append((ids, np.frombuffer(row["asked"], row["kind"]).reshape(len(ids), row["dim"])))
        asked = spark.sparkContext.broadcast({d: (np.concatenate([i for i, _ in v]), np.concatenate([x for _, x in v])) for d, v in lists.items()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = {d: _nothing(len(ids)) for d, (ids, _) in asked.value.items()}
            for batch in batches:
                # One block at a time: a batch holds many.
                for i in range(batch.num_rows):
                    dim, kind = (batch.column(n)[i].as_py() for n in (0, 1))
                    if dim not in best:
                        continue
                    vid = np.frombuffer(batch.column(2)[i].as_buffer(), np.int64)
                    x = _unpack(kind, batch.column(3)[i].as_buffer(), dim, len(vid))
                    qid, q = asked.value[dim]
                    for start in range(0, len(qid), query_rows):
                        part = slice(start, start + query_rows)
                        mine = best[dim][part]
                        _improve(qid[part], q[part].astype(float), vid, x, k, bits, mine)
                        best[dim][part] = mine
            for d, found in best.items():
                for start in range(0, len(found), 10_000):
                    got = _listed(asked.value[d][0][start : start + 10_000], found[start : start + 10_000])
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["query_id", "vec_id", "score"])
            give_back()

        return packed.select("dim", "kind", "ids", "data").mapInArrow(run, "query_id long, vec_id long, score long")

    # Components count eight bytes each, however they are packed.
    rounds = max(1, -(-sum(m * 8 * (d + 1) for d, (_, m) in sizes.items()) // ROUND_BYTES))
    found = [ask(rounds, r) for r in range(rounds)]
    best = reduce(DataFrame.union, found)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
