"""Ranked lexical search with range-maximum tables over posting lists.

Documents are read once into rows of query terms and counts. Each task turns its rows into shards: posting lists of
impacts with a sparse table of range maxima per list. A query starts from the interval of all documents of the
shard and always opens the intervals of highest bound, the sum of its terms' largest impacts there. An interval is
split at the document of its largest impact, which is scored exactly; the search ends when no interval left can
reach the k-th score. Shards exchange nothing, and each task returns k documents per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blob_rows, c, materialize, small_batches

#: (item, term) pairs that one pass over the documents serves.
BLOCK_TERMS = 200_000
#: Postings of a shard; its tables take about 100 bytes each.
SHARD_POSTINGS = 500_000
#: Intervals opened together.
OPENED = 256
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters of a UTF-8 text, with A-Z lower-cased."""
    return (text or b"").translate(_BYTES).split()


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Posting lists of some documents, each with a sparse table of the places of its range maxima."""

    def __init__(self, keys: list, lengths: Sequence[int], lists: list[np.ndarray], counts: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
        # Documents alike in length, terms and counts score alike: of each such class only the k smallest keys can win.
        classes: dict[tuple, list] = {}
        for key, n, t, f in zip(keys, lengths, lists, counts):
            classes.setdefault((n, t.tobytes(), f.tobytes()), []).append((key is None, key))
        # Documents of similar length lie side by side, so that the bounds of intervals are close.
        order = sorted(classes, key=lambda x: x[0])
        self.keys = [sorted(classes[x], key=lambda v: (v[0], v[1] or 0))[:k] for x in order]
        sizes = np.array([len(x[1]) // 4 for x in order], np.int64)
        term = np.frombuffer(b"".join(x[1] for x in order), np.int32).astype(np.int64)
        tf = np.frombuffer(b"".join(x[2] for x in order), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(order)), sizes)
        wide = np.int64 if 90 * max(lengths, default=0) * n_docs < 2**62 else object
        m = (10 + 90 * np.array([x[0] for x in order], wide) * n_docs // max(n_terms, 1)).astype(np.int64)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        place = np.argsort(term, kind="stable")
        self.n_docs = len(order)
        self.doc, self.impact = doc[place], impact[place]
        self.posting = term[place] * self.n_docs + self.doc
        self.ends = np.cumsum(np.bincount(term, minlength=len(weights)))
        self.starts = self.ends - np.bincount(term, minlength=len(weights))
        longest = int((self.ends - self.starts).max(initial=0))
        self.level_of = np.frexp(np.arange(longest + 1))[1] - 1
        levels = [np.arange(len(self.doc), dtype=np.int32)]
        # Level j holds the place of the maximum of 2^j postings; ranges never leave a list, so lists may share rows.
        while 2 ** len(levels) <= longest:
            low, half = levels[-1], 2 ** (len(levels) - 1)
            high = np.concatenate([low[half:], low[-half:]])
            levels.append(np.where(self.impact[low] >= self.impact[high], low, high))
        self.table = np.concatenate(levels) if len(self.doc) else np.empty(0, np.int32)

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the largest impact in [low, high) of the postings; value 0 where that is empty."""
        size = high - low
        some = size > 0
        level = self.level_of[np.maximum(size, 1)]
        base = level * len(self.doc)
        a = self.table[np.where(some, base + low, 0)]
        b = self.table[np.where(some, base + high - (1 << level.astype(np.int64)), 0)]
        at = np.where(self.impact[a] >= self.impact[b], a, b)
        return at, np.where(some, self.impact[at], 0)

    def search(self, wanted: np.ndarray, k: int, best: list[tuple], opened: int = OPENED) -> tuple[list[tuple], int]:
        """``best`` (score falling, then key) after this shard's documents, and how many documents were scored."""
        t = wanted[self.starts[wanted] < self.ends[wanted]]
        if not len(t):
            return best, 0
        low, high = self.starts[t][None, :], self.ends[t][None, :]
        scored = 0

        def bounded(low, high):
            at, value = self.largest(low, high)
            split = at[np.arange(len(at)), value.argmax(axis=1)]
            return value.sum(axis=1), self.doc[split]

        bound, split = bounded(low, high)
        while True:
            least = -best[-1][0] if len(best) == k else 1
            alive = np.flatnonzero(bound >= least)
            if not len(alive):
                return best, scored
            bound, split, low, high = bound[alive], split[alive], low[alive], high[alive]
            pick = np.argpartition(-bound, opened)[:opened] if len(bound) > opened else np.arange(len(bound))
            at = np.searchsorted(self.posting, t[None, :] * self.n_docs + split[pick][:, None])
            at = np.clip(at, low[pick], high[pick])
            inside = at < high[pick]
            here = np.where(inside, at, 0)
            held = inside & (self.doc[here] == split[pick][:, None])
            score = np.where(held, self.impact[here], 0).sum(axis=1)
            scored += len(pick)
            good = [(-int(score[i]), *v) for i in np.flatnonzero(score >= least) for v in self.keys[split[pick[i]]]]
            if good:
                best = sorted(best + good, key=lambda v: (v[0], v[1], v[2] or 0))[:k]
            rest = np.ones(len(bound), bool)
            rest[pick] = False
            new_low = np.concatenate([low[pick], at + held])
            new_high = np.concatenate([at, high[pick]])
            new_bound, new_split = bounded(new_low, new_high)
            bound, split = np.concatenate([bound[rest], new_bound]), np.concatenate([split[rest], new_split])
            low, high = np.concatenate([low[rest], new_low]), np.concatenate([high[rest], new_high])


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``key, n, terms, counts`` of the documents with a term: their length and their terms of the vocabulary, by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (texts,) = blob_rows([batch], 1)
            lengths, sizes, ids, counts = [], [0], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for text in texts:
                words = terms(text)
                lengths.append(len(words))
                got, n = np.unique(np.array([vocabulary[w] for w in words if w in vocabulary], np.int64), return_counts=True)
                ids.append(got)
                counts.append(n)
                sizes.append(sizes[-1] + len(got))
            lists = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(x), pa.int32())) for x in (ids, counts)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *lists], names=["key", "n", "terms", "counts"])
            yield out.filter(pa.array(np.array(lengths) > 0))

    return docs.mapInArrow(run, "key long, n long, terms array<int>, counts array<int>")


def _doc_counts(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term id occurs; a task returns one row per term it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some], pa.int64())], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for term, n in rows.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return out


def _asked(items: DataFrame, item: str, text: str) -> DataFrame:
    """Distinct ``item, term`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(set(terms(x))) for x in next(blob_rows([batch], 1))]
            at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]), pa.int64())
            flat = pa.array([w for x in found for w in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), flat], names=["item", "term"])

    rows = items.select(c(item).cast("long").alias("item"), c(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "item long, term binary").distinct()


def _search_block(docs: DataFrame, pairs: list[tuple], k: int, shard_postings: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for _, t in pairs}))}
    by_item: dict[int | None, list[int]] = {}
    for item, term in pairs:
        by_item.setdefault(item, []).append(vocabulary[bytes(term)])
    rows = materialize(postings(docs, vocabulary), "postings")
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = one["n"], one["terms"] or 0
    weights = np.array([weight(int(df), n_docs) for df in _doc_counts(rows, len(vocabulary))], np.int64)
    wanted = {item: np.array(sorted(ids), np.int64) for item, ids in by_item.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, list[tuple]] = {item: [] for item in wanted}
        held: tuple[list, list, list, list] = ([], [], [], [])
        size = 0

        def flush():
            shard = Shard(*held, weights, n_docs, n_terms, k)
            for item, ids in wanted.items():
                best[item] = shard.search(ids, k, best[item])[0]

        for batch in batches:
            lists = [batch.column(i) for i in (2, 3)]
            stops = lists[0].offsets.to_numpy()
            flat = [x.values.to_numpy().astype(np.int32) for x in lists]
            keys, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                a, z = stops[i], stops[i + 1]
                if a == z:
                    continue
                for part, value in zip(held, (keys[i], lengths[i], flat[0][a:z], flat[1][a:z])):
                    part.append(value)
                size += z - a
                if size >= shard_postings:
                    flush()
                    held, size = ([], [], [], []), 0
        if size:
            flush()
        out = [(item, key, -score) for item, rows in best.items() for score, _, key in rows]
        columns = zip(*out) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def _none(spark: SparkSession) -> DataFrame:
    return spark.range(0).selectExpr("id AS item_id", "id AS doc_id", "id AS score")


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    k: int = 10, block_terms: int = BLOCK_TERMS, shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the k documents of highest score above 0.

    Keys of documents and items are whole numbers. Texts are read whole; null and empty texts have no terms and take no
    part. Every row of ``docs`` is a document of its own, repeated rows too; a null key ranks after others of equal
    score. Rows of one item key, null included, are one item with the terms of all of them. Equal scores go to the
    smaller key. Other columns are not read. Empty tables give no rows.

    Items are served in blocks of about ``block_terms`` (item, term) pairs, counted first; each block is one pass over
    the texts, whose query terms are written, counted and then searched in shards of about ``shard_postings``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    asked = materialize(_asked(items, item, item_text), "asked")
    blocks = -(-asked.count() // block_terms)
    texts = docs.select(c(key).cast("long").alias("key"), c(text).cast("string").alias("text"))
    found = _none(spark)
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        pairs = [tuple(r) for r in mine.collect()]
        if pairs:
            found = found.unionByName(_search_block(texts, pairs, k, shard_postings))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
