"""SimHash near-duplicates: a grid range join over segment bit counts, then exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blob_rows, c, materialize, small_batches
from .components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
SEGMENT_BITS = 4

#: For each byte value its eight bits, one in each byte of a 64-bit number.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles (ASCII lower case, ASCII white space); zero without words."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(start, end[words - 1 :].tolist())], dtype="<u8")
    lanes = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    # Each of the 64 lanes is a byte: sum at most 255 rows before widening.
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    counts = np.ascontiguousarray(sums).view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """``key, fp`` for every row; ``fp`` is the fingerprint as a signed long. A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in blob_rows([batch], 1):
                made = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=["key", "fp"])

    small_batches(docs.sparkSession)
    narrow = docs.select(key.alias("key"), c(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"key {kind}, fp long")


def links(prints: DataFrame, max_bits: int = MAX_BITS, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """Pairs ``u < v`` of different fingerprints in ``prints`` (distinct ``fp``) that differ in at most ``max_bits`` bits.

    A fingerprint becomes the vector of its segments' bit counts. Two fingerprints differ in at least as many
    bits as the Manhattan distance of their vectors, so a range join on the grid of vectors finds every pair:
    around each vector lies a ball of radius ``max_bits / 2``, and balls of vectors within ``max_bits`` share a
    cell. Pairs of a cell are verified by the bits in which they differ.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("the balls are built for up to 2 bits")
    wide = 4 if segment_bits < 8 else 5 if segment_bits < 16 else 8
    n = 64 // segment_bits
    if wide * n > 64 or 64 % segment_bits:
        raise ValueError("the segments' bit counts must fit in 64 bits")
    mask = F.lit(2**segment_bits - 1)
    code = F.lit(0).cast("long")
    for i in range(n):
        count = F.bit_count(F.shiftrightunsigned("fp", segment_bits * i).bitwiseAND(mask)).cast("long")
        code = code.bitwiseXOR(F.shiftleft(count, wide * i))
    # 1 << 63 would overflow a literal: build the steps as signed longs. Sums wrap on both sides alike.
    steps = [(1 << (wide * i)) - (1 << 64 if wide * i == 63 else 0) for i in range(n)]
    cells = F.array(F.col("code"), *[F.col("code").bitwiseXOR(F.lit(0)) + F.lit(s) for s in steps], *[F.col("code") - F.lit(s) for s in steps])
    placed = materialize(prints.select("fp", code.alias("code")).select("fp", F.explode(cells).alias("cell")), "cells")
    left, right = placed.select("cell", F.col("fp").alias("u")), placed.select("cell", F.col("fp").alias("v"))
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    return left.join(right, (left["cell"] == right["cell"]) & near).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, ``fingerprint`` (16 hex digits), ``component_id`` and ``n_links``.

    ``component_id`` is the smallest key of all rows whose fingerprints are reachable over links; ``n_links`` counts
    the other fingerprints that the row's own is linked to. Rows of one fingerprint are one class and are never
    paired. Null and empty texts have fingerprint zero. Repeated rows and null keys keep their rows; a component of
    null keys only has a null id.
    """
    prints = materialize(fingerprints(docs, c(key), text), "prints")
    classes = prints.groupBy("fp").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    named = classify(classes)
    return attach_classes(prints, named).select(
        F.col("key").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component_id"),
        F.col("n_links"),
    )


def classify(classes: DataFrame) -> DataFrame:
    """Adds ``component`` (a fingerprint), ``component_id`` (its smallest ``first``) and ``n_links`` to classes of ``fp``."""
    classes = materialize(classes, "classes")
    edges = materialize(links(classes.select("fp")), "links")
    member = components(edges)
    degree = edges.select(F.col("u").alias("fp")).unionByName(edges.select(F.col("v").alias("fp"))).groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    told = classes.join(member.withColumnRenamed("node", "fp"), "fp", "left").join(degree, "fp", "left")
    told = told.withColumn("component", F.coalesce("component", "fp")).withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    smallest = told.groupBy("component").agg(F.min("first").alias("component_id"))
    return materialize(told.join(smallest, "component"), "named")


#: Fingerprints with more rows than this are joined apart from the rest; there are at most rows / HOT_ROWS of them.
HOT_ROWS = 100_000


def attach_classes(prints: DataFrame, named: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Joins class results onto rows by ``fp``; rows of very frequent fingerprints take theirs from a broadcast."""
    hot = F.broadcast(named.where(F.col("n") > hot_rows))
    rest = named.where(F.col("n") <= hot_rows)
    return prints.join(hot, "fp").unionByName(prints.join(hot.select("fp"), "fp", "left_anti").join(rest, "fp"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest key, then of the smallest text hash.

    All columns stay as they are. Repeated rows and rows with null keys are duplicates like others: null keys are
    taken only where a component has no other.
    """
    ident = F.struct(F.isnull(c(key)).alias("none"), c(key).alias("id"), F.xxhash64(F.lit(0), c(text)).alias("hash"))
    prints = materialize(fingerprints(docs, ident, text), "prints")
    named = classify(prints.groupBy("fp").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")))
    keep = named.groupBy("component").agg(F.min("first").alias("first")).select("first.*")
    rows = docs.select(F.struct(*[c(x) for x in docs.columns]).alias("row"), F.coalesce(c(key).cast("string"), F.lit("")).alias("id"), F.isnull(c(key)).alias("none"), F.xxhash64(F.lit(0), c(text)).alias("hash"))
    kept = rows.join(keep.withColumn("id", F.coalesce(F.col("id").cast("string"), F.lit(""))), ["none", "id", "hash"], "left_semi")
    # Rows that agree in key and text are repeats; the first of each stays.
    return kept.groupBy("none", "id", "hash").agg(F.first("row").alias("row")).select("row.*")
