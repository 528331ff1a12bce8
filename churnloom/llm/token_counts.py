"""Exact length histogram of encoded documents, and what its suffix sums answer for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import c, small_batches

RANKS = "byte_bpe_50k.tiktoken"
BLOCK = 1024
_ENCODINGS: dict[tuple[str, str], object] = {}


def _encoding(path: str, pattern: str):
    """One encoder per worker process and vocabulary."""
    import tiktoken

    if (path, pattern) not in _ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def lengths(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``length, n_docs`` of each batch of documents: partial histograms, to be added up. Null texts have length 0."""
    small_batches(docs.sparkSession)
    named = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(named, pattern).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()]
            values, counts = np.unique(np.array(sizes, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], names=["length", "n_docs"])

    return docs.select(c(text).alias("text")).mapInArrow(run, "length long, n_docs long")


def length_histogram(partial: DataFrame) -> DataFrame:
    """One row per encoded length that occurs, read as a context limit of that length.

    ``n_docs`` have this length; ``n_longer`` are longer, with ``tokens_longer`` tokens; ``quantile`` is the share of
    documents that fit; ``tokens_fit`` are the tokens of documents that fit and ``tokens_truncated`` all tokens after
    cutting every document to the limit; ``n_total`` and ``tokens_total`` describe all documents. For a limit that does
    not occur as a length, see ``at_limits``. No documents give no rows.

    Suffix sums run over blocks of lengths and then inside each block, so no task sees more than a block's lengths
    or the list of blocks (the longest length / ``BLOCK``).
    """
    hist = partial.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    hist = hist.withColumn("tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.floor(F.col("length") / BLOCK))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("bn"), F.sum("tokens").alias("bt"))
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("bn").over(after), zero).alias("an"),
        F.coalesce(F.sum("bt").over(after), zero).alias("at"),
        F.sum("bn").over(everything).alias("n_total"),
        F.sum("bt").over(everything).alias("tokens_total"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    both = hist.join(blocks, "block")
    longer = F.col("an") + F.coalesce(F.sum("n_docs").over(inside), zero)
    tokens_longer = F.col("at") + F.coalesce(F.sum("tokens").over(inside), zero)
    out = both.withColumn("n_longer", longer).withColumn("tokens_longer", tokens_longer)
    return out.select(
        "length",
        "n_docs",
        "n_longer",
        "tokens_longer",
        ((F.col("n_total") - F.col("n_longer")) / F.col("n_total")).alias("quantile"),
        (F.col("tokens_total") - F.col("tokens_longer")).alias("tokens_fit"),
        (F.col("tokens_total") - F.col("tokens_longer") + F.col("n_longer") * F.col("length")).alias("tokens_truncated"),
        "n_total",
        "tokens_total",
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``limit, n_fit, tokens_fit, tokens_truncated`` for chosen context limits, from a length histogram."""
    limit = F.explode(F.array(*[F.lit(x).cast("long") for x in sorted(set(limits))])).alias("limit")
    cut = F.least("length", "limit") * F.col("n_docs")
    fits = F.col("length") <= F.col("limit")
    return (
        histogram.select("length", "n_docs", limit)
        .groupBy("limit")
        .agg(
            F.sum(F.when(fits, F.col("n_docs")).otherwise(0)).alias("n_fit"),
            F.sum(F.when(fits, cut).otherwise(0)).alias("tokens_fit"),
            F.sum(cut).alias("tokens_truncated"),
        )
    )


def quantile_length(histogram: DataFrame, q: float) -> int | None:
    """The smallest length that a share ``q`` of the documents does not exceed."""
    return histogram.where(F.col("quantile") >= q).agg(F.min("length")).first()[0]
