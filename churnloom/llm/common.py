"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

__all__ = ["append_columns", "attach_lists", "blob_rows", "c", "fresh", "give_back", "materialize", "short_plans", "small_batches"]

#: Entries of a list table that may be broadcast; at 16 to 40 bytes each this is at most 20 MB.
BROADCAST_ENTRIES = 500_000


def c(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(f"`{name.replace('`', '``')}`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    return f"_{stem}_{uuid.uuid4().hex[:8]}"


def append_columns(
    df: DataFrame, read: str, fields: T.StructType, compute: Callable[[pa.ChunkedArray], list[pa.Array]]
) -> DataFrame:
    """All columns of ``df`` and those of ``fields``, computed batch by batch from the column ``read``.

    A column of ``df`` with the name of a new field is replaced. No rows move between partitions.
    """
    small_batches(df.sparkSession)
    names = {f.name.lower() for f in fields}
    source = fresh(df, "read")
    kept = [x for x in df.columns if x.lower() not in names]
    narrow = df.select(*[c(x) for x in kept], c(read).alias(source))
    schema = T.StructType([*narrow.schema.fields[:-1], *fields.fields])
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = compute(batch.column(width))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(width)] + new, names=[f.name for f in schema.fields]
            )
        give_back()

    return narrow.mapInArrow(run, schema)


#: Rows of an Arrow batch: whole texts make wide rows, and a worker holds a batch several times over.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lowers the session's rows per Arrow batch to ``rows``; the setting is read when a plan runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def give_back() -> None:
    """Returns freed memory to the system: a worker is used again for later stages, and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def short_plans(spark: SparkSession, most: int = 100_000) -> None:
    """Limits the characters that the session prints of a plan, for plans that hold a large literal; a set limit stays."""
    name, unlimited = "spark.sql.maxPlanStringLength", 2_000_000_000
    value = spark.conf.get(name).rstrip("bB")
    if value.isdigit() and int(value) > unlimited:
        spark.conf.set(name, str(most))


def blob_rows(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[bytes | None]]:
    """The UTF-8 bytes of a text column, batch by batch."""
    for batch in batches:
        yield batch.column(column).cast(pa.binary()).to_pylist()


def attach_lists(
    rows: DataFrame, lists: DataFrame, on: str, entries: Column, spread: Sequence[Column], slice_rows: int, n_rows: str
) -> DataFrame:
    """Left-join one-row-per-key ``lists`` onto ``rows`` without loading one task with a hot key.

    ``entries`` counts what a list row holds. Lists of at most ``BROADCAST_ENTRIES`` entries in all are
    broadcast. Otherwise each key is cut into slices of about ``slice_rows`` rows: its list is repeated for
    each slice (``n_rows`` is the column with the key's row count) and rows take a slice by a hash of ``spread``.
    """
    lists = materialize(lists, "lists")
    total = lists.agg(F.sum(entries + 1)).first()[0] or 0
    if total <= BROADCAST_ENTRIES:
        return rows.join(F.broadcast(lists.drop(n_rows)), on, "left")
    slices = F.ceil(F.col(n_rows) / slice_rows).cast("int")
    widths = lists.where(slices > 1).select(on, slices.alias("_slices"))
    parts = lists.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.greatest(slices - 1, F.lit(0))))).drop(n_rows)
    # Keys of more than one slice number at most rows / slice_rows.
    cut = rows.join(F.broadcast(widths), on, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(*spread), F.coalesce("_slices", F.lit(1)).cast("long")).cast("int")
    )
    return cut.join(parts, [on, "_slice"], "left").drop("_slice", "_slices")
