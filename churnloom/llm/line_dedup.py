"""Site-relative line frequency: lines that a large share of a site's pages repeat are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach_lists, c

RATIO = 0.02
MIN_PAGES = 3
SLICE_ROWS = 200_000


def _code(line: Column) -> Column:
    """128 bits of a line as text."""
    return F.concat_ws(":", F.xxhash64(line), F.xxhash64(F.lit(1), line))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per site (``_site``) its page count (``_pages``) and the codes of its boilerplate lines (``_codes``).

    ``pages`` has ``_site`` and ``_lines``, the trimmed lines of a page. A line is boilerplate where at least
    ``min_pages`` pages of the site hold it and these are more than ``ratio`` of the site's pages. A site's
    list has at most (its mean number of lines per page) / ``ratio`` codes, whatever the number of pages.
    """
    totals = pages.groupBy("_site").agg(F.count(F.lit(1)).alias("_pages"))
    lines = pages.select("_site", F.explode(F.array_distinct("_lines")).alias("line")).where("line <> ''")
    counts = lines.groupBy("_site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")).agg(
        F.count(F.lit(1)).alias("n")
    )
    common = counts.where(F.col("n") >= min_pages).join(totals, "_site").where(F.col("n") > F.col("_pages") * ratio)
    return common.groupBy("_site").agg(
        F.max("_pages").alias("_pages"), F.collect_list(F.concat_ws(":", "h1", "h2")).alias("_codes")
    )


def drop_boilerplate(
    docs: DataFrame,
    text: str = "text",
    site: str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``docs`` with boilerplate lines cut out of ``text``, and the columns ``n_lines`` and ``n_dropped``.

    A line is what stands between line feeds, compared without surrounding spaces, tabs and carriage
    returns; blank lines are neither counted nor dropped. A page that repeats a line counts once for it.
    Every row stays, also one whose lines all go (its text becomes empty); a null text stays null with zero
    lines, an empty text has one blank line. Rows with a null site form a site of their own. Repeated rows
    are pages of their own. Existing columns named like the new ones are replaced.
    """
    kept = [x for x in docs.columns if x.lower() not in ("n_lines", "n_dropped")]
    trimmed = lambda x: F.regexp_replace(x, r"^[ \t\r]+|[ \t\r]+$", "")
    name = F.when(c(site).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), c(site).cast("string")))
    pages = docs.select(name.alias("_site"), F.transform(F.split(c(text), "\n"), trimmed).alias("_lines"))
    # The row travels as one struct, so its columns can't clash with the names used here.
    rows = attach_lists(
        docs.select(F.struct(*[c(x) for x in kept]).alias("_row"), name.alias("_site"), F.split(c(text), "\n").alias("_lines")),
        boilerplate(pages, ratio, min_pages),
        "_site",
        F.size("_codes"),
        [F.col("_lines")],
        slice_rows,
        "_pages",
    )
    stays = F.filter("_lines", lambda x: ~F.array_contains("_codes", _code(trimmed(x))))
    rows = rows.withColumn("_stays", F.when(F.col("_codes").isNull(), F.col("_lines")).otherwise(stays))
    size = lambda x: F.coalesce(F.when(F.col(x).isNotNull(), F.size(x)), F.lit(0)).cast("long")
    out = [F.array_join("_stays", "\n").alias(x) if x == text else F.col("_row").getField(x).alias(x) for x in kept]
    return rows.select(*out, size("_lines").alias("n_lines"), (size("_lines") - size("_stays")).alias("n_dropped"))
