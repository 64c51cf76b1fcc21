"""Line dedup by site-relative frequency (operator 9), native.

For each host the share of its pages that contain a line is the number of
pages with the line over the number of pages of the host.  Lines above
``max_ratio`` and on ``least`` pages or more are boilerplate of that host and are dropped
from its pages.  The rule is the same for hosts of every size.

Plan: each page gives its distinct line keys (64-bit hashes); counts per
(host, line) are pre-aggregated before the shuffle; only lines above the ratio
go on.  Rows bound pages from above, so a line's ids are counted only if its rows are above it.  Their number is bounded per host by average lines a page over
``max_ratio``, whatever the host's size.  The pages that hold one are found by
an equi-join on (host, line), whose hot keys AQE splits, and gathered per page.

With ``copies_once`` pages of one host with the same set of lines count as one
page, above and below the line, for ``least`` too: a group of copies then never makes its own
text boilerplate.
With ``long_ratio`` a line of ``LONG_WORDS`` words or more is a repeated passage
where it is on more than that share of the pages of a host, and on ``least`` with
other lines; it stays on the page of the smallest id and is dropped from the others.

Defined cases: a line is compared without surrounding blanks, tabs and carriage
returns; blank lines are neither counted nor dropped; a null text stays null
with 0 lines; an empty text is one blank line; pages with a null host form one
host; rows of one id are one page when counted, rows without an id one each, and
rows of one id and host share their drops; an empty table gives an empty
result; other columns pass through unread, but for
those named like an added one, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import q

MAX_RATIO = 0.05
LEAST_PAGES = 3  # that hold a boilerplate line
LONG_WORDS = 50  # words of a line that is a passage

_KEY = "btrim(l, ' \\t\\r')"
# the length spares short lines the split
_LONG = f"length(l) >= {2 * LONG_WORDS - 1} AND size(split(l, '[ \\t]+')) >= {LONG_WORDS}"


def boilerplate_lines(
    pages: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_ratio: float = MAX_RATIO, least: int = LEAST_PAGES, copies_once: bool = False,
) -> DataFrame:
    """(host, line_key, n_pages, host_pages) of the lines above the ratio."""
    host, keys = F.col(q(host_col)).alias("host"), _line_keys(text_col)
    if copies_once:
        pages = pages.select(host, F.array_sort(keys).alias("keys")).distinct()
        # coalesce: Spark would else filter on the size of the keys, and make them again for it
        host, keys, n_pages = F.col("host"), F.coalesce("keys", F.array().cast("array<bigint>")), F.count("*")
    else:
        n_pages = F.countDistinct(q(id_col)) + F.count_if(F.col(q(id_col)).isNull())
    totals = pages.groupBy(host.alias("host_")).agg(n_pages.alias("host_pages"))

    def above(counts: DataFrame) -> DataFrame:
        common = counts.where(F.col("n_pages") >= least).join(totals, F.col("host").eqNullSafe(F.col("host_")))
        return common.where(F.col("n_pages") > max_ratio * F.col("host_pages")).select("host", "line_key", "n_pages", "host_pages")

    lines = pages.select(host, F.explode(keys).alias("line_key"))
    by_rows = above(lines.groupBy("host", "line_key").agg(F.count("*").alias("n_pages")))
    if copies_once:
        return by_rows
    held = pages.select(F.col(q(id_col)), F.col(q(host_col)).alias("of_host"), F.explode(_line_keys(text_col)).alias("of_key"))
    on_lines = held.join(by_rows, (F.col("of_key") == F.col("line_key")) & F.col("of_host").eqNullSafe(F.col("host")))
    return above(on_lines.groupBy("host", "line_key").agg(n_pages.alias("n_pages")))


def repeated_passages(
    pages: DataFrame, ratio: float, least: int, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
) -> DataFrame:
    """(host, line_key, keeper, n_pages, host_pages) of the long lines above the ratio; the keeper is an id."""
    page = F.xxhash64(F.array_sort(_line_keys(text_col)))
    held = pages.select(F.col(q(id_col)).alias("id"), F.col(q(host_col)).alias("host"), page.alias("page"), _line_keys(text_col, _LONG).alias("keys"))
    counts = (
        held.select("id", "host", "page", F.explode("keys").alias("line_key"))
        .groupBy("host", "line_key").agg(F.min("id").alias("keeper"), F.countDistinct("page").alias("n_pages"))
        .where(F.col("n_pages") >= least)
    )
    totals = held.groupBy(F.col("host").alias("host_")).agg(F.countDistinct("page").alias("host_pages"))
    return counts.join(totals, F.col("host").eqNullSafe(F.col("host_"))).where(
        F.col("n_pages") > ratio * F.col("host_pages")
    ).select("host", "line_key", "keeper", "n_pages", "host_pages")


def drop_boilerplate(
    pages: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_ratio: float = MAX_RATIO, least: int = LEAST_PAGES, copies_once: bool = False,
    long_ratio: float | None = None,
) -> DataFrame:
    """The pages with boilerplate lines cut out of the text, plus ``n_lines_`` and ``n_dropped_``."""
    hot = boilerplate_lines(pages, id_col, text_col, host_col, max_ratio, least, copies_once).select(
        F.col("host").alias("hot_host"), F.col("line_key").alias("hot_key")
    )
    on_page = pages.select(
        F.col(q(id_col)).alias("page_"), F.col(q(host_col)).alias("host_"), F.explode(_line_keys(text_col)).alias("key_")
    )
    same = F.col("key_").eqNullSafe(F.col("hot_key")) & F.col("host_").eqNullSafe(F.col("hot_host"))
    found = on_page.join(hot, same).select("page_", "host_", "key_")
    if long_ratio is not None:
        passages = repeated_passages(pages, long_ratio, least, id_col, text_col, host_col).select(
            F.col("host").alias("hot_host"), F.col("line_key").alias("hot_key"), "keeper"
        )
        others = on_page.join(passages, same).where(~F.col("page_").eqNullSafe(F.col("keeper")))
        found = found.unionByName(others.select("page_", "host_", "key_"))
    drops = (
        found.groupBy("page_", "host_").agg(F.collect_set("key_").alias("drop_"))
    )
    joined = pages.alias("p").join(
        drops.alias("d"),
        F.col(f"p.{q(id_col)}").eqNullSafe(F.col("d.page_")) & F.col(f"p.{q(host_col)}").eqNullSafe(F.col("d.host_")),
        "left",
    )
    text = f"p.{q(text_col)}"
    kept = f"filter(split({text}, '\\n', -1), l -> {_KEY} = '' OR NOT array_contains(d.drop_, xxhash64({_KEY})))"
    n_lines = f"CASE WHEN {text} IS NULL THEN 0L ELSE CAST(length({text}) - length(replace({text}, '\\n', '')) + 1 AS BIGINT) END"
    cleaned = F.expr(f"CASE WHEN d.drop_ IS NULL THEN {text} ELSE array_join({kept}, '\\n') END")
    dropped = F.expr(f"CASE WHEN d.drop_ IS NULL THEN 0L ELSE {n_lines} - CAST(size({kept}) AS BIGINT) END")
    columns = [cleaned.alias(c) if c == text_col else F.col(f"p.{q(c)}") for c in pages.columns if c not in ("n_lines_", "n_dropped_")]
    return joined.select(*columns, F.expr(n_lines).alias("n_lines_"), dropped.alias("n_dropped_"))


def _line_keys(text_col: str, which: str = "l <> ''"):
    """Distinct hashes of a page's lines that are not blank, or of those that ``which`` names."""
    lines = f"filter(transform(split({q(text_col)}, '\\n', -1), l -> {_KEY}), l -> {which})"
    return F.expr(f"array_distinct(transform({lines}, l -> xxhash64(l)))")
