"""URL filter by host-suffix and path-prefix expressions (operator 7), native.

Every URL is expanded into ``suffix`` + ``path prefix`` expressions: each
suffix of the host whose number of labels some rule has, with each prefix of the path whose
length some rule has.  Expressions and rules meet in an equi-join on the first 32 bits of their
SHA-256; the full digest confirms a match and the longest rule wins (the
longer expression, then the longer host; ``block`` before ``allow`` for one
expression with both).

The verdict depends on the host and the few path prefixes alone, so URLs are
first reduced to distinct (host, prefixes); a host that holds a third of all
pages is looked up once.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule and gets the default verdict; hosts keep ports and user parts as
written; an empty path fits no rule, since every rule path starts with ``/``;
repeated rows each get their verdict; with no rules all get the default;
other columns pass through, but for those named like one that is added here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.llm.common import q

# The rules of the registered query.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
DEFAULT_VERDICT = "allow"
_ADDED = ("host_", "path_", "rule_", "verdict_", "lengths_", "labels_", "prefixes_", "b_host", "b_prefixes", "found_")
PREFIX_HEX = 8  # hex digits of the digest that the join key has

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT_VERDICT
) -> DataFrame:
    """The pages' columns plus ``host_``, ``path_``, ``rule_`` (null if none fits) and ``verdict_``."""
    url = q(url_col)
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END"
    rest = f"coalesce({rest}, '')"
    host = _ASCII_LOWER.format(f"regexp_extract({rest}, '^[^/?#]*', 0)")
    path = f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
    passed = [F.col(q(c)) for c in pages.columns if c not in _ADDED]
    keyed = pages.select(
        *passed,
        F.expr(host).alias("host_"), F.expr(path).alias("path_"),
    )
    # the path lengths that rules have: at most one entry for each length of a path
    lengths = rules.agg(F.array_sort(F.collect_set(F.length("path"))).alias("l")).scalar()
    labels = rules.agg(F.array_sort(F.collect_set(F.size(F.split("host", "[.]", -1)))).alias("l")).scalar()
    keyed = keyed.withColumn("lengths_", lengths).withColumn("prefixes_", F.expr(
        "transform(filter(coalesce(lengths_, array()), n -> n <= length(path_)), n -> substring(path_, 1, n))"
    )).drop("lengths_")
    places = keyed.select("host_", "prefixes_").distinct()
    # the host is split once: the array of its labels is bound by transform over one element
    suffixes = (
        "element_at(transform(array(split(host_, '[.]', -1)), l -> "
        "transform(filter(coalesce(labels_, array()), n -> n <= size(l)), n -> array_join(slice(l, size(l) - n + 1, n), '.'))), 1)"
    )
    expressions = places.withColumn("labels_", labels).select(
        "host_", "prefixes_", F.explode(F.expr(suffixes)).alias("suffix"),
    ).select("host_", "prefixes_", "suffix", F.explode("prefixes_").alias("prefix"))
    expressions = _digested(expressions.withColumn("expression", F.concat("suffix", "prefix"))).alias("e")
    keyed_rules = _digested(rules.select(
        F.concat("host", "path").alias("expression"), F.length("host").alias("host_length"), "verdict"
    )).alias("r")
    fits = expressions.join(
        keyed_rules,
        (F.col("e.short") == F.col("r.short")) & (F.col("e.digest") == F.col("r.digest"))
        & (F.length("e.suffix") == F.col("host_length")),
    )
    best = fits.groupBy("host_", "prefixes_").agg(
        F.max(F.struct(
            F.length("r.expression").alias("n"), F.col("host_length"),
            F.col("verdict").alias("verdict"), F.col("r.expression").alias("rule"),
        )).alias("best")
    ).select(
        F.col("host_").alias("b_host"), F.col("prefixes_").alias("b_prefixes"),
        F.col("best.rule").alias("rule_"), F.col("best.verdict").alias("found_"),
    )
    judged = keyed.join(
        best, (F.col("host_") == F.col("b_host")) & (F.col("prefixes_") == F.col("b_prefixes")), "left"
    )
    return judged.select(
        *passed, "host_", "path_", "rule_",
        F.coalesce("found_", F.lit(default)).alias("verdict_"),
    )


def _digested(df: DataFrame) -> DataFrame:
    """Adds the full digest and the short hash prefix of ``expression``."""
    digest = F.sha2("expression", 256)
    return df.withColumn("digest", digest).withColumn("short", F.substring(F.col("digest"), 1, PREFIX_HEX))
