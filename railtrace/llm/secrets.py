"""Secret scan with an incremental blob ledger (operator 10), native.

Every historical version of a path is content-addressed by the SHA-256 of its
text.  The ledger holds one row per (blob, rule, rule version) that has been
scanned, with the spans found.  A run scans only pairs the ledger does not
have, appends them, and joins the findings back to every path that ever held
the blob.

Spans are code-point offsets ``[start, end)``.  Spark has no function for match
positions, so they come from two arrays of one pattern: the gaps that
``split`` leaves and the matches that ``regexp_extract_all`` returns; running
sums of their lengths give the starts.  Leftmost, non-overlapping matching is
the same in both.  The sums go block by block of ``BLOCK`` matches, and each array of a
text is made once, so a text of many matches takes time in proportion to them.

A rule may name a group whose length must reach ``min_length``; matches below
it are dropped after matching (they still consume their text).

Defined cases: a null text is an empty blob without findings; equal texts are
one blob, scanned once, whatever their number; repeated (path, version) rows
each get their findings; an empty table scans nothing; other columns pass
through, but for those named like an added one; zero-length matches cannot occur with these rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.llm.common import q, shared_path


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0  # the group whose length counts
    min_length: int = 0
    hint: str = ""  # a cheap SQL test on column t that every text with a match passes


# Base kinds in the order that breaks ties between spans.
# `hex` asks for the run of 24 at once: maximal runs are the same either way.
# `access` likewise: a run that is too short from its first AKIA is too short from a later one.
BASE_RULES = (
    Rule("assign", 1,
         r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
         r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=1, min_length=6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", hint="contains(t, 'AKIA')"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
# Rules added by this operator.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="contains(t, '-----BEGIN ')"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+", hint="contains(t, '.eyJ')"),
    Rule("hub", 1, r"gh[opsu]_[A-Za-z0-9]{36,}", hint="contains(t, 'gh')"),
)
RULES = BASE_RULES + MORE_RULES
BASE_KINDS = tuple(r.kind for r in BASE_RULES)

BLOCK = 256  # matches of a text that are walked at a time
LEDGER_SCHEMA = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"


def blob_id(text_col: str):
    return F.sha2(F.coalesce(F.col(q(text_col)), F.lit("")).cast("binary"), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; an empty table where none has been written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_unseen(versions: DataFrame, ledger: str, text_col: str = "text", rules=RULES) -> None:
    """Scan the (blob, rule version) pairs that the ledger lacks and append them to it."""
    spark = versions.sparkSession
    known = read_ledger(spark, ledger)
    seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", F.col("version").cast("string"))).alias("seen"))
    # keys alone, no aggregate buffer: copies within a task go before the shuffle
    blobs = versions.select(blob_id(text_col).alias("blob"), F.coalesce(F.col(q(text_col)), F.lit("")).alias("t")).distinct()
    todo = blobs.alias("b").join(seen.alias("s"), F.col("b.blob") == F.col("s.blob"), "left").select(
        F.col("b.blob").alias("blob"), "t", F.coalesce("seen", F.array().cast("array<string>")).alias("seen")
    )
    found = []
    for r in rules:
        unseen = f"NOT array_contains(seen, '{r.kind}:{r.version}')"
        found.append(
            f"CASE WHEN {unseen} THEN named_struct('kind', '{r.kind}', 'version', {int(r.version)}, 'spans', {_spans(r)}) END"
        )
    rows = todo.select("blob", F.expr(f"filter(array({', '.join(found)}), x -> x IS NOT NULL)").alias("found"))
    rows = rows.select("blob", F.explode("found").alias("f")).select("blob", "f.kind", "f.version", "f.spans")
    rows.write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, text_col: str = "text", rules=RULES) -> DataFrame:
    """The versions' columns (without the text) plus ``found_``: array of (start, rank, kind, end), sorted.

    ``rank`` is the rule's place in ``rules``; it breaks ties of equal starts.
    """
    spark = versions.sparkSession
    current = spark.createDataFrame([(r.kind, r.version, i) for i, r in enumerate(rules)], "kind string, version int, rank int")
    hits = read_ledger(spark, ledger).where(F.size("spans") > 0)
    hits = hits.join(F.broadcast(current), ["kind", "version"])  # one row per rule
    per_blob = (
        hits.select("blob", "kind", "rank", F.explode("spans").alias("s"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct(
            F.col("s.start").alias("start"), F.col("rank"), F.col("kind"), F.col("s.end").alias("end")
        ))).alias("found_"))
        .withColumnRenamed("blob", "found_blob_")
    )
    paths = versions.select(
        *[F.col(q(c)) for c in versions.columns if c not in (text_col, "blob_", "found_", "found_blob_")], blob_id(text_col).alias("blob_")
    )
    return paths.join(per_blob, F.col("blob_") == F.col("found_blob_"), "left").drop("found_blob_")


def new_ledger(spark: SparkSession) -> str:
    return shared_path(spark, "ledger")


def _spans(r: Rule) -> str:
    """SQL for the spans of a rule in column t."""
    pattern = "r'" + r.pattern.replace("'", "\\x27") + "'"
    none = "CAST(array() AS array<struct<start:int,end:int>>)"
    found = f"regexp_extract_all(t, {pattern}, 0)"
    part = f"regexp_extract_all(t, {pattern}, {r.group})" if r.group else "v.found"
    blocks = f"sequence(0, (size(z) - 1) DIV {BLOCK})"
    block = f"slice(z, b * {BLOCK} + 1, {BLOCK})"
    lengths = f"transform({blocks}, b -> aggregate({block}, 0, (a, x) -> a + x.gap + x.len))"
    begins = (
        f"aggregate({lengths}, named_struct('at', 0, 'out', CAST(array() AS array<int>)), "
        "(a, n) -> named_struct('at', a.at + n, 'out', array_append(a.out, a.at)), a -> a.out)"
    )
    walk = (
        f"aggregate({block}, named_struct('at', begin, 'out', {none}), "
        "(a, x) -> named_struct('at', a.at + x.gap + x.len, 'out', "
        f"IF(x.part >= {r.min_length}, array_append(a.out, named_struct('start', a.at + x.gap, 'end', a.at + x.gap + x.len)), a.out)), "
        "a -> a.out)"
    )
    spans = f"flatten(zip_with({begins}, {blocks}, (begin, b) -> {walk}))"
    # v and z are bound by transform over one element, so that lambdas do not make them again
    z = (
        "zip_with(slice(v.gaps, 1, size(v.found)), zip_with(v.found, v.parts, (w, p) -> struct(char_length(w) AS len, char_length(p) AS part)), "
        "(g, m) -> struct(char_length(g) AS gap, m.len AS len, m.part AS part))"
    )
    bound = f"transform(array(named_struct('found', {found}, 'gaps', split(t, {pattern}, -1))), v -> named_struct('found', v.found, 'gaps', v.gaps, 'parts', {part}))"
    every = f"element_at(transform({bound}, v -> element_at(transform(array({z}), z -> {spans}), 1)), 1)"
    hint = f"{r.hint} AND " if r.hint else ""
    return f"CASE WHEN {hint}t RLIKE {pattern} THEN {every} ELSE {none} END"
