"""A training-corpus pipeline over ``documents``: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the
last return the columns of ``documents``; a stage sees what its predecessor kept.

1. toxicity: documents predicted toxic go.
2. line dedup: boilerplate lines of a host are cut out of the texts; documents that
   had words and keep none go.  Copies count as one page, and a line must be on
   ``LEAST_PAGES`` of those, so a group of copies stays for stage 3.  The rule is the
   same for hosts of every size.  Passages (lines of 50 words or more) that repeat on
   over ``LONG_RATIO`` of a host's distinct pages stay on the page of the smallest id.
3. n-gram Jaccard join: of each class of near copies the document of the smallest id stays.
4. benchmark decontamination: spans of benchmark passages are cut out of the texts;
   documents that had words and keep none go.
5. packing: the texts' ids are packed into sequences.

Defined cases: null ids, texts, languages and sources pass every filter that
has no reason against them; rows with a null id are never near copies; repeated
rows of one id and text become one in stage 3; of texts that tie as near copies the one of the
smallest id stays; texts of any length are read whole; an empty table gives an empty one at every stage;
extra columns pass through to stage 5 as they came, whatever their names, also those that an
operator gives to a column of its own; ``n_chars`` follows the text where the column exists.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.llm import fm_index, line_dedup, ngram_join, packing, queries, toxicity
from railtrace.llm.common import q, table, written

LEAST_PAGES = 3  # distinct pages of a host that hold a boilerplate line
LONG_RATIO = 0.002  # of a host's pages; a long line on more stays on one page alone
HAS_WORD = r"[^\x20\x09-\x0D]"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def apart(stage):
    """A stage that sees extra columns under names that clash with none of the operators'."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        renamed = docs.toDF(*[c if c in COLUMNS else f"extra {i}" for i, c in enumerate(docs.columns)])
        return stage(spark, renamed, sf_dir).toDF(*docs.columns)

    return run_stage


@apart
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the labels are of the documents as they came, and so is what the model learns from
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted_ = 0").select(*_names(docs))


@apart
def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(docs, least=LEAST_PAGES, copies_once=True, long_ratio=LONG_RATIO)
    return _with_texts(cleaned.where(_not_emptied("n_dropped_ > 0")), docs)


@apart
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = ngram_join.similar_documents(docs.select("doc_id", "text"))
    kept = classes.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id_")).distinct()
    named = docs.where("doc_id IS NOT NULL").alias("d").join(kept, F.col("d.doc_id") == F.col("kept_id_"), "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).select(*_names(docs)).unionByName(docs.where("doc_id IS NULL"))


@apart
def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = fm_index.find_contamination(docs, table(spark, sf_dir, "benchmark"), clean=True)
    return _with_texts(cleaned.where(_not_emptied("size(spans_) > 0")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.toDF(*[c if c in COLUMNS else f"extra {i}" for i, c in enumerate(docs.columns)])
    return packing.pack_documents(docs, queries.word_tokenizer(), queries.END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", cut_benchmark),
    ("packing", pack),
]

# the toxicity model is not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; each stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


def _names(docs: DataFrame):
    return [F.col(q(c)) for c in docs.columns]


def _not_emptied(changed: str) -> str:
    """Keeps a document unless it changed and has no word left."""
    return f"NOT ({changed} AND NOT coalesce(text, '') RLIKE r'{HAS_WORD}')"


def _with_texts(changed: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return changed.select(*_names(docs))
    n_chars = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
    return changed.select(*[n_chars.alias(c) if c == "n_chars" else F.col(q(c)) for c in docs.columns])
