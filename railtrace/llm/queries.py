"""Registered queries of the operators, and their DuckDB twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railtrace.llm import conversations, fm_index, line_dedup, maxent_lm, merkle, ngram_join, ordinal, packing, quality_rules, secrets, token_files, toxicity, url_filter
from railtrace.llm.common import table
from railtrace.llm.labelled import held_out


END_ID = 2  # ends every document


def word_tokenizer() -> str:
    """The public tokenizer's file; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, word_tokenizer(), END_ID, packing.Limits(tokens=4096, segments=128, loss=4096))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("score_").alias("score"), F.col("predicted_").alias("predicted")
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ids_once=True)


def quality_grade():
    """Graded ratings from the labels: 0 poor, 1 sound but toxic, 2 sound and not toxic."""
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, 2 - F.col("toxic"))


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.train(docs, table(spark, sf_dir, "labels"), quality_grade())
    graded = ordinal.grade_documents(docs, model)
    return graded.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("expected_grade_").alias("expected_grade"),
        F.col("tail_probability_").alias("tail_probability"), F.col("grade_").alias("grade"), F.col("kept_").alias("kept"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_token_files(docs, token_files.new_folder(spark), word_tokenizer(), END_ID)
    return token_files.read_documents(manifest).withColumnRenamed("id", "doc_id")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rules_table(spark))
    return judged.select(
        "page_id", F.col("host_").alias("host"), F.col("path_").alias("path"),
        F.col("rule_").alias("rule"), F.col("verdict_").alias("verdict"),
    )


def op8_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fm_index.find_contamination(docs, table(spark, sf_dir, "benchmark"), unnamed=True)
    n_hit = F.expr("aggregate(spans_, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        "doc_id", F.col("n_words_").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items_").cast("long").alias("n_items"),
        F.sha2(F.array_join("items_", ","), 256).alias("items_sha256"),
        (F.size("spans_") > 0).alias("contaminated"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = line_dedup.drop_boilerplate(docs)
    return cleaned.select(
        "doc_id", "source", F.col("n_lines_").alias("n_lines"), F.col("n_dropped_").alias("n_dropped"), "text"
    )


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.new_ledger(spark)
    secrets.scan_unseen(docs, ledger)
    found = secrets.findings(docs, ledger)
    n = {k: f"size(filter(found_, x -> x.kind = '{k}'))" for k in secrets.BASE_KINDS}
    base = ", ".join(f"'{k}'" for k in secrets.BASE_KINDS)
    none = "CAST(array() AS array<struct<start:int,rank:int,kind:string,end:int>>)"
    found = found.withColumn("found_", F.expr(f"coalesce(found_, {none})"))
    return found.select(
        "doc_id",
        *[F.expr(f"CAST({n[k]} AS BIGINT)").alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.expr(f"sha2({_joined(f'filter(found_, x -> x.kind IN ({base}))')}, 256)").alias("base_sha256"),
        F.expr(_joined("found_")).alias("spans"),
    )


LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF)
    leaf = merkle.digest([F.col(c) for c in LEAF])
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = F.when(tampered, merkle.digest([more if c == "n_chars" else F.col(c) for c in LEAF]))
    manifest = merkle.build(docs, F.col("lang"), [F.col("doc_id")], leaf, [F.col("doc_id"), claimed.alias("claimed")])
    rows = manifest.rows.withColumn("folded_root", merkle.fold(F.coalesce("claimed", "leaf"), F.col("path")))
    root = F.lit(manifest.root).cast("string")
    return rows.select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == root).alias("verified"),
    )


def damaged_conversations(conversations_: DataFrame) -> DataFrame:
    """The rows with the faults that the query plants, by the checksum of ``conv_id:turn``."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat_ws(":", text["conv_id"], text["turn"]).cast("binary")) % 20
    rows = conversations_.select("conv_id", "turn", text["role"].alias("role"), text["text"].alias("text"), kind.alias("kind_"))
    return rows.where("kind_ <> 0").withColumn("n_", F.expr("explode(CASE WHEN kind_ = 3 THEN array(1, 2) ELSE array(1) END)")).selectExpr(
        "conv_id", "turn", "CASE WHEN kind_ = 4 THEN 'user' ELSE role END AS role",
        "CASE WHEN kind_ = 1 THEN '' WHEN kind_ = 2 THEN translate(text, '.!?', '') ELSE text END AS text",
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged_conversations(original)
    audited = conversations.audits(rows)
    found = audited.join(conversations.digests(rows, audited), "k_")
    ids = original.select("conv_id").distinct().withColumn("k_", merkle.encoded([F.col("conv_id")]))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, "k_", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13_maxent_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = maxent_lm.train(docs, ~held)
    scored = maxent_lm.score(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])
    return scored.select(
        "doc_id", "held_out", F.col("n_tokens_").alias("n_tokens"), F.col("n_known_").alias("n_known"),
        F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"),
        F.col("base_score_").alias("base_score"), F.col("score_").alias("score"),
    )


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"


QUERIES = {
    "op1_vector_packing": op1_vector_packing,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_join": op3_ngram_join,
    "op4_line_frequency": op4_line_frequency,
    "op5_ordinal_quality": op5_ordinal_quality,
    "op6_token_files": op6_token_files,
    "op7_url_filter": op7_url_filter,
    "op8_fm_decontamination": op8_fm_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_secret_ledger": op10_secret_ledger,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_maxent_scoring": op13_maxent_scoring,
}
