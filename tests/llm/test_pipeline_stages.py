import corpus_pipeline
from pyspark.sql import functions as F

from railtrace.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    from tests.llm.test_fm_index import brute_force as contaminated
    from tests.llm.test_ngram_join import brute_force as near

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"
    ]
    docs = table(spark, SF, "documents")
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SF), name)
        if name != "packing":
            assert out.schema == docs.schema
            assert out.join(docs, "doc_id", "left_anti").count() == 0
            assert out.where("n_chars <> length(text)").count() == 0
        before = {r.doc_id: r.text for r in docs.collect()}
        if name == "ngram_jaccard_join":
            classes = near(list(before.items()))
            assert {r.doc_id for r in out.collect()} == {c for _, _, c, _ in classes}
        if name == "benchmark_decontamination":
            after = {r.doc_id: r.text for r in out.collect()}
            for key, text in before.items():
                n, hit, _ = contaminated(text, items)
                if not hit:
                    assert after[key] == text
                elif key in after:
                    assert len(after[key]) < len(text)
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == set(before)
        docs = out


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_odd_documents_through_the_filters(spark, odd_docs, no_docs):
    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination"):
        out = stages[name](spark, odd_docs, SF)
        assert out.columns == odd_docs.columns
        n = out.groupBy(F.coalesce(F.col("doc_id"), F.lit(-1)).alias("k")).count().collect()
        if name == "ngram_jaccard_join":
            assert {r.k: r["count"] for r in n} == {1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 7: 1, 9: 1, 11: 1, -1: 2}
        assert stages[name](spark, no_docs, SF).count() == 0
    assert stages["packing"](spark, no_docs, SF).count() == 0


CLASHES = ["kept_id_", "score_", "predicted_", "n_lines_", "n_dropped_", "n_words_", "spans_", "items_", "component_id", "extra 5", "a.b"]


def test_extra_columns_keep_their_values_through_all_stages(spark, odd_docs):
    """Whatever the names of extra columns, the rows are those of a table without them, and the values stay."""
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    packed = plain.toDF(*plain.columns).selectExpr("*", *[f"concat(coalesce(doc_id, -1), ' {c}') AS c{i}" for i, c in enumerate(CLASHES)])
    packed = packed.toDF(*plain.columns, *CLASHES)
    for name, stage in corpus_pipeline.STAGES:
        a, b = (corpus_pipeline.written(stage(spark, d, SF), name) for d in (plain, packed))
        n = len(a.columns)
        if name == "packing":
            drop = lambda rows: sorted(repr((r.doc_id, r.start, r.doc_tokens)) for r in rows if r.start == 0)
            assert drop(a.collect()) == drop(b.collect()) and a.columns == b.columns
        else:
            rows = b.collect()
            assert b.columns == packed.columns
            assert sorted(repr(tuple(r)[:n]) for r in rows) == sorted(repr(tuple(r)) for r in a.collect())
            assert all(tuple(r)[n:] == tuple(f"{-1 if r[0] is None else r[0]} {c}" for c in CLASHES) for r in rows)
        plain, packed = a, b


def test_odd_documents_are_packed_whole(spark, odd_docs):
    """Null, empty and very long texts, repeated rows and null ids: every id of every row lies in one piece."""
    out = corpus_pipeline.pack(spark, odd_docs, SF).collect()
    docs = odd_docs.collect()
    assert sum(r.length for r in out) == sum(r.doc_tokens for r in out if r.start == 0)
    assert sum(r.start == 0 for r in out) == len(docs) and all(r.length <= 4096 for r in out)


def line_dedup_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(3)
    return {r.doc_id: r.text for r in corpus_pipeline.drop_boilerplate_lines(spark, docs, SF).collect()}


def test_copies_of_a_host_are_left_for_the_join(spark):
    """A group of copies that holds a third of a host, and a pair on a host of 20 pages."""
    passage = "one copied page\nwith a second line"
    rows = [(i, passage + " \n" * (i % 2), "a") for i in range(30)]  # blanks at the ends make no other page
    rows += [(100 + i, f"Menu\nown line {i}", "a") for i in range(60)]
    rows += [(200 + i, passage if i < 2 else f"page {i}", "b") for i in range(20)]
    got = line_dedup_of(spark, rows)
    assert set(got) == {r[0] for r in rows}
    assert all(got[i] == text for i, text, _ in rows if i < 100 or i >= 200)
    assert all(got[100 + i] == f"own line {i}" for i in range(60))  # boilerplate goes


def test_small_hosts_lose_boilerplate_too(spark):
    rows = [(100 * n + i, f"Menu\npage {i}", f"host {n}") for n in (2, 3, 19, 20) for i in range(n)]
    got = line_dedup_of(spark, rows)
    assert got == {key: text if host == "host 2" else text.removeprefix("Menu\n") for key, text, host in rows}


def test_a_repeated_passage_stays_on_one_page(spark):
    long, short = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("p", 50), ("s", 49)))
    rows = [(i, f"page {i}" + f"\n{long}\n{short}" * (i in (7, 50, 90)) + f"\n{long}x" * (i in (8, 9)), "a") for i in range(100)]
    rows += [(200 + i, long, "b") for i in range(5)]  # copies are for stage 3
    got = line_dedup_of(spark, rows)
    assert got == {key: text.replace(f"\n{long}\n", "\n") if key in (50, 90) else text for key, text, _ in rows}
