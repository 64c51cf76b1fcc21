import itertools
import re
import time
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railtrace.llm import ngram_join
from railtrace.llm.components import components
from railtrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """(n_shingles, component, links) of each row, by comparing all pairs."""
    sets = [(k, shingle_set(t)) for k, t in rows]
    near = defaultdict(set)
    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(sets), 2):
        both = len(a & b)
        if both and 100 * both >= 80 * len(a | b):
            near[i].add(j)
            near[j].add(i)
    out = []
    for i, (key, found) in enumerate(sets):
        reached, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - reached:
                reached.add(j)
                todo.append(j)
        out.append((key, len(found), min(sets[j][0] for j in reached), len(near[i])))
    return sorted(out)


def found_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_op3_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found_rows(QUERIES["op3_ngram_join"](spark, SF)) == brute_force(rows)


def test_chains_copies_and_units(spark, monkeypatch):
    """A chain of near copies, exact copies and a passage that many share, dealt into several units."""
    rng = np.random.default_rng(3)
    word = lambda: f"w{rng.integers(1, 10**9)}"
    base = [word() for _ in range(60)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(base)))
        base = list(base)
        base[rng.integers(0, 60)] = word()
    rows += [(100 + i, rows[5][1].upper()) for i in range(7)]
    passage = [word() for _ in range(12)]
    rows += [(200 + i, " ".join([word() for _ in range(40)] + passage)) for i in range(30)]
    rows += [(300 + i, "the same few") for i in range(3)]
    monkeypatch.setattr(ngram_join, "CHUNK", 5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found_rows(ngram_join.similar_documents(df)) == brute_force(rows)


def test_odd_documents(odd_docs, no_docs):
    found = [tuple(r) for r in ngram_join.similar_documents(odd_docs).collect()]
    by_id = defaultdict(list)
    for key, n, component, links in found:
        by_id[key].append((n, component, links))
    assert by_id[1] == [(8, 1, 1)] and by_id[5] == [(8, 1, 1)]  # rows without an id link with nothing
    assert by_id[2] == [(0, 2, 0)] and by_id[3] == [(0, 3, 0)] and by_id[4] == [(0, 4, 0)]
    assert by_id[6] == [(1, 6, 1)] and by_id[8] == [(1, 6, 1)] and by_id[7] == [(1, 7, 0)]
    assert by_id[9][0][1:] == (9, 1) and by_id[10][0][1:] == (9, 1)
    assert [x[1:] for x in by_id[11]] == [(11, 1), (11, 1)]
    assert sorted(by_id[None]) == [(0, None, 0), (8, None, 0)]
    assert ngram_join.similar_documents(no_docs).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1), min_size=1, max_size=14), st.sampled_from([50, 80, 100]))
def test_trie_join_equals_all_pairs(sets, percent):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    everything = np.arange(len(sets))
    found = {(i, int(j)) for i, js in ngram_join.trie_join(arrays, everything, everything, percent) for j in js if i != j}
    assert found == {
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
        if i != j and 100 * len(a & b) >= percent * len(a | b)
    }


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1, max_size=40), st.integers(0, 8), st.integers(0, 8), st.randoms())
def test_similar_sets_share_enough_first_shingles(common, a, b, random):
    x, y = sorted(common | set(range(100, 100 + a))), sorted(common | set(range(200, 200 + b)))
    if 100 * len(common) < 80 * (len(common) + a + b):
        return
    order = list(range(300))
    random.shuffle(order)
    rank = {t: i for i, t in enumerate(order)}
    sent = lambda s: set(sorted(s, key=rank.get)[:ngram_join.prefix_length(len(s), 80) - 1 + int(ngram_join.must_share(len(s), 80))])
    smaller = -(-80 * max(len(x), len(y)) // 100)
    assert len(sent(x) & sent(y)) >= int(ngram_join.must_share(smaller, 80))


@pytest.mark.parametrize("n", [0, 1, 40])
def test_components_of_a_path(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {i: 0 for i in range(n + 1) if n} | {100: 100, 101: 100}


def families(n, members, common):
    """Texts of n families of near copies; one passage of a few words is in texts of neighbouring families."""
    rng = np.random.default_rng(8)
    word = lambda: f"w{rng.integers(1, 10**9)}"
    rows, passage = [], [word() for _ in range(common)]
    for i in range(n):
        text, last, passage = [word() for _ in range(80)], passage, [word() for _ in range(common)]
        for j in range(members):
            own = list(text)
            own[rng.integers(0, 80)] = word()
            rows.append((100 * i + j, " ".join(own[:30] + last + own[30:] + passage)))
    return rows


def test_chance_ties_no_families(spark, monkeypatch):
    """Families that share a shingle or two are components of their own before any texts meet."""
    tied, found = [], ngram_join.components
    monkeypatch.setattr(ngram_join, "components", lambda edges: tied.append(found(edges)) or tied[-1])
    rows = families(12, 3, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found_rows(ngram_join.similar_documents(df)) == brute_force(rows)
    assert {r.node // 100 for r in tied[0].collect()} == set(range(12))
    assert all(r.node // 100 == r.component // 100 for r in tied[0].collect())


@pytest.mark.parametrize("rare, marks", [(1, 8), (2, 1 << 26), (4, 1 << 15)])
def test_frequent_shingles_and_rounds(spark, monkeypatch, rare, marks):
    """Families larger than the pairs that are counted, units in several rounds, a filter that lets other texts by."""
    for name, value in (("RARE", rare), ("MARKS", marks), ("CHUNK", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = families(4, 7, 12) + [(1000 + i, f"alone {i} of " + " ".join(f"x{i}y{j}" for j in range(20))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found_rows(ngram_join.similar_documents(df)) == brute_force(rows)


def test_must_share_in_sql(spark):
    for percent in (50, 80, 100):
        sql = ngram_join.must_share_sql("id", percent)
        found = spark.range(1, 3000).selectExpr("id", f"{sql} AS m").collect()
        assert [r.m for r in found] == ngram_join.must_share(np.array([r.id for r in found]), percent).tolist()


def test_files_go_when_they_are_done_with(spark, tmp_path, monkeypatch):
    """Neither shuffle files nor the tables of steps wait for the driver's garbage collection."""
    def shuffles():
        return {b.toString() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()) if b.isShuffle()}

    monkeypatch.setattr("railtrace.llm.common.ensure_checkpoint_dir", lambda _: str(tmp_path))
    before = shuffles()
    df = spark.createDataFrame(families(4, 7, 12), "doc_id long, text string").repartition(3)
    ngram_join.similar_documents(df)
    labels = [re.sub("llm-|-[0-9a-f]{32}", "", p.name) for p in tmp_path.iterdir()]
    assert sorted(labels) == ["representatives", "set-marks", "stars", "stars", "unit-classes"]
    for _ in range(100):
        # what the driver's few aggregates of a row or so leave is no matter
        if len(left := {b.split("_")[1] for b in shuffles() - before}) <= 12:
            break
        time.sleep(0.1)
    assert len(left) <= 12
