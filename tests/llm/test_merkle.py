import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from railtrace.llm import merkle
from railtrace.llm.queries import LEAF, QUERIES, op11_merkle_manifest


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def climb(nodes, fanout):
    """The root of a list of digests, and each one's path of (left, right) siblings."""
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + fanout, len(nodes))) for a in range(0, len(nodes), fanout)]
        for run in runs:
            for j in run:
                for m in members[j]:
                    paths[m].append(("".join(nodes[run[0]:j]), "".join(nodes[j + 1:run[-1] + 1])))
        nodes, members = [H("".join(nodes[j] for j in r)) for r in runs], [sum((members[j] for j in r), []) for r in runs]
    return nodes[0], paths


def brute_force(rows, fanout):
    """(root, sorted (key, group, leaf, subroot, path)) of (key, group, leaf) rows."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    trees = [climb([r[2] for r in groups[g]], fanout) for g in order]
    if not trees:
        return None, []
    root, tops = climb([t[0] for t in trees], fanout)
    return root, sorted(
        (repr((*row, subroot, path + top)) for g, (subroot, paths), top in zip(order, trees, tops) for row, path in zip(groups[g], paths))
    )


@pytest.mark.parametrize("n, fanout, steps, groups", [
    (0, 2, 3, ["a"]), (1, 2, 3, ["a"]), (2, 2, 10, [None]), (9, 2, 2, ["a", "b", ""]), (100, 2, 3, ["a", None, "", "é", "zz"]),
    (90, 3, 2, ["a", None, "b"]), (65, 4, 1, ["x"]), (40, 2, 10, [str(i) for i in range(30)]),
])
def test_manifest_equals_brute_force(spark, n, fanout, steps, groups):
    rows = [(None if i % 9 == 8 else i // 2 * 5 % 37, groups[i * 7 % len(groups)]) for i in range(n)]
    rows = [(k, g, H(encoded([k, g, i % 3]))) for i, (k, g) in enumerate(rows)]
    rows += rows[:n // 3]  # repeated rows are leaves of their own
    df = spark.createDataFrame(rows, "k long, g string, leaf string").repartition(3)
    got = merkle.build(df, F.col("g"), [F.col("k")], F.col("leaf"), [F.col("k"), F.col("g")], fanout, steps)
    found = [(r.k, r.g, r.leaf, r.subroot, [(x.l, x.r) for x in r.path]) for r in got.rows.collect()]
    root, expected = brute_force(rows, fanout)
    assert got.root == root and sorted(map(repr, found)) == expected
    sizes = {r.group: r.leaves for r in got.subroots.collect()}
    assert sizes == {g: sum(r[1] == g for r in rows) for g in {r[1] for r in rows}}


def test_one_row_repeated_is_dealt_over_tasks(spark):
    df = spark.range(4000).select(F.lit(7).alias("k"), F.lit("hot").alias("g"), F.lit(H("x")).alias("leaf"))
    got = merkle._placed(df.select(F.col("g").alias("group_"), F.col("leaf").alias("node_"), "k"), ["k"], ["k"], "t")
    assert sorted(r.slot_ for r in got.collect()) == list(range(4000))
    keys = [F.col(c) for c in ("g", "k", "leaf", "salt_")]
    dealt = df.withColumn("salt_", F.monotonically_increasing_id()).repartitionByRange(4, *keys)
    assert max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()) < 2500


def test_query_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    for docs, name in ((odd_docs, "odd"), (no_docs, "none")):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    assert op11_merkle_manifest(spark, f"{tmp_path}/none").count() == 0
    rows = [tuple(r) for r in odd_docs.select(*LEAF).collect()]
    leaves = [(r[0], r[2], H(encoded(r))) for r in rows]
    root, expected = brute_force(leaves, 2)
    got = op11_merkle_manifest(spark, f"{tmp_path}/odd").collect()
    assert len(got) == len(rows) and {r.root for r in got} == {root}
    by_leaf = {leaf: (key, subroot, path) for key, _, leaf, subroot, path in map(eval, expected)}
    original = {H(encoded(r)): r for r in rows}
    for r in got:
        key, subroot, path = by_leaf[r.leaf]
        assert r.doc_id == key and r.subroot == subroot
        source = original[r.leaf]
        tampered = key is not None and zlib.crc32(str(key).encode()) % 7 == 0 and source[3] is not None
        assert r.verified == (not tampered) == (r.folded_root == root)


def test_nothing_verifies_after_a_change_of_any_field(spark):
    docs = spark.createDataFrame([(i, "s", "l" * (i % 2), i, f"t{i}") for i in range(9)], "doc_id long, source string, lang string, n_chars long, text string")
    manifest = merkle.build(docs, F.col("lang"), [F.col("doc_id")], merkle.digest([F.col(c) for c in LEAF]), [F.col(c) for c in LEAF])
    for changed in LEAF:
        value = {"doc_id": F.lit(99), "n_chars": F.lit(None)}.get(changed, F.lit("x"))
        leaf = merkle.digest([value if c == changed else F.col(c) for c in LEAF])
        assert manifest.rows.where(merkle.fold(leaf, F.col("path")) == manifest.root).count() == 0
    assert manifest.rows.where(merkle.fold(F.col("leaf"), F.col("path")) != manifest.root).count() == 0
    assert "op11_merkle_manifest" in QUERIES
