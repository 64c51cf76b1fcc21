import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from railtrace.llm import conversations as C
from railtrace.llm.queries import damaged_conversations, op12_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def brute_force(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) by trying every edit; rows in order."""
    seen, faults, turns = set(), [], [t for t, _, _ in rows if t is not None]
    for _, role, text in rows:
        last = text.strip(" \t\n\r\x0b\x0c")[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(not a[1] or not b[1] or a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = None
    slots = ["", "I", "II"]
    for edits in itertools.product(*[["D"] if f in ("blank", "duplicate") else ["D", "K", "R"] for f in faults]):
        for inserts in itertools.product(slots, repeat=len(rows) + 1):
            out, cost, legal = [], 0, True
            for (_, role, text), fault, edit, more in zip(rows + [(0, "", "")], faults + [""], [*edits, "end"], inserts):
                for _ in more:
                    out.append(("assistant" if out and out[-1][0][:1] == "u" else "user", ""))
                    cost += 2
                if edit == "D":
                    cost += 3
                elif edit != "end":
                    cost += (fault == "truncated") + 2 * (edit == "R")
                    legal &= edit == "R" or bool(role)
                    out.append((role if edit == "K" else "assistant" if out and out[-1][0][:1] == "u" else "user", text))
            if legal and PATTERN.fullmatch("".join(r[:1] for r, _ in out)):
                audit = "".join(m + e for m, e in zip(inserts, [*edits, ""]))
                if best is None or (cost, audit) < best[:2]:
                    best = cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    n = {k: faults.count(k) for k in ("blank", "duplicate", "truncated")}
    return gaps, n["blank"], n["duplicate"], n["truncated"], illegal, *best


def random_conversations(n, seed, longest=5):
    rng = random.Random(seed)
    texts = ["Fine.", "Cut", "", " \t\n", "Really?! ", "Well", "a.", "b!"]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "umpire", "", "User"]
    rows = []
    for c in range(n):
        turn = 0
        for _ in range(rng.randrange(1, longest + 1)):
            turn += rng.choice([0, 1, 1, 1, 3])
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(roles), rng.choice(texts)))
    return rows


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))


def found(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    audited = C.audits(df)
    both = audited.join(C.digests(df, audited), "k_").collect()
    return {r.k_: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.sha256) for r in both}


def expected(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault("-" if conv is None else f"{len(str(conv))}:{conv}", []).append(tuple(row))
    out = {}
    for key, members in groups.items():
        *rest, text = brute_force(in_order(members))
        out[key] = (*rest, hashlib.sha256(text.encode()).hexdigest())
    return out


@pytest.mark.parametrize("segment", [4096, 2, 1])
def test_audits_equal_brute_force(spark, segment):
    rows = random_conversations(150, 5)
    if segment == 4096:
        got = found(spark, rows)
    else:
        got = {}
        for key, want in expected(rows).items():  # the chain of short segments, without Spark
            members = in_order([tuple(r[1:]) for r in rows if f"{len(str(r[0]))}:{r[0]}" == key])
            got[key] = (*chained(members, segment), want[-1])
    assert got == expected(rows)


def chained(members, size):
    seen, chain = set(), C.Chain()
    for at in range(0, len(members), size):
        segment = C.Segment(C.STATES)
        for turn, role, text in members[at:at + size]:
            last = text.strip(" \t\n\r\x0b\x0c")[-1:]
            segment.add(turn, role[:1], not last, last not in (".", "!", "?"), (role, text) not in seen, 1)
            seen.add((role, text))
        names = ["rows_", "low_", "high_", "turns_", "first_", "last_", "blank_", "duplicate_", "truncated_", "illegal_", "head_", "tail_"]
        chain.add({k: getattr(segment, k[:-1]) for k in names} | {"ways_": segment.ways()})
    return chain.result("k")[2:]


def test_a_conversation_over_many_tasks_and_segments(spark, monkeypatch):
    """One conversation of a third of all rows gives the same however it is dealt."""
    rng = random.Random(2)
    hot = [(7, i // 2 if i % 50 else None, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No", ""]) + f" {i}." * (i % 3)) for i in range(3000)]
    rows = hot + [(100 + i // 3, i % 3, "user" if i % 3 else "system", f"t{i}.") for i in range(6000)]
    got = found(spark, rows, 4)
    members = in_order([r[1:] for r in hot])
    walk, seen = C.Segment([C.START]), set()
    for turn, role, text in members:
        last = text.strip()[-1:]
        walk.add(turn, role[:1], not last, last not in (".", "!", "?"), (role, text) not in seen, 1)
        seen.add((role, text))
    best = min((w["cost"], w["audit"]) for w in one_more(walk) if w["exit"] in (C.START, C.ASSISTANT))
    assert got["1:7"][5:7] == best
    df = spark.createDataFrame(rows, SCHEMA)
    parts = C.with_order(df, *df.columns).repartitionByRange(4, *C._ordered()).where("k_ = '1:7'")
    assert parts.select(F.spark_partition_id()).distinct().count() > 1
    assert len(got) == 2001


def one_more(walk):
    """A segment's ways with rows inserted at its end."""
    for w in walk.walks.values():
        w.insert()
    return walk.ways()


def test_equal_rows_of_a_turn_are_counted(spark):
    rows = [(1, 0, "user", "Hi.")] * 5000 + [(1, 1, "assistant", "Yes.")]
    got = found(spark, rows)["1:1"]
    assert got[:7] == (0, 0, 4999, 0, 4999, 3 * 4999, "K" + "D" * 4999 + "K")


def test_strings_are_compared_at_their_longest_common_prefix(monkeypatch):
    rng = random.Random(4)
    for base in (C._BASE, 0):  # a base of 0 makes every hash collide that ends alike
        monkeypatch.setattr(C, "_BASE", base)
        edits, nodes = C.Edits(), [0]
        for _ in range(400):
            nodes.append(edits.add(rng.choice(nodes[-20:]), rng.choice("DIKR")))
        for _ in range(3000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert edits.less(a, b) == (edits.text(a) < edits.text(b))


def test_repaired_rows_are_what_the_digest_covers(spark):
    rows = random_conversations(60, 9) + [(None, None, None, None), (None, 3, "user", "x" * 200_000), (5_000, 1, "system", "only.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    audited = C.audits(df)
    texts = {}
    for r in sorted(C.repaired(df, audited).collect(), key=lambda r: (r.k_, r.position)):
        texts.setdefault(r.k_, []).append(f"{r.role}:{r.text}")
        assert r.position == len(texts[r.k_]) - 1
    for r in C.digests(df, audited).collect():
        assert r.sha256 == hashlib.sha256("\n".join(texts.get(r.k_, [])).encode()).hexdigest()


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(*r, 1) for r in random_conversations(40, 1)] + [(None, None, None, None, None), (None, 1, "user", None, 2), (77, None, None, "x", 3)]
    df = spark.createDataFrame(rows, SCHEMA + ", k_ int")
    df.write.parquet(f"{tmp_path}/a/conversations.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert op12_conversation_repair(spark, f"{tmp_path}/b").count() == 0
    got = {r.conv_id: tuple(r)[1:] for r in op12_conversation_repair(spark, f"{tmp_path}/a").collect()}
    damaged = [tuple(r) for r in damaged_conversations(df).collect()]
    want = expected(damaged)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get("-" if c is None else f"{len(str(c))}:{c}", empty) for c in {r[0] for r in rows}}
