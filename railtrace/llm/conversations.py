"""Conversation structure repair by a persistent audit DP (operator 12).

The rows of a conversation, in order, are edited so that the initials of their roles spell
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3, the only edit of blank
and duplicate rows), Insert of an empty user or assistant text anywhere (2); a truncated row
that stays adds 1.  The cheapest edits win, ties the ASCII-least string of their initials.

The DP walks the rows with one best string of edits for each state of that pattern.  Strings
are linked nodes that share their prefixes; a node knows its ancestors at distances of
powers of two and a rolling hash of its whole string, so two strings are compared at their
longest common prefix, found by lifting both while their hashes differ; equal hashes are
confirmed letter by letter up to the node that both share.  Two strings of one
cost and state after the same rows are never prefixes of each other (letters say the cost), so the
least one stays least whatever follows.

Only thin rows (no texts) meet the DP, ordered by a range partitioning, so a long conversation is
dealt over many tasks.  A task cuts it into segments of at most ``SEGMENT`` rows; a
segment that does not begin its conversation gives the best edits from every state to every
state, and segments are chained, in order, in a stream.  Equal rows of one turn are counted, not
repeated.  Texts are shuffled once, for ``repaired`` and ``digests``, where each
conversation's rows pass as a sorted stream; a SHA-256 of one conversation is sequential by
nature, but nothing of it is held except its string of edits.

Defined cases: null roles and texts are one space; rows are ordered by turn (nulls first),
role and MD5 of the text; rows of a null conversation are one conversation; the initial of an empty
role fits nowhere; a turn's repeated rows are duplicates after the first; a conversation without rows has
no entry; other columns are left alone and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import q, written
from railtrace.llm.merkle import encoded

SEGMENT = 4096  # rows whose nodes are held at once
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired rows so far end with
STATES = range(4)
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
_NEXT = {  # state -> state, by the initial of the next repaired row
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
_PUT = {**_NEXT["u"], **_NEXT["a"]}  # the row that fits after each state: user, but assistant after user
_MOD, _BASE = (1 << 61) - 1, 1_000_003
BLANKS = r" \t\n\x0b\x0c\r"

SEGMENT_SCHEMA = (
    "k_ string, part_ int, at_ long, rows_ long, low_ long, high_ long, turns_ long, first_ long, last_ long, blank_ long, "
    "duplicate_ long, truncated_ long, illegal_ long, head_ string, tail_ string, "
    "ways_ array<struct<entry:int,exit:int,cost:long,audit:string>>"
)
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
_WAYS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
AUDIT_SCHEMA = "k_ string, rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class Edits:
    """Strings of edits as linked nodes; node 0 is the empty string."""

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [()]

    def add(self, parent: int, letter: str) -> int:
        ups, jump = [parent], 0
        while jump < len(self.up[ups[-1]]):  # the ancestor at distance 2 ** (jump + 1)
            ups.append(self.up[ups[-1]][jump])
            jump += 1
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % _MOD)
        self.up.append(tuple(ups))
        return len(self.up) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while (far := self.depth[node] - depth) > 0:
            node = self.up[node][far.bit_length() - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the string of a comes before that of b."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] != self.hash[y]:
            for jump in reversed(range(max(len(self.up[x]), len(self.up[y])))):
                if jump < len(self.up[x]) and self.hash[self.up[x][jump]] != self.hash[self.up[y][jump]]:
                    x, y = self.up[x][jump], self.up[y][jump]
            # the parents' strings are equal by their hashes; confirm it
            if self._equal(self.up[x][0], self.up[y][0]) and self.letter[x] != self.letter[y]:
                return self.letter[x] < self.letter[y]
        elif self._equal(x, y):
            return self.depth[a] < self.depth[b]
        return self.text(a) < self.text(b)  # a collision: compare whole strings

    def _equal(self, x: int, y: int) -> bool:
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class Walk:
    """Best edits from one entry state to each state: ``best[state]`` is (cost, node) or None."""

    def __init__(self, entry: int):
        self.edits = Edits()
        self.best: list[tuple[int, int] | None] = [None] * 4
        self.best[entry] = (0, 0)

    def _offer(self, best, state, cost, parent, letter):
        """Put ``parent`` plus a letter at a state, if it is better than what stands there."""
        held = best[state]
        if held is not None and held[0] < cost:
            return
        node = self.edits.add(parent, letter)
        if held is None or cost < held[0] or self.edits.less(node, held[1]):
            best[state] = (cost, node)

    def insert(self) -> None:
        """Rows inserted here: a user row where one fits, then an assistant row."""
        best = list(self.best)
        for state, to in _NEXT["u"].items():
            if self.best[state] is not None:
                cost, node = self.best[state]
                self._offer(best, to, cost + INSERT_COST, node, "I")
        if best[USER] is not None:
            self._offer(best, ASSISTANT, best[USER][0] + INSERT_COST, best[USER][1], "I")
        self.best = best

    def row(self, initial: str, doomed: bool, truncated: bool) -> None:
        self.insert()
        best: list[tuple[int, int] | None] = [None] * 4
        extra = TRUNCATED_COST if truncated else 0
        keeps = _NEXT.get(initial, {})
        for state in STATES:
            if self.best[state] is None:
                continue
            cost, node = self.best[state]
            self._offer(best, state, cost + DELETE_COST, node, "D")
            if not doomed:
                if state in keeps:
                    self._offer(best, keeps[state], cost + KEEP_COST + extra, node, "K")
                self._offer(best, _PUT[state], cost + REROLE_COST + extra, node, "R")
        self.best = best


class Segment:
    """Consecutive rows of one conversation: their counts, and their best edits by entry state."""

    def __init__(self, entries):
        self.rows = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.first = self.last = self.head = self.tail = None
        self.walks = {e: Walk(e) for e in entries}

    def add(self, turn, initial, blank, truncated, fresh, copies) -> None:
        if turn is not None and (self.rows == 0 or turn != self.last):
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.rows == 0:
            self.first, self.head = turn, initial
        else:
            self.illegal += _illegal(self.tail, initial)
        self.illegal += (copies - 1) * _illegal(initial, initial)
        self.rows += copies
        self.last, self.tail = turn, initial
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - fresh
            self.truncated += int(fresh and truncated)
        for walk in self.walks.values():
            for i in range(copies):
                walk.row(initial, blank or not fresh or i > 0, truncated)

    def ways(self):
        return [
            {"entry": e, "exit": s, "cost": w.best[s][0], "audit": w.edits.text(w.best[s][1])}
            for e, w in self.walks.items() for s in STATES if w.best[s] is not None
        ]


def _illegal(a: str, b: str) -> int:
    return a + b not in ("su", "ua", "au") or not a or not b


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted thin rows of one partition as segments."""
    from pyspark import TaskContext

    part, at, key, segment, out = TaskContext.get().partitionId(), 0, None, None, []

    def close():
        out.append((
            key, part, at, segment.rows, segment.low, segment.high, segment.turns, segment.first, segment.last, segment.blank,
            segment.duplicate, segment.truncated, segment.illegal, segment.head, segment.tail, segment.ways(),
        ))

    for batch in batches:
        for k, turn, initial, blank, truncated, fresh, copies in zip(*(c.to_pylist() for c in batch.columns)):
            while copies:
                if k != key or segment.rows >= SEGMENT:
                    if segment is not None:
                        close()
                    # the partition's first conversation may have begun in another one
                    begins = key is not None and k != key
                    key, segment, at = k, Segment([START] if begins else STATES), at + 1
                taken = min(copies, SEGMENT - segment.rows)
                segment.add(turn, initial, blank, truncated, fresh, taken)
                fresh, copies = False, copies - taken
        if len(out) >= 256:
            yield _batch(out, SEGMENT_SCHEMA)
            out.clear()
    if segment is not None:
        close()
    if out:
        yield _batch(out, SEGMENT_SCHEMA)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    """Rows as a batch of a schema of longs, ints and strings, and of ``ways_``."""
    names, types = zip(*(f.split(" ", 1) for f in ddl.split(", ")))
    kinds = [_ARROW.get(t, _WAYS) for t in types]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))


class Chain:
    """The segments of one conversation, joined in order.

    ``best[state]`` is (cost, rope); a rope is (rope before, string of a segment, length in strings).
    """

    def __init__(self):
        self.best = [None] * 4
        self.best[START] = (0, None)
        self.sums = [0] * 6
        self.low = self.high = self.last = self.tail = None

    def add(self, s: dict) -> None:
        joined = self.sums[0] and _illegal(self.tail, s["head_"])
        same = self.sums[0] and s["first_"] is not None and s["first_"] == self.last
        more = [s["rows_"], s["turns_"] - bool(same), s["blank_"], s["duplicate_"], s["truncated_"], s["illegal_"] + joined]
        self.sums = [a + b for a, b in zip(self.sums, more)]
        self.low = s["low_"] if self.low is None else self.low
        self.high = s["high_"] if s["high_"] is not None else self.high
        self.last, self.tail = s["last_"], s["tail_"]
        self._extend((w["entry"], w["exit"], w["cost"], w["audit"]) for w in s["ways_"])

    def _extend(self, ways) -> None:
        best = [None] * 4
        for entry, to, cost, audit in ways:
            if self.best[entry] is None:
                continue
            cost += self.best[entry][0]
            rope = (self.best[entry][1], audit, _length(self.best[entry][1]) + 1)
            held = best[to]
            if held is None or cost < held[0] or cost == held[0] and _rope_less(rope, held[1]):
                best[to] = (cost, rope)
        self.best = best

    def result(self, key) -> tuple:
        end = [(s, s, 0, "") for s in STATES]
        end += [(s, USER, INSERT_COST, "I") for s in _NEXT["u"]] + [(USER, ASSISTANT, INSERT_COST, "I")]
        end += [(s, ASSISTANT, 2 * INSERT_COST, "II") for s in _NEXT["u"]]
        self._extend(end)
        legal = [b for b in (self.best[START], self.best[ASSISTANT]) if b is not None]
        won = legal[0]
        for other in legal[1:]:
            if other[0] < won[0] or other[0] == won[0] and _rope_less(other[1], won[1]):
                won = other
        rows, turns, blank, duplicate, truncated, illegal = self.sums
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - turns, (1 << 63) - 1)
        return key, rows, gaps, blank, duplicate, truncated, illegal, won[0], "".join(_strings(won[1], None))


def _length(rope) -> int:
    return rope[2] if rope else 0


def _strings(rope, until) -> list[str]:
    out = []
    while rope is not until:
        out.append(rope[1])
        rope = rope[0]
    return out[::-1]


def _rope_less(a, b) -> bool:
    """Compares two ropes from the rope that both go on from."""
    x, y = a, b
    while x is not y:
        if _length(x) >= _length(y):
            x = x[0]
        else:
            y = y[0]
    return "".join(_strings(a, x)) < "".join(_strings(b, x))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in b.to_pylist())
    out = []
    for key, segments in groupby(rows, key=lambda r: r["k_"]):
        chain = Chain()
        for s in segments:
            chain.add(s)
        out.append(chain.result(key))
        if len(out) >= 1024:
            yield _batch(out, AUDIT_SCHEMA)
            out.clear()
    if out:
        yield _batch(out, AUDIT_SCHEMA)


def with_order(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``k_`` (the conversation), ``turn_``, ``role_``, ``text_`` and ``md5_`` of each row."""
    return rows.select(
        encoded([F.col(q(conv))]).alias("k_"), F.col(q(turn)).cast("long").alias("turn_"),
        F.coalesce(F.col(q(role)), F.lit(" ")).alias("role_"), F.coalesce(F.col(q(text)), F.lit(" ")).alias("text_"),
    ).withColumn("md5_", F.md5(F.col("text_").cast("binary")))


ORDER = ["turn_", "role_", "md5_"]


def _ordered(*more: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("k_", *more, *ORDER)]


def audits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``k_`` (its encoded id), rows, gaps, faults, cost and audit; written."""
    thin = with_order(rows, conv, turn, role, text).selectExpr(
        "k_", *ORDER, r"NOT text_ RLIKE '[^\\x20\\x09-\\x0D]' AS blank_",
        rf"NOT right(trim(TRAILING '{BLANKS}' FROM text_), 1) RLIKE '[.!?]' AS cut_",
    ).groupBy("k_", *ORDER, "blank_", "cut_").agg(F.count("*").alias("copies_"))
    first = thin.groupBy("k_", "role_", "md5_").agg(F.min(F.struct("turn_")).alias("first_"), F.count("*").alias("n_")).where("n_ > 1").drop("n_")
    thin = thin.join(first, ["k_", "role_", "md5_"], "left").withColumn("fresh_", F.expr("first_ IS NULL OR turn_ <=> first_.turn_"))
    thin = thin.repartitionByRange(*_ordered()).sortWithinPartitions(*_ordered())
    segments = thin.selectExpr(
        "k_", "turn_", "left(role_, 1) AS initial_", "blank_", "cut_", "fresh_", "copies_"
    ).mapInArrow(_segments, SEGMENT_SCHEMA)
    segments = written(segments, "conversation-segments")
    in_order = segments.repartition("k_").sortWithinPartitions("k_", "part_", "at_")
    return written(in_order.mapInArrow(_chained, AUDIT_SCHEMA), "conversation-audits")


def _replay(batches: Iterator[pa.RecordBatch]):
    """(key, rows) of each conversation; rows gives the repaired (role, text) in order."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for key, members in groupby(rows, key=lambda r: r[0]):
        yield key, _repaired(members)


def _repaired(members):
    state, edits = START, iter("")

    def put():
        nonlocal state
        state = _PUT[state]
        return "user" if state == USER else "assistant"

    for _, audit, role, text in members:
        if audit is not None:  # sorts before the conversation's rows
            edits = iter(audit)
            continue
        while (letter := next(edits)) == "I":
            yield put(), ""
        if letter == "K":
            state = _NEXT[role[0]][state]
            yield role, text
        elif letter == "R":
            yield put(), text
    for _ in edits:
        yield put(), ""


def _dealt(rows: DataFrame, audited: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows behind the audit of their conversation, sorted, conversation by conversation."""
    body = with_order(rows, conv, turn, role, text).withColumn("audit_", F.lit(None).cast("string"))
    heads = audited.select("k_", F.col("audit").alias("audit_"))
    both = body.unionByName(heads, allowMissingColumns=True).withColumn("is_row_", F.col("audit_").isNull())
    both = both.repartition("k_").sortWithinPartitions(*_ordered("is_row_"))
    return both.select("k_", "audit_", "role_", "text_")


def repaired(rows: DataFrame, audited: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired rows: ``k_``, ``position``, ``role``, ``text``."""

    schema = "k_ string, position long, role string, text string"

    def run(batches):
        out, size = [], 0
        for key, members in _replay(batches):
            for at, (new_role, new_text) in enumerate(members):
                out.append((key, at, new_role, new_text))
                size += len(new_text)
                if len(out) >= 1024 or size >= 1 << 22:
                    yield _batch(out, schema)
                    out, size = [], 0
        if out:
            yield _batch(out, schema)

    return _dealt(rows, audited, conv, turn, role, text).mapInArrow(run, schema)


def digests(rows: DataFrame, audited: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``k_`` and the SHA-256 of each conversation's repaired ``role:text``, joined by newlines."""
    schema = "k_ string, sha256 string"

    def run(batches):
        out = []
        for key, members in _replay(batches):
            digest, between = hashlib.sha256(), ""
            for new_role, new_text in members:
                digest.update(f"{between}{new_role}:{new_text}".encode())
                between = "\n"
            out.append((key, digest.hexdigest()))
            if len(out) >= 1024:
                yield _batch(out, schema)
                out.clear()
        if out:
            yield _batch(out, schema)

    return _dealt(rows, audited, conv, turn, role, text).mapInArrow(run, schema)
