"""Merkle manifest of a dataset by lag and lead windows (operator 11).

Rows become leaves: the digest of their fields.  The leaves of a group, in order, are
hashed in runs of ``fanout`` until one node, the subroot, remains; the subroots, in order
of their group (null first), are hashed likewise into the root.

Levels are windows, not self-joins.  At a level the node of a run's child lives on the row
of that child's first leaf, so siblings stand at fixed offsets: ``lag`` and ``lead`` columns,
masked by the child's slot in its run and by the run's length, bring them, and the row of
the first child hashes the parent.  On the way back each row takes its parent's path from
the first child's row by a fixed ``lag``.  A window holds ``fanout ** STEPS`` leaves of a
group, never a whole group; the nodes that remain of it are the rows of the next window
table, which is that many times smaller, and paths come down by one join per table.

Positions in a group come from a range partitioning with a salt as its last key, so a hot
group, or one row repeated, is dealt over many tasks; only rows per (group, partition) meet
in one window.  Each table is written to the shared folder, so a lost executor costs one
table's work.  Only the number of levels and the root pass through the driver.

Defined cases: a null field is ``-``, any other its UTF-8 byte count, ``:`` and its text;
null keys sort first; rows of one key are ordered by their digests, so repeated rows are
leaves of their own; a group of one row has its leaf as subroot; null is a group of its
own, apart from the empty text; an empty table gives an empty result; other columns are
left alone and may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import q, written

STEPS = 10  # levels of one window table
PATH = "array<struct<l:string,r:string>>"


def encoded(fields: list[Column]) -> Column:
    """The fields as one text: ``-`` for null, else byte count, ``:`` and value."""
    texts = [f.cast("string") for f in fields]
    return F.concat(*[
        F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts
    ])


def digest(fields: list[Column]) -> Column:
    return F.sha2(encoded(fields), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, x: F.sha2(F.concat(x["l"], node, x["r"]), 256))


def siblings(path: Column) -> Column:
    """A path's digests from leaf to root, left to right, as one text."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["l"], x["r"])), "")


@dataclass(frozen=True)
class Manifest:
    """``rows``: the carried columns, ``leaf``, ``subroot`` and ``path`` (from leaf to root: the
    siblings to the left and to the right at every level); ``subroots``: ``group``, ``subroot``,
    ``leaves``; ``root``: null for an empty table."""

    rows: DataFrame
    subroots: DataFrame
    root: str | None


def build(docs: DataFrame, group: Column, order: list[Column], leaf: Column, carry: list[Column], fanout: int = 2, steps: int = STEPS) -> Manifest:
    """The manifest of a table; ``carry`` are named columns of it to keep beside each leaf."""
    if fanout < 2 or steps < 1:
        raise ValueError("a run has two or more children, a window one or more levels")
    kept = docs.select(*carry).schema.names
    sort = [f"o{i}_" for i in range(len(order))]
    leaves = docs.select(
        group.cast("string").alias("key_"), encoded([group]).alias("group_"), leaf.alias("node_"),
        *[c.alias(s) for c, s in zip(order, sort)], *[c.alias(f"c{i}_") for i, c in enumerate(carry)],
    )
    carried = ["key_", *[f"c{i}_" for i in range(len(kept))]]
    tables = _climb(_placed(leaves, [*sort, "node_"], carried, "merkle-leaves"), carried, fanout, steps)
    subroots = written(
        tables[-1].where("slot_ = 0").select("group_", "key_", F.col("top_").alias("subroot_"), F.col("size_").alias("leaves_")),
        "merkle-subroots",
    ) if len(tables) == 1 else _subroots(tables)
    one = subroots.select(F.lit("").alias("group_"), "key_", F.col("group_").alias("of_"), F.col("subroot_").alias("node_"))
    crown = _climb(_placed(one, ["key_"], ["of_"], "merkle-groups"), ["of_"], fanout, steps)
    top = crown[-1].where("slot_ = 0").select("top_").first()
    # down again: the crown's own tables, then the groups' from the smallest to the leaves
    above = _down(crown, None, fanout, steps).select(F.col("of_").alias("group_"), F.lit(0).cast("long").alias("up_"), F.col("path_").alias("rest_"))
    above = above.join(subroots.select("group_", "subroot_"), "group_")
    rows = _down(tables, above, fanout, steps)
    return Manifest(
        rows.select(
            *[F.col(f"c{i}_").alias(c) for i, c in enumerate(kept)],
            F.col("node_").alias("leaf"), F.col("subroot_").alias("subroot"), F.col("path_").alias("path"),
        ),
        subroots.select(F.col("key_").alias("group"), F.col("subroot_").alias("subroot"), F.col("leaves_").alias("leaves")),
        top[0] if top else None,
    )


def _placed(nodes: DataFrame, order: list[str], carried: list[str], label: str) -> DataFrame:
    """Nodes (``group_``, ``node_``, carried columns) with ``slot_`` and ``size_`` in their group."""
    keys = [F.col(c).asc_nulls_first() for c in ["group_", *order, "salt_"]]
    dealt = nodes.withColumn("salt_", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    columns = list(dict.fromkeys(["group_", "node_", *carried]))
    ordered = written(dealt.select(*columns, F.monotonically_increasing_id().alias("at_")), label)
    ordered = ordered.withColumn("part_", F.expr("shiftrightunsigned(at_, 33)"))
    # one row per group and partition
    runs = written(ordered.groupBy("group_", "part_").agg(F.min("at_").alias("from_"), F.count("*").alias("n_")), label + "-runs")
    runs = runs.selectExpr(
        "group_", "part_",
        "coalesce(sum(n_) OVER (PARTITION BY group_ ORDER BY part_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) - from_ AS shift_",
        "sum(n_) OVER (PARTITION BY group_) AS size_",
    )
    return ordered.join(runs, ["group_", "part_"]).select(*columns, F.expr("at_ + shift_").alias("slot_"), "size_")


def _climb(nodes: DataFrame, carried: list[str], fanout: int, steps: int) -> list[DataFrame]:
    """Written window tables from the leaves up to one node a group."""
    span, tables = fanout ** steps, []
    while True:
        table = written(_window_table(nodes, fanout, steps), "merkle-levels")
        tables.append(table)
        if (table.agg(F.max("size_")).first()[0] or 0) <= span:
            return tables
        nodes = table.where(f"slot_ % {span} = 0").selectExpr(
            "group_", "top_ AS node_", f"slot_ DIV {span} AS slot_", f"(size_ + {span - 1}) DIV {span} AS size_"
        )


def _window_table(nodes: DataFrame, fanout: int, steps: int) -> DataFrame:
    """Nodes with ``path_`` (their siblings within the window, level by level) and, on a window's
    first row, ``top_``: what remains of the window."""
    over = f"OVER (PARTITION BY group_, block_ ORDER BY slot_)"
    df = nodes.withColumn("block_", F.expr(f"slot_ DIV {fanout ** steps}")).withColumn("top_", F.col("node_"))
    for level in range(steps):
        step, size, place, live = _level(level, fanout)
        others = range(1, fanout)
        df = df.withColumns(
            {f"b{o}_": F.expr(f"lag(top_, {o * step}) {over}") for o in others}
            | {f"a{o}_": F.expr(f"lead(top_, {o * step}) {over}") for o in others}
        )
        left = ", ".join(f"CASE WHEN {place} >= {o} THEN b{o}_ END" for o in reversed(others))
        right = ", ".join(f"CASE WHEN {place} + {o} < {fanout} AND slot_ DIV {step} + {o} < {size} THEN a{o}_ END" for o in others)
        df = df.withColumn(f"s{level}_", F.expr(f"CASE WHEN {live} THEN struct(concat_ws('', {left}) AS l, concat_ws('', {right}) AS r) END"))
        df = df.withColumn("top_", F.expr(
            f"CASE WHEN NOT {live} THEN top_ WHEN {place} = 0 THEN sha2(concat(top_, s{level}_.r), 256) END"
        )).drop(*[f"{s}{o}_" for s in "ab" for o in others])
    df = df.withColumn("path_", F.expr(f"CAST(array() AS {PATH})"))
    for level in reversed(range(steps)):
        step, size, place, live = _level(level, fanout)
        parents = " ".join(f"WHEN {o} THEN lag(path_, {o * step}) {over}" for o in range(1, fanout))
        df = df.withColumn("up_", F.expr(f"CASE {place} {parents} ELSE path_ END"))
        df = df.withColumn("path_", F.expr(f"CASE WHEN {live} THEN concat(array(s{level}_), up_) ELSE path_ END")).drop("up_", f"s{level}_")
    return df.drop("block_")


def _level(level: int, fanout: int) -> tuple[int, str, str, str]:
    """Of a level: the distance of neighbours, the number of nodes, a node's place in its run, and
    whether a row holds a node whose group has more than one."""
    step = fanout ** level
    size = f"((size_ + {step - 1}) DIV {step})"
    return step, size, f"(slot_ DIV {step} % {fanout})", f"(slot_ % {step} = 0 AND {size} > 1)"


def _subroots(tables: list[DataFrame]) -> DataFrame:
    """One row per group: its subroot from the last table, its key and size from the first."""
    last = tables[-1].where("slot_ = 0").select("group_", F.col("top_").alias("subroot_"))
    first = tables[0].where("slot_ = 0").select("group_", "key_", F.col("size_").alias("leaves_"))
    return written(first.join(last, "group_"), "merkle-subroots")


def _down(tables: list[DataFrame], above: DataFrame | None, fanout: int, steps: int) -> DataFrame:
    """The first table's rows with their whole paths; ``above`` goes on from the last table's groups."""
    span = fanout ** steps
    for i, table in reversed(list(enumerate(tables))):
        if above is not None:
            up = table.withColumn("up_", F.expr(f"slot_ DIV {span}" if i < len(tables) - 1 else "0L"))
            table = up.join(above, ["group_", "up_"]).withColumn("path_", F.concat("path_", "rest_")).drop("rest_", "up_")
        if i:
            more = [c for c in ("subroot_",) if c in table.columns]
            above = table.select("group_", F.col("slot_").alias("up_"), F.col("path_").alias("rest_"), *more)
    return table
