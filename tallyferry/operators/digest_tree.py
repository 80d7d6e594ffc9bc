"""Cell differences of large copies that are mostly equal: a tree of digests over key ranges.

The leaves are ranges of the leading key, cut by keys sampled from the source; each
has its rows' number and two digests that do not depend on order. A node above is the sum of
those below it, up to one node for the table. Both trees are compared from the top, level by
level, going down only where nodes differ. The row-by-row join then reads only the
ranges whose leaves differ, by filters on the key that reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyferry.functions.digests import comparable
from tallyferry.functions.predicates import conjoin
from tallyferry.functions.scalars import ordinal, ordinal_literal
from tallyferry.functions.text import quoted
from tallyferry.operators.diffs import field_diff
from tallyferry.operators.intervals import between_cuts
from tallyferry.operators.ranks import non_null_keys, split_keys
from tallyferry.session import materialise

LEAVES = 4096
FAN_OUT = 16
#: Ranges of a filter; more of them are found by joining the leaf numbers, at most ``LEAVES``.
FILTER_RANGES = 64
_LEAF = "__leaf"


@dataclass(frozen=True)
class TreeDiff:
    """``lines`` as ``field_diff`` gives them, and the rows of either side that their join reads."""

    lines: DataFrame
    source_rows: int
    target_rows: int
    ranges: int


def leaf_of(df: DataFrame, key: str, cuts: Sequence[object]) -> Column:
    """The key range of a row: how many cuts lie at or below its key; rows without a key come last."""
    value = ordinal(df, key)
    stand_in = F.lit(cuts[0]) if cuts else F.lit(None)
    return F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(between_cuts(F.coalesce(value, stand_in), cuts)).cast("int")


def digest_tree(df: DataFrame, key: str, cuts: Sequence[object], columns: Sequence[str]) -> DataFrame:
    """``level`` (0: the root), ``node``, ``n_rows`` and two digests, of all levels; one aggregate over the table."""
    values = [comparable(c, df.schema[c].dataType) for c in columns] + [f"isnull({quoted(c)})" for c in columns]
    row = ", ".join(values)
    leaves = df.select(
        leaf_of(df, key, cuts).alias("node"), F.expr(f"xxhash64(0, {row})").alias("a"), F.expr(f"xxhash64(1, {row})").alias("b")
    )
    # The sum of 32 bits cannot overflow below 2^31 rows a leaf times 2^32.
    leaves = leaves.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor("a").alias("mixed"),
        F.sum(F.shiftrightunsigned("b", 32).cast("decimal(20,0)")).alias("total"),
    )
    depth = depth_of(len(cuts) + 2)
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level")
    node = F.expr(f"cast(floor(node / power({FAN_OUT}, {depth} - level)) as int)")
    spread = leaves.select(levels, "node", "n_rows", "mixed", "total").withColumn("node", node)
    return spread.groupBy("level", "node").agg(
        F.sum("n_rows").alias("n_rows"), F.bit_xor("mixed").alias("mixed"), F.sum("total").cast("decimal(38,0)").alias("total")
    )


def depth_of(leaves: int) -> int:
    """Levels below the root."""
    depth = 0
    while FAN_OUT**depth < leaves:
        depth += 1
    return depth


def differing_leaves(source: DataFrame, target: DataFrame, depth: int) -> list:
    """(node, source rows, target rows) of the leaves that differ: one small query a level, below differing nodes only."""
    names = ["n_rows", "mixed", "total"]
    open_nodes, rows = [0], []
    for level in range(depth + 1):
        # At most LEAVES numbers, usually few.
        here = [t.where((F.col("level") == level) & F.col("node").isin(open_nodes)).select("node", *names) for t in (source, target)]
        other = here[1].select("node", *[F.col(n).alias(f"t_{n}") for n in names])
        differ = ~conjoin(*[F.col(n).eqNullSafe(F.col(f"t_{n}")) for n in names])
        rows = here[0].join(other, "node", "full_outer").where(differ).select("node", "n_rows", "t_n_rows").collect()
        open_nodes = [r["node"] * FAN_OUT + i for r in rows for i in range(FAN_OUT)]
        if not rows:
            break
    return sorted(((r["node"], r["n_rows"] or 0, r["t_n_rows"] or 0) for r in rows))


def tree_diff(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, leaves: int = LEAVES
) -> TreeDiff:
    """The lines of ``field_diff``, with a join over the key ranges that differ only.

    ``keys[0]`` leads the ranges. Keys must be unique; it is checked in the ranges that
    are joined.
    """
    key = keys[0]
    compared = [*keys, *(columns if columns is not None else [c for c in source.columns if c not in keys])]
    known = non_null_keys(source, key)
    rows = known.count()
    cuts = split_keys(known, rows, leaves - 1) if rows else []
    trees = [materialise(digest_tree(df, key, cuts, compared).repartition("level"), "digest-tree") for df in (source, target)]
    found = differing_leaves(*trees, depth_of(len(cuts) + 2))
    nodes = [node for node, _, _ in found]
    picked = [_of_leaves(df.select(*map(quoted, compared)), key, cuts, nodes) for df in (source, target)]
    return TreeDiff(
        field_diff(*picked, keys, compared[len(keys):]), sum(f[1] for f in found), sum(f[2] for f in found), len(_runs(nodes))
    )


def _runs(nodes: list[int]) -> list[tuple[int, int]]:
    """Neighbouring leaves as ranges, first and last."""
    out: list[tuple[int, int]] = []
    for node in nodes:
        if out and out[-1][1] == node - 1:
            out[-1] = (out[-1][0], node)
        else:
            out.append((node, node))
    return out


def _of_leaves(df: DataFrame, key: str, cuts: list, nodes: list[int]) -> DataFrame:
    """The rows of some leaves."""
    runs, column, nulls = _runs([n for n in nodes if n <= len(cuts)]), F.col(quoted(key)), len(cuts) + 1 in nodes
    if len(runs) > FILTER_RANGES:
        wanted = df.sparkSession.createDataFrame([(n,) for n in nodes], f"{_LEAF} int")
        return df.withColumn(_LEAF, leaf_of(df, key, cuts)).join(F.broadcast(wanted), _LEAF, "left_semi").drop(_LEAF)
    condition = column.isNull() if nulls else F.lit(False)
    for first, last in runs:
        low = column >= ordinal_literal(df, key, cuts[first - 1]) if first > 0 else None
        high = column < ordinal_literal(df, key, cuts[last]) if last < len(cuts) else None
        condition = condition | conjoin(column.isNotNull(), low, high)
    return df.where(condition)
