"""Keyless alignment: conservation, maximality and planted changes."""

import random
from collections import Counter

import pytest

from tallyferry.operators import alignment as A
from tallyferry.operators import diffs as D

SCHEMA = "a long, b string, c double, d string"


def lines_of(source, target, **more):
    return [tuple(r) for r in A.aligned_diff(source, target, **more).collect()]


def test_one_missing_row_is_one_line(table):
    lines = table("lineitem")
    gone = lines.orderBy("l_orderkey", "l_linenumber").limit(1).first()
    less = lines.where(f"not (l_orderkey = {gone.l_orderkey} and l_linenumber = {gone.l_linenumber} and l_partkey = {gone.l_partkey})")
    got = lines_of(lines, less, show=["l_orderkey", "l_linenumber"])
    assert got == [(gone.l_orderkey, gone.l_linenumber, None, None, None, "source_only", lines.count() - less.count())]
    assert lines_of(less, lines, show=["l_orderkey"])[0][4] == "target_only"
    # What matching by position makes of the same.
    assert D.positional_diff(lines, less).count() > 1000


def best_pairs(sources, targets, changed):
    """Whether some leftover pair differs in at most ``changed`` cells."""
    return any(sum(x != y for x, y in zip(s, t)) <= changed for s in sources for t in targets)


@pytest.mark.parametrize("seed", range(4))
def test_random_tables(spark, seed):
    rng = random.Random(seed)
    values = [[None, 1, 2, 3], ["x", "y", None, ""], [0.5, None, 1.5], ["p", "q", "r", "s"]]
    rows = [tuple(rng.choice(v) for v in values) for _ in range(120)]
    other = [tuple(rng.choice(v) if rng.random() < 0.15 else cell for v, cell in zip(values, r)) for r in rows if rng.random() < 0.9]
    other += [tuple(rng.choice(v) for v in values) for _ in range(8)]
    rng.shuffle(other)
    source, target = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)
    got = A.aligned_diff(source, target, ["a", "b", "c", "d"]).collect()
    left, right = Counter(rows) - Counter(other), Counter(other) - Counter(rows)
    alone = {kind: Counter({tuple(r[:4]): r.copies for r in got if r.kind == kind}) for kind in ("source_only", "target_only")}
    assert not alone["source_only"] - left and not alone["target_only"] - right
    paired = left - alone["source_only"]
    assert sum(paired.values()) == sum((right - alone["target_only"]).values())
    # Every paired row changes in one or two cells, and nobody left could have met.
    changed = Counter()
    for r in got:
        if r.kind == "changed":
            changed[tuple(r[:4])] += r.copies
    assert set(changed) == set(paired)
    assert all(paired[k] <= n <= 2 * paired[k] for k, n in changed.items())
    assert not best_pairs(alone["source_only"], alone["target_only"], 2)


def test_fewest_changed_cells_first(spark):
    source = spark.createDataFrame([(1, "x", 1.0, "p"), (2, "y", 2.0, "q")], SCHEMA)
    target = spark.createDataFrame([(1, "x", 9.0, "z"), (1, "x", 1.0, "z"), (2, "n", 8.0, "q")], SCHEMA)
    got = sorted(lines_of(source, target, show=["a"]), key=repr)
    assert got == sorted([
        (1, "d", "p", "z", "changed", 1), (2, "b", "y", "n", "changed", 1), (2, "c", "2.0", "8.0", "changed", 1),
        (1, None, None, None, "target_only", 1),
    ], key=repr)
    only = lines_of(source, target, show=["a"], max_changed=0)
    assert sorted((r[0], r[4], r[5]) for r in only) == [
        (1, "source_only", 1), (1, "target_only", 2), (2, "source_only", 1), (2, "target_only", 1)
    ]


def test_hot_rows_and_empty_sides(spark):
    hot = spark.range(3000).selectExpr("if(id % 3 = 0, 7L, id) as a", "'x' as b", "1.0D as c", "'same' as d")
    fewer = hot.where("a <> 7").union(hot.where("a = 7").limit(400))
    assert [r[1:] for r in lines_of(hot, fewer)] == [(None, None, None, "source_only", 601)]
    # All rows agree but for the first column: they meet one by one.
    shifted = hot.selectExpr("a + 10000 as a", "b", "c", "d")
    got = A.aligned_diff(hot, shifted)
    assert got.where("kind <> 'changed' or column_name <> 'a'").isEmpty() and got.agg({"copies": "sum"}).first()[0] == 3000
    none = hot.limit(0)
    assert lines_of(none, none) == [] and A.aligned_diff(hot, none).agg({"copies": "sum"}).first()[0] == 3000
    with pytest.raises(ValueError, match="rename"):
        A.aligned_diff(hot.withColumnRenamed("b", "side"), hot.withColumnRenamed("b", "side"))
