"""Minimal keys, references of several columns, and the digest tree against plain forms."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakeaudit.operators import compare, inclusion, keysearch


def plain_keys(rows, columns, width):
    out = set()
    for n in range(1, width + 1):
        for own in itertools.combinations(range(len(columns)), n):
            values = [tuple(r[i] for i in own) for r in rows]
            whole = all(v is not None for t in values for v in t)
            if rows and whole and len(set(values)) == len(values) and not any(set(k) < set(own) for k in out):
                out.add(own)
    return {",".join(columns[i] for i in k) for k in out}


@pytest.mark.parametrize("seed", range(4))
def test_minimal_keys_equal_all_sets(spark, seed, monkeypatch):
    """No single column is a key; some sets of two or three are."""
    monkeypatch.setattr(keysearch, "PASS", 7)
    rng, columns = random.Random(seed), ["a", "b", "c", "d", "e", "f"]
    rows = [(rng.randint(0, 25), str(rng.randint(0, 18)), rng.randint(0, 9), rng.randint(0, 4), 1, rng.choice([1, 2, None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, c int, d int, e int, f int")
    got = {r.key_columns for r in keysearch.minimal_keys({"t": df}, 4).collect()}
    assert got == plain_keys(rows, columns, 4)


def test_a_key_of_two_columns_only(spark):
    rows = [(k // 10, k % 10, k % 2, None) for k in range(100)]
    tables = {"grid": spark.createDataFrame(rows, "x int, y int, half int, gap string"), "none": spark.createDataFrame([], "x int"), "one": spark.createDataFrame([(1, "a")], "x int, y string")}
    got = sorted((r.table_name, r.key_columns, r.width, r.row_count) for r in keysearch.minimal_keys(tables).collect())
    assert got == [("grid", "x,y", 2, 100), ("one", "x", 1, 1), ("one", "y", 1, 1)]


def test_agree_sets_are_agreements(spark):
    rows = [(k % 7, k % 11, k % 3, k % 2) for k in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    columns = {"t": ["a", "b", "c", "d"]}
    masks = keysearch.agree_sets({"t": df}, columns, [(("t", ("a", "b")), "b"), (("t", ("c", "d")), "c")], 2)["t"]
    true = {sum(1 << i for i in range(4) if x[i] == y[i]) for x, y in itertools.combinations(rows, 2)}
    assert masks and set(masks) <= true


def plain_references(tables, keys):
    out = set()
    for parent, key in keys:
        theirs = {tuple(r[tables[parent][0].index(c)] for c in key) for r in tables[parent][1]}
        for child, (columns, rows) in tables.items():
            for own in itertools.permutations(columns, len(key)) if child != parent else ():
                mine = {tuple(r[columns.index(c)] for c in own) for r in rows}
                mine = {t for t in mine if None not in t}
                kinds = all(isinstance(x, str) == isinstance(y, str) for m in list(mine)[:1] for t in list(theirs)[:1] for x, y in zip(m, t, strict=True))
                if mine and kinds and mine <= theirs:
                    out.add((child, ",".join(own), parent, ",".join(key), len(mine), len(theirs)))
    return out


@pytest.mark.parametrize("bits", [4, 12])
def test_references_equal_plain_inclusions(spark, bits):
    """Also with sketches that keep 16 values only: no pair is lost."""
    rng = random.Random(bits)
    stock = sorted({(rng.randint(0, 60), rng.randint(0, 40), rng.choice("xyz")) for _ in range(900)})
    tables = {
        "stock": (["part", "shop", "kind"], stock),
        "lines": (["p", "s", "k", "n"], [(*rng.choice(stock), rng.randint(0, 3)) for _ in range(3000)] + [(None, 1, "x", 1), (5000, None, "x", 1)]),
        "swapped": (["s", "p"], [(s, p) for p, s, _ in rng.sample(stock, 300)]),
        "stray": (["p", "s"], [(p, s) for p, s, _ in rng.sample(stock, 300)] + [(60, 41)]),
        "parts": (["part"], [(k,) for k in range(100)]),
    }
    tables["lines"] = (tables["lines"][0], [r for r in tables["lines"][1] if r[0] != 5000])
    schemas = {"stock": "part int, shop long, kind string", "lines": "p long, s int, k string, n int", "swapped": "s int, p int", "stray": "p int, s int", "parts": "part long"}
    keys = [("stock", ("part", "shop")), ("stock", ("part", "shop", "kind")), ("parts", ("part",))]
    frames = {t: spark.createDataFrame(rows, schemas[t]) for t, (_, rows) in tables.items()}
    listed = spark.createDataFrame([(t, ",".join(k)) for t, k in keys], "table_name string, key_columns string")
    got = {
        (r.parent_table, r.parent_columns, r.referenced_table, r.referenced_columns, r.child_values, r.key_values)
        for r in inclusion.composite_relationships(frames, listed, bits=bits).collect()
    }
    want = plain_references(tables, keys)
    assert got == want and ("lines", "p,s", "stock", "part,shop") in {w[:4] for w in want}


def test_sketches_rule_pairs_out_before_values_move(spark):
    tables = {"big": spark.range(20000).selectExpr("id AS a", "id * 2 AS b"), "ref": spark.range(20000).selectExpr("id AS k")}
    sides = [("big", ("a",)), ("big", ("b",)), ("ref", ("k",))]
    kept = inclusion.sketches(tables, sides)
    pairs = spark.createDataFrame([(0, 2), (1, 2), (2, 0), (2, 1)], "child int, parent int")
    assert sorted(tuple(r) for r in inclusion.possible_pairs(kept, pairs).collect()) == [(0, 2), (2, 0)]


def test_no_references(spark):
    none = spark.createDataFrame([], "a int, b int")
    keys = spark.createDataFrame([("t", "a,b")], "table_name string, key_columns string")
    assert inclusion.composite_relationships({"t": none, "u": none}, keys).collect() == []


def _sides(spark, rows=20_000, changed=5):
    rng = random.Random(changed)
    some = rng.sample(range(rows), 3 * changed)
    one = spark.range(rows).selectExpr("id AS k", "cast(id % 97 AS string) AS v", "if(id % 5 = 0, NULL, id) AS w")
    gone, new, other = some[:changed], some[changed : 2 * changed], some[2 * changed :]
    two = one.where(~F.col("k").isin(gone)).withColumn("v", F.when(F.col("k").isin(other), F.lit("other")).otherwise(F.col("v")))
    return one.where(~F.col("k").isin(new)), two


@pytest.mark.parametrize("changed", [0, 1, 5, 200])
def test_tree_diff_equals_the_whole_diff(spark, changed):
    one, two = _sides(spark, changed=changed)
    whole = compare.keyed_diff(one, two, ["k"], ["v", "w"])
    got = compare.tree_diff(one, two, ["k"], ["v", "w"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.where("status <> 'same'").collect()))
    assert sorted(map(tuple, compare.tree_summary(one, two, ["k"], ["v", "w"]).collect())) == sorted(map(tuple, compare.diff_summary(whole).collect()))


def test_only_buckets_with_changes_are_followed(spark):
    one, two = _sides(spark, changed=2)
    found, level = compare.suspect_buckets(one, two, ["k"], ["v", "w"])
    assert level == compare.LEVELS and 0 < found.count() <= 6
    assert compare._within(one, ["k"], found, level).count() < 20
    # Too many to follow: the level above stays, and the result too.
    _, level = compare.suspect_buckets(*_sides(spark, changed=200), ["k"], ["v", "w"], followed=300)
    assert level == 1
    assert compare.suspect_buckets(*_sides(spark, changed=200), ["k"], ["v", "w"], followed=3)[1] == 0


def test_tree_sees_repeated_rows(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], "k int, v string")
    two = spark.createDataFrame([(1, "b"), (1, "b"), (2, "b"), (None, "m")], "k int, v string")
    got = {(r.k, r.status) for r in compare.tree_diff(one, two, ["k"], ["v"]).collect()}
    assert got == {(1, "duplicate"), (None, "changed")}
    none = one.where("false")
    assert compare.tree_diff(none, none, ["k"], ["v"]).collect() == [] and compare.tree_diff(one, none, ["k"], ["v"]).count() == 3
