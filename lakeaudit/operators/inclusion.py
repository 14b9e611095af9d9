"""References of several columns, with sketches before exact checks.

A column, or a list of columns, refers to a key of another table if all its values are among the
key's. Sketches that keep the values with the smallest hashes rule most pairs out: a value kept of the
one that the other's sketch should have kept and didn't is a value that the other lacks. So no true
pair is lost, and only values of what is left are shuffled. References of several columns grow
from those of one: each of their columns must refer to its partner first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import permutations
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeaudit.functions import names
from lakeaudit.functions.numbers import half_up
from lakeaudit.operators import model, profile
from lakeaudit.session import stored

# Values a sketch keeps: two to this power.
SKETCH_BITS = 12
# Sides of one pass over the tables.
PASS = 256
Side = tuple[str, tuple[str, ...]]

SCHEMA = (
    "constraint_name string, parent_table string, parent_columns string, referenced_table string, referenced_columns string, "
    "child_values long, key_values long, parent_coverage double"
)


def _kinds(tables: Mapping[str, DataFrame], side: Side) -> str:
    return "|".join(model._value_kind(tables[side[0]].schema[c].dataType) for c in side[1])


def _cells(tables: Mapping[str, DataFrame], side: Side) -> tuple[list[Column], Column]:
    """The values of a side in a form that compares across tables, and whether none is NULL."""
    fields = [tables[side[0]].schema[c] for c in side[1]]
    values = [names.column(f.name).cast("long") if isinstance(f.dataType, profile.WHOLE) else names.column(f.name) for f in fields]
    return values, reduce(and_, [v.isNotNull() for v in values])


def sketches(tables: Mapping[str, DataFrame], sides: Sequence[Side], bits: int = SKETCH_BITS) -> DataFrame:
    """(i, kinds, sketch) per side: one scan of each table, and no value is shuffled."""
    parts = []
    for table, df in tables.items():
        own = [(i, s) for i, s in enumerate(sides) if s[0] == table]
        for first in range(0, len(own), PASS):
            some, columns = own[first : first + PASS], []
            for i, side in some:
                values, whole = _cells(tables, side)
                columns.append(F.theta_sketch_agg(F.when(whole, F.xxhash64(F.lit(_kinds(tables, side)), *values)), bits).alias(f"s{i}"))
            one = df.agg(*columns)
            rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_kinds(tables, side)).alias("kinds"), F.col(f"s{i}").alias("sketch")) for i, side in some])
            parts.append(one.select(F.explode(rows).alias("x")).select("x.*"))
    return stored(model._union(parts), "sketches")


def possible_pairs(kept: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (child, parent) pairs whose sketches don't show a value that only the child has."""
    child = kept.select(F.col("i").alias("child"), "kinds", F.col("sketch").alias("mine"))
    parent = kept.select(F.col("i").alias("parent"), F.col("kinds").alias("their_kinds"), F.col("sketch").alias("theirs"))
    met = pairs.join(child, "child").join(parent, "parent").where("kinds = their_kinds")
    missing = F.theta_sketch_estimate(F.theta_difference("mine", "theirs"))
    return stored(met.where((missing == 0) & (F.theta_sketch_estimate("mine") > 0)).select("child", "parent"), "possible")


def included(tables: Mapping[str, DataFrame], sides: Sequence[Side], pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(child, parent, values of the child, values of the parent) of the pairs where all of the child's are the parent's.

    Exact but for 128-bit digests. Distinct values of the sides that occur in a pair meet in one grouped
    pass, as bits of the sides that hold them, combined before the shuffle.
    """
    if not pairs:
        return []
    used = sorted({i for pair in pairs for i in pair})
    number = {i: k for k, i in enumerate(used)}
    words = len(used) // model.WORD_BITS + 1
    parts = []
    for table, df in tables.items():
        cells = []
        for i in used:
            if sides[i][0] != table:
                continue
            values, whole = _cells(tables, sides[i])
            marks = [F.lit(1 << (number[i] % model.WORD_BITS) if number[i] // model.WORD_BITS == w else 0).cast("long").alias(f"w{w}") for w in range(words)]
            digest = F.struct(*[F.xxhash64(F.lit(seed), F.lit(_kinds(tables, sides[i])), *values).alias(f"h{seed}") for seed in (1, 2)], *marks)
            cells.append(F.when(whole, digest))
        if cells:
            parts.append(df.select(F.explode(F.array(*cells)).alias("x")).where("x IS NOT NULL").select("x.*"))
    marks = [f"w{w}" for w in range(words)]
    held = model._union(parts).groupBy("h1", "h2").agg(*[F.bit_or(m).alias(m) for m in marks]).groupBy(*marks).agg(F.count(F.lit(1)).alias("n"))
    held = stored(held, "held")

    def has(i: int) -> Column:
        return F.col(f"w{number[i] // model.WORD_BITS}").bitwiseAND(F.lit(1 << (number[i] % model.WORD_BITS))) != 0

    # Per pair three sums over the few ways in which values are held; pairs are rows by number.
    sums = [F.struct(
        F.lit(c).alias("child"), F.lit(p).alias("parent"), F.sum(F.when(has(c), F.col("n"))).alias("mine"),
        F.sum(F.when(has(p), F.col("n"))).alias("theirs"), F.sum(F.when(has(c) & has(p), F.col("n"))).alias("both"),
    ) for c, p in pairs]
    out: list[tuple[int, int, int, int]] = []
    for first in range(0, len(sums), PASS):
        for r in held.agg(F.array(*sums[first : first + PASS]).alias("x")).select(F.inline("x")).collect():
            if r["mine"] and r["mine"] == r["both"]:
                out.append((r["child"], r["parent"], r["mine"], r["theirs"]))
    return out


def _found(spark: SparkSession, tables: Mapping[str, DataFrame], sides: list[Side], wanted: list[tuple[int, int]], bits: int) -> list[tuple[int, int, int, int]]:
    if not wanted:
        return []
    pairs = spark.createDataFrame(wanted, "child int, parent int")
    left = possible_pairs(sketches(tables, sides, bits), pairs)
    return included(tables, sides, [(r["child"], r["parent"]) for r in left.collect()])


def composite_relationships(
    tables: Mapping[str, DataFrame], keys: DataFrame, kinds: tuple = model.KEY_TYPES, bits: int = SKETCH_BITS
) -> DataFrame:
    """Lists of columns all of whose values are contained in a key of another table.

    ``keys`` has table_name and key_columns, separated by commas; keys of one column and of several
    are taken alike. Rows with a NULL in the list refer to nothing. A list without values refers
    to nothing either. Only figures per column or pair reach the driver.
    """
    spark = keys.sparkSession
    wanted = [(r["table_name"], tuple(r["key_columns"].split(","))) for r in keys.select("table_name", "key_columns").distinct().collect()]
    parts = sorted({(t, (c,)) for t, key in wanted for c in key})
    columns = [(t, (f.name,)) for t, df in tables.items() for f in df.schema.fields if isinstance(f.dataType, kinds)]
    sides = [*columns, *[p for p in parts if p not in columns]]
    at = {s: i for i, s in enumerate(sides)}
    single = [(at[c], at[p]) for c in columns for p in parts if c[0] != p[0] and _kinds(tables, c) == _kinds(tables, p)]
    unary = _found(spark, tables, sides, single, bits)
    holds = {(sides[c], sides[p]) for c, p, _, _ in unary}
    rows = [(sides[c], sides[p], mine, theirs) for c, p, mine, theirs in unary if sides[p] in wanted]
    # Longer lists: each column refers to its partner, in the order of the key.
    grown: list[tuple[Side, Side]] = []
    for table, key in wanted:
        if len(key) < 2:
            continue
        for child in tables:
            choices = [[c[1][0] for c, p in holds if c[0] == child and p == (table, (k,))] for k in key]
            if child != table and all(choices):
                grown += [((child, own), (table, key)) for own in permutations(sorted({c for cs in choices for c in cs}), len(key)) if all(c in cs for c, cs in zip(own, choices, strict=True))]
    many = sorted({s for pair in grown for s in pair})
    place = {s: i for i, s in enumerate(many)}
    rows += [(many[c], many[p], mine, theirs) for c, p, mine, theirs in _found(spark, tables, many, [(place[c], place[p]) for c, p in grown], bits)]
    listed = [(
        "_".join(["fk", child[0], *child[1], parent[0]]), child[0], ",".join(child[1]), parent[0], ",".join(parent[1]), mine, theirs, None,
    ) for child, parent, mine, theirs in rows]
    # A row per reference.
    found = spark.createDataFrame(listed, SCHEMA)
    return found.withColumn("parent_coverage", half_up(F.try_divide("child_values", "key_values"), 4))
