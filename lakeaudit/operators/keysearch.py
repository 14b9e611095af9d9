"""Minimal keys of any width, level by level.

A set of columns is a key if no row has a NULL in it and no two rows agree on it, and minimal if
none of its parts is one. Level by level, only sets without a key inside are candidates. Most
fall without a pass over all rows: if their columns have too few combinations for the
rows, or if they lie in an agree set, the columns on which two rows are known to agree. Agree
sets come from all rows of a sample of values, so that rows with equal values stay
together. What survives is checked on all rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import prod
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions import names
from lakeaudit.operators import model
from lakeaudit.session import stored

WIDTH = 3
# One of so many values is in the sample that agree sets are found in; the checks are exact.
SAMPLE_OF = 16
# Candidates of one pass over the tables: each row becomes so many digests at most.
PASS = 256
# Agree sets kept of each table, the widest; they only save checks.
AGREE_SETS = 1000

SCHEMA = "table_name string, key_columns string, width int, row_count long"
Candidate = tuple[str, tuple[str, ...]]


def agree_sets(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]], candidates: Sequence[tuple[Candidate, str]], sample_of: int = SAMPLE_OF) -> dict[str, list[int]]:
    """Per table the sets of columns, as bits of their place, on which two sampled rows agree.

    A candidate comes with the column whose values are sampled for it. Of the rows equal in a
    candidate, the first and the last by digest are compared in all columns.
    """
    parts = []
    for table, df in tables.items():
        own = [(i, c[1], pivot) for i, (c, pivot) in enumerate(candidates) if c[0] == table]
        if not own:
            continue
        digests = F.array(*[F.xxhash64(names.column(c), names.column(c).isNull()) for c in columns[table]])
        row = df.withColumn("_row", digests)
        cells = [
            F.when(
                F.pmod(F.xxhash64(F.lit(9), names.column(pivot)), F.lit(sample_of)) == 0,
                F.struct(F.lit(i).alias("k"), *[F.xxhash64(F.lit(seed), *[names.column(c) for c in key]).alias(f"h{seed}") for seed in (1, 2)]),
            )
            for i, key, pivot in own
        ]
        parts.append(row.select(F.lit(table).alias("t"), "_row", F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("x")).select("t", "_row", "x.*"))
    if not parts:
        return {}
    groups = model._union(parts).groupBy("t", "k", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("a"), F.max("_row").alias("b")).where("n > 1")
    place = F.sequence(F.lit(0), F.size("a") - 1)
    equal = F.zip_with(F.zip_with("a", "b", lambda x, y: x == y), place, lambda same, i: F.when(same, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    masks = groups.select("t", F.aggregate(equal, F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y)).alias("mask")).distinct()
    # A list per table of bounded length.
    found: dict[str, list[int]] = {}
    for table in {c[0] for c, _ in candidates}:
        best = masks.where(F.col("t") == table).orderBy(F.bit_count("mask").desc(), "mask").limit(AGREE_SETS)
        found[table] = [r["mask"] for r in best.collect()]
    return found


def minimal_keys(tables: Mapping[str, DataFrame], width: int = WIDTH, kinds: tuple = model.KEY_TYPES, sample_of: int = SAMPLE_OF) -> DataFrame:
    """(table_name, key_columns, width, row_count): all minimal keys of up to ``width`` columns.

    ``key_columns`` are in the order of the table. Columns with a NULL are in no key; a table
    without rows has none; a table of one row has each of its columns as one. Only figures per
    candidate reach the driver.
    """
    columns = {t: [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)][:63] for t, df in tables.items()}
    spark = next(iter(tables.values())).sparkSession if tables else None
    keys: list[tuple[Candidate, int]] = []
    useful: dict[str, list[str]] = {t: [] for t in tables}
    sizes: dict[Candidate, int] = {}
    rows: dict[str, int] = {}
    for r in _checked(tables, [(t, (c,)) for t, cs in columns.items() for c in cs]):
        table, column = r["table_name"], r["key_columns"]
        rows[table] = r["row_count"]
        if r["is_key"]:
            keys.append(((table, (column,)), r["row_count"]))
        elif not r["null_rows"] and r["distinct_count"] > 1:
            # A column of one value tells no rows apart, so no minimal key holds it.
            sizes[table, (column,)] = r["distinct_count"]
    for table, cs in columns.items():
        useful[table] = [c for c in cs if (table, (c,)) in sizes]
    masks: dict[str, list[int]] = {}
    for level in range(2, width + 1):
        found = {c for c, _ in keys}
        todo = [
            (t, key) for t, cs in useful.items() for key in combinations(cs, level)
            if prod(sizes[t, (c,)] for c in key) >= rows[t] and not any((t, part) in found for n in range(1, level) for part in combinations(key, n))
        ]

        def open_(candidates: list[Candidate]) -> list[Candidate]:
            bits = {t: {c: 1 << i for i, c in enumerate(cs)} for t, cs in columns.items()}
            return [(t, k) for t, k in candidates if not any(reduce(add, (bits[t][c] for c in k)) & ~m == 0 for m in masks.get(t, ()))]

        while todo := open_(todo):
            some, todo = todo[:PASS], todo[PASS:]
            pivots = [(c, max(c[1], key=lambda name, t=c[0]: sizes[t, (name,)])) for c in some]
            for table, more in agree_sets(tables, columns, pivots, sample_of).items():
                masks[table] = [*masks.get(table, ()), *more]
            for r in _checked(tables, open_(some)):
                if r["is_key"]:
                    keys.append(((r["table_name"], tuple(r["key_columns"].split(","))), r["row_count"]))
    listed = [(t, ",".join(key), len(key), n) for (t, key), n in keys]
    # A row per key.
    return spark.createDataFrame(listed, SCHEMA)


def _checked(tables: Mapping[str, DataFrame], candidates: list[Candidate]) -> list:
    return stored(model.check_keys(tables, candidates), "keys").collect() if candidates else []
