"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import WORD, parts, seeded, slice_of, stored, with_broadcast_if_small
from lakeaudit.llm.rows import HELD, released

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 50


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def filled_targets(sizes: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to rows (source, source_size, weight): one row per source.

    Together the targets are ``share`` of all sizes. A source stops at ``max_epochs`` times
    its size, and what it can't take goes to the others by weight until none is above. In
    order of the level (target per weight) at which sources fill up, a source is full if the
    level left by those before it reaches its own. Full sources raise that level, and passing
    over one that isn't full would lower it, so the largest level of those not full holds for
    all of them. That is the fixed point of clamping and resharing.
    """
    every = Window.partitionBy(F.lit(0))
    before = every.orderBy("__fills_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("__total") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    return (
        sizes.withColumn("__cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("__fills_at", F.col("__cap") / F.col("weight"))
        .withColumn("__total", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("__level", level)
        .withColumn("__level", F.when(F.col("__fills_at") > F.col("__level"), F.col("__level")))
        .withColumn("__final", F.max("__level").over(every))
        .withColumn("target", F.when(F.col("__fills_at") > F.col("__final"), F.col("__final") * F.col("weight")).otherwise(F.col("__cap")))
        .drop("__cap", "__fills_at", "__total", "__level", "__final")
    )


def mixture_plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """What the mix takes of each source: whole repetitions and where the fractional one stops.

    ``sized`` has source, size and ``__order``, the seeded order. The fractional repetition
    takes the first rows in that order up to the target; ``cut_order`` is the row at
    which it stops and ``cut_words`` what it takes of that row (equal rows share it).
    The cut is found from sums of slices of the order, then inside the one slice it falls
    into, so that a hot source never meets in one task.
    """
    slices = 4 * parts(sized.sparkSession)
    sized = sized.withColumn("__slice", slice_of(F.col("__order"), slices))
    sums = stored(sized.groupBy("source", "__slice").agg(F.sum("size").alias("__sum")), "mixing-sums")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    sources = (
        sums.groupBy("source").agg(F.sum("__sum").alias("source_size"))
        .withColumn("__rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", weight).drop("__rank")
    )
    plan = filled_targets(sources, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("__rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    plan = stored(plan.withColumnRenamed("source", "__source"), "mixing-targets")
    inside = Window.partitionBy("source").orderBy("__slice")
    cut_slice = (
        sums.withColumn("__to", F.sum("__sum").over(inside))
        .join(with_broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("__source")))
        .where((F.col("__to") > F.col("__rest")) & (F.col("__to") - F.col("__sum") <= F.col("__rest")))
        .select("__source", F.col("__slice").alias("__cut_slice"), (F.col("__rest") - F.col("__to") + F.col("__sum")).alias("__left"))
    )
    in_slice = sized.join(
        with_broadcast_if_small(stored(cut_slice, "mixing-slices")),
        F.col("source").eqNullSafe(F.col("__source")) & (F.col("__slice") == F.col("__cut_slice")),
    )
    same = in_slice.groupBy("__source", "__order").agg(F.sum("size").alias("__sum"), F.count(F.lit(1)).alias("__rows"), F.first("__left").alias("__left"))
    cut = (
        same.withColumn("__to", F.sum("__sum").over(Window.partitionBy("__source").orderBy("__order")))
        .where((F.col("__to") > F.col("__left")) & (F.col("__to") - F.col("__sum") <= F.col("__left")))
        .select(
            F.col("__source").alias("__cut_source"), F.col("__order").alias("cut_order"),
            F.floor((F.col("__left") - F.col("__to") + F.col("__sum")) / F.col("__rows")).cast("long").alias("cut_words"),
        )
    )
    return stored(
        plan.join(cut, F.col("__source").eqNullSafe(F.col("__cut_source")), "left")
        .select(F.col("__source").alias("source"), "source_size", "weight", "target", "whole", "cut_order", "cut_words"),
        "mixing-plan",
    )


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(held, size, source_size, target, whole, extra): the row itself, its words, and what is taken.

    A document is taken ``whole`` times in full, and ``extra`` words of it once more: all of
    them, none, or, for one document of a source, the part that reaches the target.

    Sources are ordered by code point with null last; a null text has no words; a source
    without words has target 0; equal rows are taken alike; no rows give no rows.
    """
    rows = documents.select(F.struct("*").alias(HELD), "source", word_count().alias("size"), seeded(seed, "doc_id", "text").alias("__order"))
    plan = mixture_plan(stored(rows.select("source", "size", "__order"), "mixing-sizes"), weights, share, max_epochs)
    plan = with_broadcast_if_small(plan.withColumnRenamed("source", "__source"))
    extra = (
        F.when(F.col("__order") < F.col("cut_order"), F.col("size"))
        .when(F.col("__order") == F.col("cut_order"), F.least("cut_words", "size"))
        .otherwise(F.lit(0).cast("long"))
    )
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("extra", extra)
        .select(HELD, "size", "source_size", "target", "whole", "extra")
    )


def taken_words(documents: DataFrame) -> DataFrame:
    """One row per document: how many of its words the mix takes, repeats counted."""
    rows = mixed(documents.select("doc_id", "source", "text"))
    taken = (F.col("whole") * F.col("size") + F.col("extra")).alias("taken")
    return rows.select(f"{HELD}.doc_id", "size", "source_size", "target", taken, f"{HELD}.source")


def mixture(documents: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``documents``: whole copies and the fractional one.

    The copy of which only a part is taken holds that many leading words of the document.
    """
    rows = mixed(documents)
    words = F.regexp_extract_all(F.col(f"{HELD}.text"), F.lit(WORD), F.lit(0))
    cut = (F.col("extra") > 0) & (F.col("extra") < F.col("size"))
    part = F.array_join(F.slice(words, F.lit(1), F.col("extra").cast("int")), " ")
    # A document without words is taken as often as its source is taken whole, at least once.
    copies = F.when(F.col("size") == 0, F.greatest("whole", F.lit(1))).otherwise(F.col("whole") + (F.col("extra") > 0).cast("long"))
    rows = rows.where(copies > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    new = F.col(HELD).withField("text", part)
    if "n_chars" in documents.columns:
        new = new.withField("n_chars", F.length(part).cast(documents.schema["n_chars"].dataType))
    return released(rows.withColumn(HELD, F.when(cut & (F.col("__copy") > F.col("whole")), new).otherwise(F.col(HELD))))
