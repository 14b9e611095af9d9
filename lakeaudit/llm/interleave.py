"""Proportional stratified interleaving: shards that all hold the mixture of the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import parts, seeded, slice_of, stored
from lakeaudit.llm.rows import HELD

SHARDS = 16
SEED = 20


def _numbered(rows: DataFrame, group: list[str], piece: str, order: list[Column], number: str, total: str) -> DataFrame:
    """Rows numbered from 0 inside ``group`` by (piece, order), where no task gets a whole group.

    Pieces split a group; rows are numbered inside a piece and moved up by the rows of the
    pieces before it. ``total`` is the group's row count.
    """
    counts = rows.groupBy(*group, piece).agg(F.count(F.lit(1)).alias("__n"))
    inside = Window.partitionBy(*group)
    counts = counts.select(
        *[F.col(c).alias(f"__{c}") for c in (*group, piece)],
        (F.sum("__n").over(inside.orderBy(piece)) - F.col("__n")).alias("__before"),
        F.sum("__n").over(inside).alias(total),
    )
    same = [rows[c].eqNullSafe(counts[f"__{c}"]) for c in (*group, piece)]
    within = F.row_number().over(Window.partitionBy(*group, piece).orderBy(*order))
    return (
        rows.withColumn("__within", within)
        .join(counts, same)
        .withColumn(number, F.col("__before") + F.col("__within") - 1)
        .drop("__within", "__before", *[f"__{c}" for c in (*group, piece)])
    )


def interleaved_shards(rows: DataFrame, stratum: str, identity: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Put every row into one of ``shards`` shards so that each holds every stratum in proportion.

    Inside a stratum rows are ranked in a seeded random order of ``identity``; the rank as a
    share of the stratum's rows orders all rows, and that order is cut into shards whose
    row counts differ by at most one. Adds ``shard``, ``slot`` (place inside the shard, from 0)
    and replaces columns of these names.

    Null strata are one stratum, null or equal identities are ordered by what else they
    hold, repeated rows get a place each, and an empty table gives an empty result. Neither a
    hot stratum nor the whole order passes one task: both are numbered slice by slice.
    """
    slices = 4 * parts(rows.sparkSession)
    rows = rows.drop("shard", "slot")
    own = [f"__id{k}" for k in range(len(identity))]
    order = [F.col(c).asc_nulls_first() for c in own]
    rows = rows.select(
        F.struct("*").alias(HELD), F.col(stratum).alias("__stratum"), *[F.col(c).alias(o) for c, o in zip(identity, own, strict=True)],
        seeded(seed, *identity).alias("__order"),
    ).withColumn("__slice", slice_of(F.col("__order"), slices))
    ranked = _numbered(rows, ["__stratum"], "__slice", [F.col("__order"), *order], "__rank", "__stratum_rows").drop("__slice")
    share = (F.col("__rank") + 0.5) / F.col("__stratum_rows")
    placed = ranked.withColumn("__share", share).withColumn("__slice", F.floor(F.col("__share") * slices).cast("int"))
    placed = stored(placed.withColumn("__all", F.lit(0)), "interleave")
    by_share = [F.col("__share"), F.col("__stratum").asc_nulls_last(), F.col("__order"), *order]
    numbered = _numbered(placed, ["__all"], "__slice", by_share, "__place", "__rows")
    shard = F.expr(f"(__place * {shards}) div __rows")
    first = F.expr(f"(shard * __rows + {shards - 1}) div {shards}")
    return (
        numbered.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("__place") - first)
        .select(f"{HELD}.*", "shard", "slot")
    )


def sharded_documents(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Each document's shard and place by the ``rows`` law, strata being the sources."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = interleaved_shards(rows, "source", ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )
