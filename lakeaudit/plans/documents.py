"""Execution plan documents as node tables."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values -----------------------------------------------------------------
NODE = "RelOp"
PREDICATES = ("SeekPredicate", "Filter", "Predicate")
COUNTERS = "RunTimeCountersPerThread"
RED_ABOVE, AMBER_ABOVE = 0.5, 0.1
# ------------------------------------------------------------------------------

NODE_SCHEMA = (
    "plan_id long, status string, node_id long, parent_id long, physical_op string, logical_op string, "
    "cost_text string, object_name string, predicate string, actual_ms string, actual_rows string"
)
# Nodes handed back at a time.
FRAME_ROWS = 20_000
_NO_BRACKETS = str.maketrans("", "", "[]")
_FIELDS = [c.split()[0] for c in NODE_SCHEMA.split(", ")]


class _Operator:
    """An operator that is still open, with what its subtree has shown so far."""

    def __init__(self, number: int, parent: int | None, given: dict):
        self.number, self.parent, self.given = number, parent, given
        self.table: str | None = None
        self.texts: dict[str, str] = {}
        self.counters: dict | None = None

    def adopt(self, child: _Operator) -> None:
        """Take from a finished child what comes first in the document."""
        self.table = self.table or child.table
        self.counters = child.counters if self.counters is None else self.counters
        for kind, text in child.texts.items():
            self.texts.setdefault(kind, text)

    def row(self, plan_id: int) -> tuple:
        actual = self.counters or {}
        predicate = next((self.texts[k] for k in PREDICATES if self.texts.get(k)), None)
        return (
            plan_id, "ok", self.number, self.parent, self.given.get("PhysicalOp", "Operation"), self.given.get("LogicalOp", ""),
            self.given.get("EstimatedTotalSubtreeCost", "0"), self.table, predicate, actual.get("ActualElapsedms"), actual.get("ActualRows"),
        )


def _nodes(plan_id: int, text: str | None) -> list[tuple]:
    """Operators in document order, each under its nearest operator; else one stub row.

    One pass over the parse events: an operator hands what it holds to the one around
    it when it ends, so no subtree is walked twice.
    """
    stub = (None,) * (len(_FIELDS) - 2)
    if not text or not text.strip().startswith("<"):
        return [(plan_id, "no plan", *stub)]
    parser = ElementTree.XMLPullParser(("start", "end"))
    rows: list[tuple] = []
    open_ones: list[_Operator] = []
    number = 0
    try:
        parser.feed(text)
        parser.close()
        for event, element in parser.read_events():
            tag = element.tag.rpartition("}")[2]
            inner = open_ones[-1] if open_ones else None
            if event == "start":
                if tag.endswith(NODE):
                    number += 1
                    open_ones.append(_Operator(number, inner.number if inner else None, dict(element.attrib)))
                elif inner and tag == COUNTERS and inner.counters is None:
                    inner.counters = dict(element.attrib)
                elif inner and tag == "Object" and not inner.table:
                    names = [element.get(k, "").translate(_NO_BRACKETS) for k in ("Schema", "Table")]
                    inner.table = ".".join(n for n in names if n) if names[1] else None
                elif inner and tag in PREDICATES:
                    inner.texts.setdefault(tag, "".join(element.itertext()).strip())
            elif tag.endswith(NODE):
                done = open_ones.pop()
                rows.append(done.row(plan_id))
                if open_ones:
                    open_ones[-1].adopt(done)
    except ElementTree.ParseError:
        return [(plan_id, "unreadable", *stub)]
    return sorted(rows, key=lambda r: r[2]) or [(plan_id, "empty", *stub)]


def _node_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows: list[tuple] = []
        for plan_id, text in zip(batch["plan_id"], batch["plan_xml"], strict=True):
            rows += _nodes(plan_id, text)
            if len(rows) >= FRAME_ROWS:
                yield pd.DataFrame(rows, columns=_FIELDS, dtype=object)
                rows = []
        yield pd.DataFrame(rows, columns=_FIELDS, dtype=object)


def plan_nodes(plans: DataFrame, plan_id: str = "plan_id", plan_xml: str = "plan_xml") -> DataFrame:
    """One row per plan operator with its parent; a bad document gives one stub row."""
    texts = plans.select(F.col(plan_id).cast("long").alias("plan_id"), F.col(plan_xml).alias("plan_xml"))
    return texts.mapInPandas(_node_batches, NODE_SCHEMA).withColumn("cost", F.col("cost_text").try_cast("double"))


def cost_band(cost: Column) -> Column:
    """Red, amber or none; a cost that is no number has none."""
    return F.when(cost > RED_ABOVE, "red").when(cost > AMBER_ABOVE, "amber").otherwise("none")


def cost_bands(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("band", cost_band(F.col("cost")))


def operator_costs(nodes: DataFrame, limit: int = 10) -> DataFrame:
    """Operators by total cost, with their nodes in each band."""
    banded = cost_bands(nodes.where(F.col("status") == "ok"))
    total = F.sum(F.col("cost").cast("decimal(28,6)"))
    grouped = banded.groupBy("physical_op").agg(
        F.count(F.lit(1)).alias("nodes"),
        total.alias("total_cost"),
        F.count_if(F.col("band") == "red").alias("red_nodes"),
        F.count_if(F.col("band") == "amber").alias("amber_nodes"),
    )
    return grouped.orderBy(F.col("total_cost").desc(), "physical_op").limit(limit)
