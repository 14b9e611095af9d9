"""Exact top-k search by a vector-approximation file.

Every component of a vector is quantised to one of 256 cells of its dimension, so that the file has
a byte per component. Cells hold about equally many values of a sample, so that outliers widen
only the outermost ones. Blocks of queries scan blocks of cells for bounds of the inner product;
what can't reach the kth best lower bound leaves. Exact vectors are then read in the order of
the bounds: the k most promising of each query first, and after those only vectors whose upper
bound reaches the kth exact score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import parts, stored

K = 5
SCALE = 256
CELLS = 256
# Rows of one block of cells and of one block of queries.
FILE_BLOCK, QUERY_BLOCK = 4096, 256
# Vectors the cells' edges are taken from; they only make bounds tighter, never change a result.
SAMPLE_ROWS = 1024
EXACT = float(2**53)
MOST, LEAST = 2**63 - 1, -(2**63)
# Room for rounding of a bound, relative to the sum of its terms' sizes.
ROOM = 1e-12


def integer_vectors(table: DataFrame, id_column: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v, row): floor(scale * x) of each component, as whole doubles, of the vectors that take part.

    Null vectors, those with null or non-finite components or none at all, and null ids take
    no part. Rows equal in id and vector count once.
    """
    values = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(scale)))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = table.where(F.col(id_column).isNotNull() & (F.size(vector) > 0)).where(finite)
    # Doubles of 2^53 and above are whole, and too large for a long.
    whole = F.transform(values, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), whole.alias("v")).dropDuplicates(["id", "v"])
    return rows.withColumn("row", F.xxhash64("id", "v"))


def cell_edges(vectors: DataFrame) -> tuple[dict[int, np.ndarray], float, float]:
    """Per length of vector the inner edges of each dimension's cells, and the least and most component of all."""
    ends = vectors.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    sample: dict[int, list] = {}
    for r in vectors.orderBy("row", "id").limit(SAMPLE_ROWS).select("v").collect():
        sample.setdefault(len(r["v"]), []).append(r["v"])
    shares = np.arange(1, CELLS) / CELLS
    return {dim: np.quantile(np.array(own), shares, axis=0, method="higher").T.copy() for dim, own in sample.items()}, ends["low"], ends["high"]


def _edges(edges: dict[int, np.ndarray], dim: int, low: float, high: float) -> np.ndarray:
    """Edges of all cells: a cell holds what is at its edge or above, and not above the next edge."""
    inner = edges[dim] if dim in edges else np.tile(np.linspace(low, high, CELLS + 1)[1:-1], (dim, 1))
    return np.concatenate([np.full((dim, 1), low), inner, np.full((dim, 1), high)], axis=1)


def _blocks(rows: int, cells: tuple[dict[int, np.ndarray], float, float] | None):
    """Vectors of a partition as blocks: ids, codes of the rows, components or their cells."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def block(dim: int, parts_: list) -> pa.RecordBatch:
            ids, codes, vectors = (np.concatenate(x) for x in zip(*parts_, strict=True))
            data = vectors
            if cells is not None:
                edges = _edges(cells[0], dim, cells[1], cells[2])
                data = np.stack([np.searchsorted(edges[d, 1:-1], vectors[:, d], side="right") for d in range(dim)], axis=1).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([ids.tobytes()]), pa.array([codes.tobytes()]), pa.array([data.tobytes()])],
                ["dim", "ids", "codes", "data"],
            )

        for batch in batches:
            column = batch.column(1)
            flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
            sizes = np.diff(ends)
            begin = np.cumsum(sizes) - sizes
            ids, codes = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for dim in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == dim)
                vectors = flat[begin[mine][:, None] + np.arange(dim)]
                held.setdefault(dim, []).append((ids[mine], codes[mine], vectors))
                if sum(len(x[0]) for x in held[dim]) >= rows:
                    yield block(dim, held.pop(dim))
        for dim, parts_ in held.items():
            yield block(dim, parts_)

    return emit


class _Queries:
    """A block of queries, and what can be among their k best of all cells seen so far."""

    def __init__(self, dim: int, ids: bytes, vectors: bytes, edges: np.ndarray, k: int):
        self.dim, self.k, self.edges = dim, k, edges
        self.ids, v = np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.float64).reshape(-1, dim)
        self.up, self.down = np.maximum(v, 0), np.minimum(v, 0)
        self.best = np.full((len(self.ids), k), -np.inf)
        self.found: list[tuple[np.ndarray, ...]] = []

    def see(self, ids: bytes, codes: bytes, cells: bytes) -> None:
        ids, codes = np.frombuffer(ids, np.int64), np.frombuffer(codes, np.int64)
        cell = np.frombuffer(cells, np.uint8).reshape(-1, self.dim).astype(np.int64)
        every = np.arange(self.dim)
        begin, end = self.edges[every, cell], self.edges[every, cell + 1]
        room = ROOM * ((self.up - self.down) @ np.maximum(np.abs(begin), np.abs(end)).T)
        least = self.up @ begin.T + self.down @ end.T - room
        most = self.up @ end.T + self.down @ begin.T + room
        # Scores end at the bounds of a long, which as doubles are not below them.
        least, most = (np.clip(x, float(LEAST), float(MOST)) for x in (least, most))
        own = self.ids[:, None] == ids[None, :]
        least[own], most[own] = -np.inf, -np.inf
        both = np.concatenate([self.best, least], axis=1)
        self.best = np.partition(both, -self.k, axis=1)[:, -self.k :]
        i, j = np.nonzero((most >= self.best.min(axis=1)[:, None]) & ~own)
        self.found.append((i, codes[j], ids[j], least[i, j], most[i, j]))
        if len(self.found) > 8:
            self.found = [self.left()]

    def left(self) -> tuple[np.ndarray, ...]:
        """What still reaches the kth best lower bound."""
        i, code, other, least, most = (np.concatenate(x) for x in zip(*self.found, strict=True))
        ok = most >= self.best.min(axis=1)[i]
        return i[ok], code[ok], other[ok], least[ok], most[ok]


def _scan(cells: tuple[dict[int, np.ndarray], float, float], k: int):
    """Bounds of each query block with the file blocks that follow each other; per query what can be among its k best."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(block: _Queries) -> pa.RecordBatch:
            i, code, other, least, most = block.left()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (block.ids[i], code, other, least, most)], ["query_id", "row", "id", "least", "most"])

        mine, block = None, None
        for batch in batches:
            for dim, query_ids, queries, ids, codes, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if mine != (dim, query_ids):
                    if block:
                        yield result(block)
                    mine, block = (dim, query_ids), _Queries(dim, query_ids, queries, _edges(cells[0], dim, cells[1], cells[2]), k)
                block.see(ids, codes, own)
        if block:
            yield result(block)

    return emit


def _score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole products of pairs of vectors, by Python's integers where doubles would round."""
    for batch in batches:
        scores = []
        for v, q in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            rough = sum(abs(x * y) for x, y in zip(v, q, strict=True))
            score = sum(x * y for x, y in zip(v, q, strict=True)) if rough < EXACT else sum(int(x) * int(y) for x, y in zip(v, q, strict=True))
            scores.append(min(max(int(score), LEAST), MOST))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores, pa.int64())], ["query_id", "id", "row", "score"])


def top_products(table: DataFrame, id_column: str, vector: str, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` largest inner products with rows other than its own.

    Ties go to the smaller id. Vectors are compared with those of equal length. A query with
    fewer candidates gets all of them, and one without any has no rows. Products are exact;
    those beyond the bounds of a long are its largest or smallest value.
    """
    spark = table.sparkSession
    vectors = stored(integer_vectors(table, id_column, vector, scale), "vectors")
    cells = cell_edges(vectors)
    if cells[1] is None:
        return vectors.limit(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), "id", F.lit(0).cast("long").alias("score"))
    queries = vectors.where(is_query)
    slices = parts(spark)
    schema = "dim int, ids binary, codes binary, data binary"
    file = vectors.select("id", "v", "row").mapInArrow(_blocks(FILE_BLOCK, cells), schema)
    file = file.withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int")).repartition(slices, "dim", "slice").hint("merge")
    asked = queries.select("id", "v", "row").mapInArrow(_blocks(QUERY_BLOCK, None), schema)
    # Every query block meets every file block: it is sent to each slice of the file once, and the merge
    # join shows it that slice's blocks in a row.
    asked = asked.select("dim", F.col("ids").alias("query_ids"), F.col("data").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    met = asked.repartition(slices, "dim", "slice").join(file, ["dim", "slice"]).select("dim", "query_ids", "queries", "ids", "codes", "data")
    schema = "query_id long, row long, id long, least double, most double"
    bounded = stored(met.mapInArrow(_scan(cells, k), schema).distinct(), "bounds")
    by_least = Window.partitionBy("query_id").orderBy(F.desc("least"), "id", "row")
    floor = bounded.withColumn("n", F.row_number().over(by_least)).where(F.col("n") == k).select("query_id", F.col("least").alias("floor"))
    by_most = Window.partitionBy("query_id").orderBy(F.desc("most"), "id", "row")
    possible = (
        bounded.join(floor, "query_id", "left").where(F.col("most") >= F.coalesce("floor", F.lit(float("-inf"))))
        .withColumn("place", F.row_number().over(by_most)).select("query_id", "row", "id", "most", "place")
    )
    possible = stored(possible, "possible")
    targets = queries.select(F.col("id").alias("query_id"), F.col("v").alias("q"))

    def read(pairs: DataFrame) -> DataFrame:
        found = pairs.join(vectors.select("row", "v"), "row").join(targets, "query_id").select("query_id", "id", "row", "v", "q")
        return found.mapInArrow(_score_batches, "query_id long, id long, row long, score long")

    first = stored(read(possible.where(F.col("place") <= k)), "first")
    certain = first.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    later = possible.where(F.col("place") > k).join(certain, "query_id").where((F.col("n") < k) | (F.col("most") >= F.col("kth")))
    scores = first.unionByName(read(later.select("query_id", "row", "id")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id", "row")
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def nearest(embeddings: DataFrame) -> DataFrame:
    found = top_products(embeddings, "vec_id", "embedding", F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
