"""Hard negatives by angular triangle filtering.

The angles of every vector to a few reference directions are stored with it. For an anchor at
angle a and a row at angle b to one direction, the angle between both lies between ``|a - b|`` and
``a + b``; over all directions that gives a cosine interval, and times both norms, with room for
rounding, bounds of the score. Only rows whose bounds overlap a window of wanted scores are
scored in integers: for the positives what can reach the kth score so far, and for the negatives
what can lie between a share of a positive's score and that score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import parts, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
# Negatives score between LOW and HIGH hundredths of the positive's score.
LOW, HIGH = 80, 100
DIRECTIONS = 12
# Vectors the directions are chosen from; they only make bounds tighter, never change a result.
SAMPLE_ROWS = 512
FILE_BLOCK, ANCHOR_BLOCK = 2048, 256
# Room for rounding: of an angle, and of a bound relative to the norms.
ANGLE_ROOM, SCORE_ROOM = 1e-7, 1e-9
EXACT = float(2**53)
MOST, LEAST = 2**63 - 1, -(2**63)
MISSING = np.iinfo(np.int64).min


def integer_rows(table: DataFrame, id_column: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """(id, label, v, row): floor(scale * x) of each component, as whole doubles, of the rows that take part.

    Null ids, labels and vectors take no part, nor do vectors without components or with null or
    non-finite ones. Rows equal in all three count once.
    """
    values = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(scale)))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = table.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & (F.size(vector) > 0)).where(finite)
    # Doubles of 2^53 and above are whole, and too large for a long.
    whole = F.transform(values, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole.alias("v")).dropDuplicates(["id", "label", "v"])
    return rows.withColumn("row", F.xxhash64("id", "label", "v"))


def reference_directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension up to ``DIRECTIONS`` unit vectors far from each other, of a sample by hash.

    Dimensions the sample misses get none here; ``_directions`` then draws seeded ones.
    """
    sample: dict[int, list] = {}
    for r in rows.orderBy("row", "id").limit(SAMPLE_ROWS).select("v").collect():
        sample.setdefault(len(r["v"]), []).append(r["v"])
    chosen = {}
    for dim, vectors in sample.items():
        units = np.array([u for u in (_unit(np.array(v)) for v in vectors) if u.any()])
        picked: list[int] = []
        nearest = np.full(len(units), -1.0)
        while len(units) and len(picked) < DIRECTIONS and nearest.min() < 1 - 1e-9:
            picked.append(int(np.argmin(nearest)))
            nearest = np.maximum(nearest, units @ units[picked[-1]])
        if picked:
            chosen[dim] = units[picked]
    return chosen


def _unit(vector: np.ndarray) -> np.ndarray:
    largest = np.abs(vector).max()
    if not largest:
        return vector
    vector = vector / largest
    return vector / np.sqrt(vector @ vector)


def _directions(chosen: dict[int, np.ndarray], dim: int) -> np.ndarray:
    if dim not in chosen:
        drawn = np.random.default_rng(dim).normal(size=(min(DIRECTIONS, dim), dim))
        chosen[dim] = drawn / np.sqrt((drawn * drawn).sum(axis=1, keepdims=True))
    return chosen[dim]


BLOCK_SCHEMA = "dim int, ids binary, rows binary, labels binary, vectors binary, norms binary, angles binary, wanted binary"


def _blocks(most: int, chosen: dict[int, np.ndarray]):
    """Rows of a partition as blocks with norms and angles; ``wanted`` holds positives' ids and scores, if there are any."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def block(dim: int, own: list[tuple]) -> pa.RecordBatch:
            ids, rows, labels, vectors, wanted = zip(*own, strict=True)
            v = np.stack(vectors)
            largest = np.maximum(np.abs(v).max(axis=1), 1.0)
            scaled = v / largest[:, None]
            norms = np.sqrt((scaled * scaled).sum(axis=1))
            cosines = (scaled @ _directions(chosen, dim).T) / np.maximum(norms, 1e-300)[:, None]
            columns = [
                np.array(ids, np.int64), np.array(rows, np.int64), np.array(labels, np.int64), v, norms * largest,
                np.arccos(np.clip(cosines, -1, 1)), np.array(wanted, np.int64),
            ]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *[pa.array([c.tobytes()]) for c in columns]], BLOCK_SCHEMA.replace(" binary", "").replace(" int", "").split(", "))

        for batch in batches:
            ids, rows, labels = (batch.column(k).to_numpy() for k in range(3))
            flat, ends = batch.column(3).flatten().to_numpy(), batch.column(3).offsets.to_numpy()
            ends = ends - ends[0]
            wanted = batch.column(4).to_pylist() if batch.num_columns > 4 else [()] * batch.num_rows
            for k in range(batch.num_rows):
                v = flat[ends[k] : ends[k + 1]]
                own = held.setdefault(len(v), [])
                own.append((ids[k], rows[k], labels[k], v, wanted[k]))
                if len(own) >= most:
                    yield block(len(v), held.pop(len(v)))
        for dim, own in held.items():
            yield block(dim, own)

    return emit


class Block:
    """A block read back."""

    def __init__(self, dim: int, ids: bytes, rows: bytes, labels: bytes, vectors: bytes, norms: bytes, angles: bytes, wanted: bytes) -> None:
        self.ids, self.rows, self.labels = (np.frombuffer(x, np.int64) for x in (ids, rows, labels))
        n = len(self.ids)
        self.v = np.frombuffer(vectors, np.float64).reshape(n, dim)
        self.norms = np.frombuffer(norms, np.float64)
        self.angles = np.frombuffer(angles, np.float64).reshape(n, -1)
        self.wanted = np.frombuffer(wanted, np.int64).reshape(n, -1)
        self.largest = float(np.abs(self.v).max())

    def bounds(self, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """Least and most possible score of each own row with each of the other block, rounded outwards."""
        least = np.zeros((len(self.ids), len(other.ids)))
        most = np.full(least.shape, np.pi)
        for a, b in zip(self.angles.T[:, :, None], other.angles.T[:, None, :], strict=True):
            np.maximum(least, np.abs(a - b), out=least)
            total = a + b
            np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
        scale = self.norms[:, None] * other.norms[None, :]
        room = scale * SCORE_ROOM + 1
        high = np.cos(np.maximum(least - 2 * ANGLE_ROOM, 0)) * scale + room
        low = np.cos(np.minimum(most + 2 * ANGLE_ROOM, np.pi)) * scale - room
        # Scores end at the bounds of a long, which as doubles are not below them.
        return np.clip(low, float(LEAST), float(MOST)), np.clip(high, float(LEAST), float(MOST))

    def scores(self, other: Block, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Whole products of the chosen rows; Python's integers where doubles would round."""
        dim = self.v.shape[1]
        if self.largest * other.largest * dim < EXACT:
            return (self.v[mine] @ other.v[theirs].T).astype(np.int64)
        whole = [np.array([[int(x) for x in v] for v in b.v[k]], object).reshape(-1, dim) for b, k in ((self, mine), (other, theirs))]
        return np.clip(whole[0] @ whole[1].T, LEAST, MOST)


class Best:
    """The ``k`` best (score, id) of so many lists."""

    def __init__(self, lists: int, k: int) -> None:
        self.k = k
        self.own: list[list[tuple[int, int]]] = [[] for _ in range(lists)]
        self.floor = np.full(lists, -np.inf)

    def add(self, which: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            kth = np.sort(scores)[-self.k]
            scores, ids = scores[scores >= kth], ids[scores >= kth]
        found = [(-int(s), int(i)) for s, i in zip(scores, ids, strict=True)]
        self.own[which] = sorted(self.own[which] + found)[: self.k]
        if len(self.own[which]) == self.k:
            # Scores beyond 2^53 round; one step down keeps the floor safe.
            self.floor[which] = np.nextafter(float(-self.own[which][-1][0]), -np.inf)


def _positives(k: int):
    """Per anchor the k best rows of its label, of the blocks that one task sees in a row."""

    def search(anchors: Block, blocks: Iterator[Block]) -> Iterator[tuple]:
        best = Best(len(anchors.ids), k)
        for block in blocks:
            _, high = anchors.bounds(block)
            possible = (anchors.labels[:, None] == block.labels[None, :]) & (anchors.ids[:, None] != block.ids[None, :])
            possible &= high >= best.floor[:, None]
            mine, theirs = np.flatnonzero(possible.any(axis=1)), np.flatnonzero(possible.any(axis=0))
            scores = anchors.scores(block, mine, theirs)
            for a, line in zip(mine.tolist(), scores, strict=True):
                ok = possible[a, theirs]
                best.add(a, line[ok], block.ids[theirs][ok])
        for a, own in enumerate(best.own):
            for score, other in own:
                yield int(anchors.ids[a]), int(anchors.rows[a]), 0, 0, other, -score

    return search


def _negatives(k: int, low: int, high: int):
    """Per anchor and positive the k best rows of other labels inside the positive's window."""

    def search(anchors: Block, blocks: Iterator[Block]) -> Iterator[tuple]:
        slots = anchors.wanted.shape[1] // 2
        ids, wanted = anchors.wanted[:, :slots], anchors.wanted[:, slots:]
        real = wanted != MISSING
        best = Best(len(anchors.ids) * slots, k)
        # Windows as doubles, a step wider on both sides.
        start = np.where(real, np.nextafter(wanted * (low / 100), -np.inf) - 1, np.inf)
        end = np.where(real, np.nextafter(wanted * (high / 100), np.inf) + 1, -np.inf)
        for block in blocks:
            least, most = anchors.bounds(block)
            differ = anchors.labels[:, None] != block.labels[None, :]
            differ &= anchors.ids[:, None] != block.ids[None, :]
            possible = np.zeros(differ.shape, bool)
            floor = best.floor.reshape(-1, slots)
            for s in range(slots):
                possible |= (most >= np.maximum(start[:, s], floor[:, s])[:, None]) & (least <= end[:, s, None])
            possible &= differ
            mine, theirs = np.flatnonzero(possible.any(axis=1)), np.flatnonzero(possible.any(axis=0))
            scores = anchors.scores(block, mine, theirs)
            if scores.dtype != object and np.abs(scores).max(initial=0) > MOST // 100:
                scores = scores.astype(object)
            for a, line in zip(mine.tolist(), scores, strict=True):
                able = np.flatnonzero(possible[a, theirs])
                values, others = line[able], block.ids[theirs][able]
                for s in np.flatnonzero(real[a]).tolist():
                    score = int(wanted[a, s])
                    ok = ((100 * values >= low * score) & (100 * values <= high * score)).astype(bool)
                    if ok.any():
                        best.add(a * slots + s, values[ok], others[ok])
        for at, own in enumerate(best.own):
            a, s = divmod(at, slots)
            for score, other in own:
                yield int(anchors.ids[a]), int(anchors.rows[a]), int(ids[a, s]), int(wanted[a, s]), other, -score

    return search


FOUND = "anchor long, row long, positive long, positive_score long, id long, score long"


def _searched(search):
    """Run ``search`` on the file blocks that follow each other for one block of anchors."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[list, list]]:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for line in zip(*columns, strict=True):
                    yield line[:8], line[8:]

        coming = pairs()
        following = next(coming, None)
        while following is not None:
            mine = following[0]

            def own() -> Iterator[Block]:
                nonlocal following
                while following is not None and following[0][2] == mine[2] and following[0][1] == mine[1]:  # noqa: B023
                    yield Block(*following[1])
                    following = next(coming, None)

            found = list(search(Block(*mine), own()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], [c.split()[0] for c in FOUND.split(", ")])

    return emit


def _met(anchors: DataFrame, file: DataFrame, slices: int, search) -> DataFrame:
    """Every block of anchors meets every file block of its dimension, slice by slice.

    The merge join streams the anchors' side, so that one task sees a slice's blocks in a row. The number
    of partitions is stated: by their bytes, which tell little of the work, they would be merged.
    """
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
    asked = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")).repartition(slices, "dim", "slice")
    theirs = file.select(*[F.col(c).alias(f"file_{c}") for c in names], F.col("slice").alias("file_slice")).repartition(slices, "file_dim", "file_slice").hint("merge")
    joined = asked.join(theirs, (F.col("dim") == F.col("file_dim")) & (F.col("slice") == F.col("file_slice")))
    return joined.select(*names, *[f"file_{c}" for c in names]).mapInArrow(_searched(search), FOUND)


def hard_negatives(
    table: DataFrame, id_column: str, vector: str, label: str, is_anchor: Column,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of floor(scale * x). Anchors are the rows where ``is_anchor``, on
    column ``id``, holds. An anchor's positives are its best rows of the same label, its negatives for
    a positive the best rows of other labels with scores of ``low`` to ``high`` hundredths of the
    positive's; ties go to the smaller id. Rows of the anchor's own id take no part, and only
    vectors of equal length are compared. An anchor without positives, and a positive without
    negatives, have no rows; repeated rows count once; an empty table gives none. Scores are exact;
    those beyond the bounds of a long are its largest or smallest value.
    """
    spark = table.sparkSession
    rows = stored(integer_rows(table, id_column, vector, label, scale), "angular-rows")
    chosen = reference_directions(rows)
    slices = parts(spark)
    file = rows.select("id", "row", "label", "v").mapInArrow(_blocks(FILE_BLOCK, chosen), BLOCK_SCHEMA)
    file = stored(file.withColumn("slice", F.pmod(F.xxhash64("rows"), F.lit(slices)).cast("int")), "angular-file")
    anchors = rows.where(is_anchor).select("id", "row", "label", "v")
    blocks = anchors.mapInArrow(_blocks(ANCHOR_BLOCK, chosen), BLOCK_SCHEMA)
    best = Window.partitionBy("anchor", "row").orderBy(F.desc("score"), "id")
    ranked = _met(blocks, file, slices, _positives(positives)).withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    # At most ``positives`` of each anchor.
    wanted = ranked.groupBy("anchor", "row").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("own"))
    missing = F.array_repeat(F.lit(MISSING).cast("long"), F.lit(positives) - F.size("own"))
    padded = [part for field in ("own.id", "own.score") for part in (F.col(field), missing)]
    wanted = stored(wanted.select(F.col("anchor").alias("id"), "row", F.concat(*padded).alias("wanted")), "angular-positives")
    asked = anchors.join(wanted, ["id", "row"]).select("id", "row", "label", "v", "wanted").mapInArrow(_blocks(ANCHOR_BLOCK, chosen), BLOCK_SCHEMA)
    found = _met(asked, file, slices, _negatives(negatives, low, high))
    best = Window.partitionBy("anchor", "row", "positive").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def embeddings_negatives(embeddings: DataFrame) -> DataFrame:
    """The negatives of every hundredth embedding; where the id is divisible by 7 the label moves on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(rows, "vec_id", "embedding", "label", F.col("id") % 100 == 0)
