"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles, equal sets are folded into one node, and each node
gets ``COORDINATES`` min-hash tokens, of which two sets share a share equal to their Jaccard
similarity. A run starts with all nodes in one bucket and splits buckets recursively: each
bucket samples 1/0.8 token positions on average, and nodes with equal tokens there go to a
child bucket together. Small buckets, and those that splitting hardly makes smaller, are
compared by brute force on the tokens, with a margin that keeps pairs at the threshold. Runs
are repeated until a pair at the threshold meets with probability of at least
``TARGET_RECALL`` even if its buckets are split ``DEPTH`` times. What met is verified exactly
on the full shingle sets.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import Words, binary, grams, map_batches, mixed, parts, stored, text_key
from lakeaudit.llm.components import components
from lakeaudit.llm.rows import held, released

SHINGLE = 5
# The threshold as a fraction, so that the verification is exact.
SIMILAR = (4, 5)
COORDINATES = 128
TARGET_RECALL = 0.999
# Share of the paths that sample a second position.
SECOND = 1 / 4
# Buckets of at most this many nodes are compared by brute force.
SMALL = 128
# Buckets still larger at this depth are compared block by block, in blocks of about BLOCK nodes.
DEPTH = 6
BLOCK = 1024
# Verification blocks: expected shingles and nodes of one.
BLOCK_SHINGLES, BLOCK_NODES = 200_000, 400
# Standard deviations of the token estimate by which a pair may miss the threshold.
MARGIN = 4.0

_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 2**32, COORDINATES, np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 2**32, COORDINATES, np.uint64).astype(np.uint32)


def run_recall(similar: float, depth: int) -> float:
    """Probability that a pair with this share of equal tokens still shares a path after ``depth`` splits.

    The two positions of a path differ, which makes the true value a little higher.
    """
    lost = 0.0
    for _ in range(depth):
        child = 1 - similar + similar * lost
        lost = child * (1 - SECOND + SECOND * child)
    return 1 - lost


def recall(runs: int, similar: float = SIMILAR[0] / SIMILAR[1]) -> float:
    """Probability that a similar pair meets in one of the runs, which all have the same tokens.

    The mean over its count of equal tokens, of which it needs ``least_equal``.
    """
    counts = range(least_equal(similar), COORDINATES + 1)
    shares = [math.comb(COORDINATES, k) * similar**k * (1 - similar) ** (COORDINATES - k) for k in counts]
    return sum(p * (1 - (1 - run_recall(k / COORDINATES, DEPTH)) ** runs) for k, p in zip(counts, shares, strict=True))


def runs_for(target: float = TARGET_RECALL, once: float | None = None) -> int:
    """Runs after which a pair is found with ``target``, at the threshold or with probability ``once`` in each run."""
    if once is not None:
        return math.ceil(math.log(1 - target) / math.log(1 - once))
    if recall(10**6) < target:
        raise ValueError(f"no number of runs finds {target} of the pairs")
    return next(runs for runs in itertools.count(1) if recall(runs) >= target)


def least_equal(similar: float = SIMILAR[0] / SIMILAR[1]) -> int:
    """Equal tokens that a similar pair has but for ``MARGIN`` standard deviations."""
    return math.floor(COORDINATES * (similar - MARGIN * math.sqrt(similar * (1 - similar) / COORDINATES)))


def shingles(text: bytes, words: Words) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer than five words is one shingle."""
    hashes = words.hashes(text.split())
    if not len(hashes):
        return hashes
    return np.unique(grams(hashes, min(SHINGLE, len(hashes))))


def node_of(shingle_set: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingle_set.tobytes()) - 2**63


def tokens(shingle_set: np.ndarray) -> np.ndarray:
    """The least value of each of the coordinates' permutations of 32-bit hashes."""
    low = (shingle_set >> np.uint64(32)).astype(np.uint32)
    best = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 256):
        part = low[at : at + 256, None] * _FACTORS + _SHIFTS
        np.minimum(best, part.min(axis=0), out=best)
    return best


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in batches:
        nodes, sizes, sketches = [], [], []
        for text in binary(batch.column(2)):
            found = shingles(text, words)
            nodes.append(node_of(found) if len(found) else None)
            sizes.append(len(found))
            sketches.append(tokens(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())],
            ["doc_id", "key", "node", "n_shingles", "sketch"],
        )


def sketched(documents: DataFrame) -> DataFrame:
    """(doc_id, key, node, n_shingles, sketch) per row; no node for a text without words."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    return map_batches(rows, _sketch_batches, "doc_id long, key string, node long, n_shingles long, sketch binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _children(paths: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and child paths: one sampled position of each path, and a second of every fourth."""
    draw = mixed(paths + np.uint64(1))
    first = (draw % np.uint64(COORDINATES)).astype(np.int64)
    second = (first + 1 + ((draw >> np.uint64(20)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    twice = np.flatnonzero((draw >> np.uint64(50)) % np.uint64(4) == 0)
    rows = np.concatenate([np.arange(len(paths)), twice])
    at = np.concatenate([first, second[twice]])
    token = sketch[rows, at].astype(np.uint64)
    child = mixed(paths[rows] ^ mixed(token * np.uint64(COORDINATES) + at.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)))
    return rows, child


def _first_split(seeds: np.ndarray):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch, nodes = _matrix(batch.column(1)), batch.column(0).to_numpy()
            for seed in seeds:
                rows, child = _children(np.full(len(nodes), seed), sketch)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(child.view(np.int64))], ["node", "path"])

    return split


def _next_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            nodes, paths = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            rows, child = _children(paths, _matrix(batch.column(2)))
            above = batch.column(3).to_numpy()[rows]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(child.view(np.int64)), pa.array(above)], ["node", "path", "above"])


def grouped_rows(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Whole groups of a sorted partition, many small ones at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut == 0 and held and held[-1].column(key)[-1].as_py() == keys[0]:
            held.append(batch)
            continue
        if cut == 0:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Which pairs join two trees, so that only those need to be told."""

    def __init__(self, size: int):
        self.tree = np.arange(size)

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs lie in different trees."""
        return self.tree[left] != self.tree[right]

    def join(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        """The pairs that joined two trees."""
        joined = []
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            a, b = sorted((int(self.tree[i]), int(self.tree[j])))
            if a != b:
                self.tree[self.tree == b] = a
                joined.append((i, j))
        return joined


def _compare_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within each bucket, edges that connect what is alike by its tokens.

    Pairs that edges connect already aren't compared again.
    """
    least = least_equal()
    for table in grouped_rows(batches, 0):
        buckets, nodes = table.column(0).to_numpy(), table.column(1).to_numpy()
        sketch = _matrix(table.column(2))
        forest, edges = _Forest(len(nodes)), []
        for apart in range(1, len(nodes)):
            rows = np.flatnonzero(buckets[apart:] == buckets[:-apart])
            if not len(rows):
                break
            rows = rows[forest.apart(rows, rows + apart)]
            for at in range(0, len(rows), 8192):
                some = rows[at : at + 8192]
                alike = some[(sketch[some] == sketch[some + apart]).sum(axis=1) >= least]
                edges += forest.join(alike, alike + apart)
        left, right = np.array(edges, np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([pa.array(nodes[left], pa.int64()), pa.array(nodes[right], pa.int64())], ["u", "v"])


def _by_key(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(parts(df.sparkSession), key).sortWithinPartitions(key)


def candidate_edges(nodes: DataFrame, runs: int | None = None) -> DataFrame:
    """Edges (u, v) between nodes (node, sketch) that met in a bucket and look alike there."""
    runs = runs or runs_for()
    seeds = mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    rows = stored(map_batches(nodes.select("node", "sketch"), _first_split(seeds), "node long, path long"), "paths")
    rows = rows.withColumn("above", F.lit(None).cast("long"))
    buckets = None
    for depth in range(1, DEPTH + 1):
        counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = stored(rows.join(counts, "path"), "buckets")
        # A bucket that kept a share as large as the threshold is one of alike nodes: splitting it on is no use.
        ends = (F.col("n") <= SMALL) | F.coalesce(F.col("n") >= F.col("above") * (SIMILAR[0] / SIMILAR[1]), F.lit(False))
        small = sized if depth == DEPTH else sized.where(ends)
        buckets = small if buckets is None else buckets.unionByName(small)
        big = sized.where(~ends).select("node", "path", "n")
        if depth == DEPTH or big.isEmpty():
            break
        rows = stored(map_batches(big.join(nodes.select("node", "sketch"), "node").select("node", "path", "sketch", "n"), _next_split, "node long, path long, above long"), "paths")
    # A bucket beyond the bound is compared as pairs of its blocks, each pair a bucket of its own.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(7), "node"), blocks)
    with_block = buckets.withColumn("blocks", blocks).withColumn("mine", mine.cast("int"))
    bucket = F.when(F.col("blocks") == 1, F.col("path")).otherwise(
        F.xxhash64("path", F.least("mine", "other"), F.greatest("mine", "other"))
    )
    dealt = with_block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(bucket.alias("bucket"), "node")
    compared = _by_key(dealt.join(nodes.select("node", "sketch"), "node").select("bucket", "node", "sketch"), "bucket")
    return map_batches(compared, _compare_buckets, "u long, v long").distinct()


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a few sets."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    common = counts[column] > 1
    places = np.cumsum(counts > 1) - 1
    column, owner = places[column[common]], owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        dense = np.zeros((len(sets), 4096), np.float32)
        dense[owner[lo:hi], column[lo:hi] - at] = 1
        total += (dense @ dense.T).astype(np.int64)
    np.fill_diagonal(total, [len(s) for s in sets])
    return total


def _verify_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links inside a block, or between two blocks, of a candidate component."""
    words = Words()
    up, down = SIMILAR
    for table in grouped_rows(batches, 0):
        groups, nodes = table.column(0).to_numpy(), table.column(1).to_numpy()
        sides, copies = table.column(2).to_numpy(), table.column(3).to_numpy()
        texts = table.column(4).cast(pa.binary()).to_pylist()
        sets: dict[int, np.ndarray] = {}
        u, v, links = [], [], []
        bounds = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1, append=groups[-1] + 1))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            members: dict[int, int] = {}
            for i in range(lo, hi):
                if int(nodes[i]) not in members:
                    found = shingles(texts[i] or b"", words)
                    # An id may stand for several texts; only the node's own counts.
                    if len(found) and node_of(found) == nodes[i]:
                        members[int(nodes[i])] = i
                        sets[i] = found
            rows = np.array(list(members.values()), np.int64)
            if len(rows) < 2:
                sets.clear()
                continue
            both = _shared([sets[i] for i in rows])
            sets.clear()
            size = np.diag(both)
            linked = down * both >= up * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(linked, False)
            if (sides[rows] >= 0).any():
                linked &= sides[rows][:, None] != sides[rows][None, :]
            weight = linked @ copies[rows]
            forest = _Forest(len(rows))
            for i in np.flatnonzero(linked.any(axis=1)).tolist():
                u.append(int(nodes[rows[i]]))
                v.append(None)
                links.append(int(weight[i]))
                others = np.flatnonzero(linked[i, :i])
                others = others[forest.apart(np.full(len(others), i), others)]
                for _, j in forest.join(np.full(len(others), i), others):
                    u.append(int(nodes[rows[i]]))
                    v.append(int(nodes[rows[j]]))
                    links.append(0)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(links, pa.int64())], ["u", "v", "links"])


def _verified(documents: DataFrame, nodes: DataFrame, candidates: DataFrame) -> DataFrame:
    """(u, v, links): edges (u, v) between linked nodes, and link counts of u where v is null."""
    members = candidates.join(nodes.select("node", "first_doc", "copies", "n_shingles"), "node")
    sizes = members.groupBy("component").agg(F.sum("n_shingles").alias("shingles"), F.count(F.lit(1)).alias("nodes"))
    blocks = F.greatest(F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("nodes") / BLOCK_NODES)).cast("int")
    dealt = (
        members.join(sizes.select("component", blocks.alias("blocks")), "component")
        .withColumn("mine", F.pmod(F.xxhash64(F.lit(9), "node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("component", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "node",
            F.when(F.col("mine") == F.col("other"), F.lit(-1)).otherwise((F.col("mine") > F.col("other")).cast("int")).alias("side"),
            "copies", "first_doc",
        )
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("first_doc"), "text")
    # The candidates grow with the corpus: they are shuffled to the texts at every size.
    rows = texts.join(stored(dealt, "verify").hint("merge"), "first_doc").select("group", "node", "side", "copies", "text")
    return map_batches(_by_key(rows, "group"), _verify_groups, "u long, v long, links long")


def near_duplicates(documents: DataFrame, runs: int | None = None) -> DataFrame:
    """(doc_id, key, class_id, n_links, n_copies) for each row of ``documents``.

    Documents are linked if their shingle sets have a Jaccard similarity of at least 0.8.
    ``class_id`` is the least id connected by links, ``n_links`` the number of other rows linked
    to the row, rows with an equal set included, and ``n_copies`` the rows with an equal set.
    ``key`` stands for the text.

    Null and blank texts have no shingles: each is a class of its own without links. Rows
    without an id get no class and no links. Repeated rows are copies. No rows give none.
    """
    rows = stored(sketched(documents.select("doc_id", "text")), "sketches")
    known = rows.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = stored(
        known.groupBy("node").agg(
            F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    candidates = components(candidate_edges(nodes, runs))
    found = stored(_verified(documents, nodes, stored(candidates, "candidates")), "links")
    links = found.where("v IS NULL").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    grouped = stored(components(found.where("v IS NOT NULL").select("u", "v")), "classes")
    least = grouped.join(nodes.select("node", "first_doc"), "node").groupBy("component").agg(F.min("first_doc").alias("least_doc"))
    figures = (
        nodes.select("node", "first_doc", "copies")
        .join(links, "node", "left")
        .join(grouped.join(least, "component").select("node", "least_doc"), "node", "left")
        .select("node", F.coalesce("least_doc", "first_doc").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "copies")
    )
    with_node = known.select("doc_id", "key", "node").join(figures, "node")
    without = rows.where("node IS NULL OR doc_id IS NULL")
    return with_node.select("doc_id", "key", "class_id", F.col("links").alias("n_links"), F.col("copies").alias("n_copies")).unionByName(
        without.select("doc_id", "key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """Documents without near duplicates: of each class the row with the least id stays."""
    kept = near_duplicates(documents).where("doc_id = class_id OR doc_id IS NULL").select("doc_id", "key").distinct()
    joined = held(documents).join(kept, F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("doc_key") == F.col("key")), "left_semi")
    # Rows equal in id and text are copies too, but for those without an id, which have no class.
    one = joined.where("doc IS NOT NULL").dropDuplicates(["doc", "doc_key"])
    return released(one.unionByName(joined.where("doc IS NULL")))
