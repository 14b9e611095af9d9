"""Importance resampling towards a target distribution.

Runs of one to three words are hashed into buckets. How much likelier a bucket is in the target
than in the corpus gives its gain, the gains of a document's runs its weight, and seeded Gumbel
noise on the weights makes the highest scores a draw without replacement. The draw's exact
cutoff is found by weighted medians of medians: each partition names the median of the keys it
still holds, the weighted median of these is below and above guaranteed shares of all
keys, and counting on both sides of it tells which share goes. Only winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import binary, map_batches, stored
from lakeaudit.operators.paging import number_rows

LONGEST_RUN = 3
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE_PERCENT = 5
SEED = 42
# Words a task remembers with their sum; longer or further ones are summed anew each time.
REMEMBERED, REMEMBERED_BYTES = 100_000, 32

# A-Z become a-z, all other bytes below 128 but digits and a-z become spaces.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _shift_tables(bits: int = 40) -> np.ndarray:
    """For each k the effect on a checksum, by each of its bytes, of 2^k zero bytes that follow."""
    byte = np.arange(256, dtype=np.uint32)
    rest = byte
    for _ in range(8):
        rest = (rest >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (rest & np.uint32(1)))
    first = np.stack([(x >> np.uint32(8)) ^ rest[x & np.uint32(255)] for x in (byte << np.uint32(8 * j) for j in range(4))])
    tables = [first]
    while len(tables) < bits:
        tables.append(_through(tables[-1], tables[-1]))
    return np.stack(tables)


def _through(table: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return table[0][sums & 255] ^ table[1][(sums >> 8) & 255] ^ table[2][(sums >> 16) & 255] ^ table[3][sums >> 24]


class Sums(dict):
    """Checksum and length of a word as one number: length * 2^32 + crc32."""

    def __init__(self) -> None:
        super().__init__()
        self.shifts = _shift_tables()

    def __missing__(self, word: bytes) -> int:
        value = len(word) << 32 | zlib.crc32(word)
        if len(self) < REMEMBERED and len(word) <= REMEMBERED_BYTES:
            self[word] = value
        return value

    def followed(self, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Checksums moved ahead of so many bytes that follow."""
        out = sums.copy()
        for k in range(int(lengths.max(initial=0)).bit_length()):
            mine = np.flatnonzero(lengths >> k & 1)
            out[mine] = _through(self.shifts[k], out[mine])
        return out

    def run_sums(self, words: list[bytes], last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places of the first words, crc32 of the run) of all runs of 1, 2, ... words.

        ``last`` is, for each word, the end of its document among the words. The checksum of two
        parts follows from theirs: that of the first, moved by the length of the second, xor that
        of the second.
        """
        packed = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        own = (packed & 0xFFFFFFFF).astype(np.uint32)
        lengths = packed >> 32
        space = np.full(len(own), zlib.crc32(b" "), np.uint32)
        tail = self.followed(space, lengths) ^ own
        places, sums = np.arange(len(own)), own
        for width in range(1, LONGEST_RUN + 1):
            yield places, sums
            inside = places + width < last[places]
            places, sums = places[inside], sums[inside]
            following = places + width
            sums = self.followed(sums, lengths[following] + 1) ^ tail[following]


def _texts_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts, each word's text, the end of that text among the words, and words per text."""
    own = [t.translate(PLAIN).split() for t in texts]
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    text_of = np.repeat(np.arange(len(own)), sizes)
    return [w for ws in own for w in ws], text_of, np.cumsum(sizes)[text_of], sizes


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket that this task's texts fill."""
    sums, counts = Sums(), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        words, _, last, _ = _texts_words(binary(batch.column(0)))
        for _, runs in sums.run_sums(words, last):
            counts += np.bincount(runs % BUCKETS, minlength=BUCKETS)
    filled = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(counts[filled])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Runs per bucket over all texts: ``BUCKETS`` numbers, summed per task, then by Spark."""
    counted = map_batches(texts.select(text), _count_batches, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log of how much likelier each bucket is in the target, rounded down."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    gains = [math.floor(1000 * math.log(((t + 1.0) * s_all) / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array(gains, np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A thousandfold Gumbel number that depends on seed and id only; a null id is an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def _score_batches(gains: np.ndarray, seed: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            words, text_of, last, sizes = _texts_words(binary(batch.column(1)))
            weights, runs_of = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for places, runs in sums.run_sums(words, last):
                whose = text_of[places]
                # Sums stay far below 2^53.
                weights += np.bincount(whose, gains[runs % BUCKETS], len(sizes)).astype(np.int64)
                runs_of += np.bincount(whose, minlength=len(sizes))
            scores = weights + np.array([noise(d, seed) for d in batch.column(0).to_pylist()], np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(runs_of), pa.array(weights), pa.array(scores)],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return emit


def scored(documents: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    gains = bucket_gains(bucket_counts(documents), bucket_counts(target))
    return map_batches(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _score_batches(gains, seed),
        "doc_id long, n_words long, n_features long, weight long, score long",
    )


# A key orders rows: lower keys are drawn first, and no two rows share one.
KEY = ("k0", "k1", "k2", "k3", "k4")


def _marked(key: tuple[int, ...]) -> Column:
    return F.struct(*[F.lit(x).cast("long").alias(name) for name, x in zip(KEY, key, strict=True)])


def _up_to(key: tuple[int, ...]) -> Column:
    # The first part alone is a filter that reaches the scan.
    return (F.col(KEY[0]) <= key[0]) & (F.struct(*KEY) <= _marked(key))


def _above(key: tuple[int, ...]) -> Column:
    return (F.col(KEY[0]) >= key[0]) & (F.struct(*KEY) > _marked(key))


def _median_of_sides(pivot: tuple[int, ...] | None):
    """Per task and side of the pivot: how many keys, and their median. The pivot itself counts as below."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows]
        if not held:
            return
        keys = np.concatenate(held, axis=1)
        above = np.zeros(keys.shape[1], bool)
        if pivot is not None:
            equal = np.ones(keys.shape[1], bool)
            for part, mark in zip(keys, pivot, strict=True):
                above |= equal & (part > mark)
                equal &= part == mark
        for side in (False, True):
            mine = keys[:, above == side]
            if mine.shape[1]:
                order = np.lexsort(mine[::-1])
                middle = mine[:, order[(len(order) - 1) // 2]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([side]), pa.array([len(order)], pa.int64()), *[pa.array([x], pa.int64()) for x in middle]], ["above", "n", *KEY]
                )

    return emit


def weighted_median(keys: list[tuple[tuple[int, ...], int]]) -> tuple[int, ...]:
    """The least key that, with all below, carries half of the weight."""
    half, carried = sum(n for _, n in keys) / 2, 0
    for key, n in sorted(keys):
        carried += n
        if carried >= half:
            return key
    raise ValueError("no keys")


def cutoff(keyed: DataFrame, rank: int) -> tuple[int, ...] | None:
    """The key of the given rank (from 1) among rows with unique keys; None if there are fewer.

    Each round reads the keys that are left once and brings two numbered medians per task to
    the driver. At least a quarter of the keys goes in each, so the rounds grow with the
    logarithm of the rows. A task holds the keys that one of its input files has left.
    """
    schema = "above boolean, n long, " + ", ".join(f"{k} long" for k in KEY)
    low: tuple[int, ...] | None = None
    pivot: tuple[int, ...] | None = None
    high: tuple[int, ...] | None = None
    while True:
        left = keyed if low is None else keyed.where(_above(low))
        left = left if high is None else left.where(_up_to(high))
        sides: tuple[list, list] = ([], [])
        for r in left.select(*KEY).mapInArrow(_median_of_sides(pivot), schema).collect():
            sides[r["above"]].append((tuple(r[k] for k in KEY), r["n"]))
        below, above = (sum(n for _, n in side) for side in sides)
        if rank > below + above or rank < 1:
            return None
        if pivot is not None and below == 1 and rank == 1:
            return sides[0][0][0]
        if pivot is None or rank <= below:
            high, side = pivot, sides[0]
        else:
            low, side, rank = pivot, sides[1], rank - below
        pivot = weighted_median(side)


def resampled(documents: DataFrame, target: DataFrame, percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document, ranked if it is drawn.

    Of the documents with ``least_words`` words, ``percent`` in a hundred are drawn, rounded down, by the
    highest score; ties go to the smaller id, then to fewer runs. Null texts are empty, null ids
    come last among ties, repeated rows are drawn one by one, and an empty table gives no rows. Other
    columns play no part.
    """
    rows = stored(scored(documents, target, seed).withColumn("row", F.monotonically_increasing_id()), "resampled")
    able = F.col("n_words") >= least_words
    drawn = rows.where(able).count() * percent // 100
    keys = [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0)), F.col("n_features"), F.col("row")]
    keyed = rows.select("*", *[k.cast("long").alias(name) for k, name in zip(keys, KEY, strict=True)])
    last = cutoff(keyed.where(able), drawn)
    columns = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    wins = able & _up_to(last)
    ranked = number_rows(keyed.where(wins), KEY).select(*columns, F.col("row_no").cast("long").alias("rank"))
    return ranked.unionByName(keyed.where(~wins).select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn_documents(documents: DataFrame, target: DataFrame, percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The rows, with all their columns, whose id is drawn."""
    ids = resampled(documents, target, percent, least_words, seed).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__drawn")).distinct()
    return documents.join(ids, documents["doc_id"].cast("long").eqNullSafe(F.col("__drawn")), "left_semi")
