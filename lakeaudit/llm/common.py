"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.session import work_path

# Words are runs of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
# Rows of one Arrow batch, so that a batch of very long texts still fits a Python worker.
BATCH_ROWS = 500
# Words remembered with their hash by a worker; beyond that they are hashed anew each time.
REMEMBERED_WORDS = 400_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read again.

    Cuts lineage without a local checkpoint: the files survive a lost executor.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for very long texts."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def parts(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the measure of how finely to split hot keys."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_with(texts: DataFrame, rows: DataFrame, listed: str, on: str = "row") -> DataFrame:
    """Texts joined with the rows whose list ``listed`` isn't empty."""
    return texts.join(rows.where(F.size(listed) > 0), on)


def text_key(text: str = "text") -> Column:
    """128 bits that stand for a text; null and empty texts share one."""
    return F.substring(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), 1, 32)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't use, whatever extra columns it has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Words(dict):
    """Hash of each word seen, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED_WORDS and len(word) <= 64:
            self[word] = value
        return value

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# Longer words are not remembered, so that a count of words bounds their bytes.
LONGEST_REMEMBERED = 64


class Recent(dict):
    """What ``make`` gives for a word, remembered for the words met lately.

    There are at most twice ``most`` words: when the newer half is full it becomes the older one, and
    words met again move to the newer half. So rare words leave and memory stays bounded
    however many tasks a worker runs.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def make(self, word: str):
        raise NotImplementedError

    def __missing__(self, word: str):
        value = self.older.pop(word, None)
        if value is None:
            value = self.make(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


def mixed(values: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over 64 bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


BASE = np.uint64(0x9E3779B97F4A7C15)


def grams(values: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` consecutive values."""
    count = len(values) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total = total * BASE + values[k : k + count]
    return mixed(total)


def window_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the place of its smallest one, the leftmost among equals.

    Equal runs have their anchor at the same place inside the run, and places never go
    back from one run to the next.
    """
    n = len(hashes)
    if n < width:
        return np.empty(0, np.int64)
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = packed
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def binary(column: pa.Array) -> list[bytes]:
    """Texts of a batch as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def listed(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrays of one batch as a list column."""
    ends = np.cumsum([0, *(len(v) for v in values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def cover(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a window of ``width`` at one of the starts."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, length), -1)
    return np.cumsum(edge[:length]) > 0


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


# A side of a join is broadcast only when counting shows it has at most this many rows.
BROADCAST_ROWS = 10_000


def with_broadcast_if_small(df: DataFrame) -> DataFrame:
    """The hint for a stored result whose row count is checked; else the planner's own choice."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def seeded(seed: int, *columns: str) -> Column:
    """A non-negative pseudo-random long that depends on the row's values only."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def slice_of(order: Column, slices: int) -> Column:
    """Slice of a pseudo-random non-negative long: larger values never lie in an earlier slice."""
    return F.floor(F.shiftright(order, 32) * F.lit(slices) / F.lit(float(1 << 31))).cast("int")
