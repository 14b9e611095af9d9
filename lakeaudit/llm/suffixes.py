"""Suffix-array dedup by a depth-limited radix sort.

Suffixes are ordered by most-significant-digit passes and only through ``WINDOW`` bytes; what is
equal then is a repeated window. A digit is a block of bytes, compared by a 64-bit hash, and
ordering a bucket is grouping it, since only equality matters. Suffixes alone in their
bucket leave after each pass.

Runs of neighbouring suffixes share an anchor, a place picked by content alone inside the
first ``REACH`` bytes of each window, and pass together as long as they can: the first digit
is the block every window of the anchor holds. Anchors equal in it are told apart by all bytes
their windows cover: those equal in these too are repeated with all their windows. Where a bucket
is still mixed, the next pass takes the windows in ranges of ``STEP`` places before the
anchor, whose digit is longer, as fewer windows share more bytes; ranges alone in their bucket
leave, equal ones are repeated as a whole, and only windows of ranges that are still mixed are
ordered one by one by their whole depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import BASE, binary, listed, map_batches, mixed, runs, signed, stored, text_key, texts_with, window_anchors

WINDOW = 400
# Starts among which a window's anchor is picked, and the bytes that an anchor's hash reads.
REACH = 256
GRAM = 64
# Windows of one range between the pass of anchors and that of windows.
STEP = 16
_BYTES = 8
_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


class Hashes:
    """64-bit hashes of any substrings of one text, from prefix sums of hashed 8-byte blocks."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, text: bytes):
        n = len(text) - _BYTES + 1
        if len(Hashes._powers) <= n:
            size = max(2 * n, 1 << 15)
            Hashes._powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, BASE)]))
            Hashes._inverses = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _INVERSE)]))
        raw = np.frombuffer(text, np.uint8)
        blocks = np.lib.stride_tricks.sliding_window_view(raw, _BYTES).copy().view(np.uint64).ravel()
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(mixed(blocks + BASE) * Hashes._powers[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of text[start:end] for ends at least 8 beyond their starts."""
        return mixed((self.sums[ends - _BYTES + 1] - self.sums[starts]) * Hashes._inverses[starts])


def anchored(text: bytes, window: int, reach: int, gram: int):
    """(hashes, anchors, first, last): the anchors of a text and the window starts of each."""
    hashes = Hashes(text)
    places = np.arange(len(text) - gram + 1)
    at = window_anchors(hashes.of(places, places + gram), reach)[: len(text) - window + 1]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return hashes, at[first], first, last


def _with_row(documents: DataFrame) -> DataFrame:
    return documents.select(F.xxhash64(F.col("doc_id"), text_key()).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _digit_batches(window: int, reach: int, gram: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            sizes, digests, digits, contexts = [], [], [], []
            for text in binary(batch.column(2)):
                sizes.append(len(text))
                digests.append(hashlib.sha256(text).hexdigest())
                if len(text) < window:
                    digits.append(none)
                    contexts.append(none)
                    continue
                hashes, at, first, last = anchored(text, window, reach, gram)
                digits.append(signed(hashes.of(at, at + window - reach + 1)))
                seen = (at - first) * window + (last - first)
                contexts.append(signed(mixed(hashes.of(first, last + window) ^ mixed(seen.astype(np.uint64)))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                    listed(digits, pa.int64()), listed(contexts, pa.int64()),
                ],
                ["row", "doc_id", "n_bytes", "sha256", "digits", "contexts"],
            )

    return emit


def _starts(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All places from each first to its last one."""
    counts = last - first + 1
    return np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _range_batches(window: int, reach: int, gram: int, step: int):
    """Of the listed anchors the ranges of their windows: place, digit and context of each.

    A range holds the windows that start so far before the anchor. Its digit is what all windows of a
    whole range share, its context what its own windows cover.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, marks in zip(batch.column(0).to_pylist(), binary(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                hashes, at, first, last = anchored(text, window, reach, gram)
                marks = np.array(sorted(set(marks)), np.int64)
                at, nearest, farthest = at[marks], (at[marks] - last[marks]) // step, (at[marks] - first[marks]) // step
                part = _starts(nearest, farthest)
                own = np.repeat(np.arange(len(marks)), farthest - nearest + 1)
                at, begin, end = at[own], first[marks][own], last[marks][own]
                begin, end = np.maximum(begin, at - step * part - step + 1), np.minimum(end, at - step * part)
                shared = hashes.of(at - step * part, at - step * part - step + 1 + window)
                seen = (at - begin) * window + (end - begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), row), pa.int64()), pa.array(begin << 32 | end), pa.array(signed(mixed(shared ^ mixed(part.astype(np.uint64))))),
                        pa.array(signed(mixed(hashes.of(begin, end + window) ^ mixed(seen.astype(np.uint64))))),
                    ],
                    ["row", "mark", "digit", "context"],
                )

    return emit


def _window_batches(window: int):
    """Hashes of all windows of the listed ranges."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, ranges in zip(batch.column(0).to_pylist(), binary(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                ranges = np.array(sorted(set(ranges)), np.int64)
                starts = _starts(ranges >> 32, ranges & 0xFFFFFFFF)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(starts), row), pa.int64()), pa.array(starts << 32 | starts), pa.array(signed(Hashes(text).of(starts, starts + window)))],
                    ["row", "mark", "window"],
                )

    return emit


def _removed_batches(window: int, reach: int, gram: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests, kept_texts = [], [], [], [], []
            for text, marks, ranges in zip(binary(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                marks, ranges = np.array(marks, np.int64), np.array(ranges, np.int64)
                begin, end = ranges >> 32, ranges & 0xFFFFFFFF
                if len(marks):
                    _, _, first, last = anchored(text, window, reach, gram)
                    begin, end = np.concatenate([first[marks], begin]), np.concatenate([last[marks], end])
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, begin, 1)
                np.add.at(edge, end + window, -1)
                gone = np.cumsum(edge[: len(text)]) > 0
                begins, ends = runs(gone)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                sizes.append(len(text))
                removed.append(int(gone.sum()))
                spans.append([f"{a}:{b}" for a, b in zip(begins.tolist(), ends.tolist(), strict=True)])
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array([len(x) for x in spans], pa.int64()), pa.array(digests, pa.string()), pa.array(spans, pa.list_(pa.string())),
                    pa.array(kept_texts, pa.binary()),
                ],
                ["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
            )

    return emit


def _pass(nodes: DataFrame, name: str) -> DataFrame:
    """(row, mark, n, stands) of the nodes that are not alone with their digit.

    ``n`` nodes are equal in the context as well. In a bucket with several contexts one node of each
    stands for it in the next pass. Whether there are several is known from the least and the largest, so
    that the contexts of a frequent digit need not meet in one task.
    """
    several = (F.min("context") < F.max("context")).alias("several")
    buckets = stored(nodes.groupBy("digit").agg(F.count(F.lit(1)).alias("n"), several).where("n > 1").select("digit", "several"), f"{name}-digits")
    left = stored(nodes.join(buckets, "digit"), name)
    code = F.xxhash64("row", "mark")
    contexts = left.groupBy("digit", "context").agg(F.count(F.lit(1)).alias("n"), F.min(code).alias("code"), F.max("several").alias("several"))
    sized = stored(contexts.where("n > 1 OR several"), f"{name}-contexts")
    own = left.drop("several").join(sized, ["digit", "context"])
    return stored(own.select("row", "mark", "n", (F.col("several") & (code == F.col("code"))).alias("stands")), f"{name}-own")


def repeated_suffixes(documents: DataFrame, scanned: DataFrame, window: int, reach: int, gram: int, step: int = STEP) -> DataFrame:
    """(row, marks, ranges): anchors all of whose windows are repeated, and ranges of repeated windows."""

    def texts_of(todo: DataFrame, name: str) -> DataFrame:
        listed_ = stored(todo.where("stands").groupBy("row").agg(F.collect_set("mark").alias("todo")), name)
        return texts_with(_with_row(documents).select("row", "text"), listed_, "todo").dropDuplicates(["row"]).select("row", "text", "todo")

    anchors = scanned.select("row", F.posexplode(F.arrays_zip("digits", "contexts")).alias("mark", "x")).select(
        "row", "mark", F.col("x.digits").alias("digit"), F.col("x.contexts").alias("context")
    )
    first = _pass(anchors, "anchors")
    schema = "row long, mark long, digit long, context long"
    ranges = stored(map_batches(texts_of(first, "todo"), _range_batches(window, reach, gram, step), schema), "ranges")
    second = _pass(ranges, "ranges")
    each = stored(map_batches(texts_of(second, "todo-ranges"), _window_batches(window), "row long, mark long, window long"), "windows")
    again = stored(each.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window"), "windows-again")
    single = each.join(again, "window").select("row", "mark").unionByName(second.where("n > 1").select("row", "mark"))
    none = F.array().cast("array<long>")
    whole = first.where("n > 1").groupBy("row").agg(F.collect_set("mark").alias("marks"))
    parts = single.groupBy("row").agg(F.collect_set("mark").alias("ranges"))
    both = whole.join(parts, "row", "full").select("row", F.coalesce(F.col("marks").cast("array<long>"), none).alias("marks"), F.coalesce("ranges", none).alias("ranges"))
    return both.withColumn("places", F.concat("marks", "ranges"))


def without_repeats(documents: DataFrame, window: int = WINDOW, reach: int = REACH, gram: int = GRAM) -> DataFrame:
    """(row, doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) of each row.

    Bytes are removed that a ``window``-byte string covers which also starts anywhere else.
    ``spans`` lists the maximal removed runs as start:end, ``kept`` has the bytes left; both
    are null where nothing is removed.

    Null texts are empty; texts shorter than the window stay. Every row is a document, so
    a repeated row is a copy of the other, and both lose what they share. No rows give none.
    """
    scanned = stored(
        map_batches(
            _with_row(documents), _digit_batches(window, reach, gram),
            "row long, doc_id long, n_bytes long, sha256 string, digits array<long>, contexts array<long>",
        ),
        "suffixes",
    )
    found = stored(repeated_suffixes(documents, scanned, window, reach, gram), "repeats")
    texts = texts_with(_with_row(documents), found, "places").select("row", F.col("doc_id").cast("long").alias("doc_id"), "text", "marks", "ranges")
    schema = "row long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<string>, kept binary"
    changed = map_batches(texts, _removed_batches(window, reach, gram), schema)
    zero = F.lit(0).cast("long")
    same = scanned.join(found.select("row"), "row", "left_anti").select(
        "row", "doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha256").alias("kept_sha256"),
        F.lit(None).cast("array<string>").alias("spans"), F.lit(None).cast("binary").alias("kept"),
    )
    return same.unionByName(changed)


def repeat_report(documents: DataFrame) -> DataFrame:
    return without_repeats(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
