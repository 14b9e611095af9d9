"""Pattern packing by non-negative least squares.

Documents become token pieces; only the histogram of piece lengths, which has at most
``MAX_TOKENS`` entries however large the corpus is, goes to the driver. There patterns of a few
lengths that fill a sequence get repeat counts that fit the histogram best, rounded down to
what is there, and residual lengths go to the fullest place that has room. The plan says
which ranks of a length go where, and pieces look up their place by length and rank.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.llm.common import map_batches, parts, seeded, stored

MAX_TOKENS = 4096
END_ID = 1
# Lengths are grouped in so many classes for the fit; a pattern has at most PATTERN documents.
CLASSES = 128
PATTERN = 4
REMEMBERED = 400_000
SEED = 30

_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
# Longer stretches are not remembered, so that a count of them bounds their bytes.
LONGEST = 64
# Words encoded in one call.
TOGETHER = 1000


class WordIds(dict):
    """Little-endian ids of space-free stretches of text.

    The tokenizer drops white space after splitting at it, so stretches are independent of
    each other. Plain words are looked up without case and without the marks behind them; those
    a text has and nobody remembers are encoded in one call.
    """

    _loaded: dict[str, WordIds] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # For words of lower-case letters alone, which the normalizer wouldn't change.
        self.normal = Tokenizer.from_file(path)
        self.normal.normalizer = None
        self.plain: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each of some plain words in lower case, all of which are one word to the tokenizer."""
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            found = self.normal.encode(" ".join(some), add_special_tokens=False)
            ends = 4 * np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(some) + 1))
            every, ends = np.array(found.ids, "<u4").tobytes(), ends.tolist()
            yield from (every[i:j] for i, j in zip(ends, ends[1:], strict=False))

    def _plain(self, words: set[str]) -> dict[str, bytes]:
        """Ids of plain words in lower case."""
        found = {word: self.plain.get(word) for word in words}
        new = [word for word, ids in found.items() if ids is None]
        for word, ids in zip(new, self._encode_words(new), strict=True):
            found[word] = ids
            if len(self.plain) < REMEMBERED and len(word) <= LONGEST:
                self.plain[word] = ids
        return found

    def _learned(self, words: set[str]) -> dict[str, bytes]:
        """Ids of stretches that aren't remembered; they are from now on if there is room."""
        matches = {word: _PLAIN.fullmatch(word) for word in words}
        plain = self._plain({match[1].lower() for match in matches.values() if match})
        found = {}
        for word, match in matches.items():
            if match is None:
                found[word] = self.encode(word)
            else:
                found[word] = plain[match[1].lower()] + (self[match[2]] if match[2] else b"")
            if len(self) < REMEMBERED and len(word) <= LONGEST:
                self[word] = found[word]
        return found

    def __missing__(self, word: str) -> bytes:
        return self._learned({word})[word]

    @classmethod
    def of(cls, path: str) -> WordIds:
        """The worker's own, kept from task to task, so that words are learned once."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.get, words))
        if None in found:
            new = self._learned({word for word, ids in zip(words, found, strict=True) if ids is None})
            found = [new[word] if ids is None else ids for word, ids in zip(words, found, strict=True)]
        return b"".join(found)


def _piece_batches(path: str, max_tokens: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            source, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                every = words.ids(text or "") + end
                for k, at in enumerate(range(0, len(every), 4 * max_tokens)):
                    part = every[at : at + 4 * max_tokens]
                    source.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    ids.append(part if with_ids else None)
            columns = [
                batch.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return cut


def pieces(documents: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): documents cut only beyond ``max_tokens``.

    ``ids`` holds little-endian 32-bit ids if asked for. A null text is empty: its one piece
    is the end id.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary"
    return map_batches(documents.select("doc_id", "text"), _piece_batches(tokenizer, max_tokens, with_ids), schema)


def patterns(classes: int, most: int = PATTERN) -> np.ndarray:
    """All ways to fill a sequence with up to ``most`` lengths, as counts per class (columns)."""
    found: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(chosen)
        elif len(chosen) < most:
            top = min(left, chosen[-1] if chosen else left)
            for size in range(top, 0, -1):
                if size * (most - len(chosen)) >= left:
                    extend((*chosen, size), left - size)

    extend((), classes)
    table = np.zeros((classes, len(found)))
    for k, chosen in enumerate(found):
        for size in chosen:
            table[size - 1, k] += 1
    return table


def nonnegative_least_squares(table: np.ndarray, goal: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """The x >= 0 with least |table @ x - goal|, by the active-set method of Lawson and Hanson."""
    n = table.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    scale = max(float(np.abs(goal).max(initial=0.0)), 1.0)
    for _ in range(rounds):
        gradient = table.T @ (goal - table @ x)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            trial = np.linalg.lstsq(table[:, chosen], goal, rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[chosen] = trial
                break
            low = trial <= 0
            held = x[chosen]
            step = np.min(held[low] / np.maximum(held[low] - trial[low], 1e-300))
            held = held + step * (trial - held)
            x[:] = 0
            x[chosen] = np.where(held > 1e-12 * scale, held, 0)
            active[chosen[x[chosen] <= 0]] = False
            if not active.any():
                break
    return x


@dataclass
class Plan:
    """Sequences in groups alike: how many, and the lengths each holds, in order."""

    max_tokens: int
    groups: list[tuple[int, tuple[int, ...]]] = field(default_factory=list)

    def slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per run of ranks of a length: its first (length, rank) as a key, sequence, offset."""
        ranks: dict[int, int] = {}
        rows, first = [], 0
        for count, lengths in self.groups:
            offset = 0
            for length in lengths:
                rank = ranks.get(length, 0)
                rows.append(((length << 44) + rank, first, offset))
                ranks[length] = rank + count
                offset += length
            first += count
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 3)
        return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()

    @property
    def sequences(self) -> int:
        return sum(count for count, _ in self.groups)


def _draw(store: dict[int, int], count: int) -> list[tuple[int, int]]:
    """Runs (length, how many) of the ``count`` longest lengths of a class."""
    drawn = []
    while count:
        length = max(store)
        some = min(count, store[length])
        drawn.append((length, some))
        count -= some
        if some == store[length]:
            del store[length]
        else:
            store[length] -= some
    return drawn


def _aligned(drawn: list[list[tuple[int, int]]]) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Sequences made of one length from each list, as runs that are alike."""
    drawn = [list(x) for x in drawn]
    while drawn[0]:
        some = min(x[0][1] for x in drawn)
        yield some, tuple(sorted((x[0][0] for x in drawn), reverse=True))
        for x in drawn:
            length, left = x[0]
            x[0] = (length, left - some)
            if left == some:
                x.pop(0)


def plan_packing(histogram: dict[int, int], max_tokens: int = MAX_TOKENS, classes: int = CLASSES, most: int = PATTERN) -> Plan:
    """Pack a histogram of lengths: fitted patterns first, then best fit for what is left."""
    classes = min(classes, max_tokens)
    width = max_tokens / classes
    stores: list[dict[int, int]] = [{} for _ in range(classes)]
    for length, count in histogram.items():
        stores[int(np.ceil(length / width)) - 1][length] = count
    have = np.array([sum(s.values()) for s in stores])
    table = patterns(classes, most)
    repeats = np.floor(nonnegative_least_squares(table, have.astype(float)) + 1e-6).astype(np.int64)
    open_groups: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    rooms: list[int] = []

    def put(count: int, lengths: tuple[int, ...]) -> None:
        room = max_tokens - sum(lengths)
        if room not in open_groups:
            open_groups[room] = []
            insort(rooms, room)
        open_groups[room].append((count, lengths))

    for k in np.argsort(-repeats, kind="stable"):
        used = np.flatnonzero(table[:, k])
        count = min([int(repeats[k]), *(int(have[c] // table[c, k]) for c in used)])
        if count > 0:
            lists = []
            for c in used:
                for _ in range(int(table[c, k])):
                    lists.append(_draw(stores[c], count))
                    have[c] -= count
            for some, lengths in _aligned(lists):
                put(some, lengths)
    rest = sorted(((length, count) for s in stores for length, count in s.items()), reverse=True)
    for length, count in rest:
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fill = min(max_tokens // length, count)
                put(count // fill, (length,) * fill)
                count %= fill
                continue
            room = rooms[at]
            held, lengths = open_groups[room].pop()
            if not open_groups[room]:
                del open_groups[room]
                rooms.pop(at)
            some = min(held, count)
            if held > some:
                put(held - some, lengths)
            put(some, (*lengths, length))
            count -= some
    return Plan(max_tokens, [g for room in sorted(open_groups) for g in open_groups[room]])


def _ranked(rows: DataFrame, histogram: DataFrame, total: int) -> DataFrame:
    """Add ``rank``, from 0 inside each length; a frequent length is numbered slice by slice."""
    spark = rows.sparkSession
    per_slice = max(1, total // (4 * parts(spark)))
    # At most one row per length: bounded by the sequence length.
    sliced = F.broadcast(histogram.select(F.col("length").alias("__length"), F.ceil(F.col("n") / per_slice).alias("__slices")))
    rows = rows.join(sliced, F.col("length") == F.col("__length")).withColumn("__slice", F.pmod(F.col("__order"), F.col("__slices")))
    rows = rows.drop("__length", "__slices")
    counts = rows.groupBy("length", "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__slice")) - F.col("__n")
    counts = counts.select(F.col("length").alias("__length"), F.col("__slice").alias("__of"), before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy("length", "__slice").orderBy("__order", "doc_id", "piece"))
    return (
        rows.withColumn("__inside", inside)
        .join(counts, (F.col("length") == F.col("__length")) & (F.col("__slice") == F.col("__of")))
        .withColumn("rank", (F.col("__before") + F.col("__inside") - 1).cast("long"))
        .drop("__slice", "__order", "__n", "__inside", "__length", "__of", "__before")
    )


def _placing(slots):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, offset = slots.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            own = (length << 44) + rank
            at = np.searchsorted(keys, own, side="right") - 1
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(first[at] + own - keys[at]), pa.array(offset[at])], [*names, "sequence_id", "offset"]
            )

    return place


def packed(documents: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``.

    Sequences hold at most ``max_tokens`` tokens without gaps. Null texts are empty, a repeated
    row is a document of its own, equal lengths are dealt in a seeded order, and no rows give
    none. Which sequence a piece of a given length gets doesn't matter to the sequence count.
    """
    spark = documents.sparkSession
    cut = stored(pieces(documents, tokenizer, max_tokens, with_ids), "pieces")
    histogram = stored(cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in histogram.collect()}
    slots = spark.sparkContext.broadcast(plan_packing(counts, max_tokens).slots())
    keep: list[Column] = [F.col(c) for c in cut.columns if with_ids or c != "ids"]
    rows = cut.select(*keep, seeded(SEED, "doc_id", "piece", "ids_crc32").alias("__order"))
    ranked = _ranked(rows, histogram, sum(counts.values()))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    return map_batches(ranked, _placing(slots), f"{schema}, sequence_id long, offset long")
