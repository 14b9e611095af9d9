"""Substring dedup by repeated-phrase automata.

Every window of ``WINDOW`` words holds one anchor phrase of ``PHRASE`` words, picked by its
content alone, so that equal windows have the same phrase at the same place. Phrases that
occur twice or more in the corpus are confirmed first, by counting. Documents are then streamed
in shards of bounded size: each shard's confirmed phrases are compiled into an Aho-Corasick
automaton, which confirms the places in the shard's documents that the hashes found. The automata
read words as codes of two letters, so that a phrase is sixteen letters however long its words
are. Only the windows around those places are compared across the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import Words, binary, listed, map_batches, mixed, signed, stored, text_key, texts_with, window_anchors
from lakeaudit.llm.rolling import Sums

WINDOW = 20
PHRASE = 8
# Phrases of one automaton, which bounds a worker's memory.
AUTOMATON = 20_000
# Words of the documents held at once, so that many copies, which add no phrase, fill no worker.
SHARD_WORDS = 1_000_000
# Letters of a word's code.
LETTERS = 2


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _anchors(sums: Sums, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor phrase: its hash, its place, and the first and last window it stands for."""
    phrases = sums.all_of(phrase)
    at = window_anchors(phrases, window - phrase + 1)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return phrases[at[first]], at[first], first, np.append(first[1:], len(at))[: len(first)] - 1


def _with_row(documents: DataFrame) -> DataFrame:
    """(row, doc_id, text): ``row`` stands for id and text."""
    return documents.select(F.xxhash64(F.col("doc_id"), text_key()).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _phrase_batches(window: int, phrase: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            found, sizes, digests = [], [], []
            for text in binary(batch.column(2)):
                split = text.split()
                found.append(signed(_anchors(Sums(words.hashes(split)), window, phrase)[0]))
                sizes.append(len(split))
                digests.append(_digest(split))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), listed(found, pa.int64())],
                ["row", "doc_id", "n_words", "sha256", "phrases"],
            )

    return emit


def _automaton(patterns: list[str]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for pattern in patterns:
        built.add_word(pattern, len(pattern))
    built.make_automaton()
    return built


def _coded(hashes: np.ndarray) -> str:
    """A text in which each word is two letters, the upper 16 bits of its hash."""
    return (hashes >> np.uint64(48)).astype("<u2").tobytes().decode("latin-1")


def _shards(batches: Iterator[pa.RecordBatch], words: Words, window: int, phrase: int):
    """Documents in shards with the codes of their confirmed phrases.

    A shard has ``AUTOMATON`` phrases and ``SHARD_WORDS`` words at most, unless one document has more.
    """
    held, patterns, size = [], set(), 0
    for batch in batches:
        confirmed = batch.column(3).to_pylist()
        for row, doc, text, mine in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary(batch.column(2)), confirmed, strict=True):
            own_hashes = words.hashes(text.split())
            sums = Sums(own_hashes)
            hashes, places, first, last = _anchors(sums, window, phrase)
            line = _coded(own_hashes)
            known = np.isin(signed(hashes), np.array(mine, np.int64))
            own = {line[LETTERS * p : LETTERS * (p + phrase)] for p in places[known].tolist()}
            if held and (len(patterns) + len(own) > AUTOMATON or size + len(own_hashes) > SHARD_WORDS):
                yield held, list(patterns)
                held, patterns, size = [], set(), 0
            held.append((row, doc, line, sums, hashes, places, first, last))
            patterns |= own
            size += len(own_hashes)
    if held:
        yield held, list(patterns)


def _located(line: str, phrase: int, automata: list[ahocorasick.Automaton]) -> np.ndarray:
    """Which words start one of the phrases; a match between two words' codes is none."""
    ends = np.array([end for built in automata for end, _ in built.iter(line)], np.int64)
    begins = ends + 1 - LETTERS * phrase
    found = np.zeros(len(line) // LETTERS, bool)
    found[begins[begins % LETTERS == 0] // LETTERS] = True
    return found


def _mark_batches(window: int, phrase: int):
    """Per confirmed anchor: its phrase, its context, and the hashes of its windows."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for held, patterns in _shards(batches, words, window, phrase):
            automata = [_automaton(patterns[k : k + AUTOMATON]) for k in range(0, len(patterns), AUTOMATON)]
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            docs, windows = [], []
            for row, doc, line, sums, hashes, places, first, last in held:
                known = _located(line, phrase, automata)[places]
                hashes, places, first, last = hashes[known], places[known], first[known], last[known]
                # The context of an anchor is all words that its windows cover, as seen from the anchor.
                seen = (places - first) * window + (last - first)
                context = mixed(sums.of(first, last + window) ^ mixed(seen.astype(np.uint64)))
                for column, values in zip(columns, (np.full(len(first), row), signed(hashes), signed(context), first, last), strict=True):
                    column.append(values)
                docs += [doc] * len(first)
                every = signed(sums.all_of(window))
                windows += [every[a : b + 1] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            row, hashes, context, first, last = (pa.array(np.concatenate(x), pa.int64()) for x in columns)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(docs, pa.int64()), hashes, context, first, last, listed(windows, pa.int64())],
                ["row", "doc_id", "phrase", "context", "first", "last", "windows"],
            )

    return emit


def _removed_batches(window: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept_texts, removed, spans = [], [], [], []
            for text, ranges in zip(binary(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                split = text.split()
                n = len(split)
                ranges = np.array(ranges, np.int64).reshape(-1)
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, ranges >> 32, 1)
                np.add.at(edge, np.minimum((ranges & 0xFFFFFFFF) + window, n), -1)
                gone = np.cumsum(edge[:n]) > 0
                kept = [w for w, g in zip(split, gone.tolist(), strict=True) if not g]
                rows.append(n)
                removed.append(int(gone.sum()))
                kept_texts.append(b" ".join(kept))
                spans.append(_digest(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(rows, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.string()), pa.array(kept_texts, pa.binary()).cast(pa.string()),
                ],
                ["row", "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return emit


def repeated_windows(documents: DataFrame, scanned: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """(row, ranges): per document the windows that start earlier somewhere, as packed ranges of starts."""
    # The same id and text twice is one document.
    per_row = scanned.select("row", F.explode("phrases").alias("phrase"))
    counts = stored(scanned.select("row", "phrases").dropDuplicates(["row"]).select(F.explode("phrases").alias("phrase")).groupBy("phrase").agg(
        F.count(F.lit(1)).alias("n")
    ).where("n > 1").select("phrase"), "phrases")
    confirmed = per_row.join(counts, "phrase").groupBy("row").agg(F.collect_set("phrase").alias("confirmed"))
    texts = _with_row(documents)
    rows = texts_with(texts, stored(confirmed, "confirmed"), "confirmed").dropDuplicates(["row"]).select("row", F.col("doc_id").cast("long").alias("doc_id"), "text", "confirmed")
    schema = "row long, doc_id long, phrase long, context long, first long, last long, windows array<long>"
    marks = stored(map_batches(rows, _mark_batches(window, phrase), schema), "marks")
    # Marks with the same context have the same windows: the earliest stands for them.
    place = F.struct("doc_id", "row", "first")
    contexts = marks.groupBy("phrase", "context").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n"))
    per_phrase = contexts.groupBy("phrase").agg(F.count(F.lit(1)).alias("contexts"))
    standing = stored(contexts.join(per_phrase, "phrase").where("n > 1 OR contexts > 1"), "contexts")
    own = marks.join(standing, ["phrase", "context"])
    is_first = (F.col("row") == F.col("earliest.row")) & (F.col("first") == F.col("earliest.first"))
    packed = F.shiftleft(F.col("first"), 32).bitwiseOR(F.col("last"))
    whole = own.where(~is_first).select("row", packed.alias("range"))
    each = (
        own.where(is_first & (F.col("contexts") > 1))
        .select("row", "doc_id", F.posexplode("windows").alias("k", "window"), "first")
        .select("row", "doc_id", (F.col("first") + F.col("k")).alias("start"), "window")
    )
    each = stored(each, "windows")
    earliest = each.groupBy("window").agg(F.min(F.struct("doc_id", "row", "start")).alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = each.join(earliest, "window").where((F.col("row") != F.col("earliest.row")) | (F.col("start") != F.col("earliest.start")))
    single = later.select("row", F.shiftleft(F.col("start"), 32).bitwiseOR(F.col("start")).alias("range"))
    return whole.unionByName(single).groupBy("row").agg(F.collect_list("range").alias("ranges"))


def without_repeats(documents: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """(row, doc_id, n_words, n_removed, kept_sha256, kept_text) of each row of ``documents``.

    Words are removed that a window covers whose words also start earlier: in a document of
    smaller id, or earlier in the same one. ``kept_text`` has the words left, joined by one
    space, where any were removed, and is null where the text stays as it is.

    Null texts have no words; null ids come first; rows equal in id and text are one document
    and are judged alike; of rows with one id and different texts the order is by hash. Very
    long documents get as many automata as they need. No rows give none.
    """
    scanned = stored(
        map_batches(_with_row(documents), _phrase_batches(window, phrase), "row long, doc_id long, n_words long, sha256 string, phrases array<long>"), "scan"
    )
    ranges = stored(repeated_windows(documents, scanned, window, phrase), "ranges")
    texts = texts_with(_with_row(documents), ranges, "ranges").select("row", F.col("doc_id").cast("long").alias("doc_id"), "text", "ranges")
    schema = "row long, doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    changed = map_batches(texts, _removed_batches(window), schema)
    same = scanned.join(ranges.select("row"), "row", "left_anti").select(
        "row", "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha256").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text")
    )
    return same.unionByName(changed)


def repeat_report(documents: DataFrame) -> DataFrame:
    return without_repeats(documents).select("doc_id", "n_words", "n_removed", "kept_sha256")
