"""Quality rules by cross-document line frequency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.llm.common import Words, binary, cover, grams, listed, map_batches, stored, text_key, with_broadcast_if_small
from lakeaudit.llm.rows import HELD, held, released

# A line is boilerplate of a host beyond this many of its distinct texts, or this share of them.
LEAST_DOCUMENTS = 30
HOST_SHARE = 0.01
# A document is depleted if fewer of its words than this share are left.
LEFT_SHARE = 0.5
# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
REPEAT_WIDTH = 3
REPEAT_SHARE = 50

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_hash(line: bytes) -> int:
    """Hash of a line without case and with single spaces."""
    return xxhash.xxh3_64_intdigest(b" ".join(line.decode().lower().encode().split())) - 2**63


def _base_figures(text: bytes, words: Words) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Figures of the base rules; distinct line hashes and the words on all lines of each."""
    split = text.split()
    lines: dict[bytes, int] = {}
    with_word = 0
    for line in text.split(b"\n"):
        count = lines.get(line)
        if count is None:
            lines[line] = 0 if not line or line.isspace() and not line.split() else 1
            with_word += lines[line]
        elif count:
            lines[line] = count + 1
            with_word += 1
    kept = {k: v for k, v in lines.items() if v}
    per_line: dict[int, int] = {}
    for line, times in kept.items():
        code = line_hash(line)
        per_line[code] = per_line.get(code, 0) + times * len(line.split())
    hashes = words.hashes(split)
    repeated = 0
    if len(hashes) >= REPEAT_WIDTH:
        _, at, counts = np.unique(grams(hashes, REPEAT_WIDTH), return_inverse=True, return_counts=True)
        repeated = int(cover(np.flatnonzero(counts[at] > 1), REPEAT_WIDTH, len(hashes)).sum())
    figures = [
        len(split), len(b"".join(split).decode()), len(text) - len(text.translate(None, SYMBOLS)), with_word - len(kept), repeated,
    ]
    return figures, np.fromiter(per_line.keys(), np.int64, len(per_line)), np.fromiter(per_line.values(), np.int64, len(per_line))


def _figure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in batches:
        rows = [_base_figures(text, words) for text in binary(batch.column(3))]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3], *[pa.array([r[0][k] for r in rows], pa.int64()) for k in range(len(BASE))],
                listed([r[1] for r in rows], pa.int64()), listed([r[2] for r in rows], pa.int64()),
            ],
            ["doc_id", "key", "host", *BASE, "lines", "line_words"],
        )


def figures(documents: DataFrame, host: Column | None = None) -> DataFrame:
    """(doc_id, key, host, base figures, lines, line_words) of each row."""
    host = F.col("source") if host is None else host
    rows = documents.select(F.col("doc_id"), text_key().alias("key"), host.cast("string").alias("host"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    base = ", ".join(f"{c} long" for c in BASE)
    return map_batches(rows, _figure_batches, f"doc_id {kind}, key string, host string, {base}, lines array<long>, line_words array<long>")


def frequent_lines(texts: DataFrame, least: int = LEAST_DOCUMENTS, share: float = HOST_SHARE) -> DataFrame:
    """(host, line, n_documents) of the lines above the limit of their host.

    ``texts`` has one row (host, key, lines, …) per distinct text of a host: copies of a text
    count once, so that only what different texts share is boilerplate.
    """
    limits = texts.groupBy("host").agg(F.greatest(F.lit(float(least)), F.count(F.lit(1)) * share).alias("limit"))
    limits = with_broadcast_if_small(stored(limits.withColumnRenamed("host", "__host"), "line-limits"))
    counts = texts.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_documents"))
    return (
        counts.where(F.col("n_documents") > least)
        .join(limits, F.col("host").eqNullSafe(F.col("__host")))
        .where(F.col("n_documents") > F.col("limit"))
        .select("host", "line", "n_documents")
    )


def _removals(rows: DataFrame, least: int, share: float) -> DataFrame:
    """(host, key, removed words, removed line hashes) of the distinct texts with frequent lines."""
    texts = rows.select("host", "key", "lines", "line_words").dropDuplicates(["host", "key"])
    frequent = frequent_lines(texts, least, share).select(F.col("host").alias("__host"), F.col("line").alias("__line"))
    frequent = with_broadcast_if_small(stored(frequent, "frequent-lines"))
    each = texts.select("host", "key", F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
    return (
        each.select("host", "key", "x.lines", "x.line_words")
        .join(frequent, F.col("host").eqNullSafe(F.col("__host")) & (F.col("lines") == F.col("__line")))
        .groupBy("host", "key").agg(F.sum("line_words").alias("n_removed"), F.collect_list("lines").alias("removed"))
        .select(F.col("host").alias("__host"), F.col("key").alias("__key"), "n_removed", "removed")
    )


def judged(documents: DataFrame, host: Column | None = None, least: int = LEAST_DOCUMENTS, share: float = HOST_SHARE) -> DataFrame:
    """(doc_id, key, host, base figures, base_failed, n_removed, removed, kept) of each row.

    A document fails the base rules with under 50 words, or more than half of its words in
    repeated three-word windows. Of the others those are rejected that keep less than half
    of their words without the lines that more texts of their host hold than the limit.

    Null texts are empty, null hosts one host, repeated rows are judged alike and count once,
    and no rows give none.
    """
    rows = stored(figures(documents, host), "figures")
    removals = _removals(rows, least, share)
    joined = rows.drop("lines", "line_words").join(removals, F.col("host").eqNullSafe(F.col("__host")) & (F.col("key") == F.col("__key")), "left")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_SHARE)
    removed = F.coalesce("n_removed", F.lit(0))
    return (
        joined.withColumn("base_failed", failed).withColumn("n_removed", removed.cast("long"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed") >= F.col("n_words") * LEFT_SHARE))
        .select("doc_id", "key", "host", *BASE, "base_failed", "n_removed", "removed", "kept")
    )


def _clean_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, removed in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
            gone = set(removed or ())
            texts.append(text if not gone or text is None else b"\n".join(x for x in text.split(b"\n") if line_hash(x) not in gone))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], [HELD, "clean"])


def cleaned(documents: DataFrame, least: int = LEAST_DOCUMENTS, share: float = HOST_SHARE) -> DataFrame:
    """The kept documents with all their columns, their frequent lines removed from the text."""
    verdict = judged(documents, None, least, share).where("kept").select(F.col("doc_id").cast("long").alias("own"), "key", F.col("host").alias("own_host"), "removed")
    rows = held(documents).withColumn("doc_host", F.col(f"{HELD}.source").cast("string"))
    same = F.col("doc").eqNullSafe(F.col("own")) & (F.col("doc_key") == F.col("key")) & F.col("doc_host").eqNullSafe(F.col("own_host"))
    joined = rows.join(verdict.dropDuplicates(["own", "key", "own_host"]), same).select(HELD, F.col(f"{HELD}.text").alias("text"), "removed")
    schema = T.StructType([joined.schema[HELD], T.StructField("clean", T.StringType())])
    return released(map_batches(joined, _clean_batches, schema).select(F.col(HELD).withField("text", F.col("clean")).alias(HELD)))


def verdicts(documents: DataFrame) -> DataFrame:
    return judged(documents).select("doc_id", *BASE, "base_failed", "kept", "n_removed", "host")
