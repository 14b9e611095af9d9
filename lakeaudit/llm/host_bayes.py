"""Quality classifier by hierarchical empirical Bayes.

Per document a classifier weighs words, word beginnings and shape figures that go with low
quality or toxicity, learned from labelled documents. Its score is turned into a
Bayes factor with the labelled documents. The share of bad documents of each host and path,
taken over all documents and shrunk towards the level above, is the prior that the
factor moves.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import Recent, map_batches, stored, text_key, with_broadcast_if_small
from lakeaudit.llm.rows import held, released

# About this many labelled documents are used to fit; their ids' hashes decide which.
FIT_ROWS = 20_000
# The model keeps this many features of each target at most: those with most weight.
FEATURES = 50_000
# A feature counts if its log-likelihood ratio is this high and its weight is above LEAST_WEIGHT.
LEAST_RATIO = 12.0
LEAST_WEIGHT = 2.5
# Score bins of the Bayes factor: none, weak, clear, strong.
BINS = (0.0, 3.0, 5.0)
LEAST_COUNT = 3
STEPS = (0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
BEST = 3
REJECT = 0.5
TARGETS = ("low", "toxic")
STRIPPED = ".,;:!?\"'()[]{}«»¡¿"
SIGNS = frozenset("#*$%&|<>!")
# Words a task remembers are twice this at most.
REMEMBERED = 80_000


def _code(kind: str, value: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}\x00{value}") - 2**63


def word_features(word: str) -> tuple[int, ...]:
    """The word itself and its beginnings of four to seven letters, without case and outer marks."""
    plain = word.lower().strip(STRIPPED)
    if not plain:
        return ()
    return (_code("word", plain), *(_code("first", plain[:k]) for k in range(4, min(7, len(plain)) + 1)))


def shape_features(words: list[str], distinct: set[str], upper: int, signs: int) -> list[int]:
    """Steps that shares reach: of repeated neighbours, capitals, signs, lone bars, repeated words."""
    n = len(words)
    if not n:
        return [_code("shape", "empty")]
    counts = {
        "again": (sum(map(operator.eq, words[1:], words)), n), "upper": (upper, len(distinct)),
        "signs": (signs, len(distinct)), "bars": (words.count("|"), n), f"few distinct of 2^{int(math.log2(n))}": (n - len(distinct), n),
    }
    return [_code(kind, str(step)) for kind, (count, of) in counts.items() if count >= LEAST_COUNT for step in STEPS if count >= step * of]


class _Known(Recent):
    """Per word: its features, whether it is in capitals, whether it has signs."""

    def make(self, word: str):
        return word_features(word), len(word) > 1 and word.isupper(), not SIGNS.isdisjoint(word)


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of all, of low and of toxic texts with each feature, summed per batch."""
    known = _Known(REMEMBERED)
    for batch in batches:
        codes, owner = [], []
        for i, text in enumerate(_texts(batch.column(0))):
            words = text.split()
            distinct = set(words)
            each = [known[w] for w in distinct]
            own = {c for x in each for c in x[0]}
            own.update(shape_features(words, distinct, sum(x[1] for x in each), sum(x[2] for x in each)))
            codes.append(np.fromiter(own, np.int64, len(own)))
            owner.append(np.full(len(own), i))
        if not codes:
            continue
        code, at = np.unique(np.concatenate(codes), return_inverse=True)
        owner = np.concatenate(owner)
        columns = [pa.array(code)]
        for k in (1, 2, 3):
            marks = batch.column(k).to_numpy(zero_copy_only=False)
            columns.append(pa.array(np.bincount(at, weights=marks[owner], minlength=len(code)).astype(np.int64)))
        yield pa.RecordBatch.from_arrays(columns, ["feature", "docs", "low", "toxic"])


@dataclass
class Model:
    """Weights of the features of each target, and what a score bin says."""

    weights: dict[int, tuple[float, float]]
    factors: dict[str, list[float]]
    rates: dict[str, float]


def _weight(bad: Column, docs: Column, all_bad: float, all_docs: float) -> Column:
    """Lower end of the log odds ratio's standard error, or null where evidence is thin."""
    fine, all_fine = docs - bad, all_docs - all_bad
    odds = F.log((bad + 0.5) / (all_bad + 1.0)) - F.log((fine + 0.5) / (all_fine + 1.0))
    spread = F.sqrt(1 / (bad + 0.5) + 1 / (fine + 0.5))
    rate = all_bad / all_docs
    ratio = F.when(bad > 0, bad * F.log(bad / (docs * rate))).otherwise(F.lit(0.0)) + F.when(
        fine > 0, fine * F.log(fine / (docs * max(1 - rate, 1e-9)))
    ).otherwise(F.lit(0.0))
    weight = odds - spread
    return F.when((weight >= LEAST_WEIGHT) & (ratio >= LEAST_RATIO), weight)


def labelled_sample(labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row (doc_id, low, toxic) per labelled document, about ``fit_rows`` of them at most.

    Several labels of one document count as bad if any is; null marks and ids don't count.
    """
    one = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("label_doc"))
        .agg(F.max((F.coalesce("quality", F.lit(1)) == 0).cast("int")).alias("low"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"))
    )
    one = stored(one, "labels")
    share = min(1.0, fit_rows / max(one.count(), 1))
    draw = F.xxhash64(F.lit(70), "label_doc").bitwiseAND(F.lit(0x7FFFFFFF))
    return one.where(draw < F.lit(int(share * 0x80000000)))


def fitted(documents: DataFrame, sample: DataFrame) -> Model:
    """Feature weights from the sampled labels; the sample is bounded, so it is broadcast.

    A text with n labelled copies counts as 1 + log2(n) texts: a label given often is sure, but copies
    would make each of its words look telling. It is bad to the share of its copies that are. Shares
    of bad documents are over all labelled rows, as those of hosts are over all rows.
    """
    labelled = documents.join(F.broadcast(sample), F.col("doc_id").cast("long") == F.col("label_doc"))
    marks = labelled.select(text_key().alias("fit_key"), *TARGETS).groupBy("fit_key").agg(F.count(F.lit(1)).alias("n"), *[F.sum(t).alias(t) for t in TARGETS])
    # Whole thousandths, so that sums do not depend on the order of rows.
    weight = F.round(1000 * (1 + F.log2("n"))).cast("long")
    marks = stored(marks.select("fit_key", weight.alias("docs"), "n", *TARGETS, *[F.round(weight * F.col(t) / F.col("n")).cast("long").alias(f"{t}_weight") for t in TARGETS]), "fit-marks")
    once = labelled.select("text", text_key().alias("fit_key")).dropDuplicates(["fit_key"])
    texts = stored(once.join(marks, "fit_key").select("text", "docs", *[F.col(f"{t}_weight").alias(t) for t in TARGETS]), "fit-texts")
    counted = marks.agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]).first()
    rates = {t: (counted[t] or 0) / max(counted["n"] or 0, 1) for t in TARGETS}
    totals = texts.agg(*[(F.sum(c) / 1000).alias(c) for c in ("docs", *TARGETS)]).first()
    docs = totals["docs"]
    weights: dict[int, list[float]] = {}
    if docs:
        counts = map_batches(texts, _count_batches, "feature long, docs long, low long, toxic long")
        summed = counts.groupBy("feature").agg(*[(F.sum(c) / 1000).alias(c) for c in ("docs", *TARGETS)])
        useful = stored(
            summed.select("feature", *[_weight(F.col(t), F.col("docs"), totals[t], docs).alias(t) for t in TARGETS]).where("low IS NOT NULL OR toxic IS NOT NULL"),
            "features",
        )
        for k, target in enumerate(TARGETS):
            best = useful.where(F.col(target).isNotNull()).orderBy(F.desc(target), "feature").limit(FEATURES)
            for row in best.select("feature", target).toLocalIterator():
                weights.setdefault(row["feature"], [0.0, 0.0])[k] = row[target]
    return Model({k: tuple(v) for k, v in weights.items()}, {}, rates)


class _Weighed(Recent):
    """Per word: its largest weight for each target, whether in capitals, whether with signs."""

    def __init__(self, weights: dict[int, tuple[float, float]]):
        super().__init__(REMEMBERED)
        self.weights = weights
        # Most words are one of these.
        self.plain = {(0.0, 0.0, upper, signs): (0.0, 0.0, upper, signs) for upper in (False, True) for signs in (False, True)}

    def make(self, word: str):
        found = [self.weights[c] for c in word_features(word) if c in self.weights]
        value = (
            max((x[0] for x in found), default=0.0), max((x[1] for x in found), default=0.0),
            len(word) > 1 and word.isupper(), not SIGNS.isdisjoint(word),
        )
        return self.plain.get(value, value)


def _scorer(weights):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value
        known = _Weighed(table)
        for batch in batches:
            scores: tuple[list[float], list[float]] = ([], [])
            for text in _texts(batch.column(4)):
                words = text.split()
                distinct = set(words)
                each = [known[w] for w in distinct]
                shapes = shape_features(words, distinct, sum(x[2] for x in each), sum(x[3] for x in each))
                shaped = [table[c] for c in shapes if c in table]
                for k in (0, 1):
                    own = [x[k] for x in each if x[k]] + [x[k] for x in shaped if x[k]]
                    scores[k].append(sum(sorted(own, reverse=True)[:BEST]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(scores[0], pa.float64()), pa.array(scores[1], pa.float64())],
                ["doc_id", "key", "host", "path", *[f"{t}_score" for t in TARGETS]],
            )

    return score


def scored(documents: DataFrame, model: Model, host: Column, path: Column) -> DataFrame:
    """(doc_id, key, host, path, low_score, toxic_score) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model.weights)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), host.cast("string").alias("host"), path.cast("string").alias("path"), "text"
    )
    return map_batches(rows, _scorer(shared), "doc_id long, key string, host string, path string, low_score double, toxic_score double")


def _bin(score: str) -> Column:
    bins = F.lit(0)
    for k, above in enumerate(BINS):
        bins = F.when(F.col(score) > above, F.lit(k + 1)).otherwise(bins)
    return bins


def factors(scores: DataFrame, sample: DataFrame) -> dict[str, list[float]]:
    """Log Bayes factor of each score bin, smoothed by one half a bin and never falling."""
    rows = scores.join(F.broadcast(sample), F.col("doc_id") == F.col("label_doc"))
    found = {}
    for target in TARGETS:
        counts = {(r["bin"], r[target]): r["n"] for r in rows.groupBy(_bin(f"{target}_score").alias("bin"), target).agg(F.count(F.lit(1)).alias("n")).collect()}
        bins = range(len(BINS) + 1)
        totals = [sum(counts.get((b, y), 0) for b in bins) + 0.5 * len(bins) for y in (0, 1)]
        logs = [math.log((counts.get((b, 1), 0) + 0.5) / totals[1]) - math.log((counts.get((b, 0), 0) + 0.5) / totals[0]) for b in bins]
        found[target] = np.maximum.accumulate(logs).tolist() if any(y for (_, y) in counts) else [0.0] * len(bins)
    return found


def _logit(rate: Column) -> Column:
    rate = F.least(F.greatest(rate, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(rate / (1 - rate))


def _probability(prior: Column, factor: Column) -> Column:
    return 1 / (1 + F.exp(-(_logit(prior) + factor)))


def strength(groups: DataFrame, total: str, rate: float) -> float:
    """Documents a prior weighs as much as, from how far groups' shares differ (method of moments)."""
    share = F.col(total) / F.col("docs")
    row = groups.agg(
        F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("groups"), F.sum(F.col("docs") * (share - F.lit(rate)) ** 2).alias("between"),
    ).first()
    rate = min(max(rate, 1e-4), 1 - 1e-4)
    if not row["docs"] or row["groups"] < 2:
        return 1e4
    spread = row["between"] / row["docs"] - rate * (1 - rate) * row["groups"] / row["docs"]
    return float(min(max(rate * (1 - rate) / max(spread, 1e-9) - 1, 5.0), 1e4))


def judged(documents: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None) -> DataFrame:
    """(doc_id, key, host, path, …, kept) for each row of ``documents``.

    ``host`` and ``path`` are expressions on the documents; by default the source, and the
    language within it. Per target come the document's log factor, the shrunk shares of host and
    path without the document itself, and the probability; a document is kept if no probability reaches one half.

    Null hosts and paths are groups of their own, null texts are empty ones. Rows equal in
    id and text are judged alike. Without labels nothing is known to be bad and all is kept.
    """
    host = host if host is not None else F.col("source")
    path = path if path is not None else F.concat_ws("/", F.coalesce(host, F.lit("")), F.coalesce("lang", F.lit("")))
    sample = stored(labelled_sample(labels), "sample")
    model = fitted(documents, sample)
    scores = stored(scored(documents, model, host, path), "scores")
    model.factors = factors(scores, sample)
    for target in TARGETS:
        table = F.array(*[F.lit(x) for x in model.factors[target]])
        factor = F.element_at(table, _bin(f"{target}_score") + 1)
        scores = scores.withColumn(f"{target}_factor", factor).withColumn(
            f"{target}_first", _probability(F.lit(model.rates[target]), F.col(f"{target}_factor"))
        )
    sums = [F.sum(f"{t}_first").alias(f"{t}_sum") for t in TARGETS]
    hosts = stored(scores.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), *sums), "hosts")
    paths = stored(scores.groupBy("host", "path").agg(F.count(F.lit(1)).alias("docs"), *sums), "host-paths")
    totals = hosts.agg(F.sum("docs").alias("docs"), *[F.sum(f"{t}_sum").alias(t) for t in TARGETS]).first()
    rates = {t: (totals[t] or 0.0) / max(totals["docs"] or 0, 1) for t in TARGETS}
    weights = {(t, level): strength(groups, f"{t}_sum", rates[t]) for t in TARGETS for level, groups in (("host", hosts), ("path", paths))}
    level = lambda groups, name, *keys: groups.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("docs").alias(f"{name}_docs"), *[F.col(f"{t}_sum").alias(f"{t}_{name}_sum") for t in TARGETS]
    )
    above = level(hosts, "host", "host").withColumnRenamed("__host", "__above")
    priors = level(paths, "path", "host", "path").join(above, F.col("__host").eqNullSafe(F.col("__above"))).drop("__above")
    priors = with_broadcast_if_small(stored(priors, "priors"))
    out = scores.join(priors, F.col("host").eqNullSafe(F.col("__host")) & F.col("path").eqNullSafe(F.col("__path")))
    for target in TARGETS:
        # A document's own evidence is no part of its prior.
        for name, parent in (("host", F.lit(rates[target])), ("path", F.col(f"{target}_host"))):
            weight = weights[target, name]
            share = (F.col(f"{target}_{name}_sum") - F.col(f"{target}_first") + weight * parent) / (F.col(f"{name}_docs") - 1 + weight)
            out = out.withColumn(f"{target}_{name}", F.greatest(share, F.lit(0.0)))
    for target in TARGETS:
        out = out.withColumn(f"p_{target}", _probability(F.col(f"{target}_path"), F.col(f"{target}_factor")))
    figures = [f"{t}_{x}" for t in TARGETS for x in ("factor", "host", "path")]
    return out.withColumn("kept", (F.col("p_low") < REJECT) & (F.col("p_toxic") < REJECT)).select(
        "doc_id", "key", "host", "path", *figures, "p_low", "p_toxic", "kept"
    )


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    rejected = judged(documents, labels).where("NOT kept").select("doc_id", "key").distinct()
    return released(held(documents).join(rejected, F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("doc_key") == F.col("key")), "left_anti"))
