"""The classifier on held-out labels, and the pipeline's stages."""

import collections
import math
import os
import random
import zlib

import numpy as np
import public_tokenizers
from corpus import SCHEMA, base_secrets, prose, similar_classes, words
from pyspark.sql import functions as F

import corpus_pipeline
from lakeaudit.llm import chosen_path, host_bayes, packing
from lakeaudit.llm.common import Recent, window_anchors

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fit = labels.where(F.col("doc_id") % 4 != 0)
    held = labels.where(F.col("doc_id") % 4 == 0)
    judged = host_bayes.judged(docs, fit).join(held, "doc_id").select("kept", "quality", "toxic").collect()
    clean = [r.kept for r in judged if r.quality == 1 and r.toxic == 0]
    toxic = [not r.kept for r in judged if r.toxic == 1]
    low = [not r.kept for r in judged if r.quality == 0]
    assert np.mean(clean) >= 0.99 and np.mean(toxic) >= 0.9 and np.mean(low) >= 0.95


def test_sparse_hosts_shrink_towards_the_whole(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0 or (k % 10 < 5 and k < 200)
        text = ("spam " * 60) if bad else prose(rng, 80)
        rows.append((k, text, "en", "big" if k < 200 else f"h{k}", 0))
        labels.append((k, int(not bad), 0))
    rows.append((900, prose(rng, 80), None, None, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in host_bayes.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == len(rows)
    overall = np.mean([r.low_host for r in got.values()])
    # A host with one bad document stays near the whole; the big one moves away from it.
    assert abs(got[204].low_host - overall) < 0.35 and got[0].low_host > got[201].low_host
    assert not got[0].kept and not got[1].kept and got[5].low_factor < 0 and got[5].kept and got[900].kept
    kept = host_bayes.accepted(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def plain_weights(rows, labels):
    """Feature weights of each target from labelled rows (id, text, …), and the shares of bad rows, in plain Python."""
    marks = {}
    for doc, quality, toxic in labels:
        old = marks.get(doc, (0, 0))
        marks[doc] = (max(old[0], int(quality == 0)), max(old[1], int(toxic == 1)))
    copies = collections.defaultdict(list)
    for r in rows:
        if r[0] in marks:
            copies[r[1] or ""].append(marks[r[0]])
    tables = collections.defaultdict(lambda: [0.0, 0.0, 0.0])
    totals = [0.0, 0.0, 0.0]
    for text, own in copies.items():
        weight = round(1000 * (1 + math.log2(len(own))))
        line = [weight, *(round(weight * sum(m[k] for m in own) / len(own)) for k in (0, 1))]
        split = text.split()
        features = {c for w in split for c in host_bayes.word_features(w)}
        features.update(host_bayes.shape_features(
            split, set(split), sum(len(w) > 1 and w.isupper() for w in set(split)), sum(not host_bayes.SIGNS.isdisjoint(w) for w in set(split)),
        ))
        for table in (totals, *(tables[c] for c in features)):
            for k in range(3):
                table[k] += line[k] / 1000
    found = {}
    for feature, (docs, *bads) in tables.items():
        for k, bad in enumerate(bads):
            fine, all_bad, all_fine = docs - bad, totals[k + 1], totals[0] - totals[k + 1]
            weight = math.log((bad + 0.5) / (all_bad + 1)) - math.log((fine + 0.5) / (all_fine + 1)) - math.sqrt(1 / (bad + 0.5) + 1 / (fine + 0.5))
            rate = all_bad / totals[0]
            ratio = (bad * math.log(bad / (docs * rate)) if bad > 1e-9 else 0) + (fine * math.log(fine / (docs * max(1 - rate, 1e-9))) if fine > 1e-9 else 0)
            if weight >= host_bayes.LEAST_WEIGHT and ratio >= host_bayes.LEAST_RATIO:
                found[feature, k] = weight
    every = [m for own in copies.values() for m in own]
    return found, [sum(m[k] for m in every) / len(every) for k in (0, 1)]


def labelled_rows(seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(500):
        bad, rude = k % 4 == 0, k % 9 == 0
        text = "spam " * 60 if bad and k % 8 else prose(rng, 60) + (" | buy || now" * 8 if bad else "") + (" vile@word" if rude else "")
        rows.append((k, text, rng.choice(["en", None]), rng.choice(["big", "big", f"h{k % 13}", None]), 0))
        if k % 5:
            labels.append((k, int(not bad), int(rude)))
    rows += rows[:20] + [(700 + k, rows[4 * k][1], "en", "copies", 0) for k in range(9)]
    return rows, labels


def test_weights_equal_plain_form(spark):
    rows, labels = labelled_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    sample = host_bayes.labelled_sample(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    model = host_bayes.fitted(docs.repartition(3), sample)
    want, rates = plain_weights(rows, labels)
    got = {(f, k): w for f, own in model.weights.items() for k, w in enumerate(own) if w}
    assert len(want) > 5 and got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    assert np.allclose([model.rates[t] for t in host_bayes.TARGETS], rates)


def plain_posteriors(first, hosts, paths, factor, rate):
    """Shares of host and path without the document itself, and the probability, from each row's first probability."""
    logit = lambda p: math.log(min(max(p, 1e-4), 1 - 1e-4) / (1 - min(max(p, 1e-4), 1 - 1e-4)))
    overall = sum(first) / len(first)

    def strength(groups):
        names = collections.Counter(groups)
        mean = {g: sum(f for f, x in zip(first, groups, strict=True) if x == g) / n for g, n in names.items()}
        if len(names) < 2:
            return 1e4
        r = min(max(overall, 1e-4), 1 - 1e-4)
        spread = sum(n * (mean[g] - overall) ** 2 for g, n in names.items()) / len(first) - r * (1 - r) * len(names) / len(first)
        return min(max(r * (1 - r) / max(spread, 1e-9) - 1, 5.0), 1e4)

    weights, out = [strength(hosts), strength(list(zip(hosts, paths, strict=True)))], []
    for i in range(len(first)):
        share, prior = [], overall
        for groups, weight in ((hosts, weights[0]), (list(zip(hosts, paths, strict=True)), weights[1])):
            others = [first[j] for j in range(len(first)) if groups[j] == groups[i] and j != i]
            prior = (sum(others) + weight * prior) / (len(others) + weight)
            share.append(prior)
        out.append((*share, 1 / (1 + math.exp(-(logit(prior) + factor[i])))))
    return out


def test_posteriors_equal_plain_form(spark):
    rows, labels = labelled_rows(4)
    docs = spark.createDataFrame(rows, SCHEMA)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = host_bayes.judged(docs.repartition(3), frame).collect()
    assert len(got) == len(rows)
    _, rates = plain_weights(rows, labels)
    hosts, paths = [r.host for r in got], [r.path for r in got]
    for target, rate in zip(host_bayes.TARGETS, rates, strict=True):
        factor = [r[f"{target}_factor"] for r in got]
        first = [1 / (1 + math.exp(-(math.log(rate / (1 - rate)) + f))) for f in factor]
        want = plain_posteriors(first, hosts, paths, factor, rate)
        assert np.allclose([(r[f"{target}_host"], r[f"{target}_path"], r[f"p_{target}"]) for r in got], want)
    bad = {r.doc_id for r in got if not r.kept}
    assert {k for k, text, *_ in rows if text.startswith("spam")} <= bad and not any(k % 4 and k % 9 for k in bad if k < 500)


def test_words_met_lately_are_remembered():
    class Lengths(Recent):
        made = 0

        def make(self, word):
            self.made += 1
            return len(word)

    known = Lengths(10)
    for k in range(1000):
        assert known[f"rare{k}"] == len(f"rare{k}") and known["often"] == 5
    assert known.made == 1001 and len(known) + len(known.older) <= 20
    assert known["x" * 100] == 100 and "x" * 100 not in known


def test_labels_with_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, None, None), (1, 0, 1), (None, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    sample = host_bayes.labelled_sample(labels).collect()
    assert {(r.label_doc, r.low, r.toxic) for r in sample} == {(1, 1, 1), (3, 0, 0)}
    assert host_bayes.judged(docs, labels).count() == 2
    assert host_bayes.labelled_sample(spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")), 1000).count() < 1200


def test_window_anchors_are_leftmost_minima():
    rng = np.random.default_rng(1)
    for n in (0, 3, 7, 8, 40, 129):
        values = rng.integers(0, 6, n).astype(np.uint64) << np.uint64(40)
        got = window_anchors(values, 8)
        assert got.tolist() == [s + int(np.argmin(values[s : s + 8])) for s in range(n - 7)]


def test_pipeline_stages_keep_what_they_should(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        if name != "packing":
            assert docs.columns == columns
        kept.append(docs)
    quality, unique, clean, mix, packed = kept
    # One document of each group of what the first stage kept.
    classes = {r.class_id for r in chosen_path.near_duplicates(quality).collect()}
    assert {r.doc_id for r in unique.collect()} == classes == {r.doc_id for r in clean.collect()}
    sizes = {r.doc_id: len(words(r.text)) for r in clean.collect()}
    total = collections.Counter()
    for r in mix.collect():
        total[r.doc_id] += len(words(r.text))
    assert all(total[k] <= 2 * n for k, n in sizes.items())
    assert abs(sum(total.values()) - 1.5 * sum(sizes.values())) <= 40
    pieces = packing.pieces(mix, packing.__dict__.get("TOKENIZER") or __import__("public_tokenizers").path(corpus_pipeline.TOKENIZER))
    same = lambda df: collections.Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.select("doc_id", "piece", "length", "ids_crc32").collect())
    assert same(packed) == same(pieces)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).where("n <> end OR n > 4096").count() == 0
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_pipeline_rows_equal_plain_forms(spark, tmp_path):
    """Rows of the whole run: spam gone, one of all pairs' classes, plain scans, plain filling, plain token ids."""
    from test_llm_operators import _filled
    from tokenizers import Tokenizer

    rng, rows, labels = random.Random(8), [], []
    for k in range(400):
        bad = rng.random() < 0.3
        text = " ".join(f"spam{rng.randrange(9)}" for _ in range(60)) if bad else prose(rng, 90)
        if not bad and k % 3 == 0:
            text = f"{text} password=hunter{k:04} {prose(rng, 10)}"
        rows.append((k, text, "en", "abc"[k % 3], len(text)))
        labels.append((k, int(not bad), 0))
    for k in range(1, 41, 2):  # near and exact copies, of any class of the above
        own = rows[k][1].split(" ")
        own[-1] = "ende" if k % 3 else own[-1]
        rows.append((1000 + k, " ".join(own), "en", "abc"[k % 2], 0))
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    good = [r for r in rows if "spam" not in r[1]]
    classes, _ = similar_classes(good)
    one = [r for i, r in enumerate(good) if classes[i] == r[0]]
    assert len(one) < len(good) < len(rows)
    texts = {}
    for doc, text, *_ in one:
        for a, _, b, _ in reversed(base_secrets(text)):
            text = f"{text[:a]}[secret]{text[b:]}"
        texts[doc] = text
    assert any("[secret]" in x for x in texts.values())
    source = {r[0]: r[3] for r in one}
    sizes = collections.Counter()
    for doc, text in texts.items():
        sizes[source[doc]] += len(words(text))
    order = sorted(sizes)
    targets = dict(zip(order, _filled([sizes[x] for x in order], (5, 2, 1), 1.5, 2), strict=True))

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    crc = lambda text: zlib.crc32(np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes())
    whole = {doc: crc(text) for doc, text in texts.items()}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= set(texts)
    taken, cut = collections.Counter(), collections.Counter()
    for r in got:
        own = words(texts[r.doc_id])
        assert r.piece == 0 and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        if r.ids_crc32 == whole[r.doc_id]:
            taken[source[r.doc_id]] += len(own)
        else:  # the leading words of the one document that is taken in part
            taken[source[r.doc_id]] += next(n for n in range(1, len(own)) if crc(" ".join(own[:n])) == r.ids_crc32)
            cut[source[r.doc_id]] += 1
    assert all(abs(taken[x] - targets[x]) <= 1 for x in order) and all(n == 1 for n in cut.values())
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, len(r.ids) // 4))
    for own in sequences.values():
        at = 0
        for offset, length, held in sorted(own):
            assert offset == at and length == held
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.1 * sum(r.length for r in got) / 4096 + 2


def test_run_leaves_the_last_stage_only(spark, tmp_path):
    """Of all that the stages write, what they need no longer is gone when ``run`` returns."""
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left == {"pipeline-mixing", "pieces", "lengths"} and packed.count() > 0
