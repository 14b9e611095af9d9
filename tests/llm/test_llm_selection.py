"""Hard negatives, importance resampling and URL rules against plain Python forms, on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from corpus import SCHEMA, documents, frame, prose
from pyspark.sql import functions as F

from lakeaudit.llm import angular, importance, url_rules

EMBEDDINGS = "vec_id long, embedding array<double>, label int"


def plain_negatives(rows, low=80, high=100, k=5):
    """(anchor, positive, rank, negative, positive score, negative score), all pairs scored with Python's integers."""
    good = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for a, own, v in good:
        if a % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), c, other) for c, other, w in good if c != a and len(w) == len(v)]
        for ps, p, _ in sorted(x for x in scores if x[2] == own)[:k]:
            fits = sorted(x for x in scores if x[2] != own and low * -ps <= 100 * -x[0] <= high * -ps)[:k]
            out += [(a, p, rank, n, -ps, -ns) for rank, (ns, n, _) in enumerate(fits, 1)]
    return sorted(out)


def negatives_of(spark, rows):
    df = spark.createDataFrame(rows, EMBEDDINGS)
    for name in ("id", "row", "score", "v", "dim", "slice", "wanted"):
        df = df.withColumn(name, F.lit(f"clash {name}"))
    return sorted(tuple(r) for r in angular.embeddings_negatives(df.repartition(3)).collect())


def test_hard_negatives_equal_all_pairs(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(k, [float(x) for x in centres[k % 6] + rng.normal(size=8) * rng.choice([0.05, 0.4])], int(rng.integers(0, 3))) for k in range(600)]
    rows += [(k, [0.25] * 8, k % 3) for k in range(600, 640)]
    rows += [(700, [0.0] * 8, 1), (800, None, 1), (900, [1.0, None], 1), (1000, [float("nan")] * 8, 1), (1100, [float("inf")] * 8, 2), (1200, [], 1)]
    rows += [(1300, [0.5, 0.25], 1), (1301, [0.5, 0.5], 1), (1302, [0.4, 0.5], 2), (1400, [1.0] * 3, 1), (None, [0.5] * 8, 1), (1500, [0.5] * 8, None)]
    rows += [rows[100], rows[100], rows[7], (107, [0.1] * 8, 5)]
    want = plain_negatives(rows)
    assert len(want) > 50 and negatives_of(spark, rows) == want


def test_hard_negatives_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(angular, "FILE_BLOCK", 16)
    monkeypatch.setattr(angular, "ANCHOR_BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=5)], k % 2) for k in range(900)]
    assert negatives_of(spark, rows) == plain_negatives(rows)


def test_hard_negatives_of_huge_components(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=4) * 3e5], k % 3) for k in range(300)]
    assert negatives_of(spark, rows) == plain_negatives(rows)
    beyond = [(100, [1e17, 1.0], 1), (101, [2e17, 1.0], 1), (102, [1.5e17, 0.0], 2), (103, [0.5, 0.5], 2)]
    got = negatives_of(spark, beyond)
    # All scores lie beyond a long, so they are its largest value.
    assert got == [(100, 101, 1, 102, 2**63 - 1, 2**63 - 1), (100, 101, 2, 103, 2**63 - 1, 2**63 - 1)]


def test_bounds_hold_every_score():
    rng = np.random.default_rng(4)
    for scale in (1.0, 1e-3, 1e6):
        vectors = np.floor(rng.normal(size=(200, 6)) * 256 * scale)
        rows = [(k, k, 0, v, ()) for k, v in enumerate(vectors)]
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([0] * len(rows)), pa.array([list(v) for v in vectors])], ["id", "row", "label", "v"]
        )
        (block,) = [angular.Block(*(c.to_pylist()[0] for c in b.columns)) for b in angular._blocks(500, {})(iter([batch]))]
        low, high = block.bounds(block)
        exact = block.v @ block.v.T
        assert (low <= exact).all() and (exact <= high).all() and (high < np.abs(exact).max() * 2).all()


def test_no_embeddings(spark):
    assert negatives_of(spark, [(None, None, None)]) == []
    assert angular.embeddings_negatives(spark.createDataFrame([], EMBEDDINGS)).collect() == []


def plain_resampling(rows, target, percent=5, least=20):
    """(doc_id, n_features, weight, score) of all rows, and those drawn in their order."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        own = word.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        return own, [" ".join(own[k : k + n]) for n in (1, 2, 3) for k in range(len(own) - n + 1)]

    def buckets(texts):
        return collections.Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t)[1])

    s, t = buckets(r[1] for r in rows), buckets(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
    out, able = [], []
    for row in rows:
        own, found = features(row[1])
        weight = sum(gain(zlib.crc32(f.encode()) % 10000) for f in found)
        h = int(hashlib.sha256(f"42:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:8], 16)
        line = (row[0], len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
        out.append(line)
        able += [line] if len(own) >= least else []
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    return collections.Counter(out), able[: len(able) * percent // 100]


@pytest.mark.parametrize("percent", [5, 0, 37, 100])
def test_resampling_equals_plain_form(spark, percent):
    rng = random.Random(5)
    rows = documents() + [(None, prose(rng, 50), None, None, None)] * 3 + [(77, "Ein Wort " * 40, "", "", 0)] * 9 + [(5000, "w" * 300 + " x" * 30, "", "", 0)]
    target = [prose(rng, 60), None, "", "Wort eins, zwei!"]
    want, drawn = plain_resampling(rows, target, percent)
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resampled(frame(spark, rows, extra=True).repartition(5), goal, percent).collect()
    assert collections.Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == want
    ranked = sorted((r["rank"], (r.doc_id, r.n_features, r.weight, r.score)) for r in got if r["rank"] is not None)
    assert [r for r, _ in ranked] == list(range(1, len(drawn) + 1)) and [x for _, x in ranked] == drawn


def test_run_sums_are_checksums():
    rng = random.Random(6)
    sums = importance.Sums()
    texts = [b"", b"a", "é b\tC D".encode(), b" ".join(bytes(rng.choices(b"abc019", k=rng.randint(1, 40))) for _ in range(500)), b"x" * 5000 + b" y z"]
    words, text_of, last, sizes = importance._texts_words(texts)
    found = collections.Counter()
    for places, runs in sums.run_sums(words, last):
        found.update(zip(text_of[places].tolist(), runs.tolist(), strict=True))
    want = collections.Counter()
    for k, t in enumerate(texts):
        own = t.lower().split()
        want.update((k, zlib.crc32(b" ".join(own[i : i + n]))) for n in (1, 2, 3) for i in range(len(own) - n + 1))
    assert found == want and sizes.tolist() == [0, 1, 4, 500, 3]


def test_cutoff_is_every_rank(spark):
    rng = random.Random(7)
    keys = [(rng.randint(0, 5), rng.randint(0, 1), rng.randint(-3, 3), 0, k) for k in range(60)]
    df = spark.createDataFrame(keys, ", ".join(f"{k} long" for k in importance.KEY)).repartition(4).cache()
    for rank in (1, 2, 29, 30, 31, 59, 60):
        assert importance.cutoff(df, rank) == sorted(keys)[rank - 1]
    assert importance.cutoff(df, 61) is None and importance.cutoff(df, 0) is None
    assert importance.cutoff(df.where("k0 > 9"), 1) is None


def test_resampling_of_nothing(spark):
    none, goal = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(None, None)], "item_id long, text string")
    assert importance.resampled(none, goal).collect() == []
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2, SCHEMA)
    assert [(r.n_features, r.weight, r["rank"]) for r in importance.resampled(nulls, goal).collect()] == [(0, 0, None)] * 2
    docs = frame(spark, [(k, "alpha beta " * 20, "en", "a", 0) for k in range(40)], extra=True)
    drawn = importance.drawn_documents(docs, goal)
    assert drawn.columns == docs.columns and drawn.count() == 2


URLS = [
    "http://a.net/", "http://net/x", "http://a.net", "http://A.EXAMPLE.Net/en/1?x=/de/", "http://example.net/EN/1", "https://example.com/de/#a", "http://notexample.com/de/",
    "http://x.org/fr/a", "http://x.org/fr", "http://org/fr/?q", "no scheme", "", None, "://", "://net/", "http://casino-win.example.com/a", "http://casinos.example.com/",
    "http://a.com/x/LOGIN?x", "http://a.com/x/loginpage", "http://ads.x.com/1", "http://badads.x.com/1", "http://a.com/responsible-gambling/casino", "http://é.com/ü/poker/",
    "http://a.com/wp-admin/\nx", "http://a://b.net/", "http://user@x.net:80/", "http://free-bets.x.net/a", "http://" + "a." * 3000 + "net/" + "en/" * 3000, "http://a.com/cart",
]


def plain_verdict(url, host_rules, patterns):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = []
    for verdict, rule in host_rules:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append((True, len(rule), verdict == "allow", rule, verdict))
    for verdict, rule in patterns:
        start, body = ("||", rule[2:]) if rule.startswith("||") else ("|", rule[1:]) if rule.startswith("|") else ("", rule)
        body, end = (body[:-1], "$") if body.endswith("|") else (body, "")
        body = "".join(".*" if c == "*" else "(?:^|[^A-Za-z0-9]|$)" if c == "^" else re.escape(c) for c in body) + end.replace("$", r"\Z")
        pattern = re.compile({"": "", "|": r"\A", "||": r"\A(?:[^/]*\.)?"}[start] + body, re.S | re.I | re.A)
        if pattern.search(host + path):
            fits.append((False, len(rule), verdict == "allow", rule, verdict))
    is_host, _, _, rule, verdict = max(fits, default=(True, 0, False, None, "allow"))
    return host, path, rule if is_host else None, verdict, None if is_host else rule


def pages_of(spark, urls):
    df = spark.createDataFrame([(k, u, "<html>") for k, u in enumerate(urls)], "page_id long, url string, html string")
    for name in ("host", "path", "rule", "verdict", "row", "token", "priority", "address"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def test_url_rules_equal_plain_form(spark):
    urls = URLS + [URLS[0]] * 5
    pages = pages_of(spark, urls)
    pages = pages.union(pages.where("page_id < 3")).union(pages.limit(1).withColumn("page_id", F.lit(None).cast("long")))
    got = collections.Counter(tuple(r) for r in url_rules.verdicts(pages).collect())
    lines = [(k, u) for k, u in enumerate(urls)] + [(k, urls[k]) for k in range(3)] + [(None, urls[0])]
    assert got == collections.Counter((k, *plain_verdict(u, url_rules.HOST_RULES, url_rules.PATTERNS)) for k, u in lines)
    clean = url_rules.allowed(pages_of(spark, urls))
    assert clean.columns == pages.columns
    assert sorted(r.page_id for r in clean.collect()) == [k for k, u in enumerate(urls) if plain_verdict(u, url_rules.HOST_RULES, url_rules.PATTERNS)[3] == "allow"]


def test_rules_of_every_form(spark):
    """Rules without any whole token, repeated and empty ones, anchors, ties of length."""
    hosts = [("block", "a.co/"), ("allow", "b.co/"), ("block", "b.co/"), ("block", ""), ("allow", "x.a.co/deep/pa")]
    patterns = [("block", "*ab*"), ("allow", "|www.|"), ("block", "|www."), ("block", "/end|"), ("allow", "q.z*"), ("block", "^7^"), ("block", "(x)[y]$.+?"), ("block", "^7^")]
    urls = ["http://x.a.co/deep/path", "http://x.a.co/deep/pA", "http://b.co/ab", "http://xaby.de/", "http://www.", "http://www.x", "http://h/a/end", "http://h/a/end/", "http://q.zebra", "http://h/7", "http://h/77", "http://h/(X)[y]$.+?x", "http://h/(X)[y]$.+!", "plain"]
    rules = url_rules.rule_table(spark, hosts, patterns)
    got = {r.page_id: tuple(r)[1:] for r in url_rules.verdicts(pages_of(spark, urls), rules).collect()}
    assert got == {k: plain_verdict(u, [h for h in hosts if h[1]], patterns) for k, u in enumerate(urls)}
    index = {r.rule: r.token for r in url_rules.rule_index(pages_of(spark, urls).selectExpr("url AS address"), rules).collect()}
    assert index["*ab*"] == "" and index["x.a.co/deep/pa"] in ("x", "a", "co", "deep") and index["^7^"] == "7"
    nothing = url_rules.rule_table(spark, [], [])
    assert {r.verdict for r in url_rules.verdicts(pages_of(spark, urls), nothing).collect()} == {"allow"}


def test_rules_are_filed_under_the_rarest_token(spark):
    addresses = spark.createDataFrame([(f"common.example/{k}",) for k in range(30)] + [("common.rare/x",)], "address string")
    index = url_rules.rule_index(addresses, url_rules.rule_table(spark, [("block", "common.example/"), ("block", "common.rare/x/")], []))
    assert {r.rule: r.token for r in index.collect()} == {"common.example/": "example", "common.rare/x/": "rare"}


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_rules.verdicts(none).collect() == [] and url_rules.allowed(none).collect() == []
