"""Small corpora with every kind of odd row, and plain Python forms of the operators."""

from __future__ import annotations

import collections
import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, count: int) -> str:
    vocabulary = [a + b + c for a in ("ka", "lo", "mi", "té", "ru", "sh") for b in ("nd", "rt", "l", "ß") for c in ("a", "en", "is", "o")]
    out = [rng.choice(vocabulary) for _ in range(count)]
    return " ".join(w + rng.choice([" ", " ", " ", "\n", ". "]).strip(" ") for w in out)


def documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): clean, copied, nearly copied, odd and very long rows."""
    rng = random.Random(seed)
    rows: list[tuple] = []

    def add(text, source="a", lang="en"):
        rows.append((len(rows), text, lang, source, None if text is None else len(text)))

    for k in range(40):
        add(prose(rng, rng.randint(30, 200)), rng.choice("aab"), rng.choice(["en", "de"]))
    for k in range(12):
        add(rows[k][1], rng.choice("abc"))
    for k in range(16):
        own = rows[k][1].split(" ")
        for _ in range(1 + k // 4):
            own[rng.randrange(len(own))] = "zzz"
        add(" ".join(own), "hot")
    passage = prose(rng, 80)
    for k in range(14):
        add(f"{prose(rng, 20)}\n{passage}\n{prose(rng, 25)}", "hot")
    add(None, None, None)
    add("", "b")
    add(" \n\t \x0b ", None)
    add("one")
    add("one two three")
    add(None, "b")
    add("same " * 300)
    add("no spaces" + "x" * 5000)
    add(prose(rng, 12_000), "long")
    add("eins zwei \x1c drei   vier fünf sechs é 'S don't Σίσυφος ΣΑΣ")
    rows.append(rows[3])
    rows.append(rows[3])
    return rows


def frame(spark, rows, extra: bool = False):
    """The rows as a frame; with columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("row", "key", "size", "target", "whole", "shard", "slot", "host", "path", "n", "rank", "kept", "__order", "__key", "node", "bucket", "spans", "TEXT2"):
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(f"clash {name}"))
    return df


def shingles(text) -> frozenset:
    own = words(text)
    return frozenset(tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))) if own else frozenset()


def similar_classes(rows) -> tuple[dict, dict]:
    """Class and link count of each position of ``rows``, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return {i: least[root(i)] for i in range(len(rows))}, links


BASE = [
    ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def base_secrets(text) -> list[tuple[int, int, int, str]]:
    found = [(m.start(), k, m.end(), kind) for k, (kind, pattern, ok) in enumerate(BASE) for m in pattern.finditer(text or "") if ok(m)]
    return sorted(found)


def listing(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def without_repeated_words(rows, window: int) -> dict[int, tuple]:
    """Per distinct (id, text): words, removed words, digest of the rest."""
    seen: set = set()
    out = {}
    for doc, text in sorted({(r[0], r[1] or "") for r in rows}):
        own = words(text)
        gone = [False] * len(own)
        for s in range(len(own) - window + 1):
            key = tuple(own[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out[doc] = (len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def without_repeated_bytes(rows, window: int) -> list[tuple]:
    """Per row: bytes, removed bytes, removed runs, digest of the rest."""
    texts = [(r[1] or "").encode() for r in rows]
    counts = collections.Counter(t[s : s + window] for t in texts for s in range(len(t) - window + 1))
    out = []
    for row, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for s in range(len(t) - window + 1):
            if counts[t[s : s + window]] > 1:
                gone[s : s + window] = b"\x01" * window
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((row[0], len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def quality_figures(text) -> tuple:
    text = text or ""
    own = words(text)
    counts = collections.Counter(tuple(own[k : k + 3]) for k in range(len(own) - 2))
    covered = {j for k in range(len(own) - 2) if counts[tuple(own[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
