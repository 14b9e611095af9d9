"""Multipart credential linking: secrets found in texts, alone or by the company they keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import stored, text_key
from lakeaudit.llm.rows import HELD, held, released

# The patterns of the base kinds, in the order in which equal starts are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

# Weak candidates: no secret by themselves, reported only next to what completes them.
# A key is a run of 32 or more characters with letters of both cases and digits.
KEY_RUN = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"(?<![A-Za-z0-9.])(?:(?:https?|s3|ftp|jdbc:[a-z]+)://[^\x20\x09-\x0D\"'<>]+|[a-z0-9-]+(?:\.[a-z0-9-]+){2,}:[0-9]{2,5})"
# Short identifiers of a user or client, given as an assignment.
IDENTIFIER = r"""(?i)\b(?:user|username|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
WINDOW = 400

BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("key", "endpoint", "identifier")
KINDS = (*BASE_KINDS, *WEAK_KINDS)


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of (start, rank, end) of the pattern's matches, in code points.

    Splitting at the matches gives the lengths between them. A text without a match is
    tested once and left.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pair = F.arrays_zip(found.alias("found"), F.slice(between, F.lit(1), F.size(found)).alias("between"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,ok:boolean>>")

    def step(done: Column, x: Column) -> Column:
        at = F.coalesce(F.try_element_at(done, F.lit(-1))["end"], F.lit(0)) + F.length(x["between"])
        ok = keep(x["found"]) if keep else F.lit(True)
        return F.concat(done, F.array(F.struct(
            at.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
            (at + F.length(x["found"])).cast("int").alias("end"), ok.alias("ok"),
        )))

    all_spans = F.aggregate(pair, empty, step)
    return F.when(text.rlike(pattern), F.filter(all_spans, lambda x: x["ok"])).otherwise(empty)


def _long_value(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_VALUE


def _mixed_key(match: Column) -> Column:
    return match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")


def _rows_of(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))


def parts_of(documents: DataFrame) -> DataFrame:
    """(doc_id, key, strong, weak): spans of the base kinds and of the weak ones, per document."""
    text = F.coalesce("text", F.lit(""))
    strong = F.concat(_spans(text, ASSIGN, "assign", _long_value), _spans(text, ACCESS, "access"), _spans(text, HEX, "hex"))
    weak = F.concat(_spans(text, KEY_RUN, "key", _mixed_key), _spans(text, ENDPOINT, "endpoint"), _spans(text, IDENTIFIER, "identifier"))
    return documents.select("doc_id", text_key().alias("__key"), _rows_of(strong).alias("strong"), _rows_of(weak).alias("weak"))


def linked(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, __key, linked): the weak spans that have all the parts they need near them.

    A key needs an access identifier (base or weak) within ``window`` code points of its
    start in the same document; an endpoint or identifier needs a secret value (an
    assignment, a hex run, or a key) there. It is an interval join on stretches of
    ``window`` code points: of each stretch and role only the first and last start are
    kept, since one of them is near enough whenever any is. So neither a document nor
    a stretch full of parts is paired out.
    """
    role = (
        F.when(F.col("s.rank").isin(KINDS.index("access"), KINDS.index("identifier")), "id")
        .when(F.col("s.rank").isin(KINDS.index("assign"), KINDS.index("hex"), KINDS.index("key")), "secret")
    )
    weak_rows = parts.where(F.size("weak") > 0)
    # The same document may be there twice with the same text; its spans are equal then.
    spans = weak_rows.select("doc_id", "__key", F.explode(F.concat("strong", "weak")).alias("s")).withColumn("role", role)
    stretch = F.floor(F.col("s.start") / window).cast("long")
    ends = (
        spans.where("role IS NOT NULL").groupBy("doc_id", "__key", "role", stretch.alias("stretch"))
        .agg(F.min("s.start").alias("first"), F.max("s.start").alias("last"))
        .select(
            F.col("doc_id").alias("__doc"), F.col("__key").alias("__doc_key"), F.col("role").alias("__role"), "first", "last",
            F.explode(F.array(F.col("stretch") - 1, F.col("stretch"), F.col("stretch") + 1)).alias("__stretch"),
        )
    )
    needs = F.when(F.col("s.rank") == KINDS.index("key"), "id").otherwise("secret")
    weak = (
        weak_rows.select("doc_id", "__key", F.explode("weak").alias("s")).distinct()
        .withColumn("stretch", stretch).withColumn("needs", needs)
    )
    near = (F.abs(F.col("first") - F.col("s.start")) <= window) | (F.abs(F.col("last") - F.col("s.start")) <= window) | (
        (F.col("first") <= F.col("s.start")) & (F.col("last") >= F.col("s.start"))
    )
    joined = weak.join(
        ends,
        weak["doc_id"].eqNullSafe(ends["__doc"]) & (weak["__key"] == ends["__doc_key"])
        & (weak["needs"] == ends["__role"]) & (weak["stretch"] == ends["__stretch"]) & near,
        "left_semi",
    )
    return joined.groupBy("doc_id", "__key").agg(F.collect_set("s").alias("linked"))


def _listing(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def with_spans(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, __key, strong, linked) of every row of ``documents``.

    A null text is empty and has no spans. Rows equal in id and text have equal spans, null
    ids are ids of their own, and no rows give no rows.
    """
    # Read three times below; written once, so that the patterns run over each text once. It holds no text.
    parts = stored(parts_of(documents), "secret-parts")
    more = linked(parts, window).select(F.col("doc_id").alias("__doc"), F.col("__key").alias("__doc_key"), "linked")
    joined = parts.join(more, parts["doc_id"].eqNullSafe(more["__doc"]) & (parts["__key"] == more["__doc_key"]), "left")
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return joined.select("doc_id", "__key", "strong", F.coalesce("linked", none).alias("linked"))


def secret_report(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Counts of base findings, a digest of them, and the list of all spans of each document."""
    rows = with_spans(documents, window)

    def count(kind: str) -> Column:
        return F.size(F.filter("strong", lambda x: x["rank"] == KINDS.index(kind))).cast("long")

    return rows.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listing(F.col("strong")).cast("binary"), 256).alias("base_sha256"),
        _listing(F.concat("strong", "linked")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )


def redacted(documents: DataFrame, window: int = WINDOW, mark: str = "[secret]") -> DataFrame:
    """Documents, all of them and all their columns, with every found span replaced by ``mark``.

    Overlapping spans are replaced once. ``n_chars``, if there, is measured again where the
    text changed.
    """
    found = with_spans(documents, window).where((F.size("strong") > 0) | (F.size("linked") > 0))
    found = found.select(F.col("doc_id").cast("long").alias("own"), F.col("__key").alias("own_key"), F.array_sort(F.concat("strong", "linked")).alias("found")).distinct()
    joined = held(documents).join(found, F.col("doc").eqNullSafe(F.col("own")) & (F.col("doc_key") == F.col("own_key")), "left")
    text = F.col(f"{HELD}.text")
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(done: Column, x: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, x["start"] - done["at"])
        fresh = x["start"] >= done["at"]
        return F.struct(
            F.when(fresh, F.concat(done["text"], gap, F.lit(mark))).otherwise(done["text"]).alias("text"),
            F.greatest(done["at"], x["end"]).alias("at"),
        )

    def finish(done: Column) -> Column:
        return F.concat(done["text"], F.substring(text, done["at"] + 1, F.length(text)))

    out = joined.withColumn("clean", F.when(F.col("found").isNotNull(), F.aggregate("found", start, step, finish)))
    new = F.col(HELD).withField("text", F.col("clean"))
    if "n_chars" in documents.columns:
        new = new.withField("n_chars", F.length("clean").cast(documents.schema["n_chars"].dataType))
    return released(out.withColumn(HELD, F.when(F.col("found").isNotNull(), new).otherwise(F.col(HELD))))
