"""URL filters: rules indexed by their rarest literal token.

A rule is a pattern, and every pattern names words that a URL must hold: its literal tokens. Each
rule is filed under the one that fewest URLs hold. The tokens of a URL fetch the rules filed
under them, and only those rules run their regular expression on it. Of the rules that fit, a
host rule goes before a pattern, and a longer one before a shorter one.

Patterns: ``*`` is any text, ``^`` any character but ASCII letters and digits or either end,
a leading ``||`` the start of the host or of one of its parent domains, and ``|`` at either end
that end of the URL's host and path. Case doesn't matter. A host rule is ``host/path``; it fits
the host and its subdomains where the path begins with the rule's, in the same case.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeaudit.llm.common import stored, with_broadcast_if_small
from lakeaudit.operators.paging import number_rows

# The host rules that the query's contract states, and the method's own patterns.
HOST_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
PATTERNS = (
    ("block", "^casino^"), ("block", "^poker^"), ("block", "^bets^"), ("block", "^pills^"), ("block", "^viagra^"), ("block", "^porn^"),
    ("block", "||ads.*"), ("block", "/login^"), ("block", "/cart^"), ("block", "/wp-admin/*"), ("allow", "/responsible-gambling/*"),
)
# What holds for a URL that no rule fits.
OTHERWISE = "allow"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# A token that stands between literal characters or anchors, so that a URL holds it as a whole.
BOUNDED = r"(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])"
PUNCTUATION = r"([\x21-\x29\x2B-\x2F\x3A-\x40\x5B-\x5D\x5F\x60\x7B-\x7E])"
# Rules without such a token are filed here, and every URL asks for them.
ANY = ""


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, A-Z lower-cased; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to a question mark or hash."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def url_tokens(address: Column) -> Column:
    """The distinct runs of letters and digits, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.translate(address, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0)))


def rule_table(spark: SparkSession, host_rules: Iterable[tuple[str, str]] = HOST_RULES, patterns: Iterable[tuple[str, str]] = PATTERNS) -> DataFrame:
    """(verdict, rule, is_host) of (verdict, rule) pairs."""
    rows = [(v, r, True) for v, r in host_rules] + [(v, r, False) for v, r in patterns]
    listed = [F.struct(F.lit(v).alias("verdict"), F.lit(r).alias("rule"), F.lit(h).alias("is_host")) for v, r, h in rows]
    return spark.range(1).select(F.inline(F.array(*listed))) if listed else spark.range(0).selectExpr("'' AS verdict", "'' AS rule", "true AS is_host")


def compiled(rules: DataFrame) -> DataFrame:
    """(priority, verdict, rule, is_host, regex, tokens): a greater priority wins.

    Null and empty rules are left out, repeated ones count once. Of rules of equal length ``allow``
    wins, then the greater text.
    """
    rules = rules.where(F.length("rule") > 0).select("verdict", "rule", "is_host").distinct()
    rules = rules.withColumn("length", F.length("rule")).withColumn("allows", F.col("verdict") == "allow")
    numbered = number_rows(rules, ["is_host", "length", "allows", "rule", "verdict"]).withColumnRenamed("row_no", "priority")
    text = F.when(F.col("is_host"), F.concat(F.lit("||"), "rule")).otherwise(F.col("rule"))
    body = F.regexp_replace(F.regexp_replace(text, r"^\|{1,2}", ""), r"\|$", "")
    body = F.regexp_replace(F.regexp_replace(body, PUNCTUATION, r"\\$1"), r"\*+", ".*")
    body = F.regexp_replace(body, r"\^", r"(?:^|\$|[^A-Za-z0-9])")
    start = F.when(text.startswith("||"), F.lit(r"^(?:[^/]*\.)?")).when(text.startswith("|"), F.lit("^")).otherwise(F.lit(""))
    return numbered.select(
        "priority", "verdict", "rule", "is_host",
        F.concat(F.when(F.col("is_host"), F.lit("(?s)")).otherwise(F.lit("(?si)")), start, body, F.when(text.endswith("|"), F.lit("$")).otherwise(F.lit(""))).alias("regex"),
        F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(BOUNDED), F.lit(0))).alias("tokens"),
    )


def rule_index(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, priority, verdict, rule, is_host, regex): each rule under its rarest token.

    ``addresses`` has a column ``address``, host and path. How many of all of them hold a token is
    counted for the tokens of rules only.
    """
    compiled_rules = stored(compiled(rules), "url-rules")
    listed = compiled_rules.select("priority", F.explode("tokens").alias("token"))
    asked = with_broadcast_if_small(stored(listed.select("token").distinct(), "url-rule-tokens"))
    held = addresses.select(F.explode(url_tokens(F.col("address"))).alias("token"))
    counts = held.join(asked, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)), -F.length("token"), "token")
    rarest = listed.join(counts, "token", "left").groupBy("priority").agg(F.min_by("token", rarity).alias("token"))
    index = compiled_rules.drop("tokens").join(rarest, "priority", "left").withColumn("token", F.coalesce("token", F.lit(ANY)))
    return stored(index, "url-index")


def verdicts(pages: DataFrame, rules: DataFrame | None = None, id_column: str = "page_id", url: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, pattern) of every row: what the best fitting rule says.

    ``rule`` is the host rule that fits, ``pattern`` the pattern that decides where no host rule
    fits; a URL that none fits is allowed. A URL that is null or has no ``://`` has an empty host
    and path. Every row has its own result, also repeated ones; an empty table gives none. Other
    columns play no part. Rows keep to themselves from the scan to one shuffle on a row number, so
    a hot host, URL or token is no group.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_column).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rows = rows.withColumn("address", F.concat("host", "path"))
    index = rule_index(rows, rule_table(spark) if rules is None else rules)
    # The null token meets no rule; it keeps rows that no rule fits.
    asked = F.concat(url_tokens(F.col("address")), F.array(F.lit(ANY), F.lit(None).cast("string")))
    fetched = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("token", F.explode(asked))
    found = fetched.join(with_broadcast_if_small(index.select("token", "priority", "regex")), "token", "left")
    found = found.where(F.col("token").isNull() | F.regexp_like("address", F.col("regex")))
    best = found.groupBy("row", "page_id", "host", "path").agg(F.max("priority").alias("priority"))
    named = with_broadcast_if_small(index.select("priority", "rule", "verdict", "is_host"))
    return best.join(named, "priority", "left").select(
        "page_id", "host", "path",
        F.when(F.col("is_host"), F.col("rule")).alias("rule"),
        F.coalesce("verdict", F.lit(OTHERWISE)).alias("verdict"),
        F.when(~F.col("is_host"), F.col("rule")).alias("pattern"),
    )


def allowed(pages: DataFrame, rules: DataFrame | None = None, url: str = "url") -> DataFrame:
    """The rows, with all their columns, whose URL no rule blocks."""
    blocked = verdicts(pages, rules, url, url).where(F.col("verdict") == "block").select(F.md5(F.col("page_id").cast("binary")).alias("__url")).distinct()
    return pages.join(blocked, F.md5(F.col(url).cast("binary")) == F.col("__url"), "left_anti")
