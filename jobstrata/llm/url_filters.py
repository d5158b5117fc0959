"""Verdicts on URLs by sites and patterns, found through each rule's rarest literal token.

There are two kinds of rules. A *site* is a host and the beginning of a path, as
``example.net/en/``; it fits its host and all subdomains, and the longest one that fits
decides. A *pattern* is looked for anywhere in host and path, in any case: ``*`` stands for any
characters, ``^`` for one that is neither a letter nor a digit, or for an end, ``|`` at an end
ties it to that end, ``||`` at the beginning to a host or a subdomain. Where no site fits, a URL
is blocked if a blocking pattern fits and no allowing one does, and allowed otherwise.

Both kinds become regular expressions, but those run on few URLs only. A token is a run of
ASCII letters and digits; a rule names tokens that every URL it fits must hold whole. The
tokens of all rules are counted in all URLs, and a rule is filed under its rarest one. The
tokens of a URL fetch the rules filed under them, and only these are tried. Rules that name no
token are filed under the empty one, which every URL holds, so none is lost.

Each distinct URL is judged once. The index is broadcast where its measured size allows and
otherwise joined in a salted shuffle; verdicts are joined back with very common URLs kept out of
the shuffle. Only DataFrame functions are used.

Defined cases: host and path of a null URL, or of one without ``://``, are empty, and only
patterns for nothing fit them; of sites of equal length the first by code point counts; a site
without a slash fits all paths; repeated rules and rows change nothing; rules with a null are
left out; other columns are kept, those called like an output are replaced; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm.common import join_counted, stored

# The index is broadcast up to this size, which is measured.
BROADCAST_BYTES = 32 << 20
# Parts of a hot token's URLs where the index is too large for that.
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[a-z0-9]+"
# A token between two literal signs: nothing in a URL can make it longer.
_WHOLE = "(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"
_PLAIN = r"([^A-Za-z0-9\x{80}-\x{10FFFF}])"


def _low(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end."""
    return _low(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def rule_table(spark: SparkSession, sites: dict[str, str], patterns: dict[str, str]) -> DataFrame:
    """Rules given as ``{rule: verdict}``."""
    rows = [(r, v, True) for r, v in sites.items()] + [(r, v, False) for r, v in patterns.items()]
    return spark.createDataFrame(rows, "rule string, verdict string, is_site boolean")


def compiled(rules: DataFrame) -> DataFrame:
    """rule, verdict, is_site, the regular expression and the tokens that it can't do without."""
    rule = F.col("rule")
    quoted = F.regexp_replace(rule, _PLAIN, r"\\$1")
    inside = F.lit(r"(?s)^(?:[^/]*\.)?")
    slash = F.instr(rule, "/")
    # The host part of a site is lower-cased, its path is not.
    cut = F.when(slash > 0, slash - 1).otherwise(F.length(rule))
    site = F.concat(_low(F.substring(rule, F.lit(1), cut)), F.substring(rule, cut + 1, F.length(rule)))
    site_end = F.when(slash > 0, F.lit("")).otherwise(F.lit(r"(?:/|\z)"))
    site_regex = F.concat(inside, F.regexp_replace(site, _PLAIN, r"\\$1"), site_end)
    edge = r"(?:^|[^A-Za-z0-9]|\\z)"
    pattern = F.regexp_replace(quoted, r"^\\\|\\\|", r"^(?:[^/]*\\.)?")
    pattern = F.regexp_replace(pattern, r"^\\\|", "^")
    pattern = F.regexp_replace(pattern, r"\\\|$", r"\\z")
    pattern = F.regexp_replace(pattern, r"\\\*", ".*")
    pattern = F.regexp_replace(pattern, r"\\\^", edge)
    # A site stands behind an anchor and, without a path, before one.
    spelled = F.when(
        F.col("is_site"), F.concat(F.lit("|"), rule, F.when(slash > 0, "").otherwise("/"))
    ).otherwise(rule)
    return (
        rules.where("rule IS NOT NULL AND verdict IS NOT NULL AND is_site IS NOT NULL")
        .distinct()
        .select(
            "rule",
            "verdict",
            "is_site",
            F.when(F.col("is_site"), site_regex)
            .otherwise(F.concat(F.lit("(?si)"), pattern))
            .alias("regex"),
            F.array_distinct(F.regexp_extract_all(_low(spelled), F.lit(_WHOLE), F.lit(0))).alias(
                "tokens"
            ),
        )
    )


def _tokens(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_low(subject), F.lit(_TOKEN), F.lit(0)))


def index(rules: DataFrame, subjects: DataFrame) -> DataFrame:
    """Compiled rules, each with the one of its tokens that the fewest ``subjects`` hold."""
    ready = stored(compiled(rules), "rules")
    named = ready.select(F.explode("tokens").alias("token")).distinct()
    seen = subjects.select(F.explode(_tokens(F.col("subject"))).alias("token"))
    counts = _with_index(seen, named).groupBy("token").agg(F.count(F.lit(1)).alias("times"))
    each = ready.select("*", F.explode_outer("tokens").alias("token")).drop("tokens")
    rarest = F.min_by("token", F.struct(F.coalesce("times", F.lit(0)), "token"))
    chosen = (
        each.join(counts, "token", "left")
        .groupBy("rule", "verdict", "is_site", "regex")
        .agg(F.coalesce(rarest, F.lit("")).alias("token"))
    )
    return stored(chosen, "rule-index")


def _with_index(tokens: DataFrame, table: DataFrame) -> DataFrame:
    """Join on the token, by broadcast up to a measured size, else salted."""
    size = table.select(
        F.sum(sum((F.length(c) + 16 for c in table.columns if c != "is_site"), F.lit(0)))
    ).first()[0]
    if (size or 0) * 2 <= BROADCAST_BYTES:
        return tokens.join(F.broadcast(table), "token")
    salt = F.pmod(F.xxhash64(*tokens.columns, F.monotonically_increasing_id()), F.lit(SALTS))
    salted = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return (
        tokens.withColumn("salt", salt.cast("int")).join(salted, ["token", "salt"]).drop("salt")
    )


def fits(subjects: DataFrame, rules: DataFrame) -> DataFrame:
    """Per distinct subject that any rule fits: how often it occurs, the deciding site, and the
    first blocking and allowing pattern."""
    found = index(rules, subjects)
    distinct = subjects.groupBy("subject").agg(F.count(F.lit(1)).alias("times"))
    tokens = distinct.select(
        "*", F.explode(F.concat(_tokens(F.col("subject")), F.array(F.lit("")))).alias("token")
    )
    fitting = _with_index(tokens, found).where(F.expr("regexp_like(subject, regex)"))
    site = F.when(F.col("is_site"), F.struct(-F.length("rule"), "rule", "verdict"))

    def pattern(verdict):
        return F.min(F.when(~F.col("is_site") & (F.col("verdict") == verdict), F.col("rule")))

    return fitting.groupBy("subject").agg(
        F.first("times").alias("times"),
        F.min(site).alias("site"),
        pattern("block").alias("blocking"),
        pattern("allow").alias("allowing"),
    )


def judge(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows``, which have a url, with host, path, the deciding site as rule, the verdict, and
    the pattern behind it, if any. ``rules`` is as ``rule_table`` makes it."""
    url = F.col("url")
    subjects = rows.select(F.concat(host(url), path(url)).alias("subject"))
    known = stored(fits(subjects, rules), "fits")
    added = ("host", "path", "rule", "verdict", "pattern")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in added]
    parts = rows.select(*kept, host(url).alias("host"), path(url).alias("path"))
    whole = parts.withColumn("_subject", F.concat("host", "path"))
    judged = join_counted(whole, known.withColumnRenamed("subject", "_subject"), "_subject", "times")
    by_pattern = F.when(
        F.col("blocking").isNotNull() & F.col("allowing").isNull(), F.lit("block")
    ).otherwise(F.lit("allow"))
    return judged.select(
        *[F.col(f"`{c}`") for c in parts.columns],
        F.col("site.rule").alias("rule"),
        F.coalesce("site.verdict", by_pattern).alias("verdict"),
        F.when(F.col("site").isNull(), F.coalesce("allowing", "blocking")).alias("pattern"),
    )
