"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression with a verdict and the literal tokens that every
match must contain. Each rule is filed under the one of its tokens that the
fewest URLs of the corpus contain. A URL looks up its own tokens, and only the
rules found that way run their expressions. Rules without a literal run on all.

The index is a constant in the plan: rule lists are configuration, so their size
does not follow the data. Rows never leave their partition.

Cases: a null URL has no host, path or tokens and gets the default verdict;
an URL without ``://`` has an empty host and path, but patterns on the whole URL
still apply; repeated rows are judged one by one; other columns pass through,
and input columns named like an output are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.llm.common import LOWER, UPPER

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs on ``target``; the fitting rule of highest ``rank`` decides.

    ``name`` is reported as the rule where ``reported`` holds. Site rules rank
    above patterns, and longer site rules above shorter ones.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    target: str = "url"
    rank: int = 0
    reported: bool = False


def site_rule(verdict: str, rule: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the path starts with the rule's."""
    return Rule(rule, verdict, rf"^(?:[^/]*\.)?{re.escape(rule)}",
                tuple(re.findall(TOKEN, rule.translate(str.maketrans(UPPER, LOWER)))), "site", 1 + len(rule), True)


def pattern_rule(verdict: str, name: str, pattern: str, *tokens: str) -> Rule:
    return Rule(name, verdict, pattern, tuple(tokens))


# The site rules of the contract.
SITE_RULES = [
    site_rule("block", "net/"), site_rule("allow", "example.net/en/"),
    site_rule("block", "example.com/de/"), site_rule("allow", "org/fr/"),
]
# Pages that are seldom prose: logins, carts, searches, archives, feeds, adverts, betting and adult sites.
PATTERN_RULES = [
    pattern_rule("block", "login", r"(?i)/(?:wp-)?login(?:\.php)?(?:[/?#]|$)", "login"),
    pattern_rule("block", "admin", r"(?i)/wp-admin/", "wp", "admin"),
    pattern_rule("block", "cart", r"(?i)/cart(?:[/?#]|$)", "cart"),
    pattern_rule("block", "checkout", r"(?i)/checkout(?:[/?#]|$)", "checkout"),
    pattern_rule("block", "search", r"(?i)/search/?\?", "search"),
    pattern_rule("block", "tag_pages", r"(?i)/tag/[^/?#]+/page/\d+", "tag", "page"),
    pattern_rule("block", "feed", r"(?i)/feed/?(?:[?#]|$)", "feed"),
    pattern_rule("block", "ad_host", r"(?i)://(?:[^/?#]*\.)?(?:ads)\.", "ads"),
    pattern_rule("block", "casino", r"(?i)://[^/?#]*\bcasino\b", "casino"),
    pattern_rule("block", "porn", r"(?i)://[^/?#]*\bporn\b", "porn"),
    pattern_rule("block", "xxx", r"(?i)://[^/?#]*\bxxx\b", "xxx"),
    pattern_rule("block", "numeric_host", r"^[a-zA-Z]+://\d{1,3}(?:\.\d{1,3}){3}(?:[:/?#]|$)"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty where it has no ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return host, path


def url_tokens(url: Column) -> Column:
    text = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({TOKEN})"), 1))


def token_counts(pages: DataFrame, tokens: set[str], url: str = "url") -> dict[str, int]:
    """How many rows' URLs contain each of the rules' tokens; bounded by the rule list."""
    if not tokens:
        return {}
    found = pages.select(F.explode(F.array_intersect(url_tokens(F.col(url)), F.lit(sorted(tokens)))).alias("token"))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


def _literal(rules: list[tuple[str, Rule]]) -> Column:
    fields = "array<struct<token:string,name:string,verdict:string,pattern:string,site:boolean,rank:int,reported:boolean>>"
    if not rules:
        return F.array().cast(fields)
    return F.array(*[
        F.struct(F.lit(token).alias("token"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"),
                 F.lit(r.pattern).alias("pattern"), F.lit(r.target == "site").alias("site"),
                 F.lit(r.rank).alias("rank"), F.lit(r.reported).alias("reported"))
        for token, r in rules]).cast(fields)


def rule_index(spark, rules: list[Rule], counts: dict[str, int]) -> tuple[Column, int, Column]:
    """Rules filed in hash buckets under their rarest token, and the rules without one."""
    filed = [(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), r) for r in rules if r.tokens]
    size = max(1, 2 * len(filed))
    buckets: list[list[tuple[str, Rule]]] = [[] for _ in range(size)]
    tokens = sorted({t for t, _ in filed})
    if tokens:
        # Spark's own hash decides the bucket on both sides.
        where = spark.range(1).select(*[F.pmod(F.xxhash64(F.lit(t)), F.lit(size)).alias(str(k)) for k, t in enumerate(tokens)]).first()
        place = dict(zip(tokens, where, strict=True))
        for token, rule in filed:
            buckets[place[token]].append((token, rule))
    return F.array(*map(_literal, buckets)), size, _literal([("", r) for r in rules if not r.tokens])


def judge_urls(pages: DataFrame, rules: list[Rule] = SITE_RULES + PATTERN_RULES, url: str = "url",
               default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    Among the rules that fit, the highest rank decides (ties: the smaller name).
    ``rule`` names it if it is a reported one.
    """
    counts = token_counts(pages, {t for r in rules for t in r.tokens}, url)
    index, size, always = rule_index(pages.sparkSession, rules, counts)
    host, path = split_url(F.col(url))
    text, site = F.coalesce(F.col(url), F.lit("")), F.concat(host, path)
    found = F.flatten(F.transform(url_tokens(F.col(url)), lambda t: F.filter(
        F.element_at(index, (F.pmod(F.xxhash64(t), F.lit(size)) + 1).cast("int")), lambda e: e["token"] == t)))
    fits = F.filter(F.concat(found, always), lambda e: F.when(e["site"], F.regexp_like(site, e["pattern"]))
                    .otherwise(F.regexp_like(text, e["pattern"])))
    best = F.array_min(F.transform(fits, lambda e: F.struct(
        (-e["rank"]).alias("order"), e["name"].alias("name"), e["verdict"].alias("verdict"), e["reported"].alias("reported"))))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return (pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"), best.alias("__best"))
            .select(*[f"`{c}`" for c in kept], "host", "path",
                    F.when(F.col("__best.reported"), F.col("__best.name")).alias("rule"),
                    F.coalesce(F.col("__best.verdict"), F.lit(default)).alias("verdict")))
