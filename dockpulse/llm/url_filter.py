"""URL filters: pattern rules indexed by their rarest literal token."""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_BREAK = "[^a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """``regex`` is searched for in host, path and query; ``tokens`` are words that every url it fits holds as whole tokens."""

    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str
    listed: bool = False


def host_rule(rule: str, verdict: str) -> UrlRule:
    """A listed rule ``host/path``: fits the host and its subdomains where the path starts with the rule's path."""
    host, _, path = rule.partition("/")
    whole = host.split(".") + path.lower().split("/")[:-1]
    tokens = tuple(t for part in whole for t in re.split(TOKEN_BREAK, part) if t)
    return UrlRule(rule, rf"^(?:[^/?#]*\.)?{re.escape(host)}/{re.escape(path)}", tokens, verdict, listed=True)


# Listed rules of the contract, and patterns for what no listed rule fits.
LISTED_RULES = (
    host_rule("org/", "allow"),
    host_rule("example.org/es/", "block"),
    host_rule("example.org/en/1", "block"),
    host_rule("com/fr/", "allow"),
    host_rule("com/de/", "block"),
)
PATTERN_RULES = (
    UrlRule("spam farm", r"^(?:[^/?#]*[.-])?spam-farm\.", ("spam", "farm"), "block"),
    UrlRule("cheap pills", r"^(?:[^/?#]*[.-])?cheap-pills\.", ("cheap", "pills"), "block"),
    UrlRule("casino", r"^(?:[^/?#]*[.-])?casino[.-]", ("casino",), "block"),
    UrlRule("adult", r"^(?:[^/?#]*[.-])?xxx[.-]", ("xxx",), "block"),
    UrlRule("login page", r"/login(?:[/?#]|$)", ("login",), "block"),
    UrlRule("login page", r"/signin(?:[/?#]|$)", ("signin",), "block"),
    UrlRule("session id", r"[?&]phpsessid=", ("phpsessid",), "block"),
)


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def parsed(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, target): host in lower case, and the text that rules are searched for in.  Empty without ``://``."""
    rest = F.coalesce(after_scheme(url), F.lit(""))
    raw = F.regexp_extract(rest, "^([^/?#]*)", 1)
    host = F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path, F.concat(host, F.substring(rest, F.length(raw) + 1, F.length(rest)))


def tokens(target: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(target), TOKEN_BREAK), lambda t: t != ""))


def rule_index(urls: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """(number, name, regex, verdict, listed, token): the token is the rule's rarest over all urls."""
    for rule in rules:
        if not rule.tokens:
            raise ValueError(f"rule {rule.name} has no literal token to be found by")
    spark = urls.sparkSession
    rows = [
        F.struct(
            F.lit(i).alias("number"),
            F.lit(r.name).alias("name"),
            F.lit(r.regex).alias("regex"),
            F.lit(r.verdict).alias("verdict"),
            F.lit(r.listed).alias("listed"),
            F.array(*map(F.lit, r.tokens)).cast("array<string>").alias("tokens"),
        )
        for i, r in enumerate(rules)
    ]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    rule_tokens = table.select("number", F.explode("tokens").alias("token"))
    wanted = rule_tokens.select("token").distinct()
    counts = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    rarest = (
        rule_tokens.join(counts, "token", "left")
        .groupBy("number")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token")).alias("best"))
    )
    return table.join(rarest, "number", "left").select("number", "name", "regex", "verdict", "listed", F.col("best.token").alias("token"))


def judge_urls(
    pages: DataFrame,
    listed: tuple[UrlRule, ...] = LISTED_RULES,
    patterns: tuple[UrlRule, ...] = PATTERN_RULES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) of every row.

    A url's tokens fetch the rules that are indexed by them; only those run their regular expression.  The longest listed rule that fits decides.  Where none fits, ``rule`` is null and the
    patterns decide: blocked if any fits (``pattern`` names the first), else allowed.

    Each distinct url is judged once, so a url or host in a third of all rows is no hot group.  Needs ``page_id`` and ``url``; others
    are left out.  A null url or one without ``://`` has an empty host and path, and is allowed.  Page ids pass on as they
    are, null or repeated.
    """
    host, path, target = parsed(F.col("url"))
    urls = pages.where("url is not null").select("url").distinct()
    urls = urls.select("url", host.alias("host"), path.alias("path"), target.alias("target"))
    urls = urls.withColumn("tokens", tokens(F.col("target")))
    index = rule_index(urls, listed + patterns)
    candidates = urls.select("url", "target", F.explode("tokens").alias("token")).join(index, "token")
    fitting = candidates.where("regexp_like(target, regex)")
    best = fitting.groupBy("url").agg(
        F.max(F.when(F.col("listed"), F.struct(F.length("name").alias("n"), "name", "verdict"))).alias("rule"),
        F.min(F.when(~F.col("listed") & (F.col("verdict") == "block"), F.struct("number", "name"))).alias("pattern"),
    )
    fallback = F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")
    return (
        pages.select("page_id", "url")
        .join(best, "url", "left")
        .select(
            "page_id",
            host.alias("host"),
            path.alias("path"),
            F.col("rule.name").alias("rule"),
            F.coalesce("rule.verdict", fallback).alias("verdict"),
            F.when(F.col("rule").isNull(), F.col("pattern.name")).alias("pattern"),
        )
    )
