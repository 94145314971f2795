"""URL filters: site rules by longest prefix, and pattern rules indexed by their rarest token.

A pattern rule is a regular expression over the whole url together with the literal tokens (runs of
letters and digits, lower-cased) that any match must contain. The index files a rule under the one
of its tokens that the fewest urls have, counted over all urls. A url's tokens fetch the rules filed
under them, and only those run their expression; rules without a literal run on every url.

The verdict is that of the longest site rule that fits, else ``block`` if a pattern rule matches,
else ``allow``. Rule lists are arguments, small against the data, and go to every task; the index
adds one row per rule token to the driver. Texts and urls never leave their rows: no shuffle but the
token count.

Defined cases: a missing url, or one without ``://``, has empty host and path, fits no site rule and
is allowed unless a pattern matches it; repeated rows and ids are judged alike; further columns pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


@dataclass(frozen=True)
class SiteRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """``pattern`` blocks a url it is found in; ``tokens`` are literals of every match."""

    pattern: str
    tokens: tuple[str, ...]


SITE_RULES = (
    SiteRule("allow", "org", "/"),
    SiteRule("block", "example.org", "/es/"),
    SiteRule("block", "example.org", "/en/1"),
    SiteRule("allow", "com", "/fr/"),
    SiteRule("block", "com", "/de/"),
)
#: Tokens are whole runs of letters and digits, so each pattern bounds its literals.
PATTERN_RULES = (
    PatternRule(r"://([^/?#]*\.)?ads?-track[.-]", ("track",)),
    PatternRule(r"://([^/?#]*[.-])?casino[.-]", ("casino",)),
    PatternRule(r"://([^/?#]*[.-])?adult-x\.", ("adult", "x")),
    PatternRule(r"://([^/?#]*[.-])?cheap-pills\.", ("cheap", "pills")),
    PatternRule(r"://([^/?#]*[.-])?(poker|xxx)[.-]", ()),
    PatternRule(r"[?&]aff_id=\d+", ("aff", "id")),
)
TOKEN = re.compile("[a-z0-9]+")


def token_counts(urls: DataFrame, url_col: str, tokens: list[str]) -> dict[str, int]:
    """In how many urls each of the rules' tokens occurs, over all urls; one row per token."""
    if not tokens:
        return {}
    of_url = F.array_distinct(F.split(F.lower(url_col), "[^a-z0-9]+"))
    found = urls.select(F.explode(F.array_intersect(of_url, F.array(*map(F.lit, tokens)))).alias("token"))
    return {r["token"]: r["count"] for r in found.groupBy("token").count().collect()}


def rarest_token_index(rules: tuple[PatternRule, ...], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by token; those without a literal are under the empty token."""
    index: dict[str, list[int]] = {}
    for number, rule in enumerate(rules):
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(token, []).append(number)
    return index


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def site_rule(host: str, path: str, by_host: dict[str, list[SiteRule]]) -> SiteRule | None:
    """The longest fitting rule: rules are looked up by the host and its parents."""
    fits = []
    labels = host.split(".")
    for k in range(len(labels)):
        fits += [r for r in by_host.get(".".join(labels[k:]), ()) if path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), r.text), default=None)


def judged(
    urls: DataFrame,
    url_col: str = "url",
    sites: tuple[SiteRule, ...] = SITE_RULES,
    patterns: tuple[PatternRule, ...] = PATTERN_RULES,
) -> DataFrame:
    """``urls`` with host, path, rule, verdict and ``pattern`` (number of the first that matches)."""
    counts = token_counts(urls, url_col, sorted({t for r in patterns for t in r.tokens}))
    index = rarest_token_index(patterns, counts)
    by_host: dict[str, list[SiteRule]] = {}
    for rule in sites:
        by_host.setdefault(rule.host, []).append(rule)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compiled = [re.compile(r.pattern) for r in patterns]
        for batch in batches:
            rows = []
            for url in batch:
                host, path = split_url(url)
                whole = (url or "").lower()
                fetched = sorted({n for t in {"", *TOKEN.findall(whole)} for n in index.get(t, ())})
                hit = next((n for n in fetched if compiled[n].search(whole)), None)
                rule = site_rule(host, path, by_host)
                verdict = rule.verdict if rule else "allow" if hit is None else "block"
                rows.append((host, path, rule.text if rule else None, verdict, hit))
            out = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict", "pattern"])
            out["pattern"] = out["pattern"].astype("Int64")
            yield out

    udf = F.pandas_udf(judge, "host string, path string, rule string, verdict string, pattern long")
    rest = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "pattern")]
    return urls.withColumn("_j", udf(F.col(url_col))).select(*rest, "_j.*")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages).select("page_id", "host", "path", "rule", "verdict")


URLS_SQL = r"""
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), cut AS (
  SELECT page_id, url, row_number() OVER () AS rid,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw, translate(regexp_extract(rest, '^[^/?#]*'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM cut
), pathed AS (
  SELECT *, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM parts
), fitting AS (
  SELECT rid, r.verdict, r.host || r.path AS rule,
         row_number() OVER (PARTITION BY rid ORDER BY length(r.host || r.path) DESC) AS n
  FROM pathed p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.verdict, CASE WHEN regexp_matches(lower(coalesce(url, '')),
         '://([^/?#]*\.)?ads?-track[.-]|://([^/?#]*[.-])?casino[.-]|://([^/?#]*[.-])?adult-x\.|'
         || '://([^/?#]*[.-])?cheap-pills\.|://([^/?#]*[.-])?(poker|xxx)[.-]|[?&]aff_id=\d+')
         THEN 'block' ELSE 'allow' END) AS verdict
FROM pathed p LEFT JOIN (SELECT * FROM fitting WHERE n = 1) f USING (rid)
"""

QUERIES = {"op4_url_filters": op4_url_filters}
ORACLES = {"op4_url_filters": URLS_SQL}
