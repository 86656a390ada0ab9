"""URL filter: rules first, then a list of canonical URLs behind a blocked Bloom filter.

A rule names a host and the beginning of a path; of those that fit a URL the longest decides. Other URLs are blocked if
their canonical form is listed. The filter has blocks of 256 bits: a URL sets eight bits of one block, so a look-up is one
equality join on the block's number. It has about 16 bits for each listed URL and a largest size, hence it
is sent to every task whatever the length of the list. Only URLs that pass it are joined with the list itself, which
removes false positives, so the answer is exact for a filter of any size.

Canonical form: host without ``www.`` and port 80 or 443, path without slashes at its end, and the query's parts in order without
tracking parameters; no scheme, no fragment.

Edge cases: NULL and text without ``://`` have an empty host and path, no rule, and are allowed; equal rows are judged each;
an empty list blocks nothing; an empty table gives an empty result; further columns are not used; URLs of any length are judged whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm import bloom
from platelake.llm.shared import col, stored

ALLOW, BLOCK = "allow", "block"

#: Names of query parameters that do not change a page.
TRACKING = ("ref", "fbclid", "gclid", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def canonical(url: Column) -> Column:
    """The canonical form; empty where there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    parts = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 3), "&")
    kept = F.array_sort(F.filter(parts, lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(*TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.concat_ws("&", kept))).otherwise("")
    return F.when(host == "", F.lit("")).otherwise(F.concat(host, path, query))


def decided(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict. ``rules``: verdict and host with the path's beginning, a bounded list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for answer, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(answer)).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical`` of every page. ``listed``: ``url``, canonical."""
    entries = stored(listed.filter("url is not null and url <> ''").select("url").distinct())
    raw = col(url).cast("string")
    parsed = pages.select(col(key).alias("page_id"), host_of(raw).alias("host"), path_of(raw).alias("path"), canonical(raw).alias("canonical"))
    rule, verdict = decided(F.col("host"), F.col("path"), rules)
    ruled = parsed.select("*", rule.alias("rule"), verdict.alias("verdict"))
    open_url = F.when(F.col("verdict").isNull() & (F.col("canonical") != ""), F.col("canonical"))
    probed = bloom.may_be_in(ruled, open_url, entries, "url", "possible")
    possible = F.col("possible")
    out = ["page_id", "host", "path", "rule", "verdict", "canonical"]
    clear = probed.filter(~possible).select(*out).withColumn("verdict", F.coalesce("verdict", F.lit(ALLOW)))
    exact = entries.select(F.col("url").alias("entry"))
    checked = probed.filter(possible).select(*out).join(exact, F.col("canonical") == F.col("entry"), "left")
    found = checked.withColumn("verdict", F.when(F.col("entry").isNotNull(), F.lit(BLOCK)).otherwise(F.lit(ALLOW))).select(*out)
    return clear.union(found)
