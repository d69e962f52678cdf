"""URL filter: rules for hosts and paths, and a list of URLs behind a blocked Bloom filter. DataFrame functions only.

**Rules** name a host, with all its subdomains, and a path prefix; the longest rule that fits decides. They are code, a
few entries, and become one expression.

**List.** Listed URLs are brought to a canonical form and set in a blocked Bloom filter (:mod:`lotbook.llm.bloom`). A
URL whose bits are all set is a possible hit, and only possible hits go to the exact hash join with the list, which
removes the false ones. The filter's size is fixed by the number of listed URLs up to ``MAX_BLOCKS`` blocks (5 MB), so
it can always be broadcast; a longer list gives more possible hits and the same result.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``,
``#`` or the end; both are empty without ``://`` and for null. Defined cases: a null or shapeless URL fits no rule and is
on no list, so it is allowed; repeated rows each get a verdict; null list entries are left out; an empty list blocks
nothing; an empty table gives an empty result. Input columns named like a result give way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.llm import bloom
from lotbook.sources.scratch import save_counted

MAX_BLOCKS = bloom.MAX_BLOCKS
_PARTS = r"^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)" + _PARTS, 1)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)" + _PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.`` and path without closing slashes; null without a host."""
    bare = F.regexp_replace(host, r"^(?:www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (length, rule, verdict) of the longest fitting rule of (verdict, host, path); null if none fits.

    Among rules of one length the greater text wins, a block before an allow of the same rule.
    """
    if not rules:
        return F.lit(None).cast("struct<length: int, rule: string, verdict: string>")
    entries = F.array(*[
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in rules])
    return F.array_max(F.filter(entries, lambda e: e.isNotNull()))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, *, url_col: str = "url",
    listed_col: str = "url", keep: Sequence[str] | None = None,
) -> DataFrame:
    """Adds ``host, path, rule, verdict``: the longest rule's verdict, else block if the canonical URL is listed.

    ``listed`` holds URLs in the column ``listed_col``.
    """
    new = {"host", "path", "rule", "verdict"}
    keep = [c for c in (pages.columns if keep is None else keep) if c.lower() not in new]
    url = F.col(url_col)
    parted = pages.select(*keep, host(url).alias("_host"), path(url).alias("_path"))
    ruled = parted.withColumn("_rule", longest_rule(F.col("_host"), F.col("_path"), rules)).withColumn(
        "_url", canonical(F.col("_host"), F.col("_path")))

    own = F.col(listed_col)
    entries, n_listed = save_counted(
        listed.select(canonical(host(own), path(own)).alias("url")).filter("url IS NOT NULL").distinct(), "listed")
    ruled = ruled.withColumn("_open", F.when(F.col("_rule").isNull(), F.col("_url")))
    tested = bloom.marked(ruled, "_open", bloom.build(entries, "url", n_listed, MAX_BLOCKS), "_hit")
    tested = tested.withColumn("_possible", F.when(F.col("_hit"), F.col("_open"))).drop("_hit", "_open")
    exact = entries.select(F.col("url").alias("_possible"), F.lit(True).alias("_listed"))
    hits = tested.filter(F.col("_possible").isNotNull()).join(exact.hint("shuffle_hash"), "_possible", "left")
    rest = tested.filter(F.col("_possible").isNull()).withColumn("_listed", F.lit(None).cast("boolean"))
    both = hits.select(*rest.columns).unionByName(rest)
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), "block"), F.lit("allow"))
    return both.select(*keep, F.col("_host").alias("host"), F.col("_path").alias("path"),
                       F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
