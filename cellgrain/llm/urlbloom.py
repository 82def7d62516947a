"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join of its possible hits.

A listed URL sets BITS bits in one block of 64 * WORDS; the filter is a table of blocks, built by a grouped bit-or,
some PER_BLOCK URLs a block whatever the list's size. Its rows are counted: a small filter is broadcast, a larger one meets
the pages in a salted shuffle by block. URLs whose bits are all set meet the list itself in a join on the canonical URL. DataFrame functions only.

Cases: a null URL or one without ``://`` has an empty host and path, meets no rule and is never listed; an empty list
or table gives no hits; repeated rows are judged each; a URL of any length is handled whole; extra columns pass
through unless a result column has their name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cellgrain.llm.common import SALT, cut, lookup_join

#: 64-bit words of a block, bits of a URL, URLs of a block.
WORDS, BITS, PER_BLOCK = 4, 8, 16
#: Fixed values: (verdict, host, path) of the contract's rules.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: Hosts with one of these words supply the query's list.
LISTED_HOST_WORDS = ("casino", "bets", "pills", "ads-track", "spam-farm", "adult-x")
#: Query parameters that don't choose a page.
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Without scheme, port, ``www.`` or ``m.``, fragment, tracking parameters, ``.html`` and a last slash; the other
    parameters sorted. Null without a host."""
    rest = after_scheme(url)
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":\d*$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(/|\.html)$", "")
    query = F.split(F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def bloom_key(url: Column, blocks: int) -> list[Column]:
    """The block of a URL and its WORDS masks: BITS places of a block, from two hashes."""
    h = F.pmod(F.xxhash64(url), F.lit(64 * WORDS))
    g = F.pmod(F.xxhash64(url, F.lit(1)), F.lit(32 * WORDS)) * 2 + 1  # odd: all places differ
    places = [F.pmod(h + g * i, F.lit(64 * WORDS)) for i in range(1, BITS + 1)]
    one = F.lit(1).cast("long")
    masks = [reduce(lambda a, b: a.bitwiseOR(b), (F.when(F.floor(p / 64) == w, F.call_function("shiftleft", one, F.pmod(p, F.lit(64)).cast("int"))).otherwise(F.lit(0).cast("long")) for p in places)).alias(f"_w{w}") for w in range(WORDS)]
    return [F.pmod(F.xxhash64(url, F.lit(2)), F.lit(blocks)).cast("long").alias("_block"), *masks]


def build_filter(listed: DataFrame, url: str, n: int) -> tuple[DataFrame, int]:
    """The filter's blocks and their number, for ``n`` listed URLs."""
    blocks = max(64, 1 << (n // PER_BLOCK).bit_length())
    rows = listed.select(*bloom_key(F.col(url), blocks))
    return rows.groupBy("_block").agg(*(F.bit_or(f"_w{w}").alias(f"_f{w}") for w in range(WORDS))), blocks


def mark_listed(pages: DataFrame, listed: DataFrame, url: str = "canonical_url", out: str = "listed") -> DataFrame:
    """Adds ``out``: whether the row's URL is among the distinct URLs of ``listed``'s only column."""
    name = listed.columns[0]
    listed = cut(listed.where(F.col(name).isNotNull()).distinct().withColumnRenamed(name, "_url"))
    bits, blocks = build_filter(listed, "_url", listed.count())
    keys = bloom_key(F.coalesce(F.col(url), F.lit("")), blocks)
    probe = lookup_join(pages.select("*", *keys), bits, ["_block"], F.monotonically_increasing_id())
    possible = reduce(lambda a, b: a & b, (F.col(f"_f{w}").bitwiseAND(F.col(f"_w{w}")) == F.col(f"_w{w}") for w in range(WORDS)))
    probe = probe.withColumn("_hit", F.coalesce(possible, F.lit(False)) & F.col(url).isNotNull()).drop("_block", *(f"_{k}{w}" for k in "fw" for w in range(WORDS)))
    # Misses leave here; the hits' URLs meet the list. The salt deals one common URL over many tasks.
    salted = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).withColumn("_listed", F.lit(True))
    hits = probe.where("_hit").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALT)).cast("int")).withColumn("_url", F.col(url))
    exact = hits.join(salted, ["_url", "_salt"], "left").withColumn(out, F.coalesce("_listed", F.lit(False))).drop("_url", "_salt", "_listed", "_hit")
    return exact.unionByName(probe.where(~F.col("_hit")).drop("_hit").withColumn(out, F.lit(False)))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, h + p) if text is None else text.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (text, verdict) if text is not None else (F.lit(None).cast("string"),) * 2


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule, canonical_url, listed and verdict: the rule's, else block if listed."""
    x = pages.drop("host", "path", "rule", "canonical_url", "listed", "verdict")
    url = F.coalesce("url", F.lit(""))
    x = x.withColumns({"host": host_of(url), "path": path_of(url), "canonical_url": canonical(url)})
    x = mark_listed(x, listed)
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return x.withColumn("rule", text).withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")))


def listed_urls(pages: DataFrame) -> DataFrame:
    """The query's list: canonical URLs of pages on hosts with a word of LISTED_HOST_WORDS."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(canonical(url).alias("u"), host_of(url).alias("h")).where(F.col("h").rlike("|".join(LISTED_HOST_WORDS))).select("u")


def url_verdicts(pages: DataFrame) -> DataFrame:
    """The contract's rows."""
    return judge(pages.select("page_id", "url"), listed_urls(pages)).select("page_id", "host", "path", "rule", "verdict", "canonical_url", "listed")


def sql() -> str:
    fits = [(h + p, kind, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for kind, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for t, _, c in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for _, k, c in fits) + " END"
    return rf"""WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))), '&') AS kept FROM a),
c AS (SELECT *, CASE WHEN regexp_replace(regexp_replace(host, ':\d*$', ''), '^(www|m)\.', '') <> '' THEN regexp_replace(regexp_replace(host, ':\d*$', ''), '^(www|m)\.', '') || regexp_replace(path, '(/|\.html)$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canonical_url FROM b),
l AS (SELECT DISTINCT canonical_url FROM c WHERE regexp_matches(host, '{"|".join(LISTED_HOST_WORDS)}') AND canonical_url IS NOT NULL),
d AS (SELECT *, canonical_url IS NOT NULL AND canonical_url IN (SELECT canonical_url FROM l) AS listed, {rule} AS rule, {verdict} AS said FROM c)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, canonical_url, listed FROM d"""
