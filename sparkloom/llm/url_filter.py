"""URL verdicts: host and path rules first, then a list behind a blocked Bloom filter."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sparkloom.operators.scale import cut_lineage

BLOCK_WORDS = 8
_KEYS_PER_BLOCK = 40  # about 13 bits for each key
_MOST_BLOCKS = 1 << 17  # 9 MB at nine longs a block: the broadcast never grows beyond
_TRACKING = r"(^|&)(utm_[^=&]*|ref|gclid|fbclid)(=[^&]*)?"


@dataclass(frozen=True)
class UrlRule:
    """Holds for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, query without tracking parts; no scheme or fragment."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, _TRACKING, ""), "^&", "")
    place = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(query == "", place).otherwise(F.concat(place, F.lit("?"), query))


def longest_rule(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, null where none does; equal lengths go by their text."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """One bit in each of the block's words: six bits of a second hash choose it."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(BLOCK_WORDS)]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """Rows ``(block, word0 .. word7)`` over the column ``listed``; made by OR in partial aggregates."""
    words = [F.bit_or(m).alias(f"word{k}") for k, m in enumerate(_masks(F.col("listed")))]
    return listed.groupBy(_block(F.col("listed"), blocks).alias("block")).agg(*words)


def judge_urls(
    df: DataFrame, listed_urls: DataFrame, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", rules: tuple[UrlRule, ...] = RULES
) -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict, canonical, listed)``, one per row of ``df``.

    The verdict is the longest fitting rule's; without one, ``block`` for URLs whose canonical form
    is listed and ``allow`` for others.

    Rows that the filter clears never leave their task. Only possible hits are shuffled to
    the list, which has one row per canonical URL, so a hit never multiplies and Spark
    can split a URL that very many rows share. The filter has at most 2^17 blocks and is safe to broadcast;
    a longer list makes it less selective, not wrong.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule, are never
    listed and are allowed. Null ids and repeated rows pass through. An empty list blocks
    nothing. Other columns are not looked at.
    """
    listed = cut_lineage(listed_urls.select(canonical(F.col(listed_col)).alias("listed")).filter(host_of(F.col(listed_col)) != "").distinct())
    count = listed.select(F.approx_count_distinct("listed")).first()[0]
    blocks = 1
    while blocks < _MOST_BLOCKS and blocks * _KEYS_PER_BLOCK < count:
        blocks *= 2
    bits = F.broadcast(bloom_filter(listed, blocks))

    url = F.col("_url")
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rows = rows.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    asked = (F.col("host") != "") & F.col("_rule").isNull()
    probed = rows.join(bits, F.when(asked, _block(F.col("canonical"), blocks)) == F.col("block"), "left")
    hit = F.col("block").isNotNull()
    for k, m in enumerate(_masks(F.col("canonical"))):
        hit = hit & (F.col(f"word{k}").bitwiseAND(m) == m)
    probed = probed.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("_hit"))
    hits = probed.filter("_hit").join(listed, F.col("canonical") == F.col("listed"), "left")
    judged = hits.select(*rows.columns, F.col("listed").isNotNull().alias("listed"))
    judged = judged.unionByName(probed.filter("not _hit").select(*rows.columns, F.lit(False).alias("listed")))
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", method).alias("verdict"), "canonical", "listed"
    )
