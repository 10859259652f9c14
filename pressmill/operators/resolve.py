"""Link resolution as joins: positive cache, metadata filter, negative cache, decoded landing rows, metadata URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.url import escaped, first_usable, host, is_decoded

# Hosts and titles of aggregator items that are never decoded.
AGGREGATOR = "news.google.com"
_MAPS_TITLE = r"(?i)-\s*google\s*maps\s*$"
_MAPS_NAMES = ("google maps", "maps.google.com")
#: Methods that a decoded row can come by, as counted by decode_stats.
OFFLINE, LOCAL, METADATA = "decode_offline", "decode_local", "fallback_meta"
SEARCHES = ("fallback_serper", "fallback_exa", "fallback_search")


def is_id_host(url: Column) -> Column:
    """Hosts below .id only."""
    return F.coalesce(host(url).endswith(".id"), F.lit(False))


def hosts_match(candidate: Column, expected: Column) -> Column:
    """Same host, or one is a subdomain of the other."""
    own, other = host(candidate), F.coalesce(expected, F.lit(""))
    same = (own == other) | own.endswith(F.concat(F.lit("."), other)) | other.endswith(F.concat(F.lit("."), own))
    return F.coalesce((other != "") & (own != "") & same, F.lit(False))


def metadata_urls(html: Column) -> Column:
    """Link targets of an item's HTML, in order."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?i)href\s*=\s*["']([^"']++)["']"""), 1)


def prefilter_reason(title: Column, media: Column, source_url: Column, job_hosts: Sequence[str]) -> Column:
    """Why an item is refused before decoding; null where it is not."""
    name, site = F.lower(F.trim(F.coalesce(media, F.lit("")))), F.coalesce(host(source_url), F.lit(""))
    out = F.when(F.coalesce(F.rlike(title, F.lit(_MAPS_TITLE)), F.lit(False)) | name.isin(*_MAPS_NAMES), "prefiltered_google_maps")
    out = out.when((site == "google.com") | (site.endswith(".google.com") & (site != AGGREGATOR)), "prefiltered_google_source")
    if job_hosts:
        job = F.regexp_extract(site, rf"^(?:.*\.)?({escaped(tuple(job_hosts))})$", 1)
        out = out.when(job != "", F.concat(F.lit("prefiltered_job_portal:"), job))
    return out


def resolve(items: DataFrame, cache: DataFrame, failed: DataFrame, decoded: DataFrame, now: Column, job_hosts: Sequence[str] = ()) -> DataFrame:
    """items (link, title, media, source_url, candidates: array) with url, resolved and method; the first layer that answers wins.

    cache: link, url. failed: link, until. decoded: link, url, method (landing rows of the decoder). One row per link each."""
    link = F.trim(F.coalesce("link", F.lit("")))
    known = cache.select(F.col("link").alias("_l1"), F.col("url").alias("_cached"))
    bad = failed.filter(F.col("until") > now).select(F.col("link").alias("_l2"), F.lit(True).alias("_failed"))
    landed = decoded.select(F.col("link").alias("_l3"), F.col("url").alias("_decoded"), F.col("method").alias("_how"))
    df = items.withColumn("_l", link).join(known, F.col("_l") == F.col("_l1"), "left").join(bad, F.col("_l") == F.col("_l2"), "left").join(landed, F.col("_l") == F.col("_l3"), "left")
    layers = [
        (~F.col("_l").contains(AGGREGATOR), F.col("_l"), F.lit("direct")),
        (F.col("_cached").isNotNull(), F.col("_cached"), F.lit("cache")),
        (prefilter_reason(F.col("title"), F.col("media"), F.col("source_url"), job_hosts).isNotNull(), None, F.lit("pre_filtered")),
        (F.coalesce("_failed", F.lit(False)), None, F.lit("negative_cache")),
        (F.col("_how").isin(OFFLINE, LOCAL) & is_decoded(F.col("_decoded")), F.col("_decoded"), F.col("_how")),
        (F.col("_how") == "rejected_target", None, F.lit("rejected_target")),
        (first_usable(F.col("candidates")).isNotNull(), first_usable(F.col("candidates")), F.lit(METADATA)),
        (F.col("_how").isin(*SEARCHES) & is_decoded(F.col("_decoded")), F.col("_decoded"), F.col("_how")),
    ]
    method, url = F.lit("failed"), F.lit(None).cast("string")
    for hit, answer, how in reversed(layers):
        hit = F.coalesce(hit, F.lit(False))
        method, url = F.when(hit, how).otherwise(method), F.when(hit, F.lit(None).cast("string") if answer is None else answer).otherwise(url)
    out = df.withColumns({"_m": method, "_u": F.nullif(url, F.lit(""))})
    return out.select(*items.columns, F.coalesce("_u", "_l").alias("url"), F.col("_u").isNotNull().alias("resolved"), F.col("_m").alias("method"))


def decode_stats(df: DataFrame, by: Sequence[str], link: Column, method: Column, failed: Column, text_length: Column) -> DataFrame:
    """Counters of one decoding run per ``by``, with the failure percentage among decodable links."""
    m, f = F.coalesce(method, F.lit("")), F.coalesce(failed, F.lit(False))
    agg = F.coalesce(link.contains(AGGREGATOR), F.lit(False))
    good, bad = agg & ~f, agg & f
    kept_out = ("negative_cache", "rejected_target", "pre_filtered")
    counters = {
        "extract_total": F.lit(True),
        "extract_ok": text_length >= 300,
        "extract_short": (F.coalesce(text_length, F.lit(0)) < 300) & ~f,
        "gnews_total": agg,
        "cache_hit": good & (m == "cache"),
        "negative_cache_hit": bad & (m == "negative_cache"),
        "rejected_target": bad & (m == "rejected_target"),
        "pre_filtered": bad & (m == "pre_filtered"),
        "decode_offline": good & (m == OFFLINE),
        "decode_local": good & (m == LOCAL),
        "decode_ok": good & ~m.isin("cache", METADATA, *SEARCHES),
        "fallback_meta": good & (m == METADATA),
        "fallback_search": good & m.isin(*SEARCHES),
        "decode_fail": bad & ~m.isin(*kept_out),
        "circuit_skipped": bad & (m == "circuit_skipped"),
    }
    out = df.groupBy(*by).agg(*(F.count_if(test).alias(name) for name, test in counters.items()))
    valid = F.greatest(F.lit(0), F.col("gnews_total") - F.col("rejected_target") - F.col("pre_filtered"))
    return out.withColumn("fail_pct", F.when(valid > 0, 100.0 * F.col("decode_fail") / valid).otherwise(0.0))
