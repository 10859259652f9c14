"""What leaves the engine: export rows, the negative sheet, run history and its figures, display names, search plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.functions.text import clean, strip_last_segment
from pressmill.functions.url import unwrap_hyperlink
from pressmill.operators import merge

# Accepted column names of each export column, defaults of empty cells, display names of media.
ALIASES = {
    "isu": ("isu", "issue", "topik_isu"),
    "title": ("title", "judul"),
    "link": ("link", "url", "resolved_url", "link_website"),
    "published": ("published", "tanggal", "pub_date"),
    "media": ("media_name", "source", "media"),
    "tone": ("tone", "sentimen"),
    "unit": ("unit_eselon", "unit"),
    "source_data": ("sumber_data", "source_data"),
}
DEFAULTS = {"tone": "Netral", "unit": "-", "source_data": "RSS"}
MEDIA_NAMES = {
    "detikcom": "Detik", "antaranews": "Antaranews", "kumparan": "Kumparan", "kompas": "Kompas", "republika": "Republika", "kontan": "Kontan",
    "liputan6": "Liputan6", "medcom": "Medcom", "viva": "VIVA", "bisnis": "Bisnis Indonesia", "tempo": "Tempo",
}
_SITE = r"(?i)\.(?:co\.id|com|id|co|tv|org|net)$"
NO_MEDIA = "Media Nasional"
KEEP_RUNS = 30


def export_rows(articles: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """One column per export column from whichever alias is filled; PDF and dropped rows go; empty cells get their defaults."""
    there = {c.lower(): c for c in articles.columns}

    def filled(names: Sequence[str]) -> Column:
        cells = [F.col(f"`{there[n]}`").cast("string") for n in names if n in there]
        return F.coalesce(*(clean(c) for c in cells)) if cells else F.lit(None).cast("string")

    status = F.lower(F.trim(F.col(f"`{there['status']}`"))) if "status" in there else F.lit("")
    df = articles.select(*(filled(names).alias(name) for name, names in aliases.items()), F.coalesce(status, F.lit("")).alias("_status"))
    df = df.withColumns({"link": unwrap_hyperlink(F.col("link"))} | {name: F.coalesce(name, F.lit(value)) for name, value in DEFAULTS.items()})
    pdf = (F.upper("source_data") == "PDF") | F.coalesce(F.rlike("link", F.lit(r"(?i)\.pdf(?:[?#]|$)")), F.lit(False))
    return df.filter(~pdf & (F.col("_status") != "buang")).withColumn("isu", F.coalesce("isu", strip_last_segment(F.col("title")))).drop("_status")


def negative_sheet(articles: DataFrame, summaries: DataFrame, placeholder: str = "-") -> DataFrame:
    """One summary per Negatif article (link, title), by link, else by lower title, else the placeholder; each summary is used once.

    articles, summaries (with summary): in order of their links, titles and summaries."""
    key = F.lower(F.trim("title"))
    negative = articles.filter("tone = 'Negatif'").select("link", "title")
    found = merge.match_once(negative, summaries.select("link", "title", "summary"), [(F.col("link"), F.col("link")), (key, key)], [F.col("link"), F.col("title")], [F.col("link"), F.col("title"), F.col("summary")])
    nth = lambda df: df.withColumn("_n", F.row_number().over(Window.partitionBy("link", "title").orderBy(F.col("summary").asc_nulls_last())))
    given = nth(found.select("l.link", "l.title", "r.summary"))
    bare = negative.withColumn("_n", F.row_number().over(Window.partitionBy("link", "title").orderBy("link")))
    same = bare["link"].eqNullSafe(given["link"]) & bare["title"].eqNullSafe(given["title"]) & (bare["_n"] == given["_n"])
    return bare.join(given, same, "left").select(bare["link"], bare["title"], F.coalesce("summary", F.lit(placeholder)).alias("summary"))


def run_history(runs: DataFrame, new: DataFrame, at: str, keep: int = KEEP_RUNS) -> DataFrame:
    """The newest runs, with the new ones (keep is the size of the history shown)."""
    return runs.unionByName(new).orderBy(F.desc(at), *(c for c in runs.columns if c != at)).limit(keep)


def run_filter(runs: DataFrame, status: str | None = None, term: str | None = None, fields: Sequence[str] = ()) -> DataFrame:
    """Runs of a status whose shown time or range holds the term."""
    if status and status != "Semua":
        runs = runs.filter(F.col("status") == status)
    if term and fields:
        hit = F.lit(False)
        for name in fields:
            hit = hit | F.coalesce(F.contains(F.lower(name), F.lit(term.lower())), F.lit(False))
        runs = runs.filter(hit)
    return runs


def run_kpis(runs: DataFrame, status: Column, duration: Column) -> DataFrame:
    """total, success_pct (100 without runs) and mean_seconds of durations like '3m 05s'."""
    parts = lambda i: F.coalesce(F.regexp_extract(duration, r"^\s*(\d+)m\s*(?:(\d+)s?)?", i).try_cast("int"), F.lit(0))
    seconds = F.when(F.contains(duration, F.lit("m")), parts(1) * 60 + parts(2))
    out = runs.agg(F.count("*").alias("total"), F.count_if(status == "Berhasil").alias("good"), F.avg(seconds).alias("mean"))
    half_up = lambda c: F.floor(c + 0.5).cast("long")
    return out.select("total", F.when(F.col("total") > 0, half_up(100.0 * F.col("good") / F.col("total"))).otherwise(100).alias("success_pct"), half_up(F.coalesce("mean", F.lit(0.0))).alias("mean_seconds"))


def media_name(media: Column) -> Column:
    """Display name of a medium: known brands, else without the site's ending."""
    m = F.trim(F.coalesce(media, F.lit("")))
    m = F.when(F.startswith(F.lower(m), F.lit("advertorial ")), F.substr(m, F.lit(13))).otherwise(m)
    m = F.regexp_replace(m, _SITE, "")
    known = F.create_map(*(F.lit(x) for pair in MEDIA_NAMES.items() for x in pair))
    return F.when(F.coalesce(media, F.lit("")) == "", NO_MEDIA).otherwise(F.coalesce(F.try_element_at(known, F.lower(m)), m))


def number_display(n: Column) -> Column:
    """1.234.567"""
    return F.coalesce(F.translate(F.format_number(n.cast("long"), 0), ",", "."), F.lit("0"))


def name_queries(officials: DataFrame, name: str, keywords: str, size: int = 4) -> DataFrame:
    """One search expression per official and chunk of ``size`` keywords: "name" ("a" OR "b"). keywords: array."""
    chunks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(keywords) / F.lit(size)).cast("int") - 1), lambda i: F.slice(keywords, i * size + 1, size))
    quoted = lambda k: F.when(F.rlike(k, F.lit('^".*"$')), k).otherwise(F.concat(F.lit('"'), k, F.lit('"')))
    rows = officials.filter(F.size(keywords) > 0).select(name, F.posexplode(chunks).alias("chunk", "words"))
    return rows.select(name, "chunk", F.concat(F.lit('"'), name, F.lit('" ('), F.array_join(F.transform("words", quoted), " OR "), F.lit(")")).alias("expression"))


def matched_label(words: Column, title: Column, tail: str) -> Column:
    """The words that the title holds, then the tail."""
    hits = F.filter(words, lambda w: F.contains(F.lower(title), F.lower(w)))
    return F.array_join(F.concat(hits, F.array(F.lit(tail))), ", ")
