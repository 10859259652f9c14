"""Readers of landing files: keywords, officials, releases, labels, page tables. Live fetching stays outside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.functions.dates import to_day
from pressmill.functions.text import clean


def keywords(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("keyword")).filter("keyword <> ''")


def keyword_groups(words: DataFrame) -> DataFrame:
    """base, variants: 'industri X' goes to base X, else to the base with the most common words (first on ties)."""
    w = words.select(F.lower("keyword").alias("k"), F.monotonically_increasing_id().alias("pos"))
    derived = F.col("k").startswith("industri ") & (F.col("k") != "industri agro")
    bases = w.filter(~derived).select(F.col("k").alias("base"), F.col("pos").alias("bpos"))
    rest = w.filter(derived).withColumn("tail", F.expr("substring(k, 10)"))
    words_of = lambda c: F.split(c, " ")
    # a keyword file of a hundred lines: blocked by a shared word
    hit = rest.withColumn("word", F.explode(words_of("tail"))).join(bases.withColumn("word", F.explode(words_of("base"))), "word")
    score = F.when(F.col("tail") == F.col("base"), 1000).otherwise(F.size(F.array_intersect(words_of("tail"), words_of("base"))))
    best = hit.withColumn("s", score).withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("s"), "bpos"))).filter("r = 1")
    return bases.join(best.select("base", "k", "pos"), "base", "left").groupBy("base").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("pos", "k")))), lambda x: x["k"]).alias("variants"))


def csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def releases(local: DataFrame, cache: DataFrame) -> DataFrame:
    """Releases by clean lower title; local beats cache."""
    both = local.withColumn("_p", F.lit(0)).unionByName(cache.withColumn("_p", F.lit(1)), allowMissingColumns=True).withColumn("_k", F.lower(F.trim("judul"))).filter(F.coalesce(F.col("_k"), F.lit("")) != "")
    return both.groupBy("_k").agg(F.min_by(F.struct("judul", "tanggal", "url"), "_p").alias("r")).select("r.judul", to_day(F.col("r.tanggal")).alias("tanggal"), "r.url")


def mart_rows(articles: DataFrame, fallback: str) -> DataFrame:
    """Typed mart rows: rows without title or link go, unknown tones are Netral, missing dates get the fallback at 08:00."""
    tone = F.when(F.col("tone").isin("Positif", "Netral", "Negatif"), F.col("tone")).otherwise("Netral")
    at = F.coalesce(F.col("published").cast("timestamp"), F.to_timestamp(F.lit(f"{fallback} 08:00:00")))
    return articles.withColumns({"title": clean(F.col("title")), "link": clean(F.col("link"))}).filter("title is not null and link is not null").withColumns({"tone": tone, "published": at})


def labels(key: DataFrame, blind: DataFrame, allowed: list[str]) -> DataFrame:
    """Labelled rows by id, with the invalid ones dropped."""
    return key.join(blind.filter(F.col("label").isin(*allowed)), "id")


def page_text(html):
    """Main text of a page by expressions: scripts, styles and tags removed, entities decoded, spaces collapsed."""
    from pressmill.functions.text import unescape_html

    bare = F.regexp_replace(html, r"(?is)<(script|style|nav|header|footer)[^>]*>.*?</\1>", " ")
    return F.trim(F.regexp_replace(unescape_html(F.regexp_replace(bare, r"(?s)<[^>]+>", " ")), r"\s+", " "))
