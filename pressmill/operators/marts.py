"""Marts and dashboard queries: daily summaries, run statistics, issue cards, search pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TONES = ("Positif", "Netral", "Negatif")


def daily_summary(df: DataFrame, day: Column, tone: Column) -> DataFrame:
    """Per day: count, positive, negative, and net (the rest)."""
    per = df.groupBy(day.alias("day")).agg(F.count("*").alias("total"), F.count_if(tone == "Positif").alias("positif"), F.count_if(tone == "Negatif").alias("negatif"))
    return per.withColumn("netral", F.col("total") - F.col("positif") - F.col("negatif"))


def exploded_counts(df: DataFrame, names: Column) -> DataFrame:
    """Counts of comma-separated names, '-' and empty ignored."""
    return df.select(F.explode(F.split(names, ",")).alias("name")).withColumn("name", F.trim("name")).filter("name not in ('', '-')").groupBy("name").agg(F.count("*").alias("n"))


def noise_pct(raw: Column, final: Column) -> Column:
    return F.coalesce(F.bround(F.try_divide((raw - final) * 100.0, raw), 0), F.lit(0.0)).cast("int")


def failure_rate(failed: Column, total: Column, rejected: Column, prefiltered: Column) -> Column:
    """Percent of decodable items that failed; 0 where nothing was decodable."""
    base = total - rejected - prefiltered
    return F.when(base > 0, F.round(failed * 100.0 / base, 1)).otherwise(0.0)


def group_tone(df: DataFrame, group: Column, tone: Column) -> DataFrame:
    """Plurality of tones, ties by Negatif, Positif, Netral; mixed where more than one tone occurs."""
    per = df.groupBy(group.alias("grp"), tone.alias("tone")).agg(F.count("*").alias("c"))
    rank = F.expr("case tone when 'Negatif' then 3 when 'Positif' then 2 else 1 end")
    return per.groupBy("grp").agg(F.max_by("tone", F.struct("c", rank)).alias("tone"), F.sum("c").alias("members"), (F.count("*") > 1).alias("mixed"))


def search_page(df: DataFrame, term: str | None, equals: dict[str, str], fields: list[str], order: list[Column], page: int, size: int = 24) -> DataFrame:
    """Filtered, ordered page; 'Semua' means no filter."""
    for c, v in equals.items():
        if v != "Semua":
            df = df.filter(F.col(c) == v)
    if term:
        df = df.filter(F.exists(F.array(*(F.lower(F.coalesce(F.col(c), F.lit(""))) for c in fields)), lambda x: x.contains(term.lower())))
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def release_coverage(releases: DataFrame, members: DataFrame, release: str, member: str) -> DataFrame:
    """Each release with the number of its members, their list, and whether it is covered."""
    per = members.groupBy(release).agg(F.count(member).alias("member_count"), F.sort_array(F.collect_list(member)).alias("members"))
    n = F.coalesce("member_count", F.lit(0)).cast("long")
    return releases.join(per, release, "left").select(release, n.alias("member_count"), F.coalesce("members", F.array().cast(per.schema["members"].dataType)).alias("members"), F.when(n == 0, "belum tercatat").otherwise("tercatat").alias("status"))


def missing_days(df: DataFrame, day: Column, first: str, last: str) -> DataFrame:
    """Days from first to last on which df has no row."""
    every = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return every.join(df.select(day.alias("day")).distinct(), "day", "left_anti")


def month_rollup(df: DataFrame, at: Column) -> DataFrame:
    """Per month: rows and days that have any."""
    return df.groupBy(F.date_format(at, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.countDistinct(F.to_date(at)).alias("days"))


def issue_cards(df: DataFrame, isu: Column, media: Column, order: Column) -> DataFrame:
    """Per issue (a missing name is 'Tanpa isu'): items, media in any case, first place in order."""
    return df.groupBy(F.coalesce(F.nullif(isu, F.lit("")), F.lit("Tanpa isu")).alias("isu")).agg(F.count("*").alias("items"), F.countDistinct(F.lower(media)).alias("media"), F.min(order).alias("first"))


def rolling_rate(df: DataFrame, key: str, order: list[str], failed: Column, size: int = 20) -> DataFrame:
    """df with rate: share of failures among the last ``size`` rows of its key, itself included."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(1 - size, 0)
    return df.withColumn("rate", F.avg(F.when(failed, 1.0).otherwise(0.0)).over(w))


def batch_slices(batches: DataFrame, late: Column) -> DataFrame:
    """Totals, failures and failure rate over all batches and over the late ones; batches: total, failed, rejected, prefiltered."""
    slices = F.explode(F.when(late, F.array(F.lit("all"), F.lit("late"))).otherwise(F.array(F.lit("all"))))
    counts = ("total", "failed", "rejected", "prefiltered")
    per = batches.withColumn("slice", slices).groupBy("slice").agg(*(F.sum(c).alias(c) for c in counts))
    return per.withColumn("fail_pct", failure_rate(*map(F.col, ("failed", "total", "rejected", "prefiltered"))).cast("double"))
