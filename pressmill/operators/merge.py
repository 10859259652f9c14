"""Joins of runs, archives, caches and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.functions.text import merge_keywords


def merge_runs(base: DataFrame, other: DataFrame, key: str, fields: list[str], keywords: str, overwrite: bool = False, names: tuple[str, str] = ("lokal", "merge_from")) -> DataFrame:
    """Keyed full outer merge of two runs: base wins unless empty (overwrite: other wins), keywords are united, runs named."""
    b, o = base.alias("b"), other.alias("o")
    joined = b.join(o, F.col(f"b.{key}") == F.col(f"o.{key}"), "full_outer")
    first, second = ("o", "b") if overwrite else ("b", "o")
    filled = lambda c: F.coalesce(F.nullif(F.col(f"{first}.{c}").cast("string"), F.lit("")), F.col(f"{second}.{c}").cast("string"))
    run = F.concat_ws(" + ", F.when(F.col(f"b.{key}").isNotNull(), names[0]), F.when(F.col(f"o.{key}").isNotNull(), names[1]))
    return joined.select(F.coalesce(f"b.{key}", f"o.{key}").alias(key), *(filled(c).alias(c) for c in fields), merge_keywords(F.col(f"b.{keywords}"), F.col(f"o.{keywords}")).alias(keywords), run.alias("sumber_run"))


def latest(df: DataFrame, keys: list[str], value: str, at: Column) -> DataFrame:
    """The newest value of each key: a partial aggregate, not a sort."""
    return df.groupBy(*keys).agg(F.max_by(value, at).alias(value))


def apply_decisions(rows: DataFrame, decisions: DataFrame, key: str, stage: str, value: str, at: Column, order: list[str]) -> DataFrame:
    """Newest decision per stage, by stage priority; 'buang' drops the row; a tone decision is added as tone_decided."""
    newest = latest(decisions, [key, stage], value, at).groupBy(key).agg(
        F.coalesce(*(F.max(F.when(F.col(stage) == s, F.col(value))) for s in order)).alias("relevance"), F.max(F.when(F.col(stage) == "tone", F.col(value))).alias("tone_decided")
    )
    return rows.join(newest, key, "left").filter(F.coalesce(F.col("relevance"), F.lit("")) != "buang").drop("relevance")


def archive_append(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """new and what old has besides: duplicates inside old survive."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def archive_union(new: DataFrame, old: DataFrame, key: str, *order: Column) -> DataFrame:
    """new before old, the first row of each key; rows without a key all stay."""
    both = new.withColumn("_age", F.lit(0)).unionByName(old.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    rank = F.row_number().over(Window.partitionBy(key).orderBy("_age", *order))
    none = F.coalesce(F.col(key), F.lit("")) == ""
    keyed = both.filter(~none).withColumn("_n", rank).filter("_n = 1").drop("_n")
    return keyed.unionByName(both.filter(none)).drop("_age")


def semi_either(left: DataFrame, right: DataFrame, one: str, two: str) -> DataFrame:
    """Rows of left whose first or second key is in right: two hash semi joins, not a nested loop."""
    hit = left.join(right.select(one).distinct(), one, "left_semi")
    rest = left.join(right.select(one).distinct(), one, "left_anti").join(right.select(two).distinct(), two, "left_semi")
    return hit.unionByName(rest)


def one_to_one(left: DataFrame, right: DataFrame, key: str, left_order: Column, right_order: Column) -> DataFrame:
    """Each left row takes at most one right row of its key and each right row is taken once, in order."""
    number = lambda df, o: df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(o)))
    return number(left, left_order).join(number(right, right_order), [key, "_n"], "left").drop("_n")


def match_once(left: DataFrame, right: DataFrame, keys: list[tuple[Column, Column]], left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """(l, r, by) structs of matched rows: round by round for each pair of keys (left, right), the n-th free row of a key on the left
    takes the n-th free one on the right; a row that has been taken is not taken again. Empty keys meet nothing. by: number of the round.

    left and right are read several times; their rows are told apart by their columns and their order among equal ones."""

    def numbered(df: DataFrame, side: str, order: list[Column]) -> DataFrame:
        row = F.struct(*df.columns)
        nth = F.row_number().over(Window.partitionBy(row).orderBy(*order))
        return df.select(row.alias(side), nth.alias(f"{side}_n"), F.struct(*order).alias(f"{side}_o"), *(k[side == "r"].alias(f"k{i}") for i, k in enumerate(keys)))

    free_l, free_r, found = numbered(left, "l", left_order), numbered(right, "r", right_order), None
    for i in range(len(keys)):
        rank = lambda df, side, k=f"k{i}": df.filter(F.coalesce(F.col(k), F.lit("")) != "").withColumn("_n", F.row_number().over(Window.partitionBy(k).orderBy(f"{side}_o", f"{side}_n"))).withColumnRenamed(k, "_k")
        taken = rank(free_l, "l").select("_k", "_n", "l", "l_n").join(rank(free_r, "r").select("_k", "_n", "r", "r_n"), ["_k", "_n"])
        found = taken.select("l", "r", F.lit(i).alias("by")) if found is None else found.unionByName(taken.select("l", "r", F.lit(i).alias("by")))
        if i + 1 < len(keys):
            rest = lambda df, side, taken=taken: df.join(taken.select(side, f"{side}_n"), (df[side].eqNullSafe(taken[side])) & (df[f"{side}_n"] == taken[f"{side}_n"]), "left_anti")
            free_l, free_r = rest(free_l, "l"), rest(free_r, "r")
    return found


def fresh(cache: DataFrame, at: Column, ttl_seconds: Column, now: Column) -> DataFrame:
    return cache.filter(F.unix_timestamp(at) + ttl_seconds > F.unix_timestamp(now))


def evict(cache: DataFrame, at: str, most: int = 15_000, least: int = 100) -> DataFrame:
    """The newest rows of a cache of bounded size (``most``, but ``least`` at least)."""
    return cache.orderBy(F.desc(at), *(c for c in cache.columns if c != at)).limit(max(least, most))
