"""Sharding along a Hilbert curve.

Several metadata columns are quantised to equal-depth cells, each row gets its index on a Hilbert curve
through the grid of cells, and the rows in curve order are cut into runs of equal row counts: a shard holds
rows that are near each other in every dimension, so per-shard min/max statistics prune. Law ``rows``: the
counts of shards are at most one apart.

The global order is a range shuffle and a sort inside each partition; ranks come from the partitions' row
counts (one small row per partition), never from a sort in one task. Rows that tie in every key are told
apart by a row number, so a hot value does not fill one partition; equal texts are neighbours.

Edge cases: null texts have no bytes (crc32 0); null metadata is the lowest cell; fewer rows than shards fill
the first shards with one each; texts of any length count as one row; an empty table gives no rows; repeated rows get slots of their own; columns
named shard or slot are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm._common import materialise, whole_row

N_SHARDS = 40
BITS = 5
#: Bytes of framing that a document takes in a shard besides its text.
OVERHEAD = 16


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def hilbert_index(coordinates: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points with integer coordinates below 2**bits, for any number of dimensions.

    Works from the high bits down: each level's cell is rotated and reflected into the curve's frame, and the
    Gray-code rank of its corner gives the level's digit."""
    n = len(coordinates)
    x = np.stack([np.asarray(c, np.int64) for c in coordinates])
    index = np.zeros(x.shape[1], np.int64)
    entry = np.zeros(x.shape[1], np.int64)
    direction = np.zeros(x.shape[1], np.int64)
    full = (1 << n) - 1
    for level in range(bits - 1, -1, -1):
        corner = np.zeros_like(index)
        for d in range(n):
            corner |= ((x[d] >> level) & 1) << d
        turn = (direction + 1) % n
        t = corner ^ entry
        t = ((t >> turn) | (t << (n - turn))) & full
        w = t.copy()
        shift = 1
        while shift < n:  # inverse Gray code
            w ^= w >> shift
            shift <<= 1
        index = (index << n) | w
        before = np.where(w == 0, 0, 2 * ((w - 1) // 2))
        e = before ^ (before >> 1)
        entry = entry ^ (((e << turn) | (e >> (n - turn))) & full)
        odd = np.where(w % 2 == 1, w, w - 1)
        trailing = np.where(w == 0, 0, np.log2(((~odd) & (odd + 1)).clip(1)).astype(np.int64))
        direction = (direction + trailing + 1) % n
    return index


def _numeric(df: DataFrame, name: str) -> Column:
    """An order-preserving number of a column: itself, or the 7 bytes of a string that follow what all values share."""
    if dict(df.dtypes)[name] != "string":
        return F.col(name).cast("double")
    low, high = df.agg(F.min(name), F.max(name)).first()  # two values
    shared = 0
    while low and high and shared < min(len(low), len(high)) and low[shared] == high[shared]:
        shared += 1
    tail = F.rpad(F.hex(F.substring(F.encode(F.substring(name, shared + 1, 7), "UTF-8"), 1, 7)), 14, "0")
    return F.conv(tail, 16, 10).cast("double")


def _cell(value: Column, bounds: list[float]) -> Column:
    inner = sorted(set(bounds))
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, inner)), lambda b: b <= value)), F.lit(0)) if inner else F.lit(0)


def shard(docs: DataFrame, dimensions: Sequence[Column], tie_breakers: Sequence[Column], n_shards: int = N_SHARDS, bits: int = BITS) -> DataFrame:
    """docs with shard (int, from 0) and slot (long, gapless within the shard)."""
    given = docs.select(*(c.alias(f"_d{i}") for i, c in enumerate(dimensions)), *(c.alias(f"_t{i}") for i, c in enumerate(tie_breakers)), whole_row(docs.drop("shard", "slot")))
    values = {f"_v{i}": _numeric(given, f"_d{i}") for i in range(len(dimensions))}
    valued = given.select(*(c.alias(name) for name, c in values.items()), *(f"_t{i}" for i in range(len(tie_breakers))), "_row")
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = valued.agg(*(F.percentile_approx(c, F.array(*map(F.lit, steps)), 10000).alias(c) for c in values)).first()  # 2**bits - 1 numbers a dimension
    cells = [_cell(F.col(c), bounds[c] or []) for c in values]

    @F.pandas_udf("long")
    def curve(*c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([x.to_numpy() for x in c], bits))

    keys = ["_h", *(f"_t{i}" for i in range(len(tie_breakers)))]
    placed = valued.withColumn("_h", curve(*cells)).drop(*values)
    parts = max(2 * n_shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = placed.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "_tie").sortWithinPartitions(*keys, "_tie")
    numbered = ranged.withColumn("_p", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    done = materialise(numbered.select("_row", "_p", "_n"))
    counts = done.groupBy("_p").agg(F.count("*").alias("c"))
    running = Window.orderBy("_p")  # one row per partition
    starts = counts.select("_p", (F.sum("c").over(running) - F.col("c")).alias("_start"), F.sum("c").over(Window.partitionBy()).alias("_total"))
    ranked = done.join(starts, "_p").withColumn("_k", F.col("_start") + F.col("_n"))
    small, extra = F.floor(F.col("_total") / n_shards), F.col("_total") % n_shards
    head = extra * (small + 1)
    shard_no = F.when(F.col("_k") < head, F.floor(F.col("_k") / (small + 1))).otherwise(extra + F.floor((F.col("_k") - head) / F.greatest(small, F.lit(1))))
    ranked = ranked.withColumn("shard", shard_no.cast("int"))
    slot = F.col("_k") - F.col("shard") * small - F.least(F.col("shard").cast("long"), extra)
    return ranked.withColumn("slot", slot.cast("long")).select("_row.*", "shard", "slot")


def placement() -> tuple[list[Column], list[Column]]:
    """Dimensions and tie breakers for tables of documents that have size and text_crc32."""
    return [F.col("source"), F.col("lang"), F.col("size")], [F.col("text_crc32"), F.col("doc_id")]


def digest(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "source", "lang", text_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    out = shard(slim, *placement())
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
