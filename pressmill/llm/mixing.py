"""Mixing sources to target weights by cube-method balanced sampling.

A document of a source with target T and size S is taken T/S times in expectation: the whole part for certain,
the fractional part by balanced sampling. The flight phase moves the fractions of a block of documents through
the null-space of two constraints, words taken and documents taken, until at most two are undecided; the
undecided of all blocks of a source form the next level's blocks, until one block is left, whose largest few
(their subset sums are the finest) are landed by the outcome that misses the word total, then the document total, least. Blocks are formed by a
hash of the document, so a hot source is spread over as many tasks as it needs, and reruns agree.

Edge cases: null text has size 0; a null source is a source of its own and sorts last; a source without words
has target 0 and gives nothing; repeated rows are separate units; very long texts count whole and may outweigh their source; null doc_ids are allowed; an empty table
gives no rows; other columns pass through mix().
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm._common import materialise, use_small_batches, whole_row, with_row_key, word_count

#: Most times that a document is repeated.
MAX_COPIES = 3
#: Weights of sources in order of their names, repeating.
WEIGHTS = (1, 2, 3)
BLOCK_ROWS = 4096
#: Units that the last block of a source leaves to the landing, besides two of the flight: 2**14 outcomes at most.
LANDING_UNITS = 12
_EPS = 1e-9


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, source_size, source_rows, target. sizes: source, size.

    Water-filling: with sources sorted by cap/weight, a prefix is capped and the rest shares by weight."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source from here on
    ranked = per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))).cast("int") + 1).cast("double"))
    ratio = MAX_COPIES * F.col("source_size") / F.col("weight")
    upto = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    full = (
        ranked.withColumn("capped_before", F.coalesce(F.sum(MAX_COPIES * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
        .withColumn("stays", F.when(F.col("level") <= ratio, F.col("level")))
        .withColumn("share", F.first("stays", ignorenulls=True).over(Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    own = F.least(MAX_COPIES * F.col("source_size").cast("double"), F.coalesce(F.col("share"), F.lit(float("inf"))) * F.col("weight"))
    return full.select("source", F.col("source_size").cast("long"), F.col("source_rows").cast("long"), own.alias("target"))


def _flight(sizes: list[float], fractions: list[float], rng: random.Random, spare: int = 0) -> None:
    """Move fractions in place until at most two, and the last ``spare`` units, are strictly between 0 and 1.

    Keeps the sum of the fractions and of size * fraction."""
    active: list[int] = []
    for unit in range(len(sizes) - spare):
        if _EPS < fractions[unit] < 1 - _EPS:
            active.append(unit)
        else:
            fractions[unit] = round(fractions[unit])
        if len(active) < 3:
            continue
        a, b, c = active
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up, down = float("inf"), float("inf")
        for unit_, step in zip(active, u, strict=True):
            if step > 0:
                up, down = min(up, (1 - fractions[unit_]) / step), min(down, fractions[unit_] / step)
            elif step < 0:
                up, down = min(up, fractions[unit_] / -step), min(down, (1 - fractions[unit_]) / -step)
        move = up if rng.random() * (up + down) < down else -down
        rest = []
        for unit_, step in zip(active, u, strict=True):
            x = fractions[unit_] + move * step
            if x < _EPS or x > 1 - _EPS:
                fractions[unit_] = float(round(x))
            else:
                fractions[unit_] = x
                rest.append(unit_)
        active = rest


def _land(sizes: list[float], fractions: list[float]) -> None:
    """Decide the last units: of all outcomes, the one that misses the words, then the documents, least."""
    left = [i for i, x in enumerate(fractions) if _EPS < x < 1 - _EPS]
    n, words = np.array([fractions[i] for i in left]), np.array([sizes[i] for i in left])
    outcomes = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    missed = np.abs(outcomes @ words - words @ n)
    best = np.lexsort((np.abs(outcomes.sum(axis=1) - n.sum()), np.round(missed, 6)))[0]
    for i, x in zip(left, outcomes[best].tolist(), strict=True):
        fractions[i] = float(x)


def _level(units: DataFrame, bucket: str, last: bool) -> DataFrame:
    """One level of flight (and landing) over the groups (source, bucket)."""
    schema = units.schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "h", "h2"], ascending=[True, True, True], kind="stable")
        sizes, fractions = pdf["size"].astype(float).tolist(), pdf["fraction"].tolist()
        rng = random.Random(f"{int(pdf['h'].min())}:{len(pdf)}")
        _flight(sizes, fractions, rng, min(LANDING_UNITS, len(sizes)) if last else 0)
        if last:
            _land(sizes, fractions)
        return pdf.assign(fraction=fractions)

    return units.groupBy("source", F.expr(bucket)).applyInPandas(lambda _, pdf: run(pdf), schema)


def balance(units: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """units: source, size, source_rows, copies, fraction, and other columns; returns them with copies decided."""
    hashed = units.withColumn("h", F.xxhash64(*[F.col(c) for c in units.columns if c != "_f"])).withColumn("h2", F.xxhash64(F.lit(7), F.col("h")))
    most = hashed.agg(F.max("source_rows")).first()[0] or 0  # one number
    levels, n = 1, most
    while n > block_rows:
        levels, n = levels + 1, 2 * -(-n // block_rows)
    done, current = [], hashed
    for level in range(levels):
        last = level == levels - 1
        shrink = (block_rows // 2) ** level
        buckets = f"greatest(1L, cast(ceil(source_rows / {block_rows * shrink}D) as bigint))"
        moved = _level(current, f"pmod(h, {buckets})" if not last else "0L", last)
        if last:
            done.append(moved)
        else:
            moved = materialise(moved)
            open_ = (F.col("fraction") > _EPS) & (F.col("fraction") < 1 - _EPS)
            done.append(moved.filter(~open_))
            current = moved.filter(open_)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.withColumn("copies", F.col("copies") + F.round("fraction").cast("int")).drop("h", "h2", "fraction")


def decide(sizes: DataFrame) -> DataFrame:
    """sizes: source, size and other columns; adds source_size, target and copies."""
    use_small_batches(sizes.sparkSession)
    per = targets(sizes)
    # one row per source: Spark broadcasts it only below its own checked threshold
    joined = sizes.alias("d").join(per.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.*", "s.source_size", "s.source_rows", "s.target")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(times + _EPS), F.lit(MAX_COPIES))
    units = joined.withColumn("copies", whole.cast("int")).withColumn("fraction", F.greatest(F.lit(0.0), times - whole))
    return balance(units).drop("source_rows")


def mix(docs: DataFrame) -> DataFrame:
    """docs with each row repeated as often as the mix takes it (not at all, up to MAX_COPIES times)."""
    keyed = with_row_key(docs.select("doc_id", "source", "text", whole_row(docs)))
    chosen = decide(keyed.select("_f", "_r", "doc_id", "source", word_count(F.col("text")).alias("size"))).select("_f", "_r", "copies")
    taken = keyed.join(chosen.filter("copies > 0"), ["_f", "_r"])
    return taken.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")


def digest(docs: DataFrame) -> DataFrame:
    sizes = with_row_key(docs).select("_f", "_r", "doc_id", "source", word_count(F.col("text")).alias("size"))
    out = decide(sizes)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "source", F.col("copies").cast("int").alias("copies"))
