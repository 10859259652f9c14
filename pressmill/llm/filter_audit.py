"""How filters of a cascade overlap, in every order.

Each document becomes a mask of the filters that it fails; documents with one mask and one part are one cell.
For every part the orders of the filters are visited by adjacent transpositions, so that two neighbouring orders
differ in two steps only and just these are worked out anew, from the cells. What a filter removes is added up along
the walk: its Shapley value, times the number of orders.

A copy of a text with a smaller id is found without gathering the copies: every (text, part, labels) group knows its
least id and how many rows have it, and only these groups meet by text. Texts are compared by SHA-256.

Edge cases: null texts are empty, a null source is the part ''; a null doc_id has no label and is never the later
copy; labels of one id in several rows count once, a flag if any row sets it; repeated rows count again, and rows
with the least id are all first copies; texts of any length are read whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm._common import WS_CLASS, map_rows

FILTERS = "ABCDE"
#: What a step reports of its filter, beside ``kept``.
COUNTS = ("docs", "good", "toxic")


def failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails; bit i is filter i."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, f"[{WS_CLASS}]+"), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    tests = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals.cast("long") > 2 * F.length(t), t.rlike("[#$%&*|]")]
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by source and failed filters."""
    flags = labels.filter("doc_id is not null").groupBy("doc_id").agg(*(F.max((F.col(c) == 1).cast("int")).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))))
    given = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), failures(F.col("text")).alias("mask"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("h"))
    marked = given.join(flags, "doc_id", "left").fillna(0, ["good", "toxic"])
    same_id = marked.groupBy("h", "part", "mask", "good", "toxic", "doc_id").agg(F.count("*").alias("c"))
    groups = same_id.groupBy("h", "part", "mask", "good", "toxic").agg(
        F.sum("c").alias("c"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("c")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "c"))).alias("first"),
    )
    least = groups.groupBy("h").agg(F.min("first.doc_id").alias("least"), F.count("*").alias("n"))
    alone = groups.join(least.filter("n > 1"), "h", "left")
    firsts = F.when(F.coalesce("least", "first.doc_id") == F.col("first.doc_id"), F.col("first.c")).otherwise(0) + F.col("nameless")
    e = 1 << FILTERS.index("E")
    split = alone.withColumn("firsts", F.coalesce(firsts, F.col("nameless"))).select(
        "part", "good", "toxic", F.inline(F.array(F.struct(F.col("mask"), F.col("firsts").alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(e)).alias("mask"), (F.col("c") - F.col("firsts")).alias("n"))))
    )
    total = lambda flag: F.sum(F.col("n") * F.col(flag)).alias(flag)
    return split.filter("n > 0").groupBy("part", "mask").agg(F.sum("n").alias("docs"), total("good"), total("toxic"))


def adjacent_orders(n: int) -> Iterator[tuple[list[int], int]]:
    """All orders of n things, each one adjacent swap from the one before; and the first swapped place (-1 at the start).

    The largest thing that can still move in its direction moves; all larger ones then turn around."""
    order, facing = list(range(n)), [-1] * n
    yield list(order), -1
    while True:
        place = {x: i for i, x in enumerate(order)}
        movable = [x for x in order if 0 <= place[x] + facing[x] < n and order[place[x] + facing[x]] < x]
        if not movable:
            return
        x = max(movable)
        i = place[x]
        j = i + facing[x]
        order[i], order[j] = order[j], order[i]
        for y in range(x + 1, n):
            facing[y] = -facing[y]
        yield list(order), min(i, j)


def audit(table: np.ndarray, names: str = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part.

    ``table[mask]`` counts documents, good and toxic ones by mask."""
    n, masks = len(names), np.arange(len(table))
    fails = [table[masks & (1 << f) != 0, 0].sum() for f in range(n)]
    unique = [table[1 << f, 0] for f in range(n)]

    def step(order: list[int], i: int) -> tuple:
        before = sum(1 << f for f in order[:i])
        passed = masks & before == 0
        lost = table[passed & (masks & (1 << order[i]) != 0)].sum(axis=0)
        return int(table[passed, 0].sum() - lost[0]), *map(int, lost)

    rows, shapley, steps = [], [0] * n, []
    for order, swapped in adjacent_orders(n):
        for i in range(n) if swapped < 0 else (swapped, swapped + 1):
            steps[i : i + 1] = [step(order, i)]
        for i, f in enumerate(order):
            kept, removed, good, toxic = steps[i]
            shapley[f] += removed
            rows.append((f, "".join(names[g] for g in order), i + 1, kept, removed, int(fails[f]) - removed, int(unique[f]), good, toxic))
    return [(*row[1:], shapley[row[0]]) for row in rows]


def interactions(counted: DataFrame) -> DataFrame:
    """The audit of every part of cells(): all orders of the filters, a row a step."""
    columns = ("filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for part, found in zip(batch["part"], batch["cells"], strict=True):
                table = np.zeros((1 << len(FILTERS), len(COUNTS)), np.int64)
                for cell in found:
                    table[cell["mask"]] = [cell[c] for c in COUNTS]
                rows = audit(table)
                yield {"part": [part] * len(rows)} | dict(zip(columns, map(list, zip(*rows, strict=True)), strict=True))

    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))  # at most 32 a part
    return map_rows(parts, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long", run)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(cells(docs, labels))
