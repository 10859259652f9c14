"""Exact search for the largest inner products, by KD-trees.

Rows are dealt to shards of at most about ``SHARD_CELLS`` components by a hash of their key, so copies of one vector
spread evenly. A shard's KD-tree splits the widest dimension at the median place, down to ``LEAF_ROWS`` rows,
and keeps a tight box for every node. The largest inner product that a box allows is the sum of the better end of each
dimension; a query visits nodes in that order and stops where no box can reach its k-th score.

Queries travel in blocks of bounded bytes. A block first searches its home shard, whose k-th score is then the
starting bound in every other shard, so these send only what may still enter the answer.

Scores are exact: components are whole numbers, and sums that may pass 64 bits are worked out with Python's integers
(a score beyond 64 bits counts as the nearest bound of long).

Edge cases: vectors that are null or hold null or non-finite components take no part; vectors meet only those of
their own length; a row is left out of its own answer, but not its copies; repeated ids and null ids (last in ties)
are rows like any other; a null id asks nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from pressmill.llm._common import materialise, with_row_key

#: Components in one shard's tree and in one block of queries: 4 MB and 1 MB of doubles.
SHARD_CELLS, BLOCK_CELLS = 1 << 19, 1 << 17
LEAF_ROWS = 256
#: Sums of whole numbers below this are exact in doubles.
EXACT = float(1 << 53)
_LONG = (-(1 << 63), (1 << 63) - 1)


def scaled(vector: Column, scale: float) -> Column:
    """scale * x of every component x, as doubles; null where the vector takes no part."""
    out = F.transform(vector, lambda x: x.cast("double") * float(scale))
    ok = F.forall(out, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(ok, out)


@dataclass
class Tree:
    """A KD-tree over the rows of one shard: node i covers rows start[i] to end[i]; children are left[i] and left[i] + 1 (-1 at leaves)."""

    rows: np.ndarray
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    low: np.ndarray
    high: np.ndarray


def build(rows: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    order = np.arange(len(rows))
    spans, left, low, high = [(0, len(rows))], [], [], []
    for a, b in spans:  # grows while it is read
        inside = rows[order[a:b]]
        low.append(inside.min(axis=0))
        high.append(inside.max(axis=0))
        width = high[-1] - low[-1]
        if b - a <= leaf_rows or not width.any():
            left.append(-1)
            continue
        middle = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(inside[:, width.argmax()], middle)]
        left.append(len(spans))
        spans += [(a, a + middle), (a + middle, b)]
    start, end = np.array(spans).T
    return Tree(rows[order], order, start, end, np.array(left), np.array(low), np.array(high))


def search(tree: Tree, ids: list[int | None], own: np.ndarray, queries: np.ndarray, k: int, kth: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each query its best (score, row of the tree) that reach ``kth``; ``own`` is the row that is the query itself, or -1."""
    dims = queries.shape[1]
    most = lambda x: float(np.abs(x).max(initial=0))
    if most(tree.rows) * most(queries) * max(dims, 1) < EXACT:
        rows, asked, low, high = tree.rows, queries, tree.low, tree.high
    else:
        rows, asked, low, high = (np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (tree.rows, queries, tree.low, tree.high))
    within = lambda x: np.clip(x, *_LONG) if x.dtype == object else x
    bounds = within(np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T)
    unnamed = np.array([x is None for x in ids], bool)
    named = np.array([x or 0 for x in ids], np.int64)
    found = []
    for q, query in enumerate(asked):
        best, scores, least = np.zeros(0, np.int64), np.zeros(0, rows.dtype), kth[q]
        queue = [(-bounds[q][0], 0)]
        while queue and -queue[0][0] >= least:
            _, node = heapq.heappop(queue)
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.left[node] + 1):
                    if bounds[q][child] >= least:
                        heapq.heappush(queue, (-bounds[q][child], child))
                continue
            a, b = tree.start[node], tree.end[node]
            reached = within(rows[a:b] @ query)
            keep = np.flatnonzero((reached >= least) & (np.arange(a, b) != own[q]))
            if len(keep):
                best, scores = np.append(best, a + keep), np.append(scores, reached[keep])
                cut = np.lexsort((named[best], unnamed[best], -scores))[:k] if scores.dtype != object else sorted(range(len(best)), key=lambda i: (-scores[i], unnamed[best[i]], named[best[i]]))[:k]
                best, scores = best[cut], scores[cut]
                if len(best) == k:
                    least = max(least, scores[-1])
        found.append([(int(s), int(i)) for s, i in zip(scores, best, strict=True)])
    return found


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Whole numbers, as doubles, of a column of lists."""
    return np.floor(column.combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(column), dims)


def _keys(group: pa.Table) -> dict:
    return {"f": [group["_f"].to_numpy().tobytes()], "r": [group["_r"].to_numpy().tobytes()], "ids": [group["id"].to_pylist()]}


_IDS = pa.list_(pa.int64())
_KEYS = [("f", pa.binary()), ("r", pa.binary()), ("ids", _IDS)]
_TREE = pa.schema([("dims", pa.int32()), ("shard", pa.int64()), *_KEYS, *((c, pa.binary()) for c in ("x", "spans", "left", "boxes"))])
_BLOCK = pa.schema([("dims", pa.int32()), ("block", pa.int64()), *_KEYS, ("x", pa.binary())])
_HIT = pa.struct([(c, pa.int64()) for c in ("f", "r", "query_id", "vec_id", "score")])
_HITS = pa.schema([("dims", pa.int32()), ("block", pa.int64()), ("kth", pa.binary()), ("hits", pa.list_(_HIT))])


def _tree_row(key: tuple, group: pa.Table) -> pa.Table:
    dims, shard = (k.as_py() for k in key)
    tree = build(_matrix(group["x"], dims))
    values = {"dims": [dims], "shard": [shard], "x": [tree.rows.tobytes()], "spans": [np.stack([tree.start, tree.end]).tobytes()], "left": [tree.left.tobytes()], "boxes": [np.stack([tree.low, tree.high]).tobytes()]}
    return pa.table(values | _keys(group.take(pa.array(tree.order))), schema=_TREE)


def _block_row(key: tuple, group: pa.Table) -> pa.Table:
    dims, block = (k.as_py() for k in key)
    return pa.table({"dims": [dims], "block": [block], "x": [_matrix(group["x"], dims).tobytes()]} | _keys(group), schema=_BLOCK)


def _read(data: bytes, dtype: type, *shape: int) -> np.ndarray:
    return np.frombuffer(data, dtype).reshape(shape)


def _search_pair(k: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        out = {"dims": [], "block": [], "kth": [], "hits": []}
        for pair in group.to_pylist():  # one: a shard and a block
            dims = pair["dims"]
            f, r, qf, qr = (_read(pair[c], np.int64, -1) for c in ("t_f", "t_r", "f", "r"))
            ids, asking = pair["t_ids"], pair["ids"]
            start, end = _read(pair["spans"], np.int64, 2, -1)
            boxes = _read(pair["boxes"], np.float64, 2, len(start), dims)
            tree = Tree(_read(pair["t_x"], np.float64, len(ids), dims), np.arange(len(ids)), start, end, _read(pair["left"], np.int64, -1), *boxes)
            place = {key: i for i, key in enumerate(zip(f.tolist(), r.tolist(), strict=True))}
            own = np.array([place.get(key, -1) for key in zip(qf.tolist(), qr.tolist(), strict=True)])
            kth = _read(pair["kth"], np.float64, -1) if pair["kth"] is not None else np.full(len(asking), -np.inf)
            found = search(tree, ids, own, _read(pair["x"], np.float64, len(asking), dims), k, kth)
            reached = [np.nextafter(float(hits[-1][0]), -np.inf) if len(hits) == k else -np.inf for hits in found]
            out["dims"].append(dims)
            out["block"].append(pair["block"])
            out["kth"].append(np.array(reached).tobytes())
            out["hits"].append([{"f": int(qf[q]), "r": int(qr[q]), "query_id": asking[q], "vec_id": ids[i], "score": s} for q, hits in enumerate(found) for s, i in hits])
        return pa.table(out, schema=_HITS)

    return run


def top_k(vectors: DataFrame, k: int, asks: Column, scale: float = 1024, vec_id: str = "vec_id", vector: str = "embedding", shard_cells: int = SHARD_CELLS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of every row for which ``asks`` holds with all other rows."""
    keyed = with_row_key(vectors.select(F.col(vec_id).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(vector).alias("v")))
    given = keyed.select("_f", "_r", "id", "asks", scaled(F.col("v"), scale).alias("x"))
    rows = materialise(given.filter("x is not null").withColumn("dims", F.size("x")))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("asks").alias("q"))
    parts = lambda n, cells: F.greatest(F.ceil(F.col(n) * F.greatest("dims", F.lit(1)) / cells), F.lit(1)).cast("long")
    sizes = sizes.select("dims", parts("n", shard_cells).alias("shards"), parts("q", block_cells).alias("blocks"))
    dealt = rows.join(sizes, "dims").withColumn("h", F.xxhash64("_f", "_r"))
    trees = materialise(dealt.withColumn("shard", F.pmod("h", "shards")).select("dims", "shard", "_f", "_r", "id", "x").groupBy("dims", "shard").applyInArrow(_tree_row, from_arrow_schema(_TREE)))
    asked = dealt.filter("asks").withColumn("block", F.pmod("h", "blocks")).select("dims", "block", "_f", "_r", "id", "x")
    blocks = materialise(asked.groupBy("dims", "block").applyInArrow(_block_row, from_arrow_schema(_BLOCK)).join(sizes.select("dims", "shards"), "dims").withColumn("home", F.pmod(F.xxhash64("block"), "shards")))
    held = trees.withColumnsRenamed({c: f"t_{c}" for c in ("f", "r", "ids", "x")})

    def searched(sent: DataFrame) -> DataFrame:
        return sent.join(held, ["dims", "shard"]).groupBy("dims", "shard", "block").applyInArrow(_search_pair(k), from_arrow_schema(_HITS))

    home = materialise(searched(blocks.withColumn("shard", F.col("home")).withColumn("kth", F.lit(None).cast("binary"))))
    others = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1), lambda s: s != F.col("home"))).alias("shard")
    away = searched(blocks.join(home.select("dims", "block", "kth"), ["dims", "block"]).select("*", others))
    hits = home.select(F.inline("hits")).unionByName(away.select(F.inline("hits")))
    order = Window.partitionBy("f", "r").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, 10, F.col("vec_id") % 100 == 0)
