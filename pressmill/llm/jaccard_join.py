"""Exact n-gram Jaccard join on size-banded tiles with hashed bitmap signatures.

Documents become sets of hashed word shingles; equal sets are one node. A node of size n can only link to sizes
within the threshold, so nodes are tiled by size band (powers of two; a node near the upper edge is also in the
next band). Inside a band the hash space is cut into P parts: two sets that differ in at most d elements agree
on at least P - d parts, so each node announces only its d + 1 largest parts, by (size, part); the largest part
on which a linked pair agrees is among these for both. A tile is the nodes that announce the same part with the
same content. Nothing is lost, and a shared passage alone does not fill a tile, because a part mixes hashes
from the whole document.

Popcounts of the exclusive or of bitmap signatures (as wide as their size band needs) bound a pair's overlap from
above, and the pairs that pass are intersected exactly as sorted arrays. First each node is tested against one hub
of its tiles (the node with the most neighbours), and each component so found again; then the nodes of tiles that
still hold several components are sifted and tiled anew by their rarest elements (see _rest), and every pair that
can still link is tested. So a group of thousands of copies costs one test per copy, texts that are alike but
below the threshold cost few, and no link between different texts is lost. A neighbour with many partners is
salted into groups of ``HUB_PARTNERS``. ``percent`` is at least 50.

Edge cases: null, empty and white-space texts have no shingles and link with nothing; a text of fewer words than
a shingle has its whole word sequence as its only one; texts are read whole; repeated rows link with each
other; a null doc_id is linked but never names a component unless all are null; an empty table gives no rows;
other columns pass through dedup().
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm._common import Rolling, as_scan, map_rows, materialise, mix, release, use_small_batches, whole_row, with_row_key

WORDS, PERCENT = 4, 85
BITMAP_WORDS = 16
HUB_PARTNERS = 512
STAR_ROUNDS = 2
SIFTS = 2
_PART, _CONTENT, _BAND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(data: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    own = (data or b"").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(own) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(own) - words + 1], ends[words - 1 :]
    return np.unique(Rolling(b" ".join(own)).slices(starts, ends))


def most_differing(n: int, percent: int) -> int:
    """Most elements in which a set of size n can differ from a linked one."""
    return n * (100 - percent) // percent


def announced(h: np.ndarray, percent: int) -> np.ndarray:
    """Tile keys of a node: the content hashes of its largest parts, in each of its bands."""
    n = len(h)
    keep = most_differing(n, percent) + 1
    band = n.bit_length() - 1
    bands = [band] if n * 100 // percent < 2 << band else [band, band + 1]
    spread, content = mix(h ^ _PART) >> np.uint64(32), mix(h ^ _CONTENT)
    out = []
    for k in bands:
        most = most_differing(2 << k, percent)
        parts = 1 + most + most // 4
        part = ((spread * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        sizes = np.bincount(part, minlength=parts)
        held = np.flatnonzero(sizes)
        sums = np.zeros(parts, np.uint64)
        sums[held] = np.add.reduceat(content[order], np.concatenate(([0], np.cumsum(sizes[held])[:-1])))
        rank = sizes * parts + np.arange(parts)
        top = np.argpartition(rank, parts - keep)[parts - keep :] if keep < parts else np.arange(parts)
        out.append(mix(sums[top] + mix(top.astype(np.uint64) * _BAND + np.uint64(k))))
    return np.concatenate(out)


def bitmap(h: np.ndarray) -> np.ndarray:
    """Signature of a set: 64 * BITMAP_WORDS bits, doubled until there are two for each element."""
    size = 64 * BITMAP_WORDS
    while size < 2 * len(h):
        size *= 2
    bits = np.zeros(size, np.uint8)
    bits[(mix(h) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _nodes(keyed: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: doc_id, _f, _r, n, node, bits, tiles (only at a node's first row in a task)."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        seen: set[bytes] = set()
        for batch in batches:
            ns, nodes, bits, tiles, offsets = [], [], [], [], [0]
            for t in batch["t"]:
                h = shingles(t, words)
                node = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
                ns.append(len(h))
                nodes.append(node)
                new = len(h) > 0 and node not in seen
                seen.add(node)
                bits.append(bitmap(h))
                own = announced(h, percent).view(np.int64) if new else np.zeros(0, np.int64)
                tiles.append(own)
                offsets.append(offsets[-1] + len(own))
            flat = pa.array(np.concatenate(tiles)) if tiles else pa.array([], pa.int64())
            widths = pa.array(np.cumsum([0, *map(len, bits)]), pa.int32())
            yield {
                "doc_id": batch["doc_id"], "_f": batch["_f"], "_r": batch["_r"], "n": ns, "node": nodes,
                "bits": pa.ListArray.from_arrays(widths, pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64))),
                "tiles": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat),
            }

    return map_rows(keyed.select("doc_id", "_f", "_r", F.col("text").cast("binary").alias("t")), "doc_id long, _f long, _r long, n long, node binary, bits array<long>, tiles array<long>", run)


def _possible(percent: int) -> Column:
    """Whether sizes (n_u, n_v) and bitmaps (b_u, b_v) allow a link. Sizes that do have bitmaps of one width or the next; the wider one is folded.

    |u and v| <= (n_u + n_v - differing bits) / 2, and linking needs 100 |u and v| >= percent |u or v|."""
    word = "if(size({b}) > {w}, {b}[i] | {b}[i + {w}], {b}[i])"
    least = "least(size(b_u), size(b_v))"
    differing = F.expr(f"aggregate(sequence(0, {least} - 1), 0, (a, i) -> a + bit_count({word.format(b='b_u', w=least)} ^ {word.format(b='b_v', w=least)}))")
    bound = (F.col("n_u") + F.col("n_v") - differing) / 2
    sizes = 100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")
    return sizes & ((100 + percent) * bound >= percent * (F.col("n_u") + F.col("n_v")))


def _side(texts: DataFrame, name: str) -> DataFrame:
    return texts.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"b_{name}"))


def _fitting(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    return pairs.join(_side(texts, "u"), "u").join(_side(texts, "v"), "v").filter(_possible(percent)).select("u", "v")


def _elements(live: DataFrame, words: int) -> DataFrame:
    """One row per shingle h of each text t; other columns are repeated."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [shingles(t, words) for t in batch["t"]]
            counts = [len(h) for h in found]
            out = {name: np.repeat(np.array(batch[name], np.int64), counts) for name in ("id", "label", "n")}
            yield {k: pa.array(v) for k, v in out.items()} | {"h": pa.array((np.concatenate(found) if found else np.zeros(0, np.uint64)).view(np.int64))}

    return map_rows(live.select("id", "label", "n", "t"), "id long, label long, n long, h long", run)


def _rest(placed: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Every pair of two components that can still link, once.

    An element that no other component holds cannot be common to such a pair: a node whose other elements are too
    few to link with anything leaves, and takes its elements with it (``SIFTS`` times). What stays is tiled
    by size band and element: the r rarest of a node's elements (r: one more than it may miss in its partner) hold
    the first one that a linked pair shares, in the order of rareness, and from there on both must still have
    enough elements. The bounds stand in the join's condition, so no other pair leaves it."""
    live = placed.groupBy("id").agg(F.min("label").alias("label")).join(texts, "id")
    own = materialise(_elements(live, words))
    of_node = Window.partitionBy("id")
    for turn in range(SIFTS):
        held = own.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("c")).filter("lo <> hi").select("h", "c")
        left = own.select("id", "label", "n", "h").join(held.hint("merge"), "h").withColumn("s", F.count("*").over(of_node)).filter(100 * F.col("s") >= percent * F.col("n"))
        if turn == SIFTS - 1:
            left = left.withColumn("rank", F.row_number().over(of_node.orderBy("c", "h"))).filter(F.col("rank") <= F.col("s") + 1 - F.ceil(percent * F.col("n") / 100))
            left = left.withColumn("enough", F.col("s") - F.col("rank") + 1)
        left = materialise(left)
        release(own)
        own = left
    band = F.length(F.bin("n"))
    small = own.select(band.alias("band"), "h", F.col("id").alias("u"), F.col("n").alias("n_u"), F.col("label").alias("l_u"), F.col("enough").alias("e_u"))
    bands = F.sequence(F.length(F.bin(F.ceil(percent * F.col("n") / 100))), band)
    large = own.select(F.explode(bands).alias("band"), "h", F.col("id").alias("v"), F.col("n").alias("n_v"), F.col("label").alias("l_v"), F.col("enough").alias("e_v"))
    apart = (F.col("l_u") != F.col("l_v")) & (F.struct("n_u", "u") < F.struct("n_v", "v"))
    can = ((100 + percent) * F.least("e_u", "e_v") >= percent * (F.col("n_u") + F.col("n_v"))) & (100 * F.col("n_u") >= percent * F.col("n_v"))
    met = small.alias("a").join(large.hint("merge").alias("b"), (F.col("a.band") == F.col("b.band")) & (F.col("a.h") == F.col("b.h")) & apart & can)
    pairs = materialise(met.select("u", "v").distinct())
    release(own)
    return pairs


def _linked(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) of nodes whose sets link. Each u's text is sent once per HUB_PARTNERS partners, each v's once."""
    partners = pairs.groupBy("u").agg(F.count("*").alias("partners"))
    salted = pairs.join(partners, "u").withColumn("salt", F.pmod(F.xxhash64("v"), F.ceil(F.col("partners") / HUB_PARTNERS))).select("u", "salt", "v")
    salted = materialise(salted)
    left = salted.select("u", "salt").distinct().join(texts.select(F.col("id").alias("u"), "t"), "u").select("u", "salt", F.lit(None).cast("long").alias("v"), "t")
    right = salted.join(texts.select(F.col("id").alias("v"), "t"), "v").select("u", "salt", "v", "t")
    grouped = left.unionByName(right).repartition("u", "salt").sortWithinPartitions("u", "salt", F.col("v").asc_nulls_first())

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        hub = None
        for batch in batches:
            us, vs = [], []
            for u, v, t in zip(batch["u"], batch["v"], batch["t"], strict=True):
                own = shingles(t, words)
                if v is None:
                    hub = own
                    continue
                common = len(np.intersect1d(hub, own, assume_unique=True))
                if 100 * common >= percent * (len(hub) + len(own) - common):
                    us.append(u)
                    vs.append(v)
            yield {"u": us, "v": vs}

    out = materialise(map_rows(grouped, "u long, v long", run))
    release(salted)
    return out


def components(edges: DataFrame) -> DataFrame:
    """id -> label, the smallest id of its connected component; edges: u, v. Min-labels with pointer jumping, a table per round."""
    both = materialise(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct())
    labels = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("id").alias("v"), "label"), "v").groupBy(F.col("u").alias("id")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("label").alias("up"))
        moved = materialise(stepped.join(jump, "to", "left").select("id", "label", F.least("to", F.coalesce("up", "to")).alias("new")))
        changed = moved.filter("label <> new").limit(1).count()
        release(labels)
        labels = moved.select("id", F.col("new").alias("label"))
        labels._pressmill_path = moved._pressmill_path
        if not changed:
            release(both)
            return labels


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, _f, _r (see with_row_key), n (set size) and label (its component; null without shingles); a table."""
    use_small_batches(docs.sparkSession)
    keyed = with_row_key(docs)
    fat = materialise(_nodes(keyed, words, percent))
    of_tile = Window.partitionBy("tile")
    posted = fat.select(F.explode("tiles").alias("tile"), "node")
    shared = posted.withColumn("lo", F.min("node").over(of_tile)).withColumn("hi", F.max("node").over(of_tile)).withColumn("m", F.count("*").over(of_tile)).filter("lo <> hi")
    tiles = materialise(shared.select("tile", "node", "m"))
    rows = materialise(fat.drop("tiles"))
    release(fat)
    near = tiles.groupBy("node").agg(F.sum("m").alias("near"))
    first = rows.groupBy("node").agg(F.min(F.struct("_f", "_r")).alias("at"))
    chosen = materialise(first.join(near, "node").select(F.monotonically_increasing_id().alias("id"), "node", "near", "at._f", "at._r"))
    spread = materialise(tiles.join(chosen.select("node", "id", "near"), "node").select("tile", "id", "near"))
    release(tiles)
    facts = chosen.join(rows.select("_f", "_r", "n", "bits"), ["_f", "_r"]).select("id", "_f", "_r", "n", "bits")
    texts = materialise(facts.join(keyed.select("_f", "_r", F.col("text").cast("binary").alias("t")), ["_f", "_r"]).select("id", "n", "bits", "t"))

    links = docs.sparkSession.createDataFrame([], "u long, v long")
    labels, found = None, []
    for turn in range(STAR_ROUNDS + 1):
        if labels is None:
            placed = spread.withColumn("label", F.col("id"))
        else:
            placed = spread.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
            placed = placed.withColumn("lo", F.min("label").over(of_tile)).withColumn("hi", F.max("label").over(of_tile)).filter("lo <> hi").drop("lo", "hi")
            placed = materialise(placed)  # tiles that still hold several components
            release(spread)
            spread = placed.drop("label")
            spread._pressmill_path = placed._pressmill_path
        if turn < STAR_ROUNDS:
            # the hub of a tile is its node with the most neighbours: of variants of one text, the one that most resemble
            hubs = placed.withColumn("hub", F.max(F.struct("near", "id", "label")).over(of_tile)).filter(F.col("hub.label") != F.col("label"))
            offers = hubs.groupBy("label", F.col("hub.id").alias("u"), F.col("id").alias("v")).agg(F.count("*").alias("c"))
            pairs = offers.groupBy("label").agg(F.max_by(F.struct("u", "v"), F.struct("c", "u", "v")).alias("p")).select("p.u", "p.v")
            pairs = materialise(_fitting(pairs, texts, percent))
        else:
            rest = _rest(placed, texts, words, percent)
            pairs = materialise(_fitting(rest, texts, percent))
            release(rest)
        if pairs.limit(1).count() and not (new := _linked(pairs, texts, words, percent)).isEmpty():
            links = links.unionByName(new)
            found += [new] if labels is None else [new, labels]
            labels = components(links)
        release(pairs)
    held = [rows, chosen, texts, spread, *found]
    named = rows.select("doc_id", "_f", "_r", "n", "node")
    if labels is None:
        named = named.withColumn("label", F.col("node"))
    else:
        name = chosen.select(F.col("id").alias("label"), F.col("node").alias("name"))
        own = chosen.select("id", "node").join(labels, "id").join(name, "label").select("node", "name")
        named = named.join(own, "node", "left").withColumn("label", F.coalesce("name", "node"))
        held.append(labels)
    out = materialise(named.withColumn("label", F.when(F.col("n") > 0, F.col("label"))).select("doc_id", "_f", "_r", "n", "label"))
    release(*held)
    return out


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component)."""
    rows = join(docs.select("doc_id", "text"))
    least = rows.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "label", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def dedup(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component (the smallest doc_id, nulls last); rows without shingles stay."""
    docs = as_scan(docs)
    rows = join(docs.select("doc_id", "text"), words, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_f", "_r"))
    kept = rows.filter("label is not null").groupBy("label").agg(first.alias("k")).select("k._f", "k._r").unionByName(rows.filter("label is null").select("_f", "_r"))
    return with_row_key(docs.select(whole_row(docs))).join(kept, ["_f", "_r"]).select("_row.*")
