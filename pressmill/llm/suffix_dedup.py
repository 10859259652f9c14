"""Repeated-substring removal by a distributed, common-prefix-aware merge sort of sampled suffixes.

A byte goes when a ``width``-byte string over it starts anywhere else in the corpus. Sorting every suffix would
exchange many times the corpus, so the sort works on a content-defined sample: of the ``key``-byte strings in
each width-byte string, those with the least hash are *anchors*. Equal strings have equal anchors, so every
repeat is seen at an anchor.

1. Each anchor is announced by the hash of its key and the hash of its context (the bytes that any width-byte
   string over the key can reach). Keys that occur once are dropped: the duplicate detection that precedes the
   exchange of a distributed string sort.
2. An anchor whose whole context occurs again repeats as a whole, and needs no more comparisons.
3. The others (edges of repeats) are sorted: every task sorts its suffixes into runs, front-codes them (length
   of the prefix shared with the suffix before, then the rest) and sends each run's piece for a bucket of keys
   to the bucket's task; there a loser tree merges the runs, comparing two suffixes only beyond the prefix that
   both are known to share with the last winner. Within a group of one key, the shared right length is a range
   minimum of the merged order's prefix lengths, the shared left length comes from the bytes before the anchor,
   and a pair with left + right >= width covers these bytes.
   A key with more than ``HOT_CONTEXTS`` different contexts is not gathered in one task: each of its width-byte
   strings is announced by a hash and counted.
4. Each document's covered intervals are merged and cut out.

Edge cases: null and empty texts have no bytes and lose none; shorter texts than width lose nothing; texts are
read whole; repeated rows are different documents, so they remove each other; null ids are allowed; an empty
table gives no rows; matches never cross documents.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm._common import Rolling, as_scan, map_rows, materialise, mix, release, use_small_batches, whole_row, with_row_key

WIDTH, KEY = 200, 64
HOT_CONTEXTS = 4000
#: Strings of hot keys that a task holds at once.
HOT_ROWS = 100_000
RUN_ROWS = 20_000
BUCKET_ROWS = 40_000


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every run of ``width`` neighbours, by doubling."""
    n, size, out = len(x) - width + 1, 1, x
    while 2 * size <= width:
        out = pick(out[: len(out) - size], out[size:])
        size *= 2
    return pick(out[:n], out[width - size : width - size + n]) if size < width else out[:n]


def anchors(data: bytes, width: int = WIDTH, key: int = KEY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, key hashes and context hashes of a text's anchors."""
    if len(data) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    rolling, reach = Rolling(data), width - key
    h = rolling.windows(key)
    least = _sliding(h, reach + 1, np.minimum)
    padded = np.concatenate((np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)))
    at = np.flatnonzero(_sliding(padded, reach + 1, np.maximum) == h)
    low, high = np.maximum(at - reach, 0), np.minimum(at + width, len(data))
    shape = (at - low).astype(np.uint64) * np.uint64(1 << 20) + (high - at).astype(np.uint64)
    return at, h[at], mix(rolling.slices(low, high) + mix(shape))


def _announce(keyed: DataFrame, width: int, key: int) -> DataFrame:
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [anchors(t or b"", width, key) for t in batch["t"]]
            counts = [len(x[0]) for x in found]
            cat = lambda i, kind: np.concatenate([x[i] for x in found]).view(kind) if found else np.zeros(0, kind)
            yield {"_f": pa.array(np.repeat(np.array(batch["_f"], np.int64), counts)), "_r": pa.array(np.repeat(np.array(batch["_r"], np.int64), counts)), "pos": pa.array(cat(0, np.int64).astype(np.int32)), "hk": pa.array(cat(1, np.int64)), "hc": pa.array(cat(2, np.int64))}

    return map_rows(keyed.select("_f", "_r", F.col("text").cast("binary").alias("t")), "_f long, _r long, pos int, hk long, hc long", run)


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low, high = known, most  # invariant: equal up to low, different somewhere below high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_code(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared prefix lengths with the suffix before, and the rests, of sorted suffixes."""
    lengths, rests, last = [], [], b""
    for s in suffixes:
        lengths.append(shared_prefix(last, s))
        rests.append(s[lengths[-1] :])
        last = s
    return lengths, rests


class LoserTree:
    """Merge of front-coded sorted runs. Each run yields (shared length with its suffix before, rest, payload)."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, object]]]) -> None:
        self.runs = runs
        n = len(runs)
        self.current: list[bytes | None] = [b""] * n
        self.shared = [0] * n  # with the last winner
        self.payload: list[object] = [None] * n
        for i in range(n):
            self._advance(i)
        self.losers = [-1] * n
        for i in range(n):
            self._play(i)

    def _advance(self, i: int) -> None:
        """The run's next suffix; what it shares with its predecessor, the last winner, is known from the code."""
        step = next(self.runs[i], None)
        if step is None:
            self.current[i] = None
        else:
            self.shared[i], rest, self.payload[i] = step
            self.current[i] = self.current[i][: self.shared[i]] + rest

    def _less(self, i: int, j: int) -> bool:
        """Whether i's suffix comes first; the later one's shared length becomes that with the earlier one."""
        a, b = self.current[i], self.current[j]
        if a is None or b is None:
            return b is None and (a is not None or i < j)
        if self.shared[i] != self.shared[j]:
            return self.shared[i] > self.shared[j]
        n = shared_prefix(a, b, self.shared[i])
        first = (a[n:] < b[n:]) if a[n:] != b[n:] else i < j
        self.shared[j if first else i] = n
        return first

    def _play(self, i: int) -> None:
        node = (i + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:
                self.losers[node] = i
                return
            if self._less(other, i):
                self.losers[node], i = i, other
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator[tuple[int, bytes, object]]:
        """(shared length with the suffix before, suffix, payload) in order."""
        while self.runs and self.current[w := self.losers[0]] is not None:
            yield self.shared[w], self.current[w], self.payload[w]
            self._advance(w)
            self._play(w)


def _union(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def cover(group: list[tuple[bytes, bytes, bool, tuple[int, int, int]]], shared: list[int], width: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """For entries (suffix, bytes before it, wanted, (_f, _r, position)) of one key in sorted order: index and covered (start, end), relative to the anchor."""
    if len(group) <= 48:
        for i, (_, left, wanted, _) in enumerate(group):
            if not wanted:
                continue
            found = []
            for step in (-1, 1):
                right, j = width, i
                while 0 <= (k := j + step) < len(group):
                    right = min(right, shared[max(j, k)])
                    j = k
                    before = shared_prefix(left[::-1], group[j][1][::-1])
                    if before + right >= width:
                        found.append((-before, right))
            if found:
                yield i, _union(found)
        return
    counts: dict[bytes, int] = {}
    strings: list[list[bytes]] = [[] for _ in group]
    last = None  # the last row and its first start that is not counted yet: anchors near each other share starts
    for i in sorted(range(len(group)), key=lambda i: group[i][3]):
        suffix, left, _, (f, r, pos) = group[i]
        whole, n = left + suffix, len(left)
        strings[i] = [whole[p : p + width] for p in range(max(0, len(whole) - width + 1)) if p <= n]
        if last != (f, r):
            last, fresh = (f, r), 0
        for s in strings[i][max(0, fresh - (pos - n)) :]:
            counts[s] = counts.get(s, 0) + 1
        fresh = max(fresh, pos - n + len(strings[i]))
    for i, ((_, left, wanted, _), own) in enumerate(zip(group, strings, strict=True)):
        if wanted and (found := [(p - len(left), p - len(left) + width) for p, s in enumerate(own) if counts[s] > 1]):
            yield i, _union(found)


_ENTRY = "<qqi?qHH"  # _f, _r, position, wanted, key hash, left length, rest length


def _runs(edges: DataFrame, texts: DataFrame, width: int, key: int, buckets: int) -> DataFrame:
    """Front-coded pieces of sorted runs: bucket, shared (uint16s), head (packed entries), body (left + rest of each)."""
    reach = width - key
    wanted = edges.groupBy("_f", "_r").agg(F.collect_list(F.struct("pos", "hk", "wanted")).alias("at"))

    def sorted_runs(held: list[tuple]) -> dict:
        held.sort(key=lambda x: (x[0], x[1]))
        out: dict[str, list] = {"bucket": [], "shared": [], "head": [], "body": []}
        start = 0
        while start < len(held):
            stop = start
            while stop < len(held) and held[stop][0] == held[start][0]:
                stop += 1
            part = held[start:stop]
            lengths, rests = front_code([x[1] for x in part])
            out["bucket"].append(part[0][0])
            out["shared"].append(np.array(lengths, np.uint16).tobytes())
            out["head"].append(b"".join(struct.pack(_ENTRY, *x[3:], len(x[2]), len(r)) for x, r in zip(part, rests, strict=True)))
            out["body"].append(b"".join(x[2] + r for x, r in zip(part, rests, strict=True)))
            start = stop
        return out

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held: list[tuple] = []
        for batch in batches:
            for f, r, t, at in zip(batch["_f"], batch["_r"], batch["t"], batch["at"], strict=True):
                for x in at:
                    p = x["pos"]
                    held.append((x["hk"] % buckets, t[p : p + width], t[max(0, p - reach) : p], f, r, p, x["wanted"], x["hk"]))
                if len(held) >= RUN_ROWS:
                    yield sorted_runs(held)
                    held = []
        if held:
            yield sorted_runs(held)

    found = texts.join(wanted.hint("shuffle_hash"), ["_f", "_r"])
    return map_rows(found.select("_f", "_r", "t", "at"), "bucket long, shared binary, head binary, body binary", run)


def _merge(runs: DataFrame, width: int, key: int, buckets: int) -> DataFrame:
    """Covered intervals of the wanted anchors: _f, _r, s, e."""

    def decode(shared: bytes, head: bytes, body: bytes) -> Iterator[tuple[int, bytes, object]]:
        at = 0
        for n, (f, r, pos, wanted, hk, left, rest) in zip(np.frombuffer(shared, np.uint16).tolist(), struct.iter_unpack(_ENTRY, head), strict=True):
            yield n, body[at + left : at + left + rest], (f, r, pos, wanted, body[at : at + left])
            at += left + rest

    def merged(pieces: list[tuple]) -> dict:
        out: dict[str, list] = {"_f": [], "_r": [], "s": [], "e": []}
        group: list[tuple] = []
        lengths: list[int] = []

        def close() -> None:
            entries = [(s, p[4], p[3], p[:3]) for s, p in group]
            for i, spans in cover(entries, lengths, width):
                f, r, pos, *_ = group[i][1]
                for s, e in spans:
                    for column, value in zip(out.values(), (f, r, pos + s, pos + e), strict=True):
                        column.append(value)

        for n, suffix, payload in LoserTree([decode(*p) for p in pieces]):
            if n < key:
                close()
                group, lengths = [], []
            group.append((suffix, payload))
            lengths.append(n)
        close()
        return out

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        last, pieces = None, []
        for batch in batches:
            for bucket, *piece in zip(batch["bucket"], batch["shared"], batch["head"], batch["body"], strict=True):
                if bucket != last and pieces:
                    yield merged(pieces)
                    pieces = []
                last = bucket
                pieces.append(piece)
        if pieces:
            yield merged(pieces)

    gathered = runs.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return map_rows(gathered, "_f long, _r long, s int, e int", run)


def _hot(edges: DataFrame, texts: DataFrame, width: int, key: int) -> tuple[DataFrame, list[DataFrame]]:
    """The same for keys with very many contexts: every width-byte string over the anchor is announced by its hash. Also the tables that hold them."""
    reach = width - key
    wanted = edges.groupBy("_f", "_r").agg(F.collect_list(F.struct("pos", "wanted")).alias("at"))

    def told(own: list[tuple]) -> dict:
        """Strings (hash, _f, _r, start, wanted): one that is there twice is decided here, and only one of its places is announced to the others."""
        counts: dict[bytes, int] = {}
        for w, *_ in own:
            counts[w] = counts.get(w, 0) + 1
        rows, found, seen = [], {}, set()
        for w, f, r, s, need in own:
            if need and counts[w] > 1:
                found.setdefault((f, r), []).append((s, s + width))
            if w not in seen:
                seen.add(w)
                rows.append((w, f, r, s, s + width, need and counts[w] == 1))
        rows += [(None, f, r, s, e, False) for (f, r), spans in found.items() for s, e in _union(spans)]
        return dict(zip(("w", "_f", "_r", "s", "e", "wanted"), map(list, zip(*rows, strict=True)) if rows else ([], [], [], [], [], []), strict=True))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            own: list[tuple] = []
            for f, r, t, at in zip(batch["_f"], batch["_r"], batch["t"], batch["at"], strict=True):
                starts: dict[int, bool] = {}
                for x in at:
                    for s in range(max(0, x["pos"] - reach), min(x["pos"], len(t) - width) + 1):
                        starts[s] = starts.get(s, False) or x["wanted"]
                for s, need in starts.items():
                    own.append((hashlib.blake2b(t[s : s + width], digest_size=16).digest(), f, r, s, need))
                    if len(own) == HOT_ROWS:
                        yield told(own)
                        own = []
            yield told(own)

    found = texts.join(wanted.hint("shuffle_hash"), ["_f", "_r"])
    strings = materialise(map_rows(found.select("_f", "_r", "t", "at"), "w binary, _f long, _r long, s int, e int, wanted boolean", run))
    twice = materialise(strings.filter("w is not null").groupBy("w").agg(F.count("*").alias("c")).filter("c > 1").select("w"))
    late = strings.filter("wanted").join(twice, "w")
    return strings.filter("w is null").select("_f", "_r", "s", "e").unionByName(late.select("_f", "_r", "s", "e")), [strings, twice]


def repeats(docs: DataFrame, width: int = WIDTH, key: int = KEY, hot_contexts: int = HOT_CONTEXTS) -> tuple[DataFrame, DataFrame]:
    """docs with their row key, and the covered intervals (_f, _r, s, e; may overlap, may pass the end)."""
    use_small_batches(docs.sparkSession)
    keyed = with_row_key(docs)
    reach = width - key
    all_ = materialise(_announce(keyed, width, key))
    often = materialise(all_.groupBy("hk").agg(F.count("*").alias("c")).filter("c > 1").select("hk"))  # a table, so that the join can split a hot key
    seen = materialise(all_.join(often, "hk").select("_f", "_r", "pos", "hk", "hc"))
    release(all_, often)
    contexts = materialise(seen.groupBy("hk", "hc").agg(F.count("*").alias("c"), F.min(F.struct("_f", "_r", "pos")).alias("one")))
    whole = seen.join(contexts.filter("c > 1").select("hk", "hc"), ["hk", "hc"], "left_semi")
    intervals = whole.select("_f", "_r", F.greatest(F.col("pos") - reach, F.lit(0)).alias("s"), (F.col("pos") + width).alias("e"))
    keys = contexts.groupBy("hk").agg(F.count("*").alias("n"), F.min("c").alias("least")).filter("n > 1 and least = 1").select("hk", "n")
    edges = materialise(contexts.join(keys, "hk").select("hk", "one.*", (F.col("c") == 1).alias("wanted"), (F.col("n") > hot_contexts).alias("hot")))
    texts = keyed.select("_f", "_r", F.col("text").cast("binary").alias("t"))
    n = {r["hot"]: r["count"] for r in edges.groupBy("hot").count().collect()}  # two numbers
    held = [seen, contexts, edges]
    if n.get(False):
        buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n[False] // BUCKET_ROWS))
        held.append(materialise(_merge(_runs(edges.filter("not hot"), texts, width, key, buckets), width, key, buckets)))
        intervals = intervals.unionByName(held[-1])
    if n.get(True):
        strings, tables = _hot(edges.filter("hot"), texts, width, key)
        held += tables
        intervals = intervals.unionByName(strings)
    merged = intervals.groupBy("_f", "_r").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    out = materialise(merged)
    release(*held)
    return keyed, out


def _cut(data: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    found = [(s, min(e, len(data))) for s, e in _union([(x["s"], x["e"]) for x in spans or ()])]
    kept, last = [], 0
    for s, e in found:
        kept.append(data[last:s])
        last = e
    return b"".join([*kept, data[last:]]), found


def digest(docs: DataFrame) -> DataFrame:
    keyed, spans = repeats(docs.select("doc_id", "text"))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for t, own in zip(batch["t"], batch["spans"], strict=True):
                t = t or b""
                kept, found = _cut(t, own)
                for name, value in (("n_bytes", len(t)), ("n_removed", len(t) - len(kept)), ("n_spans", len(found)), ("kept_sha256", hashlib.sha256(kept).hexdigest())):
                    out[name].append(value)
            yield out

    texts = keyed.select("doc_id", "_f", "_r", F.col("text").cast("binary").alias("t"))
    joined = texts.join(spans.hint("shuffle_hash"), ["_f", "_r"], "left").select("doc_id", "t", "spans")
    return map_rows(joined, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", run)


def remove(docs: DataFrame) -> DataFrame:
    """docs with text_bytes: what is left of each text's UTF-8 (a cut may fall inside a character; null stays null)."""
    docs = as_scan(docs)
    _, spans = repeats(docs.select("text"))
    keyed = with_row_key(docs.select("text", whole_row(docs.drop("text_bytes"))))

    def kept(texts: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _cut(t, x)[0] for t, x in zip(texts, own, strict=True)], dtype=object)

    joined = keyed.join(spans.hint("shuffle_hash"), ["_f", "_r"], "left")
    return joined.select("_row.*", F.pandas_udf(kept, "binary")(F.col("text").cast("binary"), "spans").alias("text_bytes"))
