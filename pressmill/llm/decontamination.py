"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items (a-z, 0-9 and non-ASCII words, lower case A-Z) are read into one generalised suffix
automaton; a document's words are streamed through it and the longest matching length is tracked at every
word. Where it reaches a window (10 words, or a whole shorter item), the words under it are hit; the items
behind the window are looked up by the window itself, so counts are exact.

Items are held in automata of at most ``block_words`` words (or one item) each, and only one block's automaton is
broadcast at a time. A benchmark of several blocks first goes into one Bloom filter of windows (``SIEVE_BITS``): a
document none of whose windows is in it has no hit, so the corpus itself is passed once, and only the
documents that it suspects take the passes over the blocks, each of which writes the hits so far beside
them before its block is destroyed. Memory does not depend on the benchmark; a fuller filter suspects more and
loses nothing. Documents are never shuffled.

Edge cases: null texts and texts without words have no hits; texts of any length are read whole; null items and items without words have no
windows; a null item_id counts as the empty string; repeated items count once per item_id; repeated document
rows are treated alike; other columns pass through remove().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm._common import Rolling, materialise, release, use_small_batches, whole_row

WINDOW = 10
BLOCK_WORDS = 250_000
#: Most bits of the filter, bits for each window below that, and hash functions.
SIEVE_BITS, SIEVE_BITS_EACH, SIEVE_HASHES = 1 << 30, 32, 4
#: remove(): a document goes when one hit span is this long, or this share of its words is hit; other hit spans are cut out.
DROP_SPAN_WORDS = 20
DROP_COVERAGE = 0.2
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_WORD).split()


class Automaton:
    """Generalised suffix automaton of word-id sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int]) -> None:
        last = 0
        for w in sequence:
            if (q := self.next[last].get(w)) is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p != -1 and w not in self.next[p]:
                self.next[p][w] = new
                p = self.link[p]
            if p != -1:
                q = self.next[p][w]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
            last = new

    def lengths(self, sequence: list[int]) -> Iterator[int]:
        """Length of the longest suffix of each prefix that some item holds."""
        state = matched = 0
        step, link, length = self.next, self.link, self.length
        for w in sequence:
            while state and w not in step[state]:
                state = link[state]
                matched = length[state]
            if w in step[state]:
                state = step[state][w]
                matched += 1
            yield matched


class Matcher:
    """Windows of one block of items: (item_id as text, normalised words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.automaton = Automaton()
        self.windows: dict[tuple[int, ...], set[str]] = {}
        for item, own in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in own]
            self.automaton.add(ids)
            size = min(WINDOW, len(ids))
            for i in range(len(ids) - size + 1):
                self.windows.setdefault(tuple(ids[i : i + size]), set()).add(item)
        self.sizes = sorted({len(x) for x in self.windows})

    def match(self, own: list[bytes], hit: np.ndarray, items: set[str]) -> None:
        """Mark the hit words and collect the items."""
        if not self.sizes or len(own) < self.sizes[0]:
            return
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in own), np.int64, len(own))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):  # runs of words that items hold
            if end - start < self.sizes[0]:
                continue
            run = ids[start:end].tolist()
            for i, matched in enumerate(self.automaton.lengths(run)):
                for size in self.sizes:
                    if size > matched:
                        break
                    if found := self.windows.get(tuple(run[i - size + 1 : i + 1])):
                        hit[start + i - size + 1 : start + i + 1] = True
                        items |= found


Items = list[tuple[str, list[bytes]]]


def window_hashes(own: list[bytes], size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` words."""
    if len(own) < size:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(lengths + 1) - 1
    return Rolling(b" ".join(own)).slices((ends - lengths)[: len(own) - size + 1], ends[size - 1 :])


class Sieve:
    """A Bloom filter of the items' windows: may tell of a window that none has, never miss one."""

    def __init__(self, windows: int, most_bits: int) -> None:
        size = 1 << 13
        while size < min(SIEVE_BITS_EACH * windows, most_bits):
            size *= 2
        self.bits, self.sizes = np.zeros(size // 8, np.uint8), set()

    def _at(self, own: list[bytes], size: int) -> np.ndarray:
        """Bits of each window, a row for each of the hash functions."""
        h = window_hashes(own, size)
        steps = np.arange(SIEVE_HASHES, dtype=np.uint64)[:, None]
        return (h + steps * ((h >> np.uint64(31)) | np.uint64(1))) & np.uint64(8 * len(self.bits) - 1)

    def add(self, own: list[bytes]) -> None:
        size = min(WINDOW, len(own))
        at = self._at(own, size).ravel()
        np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        self.sizes.add(size)

    def suspects(self, own: list[bytes]) -> bool:
        for size in self.sizes:
            at = self._at(own, size)
            held = (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
            if held.all(axis=0).any():
                return True
        return False


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """Items with words, in blocks of at most block_words words (or one item)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").cast("binary").alias("t")).distinct()
    held, n = [], 0
    for row in items.orderBy("i", "t").toLocalIterator():
        own = words(row["t"])
        if held and n + len(own) > block_words:
            yield held
            held, n = [], 0
        if own:
            held.append((row["i"], own))
            n += len(own)
    if held:
        yield held


FOUND = "n_words long, n_hit long, hit binary, items array<string>"


def _pass(df: DataFrame, matcher) -> DataFrame:
    """One block's hits, added to those in ``found``."""

    def run(texts: pd.Series, n_hits: pd.Series, hits: pd.Series, items: pd.Series) -> pd.DataFrame:
        out = []
        for t, n, bits, before in zip(texts, n_hits, hits, items, strict=True):
            own = words(t)
            hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool) if n else np.zeros(len(own), bool)
            found = set(before)
            matcher.value.match(own, hit, found)
            n = int(hit.sum())
            out.append((len(own), n, np.packbits(hit).tobytes() if n else b"", sorted(found)))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "hit", "items"])

    return df.withColumn("found", F.pandas_udf(run, FOUND)("t", "found.n_hit", "found.hit", "found.items"))


def _find(df: DataFrame, first: Items, rest: Iterator[Items]) -> DataFrame:
    """df (t: binary) with found: hit words as packed bits, and the items they are from."""
    use_small_batches(df.sparkSession)
    context = df.sparkSession.sparkContext
    df = df.withColumn("found", F.expr(_EMPTY.format(n="0L")))
    block, written = context.broadcast(Matcher(first)), None  # at most BLOCK_WORDS words, or one item
    for items in rest:
        before, written = written, materialise(_pass(df, block))
        block.destroy()
        if before is not None:
            release(before)
        df, block = written, context.broadcast(Matcher(items))
    return _pass(df, block)


_EMPTY = "named_struct('n_words', {n}, 'n_hit', 0L, 'hit', X'', 'items', cast(array() as array<string>))"


def _sifted(df: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """df (t: binary) as suspects, written, and the others, with n_words."""
    sieve = Sieve(sum(max(1, len(own) - WINDOW + 1) for block in blocks(benchmark) for _, own in block), SIEVE_BITS)
    for block in blocks(benchmark):
        for _, own in block:
            sieve.add(own)
    shared = df.sparkSession.sparkContext.broadcast(sieve)  # SIEVE_BITS, whatever the benchmark
    use_small_batches(df.sparkSession)

    def look(texts: pd.Series) -> pd.DataFrame:
        own = [words(t) for t in texts]
        return pd.DataFrame({"n": [len(w) for w in own], "suspect": [shared.value.suspects(w) for w in own]})

    judged = df.withColumn("_s", F.pandas_udf(look, "n long, suspect boolean")("t"))
    return materialise(judged.filter("_s.suspect").drop("_s")), judged.filter("not _s.suspect").withColumn("n", F.col("_s.n")).drop("_s")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    df = docs.select("doc_id", F.col("text").cast("binary").alias("t"))
    held = blocks(benchmark)
    first, more = next(held, []), next(held, None)
    if more is None:
        out = _find(df, first, iter(()))
    else:
        suspects, others = _sifted(df, benchmark)
        held = blocks(benchmark)
        out = _find(suspects, next(held), held).select("doc_id", "found").unionByName(others.select("doc_id", F.expr(_EMPTY.format(n="n")).alias("found")))
    return out.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def _cut(data: bytes, hit: np.ndarray) -> bytes | None:
    """The text without its hit words, or None where it has to go."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
    if max(e - s for s, e in spans) >= DROP_SPAN_WORDS or hit.mean() >= DROP_COVERAGE:
        return None
    is_word = np.frombuffer(data.translate(_WORD), np.uint8) != 32
    at = np.flatnonzero(np.diff(np.concatenate(([0], is_word.view(np.int8), [0]))))
    kept, last = [], 0
    for s, e in spans:
        kept.append(data[last : at[2 * s]])
        last = at[2 * e - 1]
    return b"".join([*kept, data[last:]])


def _clean(matcher: Matcher, data: bytes) -> bytes | None:
    """_cut until nothing is hit: cutting may join words to a new window."""
    while True:
        own = words(data)
        hit = np.zeros(len(own), bool)
        matcher.match(own, hit, set())
        if not hit.any():
            return data
        if (data := _cut(data, hit)) is None:
            return None


def _clean_in_rounds(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """_clean over several blocks: each round cuts what any block hits; cut documents go to the next round."""

    def cut(texts: pd.Series, n_hits: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, np.unpackbits(np.frombuffer(h, np.uint8), count=len(words(t))).astype(bool)) if n else t for t, n, h in zip(texts, n_hits, hits, strict=True)], dtype=object)

    done = []
    while True:
        held = blocks(benchmark)
        found = _find(df, next(held), held).withColumn("c", F.pandas_udf(cut, "binary")("t", "found.n_hit", "found.hit")).filter("c is not null")
        found = materialise(found.select("_row", F.col("c").alias("t"), (F.col("found.n_hit") > 0).alias("again")))
        done.append(found.filter("not again").select("_row", F.col("t").alias("c")))
        df = found.filter("again").select("_row", "t")
        if df.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without benchmark passages: long or dense hits drop the document, other hit spans are cut from its text (and n_chars follows)."""
    use_small_batches(docs.sparkSession)
    texts = docs.select(whole_row(docs), F.coalesce(F.col("text").cast("binary"), F.expr("X''")).alias("t"))
    held = blocks(benchmark)
    first, more = next(held, []), next(held, None)
    if more is None:
        matcher = docs.sparkSession.sparkContext.broadcast(Matcher(first))  # at most BLOCK_WORDS words, or one item

        def clean(texts: pd.Series) -> pd.Series:
            return pd.Series([_clean(matcher.value, t) for t in texts], dtype=object)

        cleaned = texts.withColumn("c", F.pandas_udf(clean, "binary")("t")).filter("c is not null")
    else:
        suspects, others = _sifted(texts, benchmark)
        cleaned = _clean_in_rounds(suspects, benchmark).unionByName(others.select("_row", F.col("t").alias("c")))
    keep = lambda name: F.col(f"_row.`{name}`")
    changed = keep("text").isNotNull() & (keep("text").cast("binary") != F.col("c"))
    new = {"text": F.decode("c", "UTF-8"), "n_chars": F.length(F.decode("c", "UTF-8")).cast("long")}
    return cleaned.select(*((F.when(changed, new[c]).otherwise(keep(c)) if c in new else keep(c)).alias(c) for c in docs.columns))
