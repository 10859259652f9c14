"""Phrase collocations from word-id suffix arrays.

Each task cuts its texts into pieces and words and gathers word ids, a separator after every piece, until a
shard of ``SHARD_WORDS`` words is full. A shard's suffix array is built by numpy prefix doubling; runs of suffixes whose
common prefix has n words or more (LCP intervals) are its n-grams with their counts. Only these distinct n-grams
leave the task; they are summed over all shards by (lang, phrase), so a phrase that fills a third of the corpus is one
row a shard, not one an occurrence.

Lengths are counted one after the other. A phrase is never more frequent than its parts, so n words leave a
task only where both their parts of n - 1 words are marked in a bitmap of the hashes of all that were frequent enough. The
bitmap has ``MAP_BITS`` bits whatever the corpus; where two phrases share a bit, a rare one is shuffled for nothing.

A phrase is scored by its weakest cut: a * a / (l * r) where a, l and r are the counts of the phrase and of its two parts.

Edge cases: null and empty texts have no words; a null lang is ``und``; any length of text is read whole, a piece
is never split between shards (a text without separators makes one larger shard); repeated rows count again; an
empty table gives no rows; ties are ordered by phrase in UTF-8 byte order; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressmill.llm._common import map_rows, materialise, mix

#: Words that one suffix array holds: bounds a task's memory (about 100 bytes a word).
SHARD_WORDS = 2_000_000
#: Every separator becomes a line feed, every blank a space.
_CUTS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
_SEPARATOR = 0
#: Bits of the map of frequent phrases (16 MB, broadcast), and of one part of it.
MAP_BITS, PART_BITS = 1 << 27, 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    """Lower-cased words, a line feed between pieces."""
    return [w for w in text.lower().translate(_CUTS).replace(b"\n", b" \n ").split(b" ") if w]


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their next ``depth`` ids or more, by prefix doubling; what lies beyond the end comes first."""
    rank, known = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while known < depth:
        later = np.zeros(len(ids), np.int64)
        later[: len(ids) - known] = rank[known:] + 1
        keys = rank * (len(ids) + 1) + later
        order = np.argsort(keys, kind="stable")
        step = np.zeros(len(ids), np.int64)
        np.cumsum(keys[order][1:] != keys[order][:-1], out=step[1:])
        rank = np.empty(len(ids), np.int64)
        rank[order] = step
        known *= 2
    return order


def common_prefixes(ids: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix, the number of ids that it shares with the suffix before it, at most ``depth``."""
    padded = np.concatenate([ids, np.full(depth, -1, ids.dtype)])
    lcp = np.zeros(len(ids), np.int64)
    same = np.ones(max(len(ids) - 1, 0), bool)
    for n in range(depth):
        same &= padded[order[1:] + n] == padded[order[:-1] + n]
        lcp[1:] += same
    return lcp


def ngrams(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first position, count) of every distinct n-gram without a separator."""
    order = suffix_array(ids, n)
    starts = np.flatnonzero(common_prefixes(ids, order, n) < n)
    counts = np.diff(np.append(starts, len(ids)))
    first = order[starts]
    ends = np.append(np.flatnonzero(ids == _SEPARATOR), len(ids))
    inside = ends[np.searchsorted(ends, first)] - first >= n
    return first[inside], counts[inside]


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\n" + word)


def phrase_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """The bit of each phrase, from the hashes of its words in order."""
    out = np.zeros_like(hashes[0])
    for h in hashes:
        out = mix(out * _STEP + h)
    return out % np.uint64(MAP_BITS)


def frequent_map(frequent: DataFrame) -> np.ndarray:
    """Bits of all phrases (lang, phrase) of one length, as bytes; put together in parts."""

    def bits(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            words_ = [p.encode().split(b" ") for p in batch["phrase"]]
            if words_:
                hashes = [np.array([word_hash(lang, w[i]) for lang, w in zip(batch["lang"], words_, strict=True)], np.uint64) for i in range(len(words_[0]))]
                found = phrase_bits(hashes).astype(np.int64)
                yield {"part": found // PART_BITS, "bit": found % PART_BITS}

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        part = np.zeros(PART_BITS, bool)
        part[group["bit"].to_numpy()] = True
        return pa.table({"part": [key[0].as_py()], "bits": [np.packbits(part).tobytes()]})

    out = np.zeros(MAP_BITS // 8, np.uint8)
    marked = map_rows(frequent.select("lang", "phrase"), "part long, bit long", bits).distinct()
    for part, data in marked.groupBy("part").applyInArrow(pack, "part long, bits binary").collect():  # 16 MB at most
        out[part * PART_BITS // 8 : (part + 1) * PART_BITS // 8] = np.frombuffer(data, np.uint8)
    return out


class _Shard:
    """Word ids of one language in one task, counted when full."""

    def __init__(self) -> None:
        self.vocab: dict[bytes, int] = defaultdict(count(1).__next__)
        self.vocab[b"\n"] = _SEPARATOR
        self.ids: list[int] = []

    def add(self, text: bytes) -> int:
        """Take in a text; how many ids it adds."""
        before = len(self.ids)
        self.ids.extend(map(self.vocab.__getitem__, words(text)))
        self.ids.append(_SEPARATOR)
        return len(self.ids) - before

    def count(self, lang: str, n: int, known: np.ndarray | None) -> Iterator[dict]:
        """Distinct phrases of n words; only those whose parts of n - 1 words are known."""
        ids = np.array(self.ids, np.int64)
        first, counts = ngrams(ids, n)
        if known is not None:
            hashes = np.array([word_hash(lang, w) for w in self.vocab], np.uint64)  # ids follow the order of insertion
            for shift in (0, 1):
                bits = phrase_bits([hashes[ids[first + shift + i]] for i in range(n - 1)])
                keep = known[(bits >> np.uint64(3)).astype(np.int64)] >> (7 - (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1
                first, counts = first[keep], counts[keep]
        spelled = pa.array(list(self.vocab), pa.binary()).cast(pa.string())
        for at in range(0, len(first), 100_000):
            part = first[at : at + 100_000]
            phrase = pc.binary_join_element_wise(*(spelled.take(pa.array(ids[part + i])) for i in range(n)), " ")
            yield {"lang": pa.array([lang] * len(part), pa.string()), "phrase": phrase, "c": pa.array(counts[at : at + 100_000])}


def count_phrases(docs: DataFrame, n: int, known: np.ndarray | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, c): occurrences of every phrase of ``n`` words; with a map of ``known`` phrases of n - 1 words only of those made of them."""
    shared = docs.sparkSession.sparkContext.broadcast(known) if known is not None else None

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        marks = shared.value if shared is not None else None
        shards: dict[str, _Shard] = {}
        held = 0
        for batch in batches:
            for name, data in zip(batch["lang"], batch["t"], strict=True):
                held += shards.setdefault(name, _Shard()).add(data)
                if held >= SHARD_WORDS:
                    largest = max(shards, key=lambda k: len(shards[k].ids))
                    held -= len(shards[largest].ids)
                    yield from shards.pop(largest).count(largest, n, marks)
        for name, shard in shards.items():
            yield from shard.count(name, n, marks)

    given = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    found = map_rows(given, "lang string, phrase string, c long", run)
    # a shard's phrases are distinct already: dealt out by key first, so that no hash table before the shuffle holds them again
    return found.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("c").alias("c"))


def count_ngrams(docs: DataFrame, min_count: int, most: int) -> tuple[DataFrame, DataFrame]:
    """((lang, n, phrase, c) of all phrases of 1 to ``most`` words that occur ``min_count`` times or more, (lang, n): words of each language)."""
    single = materialise(count_phrases(docs, 1))
    size = single.groupBy("lang").agg(F.sum("c").alias("n"))
    level = single.filter(F.col("c") >= min_count)
    frequent = level.select("lang", F.lit(1).alias("n"), "phrase", "c")
    for n in range(2, most + 1):
        level = materialise(count_phrases(docs, n, frequent_map(level)).filter(F.col("c") >= min_count))
        frequent = frequent.unionByName(level.select("lang", F.lit(n).alias("n"), "phrase", "c"))
    return frequent, size


def collocations(docs: DataFrame, min_count: int = 10, most: int = 3, absorbed_percent: int = 50) -> DataFrame:
    """(lang, n_words, phrase, a, l, r, n, score) of every phrase of 2 to ``most`` words that occurs ``min_count`` times
    or more, unless a longer one that holds its words has ``absorbed_percent`` of its count or more."""
    frequent, size = count_ngrams(docs, min_count, most)
    phrases = frequent.filter("n > 1").withColumnsRenamed({"n": "n_words", "c": "a"}).withColumn("w", F.split("phrase", " "))

    cuts = phrases.select("lang", "n_words", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    join = lambda words, start, length: F.array_join(F.slice(words, start, length), " ")
    cuts = cuts.select("lang", "n_words", "phrase", "a", "k", join(F.col("w"), 1, F.col("k")).alias("first"), join(F.col("w"), F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"))
    part = lambda name, c: frequent.select("lang", F.col("phrase").alias(name), F.col("c").alias(c))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    wide = lambda x: F.col(x).cast("decimal(16,0)")  # noqa: E731  products of counts up to 10**15 stay exact in 38 digits
    cuts = cuts.withColumns({"_over": wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)"), "_under": wide("l") * wide("r")})
    scored = cuts.withColumn("score", F.expr("_over DIV _under"))
    weakest = scored.groupBy("lang", "n_words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = phrases.filter("n_words > 2").select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("m"), "n_words")
    inner = inner.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("m") + 1)).alias("s"))
    absorbing = inner.groupBy("lang", join(F.col("w"), F.col("s"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    left = weakest.join(absorbing, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < absorbed_percent * F.col("a")))
    return left.join(size, "lang").select("lang", "n_words", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def top_collocations(docs: DataFrame, per_lang: int = 2000, min_count: int = 10, most: int = 3, absorbed_percent: int = 50) -> DataFrame:
    """The first ``per_lang`` collocations of each language, ranked."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = collocations(docs, min_count, most, absorbed_percent).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= per_lang)


def digest(docs: DataFrame) -> DataFrame:
    long = [F.col(c).cast("long").alias(c) for c in ("rank", "a", "l", "r", "n", "score")]
    return top_collocations(docs).select("lang", long[0], "phrase", *long[1:])
