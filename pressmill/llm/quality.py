"""Quality rules as a short-circuit cascade.

fit() times every rule and counts its rejections on a sample of at most ``sample_rows`` documents and orders
the rules by rejections per second; apply() runs them in that order and stops at the first that rejects, so
cheap rules that reject much spare the dear ones. Features are computed only when a rule asks for them. The
order changes the cost and ``rejected_by``, never the verdict.

Edge cases: null and empty texts have zero of everything and are rejected (fewer than 50 words); texts of any
length are read whole; repeated rows and null ids are judged alike; other columns pass through filter_docs().
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.llm._common import WS_BYTES, map_rows, use_small_batches

SYMBOLS = b"#*$%&|<>"
#: Bounds of the sample that orders the rules.
SAMPLE_ROWS, SAMPLE_CHARS = 256, 20_000
_CONTINUATION = bytes(range(0x80, 0xC0))


class Features:
    """Lazily computed features of one text, given as UTF-8."""

    def __init__(self, data: bytes | None) -> None:
        self.data = data or b""

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # ASCII white space only, for bytes

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.data.translate(None, WS_BYTES + _CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def word_ids(self) -> np.ndarray:
        ids = {w: i for i, w in enumerate(dict.fromkeys(self.words))}
        self.n_distinct = len(ids)
        return np.fromiter(map(ids.__getitem__, self.words), np.int64, self.n_words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside 3-word windows that occur twice or more."""
        if self.n_words < 4:
            return 0
        w = self.word_ids
        pairs = np.unique(w[:-1] * self.n_distinct + w[1:], return_inverse=True)[1]
        keys = pairs[:-1] * self.n_distinct + w[2:]
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        hit = np.zeros(self.n_words, bool)
        for shift in range(3):
            hit[shift : shift + len(twice)] |= twice
        return int(hit.sum())

    @cached_property
    def top_word_share(self) -> float:
        return float(np.bincount(self.word_ids).max()) / self.n_words if self.n_words else 0.0


#: The rules that every document must pass, in any order: name -> test that rejects.
RULES: dict[str, Callable[[Features], bool]] = {
    "too_few_words": lambda f: f.n_words < 50,
    "repeated_trigrams": lambda f: 100 * f.n_repeat_words > 50 * f.n_words,
    "symbol_heavy": lambda f: 100 * f.n_symbols > 15 * f.n_words,
    "odd_word_length": lambda f: not 2 * f.n_words <= f.word_chars <= 25 * f.n_words,
    "duplicate_lines": lambda f: 100 * f.n_dup_lines > 30 * len(f.lines),
    "one_word_dominates": lambda f: f.top_word_share > 0.3,
}
BASE = ("too_few_words", "repeated_trigrams")


def fit(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names in the order of rejections per second on a sample, each among the rows that the rules before it pass and
    beside the features that they have worked out. The sample is bounded in rows and characters; it decides the order only, never a verdict."""
    sample = docs.select(F.left(F.col(text), F.lit(SAMPLE_CHARS)).cast("binary").alias("t")).filter(F.pmod(F.xxhash64("t"), F.lit(4)) == 0).limit(sample_rows).collect()
    texts, order = [t for (t,) in sample], []
    while len(order) < len(RULES):
        seconds, rejected = {}, {}
        for name, rejects in RULES.items():
            if name in order:
                continue
            seconds[name], rejected[name] = 1e-6, 0
            for t in texts:
                features = Features(t)
                for done in order:
                    RULES[done](features)
                began = time.perf_counter()
                rejected[name] += rejects(features)
                seconds[name] += time.perf_counter() - began
        order.append(min(seconds, key=lambda name: (-rejected[name] / seconds[name], seconds[name])))
        texts = [t for t in texts if not RULES[order[-1]](Features(t))]
    return order


def judge(features: Features, order: list[str]) -> str | None:
    """The first rule of the order that rejects."""
    return next((name for name in order if RULES[name](features)), None)


def filter_docs(docs: DataFrame, order: list[str] | None = None, text: str = "text") -> DataFrame:
    """The rows of docs that pass every rule, unchanged."""
    order = order or fit(docs, text)
    use_small_batches(docs.sparkSession)

    def passes(texts: pd.Series) -> pd.Series:
        return pd.Series([judge(Features(t), order) is None for t in texts], dtype=bool)

    return docs.filter(F.pandas_udf(passes, "boolean")(F.col(text).cast("binary")))


def digest(docs: DataFrame) -> DataFrame:
    order = fit(docs)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            fs = [Features(t) for t in batch["t"]]
            reasons = [judge(f, order) for f in fs]  # the features that the cascade computed are kept
            failed = [any(RULES[name](f) for name in BASE) for f in fs]
            yield {
                "doc_id": batch["doc_id"],
                "n_words": [f.n_words for f in fs],
                "word_chars": [f.word_chars for f in fs],
                "n_symbols": [f.n_symbols for f in fs],
                "n_dup_lines": [f.n_dup_lines for f in fs],
                "n_repeat_words": [f.n_repeat_words for f in fs],
                "base_failed": failed,
                "kept": [r is None for r in reasons],
            }

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return map_rows(docs.select("doc_id", F.col("text").cast("binary").alias("t")), schema, run)
