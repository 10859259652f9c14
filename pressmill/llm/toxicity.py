"""Toxicity scoring by a weighted finite-state pattern grammar.

Five letter-to-letter transducers (see Transducer) read a clause: *negation* and *reported speech* carry their scope in their states
and scale down what stands in it; *target* scales up an insult with a person word before or behind it; *threat*
confirms a threat verb whose target follows; *insult* emits. They are composed into one transducer
(``compose``), whose best path over a clause is its weight; targets and threats that are confirmed by later words
are guesses that die when the words do not come. Which words are insults is a learned lexicon of whole words and
stems of any language. A document's features are sums over its matched clauses, and a logistic model turns them into
a score, so a single word out of context weighs little.

The lexicon and the model are learned from labelled rows outside the held out remainder; at most ``max_labelled``
of them, chosen by a hash of the id. A term enters the lexicon by its log odds and a significance test; their
number is bounded by the labelled rows only. Labels, lang, source and doc_id are no inputs of a score. Documents are scored
whole and never shuffled.

Edge cases: null and empty texts have no matched clause and get the model's base score; rows without a label or
with a null id are scored only; an id labelled twice counts as toxic if one label is; of rows that share a
labelled id the least text is learned from; without usable labels of both classes every score is 0; repeated rows are
scored alike; very long texts are scored whole, other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm._common import map_rows, materialise, release

MAX_LABELLED = 20_000
#: A term of the lexicon is in so many toxic texts, has such log odds, and they are so many standard errors above 0.
LEAST_TEXTS, LEAST_ODDS, LEAST_Z = 3, 1.5, 2.0
#: The weights are fitted on features by the lexicon of the other folds, so that terms of chance earn none.
FOLDS = 4
STEM_CHARS = range(4, 9)
THRESHOLD = 0.3
#: Fixed word lists of the grammar.
TARGETS = frozenset("you your he she they them his her tu te vous toi il elle du dich dir ihr er sie usted ustedes él ella".split())
NEGATORS = frozenset("not no never isn't aren't ne pas jamais nicht kein keine nie nunca jamás".split())
REPORTERS = frozenset("said says quoted reported wrote dit disait écrit sagte schrieb dijo escribió".split())
THREATS = frozenset("kill hurt destroy beat shoot burn tuer frapper töten schlagen matar golpear".split())
NEGATION_REACH, TARGET_REACH, THREAT_REACH = 3, 4, 3
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 0.3, 0.5, 1.2, 2.0

_TOKEN = re.compile(r"[^\W\d_]+(?:'t)?|[.!?;:\n\"«»“”]")
_ENDS = frozenset(".!?;:\n")
_QUOTES = frozenset("\"«»“”")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


#: Letters: other word, target, negator, reporter, threat verb, insult; C, on inner tapes only, is a confirmed threat.
LETTERS = "wTNRHI"
Arc = tuple[str, float, object]


class Transducer:
    """A weighted letter-to-letter transducer: step(state, letter) gives arcs (output letter, factor, next state).

    A token's factor is the product over the tapes, times the token's own weight on the last one; a path's weight is
    the sum over its tokens, and a clause's the largest of the paths that end in a final state."""

    def __init__(self, starts: Iterable[object], step: Callable[[object, str], list[Arc]], final: Callable[[object], bool], letters: str = LETTERS) -> None:
        self.starts, self.final, self.letters = list(starts), final, letters
        self.arcs: dict[tuple[object, str], list[Arc]] = {}
        todo, seen = list(self.starts), set(self.starts)
        while todo:
            state = todo.pop()
            for letter in letters:
                self.arcs[state, letter] = step(state, letter)
                for _, _, after in self.arcs[state, letter]:
                    if after not in seen:
                        seen.add(after)
                        todo.append(after)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that writes what second writes for what first writes."""

    def step(state: tuple, letter: str) -> list[Arc]:
        return [(z, f * g, (p, q)) for y, f, p in first.arcs[state[0], letter] for z, g, q in second.arcs[state[1], y]]

    return Transducer([(p, q) for p in first.starts for q in second.starts], step, lambda s: first.final(s[0]) and second.final(s[1]), first.letters)


def negation() -> Transducer:
    """State: words that the last negator still governs."""

    def step(left: int, x: str) -> list[Arc]:
        return [(x, NEGATED if left and x in "HI" else 1.0, NEGATION_REACH if x == "N" else max(0, left - 1))]

    return Transducer([0], step, lambda _: True)


def reported_speech() -> Transducer:
    """State: whether a reporter came before in the clause, or the clause is quoted."""

    def step(inside: bool, x: str) -> list[Arc]:
        return [(x, REPORTED if inside and x in "HI" else 1.0, inside or x == "R")]

    return Transducer([False, True], step, lambda _: True)


def target() -> Transducer:
    """State: words that the last target still reaches, and words within which a promised one has to come."""

    def step(state: tuple[int, int], x: str) -> list[Arc]:
        before, due = state
        if x == "T":
            return [(x, 1.0, (TARGET_REACH, 0))]
        if due == 1:  # the promise is broken
            return []
        after = (max(0, before - 1), max(0, due - 1))
        if x != "I":
            return [(x, 1.0, after)]
        if before or due:
            return [(x, TARGETED, after)]
        return [(x, 1.0, after), (x, TARGETED, (0, TARGET_REACH + 1))]

    return Transducer([(0, 0)], step, lambda s: s[1] == 0)


def threat() -> Transducer:
    """State: words within which the target of a confirmed threat has to come. One verb is confirmed by a target."""

    def step(due: int, x: str) -> list[Arc]:
        if x == "T":
            return [(x, 1.0, 0)]
        if due == 1:
            return []
        plain = (x, 1.0, max(0, due - 1))
        return [plain, ("C", 1.0, THREAT_REACH + 1)] if x == "H" and not due else [plain]

    return Transducer([0], step, lambda due: due == 0)


def insult() -> Transducer:
    """Emits an insult's own weight and a confirmed threat's; nothing else weighs."""
    return Transducer([0], lambda _, x: [(x, {"I": 1.0, "C": THREAT_WEIGHT}.get(x, 0.0), 0)], lambda _: True, LETTERS + "C")


class Grammar:
    """The composed transducers over a lexicon {term: weight}; a term is 'word$' or a stem 'stem*' of longer words."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self._memo: dict[str, float] = {}
        whole = compose(compose(compose(compose(negation(), reported_speech()), target()), threat()), insult())
        number = {state: i for i, state in enumerate(dict.fromkeys(s for s, _ in whole.arcs))}
        self.steps: list[dict[str, list[tuple[int, float]]]] = [{} for _ in number]
        for (state, letter), arcs in whole.arcs.items():
            self.steps[number[state]][letter] = [(number[after], factor) for _, factor, after in arcs]
        self.finals = [whole.final(state) for state in number]
        self.start = {quoted: number[state] for quoted, state in zip((False, True), whole.starts, strict=True)}

    def weight(self, word: str) -> float:
        """A word's weight as an insult: that of its longest term."""
        if (w := self._memo.get(word)) is None:
            if len(self._memo) > 300_000:
                self._memo.clear()
            w = self.lexicon.get(word + "$")
            for k in reversed(STEM_CHARS):
                if w is None and len(word) > k:
                    w = self.lexicon.get(word[:k] + "*")
            w = self._memo[word] = w or 0.0
        return w

    def letter(self, word: str) -> str:
        if word in NEGATORS:
            return "N"
        if word in REPORTERS:
            return "R"
        if word in TARGETS:
            return "T"
        return "H" if word in THREATS else "I" if self.weight(word) else "w"

    def clause(self, tokens: list[str], quoted: bool) -> tuple[float, list[str]]:
        """Weight of the best path and the insults of one clause."""
        live, hits, steps = {self.start[quoted]: 0.0}, [], self.steps
        for token in tokens:
            letter = self.letter(token)
            own = 1.0
            if letter == "I":
                own = self.weight(token)
                hits.append(token)
            after: dict[int, float] = {}
            for state, total in live.items():
                for to, factor in steps[state][letter]:
                    w = total + factor * own
                    if w > after.get(to, -1.0):
                        after[to] = w
            live = after
        return max(w for state, w in live.items() if self.finals[state]), hits

    def features(self, text: str | None) -> list[float]:
        total, best, n_hits, n_words, matched = 0.0, 0.0, 0, 0, 0
        distinct: set[str] = set()
        weight, clause, quoted = self.weight, [], False
        hot = False

        def close() -> None:
            nonlocal total, best, n_hits, matched
            w, hits = self.clause(clause, quoted)
            if hits or w:
                total, best, n_hits, matched = total + w, max(best, w), n_hits + len(hits), matched + 1
                distinct.update(hits)

        for token in _TOKEN.findall((text or "").lower()):
            if token in _ENDS or token in _QUOTES:
                if hot:
                    close()
                clause, hot = [], False
                quoted = (not quoted) if token in _QUOTES else quoted and token != "\n"
                continue
            n_words += 1
            clause.append(token)
            hot = hot or weight(token) != 0.0 or token in THREATS
        if hot:
            close()
        return [math.log1p(total), math.log1p(best), math.log1p(n_hits), math.log1p(len(distinct)), math.log1p(matched), math.log1p(100 * total / (n_words + 10))]


def terms(text: str | None) -> set[str]:
    found = set()
    for word in set(_TOKEN.findall((text or "").lower())):
        if word[0].isalpha():
            found.add(word + "$")
            found.update(word[:k] + "*" for k in STEM_CHARS if len(word) > k)
    return found


def _document_counts(sample: DataFrame) -> DataFrame:
    """term, n (texts with it) and pos (toxic ones), as arrays by fold."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            n: Counter[tuple[str, int]] = Counter()
            pos: Counter[tuple[str, int]] = Counter()
            for t, y, fold in zip(batch["text"], batch["toxic"], batch["fold"], strict=True):
                found = [(x, fold) for x in terms(t)]
                n.update(found)
                if y == 1:
                    pos.update(found)
            yield {"term": [t for t, _ in n], "fold": [k for _, k in n], "n": list(n.values()), "pos": [pos[x] for x in n]}

    parts = map_rows(sample.select("text", "toxic", "fold"), "term string, fold int, n long, pos long", run)
    by_fold = lambda c: F.array(*(F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)) for k in range(FOLDS))).alias(c)
    return parts.groupBy("term").agg(by_fold("n"), by_fold("pos"))


def lexicon_of(counts: DataFrame, sizes: dict[tuple[int, bool], int], without: int | None = None) -> DataFrame:
    """term, odds: terms that toxic texts (but those of a fold) have more often, by log odds, and by more standard errors than chance gives."""
    folds = [k for k in range(FOLDS) if k != without]
    pos, neg = (sum(sizes.get((k, y), 0) for k in folds) for y in (True, False))
    c = sum((F.col("pos")[k] for k in folds), F.lit(0))
    other = sum((F.col("n")[k] for k in folds), F.lit(0)) - c
    odds = F.log((c + 0.5) / (pos + 1)) - F.log((other + 0.5) / (neg + 1))
    error = F.sqrt(1 / (c + 0.5) - 1 / (pos + 1) + 1 / (other + 0.5) - 1 / (neg + 1))
    found = counts.filter(c >= LEAST_TEXTS).select("term", odds.alias("odds"), (odds / error).alias("z"))
    return found.filter((F.col("odds") >= LEAST_ODDS) & (F.col("z") >= LEAST_Z)).select("term", F.round(F.least("odds", F.lit(5.0)), 3).alias("odds"))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[dict[str, float], list[float]]:
    """Lexicon and logistic weights from labelled rows that are not held out; no weights without both classes."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    train = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(train), "doc_id")  # train has at most max_labelled rows
    one = texts.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("toxic").alias("toxic"))
    sample = materialise(one.select("text", F.expr("if(toxic = 1, 1, 0)").alias("toxic"), F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")))
    sizes = {(r["fold"], r["toxic"] == 1): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}  # two numbers a fold
    if len({y for _, y in sizes}) < 2:
        release(sample)
        return {}, []
    counts = materialise(_document_counts(sample))
    lexicons = [{r["term"]: r["odds"] for r in lexicon_of(counts, sizes, k).collect()} for k in (*range(FOLDS), None)]  # terms of at most max_labelled texts
    grammars = [Grammar(x) for x in lexicons[:FOLDS]]

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"y": batch["toxic"], "x": [grammars[k].features(t) for k, t in zip(batch["fold"], batch["text"], strict=True)]}

    rows = map_rows(sample, "y int, x array<double>", run).collect()  # at most max_labelled small rows
    release(sample, counts)
    y, x = np.array([r["y"] for r in rows], float), np.array([[1.0, *r["x"]] for r in rows])
    order = np.lexsort((*x.T, y))  # sums do not depend on the order of arrival
    return lexicons[FOLDS], _logistic(x[order], y[order])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton's method with a ridge on all weights but the bias."""
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [round(float(v), 9) for v in w]


def score(docs: DataFrame, model: tuple[dict[str, float], list[float]]) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    lexicon, weights = model
    grammar = Grammar(lexicon)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            scores = []
            for t in batch["text"]:
                if not weights:
                    scores.append(0.0)
                    continue
                z = sum(w * v for w, v in zip(weights, (1.0, *grammar.features(t)), strict=True))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores, "predicted": [int(s >= THRESHOLD) for s in scores]}

    return map_rows(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), "doc_id long, held_out boolean, score double, predicted int", run)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
