"""KD-tree search, filter audit and collocations against brute force on fixtures of edge cases."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.llm import collocations, filter_audit, kd_search

VECTORS = "vec_id long, embedding array<float>, label int"


def vector_rows():
    rng = random.Random(5)
    point = lambda d: [round(rng.uniform(-1, 1), 3) for _ in range(d)]
    rows = [(i, point(6), i % 3) for i in range(700)]
    same = point(6)
    rows += [(i, list(same), 0) for i in range(700, 1000)]  # a third are copies
    rows += [(1000, [0.0] * 6, None), (1000, [0.0] * 6, None), (1100, None, 1), (1200, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (1300, [math.inf] + [0.0] * 5, 1), (1301, [math.nan] + [0.0] * 5, 1)]
    rows += [(None, point(6), 1), (None, list(same), 1), (-100, point(6), 2), (1400, point(2), 2), (1401, point(2), 2), (1500, [], 2), (1501, [], 2)]
    return rows + [(1600, [3e30] * 3, 1), (1601, [2e9] * 3, 1), (1602, [-2e9] * 3, 1), (1700, [2e9 + 512] * 3, 1)]


def best(rows, k):
    good = [(n, i, [math.floor(1024 * float(np.float32(x))) for x in v]) for n, (i, v, _) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in good:
        if i is None or i % 100:
            continue
        found = sorted((-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63)), 2**63 - 1), j is None, j or 0) for m, j, w in good if m != n and len(v) == len(w))
        out += [(i, rank + 1, None if unnamed else j, -s) for rank, (s, unnamed, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


def read_back(spark, tmp_path_factory, rows, schema, name):
    path = str(tmp_path_factory.mktemp(name) / f"{name}.parquet")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    return read_back(spark, tmp_path_factory, vector_rows(), VECTORS, "embeddings")


@pytest.mark.parametrize(("shard_cells", "block_cells"), [(1 << 19, 1 << 17), (900, 12)])
def test_kd_search(vectors, shard_cells, block_cells):
    clashing = vectors.withColumns({c: F.lit("kept") for c in ("dims", "x", "h", "shard", "block", "_f", "_r", "kth", "id", "rank")})
    for given in (vectors, clashing):
        got = kd_search.top_k(given, 10, F.col("vec_id") % 100 == 0, shard_cells=shard_cells, block_cells=block_cells)
        assert sorted(map(tuple, got.collect()), key=repr) == best(vector_rows(), 10)


def test_kd_search_of_nothing(vectors):
    assert kd_search.digest(vectors.limit(0)).count() == 0
    assert kd_search.digest(vectors.filter("vec_id = 1400")).count() == 0  # nothing but itself


@pytest.mark.parametrize("leaf", [1, 7, 64])
def test_tree(leaf):
    rng = np.random.default_rng(leaf)
    rows = np.floor(rng.normal(0, 50, (500, 5)))
    rows[100:300] = rows[0]
    tree = kd_search.build(rows, leaf)
    assert sorted(tree.order) == list(range(500)) and (tree.rows == rows[tree.order]).all()
    for a, b, left, low, high in zip(tree.start, tree.end, tree.left, tree.low, tree.high, strict=True):
        assert (tree.rows[a:b].min(axis=0) == low).all() and (tree.rows[a:b].max(axis=0) == high).all()
        assert left >= 0 or b - a <= leaf or (low == high).all()
        if left >= 0:
            assert (tree.start[left], tree.end[left + 1]) == (a, b) and tree.end[left] == tree.start[left + 1] == a + (b - a) // 2
    queries = np.floor(rng.normal(0, 50, (20, 5)))
    scores = queries @ tree.rows.T
    for kth in (-np.inf, 3000.0):
        found = kd_search.search(tree, list(range(500)), np.full(20, -1), queries, 8, np.full(20, kth))
        for q, hits in enumerate(found):
            want = sorted(((-s, i) for i, s in enumerate(scores[q]) if s >= kth))[:8]
            assert hits == [(int(-s), i) for s, i in want]


def test_tree_leaves_out_what_cannot_win():
    rows = np.repeat(np.arange(1000.0), 2).reshape(-1, 2)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key)
            return np.asarray(self)[key]

    tree = kd_search.build(rows, 10)
    tree.rows = tree.rows.view(Watched)
    hits = kd_search.search(tree, list(range(1000)), np.array([-1]), np.array([[1.0, 1.0]]), 5, np.array([-np.inf]))
    assert [s for s, _ in hits[0]] == [1998, 1996, 1994, 1992, 1990] and len(read) < 4


DOCS = "doc_id long, text string, lang string, source string"


def doc_rows():
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 4))) for _ in range(12)] + ["The", "$5", "|", "e f", "x\x1cy"]
    say = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", " \x0b", "  "]) for _ in range(n))
    texts = [say(rng.choice([3, 40, 250])) for _ in range(60)]
    texts += [texts[0]] * 40 + [texts[1], texts[1].upper()] + [None, "", " \n", "a", "a b", "word", "A" * 50 + " b", "ab cd ef " * 4000, "lo" * 5000]
    rows = [(i, t, rng.choice(["en", "de", None, "und"]), rng.choice(["s", "s", None, "", "é"])) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [rows[5], rows[5], (None, texts[0], "en", "s"), (None, texts[0], None, None), (0, texts[2], "en", "s"), (900, None, None, None), (901, texts[0], "fr", "only")]


LABELS = [(i, i % 2, i % 3 // 2) for i in range(0, 80)] + [(3, 0, 1), (None, 1, 1), (4, None, None), (999, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return read_back(spark, tmp_path_factory, doc_rows(), DOCS, "documents")


def masks():
    rows, least = doc_rows(), {}
    for i, t, _, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = ({i for i, *flags in LABELS if i is not None and flags[c] == 1} for c in (0, 1))
    for i, t, _, source in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > least[t]]
        yield source or "", {f for f, bad in zip("ABCDE", fails, strict=True) if bad}, i in good, i in toxic


def audit_by_hand():
    parts = defaultdict(list)
    for part, *rest in masks():
        parts[part].append(rest)
    out = []
    for part, docs in parts.items():
        rows, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(docs)
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(removed)
                fails = sum(f in d[0] for d in docs)
                rows.append((f, ("".join(order), step, len(left), len(removed), fails - len(removed), sum(d[0] == {f} for d in docs), sum(d[1] for d in removed), sum(d[2] for d in removed))))
        out += [(part, *row, shapley[f]) for f, row in rows]
    return sorted(out)


def test_filter_audit(spark, docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    clashing = docs.withColumns({c: F.lit(7) for c in ("h", "part", "mask", "good", "toxic", "quality", "c", "n", "least", "cells")})
    for given in (docs, clashing):
        assert sorted(map(tuple, filter_audit.digest(given, labels).collect())) == audit_by_hand()
    assert filter_audit.digest(docs.limit(0), labels).count() == 0
    unlabelled = filter_audit.digest(docs, labels.limit(0))
    assert unlabelled.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_orders_differ_by_one_swap(n):
    orders = list(filter_audit.adjacent_orders(n))
    assert sorted(o for o, _ in orders) == sorted(map(list, itertools.permutations(range(n))))
    for (before, _), (after, at) in itertools.pairwise(orders):
        assert [i for i in range(n) if before[i] != after[i]] == [at, at + 1]


def phrases_by_hand(per_lang=2000, least=10, most=3):
    n, f = Counter(), Counter()
    for _, t, lang, _ in doc_rows():
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    found = defaultdict(list)
    for (lang, *w), a in candidates.items():
        cuts = [(1_000_000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        inside = lambda longer: any(longer[s : s + len(w)] == w for s in range(len(longer) - len(w) + 1))
        if not any(len(h) - 1 > len(w) and h[0] == lang and inside(list(h[1:])) and 100 * c >= 50 * a for h, c in candidates.items()):
            found[lang].append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, rows in found.items() for i, (s, a, p, x, y) in enumerate(sorted(rows)[:per_lang]))


def test_collocations(docs, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_WORDS", 300)
    clashing = docs.withColumns({c: F.lit("kept") for c in ("n", "phrase", "c", "t", "w", "a", "l", "r", "rank", "score")})
    want = phrases_by_hand()
    assert len(want) > 100
    for given in (docs, clashing):
        assert sorted(map(tuple, collocations.digest(given).collect())) == want
    assert collocations.digest(docs.limit(0)).count() == 0


def test_longer_phrases(docs):
    got = collocations.top_collocations(docs, 50, 4, 5).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(50, 4, 5)


def test_large_counts_stay_exact(spark, monkeypatch):
    counts = [("en", 1, "x", 4 * 10**13 + 1), ("en", 1, "y", 10**14 + 7), ("en", 2, "x y", 4 * 10**13 - 11)]
    size = spark.createDataFrame([("en", 14 * 10**13 + 8)], "lang string, n long")
    monkeypatch.setattr(collocations, "count_ngrams", lambda docs, least, most: (docs, size))
    (row,) = collocations.collocations(spark.createDataFrame(counts, "lang string, n int, phrase string, c long")).collect()
    assert row.score == 10**6 * (4 * 10**13 - 11) ** 2 // ((4 * 10**13 + 1) * (10**14 + 7)) and row.n == 14 * 10**13 + 8


@pytest.mark.parametrize("depth", [1, 2, 3, 5, 8])
def test_suffix_array(depth):
    rng = random.Random(depth)
    ids = np.array([rng.randint(0, 3) for _ in range(400)] + [0])
    order = collocations.suffix_array(ids, depth)
    cut = [tuple(ids[i : i + depth]) for i in order]
    assert sorted(order) == list(range(401)) and cut == sorted(cut)
    want = Counter(tuple(ids[i : i + depth]) for i in range(402 - depth) if 0 not in ids[i : i + depth])
    assert {tuple(ids[i : i + depth]): c for i, c in zip(*collocations.ngrams(ids, depth), strict=True)} == want


def test_map_of_frequent_phrases_is_only_a_filter(docs, monkeypatch):
    """A crowded map lets rare phrases through and changes no count."""
    monkeypatch.setattr(collocations, "MAP_BITS", 1 << 6)
    monkeypatch.setattr(collocations, "PART_BITS", 1 << 4)
    assert sorted(map(tuple, collocations.digest(docs).collect())) == phrases_by_hand()
