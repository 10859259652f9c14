"""Each corpus operator against brute force on a fixture of edge cases: nulls, empty and very long texts, ties, repeats, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pressmill.llm import chat, decontamination, jaccard_join, mixing, packing, pii, quality, sharding, suffix_dedup, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def make_rows():
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    bases = [say(rng.randint(30, 120)) for _ in range(10)]
    texts = []
    for b in bases:
        ws = b.split()
        texts += [b, b, b.upper(), " ".join(ws[:-1]), b.replace(" ", "\n", 5)]
        ws[len(ws) // 2] = "changed"
        texts.append(" ".join(ws))
    texts += [say(rng.randint(60, 200)) for _ in range(25)]
    shared = say(70)
    texts += [f"{say(20)} {shared} {say(30)}" for _ in range(8)]
    texts += [None, "", "   \n", "a", "a b c", "x" * 700, "ab " * 3000, say(6000), "word word\x1cword é" * 30]
    texts += ["write to me.x@site.org or 1.2.3.4, card 4111 1111 1111 1111, phone +49 (30) 1234-5678; a@b.c_d@e.f", "iban DE89 3704 0044 0532 0130 00 and 999.1.1.1 and 4111 1111 1111 1112"]
    sources = ["src0"] * (len(texts) // 3) + [None, "b", "é"] * len(texts)
    rows = [(i, t, rng.choice(["en", "de", None]), sources[i], None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[0], "en", "src0", 5), (None, None, None, None, None)]


ROWS = make_rows()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def clashing(docs):
    """docs with columns that are named like the operators' own."""
    names = ["_f", "_r", "_t", "_h", "_row", "shard", "slot", "size", "label", "node", "copies", "pii", "h", "c", "t", "text_bytes"]
    return docs.withColumns({n: F.lit("kept") for n in names})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def tokens(t):
    return WORD.findall((t or "").encode().lower())


def sets(k):
    out = []
    for r in ROWS:
        w = tokens(r[1])
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def linked(k, percent):
    s = sets(k)
    parent = list(range(len(s)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= percent * len(s[i] | s[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return s, [find(i) for i in range(len(s))]


def test_jaccard_join(docs):
    s, roots = linked(4, 85)
    ids = defaultdict(list)
    for r, root in zip(ROWS, roots, strict=True):
        ids[root].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    want = sorted(((r[0], len(x), least[root] if x else r[0]) for r, x, root in zip(ROWS, s, roots, strict=True)), key=repr)
    assert rows(jaccard_join.digest(docs)) == want


def test_jaccard_dedup_keeps_one(clashing):
    s, roots = linked(5, 80)
    out = jaccard_join.dedup(clashing, 5, 80)
    assert out.columns == clashing.columns
    assert out.count() == len({root for root, x in zip(roots, s, strict=True) if x}) + sum(not x for x in s)
    again = jaccard_join.dedup(clashing.unionByName(clashing), 5, 80)  # not a scan of files
    assert again.filter("length(trim(text)) > 3").count() == out.filter("length(trim(text)) > 3").count()


@pytest.mark.parametrize("hot", [4000, 2])
def test_suffix_dedup(docs, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeats, "__defaults__", (200, 64, hot))
    data = [(r[1] or "").encode() for r in ROWS]
    seen = Counter(t[p : p + 200] for t in data for p in range(len(t) - 199))
    want = []
    for r, t in zip(ROWS, data, strict=True):
        covered = bytearray(len(t))
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                covered[p : p + 200] = b"\1" * 200
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        want.append((r[0], len(t), len(t) - len(kept), len(re.findall(b"\1+", bytes(covered))), hashlib.sha256(kept).hexdigest()))
    assert rows(suffix_dedup.digest(docs)) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [4000, 2])
def test_suffix_dedup_runs_inside_unique_text(spark, hot, tmp_path, monkeypatch):
    """Near anchors of one row share starts, which count once: groups below 49 contexts, above 48, and hot."""
    monkeypatch.setattr(suffix_dedup.repeats, "__defaults__", (200, 64, hot))
    rng = random.Random(5)
    own = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    texts = [own(400) + "=" * 200 + own(400), own(400) + "-" * 80 + own(400), own(300) + "xyz" * 66 + own(300), own(300) + "*" * 300 + own(300)]
    texts += [own(100) + "#" * 70 + own(30) + "#" * 70 + own(100) for _ in range(30)] + ["~" * 199, own(50) + "~" * 150 + own(50)]
    texts += [own(200) + texts[0][350:650] + own(200)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    seen = Counter(t[p : p + 200] for t in texts for p in range(len(t) - 199))
    want = [sum(any(seen[t[q : q + 200]] > 1 for q in range(max(0, p - 199), min(p, len(t) - 200) + 1)) for p in range(len(t))) for t in texts]
    got = suffix_dedup.digest(spark.read.parquet(str(tmp_path / "documents.parquet"))).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == want and want[1] == 0 and want[0] == want[-1] == 300 and want[3] == 300


@pytest.mark.parametrize("hot", [4000, 2])
def test_suffix_dedup_keeps_unique_text_around_a_run(spark, hot, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeats, "__defaults__", (200, 64, hot))
    rng = random.Random(6)
    own = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    spark.createDataFrame([(1, own(400) + "=" * 200 + own(400))], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert [r["n_removed"] for r in suffix_dedup.digest(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()] == [0]


def test_suffix_remove_passes_columns(clashing):
    out = suffix_dedup.remove(clashing)
    assert sorted(out.columns) == sorted(clashing.columns) and out.count() == len(ROWS)
    assert out.filter("text is null and text_bytes is not null").count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(0)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 40))) for _ in range(7)]

    def coded(run):
        lengths, rests = suffix_dedup.front_code(run)
        return iter([(n, r, None) for n, r in zip(lengths, rests, strict=True)])

    got = list(suffix_dedup.LoserTree([coded(r) for r in runs]))
    assert [s for _, s, _ in got] == sorted(x for r in runs for x in r)
    assert all(n == suffix_dedup.shared_prefix(a, b) for (_, a, _), (n, b, _) in zip(got, got[1:], strict=False))


def test_pii(docs):
    kinds = {"email": rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": rb"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": rb"[0-9]([\x20-]?[0-9])+", "phone": rb"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    def valid(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]

    want = []
    for r in ROWS:
        spans = [(k, m.start(), m.end()) for k, p in kinds.items() for m in re.finditer(p.decode(), r[1] or "", re.ASCII) if valid(k, m[0])]
        n = Counter(k for k, *_ in spans)
        want.append((r[0], n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()))
    got = pii.digest(docs)
    assert rows(got.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")) == sorted(want, key=repr)
    assert got.filter("spans like '%iban:5:32%'").count() == 1


def test_pii_mask_and_long_runs(spark, clashing):
    out = pii.mask(pii.detect(clashing))
    assert out.filter("text like 'write to <email> or <ip>, card <card>, phone <phone>%'").count() == 1
    long_ = spark.createDataFrame([(1, "1" * 200_000), (2, "a." * 100_000), (3, "a@" + "b." * 100_000 + "c")], "doc_id long, text string")
    assert [r["n_email"] for r in pii.digest(long_).orderBy("doc_id").collect()] == [0, 0, 1]


def test_pii_iban_beside_capitals_and_numbers(spark):
    iban, gb = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    texts = [f"{iban} BIC COBADEFF", "DE89370400440532013000 2024", f"{gb} EUR 500", f"{iban} {gb}", f"AB12 CDEF GHIJ KLMN {iban}", f"{iban}9", "DE88 3704 0044 0532 0130 00", f"{iban}", "NO9386011117947 NOK"]
    want = ["iban:0:27", "iban:0:22", "iban:0:27", "iban:0:27,iban:28:55", "iban:20:47", "", "", "iban:0:27", "iban:0:15"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["spans"] for r in pii.digest(df).orderBy("doc_id").collect()] == want
    assert pii.mask(pii.detect(df)).orderBy("doc_id").first()["text"] == "<iban> BIC COBADEFF"


def test_mixing(docs):
    got = mixing.digest(docs).collect()
    sizes = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got)
    assert sizes == sorted((r[0] is None, r[0] or 0, len(tokens(r[1]))) for r in ROWS)
    per = defaultdict(int)
    for r in ROWS:
        per[r[3]] += len(tokens(r[1]))
    order = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped, target = set(), {}
    while True:
        share = (sum(per.values()) - sum(3 * per[s] for s in capped)) / max(1, sum(weight[s] for s in order if s not in capped))
        target = {s: 3.0 * per[s] if s in capped else share * weight[s] for s in order}
        over = {s for s in order if target[s] > 3 * per[s] + 1e-9}
        if not over:
            break
        capped |= over
    taken = defaultdict(int)
    for r in got:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == per[r["source"]]
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = {s: max(len(tokens(r[1])) for r in ROWS if r[3] == s) for s in order}
    assert all(abs(taken[s] - target[s]) <= 0.5 * largest[s] for s in order)  # a source of few documents can't come nearer
    assert rows(mixing.digest(docs)) == sorted((tuple(r) for r in got), key=repr)


def test_mixing_passes_rows(clashing):
    out = mixing.mix(clashing)
    assert out.columns == clashing.columns and out.filter("copies <> 'kept'").count() == 0


def test_quality(docs, clashing):
    got = {(r["doc_id"], r["n_words"]): r for r in quality.digest(docs).collect()}
    for r in ROWS:
        w = WORD.findall((r[1] or "").encode())
        tri = Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {i + j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in (r[1] or "").encode().split(b"\n") if WORD.search(x)]
        x = got[r[0], len(w)]
        assert (x["word_chars"], x["n_repeat_words"], x["n_dup_lines"]) == (sum(len(y.decode()) for y in w), len(hit), len(lines) - len(set(lines)))
        assert x["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (x["base_failed"] and x["kept"])
    out = quality.filter_docs(clashing)
    assert out.columns == clashing.columns and out.count() == sum(r["kept"] for r in quality.digest(docs).collect())


def test_sharding(docs, clashing):
    got = sharding.digest(docs).collect()
    assert Counter((r["size"], r["text_crc32"]) for r in got) == Counter((len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[i]) for i in range(40)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    out = sharding.shard(clashing, [F.col("source"), F.col("n_chars")], [F.col("doc_id")], 7)
    assert out.count() == len(ROWS) and set(out.columns) == set(clashing.columns)


def test_hilbert_curve_is_a_path():
    import numpy as np

    for n, bits in ((2, 3), (3, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij")).reshape(n, -1)
        order = np.argsort(sharding.hilbert_index(list(grid), bits))
        assert len(set(sharding.hilbert_index(list(grid), bits).tolist())) == grid.shape[1]
        assert (np.abs(np.diff(grid[:, order])).sum(axis=0) == 1).all()


def test_chat_folds_events(spark):
    log = [
        (1, 0, "message", 0, "user", "hi <|end|> & &lt;"),
        (1, 1, "message", 1, "assistant", "Hel"),
        (1, 2, "delta", 1, "assistant", "lo"),
        (1, 3, "edit", 0, "user", "hi!"),
        (1, 4, "regenerate", 1, "assistant", ""),
        (1, 5, "delta", 1, "assistant", "Again<"),
        (2, 0, "message", None, None, None),
        (2, 0, "message", None, None, None),
        (3, 0, "message", None, "system", "stays"),
        (3, 1, "message", 1, "assistant", "a"),
        (3, 2, "regenerate", 1, "assistant", "b"),
        (4, 0, "message", None, "system", "goes"),
        (4, 1, "message", 1, "user", "goes too"),
        (4, 2, "regenerate", None, "system", "new"),
        (4, 3, "message", 1, "user", "last"),
    ]
    out = {r["conv_id"]: r for r in chat.format_events(spark.createDataFrame(log, "conv_id long, seq long, kind string, turn long, role string, text string")).collect()}
    assert [(t["role"], t["text"]) for t in out[1]["turns"]] == [("user", "hi!"), ("assistant", "Again<")] and out[1]["loss_text"] == "Again<"
    assert [(t["role"], t["text"]) for t in out[2]["turns"]] == [("", ""), ("", "")]
    assert [t["text"] for t in out[3]["turns"]] == ["stays", "b"] and [t["text"] for t in out[4]["turns"]] == ["new", "last"]


def test_toxicity_generalises(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.digest(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    good = sum(r["predicted"] == r["toxic"] for r in got) / len(got)
    assert len(got) > 50 and good > 0.9 and all(0 <= r["score"] <= 1 for r in got)
    none = spark.createDataFrame([(1, None), (2, ""), (None, "you idiot")], "doc_id long, text string")
    assert toxicity.digest(none, labels.limit(0)).filter("score = 0 and predicted = 0").count() == 3


def test_grammar_scales_clauses():
    g = toxicity.Grammar({"idiot$": 2.0})
    weigh = lambda s: g.clause(s.split(), False)[0]
    assert weigh("you idiot") > weigh("an idiot") > weigh("he said idiot") and weigh("not an idiot") < weigh("an idiot")
    assert weigh("i will hurt you") == toxicity.THREAT_WEIGHT


def test_decontamination(spark, docs, clashing):
    items = [(1, " ".join(tokens(ROWS[0][1])[i].decode() for i in range(20))), (2, "a b c"), (3, ""), (4, None), (None, "A, b; C"), (2, "a b c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    norm = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = norm(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    want = []
    for r in ROWS:
        w, hit, found = norm(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= own
        want.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert rows(decontamination.digest(docs, bench)) == sorted(want, key=repr)
    out = decontamination.remove(clashing, bench)
    assert out.columns == clashing.columns and decontamination.digest(out, bench).filter("contaminated").count() == 0
    assert out.count() >= sum(not x[5] for x in want)


def test_decontamination_in_blocks(spark, docs):
    bench = spark.createDataFrame([(i, ROWS[i][1]) for i in range(12)], "item_id long, text string")
    assert len(list(decontamination.blocks(bench, 100))) > 3
    whole, cleaned = rows(decontamination.digest(docs, bench)), rows(decontamination.remove(docs, bench))
    try:
        decontamination.blocks.__defaults__ = (100,)
        assert rows(decontamination.digest(docs, bench)) == whole
        assert rows(decontamination.remove(docs, bench)) == cleaned
    finally:
        decontamination.blocks.__defaults__ = (decontamination.BLOCK_WORDS,)


def test_packing_round_trip(spark, docs):
    import numpy as np
    import tiktoken

    ranks = packing.load_ranks(packing.TOKENIZER)
    coder = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = defaultdict(list)
    for r in packing.pack(docs, row_tokens=256, block_tokens=3000).collect():
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 256 and r["cu_seqlens"][-1] == r["n_tokens"] <= 256 and r["position_resets"] == r["cu_seqlens"][:-1]
        for doc, no, at, s, e in zip(r["doc_ids"], r["doc_nos"], r["doc_offsets"], r["cu_seqlens"][:-1], r["cu_seqlens"][1:], strict=True):
            pieces[r["block"], no, doc].append((at, ids[s:e].tolist()))
    got = Counter()
    for (_, _, doc), parts in pieces.items():
        ids = [x for _, p in sorted(parts) for x in p]
        assert ids[-1] == len(ranks)
        got[doc, coder.decode(ids[:-1])] += 1
    assert got == Counter((r[0], r[1]) for r in ROWS if r[1])


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    conv = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (pii.digest(none), mixing.digest(none), quality.digest(none), sharding.digest(none), chat.digest(conv), toxicity.digest(none, labels), decontamination.digest(none, bench), suffix_dedup.digest(none), jaccard_join.digest(none), packing.digest(none)):
        assert df.count() == 0
    assert decontamination.digest(docs, bench).filter("contaminated").count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert set(docs.columns) < set(out.columns) and 0 < out.count()
    assert decontamination.digest(out, bench).filter("contaminated").count() == 0
    assert quality.digest(out).filter("not kept and n_words >= 50").count() == 0


def paths(tapes, tokens, start):
    """Every path of the tapes in lockstep, enumerated: (factors of each token) and whether it ends well."""
    states = [([], [s for s in start])]
    for token in tokens:
        after = []
        for factors, at in states:
            partial = [(token, 1.0, [])]
            for tape, state in zip(tapes, at, strict=True):
                partial = [(z, f * g, [*done, to]) for y, f, done in partial for z, g, to in tape.step(state, y)]
            after += [([*factors, f], done) for _, f, done in partial]
        states = after
    return [factors for factors, at in states if all(tape.final(s) for tape, s in zip(tapes, at, strict=True))]


def test_composition_is_the_best_of_all_paths():
    class Tape:
        def __init__(self, t):
            self.step, self.final = lambda state, x: t.arcs[state, x], t.final

    tapes = [Tape(t) for t in (toxicity.negation(), toxicity.reported_speech(), toxicity.target(), toxicity.threat(), toxicity.insult())]
    words = {"w": "tree", "T": "you", "N": "not", "R": "said", "H": "hurt", "I": "idiot"}
    g, rng = toxicity.Grammar({"idiot$": 1.7}), random.Random(4)
    for _ in range(300):
        letters = [rng.choice("wwTNRHII") for _ in range(rng.randint(0, 9))]
        quoted = rng.random() < 0.3
        found = paths(tapes, letters, [0, quoted, (0, 0), 0, 0])
        want = max(sum(f * (1.7 if x == "I" else 1.0) for f, x in zip(factors, letters, strict=True)) for factors in found)
        assert abs(g.clause([words[x] for x in letters], quoted)[0] - want) < 1e-9


def test_toxicity_of_one_class_ties_and_repeats(spark, clashing):
    labels = spark.createDataFrame([(i, 1, 1) for i in range(60)], "doc_id long, quality int, toxic int")
    assert toxicity.digest(clashing, labels).filter("score = 0 and predicted = 0").count() == len(ROWS)
    both = labels.unionByName(spark.createDataFrame([(i, 1, 0) for i in range(30, 90)], "doc_id long, quality int, toxic int"))
    got = toxicity.digest(clashing, both).join(clashing.select("doc_id", "text"), "doc_id").groupBy("text").agg(F.countDistinct("score").alias("n"))
    assert got.filter("n > 1").count() == 0
    assert rows(toxicity.digest(clashing, both)) == rows(toxicity.digest(clashing, both))
