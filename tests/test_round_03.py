"""Cases of the findings of round 3."""

import duckdb

from pressmill import queries


def test_name_that_opens_a_text(spark, tmp_path):
    """The SQL takes the next place of a name that opens the text."""
    texts = ["moron a worthless b moron", "moron a worthless b", "clown", "clown, clown", "xmoron moron trash", None, "trash\nmoron trash"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = {tuple(r) for r in queries.QUERIES["entity_first_two"](spark, str(tmp_path)).collect()}
    assert got == set(con.execute(queries.SQL["entity_first_two"]).fetchall())
    assert (0, "C", "A") in got and (1, "A", "C") in got


def test_review_sample_keeps_the_order_of_the_file(spark, tmp_path):
    """Of rows with one position the first of the file is taken, however the rows are dealt to tasks."""
    con = duckdb.connect()
    con.execute("create table lineitem as select (i // 14)::BIGINT as l_orderkey, (i % 7 + 1)::INT as l_linenumber, ((i * 7919) % 11) / 100.0::DOUBLE as l_discount, ['A', 'N', 'R'][(i * 31 // 7) % 3 + 1] as l_returnflag, ['F', 'O'][(i * 17 // 5) % 2 + 1] as l_linestatus from range(6000) r(i)")
    con.execute(f"copy (select * from lineitem) to '{tmp_path}/lineitem.parquet' (format parquet, row_group_size 2048)")
    con.execute("drop table lineitem")
    con.execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet')")
    want = sorted(con.execute(queries.SQL["review_sample"]).fetchall())
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    try:
        for size, parts in (("8k", "13"), ("1g", "1")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert sorted(tuple(r) for r in queries.QUERIES["review_sample"](spark, str(tmp_path)).collect()) == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_samples_rank_few_rows_of_a_stratum(spark):
    """No task gathers a stratum: each hands on as many rows as are asked for."""
    from pressmill.operators import registry

    df = spark.range(5000).selectExpr("id AS pos", "id % 10 / 10.0D AS skor")
    out = registry.stratified_sample(df, "skor", "pos", {"low": 20, "mid": 15, "high": 25})
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2 and out.count() == 60


def test_near_texts_by_blocks(monkeypatch):
    """Near pairs of blocks are those of brute force: titles of any length, characters beyond ASCII, copies with holes."""
    import random

    from pressmill.functions import fuzzy, likeness

    monkeypatch.setattr(likeness, "BLOCK", 50)
    random.seed(3)
    said = ["".join(random.choices(["der ", "tion", "en", "é", "中", "😀", " a"], k=random.randrange(1, 45))) for _ in range(120)]
    texts = sorted({*said, *(t[:9] + t[9 + k % 12 :] + "x" * (k % 5) for k, t in enumerate(said)), "a", "ab", "b" * 200, "b" * 180 + "c"})
    want = {frozenset((x, y)) for i, x in enumerate(texts) for y in texts[:i] if fuzzy.ratio(x, y) >= 85}
    got = [frozenset(p) for x, y in likeness.near_pairs(texts, None, 85.0) for p in zip(x, y, strict=True)]
    assert len(want) > 50 and len(got) == len(set(got)) and set(got) == want
    left, right = texts[::2], texts[1::2]
    got = {p for x, y in likeness.near_pairs(left, right, 85.0) for p in zip(x, y, strict=True)}
    assert got == {(x, y) for x in left for y in right if fuzzy.ratio(x, y) >= 85}


def test_groups_do_not_join_every_two_copies(spark):
    """Rows with one title make a link each, not one for each pair."""
    from pressmill.operators.dedup import near_title_groups, near_title_links, near_title_pairs

    titles = ["Harga gula naik - A"] * 60 + ["Harga gula naik lagi - A", "Ekspor sawit turun", "", ""]
    df = spark.createDataFrame(list(enumerate(titles)), "pos long, title string")
    assert near_title_pairs(df, "title", "pos").count() == 60 * 59 // 2 + 60 and near_title_links(df, "title", "pos").count() < 130
    groups = {r["pos"]: (r["group_pos"], r["group_title"]) for r in near_title_groups(df, "title", "pos").collect()}
    assert all(groups[i] == (0, "Harga gula naik lagi - A") for i in range(61)) and [groups[i] for i in (61, 62, 63)] == [(61, "Ekspor sawit turun"), (62, ""), (63, "")]


def test_officials_by_blocks():
    """Best officials of blocks are those of brute force, ties to the smallest id, null-like and empty titles left out."""
    import random

    from pressmill.functions.fuzzy import token_set_ratio
    from pressmill.operators.registry import _best_officials

    random.seed(5)
    words = ["gula", "naik", "harga", "sawit", "é", "中文", "ekspor", "impor", "turun", "pabrik", "kopi"]
    some = lambda: " ".join(random.choices(words, k=random.randrange(0, 9)))
    held = [(i, some()) for i in random.sample(range(1000), 60)]
    titles = sorted({*(some() for _ in range(150)), *(t[:-2] + "q" for _, t in held), " ", "gula gula"})
    got = {t: (s, o) for t, s, o in zip(*_best_officials(titles, held, 80.0), strict=True)}
    want = {t: (s, -o) for t in titles if (m := max((token_set_ratio(t, o), -i) for i, o in held))[0] >= 80 for s, o in [m]}
    assert got == want and len({s for s, _ in got.values()}) > 5


def test_parties_are_looked_up_only_where_their_characters_stand(monkeypatch):
    """The same answer as the ratio over all windows, and no ratio at all where a text lacks the characters."""
    import random

    from pressmill.functions import fuzzy

    random.seed(2)
    for _ in range(500):
        a, b = "".join(random.choices("abcé ", k=random.randrange(9))), "".join(random.choices("abcdé ", k=random.randrange(40)))
        for least in (50.0, 85.0, 100.0):
            assert fuzzy.partial_reaches(a, b, least) == (fuzzy.partial_ratio(a, b) >= least)
    monkeypatch.setattr(fuzzy, "lcs", None)
    assert not fuzzy.partial_reaches("¤¤¤¤", "kata " * 50_000, 85.0)


def test_words_are_weighed_once(monkeypatch):
    """A word that returns is weighed once for all names and texts."""
    from pressmill.operators import entities

    asked = []
    monkeypatch.setattr(entities, "ratio", lambda a, b, real=entities.ratio: asked.append((a, b)) or real(a, b))
    names = entities.Names({"Agus Gumiwang": ("Agus Gumiwang", "Menperin"), "Putu Juli": ("Putu Juli Ardika", "Putu")})
    text = "harga gula naik dan pabrik gula " * 40 + "kata Agus Gumiwan dan Putu Juli Ardikka"
    assert [n for _, n in names.find(text)] == ["Agus Gumiwang", "Putu Juli"]
    before = len(asked)
    names.find("harga gula naik " * 300)
    assert len(asked) == before < 60


def test_articles_are_not_broadcast(spark):
    """However small Spark takes the articles for, no side of theirs goes through the driver."""
    from pyspark.sql import functions as F

    from pressmill.operators import issues
    from pressmill.operators.dedup import label_components

    docs = spark.createDataFrame([("d1", "harga gula naik", "pabrik gula " * 20), ("d2", "harga gula turun", "pabrik kopi " * 20)], "id string, title string, text string")
    feats, texts = issues.features(docs, "id", "title", F.lit(None).cast("date"), F.col("text")), issues.bodies(docs, "id", "title", F.col("text"), F.lit("2024-01-01").cast("date"))
    pairs = issues.met(feats, feats, issues.title_keys(two=True)).filter("a < b")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    made = [pairs, issues.base_scores(pairs, feats, feats, issues.idf(feats)), issues.body_pairs(texts, texts, days=True), label_components(feats, pairs, "id")]
    assert not any("BroadcastHashJoin" in plan(df) for df in made)
    assert plan(issues.base_scores(pairs, feats, issues.features(docs, "id", "title", F.lit(None).cast("date"), F.col("text")), issues.idf(feats))).count("SortMergeJoin") >= 4


def test_gram_cosines_of_a_batch():
    """Cosines of a batch are those of each pair alone, to the last bit."""
    import random
    from collections import Counter

    from pressmill.operators.issues import gram_cosines

    def alone(x, y):
        if not x or not y:
            return 0.0
        p, q = (Counter(t[i : i + n] for n in (3, 4) for i in range(len(t) - n + 1)) for t in (f" {x} ", f" {y} "))
        dot = sum(c * q[g] for g, c in p.items())
        return dot / (sum(c * c for c in p.values()) ** 0.5 * sum(c * c for c in q.values()) ** 0.5)

    random.seed(4)
    some = [None, "", "a", "中文", *(" ".join(random.choices(["gula", "naik", "é", "😀😀", "aaaaa", "b"], k=random.randrange(1, 14))) for _ in range(600))]
    a, b = random.choices(some, k=5000), random.choices(some, k=5000)
    assert gram_cosines(a, b).tolist() == [alone(x, y) for x, y in zip(a, b, strict=True)] and gram_cosines([], []).tolist() == []


def test_samples_do_not_sort_their_input(spark):
    """Only the first rows of each stratum are held and ranked, ties and unknown scores included."""
    from pressmill.operators import registry

    df = spark.range(4000).selectExpr("4000 - id DIV 2 AS pos", "CASE WHEN id % 11 < 10 THEN id % 11 / 10.0D END AS skor")
    quotas = {"low": 20, "mid": 0, "high": 25}
    out = registry.stratified_sample(df, "skor", "pos", quotas)
    assert out._jdf.queryExecution().executedPlan().toString().count("TakeOrderedAndProject") >= 2
    rows = sorted((r["pos"], "low" if r["skor"] is not None and r["skor"] < 0.45 else "high" if r["skor"] is not None and r["skor"] >= 0.65 else "mid") for r in df.collect())
    want = sorted(r for k, n in quotas.items() for r in [x for x in rows if x[1] == k][:n])
    assert sorted((r["pos"], r["stratum"]) for r in out.collect()) == want
    assert registry.stratified_sample(df, "skor", "pos", {}).count() == 0


def test_groups_by_fixpoint_are_those_of_the_replay(spark, monkeypatch):
    """Chains, copies between near titles, heads before ' - ' and empty titles: as one replay over all rows, without one."""
    import random

    from pyspark.sql import functions as F

    from pressmill.operators import dedup

    random.seed(6)
    base = ["harga gula naik di pasar induk", "ekspor sawit turun tajam tahun ini", "pabrik kopi baru dibuka"]
    said = []
    for k in range(110):
        t = random.choice(base)
        for _ in range(random.randrange(7)):
            i = random.randrange(len(t))
            t = t[:i] + random.choice("xyzé") + t[i + 1 :]
        said.append(random.choice([t, t.upper(), f"{t} - {random.choice(['A', 'Media Nusantara Online', 'B - C'])}", f"{t}  - x", f" - {t}"]))
        if k % 3 == 0:
            said.append(random.choice(said))
    said += ["", None, " ", " ", " - ", "中文 - a"]
    df = spark.createDataFrame(list(enumerate(said)), "pos long, title string")
    want = {tuple(r) for r in dedup.replay_groups(df.withColumn("c", F.lit(0)), "c", "title", "pos").select("pos", "group_pos", "group_title").collect()}
    monkeypatch.setattr(dedup, "replay_groups", None)
    got = dedup.near_title_groups(df, "title", "pos")
    assert got.columns == ["pos", "title", "group_pos", "group_title"] and {tuple(r)[:1] + tuple(r)[2:] for r in got.collect()} == want
    assert 20 < len({r[1] for r in want}) < len(want) - 20


def test_patterns_open_with_the_first_characters(spark):
    """What is dear is asked only where a value may begin; the answers stay those of whole words."""
    from pyspark.sql import functions as F

    from pressmill.operators.predicates import SPARK, word

    values = ("gula", "rp 5", "é-x", "[a")
    said = ["gula", "xgula", "gulay", "a gula, b", "rp 5", "rp 55", "é-x", "aé-x", "[a]", "[ab", "", "-"]
    shown = word("t", values).show(SPARK)
    assert shown.index("(?=[") < shown.index("(?<!")
    got = [r["t"] for r in spark.createDataFrame([(t,) for t in said], "t string").filter(F.expr(shown)).collect()]
    assert sorted(got) == sorted(["gula", "a gula, b", "rp 5", "é-x", "[a]"])


def test_titles_are_worked_out_once(spark):
    """A title's steps stand once in the plan, not once for each branch that reads them."""
    from pyspark.sql import functions as F

    from pressmill.operators import issues

    df = spark.createDataFrame([("a", "Ekspor Sawit RI Naik 5 Persen, Harga Turun - Kabar.com", "Kabupaten Riau: ekspor&amp;harga"), ("b", None, None)], "id string, title string, text string")
    feats = issues.features(df, "id", "title", F.lit(None).cast("date"), F.col("text"))
    texts = issues.bodies(df, "id", "title", F.col("text"))
    for made in (feats, texts):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("MetroTVNews") <= 4
        assert made._jdf.queryExecution().optimizedPlan().toString().count("&quot;") <= 6
    assert [r["title"] for r in feats.orderBy("id").collect()] == ["Ekspor Sawit RI Naik 5 Persen, Harga Turun", ""]
    assert [list(r["places"]) for r in texts.orderBy("id").collect()] == [["riau"], []]


def test_only_open_pairs_meet_by_grams(spark):
    """Scores take to Python the titles of pairs whose score rests on them, with no sides' maps, and the pairs of a text come together."""
    from pyspark.sql import functions as F

    from pressmill.operators import issues

    rows = [("a", "Harga gula naik di pasar induk"), ("b", "Harga gula naik di pasar induk"), ("c", "Gula pasir langka di pasar induk"), ("d", "Sidang gula pasar induk di mk")]
    feats = issues.features(spark.createDataFrame(rows, "id string, title string"), "id", "title", F.lit(None).cast("date"), F.lit(""))
    pairs = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d")], "a string, b string")
    out = issues.base_scores(pairs, feats, feats, issues.idf(feats))
    plan = out._jdf.queryExecution().optimizedPlan()
    python = [line for line in plan.toString().splitlines() if "ArrowEvalPython" in line]
    assert len(python) == 2 and all("CASE WHEN" in line or "_norm" not in line for line in python)  # masked
    below = plan.toString().split("ArrowEvalPython")[-1].splitlines()[1]
    assert "a_w" not in below.split("Project")[-1].split("AS _word")[-1]
    got = {r["b"]: (r["base"], r["kind"]) for r in out.collect()}
    assert got["b"] == (1.0, issues.FIXED) and got["d"] == (0.12, issues.FIXED) and got["c"][1] == issues.DATED and 0.3 < got["c"][0] < 1


def test_cosines_of_a_label_meet_in_parts(spark, tmp_path):
    """Pairs of one label as in the SQL, by products of packs in parts of a label; vectors of zeros and labels that are null."""
    import random

    random.seed(8)
    rows = [(i, [random.uniform(-1, 1) for _ in range(5)] if i % 17 else [0.0] * 5, None if i % 13 == 5 else f"l{i % 3}") for i in range(160)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    for name in ("embedding_cosine", "embedding_cosine_all"):
        want = sorted((a, b, str(c)) for a, b, c in con.execute(queries.SQL[name]).fetchall())
        df = queries.QUERIES[name](spark, str(tmp_path))
        got = sorted((r["a"], r["b"], str(r["cos"] + 0.0)) for r in df.collect())
        assert [x[:2] for x in got] == [x[:2] for x in want] and any(c == "nan" for *_, c in want)
        assert all(x[2] == y[2] or float(x[2]) == float(y[2]) for x, y in zip(got, want, strict=True))
        assert "_part" in df._jdf.queryExecution().optimizedPlan().toString() or name == "embedding_cosine_all"


def test_alike_articles_are_scored_once(spark, monkeypatch):
    """Articles of one title and lead meet the issues as one; a copy whose body alone passes the gate brings no other copy."""
    from pyspark.sql import functions as F

    from pressmill.operators import assignment, issues

    body = "Kabupaten Riau mencatat panen besar kakao premium menurut petani lokal serta koperasi desa makmur sentosa abadi"
    rows = [("a1", "Harga gula naik", ""), ("a2", "Harga gula naik", ""), ("a3", "Harga gula naik", body), ("a4", "Kopi langka", body), ("a5", "Kopi langka", "")]
    docs = spark.createDataFrame(rows, "id string, title string, text string")
    items = spark.createDataFrame([("b1", "Gula pasir naik tajam", ""), ("b2", "Cokelat melimpah", body)], "id string, title string, text string")
    feats = [issues.features(x, "id", "title", F.lit(None).cast("date"), F.lit("")) for x in (docs, items)]
    texts = [issues.bodies(x, "id", "title", F.col("text")) for x in (docs, items)]
    seen = []
    real = assignment.base_scores
    monkeypatch.setattr(assignment, "base_scores", lambda pairs, *a: seen.append(pairs.count()) or real(pairs, *a))
    got = {(r["a"], r["b"]): (r["kind"], r["body_cosine"]) for r in assignment.match_pairs(*feats, *texts).collect()}
    assert set(got) == {("a1", "b1"), ("a2", "b1"), ("a3", "b1"), ("a3", "b2"), ("a4", "b2")} and seen == [3]
    assert got["a3", "b2"][1] > 0.9 and got["a1", "b1"][1] is None
