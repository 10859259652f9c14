"""Every query with SQL against DuckDB on the smallest tables; the others against brute force or golden cases."""

import duckdb
import pytest
from pyspark.sql import functions as F

from pressmill import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(_plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, con, name):
    df = queries.QUERIES[name](spark, DATA)
    want = con.execute(queries.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    assert sorted((tuple(map(_plain, r)) for r in df.collect()), key=repr) == sorted((tuple(_plain(r[i]) for i in order) for r in want.fetchall()), key=repr)


def test_near_titles_against_brute_force(spark):
    from pressmill.functions.fuzzy import ratio
    from pressmill.operators.dedup import near_title_groups, near_title_pairs

    titles = ["Harga gula naik - Media A", "Harga gula naik - Kantor B", "Harga gula naik lagi", "Ekspor sawit turun", "Ekspor sawit turun!", "", "x"]
    df = spark.createDataFrame(list(enumerate(titles)), "pos long, title string")
    variants = [{t.lower(), t.lower().rpartition(" - ")[0] or t.lower()} - {""} for t in titles]
    want = {(i, j) for i in range(len(titles)) for j in range(i + 1, len(titles)) if any(ratio(a, b) >= 85 for a in variants[i] for b in variants[j])}
    assert {tuple(r) for r in near_title_pairs(df, "title", "pos").collect()} == want
    groups = {r["pos"]: r["group_pos"] for r in near_title_groups(df, "title", "pos").collect()}
    assert groups[0] == groups[1] == 0 and groups[3] == groups[4] == 3 and groups[6] == 6


def test_cosines_of_every_label(spark):
    from pressmill.operators import issues

    rows = [(0, [1.0, 0.0], "x"), (1, [3.0, 4.0], "y"), (2, [0.0, 0.0], None), (3, None, "x"), (4, [1.0, None], "x"), (5, [1.0], "x"), (6, [-2.0, 0.0], None)]
    df = spark.createDataFrame(rows, "id long, v array<float>, label string")
    got = {(r["a"], r["b"]): r["cos"] for r in issues.cosines(df, df).collect()}
    assert len(got) == 49 and round(got[0, 1], 12) == 0.6 and got[0, 6] == -1 and got[0, 2] == got[2, 2] == 0
    assert all(got[0, i] is None and got[i, 0] is None for i in (3, 4, 5)) and got[5, 5] == 1
    e = spark.read.parquet(f"{DATA}/embeddings.parquet")
    assert queries.QUERIES["embedding_cosine_all"](spark, DATA).count() == e.filter("vec_id % 20 = 0").count() * (e.count() - 1)


def test_blend(spark):
    from pressmill.operators import issues

    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [3.0, 4.0]), ("c", None), ("d", [-1.0, 0.0])], "id string, v array<float>")
    scores = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.5), ("a", "d", 0.5), ("b", "d", 0.2), ("a", "e", 0.3)], "a string, b string, score double")
    got = {(r["a"], r["b"]): round(r["score"], 12) for r in issues.blend(scores, vectors).collect()}
    assert got == {("a", "b"): 0.545, ("a", "c"): 0.5, ("a", "d"): 0.275, ("b", "d"): 0.2, ("a", "e"): 0.3}


@pytest.mark.parametrize("name", ["issue_match", "issue_match_bodies"])
def test_issue_match(spark, name):
    """Best issues of documents of every language against the replay of the oracle."""
    from pressmill.operators import issues
    from tests import issue_oracle

    whole = name == "issue_match_bodies"
    docs, left = queries._issue_side(spark, DATA, "documents", "doc_id", 30, whole)
    items, right = queries._issue_side(spark, DATA, "benchmark", "item_id", 30, False)
    right = right.join(items.select("id", "kind", F.col("day").alias("start")), "id")
    rows = [[r.asDict() for r in x.collect()] for x in (left, right, issues.bodies(docs, "id", "title", F.col("text")), issues.bodies(items, "id", "title", F.col("text")))]
    if not whole:
        rows[0], rows[1] = ([{**r, "day": None, "start": None} for r in side] for side in rows[:2])
        rows[2], rows[3] = ([{**r, "chars": 0} for r in side] for side in rows[2:])
    want, _ = issue_oracle.replay(rows[0], rows[1], rows[2] + rows[3])
    got = {r["a"]: r for r in queries.QUERIES[name](spark, DATA).collect()}
    assert {a for a, w in want.items() if w[1] > 0.18} <= got.keys() <= want.keys() and any(w[4] for w in want.values())
    for a, (issue, top, second, accepted, gray) in want.items():
        if top > 0.18:
            r = got[a]
            assert (r["accepted"], r["gray"]) == (accepted, gray) and r["score"] == pytest.approx(top, abs=1e-4) and (r["issue"] == issue or second > top - 1e-9)
