"""Issue registry: members, sampling, inheritance of tones, retention. State is a table, rewritten to a new version."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.functions.fuzzy import partial_reaches, ratio, ratio_udf, token_set_udf
from pressmill.functions.likeness import AT_ONCE, BLOCK, Block, lcs_pairs, passing
from pressmill.functions.text import strip_source_suffix
from pressmill.functions.url import host, is_decoded
from pressmill.operators.dedup import top_per_key

REEVALUATE_AFTER = 3


def upsert_members(members: DataFrame, new: DataFrame, issue: str, key: str) -> DataFrame:
    """Idempotent: members of (issue, key) already there stay as they are."""
    return members.unionByName(new.join(members.select(issue, key), [issue, key], "left_anti"))


def prune(registry: DataFrame, today: Column, days: int = 14) -> DataFrame:
    """Clusters go after the days without an article; releases stay."""
    return registry.filter((F.col("sumber_isu") == "rilis") | (F.datediff(today, F.col("tanggal_terakhir")) <= days))


def needs_tone(registry: DataFrame) -> Column:
    """Whether an issue's tone must be judged again: none yet, or enough new members since."""
    return F.col("tone").isNull() | (F.col("member_count") - F.coalesce("member_count_at_eval", F.lit(0)) >= REEVALUATE_AFTER)


def sample_titles(members: DataFrame, issue: str, title: str, order: Column, n: int = 12) -> DataFrame:
    return top_per_key(members, [issue], n, order, F.col(title)).groupBy(issue).agg(F.array_sort(F.collect_list(title)).alias("sample_titles"))


def stratified_sample(df: DataFrame, score: str, pos: str, quotas: dict[str, int]) -> DataFrame:
    """Rows by stratum of score (low < 0.45, high >= 0.65, mid between), at most the quota each, in order of pos."""
    stratum = F.when(F.col(score) < 0.45, "low").when(F.col(score) >= 0.65, "high").otherwise("mid")
    quota = F.create_map(*(F.lit(x) for kv in quotas.items() for x in kv))
    few = first_of_each(df.withColumn("stratum", stratum), "stratum", quotas, F.col(pos)).repartition(max(1, len(quotas)))  # so that tasks share the ranking
    first = ranked_first(few, ["stratum"], max(quotas.values(), default=0), F.col(pos))
    return first.filter(F.col("_n") <= F.coalesce(F.try_element_at(quota, F.col("stratum")), F.lit(0))).drop("_n")


def first_of_each(df: DataFrame, key: str, quotas: dict[str, int], *order: Column) -> DataFrame:
    """The first rows of each named key, as many as its quota: a pass over df for each key, in which a task holds about twice the quota and sorts nothing else."""
    parts = [df.filter(F.col(key) == k).orderBy(*order).limit(n) for k, n in quotas.items()]
    return reduce(DataFrame.unionAll, parts) if parts else df.limit(0)


def ranked_first(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each key with their rank _n. n is a number, so each task hands on at most n rows of a key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= n)


def review_sample(assigned: DataFrame, most: int = 60, first: int = 23, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows of assigned (id, pos, isu_id, sumber_isu, skor_isu) for a review, with their bucket, at most ``most``.

    Buckets in turn, each in order of pos and without ids taken before: 0 the numbered articles art_1 to art_<first>; then a quarter
    of the places (8 at least) each for 1 releases and, of clusters of two or more, 2 low (< 0.45), 3 mid, 4 high scores (>= 0.65);
    5 what is left of these clusters, but for eight places of single ones; 6 single clusters. Unused places pass on.
    ties: further columns that order rows of one pos."""
    quota = max(8, most // 4)
    order = [F.col(c) for c in ("pos", *ties)]
    sizes = assigned.groupBy(F.coalesce("isu_id", F.lit("")).alias("_isu")).agg(F.count("*").alias("_size"))
    score = F.coalesce("skor_isu", F.lit(0.0))
    group = F.when(F.col("sumber_isu") == "rilis", 1).when((F.col("sumber_isu") == "klaster") & (F.col("_size") >= 2), F.when(score < 0.45, 2).when(score >= 0.65, 4).otherwise(3)).when(F.col("sumber_isu") == "klaster", 6)
    number = F.try_to_number(F.regexp_extract("id", "^art_([0-9]{1,9})$", 1), F.lit("999999999"))
    rows = assigned.withColumn("_isu", F.coalesce("isu_id", F.lit(""))).join(sizes, "_isu").withColumns({"_group": group, "_early": F.coalesce(number <= first, F.lit(False))})
    singles = F.least(F.lit(8), F.count_if(F.col("_group") == 6))
    rest = most - rows.agg(singles.alias("n")).first()["n"]  # one number
    rows = top_per_key(rows, ["id"], 1, *order)
    early = top_per_key(rows.filter("_early"), ["_early"], first, *order).withColumn("bucket", F.lit(0))
    later = rows.join(early.select("id"), "id", "left_anti").filter(F.col("_group").isNotNull())
    ranked = ranked_first(later.filter("_group < 6"), ["_group"], quota + most, *order)  # a group gives no more than its share and all places
    shares = ranked.filter(F.col("_n") <= quota).drop("_n").withColumn("bucket", F.col("_group"))
    left = ranked.filter((F.col("_n") > quota) & (F.col("_group") > 1)).drop("_n").orderBy(*order).limit(rest).withColumn("bucket", F.lit(5))
    lone = later.filter("_group = 6").orderBy(*order).limit(most).withColumn("bucket", F.lit(6))
    chosen = early.unionByName(shares).unionByName(left).unionByName(lone)
    return chosen.orderBy("bucket", *order).limit(most).select(*assigned.columns, "bucket")


def diverse_members(members: DataFrame, issue: str, title: str, n: int = 8) -> DataFrame:
    """Farthest-first titles of each issue: from the first of the sorted distinct titles, always the one least like those taken."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = sorted({t.lower() for t in pdf[title] if t})
        taken = left[:1]
        while len(taken) < min(n, len(left)):
            taken.append(max((t for t in left if t not in taken), key=lambda t: min(100 - ratio(t, x) for x in taken)))
        return pd.DataFrame({issue: [pdf[issue].iloc[0]] * len(taken), "rank": range(1, len(taken) + 1), "title": taken})

    kind = dict(members.dtypes)[issue]
    return members.select(issue, title).distinct().groupBy(issue).applyInPandas(run, f"{issue} {kind}, rank long, title string")


#: Distinct titles of one part of the grid.
PART_TITLES = 20_000


def _best_officials(titles: list[str], held: list[tuple[int, str]], least: float) -> tuple[list[str], list[float], list[int]]:
    """Titles with their best token_set_ratio of ``least`` or more among the officials (id, title), of equal ones the smallest id."""
    held = sorted((i, sorted(set(t.split()))) for i, t in held)
    held, out = [(i, w) for i, w in held if w], ([], [], [])
    known = {w: k for k, w in enumerate(sorted({w for _, words in held for w in words}))}
    length = np.array([len(w) + 1 for w in known], np.float32)

    def side(sets: list[list[str]]) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
        there = np.zeros((len(sets), len(known)), np.float32)
        at = [(k, known[w]) for k, words in enumerate(sets) for w in words if w in known]
        if at:
            there[tuple(np.array(at).T)] = 1
        joined = [" ".join(words) for words in sets]
        # the words in any order have no other characters and pairs of neighbours
        return Block(joined, [f" {t} " for t in joined]), there, np.array([len(t) for t in joined], np.int64), np.array([len(words) for words in sets])

    if not held:
        return out
    officials, there, m, b_words = side([w for _, w in held])
    for start in range(0, len(titles), BLOCK):
        sets = [(t, sorted(set(t.split()))) for t in titles[start : start + BLOCK]]
        sets = [(t, w) for t, w in sets if w]
        if not sets:
            continue
        own, mine, n, a_words = side([w for _, w in sets])
        words, common = mine @ there.T, (mine * length) @ there.T - 1
        common = np.maximum(common, 0).astype(float)
        score = 200.0 * common / (common + np.minimum(n[:, None], m[None, :]))
        score[(words == a_words[:, None]) | (words == b_words[None, :])] = 100.0
        i, j = passing(own, officials, least, n, m)
        open_ = score[i, j] < 100
        i, j = i[open_], j[open_]
        for k in range(0, len(i), AT_ONCE):
            p, q = i[k : k + AT_ONCE], j[k : k + AT_ONCE]
            one, two = [], []
            for x, y in zip(p.tolist(), q.tolist(), strict=True):
                left, right = sets[x][1], held[y][1]
                both = set(left) & set(right)
                shared = [w for w in left if w in both]
                one.append(" ".join([*shared, *(w for w in left if w not in both)]))
                two.append(" ".join([*shared, *(w for w in right if w not in both)]))
            at = np.arange(len(p))
            score[p, q] = np.maximum(score[p, q], 200.0 * lcs_pairs(one, two, at, at) / (n[p] + m[q]))
        best = score.argmax(axis=1)  # the first: the smallest id
        for k in np.flatnonzero(score[np.arange(len(sets)), best] >= least):
            out[0].append(sets[k][0])
            out[1].append(float(score[k, best[k]]))
            out[2].append(held[best[k]][0])
    return out


def official_match(titles: DataFrame, official: DataFrame, least: float = 80.0, block: int = 500) -> DataFrame:
    """id, best, official_id: every distinct title against every official title. Parts of the titles and of at most about ``block``
    officials meet as a grid, a task each. Ties: the smallest id."""
    distinct = titles.select("title").distinct()
    parts, blocks = max(8, -(-distinct.count() // PART_TITLES)), max(1, -(-official.count() // block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = distinct.select("title", F.pmod(F.xxhash64("title"), F.lit(parts)).cast("int").alias("u")).withColumn("v", every(blocks))
    right = official.select("official_id", F.coalesce("official_title", F.lit("")).alias("official_title"), F.pmod(F.xxhash64("official_id"), F.lit(blocks)).cast("int").alias("v")).withColumn("u", every(parts))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        t, s, o = _best_officials(a["title"].tolist(), list(zip(b["official_id"].tolist(), b["official_title"].tolist(), strict=True)), least)
        return pd.DataFrame({"title": np.array(t, object), "s": np.array(s, float), "o": np.array(o, np.int64)})

    cells = 2 * parts * blocks
    of = lambda x: x.repartition(cells, "u", "v").groupBy("u", "v")
    found = of(left).cogroup(of(right)).applyInPandas(run, "title string, s double, o long")
    top = found.groupBy("title").agg(F.max("s").alias("best"), F.max_by("o", F.struct("s", -F.col("o"))).alias("official_id"))
    return titles.join(top, "title").select("id", "best", "official_id")


def search_matches(articles: DataFrame, results: DataFrame) -> DataFrame:
    """(id, url, score) of the best search result of each article, of equal ones the first by pos; articles without a match are left out.

    articles: id, title, media, source_url. results: id, pos, title, url. On a host of the article's own source a result needs
    72 by word sets or 68 as a whole; elsewhere 88 as a whole, or 92 by word sets where the article's title has 25 characters."""
    tidy = lambda title, media: F.lower(F.trim(strip_source_suffix(F.trim(F.coalesce(title, F.lit(""))), F.trim(F.coalesce(media, F.lit(""))))))
    own = host(F.coalesce("source_url", F.lit("")))
    a = articles.select("id", tidy(F.col("title"), F.col("media")).alias("_a"), "media", F.when(own.contains("news.google"), "").otherwise(own).alias("_own"))
    usable = results.filter(F.coalesce(is_decoded(F.col("url")), F.lit(False)))
    both = usable.select("id", "pos", "url", F.col("title").alias("_t")).join(a, "id").withColumn("_b", tidy(F.col("_t"), F.col("media"))).filter("_a <> '' AND _b <> ''")
    both = both.withColumns({"_full": ratio_udf("_a", "_b"), "_words": token_set_udf("_a", "_b"), "_host": host(F.col("url"))})
    within = lambda x, y: F.endswith(F.concat(F.lit("."), x), F.concat(F.lit("."), y))
    same = (F.col("_own") != "") & (within(F.col("_host"), F.col("_own")) | within(F.col("_own"), F.col("_host")))
    strict = (F.col("_full") >= 88) | ((F.col("_words") >= 92) & (F.length("_a") >= 25))
    score = F.when(same, F.when((F.col("_words") >= 72) | (F.col("_full") >= 68), F.col("_full") + 20)).when(strict, F.col("_full"))
    best = both.withColumn("score", score).filter("score IS NOT NULL").groupBy("id").agg(F.max_by(F.struct("url", "score"), F.struct("score", -F.col("pos"))).alias("m"))
    return best.select("id", "m.*")


def grounded(summaries: DataFrame, least: float = 85.0) -> DataFrame:
    """summaries with parties_kept (those named in title or text, by partial ratio), parties_dropped and needs_check (facts hold a number
    of two digits or more that is in neither). summaries: title, text, parties (array of names; blank ones go), facts."""

    @F.pandas_udf("array<string>")
    def named(parties: pd.Series, corpus: pd.Series) -> pd.Series:
        there = lambda name, text: name.lower() in text or partial_reaches(name.lower(), text, least)
        return pd.Series([[n for n in names if there(n, text)] for names, text in zip(parties, corpus, strict=True)])

    blank = F.array().cast("array<string>")
    names = F.filter(F.transform(F.coalesce("parties", blank), lambda n: F.trim(F.coalesce(n, F.lit("")))), lambda n: n != "")
    corpus = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))))
    numbers = F.regexp_extract_all(F.coalesce("facts", F.lit("")), F.lit(r"(?<![\p{L}\p{N}_])[0-9]{2,}(?![\p{L}\p{N}_])"), 0)
    known = summaries.withColumns({"_names": names, "_corpus": corpus})
    known = known.withColumns({"parties_kept": named("_names", "_corpus"), "needs_check": F.exists(numbers, lambda n: ~F.contains(F.col("_corpus"), n))})
    return known.withColumn("parties_dropped", F.size("_names") - F.size("parties_kept")).drop("_names", "_corpus")
