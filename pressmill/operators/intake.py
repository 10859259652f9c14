"""From landing rows of the sources to one table of articles: post-filters, unions, press lists, the retry queue, officials."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressmill.functions.text import merge_keywords, strip_source_suffix
from pressmill.functions.url import canonical, is_valid_domain
from pressmill.operators import screen
from pressmill.operators.dedup import dedup_by_key, first_per_key
from pressmill.operators.predicates import SPARK

# Fixed values.
RANGE_SEPARATORS = (":", "_sd_", "..", " to ", " - ")
OUT_OF_SCOPE = ("taufiek bawazier", "setia diarta", "reni yanita", "tri supondy")
SCOPE_NOTE = "di luar scope"
#: Names in the press: words that a name holds (one of each group), and the spellings that it then has.
SPELLINGS = (
    ((("eko",), ("s.a.", "cahyanto")), ("eko s.a. cahyanto", "eko sa cahyanto", "eko cahyanto")),
    ((("citra",), ("rapati",)), ("rr citra rapati", "rr. citra rapati", "citra rapati")),
    ((("m. rum", "m rum"),), ("m. rum", "m rum")),
    ((("putu",), ("juli",)), ("putu juli ardika", "putu juli")),
    ((("sarmuji",),), ("muhammad sarmuji", "menperin sarmuji", "menteri perindustrian sarmuji", "m. sarmuji", "m sarmuji", "sarmuji")),
    ((("agus",), ("gumiwang",)), ("agus gumiwang kartasasmita", "agus gumiwang", "menperin agus gumiwang", "menteri perindustrian agus gumiwang")),
    ((("faisol",), ("riza",)), ("faisol riza", "wamenperin", "wakil menteri perindustrian")),
)
LIST_CHARS = 1000


def date_range(target: str | None, today: datetime.date) -> tuple[datetime.date, datetime.date]:
    """First and last day of a run: 'day', or two days around a separator; yesterday by default."""
    if not (target or "").strip():
        day = today - datetime.timedelta(days=1)
        return day, day
    found = next((s for s in RANGE_SEPARATORS if s in target.strip()), None)
    ends = target.strip().split(found, 1) if found else [target] * 2
    first, last = (datetime.datetime.strptime(x.strip(), "%Y-%m-%d").date() for x in ends)
    return first, last


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all sources, with the columns of any; ``source_no`` is the place of the source."""
    numbered = [f.withColumn("source_no", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def search_hits(rows: DataFrame, pos: str) -> DataFrame:
    """Hits (title, link, media) that may be articles: valid hosts, titles without the media's name that pass the first look, the first of each link."""
    named = rows.withColumn("title", strip_source_suffix(F.col("title"), F.col("media"))).filter(is_valid_domain(F.col("link")))
    judged = named.withColumn("_t", F.expr(screen.FIELDS["_t"])).filter(F.expr(screen.likely_relevant().show(SPARK))).drop("_t")
    return first_per_key(judged, ["link"], F.col(pos))


def press_list(rows: DataFrame, first: Column, last: Column, pos: str) -> DataFrame:
    """Rows (url, day as dd/mm/yyyy, text) of a listing whose day is in the range, the first of each address; texts are cut as in listings."""
    day = F.try_to_timestamp(F.trim("day"), F.lit("dd/MM/yyyy")).cast("date")
    dated = rows.withColumn("day", day).filter(F.col("day").between(first, last) & (F.coalesce("url", F.lit("")) != ""))
    return first_per_key(dated.withColumn("text", F.substring("text", 1, LIST_CHARS)), ["url"], F.col(pos))


def union_by_url(rows: DataFrame, pos: str, fill: tuple[str, ...] = ("published", "media")) -> DataFrame:
    """One row (link, title, text, keyword, ...) for each canonical address, in order of pos: the longest text's row (the
    earliest on ties) with the keywords of all; its empty fields come from later copies. Rows without an address go."""
    keyed = rows.withColumn("link", canonical(F.col("link"))).filter(F.coalesce("link", F.lit("")) != "")
    best = dedup_by_key(keyed, F.col("link"), F.col("text"), F.col("keyword"), F.col(pos), keep_unkeyed=False)
    best = best.drop("keyword").withColumnRenamed("keywords", "keyword")
    kept = best.select("link", F.col(pos).alias("_at"))
    said = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    later = keyed.join(kept, "link").filter(F.col(pos) > F.col("_at"))
    first = later.groupBy("link").agg(*(F.min_by(c, F.when(said(c).isNotNull(), F.col(pos))).alias(f"_{c}") for c in fill))
    joined = best.join(first, "link", "left")
    return joined.withColumns({c: F.coalesce(said(c), F.col(f"_{c}")) for c in fill}).drop(*(f"_{c}" for c in fill))


def retry_queue(failures: DataFrame, done: DataFrame, link: str, keyword: str, pos: str) -> DataFrame:
    """Failed links that are not done yet: once each, with the keywords of all their failures."""
    left = failures.join(done.select(link).distinct(), link, "left_anti")
    words = F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(keyword).alias("k")))), lambda x: x["k"])
    return left.groupBy(link).agg(F.min(pos).alias(pos), merge_keywords(F.array_join(words, ",")).alias(keyword))


def distinct_titles(rows: DataFrame, *order: Column) -> DataFrame:
    """The first row of each clean lower title, over the files and sheets that were read."""
    keyed = rows.withColumn("_k", F.lower(F.regexp_replace(F.trim(F.coalesce("title", F.lit(""))), r"\s+", " "))).filter("_k <> ''")
    return first_per_key(keyed, ["_k"], *order).drop("_k")


def number_rows(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows of a small mart with ids from 1 in order (one task sorts them)."""
    return rows.withColumn("id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def officials_in_scope(rows: DataFrame, active_only: bool = True) -> DataFrame:
    """nama, jabatan, keywords and is_out_of_scope from the mapping's rows (nama_pejabat, jabatan, keyword_terkait)."""
    name, said = F.trim(F.coalesce("nama_pejabat", F.lit(""))), F.trim(F.coalesce("keyword_terkait", F.lit("")))
    outside = F.lower(name).isin(*OUT_OF_SCOPE) | F.contains(F.lower(said), F.lit(SCOPE_NOTE))
    words = F.filter(F.transform(F.split(said, ";"), lambda x: F.trim(x)), lambda x: (x != "") & ~F.contains(F.lower(x), F.lit(SCOPE_NOTE)))
    out = rows.select(name.alias("nama"), F.trim(F.coalesce("jabatan", F.lit(""))).alias("jabatan"), words.alias("keywords"), outside.alias("is_out_of_scope")).filter("nama <> ''")
    return out.filter("not is_out_of_scope") if active_only else out


def official_aliases(rows: DataFrame) -> DataFrame:
    """nama, unit_eselon and aliases, longest first: the lower name, its first two words if it has three, and the spellings of the press."""
    name = F.array_join(F.filter(F.split(F.trim(F.coalesce("nama", F.lit(""))), r"\s+"), lambda w: w != ""), " ")
    low = F.lower(name)
    own = F.split(low, " ")
    none = F.array().cast("array<string>")
    spelt = None
    for groups, spellings in SPELLINGS:
        exact = groups[0][0].startswith("m")
        holds = reduce(lambda a, b: a & b, (reduce(lambda a, b: a | b, ((low == w) if exact else F.contains(low, F.lit(w)) for w in g)) for g in groups))
        value = F.array(*map(F.lit, spellings))
        spelt = F.when(holds, value) if spelt is None else spelt.when(holds, value)
    every = F.array_distinct(F.concat(F.array(low), F.when(F.size(own) >= 3, F.array(F.concat_ws(" ", F.slice(own, 1, 2)))).otherwise(none), spelt.otherwise(none)))
    longest = F.transform(F.array_sort(F.transform(every, lambda a: F.struct(-F.length(a), a.alias("a")))), lambda x: x["a"])
    unit = F.trim(F.coalesce("unit_eselon", F.lit("-")))
    return rows.select(name.alias("nama"), unit.alias("unit_eselon"), longest.alias("aliases")).filter((F.col("nama") != "") & ~F.lower("nama").isin(*OUT_OF_SCOPE))


def single_word(keyword: Column) -> Column:
    """Whether the base keyword has one word; of an OR-query, its first alternative."""
    k = F.trim(F.coalesce(keyword, F.lit("")))
    first = F.trim(F.regexp_replace(F.substring_index(F.regexp_replace(k, r"^\(+", ""), " OR ", 1), "[\"']", ""))
    base = F.when(k.startswith("(") & F.contains(k, F.lit(" OR ")), first).otherwise(k)
    return (base != "") & ~F.rlike(base, F.lit(r"\s"))
