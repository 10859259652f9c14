"""Second look at kept articles: page kinds, ordered title rules, first occurrences, the borderline rubric, policy scores, institution signals.

Rules are Tests (see predicates), printed as SQL of Spark and of DuckDB; the labels that a model would give come from a
provider, whose offline default is RAGU (borderline), which the rubric then decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import count_words
from pressmill.operators import screen
from pressmill.operators import values as v
from pressmill.operators.dedup import first_per_key
from pressmill.operators.predicates import DUCKDB, SPARK, Test, all_of, any_of, cascade, find, has, one_of, quote, sql, word
from pressmill.operators.title_rules import TITLE_RULES, TitleRule
from pressmill.operators.tone import OFFICIALS

# Fixed values.
EXPLICIT = v.EXPLICIT_KEMENPERIN_SIGNALS
IKMA = ("direktorat jenderal industri kecil, menengah, dan aneka", "ditjen ikma")
OFFICIAL_KEYWORDS = ("pejabat_kemenperin", "pejabat kemenperin", "kemenperin_pejabat")
GOVERNMENT = r"(?i)\b(?:kemenperin|menperin|wamenperin|ditjen\s+industri\s+agro|ditjen\s+ia|kementerian\s+perindustrian|apvi|gapki|gapmmi|gappri|apindo|kadin|himki|asindo|akbi|gabungan\s+pengusaha|asosiasi\s+industri|asosiasi\s+petani)\b"
DOMESTIC = r"(?i)\b(?:industri\s+dalam\s+negeri|pabrik\s+dalam\s+negeri|utilisasi\s+pabrik|kapasitas\s+produksi|investasi\s+pabrik|hilirisasi\s+industri|ekspansi\s+pabrik|pekerja\s+industri|phk\s+(pekerja|buruh|pabrik)|pabrik\s+rokok|pabrik\s+sawit|industri\s+hasil\s+tembakau|iht|industri\s+mamin|industri\s+agro)\b"
ACADEMIC = r"(?i)\b(?:akademisi|ekonom|pengamat|guru\s+besar|dosen|peneliti\s+universitas|pakar\s+ekonomi|pakar\s+kesehatan|umm|ugm|unair|undip|unpad)\b"
FOREIGN = r"(?i)\b(?:who|world\s+health\s+organization|fctc|uni\s+eropa|eudr|parlemen\s+eropa|konferensi\s+who|laporan\s+who|impor\s+as|malaysia|thailand|vietnam)\b"


def title_rule(rule: TitleRule, t: str = "_t") -> Test:
    tests = []
    if rule.any:
        held = [has(t, rule.any)] + ([has(t, rule.also)] if rule.also else []) + ([~has(t, rule.unless)] if rule.unless else [])
        tests.append(all_of(*held))
    if rule.exact:
        tests.append(one_of(t, rule.exact))
    if rule.pattern:
        tests.append(find(t, (rule.pattern,)))
    return any_of(*tests)


def title_reason(rules: Sequence[TitleRule], engine: str) -> str:
    """The reason of the first rule that holds, else null.

    In Spark the rules are one constant that a higher-order function walks: as many regular expressions would outgrow a generated method."""
    if engine == DUCKDB:
        return cascade([(r.reason, title_rule(r)) for r in rules], engine)
    array = lambda xs: f"array({', '.join(quote(x, engine) for x in xs)})" if xs else "cast(array() as array<string>)"
    table = ", ".join(f"struct({quote(r.reason, engine)} AS reason, {array(r.any)} AS has, {array(r.also)} AS also, {array(r.unless)} AS unless, {array(r.exact)} AS exact, {quote(r.pattern, engine)} AS pattern)" for r in rules)
    held = "exists(r.has, w -> contains(_t, w)) AND (size(r.also) = 0 OR exists(r.also, w -> contains(_t, w))) AND NOT exists(r.unless, w -> contains(_t, w))"
    return f"get(filter(array({table}), r -> {held} OR array_contains(r.exact, _t) OR (r.pattern <> '' AND rlike(_t, r.pattern))), 0).reason"


def first_reasons() -> list[tuple[str, Test]]:
    """Reasons of the first pass that come before the title rules, in order, over screen.FIELDS."""
    return [
        ("Dokumen PDF (Bukan Berita)", screen.pdf()),
        *screen.evergreen(),
        ("Domain Luar Negeri Non-Relevan (.vn / noise)", screen.foreign_host()),
        ("Aggregator Bot AI / Teks Rusak (feedberry.com)", has("_u", ("feedberry.com",))),
        ("Blog Opini UGC (Kompasiana)", has("_u", ("kompasiana.com",))),
        ("Rubrik Kuliner / Gaya Hidup Makanan (Bukan Manufaktur IA)", has("_u", ("/food/read/",)) & ~has("_x", ("kemenperin",))),
        ("Ranah Ditjen IKMA (Industri Kecil, Menengah, dan Aneka - Bukan Ditjen IA)", has("_x", IKMA) & ~has("_x", ("industri agro",))),
    ]


def first_pass(articles: DataFrame, pos: str, rules: Sequence[TitleRule] = TITLE_RULES) -> DataFrame:
    """articles (title, text, url, source, keyword) with recheck_reason: a reason of first_reasons, or a later occurrence of the same title among rows without one."""
    judged = screen.fields(articles).withColumn("recheck_reason", F.expr(f"coalesce({cascade(first_reasons(), SPARK)}, {title_reason(rules, SPARK)})")).drop(*screen.FIELDS)
    key = F.lower(F.trim(F.coalesce("title", F.lit(""))))
    first = first_per_key(judged.filter("recheck_reason is null").select(key.alias("_k"), F.col(pos).alias("_first")), ["_k"], F.col("_first"))
    joined = judged.join(first, key == F.col("_k"), "left")
    repeat = F.col("recheck_reason").isNull() & (F.col("_first") != F.col(pos))
    return joined.withColumn("recheck_reason", F.when(repeat, "judul_sama").otherwise(F.col("recheck_reason"))).drop("_k", "_first")


def first_pass_sql(articles: str, pos: str, rules: Sequence[TitleRule] = TITLE_RULES) -> str:
    inner = f"SELECT *, coalesce({cascade(first_reasons(), DUCKDB)}, {title_reason(rules, DUCKDB)}) AS why FROM (SELECT *, {', '.join(f'{e} AS {n}' for n, e in screen.FIELDS.items())} FROM {articles})"
    return f"SELECT {pos}, CASE WHEN why IS NULL AND row_number() OVER (PARTITION BY _t, why IS NULL ORDER BY {pos}) > 1 AND _t <> '' THEN 'judul_sama' ELSE why END AS recheck_reason FROM ({inner})"


def rubric_cases(title: str = "title", corpus: str = "corpus") -> list[tuple[str, Test]]:
    return [
        ("HILIR", find(corpus, (GOVERNMENT,)) | (find(corpus, (DOMESTIC,)) & ~find(title, (ACADEMIC,)))),
        ("BUKAN_HILIR", find(corpus, (ACADEMIC, FOREIGN))),
        ("RAGU", sql("true")),
    ]


def rubric(articles: DataFrame, label: str = "label") -> DataFrame:
    """articles (title, text) with rubric: RAGU by evidence is HILIR, BUKAN_HILIR, or still RAGU; other labels stay."""
    given = F.upper(F.trim(label))
    corpus = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.expr("left(coalesce(text, ''), 2500)"))
    found = F.expr(cascade(rubric_cases("_title", "_corpus"), SPARK))
    df = articles.withColumns({"_corpus": corpus, "_title": F.coalesce("title", F.lit(""))})
    return df.withColumn("rubric", F.when(given != "RAGU", given).otherwise(found)).drop("_corpus", "_title")


def policy_scores(text: Column, industry: tuple[str, ...] = v.INDUSTRY_POLICY_SIGNALS, health: tuple[str, ...] = v.HEALTH_PERSONAL_SIGNALS) -> tuple[Column, Column]:
    return count_words(text, industry), count_words(text, health)


def signal_cases(officials: dict[str, Sequence[str]]) -> list[tuple[object, Test]]:
    """(kind and detail as one text with a line break, test) in order, over screen.FIELDS."""
    aliases = [a for spellings in officials.values() for a in spellings]
    none = "NONE\n"
    ours = screen.agro_relevant() | screen.first_official_is(screen.AGRO_OFFICIALS, [*aliases, *screen.AGRO_OFFICIALS])
    asked = [("pejabat_presisi", has("_k", ("pejabat_presisi",))), ("pejabat_kemenperin", one_of("_k", OFFICIAL_KEYWORDS)), ("Direct Crawl", sql("_s = 'direct crawl'"))]
    special = [rule for detail, test in asked for rule in ((f"EKSPLISIT\n{detail}", test & ours), (none, test))]
    return [
        (none, has("_c", ("afghanistan", "imarah islam")) | screen.engagement()),
        *special,
        *((f"EKSPLISIT\n{s}", word("_c", (s,))) for s in EXPLICIT),
        *((f"IMPLISIT\n{name}", screen.first_official_is(spellings, aliases)) for name, spellings in officials.items()),
        (none, sql("true")),
    ]


def institution_signal(articles: DataFrame, officials: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """articles (title, text, url, source, keyword) with related, kind and detail: how the article concerns the institution."""
    signal = F.split(F.expr(cascade(signal_cases(officials or {n: (n,) for n in OFFICIALS}), SPARK)), "\n")
    found = screen.fields(articles).withColumn("_signal", signal)
    return found.withColumns({"related": F.col("_signal")[0] != "NONE", "kind": F.col("_signal")[0], "detail": F.col("_signal")[1]}).drop("_signal", *screen.FIELDS)


def institution_signal_sql(articles: str, keep: str, officials: dict[str, Sequence[str]]) -> str:
    signal = cascade(signal_cases(officials), DUCKDB)
    inner = f"SELECT *, string_split({signal}, chr(10)) AS s FROM (SELECT *, {', '.join(f'{e} AS {n}' for n, e in screen.FIELDS.items())} FROM {articles})"
    return f"SELECT {keep}, s[1] <> 'NONE' AS related, s[1] AS kind, s[2] AS detail FROM ({inner})"
