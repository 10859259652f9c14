"""Queries by name over the driver's tables, each with equivalent DuckDB SQL where SQL can express it.

Bindings: documents are articles (title: the first line's first 80 characters; media: source; keyword: lang),
pages give URLs, events give dated classes, orders and lineitem give runs and batches, benchmark gives releases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressmill.functions import dates, text, url
from pressmill.operators import assignment, cascade, dedup, entities, evaluation, issues, marts, merge, tone
from pressmill.sources import landing
from pressmill.streaming import snapshot

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_TITLE_SQL = "substr(split_part(coalesce(text, ''), chr(10), 1), 1, 80)"


def _title() -> Column:
    return F.substring(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1), 1, 80)


def _tone() -> Column:
    return F.when(F.col("event_type").isin("purchase", "signup"), "Positif").when(F.col("event_type") == "error", "Negatif").otherwise("Netral")


_TONE_SQL = "CASE WHEN event_type IN ('purchase','signup') THEN 'Positif' WHEN event_type = 'error' THEN 'Negatif' ELSE 'Netral' END"


# Scans, projections -------------------------------------------------------------------------------------------------


@query("canonical_url", r"""
WITH u AS (SELECT page_id, trim(url) AS u FROM pages),
h AS (SELECT *, regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS h,
  regexp_replace(regexp_extract(u, '^[^?#]*?://[^/?#]*(/[^?#]*)', 1), '/{2,}', '/', 'g') AS p0, regexp_extract(u, '\?([^#]*)', 1) AS q FROM u),
p AS (SELECT *, CASE WHEN length(p0) <= 1 OR regexp_replace(p0, '/+$', '') = '' THEN '/' ELSE regexp_replace(p0, '/+$', '') END AS p,
  list_sort(list_transform(list_filter(list_filter(string_split(q, '&'), lambda x: contains(x, '=')), lambda x: regexp_replace(x, '^[^=]*=', '') <> ''
    AND NOT regexp_matches(lower(split_part(x, '=', 1)), '^(utm_|gaa_|mtm_|pk_|hsa_)')
    AND split_part(x, '=', 1) NOT IN ('fbclid','gclid','dclid','yclid','msclkid','mc_cid','mc_eid','igshid','srsltid','ref','oc','hl','gl','ceid','_ga','_gl','spm','si','feature','guccounter','guce_referrer','guce_referrer_sig')),
    lambda x: {'k': split_part(x, '=', 1), 'v': regexp_replace(x, '^[^=]*=', '')})) AS kv FROM h)
SELECT page_id, CASE WHEN h = '' THEN lower(regexp_replace(split_part(u, '?', 1), '/+$', '')) ELSE 'https://' || h || p ||
  CASE WHEN len(kv) > 0 THEN '?' || array_to_string(list_transform(kv, lambda x: x.k || '=' || x.v), '&') ELSE '' END END AS canonical, h AS host FROM p
""")
def _(spark, d):
    return _t(spark, d, "pages").select("page_id", url.canonical(F.col("url")).alias("canonical"), url.host(url.unwrap_hyperlink(F.col("url"))).alias("host"))


@query("url_domain_filter", r"""
WITH h AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS h FROM pages)
SELECT page_id, CASE WHEN coalesce(url, '') = '' THEN false
  WHEN regexp_matches(regexp_replace(lower(url), '[?#].*$', ''), '(\.mp4|\.jpg|\.jpeg|\.png|\.mp3)$') OR regexp_matches(lower(url), '(/lowongan|/jobs/|/job/|/opportunities/jobs|/career|/karir|/loker)') OR regexp_matches(h, '\.(sch|desa)\.id$') THEN false
  WHEN regexp_matches(h, '(^|\.)go\.id$') THEN true
  ELSE NOT regexp_matches(h, '(^|\.)(shopee\.co\.id|tokopedia\.com|bukalapak\.com|lazada\.co\.id|blibli\.com|jd\.id|astronauts\.id|grab\.com|researchgate\.net|bible\.com|youtube\.com|instagram\.com|tiktok\.com|wikipedia\.org|x\.com|facebook\.com|twitter\.com|linkedin\.com|glints\.com|kitalulus\.com|bebee\.com|jobstreet\.co\.id|jobstreet\.com|kalibrr\.com|karir\.com|loker\.id|indeed\.com|jobsdb\.com|prosple\.com)$') END AS valid FROM h
""")
def _(spark, d):
    return _t(spark, d, "pages").select("page_id", url.is_valid_domain(F.col("url")).alias("valid"))


@query("link_key", "SELECT page_id, lower(regexp_replace(trim(coalesce(url, '')), '/+$', '')) AS link FROM pages")
def _(spark, d):
    return _t(spark, d, "pages").select("page_id", url.link_key(F.col("url")).alias("link"))


@query("decision_key", "SELECT page_id, sha256(concat_ws('|', url, 'tone', 'v1', 'rules')) AS k FROM pages")
def _(spark, d):
    return _t(spark, d, "pages").select("page_id", text.decision_key(F.col("url"), F.lit("tone"), F.lit("v1"), F.lit("rules")).alias("k"))


@query("page_text", r"""
SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?is)<nav[^>]*>.*?</nav>', ' ', 'g'), '(?is)<header[^>]*>.*?</header>', ' ', 'g'), '(?is)<footer[^>]*>.*?</footer>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'),
  '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS body FROM pages
""")
def _(spark, d):
    return _t(spark, d, "pages").select("page_id", landing.page_text(F.col("html")).alias("body"))


@query("title_suffix", f"""
WITH a AS (SELECT doc_id, source, {_TITLE_SQL} || ' - ' || source || ' - ' || upper(source) AS t FROM documents)
SELECT doc_id, regexp_replace(t, '(?i)( - ' || source || ')+\\s*$', '') AS without_source, trim(regexp_replace(t, '(?s)^(.*) - .*$', '\\1')) AS without_last FROM a
""")
def _(spark, d):
    t = F.concat(_title(), F.lit(" - "), F.col("source"), F.lit(" - "), F.upper("source"))
    return _t(spark, d, "documents").select("doc_id", text.strip_source_suffix(t, F.col("source")).alias("without_source"), text.strip_last_segment(t).alias("without_last"))


@query("keyword_count", r"""
SELECT doc_id, len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+'), lambda x: x IN ('the', 'idiot', 'der', 'license'))) AS n,
  regexp_matches(coalesce(text, ''), '(?i)(^|[^\p{L}\p{N}_])(apache|gpl)($|[^\p{L}\p{N}_])') AS licensed FROM documents
""")
def _(spark, d):
    body = F.coalesce("text", F.lit(""))
    return _t(spark, d, "documents").select("doc_id", text.count_words(body, ["the", "idiot", "der", "license"]).cast("long").alias("n"), text.has_word(body, ["apache", "gpl"]).alias("licensed"))


@query("commodity_case", "SELECT p_partkey, " + "CASE " + " ".join("WHEN " + " OR ".join(f"contains(k, '{p}')" for p in ps) + f" THEN '{n}'" for n, ps in text.COMMODITIES) + " ELSE 'Lainnya' END AS commodity FROM (SELECT p_partkey, lower(concat_ws(' ', coalesce(p_name, ''), coalesce(p_type, ''))) AS k FROM part)")
def _(spark, d):
    return _t(spark, d, "part").select("p_partkey", text.commodity(F.col("p_name"), F.col("p_type")).alias("commodity"))


@query("title_tokens", f"""
WITH n AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower({_TITLE_SQL}), '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g'), '\\s+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(w, lambda x: (length(x) >= 2 OR regexp_matches(x, '^[0-9]$')) AND NOT list_contains(['{"', '".join(text.STOPWORDS)}'], x)))), ' ') AS toks FROM n
""")
def _(spark, d):
    plain = F.regexp_replace(F.lower(_title()), r"[^\p{L}\p{N}_\s]+", " ")
    return _t(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(text.tokens(plain)), " ").alias("toks"))


@query("char_ngram_count", f"""
WITH t AS (SELECT doc_id, ' ' || {_TITLE_SQL} || ' ' AS p FROM documents)
SELECT doc_id, (greatest(length(p) - 2, 0) + greatest(length(p) - 3, 0))::BIGINT AS n, substr(p, 1, 3) AS first_gram FROM t
""")
def _(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.size(text.char_ngrams(_title())).cast("long").alias("n"), F.coalesce(F.get(text.char_ngrams(_title()), F.lit(0)), F.concat(F.lit(" "), _title(), F.lit(" "))).alias("first_gram"))


@query("date_display", """
SELECT event_id, list_extract(['Senin','Selasa','Rabu','Kamis','Jumat','Sabtu','Minggu'], isodow(ts)::INT) || ', ' || day(ts) || ' ' || list_extract(['Januari','Februari','Maret','April','Mei','Juni','Juli','Agustus','September','Oktober','November','Desember'], month(ts)::INT) || ' ' || year(ts) AS long_form,
  strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS wib, (greatest(1, (event_id % 5000)::INT) // 60) || 'm ' || lpad((greatest(1, (event_id % 5000)::INT) % 60)::VARCHAR, 2, '0') || 's' AS took FROM events
""")
def _(spark, d):
    gmt = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return _t(spark, d, "events").select("event_id", dates.long_display(F.to_date("ts")).alias("long_form"), F.date_format(dates.to_wib(gmt), "yyyy-MM-dd HH:mm:ss").alias("wib"), dates.duration(F.pmod("event_id", F.lit(5000))).alias("took"))


@query("search_expression", "SELECT p_partkey, CASE WHEN contains(p_name, ' ') THEN '(\"' || p_name || '\" OR ' || CASE WHEN contains(p_brand, ' ') OR contains(p_brand, '#') THEN CASE WHEN contains(p_brand, ' ') THEN '\"' || p_brand || '\"' ELSE p_brand END ELSE p_brand END || ')' ELSE '(' || p_name || ' OR ' || CASE WHEN contains(p_brand, ' ') THEN '\"' || p_brand || '\"' ELSE p_brand END || ')' END AS q FROM part")
def _(spark, d):
    return _t(spark, d, "part").select("p_partkey", text.or_query(F.concat_ws(",", "p_name", "p_brand")).alias("q"))


# Filters ------------------------------------------------------------------------------------------------------------

_CASCADE_SQL = f"""
WITH a AS (SELECT doc_id, lang, {_TITLE_SQL} AS title, coalesce(text, '') AS text FROM documents)
SELECT doc_id, lang, CASE WHEN length(trim(title)) < 5 THEN 'title_too_short' WHEN length(trim(text, ' ')) < 300 THEN 'too_short'
  WHEN contains(lower(text), 'licensed under the') OR contains(lower(text), 'all rights reserved') THEN 'licence_line'
  WHEN regexp_matches(title, '[#*$%&|]{{3}}') THEN 'symbol_noise'
  WHEN regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(idiot|scum|moron)($|[^\\p{{L}}\\p{{N}}_])') THEN 'insult'
  WHEN regexp_matches(title, '[A-Za-z0-9_] \\| [A-Za-z0-9_]') THEN 'table_row' END AS discard_reason FROM a
"""


def _judged(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", "lang", _title().alias("title"), F.coalesce("text", F.lit("")).alias("text"), F.lit("").alias("url"))
    return cascade.cascade(docs, cascade.NEUTRAL)


@query("filter_cascade", _CASCADE_SQL)
def _(spark, d):
    return _judged(spark, d).select("doc_id", "lang", "discard_reason")


@query("discard_histogram", f"SELECT discard_reason AS reason, count(*) AS n FROM ({_CASCADE_SQL}) WHERE discard_reason IS NOT NULL GROUP BY 1")
def _(spark, d):
    return cascade.histogram(_judged(spark, d))


#: Phrases that the test tables lack, one of which goes into each article's title and text.
_PHRASES = (
    "Harga TBS naik", "Disbun tetapkan harga", "Gajah liar masuk kebun", "Rokok ilegal disita", "Rokok ilegal dan kebijakan disita", "Kriya keramik", "Kriya kemenperin", "Bahlil jadi menko hilirisasi", "Video viral sapi",
    "Video viral harga", "Buku.pdf", "[PDF] data", "Lowongan kerja", "Pencurian kabel", "Pencurian pabrik ekspor impor", "Densus 88 bergerak", "Tewas di jalan", "Kebakaran toko", "Bea cukai tangkap", "Konser musik", "Resep kue",
    "Gula 3 gram dan 2 sdm bumbu", "Diskon besar", "Promo hadir di expo", "Voucher belanja", "BAB II", "Template surat ekspor", "Abstrak", "Library cafe baru", "Tiga buah kakao", "Toko disegel satpol pp", "Izin usaha pabrik",
    "Moratorium izin sawit", "Miras di karaoke", "Tulis di kolom komentar", "Sapi #shorts lucu", "Sapi #shorts resmikan", "#a #b #c", "Roblox baru", "Apa itu CPO", "Kisah merek lama", "Mengenal sapi turun", "Jasa limbah cair", "hubungi kami dan minta penawaran",
    "Kemenperin resmikan pabrik", "Menperin bicara", "Agus Gumiwang bicara", "Faisol Riza lalu Putu Juli Ardika", "Batik dan sawit", "Batik dan batik", "Kopi, kopi dan teh", "Industri agro tumbuh", "Margot Robbie minum kopi", "Imarah Islam impor gula",
    "Gizi, diet dan kalori", "PT Gula dan PG Tebu", "Diet industri", "Le Minerale brand awards", "Peran UMKM", "BCA Sekuritas", "BCA Sekuritas catat laba", "Penerbitan obligasi pulp", "Penerbitan sukuk produksi", "Analisis teknikal saham", "WA 0859 3970 0884",
    "Hubungi +62 812 3456 7890", "84+ Foto biskuit", "Stock photo biskuit", "Galang dana masjid", "Wujudkan masjid", "SMK Negeri 4", "SMK Negeri 4 luncurkan mobil", "Tigersnus", "Modal mendirikan pabrik", "Berita terbaru hari ini - kopi", "Untitled", "Peraturan Menteri Nomor 5",
    "Pengadilan agama", "Gaikindo auto week", "Harga cabai", "Duren Sawit", "Kelapa Gading", "Perahu karet", "Karet jam karet", "Kertas kerja", "Pabrik kertas", "Kakao Page", "Warna cokelat", "Pulp Fiction", "Teh Rina bernyanyi", "Gigi susu", "Aeropress kopi", "Hall of fame biodiesel",
    "Biodiesel fame", "Pomeranian limbah", "Limbah pome", "Keluhan petani sawit", "Nppbkc terbitkan", "Kawasan industri baru", "Kawasan industri halal", "Dbhcht sosialisasi", "Galangan kapal", "Gapki bicara", "Dosen UGM menilai", "Impor AS dan WHO", "Pabrik rokok", "Ditjen IKMA", "[musik] [musik]", "Kemenperin tidak korupsi korupsi", "Kemenperin dinilai gagal", "Zona integritas kemenperin bebas korupsi", "Menperin mengkritik importir ilegal", "Pengamat kritik kebijakan industri", "Apresiasi hilirisasi",
    "Turut hadir perwakilan kemenperin", "Tanpa menyinggung kemenperin", "Petani minta pemerintah bantu", "Menteri pertanian bicara", "Ekspor sawit turun", "Bangkrut dan gulung tikar", "Menperin akui gagal", "Tak lagi (korupsi) di kemenperin", "Protes kebijakan tkdn",
)
_KEYWORDS = ("pome", "fame", "gula", "kopi", "kertas", "kelapa", "karet", "kakao", "cokelat", "pulp", "tar", "teh", "susu", "sawit", "kopi, teh", "pejabat_presisi", "kemenperin", "")
_URLS = ("https://m.id/a/", "https://www.kompasiana.com/a/", "https://m.vn/a/", "https://a.id/glosarium/", "https://b.id/produk/", "https://c.id/loker/", "https://ojs.id/article/view/", "https://agro.kemenperin.go.id/", "https://feedberry.com/", "https://d.id/food/read/")
_SOURCES = ("Media", "youtube", "pdf", "Direct Crawl", "Media", "Media")


def _articles_sql(engine: str) -> str:
    """documents as articles of the monitored kind: title, text, url, source and keyword."""
    from pressmill.operators.predicates import DUCKDB, quote

    def pick(values, at: str) -> str:
        shown = ", ".join(quote(x, engine) for x in values)
        i = f"CAST(({at}) % {len(values)} + 1 AS INT)"
        return f"list_extract([{shown}], {i})" if engine == DUCKDB else f"element_at(array({shown}), {i})"

    title = _TITLE_SQL if engine == DUCKDB else "substring(substring_index(coalesce(text, ''), '\\n', 1), 1, 80)"
    some = f"CASE WHEN doc_id % 4 = 0 THEN '' ELSE {pick(_PHRASES, 'doc_id')} END"
    body = f"concat(coalesce(text, ''), ' ', {pick(_PHRASES, 'doc_id * 7 + 3')}, '. ', {pick(_PHRASES, 'doc_id * 13 + 5')}, ' ', {pick(_PHRASES, 'doc_id * 7 + 3')})"
    return f"(SELECT doc_id, concat({some}, CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat(' ', {title}) END) AS title, {body} AS text, CASE WHEN doc_id % 5 = 0 THEN concat({pick(_URLS, 'doc_id // 5' if engine == DUCKDB else 'doc_id div 5')}, doc_id) ELSE concat('https://m.id/a/', doc_id) END AS url, {pick(_SOURCES, 'doc_id // 3' if engine == DUCKDB else 'doc_id div 3')} AS source, {pick(_KEYWORDS, 'doc_id // 2' if engine == DUCKDB else 'doc_id div 2')} AS keyword FROM documents)"


def _articles(spark, d) -> DataFrame:
    from pressmill.operators.predicates import SPARK

    of = _articles_sql(SPARK).removeprefix("(SELECT ").removesuffix(" FROM documents)")
    return _t(spark, d, "documents").selectExpr(*_split_select(of))


def _split_select(select: str) -> list[str]:
    """The expressions of a SELECT list."""
    parts, depth, quoted, last = [], 0, False, 0
    for i, c in enumerate(select):
        if c == "'" and select[i - 1] != "\\":
            quoted = not quoted
        elif not quoted:
            depth += (c in "([") - (c in ")]")
            if c == "," and depth == 0:
                parts.append(select[last:i])
                last = i + 1
    return [*parts, select[last:]]


def _flags(name: str, tests: dict[str, str]) -> None:
    """Register a query of single tests of the screening over articles, by the names of its functions."""
    from pressmill.operators import screen
    from pressmill.operators.predicates import DUCKDB, SPARK

    made = {column: getattr(screen, function)() for column, function in tests.items()}
    sql = ", ".join(f"{t.show(DUCKDB)} AS {c}" for c, t in made.items())
    given = ", ".join(f"{e} AS {n}" for n, e in screen.FIELDS.items())

    @query(name, f"SELECT doc_id, {sql} FROM (SELECT doc_id, {given} FROM {_articles_sql(DUCKDB)})")
    def _(spark, d):
        return screen.fields(_articles(spark, d)).select("doc_id", *(F.expr(t.show(SPARK)).alias(c) for c, t in made.items()))


_flags("title_prefilter", {"likely": "likely_relevant"})
_flags("agro_relevance", {"relevant": "agro_relevant", "overridden": "override"})
_flags("crime_filters", {"crime": "crime_or_accident", "noise": "crime_noise"})
_flags("page_noise", {"structural": "structural_noise", "document": "document_noise", "recipe": "recipe", "promotional": "promotional", "job": "job_posting", "shorts": "shorts_noise"})
_flags("keyword_topic", {"topic": "keyword_is_topic", "health": "health_topic"})


def _screen_sql(keep: str) -> str:
    from pressmill.operators.predicates import DUCKDB
    from pressmill.operators.screen import screen_sql

    return screen_sql(_articles_sql(DUCKDB), keep)


@query("news_cascade", f"SELECT discard_reason AS reason, count(*) AS n FROM ({_screen_sql('doc_id')}) WHERE discard_reason IS NOT NULL GROUP BY 1")
def _(spark, d):
    from pressmill.operators.screen import screen

    return cascade.histogram(screen(_articles(spark, d)))


@query("date_filter", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def _(spark, d):
    return _t(spark, d, "events").filter(dates.in_range(F.col("ts"), "2024-01-10", "2024-01-11")).select("event_id", "event_type")


@query("length_filter", "SELECT doc_id, length(trim(coalesce(text, ''), ' ')) < 300 AND coalesce(text, '') <> '' AS suspiciously_short FROM documents")
def _(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.suspiciously_short(F.col("text")).alias("suspiciously_short"))


@query("primary_topic", r"""
SELECT doc_id, greatest(len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+'), lambda x: x = 'idiot')), len(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+'), lambda x: x = 'clown'))) >= 2
  OR regexp_matches(substr(split_part(coalesce(text, ''), chr(10), 1), 1, 80), '(?i)(^|[^\p{L}\p{N}_])(idiot|clown)($|[^\p{L}\p{N}_])') AS primary_topic FROM documents
""")
def _(spark, d):
    return _t(spark, d, "documents").select("doc_id", cascade.primary_topic(_title(), F.coalesce("text", F.lit("")), ("idiot", "clown")).alias("primary_topic"))


# Dedup, joins, set operations ----------------------------------------------------------------------------------------


@query("dedup_by_key", """
WITH k AS (SELECT doc_id, lang, md5(lower(trim(coalesce(text, ''), ' '))) AS k, length(coalesce(text, '')) AS n FROM documents),
b AS (SELECT k, arg_max(doc_id, struct_pack(n := n, p := -doc_id)) AS doc_id, count(*) AS n_members FROM k GROUP BY k),
f AS (SELECT k, lang, min(doc_id) AS p FROM k GROUP BY 1, 2)
SELECT b.doc_id, string_agg(f.lang, ', ' ORDER BY f.p) AS keywords, b.n_members FROM b JOIN f USING (k) GROUP BY b.doc_id, b.n_members
""")
def _(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", F.md5(F.lower(F.trim(F.coalesce("text", F.lit(""))))).alias("k"), F.coalesce("text", F.lit("")).alias("body"))
    return dedup.dedup_by_key(docs, F.col("k"), F.col("body"), F.col("lang"), F.col("doc_id")).select("doc_id", "keywords", "n_members")


def _runs(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source", _title().alias("title"))
    base = docs.filter(F.pmod("doc_id", F.lit(3)) != 1).withColumn("title", F.when(F.pmod("doc_id", F.lit(5)) == 0, "").otherwise(F.col("title")))
    other = docs.filter(F.pmod("doc_id", F.lit(3)) != 0).withColumn("lang", F.lit("xx"))
    return base, other


_RUNS_SQL = f"""
d AS (SELECT doc_id, lang, source, {_TITLE_SQL} AS title FROM documents),
b AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 5 = 0 THEN '' ELSE title END AS title FROM d WHERE doc_id % 3 <> 1),
o AS (SELECT doc_id, 'xx' AS lang, source, title FROM d WHERE doc_id % 3 <> 0)
"""


@query("merge_runs", f"""
WITH {_RUNS_SQL}
SELECT coalesce(b.doc_id, o.doc_id) AS doc_id, coalesce(nullif(b.title, ''), o.title) AS title, coalesce(nullif(b.source, ''), o.source) AS source,
  concat_ws(', ', b.lang, o.lang) AS lang, concat_ws(' + ', CASE WHEN b.doc_id IS NOT NULL THEN 'lokal' END, CASE WHEN o.doc_id IS NOT NULL THEN 'merge_from' END) AS sumber_run
FROM b FULL JOIN o ON b.doc_id = o.doc_id
""")
def _(spark, d):
    base, other = _runs(spark, d)
    return merge.merge_runs(base, other, "doc_id", ["title", "source"], "lang").select("doc_id", "title", "source", "lang", "sumber_run")


@query("archive_append", f"WITH {_RUNS_SQL} SELECT doc_id, lang FROM o UNION ALL SELECT doc_id, lang FROM b WHERE doc_id NOT IN (SELECT doc_id FROM o)")
def _(spark, d):
    base, other = _runs(spark, d)
    return merge.archive_append(other.select("doc_id", "lang"), base.select("doc_id", "lang"), "doc_id")


@query("archive_merge", f"WITH {_RUNS_SQL}, u AS (SELECT title, doc_id, 0 AS age FROM o UNION ALL SELECT title, doc_id, 1 FROM b) SELECT title, doc_id FROM u WHERE title <> '' QUALIFY row_number() OVER (PARTITION BY title ORDER BY age, doc_id) = 1 UNION ALL SELECT title, doc_id FROM u WHERE title = ''")
def _(spark, d):
    base, other = _runs(spark, d)
    return merge.archive_union(other.select("title", "doc_id"), base.select("title", "doc_id"), "title", F.col("doc_id"))


@query("semi_either", f"WITH {_RUNS_SQL} SELECT doc_id, title FROM b WHERE doc_id IN (SELECT doc_id FROM o WHERE doc_id % 2 = 0) OR title IN (SELECT title FROM o WHERE doc_id % 2 = 0)")
def _(spark, d):
    base, other = _runs(spark, d)
    return merge.semi_either(base.select("doc_id", "title"), other.filter(F.pmod("doc_id", F.lit(2)) == 0), "doc_id", "title").select("doc_id", "title")


@query("one_to_one", """
WITH l AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'error'),
r AS (SELECT event_id AS fix_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'click')
SELECT l.event_id, r.fix_id FROM l LEFT JOIN r ON l.user_id = r.user_id AND l.n = r.n
""")
def _(spark, d):
    e = _t(spark, d, "events")
    left = e.filter("event_type = 'error'").select("event_id", "user_id")
    right = e.filter("event_type = 'click'").select(F.col("event_id").alias("fix_id"), "user_id")
    return merge.one_to_one(left, right, "user_id", F.col("event_id"), F.col("fix_id")).select("event_id", "fix_id")


@query("latest_decision_per_stage", "SELECT user_id, event_type, arg_max(value, struct_pack(t := ts, i := event_id)) AS value FROM events GROUP BY 1, 2")
def _(spark, d):
    return merge.latest(_t(spark, d, "events"), ["user_id", "event_type"], "value", F.struct("ts", "event_id"))


@query("ttl_cache_lookup", "SELECT event_id, user_id FROM events WHERE epoch(ts) + CASE WHEN event_type = 'error' THEN 21600 ELSE 2592000 END > epoch(TIMESTAMP '2024-01-30 12:00:00')")
def _(spark, d):
    ttl = F.when(F.col("event_type") == "error", 21600).otherwise(2592000)
    return merge.fresh(_t(spark, d, "events"), F.col("ts"), ttl, F.to_timestamp(F.lit("2024-01-30 12:00:00"))).select("event_id", "user_id")


@query("recent_top_n", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 3")
def _(spark, d):
    return dedup.top_per_key(_t(spark, d, "events"), ["user_id"], 3, F.desc("ts"), F.col("event_id")).select("user_id", "event_id")


@query("first_occurrence", f"SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lower({_TITLE_SQL}) ORDER BY doc_id) = 1")
def _(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.lower(_title()).alias("t"))
    return dedup.first_per_key(docs, ["t"], F.col("doc_id")).select("doc_id")


@query("missing_dates", "SELECT d::DATE AS day FROM range(DATE '2024-01-01', DATE '2024-03-01', INTERVAL 1 DAY) r(d) WHERE d::DATE NOT IN (SELECT ts::DATE FROM events)")
def _(spark, d):
    return marts.missing_days(_t(spark, d, "events"), F.to_date("ts"), "2024-01-01", "2024-02-29")


@query("registry_window_match", """
WITH i AS (SELECT o_orderkey AS issue, CASE WHEN o_orderkey % 2 = 0 THEN 'rilis' ELSE 'klaster' END AS kind, o_orderdate::DATE AS d, o_custkey AS c FROM orders),
a AS (SELECT o_orderkey AS art, o_orderdate::DATE AS d, o_custkey AS c FROM orders)
SELECT a.art, i.issue FROM a JOIN i ON a.c = i.c WHERE CASE WHEN kind = 'rilis' THEN a.d - i.d BETWEEN -1 AND 7 ELSE abs(a.d - i.d) <= 14 END
""")
def _(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"), "o_custkey")
    i = o.select(F.col("o_orderkey").alias("issue"), F.when(F.pmod("o_orderkey", F.lit(2)) == 0, "rilis").otherwise("klaster").alias("kind"), F.col("d").alias("start"), "o_custkey")
    a = o.select(F.col("o_orderkey").alias("art"), F.col("d").alias("day"), "o_custkey")
    return a.join(i, "o_custkey").filter(issues.in_window(F.col("kind"), F.col("start"), F.col("day"))).select("art", "issue")


# Aggregations, marts -------------------------------------------------------------------------------------------------


@query("daily_summary", f"SELECT ts::DATE AS day, count(*) AS total, count(*) FILTER (WHERE t = 'Positif') AS positif, count(*) FILTER (WHERE t = 'Negatif') AS negatif, count(*) FILTER (WHERE t = 'Netral') AS netral FROM (SELECT ts, {_TONE_SQL} AS t FROM events) GROUP BY 1")
def _(spark, d):
    return marts.daily_summary(_t(spark, d, "events"), F.to_date("ts"), _tone())


@query("spokesperson_counts", "SELECT trim(x) AS name, count(*) AS n FROM (SELECT unnest(string_split(o_orderpriority || ',' || CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE o_orderstatus END, ',')) AS x FROM orders) WHERE trim(x) NOT IN ('', '-') GROUP BY 1")
def _(spark, d):
    names = F.concat_ws(",", "o_orderpriority", F.when(F.pmod("o_orderkey", F.lit(4)) == 0, "-").otherwise(F.col("o_orderstatus")))
    return marts.exploded_counts(_t(spark, d, "orders"), names)


@query("run_stats", "SELECT user_id, count(*) AS raw, count(*) FILTER (WHERE event_type <> 'error') AS final, round_even(100.0 * count(*) FILTER (WHERE event_type = 'error') / count(*), 0)::INT AS noise_pct FROM events GROUP BY 1")
def _(spark, d):
    per = _t(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("raw"), F.count_if(F.col("event_type") != "error").alias("final"))
    return per.withColumn("noise_pct", marts.noise_pct(F.col("raw"), F.col("final")))


@query("batch_report", "WITH b AS (SELECT l_linenumber AS batch, count(*) AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS failed, count(*) FILTER (WHERE l_linestatus = 'O') AS prefiltered FROM lineitem GROUP BY 1), s AS (SELECT 'all' AS slice, * FROM b UNION ALL SELECT 'late', * FROM b WHERE batch >= 4) SELECT slice, sum(total)::BIGINT AS total, sum(failed)::BIGINT AS failed, CASE WHEN sum(total) - sum(prefiltered) > 0 THEN round(sum(failed) * 100.0 / (sum(total) - sum(prefiltered)), 1) ELSE 0.0 END::DOUBLE AS fail_pct FROM s GROUP BY 1")
def _(spark, d):
    per = _t(spark, d, "lineitem").groupBy("l_linenumber").agg(F.count("*").alias("total"), F.count_if(F.col("l_returnflag") == "R").alias("failed"), F.lit(0).alias("rejected"), F.count_if(F.col("l_linestatus") == "O").alias("prefiltered"))
    return marts.batch_slices(per, F.col("l_linenumber") >= 4).select("slice", "total", "failed", "fail_pct")


@query("issue_group_tone", f"WITH p AS (SELECT user_id AS grp, {_TONE_SQL} AS tone, count(*) AS c FROM events GROUP BY 1, 2) SELECT grp, arg_max(tone, struct_pack(c := c, r := CASE tone WHEN 'Negatif' THEN 3 WHEN 'Positif' THEN 2 ELSE 1 END)) AS tone, sum(c)::BIGINT AS members, count(*) > 1 AS mixed FROM p GROUP BY 1")
def _(spark, d):
    return marts.group_tone(_t(spark, d, "events"), F.col("user_id"), _tone())


@query("news_search_page", "SELECT doc_id, source, lang FROM documents WHERE lang = 'en' AND (contains(lower(coalesce(text, '')), 'idiot') OR contains(lower(source), 'idiot')) ORDER BY n_chars DESC, doc_id LIMIT 24 OFFSET 24")
def _(spark, d):
    return marts.search_page(_t(spark, d, "documents"), "Idiot", {"lang": "en", "source": "Semua"}, ["text", "source"], [F.desc("n_chars"), F.col("doc_id")], 2).select("doc_id", "source", "lang")


@query("month_rollup", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(DISTINCT o_orderdate::DATE) AS days FROM orders GROUP BY 1")
def _(spark, d):
    return marts.month_rollup(_t(spark, d, "orders"), F.col("o_orderdate"))


@query("issue_cards", "SELECT coalesce(nullif(lang, ''), 'Tanpa isu') AS isu, count(*) AS items, count(DISTINCT lower(source)) AS media, min(doc_id) AS first_id FROM documents GROUP BY 1")
def _(spark, d):
    return marts.issue_cards(_t(spark, d, "documents"), F.col("lang"), F.col("source"), F.col("doc_id")).withColumnRenamed("first", "first_id")


@query("issue_majority_tone", f"WITH p AS (SELECT user_id AS isu, {_TONE_SQL} AS t, count(*) AS c FROM events GROUP BY 1, 2), m AS (SELECT isu, max(c) AS top, sum(c)::BIGINT AS members FROM p GROUP BY 1) SELECT m.isu, CASE WHEN count(*) = 1 THEN min(t) ELSE 'Netral' END AS issue_tone, members FROM m JOIN p ON p.isu = m.isu AND p.c = m.top GROUP BY m.isu, members")
def _(spark, d):
    return tone.issue_majority(_t(spark, d, "events").select(F.col("user_id").alias("isu"), _tone().alias("tone")), "isu")


@query("mixed_tone", f"SELECT user_id AS isu, count(*) AS members, string_agg(DISTINCT {_TONE_SQL}, ',' ORDER BY {_TONE_SQL}) AS tones FROM events GROUP BY 1 HAVING count(*) >= 2 AND count(DISTINCT {_TONE_SQL}) > 1")
def _(spark, d):
    return tone.mixed(_t(spark, d, "events").select(F.col("user_id").alias("isu"), _tone().alias("tone")), "isu")


@query("rolling_failure", "SELECT event_id, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 19 PRECEDING) AS rate FROM events")
def _(spark, d):
    return marts.rolling_rate(_t(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error").select("event_id", "rate")


_PRED_SQL = f"SELECT l.quality AS actual, CASE WHEN length(coalesce(text, '')) >= 300 AND NOT regexp_matches({_TITLE_SQL}, '[#*$%&|]') THEN 1 ELSE 0 END AS predicted FROM labels l JOIN documents USING (doc_id)"


def _predicted(spark, d) -> DataFrame:
    ok = (F.length(F.coalesce("text", F.lit(""))) >= 300) & ~_title().rlike(r"[#*$%&|]")
    docs = _t(spark, d, "documents").select("doc_id", F.when(ok, 1).otherwise(0).alias("predicted"))
    return _t(spark, d, "labels").join(docs, "doc_id").select(F.col("quality").alias("actual"), "predicted")


@query("confusion_matrix", f"SELECT actual, predicted, count(*) AS n FROM ({_PRED_SQL}) GROUP BY 1, 2")
def _(spark, d):
    return evaluation.confusion(_predicted(spark, d), "actual", "predicted")


@query("class_metrics", f"WITH p AS ({_PRED_SQL}), c AS (SELECT DISTINCT actual AS label FROM p UNION SELECT DISTINCT predicted FROM p), m AS (SELECT label, count(*) FILTER (WHERE actual = label) AS support, count(*) FILTER (WHERE predicted = label) AS said, count(*) FILTER (WHERE actual = label AND predicted = label) AS hit FROM c, p GROUP BY 1), r AS (SELECT label, support, CASE WHEN said > 0 THEN hit::DOUBLE / said ELSE 0 END AS precision, CASE WHEN support > 0 THEN hit::DOUBLE / support ELSE 0 END AS recall FROM m) SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM r")
def _(spark, d):
    return evaluation.class_metrics(_predicted(spark, d), "actual", "predicted")


@query("threshold_grid", "WITH g AS (SELECT * FROM (VALUES (0.4::DOUBLE), (0.48), (0.55), (0.6), (0.65)) s(min_score), (VALUES (0.0::DOUBLE), (0.06), (0.1)) m(min_margin)), e AS (SELECT l_discount * 10 AS s, l_tax AS m, l_returnflag = 'N' AS c FROM lineitem) SELECT min_score, min_margin, count(*) FILTER (WHERE s >= min_score AND m >= min_margin) AS accepted, count(*) FILTER (WHERE s >= min_score AND m >= min_margin)::DOUBLE / count(*) AS coverage, coalesce(count(*) FILTER (WHERE s >= min_score AND m >= min_margin AND c)::DOUBLE / nullif(count(*) FILTER (WHERE s >= min_score AND m >= min_margin), 0), 0) AS precision FROM g, e GROUP BY 1, 2")
def _(spark, d):
    rows = _t(spark, d, "lineitem").select((F.col("l_discount") * 10).alias("s"), F.col("l_tax").alias("m"), (F.col("l_returnflag") == "N").alias("c"))
    return evaluation.threshold_grid(rows, "s", "m", "c", [0.4, 0.48, 0.55, 0.6, 0.65], [0.0, 0.06, 0.1])


# Similarity, clustering, entities, tone --------------------------------------------------------------------------------


@query("idf_map", f"""
WITH t AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(regexp_replace(lower({_TITLE_SQL}), '[^\\p{{L}}\\p{{N}}_\\s]+', ' ', 'g'), '\\s+'), lambda x: length(x) >= 2))) AS token FROM documents)
SELECT token, count(*) AS df, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM t GROUP BY 1
""")
def _(spark, d):
    plain = F.regexp_replace(F.lower(_title()), r"[^\p{L}\p{N}_\s]+", " ")
    feats = _t(spark, d, "documents").select("doc_id", F.filter(F.split(plain, r"\s+"), lambda w: F.length(w) >= 2).alias("toks"))
    return issues.idf(feats)


@query("embedding_cosine", "WITH q AS (SELECT vec_id AS a, embedding AS ea FROM embeddings WHERE vec_id % 20 = 0) SELECT q.a, e.vec_id AS b, round(list_cosine_similarity(q.ea::DOUBLE[], e.embedding::DOUBLE[]), 6) AS cos FROM q, embeddings e WHERE e.vec_id <> q.a AND e.label = (SELECT label FROM embeddings x WHERE x.vec_id = q.a)")
def _(spark, d):
    e = _t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")
    return issues.cosines(e.filter(F.pmod("id", F.lit(20)) == 0), e, "label", 6, float("nan")).filter("a <> b")


@query("embedding_cosine_all", "WITH q AS (SELECT vec_id AS a, embedding AS ea FROM embeddings WHERE vec_id % 20 = 0) SELECT q.a, e.vec_id AS b, round(list_cosine_similarity(q.ea::DOUBLE[], e.embedding::DOUBLE[]), 6) AS cos FROM q, embeddings e WHERE e.vec_id <> q.a")
def _(spark, d):
    """The same ids against the rows of every label, as C7 compares all texts."""
    e = _t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    q = e.filter(F.pmod("id", F.lit(20)) == 0)
    return issues.cosines(q, e, digits=6, zero=float("nan")).filter("a <> b")


@query("near_dup_titles")
def _(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", _title().alias("title"))
    return dedup.near_title_pairs(docs, "title", "doc_id")


@query("near_dup_groups")
def _(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", _title().alias("title"))
    return dedup.near_title_groups(docs, "title", "doc_id")


@query("issue_clusters")
def _(spark, d):
    """All documents by title, body and day."""
    docs, feats = _issue_side(spark, d, "documents", "doc_id", 90, True)
    return assignment.cluster(feats, issues.bodies(docs, "id", "title", F.col("text"), F.col("day")))


@query("entity_first_two", r"""
WITH a AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents),
f AS (SELECT doc_id, x.name, instr(regexp_replace(t, '[^\p{L}\p{N}_]', ' ', 'g'), '') AS z, length(regexp_extract(t, '(?s)^(.*?[^\p{L}\p{N}_]|)(' || x.alias || ')($|[^\p{L}\p{N}_])', 1)) + 1 AS pos, regexp_matches(t, '(^|[^\p{L}\p{N}_])(' || x.alias || ')($|[^\p{L}\p{N}_])') AS hit
  FROM a, (VALUES ('A', 'idiot|moron'), ('B', 'clown'), ('C', 'worthless|trash')) x(name, alias)),
r AS (SELECT doc_id, name, row_number() OVER (PARTITION BY doc_id ORDER BY pos, name) AS n FROM f WHERE hit)
SELECT a.doc_id, coalesce(max(CASE WHEN n = 1 THEN name END), '-') AS spokesperson_1, coalesce(max(CASE WHEN n = 2 THEN name END), '-') AS spokesperson_2 FROM a LEFT JOIN r USING (doc_id) GROUP BY 1
""")
def _(spark, d):
    aliases = {"A": ("idiot", "moron"), "B": ("clown",), "C": ("worthless", "trash")}
    return entities.map_spokespersons(_t(spark, d, "documents"), F.col("text"), aliases, opening_last=True).select("doc_id", "spokesperson_1", "spokesperson_2")


def _tone_sql() -> str:
    from pressmill.operators.predicates import DUCKDB

    return tone.classify_sql(_articles_sql(DUCKDB), "doc_id", "title", "text", "keyword", "source")


@query("tone_fallback", _tone_sql())
def _(spark, d):
    return tone.classify(_articles(spark, d), "title", "text", "keyword", "source").select("doc_id", "hubungan", "arah", "tone", "keyakinan", "dasar", "asumsi")


# Streaming, extensions -------------------------------------------------------------------------------------------------


@query("stream_snapshot_union", "SELECT DISTINCT event_id FROM events")
def _(spark, d):
    e = _t(spark, d, "events")
    import uuid

    from pressmill.sources.scratch import shared_dir

    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(e.schema).format("parquet").option("pathGlobFilter", "events.parquet").load(d)
    return snapshot.run_available(snapshot.unite(stream.select("event_id", "ts"), "event_id", "ts"), f"{at}/out", f"{at}/state").select("event_id")


@query("tone_cube", f"SELECT t AS tone, user_id % 3 AS bucket, count(*) AS n FROM (SELECT {_TONE_SQL} AS t, user_id FROM events) GROUP BY CUBE (t, user_id % 3)")
def _(spark, d):
    return _t(spark, d, "events").select(_tone().alias("tone"), F.pmod("user_id", F.lit(3)).alias("bucket")).cube("tone", "bucket").agg(F.count("*").alias("n"))


@query("rolling_tone_share", f"WITH p AS (SELECT ts::DATE AS day, count(*) FILTER (WHERE {_TONE_SQL} = 'Negatif') AS neg, count(*) AS n FROM events GROUP BY 1) SELECT day, sum(neg) OVER w::DOUBLE / sum(n) OVER w AS share FROM p WINDOW w AS (ORDER BY day ROWS 6 PRECEDING)".replace("sum(neg) OVER w::DOUBLE", "(sum(neg) OVER w)::DOUBLE").replace("/ sum(n) OVER w", "/ (sum(n) OVER w)"))
def _(spark, d):
    per = _t(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count_if(_tone() == "Negatif").alias("neg"), F.count("*").alias("n"))
    w = Window.orderBy("day").rowsBetween(-6, 0)  # one row per day
    return per.select("day", (F.sum("neg").over(w) / F.sum("n").over(w)).alias("share"))


@query("session_windows", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events), k AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts, s DESC ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM k GROUP BY user_id, k")
def _(spark, d):
    return _t(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


@query("asof_release", "SELECT e.event_id, max(r.ts) AS release_ts FROM events e LEFT JOIN events r ON r.user_id = e.user_id AND r.event_type = 'signup' AND r.ts <= e.ts WHERE e.event_type = 'purchase' GROUP BY 1")
def _(spark, d):
    e = _t(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
    known = e.withColumn("release_ts", F.max(F.when(F.col("event_type") == "signup", F.col("ts"))).over(w))
    return known.filter("event_type = 'purchase'").select("event_id", "release_ts")


# Recheck, registry, releases -------------------------------------------------------------------------------------------


def _evergreen_sql() -> str:
    from pressmill.operators import screen
    from pressmill.operators.predicates import DUCKDB
    from pressmill.operators.predicates import cascade as printed

    given = ", ".join(f"{screen.FIELDS[n]} AS {n}" for n in ("_t", "_x", "_u"))
    return f"SELECT doc_id, {printed(screen.evergreen(), DUCKDB)} AS kind FROM (SELECT doc_id, {given} FROM {_articles_sql(DUCKDB)})"


@query("evergreen_pages", _evergreen_sql())
def _(spark, d):
    from pressmill.operators import screen
    from pressmill.operators.predicates import SPARK
    from pressmill.operators.predicates import cascade as printed

    return screen.fields(_articles(spark, d)).select("doc_id", F.expr(printed(screen.evergreen(), SPARK)).alias("kind"))


def _recheck_sql() -> str:
    from pressmill.operators.predicates import DUCKDB
    from pressmill.operators.recheck import first_pass_sql

    return first_pass_sql(_articles_sql(DUCKDB), "doc_id")


@query("recheck_first_pass", _recheck_sql())
def _(spark, d):
    from pressmill.operators import recheck

    return recheck.first_pass(_articles(spark, d), "doc_id").select("doc_id", "recheck_reason")


def _rubric_sql() -> str:
    from pressmill.operators.predicates import DUCKDB
    from pressmill.operators.predicates import cascade as printed
    from pressmill.operators.recheck import rubric_cases

    return f"SELECT doc_id, {printed(rubric_cases(), DUCKDB)} AS label FROM (SELECT doc_id, title, concat(title, ' ', left(text, 2500)) AS corpus FROM {_articles_sql(DUCKDB)})"


@query("ragu_rubric", _rubric_sql())
def _(spark, d):
    from pressmill.operators import recheck

    return recheck.rubric(_articles(spark, d).withColumn("label", F.lit(" ragu"))).select("doc_id", F.col("rubric").alias("label"))


@query("policy_scores", r"WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents) SELECT doc_id, len(list_filter(w, lambda x: x IN ('the', 'der')))::BIGINT AS industry, len(list_filter(w, lambda x: x IN ('idiot', 'scum')))::BIGINT AS health FROM t")
def _(spark, d):
    from pressmill.operators import recheck

    a, b = recheck.policy_scores(F.coalesce("text", F.lit("")), ("the", "der"), ("idiot", "scum"))
    return _t(spark, d, "documents").select("doc_id", a.cast("long").alias("industry"), b.cast("long").alias("health"))


#: Officials with their aliases.
_OFFICIALS = {"Agus Gumiwang": ("agus gumiwang", "agus gumiwang kartasasmita"), "Putu Juli Ardika": ("putu juli ardika", "putu juli"), "Faisol Riza": ("faisol riza",)}


def _signal_sql() -> str:
    from pressmill.operators.predicates import DUCKDB
    from pressmill.operators.recheck import institution_signal_sql

    return institution_signal_sql(_articles_sql(DUCKDB), "doc_id", _OFFICIALS)

@query("institution_signal", _signal_sql())
def _(spark, d):
    from pressmill.operators import recheck

    return recheck.institution_signal(_articles(spark, d), _OFFICIALS).select("doc_id", "related", "kind", "detail")


@query("needs_tone", "WITH i AS (SELECT o_custkey AS isu, count(*) AS member_count, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1996-01-01') AS at_eval, CASE WHEN min(o_orderstatus) = 'F' THEN 'Netral' END AS tone FROM orders GROUP BY 1) SELECT isu, tone IS NULL OR member_count - at_eval >= 3 AS judge FROM i")
def _(spark, d):
    from pressmill.operators import registry

    i = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("isu")).agg(F.count("*").alias("member_count"), F.count_if(F.col("o_orderdate") < "1996-01-01").alias("member_count_at_eval"), F.when(F.min("o_orderstatus") == "F", "Netral").alias("tone"))
    return i.select("isu", registry.needs_tone(i).alias("judge"))


@query("registry_prune", "WITH i AS (SELECT o_custkey AS isu, CASE WHEN o_custkey % 5 = 0 THEN 'rilis' ELSE 'klaster' END AS sumber_isu, max(o_orderdate)::DATE AS tanggal_terakhir FROM orders GROUP BY 1, 2) SELECT isu, sumber_isu FROM i WHERE sumber_isu = 'rilis' OR DATE '1998-07-01' - tanggal_terakhir <= 14")
def _(spark, d):
    from pressmill.operators import registry

    kind = F.when(F.pmod("o_custkey", F.lit(5)) == 0, "rilis").otherwise("klaster")
    i = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("isu"), kind.alias("sumber_isu")).agg(F.to_date(F.max("o_orderdate")).alias("tanggal_terakhir"))
    return registry.prune(i, F.lit("1998-07-01").cast("date")).select("isu", "sumber_isu")


@query("upsert_members", "SELECT user_id AS isu, event_id AS k, 'old' AS run FROM events WHERE event_id % 3 = 0 UNION ALL SELECT user_id, event_id, 'new' FROM events WHERE event_id % 2 = 0 AND event_id % 3 <> 0")
def _(spark, d):
    from pressmill.operators import registry

    e = _t(spark, d, "events").select(F.col("user_id").alias("isu"), F.col("event_id").alias("k"))
    return registry.upsert_members(e.filter("k % 3 = 0").withColumn("run", F.lit("old")), e.filter("k % 2 = 0").withColumn("run", F.lit("new")), "isu", "k")


@query("sample_titles", "WITH r AS (SELECT c_nationkey AS isu, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name) AS n FROM customer) SELECT isu, string_agg(c_name, '|' ORDER BY c_name) AS titles FROM r WHERE n <= 12 GROUP BY 1")
def _(spark, d):
    from pressmill.operators import registry

    c = _t(spark, d, "customer").select(F.col("c_nationkey").alias("isu"), "c_name", "c_acctbal")
    return registry.sample_titles(c, "isu", "c_name", F.desc("c_acctbal")).select("isu", F.array_join("sample_titles", "|").alias("titles"))


@query("stratified_sample", "WITH s AS (SELECT l_orderkey * 10 + l_linenumber AS pos, l_discount * 10 AS skor FROM lineitem), t AS (SELECT *, CASE WHEN skor < 0.45 THEN 'low' WHEN skor >= 0.65 THEN 'high' ELSE 'mid' END AS stratum FROM s), n AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY pos) AS n FROM t) SELECT pos, stratum FROM n WHERE n <= CASE stratum WHEN 'low' THEN 20 WHEN 'mid' THEN 15 ELSE 25 END")
def _(spark, d):
    from pressmill.operators import registry

    s = _t(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), (F.col("l_discount") * 10).alias("skor"))
    return registry.stratified_sample(s, "skor", "pos", {"low": 20, "mid": 15, "high": 25}).select("pos", "stratum")


@query("review_sample", """
WITH a AS (SELECT 'art_' || ((l_orderkey * 10 + l_linenumber) // 11) AS id, l_orderkey * 10 + l_linenumber AS pos, l_orderkey % 3001 || l_linestatus AS isu_id, CASE WHEN l_returnflag = 'R' THEN 'rilis' ELSE 'klaster' END AS sumber_isu, (l_discount * 10)::DOUBLE AS skor_isu FROM lineitem),
c AS (SELECT *, count(*) OVER (PARTITION BY isu_id) AS size FROM a),
g AS (SELECT *, CASE WHEN sumber_isu = 'rilis' THEN 1 WHEN size < 2 THEN 6 WHEN skor_isu < 0.45 THEN 2 WHEN skor_isu >= 0.65 THEN 4 ELSE 3 END AS grp, substr(id, 5)::BIGINT <= 23 AS early FROM c),
k AS (SELECT 60 - least(8, count(*)) AS room FROM g WHERE grp = 6),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) AS nth FROM g) WHERE nth = 1),
e AS (SELECT id, pos, 0 AS bucket FROM u WHERE early ORDER BY pos LIMIT 23),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY pos) AS n FROM u WHERE id NOT IN (SELECT id FROM e)),
x AS (SELECT id, pos, grp AS bucket FROM r WHERE grp < 6 AND n <= 15),
m AS (SELECT id, pos, 5 AS bucket FROM (SELECT *, row_number() OVER (ORDER BY pos) AS i FROM r WHERE grp BETWEEN 2 AND 4 AND n > 15) WHERE i <= (SELECT room FROM k)),
s AS (SELECT id, pos, 6 AS bucket FROM r WHERE grp = 6 AND n <= 60)
SELECT id, pos, bucket FROM (SELECT * FROM e UNION ALL SELECT * FROM x UNION ALL SELECT * FROM m UNION ALL SELECT * FROM s) ORDER BY bucket, pos LIMIT 60
""")
def _(spark, d):
    from pressmill.operators import registry

    pos = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))  # rows of one pos in the order of the files, as DuckDB reads them
    a = _t(spark, d, "lineitem").select(F.concat(F.lit("art_"), F.floor(pos / 11).cast("string")).alias("id"), pos.alias("pos"), place.alias("place"), F.concat(F.pmod("l_orderkey", F.lit(3001)).cast("string"), "l_linestatus").alias("isu_id"), F.when(F.col("l_returnflag") == "R", "rilis").otherwise("klaster").alias("sumber_isu"), (F.col("l_discount") * 10).cast("double").alias("skor_isu"))
    return registry.review_sample(a, ties=("place",)).select("id", "pos", "bucket")


@query("grounded_parties", r"""
WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t, string_split(coalesce(text, ''), ' ')[1] AS w, 'sejak 19' || doc_id % 100 || ' naik 12 persen dan 7 ton' AS facts FROM documents),
p AS (SELECT *, list_filter([trim(w), '¤¤¤¤'], lambda x: x <> '') AS names FROM d)
SELECT doc_id, array_to_string(list_filter(names, lambda x: contains(t, lower(x))), '|') AS kept, (len(names) - len(list_filter(names, lambda x: contains(t, lower(x)))))::INT AS dropped,
  len(list_filter(regexp_extract_all(facts, '\b[0-9]{2,}\b'), lambda x: NOT contains(t, x))) > 0 AS needs_check FROM p
""")
def _(spark, d):
    """Named parties: the first word of the text and one that no text holds."""
    from pressmill.operators import registry

    t = F.coalesce("text", F.lit(""))
    facts = F.concat(F.lit("sejak 19"), F.pmod("doc_id", F.lit(100)).cast("string"), F.lit(" naik 12 persen dan 7 ton"))
    given = _t(spark, d, "documents").select("doc_id", F.lit("").alias("title"), "text", F.array(F.substring_index(t, " ", 1), F.lit("¤¤¤¤")).alias("parties"), facts.alias("facts"))
    return registry.grounded(given).select("doc_id", F.array_join("parties_kept", "|").alias("kept"), F.col("parties_dropped").alias("dropped"), "needs_check")


@query("diverse_members")
def _(spark, d):
    from pressmill.operators import registry

    return registry.diverse_members(_t(spark, d, "part").select(F.col("p_brand").alias("isu"), F.col("p_name").alias("title")), "isu", "title")


@query("official_match")
def _(spark, d):
    from pressmill.operators import registry

    titles = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), _title().alias("title")).filter("title <> ''")
    official = _t(spark, d, "benchmark").select(F.col("item_id").alias("official_id"), F.substring("text", 1, 80).alias("official_title"))
    return registry.official_match(titles, official)


def _issue_side(spark, d, table: str, id_: str, days: int, lead: bool) -> tuple[DataFrame, DataFrame]:
    """A table as articles or issues (id, title, text, day; an id divisible by 23 has no day), and its features."""
    day = F.when(F.pmod(id_, F.lit(23)) != 0, F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(id_, F.lit(days)).cast("int")))
    docs = _t(spark, d, table).select(F.concat(F.lit(table[0]), F.col(id_).cast("string")).alias("id"), _title().alias("title"), "text", day.alias("day"), F.when(F.pmod(id_, F.lit(3)) == 0, "rilis").otherwise("klaster").alias("kind"))
    return docs, issues.features(docs, "id", "title", F.col("day"), F.col("text") if lead else F.lit(""))


@query("issue_match")
def _(spark, d):
    """Titles alone: no days, no bodies."""
    docs, left = _issue_side(spark, d, "documents", "doc_id", 30, False)
    items, right = _issue_side(spark, d, "benchmark", "item_id", 30, False)
    undated = F.lit(None).cast("date")
    right = right.withColumn("day", undated).join(items.select("id", "kind"), "id").withColumn("start", undated)
    own, other = (issues.bodies(x.limit(0), "id", "title", F.col("text")) for x in (docs, items))
    return assignment.assign(left.withColumn("day", undated), right, own, other)


@query("issue_match_bodies")
def _(spark, d):
    """Titles, leads, bodies and days: articles in order, each within the window of its issue's last day."""
    docs, left = _issue_side(spark, d, "documents", "doc_id", 30, True)
    items, right = _issue_side(spark, d, "benchmark", "item_id", 30, False)
    right = right.join(items.select("id", "kind", F.col("day").alias("start")), "id")
    own, other = (issues.bodies(x, "id", "title", F.col("text")) for x in (docs, items))
    return assignment.assign(left, right, own, other)


@query("body_entity_counts", r"""
WITH k AS (SELECT doc_id, left(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), 1200) || ' GAPKI dan WIB, Kota Medan, riau.' AS b FROM documents)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(b, '[\p{L}\p{N}_]+'), lambda w: regexp_matches(w, '^[A-Z]{2,10}$') AND w <> 'WIB' AND NOT list_contains(['""" + "','".join(text.BOILERPLATE) + r"""'], w)))), ',') AS acronyms,
  array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(b), '[a-z]+'), lambda w: list_contains(['""" + "','".join(text.PLACES) + r"""'], w)))), ',') AS places FROM k
""")
def _(spark, d):
    plain = F.left(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")), F.lit(text.SNIPPET_CHARS))
    e = text.body_entities(F.concat(plain, F.lit(" GAPKI dan WIB, Kota Medan, riau.")))
    rows = _t(spark, d, "documents").select("doc_id", e.alias("e"))
    return rows.select("doc_id", F.array_join(F.array_sort("e.acronyms"), ",").alias("acronyms"), F.array_join(F.array_sort("e.places"), ",").alias("places"))


@query("inside_margin", "SELECT l_orderkey, greatest(0.0, coalesce(max(l_discount) FILTER (WHERE l_returnflag = 'R'), 0.0) - coalesce(max(l_discount) FILTER (WHERE l_returnflag <> 'R'), 0.0))::DOUBLE AS margin FROM lineitem GROUP BY 1")
def _(spark, d):
    e = _t(spark, d, "lineitem").select("l_orderkey", F.lit("R").alias("own"), F.col("l_returnflag").alias("other"), F.col("l_discount").cast("double").alias("s"))
    return issues.inside_margin(e, "l_orderkey", "own", "other", "s")


@query("release_coverage", "SELECT r.o_orderkey AS rilis, count(l.l_orderkey) AS member_count, CASE WHEN count(l.l_orderkey) = 0 THEN 'belum tercatat' ELSE 'tercatat' END AS status FROM orders r LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') l ON l.l_orderkey = r.o_orderkey GROUP BY 1")
def _(spark, d):
    r = _t(spark, d, "orders").select(F.col("o_orderkey").alias("rilis"))
    m = _t(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("rilis")).agg(F.count("*").alias("c"))
    n = F.coalesce("c", F.lit(0)).cast("long")
    return r.join(m, "rilis", "left").select("rilis", n.alias("member_count"), F.when(n == 0, "belum tercatat").otherwise("tercatat").alias("status"))


def _context_sql() -> str:
    from pressmill.operators import context, screen
    from pressmill.operators.predicates import DUCKDB
    from pressmill.operators.predicates import cascade as printed

    given = ", ".join(f"{e} AS {n}" for n, e in screen.FIELDS.items())
    return f"SELECT doc_id, keyword, {printed(context.mills() + context.contexts(), DUCKDB)} AS reason FROM (SELECT doc_id, keyword, {given} FROM {_articles_sql(DUCKDB)})"


@query("keyword_context", _context_sql())
def _(spark, d):
    from pressmill.operators import context

    return context.keyword_contexts(_articles(spark, d)).select("doc_id", "keyword", F.col("context_reason").alias("reason"))


def _tobacco_sql() -> str:
    from pressmill.operators.predicates import DUCKDB

    return f"""
WITH a AS (SELECT doc_id, lower(title) AS t, lower(concat(title, ' ', text)) AS b, CASE doc_id % 3 WHEN 0 THEN 'gula, rokok' WHEN 1 THEN 'Rokok elektrik, kopi, rokok tanpa pita cukai' ELSE 'gula' END AS kw FROM {_articles_sql(DUCKDB)}),
c AS (SELECT *, regexp_matches(t, 'vapor|rokok sintetis|electric|elektrik.*rokok|rokok.*elektrik') OR regexp_matches(b, 'rokok elektri|rokok elektronik|vape|bnn.*narkotika|narkotika.*bnn') OR doc_id % 3 = 1 AS e,
  regexp_matches(b, 'pita cukai|cukai rokok') OR doc_id % 3 = 1 AS x, regexp_matches(t, 'djbc|bea cukai|gempur rokok') OR contains(b, 'rokok ilegal') OR (regexp_matches(b, 'bea cukai|djbc') AND contains(b, 'rokok')) AS i FROM a),
l AS (SELECT *, list_filter([CASE WHEN e THEN 'bnn rokok elektrik' END, CASE WHEN x THEN 'rokok tanpa pita cukai' END, CASE WHEN i THEN 'djbc rokok ilegal' END], lambda y: y IS NOT NULL) AS s FROM c)
SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN kw ELSE CASE WHEN doc_id % 3 = 0 THEN 'gula, ' ELSE 'kopi, ' END || array_to_string(CASE WHEN len(s) > 0 THEN s WHEN regexp_matches(b, 'cukai|tarif') THEN ['rokok tanpa pita cukai'] WHEN contains(b, 'elektrik') THEN ['bnn rokok elektrik'] ELSE ['djbc rokok ilegal'] END, ', ') END AS keywords FROM l
"""


@query("tobacco_keywords", _tobacco_sql())
def _(spark, d):
    from pressmill.operators import context

    k = F.pmod("doc_id", F.lit(3))
    kw = F.when(k == 0, "gula, rokok").when(k == 1, "Rokok elektrik, kopi, rokok tanpa pita cukai").otherwise("gula")
    return _articles(spark, d).select("doc_id", context.tobacco_keywords(kw, F.col("title"), F.col("text")).alias("keywords"))


@query("negative_groups")
def _(spark, d):
    """Greedy groups against each group's first member only, inside components of near titles."""
    docs = _t(spark, d, "documents").select("doc_id", _title().alias("title"))
    placed = dedup.label_components(docs, dedup.near_title_links(docs, "title", "doc_id"), "doc_id")
    return dedup.replay_groups(placed, "component", "title", "doc_id", 85.0, heads=True).select("doc_id", "group_pos", "group_title")


# Model replies, link resolution, publishing ----------------------------------------------------------------------------


@query("batch_verdicts", r"""
WITH o AS (SELECT o_custkey AS batch, o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'Produk UMKM naik' ELSE o_orderpriority END AS title, o_orderkey % 3 AS part, o_orderstatus FROM orders),
v AS (SELECT *, CASE WHEN o_custkey_even THEN 2 ELSE part END AS seen FROM (SELECT *, batch % 10 = 9 AS o_custkey_even FROM o))
SELECT batch, id, title,
  CASE WHEN id % 7 = 0 OR seen = 1 THEN 'buang' WHEN seen = 0 AND o_orderstatus = 'F' THEN 'relevan' ELSE 'review' END AS status,
  CASE WHEN id % 7 = 0 OR seen = 1 THEN '-' WHEN seen = 0 AND o_orderstatus = 'F' THEN 'Gula' ELSE 'Industri Umum' END AS sub_sektor,
  CASE WHEN id % 7 = 0 THEN 'UMKM' WHEN seen = 1 THEN 'Bukan Sektor Industri Agro' WHEN seen = 0 THEN 'alasan ' || id ELSE '' END AS alasan
FROM v
""")
def _(spark, d):
    """Replies hold two thirds of what was sent, inside fences; those of every tenth batch are broken JSON."""
    from pressmill.operators import verdicts

    orders = _t(spark, d, "orders").withColumnsRenamed({"o_custkey": "batch", "o_orderkey": "id"})
    sent = orders.select("batch", "id", F.when(F.col("id") % 7 == 0, "Produk UMKM naik").otherwise(F.col("o_orderpriority")).alias("title"))
    status = F.when(F.col("o_orderstatus") == "F", "Relevan ").when(F.col("o_orderstatus") == "O", "review").otherwise("lain")
    kept = F.struct("id", status.alias("status"), F.when(F.col("o_orderstatus") == "F", "Gula").otherwise("").alias("sub_sektor"), F.concat(F.lit("alasan "), F.col("id").cast("string")).alias("alasan"))
    both = orders.groupBy("batch").agg(F.collect_list(F.when(F.col("id") % 3 == 0, kept)).alias("hasil"), F.collect_list(F.when(F.col("id") % 3 == 1, F.struct("id"))).alias("dibuang"))
    reply = F.concat(F.lit("Berikut:\n```json\n"), F.to_json(F.struct("hasil", "dibuang")), F.lit("\n```"))
    return verdicts.batch_verdicts(sent, both.select("batch", F.when(F.col("batch") % 10 == 9, F.lit("{ maaf")).otherwise(reply).alias("reply")), "batch")


@query("reply_salvage", "SELECT s_suppkey, s_suppkey::VARCHAR AS id, 'Netral' AS tone, s_name || ' \"a\"' AS isu FROM supplier UNION ALL SELECT s_suppkey, s_nationkey::VARCHAR, NULL, 'x' FROM supplier")
def _(spark, d):
    from pressmill.operators import verdicts

    reply = F.concat(F.lit('```json\n{"hasil": [{"id": '), F.col("s_suppkey"), F.lit(', "tone": "Netral", "isu": "'), F.col("s_name"), F.lit(r' \"a\""}, {"isu": "x", "tone": null, "id": '), F.col("s_nationkey"), F.lit("}, {"))
    return _t(spark, d, "supplier").select("s_suppkey", F.inline(verdicts.salvage(reply, ("id", "tone", "isu"))))


@query("reply_labels", "SELECT event_id, CASE event_type WHEN 'click' THEN 'K1' WHEN 'view' THEN 'K4' ELSE 'K3' END AS hubungan, CASE event_type WHEN 'click' THEN 'menyerang' WHEN 'view' THEN 'mendukung' ELSE 'tidak ada' END AS arah, CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'tinggi' ELSE 'sedang' END AS keyakinan FROM events")
def _(spark, d):
    from pressmill.operators import verdicts

    said = lambda a, b: F.when(F.col("event_type") == "click", a).when(F.col("event_type") == "view", b)
    labels = verdicts.relation(said(" k1", "K4")), verdicts.direction(said("Kritik", "mendukung ")), verdicts.confidence(said("Tinggi", "?"), F.col("user_id") % 2 == 0)
    return _t(spark, d, "events").select("event_id", *(c.alias(n) for c, n in zip(labels, ("hubungan", "arah", "keyakinan"), strict=True)))


@query("link_resolution", r"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://news.google.com/articles/' || page_id ELSE trim(coalesce(url, ''), ' ') END AS link FROM pages),
m AS (SELECT *, CASE WHEN page_id % 2 = 1 THEN 'direct' WHEN page_id % 14 = 0 THEN 'cache' WHEN page_id % 14 = 2 THEN 'pre_filtered' WHEN page_id % 14 = 4 AND page_id % 28 <> 4 THEN 'negative_cache'
    WHEN page_id % 14 = 6 THEN 'decode_offline' WHEN page_id % 14 = 8 THEN 'rejected_target' WHEN page_id % 14 = 10 THEN 'fallback_meta' WHEN page_id % 14 = 12 THEN 'fallback_serper' ELSE 'failed' END AS method FROM p)
SELECT page_id, method, method IN ('cache', 'decode_offline', 'fallback_meta', 'fallback_serper') OR (method = 'direct' AND link <> '') AS resolved,
  CASE method WHEN 'cache' THEN 'https://a.id/x/' || page_id WHEN 'decode_offline' THEN 'https://b.id/p/' || page_id WHEN 'fallback_meta' THEN 'https://c.id/p/' || page_id WHEN 'fallback_serper' THEN 'https://d.id/p/' || page_id ELSE link END AS url
FROM m
""")
def _(spark, d):
    """Layers of the resolution, each answering for a residue of the page's number."""
    from pressmill.operators import resolve

    pages, k = _t(spark, d, "pages"), F.col("page_id")
    own = lambda start: F.concat(F.lit(start), k.cast("string"))
    link = F.when(k % 2 == 0, own("https://news.google.com/articles/")).otherwise(F.col("url"))
    maps = F.when(k % 14 == 2, "Kantor - Google Maps").otherwise("Harga gula")
    candidates = F.when(k % 14 == 10, F.array(F.lit("https://news.google.com/x"), own("https://c.id/p/"))).otherwise(F.array(F.lit("https://c.id/")))
    items = pages.select("page_id", link.alias("link"), maps.alias("title"), F.lit("Media").alias("media"), F.lit("https://m.id").alias("source_url"), candidates.alias("candidates"))
    even = pages.filter(k % 2 == 0).select(k, own("https://news.google.com/articles/").alias("link"))
    cache = even.filter(k % 14 == 0).select("link", own("https://a.id/x/").alias("url"))
    failed = even.filter(k % 14 == 4).select("link", F.when(k % 28 == 4, 5).otherwise(15).alias("until"))
    decoded = even.filter((k % 14).isin(0, 6, 8, 12)).select("link", F.when(k % 14 == 12, own("https://d.id/p/")).otherwise(own("https://b.id/p/")).alias("url"), F.when(k % 14 == 8, "rejected_target").when(k % 14 == 12, "fallback_serper").otherwise("decode_offline").alias("method"))
    return resolve.resolve(items, cache, failed, decoded, F.lit(10), ("jobs.id",)).select("page_id", "method", "resolved", "url")


_DECODE_METHODS = ("cache", "decode_offline", "decode_local", "fallback_meta", "fallback_exa", "negative_cache", "rejected_target", "pre_filtered", "circuit_skipped")


@query("decode_stats", f"""
WITH e AS (SELECT event_type, user_id % 2 = 0 AS g, [{", ".join(f"'{m}'" for m in _DECODE_METHODS)}][event_id % 9 + 1] AS m, event_id % 9 >= 5 AS f, (event_id * 7) % 600 AS n FROM events),
c AS (SELECT event_type, count(*) AS extract_total, count(*) FILTER (n >= 300) AS extract_ok, count(*) FILTER (n < 300 AND NOT f) AS extract_short, count(*) FILTER (g) AS gnews_total,
  count(*) FILTER (g AND m = 'cache') AS cache_hit, count(*) FILTER (g AND m = 'negative_cache') AS negative_cache_hit, count(*) FILTER (g AND m = 'rejected_target') AS rejected_target,
  count(*) FILTER (g AND m = 'pre_filtered') AS pre_filtered, count(*) FILTER (g AND m = 'decode_offline') AS decode_offline, count(*) FILTER (g AND m = 'decode_local') AS decode_local,
  count(*) FILTER (g AND m IN ('decode_offline', 'decode_local')) AS decode_ok, count(*) FILTER (g AND m = 'fallback_meta') AS fallback_meta, count(*) FILTER (g AND m = 'fallback_exa') AS fallback_search,
  count(*) FILTER (g AND m = 'circuit_skipped') AS decode_fail, count(*) FILTER (g AND m = 'circuit_skipped') AS circuit_skipped FROM e GROUP BY 1)
SELECT *, CASE WHEN gnews_total - rejected_target - pre_filtered > 0 THEN 100.0::DOUBLE * decode_fail / (gnews_total - rejected_target - pre_filtered) ELSE 0.0 END AS fail_pct FROM c
""")
def _(spark, d):
    from pressmill.operators import resolve

    k = F.col("event_id")
    method = F.element_at(F.array(*map(F.lit, _DECODE_METHODS)), (k % 9 + 1).cast("int"))
    link = F.when(F.col("user_id") % 2 == 0, "https://news.google.com/x").otherwise("https://a.id/x")
    return resolve.decode_stats(_t(spark, d, "events"), ["event_type"], link, method, k % 9 >= 5, (k * 7) % 600)


@query("id_hosts", r"SELECT page_id, regexp_matches(lower(trim(coalesce(url, ''), ' ')), '^[a-z]+://[^/?#]*\.id(:[0-9]+)?([/?#]|$)') AS allowed FROM pages")
def _(spark, d):
    from pressmill.operators import resolve

    return _t(spark, d, "pages").select("page_id", resolve.is_id_host(F.col("url")).alias("allowed"))


@query("export_rows", r"""
SELECT p_name AS isu, p_name || ' - Media' AS title, 'https://m.id/' || p_partkey AS link, NULL::VARCHAR AS published, p_brand AS media, CASE WHEN p_size % 3 = 0 THEN 'Positif' ELSE 'Netral' END AS tone,
  '-' AS unit, 'RSS' AS source_data FROM part WHERE p_partkey % 13 <> 0 AND p_size % 11 <> 0
""")
def _(spark, d):
    from pressmill.operators import publish

    k = F.col("p_partkey").cast("string")
    link = F.concat(F.lit('=HYPERLINK("https://m.id/'), k, F.when(F.col("p_partkey") % 13 == 0, ".pdf").otherwise(""), F.lit('","buka")'))
    rows = _t(spark, d, "part").select(F.concat("p_name", F.lit(" - Media")).alias("judul"), link.alias("url"), F.col("p_brand").alias("source"), F.when(F.col("p_size") % 3 == 0, "Positif").otherwise("nan").alias("tone"), F.when(F.col("p_size") % 11 == 0, "Buang ").otherwise("review").alias("status"))
    return publish.export_rows(rows)


@query("match_once", """
WITH e AS (SELECT event_id, event_type, user_id, ts::DATE AS day FROM events),
l1 AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY event_id) AS n FROM e WHERE event_type = 'purchase'),
r1 AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY event_id) AS n FROM e WHERE event_type = 'error'),
m AS (SELECT l1.event_id AS a, r1.event_id AS b FROM l1 JOIN r1 USING (user_id, day, n)),
l2 AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM l1 WHERE event_id NOT IN (SELECT a FROM m)),
r2 AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM r1 WHERE event_id NOT IN (SELECT b FROM m))
SELECT a, b, 0 AS round FROM m UNION ALL SELECT l2.event_id, r2.event_id, 1 FROM l2 JOIN r2 USING (user_id, n)
""")
def _(spark, d):
    """Purchases and errors of one user, first of one day, then of any; each is used once."""
    e = _t(spark, d, "events").select("event_id", "event_type", "user_id", F.to_date("ts").alias("day"))
    left, right = (e.filter(F.col("event_type") == x).select("event_id", "user_id", "day") for x in ("purchase", "error"))
    day, user = F.concat_ws("|", "user_id", "day"), F.col("user_id").cast("string")
    found = merge.match_once(left, right, [(day, day), (user, user)], [F.col("event_id")], [F.col("event_id")])
    return found.select(F.col("l.event_id").alias("a"), F.col("r.event_id").alias("b"), F.col("by").alias("round"))


@query("negative_sheet", r"""
WITH a AS (SELECT 'l' || p_partkey AS link, p_name || p_type AS title FROM part WHERE p_size % 2 = 0),
l AS (SELECT 'l' || p_partkey AS link, 's' || p_partkey AS summary FROM part WHERE p_partkey % 3 = 0),
t AS (SELECT lower(p_name || p_type) AS k, 't' || p_partkey AS summary, row_number() OVER (PARTITION BY lower(p_name || p_type) ORDER BY upper(p_name || p_type), 't' || p_partkey) AS n FROM part WHERE p_partkey % 30 = 1),
f AS (SELECT link, title, row_number() OVER (PARTITION BY lower(title) ORDER BY link, title) AS n FROM a WHERE link NOT IN (SELECT link FROM l))
SELECT a.link, a.title, coalesce(l.summary, t.summary, '-') AS summary FROM a LEFT JOIN l ON l.link = a.link LEFT JOIN f ON f.link = a.link LEFT JOIN t ON t.k = lower(f.title) AND t.n = f.n
""")
def _(spark, d):
    from pressmill.operators import publish

    part, k = _t(spark, d, "part"), F.col("p_partkey").cast("string")
    title = F.concat("p_name", "p_type")
    articles = part.select(F.concat(F.lit("l"), k).alias("link"), title.alias("title"), F.when(F.col("p_size") % 2 == 0, "Negatif").otherwise("Netral").alias("tone"))
    by_link = part.filter("p_partkey % 3 = 0").select(F.concat(F.lit("l"), k).alias("link"), F.lit("").alias("title"), F.concat(F.lit("s"), k).alias("summary"))
    by_title = part.filter("p_partkey % 30 = 1").select(F.lit("").alias("link"), F.upper(title).alias("title"), F.concat(F.lit("t"), k).alias("summary"))
    return publish.negative_sheet(articles, by_link.unionByName(by_title))


@query("run_kpis", "SELECT count(*) AS total, floor(100.0::DOUBLE * count(*) FILTER (o_orderstatus <> 'P') / count(*) + 0.5)::BIGINT AS success_pct, floor(avg((o_orderkey % 9) * 60 + o_custkey % 60) FILTER (o_orderkey % 5 <> 0) + 0.5)::BIGINT AS mean_seconds FROM orders")
def _(spark, d):
    from pressmill.operators import publish

    shown = F.concat((F.col("o_orderkey") % 9).cast("string"), F.lit("m "), F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0"), F.lit("s"))
    return publish.run_kpis(_t(spark, d, "orders"), F.when(F.col("o_orderstatus") == "P", "Gagal").otherwise("Berhasil"), F.when(F.col("o_orderkey") % 5 == 0, "-").otherwise(shown))


@query("run_history", "SELECT o_orderkey, o_orderdate, o_orderstatus AS status FROM orders ORDER BY o_orderdate DESC, o_orderkey, status LIMIT 30")
def _(spark, d):
    from pressmill.operators import publish

    runs = _t(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("status"))
    return publish.run_history(runs.filter("o_orderkey % 2 = 0"), runs.filter("o_orderkey % 2 = 1"), "o_orderdate")


@query("run_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND contains(lower(o_orderpriority), 'medium')")
def _(spark, d):
    from pressmill.operators import publish

    runs = _t(spark, d, "orders").withColumnRenamed("o_orderstatus", "status")
    return publish.run_filter(runs, "F", "Medium", ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query("media_names", r"SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'Kompas' WHEN 1 THEN n_name WHEN 2 THEN 'VIVA' ELSE 'Media Nasional' END AS media, CASE WHEN n_nationkey = 0 THEN '0' ELSE n_nationkey || '.234.567' END AS shown FROM nation")
def _(spark, d):
    from pressmill.operators import publish

    k = F.col("n_nationkey")
    media = F.when(k % 4 == 0, "KOMPAS.com").when(k % 4 == 1, F.concat(F.lit("Advertorial "), "n_name", F.lit(".CO.ID"))).when(k % 4 == 2, " viva.co.id")
    n = F.when(k == 0, 0).otherwise(k * 1_000_000 + 234_567)
    return _t(spark, d, "nation").select("n_nationkey", publish.media_name(media).alias("media"), publish.number_display(n).alias("shown"))


@query("name_queries", r"""
WITH k AS (SELECT n_name, unnest(['gula', 'kopi', 'teh', '"minyak sawit"', 'karet', 'kakao']) AS w, generate_subscripts([1, 2, 3, 4, 5, 6], 1) AS i, n_nationkey FROM nation)
SELECT n_name, ((i - 1) // 4)::INTEGER AS chunk, '"' || n_name || '" (' || string_agg(CASE WHEN w LIKE '"%' THEN w ELSE '"' || w || '"' END, ' OR ' ORDER BY i) || ')' AS expression
FROM k WHERE i <= n_nationkey % 7 GROUP BY 1, 2
""")
def _(spark, d):
    from pressmill.operators import publish

    words = F.array(*map(F.lit, ("gula", "kopi", "teh", '"minyak sawit"', "karet", "kakao")))
    officials = _t(spark, d, "nation").select("n_name", F.slice(words, F.lit(1), F.col("n_nationkey") % 7).alias("words"))
    return publish.name_queries(officials, "n_name", "words")


@query("screening", _screen_sql("doc_id"))
def _(spark, d):
    """The whole screening with its overrides, over documents as articles."""
    from pressmill.operators import screen

    return screen.screen(_articles(spark, d)).select("doc_id", "discard_reason")


# Intake, officials, verdicts -------------------------------------------------------------------------------------------

_PAGE_SQL = SQL["canonical_url"].strip()


def _copies(spark, d) -> DataFrame:
    """pages as copies of articles: three sources over few addresses."""
    at = F.concat(F.lit("https://Media.id/a/"), F.pmod("page_id", F.lit(60)).cast("string"), F.lit("?utm_source=x"))
    n = F.col("page_id")
    return _t(spark, d, "pages").select("page_id", at.alias("link"), F.concat(F.lit("T"), n).alias("title"), F.expr("repeat('x', cast(page_id % 7 as int))").alias("text"), F.when(n % 2 == 0, "gula, kopi").otherwise("Kopi").alias("keyword"), F.when(n % 3 == 0, F.concat(F.lit("p"), n)).alias("published"), F.when(n % 5 == 0, F.concat(F.lit("m"), n)).otherwise("").alias("media"))


@query("union_by_url", """
WITH k AS (SELECT page_id, 'https://media.id/a/' || (page_id % 60) AS link, 'T' || page_id AS title, repeat('x', (page_id % 7)::INT) AS text, CASE WHEN page_id % 2 = 0 THEN 'gula, kopi' ELSE 'Kopi' END AS keyword, CASE WHEN page_id % 3 = 0 THEN 'p' || page_id END AS published, CASE WHEN page_id % 5 = 0 THEN 'm' || page_id ELSE '' END AS media FROM pages),
b AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY link ORDER BY length(text) DESC, page_id) = 1),
w AS (SELECT link, CASE WHEN arg_min(keyword, page_id) = 'Kopi' THEN CASE WHEN count(DISTINCT keyword) = 1 THEN 'Kopi' ELSE 'Kopi, gula' END ELSE 'gula, kopi' END AS keyword, count(*) AS n_members FROM k GROUP BY 1)
SELECT b.page_id, b.link, b.title, w.keyword, w.n_members, coalesce(b.published, (SELECT arg_min(published, page_id) FROM k WHERE k.link = b.link AND k.page_id > b.page_id AND published IS NOT NULL)) AS published,
  coalesce(nullif(b.media, ''), (SELECT arg_min(media, page_id) FROM k WHERE k.link = b.link AND k.page_id > b.page_id AND media <> '')) AS media FROM b JOIN w USING (link)
""")
def _(spark, d):
    from pressmill.operators import intake

    return intake.union_by_url(_copies(spark, d), "page_id").select("page_id", "link", "title", "keyword", "n_members", "published", "media")


@query("dedup_by_url", f"WITH c AS ({_PAGE_SQL.rstrip(';')}), k AS (SELECT page_id, html, canonical AS link FROM pages JOIN c USING (page_id)) SELECT arg_max(page_id, (length(coalesce(html, '')), -page_id)) AS page_id, link, count(*) AS n_members FROM k WHERE link <> '' GROUP BY link UNION ALL SELECT page_id, link, 1 FROM k WHERE coalesce(link, '') = ''")
def _(spark, d):
    pages = _t(spark, d, "pages").select("page_id", "html", url.canonical(F.col("url")).alias("link"))
    return dedup.dedup_by_key(pages, F.col("link"), F.col("html"), F.lit("page"), F.col("page_id")).select("page_id", "link", "n_members")


@query("union_sources", "SELECT 0 AS source_no, n_nationkey AS id, n_name AS name, NULL::INTEGER AS region FROM nation UNION ALL SELECT 1, r_regionkey, r_name, r_regionkey::INTEGER FROM region")
def _(spark, d):
    from pressmill.operators import intake

    a = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    b = _t(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("name"), F.col("r_regionkey").cast("int").alias("region"))
    return intake.union_sources(a, b)


@query("press_list", """
WITH k AS (SELECT o_orderkey, 'https://m.id/' || (o_custkey % 500) AS url, CASE WHEN o_orderkey % 11 = 0 THEN 'kemarin' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS day, o_orderdate::DATE AS d, repeat('ab', (o_orderkey % 900)::INT) AS text FROM orders)
SELECT o_orderkey, url, d AS day, length(substr(text, 1, 1000)) AS n FROM k WHERE day <> 'kemarin' AND d BETWEEN DATE '1994-03-01' AND DATE '1995-02-28' QUALIFY row_number() OVER (PARTITION BY url ORDER BY o_orderkey) = 1
""")
def _(spark, d):
    import datetime

    from pressmill.operators import intake

    first, last = intake.date_range("1994-03-01 to 1995-02-28", datetime.date(2026, 1, 1))
    key = F.col("o_orderkey")
    rows = _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit("https://m.id/"), (F.col("o_custkey") % 500).cast("string")).alias("url"), F.when(key % 11 == 0, "kemarin").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day"), F.expr("repeat('ab', cast(o_orderkey % 900 as int))").alias("text"))
    return intake.press_list(rows, F.lit(first), F.lit(last), "o_orderkey").select("o_orderkey", "url", "day", F.length("text").cast("long").alias("n"))


@query("retry_queue", """
WITH f AS (SELECT l_orderkey AS link, CASE WHEN l_linenumber % 2 = 0 THEN 'gula, kopi' ELSE 'Kopi' END AS keyword, l_orderkey * 10 + l_linenumber AS pos FROM lineitem WHERE l_linenumber <= 3), x AS (SELECT * FROM f WHERE link NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))
SELECT link, min(pos) AS pos, CASE WHEN arg_min(keyword, pos) = 'Kopi' THEN CASE WHEN count(DISTINCT keyword) = 1 THEN 'Kopi' ELSE 'Kopi, gula' END ELSE 'gula, kopi' END AS keyword FROM x GROUP BY 1
""")
def _(spark, d):
    from pressmill.operators import intake

    f = _t(spark, d, "lineitem").filter("l_linenumber <= 3").select(F.col("l_orderkey").alias("link"), F.when(F.col("l_linenumber") % 2 == 0, "gula, kopi").otherwise("Kopi").alias("keyword"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"))
    done = _t(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("link"))
    return intake.retry_queue(f, done, "link", "keyword", "pos")


@query("distinct_titles", r"SELECT c_custkey, name FROM (SELECT c_custkey, c_mktsegment || '  ' || (c_custkey % 40) AS name FROM customer) QUALIFY row_number() OVER (PARTITION BY lower(regexp_replace(trim(name), '\s+', ' ', 'g')) ORDER BY c_custkey) = 1")
def _(spark, d):
    from pressmill.operators import intake

    rows = _t(spark, d, "customer").select("c_custkey", F.concat("c_mktsegment", F.lit("  "), F.col("c_custkey") % 40).alias("title"))
    return intake.distinct_titles(rows, F.col("c_custkey")).select("c_custkey", F.col("title").alias("name"))


@query("number_rows", "SELECT n_name, row_number() OVER (ORDER BY n_name DESC)::INTEGER AS id FROM nation")
def _(spark, d):
    from pressmill.operators import intake

    return intake.number_rows(_t(spark, d, "nation").select("n_name"), F.desc("n_name"))


@query("single_word", "SELECT DISTINCT p_type, p_brand, length(split_part(p_type, ' ', 1)) > 0 AND NOT contains(trim(p_type), ' ') AS plain, true AS alternative FROM part")
def _(spark, d):
    from pressmill.operators import intake

    alternatives = F.concat(F.lit('("gula" OR "'), "p_brand", F.lit('")'))
    return _t(spark, d, "part").select("p_type", "p_brand", intake.single_word(F.col("p_type")).alias("plain"), intake.single_word(alternatives).alias("alternative")).distinct()


@query("cache_eviction", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 500")
def _(spark, d):
    return merge.evict(_t(spark, d, "events").select("event_id", "ts"), "ts", 500)


@query("release_members", "SELECT r.o_orderkey AS rilis, count(l.l_orderkey) AS member_count, coalesce(array_to_string(list_sort(list(l.l_linenumber) FILTER (WHERE l.l_linenumber IS NOT NULL)), ','), '') AS members, CASE WHEN count(l.l_orderkey) = 0 THEN 'belum tercatat' ELSE 'tercatat' END AS status FROM orders r LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') l ON l.l_orderkey = r.o_orderkey GROUP BY 1")
def _(spark, d):
    r = _t(spark, d, "orders").select(F.col("o_orderkey").alias("rilis"))
    m = _t(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("rilis"), "l_linenumber")
    out = marts.release_coverage(r, m, "rilis", "l_linenumber")
    return out.withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), ","))


@query("evaluation_summary", """
WITH e AS (SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN 'Positif' WHEN event_type = 'error' THEN 'Negatif' ELSE 'Netral' END AS a, CASE WHEN event_id % 7 = 0 THEN 'Negatif' WHEN event_id % 3 = 0 THEN 'Positif' ELSE 'Netral' END AS p FROM events),
f AS (SELECT k, count(*) FILTER (WHERE a = k AND p = k) AS h, count(*) FILTER (WHERE p = k) AS s, count(*) FILTER (WHERE a = k) AS t FROM e, (VALUES ('Positif'), ('Netral'), ('Negatif')) x(k) GROUP BY k)
SELECT (SELECT count(*) FROM e) AS total, round((SELECT avg((a = p)::INT) FROM e), 9) AS accuracy, round(sum(CASE WHEN s + t > 0 THEN 2.0 * h / (s + t) ELSE 0 END) / 3, 9) AS macro_f1, round(sum(CASE WHEN k = 'Negatif' THEN s END) * 1.0 / nullif(sum(CASE WHEN k = 'Negatif' THEN t END), 0), 9) AS negative_ratio,
  round((SELECT avg((a = 'Netral')::INT) FROM e), 9) AS always_accuracy, round(2.0 * sum(CASE WHEN k = 'Netral' THEN t END) / ((SELECT count(*) FROM e) + sum(CASE WHEN k = 'Netral' THEN t END)) / 3, 9) AS always_macro_f1 FROM f
""")
def _(spark, d):
    key = F.col("event_id")
    e = _t(spark, d, "events").select(_tone().alias("a"), F.when(key % 7 == 0, "Negatif").when(key % 3 == 0, "Positif").otherwise("Netral").alias("p"))
    out = evaluation.summary(e, "a", "p")
    return out.select("total", *(F.round(c, 9).alias(c) for c in out.columns[1:]))


@query("issue_verdicts", """
WITH m AS (SELECT user_id AS isu, user_id % 13 = 0 AS rilis, CASE event_id % 4 WHEN 0 THEN 'K2' WHEN 1 THEN 'K3' WHEN 2 THEN 'K4' ELSE CASE WHEN user_id % 3 = 0 THEN 'K1' ELSE 'K3' END END AS h, CASE event_id % 5 WHEN 0 THEN 'menyerang' WHEN 1 THEN 'mendukung' ELSE 'tidak ada' END AS r FROM events),
t AS (SELECT *, CASE r WHEN 'menyerang' THEN 'Negatif' WHEN 'mendukung' THEN 'Positif' ELSE 'Netral' END AS tone FROM m),
i AS (SELECT isu, bool_or(rilis OR h = 'K1') AS k1, bool_or(r = 'menyerang') AS attack, bool_or(h = 'K3') AS k3, min(h) AS least, count(*) AS members FROM t GROUP BY 1),
v AS (SELECT isu, tone, count(*) AS c FROM t GROUP BY 1, 2), b AS (SELECT isu, max(c) AS top FROM v GROUP BY 1), w AS (SELECT isu, count(*) AS n, min(tone) AS tone FROM v JOIN b USING (isu) WHERE c = top GROUP BY 1),
h AS (SELECT isu, tone, h, row_number() OVER (PARTITION BY isu, tone ORDER BY count(*) DESC, h) AS o FROM t GROUP BY 1, 2, 3),
g AS (SELECT isu, tone, r, row_number() OVER (PARTITION BY isu, tone ORDER BY count(*) DESC, CASE r WHEN 'menyerang' THEN 'menyerang' WHEN 'mendukung' THEN 'mendukung' ELSE 'tidak ada' END) AS o FROM t GROUP BY 1, 2, 3)
SELECT isu, CASE WHEN k1 AND NOT attack THEN 'Positif' WHEN n > 1 THEN 'Netral' ELSE w.tone END AS issue_tone, CASE WHEN k1 THEN 'K1' WHEN n > 1 THEN CASE WHEN k3 THEN 'K3' ELSE least END ELSE h.h END AS hubungan,
  CASE WHEN k1 AND NOT attack THEN 'mendukung' WHEN n > 1 THEN 'tidak ada' ELSE g.r END AS arah, members FROM i JOIN w USING (isu) JOIN h ON h.isu = i.isu AND h.tone = w.tone AND h.o = 1 JOIN g ON g.isu = i.isu AND g.tone = w.tone AND g.o = 1
""")
def _(spark, d):
    key, user = F.col("event_id"), F.col("user_id")
    relation = F.when(key % 4 == 0, "K2").when(key % 4 == 1, "K3").when(key % 4 == 2, "K4").otherwise(F.when(user % 3 == 0, "K1").otherwise("K3"))
    direction = F.when(key % 5 == 0, "menyerang").when(key % 5 == 1, "mendukung").otherwise("tidak ada")
    tones = F.when(F.col("arah") == "menyerang", "Negatif").when(F.col("arah") == "mendukung", "Positif").otherwise("Netral")
    m = _t(spark, d, "events").select(user.alias("isu"), (user % 13 == 0).alias("rilis"), relation.alias("hubungan"), direction.alias("arah")).withColumn("tone", tones)
    return tone.issue_verdict(m, "isu", "rilis")


@query("fuzzy_officials")
def _(spark, d):
    """Officials by exact or near aliases, with the unit of the first."""
    units = {"Agus Gumiwang": "Menteri", "Putu Juli Ardika": "IA"}
    return entities.fuzzy_spokespersons(_articles(spark, d), F.concat_ws(" ", "title", "text"), _OFFICIALS, units).select("doc_id", "spokesperson_1", "spokesperson_2", "unit_eselon")


def _hits_sql() -> str:
    from pressmill.operators import screen
    from pressmill.operators.predicates import DUCKDB

    return f"SELECT doc_id, title FROM (SELECT *, {screen.FIELDS['_t']} AS _t FROM {_articles_sql(DUCKDB)}) WHERE NOT contains(url, '/loker') AND {screen.likely_relevant().show(DUCKDB)}"


@query("search_hits", _hits_sql())
def _(spark, d):
    from pressmill.operators import intake

    rows = _articles(spark, d).select("doc_id", F.concat("title", F.lit(" - "), "source").alias("title"), F.col("url").alias("link"), F.col("source").alias("media"))
    return intake.search_hits(rows, "doc_id").select("doc_id", "title")


@query("official_aliases", """
WITH k AS (SELECT DISTINCT 'Putu Juli ' || c_mktsegment AS nama FROM customer)
SELECT nama, 'IA' AS unit_eselon, array_to_string(list_transform(list_sort(list_transform([lower(nama), 'putu juli', 'putu juli ardika'], lambda x: {'n': -length(x), 'a': x})), lambda y: y.a), '|') AS aliases FROM k
""")
def _(spark, d):
    from pressmill.operators import intake

    rows = _t(spark, d, "customer").select(F.concat_ws(" ", F.lit("Putu  Juli"), "c_mktsegment").alias("nama"), F.lit(" IA ").alias("unit_eselon")).distinct()
    return intake.official_aliases(rows).select("nama", "unit_eselon", F.array_join("aliases", "|").alias("aliases"))


@query("officials_in_scope", r"""
WITH k AS (SELECT n_name AS nama, CASE WHEN n_nationkey % 5 = 0 THEN 'gula; di luar scope' WHEN n_nationkey % 5 = 1 THEN ' gula ;kopi;; ' ELSE 'teh' END AS said, n_nationkey FROM nation)
SELECT nama, '' AS jabatan, CASE WHEN n_nationkey % 5 = 1 THEN 'gula|kopi' ELSE 'teh' END AS keywords, false AS is_out_of_scope FROM k WHERE n_nationkey % 5 <> 0
""")
def _(spark, d):
    from pressmill.operators import intake

    key = F.col("n_nationkey") % 5
    rows = _t(spark, d, "nation").select(F.col("n_name").alias("nama_pejabat"), F.lit(" ").alias("jabatan"), F.when(key == 0, "gula; di luar scope").when(key == 1, " gula ;kopi;; ").otherwise("teh").alias("keyword_terkait"))
    return intake.officials_in_scope(rows).withColumn("keywords", F.array_join("keywords", "|"))
