"""Text columns: titles, normalisation, tokens, entities, keyword folds, classifications. All built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressmill.functions.url import escaped, folded

# Phrases and words that name one thing, words without topic, and broad topics.
PHRASES = {
    "rokok elektrik": "rokok_elektronik", "rokok elektronik": "rokok_elektronik", "proyek strategis nasional": "psn", "makan bergizi gratis": "mbg",
    "menu mbg": "mbg", "masuk mbg": "mbg", "seram bagian timur": "sbt", "industri hasil tembakau": "iht", "susu ikan": "susu_ikan", "minyak atsiri": "minyak_atsiri",
    "rumput laut": "rumput_laut", "pakan ternak": "pakan_ternak", "pet food": "pet_food", "bea keluar": "bea_keluar", "el nino": "el_nino",
    "tenaga kerja": "pekerja", "nasib pekerja": "pekerja", "jaga pekerja": "lindungi pekerja", "jaga tenaga kerja": "lindungi pekerja",
    "memohon perlindungan": "minta lindungi", "minta perlindungan": "minta lindungi", "minta pemerintah lindungi": "minta pemerintah lindungi",
    "pelaku industri": "industri", "pelaku usaha": "industri", "kabar terbaru": "perkembangan", "begini nasib": "perkembangan", "masih pr": "perkembangan",
    "digadang-gadang": "digadang", "pelarangan": "larangan", "berbasis bukti": "kajian ilmiah",
}
WORDS = {"rel": "rokok_elektronik", "vape": "rokok_elektronik", "vapor": "rokok_elektronik", "perlindungan": "lindungi", "melindungi": "lindungi", "memohon": "minta", "meminta": "minta", "mendesak": "minta", "desak": "minta", "karyawan": "pekerja", "buruh": "pekerja"}
STOPWORDS = "dan di ke dari yang untuk pada dengan ini itu atau dalam oleh sebagai karena agar hingga sampai akan sudah telah masih jadi menjadi para terkait soal tentang begini dulu kini saat tengah atas nasional indonesia ri".split()
GENERIC = "sawit sagu rokok_elektronik susu_ikan kakao karet pulp tekstil gula garam kelor rumput_laut pakan_ternak mamin industri pemerintah kemenperin ekspor hilirisasi wacana ekonomi dampak berdampak disorot".split()
ACRONYMS = "kkp mbg psn sbt mk bnn mui ispo b50 tkdn dpr knma apki askindo gapki hippindo kadin bpdp ntb sumut maluku jepang sumsel aceh meranti riau".split()
# What ends a title as the name of a medium, and amounts, days and years of a normalised title.
MEDIA_SUFFIX = (
    r"\s+(?:[-–—|]\s*)(?:[A-Za-z0-9_.-]+\.(?:com|co\.id|id|go\.id|net|org)|ANTARA\s+News(?:\s+[A-Za-z]+)?|CNN\s+Indonesia|CNBC\s+Indonesia|detik[A-Za-z]*|Kompas\.com|Tempo\.co"
    r"|Liputan6\.com|kumparan|Inilah\.com|Harian\s+Jogja|Sumut\s+Pos|MetroTVNews\.com|FORTUNE\s+Indonesia|Industry\.co\.id|Kontan(?:\.co\.id)?"
    r"|Bisnis(?:\.com)?|Radar\s+[A-Za-z]+|Index\s+Sumut|Rakyat\s+Maluku|Ameks\s+Online)\s*$"
)
MEDIA_HINTS = (".com", ".id", ".co.id", "news", "pos", "online", "tv")
TITLE_NUMBERS = (
    r"\b(?:usd\s*\d+(?:_\d+)?(?:\s*(?:juta|miliar|triliun))?|rp\s*\d+(?:_\d+)?(?:\s*(?:juta|miliar|triliun))?|\d+(?:_\d+)?\s*(?:juta|miliar|triliun|persen|ton|tahun|hari)"
    r"|\d{1,2}\s+(?:januari|februari|maret|april|mei|juni|juli|agustus|september|oktober|november|desember)|202\d)\b"
)
#: Commodity classes in order; substrings, not words.
COMMODITIES = (
    ("Kelapa Sawit & CPO", ("sawit", "cpo", "minyak sawit", "pome")),
    ("Biodiesel & Bioenergi", ("biodiesel", "bioethanol", "fame", "bioenergi")),
    ("Hasil Tembakau", ("tembakau", "rokok", "nikotin", "tar", "vape", "cukai")),
    ("Tepung, Sagu & Pati", ("tepung", "terigu", "tapioka", "sagu", "pati", "mocaf")),
    ("Kakao & Cokelat", ("kakao", "cokelat")),
    ("Kopi & Teh", ("kopi", "teh")),
    ("Kelapa & Olahan", ("kelapa",)),
    ("Rumput Laut", ("rumput laut", "alga", "spirulina")),
    ("Kayu & Furnitur", ("mebel", "furniture", "furnitur", "kayu")),
    ("Pulp & Kertas", ("pulp", "kertas")),
    ("Gula & Tebu", ("gula", "tebu", "rafinasi")),
    ("Karet & Olahan", ("karet",)),
    ("Susu & Olahan", ("susu",)),
    ("Pakan Ternak", ("pakan",)),
    ("Makanan & Minuman", ("makanan", "minuman", "mamin", "daging", "mi instan", "ikan kaleng", "biskuit", "beralkohol", "berpemanis", "amdk", "galon")),
)
OTHER_COMMODITY = "Lainnya"
_EDGE = r"\p{L}\p{N}_"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with the value worked out once, however often it is used; plain reuse repeats the whole expression, branch by branch."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def clean(c: Column, dash_is_null: bool = False) -> Column:
    """Trimmed, with the spellings of absence as null."""
    t = F.trim(c)
    gone = ["", "nan", "none", "null"] + (["-"] if dash_is_null else [])
    return F.when(~F.lower(t).isin(*gone), t)


def strip_source_suffix(title: Column, source: Column) -> Column:
    """Remove every trailing ' - <source>', ignoring case. The source is taken literally."""
    quoted = F.concat(F.lit(r"(?i)( - \Q"), F.replace(source, F.lit("\\E"), F.lit("")), F.lit(r"\E)+\s*$"))
    return F.when(F.coalesce(source, F.lit("")) == "", title).otherwise(F.regexp_replace(title, quoted, F.lit("")))


def strip_last_segment(title: Column) -> Column:
    """Cut at the last ' - '."""
    return F.trim(F.regexp_replace(title, r"(?s)^(.*) - .*$", "$1"))


def unescape_html(c: Column) -> Column:
    for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def _without_tail(title: Column, separator: str, *hints: str) -> Column:
    """The title before its last separator, where at most four words follow (with one of the hints, if any) and 15 characters or more precede it."""

    def cut(title: Column, tail: Column) -> Column:
        head = F.substring(title, F.lit(1), F.length(title) - F.length(tail) - len(separator))
        words = F.size(F.filter(F.split(tail, r"\s+"), lambda w: w != ""))
        hinted = F.lower(tail).rlike(escaped(hints)) if hints else F.lit(True)
        return F.when(F.contains(title, F.lit(separator)) & (words <= 4) & (F.length(head) >= 15) & hinted, _stripped(head)).otherwise(title)

    return let(title, lambda t: let(F.substring_index(t, separator, -1), lambda tail: cut(t, tail)))


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def display_title(title: Column) -> Column:
    """Unescaped title without the name of its medium."""
    t = _stripped(F.regexp_replace(_stripped(unescape_html(title)), f"(?i){MEDIA_SUFFIX}", ""))
    t = _without_tail(_without_tail(t, " | "), " - ", *MEDIA_HINTS)
    return _stripped(F.regexp_replace(t, r"\s+", " "))


def normalise_issue(title: Column) -> Column:
    """Lower case, amounts of money kept together, one spelling for phrases and words that name one thing."""
    t = F.lower(display_title(title))
    for sign, name in ((r"us\$", "usd"), ("rp", "rp")):
        for number, kept in ((r"(\d+)[.,](\d+)", "$1_$2"), (r"(\d+)", "$1")):
            t = F.regexp_replace(t, rf"{sign}(?<![{_EDGE}]{sign})\s*{number}", f"{name} {kept}")  # a literal is found sooner than an edge
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_\s-]", " ")
    for phrase, name in sorted(PHRASES.items(), key=lambda x: (-len(x[0]), x[0])):
        t = F.regexp_replace(t, rf"{phrase}(?<![{_EDGE}]{phrase})(?![{_EDGE}])", name)
    names = F.create_map(*(F.lit(x) for pair in WORDS.items() for x in pair))
    ws = F.filter(F.split(F.replace(t, F.lit("-"), F.lit(" ")), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(ws, lambda w: F.coalesce(F.try_element_at(names, w), w)), " ")


def tokens(normal: Column, drop_generic: bool = False) -> Column:
    """Distinct tokens of two characters or more (or a digit), without stop words."""
    ws = F.filter(F.split(normal, r"\s+"), lambda w: (F.length(w) >= 2) | w.rlike("^[0-9]$"))
    gone = STOPWORDS + (GENERIC if drop_generic else [])
    return F.array_except(F.array_distinct(ws), F.array(*map(F.lit, gone)))


def entities(normal: Column) -> Column:
    """struct(numbers, acronyms) of a normalised title."""
    amount = rf"(?=[ur\d])(?<![{_EDGE}]){TITLE_NUMBERS[2:-2]}(?![{_EDGE}])"
    return F.struct(F.array_distinct(F.regexp_extract_all(normal, F.lit(amount), 0)).alias("numbers"), F.array_intersect(F.split(normal, r"\s+"), F.array(*map(F.lit, ACRONYMS))).alias("acronyms"))


# Fixed values of entities in bodies. Patterns look for a first character before what stands before it.
BOILERPLATE = (
    "WIB WITA WIT RI PT TBK CV RP USD IDR UU PP NO ID CO COM TV DR SH MH PJ SE MM II III IV VI AKBP KOMBES REL CPO UMKM SDM BUMN PDB KBLI DPR MPR BPS BI OJK "
    "JAKARTA SURABAYA BANDUNG MEDAN AMBON SEMARANG BADUNG BALI SUMUT ACEH ANTARA KOMPAS DETIK CNBC CNN TRIBUNNEWS KONTAN PROHABA SINDO JENDELASERAM RADARBANJARMASIN SUMUTPOS"
).split()
ORGANISATION = r"(?=[ABDFGHIMP])(?<![\p{L}\p{N}_])(?:Asosiasi|Perkumpulan|Gabungan|Himpunan|Federasi|Ikatan|Direktorat(?:\s+Jenderal)?|Mahkamah|Majelis|Badan)\s+(?:[A-Z][A-Za-z0-9.-]+(?:\s+(?:dan|of|untuk)?\s*[A-Z][A-Za-z0-9.-]+){0,4})"
PLACE = r"(?=[KPW])(?<![\p{L}\p{N}_])(?:Kabupaten|Kota|Provinsi|Wilayah|Kawasan)\s+([A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,2})"
PLACES = "sbt maluku sumut aceh meranti riau ntb surabaya semarang kendal bali badung sumsel bandung medan ambon".split()
NOT_PLACES = ("jakarta", "indonesia")
AMOUNT = r"(?i)(?=[runRUN\d])(?<![\p{L}\p{N}_])(?:rp\s*\d+(?:[.,]\d+)?\s*(?:juta|miliar|triliun)|usd\s*\d+(?:[.,]\d+)?\s*(?:juta|miliar|triliun)|\d+(?:[.,]\d+)?\s*(?:juta|miliar|triliun|persen|ton|gw|mw|ribu|orang|pekerja)|nomor\s+\d+(?:/[a-z0-9-]+)*)(?![\p{L}\p{N}_])"
SNIPPET_CHARS = 1200


def body_snippet(title: Column, body: Column) -> Column:
    """The first characters of a body without tags' entities, repeated blanks and a repeat of its title."""

    def cut(plain: Column, own: Column) -> Column:
        rest = F.regexp_replace(F.substring(plain, F.length(own) + 1, F.length(plain)), r"^[ \-–—:|]+|[ \-–—:|]+$", "")
        return F.left(F.when((own != "") & F.startswith(F.lower(plain), F.lower(own)), rest).otherwise(plain), F.lit(SNIPPET_CHARS))

    plain = F.trim(F.regexp_replace(unescape_html(F.coalesce(body, F.lit(""))), r"\s+", " "))
    return let(plain, lambda p: let(F.trim(F.coalesce(title, F.lit(""))), lambda own: cut(p, own)))


def body_entities(body: Column) -> Column:
    """struct(acronyms, orgs, places, numbers) of a body."""
    tidy = lambda found: F.array_distinct(F.transform(found, lambda x: F.lower(F.regexp_replace(F.trim(x), r"\s+", " "))))
    found = lambda pattern, group=0: F.regexp_extract_all(body, F.lit(pattern), group)
    capitals = F.array_except(F.array_distinct(found(r"(?=[A-Z])(?<![\p{L}\p{N}_])[A-Z]{2,10}(?![\p{L}\p{N}_])")), F.array(*map(F.lit, BOILERPLATE)))
    named = F.array_except(tidy(found(PLACE, 1)), F.array(*map(F.lit, NOT_PLACES)))
    known = F.array_intersect(F.regexp_extract_all(F.lower(body), F.lit("[a-z]+"), 0), F.array(*map(F.lit, PLACES)))
    return F.struct(capitals.alias("acronyms"), tidy(found(ORGANISATION)).alias("orgs"), F.array_union(named, known).alias("places"), tidy(found(AMOUNT)).alias("numbers"))


def char_ngrams(text: Column, sizes: tuple[int, ...] = (3, 4)) -> Column:
    """All character n-grams (with repeats) of the space-padded text."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))

    def grams(n: int) -> Column:
        all_ = F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)), lambda i: F.substring(padded, i, F.lit(n)))
        return F.when(F.length(padded) >= n, all_).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(grams, sizes))


def merge_keywords(*lists: Column, separator: str = ",") -> Column:
    """Ordered union of comma lists, ignoring case, with the first spelling."""
    parts = F.filter(F.transform(F.split(F.concat_ws(separator, *lists), separator), lambda x: F.trim(x)), lambda x: x != "")
    keep = lambda a, x: F.when(F.exists(a, lambda y: F.lower(y) == F.lower(x)), a).otherwise(F.array_append(a, x))
    return F.array_join(F.aggregate(parts, F.array().cast("array<string>"), keep), f"{separator} ")


def commodity(keyword: Column, title: Column) -> Column:
    text = F.lower(F.concat_ws(" ", F.coalesce(keyword, F.lit("")), F.coalesce(title, F.lit(""))))
    out = None
    for name, parts in COMMODITIES:
        test = text.rlike(escaped(parts))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(OTHER_COMMODITY)


def has_word(text: Column, words: list[str] | tuple[str, ...]) -> Column:
    """Whether one of the phrases occurs between non-word characters, ignoring case."""
    return F.lower(text).rlike(rf"(?<![{_EDGE}]){folded([w.lower() for w in words])}(?![{_EDGE}])")


def count_words(text: Column, words: list[str] | tuple[str, ...]) -> Column:
    """Occurrences of each phrase, summed; overlapping phrases count each."""
    return sum((F.regexp_count(F.lower(text), F.lit(rf"(?<![{_EDGE}]){escaped([w])}(?![{_EDGE}])")) for w in words), F.lit(0))


def or_query(keywords: Column) -> Column:
    """Comma list to a search expression of quoted alternatives."""
    parts = F.filter(F.transform(F.split(keywords, ","), lambda x: F.trim(x)), lambda x: x != "")
    quoted = F.transform(parts, lambda x: F.when(x.contains(" "), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x))
    return F.when(F.size(parts) > 1, F.concat(F.lit("("), F.array_join(quoted, " OR "), F.lit(")"))).otherwise(F.array_join(quoted, ""))


def decision_key(url: Column, stage: Column, version: Column, model: Column) -> Column:
    return F.sha2(F.concat_ws("|", url, stage, version, model), 256)


def title_case(title: Column) -> Column:
    """A title all in capitals (more than five letters) in title case."""
    letters = F.regexp_replace(title, r"[^\p{L}]", "")
    return F.when((F.length(letters) > 5) & (letters == F.upper(letters)), F.initcap(F.lower(title))).otherwise(title)


def suspiciously_short(body: Column, least: int = 300) -> Column:
    """Whether a text is there but too short for an article."""
    t = F.coalesce(body, F.lit(""))
    return (t != "") & (F.length(F.trim(t)) < least)
