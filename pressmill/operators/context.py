"""Keyword contexts: whether a keyword means the commodity, not a place, idiom, colour, name or brand; as Tests (see predicates)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.operators import values as v
from pressmill.operators.predicates import SPARK, Test, any_of, cascade, find, has, sql, word, words

# Fixed values that stand in one context each.
KARET_STRONG = ("hilirisasi", "apkarindo", "harga karet", "ekspor karet", "industri karet", "pabrik karet")
KARET_SEA = ("jam karet", "kapal", "km ", "tenggelam", "perahu")
KELAPA_SPAM = ("bet tunas kelapa", "situs resmi indonesia")
COKELAT_TITLES = ("amplop cokelat", "baju cokelat", "seragam cokelat", "celana cokelat")
SUSU_TEXTS = ("susu kecoa", "susu kecoak")
SUSU_TITLES = ("gigi susu", "gigi berlubang", "rekomendasi susu oat")
KOPI_CHILDREN = ("perkembangan anak", "pola asuh")


def pome(both: str = "_c") -> Test:
    return word(both, v.POME_REJECT_WORDS) | ~has(both, v.POME_INDUSTRY_WORDS)


def fame(both: str = "_c") -> Test:
    return has(both, v.FAME_EXCLUDE_PHRASES) | ~word(both, v.FAME_INDUSTRY_TERMS)


def mills(k: str = "_k") -> list[tuple[str, Test]]:
    """The contexts that no override lifts."""
    return [("pome_pomeranian_or_non_industrial", sql(f"{k} = 'pome'") & pome()), ("fame_non_industrial", sql(f"{k} = 'fame'") & fame())]


def contexts(t: str = "_t", both: str = "_c", raw: str = "_raw", k: str = "_k") -> list[tuple[str, Test]]:
    """(reason, test that the keyword means something else), in the order in which reasons are observable."""
    karet = word(both, v.KARET_INDUSTRY_TERMS)
    mentions, idioms = words(both, ("karet",)), sum_of(both, v.KARET_EXCLUDE_PHRASES)
    tests = [
        ("kertas_kerja_or_idiom", ("kertas",), has(t, v.KERTAS_EXCLUDE_PHRASES) | ~word(both, v.KERTAS_INDUSTRY_TERMS)),
        ("kelapa_location_or_spam", ("kelapa",), has(both, KELAPA_SPAM) | (has(both, v.KELAPA_EXCLUDE_PHRASES) & ~word(both, v.KELAPA_INDUSTRY_TERMS))),
        ("karet_idiom_or_marine", ("karet",), (has(both, v.KARET_EXCLUDE_PHRASES) & ~word(both, KARET_STRONG)) | (~karet & (has(t, KARET_SEA) | ((mentions > 0) & (mentions <= idioms))))),
        ("kakao_entertainment", ("kakao",), has(both, v.KAKAO_EXCLUDE_PHRASES) & ~word(both, v.KAKAO_INDUSTRY_TERMS)),
        ("cokelat_color_or_envelope", ("cokelat",), has(t, COKELAT_TITLES) | (has(both, v.COKELAT_EXCLUDE_PHRASES) & ~word(both, v.COKELAT_INDUSTRY_TERMS))),
        ("pulp_fiction_or_pop_culture", ("pulp",), has(both, v.PULP_EXCLUDE_PHRASES) & ~word(both, v.PULP_INDUSTRY_TERMS)),
        ("tar_not_tobacco", ("tar",), ~word(both, v.TAR_INDUSTRY_TERMS)),
        ("teh_sundanese_honorific", ("teh",), has(t, v.TEH_EXCLUDE_TITLE_PHRASES) | (find(raw, (r"\bTeh\s+[A-Z][a-z]+",)) & ~word(both, v.TEH_INDUSTRY_TERMS))),
        ("susu_idiom_or_dental", ("susu",), any_of(has(t, v.SUSU_EXCLUDE_PHRASES), has(both, SUSU_TEXTS), has(t, SUSU_TITLES))),
        ("kopi_lifestyle_or_parenting", ("kopi",), has(t, v.KOPI_EXCLUDE_TITLE_PHRASES) | has(t, KOPI_CHILDREN)),
        ("sawit_location_duren_sawit", ("sawit", "minyak sawit"), has(both, v.SAWIT_EXCLUDE_PHRASES) & ~word(both, v.SAWIT_INDUSTRY_TERMS)),
    ]
    return [(reason, sql(f"{k} IN ({', '.join(repr(w) for w in keywords)})") & test) for reason, keywords, test in tests]


def sum_of(field: str, phrases: tuple[str, ...]):
    """Occurrences of each phrase, summed."""
    total = words(field, phrases[:1])
    for p in phrases[1:]:
        total = total + words(field, (p,))
    return total


def keyword_contexts(articles: DataFrame) -> DataFrame:
    """articles (title, text, url, source, keyword) with context_reason, null where the keyword may mean the commodity."""
    from pressmill.operators.screen import FIELDS, fields

    return fields(articles).withColumn("context_reason", F.expr(cascade(mills() + contexts(), SPARK))).drop(*FIELDS)


def tobacco_keywords(keywords: Column, title: Column, text: Column) -> Column:
    """Replace generic tobacco keywords by up to three specific ones; other keywords stay in front."""
    t, both = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.concat_ws(" ", title, text))
    parts = F.filter(F.transform(F.split(keywords, ","), lambda x: F.trim(x)), lambda x: x != "")
    generic = lambda x: F.lower(x).contains("rokok")
    rest = F.filter(parts, lambda x: ~generic(x))
    said = F.lower(F.coalesce(keywords, F.lit("")))
    electric = t.rlike("vapor|rokok sintetis|electric|elektrik.*rokok|rokok.*elektrik") | both.rlike("rokok elektri|rokok elektronik|vape|bnn.*narkotika|narkotika.*bnn") | said.rlike("elektrik|electric")
    excise = both.rlike("pita cukai|cukai rokok") | said.contains("tanpa pita cukai")
    illegal = t.rlike("djbc|bea cukai|gempur rokok") | both.rlike("rokok ilegal") | (both.rlike("bea cukai|djbc") & both.contains("rokok")) | said.contains("ilegal")
    specific = F.array_compact(F.array(F.when(electric, "bnn rokok elektrik"), F.when(excise, "rokok tanpa pita cukai"), F.when(illegal, "djbc rokok ilegal")))
    fallback = F.array(F.when(both.rlike("cukai|tarif"), "rokok tanpa pita cukai").when(both.contains("elektrik"), "bnn rokok elektrik").otherwise("djbc rokok ilegal"))
    named = F.when(F.size(specific) > 0, specific).otherwise(fallback)
    return F.when(F.exists(parts, generic), F.array_join(F.array_union(rest, named), ", ")).otherwise(keywords)
