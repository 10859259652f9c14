"""Literal cases: scalars, tone, issues, fuzzy ratios."""

import datetime

import pytest
from pyspark.sql import functions as F

from pressmill.functions import dates, fuzzy, text, url
from pressmill.operators import assignment, entities, issues, tone


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, want",
    [
        ('=HYPERLINK("http://www.ekonomi.bisnis.com/read/20261111/1/cpo/?utm_source=google&fbclid=XYZ&b=2&a=1", "Buka")', "https://ekonomi.bisnis.com/read/20261111/1/cpo?a=1&b=2"),
        ("https://ekonomi.bisnis.com/read/20261111/1/cpo?a=1&b=2&gclid=999", "https://ekonomi.bisnis.com/read/20261111/1/cpo?a=1&b=2"),
        ("https://youtu.be/AbC", "https://youtube.com/watch?v=AbC"),
        ("http://WWW.X.id:80//a//b/#top", "https://x.id/a/b"),
        ("http://x.id", "https://x.id/"),
        ("Not a URL/", "not a url"),
    ],
)
def test_canonical_url(spark, value, want):
    assert one(spark, value, url.canonical) == want


def test_scalars(spark):
    assert str(one(spark, "Sat, 07 Nov 2026 23:02:51 GMT", dates.to_wib)) == "2026-11-08 06:02:51"
    assert str(one(spark, "2026-11-08 08:00:00", dates.to_wib)) == "2026-11-08 08:00:00"
    assert one(spark, "garbage", dates.to_wib) is None
    assert one(spark, "Rabu, 7 Oktober 2026", dates.indonesian_date) == datetime.date(2026, 10, 7)
    assert one(spark, 278, dates.duration, "int") == "4m 38s"
    assert one(spark, "2026-11-05", lambda c: dates.short_display(F.to_date(c))) == "5 Nov 2026"
    assert one(spark, "KKP Jelaskan Perkembangan Susu Ikan &amp; Olahan Laut - kumparan.com", text.display_title) == "KKP Jelaskan Perkembangan Susu Ikan & Olahan Laut"
    same = {one(spark, f"Industri {x} Nasional", text.normalise_issue) for x in ("REL", "Rokok Elektronik", "Rokok Elektrik", "Vape")}
    assert len(same) == 1 and "rokok_elektronik" in same.pop()
    for keyword, want in (("kelapa sawit, cpo", "Kelapa Sawit & CPO"), ("rokok ilegal", "Hasil Tembakau"), ("makanan dan minuman", "Makanan & Minuman")):
        assert one(spark, keyword, lambda c: text.commodity(c, F.lit(""))) == want
    assert one(spark, "CPO, biodiesel,cpo", lambda c: text.merge_keywords(c, F.lit("Biodiesel,sagu"))) == "CPO, biodiesel, sagu"
    assert one(spark, "abc", text.char_ngrams) == [" ab", "abc", "bc ", " abc", "abc "]


def test_ratios():
    assert round(fuzzy.ratio("kitten", "sitting"), 2) == 61.54
    assert fuzzy.ratio("", "") == 100 and fuzzy.ratio("a", "") == 0
    assert fuzzy.token_set_ratio("a b c", "c b a d") == 100
    assert fuzzy.partial_ratio("abc", "xxabcxx") == 100


TONES = [
    ("Kemenperin Antisipasi Lonjakan Harga Gula Jelang Nataru", "", "Positif"),
    ("Menperin Resmikan Pabrik Baru di Kawasan Industri Kendal", "", "Positif"),
    ("Ekspor Karet Remah Indonesia 2024 Capai US$2,8 Miliar, Jepang Tujuan Utama", "", "Netral"),
    ("Harga CPO Tidak Naik Pekan Ini", "", "Netral"),
    ("SINTETIS Juru Bicara Kemenperin Tegaskan Komitmen Zona Integritas Bebas Korupsi", "Juru bicara Kemenperin menjelaskan program pencegahan gratifikasi di seluruh balai industri.", "Positif"),
    ("SINTETIS Asosiasi Manufaktur Apresiasi Kebijakan TKDN yang Terbukti Melindungi Pabrik Lokal", "Para pelaku industri menyatakan dukungan penuh dan memuji aturan TKDN karena mendorong investasi pabrik.", "Positif"),
    ("SINTETIS Pemprov Jawa Timur Buka Pameran UMKM Pangan Daerah", "Pameran digelar tiga hari. Puluhan stan tampil. Selain dinas daerah, perwakilan Kemenperin juga turut hadir.", "Netral"),
    ("SINTETIS Gabungan Asosiasi Kritik Pedas Kebijakan Kemenperin yang Dinilai Menghambat Industri", "Asosiasi pengusaha mengkritik dan menyalahkan Kemenperin atas aturan yang dianggap membebani pabrik domestik.", "Negatif"),
]


def test_tone(spark):
    df = spark.createDataFrame([(i, t, b) for i, (t, b, _) in enumerate(TONES)], "i int, t string, b string")
    got = {r["i"]: r["tone"] for r in tone.classify(df, 't', 'b', "''").collect()}
    assert [got[i] for i in range(len(TONES))] == [w for *_, w in TONES]


TITLES = {
    "re_1": "Industri Rokok Elektronik Minta Pemerintah Lindungi Tenaga Kerja",
    "re_2": "Industri Rokok Elektronik Minta Perlindungan Pemerintah, Soroti Nasib Pekerja",
    "re_3": "Pelaku Industri Rokok Elektronik Minta Pemerintah Lindungi Usaha dan Tenaga Kerja",
    "re_4": "Pelaku Usaha Rokok Elektrik Minta Pemerintah Lindungi Industri & Pekerja",
    "sw_1": "Ekspor Sawit RI Diproyeksi Turun hingga 5 Juta Ton Gegara El Nino hingga B50",
    "sw_3": "Sawit Dominasi Ekspor Sumut, Penerimaan Bea Keluar Lampaui Target Rp3 Triliun",
    "mk_1": "Sidang Larangan Vape Digelar 25 November, MK Akan Dengar Pengusaha, BNN, dan MUI",
}


@pytest.mark.parametrize("seed", [1, 42])
def test_issue_clusters(spark, seed):
    import random

    rows = list(TITLES.items())
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "id string, title string")
    got = {r["id"]: (r["isu_id"], r["isu"]) for r in assignment.cluster(issues.features(df, "id", "title", F.lit("2026-11-17").cast("date"), F.lit(""))).collect()}
    assert len({got[x] for x in ("re_1", "re_2", "re_3", "re_4")}) == 1
    assert len({got[x] for x in ("re_1", "sw_1", "sw_3", "mk_1")}) == 4


def test_first_two(spark):
    m = one(spark, "Putu Juli bertemu Menperin dan Faisol Riza", lambda c: entities.first_mentions(c, {"A": ("faisol riza",), "B": ("putu juli",), "C": ("menperin",)}))
    assert [x["name"] for x in m] == ["B", "C"]


def test_contexts(spark):
    from pressmill.operators import context

    cases = [
        ("Warga Duren Sawit gelar pasar murah", "", "sawit", "sawit_location_duren_sawit"),
        ("Ekspor sawit dari Duren Sawit", "industri sawit tumbuh", "sawit", None),
        ("LRT Kelapa Gading", "", "kelapa", "kelapa_location_or_spam"),
        ("Kertas kerja menteri", "industri kertas", "kertas", "kertas_kerja_or_idiom"),
        ("Teh Rina bernyanyi", "", "teh", "teh_sundanese_honorific"),
        ("Perahu karet tenggelam", "", "karet", "karet_idiom_or_marine"),
        ("Harga karet naik", "petani karet senang", "karet", None),
        ("Anjing pomeranian lucu", "", "pome", "pome_pomeranian_or_non_industrial"),
    ]
    df = spark.createDataFrame([(i, *c[:3], c[3]) for i, c in enumerate(cases)], "i int, title string, text string, keyword string, want string")
    got = context.keyword_contexts(df.withColumns({"url": F.lit(""), "source": F.lit("")})).collect()
    assert [(r["i"], r["context_reason"]) for r in got] == [(r["i"], r["want"]) for r in got]
    kw = df.limit(1).select(context.tobacco_keywords(F.lit("gula, rokok"), F.lit("Bea Cukai sita rokok ilegal"), F.lit("")).alias("k")).first()["k"]
    assert kw == "gula, djbc rokok ilegal"


def test_rubric_and_evergreen(spark):
    from pressmill.operators import recheck

    rows = [
        ("Apa itu CPO?", "", "https://a.id/x", "non_news_glossary (artikel glosarium/definisi 'Apa Itu')"),
        ("Kemenperin resmikan pabrik", "", "https://a.id/read/1", None),
        ("Kisah merek lama", "", "https://a.id/x", "non_news_evergreen_education (artikel kisah merek/edukasi tanpa peristiwa aktual)"),
        ("Sapi", "", "https://a.id/x.pdf", "Dokumen PDF (Bukan Berita)"),
        ("Harga sapi naik", "", "https://feedberry.com/x", "Aggregator Bot AI / Teks Rusak (feedberry.com)"),
        ("Harga sapi naik", "Ditjen IKMA hadir", "https://a.id/x", "Ranah Ditjen IKMA (Industri Kecil, Menengah, dan Aneka - Bukan Ditjen IA)"),
        ("Petani keluhkan harga sawit", "", "https://a.id/x", "Keluhan Petani Non-Tembakau (Hulu Pertanian/Perkebunan)"),
        ("Petani tembakau dan sawit mengeluh", "", "https://a.id/x", None),
        ("Kawasan industri halal", "", "https://a.id/x", None),
        ("Kawasan industri baru", "", "https://a.id/x", "Kebijakan Kawasan Industri Umum Non-IA (Ditjen KPAII)"),
        ("Agenda", "", "https://a.id/x", "Judul Generik / Kosong (Artifact Web)"),
        ("1234567", "", "https://a.id/x", "Judul Generik / Kosong (Artifact Web)"),
        ("Peran UMKM", "", "https://a.id/x", "Headline Memuat UMKM"),
        ("kawasan industri halal ", "", "https://a.id/x", "judul_sama"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, title string, text string, url string, want string").withColumns({"source": F.lit(""), "keyword": F.lit("")})
    assert [(r["i"], r["recheck_reason"]) for r in recheck.first_pass(df, "i").orderBy("i").collect()] == [(i, r[3]) for i, r in enumerate(rows)]
    labels = spark.createDataFrame([("RAGU", "Gapki bicara"), ("RAGU", "Dosen UGM menilai"), ("RAGU", "x"), ("hilir", "x")], "label string, title string").withColumn("text", F.lit(""))
    assert [r["rubric"] for r in recheck.rubric(labels).collect()] == ["HILIR", "BUKAN_HILIR", "RAGU", "HILIR"]


def test_screening_of_single_tests(spark):
    from pressmill.operators import screen
    from pressmill.operators.predicates import SPARK

    def judge(test, title, text=""):
        df = spark.createDataFrame([(title, text, "", "", "")], "title string, text string, url string, source string, keyword string")
        return screen.fields(df).select(F.expr(test.show(SPARK)).alias("x")).first()["x"]

    yes = {
        "structural_noise": ["Search - WA 0859 3970 0884 [[Hatiga Furniture]]...", "Jual Mebel WA 081234567890", "900+ Foto Biskuit Pictures, Gambar dan Background untuk Unduh Gratis", "Campaign - Bantu Wujudkan Renovasi Musholla", "SMK Negeri 1 Sarmi", "Tigersnus Zero Frosty Mint", "Modal Mendirikan Pabrik AMDK", "BCA Sekuritas", "Berita Terbaru Hari Ini - Kelapa", "BAB II", "62 Penerbitan obligasi"],
        "crime_noise": ["Densus 88 tangkap tiga terduga teroris di Sulteng", "Tabrakan Beruntun Truk Sawit", "Polsek Pangkalan Susu Giatkan Patroli Dialogis"],
        "agro_relevant": ["Petani sawit untung", "Ditjen industri agro bicara", "Batik dan sawit"],
        "engagement": ["Yuk share di kolom komentar!", "Gimana menurut kamu"],
        "local_enforcement": ["Satpol PP Surabaya segel toko penjual minuman beralkohol eceran"],
    }
    no = {
        "structural_noise": ["Pabrik Baru Dibuka Pukul 08.00 WIB Kemarin", "Presiden Resmikan Pabrik Biskuit", "SMK Negeri 1 Sarmi Gelar Pameran Olahan Sagu", "BCA Sekuritas catat laba", "Laba naik setelah penerbitan obligasi"],
        "crime_noise": ["Bea Cukai Sita 1 Juta Batang Rokok Ilegal di Kudus", "OJK dan Pemkab Kolaka Utara Bangun Ekosistem Kakao", "Harga naik"],
        "agro_relevant": ["Batik tulis", "Margot Robbie minum kopi", "Harga besi"],
        "engagement": ["Aturan Pasokan GKM Rafinasi"],
        "local_enforcement": ["Bea Cukai Musnahkan Rokok Ilegal dan Minuman Beralkohol", "DPRD Pasuruan Soroti Perlindungan Investasi Pabrik"],
    }
    for want, cases in ((True, yes), (False, no)):
        for name, titles in cases.items():
            for title in titles:
                assert judge(getattr(screen, name)(), title) is want, (name, title)
    assert judge(screen.crime_or_accident(), "Pencurian kabel") is True and judge(screen.crime_or_accident(), "Pencurian kabel", "pabrik dan ekspor") is False
    assert judge(screen.likely_relevant(), "Diet sehat") is False and judge(screen.likely_relevant(), "Diet industri") is True
    plain = [("Pelatihan petani TBS sawit di Riau", None), ("TBS Sawit Kaltim periode ini catat kenaikan", "farmgate_tbs_or_retail_price")]
    body = "Produksi sawit nasional naik dan ekspor sawit tumbuh. " * 10
    df = spark.createDataFrame([(t, body, "https://m.id/1", "Media", "sawit", w) for t, w in plain], "title string, text string, url string, source string, keyword string, want string")
    assert [r["discard_reason"] for r in screen.screen(df).collect()] == [w for _, w in plain]


def test_screen_reasons_in_order(spark):
    from pyspark.sql import functions as F

    from pressmill.operators.screen import screen

    body = "Produksi gula nasional naik dan ekspor gula tumbuh. " * 10
    cases = [
        ("Produksi gula naik", body, "https://m.id/a/1", "Media", "gula", None),
        ("Produksi gula naik", body, "https://m.id/a/1", "youtube", "gula", "youtube_disabled"),
        ("Jual mebel WA 081234567890", body, "https://m.id/a/2", "Media", "gula", "structural_noise"),
        ("SMK Negeri 4 Sarmi", body, "https://m.id/a/3", "Media", "gula", "structural_noise"),
        ("SMK Negeri 4 luncurkan gula cair", body, "https://m.id/a/3", "Media", "gula", None),
        ("Penerbitan obligasi perusahaan gula", body, "https://m.id/a/4", "Media", "gula", "structural_noise"),
        ("gula", "", "https://m.id/a/5", "Media", "gula", "placeholder_or_error_title"),
        ("Pasar gula", "pendek", "https://m.id/a/6", "Media", "gula", "empty_or_too_short"),
        ("Harga gula hari ini", body, "https://m.vn/a/7", "Media", "gula", "foreign_noise_domain"),
        ("Toko minol disegel satpol pp", body, "https://m.id/a/8", "Media", "gula", "local_retail_enforcement"),
        ("Pengawasan gula #shorts #a", body.replace("ekspor", ""), "https://m.id/a/9", "Media", "gula", "shorts_entertainment_noise"),
        ("Anjing pome lucu sekali", body, "https://m.id/a/10", "Media", "pome", "pome_pomeranian_or_non_industrial"),
        ("Produksi gula naik", body, "https://m.id/a/11", "Media", "sagu", "keyword_not_primary_topic"),
        (None, None, None, None, None, "placeholder_or_error_title"),
    ]
    df = spark.createDataFrame([(i, *c[:5]) for i, c in enumerate(cases)], "i long, title string, text string, url string, source string, keyword string")
    got = {r["i"]: r["discard_reason"] for r in screen(df).collect()}
    assert {i: got[i] for i in got} == {i: c[5] for i, c in enumerate(cases)}
    assert screen(df, accept=F.lit(True)).filter("discard_reason is not null").count() == 0


def test_unnegated_against_brute_force(spark):
    import random
    import re

    from pressmill.operators.predicates import SPARK

    def negated(low, at):
        window = " ".join(low[:at].strip().split()[-3:])
        return any(re.search(rf"\b{re.escape(n)}\b", window) for n in tone.NEGATORS)

    cues, rng = ("korupsi", "dinilai gagal", "lamban"), random.Random(3)
    parts = ["tidak", "bebas dari", "korupsi", "dinilai gagal", "lamban", "sapi", "(korupsi)", "tak-", "belum,", "  ", "korupsinya", ". ", "\n", "bebas  dari"]
    texts = [rng.choice(["", " "]).join([" ".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))]) for _ in range(1500)] + ["tidak korupsi korupsi", "tidak a b korupsi", "tidak a b c korupsi", "tidak 'korupsi'"]
    want = [any(not negated(t, m.start()) for c in cues for m in re.finditer(rf"\b{c}\b", t)) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, x string")
    got = [r["y"] for r in df.select("i", F.expr(tone.unnegated("x", cues).show(SPARK)).alias("y")).orderBy("i").collect()]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_officials_like_an_alias(spark):
    aliases = {"Agus Gumiwang": ("agus gumiwang",), "Wakil": ("wamenperin",), "Dyan Garneta": ("dyan garneta",)}
    cases = [("Agus Gumiwang bicara", "Agus Gumiwang", "-"), ("agus gumiwnag dan Wamenperin", "Agus Gumiwang", "Wakil"), ("Menperin hadir", "-", "-"), ("dan greta", "-", "-"), ("Dyan Garnetta lalu agus gumiwang", "Dyan Garneta", "Agus Gumiwang"), (None, "-", "-"), ("", "-", "-")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i long, x string")
    got = entities.fuzzy_spokespersons(df, F.col("x"), aliases, {"Wakil": "W"}).orderBy("i").collect()
    assert [(r["spokesperson_1"], r["spokesperson_2"]) for r in got] == [c[1:] for c in cases]
    assert [r["n"] for r in df.select("i", entities.names_someone(F.col("x"), aliases).alias("n")).orderBy("i").collect()] == [c[1] != "-" for c in cases]


def test_intake(spark):
    import datetime

    from pressmill.operators import intake

    day = datetime.date(2026, 1, 2)
    assert intake.date_range(None, day) == (datetime.date(2026, 1, 1),) * 2
    for text in ("2025-01-01:2025-02-01", "2025-01-01_sd_2025-02-01", "2025-01-01..2025-02-01", "2025-01-01 to 2025-02-01", "2025-01-01 - 2025-02-01"):
        assert intake.date_range(text, day) == (datetime.date(2025, 1, 1), datetime.date(2025, 2, 1))
    assert one(spark, '("gula" OR "industri gula")', intake.single_word) is True and one(spark, '("industri gula" OR "gula")', intake.single_word) is False
    rows = spark.createDataFrame([("Eko S.A.  Cahyanto", "S"), ("Taufiek Bawazier", "x"), ("M. Rum", None)], "nama string, unit_eselon string")
    got = {r["nama"]: (r["unit_eselon"], r["aliases"]) for r in intake.official_aliases(rows).collect()}
    assert got == {"Eko S.A. Cahyanto": ("S", ["eko s.a. cahyanto", "eko sa cahyanto", "eko cahyanto", "eko s.a."]), "M. Rum": ("-", ["m. rum", "m rum"])}
    hits = spark.createDataFrame([(1, "Harga gula naik - M", "https://a.id/1", "M"), (2, "Diet sehat - M", "https://a.id/2", "M"), (3, "Harga gula naik", "https://tokopedia.com/3", "M"), (4, "Harga gula naik lagi", "https://a.id/1", "M")], "pos long, title string, link string, media string")
    assert [(r["pos"], r["title"]) for r in intake.search_hits(hits, "pos").collect()] == [(1, "Harga gula naik")]


def test_body_gate_against_brute_force(spark):
    import math

    from pressmill.operators import issues

    say = lambda *w: " ".join(w)
    texts = {
        "a0": ("Judul satu", say("GAPKI", "menyatakan ekspor naik lima persen di Kota Medan setelah pertemuan panjang bersama pelaku usaha daerah, 12 ton")),
        "a1": ("Judul dua", "Pendek"),
        "a2": ("Judul tiga", say("Cuaca cerah di pegunungan utara membuat pendaki gembira sepanjang akhir pekan kemarin")),
        "i0": ("Rilis x", say("GAPKI", "menyatakan ekspor naik lima persen di Kota Medan setelah rapat tertutup bersama asosiasi petani, 12 ton")),
        "i1": ("Rilis y", say("Musim hujan membuat jalan licin dan pengendara melambat sepanjang pagi kemarin")),
    }
    df = spark.createDataFrame([(k, t, b) for k, (t, b) in texts.items()], "id string, title string, text string")
    side = lambda x: issues.bodies(df.filter(F.col("id").startswith(x)), "id", "title", F.col("text"))
    left, right = side("a"), side("i")
    pairs = spark.createDataFrame([(a, b, 0.1) for a in texts if a[0] == "a" for b in texts if b[0] == "i"], "a string, b string, score double")
    rows = {r["id"]: r for r in left.unionByName(right).collect()}
    long_ = [r for r in rows.values() if r["chars"] >= 40]
    count = lambda t: sum(t in r["toks"] for r in long_)
    weight = lambda t: math.log((len(long_) + 1) / (count(t) + 1)) + 1
    for r in issues.body_signals(pairs, left, right).withColumn("gated", issues.settled(F.col("score"), F.lit(issues.GATED), F.lit(None).cast("int"), F.when(F.col("body_eligible"), F.col("body_cosine")))).collect():
        x, y = rows[r["a"]], rows[r["b"]]
        cosine = held = 0
        if x["chars"] >= 40 and y["chars"] >= 40:
            norm = lambda z: math.sqrt(sum(weight(t) ** 2 for t in z["toks"]))
            cosine = sum(weight(t) ** 2 for t in set(x["toks"]) & set(y["toks"])) / (norm(x) * norm(y))
            both = lambda c: len(set(x[c]) & set(y[c]))
            held = max(both("acrs"), both("orgs")) + both("places") + both("nums")
        ok = cosine >= 0.45 or (held >= 2 and cosine >= 0.25)
        assert abs(r["body_cosine"] - cosine) < 1e-9 and r["body_entities"] == held and r["body_eligible"] == ok
        assert abs(r["gated"] - (round(max(0.36, min(0.41, 0.36 + 0.05 * cosine)), 4) if ok else 0.1)) < 1e-9
    first = next(r for r in issues.body_signals(pairs, left, right).collect() if (r["a"], r["b"]) == ("a0", "i0"))
    assert first["body_eligible"] and first["body_entities"] >= 3


def test_passing_mentions_end_at_a_border(spark):
    rows = [(0, "Kemenperin turut hadirkan produk lokal"), (1, "Nama Kemenperin disebut dalam pameran"), (2, "Kemenperin turut hadir dalam pameran"), (3, "Nama Kemenperin ikut di daftar")]
    got = {r["id"]: r["hubungan"] for r in tone.classify(spark.createDataFrame(rows, "id int, title string").selectExpr("*", "'' AS text", "'' AS keyword"), "title", "text", "keyword").collect()}
    assert got == {0: "K1", 1: "K1", 2: "K2", 3: "K2"}


def test_titles_without_their_medium(spark):
    cases = {
        "Ekspor CPO Naik - FORTUNE Indonesia": "Ekspor CPO Naik",
        "Harga &amp; Pasar Kakao | Harian Jogja ": "Harga & Pasar Kakao",
        "Pabrik Gula Baru Diresmikan - Tempo.co": "Pabrik Gula Baru Diresmikan",
        "Pabrik Gula Baru Diresmikan | Suara Rakyat": "Pabrik Gula Baru Diresmikan",
        "Pendek saja | Suara Rakyat": "Pendek saja | Suara Rakyat",
        "Pabrik Gula Baru Diresmikan - Suara Rakyat": "Pabrik Gula Baru Diresmikan - Suara Rakyat",
        "Pabrik Gula Baru Diresmikan - Jatim Pos": "Pabrik Gula Baru Diresmikan",
        "Pabrik Gula Baru Diresmikan - berita online dari lima kota besar": "Pabrik Gula Baru Diresmikan - berita online dari lima kota besar",
        "Nasib Petani Digadang-gadang Membaik": "Nasib Petani Digadang-gadang Membaik",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["d"] for r in df.select("t", text.display_title(F.col("t")).alias("d")).collect()} == cases


def test_amounts_and_days_of_titles(spark):
    cases = {
        "Pameran 7 Oktober 2026 di Jakarta": ("pameran 7 oktober 2026 di jakarta", {"7 oktober", "2026"}),
        "Nilai US$ 1,5 Juta dan Rp2.5 Triliun": ("nilai usd 1_5 juta dan rp 2_5 triliun", {"usd 1_5 juta", "rp 2_5 triliun"}),
        "Naik 1,48 Persen": ("naik 1 48 persen", {"48 persen"}),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("n", text.normalise_issue(F.col("t")))
    assert {r["t"]: (r["n"], set(r["e"]["numbers"])) for r in df.withColumn("e", text.entities(F.col("n"))).collect()} == cases


def test_negative_sheet_uses_each_summary_once(spark):
    from pressmill.operators import publish

    articles = [("u1", "A", "Negatif"), ("u1", "A", "Negatif"), ("u2", "B", "Negatif"), ("u3", "b ", "Negatif"), ("u4", "C", "Netral"), (None, "D", "Negatif"), ("u9", None, "Negatif")]
    summaries = [("u1", "x", "s1"), ("", "B", "s2"), ("u3", "zz", "s3"), ("u7", "D", "s4"), ("u8", "D", "s5")]
    df = spark.createDataFrame(articles, "link string, title string, tone string")
    got = publish.negative_sheet(df, spark.createDataFrame(summaries, "link string, title string, summary string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("u1", "A", "s1"), ("u1", "A", "-"), ("u2", "B", "s2"), ("u3", "b ", "s3"), (None, "D", "s4"), ("u9", None, "-")], key=repr)


def test_search_matches(spark):
    from pressmill.operators import registry

    articles = [(1, "Pabrik Gula Baru Diresmikan di Jawa - Suara", "Suara", "https://www.suara.id/x"), (2, "Gula Naik", None, None), (3, "", "Suara", "https://suara.id"), (4, "Pabrik gula baru diresmikan hari ini", None, "https://news.google.com/a"), (5, "Harga kakao naik", "", "https://kakao.id")]
    results = [
        (1, 0, "Pabrik gula baru resmi di Jawa", "https://m.suara.id/read/1"), (1, 1, "Pabrik Gula Baru Diresmikan di Jawa - Suara", "https://news.suara.id/read/2"), (1, 2, "Pabrik Gula Baru Diresmikan di Jawa", "https://suara.id/read/3"), (1, 3, "Pabrik Gula Baru Diresmikan di Jawa", "not an address"),
        (2, 0, "Gula Naik Lagi Menjelang Hari Raya di Seluruh Pasar", "https://a.id/read/1"),  # contained, but the own title is short
        (3, 0, "Pabrik", "https://suara.id/read/9"),
        (4, 0, "Di Jawa pabrik gula baru diresmikan hari ini oleh menteri", "https://b.id/read/1"), (4, 1, "Pabrik gula tua ditutup", "https://b.id/read/2"),
        (5, 0, "Harga kopi turun tajam", "https://kakao.id/read/1"), (5, 1, None, "https://kakao.id/read/2"),
    ]
    got = registry.search_matches(spark.createDataFrame(articles, "id int, title string, media string, source_url string"), spark.createDataFrame(results, "id int, pos int, title string, url string"))
    assert {r["id"]: r["url"] for r in got.collect()} == {1: "https://news.suara.id/read/2", 4: "https://b.id/read/1"}


def test_review_sample_fills_its_places(spark):
    from pressmill.operators import registry

    kinds = [("rilis", 0.9)] * 3 + [("klaster", 0.3)] * 30 + [("klaster", 0.5)] * 2 + [("klaster", 0.8)] * 9
    rows = [(f"x{i}", i, "r" if k == "rilis" else "many", k, s) for i, (k, s) in enumerate(kinds)] + [(f"s{i}", 100 + i, f"only{i}", "klaster", 1.0) for i in range(20)] + [("art_5", 200, "many", "klaster", 0.9), ("art_24", 201, "many", "klaster", 0.9), ("x0", 300, "r", "rilis", 0.9)]
    df = spark.createDataFrame(rows, "id string, pos long, isu_id string, sumber_isu string, skor_isu double")
    got = [(r["bucket"], r["id"]) for r in registry.review_sample(df).collect()]
    want = [(0, "art_5")] + [(1, f"x{i}") for i in range(3)] + [(2, f"x{i}") for i in range(3, 18)] + [(3, "x33"), (3, "x34")] + [(4, f"x{i}") for i in range(35, 44)] + [(4, "art_24")] + [(5, f"x{i}") for i in range(18, 33)]
    assert got == want + [(6, f"s{i}") for i in range(60 - len(want))]
    assert len(registry.review_sample(df, most=10).collect()) == 10 and registry.review_sample(df.limit(0)).count() == 0


def test_grounded_parties(spark):
    from pressmill.operators import registry

    rows = [
        (1, "Harga gula naik", "Menteri Agus Gumiwan menyebut 15 pabrik tutup sejak 2024.", ["Agus Gumiwang", " ", "Faisol Riza", "HARGA GULA"], "15 pabrik pada 2024, 7 lainnya"),
        (2, None, None, None, "12 pabrik"),
        (3, "Judul", "", ["Judul"], None),
    ]
    got = registry.grounded(spark.createDataFrame(rows, "id int, title string, text string, parties array<string>, facts string")).collect()
    assert {r["id"]: (r["parties_kept"], r["parties_dropped"], r["needs_check"]) for r in got} == {1: (["Agus Gumiwang", "HARGA GULA"], 1, False), 2: ([], 0, True), 3: (["Judul"], 0, False)}
