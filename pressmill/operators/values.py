"""Fixed values of the screening: word lists and patterns, whole and in order. Patterns are for lower-case text."""

from __future__ import annotations

# Fixed values.
INDUSTRY_CONTEXT_WORDS = (
    "industri", "ekspor", "impor", "produksi", "pabrik", "kemenperin", "kementerian", "perdagangan", "komoditas", "investasi", "harga", "ton", "kuintal",
    "petani", "perkebunan", "swasembada", "giling", "rendemen", "tebu",
)
HEALTH_LIFESTYLE_WORDS = (
    "gula darah", "diabetes", "kalori", "diet", "kesehatan tubuh", "manfaat", "efek samping", "penyakit", "gejala", "kolesterol", "behel", "kawat gigi",
    "skors", "gigi berlubang",
)
RECIPE_WORDS = (
    "resep", "bahan-bahan", "cara membuat", "cara memasak", "sendok teh", "sendok makan", "bumbu halus", "adonan", "kukus", "panggang", "tumis",
    "tips membuat", "cara seduh", "tips memasak",
)
PROMO_WORDS = (
    "syarat dan ketentuan", "syarat & ketentuan", "periode promo", "dapatkan", "diskon", "supermarket", "minimal pembelian", "minimum transaksi",
    "cashback", "voucher", "katalog promo", "harga promo", "promo bca", "promo", "katalog", "brosur", "promo mingguan", "promo ssr", "promo jsm",
)
SOCIAL_MEDIA_ENGAGEMENT_PATTERNS = (
    r"\bshare\s+di\s+kolom\s+komentar\b", r"\btulis\s+di\s+kolom\s+komentar\b", r"\btulis\s+komentar(mu| kalian| sobat)?\b", r"\bkomen\s+di\s+bawah\b",
    r"\bkomentar\s+di\s+bawah\b", r"\btinggalkan\s+komentar\b", r"\bmenurut\s+(kamu|mu|kalian|sobat)\b",
    r"\bgimana\s+menurut\s+(kamu|mu|kalian|sobat)\b", r"\bbagaimana\s+menurut\s+(kamu|mu|kalian|sobat)\b", r"\bshare\s+pendapat(mu| kalian| sobat)?\b",
    r"\byuk\s+share\b", r"\bshare.*yuk\b", r"\bjangan\s+lupa\s+(like|subscribe)\b",
)
AGGREGATOR_PLACEHOLDER_PREFIXES = (
    r"^berita\s+(terbaru|terkini|hari\s+ini)(\s+hari\s+ini)?\s*[-–—:]\s*", r"^berita\s+.*terbaru\s+hari\s+ini\b", r"^berita\s+.*terkini\s+hari\s+ini\b",
    r"^(kumpulan\s+berita|berita\s+dan\s+informasi)\b", r"^(tag|topik|indeks\s+berita)\s*[-–—:]\s*",
)
DONATION_CAMPAIGN_PATTERNS = (
    r"^campaign\s*[-–—:]",
    r"\b(galang\s+dana|penggalangan\s+dana|donasi\s+online|bantu\s+wujudkan|patungan\s+untuk|sedekah\s+subuh|sedekah\s+jariyah|wakaf\s+produktif)\b",
    r"\b(kitabisa|amalsholeh|ayobantu|rumahzakat|dompetdhuafa|wecare\.id)\b",
    r"\b(sedekah|infaq|zakat|donasi)\s+(untuk\s+pembangunan|musholla|masjid|yatim|dhuafa|pesantren)\b",
    r"\b(bantu\s+renovasi|renovasi\s+musholla|pembangunan\s+musholla|pembangunan\s+masjid)\b",
)
EDUCATIONAL_JOURNALISTIC_VERBS = (
    "resmikan", "meresmikan", "gelar", "menggelar", "adakan", "mengadakan", "umumkan", "mengumumkan", "raih", "meraih", "juara", "kunjungi",
    "mengunjungi", "lepas", "melepas", "teken", "tandatangani", "menandatangani", "terima", "menerima", "buka", "membuka", "luncurkan", "meluncurkan",
    "ciptakan", "menciptakan", "inovasi", "kembangkan", "kolaborasi", "kerjasama", "kerja sama", "bantu", "dukung", "dorong", "siapkan", "tinjau",
    "meninjau", "panen", "produksi", "pamerkan", "wisuda", "workshop", "pelatihan", "sosialisasi", "seminar", "gagas", "rilis", "pameran", "capai",
    "mencapai",
)
_UMKM_HEADLINE_PATTERNS = (
    r"\b(?:umkm|ukm)\b", r"\busaha\s+mikro(?:\s*(?:dan|&|,)?\s*kecil)?\b",
)
LOCAL_RETAIL_WELFARE_PATTERNS = (
    r"\b(?:trusted\s+(&|dan)?\s+popular\s+brand\s+awards?|brand\s+awards?|penghargaan\s+merek)\b",
    r"\b(?:terima\s+)?blt\s+(?:cukai|dbhcht|dana\s+bagi\s+hasil|tembakau)\b", r"\bzakat\s+produktif\b", r"\bjual\s+[\d.,]+\s+gelas\b",
    r"\bkopi\s+kenangan\s+dongkrak\b", r"\bsatu\s+set\s+dibanderol\b", r"\bdibanderol\s+mulai\s+rp\b", r"\bsentra\s+mebel\s+manongkoki\b",
    r"\bkerupuk\s+citra\b", r"\b(?:pulau\s+)?enggano\b", r"\bsultan\s+b\.?\s+najamuddin\b",
)
RETAIL_PROMO_PATTERNS = (
    r"\bsyarat\s+dan\s+ketentuan\b", r"\bsyarat\s*&\s*ketentuan\b", r"\bs&k\s+berlaku\b", r"\bperiode\s+promo\b", r"\bdiskon\b", r"\bsupermarket\b",
    r"\bminimarket\b", r"\bhypermarket\b", r"\bminimal\s+pembelian\b", r"\bminimum\s+transaksi\b", r"\bcashback\b", r"\bvoucher\b",
    r"\bkatalog\s+promo\b", r"\bharga\s+promo\b", r"\bpromo\s+bca\b", r"\bpromo\s+mingguan\b", r"\bpromo\s+ssr\b", r"\bpromo\s+jsm\b",
    r"\bbeli\s+1\s+gratis\s+1\b", r"\bbeli\s+2\s+gratis\s+1\b", r"\bpotongan\s+harga\b", r"\bkupon\s+belanja\b", r"\btoko\s+alat\s+rumah\s+tangga\b",
    r"^(toko|grosir|distributor)\s+.*\b(murah|terlengkap|terdekat|diskon)\b",
)
OFFICIAL_EVENT_PATTERNS = (
    r"\bfi\s+asia\b", r"\bfood\s+ingredients\s+asia\b", r"\btrade\s+expo\b", r"\btei\b", r"\bsial\s+interfood\b", r"\binterfood\b",
    r"\bfood\s*&\s*hotel\b", r"\bfhi\b", r"\ballpack\b", r"\biffina\b", r"\bindo\s+livestock\b", r"\bagrinex\b", r"\bpameran\b", r"\bexpo\b",
    r"\bexhibition\b",
)
BRAND_EVENT_ACTION_PATTERNS = (
    r"\b(hadir\s+di|hadir\s+dalam)\b", r"\b(perkenalkan|memperkenalkan)\b", r"\b(pamerkan|memamerkan)\b", r"\b(tampilkan|menampilkan)\b",
    r"\b(unjuk\s+gigi\s+di)\b", r"\b(ramaikan|meramaikan)\b", r"\b(berpartisipasi\s+di|berpartisipasi\s+dalam|partisipasi\s+di|partisipasi\s+dalam)\b",
    r"\b(ikut\s+serta\s+di|ikut\s+serta\s+dalam)\b", r"\b(luncurkan|meluncurkan)\b",
)
JOB_TITLE_KEYWORDS = (
    "lowongan", "loker", "dibutuhkan", "we are hiring", "open recruitment", "job vacancy", "buka lowongan", "pelamar kerja", "drafter",
    "quality control", "workshop furniture", "marketing furniture", "staff admin", "graphic design",
)
JOB_CONTENT_KEYWORDS = (
    "kualifikasi:", "persyaratan:", "job description", "deskripsi pekerjaan", "tanggung jawab pekerjaan", "rentang gaji", "kirim cv", "lamar pekerjaan",
    "apply now", "cara melamar",
)
CRITICAL_INCIDENT_TITLE_PHRASES = (
    "meninggal dunia", "ditemukan tewas", "tewas", "mayat", "pembunuhan", "diserang beruang", "diterkam buaya", "diserang buaya", "kebakaran lahan",
    "pemadaman", "laka lantas", "kecelakaan maut", "kecelakaan fatal", "tabrakan beruntun", "tabrakan", "orang hilang", "serangan jantung",
    "bakar lahan", "membakar lahan", "karhutla", "diterkam", "meninggal", "gantung diri", "bunuh diri", "densus 88", "terduga teroris", "teroris",
    "giro kosong", "bilyet giro kosong",
)
CRIME_ACCIDENT_TITLE_KEYWORDS = (
    "bobol", "pembobolan", "curi", "mencuri", "pencurian", "residivis", "maling", "perampokan", "rampok", "kebakaran", "korban", "pembunuhan", "mayat",
    "laka lantas", "tewas", "teroris", "ditangkap", "dibekuk", "diringkus", "tabrakan",
)
CELEBRITY_TITLE_KEYWORDS = (
    "ji chang-wook", "aktor korea", "artis korea", "drakor", "k-pop", "konser", "lirik lagu", "chord gitar", "kunci gitar", "makna lagu", "viral tiktok",
    "ig nobel", "minidrama", "mini drama", "sinetron", "film pendek", "trailer", "teaser", "webseries", "betrand peto", "karaoke betrand", "ruben onsu",
    "sarwendah",
)
CRIME_ACCIDENT_PHRASES = (
    "puntung rokok", "dilalap api", "kobaran api", "densus 88", "terduga teroris", "tabrakan beruntun", "kecelakaan maut", "kecelakaan fatal",
    "laka lantas", "truk terbalik", "truk terguling", "korban tewas", "meninggal dunia", "ditemukan tewas", "bunuh diri", "habisi pelajar",
    "habisi nyawa", "buang jasad", "pelaku nekat", "polisi amankan ibadah", "bhabinkamtibmas", "naik penyidikan", "patroli dialogis", "jumat curhat",
    "cipta kondisi", "operasi cipta kondisi", "razia miras", "botol miras", "miras ilegal", "beasiswa sawit", "toko miras", "faktor kasus kriminal",
    "polwan sapa", "giro kosong", "bilyet giro kosong", "bilyet giro", "ular piton", "ular kobra", "teror ular", "diserang buaya", "diterkam buaya",
    "diserang beruang", "penunggu kebun",
)
CRIME_ACCIDENT_SINGLE_WORDS = (
    "kebakaran", "terbakar", "hangus", "curi", "pencuri", "pencurian", "maling", "rampok", "perampokan", "bobol", "pembobolan", "digerebek", "gerebek",
    "penggerebekan", "sabu", "narkoba", "narkotika", "ganja", "ekstasi", "ditangkap", "tertangkap", "tangkap", "diamankan", "dibekuk", "diringkus",
    "terciduk", "tersangka", "residivis", "buronan", "teroris", "terorisme", "radikalisme", "tabrakan", "kecelakaan", "menabrak", "ditabrak", "tewas",
    "mayat", "pembunuhan", "penipuan", "penggelapan", "hantu", "polsek", "polresta", "polres", "kamtibmas", "brimob",
)
POLICY_INSTITUTION_TITLE_SIGNALS = (
    "kemenperin", "kementerian perindustrian", "menperin", "wamenperin", "ditjen agro", "menteri perindustrian", "kebijakan", "regulasi", "ekspor",
    "impor", "produksi nasional", "investasi", "hilirisasi",
)
NON_ARTICLE_TITLE_PATTERNS = (
    r"^\s*(bab|chapter)\s+([ivxlcdm]+|\d+)\b", r"\btemplate\b",
    r"^\s*(daftar\s+isi|daftar\s+tabel|daftar\s+gambar|daftar\s+pustaka|lembar\s+pengesahan|kata\s+pengantar|halaman\s+judul|lampiran)\b",
    r"^\s*(abstrak|abstract)\b", r"\b(ijccs|ijccs-style)\b", r"\blaporan\s+magang\b", r"\bbuku\s+karya\s+ilmiah\b", r"\bbuku\s+tulis\b",
    r"\bjurnal\s+ilmiah\s+kesehatan\b", r"\bkejadian\s+ispa\b", r"\bstudi\s+kasus\s+pada\s+konsumen\b", r"\bjenis\s+packing\s+agar\s+barang\s+aman\b",
)
GENERIC_PLACEHOLDER_TITLES = (
    "resource discovery", "untitled", "no title", "error", "404 not found", "access denied", "blocked", "document", "halaman tidak ditemukan",
    "search results", "katalog induk", "informasi paket", "garba rujukan digital", "index", "home", "beranda", "loading", "sipp", "das kelapa",
    "daftar umkm", "pencarian data umkm", "icgab 2026", "proyek tunggal", "simponi sumut", "kelapaaa", "pecinta kopi", "berita terbaru hari ini",
    "berita terkini", "berita hari ini", "kumpulan berita", "indeks berita", "berita dan informasi",
)
NON_NEWS_DOMAINS = (
    "order.lottemart.co.id", "tiket.com", "chandrakarya.com", "jadesta.kemenpar.go.id", "eorder-bppbj.jakarta.go.id", "jobrapido.com", "confbeam.org",
    "hidrologi.net", "data-umkm.babelprov.go.id", "nimbuflyk.digital", "simponisumut.sumutprov.go.id", "pustaka.badanpangan.go.id", "spse.inaproc.id",
    "garuda.kemdiktisaintek.go.id", "katalog.kemendikdasmen.go.id", "sipp.pn-", "siplah.", "repository.", "repositori.", "multidisipliner.org",
    "kailogistik.id", "inviro.co.id", "saka.co.id", "tipsytales.id", "jdih.", "databoks.katadata.co.id", "papeda.ambon.go.id",
)
RETAIL_ENFORCEMENT_SIGNALS = (
    "satpol pp", "disegel", "penyegelan", "raperda", "ranperda", "moratorium izin", "moratorium perizinan", "moratorium rhu", "ketenagakerjaan",
    "pengawasan usaha karaoke", "usaha karaoke", "izin usaha", "penertiban minol", "penertiban miras", "riuh malam", "diskotek baru", "pembatasan miras",
    "pengendalian miras",
)
RETAIL_INDUSTRY_EXCEPTIONS = (
    "pabrik", "fasilitas produksi", "kapasitas produksi", "hilirisasi", "ekspor", "impor", "kemenperin", "kementerian perindustrian", "ditjen agro",
    "investasi", "kawasan industri",
)
SHORTS_ENTERTAINMENT_PATTERNS = (
    r"#shorts\b", r"#fyp\b", r"#viral\b", r"#trending\b", r"#shortvideo\b", r"#short\b", r"#reels\b", r"#tiktok\b",
)
FORMAL_NEWS_INSTITUTIONS_MEDIA = (
    "kemenperin", "kementerian", "ditjen", "dinas", "bps", "ojk", "bi", "presiden", "wapres", "menteri", "menperin", "wamenperin", "dirjen", "antara",
    "kompas", "detik", "tempo", "kontan", "bisnis.com", "tribun", "republika", "liputan6", "suara.com", "metrotv", "kompastv", "tvone", "cnn", "cnbc",
    "inews", "rri", "tvri", "bumn", "ptpn", "holding",
)
JOURNALISTIC_VERBS = (
    "resmikan", "meresmikan", "umumkan", "mengumumkan", "laporkan", "melaporkan", "capai", "mencapai", "targetkan", "menargetkan", "tegaskan",
    "menegaskan", "dorong", "mendorong", "tinjau", "meninjau", "luncurkan", "meluncurkan", "gelar", "menggelar", "buka", "membuka", "bahas", "soroti",
    "ungkap", "paparkan", "beberkan", "catat", "mencatat", "tumbuh", "meningkat", "anjlok", "turun", "ekspor", "impor", "investasi", "hilirisasi",
    "produksi",
)
SAWIT_EXCLUDE_PHRASES = (
    "duren sawit", "kecamatan duren sawit", "kelurahan duren sawit", "polsek duren sawit",
)
SAWIT_INDUSTRY_TERMS = (
    "kelapa sawit", "minyak sawit", "perkebunan sawit", "kebun sawit", "cpo", "tbs", "tandan buah segar", "petani sawit", "industri sawit",
    "pabrik sawit", "ekspor sawit", "hilirisasi sawit", "bpdpks", "gapki", "sawit rakyat",
)
PULP_EXCLUDE_PHRASES = (
    "pulp fiction",
)
PULP_INDUSTRY_TERMS = (
    "pabrik pulp", "industri pulp", "bubur kertas", "kayu pulp", "produksi pulp", "ekspor pulp", "impor pulp", "toba pulp", "serat kayu",
    "hutan tanaman industri", "hti",
)
KERTAS_EXCLUDE_PHRASES = (
    "kertas kerja", "di atas kertas", "uang kertas", "tiket kertas", "wayang kertas", "ujian kertas", "kertas ujian",
    "ujian berbasis komputer atau kertas", "era kertas", "menandatangani kertas", "selembar kertas", "kantong kertas", "kertas suara", "kertas kado",
    "pesawat kertas", "antara kertas dan realita",
)
KERTAS_INDUSTRY_TERMS = (
    "pabrik kertas", "industri kertas", "bahan baku kertas", "produksi kertas", "produsen kertas", "ekspor kertas", "impor kertas", "kertas bekas",
    "limbah kertas", "daur ulang kertas", "pulp", "kertas kemasan", "kertas karton", "tjiwi kimia", "indah kiat",
)
KELAPA_EXCLUDE_PHRASES = (
    "kelapa gading", "talang kelapa", "tanjung kelapa", "pulau kelapa", "kelapa dua", "kelapa lima",
)
KELAPA_INDUSTRY_TERMS = (
    "pohon kelapa", "minyak kelapa", "kelapa parut", "kopra", "sabut kelapa", "perkebunan kelapa", "petani kelapa", "olahan kelapa", "batok kelapa",
    "air kelapa", "hilirisasi kelapa", "kelapa kopyor", "tunas kelapa", "daging kelapa", "ekspor kelapa", "industri kelapa", "produksi kelapa",
)
KARET_EXCLUDE_PHRASES = (
    "jam karet", "perahu karet", "ban karet", "gelang karet", "celana karet", "tali karet", "permainan karet", "lompat tali", "stasiun karet",
)
KARET_INDUSTRY_TERMS = (
    "kebun karet", "perkebunan karet", "petani karet", "harga karet", "ekspor karet", "industri karet", "sadap karet", "getah karet", "lateks",
    "apkarindo", "gabungan perusahaan karet", "produksi karet", "tanaman karet", "pohon karet", "kayu karet", "hilirisasi",
)
KAKAO_EXCLUDE_PHRASES = (
    "kakao entertainment", "kakao page", "kakaotalk", "kakao corp", "the boyz", "label 78",
)
KAKAO_INDUSTRY_TERMS = (
    "kebun kakao", "perkebunan kakao", "petani kakao", "biji kakao", "olahan kakao", "harga kakao", "produksi kakao", "ekspor kakao", "industri kakao",
    "pohon kakao", "cokelat",
)
COKELAT_EXCLUDE_PHRASES = (
    "amplop cokelat", "warna cokelat", "baju cokelat", "seragam cokelat", "celana cokelat", "sepatu cokelat", "kulit cokelat", "mata cokelat",
    "rambut cokelat", "beras cokelat", "gula cokelat",
)
COKELAT_INDUSTRY_TERMS = (
    "biji cokelat", "kebun cokelat", "petani cokelat", "perkebunan cokelat", "olahan cokelat", "produk cokelat", "batang cokelat", "pabrik cokelat",
    "industri cokelat", "bubuk cokelat", "ekspor cokelat", "harga cokelat", "kakao", "kudapan cokelat", "kue cokelat", "manisan cokelat",
    "bikin cokelat", "makan cokelat", "cokelat batang", "cokelat batangan",
)
TAR_INDUSTRY_TERMS = (
    "rokok", "tembakau", "sigaret", "nikotin", "asap rokok", "kretek", "kadar tar", "kandungan tar", "senyawa tar", "vape",
)
TEH_EXCLUDE_TITLE_PHRASES = (
    "teh cely", "teh rina", "teh nia", "teh melly", "teh nita", "teh novi", "tulus", "cover", "singing battle", "dj teh", "remix", "chord",
    "kunci gitar", "ami awards", "lagu", "music video", "official lyric", "song", "lirik lagu", "makna lagu", "lagu pop", "single baru",
)
TEH_INDUSTRY_TERMS = (
    "kebun teh", "perkebunan teh", "petani teh", "daun teh", "pabrik teh", "industri teh", "produksi teh", "ekspor teh", "harga teh", "pucuk teh",
    "minuman teh", "teh kemasan", "teh hitam", "teh hijau", "teh wangi",
)
SUSU_EXCLUDE_PHRASES = (
    "gigi susu", "warna kopi susu", "berwarna kopi susu", "susu kecoa", "susu kecoak",
)
KOPI_EXCLUDE_TITLE_PHRASES = (
    "kena skors", "etiket makan", "perkembangan anak", "tumbuh kembang", "asam lambung", "rekomendasi susu oat", "aeropress", "french press",
    "#cari_aman",
)
FAME_EXCLUDE_PHRASES = (
    "hall of fame", "walk of fame", "the fame", "fame and fortune", "fame got", "rise to fame", "claim to fame", "star", "celebrity", "hollywood",
    "actress", "actor", "barbie", "movie", "song", "album",
)
FAME_INDUSTRY_TERMS = (
    "fatty acid", "methyl ester", "metil ester", "biodiesel", "oleokimia", "sawit", "minyak sawit", "b35", "b40", "b50", "bioenergi", "ebt",
    "bahan bakar nabati", "bbn", "cpo", "solar",
)
POME_REJECT_WORDS = (
    "dog", "pomeranian", "anjing", "pet", "pets", "puppy", "cute", "cutedog",
)
POME_INDUSTRY_WORDS = (
    "limbah", "sawit", "pabrik", "pengolahan", "cpo", "biogas", "ebt", "palm oil mill effluent", "palmco", "sludge", "bioetanol", "energi bersih",
    "energi terbarukan", "emisi karbon", "kek sei mangkei",
)
NON_AGRO_TOPIC_PATTERNS = (
    r"\brangkap\s+jabatan\b", r"\bbupati\s+gowa\b", r"\btipidkor\b", r"\bbatik\b", r"\bnet\s+zero\s+emission\b", r"\bdekarbonisasi\b",
    r"\bemisi\s+karbon\b", r"\bindustri\s+hijau\b", r"\bsertifikasi\s+halal\b", r"\bwajib\s+halal\b", r"\bindustri\s+halal\b",
    r"\bhalal\s+industry\s+awards\b", r"\bkonsultasi\s+bisnis\b", r"\bperguruan\s+tinggi\b", r"\bdaya\s+saing\s+ikm\b", r"\bindustrial\s+festival\b",
    r"\bfestival\s+industri\b", r"\botomotif\b", r"\bgaikindo\b",
)
SPECIFIC_AGRO_COMMODITIES = (
    r"\bsawit\b", r"\bkelapa\s+sawit\b", r"\bcpo\b", r"\bcrude\s+palm\s+oil\b", r"\bminyak\s+sawit\b", r"\bminyak\s+goreng\b", r"\btbs\b",
    r"\bbiodiesel\b", r"\bfame\b", r"\bpome\b", r"\bbioethanol\b", r"\boleokimia\b", r"\bb35\b", r"\bb40\b", r"\bb50\b", r"\bmamin\b",
    r"\bmakanan\s+dan\s+minuman\b", r"\bindustri\s+makanan\b", r"\bindustri\s+minuman\b", r"\bmakanan\s+kemasan\b", r"\bbiskuit\b",
    r"\bolahan\s+daging\b", r"\bdaging\s+olahan\b", r"\bmi\s+instan\b", r"\bmie\s+instan\b", r"\bikan\s+kaleng\b", r"\bsarden\b", r"\bkelapa\b",
    r"\bkopra\b", r"\bsantan\b", r"\bnata\s+de\s+coco\b", r"\bgula\b", r"\bgula\s+rafinasi\b", r"\bgkm\b", r"\btebu\b", r"\bpabrik\s+gula\b",
    r"\btepung\b", r"\bterigu\b", r"\btapioka\b", r"\bsingkong\b", r"\bsagu\b", r"\bpati\b", r"\brumput\s+laut\b", r"\balga\b", r"\bspirulina\b",
    r"\bpulp\b", r"\bbubur\s+kertas\b", r"\bkertas\b", r"\bkayu\s+lapis\b", r"\bplywood\b", r"\bmebel\b", r"\bfurniture\b", r"\bfurnitur\b",
    r"\bbambu\b", r"\bolahan\s+bambu\b", r"\batsiri\b", r"\bminyak\s+atsiri\b", r"\bnilam\b", r"\bserai\s+wangi\b", r"\bkaret\b", r"\blateks\b",
    r"\bcrumb\s+rubber\b", r"\btembakau\b", r"\bhasil\s+tembakau\b", r"\brokok\b", r"\bcukai\s+rokok\b", r"\brokok\s+ilegal\b", r"\brokok\s+elektrik\b",
    r"\brokok\s+tanpa\s+pita\s+cukai\b", r"\btar\b", r"\bnikotin\b", r"\bkakao\b", r"\bbiji\s+kakao\b", r"\bcokelat\b", r"\bcoklat\b",
    r"\bminuman\s+beralkohol\b", r"\bminuman\s+berpemanis\b", r"\bamdk\b", r"\bair\s+minum\s+dalam\s+kemasan\b", r"\bgalon\b", r"\bteh\b",
    r"\bpucuk\s+teh\b", r"\bsusu\b", r"\bproduk\s+susu\b", r"\bolahan\s+susu\b", r"\bkopi\b", r"\bbiji\s+kopi\b", r"\bpakan\s+ternak\b", r"\bpakan\b",
)
DITJEN_AGRO_EXPLICIT = (
    r"\bditjen\s+agro\b", r"\bditjen\s+industri\s+agro\b", r"\bdirektorat\s+jenderal\s+industri\s+agro\b", r"\bindustri\s+agro\b", r"\bsektor\s+agro\b",
    r"\bhasil\s+hutan\s+dan\s+perkebunan\b", r"\bmakanan\s+hasil\s+laut\s+dan\s+perikanan\b", r"\bminuman\s+hasil\s+tembakau\b", r"\bkemurgi\b",
    r"\bakademi\s+komunitas\s+bambu\b",
)
INDUSTRY_POLICY_SIGNALS = (
    "kementerian", "kemenperin", "kementan", "dinas", "menteri", "wamenperin", "wamentan", "direktur jenderal", "dirjen", "gubernur", "bupati",
    "wali kota", "dprd", "dpr ri", "komisi vi", "pabrik", "pg ", "swasembada", "ekspor", "impor", "produksi", "produktivitas", "investasi", "petani",
    "perkebunan", "industri", "komoditas", "pasar global", "hilirisasi", "koperasi", "perusahaan", "pt ", "tata niaga", "kuota", "rafinasi", "harga",
    "daya saing",
)
HEALTH_PERSONAL_SIGNALS = (
    "kesehatan tubuh", "gizi", "diet", "kalori", "diabetes", "gula darah", "kemenkes", "puskesmas", "manfaat", "khasiat", "efek samping", "penyakit",
    "menu sarapan", "menu sehat", "pola makan", "asupan", "konsumsi harian", "tips kesehatan", "detoksifikasi", "resep", "racun", "keracunan", "toksik",
    "toksisitas", "gangguan saraf", "kemandulan", "penurunan fungsi organ", "sejarah kuno", "romawi kuno", "zaman dulu", "fakta unik", "fakta menarik",
)
EXPLICIT_KEMENPERIN_SIGNALS = (
    "kemenperin", "kementerian perindustrian", "menteri perindustrian", "menperin", "wamenperin", "wakil menteri perindustrian",
    "direktorat jenderal industri agro", "ditjen agro", "ditjen industri agro", "akademi komunitas bambu", "akademi komunitas bambu kemenperin",
)

# Patterns of one rule each.
INSTITUTION = r"\b(kemenperin|kementerian\s+perindustrian|menteri\s+perindustrian|wamenperin|wakil\s+menteri\s+perindustrian|menperin|direktorat\s+jenderal\s+industri\s+agro|ditjen\s+agro|ditjen\s+industri\s+agro)\b"
GALLERIES = (
    r"\b\d+\s*\+\s*foto\b",
    r"\b\d+\+?\s+foto\b.*\b(pictures|gambar|background)\b.*\b(unduh|download)\s+gratis\b",
    r"pictures,\s*gambar\s+dan\s+background\s+untuk\s+(unduh|download)\s+gratis",
    r"^\d+[\d.,]*\+?\s+(foto|gambar|vektor)\s+.*\b(gratis|free)\b",
)
SCHOOLS = (
    r"^(profil\s+|akreditasi\s+|sejarah\s+)?(smk|smkn|sma|sman|smp|smpn|sd|sdn|madrasah|man|mts|mis|universitas|institut|politeknik|akademi|sekolah tinggi)\b",
    r"\b(data pokok pendidikan|dapodik|profil sekolah|akreditasi sekolah)\b",
)
SHOP_TITLES = r"\b(frosty mint|ginger twist|glacial mint|zesty citrus|nicotine pouch|pod cartridge)\b"
MACHINES = (
    r"\b(modal|biaya)\s+(mendirikan|membuat|buka|membuka)\s+pabrik\b",
    r"\bpaket\s+mesin\s+(depot|amdk|usaha)\b",
    "penentuan kadar abu",
)
DOCUMENTS = (
    r"\b(di|pada)\s+(?:pt\.?|cv\.?)\s*xyz\b",
    r"^(?:keputusan|peraturan|instruksi|surat\s+edaran|kepmen|permen)\s+(?:menteri|presiden|direktur|kepala|gubernur|bupati)?\s*(?:nomor|no\.?)\s*\d+",
    r"^\d+\.\s+data\s+(?:luas|produksi|populasi|harga|rekapitulasi)\b",
)
CHAPTER_TITLE = r"^(bab|cover|lampiran|skripsi|tesis)\b"
STOCKS = (
    r"\banalisis\s+teknikal\b",
    r"\btarget\s+harga\b",
    r"\brekomendasi\s+saham(nya)?\b",
    r"\bsimak\s+rekomendasi\s+saham(nya)?\b",
    r"\banalisis\s+fundamental\b",
)
MEASURES = r"\b\d+[\s\w]*(gram|gr|ml|mililiter|sendok makan|sendok teh|sdm|sdt|butir|lembar|siung|bungkus|cup)\b"
SAFE_OF_CORRUPTION = r"\b(?:anti[-\s]?korupsi|bebas\s+korupsi|pencegahan\s+korupsi|cegah\s+korupsi|pencegahan\s+gratifikasi|zona\s+integritas|wbk|wbbm)\b"
PASSING_MENTION = r"\b(?:turut\s+hadir|juga\s+hadir|juga\s+dihadiri|perwakilan\s+kemenperin|selain\s+[^\.]{0,50}kemenperin|salah\s+satu(?:nya)?[^\.]{0,30}kemenperin|sebagian\s+besar\s+laporan|nama\s+kemenperin\s+(?:ikut\s+|turut\s+)?di)\b"
DENIED_MENTION = r"\b(?:tanpa\s+(?:menyinggung|melibatkan|menyebut|campur\s+tangan)|tidak\s+(?:menyinggung|melibatkan|menyebut)|bukan\s+(?:kewenangan|urusan|terkait))\s+(?:kementerian\s+perindustrian|kemenperin)\b"
OUTWARD_ATTACK = r"\b(?:kemenperin|menperin|wamenperin|dirjen|sekjen|jubir|juru\s+bicara)[^\.]{0,35}\b(?:kritik|mengkritik|sorot|menyoroti|kecam|mengecam)\b[^\.]{0,45}\b(?:ilegal|penyelundup|oknum|impor\s+ilegal|kartel|penimbun|pelanggar)"
TARGETED_ATTACK = r"\b(?:dikritik|dikecam|disorot|digugat|disalahkan|kelalaian|lamban|tidak\s+efektif|tak\s+efektif)\b|(?:kritik|mengkritik|gugat|menggugat|salahkan|menyalahkan|kecam|mengecam)[^\.]{0,55}\b(?:kemenperin|menperin|kebijakan|aturan|regulasi)\b"
GENERAL_APPEAL = r"\b(?:minta|meminta|mohon|memohon|harap|berharap|imbau|mengimbau|usul|mengusulkan)\s+[^\.]{0,35}\bpemerintah\b"
FALLING_MARKET = r"\b(?:ekspor|produksi|harga|permintaan)[^.]{0,35}\b(?:turun|anjlok|melemah|tertekan)\b"
