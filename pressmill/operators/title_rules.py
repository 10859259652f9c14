"""Ordered title rules of the second look, as data: a title (lower case) that holds one of ``any`` and one of ``also`` and
none of ``unless``, or is one of ``exact``, or matches ``pattern``, gets the reason; the first rule wins."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TitleRule:
    reason: str
    any: tuple[str, ...] = ()
    also: tuple[str, ...] = ()
    unless: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()
    pattern: str = ""


# Fixed values, in order.
TITLE_RULES = (
    TitleRule("Bukan Agro (Otomotif / Kendaraan Listrik ILMATE)", ("insentif hybrid", "reev", "ganjil genap", "mobil listrik", "mobil double cabin", "lebih hemat bbm dari hybrid", "toyota perluas produksi")),
    TitleRule("Bukan Agro (Industri Maritim ILMATE)", ("galangan kapal",)),
    TitleRule("Bukan Agro (Logam / Baja ILMATE)", ("skrap baja",)),
    TitleRule("Bukan Agro (Infrastruktur Irigasi PU / Sumber Daya Air)", ("bendung karet",)),
    TitleRule("Bukan Agro (Bencana Kebakaran Hutan / Lingkungan)", ("kabut asap", "haze victims")),
    TitleRule("Bukan Agro (Tarif Kayu Luar Negeri AS-Kanada)", ("as cabut sebagian tarif impor kanada",)),
    TitleRule("Bukan Agro (Kerja Sama Bilateral Kepolisian)", ("indonesia-rusia perkuat kerja sama ekonomi",)),
    TitleRule("Bukan Agro (Kerja Sama Bilateral Umum Non-Agro)", ("indonesia-azerbaijan", "indonesia-eu business forum", "indonesia – eu", "indonesia - eu")),
    TitleRule("Bukan Agro (Profil Smart City Daerah)", ("smart city temanggung",)),
    TitleRule("Artifact Web (Halaman Repositori Akademik)", ("repositori institusi",)),
    TitleRule("Arsip Lama (Regulasi PP Tahun 1961)", ("peraturan pemerintah nomor 189 tahun 1961",)),
    TitleRule("Data Asing (Biro Statistik Nasional China NBS)", ("produksi susu september mencapai 2,928 juta ton, nai",)),
    TitleRule("Bukan Agro (Festival Musik Joyland)", ("joyland sessions",)),
    TitleRule("Bukan Agro (Pabrik Sepatu PT PWI 6)", ("pt pwi 6",)),
    TitleRule("Pabrik Luar Negeri (Produsen Biskuit Malaysia Tutup)", ("lee biscuits", "setelah 92 tahun, pabrik biskuit legendaris ini akhirnya tutup", "92 tahun berjalan, pabrik biskuit legendaris resmi tutup", "usai 92 tahun produksi biskuit, perusahaan malaysia ini")),
    TitleRule("Bukan Sektor Agro (Keramik IKFT)", ("industri keramik",)),
    TitleRule("Bukan Sektor Agro (Pertambangan ESDM)", ("tambang", "menambang", "penambangan")),
    TitleRule("Bukan Sektor Agro (Pertambangan ESDM)", ("esdm dalami kebun sawit", "esdm siapkan")),
    TitleRule("Bukan Sektor Agro (ESDM Energi)", ("komisi xii dpr", "dirjen ebtke", "sektor energi dua tahun")),
    TitleRule("Artifact Kosong / Error Web", ("stuktur data",)),
    TitleRule("Artifact Kosong / Error Web", exact=("berita",)),
    TitleRule("Artifact Web Kemenko Perekonomian", ("kementerian koordinator bidang perekonomian republik indonesia",)),
    TitleRule("Hulu Perkebunan (Surat Tanda Daftar Budidaya Kebun Sawit)", ("stdb kelapa sawit",)),
    TitleRule("Hulu Perkebunan (Penyediaan Lahan Kebun Sawit)", ("garap 200.000 hektare lahan",)),
    TitleRule("Hulu Perkebunan (Verifikasi Fisik Kebun Kelapa Rakyat)", ("dukungan perkebunan kelapa sesuai kebutuhan pekebun",)),
    TitleRule("Hulu Perkebunan (Produksi Tandan Buah Segar Daerah)", ("5 daerah penghasil sawit terbesar di kaltim",)),
    TitleRule("Hulu Perkebunan (Kajian Agronomi Curah Hujan Kebun)", ("pengaruh curah hujan terhadap produksi kelapa sawit",)),
    TitleRule("Hulu Perkebunan (Kajian Agronomi Pemupukan Kebun)", ("kajian pemupukan di perkebunan",)),
    TitleRule("Hulu Tanaman Pangan (Beras Kementan / Dinas Pertanian Daerah)", ("beras sumut surplus",)),
    TitleRule("Hulu Perkebunan (Penyiapan Lahan Kebun Pemda Mimika)", ("pemerintah mimika optimalkan lahan perkebunan",)),
    TitleRule("Hulu Budidaya (Harga Bahan Mentah Rumput Laut Pembudidaya)", ("standar harga",), also=("pembudidaya rumput laut",)),
    TitleRule("Hulu Budidaya (Harga Rumput Laut Mentah Tingkat Pembudidaya)", ("usulkan harga minimal rp14.000",)),
    TitleRule("Hulu Perkebunan (Konsumsi Buah Kakao Segar di Kebun Warga)", ("mencicipi buah kakao dari kebun",)),
    TitleRule("Hulu Perkebunan (Replanting / Peremajaan Pohon Karet Tua)", ("pohon karet tua di boven digoel diarahkan untuk peremajaan",)),
    TitleRule("Hulu Perkebunan (Aspirasi Petani Karet di Komisi IV DPR RI)", ("rdpu dengan dewan pimpinan pusat petani karet indonesia",)),
    TitleRule("Hulu Perkebunan (Budidaya Tanaman Tembakau Petani)", ("transfer teknologi pakistan untuk petani tembakau",)),
    TitleRule("Hulu Pertanian (Harga Bahan Baku Mentah Singkong Petani)", ("harga singkong di lampung melonjak tembus rekor",)),
    TitleRule("Hulu Budidaya (Bibit dan Tambak Rumput Laut)", ("kebun bibit rumput laut", "rumah budidaya rumput laut", "rumah bibit rumput laut")),
    TitleRule("Hulu Budidaya / Bibit (KKP / Perbenihan Kebun)", ("pembaruan bibit", "rumah bibit", "perbenihan kelapa", "budidaya tambak", "modelling budidaya", "rumah budidaya")),
    TitleRule("Hulu Nelayan / Pembudidaya Rumput Laut", ("pembudi daya rumput", "pembudidaya rumput", "nelayan dan pembudi", "panen raya rumput")),
    TitleRule("Hulu Bantuan Sarpras Perikanan KKP", ("bantuan perikanan bukan untuk", "pengecekan sarana dan prasarana")),
    TitleRule("Hulu Perkebunan (Adat Ritual Peremajaan Kebun PTPN IV)", ("ritual baremah",)),
    TitleRule("Hulu Budidaya Tambak (Ikan Patin)", ("ikan patin",)),
    TitleRule("Hulu Pertanian (Komisi IV DPR RI)", ("komisi iv dpr ri - dalami potensi bungkil",)),
    TitleRule("Ranah Kehutanan / Lingkungan (KLHK)", ("moratorium sawit",)),
    TitleRule("Klimatologi Kebun (BMKG)", ("buletin informasi iklim",)),
    TitleRule("Penyuluhan Petani Swadaya Hulu", ("petani swadaya di aceh",)),
    TitleRule("Hulu Harga Panen Singkong Petani (DPRD)", ("dprd lampung optimis harga singkong",)),
    TitleRule("Penyelenggaraan Kebun Kelapa Sawit PSN", ("siap jadi percontohan tata kelola perkebunan", "jalankan psn sawit, agrinas palma")),
    TitleRule("Artikel Teori Konseptual Pembangunan Sawit", ("implementasi pembangunan kelapa sawit yang berkelanjutan",)),
    TitleRule("Kamtibmas Jalan Desa Tonase Truk Sawit", ("angkutan cpo diatas 20 ton", "pt sil tegaskan kepatuhan tonase")),
    TitleRule("Keluhan Petani Non-Tembakau (Hulu Pertanian/Perkebunan)", ("keluh",), also=("sawit", "karet", "kakao", "kopi", "tebu", "singkong", "kelapa"), unless=("tembakau",)),
    TitleRule("Satwa Liar / Bencana Lingkungan", ("tapir", "gajah", "monyet", "buaya", "satwa liar"), also=("sawit", "kebun", "hutan")),
    TitleRule("Kriminal Murni Non-Industri", ("pembunuhan", "perampokan", "alat kejahatan", "maling", "curat", "curas", "polres tangkap")),
    TitleRule("Harga Eceran Pasar Tradisional", ("harga cabai", "harga beras di pasar", "harga daging di pasar", "pasar tradisional", "sembako pasar")),
    TitleRule("Teknis Administrasi Bea Cukai Daerah (NPPBKC)", ("nppbkc",), also=("terbitkan", "satu perusahaan", "layanan hanggar", "sosialisasi nppbkc")),
    TitleRule("Headline Memuat UMKM", pattern=r"\b(?:umkm|ukm)\b|\busaha\s+mikro\b"),
    TitleRule("Aksi Pendanaan Korporasi Murni (Bukan Operasional Pabrik)", ("obligasi", "sukuk", "surat utang", "pefindo", "rights issue", "buyback saham")),
    TitleRule("Resep / Tips Kuliner Rumah Tangga", ("resep ", "cara membuat ", "cara memasak ", "tips memasak ")),
    TitleRule("Promosi Ritel Supermarket", ("katalog promo", "promo jsm", "supermarket", "diskon jsm")),
    TitleRule("Pemberdayaan / Pelatihan Skala Desa", ("kwt ", "kelompok wanita tani", "ibu-ibu pkk", "pelatihan ibu-ibu")),
    TitleRule("Iklan Katalog Produk Impor (Made-in-China)", ("apa itu kertas tisu pulp kayu virgin",)),
    TitleRule("Riset / Lomba Mahasiswa Kampus", ("pimnas", "tim unair", "ekspedisi patriot ipb", "tim undana", "karsa nusa", "umpwr", "unkriswina")),
    TitleRule("Riset / Pengabdian Mahasiswa Kampus (ITS / UI / ITB)", ("tep its kembangkan tepung beras", "tep ui gali potensi", "pmki 2026: itb hadirkan teknologi")),
    TitleRule("Kegiatan Mahasiswa / PKM Kampus (BDP Unhas)", ("hmp bdp unhas tingkatkan nilai ekonomi rumput laut",)),
    TitleRule("Program Magang Mahasiswa Kampus UTU", ("dari kebun hingga produk cokelat, fakultas pertanian utu",)),
    TitleRule("Lomba Siswa / Sekolah", ("teaching factory smkn 5 merauke", "riset ai klasifikasi ampas sagu antar 2 siswa", "mahasiswa feb unimal juara satu")),
    TitleRule("Hilirisasi Riset Laboratorium Kampus (UNAND)", ("unand olah gambir jadi minuman dan kosmetik",)),
    TitleRule("Kata Bermakna Ganda (Karet Non-Agro)", ("perahu karet", "jam karet", "gelang karet", "celana karet")),
    TitleRule("Kata Bermakna Ganda (Nama Lokasi Kelapa)", ("kelapa gading", "pantai kelapa", "jalan kelapa")),
    TitleRule("Kata Bermakna Ganda (Kakao Media K-pop/Korea)", ("kakao entertainment", "kakaotalk")),
    TitleRule("Event Budaya / Kuliner Daerah Papua", ("sagu warnai tarung tiga di jayapura",)),
    TitleRule("Listicle Konsumsi Mie Instan Global", ("10 negara paling doyan mi instan",)),
    TitleRule("Himbauan Kepolisian Kamtibmas Pemuda", ("kombes fredricukus dorong pemuda papua", "michael yarisetouw ajak anak muda papua")),
    TitleRule("Aspirasi Reses DPR Daerah (Kupang Barat)", ("reses di kupang barat, viktor laiskodat",)),
    TitleRule("Kuliner Wisata Event Olahraga", ("kelapa muda naik kelas saat motogp mandalika",)),
    TitleRule("Ekonomi Warga Kampung Sawit (Bukan Industri)", ("kelapa sawit expo center 2026: dari kampung yang pernah",)),
    TitleRule("Sosialisasi Edukasi Pelajar / Pelatihan Peternak Sapi", ("kenalkan potensi industri kelapa sawit berkelanjutan kepada pelajar", "kenalkan kebaikan sawit bagi peternak sapi")),
    TitleRule("Blog Opini UGC (Kompasiana)", ("berkah ekonomi atau kutukan ekologi", "terobosan endy, maya, lutfi")),
    TitleRule("Feature Cerita Kebun Kopi Ende", ("kuncup putih di lereng detubapa",)),
    TitleRule("Koperasi Daerah Pegunungan Papua", ("menkop ri fasilitasi pengembangan kopi papua",)),
    TitleRule("Kerajinan Batik Tulis UMKM", ("perajin batik tulis", "lilin batik", "batik sawit", "smart batik")),
    TitleRule("Profil Human Interest Inspiratif UMKM Lokal", ("kisah inspiratif mama lidia mikan",)),
    TitleRule("Isu Geopolitik / Investigasi Ekspor Transit", ("mengalir ke israel",)),
    TitleRule("Ranah Ditjen IKMA / Sentra Perajin Ukir Lokal / Seminar Budaya Kampus", ("octofest", "rekanusa", "seni ukir jepara", "pengusaha ukir jepara", "perajin mebel jepara", "pelaku mebel jepara", "pengusaha mebel jepara diminta berinovasi dalam desain ukir", "furniture exhibition for export in jepara", "realisasi target ekspor industri furnitur dari jepara")),
    TitleRule("Kasus Pidana Korupsi / Penggeledahan Pajak Kejagung (Non-Operasional IA)", ("kejagung geledah", "geledah pt ipps", "kasus transfer pricing")),
    TitleRule("Berita Makro PMI / IKI / Utilisasi Manufaktur Umum (Bukan Spesifik Ditjen IA)", ("kenaikan pmi indikator perkembangan positif industri ri", "pmi manufaktur indonesia capai 54,0", "pmi manufaktur menguat, pengamat tekankan kepastian regulasi", "pmi manufaktur indonesia tembus 54,0, investasi industri masih tertahan", "ekspansi manufaktur dibayangi kenaikan harga produksi", "menperin sarmuji beberkan kinerja manufaktur ri yang cetak rekor", "industrialisasi ri kembali menggeliat, jangan hanya andalkan nikel", "menperin pede industri ri ekspansi, benarkah ancaman sudah lewat", "industri manufaktur pertahankan ekspansi pada september 2026", "naikan utilisasi industri ke 85%", "utilisasi kapasitas industri rendah, target kemenperin 85%", "kemenperin bidik utilisasi industri 85%", "menperin dorong utilisasi industri naik jadi 85 persen", "menperin genjot produksi, industri tak boleh kekurangan bahan baku", "mendag dan menperin tagih peran kadin", "menperin upayakan hilirisasi ciptakan ekosistem industri pendukung")),
    TitleRule("Tren Kuliner / Gaya Hidup Luar Negeri (Bukan Industri IA)", ("pandan makin populer di as dan eropa",)),
    TitleRule("Tren Kuliner / Menu Barista Kedai Kopi F&B (Bukan Pabrik IA)", ("tren minuman rendah gula meningkat, industri kopi", "minuman rendah gula hingga berbahan nabati jadi sorotan", "ellenka barista")),
    TitleRule("Promosi Pameran Mesin Plastik & Moulding (Ranah IKFT / ILMATE)", ("plastics & rubber indonesia", "jelajahi inovasi teknologi industri plastik dan karet")),
    TitleRule("Bukan Sektor Agro (Industri Plastik & Kemasan Plastik - Ditjen IKFT)", ("permintaan kemasan plastik naik",)),
    TitleRule("Bukan Sektor Agro (Industri Jamu & Farmasi / Saham SIDO - Ditjen IKFT)", ("sido muncul", "kinerja sido tertekan")),
    TitleRule("Bukan Sektor Agro (Gas untuk Petrokimia, Pupuk, Kaca, Baja, Keramik - IKFT/ILMATE)", ("penambahan alokasi gas industri: bisa pacu utilisasi",)),
    TitleRule("Razia / Pengawasan Rokok Ilegal Tingkat Kecamatan (Pemkab / Satpol PP)", ("awasi mesin pelinting rokok di socah",)),
    TitleRule("Hulu Perkebunan Sawit (Benih, Budidaya, PSR, dan Legalitas Lahan GAPKI)", ("enam langkah transformasi kunci menjaga masa depan industri sawit",)),
    TitleRule("Hulu Kehutanan / Kebakaran Hutan dan Lahan Konsesi Kayu", ("singapura batasi sertifikasi hijau app",)),
    TitleRule("Hulu Pertanian / Koordinasi Birokrasi Kementan Daerah (BRMP)", ("brmp gorontalo",)),
    TitleRule("Pengumuman Administrasi Proposal Hibah BPDP (Bukan Operasional Pabrik)", ("bpdp perpanjang batas waktu pengajuan proposal",)),
    TitleRule("Edukasi Gizi Konsumen Rumah Tangga (Parapuan / BPOM)", ("bpom jelaskan peran teknologi sterilisasi",)),
    TitleRule("Opini Regulasi Jaminan Produk Halal Umum (BPJPH)", ("uu jaminan produk halal tak kunjung ditegakkan",)),
    TitleRule("Kunjungan Asosiasi Budidaya & Perdagangan Rumput Laut (Non-Pabrik)", ("delegasi arli ke china",)),
    TitleRule("Kunjungan Akademisi Kampus Jepang / Riset BRIN", ("tarik perhatian guru besar jepang",)),
    TitleRule("Fokus Pasar Kerajinan / Kriya (Ranah Ditjen IKMA)", ("himki pacu pasar kerajinan",)),
    TitleRule("Manajemen Lalu Lintas & Angkutan Jalan Raya Nataru (Kemenhub/Korlantas)", ("rekayasa lalu lintas jadi kunci distribusi", "pasokan makanan dan minuman saat nataru perlu dijaga")),
    TitleRule("Promosi Kuliner / Masakan Tradisional / Lomba Chef (Gaya Hidup & Pariwisata)", ("jadi ajang promosi kuliner nusantara", "dorong kuliner nusantara jadi alat diplomasi", "makanan bisa jadi alat negara", "soto lamongan ikut disorot", "pameran makanan dorong keunggulan khas indonesia", "la cuisine 2026 libatkan", "sagu di luwu juga diolah menjadi sinole")),
    TitleRule("Wacana Energi / BBM Biofuel & Biogas (Ranah ESDM / Riset Energi)", ("bisa buat bbm baru", "rumput laut bisa diolah jadi biofuel", "brin research biogas")),
    TitleRule("Berita Makro Kurs Rupiah Lintas Sektor (Manufaktur Umum, Farmasi & Digital)", ("rupiah melemah, industri manufaktur hingga pangan", "rupiah melemah, sektor makanan hingga digital")),
    TitleRule("Sosialisasi Sertifikasi Halal Kemenag Kabupaten (Arsip Daerah)", ("kampanye who 2026, bpjph banggai",)),
    TitleRule("Pidato Makro Hilirisasi SDA / PMI Manufaktur Umum Nasional", ("jangan cuma jago jual komoditas mentah", "dorong hilirisasi sda untuk pertumbuhan industri", "menperin perdalam hilirisasi demi ciptakan pertumbuhan", "pamer pmi manufaktur ri oktober 2026")),
    TitleRule("Opini Sosial Lahan PSN di Papua", ("program strategis nasional di papua",)),
    TitleRule("Forum Daerah Pemprov/BI Riau & Hulu Lahan Petani Kelapa Pesisir", ("pemprov riau dorong hilirisasi kelapa", "bi dan pemprov riau dorong hilirisasi kelapa", "luas lahan capai 440 ribu hektare, riau dorong")),
    TitleRule("Hulu Perkebunan (Nilai Tukar Petani & Harga TBS Sawit Kalbar)", ("bps catat ntp kalbar turun",)),
    TitleRule("Kegiatan Kampus & Beasiswa Mahasiswa (Unram)", ("dorong mahasiswa kuasai teknologi sambut hilirisasi kelapa", "beasiswa dan pengembangan kelapa warnai kegiatan di unram")),
    TitleRule("Profil UMKM Tradisional Daerah (Ranah Ditjen IKMA / Pemkab)", ("produk olahan alami asal salatiga tembus pasar amerika", "produk lokal blora tembus pasar as")),
    TitleRule("Program Hulu-Hilir Kementan (Wamentan / BRMP Pertanian)", ("proyeksikan 90 persen ekspor perkebunan berwujud olahan", "brmp sulut pacu hilirisasi kelapa")),
    TitleRule("Bukan Sektor Agro (Inovasi Lampu LED & Teknik Biomedis ITERA)", ("inovasi led kepada mahasiswa teknik biomedis",)),
    TitleRule("Hulu Budidaya Rumput Laut Nelayan Daerah", ("budidaya rumput laut di desa balefadorotuho", "aktivitas nelayan membudidayakan rumput laut")),
    TitleRule("Bukan Sektor Agro (Industri Bahan Baku Obat & Farmasi - Ditjen IKFT)", ("jadi bahan baku obat",)),
    TitleRule("Opini Bursa Saham MSCI & Pajak Korporasi", ("korporasi pengemplang pajak",)),
    TitleRule("Kunjungan Wisata Diplomatik ke Sentra Ukir Jepara (Kriya / Pemkab)", ("diplomat meksiko", "14 dubes jelajahi jepara", "dubes rumania lihat potensi besar mebel dan ukiran jepara")),
    TitleRule("Hulu Petani Nilam / Sistem Resi Gudang (Bappebti Kemendag)", ("minyak nilam masuk srg",)),
    TitleRule("Audiensi Umum Pemprov Sumsel (Pelayaran & Investor Pertambangan/Perkebunan)", ("herman deru", "hd tawarkan potensi hilirisasi komoditas sumsel")),
    TitleRule("Anggaran Bansos DBHCHT Daerah / Kasus Korupsi KPK (Non-Operasional Pabrik)", ("separuh anggaran dbhcht dialokasikan", "dugaan korupsi cukai rokok")),
    TitleRule("Hulu Perkebunan Kakao (Pupuk Subsidi, Bibit Kebun & Pengabdian Mahasiswa/PKK)", ("npk kakao", "bibit kakao di panyabungan", "uniflor berdayakan petani kakao", "program aksara mahasiswa uniflor")),
    TitleRule("Hulu Kehutanan / Konservasi Taman Nasional & Deforestasi EUDR", ("rantai pasok bebas deforestasi", "rantai pasok kopi berkelanjutan di tnbbs")),
    TitleRule("FGD Fatwa MUI & Kesehatan Remaja Kemenkes (Bukan Industri)", ("fgd komisi fatwa mui",)),
    TitleRule("Kebijakan Perdagangan Ekspor CPO Menko Pangan (Bukan Pabrik IA)", ("zulhas ingin ekspor cpo langsung",)),
    TitleRule("Hulu Perkebunan (Benih / Varietas Bibit Kelapa Sawit Disbun)", ("varietas ppks simalungun",)),
    TitleRule("Berita Makro PMI Umum", ("pmi manufaktur indonesia pada oktober 2026 capai 54",)),
    TitleRule("Kuliner / Gaya Hidup Restoran", ("potensi besar, kuliner indonesia punya peluang mendunia",)),
    TitleRule("Bukan Sektor Agro (Petrokimia IKFT)", ("sawit & petrokimia belum maksimal",)),
    TitleRule("Akademisi Kampus (UIN Jakarta)", ("uin jakarta",)),
    TitleRule("Teknis Kunjungan Bea Cukai (CVC)", ("customs visit customer", "kegiatan cvc")),
    TitleRule("Teknis Administrasi Bea Cukai (NPPBKC)", ("kepatuhan cukai sejak awal usaha",)),
    TitleRule("Bimtek Manajemen Keuangan Pemkot Malang", ("diskopindag kota malang latih",)),
    TitleRule("Perkebunan Sawit Danantara RSPO", ("kelola ekspor satu pintu, dsi tegaskan",)),
    TitleRule("Judul Generik / Kosong (Artifact Web)", exact=("agenda", "berita", "article", "indeks berita", "detail berita", "informasi paket")),
    TitleRule("Judul Generik / Kosong (Artifact Web)", pattern=r"^.{0,4}$|^\p{Nd}+$"),
    TitleRule("Halaman Kamus / Direktori / Arsip Statis (Bukan Berita)", ("kamus istilah hukum", "profile, phone, address", "peraturan direktur jenderal industri agro nomor")),
    TitleRule("Hulu Perkebunan (Update Harga TBS Sawit Harian Petani)", ("harga tbs sawit", "daftar harga tbs", "rincian harga tbs")),
    TitleRule("Bukan Sektor Agro (Ranah Ditjen IKFT / ILMATE / IKMA)", ("industri plastik", "industri petrokimia", "pabrik gemuk", "gaikindo", "pameran otomotif", "hari batik nasional")),
    TitleRule("Kebijakan Kawasan Industri Umum Non-IA (Ditjen KPAII)", ("kawasan industri",), unless=("agro", "sagu", "sawit", "kakao", "kelapa", "mamin", "pangan", "karet", "tembakau", "pulp", "kertas", "halal", "maluku")),
    TitleRule("Energi Biogas / Listrik POME (Ranah Energi EBTKE / Lingkungan, Bukan Inti Manufaktur IA)", ("instalasi biogas limbah sawit", "biogas dari limbah sawit", "biogas di sei pagar", "biogas di sungai pagar", "pemanfaatan pome sebagai energi", "listrik pome 3,9 gw", "limbah sawit jadi listrik", "palm oil waste into electricity", "limbah sawit berpotensi hasilkan energi")),
    TitleRule("Sosialisasi DBHCHT / Penindakan Bea Cukai Daerah (Bukan Kebijakan Industri IA)", ("dbhcht",), also=("salurkan blt", "pelatihan", "sosialisasikan", "sosialisasi")),
    TitleRule("Sosialisasi DBHCHT / Penindakan Bea Cukai Daerah (Bukan Kebijakan Industri IA)", ("bea cukai",), also=("gencarkan penindakan rokok ilegal", "ajak masyarakat dukung peredaran rokok legal", "dampingi pelaku usaha di tiga wilayah")),
    TitleRule("Logistik / Transportasi Truk Umum (Bukan Sektor IA)", ("distribusi kebutuhan harian masyarakat juga bergantung pada angkutan truk",)),
    TitleRule("Penanganan Emisi Gas Pendingin Refrigeran (Lingkungan Non-Inti IA)", ("super-polutan",), also=("recolit",)),
    TitleRule("Penanganan Emisi Gas Pendingin Refrigeran (Lingkungan Non-Inti IA)", ("recoolit",)),
    TitleRule("Arsip Berita Lama (Tahun 2024)", ("mulai 2024, pdam cilegon mandiri bakal jual air minum",)),
)
