"""URL columns: canonical form, hosts, domain and asset filters. All built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRACKING_PREFIXES = ("utm_", "gaa_", "mtm_", "pk_", "hsa_")
TRACKING_NAMES = ("fbclid", "gclid", "dclid", "yclid", "msclkid", "mc_cid", "mc_eid", "igshid", "srsltid", "ref", "oc", "hl", "gl", "ceid", "_ga", "_gl", "spm", "si", "feature", "guccounter", "guce_referrer", "guce_referrer_sig")
MARKETPLACES = ("shopee.co.id", "tokopedia.com", "bukalapak.com", "lazada.co.id", "blibli.com", "jd.id", "astronauts.id", "grab.com", "researchgate.net", "bible.com")
SOCIAL_MEDIA = ("youtube.com", "instagram.com", "tiktok.com", "wikipedia.org", "x.com", "facebook.com", "twitter.com", "linkedin.com")
JOB_PORTALS = ("glints.com", "kitalulus.com", "bebee.com", "jobstreet.co.id", "jobstreet.com", "kalibrr.com", "karir.com", "loker.id", "indeed.com", "jobsdb.com", "prosple.com")
ASSET_EXTENSIONS = (".mp4", ".jpg", ".jpeg", ".png", ".mp3")
JOB_PATHS = ("/lowongan", "/jobs/", "/job/", "/opportunities/jobs", "/career", "/karir", "/loker")


def escaped(words: tuple[str, ...] | list[str]) -> str:
    """A regular-expression alternation of literal words."""
    return "|".join("".join("\\" + ch if ch in r"\.[]{}()*+-?^$|&/" and ch not in "&/-" else ch for ch in w) for w in words)


def folded(words: tuple[str, ...] | list[str]) -> str:
    """The same alternation with common beginnings folded, longest first: a regular expression engine tries a branch or two at each place instead of all."""
    tree: dict = {}
    for w in words:
        node = tree
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def write(node: dict) -> str:
        branches = [escaped([ch]) + write(sub) for ch, sub in sorted(node.items()) if ch]
        body = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})" if branches else ""
        return f"(?:{body})?" if body and "" in node else body

    return write(tree)


def unwrap_hyperlink(url: Column) -> Column:
    """The address inside a spreadsheet's =HYPERLINK("...", ...) formula."""
    inner = F.regexp_extract(url, r'(?i)^=HYPERLINK\("([^"]*)"', 1)
    return F.trim(F.when(inner != "", inner).otherwise(F.coalesce(url, F.lit(""))))


def host(url: Column) -> Column:
    """Lower-case host without user, port and www."""
    raw = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(raw, r"^www\.", "")


def _query(url: Column) -> Column:
    """Query without tracking and blank parameters, sorted, re-encoded."""
    pairs = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    decoded = F.transform(
        F.filter(pairs, lambda p: F.instr(p, "=") > 0),
        lambda p: F.struct(F.try_url_decode(F.substring_index(p, "=", 1)).alias("k"), F.try_url_decode(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("v")),
    )
    tracked = lambda k: F.lower(k).isin(*TRACKING_NAMES) | F.lower(k).rlike("^(" + "|".join(TRACKING_PREFIXES) + ")")
    kept = F.array_sort(F.filter(decoded, lambda x: (x["v"] != "") & ~tracked(x["k"])))
    return F.array_join(F.transform(kept, lambda x: F.concat(F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "&")


def canonical(url: Column) -> Column:
    """The identity of an article: https, bare lower host, collapsed path, sorted query without tracking."""
    u = unwrap_hyperlink(url)
    h = host(u)
    path = F.regexp_replace(F.regexp_extract(u, r"^[^?#]*?://[^/?#]*(/[^?#]*)", 1), "/{2,}", "/")
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(F.lit("/"))
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = _query(u)
    plain = F.concat(F.lit("https://"), F.regexp_replace(h, r"^m\.youtube\.com$", "youtube.com"), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    news = F.regexp_extract(path, r"/(?:articles|read)/([^/]+)", 1)
    short = F.when(h == "youtu.be", F.regexp_extract(path, "^/([^/]+)", 1)).when(h.rlike(r"(^|\.)youtube\.com$"), F.regexp_extract(path, "^/shorts/([^/]+)", 1)).otherwise("")
    bare = F.lower(F.regexp_replace(F.substring_index(u, "?", 1), "/+$", ""))
    return (
        F.when(h == "", bare)
        .when((h == "news.google.com") & (news != ""), F.concat(F.lit("https://news.google.com/articles/"), news))
        .when(short != "", F.concat(F.lit("https://youtube.com/watch?v="), short))
        .otherwise(plain)
    )


def link_key(url: Column) -> Column:
    """The weaker key of archives: trimmed, no trailing slash, lower case."""
    return F.lower(F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), "/+$", ""))


def is_valid_domain(url: Column) -> Column:
    """Not an asset, job page or village/school site; government hosts pass; marketplaces, social media and job portals do not."""
    lower, h = F.lower(url), host(url)
    ends = lambda names: h.rlike("(^|\\.)(" + escaped(names) + ")$")
    asset = F.regexp_replace(lower, r"[?#].*$", "").rlike("(" + escaped(ASSET_EXTENSIONS) + ")$")
    job = lower.rlike("(" + "|".join(JOB_PATHS) + ")")
    local = h.rlike(r"\.(sch|desa)\.id$")
    return F.when(F.coalesce(url, F.lit("")) == "", False).when(asset | job | local, False).when(h.rlike(r"(^|\.)go\.id$"), True).otherwise(~ends(MARKETPLACES + SOCIAL_MEDIA + JOB_PORTALS))


def is_decoded(url: Column) -> Column:
    """A usable article address: http(s), a dotted host that is no search host, not a bare home page, valid domain."""
    h = host(url)
    path = F.regexp_extract(url, r"^[^?#]*?://[^/?#]*(/[^?#]*)", 1)
    bare = path.isin("", "/") & ~F.contains(url, F.lit("?"))
    return url.rlike("(?i)^https?://") & h.contains(".") & ~h.rlike(r"(^|\.)google\.[a-z.]+$") & ~bare & is_valid_domain(url)


def first_usable(urls: Column) -> Column:
    """The first usable address of an ordered array; null where there is none."""
    return F.try_element_at(F.filter(urls, is_decoded), F.lit(1))
