"""PII detection, in Spark expressions only.

Regular expressions propose spans, checksums (Luhn, mod-97) and digit counts confirm them, and context words
near a span move its score. Base kinds (email, ip, card, phone) are always kept once confirmed; the further
kinds (iban, ssn, secret) are kept when their score reaches ``keep_score``.

The patterns are possessive and anchored at the start of a run of their own characters (or at the end of the
match before, ``\\G``), so that each is linear in the text and recursion-free, and finds the same leftmost
non-overlapping matches as the plain form. An IBAN is as long as those of its country and takes only its head, so
neither capital words behind it nor an unconfirmed proposal before it hide one. Positions are running sums, made in
blocks of ``BLOCK`` matches, and the words near a span are read from chunks of ``CHUNK`` characters, so that a text
of megabytes with a match in every line takes seconds.

Edge cases: null and empty texts have no spans (n_* 0, the hash of nothing); texts of any length are read
whole; repeated rows and null ids give one output row each; other columns pass through
(a clashing ``pii`` is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.llm._common import whole_row

BASE_KINDS = ("email", "ip", "card", "phone")
#: Country code and length of an IBAN.
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
    "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
    "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
    "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 "
    "YE30 "
).split()}


def _iban() -> str:
    """The head of an IBAN, with all of it in group 1: as long as its country's are, or up to 34 characters for a code that is not listed."""
    rest = r"[0-9]{2}(?:\x20?[A-Z0-9])"
    of_length = (f"(?:{'|'.join(c for c, m in IBAN_LENGTHS.items() if m == n)}){rest}{{{n - 4}}}" for n in sorted(set(IBAN_LENGTHS.values())))
    other = f"(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}{rest}{{11,30}}"
    return rf"(?<![A-Za-z0-9])(?=((?:{'|'.join([*of_length, other])})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}"


#: Names before an assigned secret.
_SECRET_NAMES = "token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key"


def _secret() -> str:
    """A value assigned to the name of a secret, a key of a published format, or the head of a private key."""
    assigned = rf"(?<=(?i:{_SECRET_NAMES})[\"']?[\x20]{{0,2}}[:=][\x20]{{0,2}}[\"']?)[A-Za-z0-9+/_.-]{{16,}}+={{0,2}}"
    formats = r"AKIA[0-9A-Z]{16}|gh[opsur]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_-]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
    return rf"(?<![A-Za-z0-9+/_.-])(?:{assigned}|{formats}|-----BEGIN [A-Z ]{{0,20}}PRIVATE KEY-----)"


#: kind -> (pattern, cheap test that a text can hold a match, score before context, context words)
PATTERNS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "instr({t}, '@') > 0", 0.8, "mail|contact|write|reply"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "rlike({t}, '[0-9]\\\\.[0-9]')", 0.6, "ip|host|server|address|login"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "rlike({t}, '[0-9][ 0-9-]{{14}}')", 0.8, "card|visa|credit|payment|pay"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "instr({t}, '+') > 0", 0.6, "call|phone|tel|mobile|fax"),
    "iban": (_iban(), "rlike({t}, '[A-Z]{{2}}[0-9]{{2}}[ A-Z0-9]{{11}}')", 0.9, "iban|bank|account|transfer"),
    "secret": (_secret(), f"rlike({{t}}, '(?i:{_SECRET_NAMES})[\"\\']? ?[:=]|AKIA|gh[a-z]_|sk-|xox|PRIVATE KEY')", 0.6, "token|secret|key|password|credential"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "rlike({t}, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}')", 0.3, "ssn|social security|taxpayer"),
}
#: kind -> characters that a match takes from the text, where the proposed text (group 1) goes on beyond them.
HEADS = {"iban": 4}
CONTEXT_CHARS = 40
BLOCK, CHUNK = 128, 512
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _valid(kind: str, m: str) -> str:
    """SQL test that the proposed text m is confirmed."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    at = f"cast(substring({digits}, i, 1) as int)"
    if kind == "ip":
        return f"rlike({m}, {_quote(f'^{_OCTET}(?:[.]{_OCTET}){{3}}$')})"
    if kind == "card":
        double = f"(length({digits}) - i) % 2 = 1"
        total = f"aggregate(sequence(1, length({digits})), 0, (a, i) -> a + if({double}, {at} * 2 - if({at} > 4, 9, 0), {at}))"
        return f"(if(length({digits}) between 16 and 19, {total} % 10 = 0, false))"
    if kind == "phone":
        return f"length({digits}) between 8 and 15"
    if kind == "secret":
        return f"(rlike({m}, '[0-9]') and rlike({m}, '[A-Za-z]') or {m} like '%PRIVATE KEY%')"
    if kind == "iban":
        compact = f"replace({m}, ' ', '')"
        turned = f"concat(substring({compact}, 5), substring({compact}, 1, 4))"
        c = f"substring({turned}, i, 1)"
        step = f"if({c} <= '9', (a * 10 + cast({c} as int)) % 97, (a * 100 + ascii({c}) - 55) % 97)"
        return f"aggregate(sequence(1, length({turned})), 0, (a, i) -> {step}) = 1"
    return "true"


_SPAN = "struct<s:int,e:int,m:string>"


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _fold(items: str, step: str) -> str:
    """The spans that step (b: p, o; x: item) appends, item by item: a fold of each block, its spans appended as one."""
    of_block = f"aggregate(slice(q, i * {BLOCK} + 1, {BLOCK}), named_struct('p', a.p, 'o', cast(array() as array<{_SPAN}>)), (b, x) -> {step})"
    joined = _let(of_block, "r", "named_struct('p', r.p, 'o', array_append(a.o, r.o))")
    blocks = f"if(size(q) = 0, cast(array() as array<int>), sequence(0, cast((size(q) - 1) div {BLOCK} as int)))"
    return _let(items, "q", f"flatten(aggregate({blocks}, named_struct('p', 0, 'o', cast(array() as array<array<{_SPAN}>>)), (a, i) -> {joined}, a -> a.o))")


def _positions(found: str, gaps: str, head: int | None = None) -> str:
    """Spans of proposed texts, from these texts and the text between the matches (of head characters, or the whole proposed text)."""
    span = "named_struct('s', b.p + x.g, 'e', b.p + x.g + length(x.m), 'm', x.m)"
    step = f"named_struct('p', b.p + x.g + {head or 'length(x.m)'}, 'o', array_append(b.o, {span}))"
    return _fold(f"filter(zip_with({found}, {gaps}, (m, g) -> named_struct('m', m, 'g', length(g))), y -> y.m is not null)", step)


def _apart(spans: str) -> str:
    """The spans without those that start inside one kept before."""
    return _fold(spans, "if(x.s < b.p, b, named_struct('p', x.e, 'o', array_append(b.o, x)))")


def _chunks(text: str) -> str:
    """Column _c: the text in chunks where it is long, else empty."""
    return f"if(length({text}) > {8 * CHUNK}, regexp_extract_all({text}, '(?s).{{1,{CHUNK}}}', 0), cast(array() as array<string>))"


def _piece(text: str, start: str, size: str) -> str:
    """size characters of the text from start (0-based), read from its chunks _c where it has some."""
    k = f"cast(({start}) div {CHUNK} as int)"
    chunked = f"substring(array_join(slice(_c, {k} + 1, cast(({start} + {size}) div {CHUNK} as int) - {k} + 1), ''), ({start}) % {CHUNK} + 1, {size})"
    return f"if(size(_c) = 0, substring({text}, {start} + 1, {size}), {chunked})"


def detect(docs: DataFrame, text: str = "text", keep_score: float = 0.5) -> DataFrame:
    """Add ``pii``: array of struct(kind, start, end, score), by kind in PATTERNS order, then start; offsets in code points, end exclusive."""
    docs = docs.drop("pii")
    df = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_t"), whole_row(docs)).withColumn("_c", F.expr(_chunks("_t")))
    for kind, (pattern, can, _, _) in PATTERNS.items():
        none = "cast(array() as array<string>)"
        df = df.withColumn(f"_m_{kind}", F.expr(f"if({can.format(t='_t')}, regexp_extract_all(_t, {_quote(pattern)}, {int(kind in HEADS)}), {none})"))
    for kind, (pattern, *_) in PATTERNS.items():
        none = f"cast(array() as array<{_SPAN}>)"
        df = df.withColumn(f"_p_{kind}", F.expr(f"if(size(_m_{kind}) = 0, {none}, {_positions(f'_m_{kind}', f'split(_t, {_quote(pattern)}, -1)', HEADS.get(kind))})"))
    parts = []
    for kind, (_, _, score, words) in PATTERNS.items():
        first = f"greatest(0, x.s - {CONTEXT_CHARS})"
        around = f"lower({_piece('_t', first, f'(x.e - x.s + {2 * CONTEXT_CHARS})')})"
        scored = f"least(1.0D, {score}D + if(rlike({around}, {_quote(words)}), 0.25D, 0D) - if(rlike({around}, 'example|sample|dummy'), 0.15D, 0D))"
        confirmed = f"filter(_p_{kind}, x -> {_valid(kind, 'x.m')})"
        spans = f"transform({_apart(confirmed) if kind in HEADS else confirmed}, x -> named_struct('kind', '{kind}', 'start', x.s, 'end', x.e, 'score', {scored}))"
        parts.append(spans if kind in BASE_KINDS else f"filter({spans}, x -> x.score >= {keep_score}D)")
    return df.select("_row.*", F.expr(f"concat({', '.join(parts)})").alias("pii"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace each span of ``pii`` (see detect) by <kind>; spans inside an earlier one go with it."""
    kept = _apart("array_sort(transform(_pii, x -> named_struct('s', x.start, 'e', x.end, 'm', x.kind)))")
    before = "if(i = 0, 0, element_at(_kept, i).e)"
    pieces = f"transform(_kept, (x, i) -> concat({_piece('_t', before, f'(x.s - {before})')}, '<', x.m, '>'))"
    last = "element_at(_kept, -1).e"
    df = docs.select(whole_row(docs), F.col(text).alias("_t"), F.col("pii").alias("_pii"))
    df = df.withColumn("_c", F.expr(_chunks("_t"))).withColumn("_kept", F.expr(kept))
    masked = F.when(F.size("_kept") > 0, F.expr(f"concat(array_join({pieces}, ''), {_piece('_t', last, f'(length(_t) - {last})')})")).otherwise(F.col("_t"))
    return df.select(*((masked if c == text else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    found = detect(docs.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda x: x["kind"].isin(*BASE_KINDS))
    scores = F.array_join(F.transform("pii", lambda x: F.format_number(x["score"], 2)), ",").alias("scores")
    others = [count(kind) for kind in PATTERNS if kind not in BASE_KINDS]
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"), scores, *others, F.size("pii").cast("long").alias("n_spans"))
