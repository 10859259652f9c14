"""Row tests as data, printed as SQL of Spark or of DuckDB: the same rule is a plan here and an oracle there.

A Test is a small tree over named columns that hold lower-case text. The printers differ where the engines do: regular
expressions (look-around against consumed borders), quoting, counting and lambdas."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pressmill.functions.url import escaped, folded

SPARK, DUCKDB = "spark", "duckdb"
_IN = r"[\p{L}\p{N}_]"
_OUT = r"[^\p{L}\p{N}_]"


def quote(s: str, engine: str) -> str:
    s = s.replace("'", "''") if engine == DUCKDB else s.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


@dataclass(frozen=True)
class Test:
    """``show(engine)`` is the SQL of a boolean that is never null where its columns are not."""

    show: Callable[[str], str]

    def __and__(self, other: Test) -> Test:
        return Test(lambda e: f"({self.show(e)} AND {other.show(e)})")

    def __or__(self, other: Test) -> Test:
        return Test(lambda e: f"({self.show(e)} OR {other.show(e)})")

    def __invert__(self) -> Test:
        return Test(lambda e: f"(NOT {self.show(e)})")


def sql(template: str, duckdb: str | None = None) -> Test:
    """SQL that both engines read, or one text for each."""
    return Test(lambda e: f"({duckdb if duckdb is not None and e == DUCKDB else template})")


def _borders(pattern: str, engine: str) -> str:
    """The pattern with word borders that know letters beyond ASCII. DuckDB has no look-around: there a border consumes its character."""
    if engine == DUCKDB:
        pattern = pattern.replace(r"\b.*\b", f"{_OUT}(?:.*{_OUT})?").replace(r"\s+.*\b", rf"\s+(?:.*{_OUT})?")
        pattern = re.sub(r"\\s\+(\[\^\\?\.\]\{0,\d+\})\\b", lambda m: rf"\s+(?:{m[1]}{_OUT})?", pattern)
    first, *others = pattern.split(r"\b")
    out = first
    for part in others:
        opens = out == "" or out.endswith(("|", "(", "(?:", "(?i)", ".*", "^", "}"))
        if engine == SPARK:
            out += rf"(?<!{_IN})" if opens else rf"(?!{_IN})"
        else:
            out += rf"(?:^|{_OUT})" if opens else rf"(?:$|{_OUT})"
        out += part
    return out


def _alternatives(patterns: Sequence[str], engine: str) -> str:
    """One pattern for all; those between two borders share them."""
    closed = [p[2:-2] for p in patterns if p.startswith(r"\b") and p.endswith(r"\b") and r"\b" not in p[2:-2] and not re.search(r"\|(?![^(]*\))", p)]
    others = [p for p in patterns if p[2:-2] not in closed]
    shared = [rf"\b(?:{'|'.join(closed)})\b"] if closed else []
    return "|".join(f"(?:{_borders(p, engine)})" for p in shared + others)


def _rlike(field: str, pattern: str, engine: str) -> str:
    return f"{'regexp_matches' if engine == DUCKDB else 'rlike'}({field}, {quote(pattern, engine)})"


def opening(values: Sequence[str]) -> str:
    """A look ahead at the first characters of the values: where none stands, nothing dearer is asked."""
    return f"(?=[{''.join(re.escape(c) for c in sorted({v[0] for v in values}))}])"


def has(field: str, values: Sequence[str]) -> Test:
    """One of the values is a part of the field."""
    return Test(lambda e: _rlike(field, folded(list(values)), e) if e == SPARK else "(" + " OR ".join(f"contains({field}, {quote(v, e)})" for v in values) + ")")


def word(field: str, values: Sequence[str]) -> Test:
    """One of the phrases is in the field between characters of no word."""
    inner = folded(list(values))
    return Test(lambda e: _rlike(field, rf"{opening(values)}(?<!{_IN})(?:{inner})(?!{_IN})" if e == SPARK else rf"(?:^|{_OUT})(?:{'|'.join(map(re.escape, values))})(?:$|{_OUT})", e))


def find(field: str, patterns: Sequence[str]) -> Test:
    """One of the patterns is found in the field."""
    return Test(lambda e: _rlike(field, _alternatives(patterns, e), e))


def one_of(field: str, values: Sequence[str]) -> Test:
    return Test(lambda e: f"{field} IN ({', '.join(quote(v, e) for v in values)})")


def starts(field: str, values: Sequence[str]) -> Test:
    return Test(lambda e: _rlike(field, f"^(?:{escaped(list(values))})", e))


def ends(field: str, values: Sequence[str]) -> Test:
    return Test(lambda e: _rlike(field, f"(?:{escaped(list(values))})$", e))


def any_of(*tests: Test) -> Test:
    return Test(lambda e: "(" + " OR ".join(t.show(e) for t in tests) + ")")


def all_of(*tests: Test) -> Test:
    return Test(lambda e: "(" + " AND ".join(t.show(e) for t in tests) + ")")


@dataclass(frozen=True)
class Number:
    """``show(engine)`` is the SQL of a number."""

    show: Callable[[str], str]

    def __add__(self, other: Number) -> Number:
        return Number(lambda e: f"({self.show(e)} + {other.show(e)})")

    def __sub__(self, other: Number) -> Number:
        return Number(lambda e: f"({self.show(e)} - {other.show(e)})")

    def scaled(self, factor: float) -> Number:
        return Number(lambda e: f"({self.show(e)} * {factor})")

    def compare(self, op: str, other: Number | float) -> Test:
        return Test(lambda e: f"({self.show(e)} {op} {other.show(e) if isinstance(other, Number) else other})")

    def __ge__(self, other: Number | float) -> Test:
        return self.compare(">=", other)

    def __gt__(self, other: Number | float) -> Test:
        return self.compare(">", other)

    def __lt__(self, other: Number | float) -> Test:
        return self.compare("<", other)

    def __le__(self, other: Number | float) -> Test:
        return self.compare("<=", other)


def number(template: str) -> Number:
    return Number(lambda e: template)


def _doubled(field: str) -> str:
    """The field with every character that is of no word twice, so that neighbours can each consume a border."""
    return f"regexp_replace({field}, '({_OUT})', '\\1\\1', 'g')"


def times(field: str, patterns: Sequence[str]) -> Number:
    """Matches of the alternatives, from left to right without overlaps. Blanks inside a pattern with borders are to match repeats of a character."""

    def show(e: str) -> str:
        whole = quote(_alternatives(patterns, e), e)
        if e == SPARK:
            return f"regexp_count({field}, {whole})"
        return f"len(regexp_extract_all({_doubled(field) if any(chr(92) + 'b' in p for p in patterns) else field}, {whole}))"

    return Number(show)


def words(field: str, phrases: Sequence[str]) -> Number:
    """Occurrences of the phrases between characters of no word; one that ends in a blank needs blanks behind it.

    The phrases are counted in one pass, so none may stand inside or reach into another."""
    plain, open_ = [p for p in phrases if not p.endswith(" ")], [p.strip() for p in phrases if p.endswith(" ")]

    def spark() -> str:
        inner = [rf"(?:{folded(plain)})(?!{_IN})"] + [rf"{re.escape(p)}\s+" for p in open_]
        return f"regexp_count({field}, {quote(rf'(?<!{_IN})(?:' + '|'.join(inner) + ')', SPARK)})"

    def duckdb() -> str:  # a border is consumed there, so each is doubled first
        double = lambda p: "".join(c if re.match(r"\w", c) else re.escape(c) * 2 for c in p)
        inner = [rf"(?:{'|'.join(map(double, plain))})(?:$|{_OUT})"] + [rf"{double(p)}\s" for p in open_]
        return f"len(regexp_extract_all({_doubled(field)}, {quote(rf'(?:^|{_OUT})(?:' + '|'.join(inner) + ')', DUCKDB)}))"

    return Number(lambda e: duckdb() if e == DUCKDB else spark())


def case(rules: Sequence[tuple[str | Callable[[str], str], Test]], engine: str) -> str:
    """The name of the first test that holds, else null. A name may be SQL, made by a function of the engine."""
    whens = " ".join(f"WHEN {test.show(engine)} THEN {name(engine) if callable(name) else quote(name, engine)}" for name, test in rules)
    return f"CASE {whens} END"


def cascade(rules: Sequence[tuple[str | Callable[[str], str], Test]], engine: str, size: int = 10) -> str:
    """The same in several CASEs under one coalesce, so that no generated method outgrows the JIT's limit."""
    return "coalesce(" + ", ".join(case(rules[i : i + size], engine) for i in range(0, len(rules), size)) + ")"
