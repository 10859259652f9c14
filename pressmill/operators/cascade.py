"""Ordered rule cascades: rules as data, compiled to first-match-wins expressions.

A rule is (reason, predicate); the first true predicate names the reason and null means kept. Long cascades are
cut into several CASE columns under one coalesce, so that no generated method outgrows the JIT's limit. Word
lists are folded into one alternation per rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import count_words, has_word
from pressmill.functions.url import escaped, host

#: Branches of one CASE.
CHUNK = 40


@dataclass(frozen=True)
class Rule:
    """A predicate over named columns. kind: contains (substring of a column), words (whole words), regex, shorter, host, expr."""

    reason: str
    kind: str
    column: str = "title"
    values: tuple[str, ...] = ()
    unless: tuple[str, ...] = ()

    def predicate(self) -> Column:
        c = F.coalesce(F.col(self.column), F.lit("")) if self.kind != "expr" else None
        if self.kind == "contains":
            test = F.lower(c).rlike(escaped(self.values))
        elif self.kind == "words":
            test = has_word(c, self.values)
        elif self.kind == "regex":
            test = c.rlike("(?i)" + "|".join(f"(?:{v})" for v in self.values))
        elif self.kind == "shorter":
            test = F.length(F.trim(c)) < int(self.values[0])
        elif self.kind == "host":
            test = host(c).rlike("(^|\\.)(" + escaped(self.values) + ")$")
        else:
            test = F.expr(self.values[0])
        if self.unless:
            test = test & ~F.lower(F.coalesce(F.col(self.column if self.kind != "expr" else "title"), F.lit(""))).rlike(escaped(self.unless))
        return F.coalesce(test, F.lit(False))


def reason(rules: Sequence[Rule]) -> Column:
    """The first rule that holds, else null."""
    columns = []
    for i in range(0, len(rules), CHUNK):
        case = None
        for rule in rules[i : i + CHUNK]:
            case = F.when(rule.predicate(), rule.reason) if case is None else case.when(rule.predicate(), rule.reason)
        columns.append(case)
    return F.coalesce(*columns)


def cascade(df: DataFrame, rules: Sequence[Rule], accept: Column | None = None) -> DataFrame:
    """df with discard_reason (null: kept); accepted rows skip every rule."""
    found = reason(rules)
    return df.withColumn("discard_reason", found if accept is None else F.when(accept, F.lit(None)).otherwise(found))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter("discard_reason is null"), df.filter("discard_reason is not null")


def histogram(df: DataFrame) -> DataFrame:
    """Rows per reason, 'other' for an empty one, of the discarded."""
    return df.filter("discard_reason is not null").groupBy(F.coalesce(F.nullif("discard_reason", F.lit("")), F.lit("other")).alias("reason")).agg(F.count("*").alias("n"))


#: A cascade for any language's documents, by the same compiler: over title, url, text, source.
NEUTRAL = (
    Rule("title_too_short", "shorter", "title", ("5",)),
    Rule("too_short", "shorter", "text", ("300",)),
    Rule("licence_line", "contains", "text", ("licensed under the", "all rights reserved")),
    Rule("symbol_noise", "regex", "title", (r"[#*$%&|]{3}",)),
    Rule("insult", "words", "text", ("idiot", "scum", "moron")),
    Rule("table_row", "regex", "title", (r"\w \| \w",)),
)


def primary_topic(title: Column, text: Column, terms: tuple[str, ...], least: int = 2) -> Column:
    """Whether a term is in the title, or one occurs at least twice in the text."""
    return has_word(title, terms) | F.greatest(*(count_words(text, [t]) for t in terms), F.lit(0)).__ge__(least)
