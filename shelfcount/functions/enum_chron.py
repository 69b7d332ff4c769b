"""Normalise enumeration/chronology strings into n_enum, n_chron, n_enum_chron.

Built-in functions only: no Python worker, no shuffle. A value that is used
twice is bound by ``_let``, so that it is worked out once. All of it is one
expression under a condition: rows with nothing or a bare volume number, which
most are, pass without any of its steps, and no row is copied from step to
step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: word lists and patterns that decide the classification ---
MONTH = (
    r"(?i:(?:jan|january|febr?|february|mar|march|apr|april|may|june?|july?|aug|august|"
    r"sept?|september|oct|october|nov|november|dec|december)[.?]?)"
)
DAY = r"[0-3]?[0-9](?:th|st|rd|nd)?"
LOOSE_DAY = r"(?i:[0-9]{1,4}(?:th|st|rd|nd)?)"
MONTH_OR_SEASON = r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec|spring|summer|winter|fall)"
YEAR = r"^(?:[a-z]{0,7}\.)?[12]\d{3}"
ENUM_MARK = r"v\.|n\.s\."
LONG_NUMBER = r"^[0-9]{5,}"
DOTTED_GAP = r"\.\s+[^.]+"
DOTTED_YEAR = r"^\. [0-2]\d{3}"
PLAIN_NUMBER = r"^(?:v\.)?\d{1,3}$"
# ----------------------------------------------------------------------------

# Spans of dates, each with what a text that holds one has somewhere.
DATE_SPANS = (
    (f"{MONTH} {DAY}-{DAY}", "-"),
    (f"{MONTH}-{MONTH}", "-"),
    (f"{MONTH} {LOOSE_DAY}", " "),
)

OUTPUTS = ("n_enum", "n_chron", "n_enum_chron")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _replace_first(text: Column, literal_pattern: str, replacement: str) -> Column:
    return F.regexp_replace(text, f"(?s)^(.*?){literal_pattern}", "$1" + replacement)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _punctuation(raw: Column) -> Column:
    text = F.translate(F.coalesce(raw, F.lit("")), ",:;", "  ")
    text = F.replace(text, F.lit(" - "), F.lit("-"))
    return F.translate(text, "()\t", "   ")


def _close_gaps(text: Column) -> Column:
    """One ``". "`` becomes ``"."`` for each dotted gap that does not lead to a year.

    The replacement always takes the leftmost gap left, which need not be the
    gap that was counted.
    """
    counted = F.filter(_matches(text, DOTTED_GAP), lambda m: ~m.rlike(DOTTED_YEAR))
    closed = F.when(text.rlike(r"\.\s"), F.aggregate(
        counted, text, lambda acc, _: _replace_first(acc, r"\. ", "."))).otherwise(text)
    closed = _replace_first(closed, r"n\.s\.", "n.s. ")
    return F.regexp_replace(closed, r"\s\s", " ")


def _without(text: Column, found: Column) -> Column:
    return F.aggregate(found, text, lambda acc, m: F.replace(acc, m, F.lit("")))


def _expand_year_months(tokens: Column) -> Column:
    """``1999-Jan`` stands for itself and its month; repeats of it vanish."""
    def unfold(token: Column, i: Column) -> Column:
        first = F.array_position(tokens, token) == i + 1
        both = F.array(token, F.element_at(F.split(token, "-"), 2))
        return (
            F.when(~token.rlike(f"{YEAR}-{MONTH}"), F.array(token))
            .when(first, both)
            .otherwise(F.array().cast("array<string>"))
        )
    return F.flatten(F.transform(tokens, unfold))


def _is_chron(token: Column) -> Column:
    enum = token.rlike(f"{ENUM_MARK}|{LONG_NUMBER}")
    return ~enum & token.rlike(f"{YEAR}|{MONTH_OR_SEASON}")


def _plain(raw: Column) -> Column:
    """The result for what most rows hold: nothing, or a bare volume number."""
    return F.when(F.coalesce(raw, F.lit("")) == "", "").when(
        raw.rlike(PLAIN_NUMBER), F.replace(raw, F.lit("v."), F.lit("")))


def _clean_enum(token: Column) -> Column:
    text = F.regexp_replace(token, r"\.$", "")
    text = F.translate(F.replace(text, F.lit('"\\"'), F.lit("")), '()[],"', "")
    text = F.regexp_replace(text, r"(?i)c[a-z]*\.", "")
    # a letter with digits keeps only the digits; "word.rest" keeps the rest
    text = F.regexp_replace(text, r"(?is)^.*?([a-z])(\d+).*$", "$1.$2")
    return F.regexp_replace(text, r"^.*?\w+\.(.*)$", "$1")


def _join_enums(tokens: Column) -> Column:
    text = F.replace(F.array_join(tokens, ":"), F.lit("::"), F.lit(":"))
    return F.regexp_replace(F.regexp_replace(text, ":$", ""), "^:", "")


def _expand_short_year(chron: Column) -> Column:
    """A two-character year: 1 to 11 belongs to this century, the rest to the last."""
    number = F.regexp_extract(chron, r"^(\d+)", 1).try_cast("int")
    century = F.when((number > 0) & (number < 12), "20").otherwise("19")
    return F.when(F.length(chron) == 2, F.concat(century, chron)).otherwise(chron)


def _take_spans(text: Column) -> Column:
    """(text, spans): the text without its spans of dates, and these."""
    def state(left: Column, spans: Column) -> Column:
        return F.struct(left.alias("text"), spans.alias("spans"))

    def take(before: Column, pattern: str, needed: str) -> Column:
        return _let(before, lambda s: F.when(F.contains(s["text"], F.lit(needed)), _let(
            _matches(s["text"], pattern),
            lambda found: state(_without(s["text"], found), F.concat(s["spans"], found)))).otherwise(s))

    whole = state(text, F.array().cast("array<string>"))
    taken = whole
    for pattern, needed in DATE_SPANS:
        taken = take(taken, pattern, needed)
    return F.when(text.rlike(MONTH_OR_SEASON), taken).otherwise(whole)


def _tokens(text: Column) -> Column:
    """(text, chron) of the words of a text."""
    words = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    given = F.when(text.rlike("[A-Za-z0-9]"), words).otherwise(F.array().cast("array<string>"))
    return F.transform(_let(given, _expand_year_months), lambda t: F.struct(
        t.alias("text"), _is_chron(t).alias("chron")))


def _parsed(raw: Column) -> Column:
    """(n_enum, n_chron) of a text that is not plain."""
    def parts(tokens: Column, spans: Column) -> Column:
        enums = F.transform(F.filter(tokens, lambda t: ~t["chron"]), lambda t: _clean_enum(t["text"]))
        chrons = F.transform(F.filter(tokens, lambda t: t["chron"]), lambda t: F.when(
            t["text"].endswith("-"), F.replace(t["text"], F.lit("-"), F.lit(""))).otherwise(t["text"]))
        return F.struct(_join_enums(enums).alias("n_enum"), _let(
            F.array_join(F.concat(spans, chrons), " "), _expand_short_year).alias("n_chron"))

    closed = _let(_punctuation(raw), _close_gaps)
    return _let(_let(closed, _take_spans), lambda taken: _let(
        _tokens(taken["text"]), lambda tokens: parts(tokens, taken["spans"])))


def with_enum_chron(df: DataFrame, column: str = "enum_chron") -> DataFrame:
    """Add n_enum, n_chron and n_enum_chron, always derived from ``column``."""
    kept = [c for c in df.columns if c not in OUTPUTS]
    plain = F.col("__plain")
    step = df.select(*kept, _plain(F.col(column)).alias("__plain"))
    step = step.select(*kept, "__plain", F.when(plain.isNull(), _parsed(F.col(column))).alias("__parsed"))
    step = step.select(*kept, F.coalesce(plain, F.col("__parsed.n_enum"), F.lit("")).alias("n_enum"),
                       F.coalesce(F.col("__parsed.n_chron"), F.lit("")).alias("n_chron"))
    both = F.concat_ws("\t", "n_enum", "n_chron")
    return step.select(*kept, "n_enum", "n_chron",
                       F.when(both == "\t", "").otherwise(both).alias("n_enum_chron"))
