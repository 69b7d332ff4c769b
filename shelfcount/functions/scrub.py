"""Checks and clean-up of the fields of a member submission (built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcount.schemas import STATUSES

# --- Fixed values: delimiters, prefixes and patterns of the submission format
OCN_DELIMITER = r"[,:;|/ ]+"
LIST_DELIMITER = r"[,; ]+"
EXPONENTIAL = r"\d[Ee]\+?\d"
DIGIT_MIX = r"^\d+\D"
PAREN_PREFIX = r"^\(.+?\)"
PREFIX = r"^\D+"
OK_PAREN_PREFIX = r"(?i)\((oclc|ocm|ocn|ocolc|on)\)"
OK_PREFIX = r"(?i)(oclc|ocm|ocn|ocolc|on)"
ISSN = r"^\d{4}-?\d{3}[0-9Xx]$"
LOCAL_ID_MAX = 50
MANY = 25
#: Candidates that pass every check but the size of the number: an allowed prefix or none, then the number.
GOOD = r"^(?:\((?i:oclc|ocm|ocn|ocolc|on)\)|(?i:oclc|ocm|ocn|ocolc|on))?0*([1-9]\d{0,17})\z"
WHITESPACE = " \t\n\x0b\f\r\x00"

EMPTY = "ocn is empty"
IN_EXPONENT = "is in exponential format"
MIXED = "is mix of digits and non-digits"
BAD_PAREN = "invalid paren prefix"
BAD_PREFIX = "invalid prefix"
NO_NUMBER = "numeric part is nil"
ZERO = "numeric part is zero"
TOO_LARGE = "too large for an ocn"
# ----------------------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def ocn_candidates(raw: Column, max_ocn: int) -> Column:
    """Array of struct(candidate, ocn, reason); exactly one of ocn and reason is set.

    A prefix is accepted when it merely contains an allowed one.
    """
    text = F.coalesce(raw, F.lit(""))
    # Each stage binds what the next one looks at more than once: patterns take most of the time.
    # delimiters at the end part nothing; an empty field, or one of delimiters only, has no candidate
    cut = F.when(text.rlike("[,:;|/ ]"), F.split(F.regexp_replace(text, OCN_DELIMITER + "$", ""), OCN_DELIMITER, -1)).otherwise(
        F.array(text))
    seen = F.transform(F.transform(cut, strip), lambda c: F.struct(
        c.alias("candidate"), F.regexp_extract(c, GOOD, 1).alias("digits")))
    found = F.transform(seen, lambda c: F.struct(c["candidate"].alias("candidate"), _number(c["digits"]).alias("ocn")))
    judged = F.transform(found, lambda c: F.when(c["ocn"] <= max_ocn, F.struct(
        c["candidate"].alias("candidate"), c["ocn"].alias("ocn"), F.lit(None).cast("string").alias("reason"))).otherwise(
        _judged(c["candidate"], max_ocn)))
    none = F.array().cast("array<struct<candidate:string,ocn:bigint,reason:string>>")
    return F.when(text.rlike("[^,:;|/ ]"), judged).otherwise(none)


def _judged(candidate: Column, max_ocn: int) -> Column:
    """struct(candidate, ocn, reason), through all the checks."""
    found = F.transform(F.transform(F.array(candidate), _parts), lambda p: _judge(p, max_ocn))
    return F.transform(found, lambda f: F.struct(
        f["candidate"].alias("candidate"), F.when(f["reason"].isNull(), f["ocn"]).alias("ocn"),
        f["reason"].alias("reason")))[0]


def _number(digits: Column) -> Column:
    """Digits without zeros in front as a number, or null. What cannot be one is not cast: a cast that fails raises an
    error inside, which takes longer than all the patterns."""
    return F.when(F.length(digits).between(1, 19), digits.try_cast("bigint"))


def _parts(candidate: Column) -> Column:
    return F.struct(
        candidate.alias("candidate"),
        F.regexp_extract(candidate, PAREN_PREFIX, 0).alias("paren"),
        F.regexp_extract(candidate, PREFIX, 0).alias("prefix"),
        F.regexp_extract(candidate, r"0*(\d+)", 1).alias("digits"),
    )


def _judge(part: Column, max_ocn: int) -> Column:
    candidate, paren, prefix, digits = (part[n] for n in ("candidate", "paren", "prefix", "digits"))
    number = _number(digits)
    reason = (
        F.when(candidate == "", EMPTY)
        .when(candidate.rlike(EXPONENTIAL), IN_EXPONENT)
        .when(candidate.rlike(DIGIT_MIX), MIXED)
        .when((paren != "") & ~paren.rlike(OK_PAREN_PREFIX), BAD_PAREN)
        .when((paren == "") & (prefix != "") & ~prefix.rlike(OK_PREFIX), BAD_PREFIX)
        .when(digits == "", NO_NUMBER)
        .when(digits == "0", ZERO)
        .when(number.isNull() | (number > F.lit(max_ocn)), TOO_LARGE)
    )
    return F.struct(candidate.alias("candidate"), number.alias("ocn"), reason.alias("reason"))


def valid_ocns(candidates: Column) -> Column:
    """Distinct accepted numbers, in order of appearance."""
    return F.array_distinct(F.transform(F.filter(candidates, lambda c: c["ocn"].isNotNull()),
                                        lambda c: c["ocn"]))


def reject_reasons(candidates: Column) -> Column:
    """One reason per refused candidate; a lone empty field has nothing to refuse."""
    refused = F.filter(candidates, lambda c: c["reason"].isNotNull())
    return F.transform(refused, lambda c: c["reason"])


def prefixes(candidates: Column) -> Column:
    """Prefixes that candidates begin with, in the order in which they are looked at, as far as that gets."""
    seen = F.filter(candidates, lambda c: ~F.coalesce(c["reason"], F.lit("")).isin(EMPTY, IN_EXPONENT, MIXED))
    cut = F.transform(seen, lambda c: F.when(
        c["candidate"].rlike(PAREN_PREFIX), F.regexp_extract(c["candidate"], PAREN_PREFIX, 0)).otherwise(
        F.regexp_extract(c["candidate"], PREFIX, 0)))
    return F.filter(cut, lambda p: p != "")


def local_ids(raw: Column) -> Column:
    """Candidates of the field; delimiters at the end part nothing."""
    text = strip(raw)
    return F.when(text.rlike("[^,; ]"),
                  F.split(F.regexp_replace(text, LIST_DELIMITER + "$", ""), LIST_DELIMITER)).otherwise(
        F.when(raw.isNotNull(), F.array().cast("array<string>")))


def too_long(ids: Column) -> Column:
    return F.filter(ids, lambda p: F.length(p) > LOCAL_ID_MAX)


def local_id(raw: Column) -> Column:
    return joined_ids(F.coalesce(local_ids(raw), F.array().cast("array<string>")))


def joined_ids(ids: Column) -> Column:
    """Those of the candidates that are not too long, each once."""
    return F.array_join(F.array_distinct(F.filter(ids, lambda p: F.length(p) <= LOCAL_ID_MAX)), ",")


def issn(raw: Column) -> Column:
    return F.array_join(F.filter(F.split(raw, LIST_DELIMITER), lambda p: p.rlike(ISSN)), ";")


def refused_issns(raw: Column) -> Column:
    """Candidates that are no ISSN; an empty field has none, and delimiters at the end part nothing."""
    cut = F.split(F.regexp_replace(raw, LIST_DELIMITER + "$", ""), LIST_DELIMITER)
    return F.when(raw.rlike("[^,; ]"), F.filter(cut, lambda p: ~p.rlike(ISSN)))


def status(raw: Column) -> Column:
    return _allowed(raw, *STATUSES)


def condition(raw: Column) -> Column:
    return _allowed(raw, "BRT")


def gov_doc(raw: Column) -> Column:
    return _allowed(raw, "0", "1")


def _allowed(raw: Column, *values: str) -> Column:
    value = strip(raw)
    return F.when(value.isin(*values), value)


def unknown_value(raw: Column, *values: str) -> Column:
    """True where a field holds something outside its allow-list."""
    value = strip(raw)
    return (value != "") & ~value.isin(*values)


def int_list(raw: Column) -> Column:
    """``"1,2"`` to integers; a non-number counts as its leading digits, or 0."""
    return F.transform(F.filter(F.split(raw, ","), lambda x: x != ""),
                       lambda x: F.coalesce(F.regexp_extract(x, r"^\s*(\d+)", 1).try_cast("bigint"),
                                            F.lit(0).cast("bigint")))


def fold_blank(c: Column) -> Column:
    """Blank and missing are the same for equality."""
    text = c.cast("string")
    return F.when(text != "", text)
