"""Rights, access, format code and holding-state predicates.

Four rights predicates exist on purpose: cost counts ``icus`` as public
domain, access denies it inside the record, shows it as allowed outside the
US, and the deposit analysis includes it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcount.schemas import IC_RIGHTS, ICUS


def is_ic(rights: str | Column) -> Column:
    """Holders of the item share its cost."""
    return _col(rights).isin(*IC_RIGHTS)


def is_ic_or_icus(rights: str | Column) -> Column:
    """Items looked at by the deposit analysis."""
    return _col(rights).isin(*IC_RIGHTS, ICUS)


def has_ic_item(items: str | Column) -> Column:
    """A catalogue record with at least one in-copyright item (array of structs)."""
    return F.exists(_col(items), lambda i: F.coalesce(is_ic(i["rights"][0]), F.lit(False)))


def record_access(rights: str | Column) -> Column:
    return F.when(is_ic_or_icus(rights), "deny").otherwise("allow")


def table_access(flag: str | Column) -> Column:
    return F.when(_col(flag), "allow").otherwise("deny")


def access_for_country(rights: str | Column, access: str | Column, country: str | Column) -> Column:
    """Access as shown to an organisation: outside the US, ``pdus`` and ``icus`` swap."""
    abroad = ~_col(country).eqNullSafe("us")
    return (
        F.when(abroad & (_col(rights) == "pdus"), "deny")
        .when(abroad & (_col(rights) == ICUS), "allow")
        .otherwise(_col(access))
    )


def bib_format(formats: str | Column) -> Column:
    """SE / BK / XX from the record's format list."""
    return (
        F.when(F.array_contains(_col(formats), "Serial"), "SE")
        .when(F.array_contains(_col(formats), "Book"), "BK")
        .otherwise("XX")
    )


def is_current(status: str | Column = "status") -> Column:
    """No status means the copy is currently held."""
    return _col(status).isNull() | (_col(status) == "CH")


def is_brittle(condition: str | Column = "condition") -> Column:
    return _col(condition).eqNullSafe("BRT")


def gives_access(condition: str | Column = "condition", status: str | Column = "status") -> Column:
    return is_brittle(condition) | _col(status).eqNullSafe("LM")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
