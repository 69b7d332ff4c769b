"""Fields of a MARC-XML holdings export as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcount.functions.scrub import strip

# --- Fixed values: code lists of the export ---------------------------------
TYPE_BY_LEADER = {"s": "ser", "m": "mon"}
BRITTLE_CONDITIONS = ("BRITTLE", "DAMAGED", "DETERIORATING", "FRAGILE")
LOST_STATUSES = ("LOST_ILL", "LOST_LOAN", "MISSING")
NO_ITM = "Record rejected for lacking an ITM field"
NO_035 = "Record rejected for missing 035a (ocn)"
NO_008 = "Record rejected for missing 008 field"
NO_ITM_ID = "Record rejected for an ITM field without local id"
NO_001 = "Record rejected for missing 001 field"
BAD_TYPE = "unexpected item type mix"
MON_COLUMNS = ("oclc", "local_id", "status", "condition", "enum_chron", "govdoc")
SER_COLUMNS = ("oclc", "local_id", "issn", "govdoc")
# ----------------------------------------------------------------------------


def _field(tag: str) -> Column:
    """First data field with the tag, or NULL."""
    return F.get(F.filter("datafield", lambda d: d["_tag"] == tag), F.lit(0))


def _sub(tag: str, code: str) -> Column:
    found = F.filter(_field(tag)["subfield"], lambda s: s["_code"] == code)
    return F.get(found, F.lit(0))["_VALUE"]


def _control(tag: str) -> Column:
    return F.get(F.filter("controlfield", lambda c: c["_tag"] == tag), F.lit(0))["_VALUE"]


def item_type() -> Column:
    code = F.substring("leader", 8, 1)
    kind = F.lit("mix")
    for letter, name in TYPE_BY_LEADER.items():
        kind = F.when(code == letter, name).otherwise(kind)
    return kind


def _is_us_document(fixed: Column) -> Column:
    place = F.substring(F.lower(fixed), 16, 3)
    federal = F.substring(F.lower(fixed), 29, 1) == "f"
    return federal & ((F.substring(place, 3, 1) == "u") | F.substring(place, 1, 2).isin("pr", "us"))


def marc_holding() -> Column:
    """struct(item_type, oclc, local_id, status, condition, enum_chron, issn, govdoc, error)."""
    kind = item_type()
    serial = kind == "ser"
    itm, fixed = _field("ITM"), _control("008")
    error = (
        F.when(kind == "mix", BAD_TYPE)
        .when(_field("035").isNull() | _sub("035", "a").isNull(), NO_035)
        .when(~serial & itm.isNull(), NO_ITM)
        .when(~serial & _sub("ITM", "d").isNull(), NO_ITM_ID)
        .when(serial & _control("001").isNull(), NO_001)
        .when(fixed.isNull(), NO_008)
    )
    parts = F.array(*[_sub("ITM", code) for code in ("a", "b", "i", "j")])
    enum_chron = F.array_join(
        F.transform(F.filter(parts, lambda p: p.isNotNull() & (p != "")), strip), ",")
    govdoc = F.when(_is_us_document(fixed), "1").otherwise("0")
    cells = {
        "item_type": kind,
        "oclc": strip(_sub("035", "a")),
        "local_id": strip(F.when(serial, _control("001")).otherwise(_sub("ITM", "d"))),
        "status": F.when(serial, "").when(_sub("ITM", "k").isin(*LOST_STATUSES), "LM").otherwise("CH"),
        "condition": F.when(_sub("ITM", "c").isin(*BRITTLE_CONDITIONS), "BRT").otherwise(""),
        "enum_chron": enum_chron,
        "issn": F.when(serial, F.coalesce(_sub("022", "a"), F.lit(""))).otherwise(""),
        "govdoc": govdoc,
    }
    one_line = [F.replace(c, F.lit("\n"), F.lit("")).alias(name) for name, c in cells.items()]
    return F.struct(*one_line, error.alias("error"))
