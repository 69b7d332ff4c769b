"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the agreed data formats -----------------
IC_RIGHTS = ("ic", "op", "und", "nobody", "pd-pvt")
ICUS = "icus"
ITEM_TYPES = ("mix", "mon", "spm", "mpm", "ser")
FORMATS = ("spm", "mpm", "ser")
STATUSES = ("CH", "LM", "WD")
MAX_STORED_OCN = 2147483647
LEGACY_ITEM_TYPES = {"mono": "spm", "multi": "mpm", "serial": "ser"}

# Columns a submission may carry, by item type: (required, optional).
SUBMISSION_COLUMNS = {
    "mix": (("oclc", "local_id"), ("govdoc",)),
    "mon": (("oclc", "local_id"), ("status", "condition", "govdoc", "enum_chron")),
    "spm": (("oclc", "local_id"), ("status", "condition", "govdoc")),
    "mpm": (("oclc", "local_id", "enum_chron"), ("status", "condition", "govdoc")),
    "ser": (("oclc", "local_id"), ("govdoc", "issn")),
}
# ----------------------------------------------------------------------------

# The counters carried through every overlap computation, in report order.
COUNTERS = ("n", "cur", "brt", "wd", "lm", "access", "cur_brt", "cur_ok")

HOLDING = T.StructType([
    T.StructField("ocn", T.LongType()),
    T.StructField("local_id", T.StringType()),
    T.StructField("organization", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("condition", T.StringType()),
    T.StructField("enum_chron", T.StringType()),
    T.StructField("mono_multi_serial", T.StringType()),
    T.StructField("issn", T.StringType()),
    T.StructField("gov_doc_flag", T.BooleanType()),
    T.StructField("uuid", T.StringType()),
    T.StructField("date_received", T.DateType()),
])

# Identity and arrival date do not take part in holding equality.
HOLDING_EQUALITY = tuple(
    f.name for f in HOLDING.fields if f.name not in ("uuid", "date_received")
) + ("n_enum", "n_chron", "n_enum_chron")

CONCORDANCE = T.StructType([
    T.StructField("variant", T.LongType()),
    T.StructField("canonical", T.LongType()),
])

LOADED_FILE = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("produced", T.DateType()),
    T.StructField("loaded", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("type", T.StringType()),
])

# One exported catalogue record per line. Field names are fixed by the export.
CATALOG_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("format", T.ArrayType(T.StringType())),
    T.StructField("oclc", T.ArrayType(T.StringType())),
    T.StructField("oclc_search", T.ArrayType(T.StringType())),
    T.StructField("title", T.ArrayType(T.StringType())),
    T.StructField("deleted", T.BooleanType()),
    T.StructField("ht_json", T.StringType()),
])
CATALOG_ITEMS = T.ArrayType(T.StructType([
    T.StructField("htid", T.StringType()),
    T.StructField("rights", T.ArrayType(T.StringType())),
    T.StructField("enumcron", T.StringType()),
    T.StructField("collection_code", T.StringType()),
]))

# organization -> format -> bucket (number of members) -> frequency
FREQUENCY_JSON = T.MapType(
    T.StringType(),
    T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType())),
)

# MARC-XML record as read with rowTag "record".
_SUBFIELD = T.StructType([
    T.StructField("_VALUE", T.StringType()),
    T.StructField("_code", T.StringType()),
])
MARC_RECORD = T.StructType([
    T.StructField("leader", T.StringType()),
    T.StructField("controlfield", T.ArrayType(T.StructType([
        T.StructField("_VALUE", T.StringType()),
        T.StructField("_tag", T.StringType()),
    ]))),
    T.StructField("datafield", T.ArrayType(T.StructType([
        T.StructField("_tag", T.StringType()),
        T.StructField("subfield", T.ArrayType(_SUBFIELD)),
    ]))),
])
