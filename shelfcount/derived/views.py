"""Domain tables over the test tables, as SQL that Spark and DuckDB read alike.

``{name}`` stands for a base table or an earlier view. Every view covers its
whole base table; conditions only choose between cases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcount.functions.enum_chron import with_enum_chron
from shelfcount.operators.dimensions import with_billing_entity
from shelfcount.session import materialize, spread

CENTRAL = "central"
TARGET_COST = 10000.0
MAX_OCN = 2000000000

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "organizations": """
        SELECT CASE WHEN n_nationkey = 0 THEN 'central' ELSE n_name END AS inst_id,
               CASE WHEN n_regionkey = 1 THEN 'us' ELSE 'zz' END AS country_code,
               CAST(CASE WHEN n_nationkey = 0 THEN 0 ELSE (n_nationkey % 5) * 0.5 END AS DOUBLE) AS weight,
               n_nationkey % 8 <> 7 AS status,
               CASE WHEN n_nationkey = 0 THEN 'central'
                    WHEN n_nationkey % 6 = 5 THEN 'NATION_' || (n_nationkey - 1)
                    ELSE n_name END AS mapto_inst_id
        FROM {nation}""",
    "collections": """
        SELECT 'C' || n_nationkey AS collection,
               CASE WHEN n_nationkey = 0 THEN 'central' ELSE n_name END AS billing_entity
        FROM {nation}""",
    "titles": """
        SELECT p_partkey, p_size, CAST(floor(p_partkey / 2) AS BIGINT) AS bib_key,
               CAST(floor(p_partkey / 4) AS BIGINT) AS k
        FROM {part}""",
    "item_rows": """
        SELECT 'p.' || p_partkey AS item_id, 'r.' || bib_key AS cluster_id, bib_key, k,
               CASE p_size % 6 WHEN 0 THEN 'ic' WHEN 1 THEN 'op' WHEN 2 THEN 'und' WHEN 3 THEN 'pd'
                    WHEN 4 THEN 'pdus' ELSE 'icus' END AS rights,
               CASE WHEN floor(p_partkey / 8) % 5 = 0 OR p_partkey % 8 = 7 THEN 'SE' ELSE 'BK' END AS bib_fmt,
               CASE WHEN k % 3 <> 0 OR p_partkey % 4 = 3 THEN ''
                    WHEN p_partkey % 4 = 2 THEN 'v.' || (p_partkey % 7 + 1) || ' (1990)'
                    ELSE 'v.' || (p_partkey % 7 + 1) END AS enum_chron,
               'C' || (p_partkey % 25) AS collection_code
        FROM {titles}""",
    "record_oclc": """
        SELECT DISTINCT bib_key, k + 1 AS ocn FROM {titles} WHERE bib_key % 25 <> 24
        UNION ALL
        SELECT DISTINCT bib_key, k + 100001 AS ocn FROM {titles} WHERE bib_key % 5 = 0""",
    "concordance": """
        SELECT DISTINCT k + 200001 AS variant, k + 1 AS canonical FROM {titles} WHERE k % 5 <> 4""",
    "record_search": """
        SELECT 'r.' || bib_key AS cluster_id, ocn FROM {record_oclc}
        UNION
        SELECT 'r.' || r.bib_key AS cluster_id, c.variant AS ocn
        FROM {record_oclc} r JOIN {concordance} c ON c.canonical = r.ocn""",
    "holding_keys": """
        SELECT *, CAST(floor(l_partkey / 4) + CASE WHEN floor(l_partkey / 4) % 7 = 3 THEN 1 ELSE 0 END
                       AS BIGINT) AS k, l_suppkey % 6 AS g
        FROM {lineitem}""",
    "holding_rows": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                 || CAST(l_quantity AS BIGINT) AS uuid,
               k + CASE WHEN l_orderkey % 10 = 7 THEN 900001 WHEN l_orderkey % 6 = 0 THEN 200001
                        ELSE 1 END AS ocn,
               CASE WHEN (g * 4 + k) % 25 = 0 THEN 'central'
                    ELSE 'NATION_' || ((g * 4 + k) % 25) END AS organization,
               'b' || (l_partkey % 9) AS local_id,
               CASE (g + k) % 4 WHEN 0 THEN '' WHEN 1 THEN 'v.' || (l_partkey % 7 + 1) WHEN 2 THEN 'v.99'
                    ELSE 'v.' || l_linenumber || ', Jan 1999' END AS enum_chron,
               CASE (g + 2 * k) % 5 WHEN 1 THEN 'WD' WHEN 2 THEN 'LM' WHEN 3 THEN 'CH'
                    WHEN 4 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'WD' ELSE 'LM' END
                    ELSE CASE l_returnflag WHEN 'A' THEN 'CH' WHEN 'R' THEN
                         CASE WHEN l_linenumber % 2 = 0 THEN 'WD' ELSE 'LM' END END END AS status,
               CASE WHEN (g + 2 * k) % 5 = 3 OR (l_linestatus = 'F' AND l_linenumber % 3 = 0)
                    THEN 'BRT' ELSE '' END AS condition,
               CASE l_linenumber % 5 WHEN 0 THEN 'mix' WHEN 1 THEN 'mon' WHEN 2 THEN 'spm'
                    WHEN 3 THEN 'mpm' ELSE 'ser' END AS mono_multi_serial,
               CASE WHEN l_linenumber % 3 = 0 THEN '' END AS issn,
               l_linenumber % 2 = 1 AS gov_doc_flag,
               CAST(l_shipdate AS DATE) AS date_received
        FROM {holding_keys}""",
    "raw_concordance": """
        SELECT DISTINCT k AS variant, k + 1 AS canonical FROM {titles}
         WHERE k % 50 IN (1, 10, 11, 20, 31, 32, 33, 34, 35, 36, 37, 38, 40, 44)
        UNION ALL
        SELECT DISTINCT k AS variant, k - 1 AS canonical FROM {titles} WHERE k % 50 IN (2, 3)
        UNION ALL
        SELECT DISTINCT k AS variant, k + 2 AS canonical FROM {titles} WHERE k % 50 IN (20, 44, 45)
        UNION ALL
        SELECT DISTINCT k AS variant, k + 1 AS canonical FROM {titles} WHERE k % 50 = 46
        UNION ALL
        SELECT DISTINCT k AS variant, k AS canonical FROM {titles} WHERE k % 50 = 30""",
    "new_concordance": """
        SELECT variant, CASE WHEN variant % 7 = 2 THEN canonical + 1 ELSE canonical END AS canonical
        FROM {concordance}""",
    "ocn_list": """
        SELECT DISTINCT o_custkey + 1 AS ocn FROM {orders}""",
    "requests": """
        SELECT DISTINCT 'p.' || l_partkey AS item_id, 'NATION_' || (l_suppkey % 25) AS organization
        FROM {lineitem}""",
    "reloads": """
        SELECT uuid || CASE WHEN ocn % 3 = 0 THEN '' ELSE '-new' END AS uuid, ocn + 1 AS ocn,
               organization, local_id, enum_chron, status, condition,
               CASE WHEN mono_multi_serial = 'mix' THEN 'mon' ELSE mono_multi_serial END AS mono_multi_serial,
               issn, gov_doc_flag, date_received
        FROM {holding_rows}
        WHERE mono_multi_serial IN ('mix', 'ser')""",
    "cost_totals": """
        SELECT CASE WHEN l_suppkey % 25 = 0 THEN 'central' ELSE 'NATION_' || (l_suppkey % 25) END AS member_id,
               '' || year(l_shipdate) AS report, CAST(count(*) AS BIGINT) AS total
        FROM {lineitem} GROUP BY 1, 2""",
    "loaded_files": """
        SELECT 'f' || o_orderkey AS filename, CAST(o_orderdate AS DATE) AS produced,
               'NATION_' || (o_custkey % 25) AS source,
               CASE WHEN o_orderstatus = 'F' THEN 'holding' ELSE 'concordance' END AS type
        FROM {orders}""",
    "submitted": """
        SELECT l_orderkey, l_linenumber, l_orderkey % 15 AS form, l_orderkey % 37 = 0 AS too_wide,
               l_partkey + 1 AS n, l_linenumber % 5 AS t,
               substr('abcdefghijklmnopqrstuvwxy', CAST(l_suppkey % 25 AS INT) + 1, 1) AS letter,
               CASE l_orderkey % 15
                    WHEN 0 THEN '' || (l_partkey + 1)
                    WHEN 1 THEN 'ocn' || (l_partkey + 1)
                    WHEN 2 THEN '(OCoLC)' || (l_partkey + 1)
                    WHEN 3 THEN (l_partkey + 1) || ',' || (l_partkey + 2)
                    WHEN 4 THEN (l_partkey + 1) || ' ' || (l_partkey + 1)
                    WHEN 5 THEN 'foo' || (l_partkey + 1)
                    WHEN 6 THEN (l_partkey + 1) || 'x'
                    WHEN 7 THEN ''
                    WHEN 8 THEN '000'
                    WHEN 9 THEN '9' || '99999999999999' || l_partkey
                    WHEN 10 THEN '1.0E+10'
                    WHEN 12 THEN (l_partkey + 1) || ',; '
                    WHEN 13 THEN ',' || (l_partkey + 1)
                    WHEN 14 THEN ' ,'
                    ELSE '(abc)' || (l_partkey + 1) END AS raw_ocn,
               CASE l_returnflag WHEN 'A' THEN ' CH ' WHEN 'R' THEN 'lost' ELSE '' END AS raw_status,
               CASE WHEN l_linestatus = 'F' THEN 'BRT' ELSE 'brt' END AS raw_condition,
               'b' || (l_partkey % 9) || '; b' || (l_partkey % 3) AS raw_local_id,
               CASE WHEN l_suppkey % 3 = 0 THEN '1234-567X; nope,1111222' || (l_partkey % 10) ELSE 'x' END AS raw_issn
        FROM {lineitem}""",
    "submission_lines": """
        SELECT 'org-' || letter || '_' || CASE t WHEN 0 THEN 'mix' WHEN 1 THEN 'mon' WHEN 2 THEN 'spm'
                 WHEN 3 THEN 'mpm' ELSE 'ser' END || '_full_20240101.tsv' AS file_name,
               'OCLC' || chr(9) || 'local_id' || CASE t WHEN 0 THEN '' WHEN 1 THEN chr(9) || 'status'
                 WHEN 2 THEN chr(9) || 'condition' WHEN 3 THEN chr(9) || 'enum_chron'
                 ELSE chr(9) || 'issn' END AS header,
               raw_ocn || chr(9) || raw_local_id || CASE t WHEN 0 THEN '' WHEN 1 THEN chr(9) || raw_status
                 WHEN 2 THEN chr(9) || raw_condition WHEN 3 THEN chr(9) || 'vol.' || n
                 ELSE chr(9) || raw_issn END || CASE WHEN too_wide THEN chr(9) ELSE '' END AS value,
               'org-' || letter AS sender, form, n, too_wide
        FROM {submitted}""",
    "second_lines": """
        SELECT replace(file_name, '20240101', '20240201') AS file_name, header, value, sender, form, n, too_wide
        FROM {submission_lines} WHERE length(value) % 2 = 0
        UNION ALL
        SELECT replace(file_name, '20240101', '20240301') AS file_name,
               CASE WHEN sender = 'org-b' THEN substr(header, 6) ELSE header END AS header, value, sender,
               CASE WHEN sender = 'org-b' THEN 7 ELSE form END AS form, n, too_wide
        FROM {submission_lines} WHERE length(value) % 7 <> 0""",
    "arriving_lines": """
        SELECT s.sender || '_' || s.kind || '_full_2024' || d.day || '01.tsv' AS file_name, s.sender, s.kind, d.day,
               CASE WHEN d.day = '03' AND s.sender = 'org-z' AND s.kind = 'ser' THEN 'local_id'
                    ELSE 'OCLC' || chr(9) || 'local_id' END AS header,
               CASE WHEN d.day = '03' AND s.sender = 'org-z' AND s.kind = 'ser' THEN raw_local_id
                    ELSE raw_ocn || chr(9) || raw_local_id || CASE WHEN too_wide THEN chr(9) ELSE '' END END AS value,
               form, n, too_wide
        FROM (SELECT *, CASE WHEN letter < 'm' THEN 'org-a' ELSE 'org-z' END AS sender,
                     CASE WHEN t = 4 THEN 'ser' ELSE 'mix' END AS kind FROM {submitted}) s,
             (SELECT '01' AS day UNION ALL SELECT '02' UNION ALL SELECT '03') d
        WHERE d.day = '01' OR (d.day = '02' AND l_orderkey % 10 < CASE sender WHEN 'org-a' THEN 4 ELSE 7 END)
           OR (d.day = '03' AND l_orderkey % 10 < 9)
        UNION ALL
        SELECT 'org-a_spm_full_20240301.tsv', 'org-a', 'spm', '03', 'OCLC' || chr(9) || 'local_id',
               raw_ocn || chr(9) || raw_local_id, form, n, false
        FROM {submitted} WHERE t = 2""",
    "enum_texts": """
        SELECT l_orderkey % 40 AS shape, CASE l_orderkey % 40
               WHEN 0 THEN 'v.3' WHEN 1 THEN 'v.3 1987' WHEN 2 THEN 'vol 3, 1987' WHEN 3 THEN 'bd.2:t.4'
               WHEN 4 THEN 'no.7 Feb 1988' WHEN 5 THEN 'Feb-Apr 1988' WHEN 6 THEN 'Mar 3-9 1988' WHEN 7 THEN '1988-Feb'
               WHEN 8 THEN '1988 1989' WHEN 9 THEN '1988-1990' WHEN 10 THEN '(1988)' WHEN 11 THEN '1988-'
               WHEN 12 THEN 'v.2-4 (1988-1990)' WHEN 13 THEN 'winter 1988' WHEN 14 THEN 'v.9 fall' WHEN 15 THEN '54321'
               WHEN 16 THEN 'pt3b' WHEN 17 THEN 'n.s.v.4' WHEN 18 THEN '[v.6]' WHEN 19 THEN 'index'
               WHEN 20 THEN 'summary' WHEN 21 THEN 'v.1 no.2' WHEN 22 THEN 'v.1:no.2' WHEN 23 THEN 't.1; 1988'
               WHEN 24 THEN '' WHEN 25 THEN '007' WHEN 26 THEN '5 - 8' WHEN 27 THEN 'Aug. 1988'
               WHEN 28 THEN 'v. 5' WHEN 29 THEN 'c.3' WHEN 30 THEN 'copy.2' WHEN 31 THEN 'v.1 c.2'
               WHEN 32 THEN 'a2' WHEN 33 THEN '1863' WHEN 34 THEN 'Jul 4th 1988' WHEN 35 THEN 'V.8'
               WHEN 36 THEN 'vol.1988' WHEN 37 THEN 'v.1988' WHEN 38 THEN 'May' ELSE 'no.12 Dec 31' END AS enum_chron
        FROM {lineitem}""",
    "marc_parts": """
        SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 's' WHEN 3 THEN 'a' ELSE 'm' END AS kind,
               o_orderkey % 11 = 0 AS no_ocn, o_orderkey % 13 = 0 AS no_itm, o_orderkey % 17 = 0 AS no_008,
               o_orderkey % 6 = 0 AS us, o_orderkey % 5 = 0 AS lost, o_custkey % 3 = 0 AS fragile, o_custkey
        FROM {orders}""",
    "marc_xml": """
        SELECT o_orderkey, '<record><leader>00000ca' || kind || ' a2200000 a 4500</leader>'
                 || CASE WHEN no_008 THEN '' ELSE '<controlfield tag="008">991231s1999    '
                 || CASE WHEN us THEN 'mdu' ELSE 'enk' END || '     x    f00||| und  </controlfield>' END
                 || '<controlfield tag="001"> 99' || o_orderkey || ' </controlfield>'
                 || CASE WHEN no_itm THEN '' ELSE '<datafield tag="ITM" ind1=" " ind2=" "><subfield code="a">v. '
                 || o_custkey || '</subfield><subfield code="b"></subfield><subfield code="c">'
                 || CASE WHEN fragile THEN 'FRAGILE' ELSE 'OK' END
                 || '</subfield><subfield code="d">23' || o_orderkey || '</subfield><subfield code="i">1999</subfield>'
                 || CASE WHEN lost THEN '<subfield code="k">MISSING</subfield>' ELSE '' END || '</datafield>' END
                 || '<datafield tag="022" ind1=" " ind2=" "><subfield code="a">4321-0987</subfield></datafield>'
                 || CASE WHEN no_ocn THEN '' ELSE '<datafield tag="035" ind1=" " ind2=" "><subfield code="a">(OCoLC)'
                 || o_custkey || '</subfield></datafield>' END || '</record>' AS xml
        FROM {marc_parts}""",
}


# Domain tables written once per session and folder: what a deployment keeps
# as its stores. All queries read these.
_STORED: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """The base tables, the views, and the stored domain tables made from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in VIEWS:
                text = VIEWS[name]
                used = {n: self[n] for n in (*BASE_TABLES, *VIEWS) if "{" + n + "}" in text}
                self._built[name] = self.spark.sql(text, **used)
            else:
                self._built[name] = spread(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))
        return self._built[name]

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED:
            _STORED[key] = materialize(build(), name)
        return _STORED[key]

    @property
    def holdings(self) -> DataFrame:
        return self._stored("holdings", lambda: with_enum_chron(self["holding_rows"]))

    @property
    def items(self) -> DataFrame:
        """Items on record clusters, with the OCN list of their record."""
        return self._stored("items", self._items)

    def _items(self) -> DataFrame:
        none = F.array().cast("array<bigint>")
        ocns = (F.when(F.col("bib_key") % 25 == 24, none)
                .when(F.col("bib_key") % 5 == 0, F.array(F.col("k") + 1, F.col("k") + 100001))
                .otherwise(F.array(F.col("k") + 1)))
        rows = self["item_rows"].withColumn("ocns", ocns).drop("k").withColumn(
            "access", F.when(F.col("rights").isin("pd", "pdus"), "allow").otherwise("deny"))
        return with_billing_entity(with_enum_chron(rows), self["collections"])

    @property
    def bridge(self) -> DataFrame:
        return self.items.select("item_id", F.explode("ocns").alias("ocn"))

    @property
    def search(self) -> DataFrame:
        return self._stored("record_search", lambda: self["record_search"])

    @property
    def concordance(self) -> DataFrame:
        return self._stored("concordance", lambda: self["concordance"])

    @property
    def requests(self) -> DataFrame:
        return self._stored("requests", lambda: self["requests"])

    @property
    def organizations(self) -> DataFrame:
        return self["organizations"]

    def prepare(self) -> None:
        """Write the stored tables now."""
        for name in ("holdings", "items", "search", "concordance"):
            getattr(self, name)
