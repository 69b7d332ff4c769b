"""The same queries as plain SQL for DuckDB, written from the rules.

Deliberately naive: the multi-part rule is one OR join, graphs are recursive
queries, and text rules are the closed forms that the derived texts follow.
"""

from __future__ import annotations

import re

from shelfcount.derived.views import BASE_TABLES, VIEWS

IC = "('ic', 'op', 'und', 'nobody', 'pd-pvt')"
_NAMES = "|".join((*BASE_TABLES, *VIEWS))

# Named parts, each usable by the later ones.
PARTS: dict[str, str] = {
    name: re.sub(r"\{(" + _NAMES + r")\}", r"\1", text) for name, text in VIEWS.items()
}
PARTS |= {
    "h": """SELECT *, regexp_extract(enum_chron, '^v[.]([0-9]+)', 1) AS n_enum,
                   CASE WHEN enum_chron LIKE '%Jan 1999' THEN 'Jan 1999' ELSE '' END AS n_chron
            FROM holding_rows""",
    "ci": """SELECT r.*, c.billing_entity, regexp_extract(enum_chron, '^v[.]([0-9]+)', 1) AS n_enum,
                    CASE WHEN rights IN ('pd', 'pdus') THEN 'allow' ELSE 'deny' END AS access,
                    bib_key % 25 = 24 AS no_ocn
             FROM item_rows r LEFT JOIN collections c ON c.collection = r.collection_code""",
    "bridge": """SELECT item_id, o.ocn FROM item_rows i JOIN record_oclc o USING (bib_key)""",
    "states": """SELECT *, status IS NULL OR status = 'CH' AS cur, condition = 'BRT' AS brt,
                        coalesce(status = 'WD', false) AS wd, coalesce(status = 'LM', false) AS lm,
                        condition = 'BRT' OR coalesce(status = 'LM', false) AS acc
                 FROM h""",
}


def _overlap_parts(p: str, items: str, ocns: str) -> dict[str, str]:
    """Parts computing overlap over cluster items and cluster OCNs."""
    return {
        f"{p}rec": f"""SELECT cluster_id, bib_key, bool_or(n_enum <> '') AS has_enum
                       FROM {items} GROUP BY ALL""",
        f"{p}fi": f"""SELECT i.*, CASE WHEN bib_fmt = 'SE' THEN 'ser' WHEN has_enum THEN 'mpm'
                             ELSE 'spm' END AS item_format
                      FROM {items} i JOIN {p}rec USING (cluster_id, bib_key)""",
        f"{p}fmt": f"""SELECT cluster_id, CASE WHEN bool_or(item_format = 'mpm') THEN 'mpm'
                              WHEN bool_or(item_format = 'spm') AND bool_or(item_format = 'ser') THEN 'ser/spm'
                              WHEN bool_or(item_format = 'ser') THEN 'ser' ELSE 'spm' END AS cf
                       FROM {p}fi GROUP BY cluster_id""",
        f"{p}ch": f"SELECT o.cluster_id, s.* FROM {ocns} o JOIN states s USING (ocn)",
        f"{p}nomatch": f"""SELECT DISTINCT cluster_id, organization FROM {p}ch
                           EXCEPT SELECT c.cluster_id, c.organization FROM {p}ch c
                           JOIN {items} i ON i.cluster_id = c.cluster_id AND i.n_enum = c.n_enum""",
        f"{p}home": f"SELECT f.*, fmt.cf FROM {p}fi f JOIN {p}fmt fmt USING (cluster_id) WHERE f.home",
        f"{p}pairs": f"""SELECT i.item_id, i.cf, c.* FROM {p}home i
                         JOIN {p}ch c ON c.cluster_id = i.cluster_id
                         LEFT JOIN {p}nomatch m ON m.cluster_id = c.cluster_id
                              AND m.organization = c.organization
                         WHERE i.cf <> 'mpm' OR c.n_enum = i.n_enum OR c.n_enum = ''
                               OR m.organization IS NOT NULL""",
        f"{p}cnt": f"""SELECT item_id, organization, cf, count(*) AS n, sum(cur::INT) AS cur,
                              sum(brt::INT) AS brt, sum(wd::INT) AS wd, sum(lm::INT) AS lm,
                              sum(acc::INT) AS acc, sum((cur AND brt)::INT) AS cur_brt,
                              sum((cur AND NOT brt)::INT) AS cur_ok
                       FROM {p}pairs GROUP BY ALL""",
        f"{p}ov": f"""SELECT item_id, organization, cf,
                             CAST(CASE WHEN cf = 'ser' THEN 1 ELSE n END AS BIGINT) AS copy_count,
                             CAST(CASE WHEN cf = 'ser' THEN 0 ELSE brt END AS BIGINT) AS brt_count,
                             CAST(CASE WHEN cf = 'ser' THEN 0 ELSE wd END AS BIGINT) AS wd_count,
                             CAST(CASE WHEN cf = 'ser' THEN 0 ELSE lm END AS BIGINT) AS lm_count,
                             CAST(CASE WHEN cf = 'ser' THEN 0 ELSE acc END AS BIGINT) AS access_count,
                             CAST(CASE WHEN cf = 'ser' THEN 1 ELSE cur END AS BIGINT) AS current_holding_count,
                             false AS deposited_only, cur_brt, cur_ok
                      FROM {p}cnt
                      UNION ALL
                      SELECT item_id, billing_entity, cf, 1, 0, 0, 0, 0, 0, true, 0, 0 FROM {p}home i
                      WHERE NOT EXISTS (SELECT 1 FROM {p}cnt c WHERE c.item_id = i.item_id
                                        AND c.organization = i.billing_entity)""",
        f"{p}ovi": f"""SELECT o.*, i.rights, i.n_enum, i.item_format FROM {p}ov o
                       JOIN {p}home i USING (item_id)""",
    }


PARTS["record_items"] = "SELECT *, true AS home FROM ci"
PARTS |= _overlap_parts("r_", "record_items", "record_search")
PARTS |= {
    # every item its own cluster, named by the item
    "s0": "SELECT item_id AS seed, ocn FROM bridge",
    "s1": """SELECT seed, ocn FROM s0 UNION
             SELECT s.seed, unnest([b.variant, b.canonical]) FROM s0 s
             JOIN concordance a ON a.canonical = s.ocn OR a.variant = s.ocn
             JOIN concordance b ON b.canonical = a.canonical""",
    "s2": """SELECT seed, ocn FROM s1 UNION
             SELECT s.seed, b2.ocn FROM s1 s JOIN bridge b1 USING (ocn) JOIN bridge b2 USING (item_id)""",
    "s3": """SELECT seed, ocn FROM s2 UNION
             SELECT s.seed, unnest([b.variant, b.canonical]) FROM s2 s
             JOIN concordance a ON a.canonical = s.ocn OR a.variant = s.ocn
             JOIN concordance b ON b.canonical = a.canonical""",
    "lookup_ocns": "SELECT seed AS cluster_id, ocn FROM s3",
    "lookup_items": """SELECT DISTINCT s.seed AS cluster_id, i.* EXCLUDE (cluster_id), s.seed = i.item_id AS home
                       FROM s3 s JOIN bridge b USING (ocn) JOIN ci i ON i.item_id = b.item_id
                       UNION ALL
                       SELECT 'bib:' || i.bib_key, i.* EXCLUDE (cluster_id), true FROM ci i WHERE no_ocn""",
}
PARTS |= _overlap_parts("l_", "lookup_items", "lookup_ocns")
PARTS |= {
    "member": "SELECT inst_id AS organization FROM organizations WHERE status",
    "nm": "SELECT item_id, CAST(count(m.organization) AS BIGINT) AS n_members FROM r_ov LEFT JOIN member m USING (organization) GROUP BY 1",
    "freq": f"""SELECT organization, item_format AS format, n_members AS bucket,
                       CAST(count(*) AS BIGINT) AS frequency
                FROM r_ovi JOIN member USING (organization) JOIN nm USING (item_id)
                WHERE rights IN {IC} GROUP BY ALL""",
    "hs": """SELECT organization, sum(CASE WHEN format = 'spm' THEN frequency / bucket ELSE 0 END) AS spm,
                    sum(CASE WHEN format = 'mpm' THEN frequency / bucket ELSE 0 END) AS mpm,
                    sum(CASE WHEN format = 'ser' THEN frequency / bucket ELSE 0 END) AS ser,
                    sum(frequency / bucket) AS total FROM freq GROUP BY 1""",
    "facts": f"""SELECT CAST(10000 AS DOUBLE) AS target_cost, CAST(count(*) AS BIGINT) AS num_volumes,
                        CAST(sum((rights NOT IN {IC})::INT) AS BIGINT) AS num_pd_volumes,
                        10000 / count(*) AS cost_per_volume,
                        (SELECT sum(weight) FROM organizations WHERE status) AS total_weight,
                        10000 / count(*) * sum((rights NOT IN {IC})::INT) AS pd_cost,
                        (SELECT CAST(count(*) AS BIGINT) FROM member) AS num_members FROM ci""",
    "hold_texts": """SELECT DISTINCT organization, ocn, local_id, mono_multi_serial AS item_type, n_enum FROM h""",
    "matched_rows": """SELECT DISTINCT i.cluster_id, p.organization, p.ocn, p.local_id,
                              p.mono_multi_serial AS item_type, i.item_id
                       FROM r_pairs p JOIN ci i USING (item_id)""",
    "report": """SELECT m.organization, m.ocn, m.local_id, m.item_type, i.rights,
                        CASE WHEN o.country_code <> 'us' AND i.rights = 'pdus' THEN 'deny'
                             WHEN o.country_code <> 'us' AND i.rights = 'icus' THEN 'allow'
                             ELSE i.access END AS access,
                        CAST(i.bib_key AS VARCHAR) AS catalog_id, m.item_id AS volume_id, i.enum_chron
                 FROM matched_rows m JOIN ci i USING (item_id)
                 JOIN organizations o ON o.inst_id = m.organization
                 UNION ALL
                 SELECT organization, ocn, local_id, item_type, '', '', '', '', '' FROM (
                   SELECT DISTINCT s.cluster_id, t.organization, t.ocn, t.local_id, t.item_type
                   FROM record_search s JOIN hold_texts t USING (ocn)) x
                 WHERE NOT EXISTS (SELECT 1 FROM matched_rows m WHERE m.cluster_id = x.cluster_id
                                   AND m.organization = x.organization AND m.local_id = x.local_id)
                 UNION ALL
                 SELECT DISTINCT organization, ocn, local_id, item_type, '', '', '', '', '' FROM hold_texts
                 WHERE ocn NOT IN (SELECT ocn FROM record_search)""",
    "nci": """SELECT item_id, rights, organization, CASE WHEN b + l + w > 1 THEN 'multiple'
                     WHEN b = 1 THEN 'brittle' WHEN l = 1 THEN 'lost_missing' ELSE 'withdrawn' END AS condition
              FROM (SELECT *, (cur_brt > 0)::INT AS b, (lm_count > 0)::INT AS l, (wd_count > 0)::INT AS w
                    FROM r_ovi WHERE cur_ok = 0) WHERE b + l + w > 0""",
    "edges": "SELECT variant, canonical FROM raw_concordance WHERE variant <> canonical",
    "both_ways": "SELECT variant AS a, canonical AS b FROM edges UNION SELECT canonical, variant FROM edges",
    "walk": "SELECT a AS ocn, a AS seen FROM both_ways UNION SELECT w.ocn, e.b FROM walk w JOIN both_ways e ON e.a = w.seen",
    "comp": "SELECT ocn, min(seen) AS component FROM walk GROUP BY ocn",
    "reach": "SELECT variant AS ocn, canonical AS seen FROM edges UNION SELECT r.ocn, e.canonical FROM reach r JOIN edges e ON e.variant = r.seen",
    "on_cycle": "SELECT ocn FROM reach WHERE ocn = seen",
    "cyclic": """SELECT c.ocn, c.component FROM comp c WHERE c.ocn IN (SELECT ocn FROM on_cycle
                 UNION SELECT r.seen FROM reach r JOIN on_cycle o ON o.ocn = r.ocn)""",
    "ties": """SELECT a.ocn AS a, b.ocn AS b FROM bridge a JOIN bridge b USING (item_id)
               UNION SELECT variant, canonical FROM concordance UNION SELECT canonical, variant FROM concordance""",
    "tied_walk": "SELECT a AS ocn, a AS seen FROM ties UNION SELECT w.ocn, e.b FROM tied_walk w JOIN ties e ON e.a = w.seen",
    "terminal": "SELECT DISTINCT canonical AS ocn FROM edges WHERE canonical NOT IN (SELECT variant FROM edges)",
    "ends": """SELECT r.ocn AS variant, min(r.seen) AS lo, max(r.seen) AS hi FROM reach r
               WHERE r.seen IN (SELECT ocn FROM terminal) GROUP BY 1""",
    "judged": """SELECT e.variant, c.component, c.component IN (SELECT component FROM cyclic) AS bad,
                        x.lo, x.hi
                 FROM edges e JOIN comp c ON c.ocn = e.variant LEFT JOIN ends x USING (variant)""",
    "sheets": """SELECT member_id AS key, report, CAST(total AS VARCHAR) AS value FROM cost_totals
                 WHERE NOT (member_id IN ('NATION_1', 'NATION_6') AND report < '1998')""",
    "names": "SELECT DISTINCT report FROM sheets",
    "grid": """SELECT k.key, n.report, coalesce(s.value, 'N/A') AS value
               FROM (SELECT DISTINCT key FROM sheets) k CROSS JOIN names n
               LEFT JOIN sheets s ON s.key = k.key AND s.report = n.report""",
    "steps": """SELECT key, report, value, lead(value) OVER (PARTITION BY key ORDER BY report) AS following,
                       try_cast(value AS BIGINT) AS x, try_cast(lead(value) OVER (PARTITION BY key ORDER BY report)
                       AS BIGINT) AS y FROM grid""",
    "sent_files": """SELECT file_name, sender, kind, nr,
          count(one) AS ready_lines,
          count(DISTINCT one) AS ready_ocns, CAST(sum(one) AS BIGINT) AS ocn_sum
        FROM (SELECT file_name, sender, split_part(file_name, '_', 2) AS kind,
                CASE WHEN file_name LIKE '%20240101%' THEN 1 WHEN file_name LIKE '%20240201%' THEN 2 ELSE 3 END AS nr,
                ok, ocns, one FROM (
                SELECT *, form IN (0, 1, 2, 3, 4, 12, 13) AND NOT too_wide AS ok,
                  CASE WHEN form = 3 THEN [n, n + 1] ELSE [n] END AS ocns FROM
                  (SELECT file_name, sender, form, n, too_wide FROM submission_lines UNION ALL
                   SELECT file_name, sender, form, n, too_wide FROM second_lines)) lines
              LEFT JOIN LATERAL (SELECT unnest(CASE WHEN ok THEN ocns ELSE [] END) AS one) ON true)
        GROUP BY ALL""",
    "sent_states": """SELECT s.sender, s.kind, coalesce(a.ready_lines, 0) AS l1, coalesce(a.ready_ocns, 0) AS o1,
          coalesce(b.ready_lines, 0) AS l2, coalesce(b.ready_ocns, 0) AS o2,
          coalesce(c.ready_lines, 0) AS l3, coalesce(c.ready_ocns, 0) AS o3
        FROM (SELECT DISTINCT sender, kind FROM sent_files) s
        LEFT JOIN sent_files a ON a.sender = s.sender AND a.kind = s.kind AND a.nr = 1
        LEFT JOIN sent_files b ON b.sender = s.sender AND b.kind = s.kind AND b.nr = 2
        LEFT JOIN sent_files c ON c.sender = s.sender AND c.kind = s.kind AND c.nr = 3""",
    "sent_second": """SELECT *, l2 > 0 AND (l1 = 0 OR (abs(l2 - l1) / l1 < 0.5 AND abs(o2 - o1) / o1 < 0.5)) AS pass2
        FROM sent_states""",
    "sent_passes": """SELECT *, l3 > 0 AND (lb = 0 OR (abs(l3 - lb) / lb < 0.5 AND abs(o3 - ob) / ob < 0.5)) AS pass3
        FROM (SELECT *, CASE WHEN pass2 THEN l2 ELSE l1 END AS lb, CASE WHEN pass2 THEN o2 ELSE o1 END AS ob
              FROM sent_second)""",
    "arrived": """SELECT sender, kind, day, file_name, count(*) AS lines, count(one) AS ready_lines,
          count(DISTINCT one) AS ready_ocns, CAST(sum(one) AS BIGINT) AS ocn_sum
        FROM (SELECT *, form IN (0, 1, 2, 3, 4, 12, 13) AND NOT too_wide AND header LIKE 'OCLC%' AS ok,
                     CASE WHEN form = 3 THEN [n, n + 1] ELSE [n] END AS ocns FROM arriving_lines) a
        LEFT JOIN LATERAL (SELECT unnest(CASE WHEN ok THEN ocns ELSE [] END) AS one) ON true
        GROUP BY ALL""",
    "arrived_second": """SELECT a.sender, a.kind, a.ready_lines AS l1, a.ready_ocns AS o1, b.ready_lines AS l2, b.ready_ocns AS o2,
          abs(b.ready_lines - a.ready_lines) / a.ready_lines < 0.4 AND abs(b.ready_ocns - a.ready_ocns) / a.ready_ocns < 0.4
            AS pass2, c.ready_lines AS l3, c.ready_ocns AS o3
        FROM arrived a JOIN arrived b USING (sender, kind) JOIN arrived c USING (sender, kind)
        WHERE a.day = '01' AND b.day = '02' AND c.day = '03'""",
    "arrived_passes": """SELECT *, CASE WHEN pass2 THEN l2 ELSE l1 END AS lb, CASE WHEN pass2 THEN o2 ELSE o1 END AS ob,
          l3 > 0 AND abs(l3 - lb) / lb < 0.4 AND abs(o3 - ob) / ob < 0.4 AS pass3
        FROM arrived_second""",
    "judged_lines": """SELECT s.*, form IN (0, 1, 2, 3, 4, 12, 13) AS ok_ocn,
            CASE t WHEN 0 THEN 2 ELSE 3 END + too_wide::INT AS width, CASE t WHEN 0 THEN 2 ELSE 3 END AS asked,
            'org-' || letter AS organization,
            CASE t WHEN 0 THEN 'mix' WHEN 1 THEN 'mon' WHEN 2 THEN 'spm' WHEN 3 THEN 'mpm' ELSE 'ser' END AS kind,
            CASE WHEN raw_local_id = 'b' || right(raw_local_id, 1) || '; b' || right(raw_local_id, 1)
                 THEN 'b' || right(raw_local_id, 1) ELSE replace(raw_local_id, '; ', ',') END AS local_id,
            CASE WHEN raw_issn = 'x' THEN '' ELSE '1234-567X;' || right(raw_issn, 8) END AS issn_value
          FROM submitted s""",
    "marc_out": """SELECT o_orderkey, CASE kind WHEN 's' THEN 'ser' WHEN 'm' THEN 'mon' ELSE 'mix' END AS item_type,
            CASE WHEN kind = 'a' THEN 'unexpected item type mix'
                 WHEN no_ocn THEN 'Record rejected for missing 035a (ocn)'
                 WHEN kind = 'm' AND no_itm THEN 'Record rejected for lacking an ITM field'
                 WHEN no_008 THEN 'Record rejected for missing 008 field' END AS error,
            '(OCoLC)' || o_custkey AS oclc,
            CASE WHEN kind = 's' THEN '99' || o_orderkey ELSE '23' || o_orderkey END AS local_id,
            CASE WHEN kind = 's' THEN '' WHEN lost THEN 'LM' ELSE 'CH' END AS status,
            CASE WHEN fragile AND NOT no_itm THEN 'BRT' ELSE '' END AS condition,
            CASE WHEN no_itm THEN '' ELSE 'v. ' || o_custkey || ',1999' END AS enum_chron,
            CASE WHEN kind = 's' THEN '4321-0987' ELSE '' END AS issn,
            CASE WHEN us THEN '1' ELSE '0' END AS govdoc FROM marc_parts""",
}

_RECURSIVE = {"walk", "reach", "tied_walk"}


def _with(query: str) -> str:
    """Put the parts a query needs, directly or not, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"[a-z_0-9]+", text)):
            if name in PARTS and name not in needed:
                needed.add(name)
                visit(PARTS[name])

    visit(query)
    if not needed:
        return query
    parts = ",\n".join(f"{name} AS ({text})" for name, text in PARTS.items() if name in needed)
    return f"WITH {'RECURSIVE ' if needed & _RECURSIVE else ''}{parts}\n{query}"


_REPORTED = ("copy_count, brt_count, wd_count, lm_count, access_count, current_holding_count, deposited_only")
_RECORD = f"SELECT item_id AS volume_id, n_enum, organization AS member_id, {_REPORTED} FROM r_ovi"
_DIFF_VALUE = """CASE WHEN following IS NULL THEN '' WHEN x IS NOT NULL AND y IS NOT NULL
    THEN CAST(y - x AS VARCHAR) ELSE value END"""
_NOT_CENTRAL = "key IN (SELECT organization FROM member WHERE organization <> 'central')"


def _pivot(relation: str, value: str = "value") -> str:
    cells = ", ".join(f"max(CASE WHEN report = '{r}' THEN {value} END) AS \"{{p}}{r}\"" for r in range(1995, 2002))
    return f"SELECT key, {cells} FROM {relation} GROUP BY key"


# Results worked out by hand from the rules: (n_enum, n_chron) of each shape of ``enum_texts``.
SHAPES = [
    ("3", ""), ("3", "1987"), ("vol:3", "1987"), ("2:4", ""), ("7", "Feb 1988"),
    ("", "Feb-Apr 1988"), ("", "Mar 3-9 1988"), ("", "1988-Feb Feb"), ("", "1988 1989"), ("", "1988-1990"),
    ("", "1988"), ("", "1988"), ("2-4", "1988-1990"), ("", "winter 1988"), ("9", "fall"),
    ("54321", ""), ("3", ""), ("s:4", ""), ("6", ""), ("index", ""),
    ("", "summary"), ("1:2", ""), ("1:2", ""), ("1", "1988"), ("", ""),
    ("007", ""), ("5-8", ""), ("", "Aug. 1988"), ("5", ""), ("3", ""),
    ("2", ""), ("1:2", ""), ("2", ""), ("", "1863"), ("", "Jul 4th 1988"),
    ("8", ""), ("", "vol.1988"), ("1988", ""), ("", "May"), ("12", "Dec 31"),
]


def _md5(seed: str) -> str:
    return f"CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT)"


def _slices(relation: str) -> str:
    return f"SELECT DISTINCT organization, mono_multi_serial FROM {relation}"


_HELD_BY = """SELECT q.item_id, coalesce(string_agg(o.organization, ',' ORDER BY o.organization), '')
    AS organizations FROM (SELECT DISTINCT item_id FROM requests) q JOIN ci USING (item_id)
    LEFT JOIN l_ov o ON o.item_id = q.item_id {extra} GROUP BY 1"""

_KEPT = f"""SELECT organization, mono_multi_serial, uuid, ocn FROM holding_rows
    WHERE (organization, mono_multi_serial) NOT IN ({_slices('reloads')})"""

_MAPTO = """CASE WHEN {c} IN (SELECT mapto_inst_id FROM organizations) THEN {c}
    ELSE (SELECT o.mapto_inst_id FROM organizations o WHERE o.inst_id = {c}) END"""

_QUERIES = {
    "holdings_counts_by_org_type": "SELECT organization, mono_multi_serial, count(*) AS holdings FROM h GROUP BY ALL",
    "holdings_counts_by_org": "SELECT organization, count(*) AS holdings FROM h GROUP BY ALL",
    "item_counts": f"""SELECT count(*) AS n_items, CAST(sum((rights IN {IC})::INT) AS BIGINT) AS n_ic,
        CAST(sum((rights NOT IN {IC})::INT) AS BIGINT) AS n_pd FROM ci""",
    "scrubbed_counts": "SELECT count(*) AS n_lines, count(DISTINCT ocn) AS n_ocns FROM h",
    "ocns_for_items": """SELECT item_id, bib_key FROM ci WHERE item_id IN
        (SELECT item_id FROM bridge WHERE ocn IN (SELECT ocn FROM ocn_list))""",
    "holdings_with_ocns": """SELECT organization, count(*) AS holdings FROM h
        WHERE ocn IN (SELECT ocn FROM ocn_list) GROUP BY 1""",
    "items_on_records": "SELECT item_id, bib_key FROM ci WHERE bib_key IN (SELECT l_orderkey FROM lineitem)",
    "find_items": """SELECT q.item_id, i.rights, i.item_id IS NULL AS not_found
        FROM (SELECT DISTINCT regexp_replace(item_id, '7$', '7x') AS item_id FROM requests) q
        LEFT JOIN ci i USING (item_id)""",
    "resolutions_with_ocns": """SELECT variant, canonical FROM concordance
        WHERE variant IN (SELECT ocn FROM ocn_list) OR canonical IN (SELECT ocn FROM ocn_list)""",
    "organizations_join": """SELECT inst_id, country_code, weight, 'sym' AS oclc_sym, status, mapto_inst_id
        FROM organizations""",
    "access_nonus": """SELECT i.item_id, q.organization,
        CASE WHEN coalesce(o.country_code, 'zz') <> 'us' AND i.rights = 'pdus' THEN 'deny'
             WHEN coalesce(o.country_code, 'zz') <> 'us' AND i.rights = 'icus' THEN 'allow' ELSE i.access END AS access
        FROM ci i JOIN requests q USING (item_id) LEFT JOIN organizations o ON o.inst_id = q.organization""",
    "catalog_records": f"""SELECT lpad(CAST(i.bib_key AS VARCHAR), 9, '0') AS cluster_id, item_id, bib_key, rights,
        'deny' AS access, CASE bib_key % 3 WHEN 0 THEN 'SE' WHEN 1 THEN 'BK' ELSE 'XX' END AS bib_fmt, n_enum,
        collection_code, CAST((SELECT count(*) FROM record_oclc r WHERE r.bib_key = i.bib_key) AS INT) AS n_ocns
        FROM ci i WHERE rights IN {IC}""",
    "missing_collections": "SELECT DISTINCT collection_code AS collection FROM ci WHERE collection_code = 'C9'",
    "concordance_expand": """SELECT ocn AS key, ocn FROM ocn_list UNION
        SELECT l.ocn, unnest([b.variant, b.canonical]) FROM ocn_list l
        JOIN concordance a ON a.canonical = l.ocn OR a.variant = l.ocn
        JOIN concordance b ON b.canonical = a.canonical""",
    "related_ocns": """SELECT ocn AS key, ocn FROM ocn_list UNION SELECT l.ocn, b2.ocn FROM ocn_list l
        JOIN bridge b1 USING (ocn) JOIN bridge b2 USING (item_id)""",
    "record_cluster_ocns": """SELECT substr(cluster_id, 3) AS cluster_id, ocn FROM record_search
        WHERE CAST(substr(cluster_id, 3) AS BIGINT) % 9 <> 4""",
    "item_formats": "SELECT item_id, item_format, cf AS cluster_format FROM r_home",
    "cluster_formats": "SELECT cluster_id, cf AS cluster_format FROM r_fmt",
    "cluster_resolutions": """SELECT DISTINCT s.cluster_id, c.variant, c.canonical FROM record_search s
        JOIN concordance c ON c.variant = s.ocn OR c.canonical = s.ocn""",
    "cluster_items": "SELECT DISTINCT s.cluster_id, b.item_id FROM record_search s JOIN bridge b USING (ocn)",
    "organizations_in_cluster": """SELECT cluster_id, organization FROM r_ch UNION
        SELECT cluster_id, billing_entity FROM ci""",
    "cluster_enums": """SELECT cluster_id, 'holding' AS side, organization, n_enum FROM r_ch UNION
        SELECT cluster_id, 'item', NULL, n_enum FROM ci""",
    "cluster_org_counts": """SELECT cluster_id, organization, count(*) AS n, CAST(sum(cur::INT) AS BIGINT) AS cur,
        CAST(sum(brt::INT) AS BIGINT) AS brt, CAST(sum(wd::INT) AS BIGINT) AS wd,
        CAST(sum(lm::INT) AS BIGINT) AS lm, CAST(sum(acc::INT) AS BIGINT) AS access FROM r_ch GROUP BY 1, 2""",
    "orgs_without_enum_match": "SELECT cluster_id, organization FROM r_nomatch",
    "empty_clusters": """SELECT cluster_id FROM (SELECT 'x.' || (ocn % 997) AS cluster_id, ocn * 3 AS ocn FROM ocn_list)
        GROUP BY 1 HAVING NOT bool_or(ocn IN (SELECT ocn FROM bridge UNION
          SELECT ocn FROM h UNION SELECT variant FROM concordance
          UNION SELECT canonical FROM concordance))""",
    "inspect_cluster": """SELECT cluster_id, part, count(*) AS members, min(key) AS first_key, max(key) AS last_key FROM (
        SELECT cluster_id, 'ocn' AS part, CAST(ocn AS VARCHAR) AS key FROM record_search
        UNION ALL SELECT * FROM (SELECT DISTINCT s.cluster_id, 'item', b.item_id FROM record_search s JOIN bridge b USING (ocn))
        UNION ALL SELECT cluster_id, 'holding', uuid FROM r_ch
        UNION ALL SELECT * FROM (SELECT DISTINCT s.cluster_id, 'resolution', CAST(c.variant AS VARCHAR) FROM record_search s
          JOIN concordance c ON c.variant = s.ocn OR c.canonical = s.ocn)) GROUP BY 1, 2""",
    "overlap_serial": _RECORD + " WHERE cf = 'ser'",
    "overlap_single": _RECORD + " WHERE cf IN ('spm', 'ser/spm')",
    "overlap_multi": _RECORD + " WHERE cf = 'mpm'",
    "overlap_fact": _RECORD,
    "depositor_only": "SELECT item_id, organization FROM r_ov WHERE deposited_only",
    "brittle_current": """SELECT item_id, organization, cur_brt > 0 AS any_brittle, cur_ok = 0 AS all_brittle
        FROM r_ov""",
    "item_members": "SELECT item_id, n_members FROM nm",
    "item_h_share": """SELECT o.item_id, o.organization,
        round(CASE WHEN m.organization IS NULL THEN 0 ELSE 1 / n_members END, 9) AS h_share
        FROM r_ov o JOIN nm USING (item_id) LEFT JOIN member m USING (organization)""",
    "frequency_table": "SELECT * FROM freq",
    "frequency_histogram": "SELECT * FROM freq",
    "frequency_merge": "SELECT * FROM freq",
    "hscore_by_member": """SELECT organization, round(spm, 6) AS spm, round(mpm, 6) AS mpm, round(ser, 6) AS ser,
        round(total, 6) AS total FROM hs""",
    "cost_summary": "SELECT * FROM facts",
    "cost_by_member": """SELECT o.inst_id AS member_id, o.weight, round(coalesce(spm, 0) * cost_per_volume, 6) AS spm,
        round(coalesce(mpm, 0) * cost_per_volume, 6) AS mpm, round(coalesce(ser, 0) * cost_per_volume, 6) AS ser,
        round(pd_cost / total_weight * o.weight, 6) AS pd, round(x.extra, 6) AS extra,
        round(coalesce(total, 0) * cost_per_volume + pd_cost / total_weight * o.weight + x.extra, 6) AS total
        FROM organizations o CROSS JOIN facts
        CROSS JOIN (SELECT coalesce((SELECT total FROM hs WHERE organization = 'central'), 0)
          * (SELECT cost_per_volume FROM facts)
          / (SELECT count(*) FROM member WHERE organization <> 'central') AS extra) x
        LEFT JOIN hs ON hs.organization = o.inst_id WHERE o.status""",
    "estimate_new_member": f"""SELECT ocns_total, ocns_matched, round(ocns_matched / ocns_total * 100, 1) AS pct_ocns_matched,
        items_matched, items_pd, round(items_pd / items_matched * 100, 1) AS pct_items_pd,
        items_ic, round(items_ic / items_matched * 100, 1) AS pct_items_ic, round(share, 6) AS h_share,
        round(share * 10000 / (SELECT count(*) FROM ci), 2) AS estimated_ic_cost FROM
        (SELECT count(*) AS ocns_total FROM ocn_list),
        (SELECT count(*) AS ocns_matched FROM ocn_list WHERE ocn IN (SELECT ocn FROM record_search WHERE cluster_id IN
          (SELECT cluster_id FROM record_search WHERE ocn IN (SELECT ocn FROM ocn_list)))),
        (SELECT count(*) AS items_matched, CAST(sum((rights IN {IC})::INT) AS BIGINT) AS items_ic,
          CAST(sum((rights NOT IN {IC})::INT) AS BIGINT) AS items_pd,
          sum(CASE WHEN rights IN {IC} THEN 1 / (coalesce(n_members, 0) + 1) ELSE 0 END) AS share
         FROM ci LEFT JOIN nm USING (item_id) WHERE cluster_id IN
          (SELECT cluster_id FROM record_search WHERE ocn IN (SELECT ocn FROM ocn_list)))""",
    "overlap_report_all": "SELECT * FROM report",
    "overlap_report_members": """SELECT r.*, CASE WHEN volume_id = '' THEN '' ELSE CAST(n_members AS VARCHAR) END
        AS matching_members_count FROM report r LEFT JOIN nm ON nm.item_id = r.volume_id
        WHERE organization = 'NATION_4'""",
    "deposit_analysis": f"""SELECT i.item_id, i.rights, i.billing_entity,
        CASE WHEN i.no_ocn THEN 'no_ocn' ELSE {{own}} END AS holdings_status, b.mapto_inst_id,
        CASE WHEN i.no_ocn THEN 'no_ocn' ELSE {{mapped}} END AS mapped_holdings_status
        FROM ci i JOIN organizations b ON b.inst_id = i.billing_entity
        LEFT JOIN organizations g ON g.mapto_inst_id = b.mapto_inst_id
        LEFT JOIN r_ov v ON v.item_id = i.item_id AND v.organization = g.inst_id AND NOT v.deposited_only
        WHERE i.rights IN {IC} OR i.rights = 'icus' GROUP BY i.item_id, i.rights, i.billing_entity, i.no_ocn, b.mapto_inst_id""",
    "non_current_items": "SELECT * FROM nci",
    "non_current_pivot": "SELECT organization, " + ", ".join(
        f"CAST(sum((rights {op} {IC} AND condition = '{c}')::INT) AS BIGINT) AS {p}_{c}"
        for p, op in (("pd", "NOT IN"), ("ic", "IN"))
        for c in ("withdrawn", "lost_missing", "brittle", "multiple")) + " FROM nci GROUP BY 1",
    "item_access": f"""SELECT q.item_id, q.organization, CAST(coalesce(sum(access_count), 0) AS BIGINT) AS brlm_count,
        CAST(coalesce(sum(copy_count), 0) AS BIGINT) AS copy_count,
        CAST(coalesce(sum(current_holding_count), 0) AS BIGINT) AS currently_held_count,
        CAST(max({_MAPTO.format(c='i.billing_entity')} = q.mapto) AS INT) AS deposited,
        f.cf AS format, i.n_enum,
        coalesce((SELECT string_agg(CAST(ocn AS VARCHAR), ',' ORDER BY ocn) FROM bridge b WHERE b.item_id = q.item_id), '') AS ocns
        FROM (SELECT item_id, organization, {_MAPTO.format(c='organization')} AS mapto FROM requests) q
        JOIN ci i USING (item_id) JOIN l_home f USING (item_id)
        JOIN organizations g ON g.mapto_inst_id = q.mapto
        LEFT JOIN l_ov v ON v.item_id = q.item_id AND v.organization = g.inst_id
        GROUP BY q.item_id, q.organization, f.cf, i.n_enum""",
    "request_checks": f"""SELECT q.organization, q.item_id, q.mapto, CASE WHEN q.item_id = ''
        THEN 'missing required param: item_id' WHEN q.mapto IS NULL OR i.item_id IS NULL THEN 'no matching data' END AS error
        FROM (SELECT *, {_MAPTO.format(c='organization')} AS mapto FROM (SELECT DISTINCT
          regexp_replace(organization, '_3$', '_300') AS organization,
          regexp_replace(item_id, '^p[.][0-9]$', '') AS item_id FROM requests)) q
        LEFT JOIN ci i ON i.item_id = q.item_id""",
    "item_held_by": _HELD_BY.format(extra=""),
    "item_held_by_brlm": _HELD_BY.format(extra="AND o.access_count > 0"),
    "record_held_by": """SELECT item_id, string_agg(organization, ',' ORDER BY organization) AS organizations
        FROM r_ov WHERE item_id IN (SELECT item_id FROM item_rows WHERE bib_key IN (SELECT bib_key FROM item_rows
          JOIN requests USING (item_id))) GROUP BY 1""",
    "members": "SELECT inst_id FROM organizations WHERE status",
    "mapto_organizations": f"""SELECT organization, {_MAPTO.format(c='organization')} AS mapto
        FROM (SELECT DISTINCT organization FROM requests)""",
    "concordance_delta_adds": "SELECT * FROM new_concordance EXCEPT ALL SELECT * FROM concordance",
    "concordance_delta_deletes": "SELECT * FROM concordance EXCEPT ALL SELECT * FROM new_concordance",
    "concordance_apply": "SELECT DISTINCT variant, canonical FROM new_concordance",
    "concordance_neighbours": """SELECT variant AS ocn, 'out' AS direction, canonical AS neighbour FROM edges
        UNION SELECT canonical, 'in', variant FROM edges""",
    "concordance_terminals": "SELECT ocn FROM terminal",
    "concordance_components": "SELECT ocn, component FROM comp",
    "concordance_cycles": "SELECT ocn, component FROM cyclic",
    "concordance_validated": "SELECT variant, lo AS canonical FROM judged WHERE NOT bad AND lo = hi",
    "concordance_rejected": """SELECT variant, CASE WHEN bad THEN 'cycle' ELSE 'several terminal OCNs' END AS reason,
        component FROM judged WHERE bad OR lo <> hi""",
    "replace_holdings": f"""SELECT organization, mono_multi_serial, count(*) AS holdings, CAST(sum(ocn) AS BIGINT) AS ocn_sum
        FROM ({_KEPT} UNION ALL SELECT organization, mono_multi_serial, uuid, ocn FROM reloads
        WHERE uuid NOT IN (SELECT uuid FROM ({_KEPT}))) GROUP BY 1, 2""",
    "replacement_counts": """SELECT r.organization, r.mono_multi_serial,
        (SELECT count(*) FROM holding_rows o WHERE o.organization = r.organization
         AND o.mono_multi_serial = r.mono_multi_serial) AS old_count, count(DISTINCT uuid) AS new_count
        FROM reloads r GROUP BY 1, 2""",
    "insert_ignore": """SELECT uuid, ocn, organization FROM reloads
        WHERE uuid NOT IN (SELECT uuid FROM holding_rows)""",
    "delete_by_uuid": """SELECT organization, count(*) AS holdings FROM holding_rows
        WHERE ocn % 3 <> 0 OR ocn % 4 = 0 GROUP BY 1""",
    "dedupe_holdings": """SELECT min(uuid) AS uuid, ocn, organization FROM h GROUP BY ocn, organization, local_id, status,
        condition, enum_chron, mono_multi_serial, gov_doc_flag""",
    "migrate_item_types": "SELECT organization, mono_multi_serial, count(*) AS holdings FROM h GROUP BY ALL",
    "size_gate": """SELECT organization, loaded_lines, coalesce(ready_lines, 0) AS ready_lines, loaded_ocns,
        coalesce(ready_ocns, 0) AS ready_ocns, round(abs(coalesce(ready_lines, 0) - loaded_lines) / loaded_lines, 9) AS line_diff,
        round(abs(coalesce(ready_ocns, 0) - loaded_ocns) / loaded_ocns, 9) AS ocn_diff,
        coalesce(ready_lines, 0) > 0 AND abs(ready_lines - loaded_lines) / loaded_lines < 0.70
          AND abs(ready_ocns - loaded_ocns) / loaded_ocns < 0.25 AS acceptable FROM
        (SELECT organization, count(*) AS loaded_lines, count(DISTINCT ocn) AS loaded_ocns FROM holding_rows GROUP BY 1)
        LEFT JOIN (SELECT organization, count(*) AS ready_lines, count(DISTINCT ocn) AS ready_ocns FROM reloads GROUP BY 1)
        USING (organization)""",
    "type_gate": """SELECT n.organization, new_types, old_types,
        CASE WHEN n.organization = 'NATION_3' AND new_types LIKE '%ser%' THEN 'ser' ELSE '' END AS diff_types,
        NOT (n.organization = 'NATION_3' AND new_types LIKE '%ser%') AS acceptable FROM
        (SELECT organization, string_agg(DISTINCT mono_multi_serial, ',' ORDER BY mono_multi_serial) AS new_types
         FROM reloads GROUP BY 1) n LEFT JOIN
        (SELECT organization, string_agg(DISTINCT mono_multi_serial, ',' ORDER BY mono_multi_serial) AS old_types
         FROM holding_rows WHERE NOT (organization = 'NATION_3' AND mono_multi_serial = 'ser') GROUP BY 1) o
        USING (organization)""",
    "latest_loaded_file": """SELECT type, source, produced, filename FROM (SELECT *, row_number() OVER (
        PARTITION BY type, source ORDER BY produced DESC, filename DESC) AS r FROM loaded_files) WHERE r = 1""",
    "file_line_counts": """SELECT file_name, count(*) AS lines FROM submission_lines GROUP BY 1
        UNION ALL SELECT NULL, count(*) FROM submission_lines""",
    "new_files": """SELECT DISTINCT file_name AS name FROM submission_lines WHERE file_name NOT LIKE '%_mon_%'
        AND file_name NOT LIKE 'org-a%' AND file_name NOT LIKE 'org-b%' AND file_name NOT LIKE 'org-c%'
        AND file_name NOT LIKE 'org-d%'""",
    "sorted_split": """SELECT part, CAST(sum(n) AS BIGINT) AS holdings, min(ocn) AS low, max(ocn) AS high,
        CAST(1 AS BIGINT) AS partitions FROM (
          SELECT ocn, n, CAST(floor((sum(n) OVER (ORDER BY ocn) - n / 2) * 16 / (SELECT count(*) FROM holding_rows)) AS INTEGER)
            AS part FROM (SELECT ocn, count(*) AS n FROM holding_rows GROUP BY 1)) GROUP BY 1""",
    "transitive_clusters": """SELECT ocn, min(seen) AS component FROM tied_walk GROUP BY 1""",
    "frequency_incremental": "SELECT * FROM freq",
    "scrub_ocn": """SELECT l_orderkey, l_linenumber, raw_ocn, CASE form WHEN 3 THEN raw_ocn WHEN 0 THEN raw_ocn
          WHEN 1 THEN CAST(n AS VARCHAR) WHEN 2 THEN CAST(n AS VARCHAR) WHEN 4 THEN CAST(n AS VARCHAR)
          WHEN 12 THEN CAST(n AS VARCHAR) WHEN 13 THEN CAST(n AS VARCHAR) ELSE '' END AS ocns,
        CASE form WHEN 5 THEN 'invalid prefix' WHEN 6 THEN 'is mix of digits and non-digits' WHEN 13 THEN 'ocn is empty'
          WHEN 8 THEN 'numeric part is zero' WHEN 9 THEN 'too large for an ocn' WHEN 10 THEN 'is in exponential format'
          WHEN 11 THEN 'invalid paren prefix' ELSE '' END AS reasons FROM submitted""",
    "scrub_local_id": "SELECT raw_local_id, local_id FROM judged_lines",
    "scrub_issn": "SELECT raw_issn, issn_value AS issn FROM judged_lines",
    "scrub_status": """SELECT l_orderkey, l_linenumber, CASE WHEN raw_status = ' CH ' THEN 'CH' END AS status,
        CASE WHEN raw_condition = 'BRT' THEN 'BRT' END AS condition,
        CASE WHEN l_linenumber = 1 THEN '1' END AS gov_doc FROM submitted""",
    "enum_chron": """SELECT enum_chron, n_enum, n_chron, CASE WHEN n_enum = '' AND n_chron = '' THEN ''
        ELSE n_enum || chr(9) || n_chron END AS n_enum_chron, count(*) AS n FROM (
        SELECT enum_chron, n_enum, n_chron FROM h UNION ALL
        SELECT enum_chron, n_enum, CASE WHEN enum_chron LIKE '%(1990)' THEN '1990' ELSE '' END FROM ci)
        GROUP BY ALL""",
    "scrub_file": """SELECT organization, kind AS mono_multi_serial, local_id,
        CASE WHEN t = 1 AND raw_status = ' CH ' THEN 'CH' END AS status,
        CASE WHEN t = 2 AND raw_condition = 'BRT' THEN 'BRT' END AS condition,
        CASE WHEN t = 3 AND NOT regexp_matches(CAST(n AS VARCHAR), '^[12][0-9]{3}') THEN CAST(n AS VARCHAR) ELSE '' END AS n_enum,
        CASE WHEN t = 4 THEN issn_value END AS issn, count(*) AS holdings, CAST(sum(one) AS BIGINT) AS ocn_sum FROM (
          SELECT *, unnest(CASE WHEN form = 3 THEN [n, n + 1] ELSE [n] END) AS one
          FROM judged_lines WHERE ok_ocn AND NOT too_wide) GROUP BY ALL""",
    "enum_chron_shapes": f"""SELECT shape, enum_chron, {[e for e, _ in SHAPES]}[shape + 1] AS n_enum,
        {[c for _, c in SHAPES]}[shape + 1] AS n_chron, count(*) AS n FROM enum_texts GROUP BY ALL""",
    "scrub_and_load": """SELECT f.file_name, CASE WHEN f.ready_lines = 0 THEN 'nothing ready'
          WHEN f.nr = 3 THEN CASE WHEN p.pass3 THEN 'loaded' ELSE 'diff too big' END
          WHEN NOT p.pass2 THEN 'diff too big' WHEN p.pass3 THEN 'superseded' ELSE 'loaded' END AS outcome,
        f.ready_lines, f.ready_ocns, coalesce(a.ready_lines, 0) AS old_count,
        h.ready_lines AS held_lines, h.ocn_sum AS held_ocn_sum
        FROM sent_files f JOIN sent_passes p USING (sender, kind)
        LEFT JOIN sent_files a ON a.sender = f.sender AND a.kind = f.kind AND a.nr = 1
        LEFT JOIN sent_files h ON h.sender = f.sender AND h.kind = f.kind AND h.ready_lines > 0
          AND h.nr = CASE WHEN p.pass3 THEN 3 WHEN p.pass2 THEN 2 ELSE 1 END
        WHERE f.nr > 1""",
    "item_table_rows": """SELECT item_id, CASE WHEN bib_key % 7 = 0 THEN 0 ELSE bib_key END AS bib_key, rights,
        CASE WHEN bib_key % 2 = 0 THEN 'allow' ELSE 'deny' END AS access, bib_fmt, n_enum,
        CASE bib_key % 4 WHEN 0 THEN '' WHEN 1 THEN '' || k WHEN 2 THEN k || ',' || (k + 1) ELSE '0' END AS ocns FROM ci""",
    "headed_holdings_files": "SELECT uuid, ocn, organization, mono_multi_serial, date_received FROM holding_rows",
    "loaded_types": "SELECT DISTINCT organization, mono_multi_serial FROM holding_rows",
    "first_lines": "SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders ORDER BY o_orderkey LIMIT 10",
    "newest_file": """SELECT max('nation4_mon_' || strftime(produced, '%Y%m%d') || '_' || filename || '.ndj') AS name
        FROM loaded_files WHERE source = 'NATION_4' AND type = 'holding'""",
    "concordance_reload": "SELECT DISTINCT variant, canonical FROM new_concordance",
    "malformed_lines": """SELECT count(*) AS malformed FROM orders
        WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_custkey % 11 = 0""",
    "concordance_adjacency": """SELECT variant, string_agg(CAST(canonical AS VARCHAR), ',' ORDER BY canonical) AS canonicals
        FROM raw_concordance GROUP BY 1""",
    "uuid_lines": """SELECT file_name, count(*) AS lines, count(*) AS uuids, count(*) AS well_formed
        FROM submission_lines GROUP BY 1""",
    "delete_listed_rows": """SELECT organization, count(*) AS holdings, CAST(sum(ocn) AS BIGINT) AS ocn_sum FROM holding_rows h
        WHERE NOT EXISTS (SELECT 1 FROM ocn_list l WHERE l.ocn = h.ocn AND h.organization = 'NATION_' || (l.ocn % 25))
        GROUP BY 1""",
    "holding_dates": """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 < 3 THEN CAST(l_shipdate AS DATE) END
        AS received FROM lineitem""",
    "header_checks": """SELECT DISTINCT 'org-' || letter || '_' || kind || '_full_20240101.tsv' AS file_name,
        'org-' || letter AS organization, kind AS mono_multi_serial, CASE v WHEN 0 THEN 2 WHEN 4 THEN 2 ELSE 3 END AS expected,
        concat_ws(',', CASE WHEN v = 4 THEN 'oclc' END, CASE WHEN kind = 'mpm' AND v <> 2 THEN 'enum_chron' END) AS missing,
        'Column not allowed: ' || CASE v WHEN 1 THEN CASE WHEN kind IN ('mix', 'ser') THEN 'status' END
          WHEN 2 THEN CASE WHEN kind IN ('mix', 'spm', 'ser') THEN 'enum_chron' END
          WHEN 3 THEN CASE WHEN kind <> 'ser' THEN 'issn' END END AS fault,
        CASE v WHEN 1 THEN 2 WHEN 4 THEN NULL ELSE 0 END AS at_oclc, CASE v WHEN 1 THEN 0 WHEN 3 THEN 2 WHEN 4 THEN 0 ELSE 1 END
          AS at_local_id
        FROM (SELECT substr('abcdefghijklmnopqrstuvwxy', CAST(l_suppkey % 25 AS INT) + 1, 1) AS letter, l_suppkey % 5 AS v,
                     ['mix', 'mon', 'spm', 'mpm', 'ser'][CAST(l_linenumber % 5 AS INT) + 1] AS kind FROM lineitem)""",
    "submission_files": """SELECT file_name || CASE ascii(letter) % 4 WHEN 1 THEN '.gz' ELSE '' END AS file_name,
        count(*) AS data_lines, count(*) FILTER (ascii(letter) % 4 = 3) AS accented,
        min(value || CASE ascii(letter) % 4 WHEN 3 THEN 'é' ELSE '' END) AS first,
        max(value || CASE ascii(letter) % 4 WHEN 3 THEN 'é' ELSE '' END) AS last,
        CAST(nullif(sum(CASE WHEN NOT ok THEN 0 WHEN form = 3 THEN 2 ELSE 1 END), 0) AS BIGINT) AS holdings,
        CAST(sum(CASE WHEN ok THEN CASE WHEN form = 3 THEN 2 * n + 1 ELSE n END END) AS BIGINT) AS ocn_sum,
        nullif(count(*) FILTER (NOT ok), 0) AS refused
        FROM (SELECT *, substr(sender, 5) AS letter, form IN (0, 1, 2, 3, 4, 12, 13) AND NOT too_wide AS ok
              FROM submission_lines) GROUP BY letter, file_name""",
    "submission_stream": """SELECT f.file_name, CASE WHEN f.kind = 'spm' THEN 'mismatch in item types'
          WHEN f.ready_lines = 0 THEN 'nothing ready'
          WHEN f.day = '03' THEN CASE WHEN p.pass3 THEN 'loaded' ELSE 'diff too big' END
          WHEN f.day = '02' AND NOT p.pass2 THEN 'diff too big'
          WHEN p.pass3 OR (f.day = '01' AND p.pass2) THEN 'superseded' ELSE 'loaded' END AS outcome,
        f.ready_lines, f.ready_ocns, h.ready_lines AS held_lines, h.ocn_sum AS held_ocn_sum
        FROM arrived f LEFT JOIN arrived_passes p ON p.sender = f.sender AND p.kind = f.kind
        LEFT JOIN arrived h ON h.sender = f.sender AND h.kind = f.kind AND f.kind <> 'spm'
          AND h.day = CASE WHEN p.pass3 THEN '03' WHEN p.pass2 THEN '02' ELSE '01' END""",
    "filled_store_stream": """SELECT organization, mono_multi_serial, count(*) AS holdings, count(DISTINCT uuid) AS uuids,
        count(*) AS loaded_lines, count(DISTINCT ocn) AS loaded_ocns FROM holding_rows GROUP BY 1, 2""",
    "scrub_rejects": """SELECT file_name, reason, count(*) AS n_lines FROM (
        SELECT organization || '_' || kind || '_full_20240101.tsv' AS file_name, concat_ws(' // ',
          CASE WHEN too_wide THEN 'Wrong number of cols (expected ' || asked || ', got ' || width || ')' END,
          CASE WHEN NOT ok_ocn THEN 'No valid OCN' END) AS reason
        FROM judged_lines WHERE too_wide OR NOT ok_ocn) GROUP BY 1, 2""",
    "scrub_stats": """SELECT message, count(*) AS lines FROM (
        SELECT 'rec_with_ocn' AS message FROM submitted
        UNION ALL SELECT 'multi_ocn_record' FROM submitted WHERE form IN (3, 4, 13)
        UNION ALL SELECT 'ocn prefix: ' || CASE form WHEN 1 THEN 'ocn' WHEN 2 THEN '(OCoLC)' WHEN 5 THEN 'foo' ELSE '(abc)' END
          FROM submitted WHERE form IN (1, 2, 5, 11)
        UNION ALL SELECT '2 candidates in one local_id' FROM submitted
        UNION ALL SELECT 'issn rejected: nope' FROM submitted WHERE t = 4 AND raw_issn <> 'x'
        UNION ALL SELECT 'issn rejected: x' FROM submitted WHERE t = 4 AND raw_issn = 'x'
        UNION ALL SELECT 'status: ' || CASE trim(raw_status) WHEN '' THEN '<empty>' ELSE trim(raw_status) END
          FROM submitted WHERE t = 1
        UNION ALL SELECT 'condition: ' || raw_condition FROM submitted WHERE t = 2
        UNION ALL SELECT 'bad status value' FROM submitted WHERE t = 1 AND raw_status = 'lost'
        UNION ALL SELECT 'bad condition value' FROM submitted WHERE t = 2 AND raw_condition = 'brt'
        UNION ALL SELECT 'ocn rejected: ' || CASE form WHEN 5 THEN 'invalid prefix'
          WHEN 6 THEN 'is mix of digits and non-digits' WHEN 13 THEN 'ocn is empty' WHEN 8 THEN 'numeric part is zero'
          WHEN 9 THEN 'too large for an ocn' WHEN 10 THEN 'is in exponential format' ELSE 'invalid paren prefix' END
          FROM submitted WHERE form > 4 AND form NOT IN (7, 12, 14)) GROUP BY 1""",
    "file_name_checks": """SELECT DISTINCT replace(file_name, '_full_20240101', x) AS file_name, x = '_full_20240101' AS valid,
        split_part(file_name, '_', 1) AS member_id, split_part(file_name, '_', 2) AS item_type,
        'ok' AS member_id_check, 'ok' AS rest_check, x = '_full_20240101' AS update_ok, x = '_full_20240101' AS date_ok
        FROM submission_lines CROSS JOIN (SELECT unnest(['_full_20240101', '_all_2024']) AS x)""",
    "alma_convert": "SELECT o_orderkey, " + ", ".join(
        f"CASE WHEN error IS NULL THEN {c} END AS {c}" for c in
        ("item_type", "oclc", "local_id", "status", "condition", "enum_chron", "issn", "govdoc")) + ", error FROM marc_out",
    "alma_errors": "SELECT error, count(*) AS records FROM marc_out WHERE error IS NOT NULL GROUP BY 1",
    "cost_history": _pivot("grid").format(p=""),
    "cost_history_diff": f"SELECT key, report, {_DIFF_VALUE} AS value FROM steps",
    "cost_history_pct": """SELECT key, report, round(CASE WHEN x <> 0 THEN 100 * (y - x) / x END, 6) AS percent,
        CASE WHEN following IS NULL THEN '' WHEN x IS NULL OR y IS NULL THEN value END AS text FROM steps""",
    "cost_highlights": f"""SELECT key, max(CASE WHEN report = '2001' THEN value END) AS total_2001,
        max(CASE WHEN report = '2000' THEN {_DIFF_VALUE} END) AS diff_2000,
        max(CASE WHEN report = '2000' THEN round(CASE WHEN x <> 0 THEN 100 * (y - x) / x END, 6) END) AS percent_2000
        FROM steps WHERE {_NOT_CENTRAL} GROUP BY key""",
    "cost_baseline": f"""SELECT key, a AS total_1996, b AS total_2001, CASE WHEN a = 'N/A' THEN a WHEN b = 'N/A' THEN a
        ELSE CAST(CAST(b AS BIGINT) - CAST(a AS BIGINT) AS VARCHAR) END AS diff_1996,
        round(100 * (try_cast(b AS DOUBLE) - try_cast(a AS DOUBLE)) / try_cast(a AS DOUBLE), 6) AS percent_1996 FROM
        (SELECT key, max(CASE WHEN report = '1996' THEN value END) AS a,
         max(CASE WHEN report = '2001' THEN value END) AS b FROM grid GROUP BY key) WHERE {_NOT_CENTRAL}""",
    "legacy_holdings_file": """SELECT uuid, ocn, organization, coalesce(nullif(status, ''), 'CH') AS status,
        condition, mono_multi_serial, gov_doc_flag, n_enum FROM h""",
    "json_holdings_file": """SELECT uuid, ocn, organization, status, condition, mono_multi_serial, gov_doc_flag, n_enum
        FROM h""",
    "concordance_files": "SELECT DISTINCT variant, canonical FROM new_concordance",
    "ocn_list_file": """SELECT DISTINCT o_custkey AS ocn, (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) AS non_numeric
        FROM orders WHERE o_orderkey % 5 <> 0""",
    "catalog_file": """SELECT item_id, bib_key, rights, 'SE' AS bib_fmt, collection_code, n_enum, bib_key AS ocn FROM ci""",
    "marc_files": """SELECT item_type AS kind, oclc, local_id, govdoc FROM marc_out
        WHERE error IS NULL AND item_type IN ('mon', 'ser')""",
    "report_files": """SELECT organization, count(*) AS lines, CAST(sum(ocn) AS BIGINT) AS ocn_sum,
        count(*) FILTER (enum_chron <> '') AS with_enum FROM holding_rows GROUP BY 1""",
    "backup_file": """SELECT uuid, ocn, organization, status, condition, mono_multi_serial, gov_doc_flag, n_enum
        FROM h WHERE organization = 'NATION_3' AND mono_multi_serial IN ('ser', 'mon')""",
    "split_files": """SELECT count(*) AS lines, CAST(0 AS BIGINT) AS unsorted, CAST(0 AS BIGINT) AS overlapping
        FROM holding_rows""",
    "histogram_files": "SELECT bucket, frequency, organization, format FROM freq",
    "frequency_files": "SELECT bucket, CAST(frequency * 2 AS BIGINT) AS frequency FROM freq WHERE organization = 'NATION_4' AND format = 'mpm'",
    "store_files": """SELECT organization, mono_multi_serial, count(*) AS holdings, CAST(sum(ocn) AS BIGINT) AS ocn_sum
        FROM holding_rows WHERE organization = 'NATION_3' AND (mono_multi_serial <> 'ser' OR ocn % 2 = 0) GROUP BY 1, 2""",
    "what_if_organizations": """SELECT inst_id, weight, CASE WHEN weight < 0 OR weight > 10
          THEN 'Weight must be between 0 and 10' END AS reason FROM (
        SELECT inst_id, CASE inst_id WHEN 'NATION_1' THEN weight + 10 ELSE weight END AS weight FROM organizations
        UNION ALL SELECT 'planned', weight + 10 FROM organizations WHERE inst_id = 'NATION_2')""",
    "synthetic_holdings": f"""SELECT {_md5('ocn')} % 100000 AS ocn, CAST({_md5('local')} % 10000000 AS VARCHAR) AS local_id,
        'org-a' AS organization, ['CH', 'LM', 'WD', NULL][{_md5('status')} % 4 + 1] AS status,
        ['BRT', ''][{_md5('condition')} % 2 + 1] AS condition, '' AS enum_chron, 'mon' AS mono_multi_serial,
        CAST(NULL AS VARCHAR) AS issn, {_md5('gov')} % 2 = 1 AS gov_doc_flag,
        'org-a-' || sha256(CAST(id AS VARCHAR)) AS uuid, DATE '2020-01-01' AS date_received
        FROM (SELECT o_orderkey AS id FROM orders)""",
    "synthetic_concordance": f"""SELECT id AS variant, id + {_md5('to')} % (1000000 - id) + 1 AS canonical
        FROM (SELECT DISTINCT l_partkey AS id FROM lineitem)
        WHERE id > 0 AND id < 1000000 AND {_md5('drop')} % 10000 < 1000""",
    "holdings_stream_ingest": """SELECT organization, mono_multi_serial, count(*) AS holdings, count(DISTINCT uuid) AS uuids
        FROM h GROUP BY 1, 2""",
    "cluster_ocns": """SELECT l.ocn AS seed, x.ocn FROM ocn_list l JOIN c3 x ON x.seed = l.ocn""",
}

_STATUS = """CASE WHEN coalesce(sum({f}copy_count), 0) = 0 THEN 'not_held'
    WHEN sum({f}current_holding_count) > 0 THEN 'held' WHEN sum({f}lm_count) > 0 THEN 'lost_missing'
    WHEN sum({f}wd_count) > 0 THEN 'withdrawn' ELSE 'unknown' END"""
_QUERIES["deposit_analysis"] = _QUERIES["deposit_analysis"].format(
    own=_STATUS.format(f="(g.inst_id = i.billing_entity)::INT * v."), mapped=_STATUS.format(f="v."))

for step, source in (("1", "c0"), ("3", "c2")):
    PARTS[f"c{step}"] = re.sub(r"\bs0\b", source, PARTS["s1"])
PARTS["c2"] = re.sub(r"\bs1\b", "c1", PARTS["s2"])
PARTS["c0"] = "SELECT ocn AS seed, ocn FROM ocn_list"
PARTS = {n: PARTS[n] for n in (*[p for p in PARTS if p not in ("c0", "c1", "c2", "c3")], "c0", "c1", "c2", "c3")}

_QUERIES["estimate_text"] = """SELECT printf('Total Estimated IC Cost: $%.2f', estimated_ic_cost) AS value FROM estimated
    UNION ALL SELECT printf('In all, we received %d distinct OCLC numbers.', ocns_total) FROM estimated
    UNION ALL SELECT printf('Of those distinct OCLC numbers, %d (%.1f%%) match items in', ocns_matched, pct_ocns_matched) FROM estimated
    UNION ALL SELECT printf('the library, corresponding to %d the library items.', items_matched) FROM estimated
    UNION ALL SELECT printf('Of those items, %d (%.1f%%) are in the public domain,', items_pd, pct_items_pd) FROM estimated
    UNION ALL SELECT printf('%d (%.1f%%) are in copyright.', items_ic, pct_items_ic) FROM estimated"""
PARTS["estimated"] = _QUERIES["estimate_new_member"]
_QUERIES["cost_from_tables"] = _QUERIES["cost_by_member"]

ORACLE: dict[str, str] = {name: _with(text) for name, text in _QUERIES.items()}

# the whole table again, over what is held after the load
_RELOADS = f"({PARTS['reloads']}) reloads"
_LATER = f"""(SELECT * FROM holding_rows WHERE (organization, mono_multi_serial) NOT IN (
                  SELECT (organization, mono_multi_serial) FROM {_RELOADS})
             UNION ALL SELECT * FROM {_RELOADS} WHERE uuid NOT IN (SELECT uuid FROM holding_rows WHERE
                  (organization, mono_multi_serial) NOT IN (SELECT (organization, mono_multi_serial) FROM {_RELOADS})))"""
ORACLE["frequency_incremental"] = ORACLE["frequency_incremental"].replace(
    PARTS["h"], PARTS["h"].replace("FROM holding_rows", f"FROM {_LATER}"))
