"""Named queries of the operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcount.llm import (bpe, decontaminate, exact, extract, fill_middle, licences, merkle, packing, quality, simhash,
                            suffix_dedup, token_counts, url_lists)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MULTI = "byte_bpe_multi_50k.tiktoken"
PLAIN = "byte_bpe_50k.json"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_suffix_dedup(spark, folder):
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op2_quality_classifier(spark, folder):
    return quality.predictions(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_byte_bpe(spark, folder):
    return bpe.encode_decode(table(spark, folder, "documents"), public_tokenizers.path(MULTI),
                             public_tokenizers.PATTERN)


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a day of fetch in 2024 or 2025, by their id."""
    return pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"),
                                                  F.pmod(F.col("page_id") * 7919, F.lit(730)).cast("int")))


def changes_of(pages: DataFrame) -> DataFrame:
    """A dated change of a list for every page: its host, its domain, or its host and up to six path parts."""
    n = F.col("page_id")
    name, parts = url_lists.host(F.col("url")), F.filter(F.split(url_lists.path(F.col("url")), "/"), lambda p: p != "")
    entry = (F.when(F.pmod(n, F.lit(3)) == 0, name)
             .when(F.pmod(n, F.lit(3)) == 1, F.regexp_replace(name, r"^[^.]+\.", ""))
             .otherwise(F.concat(name, F.lit("/"), F.array_join(
                 F.slice(parts, F.lit(1), (F.pmod(F.floor(n / 3), F.lit(6)) + 1).cast("int")), "/"))))
    return pages.select(
        F.concat(F.lit("list"), F.pmod(F.floor(n / 3), F.lit(4)).cast("string")).alias("list"), entry.alias("entry"),
        F.date_add(F.lit("2023-10-01").cast("date"), F.pmod(n * 104729, F.lit(800)).cast("int")).alias("day"),
        (F.pmod(F.floor(n / 7), F.lit(3)) != 0).alias("added"))


@query
def op4_url_lists(spark, folder):
    pages = table(spark, folder, "pages")
    return url_lists.evaluate(captures_of(pages), changes_of(pages))


@query
def op5_simhash(spark, folder):
    return simhash.near_components(table(spark, folder, "documents"))


@query
def op6_token_counts(spark, folder):
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(PLAIN))


@query
def op7_licences(spark, folder):
    return licences.scan(table(spark, folder, "documents"))


@query
def op8_decontamination(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op9_exact_dedup(spark, folder):
    return exact.exact_groups(table(spark, folder, "documents"))


@query
def op10_html_extraction(spark, folder):
    return extract.extract(table(spark, folder, "pages"))


@query
def op11_fill_in_middle(spark, folder):
    return fill_middle.digests(table(spark, folder, "documents"))


@query
def op12_packing(spark, folder):
    return packing.digests(table(spark, folder, "documents"), public_tokenizers.path(PLAIN))


@query
def op13_merkle_manifest(spark, folder):
    return merkle.verified(table(spark, folder, "documents"))


ORACLE["op4_url_lists"] = r"""
WITH p AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id * 7919 % 730 AS INTEGER) AS DATE) AS fetched,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
                     lambda s: s <> '') AS parts
  FROM pages),
c AS (
  SELECT 'list' || CAST(page_id // 3 % 4 AS VARCHAR) AS list,
         CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]+\.', '')
              ELSE host || '/' || array_to_string(parts[1:page_id // 3 % 6 + 1], '/') END AS entry,
         CAST(DATE '2023-10-01' + CAST(page_id * 104729 % 800 AS INTEGER) AS DATE) AS day,
         page_id // 7 % 3 <> 0 AS added
  FROM p),
d AS (SELECT list, entry, day, bool_and(added) AS added FROM c GROUP BY ALL),
v AS (SELECT *, lead(day) OVER (PARTITION BY list, entry ORDER BY day) AS until FROM d),
n AS (
  SELECT page_id, fetched, unnest(list_distinct(
           list_transform(range(1, greatest(len(string_split(host, '.')), 2)),
                          lambda i: array_to_string(string_split(host, '.')[i:], '.'))
           || list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[:i], '/'))
         )) AS entry
  FROM p WHERE host <> ''),
h AS (
  SELECT page_id, count(*) AS n_entries, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
  FROM n JOIN v USING (entry)
  WHERE added AND day <= fetched AND (until IS NULL OR fetched < until) GROUP BY page_id)
SELECT page_id, url, fetched, coalesce(n_entries, 0) AS n_entries, coalesce(lists, '') AS lists
FROM p LEFT JOIN h USING (page_id)
"""

ORACLE["op7_licences"] = licences.oracle()

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"""

ORACLE["op8_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM places JOIN phrases USING (n, phrase)),
words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
          FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE["op9_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

ORACLE["op11_fill_in_middle"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
d AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS one, greatest(h1 % (n + 1), h2 % (n + 1)) AS two,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(units[1:one], '') AS prefix, array_to_string(units[one + 1:two], '') AS middle,
         array_to_string(units[two + 1:], '') AS suffix
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

# DuckDB has no crc32: it is worked out bit by bit over the decimal id.
ORACLE["op13_merkle_manifest"] = r"""
WITH RECURSIVE
crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, i + 1, CASE WHEN i % 9 = 0 THEN xor(c, CAST(ord(s[i // 9 + 1]) AS BIGINT))
                                WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END
  FROM crc WHERE i < length(s) * 9),
chosen AS (SELECT doc_id FROM crc WHERE i = length(s) * 9 AND xor(c, CAST(4294967295 AS BIGINT)) % 7 = 0),
fields AS (
  SELECT d.*, c.doc_id IS NOT NULL AND n_chars IS NOT NULL AS hit, n_chars + 1 AS more
  FROM documents d LEFT JOIN chosen c ON c.doc_id = d.doc_id),
texts AS (
  SELECT doc_id, lang, hit,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
           || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS size,
         octet_length(encode(CAST(more AS VARCHAR))) || ':' || more AS wrong_size,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS body
  FROM fields),
leaves AS (
  SELECT doc_id, lang, sha256(head || size || body) AS leaf,
         CASE WHEN hit THEN sha256(head || wrong_size || body) END AS wrong FROM texts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
                                         lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
             FROM levels WHERE len(nodes) = 1),
tops AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
                                   lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
  FROM tops WHERE len(nodes) > 1),
steps AS (
  SELECT p.lang, p.place, l.level, (p.place >> l.level) % 2 = 1 AS is_right,
         l.nodes[xor(p.place >> l.level, 1) + 1] AS sibling
  FROM placed p JOIN levels l ON l.lang IS NOT DISTINCT FROM p.lang WHERE len(l.nodes) > 1
  UNION ALL
  SELECT p.lang, p.place, s.height + t.level, (s.place >> t.level) % 2 = 1, t.nodes[xor(s.place >> t.level, 1) + 1]
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, tops t WHERE len(t.nodes) > 1),
proofs AS (
  SELECT lang, place, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256,
         list(is_right ORDER BY level) AS sides, list(sibling ORDER BY level) AS siblings
  FROM steps GROUP BY lang, place),
folds AS (
  SELECT p.lang, p.place, 0 AS done, coalesce(p.wrong, p.leaf) AS node, coalesce(f.sides, []) AS sides,
         coalesce(f.siblings, []) AS siblings
  FROM placed p LEFT JOIN proofs f ON f.lang IS NOT DISTINCT FROM p.lang AND f.place = p.place
  UNION ALL
  SELECT lang, place, done + 1,
         sha256(CASE WHEN sides[done + 1] THEN siblings[done + 1] || node
                     ELSE node || coalesce(siblings[done + 1], '') END), sides, siblings
  FROM folds WHERE done < len(sides))
SELECT p.doc_id, p.leaf, s.subroot, t.nodes[1] AS root, coalesce(f.proof_sha256, sha256('')) AS proof_sha256,
       o.node AS folded_root, o.node = t.nodes[1] AS verified
FROM placed p
JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
JOIN tops t ON len(t.nodes) = 1
LEFT JOIN proofs f ON f.lang IS NOT DISTINCT FROM p.lang AND f.place = p.place
JOIN folds o ON o.lang IS NOT DISTINCT FROM p.lang AND o.place = p.place AND o.done = len(o.sides)
"""
