"""Named queries over the derived tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcount.derived.views import CENTRAL, MAX_OCN, TARGET_COST, Tables
from shelfcount.functions import marc, rights, scrub
from shelfcount.functions.enum_chron import with_enum_chron
from shelfcount.operators import (changes, clusters, concordance, counts, dimensions, formats,
                                  frequency, overlap)
from shelfcount.plans import (cost, deposit, estimate, incremental, load, lookups, non_current, overlap_report,
                              synthetic, trends)
from shelfcount.session import dealt, materialize, shared_folder
from shelfcount.sources import files, marcxml, sinks, slices, submissions, tables
from shelfcount.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def record_overlap(t: Tables) -> DataFrame:
    return overlap.overlap(t.items, t.search, t.holdings)


def lookup_model(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Home items with formats, and overlap rows, of the clusters of the requested items."""
    return lookups.lookup_model(t.requests, t.items, t.concordance, t.holdings)


# --- counts and scans --------------------------------------------------------

@query
def holdings_counts_by_org_type(t):
    return counts.holdings_by_type(t.holdings)


@query
def holdings_counts_by_org(t):
    return counts.holdings_by_organization(t.holdings)


@query
def item_counts(t):
    return counts.item_counts(t.items)


@query
def scrubbed_counts(t):
    return counts.scrubbed_counts(t.holdings)


@query
def ocns_for_items(t):
    return tables.items_with_ocns(t.items, t.bridge, t["ocn_list"]).select("item_id", "bib_key")


@query
def holdings_with_ocns(t):
    return (tables.holdings_with_ocns(t.holdings, t["ocn_list"])
            .groupBy("organization").agg(F.count("*").alias("holdings")))


@query
def items_on_records(t):
    asked = t["lineitem"].select(F.expr("l_orderkey").alias("bib_key")).distinct()
    return tables.items_on_records(t.items, asked).select("item_id", "bib_key")


@query
def find_items(t):
    asked = t["requests"].select(F.regexp_replace("item_id", "7$", "7x").alias("item_id")).distinct()
    return tables.find_items(asked, t.items.select("item_id", "rights")).select(
        "item_id", "rights", "not_found")


@query
def resolutions_with_ocns(t):
    return tables.resolutions_with_ocns(t.concordance, t["ocn_list"])


@query
def organizations_join(t):
    org = t.organizations
    return tables.organizations(
        org.select("inst_id", "weight", "status", F.lit("sym").alias("oclc_sym")),
        org.select("inst_id", "country_code", "mapto_inst_id"))


@query
def access_nonus(t):
    rows = t.items.select("item_id", "rights", "access").join(t["requests"], "item_id")
    with_org = dimensions.with_organization_attributes(rows, t.organizations)
    return with_org.select("item_id", "organization", rights.access_for_country(
        "rights", "access", "country_code").alias("access"))


@query
def catalog_records(t):
    """Records written the way the catalogue exports them, then parsed back."""
    from shelfcount.sources import catalog

    def ends(column):
        """All of a record's values, few as they are."""
        return F.sort_array(F.collect_set(column))

    one = F.to_json(F.struct(F.col("item_id").alias("htid"), F.array("rights").alias("rights"),
                             F.col("enum_chron").alias("enumcron"),
                             F.lower("collection_code").alias("collection_code")))
    nested = t["item_rows"].withColumn("one", one).groupBy("bib_key").agg(ends(F.col("one")).alias("ones"))
    found = t["record_oclc"].groupBy("bib_key").agg(ends(F.col("ocn").cast("string")).alias("oclc"))
    raw = nested.join(found, "bib_key", "left").select(
        F.lpad(F.col("bib_key").cast("string"), 9, "0").alias("id"),
        F.when(F.col("bib_key") % 3 == 0, F.array(F.lit("Serial"), F.lit("Journal")))
        .when(F.col("bib_key") % 3 == 1, F.array(F.lit("Book"))).alias("format"),
        "oclc", F.col("oclc").alias("oclc_search"), F.lit(False).alias("deleted"),
        F.concat(F.lit("["), F.array_join("ones", ","), F.lit("]")).alias("ht_json"))
    parsed = catalog.load(catalog.with_ic_items(catalog.not_deleted(catalog.parse_records(raw))))
    return parsed.items.filter(rights.is_ic("rights")).select(
        "cluster_id", "item_id", "bib_key", "rights", "access", "bib_fmt", "n_enum",
        "collection_code", F.size("ocns").alias("n_ocns"))


@query
def missing_collections(t):
    known = t["collections"].filter(F.col("billing_entity") != "NATION_9")
    return dimensions.missing_collections(t.items, known)


# --- clusters and formats ----------------------------------------------------

@query
def concordance_expand(t):
    seeds = t["ocn_list"].select(F.col("ocn").alias("key"), "ocn")
    return clusters.concordance_expand(seeds, t.concordance)


@query
def related_ocns(t):
    seeds = t["ocn_list"].select(F.col("ocn").alias("key"), "ocn")
    return clusters.related_ocns(seeds, t.bridge)


@query
def cluster_ocns(t):
    seeds = t["ocn_list"].select(F.col("ocn").cast("string").alias("seed"), "ocn")
    home, ocns = clusters.ocn_clusters(seeds, t.bridge, t.concordance)
    return home.join(ocns, "cluster_id").select(F.col("seed").cast("bigint").alias("seed"), "ocn")


@query
def transitive_clusters(t):
    return clusters.transitive_clusters(t.bridge, t.concordance)


@query
def record_cluster_ocns(t):
    """OCNs of records written the way the catalogue exports them, then parsed back."""
    from shelfcount.sources import catalog

    own = t["record_oclc"].groupBy("bib_key").agg(F.collect_set(F.col("ocn").cast("string")).alias("oclc"))
    found = t["record_search"].groupBy("cluster_id").agg(F.collect_set(F.col("ocn").cast("string")).alias("oclc_search"))
    one = F.to_json(F.struct(F.col("item_id").alias("htid"), F.array("rights").alias("rights"),
                             F.lower("collection_code").alias("collection_code")))
    nested = t["item_rows"].groupBy("bib_key", "cluster_id").agg(F.collect_list(one).alias("ones"))
    raw = nested.join(own, "bib_key", "left").join(found, "cluster_id", "left").select(
        F.col("bib_key").cast("string").alias("id"), F.array(F.lit("Book")).alias("format"), "oclc", "oclc_search",
        (F.col("bib_key") % 9 == 4).alias("deleted"),
        F.concat(F.lit("["), F.array_join("ones", ","), F.lit("]")).alias("ht_json"))
    parsed = catalog.load(catalog.not_deleted(catalog.parse_records(raw)))
    return parsed.record_ocns.select("cluster_id", "ocn")


@query
def item_formats(t):
    return formats.with_formats(t.items).select("item_id", "item_format", "cluster_format")


@query
def cluster_formats(t):
    return formats.cluster_formats(formats.record_flags(t.items)).select("cluster_id", "cluster_format")


@query
def cluster_resolutions(t):
    return clusters.cluster_resolutions(t.search, t.concordance)


@query
def cluster_items(t):
    return clusters.cluster_items(t.search, t.bridge)


@query
def organizations_in_cluster(t):
    return overlap.organizations_in_clusters(t.items, t.search, t.holdings)


@query
def cluster_enums(t):
    return overlap.cluster_enums(t.items, t.search, t.holdings)


@query
def cluster_org_counts(t):
    by_org = overlap.count_by_org(overlap.count_by_enum(t.holdings))
    return overlap.cluster_org_counts(t.search, by_org).select(
        "cluster_id", "organization", *overlap.REPORT_COUNTS)


@query
def orgs_without_enum_match(t):
    return overlap.unmatched_organizations(overlap.prepare(t.items, t.search, t.holdings))


@query
def empty_clusters(t):
    listed = t["ocn_list"].select(F.concat(F.lit("x."), F.col("ocn") % 997).alias("cluster_id"),
                                  (F.col("ocn") * 3).alias("ocn"))
    return clusters.empty_clusters(listed, t.bridge, t.concordance, t.holdings)


@query
def inspect_cluster(t):
    parts = clusters.inspect(t.search, t.items.drop("cluster_id"), t.bridge, t.holdings, t.concordance)
    # least and greatest texts are found in sorted rows: dealt out first, so that a task sorts a bounded number of them
    # rather than, beside its join, all that the join gives
    together = dealt(parts.select("cluster_id", "part", "key"), t.holdings.count(), "cluster_id", "part")
    return together.groupBy("cluster_id", "part").agg(
        F.count("*").alias("members"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


# --- overlap, frequency, cost ------------------------------------------------

def _of_format(t: Tables, *kinds: str) -> DataFrame:
    return overlap.record(record_overlap(t).filter(F.col("cluster_format").isin(*kinds)))


@query
def overlap_serial(t):
    return _of_format(t, "ser")


@query
def overlap_single(t):
    return _of_format(t, "spm", "ser/spm")


@query
def overlap_multi(t):
    return _of_format(t, "mpm")


@query
def overlap_fact(t):
    return overlap.record(record_overlap(t))


@query
def depositor_only(t):
    return record_overlap(t).filter("deposited_only").select("item_id", "organization")


@query
def brittle_current(t):
    return record_overlap(t).select(
        "item_id", "organization", overlap.any_current_brittle().alias("any_brittle"),
        overlap.all_current_brittle().alias("all_brittle"))


@query
def item_members(t):
    return overlap.member_counts(record_overlap(t), t.organizations)


@query
def item_h_share(t):
    return overlap.h_shares(record_overlap(t), t.organizations).withColumn(
        "h_share", F.round("h_share", 9))


def _frequencies(t: Tables) -> DataFrame:
    return cost.ic_frequencies(t.items, t.search, t.holdings, t.organizations)


@query
def frequency_table(t):
    return _frequencies(t)


@query
def frequency_incremental(t):
    """The table of before, brought up to date after slices were replaced, from what changed."""
    before = t.holdings
    # rows that stay are parsed already; the enumerations of new ones are parsed where they come in
    reloads = materialize(with_enum_chron(t["reloads"]), "reloads")
    after = materialize(changes.replace_slice(before, reloads), "after")
    slices_of = reloads.select(*load.SLICE).distinct()
    changed = incremental.changed_ocns(*[h.join(slices_of, load.SLICE, "left_semi") for h in (before, after)])
    return incremental.updated(_frequencies(t), incremental.frequency_change(
        t.items, t.search, before, after, changed, t.organizations))


@query
def frequency_histogram(t):
    return frequency.histogram(_frequencies(t))


@query
def frequency_merge(t):
    """Tables of two halves of the items, as JSON and back, add up to the whole."""
    rows = record_overlap(t).filter(rights.is_ic("rights"))
    half = F.pmod(F.xxhash64("item_id"), F.lit(2))
    parts = [frequency.as_json(frequency.frequencies(rows.filter(half == i), t.organizations))
             for i in (0, 1)]
    return frequency.merge(files.frequency_rows(parts[0].union(parts[1])))


@query
def hscore_by_member(t):
    scores = frequency.hscores(_frequencies(t))
    return scores.select("organization", *[F.round(c, 6).alias(c) for c in ("spm", "mpm", "ser", "total")])


def _cost(t: Tables) -> cost.CostReport:
    return cost.cost_report(t.items, t.search, t.holdings, t.organizations, TARGET_COST, CENTRAL)


@query
def cost_summary(t):
    return _cost(t).summary


@query
def cost_by_member(t):
    report = _cost(t).by_member
    return report.select("member_id", "weight", *[
        F.round(c, 6).alias(c) for c in ("spm", "mpm", "ser", "pd", "extra", "total")])


@query
def estimate_new_member(t):
    return estimate.estimate(t["ocn_list"], t.items, t.search, t.holdings, t.organizations,
                             TARGET_COST).withColumn("h_share", F.round("h_share", 6))


@query
def estimate_text(t):
    return estimate.as_text(estimate.estimate(t["ocn_list"], t.items, t.search, t.holdings, t.organizations, TARGET_COST),
                            "the library")


# --- reports and lookups -----------------------------------------------------

@query
def overlap_report_all(t):
    return overlap_report.overlap_report(t.items, t.search, t.holdings, t.organizations)


@query
def overlap_report_members(t):
    return overlap_report.overlap_report(t.items, t.search, t.holdings, t.organizations,
                                         organization="NATION_4", with_members=True)


@query
def deposit_analysis(t):
    return deposit.deposit_analysis(t.items, t.search, t.holdings, t.organizations)


@query
def non_current_items(t):
    return non_current.non_current_items(t.items, t.search, t.holdings)


@query
def non_current_pivot(t):
    return non_current.non_current_counts(
        non_current.non_current_items(t.items, t.search, t.holdings))


@query
def item_access(t):
    placed, rows = lookup_model(t)
    kinds = placed.select("item_id", "cluster_format")
    answers = lookups.item_access(t.requests, rows, t.items, t.organizations, kinds)
    return answers.withColumn("ocns", F.array_join(F.col("ocns").cast("array<string>"), ","))


@query
def request_checks(t):
    asked = t.requests.select(
        F.regexp_replace("organization", "_3$", "_300").alias("organization"),
        F.regexp_replace("item_id", r"^p\.\d$", "").alias("item_id")).distinct()
    return lookups.check_requests(asked, t.items, t.organizations).select(
        "organization", "item_id", "mapto", "error")


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("organizations", F.array_join("organizations", ","))


@query
def item_held_by(t):
    return _joined(lookups.item_held_by(t.requests, lookup_model(t)[1]))


@query
def item_held_by_brlm(t):
    return _joined(lookups.item_held_by(t.requests, lookup_model(t)[1], "brlm"))


@query
def record_held_by(t):
    asked = t.items.join(t.requests, "item_id", "left_semi").select("cluster_id")
    return _joined(lookups.record_held_by(asked, t.items, t.search, t.holdings))


@query
def members(t):
    return dimensions.member_list(t.organizations)


@query
def mapto_organizations(t):
    asked = t["requests"].select("organization").distinct()
    return dimensions.resolve_mapto(asked, t.organizations)


# --- concordance -------------------------------------------------------------

@query
def concordance_delta_adds(t):
    return concordance.delta(t.concordance, t["new_concordance"])[0]


@query
def concordance_delta_deletes(t):
    return concordance.delta(t.concordance, t["new_concordance"])[1]


@query
def concordance_apply(t):
    adds, deletes = concordance.delta(t.concordance, t["new_concordance"])
    return concordance.apply_delta(t.concordance, adds, deletes)


@query
def concordance_neighbours(t):
    return concordance.neighbours(t["raw_concordance"])


@query
def concordance_terminals(t):
    return concordance.terminals(t["raw_concordance"])


@query
def concordance_components(t):
    return concordance.components(t["raw_concordance"])


@query
def concordance_cycles(t):
    return concordance.validate(t["raw_concordance"]).cyclic


@query
def concordance_validated(t):
    return concordance.validate(t["raw_concordance"]).valid


@query
def concordance_rejected(t):
    return concordance.validate(t["raw_concordance"]).rejected


# --- change sets and gates ---------------------------------------------------

@query
def replace_holdings(t):
    new = changes.replace_slice(t["holding_rows"], t["reloads"])
    return new.groupBy("organization", "mono_multi_serial").agg(
        F.count("*").alias("holdings"), F.sum("ocn").alias("ocn_sum"))


@query
def replacement_counts(t):
    return changes.replacement_counts(t["holding_rows"], t["reloads"])


@query
def insert_ignore(t):
    added = changes.insert_ignore(t["holding_rows"], t["reloads"].union(t["reloads"]))
    return added.select("uuid", "ocn", "organization")


@query
def delete_by_uuid(t):
    lines = t["holding_rows"].filter("ocn % 3 = 0").select(
        F.concat_ws("\t", F.when(F.col("ocn") % 4 == 0, F.lit("none")).otherwise(F.col("ocn").cast("string")),
                    "organization", "uuid").alias("value"))
    return changes.delete_by_uuid(t["holding_rows"], changes.valid_deletions(lines)).groupBy(
        "organization").agg(F.count("*").alias("holdings"))


@query
def dedupe_holdings(t):
    return changes.dedupe(t.holdings).select("uuid", "ocn", "organization")


@query
def migrate_item_types(t):
    old = t["holding_rows"].withColumn("mono_multi_serial", F.expr(
        "CASE mono_multi_serial WHEN 'spm' THEN 'mono' WHEN 'mpm' THEN 'multi' "
        "WHEN 'ser' THEN 'serial' ELSE mono_multi_serial END"))
    return counts.holdings_by_type(changes.migrate_item_types(old))


@query
def size_gate(t):
    gate = counts.size_gate(t["holding_rows"], t["reloads"], ["organization"], 0.70, 0.25)
    return gate.withColumns({c: F.round(c, 9) for c in ("line_diff", "ocn_diff")})


@query
def type_gate(t):
    loaded = t["holding_rows"].filter("NOT (organization = 'NATION_3' AND mono_multi_serial = 'ser')")
    gate = counts.type_gate(loaded, t["reloads"])
    return gate.select("organization", *[F.array_join(c, ",").alias(c) for c in
                                         ("new_types", "old_types", "diff_types")], "acceptable")


@query
def latest_loaded_file(t):
    return changes.latest_loaded(t["loaded_files"])


@query
def file_line_counts(t):
    lines = t["submission_lines"].select("file_name", "value")
    return counts.directory_counts(lines)


@query
def new_files(t):
    listed = t["submission_lines"].select(
        F.regexp_replace("file_name", "^(org-[abc]_.*)[.]tsv$", "$1.xml").alias("name")).distinct()
    seen = listed.filter("name like '%_mon_%'")
    return files.new_files(listed.withColumn("is_dir", F.col("name").like("org-d%")), seen).select("name")


@query
def sorted_split(t):
    """Sixteen parts: what each has, and that a partition is one part."""
    parts = sinks.sorted_split(t["holding_rows"].select("uuid", "ocn"), 16)
    return parts.withColumn("partition", F.spark_partition_id()).groupBy("part").agg(
        F.count("*").alias("holdings"), F.min("ocn").alias("low"), F.max("ocn").alias("high"),
        F.count_distinct("partition").alias("partitions"))


# --- scrub -------------------------------------------------------------------

@query
def scrub_ocn(t):
    judged = t["submitted"].select("l_orderkey", "l_linenumber", "raw_ocn",
                                   scrub.ocn_candidates(F.col("raw_ocn"), MAX_OCN).alias("c"))
    return judged.select(
        "l_orderkey", "l_linenumber", "raw_ocn",
        F.array_join(scrub.valid_ocns(F.col("c")).cast("array<string>"), ",").alias("ocns"),
        F.array_join(scrub.reject_reasons(F.col("c")), ",").alias("reasons"))


@query
def scrub_local_id(t):
    return t["submitted"].select("raw_local_id", scrub.local_id(F.col("raw_local_id")).alias("local_id"))


@query
def scrub_issn(t):
    return t["submitted"].select("raw_issn", scrub.issn(F.col("raw_issn")).alias("issn"))


@query
def scrub_status(t):
    return t["submitted"].select(
        "l_orderkey", "l_linenumber", scrub.status(F.col("raw_status")).alias("status"),
        scrub.condition(F.col("raw_condition")).alias("condition"),
        scrub.gov_doc(F.col("l_linenumber").cast("string")).alias("gov_doc"))


@query
def enum_chron(t):
    both = t["holding_rows"].select("enum_chron").union(t["item_rows"].select("enum_chron"))
    return with_enum_chron(both).groupBy("enum_chron", "n_enum", "n_chron", "n_enum_chron").agg(
        F.count("*").alias("n"))


@query
def enum_chron_shapes(t):
    """Forty shapes of text, each against a result worked out by hand."""
    return with_enum_chron(t["enum_texts"]).groupBy("shape", "enum_chron", "n_enum", "n_chron").agg(
        F.count("*").alias("n"))


def _submissions(lines: DataFrame) -> submissions.Submissions:
    return submissions.Submissions(lines.select("file_name", "value"), lines.select("file_name", "header").distinct())


def _scrubbed(t: Tables) -> submissions.Scrubbed:
    return submissions.scrub_lines(_submissions(t["submission_lines"]), "2024-01-01", MAX_OCN)


@query
def scrub_and_load(t):
    """Two deliveries into an empty store, the second with two files of each slice: outcomes, and what is held."""
    work = f"{shared_folder(t.spark)}/load-{uuid.uuid4().hex}"
    for number, name in enumerate(("submission_lines", "second_lines")):
        lines = t[name]
        outcomes = load.load_files(t.spark, lines.select("file_name").distinct(), _submissions(lines), f"{work}/store",
                                   f"{work}/ledger", f"{work}/{number}", "2024-01-01", MAX_OCN, load.Limits(0.5, 0.5))
    held = t.spark.read.parquet(f"{work}/store").groupBy(*load.SLICE).agg(
        F.count("*").alias("held_lines"), F.sum("ocn").alias("held_ocn_sum"))
    return outcomes.join(held, load.SLICE, "left").select(
        "file_name", "outcome", "ready_lines", "ready_ocns", "old_count", "held_lines", "held_ocn_sum")


#: How files come: suffix, encoding, what the header has around it, and the options of the writer.
_STYLES = ((("", None, "", ""), {}), ((".gz", None, "", "\t\t"), {"compression": "gzip"}),
           (("", None, "\ufeff", ""), {"lineSep": "\r\n"}), (("", "ISO-8859-1", "", "\t"), {}))


def _style() -> F.Column:
    return F.ascii(F.substring("file_name", 5, 1)) % len(_STYLES)


def _write_files(lines: DataFrame, folder: str, styles: int = 1) -> None:
    """Submissions as the files they come in, header first."""
    for i, ((suffix, encoding, before, after), options) in enumerate(_STYLES[:styles]):
        own = lines.filter(_style() == i) if styles > 1 else lines
        heads = own.select("file_name", F.lit(-1).cast("long").alias("pos"),
                           F.concat(F.lit(before), "header", F.lit(after)).alias("value")).distinct()
        data = own.select("file_name", F.monotonically_increasing_id().alias("pos"), F.concat(
            "value", F.lit("é" if encoding else "")).alias("value"))
        sinks.write_named_files(heads.union(data), f"{folder}{i if styles > 1 else ''}", suffix, encoding, **options)


@query
def submission_files(t):
    """Files as members send them (plain, gzip with empty names in the header, BOM and CRLF, Latin-1), read and scrubbed."""
    place = _place(t, "sent")
    _write_files(t["submission_lines"], place, len(_STYLES))
    parts = [submissions.read_submissions(t.spark, f"{place}{i}", encoding)
             for i, ((_, encoding, _, _), _) in enumerate(_STYLES)]
    lines = functools.reduce(DataFrame.union, [p.lines for p in parts])
    heads = functools.reduce(DataFrame.union, [p.heads for p in parts])
    done = submissions.scrub_lines(submissions.Submissions(lines, heads), "2024-01-01", MAX_OCN)
    counted = lines.groupBy("file_name").agg(
        F.count("*").alias("data_lines"), F.count_if(F.col("value").endswith("é")).alias("accented"),
        F.min("value").alias("first"), F.max("value").alias("last"))
    held = done.valid.groupBy("file_name").agg(F.count("*").alias("holdings"), F.sum("ocn").alias("ocn_sum"))
    refused = done.rejected.groupBy("file_name").agg(F.count("*").alias("refused"))
    return counted.join(held, "file_name", "left").join(refused, "file_name", "left")


@query
def submission_stream(t):
    """Deliveries of three months arrive on a stream, five files at a time, and are gated: what became of each file,
    and what the store has of its slice."""
    place = _place(t, "arriving")
    arriving = t["arriving_lines"]
    for day in ("01", "02", "03"):
        _write_files(arriving.filter(F.col("day") == day), f"{place}/in")
    ingest.scrub_and_replace(
        ingest.submission_stream(t.spark, f"{place}/in", 5), f"{place}/store", f"{place}/ledger", f"{place}/staging",
        f"{place}/checkpoint", "2024-04-01", MAX_OCN, load.Limits(0.4, 0.4)).awaitTermination()
    outcomes = load.settled(t.spark.read.parquet(f"{place}/staging/batch=*/outcomes"))
    held = t.spark.read.parquet(f"{place}/store").groupBy(*load.SLICE).agg(
        F.count("*").alias("held_lines"), F.sum("ocn").alias("held_ocn_sum"))
    return outcomes.join(held, load.SLICE, "left").select(
        "file_name", "outcome", "ready_lines", "ready_ocns", "held_lines", "held_ocn_sum")


@query
def filled_store_stream(t):
    """Holdings arrive in four batches, every one repeating rows of the store and of the batch before it."""
    place = _place(t, "filled")
    rows = t["holding_rows"]
    part = F.pmod(F.xxhash64("uuid"), F.lit(5))
    sinks.write_store(rows.filter(part == 0), f"{place}/store")
    for i in range(1, 5):
        rows.filter(part.isin(0, i, i - 1)).coalesce(1).write.mode("append").parquet(f"{place}/in")
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/in")
    ingest.insert_new(stream, f"{place}/store", f"{place}/checkpoint").awaitTermination()
    sizes = slices.sizes(slices.Kept.of(t.spark, f"{place}/store").summary())
    return t.spark.read.parquet(f"{place}/store").groupBy(*load.SLICE).agg(
        F.count("*").alias("holdings"), F.count_distinct("uuid").alias("uuids")).join(sizes, load.SLICE)


@query
def scrub_file(t):
    return _scrubbed(t).valid.groupBy(
        "organization", "mono_multi_serial", "local_id", "status", "condition", "n_enum", "issn").agg(
        F.count("*").alias("holdings"), F.sum("ocn").alias("ocn_sum"))


@query
def scrub_rejects(t):
    return _scrubbed(t).rejected.groupBy("file_name", "reason").agg(F.count("*").alias("n_lines"))


@query
def scrub_stats(t):
    return _scrubbed(t).stats


@query
def file_name_checks(t):
    names = t["submission_lines"].select(F.regexp_replace("file_name", "_full_20240101", F.lit(
        "_all_2024")).alias("bad"), "file_name")
    both = names.select("file_name").union(names.select("bad")).distinct()
    return submissions.diagnose_file_names(both).select(
        "file_name", "valid", "member_id", "item_type", "member_id_check", "rest_check",
        (F.col("update_type_check") == "ok").alias("update_ok"), (F.col("date_check") == "ok").alias("date_ok"))


def _marc(t: Tables) -> DataFrame:
    return marcxml.convert(marcxml.marc_texts(t["marc_xml"]))


@query
def alma_convert(t):
    converted = _marc(t)
    cells = ("oclc", "local_id", "status", "condition", "enum_chron", "issn", "govdoc")
    return converted.select("o_orderkey", F.when(F.col("error").isNull(), F.col("item_type")).alias("item_type"),
                            *[F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in cells], "error")


@query
def alma_errors(t):
    return marcxml.error_counts(_marc(t))


# --- trends ------------------------------------------------------------------

def _sheets(t: Tables) -> DataFrame:
    """Totals per member and report; a few members are absent from some reports."""
    return t["cost_totals"].filter("NOT (member_id IN ('NATION_1', 'NATION_6') AND report < '1998')").select(
        F.col("member_id").alias("key"), "report", F.col("total").cast("string").alias("value"))


@query
def cost_history(t):
    return trends.append_sheets(_sheets(t), trends.report_names(_sheets(t)))


@query
def cost_history_diff(t):
    return trends.differences(_sheets(t), trends.report_names(_sheets(t)))


@query
def cost_history_pct(t):
    diffs = trends.percent_differences(_sheets(t), trends.report_names(_sheets(t)))
    number = F.regexp_replace("value", "%$", "").try_cast("double")
    return diffs.select("key", "report", F.round(number, 6).alias("percent"),
                        F.when(~F.col("value").endswith("%"), F.col("value")).alias("text"))


def _rounded(sheet: DataFrame) -> DataFrame:
    """Percents as numbers of six digits, for comparison."""
    return sheet.withColumns({c: F.round(F.regexp_replace(c, "%$", "").try_cast("double"), 6)
                              for c in sheet.columns if c.startswith("percent_")})


@query
def cost_highlights(t):
    names = trends.report_names(_sheets(t))
    return _rounded(trends.cost_history(_sheets(t), names, t.organizations, CENTRAL)["highlights"])


@query
def cost_baseline(t):
    return _rounded(trends.baseline_change(_sheets(t), "1996", "2001", t.organizations, CENTRAL))


# --- written by a sink, read by a source ---------------------------------------

def _place(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{uuid.uuid4().hex}/{name}"


_HELD = ("uuid", "ocn", "organization", "status", "condition", "mono_multi_serial", "gov_doc_flag", "n_enum")


@query
def legacy_holdings_file(t):
    place = _place(t, "old.tsv")
    old = F.expr("CASE mono_multi_serial WHEN 'spm' THEN 'mono' WHEN 'mpm' THEN 'multi' WHEN 'ser' THEN 'serial' "
                 "WHEN 'mix' THEN '' ELSE mono_multi_serial END")
    cells = {"mono_multi_serial": old, "gov_doc": F.col("gov_doc_flag").cast("int"), "n_enum": F.lit("stale")}
    blank = F.lit("")
    given = t["holding_rows"].columns
    sinks.write_text(t["holding_rows"].select(F.concat_ws("\t", *[F.coalesce(
        cells.get(c, F.col(c) if c in given else blank).cast("string"), blank)
        for c in files.LEGACY_COLUMNS]).alias("value")), place)
    return files.read_holdings(t.spark, place).select(*_HELD)


@query
def json_holdings_file(t):
    place = _place(t, "new.ndj")
    sinks.write_scrubbed(t["holding_rows"], place)
    return files.read_holdings(t.spark, place).select(*_HELD)


@query
def concordance_files(t):
    """A delta by date: adds and deletes written as pairs, read back and applied."""
    place = _place(t, "delta")
    adds, deletes = concordance.delta(t.concordance, t["new_concordance"])
    sinks.write_pairs(adds, f"{place}/comm_diff_2024-02-03.txt.adds")
    sinks.write_pairs(deletes, f"{place}/comm_diff_2024-02-03.txt.deletes")
    return concordance.load(t.concordance, "20240203", lambda p: files.read_concordance(t.spark, p), place)


@query
def ocn_list_file(t):
    place = _place(t, "list.txt")
    lines = t["orders"].select(F.when(F.col("o_orderkey") % 5 == 0, "no number").otherwise(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" x"))).alias("value"))
    sinks.write_text(lines, place)
    return files.read_ocn_list(t.spark, place).withColumn(
        "non_numeric", F.lit(files.count_non_numeric(t.spark, place).first()[0]))


@query
def catalog_file(t):
    from shelfcount.sources import catalog

    place = _place(t, "records.ndj")
    one = F.to_json(F.struct(F.col("item_id").alias("htid"), F.array("rights").alias("rights"),
                             F.col("enum_chron").alias("enumcron"), F.lower("collection_code").alias("collection_code")))
    record = F.struct(F.col("bib_key").cast("string").alias("id"), F.array(F.lit("Serial")).alias("format"),
                      F.array(F.col("bib_key").cast("string")).alias("oclc"),
                      F.concat(F.lit("["), F.array_join(F.collect_list(one), ","), F.lit("]")).alias("ht_json"))
    sinks.write_text(t["item_rows"].groupBy("bib_key").agg(F.to_json(record).alias("value")).select("value"), place)
    loaded = catalog.load(catalog.parse_records(catalog.read_records(t.spark, place)))
    return loaded.items.select("item_id", "bib_key", "rights", "bib_fmt", "collection_code", "n_enum",
                               F.get("ocns", F.lit(0)).alias("ocn"))


@query
def marc_files(t):
    """Records as XML files of up to a thousand, converted to files for monographs and for serials, read back."""
    place = _place(t, "marc")
    root = F.concat(F.lit("<collection>"), F.array_join(F.collect_list("xml"), ""), F.lit("</collection>"))
    (t["marc_xml"].groupBy(F.floor(F.col("o_orderkey") / 1000).alias("file")).agg(root.alias("value"))
     .write.partitionBy("file").text(f"{place}/in.xml"))
    load.convert_marc(t.spark, f"{place}/in.xml", f"{place}/out")
    parts = [files.read_keyed(t.spark, f"{place}/out/{kind}", tables_schema(*marc_columns)).select(
        F.lit(kind).alias("kind"), "oclc", "local_id", "govdoc")
        for kind, marc_columns in (("mon", marc.MON_COLUMNS), ("ser", marc.SER_COLUMNS))]
    return parts[0].union(parts[1])


def tables_schema(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


@query
def report_files(t):
    """A report by organisation: tab separated, with header, a folder each."""
    place = _place(t, "report")
    sinks.write_tsv(t["holding_rows"].select("organization", "ocn", "local_id", "enum_chron"), place, by="organization")
    back = t.spark.read.csv(place, sep="\t", header=True, schema="ocn long, local_id string, enum_chron string, "
                                                                 "organization string")
    return back.groupBy("organization").agg(F.count("*").alias("lines"), F.sum("ocn").alias("ocn_sum"),
                                            F.count_if(F.coalesce("enum_chron", F.lit("")) != "").alias("with_enum"))


@query
def backup_file(t):
    place = _place(t, "backup")
    sinks.write_backup(t["holding_rows"], "NATION_3", ["ser", "mon"], place)
    return files.holdings_from_json(t.spark, place).select(*_HELD)


@query
def split_files(t):
    """Sorted by OCN and split: parts do not overlap but in a shared OCN, and are sorted within."""
    place = _place(t, "split")
    sinks.write_split(t["holding_rows"].select("uuid", "ocn"), place, 8)
    lines = t.spark.read.schema("uuid string, ocn long").json(place).select(
        "uuid", "ocn", F.col("_metadata.file_name").alias("part"), F.monotonically_increasing_id().alias("line"))
    in_part = Window.partitionBy("part").orderBy("line")
    steps = lines.withColumn("back", F.col("ocn") < F.lag("ocn").over(in_part))
    ranges = steps.groupBy("part").agg(F.min("ocn").alias("low"), F.max("ocn").alias("high"), F.count("*").alias("n"),
                                       F.count_if("back").alias("unsorted"))
    return ranges.withColumn("before", F.max("high").over(Window.orderBy("low", "high").rowsBetween(  # eight rows
        Window.unboundedPreceding, -1))).agg(
        F.sum("n").alias("lines"), F.sum("unsorted").alias("unsorted"), F.count_if(F.col("before") > F.col("low"))
        .alias("overlapping"))


@query
def histogram_files(t):
    place = _place(t, "histograms")
    sinks.write_histograms(_frequencies(t), place)
    return t.spark.read.schema("bucket long, frequency long, organization string, format string").csv(place, sep="\t")


@query
def frequency_files(t):
    """Frequency tables of two folders of files, added up, and looked up for one organisation."""
    place = _place(t, "tables")
    table = _frequencies(t)
    sinks.write_frequency_json(frequency.as_json(table), f"{place}/a.json")
    read = files.read_frequency_json(t.spark, file=f"{place}/a.json")
    return frequency.lookup(frequency.merge(read, read), "NATION_4", "mpm")


@query
def store_files(t):
    """The store as partitions; one slice is replaced, the others stay."""
    place = _place(t, "store")
    sinks.write_store(t["holding_rows"], place)
    sinks.write_store(t["holding_rows"].filter("organization = 'NATION_3' AND mono_multi_serial = 'ser' AND ocn % 2 = 0"),
                      place)
    return tables.holdings_of(t.spark.read.parquet(place), "NATION_3").groupBy("organization", "mono_multi_serial").agg(
        F.count("*").alias("holdings"), F.sum("ocn").alias("ocn_sum"))


@query
def what_if_organizations(t):
    """Organisations with a temporary one and a replaced one, and those that break the rules."""
    extra = t.organizations.filter("inst_id IN ('NATION_1', 'NATION_2')").select(
        F.when(F.col("inst_id") == "NATION_1", "NATION_1").otherwise("planned").alias("inst_id"),
        "country_code", (F.col("weight") + 10).alias("weight"), "status", "mapto_inst_id")
    every = dimensions.add_temporary(t.organizations, extra)
    wrong = dimensions.invalid_organizations(every).select("inst_id", "reason")
    return every.select("inst_id", "weight").join(wrong, "inst_id", "left")


@query
def item_table_rows(t):
    """Rows of the flat item table to items."""
    rows = t["item_rows"].select(
        F.col("item_id").alias("htid"), F.when(F.col("bib_key") % 7 == 0, "none").otherwise(
            F.col("bib_key").cast("string")).alias("bib_num"), F.col("rights").alias("rights_code"),
        (F.col("bib_key") % 2 == 0).alias("access"), "bib_fmt", F.col("enum_chron").alias("description"), "collection_code",
        F.expr("CASE bib_key % 4 WHEN 0 THEN '' WHEN 1 THEN '' || k WHEN 2 THEN k || ',' || (k + 1) || 'x' ELSE 'x' END")
        .alias("oclc"))
    return tables.items_from_rows(rows).select("item_id", "bib_key", "rights", "access", "bib_fmt", "n_enum", F.array_join(
        F.col("ocns").cast("array<string>"), ",").alias("ocns"))


@query
def headed_holdings_files(t):
    """Files in the old layout, by type, some with a header."""
    place = _place(t, "headed.tsv")
    cells = {"gov_doc": F.col("gov_doc_flag").cast("int")}
    given, blank = t["holding_rows"].columns, F.lit("")
    value = F.concat_ws("\t", *[F.coalesce(cells.get(c, F.col(c) if c in given else blank).cast("string"), blank)
                                for c in files.LEGACY_COLUMNS])
    name = F.concat(F.lit("old_"), F.col("mono_multi_serial"), F.lit(".tsv"))
    data = t["holding_rows"].select(name.alias("file_name"), F.monotonically_increasing_id().alias("pos"), value.alias("value"))
    heads = data.select("file_name").distinct().filter("file_name != 'old_mix.tsv'").select(
        "file_name", F.lit(-1).cast("long").alias("pos"), F.lit("OCN\tBIB").alias("value"))
    sinks.write_named_files(heads.union(data), place)
    return files.read_holdings(t.spark, place).select("uuid", "ocn", "organization", "mono_multi_serial", "date_received")


@query
def loaded_types(t):
    return counts.loaded_types(t["holding_rows"])


@query
def first_lines(t):
    """The first ten lines of a file."""
    place = _place(t, "numbers.txt")
    t["orders"].orderBy("o_orderkey").select(F.col("o_orderkey").cast("string").alias("value")).coalesce(1).write.text(place)
    return counts.first_lines(t.spark.read.text(place), 10)


@query
def newest_file(t):
    listed = t["loaded_files"].select(F.concat_ws(
        "_", F.lower("source"), F.when(F.col("type") == "holding", "mon").otherwise("ser"),
        F.date_format("produced", "yyyyMMdd"), F.concat("filename", F.lit(".ndj"))).alias("name"))
    return files.newest_file(listed.withColumn("name", F.regexp_replace("name", "^nation_", "nation")), "nation4", "mon")


@query
def concordance_reload(t):
    """The table after a full file was loaded."""
    place = _place(t, "full.txt")
    sinks.write_pairs(t["new_concordance"].union(t["new_concordance"]), place)
    return concordance.load(t.concordance, place, lambda p: files.read_concordance(t.spark, p), "")


@query
def malformed_lines(t):
    lines = t["orders"].select(F.concat(F.col("o_orderkey").cast("string"), F.when(
        F.col("o_orderkey") % 5 == 0, " ").when(F.col("o_orderkey") % 7 == 0, "\t\t").otherwise("\t"),
        F.col("o_custkey").cast("string"), F.when(F.col("o_custkey") % 11 == 0, "x").otherwise("")).alias("value"))
    return concordance.malformed_lines(lines)


@query
def concordance_adjacency(t):
    return concordance.adjacency(t["raw_concordance"]).select(
        "variant", F.array_join(F.col("canonicals").cast("array<string>"), ",").alias("canonicals"))


@query
def uuid_lines(t):
    """Every line with a uuid of its own, written once."""
    place = _place(t, "uuids")
    changes.with_uuid(t["submission_lines"].select("file_name", "value")).write.json(place)
    back = t.spark.read.schema("file_name string, value string, uuid string").json(place)
    return back.groupBy("file_name").agg(F.count("*").alias("lines"), F.count_distinct("uuid").alias("uuids"),
                                         F.count_if(F.col("uuid").rlike(changes.UUID)).alias("well_formed"))


@query
def delete_listed_rows(t):
    listed = t["ocn_list"].select("ocn", (F.concat(F.lit("NATION_"), F.col("ocn") % 25)).alias("organization"))
    return changes.delete_rows(t["holding_rows"], listed, ["ocn", "organization"]).groupBy("organization").agg(
        F.count("*").alias("holdings"), F.sum("ocn").alias("ocn_sum"))


@query
def holding_dates(t):
    """Dates in the forms that files have them in, and none."""
    text = F.expr("CASE l_linenumber % 4 WHEN 0 THEN date_format(l_shipdate, 'yyyy-MM-dd') WHEN 1 THEN "
                  "date_format(l_shipdate, 'yyyyMMdd') WHEN 2 THEN date_format(l_shipdate, 'yyyy-MM-dd 12:34:56') ELSE 'soon' END")
    return t["lineitem"].select("l_orderkey", "l_linenumber", files.parse_date(text).alias("received"))


@query
def header_checks(t):
    """Headers of every kind of file, each with columns that some kinds may not have."""
    named = t["lineitem"].select(F.expr(
        "'org-' || substr('abcdefghijklmnopqrstuvwxy', CAST(l_suppkey % 25 AS INT) + 1, 1) || '_' || "
        "element_at(array('mix', 'mon', 'spm', 'mpm', 'ser'), l_linenumber % 5 + 1) || '_full_20240101.tsv'").alias("file_name"),
        F.expr("CASE l_suppkey % 5 WHEN 0 THEN 'OCLC\tLocal_ID' WHEN 1 THEN 'local_id\tSTATUS\toclc' "
               "WHEN 2 THEN 'oclc\tlocal _id\tenum_chron' WHEN 3 THEN 'oclc\tissn\tlocal_id' ELSE 'local_id\tgovdoc' END")
        .alias("header")).distinct()
    return submissions.analyse_headers(named).select(
        "file_name", "organization", "mono_multi_serial", "expected", F.array_join("missing", ",").alias("missing"), "fault",
        "at_oclc", "at_local_id")


@query
def cost_from_tables(t):
    """The cost report from frequency tables in files and given counts."""
    place = _place(t, "given")
    sinks.write_frequency_json(frequency.as_json(_frequencies(t)), f"{place}/a.json")
    table = frequency.merge(files.read_frequency_json(t.spark, file=f"{place}/a.json"))
    report = cost.from_frequencies(table, counts.item_counts(t.items), t.organizations, TARGET_COST, CENTRAL).by_member
    return report.select("member_id", "weight", *[
        F.round(c, 6).alias(c) for c in ("spm", "mpm", "ser", "pd", "extra", "total")])


# --- generated and streamed --------------------------------------------------

@query
def synthetic_holdings(t):
    ids = t["orders"].select(F.col("o_orderkey").alias("id"))
    return synthetic.holdings(ids, "org-a", 100_000, "2020-01-01")


@query
def synthetic_concordance(t):
    ids = t["lineitem"].select(F.col("l_partkey").alias("id")).distinct()
    return synthetic.concordance(ids, 1_000_000)


def holdings_stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Every lineitem arrives twice on a stream; the store keeps each uuid once."""
    work = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{folder}/lineitem.parquet").schema
    source = spark.readStream.schema(schema).option(
        "pathGlobFilter", "{lineitem,part-*}.parquet").parquet(
        folder if ingest.is_file(spark, f"{folder}/lineitem.parquet") else f"{folder}/lineitem.parquet")
    t = Tables(spark, folder)
    t._built["lineitem"] = source
    twice = t["holding_rows"].withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    run = ingest.insert_new(twice, f"{work}/store", f"{work}/checkpoint")
    run.awaitTermination()
    return spark.read.parquet(f"{work}/store").groupBy("organization", "mono_multi_serial").agg(
        F.count("*").alias("holdings"), F.count_distinct("uuid").alias("uuids"))


QUERIES["holdings_stream_ingest"] = holdings_stream_ingest
