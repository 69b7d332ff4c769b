"""The overlap table: one row per item and organisation that holds or deposited it.

Rules, per cluster format:

* ``spm`` and ``ser/spm``: every holding of the organisation in the cluster counts;
* ``ser``: the same, but copy and current counts are cut to 1 and the state
  counts to 0 (holdings still tell whether current copies are brittle);
* ``mpm``: a holding counts for an item if its enumeration is equal or blank,
  or if none of the organisation's enumerations equals any item's.

The billing entity of an item gets a row with one copy where nothing counts.

The mpm rule is an OR. It is never run as one: holdings are first counted per
OCN and organisation, and the three cases become equi joins on those counts.
Nothing is joined holding by holding, so neither a much-held OCN nor a record
with very many volumes multiplies rows beyond the result itself; and the items
of a very large cluster are joined under several salted keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcount.functions.rights import gives_access, is_brittle, is_current
from shelfcount.operators.formats import with_formats
from shelfcount.schemas import COUNTERS, MAX_STORED_OCN
from shelfcount.session import checked_broadcast, materialize

MPM = "mpm"
CLUSTER_FACTS = ("cluster_format", "cluster_blank", "cluster_items")
# Items of one cluster that a single join key may carry.
ITEMS_PER_KEY = 10_000
ITEM_COLUMNS = ("cluster_id", "item_id", "bib_key", "bib_fmt", "rights", "n_enum",
                "billing_entity", "home")
# What an overlap row repeats of its item.
FACTS = ("item_id", "cluster_id", "cluster_format", "item_format", "n_enum", "rights")
REPORT_COUNTS = {"n": "copy_count", "cur": "current_holding_count", "brt": "brt_count",
                 "wd": "wd_count", "lm": "lm_count", "access": "access_count"}


def state_counts() -> dict[str, Column]:
    """The counters of a group of holdings."""
    current, brittle = is_current(), is_brittle()
    tests = {
        "cur": current,
        "brt": brittle,
        "wd": F.col("status").eqNullSafe("WD"),
        "lm": F.col("status").eqNullSafe("LM"),
        "access": gives_access(),
        "cur_brt": current & brittle,
        "cur_ok": current & ~brittle,
    }
    return {"n": F.count("*"), **{name: F.count_if(test) for name, test in tests.items()}}


def sums(prefix: str = "") -> list[Column]:
    return [F.sum(prefix + c).alias(prefix + c) for c in COUNTERS]


def count_by_enum(holdings: DataFrame) -> DataFrame:
    """(ocn, organization, n_enum, counters): the only pass over single holdings.

    Numbers beyond the stored integer range never match, so they are not counted.
    """
    counts = [c.alias(name) for name, c in state_counts().items()]
    return (holdings.filter(F.col("organization").isNotNull() & (F.col("ocn") <= MAX_STORED_OCN))
            .groupBy("ocn", "organization", F.coalesce("n_enum", F.lit("")).alias("n_enum"))
            .agg(*counts))


def count_by_org(by_enum: DataFrame) -> DataFrame:
    """(ocn, organization, counters, blank counters): blank ones have no enumeration."""
    blank = F.col("n_enum") == ""
    blanks = [F.sum(F.when(blank, F.col(c)).otherwise(0)).alias(f"blank_{c}") for c in COUNTERS]
    return by_enum.groupBy("ocn", "organization").agg(*sums(), *blanks)


def cluster_org_counts(cluster_ocns: DataFrame, by_org: DataFrame) -> DataFrame:
    """(cluster_id, organization, counters, blank counters)."""
    return (cluster_ocns.join(by_org, "ocn").groupBy("cluster_id", "organization")
            .agg(*sums(), *sums("blank_")))


@dataclass
class Parts:
    """What overlap and the overlap report are both made from.

    ``items`` carry their formats; ``by_enum`` are holdings counted per OCN,
    organisation and enumeration. These and the matches are written once,
    since later steps read them several times.
    """

    items: DataFrame
    cluster_ocns: DataFrame
    by_enum: DataFrame

    @property
    def formats(self) -> DataFrame:
        return self.items.select("cluster_id", *CLUSTER_FACTS).distinct()

    @property
    def home(self) -> DataFrame:
        items = self.items
        return items.filter("home") if "home" in items.columns else items

    @cached_property
    def matches(self) -> DataFrame:
        """(cluster_id, organization, n_enum, counters) where an enumeration of an mpm item is held.

        Joined on (ocn, n_enum), so a hot OCN is spread by enumeration and only
        pairs that match are ever formed.
        """
        volumes = self.items.filter(F.col("cluster_format") == MPM)
        return materialize(enum_matches(volumes, self.cluster_ocns, self.by_enum), "matches")


def near(holdings: DataFrame, cluster_ocns: DataFrame) -> DataFrame:
    """Holdings on the OCNs of the clusters: a few clusters need not count the whole store."""
    return holdings.join(cluster_ocns.select("ocn").distinct(), "ocn", "left_semi")


def prepare(items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame, narrowed: bool = False) -> Parts:
    """``narrowed`` says that the clusters are not all there are, so most holdings are on none of them."""
    if narrowed:
        cluster_ocns = materialize(cluster_ocns, "near_ocns")
        holdings = near(holdings, cluster_ocns)
    slim = items.select(*[c for c in ITEM_COLUMNS if c in items.columns]).withColumn(
        "n_enum", F.coalesce("n_enum", F.lit("")))
    return Parts(materialize(with_formats(slim), "items"), cluster_ocns,
                 materialize(count_by_enum(holdings), "by_enum"))


def enum_matches(items: DataFrame, cluster_ocns: DataFrame, by_enum: DataFrame) -> DataFrame:
    """(cluster_id, organization, n_enum, cluster_items, counters) of holdings equal to an
    item's enumeration."""
    enums = items.filter(F.col("n_enum") != "").select("cluster_id", "n_enum", "cluster_items").distinct()
    asked = enums.join(cluster_ocns, "cluster_id")
    return (asked.join(by_enum.filter(F.col("n_enum") != ""), ["ocn", "n_enum"])
            .groupBy("cluster_id", "organization", "n_enum", "cluster_items").agg(*sums()))


def _keys() -> Column:
    return F.ceil(F.col("cluster_items") / ITEMS_PER_KEY)


def salted(items: DataFrame) -> DataFrame:
    """Items with a salt: those of a very large cluster fall under several keys."""
    return items.withColumn("salt", F.pmod(F.xxhash64("item_id"), _keys()))


def per_salt(rows: DataFrame) -> DataFrame:
    """Rows of a cluster once per salt of its items; nearly always that is once."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), _keys() - 1)))


def with_match_flag(parts: Parts, matches: DataFrame) -> DataFrame:
    """Counts per cluster and organisation, the cluster's format, and has_match.

    Matches only bring a flag into the same aggregation, which saves a join. A
    blank enumeration matches a blank one.
    """
    none = [F.lit(0).cast("bigint").alias(c)
            for c in (*COUNTERS, *(f"blank_{c}" for c in COUNTERS))]
    held = parts.cluster_ocns.join(count_by_org(parts.by_enum), "ocn").drop("ocn")
    hits = matches.select("cluster_id", "organization", *none, F.lit(True).alias("hit"))
    merged = (held.withColumn("hit", F.lit(False)).unionByName(hits)
              .groupBy("cluster_id", "organization")
              .agg(*sums(), *sums("blank_"), F.max("hit").alias("hit")))
    blank_match = F.col("cluster_blank") & (F.col("blank_n") > 0)
    return (merged.join(parts.formats, "cluster_id")
            .withColumn("has_match", F.col("hit") | blank_match).drop("hit", "cluster_blank"))


def unmatched_organizations(parts: Parts) -> DataFrame:
    """(cluster_id, organization) with holdings, none of them equal to an item's enumeration."""
    matches = enum_matches(parts.items, parts.cluster_ocns, parts.by_enum)
    return with_match_flag(parts, matches).filter(~F.col("has_match")).select(
        "cluster_id", "organization")


def overlap(items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame, narrowed: bool = False) -> DataFrame:
    """Overlap rows with matching counters.

    ``items``: cluster_id, item_id, bib_key, bib_fmt, rights, n_enum,
    billing_entity and optionally ``home`` (rows of other clusters that only
    shape formats and enumerations). ``cluster_ocns``: distinct (cluster_id, ocn).
    """
    return overlap_of(prepare(items, cluster_ocns, holdings, narrowed))


def overlap_of(parts: Parts) -> DataFrame:
    home = salted(parts.home).select(*FACTS, "billing_entity", "salt")
    matches = parts.matches
    general = per_salt(_general_counts(with_match_flag(parts, matches)).filter("n > 0"))
    columns = (*FACTS, "organization", *COUNTERS)
    by_cluster = home.join(general, ["cluster_id", "salt"]).select(
        *columns, F.lit(False).alias("depositor"))
    by_volume = (home.filter("n_enum != ''").join(per_salt(matches), ["cluster_id", "n_enum", "salt"])
                 .select(*columns, F.lit(False).alias("depositor")))
    deposited = home.filter("billing_entity is not null").select(
        *FACTS, F.col("billing_entity").alias("organization"),
        *[F.lit(0).cast("bigint").alias(c) for c in COUNTERS], F.lit(True).alias("depositor"))
    # Placed by item at once: summing here and counting members later share it.
    # An item has at most one row per organisation, so no partition is hot.
    per_item = (by_cluster.union(by_volume).union(deposited).repartition("item_id")
                .groupBy(*FACTS, "organization")
                .agg(*sums(), F.max("depositor").alias("depositor")))
    return _as_report(per_item)


def _general_counts(counted: DataFrame) -> DataFrame:
    """What counts for every item of the cluster alike.

    Outside mpm these are all holdings of the organisation. In mpm clusters
    these are its blank holdings, or all of them if it has no match at all.
    """
    blanks_only = (F.col("cluster_format") == MPM) & F.col("has_match")
    return counted.select(
        "cluster_id", "organization", "cluster_items",
        *[F.when(blanks_only, F.col(f"blank_{c}")).otherwise(F.col(c)).alias(c) for c in COUNTERS])


def _as_report(rows: DataFrame) -> DataFrame:
    """Matching counters to the reported ones."""
    serial = F.col("cluster_format") == "ser"
    matching = F.when(serial, F.least(F.col("n"), F.lit(1))).otherwise(F.col("n"))
    deposited_only = (matching == 0) & F.col("depositor")

    def state(c: str) -> Column:
        return F.when(serial, F.lit(0)).otherwise(F.col(c)).cast("bigint")

    return rows.select(
        *FACTS, "organization",
        F.when(deposited_only, F.lit(1)).otherwise(matching).cast("bigint").alias("copy_count"),
        state("brt").alias("brt_count"),
        state("wd").alias("wd_count"),
        state("lm").alias("lm_count"),
        state("access").alias("access_count"),
        F.when(serial, matching).otherwise(F.col("cur")).cast("bigint").alias("current_holding_count"),
        deposited_only.alias("deposited_only"),
        matching.cast("bigint").alias("matching_count"),
        F.col("cur_brt").alias("current_brittle"),
        F.col("cur_ok").alias("current_not_brittle"),
    )


def any_current_brittle() -> Column:
    return F.col("current_brittle") > 0


def all_current_brittle() -> Column:
    """True also where nothing is current."""
    return F.col("current_not_brittle") == 0


def record(overlap_rows: DataFrame) -> DataFrame:
    """The ten reported fields."""
    return overlap_rows.select(
        F.col("item_id").alias("volume_id"), "n_enum", F.col("organization").alias("member_id"),
        "copy_count", "brt_count", "wd_count", "lm_count", "access_count",
        "current_holding_count", "deposited_only")


def organizations_in_clusters(items: DataFrame, cluster_ocns: DataFrame,
                              holdings: DataFrame) -> DataFrame:
    """(cluster_id, organization): holders and billing entities."""
    per_ocn = holdings.select("ocn", "organization").distinct()
    holders = cluster_ocns.join(per_ocn, "ocn").select("cluster_id", "organization")
    billed = items.select("cluster_id", F.col("billing_entity").alias("organization"))
    return holders.union(billed).filter("organization is not null").distinct()


def cluster_enums(items: DataFrame, cluster_ocns: DataFrame, holdings: DataFrame) -> DataFrame:
    """(cluster_id, side, organization, n_enum) in long form: items have no organisation."""
    held = holdings.select("ocn", "organization", "n_enum").distinct()
    of_holdings = cluster_ocns.join(held, "ocn").select(
        "cluster_id", F.lit("holding").alias("side"), "organization", "n_enum").distinct()
    of_items = items.select("cluster_id", F.lit("item").alias("side"),
                            F.lit(None).cast("string").alias("organization"), "n_enum").distinct()
    return of_holdings.union(of_items)


def with_member_counts(overlap_rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """Overlap rows with member (bool) and n_members of the item.

    The window sees one row per organisation, and keeps the rows where they are.
    """
    ids = organizations.filter("status").select(F.col("inst_id").alias("organization"),
                                                F.lit(True).alias("member"))
    marked = (overlap_rows.join(checked_broadcast(ids), "organization", "left")
              .withColumn("member", F.coalesce("member", F.lit(False))))
    return marked.withColumn("n_members",
                             F.count_if("member").over(Window.partitionBy("item_id")))


def matching_members(overlap_rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """Overlap rows of members, with n_members."""
    return with_member_counts(overlap_rows, organizations).filter("member")


def member_counts(overlap_rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """(item_id, n_members) of items held by anyone."""
    ids = organizations.filter("status").select(F.col("inst_id").alias("organization"),
                                                F.lit(1).alias("member"))
    return (overlap_rows.select("item_id", "organization")
            .join(checked_broadcast(ids), "organization", "left")
            .groupBy("item_id").agg(F.count("member").alias("n_members")))


def h_shares(overlap_rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """(item_id, organization, h_share): 1/n_members for members, 0 for others."""
    share = F.when(F.col("member"), 1.0 / F.col("n_members")).otherwise(0.0)
    return (with_member_counts(overlap_rows, organizations)
            .select("item_id", "organization", share.alias("h_share")))
