"""Clusters of equivalent OCNs.

Two kinds exist and give different answers, so they are never mixed:

* record clusters, one per catalogue record, for reports;
* OCN clusters, grown from an item's own OCNs, for lookups: concordance, then
  OCNs of items sharing any of these, then concordance again, and stop.

Every step of the OCN kind distributes over set union. A seed is therefore
first reduced to *units* (a canonical OCN that it touches, or a plain OCN
without concordance entry). Units are expanded once each, however many seeds
share them, and seeds with the same units share one cluster. A canonical OCN
with very many variants is expanded once instead of once per variant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.operators.concordance import components
from shelfcount.session import materialize


def canonicals_touched(keys: DataFrame, concordance: DataFrame) -> DataFrame:
    """(key, ocn) to distinct (key, ocn, canonical), the OCN being either side of an entry."""
    touched = (concordance.select(F.col("variant").alias("ocn"), "canonical")
               .union(concordance.select(F.col("canonical").alias("ocn"), "canonical")).distinct())
    return keys.join(touched, "ocn").select("key", "ocn", "canonical").distinct()


def _groups(concordance: DataFrame) -> DataFrame:
    """(canonical, ocn): all members of a canonical's group, itself included."""
    return (concordance.select("canonical", F.col("variant").alias("ocn"))
            .union(concordance.select("canonical", F.col("canonical").alias("ocn"))).distinct())


def concordance_expand(keys: DataFrame, concordance: DataFrame) -> DataFrame:
    """(key, ocn) plus every OCN sharing a canonical with one of the key's OCNs."""
    touched = canonicals_touched(keys, concordance).select("key", "canonical").distinct()
    added = touched.join(_groups(concordance), "canonical").select("key", "ocn")
    return keys.select("key", "ocn").union(added).distinct()


def related_ocns(keys: DataFrame, bridge: DataFrame) -> DataFrame:
    """(key, ocn) plus every OCN on an item that carries one of the key's OCNs."""
    items = keys.join(bridge, "ocn").select("key", "item_id").distinct()
    added = items.join(bridge, "item_id").select("key", "ocn")
    return keys.select("key", "ocn").union(added).distinct()


def expand_ocns(keys: DataFrame, bridge: DataFrame, concordance: DataFrame) -> DataFrame:
    """(key, ocn) to the OCNs of the cluster of each key: exactly three steps."""
    first = materialize(concordance_expand(keys, concordance), "hop")
    return concordance_expand(materialize(related_ocns(first, bridge), "hop"), concordance)


def seed_units(seeds: DataFrame, concordance: DataFrame) -> DataFrame:
    """(seed, ocn) to distinct (seed, unit); a unit is named by kind and OCN."""
    keys = seeds.select(F.col("seed").alias("key"), "ocn")
    touched = canonicals_touched(keys, concordance)
    by_group = touched.select(F.col("key").alias("seed"),
                              F.struct(F.lit("c").alias("kind"),
                                       F.col("canonical").alias("ocn")).alias("unit"))
    alone = (keys.join(touched.select("ocn").distinct(), "ocn", "left_anti")
             .select(F.col("key").alias("seed"),
                     F.struct(F.lit("o").alias("kind"), F.col("ocn")).alias("unit")))
    return by_group.union(alone).distinct()


def _unit_ocns(units: DataFrame, concordance: DataFrame) -> DataFrame:
    """First step for units: the group of a canonical, or the OCN alone."""
    grouped = (units.filter("unit.kind = 'c'")
               .join(_groups(concordance).withColumnRenamed("canonical", "c"),
                     F.col("unit.ocn") == F.col("c"))
               .select(F.col("unit").alias("key"), "ocn"))
    alone = units.filter("unit.kind = 'o'").select(F.col("unit").alias("key"),
                                                   F.col("unit.ocn").alias("ocn"))
    return grouped.union(alone)


def _drop_covered(units_of: DataFrame, unit_items: DataFrame) -> DataFrame:
    """Leave out plain units that add nothing next to the seed's most frequent unit.

    If every item with OCN x also carries the top unit t, then whatever x leads
    to is reached from t as well. Items that share one very common OCN thereby
    fall into one cluster instead of one copy of it per item. Only pairs
    (unit, top unit of one of its seeds) are compared, not all pairs.
    """
    sizes = unit_items.groupBy("unit").agg(F.count("*").alias("size"))
    sized = units_of.join(sizes, "unit", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    tops = sized.groupBy("seed").agg(F.max(F.struct("size", "unit")).alias("top"))
    paired = (sized.filter("unit.kind = 'o'").join(tops, "seed")
              .filter((F.col("unit") != F.col("top.unit")) & (F.col("size") > 0))
              .select("seed", "unit", "size", F.col("top.unit").alias("top")))
    pairs = paired.select("unit", "top", "size").distinct()
    both = (pairs.join(unit_items, "unit")
            .join(unit_items.select(F.col("unit").alias("top"), "item_id"), ["top", "item_id"]))
    covered = (both.groupBy("unit", "top", "size").agg(F.count("*").alias("shared"))
               .filter("shared = size").select("unit", "top"))
    dropped = paired.join(covered, ["unit", "top"], "left_semi").select("seed", "unit")
    return units_of.join(dropped, ["seed", "unit"], "left_anti")


def ocn_clusters(seeds: DataFrame, bridge: DataFrame,
                 concordance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clusters of many seeds at once.

    ``seeds`` is (seed, ocn). Returns (seed, cluster_id) and (cluster_id, ocn).
    The cluster id is derived from the units, so equal seeds meet again.
    """
    units_of = materialize(seed_units(seeds, concordance), "units")
    first = materialize(_unit_ocns(units_of.select("unit").distinct(), concordance), "unit_ocns")
    unit_items = materialize(
        first.join(bridge, "ocn").select(F.col("key").alias("unit"), "item_id").distinct(), "unit_items")
    kept = _drop_covered(units_of, unit_items)
    signature = F.array_join(F.transform(
        "units", lambda u: F.concat(u["kind"], u["ocn"].cast("string"))), ",")
    home = materialize(
        kept.groupBy("seed").agg(F.sort_array(F.collect_list("unit")).alias("units"))
        .select("seed", "units", F.concat(F.lit("ocn:"), F.sha2(signature, 256)).alias("cluster_id")),
        "home")
    shared = unit_items.join(bridge, "item_id").select(F.col("unit").alias("key"), "ocn")
    second = materialize(first.union(shared).distinct(), "hop")
    members = home.select("cluster_id", F.explode("units").alias("key")).distinct()
    reach = concordance_expand(second, concordance)
    ocns = materialize(members.join(reach, "key").select("cluster_id", "ocn").distinct(), "cluster_ocns")
    return home.select("seed", "cluster_id"), ocns


def item_clusters(items: DataFrame, concordance: DataFrame,
                  wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Lookup clusters of all items, or of the ``wanted`` ones (item_id) only.

    A cluster starts from the OCNs of its item, so those of a few items are made from what these OCNs touch.
    Returns cluster items and (cluster_id, ocn). Cluster items are the input
    rows with cluster_id and ``home``: an item can sit in several clusters, and
    its own overlap is taken from its home cluster only. Items without OCN
    form one cluster per record and have no holdings.
    """
    bridge = items.select("item_id", F.explode("ocns").alias("ocn")).distinct()
    with_seed = items.withColumn("seed", F.array_join(F.sort_array(F.array_distinct("ocns")), ","))
    own = with_seed if wanted is None else with_seed.join(wanted.select("item_id").distinct(), "item_id", "left_semi")
    seeds = (own.filter("seed != ''").select("seed", F.explode("ocns").alias("ocn")).distinct())
    home, ocns = ocn_clusters(seeds, bridge, concordance)
    in_cluster = ocns.join(bridge, "ocn").select("cluster_id", "item_id").distinct()
    home_of = (own.filter("seed != ''").select("item_id", "seed").join(home, "seed")
               .select("item_id", F.col("cluster_id").alias("home_id")))
    placed = (items.join(in_cluster, "item_id").join(home_of, "item_id", "left")
              .withColumn("home", F.coalesce(F.col("cluster_id") == F.col("home_id"), F.lit(False))).drop("home_id"))
    without = own.filter("seed = ''").select("bib_key").distinct()
    by_record = (items.join(without, "bib_key")
                 .withColumn("cluster_id", F.concat(F.lit("bib:"), F.col("bib_key").cast("string")))
                 .withColumn("home", F.size("ocns") == 0))
    if wanted is not None:
        asked = wanted.select("item_id", F.lit(True).alias("asked")).distinct()
        by_record = (by_record.join(asked, "item_id", "left")
                     .withColumn("home", F.col("home") & F.col("asked").isNotNull()).drop("asked"))
    return placed.unionByName(by_record), ocns


def transitive_clusters(bridge: DataFrame, concordance: DataFrame) -> DataFrame:
    """(ocn, component): OCNs that any path over items and concordance entries connects, named by the least of them.

    Unlike ``ocn_clusters``, which stops after three steps. An item gives a star, from its least OCN to its others, so
    edges are as many as item OCNs, also for a very common OCN; components come in logarithmic rounds.
    """
    least = bridge.groupBy("item_id").agg(F.min("ocn").alias("canonical"))
    stars = bridge.join(least, "item_id").select(F.col("ocn").alias("variant"), "canonical")
    pairs = materialize(stars.union(concordance.select("variant", "canonical")).distinct(), "pairs")
    joined = components(pairs)
    alone = pairs.filter("variant = canonical").select(F.col("variant").alias("ocn")).distinct().join(
        joined.select("ocn"), "ocn", "left_anti")
    return joined.union(alone.select("ocn", F.col("ocn").alias("component")))


def cluster_holdings(cluster_ocns: DataFrame, holdings: DataFrame) -> DataFrame:
    """(cluster_id, holding columns): every holding of a cluster."""
    return cluster_ocns.join(holdings, "ocn")


def cluster_items(cluster_ocns: DataFrame, bridge: DataFrame) -> DataFrame:
    """(cluster_id, item_id), each pair once."""
    return cluster_ocns.join(bridge, "ocn").select("cluster_id", "item_id").distinct()


def cluster_resolutions(cluster_ocns: DataFrame, concordance: DataFrame) -> DataFrame:
    """(cluster_id, variant, canonical) entries touching the cluster."""
    by_variant = cluster_ocns.join(concordance, F.col("ocn") == F.col("variant"))
    by_canonical = cluster_ocns.join(concordance, F.col("ocn") == F.col("canonical"))
    columns = ("cluster_id", "variant", "canonical")
    return by_variant.select(*columns).union(by_canonical.select(*columns)).distinct()


def empty_clusters(cluster_ocns: DataFrame, bridge: DataFrame, concordance: DataFrame,
                   holdings: DataFrame) -> DataFrame:
    """Cluster ids with neither items, concordance entries nor holdings."""
    known = (bridge.select("ocn").union(holdings.select("ocn"))
             .union(concordance.select("variant")).union(concordance.select("canonical")).distinct())
    filled = cluster_ocns.join(known, "ocn", "left_semi").select("cluster_id")
    return cluster_ocns.select("cluster_id").distinct().join(filled, "cluster_id", "left_anti")


def inspect(cluster_ocns: DataFrame, items: DataFrame, bridge: DataFrame, holdings: DataFrame,
            concordance: DataFrame) -> DataFrame:
    """Everything of a cluster in long form (cluster_id, part, key, detail as JSON).

    One row per member keeps a very large cluster spread over tasks.
    """
    def rows(df: DataFrame, part: str, key: str, *columns: str) -> DataFrame:
        return df.select("cluster_id", F.lit(part).alias("part"),
                         F.col(key).cast("string").alias("key"),
                         F.to_json(F.struct(*columns)).alias("detail"))

    item_rows = cluster_items(cluster_ocns, bridge).join(items, "item_id")
    return (
        rows(cluster_ocns, "ocn", "ocn", "ocn")
        .union(rows(item_rows, "item", "item_id", "item_id", "bib_key", "rights", "n_enum"))
        .union(rows(cluster_holdings(cluster_ocns, holdings), "holding", "uuid",
                    "ocn", "organization", "n_enum", "status", "condition"))
        .union(rows(cluster_resolutions(cluster_ocns, concordance), "resolution", "variant",
                    "variant", "canonical"))
    )
