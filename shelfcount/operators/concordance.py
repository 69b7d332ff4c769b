"""The OCN concordance: validation as a graph, deltas, and applying them.

All graph work is a loop of joins and aggregates over the whole edge table.
Loops end when nothing changes; there is no round limit, because stopping
early would give wrong answers. Each round is checkpointed to the shared
folder, which bounds the plan and survives lost executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.session import cut_lineage

PAIR_LINE = r"^[0-9]+\t[0-9]+$"
CYCLE = "cycle"
SEVERAL = "several terminal OCNs"


def malformed_lines(lines: DataFrame) -> DataFrame:
    """One row: how many lines (value) are not number, tab, number."""
    return lines.agg(F.count_if(~F.col("value").rlike(PAIR_LINE)).alias("malformed"))


def require_well_formed(lines: DataFrame) -> None:
    bad = malformed_lines(lines).first()["malformed"]
    if bad:
        raise ValueError(f"Invalid format. {bad} line(s) are malformed.")


def without_self(pairs: DataFrame) -> DataFrame:
    """Drop entries of an OCN to itself."""
    return pairs.filter(F.col("variant") != F.col("canonical"))


def neighbours(pairs: DataFrame) -> DataFrame:
    """(ocn, direction, neighbour), distinct, without self."""
    edges = without_self(pairs)
    return (edges.select(F.col("variant").alias("ocn"), F.lit("out").alias("direction"),
                         F.col("canonical").alias("neighbour"))
            .union(edges.select("canonical", F.lit("in"), "variant")).distinct())


def adjacency(pairs: DataFrame) -> DataFrame:
    """(variant, canonicals), for looking at small tables."""
    return pairs.groupBy("variant").agg(F.sort_array(F.collect_list("canonical")).alias("canonicals"))


def terminals(pairs: DataFrame) -> DataFrame:
    """OCNs that do not lead on to another one."""
    edges = without_self(pairs)
    return (edges.select(F.col("canonical").alias("ocn")).distinct()
            .join(edges.select(F.col("variant").alias("ocn")), "ocn", "left_anti"))


def _fingerprint(df: DataFrame) -> tuple:
    """Row count and an order-free hash, to see whether a round changed anything."""
    row = df.agg(F.count("*").alias("n"),
                 F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(pairs: DataFrame) -> DataFrame:
    """(ocn, component): weakly connected, named by the least OCN in it.

    Alternates large-star and small-star steps (Kiveris et al., 2014), which
    need a logarithmic number of rounds for chains and stars alike. Only the
    least neighbour of a node is ever aggregated, never its neighbour list.
    """
    edges = without_self(pairs).select(F.col("variant").alias("u"), F.col("canonical").alias("v"))
    edges = cut_lineage(edges.distinct())
    if edges.isEmpty():
        return edges.select(F.col("u").alias("ocn"), F.col("v").alias("component"))
    before = None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("ocn"), F.col("v").alias("component"))
    return (edges.select(F.col("u").alias("ocn"), F.col("v").alias("component"))
            .union(roots).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of a node go to the least of its neighbourhood."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Lesser neighbours of a node, and the node, go to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())


def cycle_residue(pairs: DataFrame, member_of: DataFrame) -> DataFrame:
    """(ocn, component) of the OCNs that a cycle leads to, its own included.

    These are what is left once OCNs without an in-edge are peeled off, again
    and again. A component with one edge less than nodes is a tree, so only the
    others are looked at. OCNs with exactly one in-edge are followed back by
    pointer doubling, and only where edges meet is anything peeled: rounds
    follow the nesting of branches, not the length of paths.
    """
    edges = without_self(pairs).select("variant", "canonical").distinct()
    placed = edges.join(member_of.withColumnRenamed("ocn", "variant"), "variant")
    n_edges = placed.groupBy("component").agg(F.count("*").alias("edges"))
    n_nodes = member_of.groupBy("component").agg(F.count("*").alias("nodes"))
    suspect = n_edges.join(n_nodes, "component").filter("edges >= nodes").select("component")
    rest = cut_lineage(placed.join(suspect, "component", "left_semi"))
    into = cut_lineage(rest.groupBy("canonical", "component").agg(
        F.count("*").alias("n"), F.min("variant").alias("before")).withColumnRenamed("canonical", "ocn"))
    back = _origins(into.filter("n = 1").select("ocn", "before"))
    meeting = into.filter("n > 1").select("ocn", "component")
    live = cut_lineage(
        rest.select(F.col("canonical").alias("ocn"), F.col("variant").alias("from"))
        .join(meeting.select("ocn"), "ocn", "left_semi")
        .join(back.withColumnRenamed("ocn", "from"), "from", "left")
        .select("ocn", F.coalesce("origin", "from").alias("origin"), F.coalesce("in_cycle", F.lit(False)).alias("in_cycle"))
        .distinct())
    left = live.count()
    while left:
        known = live.select(F.col("ocn").alias("origin"), F.lit(True).alias("known")).distinct()
        live = cut_lineage(live.join(known, "origin", "left").filter("in_cycle OR known")
                           .select("ocn", "origin", "in_cycle"))
        now = live.count()
        if now == left:
            break
        left = now
    reached = live.select("ocn").distinct()
    single = (back.join(reached.select(F.col("ocn").alias("origin"), F.lit(True).alias("known")), "origin", "left")
              .filter("in_cycle OR known").select("ocn"))
    return into.select("ocn", "component").join(reached.union(single).distinct(), "ocn", "left_semi")


def _origins(single: DataFrame) -> DataFrame:
    """(ocn, origin, in_cycle) of OCNs (ocn, before) with one in-edge: the first OCN on the way back that has
    none or several, or, after more steps than there are such OCNs, one of a cycle."""
    jumps = cut_lineage(single.withColumnRenamed("before", "origin"))
    size, steps, before = jumps.count(), 1, None
    while steps < size:
        further = jumps.select(F.col("ocn").alias("origin"), F.col("origin").alias("far"))
        jumps = cut_lineage(jumps.join(further, "origin", "left").select(
            "ocn", F.coalesce("far", "origin").alias("origin")))
        steps *= 2
        now = _fingerprint(jumps)
        if now == before:
            break
        before = now
    inner = single.select(F.col("ocn").alias("origin"), F.lit(True).alias("inner"))
    return cut_lineage(jumps.join(inner, "origin", "left").select(
        "ocn", "origin", F.coalesce("inner", F.lit(False)).alias("in_cycle")))


def resolve(pairs: DataFrame) -> DataFrame:
    """(ocn, lo, hi): least and greatest terminal reached by each variant.

    For an acyclic table; lo = hi means a single terminal. OCNs with one
    successor are followed by pointer doubling, so a chain of length n takes
    log2(n) rounds. Where paths branch, the ends of all branches are merged,
    which takes one more round per nested branching.
    """
    edges = without_self(pairs).select(F.col("variant").alias("ocn"),
                                       F.col("canonical").alias("next")).distinct()
    fan = edges.groupBy("ocn").agg(F.count("*").alias("n"), F.min("next").alias("next"))
    single = cut_lineage(fan.filter("n = 1").select("ocn", "next"))
    branching = cut_lineage(fan.filter("n > 1").select("ocn"))
    jumps = _follow(single)
    ends = cut_lineage(edges.join(branching, "ocn", "left_semi")
                       .join(jumps.select(F.col("ocn").alias("next"), F.col("end")), "next", "left")
                       .select("ocn", F.coalesce("end", "next").alias("end")).distinct())
    solved = _merge_branches(ends)
    chained = jumps.join(solved.select(F.col("ocn").alias("end"), "lo", "hi"), "end", "left").select(
        "ocn", F.coalesce("lo", "end").alias("lo"), F.coalesce("hi", "end").alias("hi"))
    return chained.union(solved)


def _follow(single: DataFrame) -> DataFrame:
    """(ocn, end): the last OCN reached over OCNs that have exactly one successor."""
    jumps = single.withColumnRenamed("next", "end")
    before = None
    while True:
        further = jumps.select(F.col("ocn").alias("end"), F.col("end").alias("far"))
        jumps = cut_lineage(jumps.join(further, "end", "left")
                            .select("ocn", F.coalesce("far", "end").alias("end")))
        now = _fingerprint(jumps)
        if now == before:
            return jumps
        before = now


def _merge_branches(ends: DataFrame) -> DataFrame:
    """(ocn, lo, hi) of branching OCNs from their (ocn, end) pairs."""
    solved = cut_lineage(ends.select("ocn", F.col("ocn").alias("lo"), F.col("ocn").alias("hi")).limit(0))
    waiting = ends.select("ocn").distinct()
    left = waiting.count()
    while left:
        # ready: no end is itself still waiting
        blocked = (ends.join(waiting.select(F.col("ocn").alias("end")), "end", "left_semi")
                   .select("ocn"))
        ready = waiting.join(blocked, "ocn", "left_anti")
        found = (ends.join(ready, "ocn", "left_semi")
                 .join(solved.select(F.col("ocn").alias("end"), "lo", "hi"), "end", "left")
                 .groupBy("ocn").agg(F.min(F.coalesce("lo", "end")).alias("lo"),
                                     F.max(F.coalesce("hi", "end")).alias("hi")))
        solved = cut_lineage(solved.union(found))
        waiting = cut_lineage(waiting.join(solved, "ocn", "left_anti"))
        now = waiting.count()
        if now == left:
            raise ValueError("the concordance has a cycle")
        left = now
    return solved


@dataclass(frozen=True)
class Validated:
    """valid(variant, canonical), rejected(variant, reason, component), cyclic(ocn, component)."""

    valid: DataFrame
    rejected: DataFrame
    cyclic: DataFrame


def validate(pairs: DataFrame) -> Validated:
    """One output row per input row, self entries left out.

    A cycle rejects every variant of its component. Of the others, a variant
    is valid if all its paths end in the same OCN.
    """
    edges = cut_lineage(without_self(pairs).select("variant", "canonical"))
    member_of = cut_lineage(components(edges))
    cyclic = cut_lineage(cycle_residue(edges, member_of))
    bad = cyclic.select("component").distinct().withColumn("bad", F.lit(True))
    placed = (edges.join(member_of.withColumnRenamed("ocn", "variant"), "variant")
              .join(bad, "component", "left"))
    sound = placed.filter("bad is null")
    ends = resolve(sound).withColumnRenamed("ocn", "variant")
    judged = sound.select("variant", "component").join(ends, "variant")
    valid = judged.filter("lo = hi").select("variant", F.col("lo").alias("canonical"))
    rejected = (placed.filter("bad").select("variant", F.lit(CYCLE).alias("reason"), "component")
                .union(judged.filter("lo != hi")
                       .select("variant", F.lit(SEVERAL).alias("reason"), "component")))
    return Validated(valid, rejected, cyclic)


def delta(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(adds, deletes) as multiset differences."""
    a, b = old.select("variant", "canonical"), new.select("variant", "canonical")
    return b.exceptAll(a), a.exceptAll(b)


def apply_delta(current: DataFrame, adds: DataFrame, deletes: DataFrame) -> DataFrame:
    """Add, then delete listed pairs. Adding a known pair changes nothing."""
    return upsert(current, adds).join(deletes, ["variant", "canonical"], "left_anti")


def upsert(current: DataFrame, adds: DataFrame) -> DataFrame:
    return current.select("variant", "canonical").union(adds.select("variant", "canonical")).distinct()


def is_delta(argument: str) -> bool:
    """Eight digits name the date of a delta; anything else is a full file."""
    return len(argument) == 8 and argument.isdigit()


def load(current: DataFrame, argument: str, read, deltas: str) -> DataFrame:
    """The table after loading a delta by date or a full file by path."""
    if not is_delta(argument):
        return read(argument).distinct()
    day = f"{argument[:4]}-{argument[4:6]}-{argument[6:]}"
    base = f"{deltas}/comm_diff_{day}.txt"
    return apply_delta(current, read(base + ".adds"), read(base + ".deletes"))
