"""Merkle manifest of a dataset: one digest for the whole, and a proof for every row.

Leaves of a group (``lang``) are ordered by id and paired level by level, a last single node by itself; the roots
of the groups, in order of their groups, are paired likewise.

Rows are put in order by a range shuffle of digests, never of texts; a row's number within its group is its number
within the range plus the counts of the ranges before. Aligned stretches of 2**``HEIGHT`` nodes go to one builder
each. A builder appends every node to a log when it is complete, that is in postorder, and never goes back: the
place of a node follows from the sizes of perfect subtrees, as the number of nodes that were completed before its
last leaf was, plus its height. So a builder finds the left sibling of a new node, and an extraction all siblings
of a leaf, by arithmetic on the log. The roots of the stretches are the nodes of the next tier; there are as many
tiers as the largest group needs, which is its height / ``HEIGHT``. The roots of the groups are one more such tree.

A proof is the list of siblings up to the root, with the side of each. Folding a leaf with it gives the root.

Null values have a leaf of their own, as the contract says. Rows of one id, null ids too, are ordered by their
leaves; rows that repeat all five values are each a leaf, next to each other, and interchangeable. A null group
comes first. An empty table gives no rows and no root. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import written

#: Levels that a builder makes: it holds 2**HEIGHT nodes, and twice as many digests of 32 bytes in its log.
HEIGHT = 10
DIGEST = 32
#: A step of a path: the side of the sibling (none, right, left), and the sibling.
ALONE, RIGHT, LEFT = 0, 1, 2
STEP = DIGEST + 1
#: Columns of a leaf, in order: fixed by the contract.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*nodes: bytes) -> bytes:
    """Digest of the hex texts of digests."""
    return sha256(b"".join(nodes).hex().encode()).digest()


def height(n: int) -> int:
    """Levels above n nodes."""
    return max(n - 1, 0).bit_length()


def position(level: int, index: int, n: int) -> int:
    """Place in the log of a node over the leaves [index * 2**level, ...) of n.

    Before leaf i, every leaf before it and every perfect subtree of those is complete: 2i - popcount(i) nodes.
    The nodes over the last leaf of a subtree follow it, level by level.
    """
    last = min((index + 1) << level, n) - 1
    return 2 * last - last.bit_count() + level


class Log:
    """Nodes over n leaves in completion order, up to a root at ``top`` levels."""

    def __init__(self, data: bytes | bytearray, n: int, top: int):
        self.data, self.n, self.top = data, n, top

    @classmethod
    def build(cls, leaves: bytes, top: int) -> Log:
        n, data = len(leaves) // DIGEST, bytearray()
        for i in range(n):
            node = leaves[i * DIGEST:(i + 1) * DIGEST]
            data += node
            last = i == n - 1
            for level in range(top):
                index = i >> level
                if index & 1:  # the subtree on the left was complete just before this one began
                    at = position(level, index - 1, n) * DIGEST
                    node = hashed(data[at:at + DIGEST], node)
                elif last:
                    node = hashed(node)
                else:
                    break
                data += node
        return cls(bytes(data), n, top)

    def node(self, level: int, index: int) -> bytes:
        at = position(level, index, self.n) * DIGEST
        return bytes(self.data[at:at + DIGEST])

    def root(self) -> bytes:
        return bytes(self.data[-DIGEST:])

    def path(self, leaf: int) -> bytes:
        """Steps from a leaf to the root."""
        steps, n = [], self.n
        for level in range(self.top):
            index = leaf >> level
            if index & 1:
                steps.append(bytes([LEFT]) + self.node(level, index - 1))
            elif (index + 1) << level < n:
                steps.append(bytes([RIGHT]) + self.node(level, index + 1))
            else:
                steps.append(bytes([ALONE]) + bytes(DIGEST))
        return b"".join(steps)


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1:at + STEP]
        leaf = hashed(leaf) if side == ALONE else hashed(leaf, sibling) if side == RIGHT else hashed(sibling, leaf)
    return leaf


def proof_digest(path: bytes) -> str:
    """Of the siblings of a path, in order."""
    steps = np.frombuffer(path, np.uint8).reshape(-1, STEP)
    return sha256(steps[steps[:, 0] != ALONE, 1:].tobytes().hex().encode()).hexdigest()


# --- leaves and their numbers ----------------------------------------------------

def leaf(**instead: Column) -> Column:
    """Digest of a row's fields, each with its length; ``instead`` are other values for some."""
    def field(name: str) -> Column:
        value = instead.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[field(c) for c in FIELDS]).cast("binary"), 256))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """With ``index``, the number of a row within its group, and ``n``, the group's size.

    A sort over all rows by range, so that a group of any size is spread; only counts for each range and group
    (about as many as there are ranges and groups) are summed up. ``rows`` are read twice.
    """
    keys = [group, *order]
    ordered = written(rows.withColumn("__tie", F.monotonically_increasing_id())
                      .repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie")
                      .drop("__tie").withColumn("__at", F.monotonically_increasing_id())
                      .withColumn("__range", F.shiftright("__at", 33)), "ordered")
    counts = ordered.groupBy(group, "__range").agg(F.count("*").alias("__own"), F.min("__at").alias("__first"))
    by_group = Window.partitionBy(group)
    before = F.sum("__own").over(by_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(counts.select(F.col(group).alias("__group"), F.col("__range").alias("__of"),
                                   (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
                                   F.sum("__own").over(by_group).alias("n")), "starts")
    same = (F.col("__range") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__group"))
    return ordered.join(starts, same).withColumn("index", F.col("__at") + F.col("__shift")).drop(
        "__at", "__range", "__of", "__group", "__shift")


# --- builders ------------------------------------------------------------------------

NODES = "grp string, n long, block long, index long, node binary"
LOGS = "grp string, n long, block long, size int, log binary"


def _stretches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that are sorted by keys, one table for each value of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for key in keys:
            column = batch.column(key).to_pylist()
            before = held[-1].column(key)[-1].as_py() if held else None
            new |= np.array([a != b for a, b in zip(column, [before, *column[:-1]])])
        new[0] = new[0] and bool(held)
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for first, last in zip(cuts[:-1], cuts[1:]):
            if held and new[first]:
                yield pa.Table.from_batches(held)
                held = []
            if last > first:
                held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def _logs(level: int):
    schema = pa.schema([("grp", pa.string()), ("n", pa.int64()), ("block", pa.int64()), ("size", pa.int32()),
                        ("log", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _stretches(batches, ["grp", "block"]):
            grp, n, block = (own.column(c)[0].as_py() for c in ("grp", "n", "block"))
            log = Log.build(b"".join(own.column("node").to_pylist()), level if n > 1 << level else height(n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((grp, n, block, log.n, log.data), schema)], schema=schema)
    return build


def built(nodes: DataFrame, level: int) -> DataFrame:
    """Logs of the aligned stretches of nodes (grp, n, index, node)."""
    return (nodes.select("grp", "n", F.shiftright("index", level).alias("block"), "index", "node")
            .repartition("grp", "block").sortWithinPartitions("grp", "block", "index")
            .mapInArrow(_logs(level), LOGS))


def _top(level: int) -> Column:
    """Levels of a stretch's log."""
    few = F.length(F.bin(F.col("n") - 1)).cast("int")
    return F.when(F.col("n") > 1 << level, level).when(F.col("n") > 1, few).otherwise(0)


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (doc_id, grp, n, index, node, and what else came with a leaf), ``tiers`` of logs (grp, n, block,
    size, log) from the leaves upwards, ``subroots`` (grp, subroot, n, index), the ``group_tiers`` over these, and
    the ``root``, None of an empty table."""

    leaves: DataFrame
    tiers: list[DataFrame]
    subroots: DataFrame
    group_tiers: list[DataFrame]
    root: bytes | None
    level: int


def _tree(nodes: DataFrame, level: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Tiers of logs over nodes (grp, n, index, node), and the root (grp, root) of each group."""
    largest = nodes.agg(F.max("n")).first()[0] or 0  # one number
    tiers = []
    while True:
        logs = written(built(nodes, level), f"{name}{len(tiers)}")
        tiers.append(logs)
        nodes = logs.select("grp", F.ceil(F.col("n") / F.lit(1 << level)).cast("long").alias("n"),
                            F.col("block").alias("index"), F.expr(f"substring(log, -{DIGEST}, {DIGEST})").alias("node"))
        largest = -(-largest // (1 << level))
        if largest <= 1:
            return tiers, nodes.select("grp", F.col("node").alias("root"))


def manifest(docs: DataFrame, level: int = HEIGHT, tampered: Column | None = None) -> Manifest:
    """Logs and roots of docs; where ``tampered``, a value for n_chars, is not null, a leaf also has what it would
    be then (other)."""
    other = F.lit(None) if tampered is None else F.when(tampered.isNotNull(), leaf(n_chars=tampered))
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("grp"),
                               leaf().alias("node"), other.cast("binary").alias("other")), "rows")
    leaves = written(numbered(rows, "grp", ["doc_id", "node"]), "leaves")
    tiers, roots = _tree(leaves, level, "logs")
    subroots = written(numbered(roots.select(F.lit("").alias("__all"), "grp", F.col("root").alias("subroot")),
                                "__all", ["grp"]).drop("__all"), "subroots")
    group_tiers, root = _tree(subroots.select(F.lit("").alias("grp"), "n", "index", F.col("subroot").alias("node")),
                              level, "tops")
    found = root.first()  # one row
    return Manifest(leaves, tiers, subroots, group_tiers, bytes(found["root"]) if found else None, level)


# --- proofs -----------------------------------------------------------------------------

def _paths(level: int):
    """Of the nodes of logs that come with the path of their root (upper): (grp, index, path)."""
    schema = pa.schema([("grp", pa.string()), ("index", pa.int64()), ("path", pa.binary())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                log, upper = Log(row["log"], row["size"], row["top"]), row["upper"]
                first = row["block"] << level
                for at in range(0, log.n, 1024):
                    own = range(at, min(at + 1024, log.n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["grp"]] * len(own), pa.string()), pa.array([first + i for i in own], pa.int64()),
                         pa.array([log.path(i) + upper for i in own], pa.binary())], schema=schema)
    return extract


def _with_upper(logs: DataFrame, upper: DataFrame, level: int) -> DataFrame:
    """Logs with the path from the root of each upwards; upper has (grp, index, path) of those roots."""
    own = upper.select(F.col("grp").alias("__g"), F.col("index").alias("__i"), F.col("path").alias("upper"))
    return logs.withColumn("top", _top(level)).join(
        own, F.col("grp").eqNullSafe(F.col("__g")) & (F.col("block") == F.col("__i"))).drop("__g", "__i")


def _node_paths(tiers: list[DataFrame], start: DataFrame, level: int) -> DataFrame:
    """(grp, index, path) of the nodes under the lowest of ``tiers``, from the root, whose own path is ``start``, down."""
    for logs in reversed(tiers):
        start = _with_upper(logs, start, level).select("grp", "block", "size", "top", "log", "upper").mapInArrow(
            _paths(level), "grp string, index long, path binary")
    return start


def upper_paths(made: Manifest) -> DataFrame:
    """(grp, index, path): for each stretch of leaves, the steps from its root to the root of all."""
    top = made.group_tiers[-1].select("grp", "block")
    over = top.select("grp", F.col("block").alias("index"), F.lit("").cast("binary").alias("path"))
    groups = _node_paths(made.group_tiers, over, made.level)
    start = made.subroots.select(F.col("grp").alias("name"), F.col("index").alias("place")).join(
        groups.select("index", "path"), F.col("place") == F.col("index")).select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("index"), "path")
    return _node_paths(made.tiers[1:], start, made.level)


PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, path binary")


def _proofs(level: int, root: bytes | None):
    schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                        ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()),
                        ("path", pa.binary())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _stretches(batches, ["grp", "block"]):
            # the first row of a stretch is its log
            head = own.slice(0, 1).to_pylist()[0]
            log, upper = Log(head["log"], head["size"], head["top"]), head["upper"]
            subroot = head["subroot"].hex()
            for batch in own.slice(1).select(["doc_id", "index", "node", "other"]).to_batches(1024):
                rows = []
                for doc_id, index, node, other in zip(*(c.to_pylist() for c in batch.columns)):
                    path = log.path(index - (head["block"] << level)) + upper
                    found = folded(node if other is None else other, path)
                    rows.append((doc_id, node.hex(), subroot, root.hex(), proof_digest(path), found.hex(),
                                 found == root, path))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                                     schema=schema)
    return extract


def proofs(made: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, path) of each leaf.

    Leaves go to the task that has the log of their stretch; a stretch is at most 2**HEIGHT of them.
    """
    none = F.lit(None)
    named = made.subroots.select(F.col("grp").alias("__s"), "subroot")
    heads = _with_upper(made.tiers[0], upper_paths(made), made.level)
    heads = heads.join(named, F.col("grp").eqNullSafe(F.col("__s"))).select(
        "grp", "block", none.cast("long").alias("doc_id"), F.lit(-1).cast("long").alias("index"),
        none.cast("binary").alias("node"), none.cast("binary").alias("other"), "size", "top", "log", "upper", "subroot")
    rows = made.leaves.select(
        "grp", F.shiftright("index", made.level).alias("block"), "doc_id", "index", "node", "other",
        none.cast("int").alias("size"), none.cast("int").alias("top"),
        *[none.cast("binary").alias(c) for c in ("log", "upper", "subroot")])
    return (heads.unionByName(rows).repartition("grp", "block").sortWithinPartitions("grp", "block", "index")
            .mapInArrow(_proofs(made.level, made.root), PROOFS))


def tampering() -> Column:
    """The contract's: n_chars plus one where 7 divides the crc32 of the decimal id, else null."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1)


def verified(docs: DataFrame, level: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) with some rows tampered with."""
    return proofs(manifest(docs, level, tampering())).drop("path")
