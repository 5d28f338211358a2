"""Sharding by a k-d tree over document metadata, with shards of near equal bytes.

A node that stands for n shards is cut in two along its widest dimension, at the weighted median:
the place where the bytes below are to the bytes above as n // 2 to n - n // 2. Medians are found
by distributed histograms, refined until the bin the cut falls into is small; the driver sees a
fixed number of bins per node, whatever the input. Equal texts share their coordinates, and within
a coordinate rows are ordered by the hash of their text, so equal texts stay together; only a group
of more than `GROUP_SHARE` of a shard is cut further, by document. A row's shard is one conditional
expression over its metadata.

Edge cases: a null text counts as none (8 bytes, checksum 0); null metadata is the coordinate 0.
Repeated rows are rows of their own. With fewer rows than shards some shards stay empty; a text
larger than a shard's share makes its shard larger. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.scratch import written

OVERHEAD = 8          # bytes a row counts besides its text
COORDINATES = 256     # steps of each dimension
DIMENSIONS = ("by_size", "by_source", "by_lang")
BIN_BITS, TIE_BITS = 10, 60
GROUP_SHARE = 0.05    # of a shard's bytes: equal texts of no more than that are never parted


@dataclass
class Node:
    """A part of the rows that will be `shards` shards, the first of which is `first`."""

    first: int
    shards: int
    dimension: str = ""
    coordinate: int = 0
    tie: int = 0
    children: list[Node] = field(default_factory=list)

    def leaf(self) -> Column:
        """The first shard of the leaf a row falls into."""
        if not self.children:
            return F.lit(self.first)
        at = F.col(self.dimension)
        below = (at < self.coordinate) | ((at == self.coordinate) & (F.col("tie") < self.tie))
        return F.when(below, self.children[0].leaf()).otherwise(self.children[1].leaf())

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, coordinates, and the tie that orders rows within one of them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + OVERHEAD).cast("bigint")

    def named(column: str) -> Column:
        return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")),
                                 F.lit(COORDINATES)), F.lit(0)).cast("int")

    half = F.lit((1 << TIE_BITS // 2) - 1)
    rows = written(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
        named("source").alias("source"), named("lang").alias("lang"),
        F.xxhash64(F.col("doc_id").cast("bigint"), F.lit(1)).bitwiseAND(half).alias("doc_tie")),
        "shard-rows")
    # copies of a text may lie in several sources: the group's coordinates are the least of them
    groups = written(rows.groupBy("text_hash").agg(
        F.min("source").alias("by_source"), F.min("lang").alias("by_lang")), "shard-groups")
    return rows.join(groups, "text_hash").select(
        "doc_id", "size", "text_crc32",
        F.least(F.lit(COORDINATES - 1), F.log2("size") * (COORDINATES / 40)).cast("int").alias(
            "by_size"),
        "by_source", "by_lang",
        (F.shiftleft(F.col("text_hash").bitwiseAND(half), TIE_BITS // 2)
         + F.col("doc_tie")).alias("tie"))


def _median(bins: list[tuple[int, int]], goal: float) -> tuple[int, int, int]:
    """The bin where the running sum passes `goal`, what lies before it, and what it holds."""
    before = 0
    for at, weight in bins:
        if before + weight > goal:
            return at, before, weight
        before += weight
    return bins[-1][0] + 1, before, 0


def build_tree(rows: DataFrame, shards: int, tolerance: float = 0.002) -> Node:
    """The tree over `metadata` rows; each cut is within `tolerance` of a shard's share."""
    root = Node(0, shards)
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return root
    small = tolerance * total / shards
    dims = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(d).alias("c"))
                               for d in DIMENSIONS]))
    while open_nodes := [x for x in root.leaves() if x.shards > 1]:
        placed = rows.withColumn("node", root.leaf())
        counted = placed.select("node", "size", dims).groupBy("node", "col.d", "col.c").agg(
            F.sum("size").alias("bytes")).collect()
        cuts = []  # node, goal within the tie range, range start, bits left
        for node in open_nodes:
            by = {d: sorted((r["c"], r["bytes"]) for r in counted
                            if r["node"] == node.first and r["d"] == d) for d in DIMENSIONS}
            if not by[DIMENSIONS[0]]:
                node.children = _halves(node)
                node.dimension = DIMENSIONS[0]
                continue
            node.dimension = max(DIMENSIONS, key=lambda d: by[d][-1][0] - by[d][0][0])
            bins = by[node.dimension]
            goal = sum(w for _, w in bins) * (node.shards // 2) / node.shards
            node.coordinate, before, held = _median(bins, goal)
            if held:
                cuts.append((node, goal - before, 0, TIE_BITS))
        while cuts:
            cuts = _refine(placed, cuts, small, tolerance)
        for node in open_nodes:
            node.children = node.children or _halves(node)
    return root


def _halves(node: Node) -> list[Node]:
    left = node.shards // 2
    return [Node(node.first, left), Node(node.first + left, node.shards - left)]


def _refine(placed: DataFrame, cuts: list, small: float, tolerance: float) -> list:
    """One round: the bins of each open range, in one aggregate over all nodes."""
    which, digit = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for node, _, start, bits in cuts:
        inside = (F.col("node") == node.first) & (F.col(node.dimension) == node.coordinate) & (
            F.shiftright("tie", bits) == start >> bits)
        which = F.when(inside, node.first).otherwise(which)
        digit = F.when(inside, F.shiftright("tie", bits - BIN_BITS).bitwiseAND(
            F.lit((1 << BIN_BITS) - 1))).otherwise(digit)
    counted = placed.select(which.alias("which"), digit.alias("digit"), "size").where(
        "which is not null").groupBy("which", "digit").agg(F.sum("size").alias("bytes")).collect()
    again = []
    for node, goal, start, bits in cuts:
        bins = sorted((r["digit"], r["bytes"]) for r in counted if r["which"] == node.first)
        at, before, held = _median(bins, goal)
        bits -= BIN_BITS
        edge = start + (at << bits)
        whole = GROUP_SHARE / tolerance if bits == TIE_BITS // 2 else 1  # one text by now
        if held > small * whole and bits:
            again.append((node, goal - before, edge, bits))
        else:  # the nearer edge of the bin
            node.tie = edge + ((1 << bits) if goal - before > held / 2 and held else 0)
    return again


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; one row per row of `docs`.

    Slots are numbered by parts of a shard, so that no task holds a whole shard.
    """
    rows = written(metadata(docs), "shard-metadata")
    tree = build_tree(rows, shards)
    parts = max(16, -(-rows.count() // (shards * 50_000)))
    placed = rows.select("doc_id", "size", "text_crc32", "tie", tree.leaf().alias("shard"),
                         F.pmod(F.xxhash64("doc_id", "tie"), F.lit(parts)).alias("part"))
    numbered = placed.withColumn("within", F.row_number().over(
        Window.partitionBy("shard", "part").orderBy("doc_id", "tie")))
    starts = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part"))
                          - F.col("n")).alias("start"))
    return numbered.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("within") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
