"""N-gram Jaccard self-join: groups of documents whose shingle sets overlap enough.

A document is the set of its distinct five-word shingles, as 64-bit hashes. Documents with one and
the same set form a class, which is compared once. Each class has a bitmap: the hash of every
shingle sets one bit. Where two bitmaps differ, so do the sets, so bit counts bound the overlap
from above, and only pairs within the bound are intersected exactly, as sorted arrays.

Comparing all classes of like size would be quadratic, so tiles are made narrower, without a loss:
sets that are similar enough share one of the first fifth of their shingles, in any order common to
all. Very frequent shingles come last in that order. A tile is the classes that share such a
shingle; equal tiles are one, and sizes too far apart for a link are not compared.

A tile compares its members by their bitmaps, only across the groups formed so far, and gives the
edges that join them: at most one per member. The components of these edges are families, outside
of which no link is possible. The sets of a family are brought together and intersected exactly,
again only across groups, and what joins the groups are links. So a group of near copies costs an
edge per copy, not all its pairs, and no connection is lost. Tiles and families of many members are
cut into blocks, and their pairs of blocks compared by different tasks.

Edge cases: a null text, or one without words, has no shingle and is linked with nothing; one with
fewer words has its whole sequence as its only shingle. A null doc_id takes part but names no
component. Repeated rows are copies. Ties need no rule. An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bpe import id_text
from riskloom.llm.components import components
from riskloom.llm.scratch import SLICE, few_rows, written  # noqa: F401
from riskloom.llm.scratch import slices as _slices
from riskloom.operators.bounded import broadcast_if_small

WORDS = 5
PER_CENT = 80             # link: 100 * intersection >= PER_CENT * union
BITS_PER_SHINGLE = 2
CHUNK = 2_000_000         # shingles counted together when frequent ones are looked for
HEAVY_LIMIT = 1_000_000   # frequent shingles put last, at most; bounds the broadcast (8 MB), and
                          # with it only the speed, as any order gives the same links
TILE_BLOCK = 1024         # members of a tile, and of a family, that make a block: a task compares
FAMILY_BLOCK = 128        # two of them
SERIALS = 1 << 33         # rows a task may number

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                        0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)  # odd, arbitrary


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text. Only A-Z are lower-cased and only ASCII
    white space separates words, which is what `bytes` methods do."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(words))):
        total += hashed[k:k + n] * MULTIPLIERS[k]
    return np.unique(mix(total + np.uint64(min(WORDS, len(words)))))


def least_overlap(n: int) -> int:
    return -(-PER_CENT * n // 100)


def bitmap(values: np.ndarray) -> bytes:
    """A bit for each value, in a power of two of bits, so that larger bitmaps fold."""
    bits = 1 << max(6, int(BITS_PER_SHINGLE * len(values) - 1).bit_length())
    flags = np.zeros(bits, np.bool_)
    flags[(values & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def folded(bitmaps: list[bytes], width: int) -> np.ndarray:
    """Bitmaps of `width` 64-bit words or a multiple as rows of that width."""
    out = np.empty((len(bitmaps), width), np.uint64)
    for i, b in enumerate(bitmaps):
        out[i] = np.bitwise_or.reduce(np.frombuffer(b, np.uint64).reshape(-1, width), axis=0)
    return out


class Members:
    """Sets that are compared with each other, by growing size.

    `shared(one, others)` gives how many shingles the set `one` has in common with each of
    `others`, at most; these come after it and are no more than a link allows larger.
    """

    def __init__(self, sizes: np.ndarray, shared: Callable[[int, np.ndarray], np.ndarray]):
        self.sizes, self.shared = sizes, shared

    def near(self, one: int, others: np.ndarray) -> np.ndarray:
        a, b = self.sizes[one], self.sizes[others]
        both = self.shared(one, others)
        return others[100 * both >= PER_CENT * (a + b - both)]

    def joins(self, parts: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs that are near enough and join the groups of the pairs before them. If members
        are of two parts, only pairs across them count."""
        k, two = len(self.sizes), parts.min() != parts.max()
        group = np.arange(k)
        for one in range(k):
            # those up to here are small enough for a link
            end = int(np.searchsorted(self.sizes, self.sizes[one] * 100 // PER_CENT, "right"))
            others = np.arange(one + 1, end)
            others = others[group[others] != group[one]]
            if two:
                others = others[parts[others] != parts[one]]
            if not len(others):
                continue
            near = self.near(one, others)
            joined, first = np.unique(group[near], return_index=True)
            group[np.isin(group, joined)] = group[one]
            for other in near[first]:
                yield one, int(other)


def by_bitmaps(sizes: np.ndarray, bitmaps: list[bytes]) -> Members:
    """Bits that only one of two bitmaps has are shingles that only one of the sets has.

    Sets near enough in size have bitmaps of one width or of two neighbouring ones, and only
    those are folded together: a small set doesn't blur the large ones of its tile.
    """
    widths = np.array([len(b) // 8 for b in bitmaps])
    known: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def at_width(width: int) -> tuple[int, np.ndarray, np.ndarray]:
        if width not in known:
            begin, end = np.searchsorted(widths, (width, 2 * width + 1))
            maps = folded(bitmaps[begin:end], width)
            known[width] = begin, maps, np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        return known[width]

    def shared(one: int, others: np.ndarray) -> np.ndarray:
        begin, maps, counts = at_width(int(widths[one]))
        mine, theirs = one - begin, others - begin
        common = np.bitwise_count(maps[theirs] & maps[mine]).sum(axis=1, dtype=np.int64)
        return np.minimum(sizes[one] - (counts[mine] - common),
                          sizes[others] - (counts[theirs] - common))

    return Members(sizes, shared)


def by_shingles(arrays: list[np.ndarray]) -> Members:
    """Exact intersections of sorted arrays; shingles are numbered within the group first."""
    sizes = np.array([len(a) for a in arrays])
    ends = np.cumsum(sizes)
    values, number = np.unique(np.concatenate(arrays), return_inverse=True)
    has = np.zeros(len(values), np.bool_)

    def shared(one: int, others: np.ndarray) -> np.ndarray:
        mine = number[ends[one] - sizes[one]:ends[one]]
        has[mine] = True
        size = sizes[others]
        starts = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(ends[others] - size - starts, size)
        both = np.add.reduceat(has[number[at]], starts, dtype=np.int64)
        has[mine] = False
        return both

    return Members(sizes, shared)


def often(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that occur `least` times or more, and how often. Sorts `values` in place; beside it,
    only a bit mask is as long."""
    values.sort()
    if len(values) < least:
        return values[:0], np.zeros(0, np.int64)
    # in sorted order, such a value stands `least` - 1 places further too
    found = np.unique(values[:len(values) - least + 1][values[least - 1:]
                                                        == values[:len(values) - least + 1]])
    return found, np.searchsorted(values, found, "right") - np.searchsorted(values, found)


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got).combine_chunks() if got else None


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start, and the end."""
    change = np.zeros(len(keys[0]), np.bool_)
    change[0] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    return np.append(np.flatnonzero(change), len(change))


def frequent_shingles(docs: DataFrame, share: float = 0.001, least: int = 100) -> np.ndarray:
    """Hashes of shingles in about `share` of all documents or more, sorted.

    Counted in chunks of documents; a chunk passes on what is frequent within it, so little moves.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts = np.empty(CHUNK, np.uint64), 0, 0

        def counted() -> pa.RecordBatch:
            found, n = often(held[:size], max(4, ceil(texts * share)))
            return pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(n)], ["shingle", "n"])

        for rows in _slices(batches):
            for text in rows.column(1).to_pylist():
                values = shingles(text)
                if size and size + len(values) > len(held):
                    yield counted()
                    size = texts = 0
                if len(values) > len(held):
                    held = np.empty(len(values), np.uint64)
                held[size:size + len(values)] = values
                size, texts = size + len(values), texts + 1
        if size:
            yield counted()

    limit = max(least, int(docs.count() * share))
    heavy = id_text(docs).mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(
        F.sum("n").alias("n")).where(F.col("n") >= limit).orderBy(
        F.desc("n"), "shingle").limit(HEAVY_LIMIT).select("shingle").toArrow()
    return np.sort(heavy.column(0).to_numpy().astype(np.int64).view(np.uint64))


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), np.bool_)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def shingle_sets(docs: DataFrame, heavy: np.ndarray) -> DataFrame:
    """serial, doc_id, n, fp (128-bit hash of the set), bitmap, anchors; one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() * SERIALS
        for rows in _slices(batches):
            n, fp, maps, anchors, ends = [], [], [], [], [0]
            for text in rows.column(1).to_pylist():
                values = shingles(text)
                last = _in_sorted(values, shared.value)
                ordered = np.concatenate([values[~last], values[last]])
                first = ordered[:len(values) - least_overlap(len(values)) + 1]
                n.append(len(values))
                fp.append(xxhash.xxh3_128_digest(values))
                maps.append(bitmap(values) if len(values) else b"")
                anchors.append(first)
                ends.append(ends[-1] + len(first))
            flat = np.concatenate(anchors) if anchors else np.zeros(0, np.uint64)
            serials = pa.array(np.arange(serial, serial + len(n)))
            serial += len(n)
            yield pa.RecordBatch.from_arrays(
                [serials, rows.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                 pa.array(maps, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                          pa.array(flat.view(np.int64)))],
                ["serial", "doc_id", "n", "fp", "bitmap", "anchors"])

    return id_text(docs).mapInArrow(
        run, "serial bigint, doc_id bigint, n bigint, fp binary, bitmap binary, anchors array<bigint>")


def tiles(anchors: DataFrame) -> DataFrame:
    """tile, k (members), node from node, anchor: each different list of members once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        anchor, node = table.column("anchor").to_numpy(), table.column("node").to_numpy()
        order = np.lexsort((node, anchor))
        anchor, node = anchor[order], node[order]
        starts = _starts(anchor)
        k = np.diff(starts)
        tile = np.add.reduceat(mix(node.view(np.uint64) + np.uint64(1)), starts[:-1])
        keep = np.flatnonzero(k > 1)
        keep = keep[np.unique(tile[keep], return_index=True)[1]]
        size = k[keep]
        at = np.arange(size.sum()) + np.repeat(starts[:-1][keep] - (np.cumsum(size) - size), size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(tile[keep], size).view(np.int64)),
             pa.array(np.repeat(size, size)), pa.array(node[at])], ["tile", "k", "node"])

    return anchors.repartition("anchor").mapInArrow(
        run, "tile bigint, k bigint, node bigint").dropDuplicates(["tile", "node"])


def block_pairs(rows: DataFrame, group: str, members: Column, size: int) -> DataFrame:
    """`rows` with block and part: a part is two blocks of a group, or all of a group of no more
    than `size` members. A row comes once for each part that has its block."""
    blocks = F.ceil(members / size)
    cut = rows.withColumn("block", F.pmod(F.xxhash64("node", group), blocks))
    whole = cut.where(blocks == 1).withColumn("part", F.lit(0).cast("bigint"))
    paired = cut.where(blocks > 1).withColumn("part", F.explode(F.transform(
        F.sequence(F.lit(0).cast("bigint"), blocks - 1),
        lambda x: F.least(x, F.col("block")) * blocks + F.greatest(x, F.col("block")))))
    return whole.union(paired)


def joining_pairs(rows: DataFrame, group: str, column: str) -> DataFrame:
    """Pairs (a, b) of nodes that join the members of each part, from rows of group, part, block,
    node, and n and bitmap or shingles."""
    exact = column == "shingles"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        key, part, block, node, n = (
            table.column(c).to_numpy() for c in (group, "part", "block", "node", "n"))
        order = np.lexsort((node, n, part, key))
        starts, data = _starts(key[order], part[order]), table.column(column)
        a, b = [], []
        for begin, end in zip(starts, starts[1:], strict=False):
            if end - begin < 2:
                continue
            rows = order[begin:end]
            held = data.take(rows).to_pylist()
            members = by_shingles([np.frombuffer(x, np.uint64) for x in held]) if exact else (
                by_bitmaps(n[rows], held))
            for one, other in members.joins(block[rows]):
                a.append(node[rows[one]])
                b.append(node[rows[other]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    columns = [group, "part", "block", "node", "n", column]
    return rows.select(*columns).repartition(group, "part").mapInArrow(run, "a bigint, b bigint")


def shingle_arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """family, k, node, n, shingles for rows of node, fp, doc_id, family, k; only documents that
    stand for a wanted node are read again."""
    texts = id_text(docs).withColumnRenamed("doc_id", "id").join(
        broadcast_if_small(wanted), F.col("id").eqNullSafe(F.col("doc_id"))).select(
        "family", "k", "node", "fp", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            fp, text = rows.column("fp").to_pylist(), rows.column("text").to_pylist()
            sets = [shingles(t) for t in text]
            # a doc_id may be repeated with another text
            keep = pa.array([xxhash.xxh3_128_digest(v) == f
                             for v, f in zip(sets, fp, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [rows.column("family"), rows.column("k"), rows.column("node"),
                 pa.array([len(v) for v in sets], pa.int64()),
                 pa.array([v.tobytes() for v in sets], pa.binary())],
                ["family", "k", "node", "n", "shingles"]).filter(keep)

    return texts.mapInArrow(run, "family bigint, k bigint, node bigint, n bigint, shingles binary")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id; one row per document."""
    with few_rows(docs.sparkSession):
        sets = written(shingle_sets(docs, frequent_shingles(docs)), "near-sets")
    # the row with the smallest number stands for all rows of its class
    classes = written(sets.where("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("doc_id"), F.min("serial").alias("node")), "near-classes")
    own = sets.join(broadcast_if_small(classes.select("node")), F.col("serial") == F.col("node"))
    tiled = written(tiles(own.select("node", F.explode("anchors").alias("anchor"))), "near-tiles")

    with few_rows(docs.sparkSession):
        bounded = written(joining_pairs(block_pairs(
            tiled.join(own.select("node", "n", "bitmap"), "node"), "tile", F.col("k"), TILE_BLOCK),
            "tile", "bitmap"), "near-bounded")
    families = written(components(bounded, "a", "b").withColumnRenamed("component", "family"),
                       "near-families")
    sizes = written(families.groupBy("family").agg(F.count("*").alias("k")), "near-sizes")
    wanted = written(classes.join(families, "node").join(broadcast_if_small(sizes), "family"),
                     "near-wanted")
    with few_rows(docs.sparkSession):
        links = written(joining_pairs(block_pairs(
            shingle_arrays(docs, wanted), "family", F.col("k"), FAMILY_BLOCK),
            "family", "shingles"), "near-links")
    groups = written(components(links, "a", "b"), "near-groups")

    named = classes.join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    ids = written(named.groupBy("component").agg(F.min("doc_id").alias("component_id")),
                  "near-ids")
    by_fp = broadcast_if_small(written(
        named.join(ids, "component").select("fp", "component_id"), "near-by-fp"))
    return sets.select("doc_id", "n", "fp").join(by_fp, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each group, the one with the smallest doc_id; all columns stay.

    Of repeated rows of a doc_id one stays. Rows without a doc_id can't be named and all stay, as
    do documents without shingles.
    """
    groups = near_groups(docs).where("doc_id is not null")
    chosen = broadcast_if_small(written(groups.where("doc_id = component_id").groupBy(
        F.col("doc_id").alias("__id")).agg(F.count("*").alias("__rows")), "near-chosen"))
    kept = docs.join(chosen, docs["doc_id"].cast("bigint") == F.col("__id"))
    single, repeated = kept.where("__rows = 1"), kept.where("__rows > 1")
    return single.union(repeated.dropDuplicates(["__id"])).select(*docs.columns).union(
        docs.where("doc_id is null"))
