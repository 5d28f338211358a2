"""Approximate nearest neighbours by inner product: a graph per shard, results merged.

Equal vectors are indexed once. Vectors are dealt evenly into shards; each shard gets a
hierarchical navigable small-world graph: node levels are drawn from the hash of the vector, nodes
are inserted in an order of falling level, in batches that double the graph, each linked to a
diverse choice of what a beam search finds. A layer is one flat array of neighbours, so an index is
two or three binary columns, written once. Maximum inner product becomes nearest distance by one
more coordinate, which makes all indexed vectors equally long.

Queries go to every shard in blocks; a beam search down the layers finds candidates, whose scores
are then computed in double precision on the original vectors. Recall is measured against brute
force in the tests.

Edge cases: vectors that are null, empty, zero, of another length than most, or that hold null or
non-finite components take no part. Equal scores go to the smaller vec_id; where more vectors tie at
the last place than a search holds, the shard's vectors are all compared for that query. Of rows repeated with
vec_id and vector one counts. With fewer candidates than k all are returned; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.scratch import written

LINKS = 24            # neighbours of a node on the upper layers; twice as many on layer 0
BEAM = 128            # candidates held while inserting and while searching
LEVEL_FACTOR = 16     # nodes of a layer per node of the next
SHARD_VECTORS = 16_384
QUERY_BLOCK = 16_384
STEP = 256            # queries searched together


def beam_search(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the `beam` nearest nodes found from its entry nodes, nearest first: node
    numbers (-1: none) and squared distances up to a constant of the query.

    All queries advance together; in each step every query expands its nearest open candidates.
    """
    q, n = len(queries), len(points)
    norms = np.einsum("ij,ij->i", points, points)
    seen = np.zeros((q, n + 1), np.bool_)
    seen[:, n] = True  # stands for "no neighbour"

    def distances(nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return norms[nodes] - 2 * np.einsum("ijk,ik->ij", points[nodes], queries[rows])

    ids = np.full((q, beam), n)
    dist = np.full((q, beam), np.inf, np.float32)
    closed = np.ones((q, beam), np.bool_)
    width = entry.shape[1]
    ids[:, :width] = np.where(entry < 0, n, entry)
    dist[:, :width] = np.where(entry < 0, np.inf, distances(np.maximum(entry, 0), np.arange(q)))
    closed[:, :width] = entry < 0
    np.put_along_axis(seen, ids[:, :width], True, 1)
    active = np.arange(q)
    while len(active):
        first = np.where(closed[active], np.inf, dist[active])
        best = np.argpartition(first, 2, axis=1)[:, :3]  # up to three candidates at a time
        usable = np.isfinite(np.take_along_axis(first, best, 1))
        going = usable.any(axis=1)
        active, best, usable = active[going], best[going], usable[going]
        if not len(active):
            break
        closed[active[:, None], best] = True
        around = links[np.where(usable, ids[active[:, None], best], n)].reshape(len(active), -1)
        around = np.sort(np.where(seen[active[:, None], around], n, around), axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = n
        seen[active[:, None], around] = True
        fresh = np.where(around < n, distances(np.minimum(around, n - 1), active), np.inf)
        all_dist = np.concatenate([dist[active], fresh], axis=1)
        top = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        dist[active] = np.take_along_axis(all_dist, top, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], around], axis=1), top, 1)
        closed[active] = np.take_along_axis(
            np.concatenate([closed[active], ~np.isfinite(fresh)], axis=1), top, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    return np.where(np.isfinite(dist), ids, -1), dist


def diverse(points: np.ndarray, centre: int, found: np.ndarray, dist: np.ndarray,
            most: int) -> np.ndarray:
    """Of `found`, nearest first, those nearer to the centre than to any one chosen before; the
    nearest of the rest fill up."""
    among = points[found]
    between = np.einsum("ij,ij->i", among, among)
    between = between[:, None] + between[None, :] - 2 * among @ among.T
    chosen: list[int] = []
    nearest = np.full(len(found), np.inf)
    for i in range(len(found)):
        if dist[i] < nearest[i]:
            chosen.append(i)
            if len(chosen) == most:
                break
            np.minimum(nearest, between[i], out=nearest)
    if len(chosen) < most:
        rest = np.setdiff1d(np.arange(len(found)), chosen)[:most - len(chosen)]
        chosen += rest.tolist()
    return found[chosen]


def insert_layer(points: np.ndarray, most: int, entries) -> np.ndarray:
    """The neighbour array of one layer over the first nodes; row n stands for no node.
    `entries(rows)` gives where the search for these nodes starts."""
    n = len(points)
    links = np.full((n + 1, most), n)
    norms = np.einsum("ij,ij->i", points, points)
    done = min(n, 2 * most + 1)
    first = norms[:done, None] + norms[None, :done] - 2 * points[:done] @ points[:done].T
    np.fill_diagonal(first, np.inf)
    order = np.argsort(first, axis=1, kind="stable")[:, :max(done - 1, 0)]
    pending = [(i, order[i], first[i, order[i]]) for i in range(done)]
    while pending:
        backward: dict[int, list[int]] = {}
        for i, found, dist in pending:
            if len(found):
                chosen = diverse(points, i, found, dist, most)
                links[i, :len(chosen)] = chosen
                for j in chosen:
                    backward.setdefault(int(j), []).append(i)
        for j, new in backward.items():  # links go both ways; the diverse ones stay
            both = np.unique(np.concatenate([links[j][links[j] < n], new]))
            if len(both) > most:
                dist = norms[both] + norms[j] - 2 * points[both] @ points[j]
                near = np.argsort(dist, kind="stable")
                both = diverse(points, j, both[near], dist[near], most)
            links[j] = n
            links[j, :len(both)] = both
        pending, batch = [], np.arange(done, min(n, 2 * done, done + 4096))
        for at in range(0, len(batch), STEP):
            rows = batch[at:at + STEP]
            found, dist = beam_search(points[:done], np.minimum(links[:done + 1], done),
                                      points[rows], np.minimum(entries(rows), done - 1), BEAM)
            dist += norms[rows, None]
            pending += [(i, f[f >= 0], d[f >= 0])
                        for i, f, d in zip(rows, found, dist, strict=True)]
        done += len(batch)
    return links


def build_graph(vectors: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order in which nodes are numbered, and the layers, lowest first. `draw`: a hash."""
    level = np.zeros(len(vectors), np.int64)
    while len(level) and level.max() < 3:  # a share of 1 / LEVEL_FACTOR of each layer goes higher
        up = (level == level.max()) & (draw % LEVEL_FACTOR == 0)
        if not up.any() or up.all():
            break
        draw = draw // LEVEL_FACTOR
        level[up] += 1
    order = np.argsort(-level, kind="stable")
    level, points = level[order], vectors[order]
    layers: list[np.ndarray] = []
    for height in range(int(level.max(initial=0)), -1, -1):
        here = points[:int((level >= height).sum())]
        above = list(layers)

        def entries(rows: np.ndarray, above=above) -> np.ndarray:
            return descend(points, above, points[rows])

        layers.insert(0, insert_layer(here, 2 * LINKS if height == 0 else LINKS, entries))
    return order, layers


def descend(points: np.ndarray, upper: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Entry nodes for the layer below `upper` (lowest first): the nearest few of each layer."""
    entry = np.zeros((len(queries), 1), np.int64)
    for links in reversed(upper):
        n = len(links) - 1
        found, _ = beam_search(points[:n], links, queries, entry, 8)
        entry = found[:, :4]
    return entry


def search(points: np.ndarray, layers: list[np.ndarray], queries: np.ndarray,
           beam: int) -> np.ndarray:
    """Node numbers of up to `beam` nearest nodes per query, -1 where there are fewer."""
    if not len(points):
        return np.full((len(queries), beam), -1)
    out = [beam_search(points, layers[0], q, descend(points, layers[1:], q), beam)[0]
           for q in (queries[k:k + STEP] for k in range(0, len(queries), STEP))]
    return np.concatenate(out)


def augmented(vectors: np.ndarray) -> np.ndarray:
    """One more coordinate makes all vectors equally long: the nearest is then the one of largest
    inner product."""
    square = np.einsum("ij,ij->i", vectors.astype(np.float64), vectors.astype(np.float64))
    more = np.sqrt(np.maximum(square.max(initial=0) - square, 0))
    return np.hstack([vectors, more[:, None]]).astype(np.float32)


def inner(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products in double precision of each query with its own row of vectors."""
    return np.einsum("ijk,ik->ij", vectors.astype(np.float64), queries.astype(np.float64))


def best_nodes(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, queries: np.ndarray,
               k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query its k best nodes of largest score, ties to the smaller id, and their scores.

    `near` holds the nodes that the graph search found. Where the k-th score reaches down to the
    last node found, up to the search's single precision, more nodes than were found may have it:
    then all nodes of the shard that reach it take part.
    """
    longest = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64).max(initial=0))
    for at in range(0, len(queries), STEP):
        asked, found = queries[at:at + STEP], near[at:at + STEP]
        score = inner(vectors[np.maximum(found, 0)], asked)
        slack = 1e-5 * longest * np.sqrt(np.einsum("ij,ij->i", asked, asked, dtype=np.float64))
        for query, nodes, points, room in zip(asked, found, score, slack, strict=True):
            nodes, points = nodes[nodes >= 0], points[nodes >= 0]
            if k <= len(nodes) < len(vectors):
                least = np.partition(points, -k)[-k]
                if points.min() >= least - room:
                    rough = vectors.astype(np.float64) @ query.astype(np.float64)
                    nodes = np.flatnonzero(rough >= least - room)
                    points = inner(vectors[None, nodes], query[None])[0]
            best = np.lexsort((ids[nodes], -points))[:k]
            yield nodes[best], points[best]


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, vec (array of float, or double where it is given so) of the rows that take part, each
    pair once."""
    given = embeddings.schema["embedding"].dataType
    double = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.DoubleType)
    vec = F.col("embedding").cast("array<double>" if double else "array<float>")
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
                      & F.exists("vec", lambda x: x != 0))
    length = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (length["d"] if length else 0)).dropDuplicates()


def _number(rows: DataFrame) -> type:
    double = isinstance(rows.schema["vec"].dataType.elementType, T.DoubleType)
    return np.float64 if double else np.float32


def build_index(distinct: DataFrame, shards: int) -> DataFrame:
    """One row per shard: shard, n, dims, keys, ids, vectors, layers (all arrays flat)."""
    kind = _number(distinct)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "vec_id"], ignore_index=True)
        vectors = np.array(rows["vec"].tolist(), kind)
        keys, ids = rows["key"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64)
        draw = keys.view(np.uint64) >> np.uint64(8)
        order, layers = build_graph(augmented(vectors), draw)
        return pd.DataFrame([{
            "shard": int(rows["shard"].iloc[0]), "n": len(keys), "dims": vectors.shape[1],
            "keys": keys[order].tobytes(), "ids": ids[order].tobytes(), "vectors": vectors[order].tobytes(),
            "layers": [x.astype("<i4").tobytes() for x in layers]}])

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(
        run, "shard int, n int, dims int, keys binary, ids binary, vectors binary, "
             "layers array<binary>")


def search_shards(index: DataFrame, queries: DataFrame, k: int, shards: int,
                  blocks: int) -> DataFrame:
    """query_id, key, first_id, score: the k best distinct vectors of every shard for every query.
    Each block of queries meets each shard once."""
    kind = _number(queries)

    def run(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "key": [], "first_id": [], "score": []}).astype(
            {"query_id": "int64", "key": "int64", "first_id": "int64", "score": "float64"})
        if not len(found) or not len(asked):
            return empty
        row = found.iloc[0]
        n, dims = int(row["n"]), int(row["dims"])
        vectors = np.frombuffer(row["vectors"], kind).reshape(n, dims)
        keys, firsts = (np.frombuffer(row[c], np.int64) for c in ("keys", "ids"))
        points, layers, left = augmented(vectors), [], row["layers"]
        for i, raw in enumerate(left):
            layers.append(np.frombuffer(raw, "<i4").reshape(
                -1, 2 * LINKS if i == 0 else LINKS).astype(np.int64))
        wanted = np.array(asked["vec"].tolist(), kind)
        flat = np.hstack([wanted, np.zeros((len(wanted), 1))]).astype(np.float32)
        near = search(points, layers, flat, max(BEAM, k))
        picked = list(best_nodes(vectors, firsts, near, wanted, k))
        nodes = np.concatenate([x for x, _ in picked])
        return pd.DataFrame({
            "query_id": np.repeat(asked["query_id"].to_numpy(), [len(x) for x, _ in picked]),
            "key": keys[nodes], "first_id": firsts[nodes],
            "score": np.concatenate([x for _, x in picked])})

    each = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    asked = queries.select("query_id", "vec", block, each)
    held = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    return held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        run, "query_id bigint, key bigint, first_id bigint, score double")


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each vector whose vec_id is
    divisible by `every`."""
    rows = usable(embeddings).withColumn("key", F.xxhash64("vec"))
    # of equal vectors the k + 1 smallest ids are all that any result can name
    same = Window.partitionBy("key", "vec").orderBy("vec_id")
    named = written(rows.withColumn("nth", F.row_number().over(same)).withColumn(
        "first_id", F.first("vec_id").over(same)).where(F.col("nth") <= k + 1), "ann-vectors")
    distinct = named.where("nth = 1").select("vec_id", "key", "vec")
    shards = max(1, -(-distinct.count() // SHARD_VECTORS))
    index = written(build_index(distinct, shards), "ann-index")
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "vec")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    found = search_shards(index, queries, k + 1, shards, blocks)
    # k + 1 vectors by score and smallest id hold the k best ids: one may have the query's id only
    merged = found.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy(
        F.desc("score"), "first_id", "key"))).where(F.col("nth") <= k + 1).drop("nth")
    hits = merged.join(named.select("key", "first_id", "vec_id"), ["key", "first_id"]).where(
        "vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.select("query_id", rank.alias("rank"), "vec_id", "score").where(
        F.col("rank") <= k)
