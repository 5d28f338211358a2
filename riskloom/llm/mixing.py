"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, how often the mix should take it. Of all rates that give each source
its target of words, with none above `most`, those are chosen that stay closest to taking every
document once, in relative entropy: documents are tilted exponentially by the words they bring,
rate = min(most, exp(tilt * words)), with one tilt per source. The tilts solve the convex dual of
that problem. It is separable by source, so Newton steps for all sources are taken together, each
by one distributed aggregate over the counts of documents of each size; a step that leaves the
interval known to hold the solution is replaced by its middle.

Rates are rounded to whole copies in blocks: the rows of a source are dealt evenly into blocks of
bounded size, and within a block longest documents come first and each takes the number of copies
that brings the words taken nearest to the words due so far; then single copies are added or left
out while that comes nearer. So a block is off by less than half of its shortest document, unless
all that could make up for it are taken as often as allowed.

Sums are whole numbers, so reruns agree whatever the order of the tasks.

Edge cases: a null text has no words. A document without words is taken with zero words. Null is a
source of its own, the last one. Repeated rows are documents of their own. A table without words
has targets of zero; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.scratch import written

MOST = 3  # copies of a document, and words of a source against its size
ONE, COARSE = 1 << 30, 1 << 10  # sums are of whole multiples of 1 / ONE, slopes of 1 / COARSE
BLOCK_ROWS = 50_000
ROUNDS = 60  # Newton needs about five; the middle of the interval gains one bit a round
NEAR = 1e-7  # share of the target that the rates may miss


def word_count(text: str):
    """Number of words `[^\\x20\\x09-\\x0D]+` of a column of texts, null as none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")),
                      F.lit(0)).cast("bigint")


def numbered(keys: DataFrame, by: str) -> DataFrame:
    """`keys` (distinct, ascending by `by`, null last) with `place` from 0. Sorted in ranges:
    no task holds them all; the driver sees one count per range."""
    ordered = written(
        keys.repartitionByRange(F.col(by).asc_nulls_last())
        .sortWithinPartitions(F.col(by).asc_nulls_last())
        .withColumn("range", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "mix-order")
    before, starts = 0, []
    for r in sorted(ordered.groupBy("range").count().collect()):
        starts.append((r["range"], before))
        before += r["count"]
    offsets = keys.sparkSession.createDataFrame(starts, "range int, before bigint")
    return ordered.join(F.broadcast(offsets), "range").withColumn(
        "place", F.col("before") + F.col("at")).drop("range", "before", "at")


def targets(sources: DataFrame, most: float = MOST) -> DataFrame:
    """source, words, weight with `target`: the words of all sources shared by weight, no source
    above `most` times its own, the excess shared again among the others until none is above."""
    capped = sources.withColumn("full", F.lit(False))
    while True:
        total, held, weight = capped.agg(
            F.sum("words").cast("double"),
            F.sum(F.when(F.col("full"), F.col("words"))).cast("double"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).cast("double")).first()
        left = (total or 0.0) - most * (held or 0.0)
        share = F.lit(left) * F.col("weight") / F.lit(weight or 1.0)
        given = written(capped.withColumn("target", F.when(
            F.col("full"), F.col("words") * F.lit(float(most))).otherwise(share)), "mix-targets")
        over = ~F.col("full") & (F.col("target") > F.col("words") * F.lit(float(most)))
        if given.where(over).isEmpty():
            return given.drop("full")
        capped = given.withColumn("full", F.col("full") | over).drop("target")


def _rate(tilt: str, size: str, most: float):
    return F.least(F.lit(float(most)), F.exp(F.least(F.col(tilt) * F.col(size), F.lit(700.0))))


def solve_tilts(sizes: DataFrame, wanted: DataFrame, most: float = MOST) -> DataFrame:
    """source, tilt: `sizes` has source, size, docs (documents of that size); `wanted` has
    source, words, target.

    A source due `most` times its words, or none at all, has no finite tilt: it gets `most`, or
    nothing, for every document with words, as an infinite one.
    """
    full = F.col("target") >= F.col("words") * F.lit(float(most))
    # at the upper end every document with a word has reached `most`; at the lower end even
    # documents of one word have too low a rate
    high = F.log(F.lit(float(most))) + 1
    low = F.least(F.log(F.col("target") / F.col("words")), F.lit(0.0)) - 1
    state = written(wanted.withColumn("tilt", F.when(
        full & (F.col("words") > 0), F.lit(float("inf"))).when(
        F.col("target") <= 0, F.lit(float("-inf"))).otherwise(F.lit(0.0)))
        .withColumn("low", F.when(F.col("tilt") == 0, low)).withColumn("high", high)
        .withColumn("done", F.col("tilt") != 0), "mix-tilts")
    for _ in range(ROUNDS):
        open_ = state.where("not done").select("source", "target", "tilt", "low", "high")
        if open_.isEmpty():
            break
        rate = _rate("tilt", "size", most)
        mass = (F.col("docs") * F.col("size")).cast("decimal(18,0)")
        bend = F.when(rate < most, rate).otherwise(0.0) * F.col("size") * COARSE
        sums = (sizes.join(open_, sizes["source"].eqNullSafe(open_["source"]))
                .groupBy(open_["source"].alias("of"))
                .agg(F.sum(mass * F.round(rate * ONE).cast("decimal(19,0)")).alias("taken"),
                     F.sum(mass * F.round(bend).cast("decimal(19,0)")).alias("curve")))
        taken = F.col("taken").cast("double") / ONE
        gap = taken - F.col("target")
        curve = F.col("curve").cast("double") / COARSE
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        # a step on log(taken), which is nearly straight for sums of exponentials
        step = F.col("tilt") - F.when((taken > 0) & (curve > 0), F.log(taken / F.col("target"))
                                      * taken / curve)
        inside = F.coalesce((step > low) & (step < high), F.lit(False))
        stepped = F.when(inside, step).otherwise((low + high) / 2)
        met = F.abs(gap) <= NEAR * F.col("target")
        moved = F.coalesce(~met, F.lit(False))
        state = written(
            state.join(sums, state["source"].eqNullSafe(sums["of"]), "left").select(
                "source", "words", "target",
                F.when(moved & ~F.col("done"), stepped).otherwise(F.col("tilt")).alias("tilt"),
                F.when(moved, low).otherwise(F.col("low")).alias("low"),
                F.when(moved, high).otherwise(F.col("high")).alias("high"),
                (F.col("done") | ~moved).alias("done")), "mix-tilts")
    return state.select("source", "tilt")


def round_copies(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of one block (`docs` documents alike, their size and rate) with their `copies`;
    of documents that are alike some may get one copy more than the others."""
    rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], na_position="last",
                            kind="stable")
    size, alike = rows["size"].to_numpy(np.int64), rows["docs"].to_numpy(np.int64)
    due = taken = 0.0
    copies = []
    for s, rate, k in zip(size.tolist(), rows["rate"].tolist(), alike.tolist(), strict=True):
        due += rate * s * k
        n = min(max(round((due - taken) / s), 0), MOST * k) if s else 0
        taken += n * s
        copies.append(n)
    copies = np.array(copies, np.int64)
    while True:  # one copy more or less, as long as that comes nearer
        off = due - taken
        free = (copies < MOST * alike) if off > 0 else (copies > 0)
        nearer = np.where(free & (size > 0), np.abs(abs(off) - size), np.inf)
        at = nearer.argmin()
        if not nearer[at] < abs(off):
            break
        step = 1 if off > 0 else -1
        copies[at] += step
        taken += step * float(size[at])
    more = copies % alike
    parts = [rows.assign(copies=copies // alike, docs=alike - more),
             rows.assign(copies=copies // alike + 1, docs=more)[more > 0]]
    return pd.concat(parts)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies: one row per document.

    Sources by code point, null last, weigh `weights` in turn. What moves is doc_id, source and
    size, not texts.
    """
    narrow = written(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count("text").alias("size")).groupBy("doc_id", "source", "size").agg(
        F.count("*").alias("docs")), "mix-sizes")
    sizes = written(narrow.groupBy("source", "size").agg(F.sum("docs").alias("docs")), "mix-counts")
    sources = numbered(sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("words"), F.sum("docs").alias("rows")), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.col("place") % len(weights) + 1).cast("int"))
    wanted = written(targets(sources.withColumn("weight", weight)), "mix-wanted")
    tilts = solve_tilts(sizes, wanted.select("source", "words", "target"))
    per_source = wanted.join(
        tilts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.coalesce("of", F.lit("")).alias("of"), F.col("of").isNull().alias("none"),
        F.col("words").alias("source_size"), "target", "tilt",
        F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks"))
    # the sources' side is aggregated, the documents' side comes straight from a table
    key = (F.coalesce("source", F.lit("")) == F.col("of")) & (
        F.col("source").isNull() == F.col("none"))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(_rate("tilt", "size", MOST))
    rated = narrow.join(per_source, key).select(
        "doc_id", "source", "size", "docs", "source_size", "target", rate.alias("rate"),
        F.pmod(F.xxhash64("doc_id", "size"), "blocks").alias("block"))
    rounded = rated.groupBy("source", "block").applyInPandas(
        lambda rows: round_copies(rows).drop(columns="block").astype({"doc_id": "Int64"}),
        "doc_id bigint, source string, size bigint, docs bigint, source_size bigint, "
        "target double, rate double, copies int")
    # a row per document; in steps, for rows that occur very often
    of_step = F.least(F.lit(BLOCK_ROWS), F.col("docs") - F.col("step"))
    return rounded.withColumn("step", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("docs") - 1, F.lit(BLOCK_ROWS).cast("bigint")))).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies",
        F.explode(F.sequence(F.lit(1).cast("bigint"), of_step)).alias("_")).drop("_")


def take_copies(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The mix itself: every document as often as it is taken, with `copy` from 0. doc_id has to be a
    key; documents without one or without words are left out."""
    kept = mix(docs, weights).where("copies > 0").select(
        F.col("doc_id").alias("taken_id"), F.explode(F.sequence(
            F.lit(0), F.col("copies") - 1)).alias("copy"))
    return docs.join(kept, docs["doc_id"] == kept["taken_id"]).drop("taken_id")


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).alias("taken"))
