"""Deduplication, upserts and slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.bounded import BROADCAST_BYTES, broadcast_if_small, measured_bytes

VALIDITY = ["valid_from", "valid_to", "is_current"]


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever comes first. Duplicates shrink before the shuffle."""
    return df.dropDuplicates(list(keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by `order_by`, which should leave no ties.

    Spark keeps one row per key in each task before the shuffle (a group limit below the
    exchange), so a key that holds most of the input sends one row per task.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that is least by `order_by`, with the group limit of `dedup_latest`."""
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(keys))


def anti_join_new_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have.

    When the source's keys are small they go to the target first, so that only target keys
    the source asks about are shuffled.
    """
    keys = list(keys)
    asked, known = source.select(*keys), target.select(*keys)
    if measured_bytes(asked) <= BROADCAST_BYTES:
        known = known.join(F.broadcast(asked.distinct()), keys, "left_semi")
    return source.join(known, keys, "left_anti")


def merge_type1(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Upsert without history: matching keys take the source's values, new keys are added.

    The source is reduced to its latest row per key and must have non-null keys. Columns only
    the target has keep their value. A small source is broadcast, so a large target is
    scanned but not shuffled.
    """
    keys = list(keys)
    source = _keyed(source, keys)
    updates = dedup_latest(source, keys, order_by).select(
        *[c for c in source.columns if c in target.columns])
    small = broadcast_if_small(source.select(*keys).distinct())
    untouched = target.join(small, keys, "left_anti")
    kept = [c for c in target.columns if c not in updates.columns]
    if kept:
        matched = target.join(small, keys, "left_semi").select(*keys, *kept)
        updates = updates.join(matched, keys, "left")
    return untouched.unionByName(updates.select(*target.columns))


def _changed(tracked: Sequence[str], left: str, right: str) -> Column:
    """Whether any tracked column differs, NULL counting as a value."""
    changed = F.lit(False)
    for name in tracked:
        changed = changed | ~F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return changed


def merge_type2(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_date: str,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Apply a batch of changes to a history; returns the whole new history.

    `target` has the payload columns of `source` plus `valid_from`, `valid_to`, `is_current`
    and optionally `created_at` / `updated_at`. Of several source rows per key the latest
    counts (ties by `order_by`); NULL keys are left out. A changed row closes the current
    version at its effective date and opens a new one; a change dated before the current
    version starts is not applied (see `late_changes` and `merge_type2_backdated`). Running twice changes nothing.
    """
    keys = list(keys)
    payload = [c for c in source.columns if c != effective_date and c not in order_by]
    stamps = [c for c in ("created_at", "updated_at") if c in target.columns]
    source = _keyed(source, keys)
    latest = dedup_latest(source, keys, [effective_date, *order_by])

    history = target.filter(~F.coalesce("is_current", F.lit(False)))
    current = target.filter("is_current")
    change = latest.select(*keys, F.struct(*payload, effective_date).alias("new"))
    # the source before deduplication bounds the size from above and needs no shuffle
    if measured_bytes(source) <= BROADCAST_BYTES:
        change = F.broadcast(change)

    paired = current.select(*keys, F.struct(*target.columns).alias("old")).join(
        change, keys, "left")
    applies = (F.col("new").isNotNull()
               & _changed(tracked, "old", "new")
               & (F.col(f"new.{effective_date}") >= F.col("old.valid_from")))

    def version(values: dict[str, Column], base: str) -> Column:
        return F.struct(*[
            values.get(c, F.col(f"{base}.{c}")).alias(c) for c in target.columns])

    def opened(base: str) -> dict[str, Column]:
        date = F.col(f"{base}.{effective_date}" if base else effective_date)
        types = dict(target.dtypes)
        absent = {c: F.lit(None).cast(types[c]) for c in target.columns
                  if c not in payload and c not in VALIDITY and c not in stamps}
        return absent | {
            "valid_from": date.cast(types["valid_from"]),
            "valid_to": F.lit(None).cast(types["valid_to"]),
            "is_current": F.lit(True),
        } | {c: F.current_timestamp() for c in stamps}

    closed = {"valid_to": F.col(f"new.{effective_date}"), "is_current": F.lit(False)}
    if "updated_at" in stamps:
        closed["updated_at"] = F.current_timestamp()
    versions = paired.select(F.explode(
        F.when(applies, F.array(version(closed, "old"), version(opened("new"), "new")))
         .otherwise(F.array(F.col("old")))
    ).alias("row")).select("row.*")

    unseen = anti_join_new_keys(latest, current, keys).withColumns(
        {c: v for c, v in opened("").items()}).select(*target.columns)
    return history.unionByName(versions).unionByName(unseen)


def merge_type2_backdated(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_date: str,
    order_by: Sequence[str] = (),
    observed: str | None = None,
) -> DataFrame:
    """Apply changes of any date to a history: a change inside it cuts the version that covers its
    date and lasts until the next version starts. Returns the whole new history.

    All source rows count, one per key and date (the last by `order_by`); rows without a key or a
    date are left out. A row that repeats the state before it opens no version; a change that makes
    the next version repeat it swallows that version. Gaps and ends of the history stay. A source
    row takes the place of a version that starts on its date.

    With `observed`, the name of an array column that `target` has or gets, every version keeps the
    dates, order and untracked values of the source rows it stands for. Any split of a feed into
    batches, in any order, then gives the history of `scd2_from_feed` over the whole feed; without
    it a row that repeated a state is forgotten and can't reappear behind a later insertion.

    Only versions of the source's keys are shuffled, once, and a key holds at most one row per
    calendar day of its history and its source. Running twice changes nothing.
    """
    keys, order_by = list(keys), list(order_by)
    types = dict(target.dtypes)
    source_types = dict(source.dtypes)
    payload = [c for c in target.columns if c in source_types and c not in keys]
    untracked = [c for c in payload if c not in tracked]
    stamps = [c for c in ("created_at", "updated_at") if c in types and c not in payload]
    noted = [c for c in dict.fromkeys([effective_date, *order_by, *untracked])]
    note_type = ", ".join(f"`{c}`: {types.get(c) or source_types[c]}" for c in noted)
    if observed and observed not in types:
        target = target.withColumn(observed, F.lit(None).cast(f"array<struct<{note_type}>>"))

    source = _keyed(source, [*keys, effective_date])
    daily = dedup_latest(
        source, [*keys, effective_date],
        order_by or sorted(c for c in source.columns if c not in (*keys, effective_date)))
    touched = source.select(*keys).distinct()
    if measured_bytes(source.select(*keys)) <= BROADCAST_BYTES:
        touched = F.broadcast(touched)
    untouched = target.join(touched, keys, "left_anti")
    versions = target.join(touched, keys, "left_semi")

    # points in time: what the source and the versions observed, and where a version ended
    first = F.struct(*[
        (F.col("valid_from") if c == effective_date
         else F.col(c) if c in untracked else F.lit(None)).cast(
             types.get(c) or source_types[c]).alias(c) for c in noted])
    notes = F.array(first)
    if observed:
        notes = F.when(F.size(observed) > 0, F.col(observed)).otherwise(notes)
    state = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in tracked])
    held = F.struct(*target.columns)
    none_held = F.lit(None).cast(versions.select(held.alias("v")).schema["v"].dataType)
    old = versions.select(*keys, state.alias("_state"), held.alias("_held"),
                          F.explode(notes).alias("_note")).select(
        *keys, "_state", "_note", F.lit(1).alias("_rank"),
        F.when(F.col(f"_note.{effective_date}") == F.col("_held.valid_from"),
               F.col("_held")).alias("_held"))
    ends = versions.where("valid_to IS NOT NULL").select(
        *keys, F.lit(None).cast(versions.select(state.alias("s")).schema["s"].dataType)
        .alias("_state"),
        F.struct(*[(F.col("valid_to") if c == effective_date else F.lit(None)).cast(
            types.get(c) or source_types[c]).alias(c) for c in noted]).alias("_note"),
        F.lit(0).alias("_rank"), none_held.alias("_held"))
    new = daily.select(
        *keys, state.alias("_state"),
        F.struct(*[F.col(c).cast(types.get(c) or source_types[c]).alias(c) for c in noted])
        .alias("_note"), F.lit(2).alias("_rank"), none_held.alias("_held"))

    date = F.col(f"_note.{effective_date}")
    # an end gives way to what starts on its date; then order decides, then the batch at hand
    timeline = Window.partitionBy(*keys).orderBy("_date")
    preferred = Window.partitionBy(*keys).orderBy(
        "_date", (F.col("_rank") > 0).desc(),
        *[F.col(f"_note.{c}").desc_nulls_last() for c in order_by], F.col("_rank").desc(),
        F.col("_held.valid_to").desc_nulls_first())
    points = (
        old.unionByName(ends).unionByName(new).withColumn("_date", date)
        .withColumn("_same", F.lag("_date").over(preferred))
        .where("_same IS NULL OR _same <> _date")
        .withColumn("_before", F.lag(F.struct(F.col("_state").alias("s"))).over(timeline))
        .withColumn("_run", F.sum(F.when(
            F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(F.col("_state")), 1)
            .otherwise(0)).over(timeline)))
    runs = points.groupBy(*keys, "_run").agg(
        F.min("_date").alias("_from"),
        F.min_by(F.struct("_state", "_note", "_held"), "_date").alias("_first"),
        F.array_sort(F.collect_list("_note")).alias("_notes"),
    ).withColumn("_to", F.lead("_from").over(Window.partitionBy(*keys).orderBy("_run"))).where(
        "_first._state IS NOT NULL")

    until = F.col("_to").cast(types["valid_to"])
    kept = F.col("_first._held")
    # a version whose dates and values stay as they are keeps its stamp
    same = kept.isNotNull() & kept["valid_to"].eqNullSafe(until)
    for c in payload:
        value = F.col("_first._note" if c in untracked else "_first._state")[c]
        same = same & kept[c].eqNullSafe(value)
    values = {
        "valid_from": F.col("_from").cast(types["valid_from"]), "valid_to": until,
        "is_current": F.col("_to").isNull(),
        **{c: F.col("_first._state")[c] for c in tracked},
        **{c: F.col("_first._note")[c] for c in untracked},
        **{c: F.col(c) for c in keys}}
    if observed:
        values[observed] = F.col("_notes")
    if "created_at" in stamps:
        values["created_at"] = F.coalesce(kept["created_at"], F.current_timestamp())
    if "updated_at" in stamps:
        values["updated_at"] = F.when(same, kept["updated_at"]).otherwise(F.current_timestamp())
    spliced = runs.select(*[
        values.get(c, kept[c]).alias(c) for c in target.columns])
    return untouched.unionByName(spliced)


def late_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], effective_date: str
) -> DataFrame:
    """Source rows dated before their key's current version, which `merge_type2` leaves out.

    `merge_type2_backdated` places them in the history, as does `scd2_from_feed` over the whole
    feed.
    """
    current = target.filter("is_current").select(*keys, F.col("valid_from").alias("_from"))
    return (source.join(current, list(keys))
                  .filter(F.col(effective_date) < F.col("_from")).drop("_from"))


def scd2_from_feed(
    feed: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective_date: str,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Full history from a feed with many rows per key; order and repeats do not matter.

    Rows of one key and date collapse to the last by `order_by` before the per-key window, so
    a key holds at most one row per calendar day however many rows the feed has for it.
    """
    keys = list(keys)
    daily = dedup_latest(
        _keyed(feed, [*keys, effective_date]), [*keys, effective_date],
        list(order_by) or sorted(c for c in feed.columns if c not in (*keys, effective_date)))
    timeline = Window.partitionBy(*keys).orderBy(effective_date)
    state = F.struct(*tracked)
    return (
        daily
        .withColumn("_before", F.lag(F.struct(state.alias("s"))).over(timeline))
        .filter(F.col("_before").isNull() | ~F.col("_before.s").eqNullSafe(state))
        .withColumn("valid_from", F.col(effective_date))
        .withColumn("valid_to", F.lead("valid_from").over(timeline))
        .withColumn("is_current", F.col("valid_to").isNull())
        .drop("_before", effective_date, *[c for c in order_by if c not in tracked])
    )


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def scd2_violations(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Broken history rules per key: current rows other than one, overlaps, backward intervals."""
    keys = list(keys)
    # equal rows first become one with a count, so a key holds distinct date pairs only
    spans = history.groupBy(*keys, "valid_from", "valid_to", "is_current").agg(
        F.count("*").alias("_n"))
    timeline = Window.partitionBy(*keys).orderBy("valid_from", F.col("valid_to").asc_nulls_last())

    def reaches(date: str) -> Column:
        """The row runs past the start of the one after it."""
        later = F.col("valid_to").isNull() | (F.col("valid_to") > F.col(date))
        return F.when(F.col(date).isNotNull() & later, 1).otherwise(0)

    per_key = spans.withColumn("_next", F.lead("valid_from").over(timeline)).groupBy(*keys).agg(
        F.sum(F.col("_n") * F.col("is_current").cast("int")).alias("current_rows"),
        F.sum(reaches("_next") + (F.col("_n") - 1) * reaches("valid_from"))
         .alias("overlapping_rows"),
        F.sum(F.when(F.col("valid_to") < F.col("valid_from"), F.col("_n")).otherwise(0))
         .alias("backward_intervals"))
    return per_key.filter("current_rows <> 1 OR overlapping_rows > 0 OR backward_intervals > 0")
