"""Change feeds and slowly changing dimensions.

Change rows are image columns plus `_change_type` (insert, update_preimage, update_postimage,
delete), `_commit_version` and `_commit_timestamp`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions import struct_of
from lakeops.operators.mutate import kept_still, latest_per_key, pair_up, update_where
from lakeops.operators.skew import BROADCAST_BYTES, broadcast_if_small, group_extent, range_slices

META = ("_change_type", "_commit_version", "_commit_timestamp")

# A key with more rows than this is sliced along its sequence (see _neighbours).
MAX_GROUP_ROWS = 5_000_000


def image_columns(changes: DataFrame) -> list[str]:
    return [c for c in changes.columns if c not in META]


def change_rows(before: Column, after: Column) -> Column:
    """The change rows of one key as an array of (`_change_type`, image), from its two images.

    NULL, so no rows once exploded, where the images are the same or both absent.
    """
    def row(kind: str, image: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), image.alias("_image"))

    return F.when(~before.eqNullSafe(after),
                  F.when(before.isNull(), F.array(row("insert", after)))
                  .when(after.isNull(), F.array(row("delete", before)))
                  .otherwise(F.array(row("update_preimage", before), row("update_postimage", after))))


def _unpacked(df: DataFrame, rows: Column) -> DataFrame:
    return df.select(F.explode(rows).alias("_r")).select("_r._image.*", "_r._change_type")


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows that lead from one snapshot to the other (without commit columns).

    Unchanged rows give none; keys must be unique in each snapshot.
    """
    paired = pair_up(before, after, keys)
    return _unpacked(paired, change_rows(F.col("_before"), F.col("_after")))


def insert_changes(rows: DataFrame) -> DataFrame:
    """Change rows of an INSERT: no comparison of snapshots needed."""
    return rows.withColumn("_change_type", F.lit("insert"))


def update_changes(current: DataFrame, set: Mapping[str, Column | str], where: Column | str) -> DataFrame:
    """Change rows of an UPDATE: old and new image of the rows it meets, row by row."""
    hit = current.where(where)
    columns = current.columns
    new = update_where(hit.withColumn("_old", struct_of(columns)), set)
    return _unpacked(new, F.array(
        F.struct(F.lit("update_preimage").alias("_change_type"), F.col("_old").alias("_image")),
        F.struct(F.lit("update_postimage").alias("_change_type"), struct_of(columns).alias("_image"))))


def delete_changes(current: DataFrame, where: Column | str) -> DataFrame:
    """Change rows of a DELETE."""
    return current.where(where).withColumn("_change_type", F.lit("delete"))


def read_changes(log: DataFrame, from_version: int | None = None, to_version: int | None = None,
                 from_ts: str | None = None, to_ts: str | None = None) -> DataFrame:
    """Changes within version and time bounds, both ends included.

    The bounds are plain filters on the commit columns; on a log partitioned by version only the
    wanted folders are read.
    """
    out = log
    if from_version is not None:
        out = out.where(F.col("_commit_version") >= from_version)
    if to_version is not None:
        out = out.where(F.col("_commit_version") <= to_version)
    if from_ts is not None:
        out = out.where(F.col("_commit_timestamp") >= F.lit(from_ts).cast("timestamp_ntz"))
    if to_ts is not None:
        out = out.where(F.col("_commit_timestamp") <= F.lit(to_ts).cast("timestamp_ntz"))
    return out


def changes_by_type(changes: DataFrame) -> DataFrame:
    """Number of change rows of each type."""
    return changes.groupBy("_change_type").agg(F.count(F.lit(1)).alias("count"))


def latest_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest image (or delete) of each key."""
    return latest_per_key(changes.where(F.col("_change_type") != "update_preimage"), keys,
                          ["_commit_version"])


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Bring a target up to date: only the newest change of a key counts. NULL keys compare equal.

    Touched keys leave the target by an anti join and come back from the changes unless deleted.
    Touched keys of at most `broadcast_bytes` (they are measured first) are broadcast, so that the
    target is not shuffled.
    """
    newest = latest_changes(changes, keys)
    touched = broadcast_if_small(changes.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct(), broadcast_bytes)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    kept = target.join(touched, same, "left_anti")
    return kept.unionByName(newest.where(F.col("_change_type") != "delete").select(*target.columns))


def audit_log(changes: DataFrame, keys: Sequence[str], user: Column | None = None) -> DataFrame:
    """Who changed which key, how and when."""
    return changes.select(*keys, "_change_type", "_commit_timestamp",
                          (user if user is not None else F.current_user()).alias("changed_by"))


def derive_operations(stream: DataFrame, is_insert: Column, value: str, factor: str) -> DataFrame:
    """Add `operation` and `updated_<value>`: an update scales the value, an insert keeps it."""
    kind = stream.schema[value].dataType
    scaled = F.round(F.col(value) * F.lit(factor).cast("decimal(10,4)"), 2).cast(kind)
    return (stream.withColumn("operation", F.when(is_insert, "INSERT").otherwise("UPDATE"))
            .withColumn(f"updated_{value}",
                        F.when(F.col("operation") == "UPDATE", scaled).otherwise(F.col(value))))


def scd1(feed: DataFrame, keys: Sequence[str], seq: Sequence[str], delete_when: Column | str) -> DataFrame:
    """Current row of each key by sequence, whatever the order of arrival; deleted keys are absent."""
    gone = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    return latest_per_key(feed, keys, seq).where(~F.coalesce(gone, F.lit(False)))


def _neighbours(rows: DataFrame, keys: Sequence[str], seq: Sequence[str], value: Column,
                name: str, ahead: bool, sliced: bool) -> DataFrame:
    """Add `value` of the previous (or with `ahead` the next) row of the key.

    Windows run within a `_slice` of a key. The row at the edge of a slice is copied over to the
    neighbouring slice of its key first, so the result is that of one window per key.
    """
    within = Window.partitionBy(*keys, "_slice").orderBy(*seq)
    near = F.lead(value).over(within) if ahead else F.lag(value).over(within)
    if not sliced:
        return rows.withColumn(name, near)
    edge = (F.min_by if ahead else F.max_by)(
        struct_of([c for c in rows.columns if c not in keys and c != "_slice"]), struct_of(seq))
    order = Window.partitionBy(*keys).orderBy("_slice")
    to = F.lag("_slice").over(order) if ahead else F.lead("_slice").over(order)
    copies = (rows.groupBy(*keys, "_slice").agg(edge.alias("_edge"))
              .withColumn("_slice", to).where(F.col("_slice").isNotNull())
              .select(*keys, "_slice", "_edge.*").withColumn("_copy", F.lit(True)))
    return (rows.withColumn("_copy", F.lit(False)).unionByName(copies)
            .withColumn(name, near).where(~F.col("_copy")).drop("_copy"))


def scd2(feed: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str],
         delete_when: Column | str, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Full history: one row per key and unbroken stretch of equal `columns`.

    Adds `_start_at` and `_end_at` (values of the first `seq` column) and `_is_current`. A delete
    closes the open row; repeated values do not open a new one. `seq` must be unique within a key;
    exact copies of a feed row do no harm.

    Key sizes are measured first (one pass over the keys). If no key is larger than
    `max_group_rows`, a window per key does; else rows are cut into range slices of key and
    sequence, so that a hot key is shared by many tasks.
    """
    gone = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    rows = feed.select(*keys, *seq, *[c for c in columns if c not in seq],
                       F.coalesce(gone, F.lit(False)).alias("_gone"))
    largest, total = group_extent(rows, keys)
    sliced = largest > max_group_rows
    if not sliced:
        rows = rows.withColumn("_slice", F.lit(0))
    else:
        shuffles = int(feed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slices = max(shuffles, -(-total // max_group_rows), 2)
        rows = range_slices(rows.distinct(), [*keys, *seq], slices).drop("_pos")
    state = struct_of(["_gone", *columns])
    seen = _neighbours(rows, keys, seq, state, "_prev", ahead=False, sliced=sliced)
    tracked = F.struct(*[F.col(f"_prev.{c}").alias(c) for c in columns])
    repeats = F.col("_prev").isNotNull() & (F.col("_prev._gone") == F.col("_gone")) & (
        F.col("_gone") | tracked.eqNullSafe(struct_of(columns)))
    turns = seen.where(~repeats).drop("_prev")
    spans = _neighbours(turns, keys, seq, F.col(seq[0]), "_end_at", ahead=True, sliced=sliced)
    return spans.where(~F.col("_gone")).select(
        *keys, *columns, F.col(seq[0]).alias("_start_at"), "_end_at",
        F.col("_end_at").isNull().alias("_is_current"))


def scd1_state(feed: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The newest row of each key, deletes included: what later batches are compared with."""
    return latest_per_key(feed, keys, seq)


def scd1_apply(state: DataFrame, batch: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """The state after a batch. Rows that come late, by `seq`, lose; keys the batch doesn't name pass by.

    Rows of deleted keys stay in the state; filter them for the current table. State and touched keys
    meet in one aggregation, which combines before its shuffle.
    """
    return latest_per_key(state.unionByName(batch), keys, seq)


def _timeline(feed: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str], delete_when: Column | str) -> DataFrame:
    gone = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
    return feed.select(*keys, *seq, *[c for c in columns if c not in seq and c not in keys],
                       F.coalesce(gone, F.lit(False)).alias("_gone")).dropDuplicates([*keys, *seq])


def _null_safe(left: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def scd2_splice(state: DataFrame, batch: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str],
                delete_when: Column | str, max_group_rows: int = MAX_GROUP_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of `state` that a batch changes, and its own: to replace those with the same keys and `seq`.

    A state has a row per feed row: keys, `seq`, `columns`, `_gone` (a delete), `_opens` (whether a stretch of
    equal `columns` begins with it) and, where it does, `_end_at`, the time the next one begins. Deletes and repeats stay in it, since a row
    that comes late may divide what they belong to. Of a key's rows only these are looked at: those between the batch's first and last,
    their predecessor and successor, and the row that opened the predecessor's stretch. Rows known already change nothing.
    """
    names = [*keys, *seq, *[c for c in columns if c not in seq and c not in keys], "_gone"]
    # What several steps read is kept: else each of them would read and shuffle the batch and the state again.
    fresh = kept_still(_timeline(batch, keys, seq, columns, delete_when))
    at = struct_of(seq)
    ends = fresh.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    ends = broadcast_if_small(kept_still(ends), broadcast_bytes)
    touched = state.join(ends, _null_safe(state, keys, "_k_"))
    near = touched.groupBy(*[F.col(k).alias(f"_n_{k}") for k in keys]).agg(
        F.max(F.when(at < F.col("_lo"), at)).alias("_before"),
        F.max(F.when((at < F.col("_lo")) & F.col("_opens"), at)).alias("_opener"),
        F.min(F.when(at > F.col("_hi"), at)).alias("_behind"))
    near = broadcast_if_small(kept_still(near), broadcast_bytes)
    inside = (at >= F.coalesce("_before", "_lo")) & (at <= F.coalesce("_behind", "_hi"))
    met = touched.join(near, _null_safe(touched, keys, "_n_")).where(inside | at.eqNullSafe(F.col("_opener")))
    old = met.select(*names, F.col("_opens").alias("_opened"), F.col("_end_at").alias("_ended"),
                     F.coalesce(at < F.col("_lo"), F.lit(False)).alias("_fixed"))
    added = fresh.select(*names, F.lit(None).cast("boolean").alias("_opened"),
                         F.lit(None).cast(state.schema["_end_at"].dataType).alias("_ended"), F.lit(False).alias("_fixed"))
    # Of a row that both have, the state's stays.
    rows = kept_still(latest_per_key(old.unionByName(added).withColumn("_known", F.col("_opened").isNotNull()), [*keys, *seq], ["_known"]).drop("_known"))

    largest, total = group_extent(rows, keys)
    sliced = largest > max_group_rows
    if sliced:
        shuffles = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = range_slices(rows, [*keys, *seq], max(shuffles, -(-total // max_group_rows), 2)).drop("_pos")
    else:
        rows = rows.withColumn("_slice", F.lit(0))
    seen = _neighbours(rows, keys, seq, struct_of(["_gone", *columns]), "_prev", ahead=False, sliced=sliced)
    tracked = F.struct(*[F.col(f"_prev.{c}").alias(c) for c in columns])
    repeats = F.col("_prev").isNotNull() & (F.col("_prev._gone") == F.col("_gone")) & (F.col("_gone") | tracked.eqNullSafe(struct_of(columns)))
    seen = seen.withColumn("_opens", F.when(F.col("_fixed"), F.col("_opened")).otherwise(~repeats)).drop("_prev")
    spans = _spans_sliced(seen, rows, keys, seq) if sliced else _spans(seen, keys, seq)
    changed = ~F.col("_opens").eqNullSafe(F.col("_opened")) | ~F.col("_end_at").eqNullSafe(F.col("_ended"))
    return spans.where(changed).select(*names, "_opens", "_end_at")


def _spans(seen: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Add `_end_at` to the rows that open a stretch, in windows that share the one shuffle of `_neighbours`.

    What the last stretch ends with here is what the last one ended with before.
    """
    of_key = Window.partitionBy(*keys, "_slice")
    behind = of_key.orderBy(*[F.desc(c) for c in seq]).rowsBetween(Window.unboundedPreceding, -1)
    following = F.last(F.when(F.col("_opens"), F.struct(F.col(seq[0]).alias("at"))), ignorenulls=True).over(behind)
    last = F.max(F.when(F.col("_opened"), F.struct(struct_of(seq).alias("at"), F.col("_ended").alias("ended")))).over(of_key)
    return seen.withColumn("_next", following).withColumn("_last", last).withColumn("_end_at", F.when(
        F.col("_opens"), F.when(F.col("_next").isNotNull(), F.col("_next.at")).otherwise(F.col("_last.ended"))))


def _spans_sliced(seen: DataFrame, rows: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """`_spans` of rows whose keys lie in several slices."""
    seen = kept_still(seen)
    tails = rows.where("_opened").groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys]).agg(F.max_by("_ended", struct_of(seq)).alias("_tail"))
    opened = _neighbours(seen.where("_opens"), keys, seq, F.struct(F.col(seq[0]).alias("at")), "_next", ahead=True, sliced=True)
    opened = (opened.join(tails, _null_safe(opened, keys, "_t_"), "left")
              .withColumn("_end_at", F.when(F.col("_next").isNotNull(), F.col("_next.at")).otherwise(F.col("_tail")))
              .select(*seen.columns, "_end_at"))
    return opened.unionByName(seen.where("NOT _opens").withColumn("_end_at", F.lit(None).cast(opened.schema["_end_at"].dataType)))


def scd2_state(feed: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str], delete_when: Column | str,
               max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """The state of `scd2_splice` after a first feed."""
    none = _timeline(feed, keys, seq, columns, delete_when).withColumns(
        {"_opens": F.lit(True), "_end_at": F.col(seq[0])}).limit(0)
    return scd2_splice(none, feed, keys, seq, columns, delete_when, max_group_rows)


def scd2_apply(state: DataFrame, batch: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str],
               delete_when: Column | str, max_group_rows: int = MAX_GROUP_ROWS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The state after a batch; rows that come late fall into their place, and a span they cut is cut as in a full run.

    The changed rows (`scd2_splice`) replace their old ones by an anti join; all others pass by, unshuffled if the changed ones are few.
    """
    changed = kept_still(scd2_splice(state, batch, keys, seq, columns, delete_when, max_group_rows, broadcast_bytes))
    ids = broadcast_if_small(changed.select(*[F.col(c).alias(f"_c_{c}") for c in (*keys, *seq)]), broadcast_bytes)
    return state.join(ids, _null_safe(state, [*keys, *seq], "_c_"), "left_anti").unionByName(changed)


def scd2_history(state: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of `scd2` from a state: its open stretches, row by row."""
    return state.where("_opens AND NOT _gone").select(*keys, *columns, F.col(seq[0]).alias("_start_at"), "_end_at",
                                                      F.col("_end_at").isNull().alias("_is_current"))
