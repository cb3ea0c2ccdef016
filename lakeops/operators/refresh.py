"""Aggregates kept up to date from change rows, without reading the table again.

Counts and sums follow from the change rows alone: an insert adds, a delete subtracts, an update does both. Least and greatest
values do, too, unless a row that held one goes; only the groups where that happened are counted anew. Distinct
values are kept with their counts, a row for each group and value.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.operators.mutate import kept_still
from lakeops.operators.skew import BROADCAST_BYTES, broadcast_if_small

GONE = ("delete", "update_preimage")


def _sign() -> Column:
    return F.when(F.col("_change_type").isin(*GONE), -1).otherwise(1).cast("bigint")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


@dataclass(frozen=True)
class Kept:
    """What is kept for each group of `keys`: rows (`n`), sums and non-null counts, extremes, distinct values of one column."""

    keys: Sequence[str]
    sums: Sequence[str] = ()
    extremes: Sequence[str] = ()
    distinct: str | None = None

    def _extremes(self, when: Column | None, prefix: str) -> list[Column]:
        out = []
        for c in self.extremes:
            value = F.col(c) if when is None else F.when(when, F.col(c))
            out += [F.min(value).alias(f"{prefix}min_{c}"), F.max(value).alias(f"{prefix}max_{c}")]
        return out

    def values(self, rows: DataFrame) -> DataFrame | None:
        """Group, value and how often the group has it; None if no distinct values are kept."""
        if self.distinct is None:
            return None
        return (rows.where(F.col(self.distinct).isNotNull()).groupBy(*self.keys, F.col(self.distinct).alias("value"))
                .agg(F.count(F.lit(1)).alias("n")))

    def groups(self, rows: DataFrame) -> DataFrame:
        """The aggregates of a whole table."""
        more = [F.count_distinct(self.distinct).alias("distinct")] if self.distinct else []
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("n"),
            *[a for c in self.sums for a in (F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}"))], *self._extremes(None, ""), *more)

    def _deltas(self, changes: DataFrame) -> DataFrame:
        sign = _sign()
        added, gone = sign > 0, sign < 0
        return changes.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(
            F.sum(sign).alias("_n"),
            *[a for c in self.sums for a in (F.sum(F.when(added, F.col(c)).otherwise(-F.col(c))).alias(f"_sum_{c}"),
                                             F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(0)).alias(f"_n_{c}"))],
            *self._extremes(added, "_in_"), *self._extremes(gone, "_out_"))

    def refreshed(self, groups: DataFrame, values: DataFrame | None, changes: DataFrame, rows: DataFrame,
                  broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame | None]:
        """Groups and values after some change rows. `rows` is the table after them, read for the groups that need it only.

        NULL keys are a group. Change rows that don't fit the groups (more deletes than rows) raise.
        """
        changes = kept_still(changes.select("_change_type", *dict.fromkeys([*self.keys, *self.sums, *self.extremes,
                                                                           *([self.distinct] if self.distinct else [])])))
        new_values, shifts = self._values_refreshed(values, changes)
        deltas = kept_still(self._deltas(changes))
        if shifts is not None:
            renamed = shifts.select(*[F.col(k).alias(f"s_{k}") for k in self.keys], "_distinct")
            on = reduce(lambda a, b: a & b, [F.col(f"_{k}").eqNullSafe(F.col(f"s_{k}")) for k in self.keys])
            deltas = deltas.join(renamed, on, "left").drop(*[f"s_{k}" for k in self.keys])
        small = broadcast_if_small(deltas, broadcast_bytes)
        # Groups without changes pass by; the others meet their deltas.
        calm = groups.join(small, _same(groups, small, self.keys), "left_anti")
        met = deltas.join(groups, _same(groups, deltas, self.keys), "left")

        def plus(name: str) -> Column:
            return (F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_{name}"), F.lit(0)))

        n = plus("n")
        wrong = F.raise_error(F.lit("refresh: more rows deleted than there are")).cast("bigint")
        unsure = F.lit(False)
        extremes = []
        for c in self.extremes:
            for name, best, beyond in ((f"min_{c}", F.least, lambda a, b: a <= b), (f"max_{c}", F.greatest, lambda a, b: a >= b)):
                held, came, went = F.col(name), F.col(f"_in_{name}"), F.col(f"_out_{name}")
                extremes.append(best(held, came).alias(name))
                # What went may have been the last of its value, unless one came that is as good.
                unsure = unsure | (F.coalesce(beyond(went, held), went.isNotNull() & held.isNull()) & ~F.coalesce(beyond(came, held), F.lit(False)))
        kinds = {f.name: f.dataType for f in groups.schema.fields}
        sums = [a for c in self.sums for a in (
            F.when(plus(f"n_{c}") > 0, plus(f"sum_{c}")).cast(kinds[f"sum_{c}"]).alias(f"sum_{c}"), plus(f"n_{c}").alias(f"n_{c}"))]
        distinct = [plus("distinct").alias("distinct")] if self.distinct else []
        after = kept_still(met.select(
            *[F.col(f"_{k}").alias(k) for k in self.keys], F.when(n < 0, wrong).otherwise(n).alias("n"), *sums, *extremes, *distinct,
            (unsure & (n > 0)).alias("_unsure")).where("n > 0"))
        out = calm.unionByName(after.where("NOT _unsure").drop("_unsure"))
        again = after.where("_unsure")
        if self.extremes and not again.isEmpty():
            asked = broadcast_if_small(again.select(*[F.col(k).alias(f"_{k}") for k in self.keys]), broadcast_bytes)
            recounted = (rows.join(asked, _same(rows, asked, self.keys), "left_semi").groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys])
                         .agg(*self._extremes(None, "")))
            rest = again.drop("_unsure", *[c for c in after.columns if c.startswith(("min_", "max_"))])
            out = out.unionByName(rest.join(recounted, _same(rest, recounted, self.keys)).select(*groups.columns))
        return out.select(*groups.columns), new_values

    def _values_refreshed(self, values: DataFrame | None, changes: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        """The counted values after the changes, and by how many the number of distinct ones changes in each group."""
        if self.distinct is None or values is None:
            return None, None
        names = [*self.keys, "value"]
        deltas = (changes.where(F.col(self.distinct).isNotNull()).groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys], F.col(self.distinct).alias("_value"))
                  .agg(F.sum(_sign()).alias("_n")).where("_n <> 0"))
        deltas = kept_still(deltas)
        small = broadcast_if_small(deltas)
        calm = values.join(small, _same(values, small, names), "left_anti")
        met = kept_still(deltas.join(values, _same(values, deltas, names), "left").select(
            *[F.col(f"_{c}").alias(c) for c in names], F.coalesce("n", F.lit(0)).alias("_was"), (F.coalesce("n", F.lit(0)) + F.col("_n")).alias("n")))
        shift = F.sum((F.col("n") > 0).cast("bigint") - (F.col("_was") > 0).cast("bigint"))
        return calm.unionByName(met.where("n > 0").drop("_was")), met.groupBy(*self.keys).agg(shift.alias("_distinct"))
