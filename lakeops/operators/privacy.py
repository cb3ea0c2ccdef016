"""Column masking and row filters by grant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def mask_cols(df: DataFrame, masks: Mapping[str, str]) -> DataFrame:
    """Hide columns: `hash` keeps equality (SHA-256), `redact` replaces letters and digits."""
    out = {}
    for column, how in masks.items():
        if how == "hash":
            out[column] = F.sha2(F.col(column).cast("string"), 256)
        elif how == "redact":
            out[column] = F.mask(F.col(column).cast("string"))
        else:
            raise ValueError(f"{column}: mask must be 'hash' or 'redact'")
    return df.withColumns(out)


def row_filter(df: DataFrame, grants: DataFrame, user: str, on: Sequence[str]) -> DataFrame:
    """Rows whose `on` values are granted to the user; `grants` has `user` and the `on` columns."""
    mine = grants.where(F.col("user") == user).select(*on)
    return df.join(mine, list(on), "left_semi")
