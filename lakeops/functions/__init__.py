"""Column expressions shared by the operators."""

from lakeops.functions.columns import (
    band,
    bin_width,
    epoch_to_timestamp,
    random_int,
    struct_of,
    try_cast,
)

__all__ = ["band", "bin_width", "epoch_to_timestamp", "random_int", "struct_of", "try_cast"]
