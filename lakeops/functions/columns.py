"""Built-in-only column expressions (all stay inside code generation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def band(col: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by value band: below `edges[i]` gives `labels[i]`; everything else, NULL too, the last."""
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs one label more than edges")
    out = F.when(_c(col) < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(_c(col) < edge, label)
    return out.otherwise(labels[-1])


def bin_width(col: Column | str, width: int) -> Column:
    """Lower edge of the fixed-width bin holding the value."""
    return (F.floor(_c(col) / width) * width).cast("bigint")


def try_cast(col: Column | str, data_type: str) -> Column:
    """Cast that gives NULL, not an error, for text that does not parse."""
    return _c(col).try_cast(data_type)


def epoch_to_timestamp(col: Column | str) -> Column:
    """Epoch seconds held as text to a timestamp; NULL for text that is no number."""
    return F.timestamp_seconds(try_cast(col, "bigint"))


def random_int(low: int, high: int, seed: int | None = None) -> Column:
    """Random integer in `low..high`, both included."""
    rand = F.rand(seed) if seed is not None else F.rand()
    return (F.lit(low) + rand * F.lit(high - low + 1)).cast("int")


def struct_of(columns: Sequence[str]) -> Column:
    """All the named columns as one struct."""
    return F.struct(*[F.col(f"`{c}`") for c in columns])
