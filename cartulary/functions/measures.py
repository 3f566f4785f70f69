"""Dates, sizes and ratios as Column expressions.  Rounding is half to even."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_day(seconds: Column) -> Column:
    """UTC day of epoch seconds, as text."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def day_number(timestamp: Column) -> Column:
    """AAAAMMJJ as an integer; null where the text is no timestamp."""
    return F.date_format(F.try_to_timestamp(timestamp.cast("string")), "yyyyMMdd").cast("int")


def convert_size(size: Column, steps: int) -> Column:
    """Bytes to a unit ``steps`` powers of 1024 higher, two decimals."""
    return F.bround(size / F.lit(1024.0) ** F.lit(steps), 2)


def mebibytes(size: Column) -> Column:
    return size / F.lit(1048576.0)


def compression_ratio(source: Column, target: Column) -> Column:
    """Source over target size; null when either isn't positive."""
    return F.when((source > 0) & (target > 0), source / target)


def estimate(size: Column, ratio: int) -> Column:
    """Size after compression by ``ratio``; null for texts that are no number."""
    return F.bround(size.cast("string").try_cast("double") / F.lit(float(ratio))).cast("long")


def reduction(width: Column, factor: float, floor: int = 2000) -> Column:
    """Scale of a reduction that leaves at least ``floor`` pixels of width; null for an unknown width."""
    known = width.isNotNull() & ~F.isnan(width.cast("double")) & (width > 0)
    return F.when(known, F.least(F.lit(1.0), F.greatest(F.lit(factor), F.lit(float(floor)) / width)))


def reduced(width: Column, height: Column, dpi: Column, factor: float, floor: int = 2000) -> list[Column]:
    s = reduction(width, factor, floor)
    return [
        s.alias("scale"),
        F.bround(width * s).cast("long").alias("new_width"),
        F.bround(height * s).cast("long").alias("new_height"),
        F.bround(dpi * s).cast("long").alias("new_dpi"),
    ]


def right_closed_bin(x: Column, edges: list[float]) -> Column:
    """Label of the bin (a, b] that holds x; the first bin also holds its lower edge; null outside."""
    c = F.when((x >= edges[0]) & (x <= edges[1]), F.lit(f"[{edges[0]:g}, {edges[1]:g}]"))
    for a, b in zip(edges[1:], edges[2:]):
        c = c.when((x > a) & (x <= b), F.lit(f"({a:g}, {b:g}]"))
    return c
