"""Hierarchical genome bins: five levels of 64 Mb .. 16 kb below one of 512 Mb."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (shift, first bin id) from the finest level up.
LEVELS = ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1))
WINDOW_SHIFT = 14


def bin_of(start: Column, end: Column, finest: int = WINDOW_SHIFT) -> Column:
    """Smallest bin of at least 2^``finest`` bases holding the 0-based half-open span [start, end)."""
    last = end - 1
    out = F.lit(0)
    for shift, first in reversed(LEVELS):
        if shift >= finest:
            out = F.when(F.shiftright(start, shift) == F.shiftright(last, shift), first + F.shiftright(start, shift)).otherwise(out)
    return out.cast("int")


def candidate_bins(start: Column, end: Column, finest: int = WINDOW_SHIFT) -> Column:
    """All bins of at least 2^``finest`` bases that may hold something overlapping the 0-based half-open span."""
    last = end - 1
    parts = [F.sequence(first + F.shiftright(start, shift), first + F.shiftright(last, shift))
             for shift, first in reversed(LEVELS) if shift >= finest]
    return F.concat(F.array(F.lit(0)), *parts)


def candidate_ranges(start: int, end: int, finest: int = WINDOW_SHIFT) -> list[tuple[int, int]]:
    """``candidate_bins`` of a known span, as one range of bins per level."""
    return [(0, 0), *[(first + (start >> shift), first + (end - 1 >> shift)) for shift, first in reversed(LEVELS) if shift >= finest]]


def overlap_length(s1, e1, s2, e2) -> Column:
    return F.greatest(F.least(e1, e2) - F.greatest(s1, s2) + 1, F.lit(0))


def overlaps(s1, e1, s2, e2) -> Column:
    return (s1 <= e2) & (s2 <= e1)


def encloses(s1, e1, s2, e2) -> Column:
    return (s1 <= s2) & (e1 >= e2)


def read_cycle(reverse, read_len, offset) -> Column:
    """Sequencing cycle of the 1-based read offset."""
    return F.when(reverse, read_len - offset + 1).otherwise(offset)
