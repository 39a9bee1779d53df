"""Flag bits of a read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag bits.
PAIRED = 0x1
PROPER = 0x2
UNMAPPED = 0x4
MATE_UNMAPPED = 0x8
REVERSE = 0x10
MATE_REVERSE = 0x20
FIRST = 0x40
SECOND = 0x80
NOT_PRIMARY = 0x100
FAILS_QC = 0x200
DUPLICATE = 0x400


def has(bit: int, flag="flag") -> Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    return flag.bitwiseAND(bit) != 0


def without(bits: int, flag="flag") -> Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    return flag.bitwiseAND(~bits)


def pair_only(bit: int, flag="flag") -> Column:
    """Meaningful on paired reads only: null otherwise."""
    return F.when(has(PAIRED, flag), has(bit, flag))
