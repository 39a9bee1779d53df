"""Base and quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHRED_OFFSET = 33
ILLUMINA_SHIFT = 31
SANGER_MAX = 60

_col = lambda c: F.col(c) if isinstance(c, str) else c


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(_col(seq), "acgtACGT", "tgcaTGCA"))


def same_base(a, b) -> Column:
    return F.upper(_col(a)) == F.upper(_col(b))


def same_base_bisulfite(base, ref_base, reverse) -> Column:
    """Also accept T read over C (forward strand) or A read over G (reverse strand)."""
    base, ref_base = F.upper(_col(base)), F.upper(_col(ref_base))
    converted = F.when(_col(reverse), (ref_base == "G") & (base == "A")).otherwise((ref_base == "C") & (base == "T"))
    return (base == ref_base) | converted


def normalise(seq) -> Column:
    return F.translate(F.upper(_col(seq)), ".", "N")


def phred(qual) -> Column:
    """Quality characters -> array of scores."""
    return F.transform(F.split(_col(qual), ""), lambda c: F.ascii(c) - PHRED_OFFSET)


def phred_text(scores) -> Column:
    return F.array_join(F.transform(_col(scores), lambda s: F.char(s + PHRED_OFFSET)), "")


def is_phred_text(qual) -> Column:
    """Every character within 33..126."""
    return _col(qual).rlike("^[!-~]*$")


def max_quality(qual) -> Column:
    return F.array_max(phred(qual))


def quality_sum(qual, at_least: int = 0) -> Column:
    return F.aggregate(phred(qual), F.lit(0), lambda total, s: total + F.when(s >= at_least, s).otherwise(0))


def shift_illumina(qual) -> Column:
    """Scores lowered by 31; null where one would fall below zero."""
    lowered = F.transform(phred(qual), lambda s: s - ILLUMINA_SHIFT)
    return F.when(F.array_min(lowered) >= 0, phred_text(lowered))


def count_chars(seq, chars: str) -> Column:
    return F.length(_col(seq)) - F.length(F.translate(_col(seq), chars, ""))


def sq_base(value) -> Column:
    """Second-best base of a packed 8-bit value (top two bits)."""
    return F.substring(F.lit("ACGT"), F.shiftrightunsigned(_col(value).bitwiseAND(255), 6) + 1, F.lit(1))


def sq_ratio(value) -> Column:
    return _col(value).bitwiseAND(63)


def sq_complement(value) -> Column:
    """The packed value with its base complemented: A<->T and C<->G flip both base bits."""
    return _col(value).bitwiseXOR(192)
