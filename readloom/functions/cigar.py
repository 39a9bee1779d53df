"""CIGAR geometry as column expressions. Positions are 1-based and closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which operators consume the read, the reference, the padded reference.
OPS = "MIDNSHP=X"
READ_OPS = "MIS=X"
REF_OPS = "MDN=X"
PADDED_OPS = "MDNP=X"
ALIGNED_OPS = "M=X"

_col = lambda c: F.col(c) if isinstance(c, str) else c


def elements(cigar) -> Column:
    """``10M2I`` -> [(10, M), (2, I)]; ``*`` -> []."""
    cigar = _col(cigar)
    pattern = F.lit(f"(\\d+)([{OPS}])")
    return F.transform(
        F.regexp_extract_all(cigar, pattern, 0),
        lambda e: F.struct(F.substring(e, F.lit(1), F.length(e) - 1).cast("int").alias("len"),
                           F.right(e, F.lit(1)).alias("op")),
    )


def is_well_formed(cigar) -> Column:
    cigar = _col(cigar)
    return (cigar == "*") | cigar.rlike(f"^(?:\\d+[{OPS}])++$")  # possessive: thousands of elements take no stack


def format_elements(els) -> Column:
    """Back to text; no elements -> ``*``."""
    els = _col(els)
    text = F.array_join(F.transform(els, lambda e: F.concat(e["len"].cast("string"), e["op"])), "")
    return F.when(F.size(els) > 0, text).otherwise(F.lit("*"))


def length_of(cigar, ops: str) -> Column:
    """Sum of the lengths of the elements whose operator is in ``ops``."""
    lens = F.regexp_extract_all(_col(cigar), F.lit(f"(\\d+)[{ops}]"), 1)
    return F.aggregate(lens, F.lit(0), lambda total, n: total + n.cast("int"))


def reference_length(cigar) -> Column:
    return length_of(cigar, REF_OPS)


def padded_length(cigar) -> Column:
    return length_of(cigar, PADDED_OPS)


def read_length(cigar) -> Column:
    return length_of(cigar, READ_OPS)


def inserted_bases(cigar) -> Column:
    return length_of(cigar, "I")


def deleted_bases(cigar) -> Column:
    return length_of(cigar, "D")


def maps_no_base(cigar) -> Column:
    return ~_col(cigar).rlike("[M=X]")


def alignment_end(pos="pos", cigar="cigar", flag="flag") -> Column:
    """Last reference position covered; 0 for an unmapped read."""
    unmapped = _col(flag).bitwiseAND(4) != 0
    return F.when(unmapped, F.lit(0)).otherwise(_col(pos) + reference_length(cigar) - 1)


def unclipped_start(pos="pos", cigar="cigar") -> Column:
    return _col(pos) - length_of(F.regexp_extract(_col(cigar), "^((?:\\d+[SH])+)", 1), "SH")


def unclipped_end(pos="pos", cigar="cigar", flag="flag") -> Column:
    return alignment_end(pos, cigar, flag) + length_of(F.regexp_extract(_col(cigar), "((?:\\d+[SH])+)$", 1), "SH")


def alignment_blocks(pos="pos", cigar="cigar") -> Column:
    """Ungapped stretches: [(read_start, ref_start, len)]."""
    block = "array<struct<read_start:int,ref_start:int,len:int>>"
    start = F.struct(F.lit(1).alias("read"), _col(pos).cast("int").alias("ref"), F.array().cast(block).alias("out"))

    def consume(state, e):
        moves = lambda ops: F.when(F.contains(F.lit(ops), e["op"]), e["len"]).otherwise(0)
        here = F.struct(state["read"].alias("read_start"), state["ref"].alias("ref_start"), e["len"].alias("len"))
        return F.struct(
            (state["read"] + moves(READ_OPS)).alias("read"),
            (state["ref"] + moves(REF_OPS)).alias("ref"),
            F.when(F.contains(F.lit(ALIGNED_OPS), e["op"]), F.concat(state["out"], F.array(here)))
            .otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(elements(cigar), start, consume, lambda state: state["out"])


def reference_position(offset, pos="pos", cigar="cigar") -> Column:
    """Reference position under the 1-based read ``offset``; 0 if that base is not aligned."""
    offset = _col(offset)
    hit = F.filter(alignment_blocks(pos, cigar),
                   lambda b: (b["read_start"] <= offset) & (offset < b["read_start"] + b["len"]))
    return F.when(F.size(hit) > 0, hit[0]["ref_start"] + offset - hit[0]["read_start"]).otherwise(0).cast("int")


def gapped_positions(pos="pos", cigar="cigar") -> Column:
    """Reference spans touched by indels: [(start, end)]; an insertion spans its two neighbours."""
    span = "array<struct<start:int,end:int>>"
    start = F.struct(_col(pos).cast("int").alias("ref"), F.array().cast(span).alias("out"))

    def consume(state, e):
        ref = state["ref"]
        inserted = F.struct((ref - 1).alias("start"), ref.alias("end"))
        deleted = F.struct(ref.alias("start"), (ref + e["len"] - 1).alias("end"))
        return F.struct(
            (ref + F.when(F.contains(F.lit(REF_OPS), e["op"]), e["len"]).otherwise(0)).alias("ref"),
            F.when(e["op"] == "I", F.concat(state["out"], F.array(inserted)))
            .when(e["op"] == "D", F.concat(state["out"], F.array(deleted)))
            .otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(elements(cigar), start, consume, lambda state: state["out"])


def _clip_tail(els: Column, room: Column) -> Column:
    """Elements with everything after ``room`` reference bases turned into a soft clip; none if no aligned base remains.

    Deletions and skips past the end vanish, hard clips stay.
    """
    kind = "array<struct<len:int,op:string>>"
    start = F.struct(room.cast("int").alias("room"), F.lit(0).alias("clip"), F.lit(0).alias("hard"), F.lit(0).alias("bases"),
                     F.array().cast(kind).alias("kept"))
    one = lambda n, op: F.array(F.struct(n.cast("int").alias("len"), op.alias("op")))
    none = F.array().cast(kind)

    def consume(s, e):
        on_ref = F.contains(F.lit(REF_OPS), e["op"])
        on_read = F.contains(F.lit(READ_OPS), e["op"])
        past = (s["room"] <= 0) & (F.size(s["kept"]) > 0)
        fits = F.when(on_ref, F.least(e["len"], s["room"])).when(past & (e["op"] != "H"), F.lit(0)).otherwise(e["len"])
        tail_hard = (e["op"] == "H") & past
        keep = F.when(tail_hard, F.lit(0)).otherwise(fits)
        return F.struct(
            (s["room"] - F.when(on_ref, keep).otherwise(0)).alias("room"),
            (s["clip"] + F.when(on_read, e["len"] - keep).otherwise(0)).alias("clip"),
            (s["hard"] + F.when(tail_hard, e["len"]).otherwise(0)).alias("hard"),
            (s["bases"] + F.when(F.contains(F.lit(ALIGNED_OPS), e["op"]), keep).otherwise(0)).alias("bases"),
            F.concat(s["kept"], F.when(keep > 0, one(keep, e["op"])).otherwise(none)).alias("kept"),
        )

    def finish(s):
        out = F.concat(s["kept"], F.when(s["clip"] > 0, one(s["clip"], F.lit("S"))).otherwise(none),
                       F.when(s["hard"] > 0, one(s["hard"], F.lit("H"))).otherwise(none))
        return F.when(s["bases"] > 0, out).otherwise(none)

    return F.aggregate(els, start, consume, finish)


def clip_past_end(pos, cigar, ref_len) -> Column:
    """``cigar`` with everything past reference position ``ref_len`` turned into a soft clip; ``*`` if nothing is left."""
    room = F.greatest(_col(ref_len) - _col(pos) + 1, F.lit(0))
    kept = _clip_tail(elements(cigar), room)
    return F.when(F.size(kept) > 0, format_elements(kept)).otherwise(F.lit("*"))


def _inside(pos: Column, els: Column, span: Column, ref_len: Column) -> Column:
    """Elements clipped at both ends of the reference; the left end is the tail of the reversed elements."""
    tail = _clip_tail(els, F.greatest(ref_len - pos + 1, F.lit(0)))
    past = F.greatest(pos + span - 1 - ref_len, F.lit(0))
    return F.reverse(_clip_tail(F.reverse(tail), F.greatest(F.least(pos + span - 1 - past, span - past), F.lit(0))))


def _element(length: Column, op: Column) -> Column:
    return F.struct(length.cast("int").alias("len"), op.alias("op"))


def clipped_cigar(pos, read_len, ref_len) -> Column:
    """CIGAR of an ungapped alignment, soft-clipped where it hangs off either reference end; null if nothing is left."""
    pos, read_len, ref_len = _col(pos), _col(read_len), _col(ref_len)
    kept = _inside(pos, F.array(_element(read_len, F.lit("M"))), read_len, ref_len)
    return F.when(F.size(kept) > 0, format_elements(kept))


def clipped_cigar_with_indel(pos, read_len, ref_len, indel_at, indel_len) -> Column:
    """As ``clipped_cigar`` with one indel after ``indel_at`` bases; positive length inserts, negative deletes.

    Null unless aligned bases remain on both sides of the indel.
    """
    pos, read_len, ref_len = _col(pos), _col(read_len), _col(ref_len)
    indel_at, indel_len = _col(indel_at), _col(indel_len)
    rest = read_len - indel_at - F.greatest(indel_len, F.lit(0))
    gap = _element(F.abs(indel_len), F.when(indel_len > 0, F.lit("I")).otherwise(F.lit("D")))
    els = F.array(_element(indel_at, F.lit("M")), gap, _element(rest, F.lit("M")))
    kept = _inside(pos, els, read_len - indel_len, ref_len)
    return F.when(F.size(F.filter(kept, lambda e: e["op"] == "M")) == 2, format_elements(kept))
