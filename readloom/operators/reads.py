"""Filters, rewrites and orders of aligned reads.

A read has qname, flag, ref_idx (-1 = none), pos (1-based, 0 = none), mapq, cigar, mate_ref_idx,
pnext, tlen, seq, qual and rg; ``tags`` (name -> type, value) is optional.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions import bases as B
from readloom.functions import cigar as C
from readloom.functions import flags as FL
from readloom.operators.skew import hot_keys, lookup_join, sliced_join
from readloom.session import cut_lineage

FLAG_COLUMNS = {
    "is_paired": FL.PAIRED, "is_proper": FL.PROPER, "is_unmapped": FL.UNMAPPED, "is_mate_unmapped": FL.MATE_UNMAPPED,
    "is_reverse": FL.REVERSE, "is_mate_reverse": FL.MATE_REVERSE, "is_first": FL.FIRST, "is_second": FL.SECOND,
    "is_not_primary": FL.NOT_PRIMARY, "fails_qc": FL.FAILS_QC, "is_duplicate": FL.DUPLICATE,
}
PAIR_ONLY = {"is_proper", "is_mate_unmapped", "is_mate_reverse", "is_first", "is_second"}
REVERSED_TAGS = ("OQ", "U2")  # quality-like tags that turn round with the read


def mapped_main_chroms(reads: DataFrame, max_ref: int = 24) -> DataFrame:
    return reads.filter(~FL.has(FL.UNMAPPED) & F.col("ref_idx").between(1, max_ref))


def flag_columns(reads: DataFrame) -> DataFrame:
    """One boolean per flag bit; pair-only bits are null on unpaired reads."""
    return reads.withColumns({
        name: FL.pair_only(bit) if name in PAIR_ONLY else FL.has(bit) for name, bit in FLAG_COLUMNS.items()})


def primary_only(reads: DataFrame) -> DataFrame:
    return reads.filter(~FL.has(FL.NOT_PRIMARY))


def add_read_group(reads: DataFrame, attrs: dict[str, str]) -> DataFrame:
    """Stamp one read group on all reads: its ID goes to ``rg``, the rest to rg_lb, rg_pl, ..."""
    columns = {"rg" if key == "ID" else f"rg_{key.lower()}": F.lit(value) for key, value in attrs.items()}
    return reads.withColumns(columns)


def _reverse_tag(name: Column, tag: Column) -> Column:
    turned = (F.when(name.isin(*REVERSED_TAGS), F.reverse(tag["value"]))
              .when(name == "E2", B.reverse_complement(tag["value"]))
              .when(name == "SQ", sq_reverse_complement(tag["value"]))
              .otherwise(tag["value"]))
    return F.struct(tag["type"].alias("type"), turned.alias("value"))


def sq_reverse_complement(packed_hex: Column) -> Column:
    """Packed second-best calls, two hex digits each: reversed, every base complemented."""
    values = F.reverse(F.regexp_extract_all(packed_hex, F.lit("(..)"), 1))
    flipped = F.transform(values, lambda v: F.lpad(F.hex(B.sq_complement(F.conv(v, 16, 10).cast("int"))), 2, "0"))
    return F.array_join(flipped, "")


def make_unmapped(reads: DataFrame, cond: Column) -> DataFrame:
    """Take the alignment off the reads meeting ``cond``; reverse-strand ones turn back as sequenced."""
    turn = cond & FL.has(FL.REVERSE)
    cleared = FL.without(FL.DUPLICATE | FL.NOT_PRIMARY | FL.PROPER | FL.REVERSE).bitwiseOR(FL.UNMAPPED)
    pick = lambda new, name: F.when(cond, new).otherwise(F.col(name))
    changes = {
        "flag": pick(cleared, "flag"), "ref_idx": pick(F.lit(-1), "ref_idx"), "pos": pick(F.lit(0), "pos"),
        "mapq": pick(F.lit(0), "mapq"), "cigar": pick(F.lit("*"), "cigar"), "tlen": pick(F.lit(0), "tlen"),
        "seq": F.when(turn, B.reverse_complement("seq")).otherwise(F.col("seq")),
        "qual": F.when(turn, F.reverse("qual")).otherwise(F.col("qual")),
    }
    if "tags" in reads.columns:
        changes["tags"] = F.when(turn, F.transform_values("tags", _reverse_tag)).otherwise(F.col("tags"))
    return reads.withColumns(changes)


def clean_reads(reads: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Soft-clip alignments that run past their reference, and zero MAPQ on unmapped reads.

    A read with no aligned base left on the reference gets CIGAR ``*``.
    """
    joined = lookup_join(reads, dictionary.select("ref_idx", F.col("length").alias("_len")), ["ref_idx"])
    over = (C.alignment_end() > F.col("_len")) & ~FL.has(FL.UNMAPPED)
    return joined.withColumns({
        "cigar": F.when(over, C.clip_past_end("pos", "cigar", "_len")).otherwise(F.col("cigar")),
        "mapq": F.when(FL.has(FL.UNMAPPED), F.lit(0)).otherwise(F.col("mapq")),
    }).select(*reads.columns)


def export_uppercase_names(reads: DataFrame) -> DataFrame:
    return reads.withColumn("qname", F.upper("qname"))


def coordinate_order(total: bool = True) -> list[Column]:
    """Unplaced reads last, then reference and position; ``total`` adds the tie-breaks."""
    keys = [F.when(F.col("ref_idx") == -1, 1).otherwise(0), F.col("ref_idx"), F.col("pos")]
    if total:
        # unplaced reads are not ordered by position
        keys[2] = F.when(F.col("ref_idx") == -1, F.lit(0)).otherwise(F.col("pos"))
        keys += [FL.has(FL.REVERSE), F.col("qname"), F.col("flag"), F.col("mapq"), F.col("mate_ref_idx"),
                 F.col("pnext"), F.col("tlen"), F.col("cigar"), F.col("seq"), F.col("qual")]
    return keys


def queryname_order(hit_index: str | None = None) -> list[Column]:
    """Name; paired before unpaired; first before second; forward, primary first; hit index, nulls first."""
    paired = FL.has(FL.PAIRED)
    keys = [F.col("qname"), F.when(paired, 0).otherwise(1),
            F.when(paired & FL.has(FL.FIRST), 0).when(paired & FL.has(FL.SECOND), 1).otherwise(0),
            FL.has(FL.REVERSE), FL.has(FL.NOT_PRIMARY)]
    if hit_index:
        keys.append(F.col(hit_index).asc_nulls_first())
    return keys


def coordinate_sort(reads: DataFrame) -> DataFrame:
    return reads.orderBy(*coordinate_order())


def queryname_sort(reads: DataFrame, hit_index: str | None = None) -> DataFrame:
    return reads.orderBy(*queryname_order(hit_index))


def region_order() -> list[Column]:
    return [F.col("ref_idx"), F.col("pos"), F.col("qname"), F.col("flag"), F.col("cigar"), F.col("mapq"),
            F.col("seq"), F.col("qual")]


def region_sort(reads: DataFrame) -> DataFrame:
    return reads.orderBy(*region_order())


def view(reads: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Every read as one text line; 0 prints as ``*`` for position, mate position and insert size."""
    names = dictionary.select("ref_idx", "rname")
    mates = dictionary.select(F.col("ref_idx").alias("mate_ref_idx"), F.col("rname").alias("_mate"))
    star = lambda c: F.when(F.col(c) == 0, F.lit("*")).otherwise(F.col(c).cast("string"))
    joined = lookup_join(lookup_join(reads, names, ["ref_idx"]), mates, ["mate_ref_idx"])
    rname, mate = F.coalesce("rname", F.lit("*")), F.coalesce("_mate", F.lit("*"))
    rnext = F.when((mate != "*") & (mate == rname), F.lit("=")).otherwise(mate)
    return joined.select(F.concat_ws(
        "\t", "qname", F.col("flag").cast("string"), rname, star("pos"), F.col("mapq").cast("string"), "cigar",
        rnext, star("pnext"), star("tlen"), "seq", "qual", F.concat(F.lit("RG:Z:"), F.col("rg"))).alias("line"))


def query_overlapping(reads: DataFrame, ref: int, start: int, end: int) -> DataFrame:
    """Reads touching [start, end]; end 0 is open. An unmapped read with a position counts as one base."""
    last = end if end > 0 else (1 << 31) - 1
    return reads.filter((F.col("ref_idx") == ref) & (F.col("pos") <= last) & (touched_end() >= start))


def query_contained(reads: DataFrame, ref: int, start: int, end: int) -> DataFrame:
    last = end if end > 0 else (1 << 31) - 1
    return reads.filter((F.col("ref_idx") == ref) & (F.col("pos") >= start) & (F.col("pos") <= last)
                        & (touched_end() <= last))


def query_starting_at(reads: DataFrame, ref: int, pos: int) -> DataFrame:
    return reads.filter((F.col("ref_idx") == ref) & (F.col("pos") == pos))


def query_unmapped(reads: DataFrame) -> DataFrame:
    return reads.filter(F.col("ref_idx") == -1)


def touched_end() -> Column:
    """Last position a region query counts; an unmapped read with a position counts as one base."""
    return F.coalesce(F.nullif(C.alignment_end(), F.lit(0)), "pos")


def mate_join(reads: DataFrame) -> DataFrame:
    """For each paired read, the read of the other end at its mate position: (qname, end, mate_pos, mate_flag, n_mates, error).

    Candidates are first aggregated to one row per (name, reference, position), so no name
    multiplies rows; the reads of a name with very many of them are sliced.
    """
    spot = lambda ref, pos: F.when(F.col(ref) == -1, F.lit(0)).otherwise(F.col(pos))
    paired = FL.has(FL.PAIRED)
    side = lambda skip, name: (
        F.count_if(paired & ~FL.has(skip)).alias(f"_n{name}"),
        # used where there is one candidate only, so each minimum is its value
        F.min(F.when(paired & ~FL.has(skip), F.col("pos"))).alias(f"_pos{name}"),
        F.min(F.when(paired & ~FL.has(skip), F.col("flag"))).alias(f"_flag{name}"))
    found = (
        reads.groupBy("qname", F.col("ref_idx").alias("_ref"), spot("ref_idx", "pos").alias("_pos"))
        .agg(F.count_if(~paired).alias("_unpaired"), *side(FL.FIRST, 1), *side(FL.SECOND, 2))
    )
    seekers = reads.filter(paired).select(
        "qname", F.col("mate_ref_idx").alias("_ref"), spot("mate_ref_idx", "pnext").alias("_pos"),
        FL.has(FL.FIRST).alias("_first"), FL.has(FL.SECOND).alias("_second"))
    keys = ["qname", "_ref", "_pos"]
    hot = cut_lineage(hot_keys(seekers, keys))
    # candidates lie by the keys already; only slices of hot ones (which null names are, too) take another shuffle
    joined = seekers.join(found, keys, "left") if hot.isEmpty() else sliced_join(seekers, found, keys, "left", hot=hot)
    # a first end skips first ends, anything else skips second ends
    n = F.coalesce(F.when(F.col("_first"), F.col("_n1")).otherwise(F.col("_n2")), F.lit(0))
    mate = lambda c: F.when(n == 1, F.when(F.col("_first"), F.col(f"_{c}1")).otherwise(F.col(f"_{c}2")))
    error = (F.when(F.col("_first") == F.col("_second"), F.lit("NOT_ONE_END"))
             .when(F.col("_unpaired") > 0, F.lit("PAIRED_AND_UNPAIRED"))
             .when(n > 1, F.lit("MULTIPLE_MATES")))
    return joined.select("qname", F.when(F.col("_first"), 1).otherwise(2).alias("end"), mate("pos").alias("mate_pos"),
                         mate("flag").alias("mate_flag"), n.alias("n_mates"), error.alias("error"))


def attach_read_group(reads: DataFrame, rgs: DataFrame) -> DataFrame:
    """Header attributes of each read's group; ``rg_missing`` where the header lacks it."""
    known = rgs.withColumnRenamed("id", "rg").withColumn("_known", F.lit(True))
    missing = F.col("rg").isNotNull() & F.col("_known").isNull()
    return lookup_join(reads, known, ["rg"]).withColumn("rg_missing", missing).drop("_known")
