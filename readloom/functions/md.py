"""Reference text of a read from its MD tag, as a column expression.

CIGAR and MD are two run-length descriptions of the same bases. Running sums of the lengths of their runs say where each run
starts in the read, among the aligned bases and among the deleted ones, so every run is one slice of bytes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from readloom.functions import cigar as C
from readloom.functions.arrays import let, running

_TOKEN = "[0-9]+|[A-Za-z]|\\^[A-Za-z]+"  # the published grammar: numbers, bases, deleted runs


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda total, n: total + n)


def _slice(data: Column, start: Column, length: Column) -> Column:
    """Bytes are cut in the time their number takes; text would be walked from its first character."""
    return F.substring(data, start + 1, length).cast("string")


def reference_text(seq: Column, cigar: Column, md: Column, with_deletions: bool) -> Column:
    """The reference under a read. Soft-clipped bases show as 0, inserted ones as -; deleted and skipped (N) ones only
    with ``with_deletions``. Null without a read, CIGAR or tag, and where they disagree."""
    lengths = lambda els, ops: F.transform(els, lambda e: F.when(F.contains(F.lit(ops), e["op"]), e["len"]).otherwise(0))
    is_gone = lambda t: F.startswith(t, F.lit("^"))
    spanned = lambda t: F.when(is_gone(t), 0).when(t.rlike("^[A-Za-z]"), 1).otherwise(t.try_cast("int"))

    def parts(v):
        """Checks the totals, then cuts the aligned bases out of the read."""
        deleted = F.filter(v["tokens"], is_gone)
        agree = (
            (_total(F.transform(v["tokens"], F.length)) == v["size"])  # nothing lies between the tokens
            & (_total(lengths(v["els"], C.READ_OPS)) == F.length(v["seq"]))
            & (_total(lengths(v["els"], C.ALIGNED_OPS)) == _total(F.transform(v["tokens"], spanned)))
            & (F.transform(deleted, lambda t: F.length(t) - 1) == F.transform(F.filter(v["els"], lambda e: e["op"] == "D"), lambda e: e["len"])))
        starts = F.struct(running(lengths(v["els"], C.READ_OPS)).alias("read"), v["els"].alias("els"), v["seq"].cast("binary").alias("data"))
        aligned = let(starts, lambda s: F.array_join(F.transform(s["els"], lambda e, i: F.when(
            F.contains(F.lit(C.ALIGNED_OPS), e["op"]), _slice(s["data"], F.get(s["read"], i), e["len"])).otherwise("")), ""))
        return F.when(agree, let(F.struct(aligned.cast("binary").alias("data"), v["tokens"].alias("tokens"), v["els"].alias("els"),
                                          running(F.transform(v["tokens"], spanned)).alias("at")), reference))

    def reference(v):
        """The reference of the aligned bases, then of all runs of the CIGAR."""
        told = F.transform(v["tokens"], lambda t, i: F.when(is_gone(t), F.lit("")).when(t.rlike("^[A-Za-z]"), t).otherwise(
            _slice(v["data"], F.get(v["at"], i), spanned(t))))
        gone = F.array_join(F.transform(F.filter(v["tokens"], is_gone), lambda t: F.substring(t, 2, 1 << 30)), "")
        return let(F.struct(
            F.array_join(told, "").cast("binary").alias("aligned"), gone.cast("binary").alias("gone"), v["els"].alias("els"),
            running(lengths(v["els"], C.ALIGNED_OPS)).alias("at"), running(lengths(v["els"], "D")).alias("gap")), shown)

    def shown(v):
        def run(e, i):
            out = F.when(F.contains(F.lit(C.ALIGNED_OPS), e["op"]), _slice(v["aligned"], F.get(v["at"], i), e["len"]))
            out = out.when(e["op"] == "S", F.repeat(F.lit("0"), e["len"])).when(e["op"] == "I", F.repeat(F.lit("-"), e["len"]))
            if with_deletions:
                out = out.when(e["op"] == "D", _slice(v["gone"], F.get(v["gap"], i), e["len"]))
                out = out.when(e["op"] == "N", F.repeat(F.lit("N"), e["len"]))
            return out.otherwise("")
        return F.array_join(F.transform(v["els"], run), "")

    given = (F.length(seq) > 0) & (F.length(cigar) > 0) & md.isNotNull()
    tokens = F.regexp_extract_all(md, F.lit(f"({_TOKEN})"), 1)
    whole = F.struct(seq.alias("seq"), C.elements(cigar).alias("els"), tokens.alias("tokens"), F.length(md).alias("size"))
    return F.when(given, let(whole, parts))
