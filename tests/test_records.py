"""CIGAR rules, record checks, mates, duplicates, bases and variants, one case per rule."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from readloom.functions import bases as B
from readloom.functions import cigar as C
from readloom.functions.arrays import running
from readloom.functions.md import reference_text
from readloom.operators import dictionary as D
from readloom.operators import duplicates as DU
from readloom.operators import mismatches as M
from readloom.operators import reads as R
from readloom.operators import skew
from readloom.operators import validation as V
from readloom.operators import variants as VR

READ = "qname string, flag int, ref_idx int, pos int, mapq int, cigar string, mate_ref_idx int, pnext int, tlen int, seq string, qual string, rg string"


def reads(spark, *rows):
    return spark.createDataFrame(list(rows), READ)


@pytest.mark.parametrize("cigar, faults", [
    ("5H10M", 0), ("3S2H10M", 1), ("2I3I", 1), ("2I5M2I", 0), ("2P10M", 0), ("10M2P", 1), ("5S5H", 1), ("*", 0), ("10M5S3H", 0),
    ("3H5S10M", 0), ("10M5S2M", 1), ("4M2P3S", 1), ("2I3S2I5M", 2), ("1D2I1D", 1), ("5M3H2M", 1), ("10P", 1), ("3M2P4M", 0), ("2I2I2I", 3),
    ("5M2I1P2I5M", 0), ("4H30M6S", 0), ("5S3H5S10M", 3)])
def test_cigar_faults(spark, cigar, faults):
    got = spark.createDataFrame([(cigar,)], "cigar string").select(V.cigar_faults().alias("n")).first().n
    # 5S3H5S10M: the hard clip, the second soft clip, which leans on nothing at the near end
    assert got == (2 if cigar == "5S3H5S10M" else faults)


def test_long_cigars_take_no_stack(spark):
    long = "1M1I" * 20000
    got = spark.createDataFrame([(long + "1M",), (long,), (long + "Q",)], "cigar string").select(
        C.is_well_formed("cigar").alias("ok"), V.cigar_faults().alias("n")).collect()
    assert [r.ok for r in got] == [True, True, False] and [r.n for r in got][:2] == [0, 0]


OK = ("r", 0, 1, 100, 30, "4M", -1, 0, 0, "ACGT", "IIII", "G")


def changed(**kw):
    names = [c.split()[0] for c in READ.split(", ")]
    return tuple(kw.get(n, v) for n, v in zip(names, OK))


@pytest.mark.parametrize("row, errors", [
    (OK, []),
    (changed(flag=2), ["INVALID_FLAG_PROPER_PAIR"]), (changed(flag=8), ["INVALID_FLAG_MATE_UNMAPPED"]),
    (changed(flag=32), ["INVALID_FLAG_MATE_NEG_STRAND"]), (changed(flag=64), ["INVALID_FLAG_FIRST_OF_PAIR"]),
    (changed(flag=128), ["INVALID_FLAG_SECOND_OF_PAIR"]), (changed(mate_ref_idx=0), ["INVALID_MATE_REF_INDEX"]),
    (changed(flag=1 + 64), ["INVALID_FLAG_MATE_UNMAPPED"]), (changed(flag=1 + 8), ["PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND"]),
    (changed(flag=65, mate_ref_idx=1), ["INVALID_ALIGNMENT_START"]), (changed(flag=65, mate_ref_idx=9, pnext=5), ["INVALID_REFERENCE_INDEX"]),
    (changed(tlen=-(1 << 29) - 1), ["INVALID_INSERT_SIZE"]), (changed(tlen=1 << 29), []),
    (changed(flag=4 + 256, mapq=0), ["INVALID_FLAG_NOT_PRIM_ALIGNMENT"]), (changed(flag=4), ["INVALID_MAPPING_QUALITY"]),
    (changed(mapq=256), ["INVALID_MAPPING_QUALITY"]), (changed(cigar="*"), ["INVALID_CIGAR"]),
    (changed(ref_idx=-1, pos=0), ["INVALID_FLAG_READ_UNMAPPED"]), (changed(rg="other"), ["READ_GROUP_NOT_FOUND"]),
    (changed(pos=0), ["INVALID_ALIGNMENT_START"]), (changed(pos=2000), ["CIGAR_MAPS_OFF_REFERENCE", "INVALID_ALIGNMENT_START"]),
    (changed(pos=998), ["CIGAR_MAPS_OFF_REFERENCE"]), (changed(pos=997), []), (changed(ref_idx=9), ["INVALID_REFERENCE_INDEX"]),
    (changed(seq="*", qual="*"), ["EMPTY_READ"]), (changed(seq="*", qual="*", flag=256), []),
    (changed(qual="III"), ["MISMATCH_READ_LENGTH_AND_QUALS_LENGTH"]), (changed(qual="*"), []), (changed(cigar="2I2I"), ["INVALID_CIGAR"])])
def test_record_rules(spark, row, errors):
    dic = spark.createDataFrame([(0, 1000), (1, 1000)], "ref_idx int, length int")
    rgs = spark.createDataFrame([("G",)], "id string")
    got = V.validation_errors(reads(spark, row), dic, rgs).collect()
    assert sorted(r.error_type for r in got) == errors


def test_empty_dictionary_and_cigar_length(spark):
    dic = spark.createDataFrame([], "ref_idx int, length int")
    rgs = spark.createDataFrame([("G",)], "id string")
    got = V.validation_errors(reads(spark, changed(cigar="5M")), dic, rgs, check_cigar_length=True).collect()
    assert sorted(r.error_type for r in got) == ["INVALID_CIGAR", "MISSING_SEQUENCE_DICTIONARY"]


def test_colour_space_reads(spark):
    dic = spark.createDataFrame([(1, 1000)], "ref_idx int, length int")
    rgs = spark.createDataFrame([("G",)], "id string")
    base = reads(spark, changed(seq="*", qual="*"), changed(seq="*", qual="*", cigar="2M1I1M"))
    tag = lambda v: F.struct(F.lit("Z").alias("type"), F.lit(v).alias("value"))
    coloured = base.withColumn("tags", F.create_map(F.lit("CQ"), tag("!!"), F.lit("CS"), tag("T0")))
    assert [r.error_type for r in V.validation_errors(coloured, dic, rgs).collect()] == ["EMPTY_READ"]
    flow = base.withColumn("tags", F.create_map(F.lit("FZ"), tag("x")))
    assert V.validation_errors(flow, dic, rgs).isEmpty()


@pytest.mark.parametrize("cigar, room, want", [
    ("10M", 10, "10M"), ("10M", 4, "4M6S"), ("10M3S2H", 4, "4M9S2H"), ("5S10M", 3, "5S3M7S"), ("4M3D4M", 5, "4M1D4S"), ("4M2I4M", 4, "4M6S"),
    ("4M10N4M", 6, "4M2N4S"), ("2H10M", 0, "*")])
def test_clip_past_end(spark, cigar, room, want):
    df = spark.createDataFrame([(cigar, 101, 100 + room)], "cigar string, pos int, len int")
    assert df.select(C.clip_past_end("pos", "cigar", "len").alias("c")).first().c == want


def test_mates(spark):
    pair = lambda name, flag, pos, mate: changed(qname=name, flag=flag, pos=pos, mate_ref_idx=1, pnext=mate)
    rows = [pair("a", 65, 10, 20), pair("a", 129, 20, 10), pair("b", 65, 10, 20), pair("c", 65, 10, 20), pair("c", 129, 20, 10),
            pair("c", 129, 20, 10), pair("d", 65, 10, 20), changed(qname="d", pos=20), pair("e", 1, 10, 20), pair("f", 65, 5, 5), pair("f", 129, 5, 5)]
    got = {(r.qname, r.end): (r.mate_pos, r.n_mates, r.error) for r in R.mate_join(reads(spark, *rows)).collect()}
    assert got[("a", 1)] == (20, 1, None) and got[("a", 2)] == (10, 1, None)
    assert got[("b", 1)] == (None, 0, None) and got[("c", 1)] == (None, 2, "MULTIPLE_MATES")
    assert got[("d", 1)] == (None, 0, "PAIRED_AND_UNPAIRED") and got[("e", 2)][2] == "NOT_ONE_END"
    assert got[("f", 1)] == (5, 1, None) and got[("f", 2)] == (5, 1, None)


def test_mates_are_shuffled_once_unless_hot(spark, monkeypatch):
    rows = [("a", 65, 0, 5, 0, 9), ("a", 129, 0, 9, 0, 5), (None, 65, 0, 5, 0, 9), (None, 65, 0, 5, 0, 9)]
    reads = spark.createDataFrame(rows, "qname string, flag int, ref_idx int, pos int, mate_ref_idx int, pnext int")
    want = [("None", 1, None, 0, None)] * 2 + [("a", 1, 9, 1, None), ("a", 2, 5, 1, None)]
    for hot, slots in ((1 << 21, False), (1, True)):
        monkeypatch.setattr(R, "hot_keys", lambda df, keys, hot=hot: skew.hot_keys(df, keys, hot))
        found = R.mate_join(reads)
        assert ("_slot" in found._jdf.queryExecution().optimizedPlan().toString()) == slots
        assert sorted((str(r.qname), r.end, r.mate_pos, r.n_mates, r.error) for r in found.collect()) == want


def test_duplicates_at_one_hot_place(spark, monkeypatch):
    monkeypatch.setattr(DU, "HOT_ROWS", 50)
    rows = [changed(qname=f"r{i:03d}", qual="I" * 4 if i == 77 else "5555") for i in range(300)]
    rows += [changed(qname="other", pos=101), changed(qname="un", flag=4), changed(qname="sec", flag=256), changed(qname="clip", pos=103, cigar="3S1M", qual="5555")]
    got = {r.qname: r.is_dup for r in DU.mark_duplicates(reads(spark, *rows)).collect()}
    assert [n for n in got if n.startswith("r") and not got[n]] == ["r077"]
    assert not got["other"] and not got["un"] and not got["sec"] and got["clip"]


def ends(name, first=100, second=300, swapped=False, clip=0, qual="IIII", rg="G"):
    """Both ends of a template; ``clip`` moves the start of the forward one behind a soft clip."""
    cigar = f"{clip}S{4 - clip}M" if clip else "4M"
    one, two = (128, 64) if swapped else (64, 128)
    return [changed(qname=name, flag=1 + 32 + one, pos=first + clip, cigar=cigar, mate_ref_idx=1, pnext=second, qual=qual, rg=rg),
            changed(qname=name, flag=1 + 16 + two, pos=second, mate_ref_idx=1, pnext=first + clip, qual=qual, rg=rg)]


def marks(spark, rows):
    got = {}
    for r in DU.mark_duplicates(reads(spark, *rows)).collect():
        got.setdefault(r.qname, []).append(r.is_dup)
    return {n: got[n][0] if len(set(got[n])) == 1 else got[n] for n in got}


def test_both_ends_of_a_template_are_marked_alike(spark):
    """Four records: a clip moves the start of one end, so no record of b has the mate position of one of a."""
    assert marks(spark, ends("a") + ends("b", clip=2, qual="####")) == {"a": False, "b": True}
    assert marks(spark, ends("a", qual="!!!!") + ends("b", clip=2)) == {"a": True, "b": False}
    # each end alone has a better rival, but no other template has both
    rows = ends("a", qual="####") + ends("b", second=400) + ends("c", first=90)
    assert marks(spark, rows) == {"a": False, "b": False, "c": False}


def test_pairs_compete_in_either_order_and_before_fragments(spark):
    rows = ends("a") + ends("b", swapped=True) + ends("c", rg="H") + ends("d", rg=None)
    rows += [changed(qname="f"), changed(qname="g", flag=1 + 8 + 64, mate_ref_idx=1, pnext=100),
             changed(qname="g", flag=1 + 4 + 128, cigar="*", mate_ref_idx=1, pnext=100),
             changed(qname="h", pos=500), changed(qname="i", pos=500, qual="####"), changed(qname="j", pos=297, flag=16, rg="none")]
    # two forward ends are another template than one of each strand
    rows += [changed(qname="k", flag=65), changed(qname="k", flag=129, pos=303)]
    got = marks(spark, rows)
    assert got["g"] in ([True, False], [False, True]) and got.pop("g")
    assert got == {"a": False, "b": True, "c": False, "d": False, "f": True, "h": False, "i": True, "j": False, "k": False}


def test_templates_with_other_records(spark):
    """More than two ends, a name without its other end, and records without a name."""
    odd = [changed(qname="o", flag=65), changed(qname="o", flag=65, pos=50), changed(qname="o", flag=129, pos=900)]
    rows = odd + [changed(qname="p", pos=50, qual="####"), changed(qname=None, pos=50), changed(qname="q", flag=65, pos=700)]
    got = {(r.qname, r.pos): r.is_dup for r in DU.mark_duplicates(reads(spark, *rows)).collect()}
    assert got == {("o", 100): False, ("o", 50): False, ("o", 900): False, ("p", 50): True, (None, 50): False, ("q", 700): False}
    assert DU.mark_duplicates(reads(spark, *odd).limit(0)).collect() == []


def test_ends_are_compared_as_numbers(spark):
    low = -(1 << 31) + 1
    ends = [(ref, five, rev) for ref in (None, -1, 0, 7, (1 << 30) - 1) for five in (None, low, -1, 0, 5, (1 << 31) - 1) for rev in (False, True)]
    rows = spark.createDataFrame(ends[::-1], "ref int, five int, rev boolean")
    packed = rows.withColumn("end", DU._packed(F.col("ref"), F.col("five"), F.col("rev"))).orderBy("end")
    assert [tuple(r) for r in packed.select(*[c.alias(n) for n, c in zip(DU.END, DU._unpacked(F.col("end")))]).collect()] == ends
    with pytest.raises(Exception, match="out of range: 1073741824"):
        rows.limit(1).select(DU._packed(F.lit(1 << 30), F.col("five"), F.col("rev"))).collect()
    plan = DU.templates(spark.createDataFrame(
        [], "qname string, flag int, ref_idx int, pos int, cigar string, qual string, rg string"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_fragments_are_scored_at_their_least_end(spark):
    row = lambda name, pos, qual: (name, 0, 1, pos, "4M", qual, "L")
    rows = [row("a", 9, "IIII"), row("a", 5, "0000"), row("a", 5, "5555"), row("b", 5, None), row("b", 5, "IIII"), row("c", 5, "5550")]
    reads = spark.createDataFrame(rows, "qname string, flag int, ref_idx int, pos int, cigar string, qual string, rg string")
    found = {r.qname: (r.ends, r.score, r.low_five, r.high_five) for r in DU.templates(reads).collect()}
    assert found == {"a": (3, 80, 5, None), "b": (2, None, 5, None), "c": (1, 75, 5, None)}
    marked = {r.qname: r.is_dup for r in DU.mark_duplicates(reads.withColumn("seq", F.lit("ACGT"))).collect()}
    assert marked == {"a": True, "b": False, "c": True}


def test_duplicate_metrics_and_library_size(spark):
    rows = [r for i in range(30) for r in ends(f"t{i}", first=100 + i // 3 * 10)] + [changed(qname="f", pos=900), changed(qname="g", pos=900)]
    rows += [changed(qname="u", flag=4, cigar="*", mapq=0), changed(qname="s", flag=256), changed(qname="x", flag=4, rg="H", cigar="*", mapq=0)]
    got = {r.library: r for r in DU.duplicate_metrics(reads(spark, *rows)).collect()}
    g = got["G"]
    assert (g.unpaired_examined, g.pairs_examined, g.unpaired_duplicates, g.pair_duplicates, g.unmapped, g.not_primary) == (2, 30, 1, 20, 1, 1)
    assert g.duplication == 41 / 62 and got["H"].duplication is None and got["H"].library_size is None
    size = next(x for x in range(10, 1000) if x * (1 - math.exp(-30 / x)) >= 10)  # 30 pairs seen, 10 different
    assert g.library_size in (size - 1, size)


@pytest.mark.parametrize("pairs, unique", [(1000, 999), (10 ** 9, 10 ** 8), (500, 1), (7, 7), (0, 0)])
def test_library_size_solves_the_equation(spark, pairs, unique):
    size = spark.range(1).select(DU.library_size(F.lit(pairs), F.lit(unique)).alias("x")).first().x
    if pairs == unique:
        assert size is None
    else:
        assert abs(size * -math.expm1(-pairs / size) - unique) < 1e-5 * unique + 1


def test_make_unmapped_turns_reverse_reads_and_tags(spark):
    df = reads(spark, changed(flag=16 + 1024, seq="AACG", qual="!\"#$"))
    tag = lambda t, v: F.struct(F.lit(t).alias("type"), F.lit(v).alias("value"))
    df = df.withColumn("tags", F.create_map(F.lit("OQ"), tag("Z", "abcd"), F.lit("E2"), tag("Z", "AACC"), F.lit("SQ"), tag("H", "05C1"), F.lit("NM"), tag("i", "12")))
    r = R.make_unmapped(df, F.lit(True)).first()
    assert (r.flag, r.ref_idx, r.pos, r.cigar, r.mapq, r.seq, r.qual) == (4, -1, 0, "*", 0, "CGTT", "$#\"!")
    assert {k: v.value for k, v in r.tags.items()} == {"OQ": "dcba", "E2": "GGTT", "SQ": "01C5", "NM": "12"}


def test_clipping_positions(spark):
    df = reads(spark, changed(cigar="2H3S4M5S1H"), changed(cigar="4M", flag=4))
    got = df.select(C.unclipped_start().alias("s"), C.unclipped_end().alias("e"), C.alignment_end().alias("a")).collect()
    assert [tuple(r) for r in got] == [(95, 109, 103), (100, 0, 0)]


def test_quality_text(spark):
    df = spark.createDataFrame([("!I~",)], "q string")
    assert df.select(B.phred("q").alias("s"), B.phred_text(B.phred("q")).alias("t"), B.is_phred_text("q").alias("ok")).first() == ([0, 40, 93], "!I~", True)


@pytest.mark.parametrize("seq, cigar, md, deletions, want", [
    ("ACGT", "4M", "4", False, "ACGT"), ("ACGT", "4M", "1A2", False, "AAGT"), ("ACGT", "2M2D2M", "2^TT2", True, "ACTTGT"),
    ("ACGT", "2M2D2M", "2^TT2", False, "ACGT"), ("ACGT", "1S3M", "3", False, "0CGT"), ("ACGT", "1M2I1M", "2", False, "A--T"),
    ("ACGT", "2M3N2M", "4", True, "ACNNNGT"), ("ACGT", "2M3N2M", "4", False, "ACGT"), ("ACGT", "4M", "3", False, None), ("ACGT", "4M", "2?2", False, None),
    ("ACGT", "2M2D2M", "2^T2", True, None), ("ACGT", "2M2D2M", "4", True, None)])
def test_reference_text(spark, seq, cigar, md, deletions, want):
    df = spark.createDataFrame([(seq, cigar, md)], "seq string, cigar string, md string")
    assert df.select(reference_text(F.col("seq"), F.col("cigar"), F.col("md"), deletions).alias("t")).first().t == want


def drawn_read(rng, runs):
    """A read with its CIGAR and MD, and the reference under it with deletions and without."""
    letters = lambda n: "".join(rng.choices("ACGT", k=n))
    seq, cigar, both, plain, md, same, before = "", "", "", "", "", 0, ""
    for _ in range(runs):
        op = rng.choice([o for o in "MMM=XIDNSHP" if o != before])
        n, before = rng.randint(1, 9), op
        cigar += f"{n}{op}"
        if op in "M=X":
            for base in letters(n):
                under = rng.choice([base, base, base, letters(1)])
                seq, both, plain = seq + base, both + under, plain + under
                if under == base:
                    same += 1
                else:
                    md, same = md + (str(same) if same or rng.random() < 0.5 else "") + under, 0
        elif op in "IS":
            seq, both, plain = seq + letters(n), both + "-0"[op == "S"] * n, plain + "-0"[op == "S"] * n
        elif op == "D":
            run = letters(n)
            md, same, both = md + f"{same}^{run}0", 0, both + run  # the 0 keeps a mismatch apart from the deleted run
        elif op == "N":
            both += "N" * n
    return seq, cigar, md + str(same), both, plain


def test_reference_of_drawn_reads(spark):
    """Reads of up to 400 runs tell the reference they were drawn from; a wrong tag tells nothing; no Python is in the plan."""
    rng = random.Random(11)
    rows = [(i, *drawn_read(rng, rng.choice([1, 2, 3, 7, 8, 9, 33, 400]))) for i in range(300)]
    rows = [r for r in rows if r[1]]
    df = spark.createDataFrame(rows, "read_id int, seq string, cigar string, md string, both string, plain string")
    for deletions in (True, False):
        out = M.reconstruct_reference(df, deletions)
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
        assert {r.read_id: r.ref_text for r in out.collect()} == {r[0]: r[4 if deletions else 5] for r in rows}
    wrong = df.withColumn("md", F.concat("md", F.lit("A")))
    assert {r.ref_text for r in M.reconstruct_reference(wrong).collect()} == {None}


def test_long_reads_take_time_in_proportion(spark):
    """Ten times the runs: about ten times the time, not a hundred."""
    def seconds(runs, reads):
        rng = random.Random(runs)
        rows = [(i, *drawn_read(rng, runs)) for i in range(reads)]
        df = spark.createDataFrame(rows, "read_id int, seq string, cigar string, md string, b string, p string").coalesce(1)
        M.reconstruct_reference(df).agg(F.sum(F.length("ref_text"))).collect()
        start = time.time()
        M.reconstruct_reference(df).agg(F.sum(F.length("ref_text"))).collect()
        return time.time() - start

    assert seconds(20000, 2) < 8 * seconds(2000, 20) + 2


def test_running_sums(spark):
    rng = random.Random(2)
    rows = [([rng.randint(0, 9) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 5, 8, 9, 16, 17, 1000)]
    got = spark.createDataFrame(rows, "a array<int>").select("a", running(F.col("a")).alias("s")).collect()
    assert all(r.s == [sum(r.a[:k]) for k in range(len(r.a))] for r in got) and len(got) == 11


def test_mismatches_across_tiles_with_a_hot_tile(spark, monkeypatch):
    monkeypatch.setattr("readloom.operators.skew.HOT_ROWS", 3)
    ref = {p: "ACGT"[p * p % 4] for p in range(1, 41)}
    tiles = spark.createDataFrame([(1, t, "".join(ref[t * 10 + i] for i in range(1, 11))) for t in range(4)], "ref_idx int, tile int, bases string")
    rows, want = [], {}
    for i in range(12):
        pos, seq = 3 + i, "ACGTTGCAACGT"
        cigar = ["12M", "3S9M", "4M2I6M", "5M3D7M"][i % 4]
        rows.append((f"r{i}", 0, 1, pos, cigar, seq, "5" * 12, "g"))
        blocks = {"12M": [(0, 0, 12)], "3S9M": [(3, 0, 9)], "4M2I6M": [(0, 0, 4), (6, 4, 6)], "5M3D7M": [(0, 0, 5), (5, 8, 7)]}[cigar]
        mm = sum(seq[a + k] != ref[pos + b + k] for a, b, n in blocks for k in range(n))
        want[f"r{i}"] = (mm, mm * 20, 2 if "I" in cigar else 0, 3 if "D" in cigar else 0)
    df = spark.createDataFrame(rows, "read_id string, flag int, ref_idx int, pos int, cigar string, seq string, qual string, rg string")
    got = {r.read_id: (r.mismatches, r.mm_qual, r["ins"], r["del"]) for r in M.mismatch_summary(df, tiles, tile=10).collect()}
    assert got == want
    per_base = M.mismatch_join(df, tiles, tile=10).filter("base <> ref_base").groupBy("read_id").count().collect()
    assert {r.read_id: r["count"] for r in per_base} == {k: v[0] for k, v in want.items() if v[0]}


def test_variant_edges(spark):
    rows = [("chr1", 1), ("chrX", 2), ("chrY", 3), ("chrM", 4), ("chrUn_gl1", 5), ("1", 6)]
    got = {r.chrom: r.chrom_num for r in VR.chrom_number(spark.createDataFrame(rows, "chrom string, pos int")).collect()}
    assert got == {"chr1": 1, "chrX": 23, "chrY": 24, "chrM": None, "chrUn_gl1": None, "1": None}


def test_dictionary_checksums_are_numbers(spark):
    schema = "ref_idx int, rname string, length int, md5 string"
    a = spark.createDataFrame([(0, "x", 5, "00AB"), (1, "y", 0, None), (2, "z", 3, "1")], schema)
    b = spark.createDataFrame([(0, "q", 5, "ab"), (1, "y", 9, "7"), (2, "z", 3, "2")], schema)
    assert [(r.ref_idx, r.reason) for r in D.compare_dictionaries(a, b).collect()] == [(2, "MD5")]


def test_a_small_reference_goes_to_the_reads(spark):
    """Pieces of reads are not shuffled to few tiles, and more tiles than that give the same rows."""
    reads = spark.createDataFrame([("r", 0, 1, 998, "6M", "ACGTAC", "IIIIII"), ("s", 16, 1, 5, "3M", "ACG", "III")],
                                  "read_id string, flag int, ref_idx int, pos int, cigar string, seq string, qual string")
    tiles = spark.createDataFrame([(1, 0, "ACGTA" * 200), (1, 1, "CCGTA" * 200)], "ref_idx int, tile int, bases string")
    few = M.mismatch_join(reads, tiles)
    assert "_slot" not in few._jdf.queryExecution().toString()
    small, M.SMALL_TILES = M.SMALL_TILES, 0
    try:
        many = M.mismatch_join(reads, tiles)
        assert "_slot" in many._jdf.queryExecution().toString() and sorted(many.collect()) == sorted(few.collect()) and few.count() == 9
    finally:
        M.SMALL_TILES = small
