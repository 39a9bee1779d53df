"""File readers and writers on hand-made files."""

import gzip
import re
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from readloom.functions import flags as FL
from readloom.operators import reads as R
from readloom.sources import sam as S
from readloom.sources import text as T
from readloom.sources import vcf as V

SAM = ("@HD\tVN:1.0\tSO:coordinate\n@SQ\tSN:chr1 x\tLN:1000\n@SQ\tSN:chr2\tLN:abc\n"
       "a\t0\tchr1\t5\t30\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:1\tNM:i:2\tXZ:Z:a:b\n")


def test_gzip_modes_and_tags(spark, tmp_path):
    (tmp_path / "x.sam.gz").write_bytes(gzip.compress((SAM + "b\t0\tchr1\n").encode()))
    path = str(tmp_path / "x.sam.gz")
    rows = {r.qname: r for r in S.read_sam(spark, path, "LENIENT").collect()}
    assert rows["a"]._errors == [] and rows["b"]._errors == ["NOT_ENOUGH_FIELDS"]
    assert rows["a"].tags["NM"].value == "2" and rows["a"].tags["XZ"].value == "a:b"
    assert "_errors" not in S.read_sam(spark, path, "SILENT").columns
    with pytest.raises(Exception, match="bad record .NOT_ENOUGH_FIELDS. in .*x.sam.gz: b"):
        S.read_sam(spark, path, "STRICT").count()
    with pytest.raises(ValueError):
        S.read_sam(spark, path, "LOUD")


@pytest.mark.parametrize("tag,good", [
    ("NM:i:-7", True), ("NM:i:2147483648", False), ("XA:A:c", True), ("XA:A:cc", False), ("XF:f:1.5", True), ("XF:f:x", False),
    ("XH:H:1f", True), ("XH:H:1", False), ("XB:B:C,255,0", True), ("XB:B:C,256", False), ("XB:B:S,65535", True), ("XB:B:S,65536", False),
    ("XB:B:c,1,,2", False), ("XB:B:f,1.5,-2", True), ("XU:Z:", True), ("XQ:Q:1", False), ("NM", False), ("", False)])
def test_one_pattern_tells_good_tags(tag, good):
    java = S._GOOD_TAGS.replace("\\z", "\\Z")  # Python's name for the end of a text
    for text in (f"\t{tag}", f"\tNM:i:1\t{tag}\tXZ:Z:a:b"):
        assert (re.match(java, text) is not None) == good


def test_tags_are_taken_from_one_text(spark, tmp_path):
    tags = ["NM:i:1\tXA:A:c", "NM:i:1\tNM:i:2\tXZ:Z:", "a::b:c\tplain\t\tXB:B:S,1,65536", ""]
    (tmp_path / "x").write_text("".join(f"{k}\t0\tc\t5\t30\t4M\t*\t0\t0\tACGT\tIIII\t{t}\n" for k, t in enumerate(tags)))
    rows = {r.qname: r for r in S.read_sam(spark, str(tmp_path / "x")).collect()}
    assert {k: {n: tuple(v) for n, v in r.tags.items()} for k, r in rows.items()} == {
        "0": {"NM": ("i", "1"), "XA": ("A", "c")}, "1": {"NM": ("i", "2"), "XZ": ("Z", "")},
        "2": {"a:": ("b", "c"), "XB": ("B", "S,1,65536")}, "3": {}}
    assert rows["2"]._errors == ["EMPTY_FIELD", "MALFORMED_TAG", "BAD_TAG_VALUE"] and rows["3"]._errors == ["EMPTY_FIELD", "MALFORMED_TAG"]
    plan = S.read_sam(spark, str(tmp_path / "x"), "SILENT")._jdf.queryExecution().analyzed().toString()
    assert "map_from_arrays(_names" in plan  # without a lambda per field


def test_header_and_dictionary(spark, tmp_path):
    (tmp_path / "x.dict").write_text(SAM)
    header = S.read_sam_header(spark, str(tmp_path / "x.dict"))
    assert [(r.kind, r.id) for r in header.orderBy("ord").collect()] == [("HD", "1.0"), ("SQ", "chr1"), ("SQ", "chr2")]
    want = [(0, "chr1", 1000), (1, "chr2", 0)]
    for dic in (S.read_sequence_dict(spark, str(tmp_path / "x.dict")), S.dictionary_of(header)):
        assert sorted((r.ref_idx, r.rname, r.length) for r in dic.collect()) == want


def test_write_sam_checks_presorted_rows(spark, tmp_path):
    rows = [("a", 0, "c", 5, 1, "1M", "*", 0, 0, "A", "I", 0, -1, 0), ("b", 0, "c", 4, 1, "1M", "c", 4, 0, "A", "I", 0, 0, 1)]
    reads = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, "
                                        "tlen int, seq string, qual string, ref_idx int, mate_ref_idx int, at long")
    header = spark.createDataFrame([(0, "@HD\tVN:1.0")], "ord long, value string")
    with pytest.raises(ValueError, match="coordinate"):
        S.write_sam(reads, header, str(tmp_path / "no"), "coordinate", presorted_by="at")
    S.write_sam(reads, header, str(tmp_path / "yes"), "coordinate")
    lines = [r.value for r in T.positioned_lines(spark, str(tmp_path / "yes")).orderBy("ord").collect()]
    assert [line.split("\t")[0] for line in lines] == ["@HD", "b", "a"] and lines[1].split("\t")[6] == "="


def test_records_are_sorted_as_columns(spark, tmp_path):
    rows = [(f"q{k % 7}", 16 * (k % 2), "c", k * 37 % 11, 1, "1M", "*", 0, 0, "A", "I", ref, -1)
            for k in range(200) for ref in (None, -1, 0, 3, (1 << 31) - 1, -(1 << 31))]
    reads = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, "
                                        "tlen int, seq string, qual string, ref_idx int, mate_ref_idx int")
    reads = reads.withColumn("pos", F.when(F.col("pos") == 3, F.lit(None)).when(F.col("pos") == 4, -9).otherwise(F.col("pos")))
    header = spark.createDataFrame([(1, "@SQ\tSN:c\tLN:9"), (0, "@HD\tVN:1.0")], "ord long, value string")
    S.write_sam(reads.withColumn("rg", F.col("ref_idx").cast("string")), header, str(tmp_path / "s"), tag_columns={"rg": "RG:Z:"}, compression="gzip")
    assert {f.suffix for f in (tmp_path / "s").glob("part-*")} == {".gz"}
    lines = [r.value for r in T.positioned_lines(spark, str(tmp_path / "s")).orderBy("ord").collect()]
    want = R.coordinate_sort(reads).select(S.sam_line(), F.col("ref_idx").cast("string")).collect()
    assert lines[:2] == ["@HD\tVN:1.0", "@SQ\tSN:c\tLN:9"]
    assert lines[2:] == [line if ref is None else f"{line}\tRG:Z:{ref}" for line, ref in want]


def test_positions_over_many_splits_and_files(spark, tmp_path):
    for part, start in enumerate((0, 700, 1500)):
        end = (700, 1500, 2000)[part]
        (tmp_path / f"part-{part}").write_text("".join(f"line {i}\n" for i in range(start, end)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = T.positioned_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.ord, r.value) for r in rows) == [(i, f"line {i}") for i in range(2000)]


def test_fastq_with_awkward_qualities(spark, tmp_path):
    (tmp_path / "f.fq").write_text("@r1 x\nACGT\n+\n@@II\n@r2\nAC\n+r2\n+@\n")
    got = sorted((r.rec_id, r.name, r.seq, r.plus, r.qual) for r in T.read_fastq(spark, str(tmp_path / "f.fq")).collect())
    assert got == [(0, "r1 x", "ACGT", "+", "@@II"), (1, "r2", "AC", "+r2", "+@")]


def test_vcf_lines(spark, tmp_path):
    (tmp_path / "v.vcf").write_text("##contig=<ID=chr1>\n#CHROM\tPOS\n\nchr2\t7\t.\tA\tC\t31.5\nchrM\t3\t.\tG\tT\t.\n")
    rows = {r.chrom: r for r in V.read_vcf(spark, str(tmp_path / "v.vcf")).collect()}
    assert (rows["chr2"].chrom_num, rows["chr2"].pos, rows["chr2"].qual) == (2, 7, 31.5)
    assert rows["chrM"].chrom_num is None and rows["chrM"].qual is None
    V.write_vcf(V.read_vcf(spark, str(tmp_path / "v.vcf")).filter("chrom_num IS NOT NULL"), str(tmp_path / "out"))
    lines = T.positioned_lines(spark, str(tmp_path / "out")).orderBy("ord").collect()
    assert [r.value for r in lines] == [V.HEADER, "chr2\t7\t.\tA\tC\t31.5"]


def test_flag_bits():
    assert [FL.PAIRED, FL.PROPER, FL.UNMAPPED, FL.MATE_UNMAPPED, FL.REVERSE, FL.MATE_REVERSE, FL.FIRST, FL.SECOND, FL.NOT_PRIMARY,
            FL.FAILS_QC, FL.DUPLICATE] == [1 << i for i in range(11)]


def test_part_files_follow_their_numbers(spark, tmp_path):
    for n in (99999, 100000, 7):
        (tmp_path / f"part-{n:05d}-x.txt").write_text(f"{n}\n")
    rows = T.positioned_lines(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r.value for r in rows] == ["7", "99999", "100000"]


def test_one_at_sign_belongs_to_the_record(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@@n1\nAC\n+\nII\n")
    assert T.read_fastq(spark, str(tmp_path / "a.fq")).first().name == "@n1"


def test_header_first_and_unnumbered_contigs_last(spark, tmp_path):
    rows = [("chrUn_1", None, 7, "chrUn_1\t7"), ("chr2", 2, 9, "chr2\t9"), ("chrM", None, 7, "chrM\t7"), ("chr1", 1, 9, "chr1\t9")]
    V.write_vcf(spark.createDataFrame(rows, "chrom string, chrom_num int, pos int, line string"), str(tmp_path / "v"))
    lines = [r.value for r in T.positioned_lines(spark, str(tmp_path / "v")).orderBy("ord").collect()]
    assert lines == [V.HEADER, "chr1\t9", "chr2\t9", "chrM\t7", "chrUn_1\t7"]


def test_unsorted_records_are_written_by_many_tasks(spark, tmp_path):
    reads = spark.range(1000).repartition(6).select(
        F.concat(F.lit("r"), "id").alias("qname"), *[F.lit(v).alias(n) for n, v in zip(S.COLUMNS[1:], (4, "*", 0, 0, "*", "*", 0, 0, "A", "I"))])
    header = spark.createDataFrame([(0, "@HD\tVN:1.0")], "ord long, value string")
    S.write_sam(reads, header, str(tmp_path / "s"), "unsorted")
    lines = [r.value for r in T.positioned_lines(spark, str(tmp_path / "s")).orderBy("ord").collect()]
    assert lines[0] == "@HD\tVN:1.0" and len(lines) == 1001
    assert sum(p.stat().st_size > 0 for p in (tmp_path / "s").glob("part-*")) == 7


GOOD = "\t0\tchr1\t5\t30\t4M\t*\t0\t0\tACGT\tIIII\tRG:Z:G\n"


def test_no_line_vanishes(spark, tmp_path):
    """Late header lines and blank lines are rows with faults, whatever the mode; the header is not."""
    (tmp_path / "x.sam").write_text("@HD\tVN:1.0\n@CO\tsame\na" + GOOD + "@CO\tsame\n\nb" + GOOD + "@c" + GOOD)
    rows = S.read_sam(spark, str(tmp_path / "x.sam"), "LENIENT").collect()
    assert [(r.qname, r._errors) for r in rows] == [
        ("a", []), ("@CO", ["HEADER_AMONG_RECORDS"]), ("", ["NOT_ENOUGH_FIELDS"]), ("b", []), ("@c", ["HEADER_AMONG_RECORDS"])]
    assert S.read_sam(spark, str(tmp_path / "x.sam"), "SILENT").count() == 5
    with pytest.raises(Exception, match="HEADER_AMONG_RECORDS.*x.sam: @CO"):
        S.read_sam(spark, str(tmp_path / "x.sam"), "STRICT").collect()


def test_header_over_files_and_splits(spark, tmp_path):
    """Part files by number: header alone, header and records, records with a late header; small splits change nothing."""
    (tmp_path / "part-0").write_text("@HD\tVN:1.0\r\n" + "".join(f"@SQ\tSN:c{i}\tLN:9\r\n" for i in range(40)))
    (tmp_path / "part-2").write_text("@CO\tlast\n" + "".join(f"r{i}" + GOOD for i in range(200)))
    (tmp_path / "part-10").write_text("@CO\tlate\n" + "".join(f"s{i}" + GOOD for i in range(100)))
    (tmp_path / "part-11").write_text("")
    head = S.sam_head(spark, str(tmp_path))
    assert len(head.lines) == 42 and (head.last, head.count, head.size) == (1, 1, 9)
    for limit in ("300", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
        try:
            rows = S.read_sam(spark, str(tmp_path), "LENIENT").collect()
            kinds = [r.kind for r in S.read_sam_header(spark, str(tmp_path)).orderBy("ord").collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(rows) == 301 and [r.qname for r in rows if r._errors] == ["@CO"]
        assert kinds == ["HD", *["SQ"] * 40, "CO"]
    with pytest.raises(FileNotFoundError):
        S.sam_head(spark, str(tmp_path / "none*"))


@pytest.mark.parametrize("text, lines, size, whole", [
    ("", 0, 0, True), ("a\t", 0, 0, False), ("@HD", 1, 3, True), ("@HD\r@CO\r\nx", 2, 9, False), ("@HD\n\n@CO\n", 1, 4, False),
    ("@CO\t" + "x" * 200000 + "\n@CO\n", 2, 200009, True), ("@CO\r\n" * 30000 + "r", 30000, 150000, False)])
def test_where_a_header_ends(text, lines, size, whole):
    class Stream:
        def __init__(self):
            self.rest = text.encode()

        def readNBytes(self, n):
            out, self.rest = self.rest[:min(n, 70000)], self.rest[min(n, 70000):]
            return out

    found, read, rest = S._leading_header(Stream())
    assert (len(found), read, rest) == (lines, size, whole)


def test_record_checks_and_tally_in_one_pass(spark, tmp_path):
    dictionary = spark.createDataFrame([(0, "chr1", 100), (1, "chr2", 100)], "ref_idx int, rname string, length int")
    groups = spark.createDataFrame([("G",)], "id string")
    lines = ["a" + GOOD, "b\t2\tchr1\t5\t30\t4M\t*\t0\t0\tACGT\tIIII\tRG:Z:H\n", "c\t0\tchr1\t98\t30\t4M\t*\t0\t0\tACGT\tIII\n",
             "d\t0\tchrX\t5\t30\t4M\t*\t0\t0\tACGT\tIIII\n", "e\tx\tchr1\n", "@CO\tlate\n",
             "f\t1\tchr1\t5\t30\t4M\t=\t500\t0\tACGT\tIIII\n", "g\t0\tchr1\t5\t30\t2I2I\t*\t0\t0\tACGT\tIIII\n"]
    (tmp_path / "x.sam").write_text("@HD\tVN:1.0\n" + "".join(lines))
    tally = Observation("t")
    rows = S.read_sam(spark, str(tmp_path / "x.sam"), "LENIENT", dictionary, groups, tally)
    want = {
        "a": [], "b": ["INVALID_FLAG_PROPER_PAIR", "READ_GROUP_NOT_FOUND"],
        "c": ["QUAL_LENGTH", "MISMATCH_READ_LENGTH_AND_QUALS_LENGTH", "CIGAR_MAPS_OFF_REFERENCE"],
        "d": ["RNAME_NOT_IN_DICTIONARY", "INVALID_FLAG_READ_UNMAPPED", "INVALID_ALIGNMENT_START"], "e": ["NOT_ENOUGH_FIELDS"],
        "@CO": ["HEADER_AMONG_RECORDS"], "f": ["INVALID_ALIGNMENT_START", "PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND"],
        "g": ["INVALID_CIGAR"]}
    assert {r.qname: sorted(r._errors) for r in rows.collect()} == {k: sorted(v) for k, v in want.items()}
    counts = {k: v for k, v in tally.get.items() if v}
    assert (counts.pop("lines"), counts.pop("bad_lines")) == (8, 7)
    assert counts == Counter(rule for own in want.values() for rule in set(own))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("] text") == 1  # one scan
    with pytest.raises(Exception, match="INVALID_FLAG_PROPER_PAIR,READ_GROUP_NOT_FOUND.*: b"):
        S.read_sam(spark, str(tmp_path / "x.sam"), "STRICT", dictionary, groups).collect()
    for bad in ({"rgs": groups}, {"mode": "SILENT", "tally": Observation("u")}):
        with pytest.raises(ValueError):
            S.read_sam(spark, str(tmp_path / "x.sam"), **bad)


def test_header_kind_is_not_cut(spark, tmp_path):
    (tmp_path / "h").write_text("@ABCDEFGHIJKLMNOP\tx:y\n")
    r = S.read_sam_header(spark, str(tmp_path / "h")).first()
    assert (r.kind, r.errors) == ("ABCDEFGHIJKLMNOP", ["UNRECOGNIZED_HEADER_TYPE"])


def test_fastq_faults(spark, tmp_path):
    (tmp_path / "f.fq").write_text("@n1\nACG\n+\nIII\nn0\nAC\n-\nI\n@n2\nAC\n")
    path = str(tmp_path / "f.fq")
    got = {r.name: (r.qual, r._errors) for r in T.read_fastq(spark, path, "LENIENT").collect()}
    assert got == {"n1": ("III", []), "n0": ("I", ["NAME_WITHOUT_AT", "PLUS_MISSING", "QUAL_LENGTH"]), "n2": (None, ["TRUNCATED_RECORD"])}
    assert T.read_fastq(spark, path, "SILENT").count() == 3
    with pytest.raises(Exception, match="bad FASTQ record"):
        T.read_fastq(spark, path).collect()
    with pytest.raises(ValueError):
        T.read_fastq(spark, path, "LOUD")


def test_chunks_of_several_files(spark, tmp_path, monkeypatch):
    """A chunk is no single task's work, and its files follow each other."""
    monkeypatch.setattr(T, "CHUNK_LINES", 100)
    lines = spark.range(4000).select(F.floor(F.col("id") / 8).alias("rec_id"), (F.floor(F.col("id") / 4) % 2 + 1).cast("int").alias("source"),
                                     (F.col("id") % 4).cast("int").alias("line_no"), F.col("id").cast("string").alias("value"))
    path = str(tmp_path / "chunks")
    T.write_chunks(lines.repartition(7), 5, path)
    assert [r.value for r in T.positioned_lines(spark, path).orderBy("ord").collect()] == [str(i) for i in range(4000)]
    sizes = T.read_chunks(spark, f"{path}/chunk=*").groupBy("chunk").count().collect()
    assert len(sizes) == 5 and all(r["count"] % 8 == 0 for r in sizes) and len(list((tmp_path / "chunks").glob("chunk=*/part*"))) > 25
