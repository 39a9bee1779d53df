"""Queries that write files from the tables with the library's writers and read them back with its readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from readloom.functions import bases as B
from readloom.operators import graph as G
from readloom.operators import intervals as I
from readloom.operators import ordering as O
from readloom.operators import reads as R
from readloom.operators import regions as RG
from readloom.operators.skew import lookup_join
from readloom.plans.base_queries import FAULTS_SQL
from readloom.plans.fixtures import fixture, table
from readloom.plans.graph_queries import BLOCKS_SQL, WALK_SQL, bipartite, top_actor
from readloom.plans.interval_queries import SPANS, islands, main_reads
from readloom.plans.read_queries import COORD, MAPPED, REGION, as_sorted, reads
from readloom.plans.registry import query
from readloom.session import cut_lineage, scratch_dir
from readloom.sources import sam as S
from readloom.sources import text as T
from readloom.sources import vcf as V

# ---- performer blocks


def write_actors(spark: SparkSession, sf_dir: str) -> str:
    """Blocks of at most 500 titles: a performer with more gets several blocks."""
    line = F.concat(F.lit("T"), F.col("title").cast("string"), F.lit("  [role]"))
    blocks = (bipartite(spark, sf_dir).groupBy("actor", F.floor(F.col("title") / 500).alias("part"))
              .agg(F.array_join(F.sort_array(F.collect_list(line)), "\n\t\t\t").alias("titles"))
              .select(F.concat(F.lit("P"), F.col("actor").cast("string"), F.lit("\t"), "titles").alias("value")))
    path = scratch_dir(spark, "actors")
    blocks.write.option("lineSep", "\n\n").text(path)
    return path


@query("io1_read_blocks", """
SELECT concat('P', actor) AS actor, count(DISTINCT title // 500) AS blocks, count(*) AS lines FROM f_costar GROUP BY actor""")
def read_blocks(spark, sf_dir):
    blocks = T.read_blocks(spark, write_actors(spark, sf_dir))
    return blocks.groupBy(F.substring_index("value", "\t", 1).alias("actor")).agg(
        F.count(F.lit(1)).alias("blocks"), F.sum(F.size(F.split("value", "\n"))).alias("lines"))


@query("pf3_parse_bipartite", "SELECT concat('P', actor) AS actor, concat('T', title) AS title FROM f_costar")
def parse_bipartite(spark, sf_dir):
    return G.parse_bipartite(T.read_blocks(spark, write_actors(spark, sf_dir)))


@query("io9_write_report", f"""
WITH RECURSIVE {WALK_SQL}, {BLOCKS_SQL}, rep AS (
SELECT 1 AS ord, '{G.LABEL_ACTORS}' AS label, CAST(count(*) AS VARCHAR) AS value FROM blocks
UNION ALL SELECT 2, '{G.LABEL_TITLES}', CAST(count(DISTINCT title) AS VARCHAR) FROM f_costar
UNION ALL SELECT CAST(s.d + 2 AS INT), concat('{G.LABEL_AT}', s.d), CAST(count(x.id) AS VARCHAR)
 FROM (SELECT unnest(range(1, 7)) AS d) s LEFT JOIN dist x ON x.dist = s.d GROUP BY s.d
UNION ALL SELECT 9, '{G.LABEL_NAMES}6', '' UNION ALL SELECT 10, '', CAST(id AS VARCHAR) FROM dist WHERE dist = 6)
SELECT row_number() OVER (ORDER BY ord, value) - 1 AS ord, concat('(', label, ',', value, ')') AS value FROM rep""")
def write_report(spark, sf_dir):
    path = scratch_dir(spark, "report")
    blocks = T.read_blocks(spark, write_actors(spark, sf_dir))
    bip = cut_lineage(G.parse_bipartite(blocks).select(*[F.substring(c, 2, 1 << 30).cast("long").alias(c) for c in ("actor", "title")]))
    T.write_report(G.separation_report(bip, top_actor(bip), records=blocks), path)
    return T.positioned_lines(spark, path)


# ---- FASTQ

PAIRS_SQL = """good AS (SELECT qname FROM f_ends WHERE flag & 1 <> 0 GROUP BY qname
 HAVING count_if(flag & 64 <> 0) = 1 AND count_if(flag & 128 <> 0) = 1),
fq AS (SELECT dense_rank() OVER (ORDER BY r.qname) - 1 AS rec_id, CASE WHEN flag & 64 <> 0 THEN 1 ELSE 2 END AS source, r.qname, seq, qual
 FROM f_ends r JOIN good g ON g.qname = r.qname WHERE flag & 1 <> 0),
fl AS (SELECT rec_id, source, 0 AS line_no, concat('@', qname) AS value FROM fq UNION ALL SELECT rec_id, source, 1, seq FROM fq
 UNION ALL SELECT rec_id, source, 2, '+' FROM fq UNION ALL SELECT rec_id, source, 3, qual FROM fq)"""


def write_fastq(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Two files in name order, of the names with exactly one row per mate: all paired reads of f_ends.

    One range shuffle brings the rows of a name together and in order, and both files are written from it, compressed.
    """
    first, second = F.col("flag").bitwiseAND(64) != 0, F.col("flag").bitwiseAND(128) != 0
    pairs = fixture(spark, sf_dir, "f_ends").filter((F.col("flag").bitwiseAND(1) != 0) & (first | second)).select("qname", "flag", "seq", "qual")
    end = lambda cond, c: F.max(F.when(cond, F.col(c)))
    names = pairs.repartitionByRange("qname").groupBy("qname").agg(
        F.count_if(first).alias("n1"), F.count_if(second).alias("n2"), end(first, "seq").alias("s1"), end(first, "qual").alias("q1"),
        end(second, "seq").alias("s2"), end(second, "qual").alias("q2")).filter("n1 = 1 AND n2 = 1")
    record = lambda mate: F.struct(F.lit(mate).alias("mate"), F.concat_ws(
        "\n", F.concat(F.lit("@"), F.col("qname")), f"s{mate}", F.lit("+"), f"q{mate}").alias("value"))
    path = scratch_dir(spark, "fastq")
    paths = f"{path}/mate=1", f"{path}/mate=2"
    for folder in paths:  # there is a file even if no name is left
        spark.createDataFrame([], "value string").write.text(folder)
    (names.select("qname", F.explode(F.array(record(1), record(2))).alias("_r")).select("qname", "_r.*")
     .sortWithinPartitions("mate", "qname").select("mate", "value")
     .write.mode("append").partitionBy("mate").option("compression", "gzip").text(path))
    return paths


@query("io2_read_fastq", f"""
WITH {PAIRS_SQL} SELECT rec_id, qname AS name, seq, '+' AS plus, qual FROM fq WHERE source = 1""")
def read_fastq(spark, sf_dir):
    return T.read_fastq(spark, write_fastq(spark, sf_dir)[0])


def zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, two = write_fastq(spark, sf_dir)
    return O.zip_by_position(T.positioned_lines(spark, one), T.positioned_lines(spark, two))


@query("jn13_zip_by_position", f"WITH {PAIRS_SQL} SELECT rec_id, source, line_no, value FROM fl")
def zip_by_position(spark, sf_dir):
    return zipped(spark, sf_dir)


@query("sr7_fastq_order", f"""
WITH {PAIRS_SQL} SELECT row_number() OVER (ORDER BY rec_id, source, line_no) - 1 AS ord, value FROM fl""")
def fastq_order(spark, sf_dir):
    return as_sorted(O.fastq_order(zipped(spark, sf_dir))).select("ord", "value")


@query("io10_write_chunks", f"""
WITH {PAIRS_SQL} SELECT row_number() OVER (ORDER BY rec_id, source, line_no) - 1 AS ord, value FROM fl""")
def write_chunks(spark, sf_dir):
    path = scratch_dir(spark, "chunks")
    T.write_chunks(zipped(spark, sf_dir), 5, path)
    return T.positioned_lines(spark, path)


@query("io3_read_chunks", f"WITH {PAIRS_SQL} SELECT CAST(5 AS BIGINT) AS chunks, count(*) AS lines, CAST(0 AS BIGINT) AS split_records FROM fl")
def read_chunks(spark, sf_dir):
    path = scratch_dir(spark, "chunks")
    T.write_chunks(zipped(spark, sf_dir), 5, path)
    per_chunk = T.read_chunks(spark, f"{path}/chunk=*").groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    return per_chunk.agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("lines"), F.count_if(F.col("n") % 8 != 0).alias("split_records"))


# ---- SAM text

EXTRA_SQL = "concat('NM:i:', mapq, chr(9), 'XA:A:c', chr(9), 'XF:f:1.5', chr(9), 'XB:B:S,1,65535', chr(9), 'XU:Z:a:b')"
NAMED_SQL = """named AS (SELECT r.*, coalesce(d.rname, '*') AS rname, coalesce(m.rname, '*') AS rnext FROM f_reads r
 LEFT JOIN f_dict d ON d.ref_idx = r.ref_idx LEFT JOIN f_dict m ON m.ref_idx = r.mate_ref_idx)"""
HEAD_SQL = """head AS (SELECT 0 AS ord, concat('@HD', chr(9), 'VN:1.0', chr(9), 'SO:coordinate') AS value
 UNION ALL SELECT 1 + ref_idx, concat('@SQ', chr(9), 'SN:', rname, ' extra', chr(9), 'LN:', length, chr(9), 'UR:file:/x/y.fa', chr(9), 'M5:', md5(rname)) FROM f_dict
 UNION ALL SELECT CAST(100 + r_regionkey AS INT), concat('@RG', chr(9), 'ID:G', r_regionkey, chr(9), 'SM:', r_name, chr(9), 'DT:2014-05-0', r_regionkey + 1, 'T10:00:00Z') FROM region
 UNION ALL SELECT 200, concat('@RG', chr(9), 'ID:G0', chr(9), 'PI:abc', chr(9), 'DT:soon')
 UNION ALL SELECT 201, concat('@PG', chr(9), 'ID:bwa', chr(9), 'VN:0.7') UNION ALL SELECT 202, concat('@PG', chr(9), 'ID:dup', chr(9), 'PP:bwa', chr(9), 'PP:other', chr(9), 'plain')
 UNION ALL SELECT 203, concat('@CO', chr(9), 'free: text') UNION ALL SELECT 204, concat('@ZZ', chr(9), 'A:b'))"""


def named_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = fixture(spark, sf_dir, "f_dict")
    own = dictionary.select("ref_idx", "rname")
    mate = dictionary.select(F.col("ref_idx").alias("mate_ref_idx"), F.col("rname").alias("rnext"))
    rows = lookup_join(lookup_join(reads(spark, sf_dir), own, ["ref_idx"]), mate, ["mate_ref_idx"])
    return rows.fillna("*", ["rname", "rnext"]).withColumn("extra", F.expr(EXTRA_SQL))


def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = HEAD_SQL[HEAD_SQL.index("(") + 1:-1]
    return spark.sql(text.replace("FROM f_dict", "FROM {f_dict}").replace("FROM region", "FROM {region}"),
                     f_dict=fixture(spark, sf_dir, "f_dict"), region=table(spark, sf_dir, "region"))


TAGS = {"rg": "RG:Z:", "extra": ""}


def write_sam_text(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "sam")
    S.write_sam(named_reads(spark, sf_dir), header_lines(spark, sf_dir), path, "coordinate", tag_columns=TAGS)
    return path


LINE_SQL = f"""concat_ws(chr(9), qname, CAST(flag AS VARCHAR), rname, CAST(pos AS VARCHAR), CAST(mapq AS VARCHAR), cigar,
 CASE WHEN rnext = rname AND rname <> '*' THEN '=' ELSE rnext END, CAST(pnext AS VARCHAR), CAST(tlen AS VARCHAR), seq, qual,
 concat('RG:Z:', rg), {EXTRA_SQL})"""


@query("io13_write_sam", f"""
WITH {NAMED_SQL}, {HEAD_SQL}, body AS (SELECT *, row_number() OVER (ORDER BY {COORD}) AS k FROM named)
SELECT row_number() OVER (ORDER BY part, ord, k, value) - 1 AS ord, value FROM (SELECT 0 AS part, ord, 0 AS k, value FROM head
 UNION ALL SELECT 1, 0, k, {LINE_SQL.replace("rg)", "'G')")} FROM body)""")
def write_sam(spark, sf_dir):
    path = scratch_dir(spark, "sam")
    # equal sort keys may still differ in the read group: leave it out of the compared text
    rows = named_reads(spark, sf_dir).withColumn("rg", F.lit("G"))
    S.write_sam(rows, header_lines(spark, sf_dir), path, "coordinate", tag_columns=TAGS, compression="gzip")
    return T.positioned_lines(spark, path)


@query("io4_read_sam", f"""
WITH {NAMED_SQL} SELECT qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, ref_idx, mate_ref_idx, rg, mapq AS nm, 'c' AS xa,
 CAST(1.5 AS FLOAT) AS xf, '1,65535' AS xb, 'a:b' AS xu, 6 AS n_tags FROM named""")
def read_sam(spark, sf_dir):
    dictionary = fixture(spark, sf_dir, "f_dict")
    rows = S.read_sam(spark, write_sam_text(spark, sf_dir), "STRICT", dictionary)
    rows = S.resolve_references(rows, dictionary)
    numbers = F.array_join(F.transform(S.tag_numbers("XB"), lambda v: v.cast("int").cast("string")), ",")
    return rows.select(*S.COLUMNS, "ref_idx", "mate_ref_idx", S.tag_text("RG").alias("rg"), S.tag_int("NM").alias("nm"),
                       S.tag_char("XA").alias("xa"), S.tag_float("XF").alias("xf"), numbers.alias("xb"), S.tag_text("XU").alias("xu"),
                       F.size("tags").alias("n_tags"))


BAD_LINE_SQL = """bad AS (SELECT qname, CASE WHEN m = 1 THEN 'x' ELSE CAST(flag AS VARCHAR) END AS flag, CASE m WHEN 2 THEN '=' WHEN 12 THEN 'chrZ' ELSE rname END AS rname,
 CASE WHEN m = 3 THEN '0' ELSE CAST(pos AS VARCHAR) END AS pos, CAST(mapq AS VARCHAR) AS mapq, CASE WHEN m = 5 THEN '5Q' ELSE cigar END AS cigar,
 CASE m WHEN 9 THEN '=' WHEN 13 THEN 'chrZ' ELSE rnext END AS rnext, CASE WHEN m = 7 THEN '5' ELSE CAST(pnext AS VARCHAR) END AS pnext,
 CASE WHEN m = 8 THEN '77' ELSE CAST(tlen AS VARCHAR) END AS tlen, CASE m WHEN 6 THEN 'AC!T' WHEN 14 THEN '*' ELSE seq END AS seq,
 CASE WHEN m = 4 THEN substr(qual, 1, 9) ELSE qual END AS qual, CASE m WHEN 10 THEN 'NM:i:abc' WHEN 11 THEN 'NM' WHEN 15 THEN 'XB:B:c,300' ELSE 'NM:i:1' END AS tag, m
 FROM (SELECT *, (pos + mapq) % 24 AS m FROM named) n)"""


@query("io4_read_sam_lenient", f"""
WITH {NAMED_SQL}, {BAD_LINE_SQL},
v AS (SELECT *, coalesce(TRY_CAST(flag AS INT), 0) AS fl, CAST(pos AS INT) AS p, CAST(mapq AS INT) AS q, CAST(pnext AS INT) AS mp, CAST(tlen AS INT) AS t FROM bad)
SELECT qname, CASE WHEN m = 0 THEN 'NOT_ENOUGH_FIELDS' ELSE concat_ws(',', CASE WHEN TRY_CAST(flag AS INT) IS NULL THEN 'NON_NUMERIC_FLAG' END,
 CASE WHEN rname = '=' THEN 'RNAME_IS_EQUALS' END, CASE WHEN rname = '*' AND fl & 4 = 0 THEN 'RNAME_MISSING_BUT_MAPPED' END,
 CASE WHEN rname <> '*' AND p = 0 THEN 'POS_ZERO_WITH_RNAME' END, CASE WHEN rname <> '*' AND fl & 4 = 0 AND cigar = '*' THEN 'CIGAR_MISSING_WITH_RNAME' END,
 CASE WHEN rname = '*' AND p <> 0 THEN 'POS_WITHOUT_RNAME' END, CASE WHEN rname = '*' AND q <> 0 THEN 'MAPQ_WITHOUT_RNAME' END,
 CASE WHEN rname = '*' AND cigar <> '*' THEN 'CIGAR_WITHOUT_RNAME' END, CASE WHEN cigar = '5Q' THEN 'MALFORMED_CIGAR' END,
 CASE WHEN rnext = '*' AND fl & 1 <> 0 AND fl & 8 = 0 THEN 'MRNM_MISSING_BUT_MATE_MAPPED' END, CASE WHEN rnext <> '*' AND fl & 1 = 0 THEN 'MRNM_ON_UNPAIRED' END,
 CASE WHEN rnext = '=' AND rname = '*' THEN 'MRNM_EQUALS_WITHOUT_RNAME' END, CASE WHEN rnext <> '*' AND mp = 0 THEN 'MPOS_ZERO_WITH_MRNM' END,
 CASE WHEN rnext = '*' AND mp <> 0 THEN 'MPOS_WITHOUT_MRNM' END, CASE WHEN rnext = '*' AND t <> 0 THEN 'ISIZE_WITHOUT_MRNM' END,
 CASE WHEN seq = 'AC!T' THEN 'ILLEGAL_BASE' END, CASE WHEN qual <> '*' AND seq = '*' THEN 'QUAL_WITHOUT_SEQ' END,
 CASE WHEN seq <> '*' AND length(seq) <> length(qual) THEN 'QUAL_LENGTH' END, CASE WHEN tag = 'NM' THEN 'MALFORMED_TAG' END,
 CASE WHEN tag IN ('NM:i:abc', 'XB:B:c,300') THEN 'BAD_TAG_VALUE' END, CASE WHEN rname = 'chrZ' THEN 'RNAME_NOT_IN_DICTIONARY' END,
 CASE WHEN rnext = 'chrZ' THEN 'MRNM_NOT_IN_DICTIONARY' END) END AS errors FROM v""")
def read_sam_lenient(spark, sf_dir):
    select = BAD_LINE_SQL[BAD_LINE_SQL.index("(") + 1:-1].replace("FROM named", "FROM {named}").replace("VARCHAR", "STRING")
    bad = spark.sql(select, named=named_reads(spark, sf_dir))
    short = F.when(F.col("m") == 0, F.lit(None)).otherwise(F.concat_ws("\t", "tlen", "seq", "qual", "tag"))
    line = F.concat_ws("\t", "qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", short)
    path = scratch_dir(spark, "badsam")
    bad.select(line.alias("value")).write.text(path)
    rows = S.read_sam(spark, path, "LENIENT", fixture(spark, sf_dir, "f_dict"))
    return rows.select("qname", F.array_join("_errors", ",").alias("errors"))


# damaged records as text, with comments and blank lines among them
CHECKED_SQL = f"""
source AS MATERIALIZED (SELECT row_number() OVER () AS rid, r.* EXCLUDE (ref_idx, mate_ref_idx), coalesce(x.ref_idx, -1) AS ref_idx,
  coalesce(y.ref_idx, -1) AS mate_ref_idx, CASE WHEN r.ref_idx = -1 THEN '*' ELSE coalesce(x.rname, concat('chr', r.ref_idx)) END AS rname,
  CASE WHEN r.mate_ref_idx = -1 THEN '*' ELSE coalesce(y.rname, concat('chr', r.mate_ref_idx)) END AS rnext
 FROM f_damaged r LEFT JOIN f_dict x ON x.ref_idx = r.ref_idx LEFT JOIN f_dict y ON y.ref_idx = r.mate_ref_idx),
{FAULTS_SQL},
named AS (SELECT rid, unnest([
  CASE WHEN rname = '*' AND flag & 4 = 0 THEN 'RNAME_MISSING_BUT_MAPPED' END, CASE WHEN rname <> '*' AND pos = 0 THEN 'POS_ZERO_WITH_RNAME' END,
  CASE WHEN rname <> '*' AND flag & 4 = 0 AND cigar = '*' THEN 'CIGAR_MISSING_WITH_RNAME' END,
  CASE WHEN rname = '*' AND pos <> 0 THEN 'POS_WITHOUT_RNAME' END, CASE WHEN rname = '*' AND mapq <> 0 THEN 'MAPQ_WITHOUT_RNAME' END,
  CASE WHEN rname = '*' AND cigar <> '*' THEN 'CIGAR_WITHOUT_RNAME' END,
  CASE WHEN rnext = '*' AND flag & 1 <> 0 AND flag & 8 = 0 THEN 'MRNM_MISSING_BUT_MATE_MAPPED' END,
  CASE WHEN rnext <> '*' AND flag & 1 = 0 THEN 'MRNM_ON_UNPAIRED' END, CASE WHEN rnext <> '*' AND pnext = 0 THEN 'MPOS_ZERO_WITH_MRNM' END,
  CASE WHEN rnext = '*' AND pnext <> 0 THEN 'MPOS_WITHOUT_MRNM' END, CASE WHEN rnext = '*' AND tlen <> 0 THEN 'ISIZE_WITHOUT_MRNM' END,
  CASE WHEN seq <> '*' AND qual <> '*' AND length(seq) <> length(qual) THEN 'QUAL_LENGTH' END,
  CASE WHEN rname <> '*' AND ref_idx = -1 THEN 'RNAME_NOT_IN_DICTIONARY' END,
  CASE WHEN rnext <> '*' AND mate_ref_idx = -1 THEN 'MRNM_NOT_IN_DICTIONARY' END]) AS error_type FROM source),
every AS (SELECT rid, error_type FROM named WHERE error_type IS NOT NULL UNION SELECT rid, error_type FROM e
 UNION ALL SELECT -r_regionkey - 1, 'HEADER_AMONG_RECORDS' FROM region UNION ALL SELECT -r_regionkey - 100, 'NOT_ENOUGH_FIELDS' FROM region)"""


@query("io4_read_sam_checked", f"""
WITH {CHECKED_SQL} SELECT error_type AS rule, count(DISTINCT rid) AS n FROM every GROUP BY 1
UNION ALL SELECT 'bad_lines', count(DISTINCT rid) FROM every
UNION ALL SELECT 'lines', (SELECT count(*) FROM source) + 2 * (SELECT count(*) FROM region)""")
def read_sam_checked(spark, sf_dir):
    """What a LENIENT read with record checks counts while its records are written, in one pass."""
    dictionary, groups = fixture(spark, sf_dir, "f_dict"), table(spark, sf_dir, "region").filter("r_regionkey <> 3").select(
        F.concat(F.lit("G"), F.col("r_regionkey")).alias("id"))
    name = lambda key, out: dictionary.select(F.col("ref_idx").alias(key), F.col("rname").alias(out))
    damaged = fixture(spark, sf_dir, "f_damaged")
    rows = damaged.join(F.broadcast(name("ref_idx", "_own")), "ref_idx", "left").join(
        F.broadcast(name("mate_ref_idx", "_mate")), "mate_ref_idx", "left")
    text = lambda key, own: F.when(F.col(key) == -1, F.lit("*")).otherwise(F.coalesce(own, F.concat(F.lit("chr"), key)))
    rows = rows.withColumn("rname", text("ref_idx", "_own")).withColumn("rnext", text("mate_ref_idx", "_mate"))
    late = table(spark, sf_dir, "region").select(F.explode(F.array(F.concat(F.lit("@CO\tlate "), "r_name"), F.lit(""))).alias("value"))
    header = header_lines(spark, sf_dir).orderBy("ord", "value").select("value").coalesce(1)
    path, out = scratch_dir(spark, "checked"), scratch_dir(spark, "records")
    header.union(rows.select(S.sam_line({"rg": "RG:Z:"}).alias("value"))).union(late).write.text(path)
    tally = Observation("lines")
    S.read_sam(spark, path, "LENIENT", dictionary, groups, tally).write.parquet(out)
    return spark.createDataFrame([(k, v) for k, v in tally.get.items() if v], "rule string, n long")


def _write_header(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "header")
    header_lines(spark, sf_dir).orderBy("ord", "value").select("value").write.text(path)
    return path


@query("io5_read_sequence_dict", "SELECT ref_idx, rname, length, md5(rname) AS md5 FROM f_dict")
def read_sequence_dict(spark, sf_dir):
    return S.read_sequence_dict(spark, _write_header(spark, sf_dir))


@query("io6_read_sam_header", f"""
WITH {HEAD_SQL}, n AS (SELECT row_number() OVER (ORDER BY ord, value) - 1 AS pos, ord, value, substr(value, 2, 2) AS kind FROM head)
SELECT pos AS ord, kind, CASE WHEN kind IN ('SQ', 'RG', 'PG') THEN regexp_extract(value, '(SN|ID):(\\S+)', 2) WHEN kind = 'HD' THEN '1.0' END AS id,
 CASE WHEN ord = 200 THEN 'HEADER_RECORD_MISSING_REQUIRED_TAG,INVALID_DATE_STRING,INVALID_PREDICTED_MEDIAN_INSERT_SIZE'
  WHEN ord = 202 THEN 'POORLY_FORMATTED_HEADER_TAG,HEADER_TAG_MULTIPLY_DEFINED' WHEN kind = 'ZZ' THEN 'UNRECOGNIZED_HEADER_TYPE' ELSE '' END AS errors,
 CASE WHEN kind = 'SQ' THEN 'file:/x/y.fa' WHEN ord = 202 THEN 'bwa' WHEN kind = 'CO' THEN 'free: text' END AS detail FROM n""")
def read_sam_header(spark, sf_dir):
    header = S.read_sam_header(spark, _write_header(spark, sf_dir))
    attr = lambda name: F.col("attrs")[name]
    return header.select("ord", "kind", "id", F.array_join("errors", ",").alias("errors"),
                         F.coalesce(attr("UR"), attr("PP"), attr("text")).alias("detail"))


@query("sf20_header_dates", """
SELECT concat('G', r_regionkey) AS id, CAST(concat('2014-05-0', r_regionkey + 1, ' 10:00:00') AS TIMESTAMP) AS run_date FROM region
UNION ALL SELECT 'G0', NULL""")
def header_dates(spark, sf_dir):
    header = S.read_sam_header(spark, _write_header(spark, sf_dir)).filter("kind = 'RG'")
    return header.select("id", S.parse_date(F.col("attrs")["DT"]).alias("run_date"))


@query("io15_export_uppercase_names", f"""
SELECT row_number() OVER (ORDER BY {COORD}) - 1 AS ord, upper(qname) AS qname, flag, pos FROM f_reads""")
def export_uppercase_names(spark, sf_dir):
    path = scratch_dir(spark, "upper")
    placed = O.ordinal(named_reads(spark, sf_dir), R.coordinate_order(), stored=True)
    no_header = spark.createDataFrame([], "ord long, value string")
    S.write_sam(R.export_uppercase_names(placed), no_header, path, "unsorted", presorted_by="ord")
    lines = T.positioned_lines(spark, path)
    field = F.split("value", "\t")
    return lines.select("ord", field[0].alias("qname"), field[1].cast("int").alias("flag"), field[3].cast("int").alias("pos"))


STAR = "CASE WHEN {0} = 0 THEN '*' ELSE CAST({0} AS VARCHAR) END"


@query("io16_view", f"""
WITH {NAMED_SQL} SELECT concat_ws(chr(9), qname, CAST(flag AS VARCHAR), rname, {STAR.format('pos')}, CAST(mapq AS VARCHAR), cigar,
 CASE WHEN rnext = rname AND rname <> '*' THEN '=' ELSE rnext END, {STAR.format('pnext')}, {STAR.format('tlen')}, seq, qual, concat('RG:Z:', rg)) AS line FROM named""")
def view(spark, sf_dir):
    return R.view(reads(spark, sf_dir), fixture(spark, sf_dir, "f_dict"))


@query("sf18_original_qualities", f"""
SELECT qname, flag, length(qual) * (ascii(qual) - 33) AS total FROM f_reads""")
def original_qualities(spark, sf_dir):
    rows = named_reads(spark, sf_dir).withColumn("oq", F.col("qual"))
    path = scratch_dir(spark, "oq")
    S.write_sam(rows, spark.createDataFrame([], "ord long, value string"), path, "unsorted", tag_columns={"oq": "OQ:Z:"})
    back = S.read_sam(spark, path, "SILENT")
    return back.select("qname", "flag", B.quality_sum(S.tag_text("OQ")).cast("long").alias("total"))


# ---- variants and intervals

VCF_SQL = """vcf AS (SELECT CASE chrom_num WHEN 23 THEN 'chrX' WHEN 24 THEN 'chrY' ELSE concat('chr', chrom_num) END AS chrom, chrom_num, pos, ref, alt,
 CAST(qual AS DOUBLE) AS qual FROM f_variants_a), vl AS (SELECT *, concat_ws(chr(9), chrom, CAST(pos AS VARCHAR), '.', ref, alt, CAST(CAST(qual AS INT) AS VARCHAR), 'PASS', '.', 'GT', '0/1') AS line FROM vcf)"""


def variant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = fixture(spark, sf_dir, "f_variants_a")
    chrom = F.when(F.col("chrom_num") == 23, "chrX").when(F.col("chrom_num") == 24, "chrY").otherwise(F.concat(F.lit("chr"), "chrom_num"))
    line = F.concat_ws("\t", chrom, F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.col("qual").cast("string"),
                       F.lit("PASS"), F.lit("."), F.lit("GT"), F.lit("0/1"))
    return calls.select("chrom_num", "pos", line.alias("line"))


def _write_vcf(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "vcf")
    V.write_vcf(variant_lines(spark, sf_dir), path)
    return path


@query("io7_read_vcf", f"WITH {VCF_SQL} SELECT chrom, chrom_num, pos, ref, alt, qual, line FROM vl")
def read_vcf(spark, sf_dir):
    return V.read_vcf(spark, _write_vcf(spark, sf_dir))


@query("io11_write_vcf", f"""
WITH {VCF_SQL} SELECT row_number() OVER (ORDER BY c, p, line) - 1 AS ord, line AS value FROM (SELECT chrom_num AS c, pos AS p, line FROM vl
 UNION ALL SELECT -1, -1, '{V.HEADER}')""")
def write_vcf(spark, sf_dir):
    return T.positioned_lines(spark, _write_vcf(spark, sf_dir))


def _regions_sql(line: str) -> str:
    return f"""WITH {SPANS}, {islands('spans', 51)} SELECT row_number() OVER (ORDER BY rname, start_pos, end_pos) - 1 AS ord, {line} AS value
FROM islands JOIN f_dict USING (ref_idx)"""


def _write_regions(spark: SparkSession, sf_dir: str, style: str) -> DataFrame:
    path = scratch_dir(spark, style)
    merged = I.merge_intervals(main_reads(spark, sf_dir))
    S.write_regions(lookup_join(merged, fixture(spark, sf_dir, "f_dict").select("ref_idx", "rname"), ["ref_idx"]), path, style)
    return T.positioned_lines(spark, path)


@query("io12_write_regions", _regions_sql("concat(rname, ':', start_pos, '-', end_pos)"))
def write_regions(spark, sf_dir):
    return _write_regions(spark, sf_dir, "region")


@query("io12_write_regions_bed", _regions_sql("concat_ws(chr(9), rname, CAST(start_pos - 1 AS VARCHAR), CAST(end_pos AS VARCHAR))"))
def write_regions_bed(spark, sf_dir):
    return _write_regions(spark, sf_dir, "bed")


@query("io12_write_regions_bed_compat", _regions_sql("concat_ws(chr(9), rname, CAST(start_pos - 1 AS VARCHAR), CAST(end_pos - 1 AS VARCHAR))"))
def write_regions_bed_compat(spark, sf_dir):
    return _write_regions(spark, sf_dir, "bed_compat")


# ---- user functions


@query("ud1_map_chunks", "SELECT qname, flag, CAST(length(seq) - length(replace(seq, 'G', '')) AS BIGINT) AS g FROM f_reads")
def map_chunks(spark, sf_dir):
    def count_g(batches):
        for pdf in batches:
            yield pdf[["qname", "flag"]].assign(g=pdf.seq.str.count("G"))

    return RG.map_chunks(reads(spark, sf_dir).select("qname", "flag", "seq"), count_g, "qname string, flag int, g long")


@query("ud2_apply_regions_by_cost", """
SELECT lang, count(*) AS n, CAST(sum(octet_length(encode(coalesce(text, '')))) AS BIGINT) AS bytes, true AS bounded FROM documents GROUP BY lang""")
def apply_regions_by_cost(spark, sf_dir):
    """Whole texts of all lengths in regions of 256 kB at most, unless one text is longer."""
    import pandas as pd

    limit = 1 << 18

    def summarise(region):
        size = region.text.fillna("").str.encode("utf-8").str.len()
        fits = int(size.sum()) <= limit or len(region) == 1
        return region.assign(bytes=size).groupby("lang", dropna=False, as_index=False).agg(n=("bytes", "size"), bytes=("bytes", "sum")).assign(fits=fits)

    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", "text")
    parts = RG.apply_regions_by_cost(docs, ["lang", "doc_id"], summarise, "lang string, n long, bytes long, fits boolean", limit, stored=True)
    return parts.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min("fits").alias("bounded"))


@query("ud2_apply_regions", f"""
WITH n AS (SELECT CAST(ceil(count(*) / 4000.0) AS BIGINT) AS k FROM f_reads WHERE {MAPPED}),
o AS (SELECT *, row_number() OVER (ORDER BY {REGION}) - 1 AS i, count(*) OVER () AS t FROM f_reads WHERE {MAPPED}),
b AS (SELECT *, CASE WHEN i < (t % k) * (t // k + 1) THEN i // (t // k + 1) ELSE t % k + (i - (t % k) * (t // k + 1)) // (t // k) END AS bucket FROM o, n)
SELECT CAST(bucket AS INT) AS bucket, count(*) AS n, arg_min(pos, i) AS first_pos, arg_max(pos, i) AS last_pos FROM b GROUP BY bucket""")
def apply_regions(spark, sf_dir):
    import pandas as pd

    def summarise(region):
        return pd.DataFrame({"bucket": [int(region.bucket.iloc[0])], "n": [len(region)],
                             "first_pos": [int(region.pos.iloc[0])], "last_pos": [int(region.pos.iloc[-1])]})

    return RG.apply_regions(main_reads(spark, sf_dir), R.region_order(), summarise,
                            "bucket int, n long, first_pos int, last_pos int", max_rows=4000, stored=True)
