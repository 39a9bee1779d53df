"""Queries on bases, qualities, reference mismatches and record checks, and on the scalar functions behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.functions import bases as B
from readloom.functions import bins as BN
from readloom.functions import cigar as C
from readloom.operators import mismatches as M
from readloom.operators import quality as Q
from readloom.operators import recalibration as RC
from readloom.operators import validation as V
from readloom.operators.reads import sq_reverse_complement
from readloom.operators.skew import lookup_join
from readloom.plans.fixtures import fixture, table
from readloom.plans.read_queries import END_SQL, LEAD, TAIL, reads, sql_length
from readloom.plans.registry import query
from readloom.session import cut_lineage

REF_BASE = "substr('ACGTTGCAAC', CAST(1 + (ref_pos * 7 + ref_idx) % 10 AS INT), 1)"
# every aligned base: blocks per distinct CIGAR, then one row per offset
ALIGNED_SQL = f"""ops AS (SELECT DISTINCT cigar, regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 1) AS ls,
  regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 2) AS os FROM f_ids WHERE flag & 4 = 0),
els AS (SELECT cigar, i, CAST(ls[i] AS INT) AS len, os[i] AS op FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM ops)),
blk AS (SELECT cigar, op, len, 1 + coalesce(sum(CASE WHEN op IN ('M','I','S','=','X') THEN len ELSE 0 END) OVER w, 0) AS rs,
  coalesce(sum(CASE WHEN op IN ('M','D','N','=','X') THEN len ELSE 0 END) OVER w, 0) AS ro FROM els
  WINDOW w AS (PARTITION BY cigar ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
al AS (SELECT r.*, CAST(b.rs + k AS INT) AS read_off, CAST(r.pos + b.ro + k AS INT) AS ref_pos
  FROM f_ids r JOIN (SELECT *, unnest(range(0, len)) AS k FROM blk WHERE op IN ('M','=','X')) b ON r.cigar = b.cigar WHERE r.flag & 4 = 0),
mm AS (SELECT *, substr(seq, read_off, 1) AS base, {REF_BASE} AS ref_base, ascii(substr(qual, read_off, 1)) - 33 AS bq FROM al)"""


def tiles(spark, sf_dir):
    return fixture(spark, sf_dir, "f_refbases")


@query("jn14_mismatch_join", f"""
WITH {ALIGNED_SQL} SELECT ref_idx, read_off, base, ref_base, count(*) AS n, CAST(sum(ref_pos) AS BIGINT) AS pos_sum,
 CAST(sum(bq) AS BIGINT) AS bq_sum, count(DISTINCT read_id) AS n_reads FROM mm GROUP BY ALL""")
def mismatch_join(spark, sf_dir):
    # a read has an offset once, so only ids of several rows are told apart; all others are counted map-side
    ids = fixture(spark, sf_dir, "f_ids")
    again = cut_lineage(ids.groupBy("read_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1 AND read_id IS NOT NULL").drop("_rows"))
    told = lookup_join(ids, again.withColumn("_again", F.lit(True)), ["read_id"])
    told = told.withColumn("_once", F.col("_again").isNull() & F.col("read_id").isNotNull()).withColumn("read_id", F.when(F.col("_again"), F.col("read_id")))
    mm = M.mismatch_join(told, tiles(spark, sf_dir), ("_once",))
    return mm.groupBy("ref_idx", "read_off", "base", "ref_base").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ref_pos").alias("pos_sum"), F.sum("bq").alias("bq_sum"),
        (F.count_distinct("read_id") + F.count_if("_once")).alias("n_reads"))


def _summary_sql(differs: str) -> str:
    return f"""WITH {ALIGNED_SQL}, s AS (SELECT read_id, count_if({differs}) AS mm, coalesce(sum(bq) FILTER ({differs}), 0) AS q FROM mm GROUP BY read_id)
SELECT r.read_id, CAST(coalesce(s.mm, 0) AS BIGINT) AS mismatches, CAST(coalesce(s.q, 0) AS BIGINT) AS mm_qual,
 CAST({sql_length('cigar', 'I')} AS BIGINT) AS ins, CAST({sql_length('cigar', 'D')} AS BIGINT) AS del,
 CAST(coalesce(s.mm, 0) + {sql_length('cigar', 'I')} + {sql_length('cigar', 'D')} AS BIGINT) AS nm
FROM f_ids r LEFT JOIN s ON s.read_id = r.read_id WHERE r.flag & 4 = 0"""


@query("ag19_mismatch_summary", _summary_sql("base <> ref_base"))
def mismatch_summary(spark, sf_dir):
    return M.mismatch_summary(fixture(spark, sf_dir, "f_ids"), tiles(spark, sf_dir))


@query("ag19_mismatch_summary_bisulfite", _summary_sql(
    "base <> ref_base AND NOT CASE WHEN flag & 16 <> 0 THEN ref_base = 'G' AND base = 'A' ELSE ref_base = 'C' AND base = 'T' END"))
def mismatch_summary_bisulfite(spark, sf_dir):
    return M.mismatch_summary(fixture(spark, sf_dir, "f_ids"), tiles(spark, sf_dir), bisulfite=True)


RECAL_SQL = f"""{ALIGNED_SQL},
cov AS (SELECT read_id, read_off, rg, bq, CAST(CASE WHEN flag & 16 <> 0 THEN length(seq) - read_off + 1 ELSE read_off END AS INT) AS cycle,
 CASE WHEN flag & 16 <> 0 THEN concat(CASE WHEN read_off = length(seq) THEN 'N' ELSE translate(substr(seq, read_off + 1, 1), 'ACGT', 'TGCA') END, translate(base, 'ACGT', 'TGCA'))
  ELSE concat(CASE WHEN read_off = 1 THEN 'N' ELSE substr(seq, read_off - 1, 1) END, base) END AS context, base <> ref_base AS bad,
 EXISTS (SELECT 1 FROM f_variants_a v WHERE v.chrom_num = mm.ref_idx AND v.pos = mm.ref_pos) AS is_known FROM mm),
tab AS (SELECT rg, bq, cycle, context, count(*) AS n_obs, CAST(count_if(bad) AS BIGINT) AS n_mm FROM cov WHERE NOT is_known GROUP BY ALL)"""


def _covariates(spark, sf_dir):
    known = fixture(spark, sf_dir, "f_variants_a").select(F.col("chrom_num").alias("ref_idx"), "pos")
    marked = M.with_known_sites(tiles(spark, sf_dir), known)
    return M.mismatch_join(fixture(spark, sf_dir, "f_ids"), marked, ("rg",), apart=False)


@query("ag21_recalibration_table", f"WITH {RECAL_SQL} SELECT * FROM tab")
def recalibration_table(spark, sf_dir):
    return M.recalibration_table(_covariates(spark, sf_dir))


@query("ag21_recalibrate", f"""
WITH {RECAL_SQL}, q AS (SELECT *, CAST(floor(-10 * log10((n_mm + 1) / (n_obs + 2)) + 0.5) AS INT) AS new_q FROM tab)
SELECT c.bq, coalesce(q.new_q, c.bq) AS new_q, count(*) AS n, CAST(sum(read_off) AS BIGINT) AS off_sum
FROM cov c LEFT JOIN q USING (rg, bq, cycle, context) GROUP BY ALL""")
def recalibrate(spark, sf_dir):
    mm = _covariates(spark, sf_dir)
    rows = M.recalibrate(mm, M.recalibration_table(mm))
    return rows.groupBy("bq", "new_q").agg(F.count(F.lit(1)).alias("n"), F.sum("read_off").alias("off_sum"))


HIERARCHY_SQL = f"""{RECAL_SQL},
ql AS (SELECT rg, bq, sum(n_obs)::BIGINT AS n_obs, sum(n_mm)::BIGINT AS n_mm FROM tab GROUP BY ALL),
gp AS (SELECT rg, sum(n_obs * pow(10, -bq / 10)) / sum(n_obs) AS p, sum(n_obs) AS n, sum(n_mm) AS m FROM ql GROUP BY rg),
gs AS (SELECT rg, -10 * log10((m + 64 * p) / (n + 64)) + 10 * log10(p) AS shift FROM gp),
qr AS (SELECT ql.*, (n_mm + 64 * least(pow(10, -(bq + shift) / 10), 1)) / (n_obs + 64) AS rate FROM ql JOIN gs USING (rg)),
cy AS (SELECT rg, bq, cycle, n_obs, n_mm, -10 * log10((n_mm + 64 * rate) / (n_obs + 64)) + 10 * log10(rate) AS score FROM
 (SELECT rg, bq, cycle, sum(n_obs)::BIGINT AS n_obs, sum(n_mm)::BIGINT AS n_mm FROM tab GROUP BY ALL) JOIN (SELECT rg, bq, rate FROM qr) USING (rg, bq)),
cx AS (SELECT rg, bq, context, n_obs, n_mm, -10 * log10((n_mm + 64 * rate) / (n_obs + 64)) + 10 * log10(rate) AS score FROM
 (SELECT rg, bq, context, sum(n_obs)::BIGINT AS n_obs, sum(n_mm)::BIGINT AS n_mm FROM tab GROUP BY ALL) JOIN (SELECT rg, bq, rate FROM qr) USING (rg, bq))"""


@query("ag21_hierarchical_table", f"""
WITH {HIERARCHY_SQL} SELECT rg, bq, 'quality' AS level, NULL::VARCHAR AS value, n_obs, n_mm, round(-10 * log10(rate), 6) AS score FROM qr
UNION ALL SELECT rg, bq, 'cycle', cycle::VARCHAR, n_obs, n_mm, round(score, 6) FROM cy
UNION ALL SELECT rg, bq, 'context', context, n_obs, n_mm, round(score, 6) FROM cx""")
def hierarchical_table(spark, sf_dir):
    table = RC.hierarchical_table(M.recalibration_table(_covariates(spark, sf_dir)))
    return table.withColumn("score", F.round("score", 6))


@query("ag21_recalibrated_reads", f"""
WITH {HIERARCHY_SQL},
every AS (SELECT read_id, rg, flag, seq, qual, unnest(range(1, length(seq) + 1)) AS i FROM f_ids),
seen AS (SELECT read_id, rg, i, ascii(substr(qual, i, 1)) - 33 AS bq, CAST(CASE WHEN flag & 16 <> 0 THEN length(seq) - i + 1 ELSE i END AS INT) AS cycle,
 CASE WHEN flag & 16 <> 0 THEN concat(CASE WHEN i = length(seq) THEN 'N' ELSE translate(substr(seq, i + 1, 1), 'ACGT', 'TGCA') END, translate(substr(seq, i, 1), 'ACGT', 'TGCA'))
  ELSE concat(CASE WHEN i = 1 THEN 'N' ELSE substr(seq, i - 1, 1) END, substr(seq, i, 1)) END AS context FROM every),
fresh AS (SELECT s.read_id, i, CAST(CASE WHEN qr.rate IS NULL OR s.bq < 6 THEN s.bq ELSE
  greatest(1, least(60, floor(-10 * log10(qr.rate) + coalesce(cy.score, 0) + coalesce(cx.score, 0) + 0.5))) END AS INT) AS q
 FROM seen s LEFT JOIN qr ON qr.rg = s.rg AND qr.bq = s.bq LEFT JOIN cy ON cy.rg = s.rg AND cy.bq = s.bq AND cy.cycle = s.cycle
 LEFT JOIN cx ON cx.rg = s.rg AND cx.bq = s.bq AND cx.context = s.context),
written AS (SELECT read_id, string_agg(chr(33 + q), '' ORDER BY i) AS qual FROM fresh GROUP BY read_id)
SELECT r.read_id, w.qual, r.qual AS oq FROM f_ids r LEFT JOIN written w USING (read_id)""")
def recalibrated_reads(spark, sf_dir):
    """Qualities written back per read: one pass over the aligned bases for the counts, one over the reads."""
    table = RC.hierarchical_table(M.recalibration_table(_covariates(spark, sf_dir)))
    return RC.recalibrate_reads(fixture(spark, sf_dir, "f_ids"), table).select("read_id", "qual", "oq")


@query("ag15_gc_profile", """
SELECT ref_idx, count(*) AS n, sum(length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) / sum(length(seq)) AS gc,
 CAST(sum(length(seq) - length(replace(seq, 'N', ''))) AS BIGINT) AS no_call, CAST(0 AS BIGINT) AS invalid FROM f_reads GROUP BY ref_idx""")
def gc_profile(spark, sf_dir):
    return Q.gc_profile(reads(spark, sf_dir), "seq", ["ref_idx"])


@query("ag15_gc_profile_text", """
WITH c AS (SELECT lang, length(text) AS l, length(regexp_replace(text, '[^GCgc]', '', 'g')) AS g,
 length(regexp_replace(text, '[^Nn.]', '', 'g')) AS x, length(regexp_replace(text, '[^ACGTacgt]', '', 'g')) AS v FROM documents)
SELECT lang, count(*) AS n, sum(g) / sum(l) AS gc, CAST(sum(x) AS BIGINT) AS no_call, CAST(sum(l) - sum(x) - sum(v) AS BIGINT) AS invalid
FROM c GROUP BY lang""")
def gc_profile_text(spark, sf_dir):
    return Q.gc_profile(table(spark, sf_dir, "documents"), "text", ["lang"])


@query("ag16_quality_encoding_vote", """
WITH q AS (SELECT rg, list_max(list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i, 1)))) - 33 AS m FROM
 (SELECT rg, qual FROM f_reads UNION ALL SELECT concat(rg, 'i'), translate(qual, chr(40), chr(103)) FROM f_reads))
SELECT rg, CAST(max(m) AS INT) AS max_q, CASE WHEN max(m) <= 60 THEN 'SANGER' ELSE 'ILLUMINA' END AS encoding FROM q GROUP BY rg""")
def quality_encoding_vote(spark, sf_dir):
    plain = reads(spark, sf_dir).select("rg", "qual")
    high = plain.select(F.concat("rg", F.lit("i")).alias("rg"), F.translate("qual", chr(40), chr(103)).alias("qual"))
    return Q.quality_encoding_vote(plain.unionByName(high), ["rg"])


SHIFTED = "array_to_string(list_transform(range(1, length(qual) + 1), lambda i: chr(CAST(ascii(substr(qual, i, 1)) {} 31 AS INT))), '')"


@query("sf10_fix_qualities", f"""
SELECT qname, CASE WHEN mapq % 2 = 0 THEN qual WHEN ascii(qual) - 33 < 31 THEN qual ELSE {SHIFTED.format('-')} END AS qual,
 CASE WHEN mapq % 2 = 0 THEN false ELSE ascii(qual) - 33 < 31 END AS bad_quality FROM f_reads""")
def fix_qualities(spark, sf_dir):
    raised = B.phred_text(F.transform(B.phred("qual"), lambda s: s + 31))
    source = reads(spark, sf_dir).select("qname", F.when(F.col("mapq") % 2 == 0, raised).otherwise(F.col("qual")).alias("qual"))
    return Q.fix_qualities(source)


RGS = "SELECT concat('G', r_regionkey) AS id FROM region WHERE r_regionkey <> 3"
OP = "substr(ops, CAST({} AS INT), 1)"


# faults (error_type, rid) as e of the records in ``source``, which have a number rid
FAULTS_SQL = f"""
g AS ({RGS}),
d AS (SELECT r.*, x.length AS len, y.length AS mlen, g.id IS NULL AND rg IS NOT NULL AS norg, regexp_replace(cigar, '[0-9]+', '', 'g') AS ops,
  CASE WHEN seq = '*' THEN 0 ELSE length(seq) END AS sl, CASE WHEN qual = '*' THEN 0 ELSE length(qual) END AS ql,
  flag & 1 <> 0 AS p, flag & 4 <> 0 AS un, regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 1) AS ls,
  regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 2) AS os
 FROM source r LEFT JOIN f_dict x ON x.ref_idx = r.ref_idx LEFT JOIN f_dict y ON y.ref_idx = r.mate_ref_idx LEFT JOIN g ON g.id = r.rg),
c AS (SELECT *, len(os) AS n, list_max(list_transform(range(1, len(os) + 1), lambda i: CASE WHEN os[i] IN ('M','=','X') THEN
  pos - 1 + list_sum(list_transform(range(1, i + 1), lambda j: CASE WHEN os[j] IN ('M','D','N','=','X') THEN CAST(ls[j] AS INT) ELSE 0 END)) END)) AS last_base
 FROM d),
f AS (SELECT *, CASE WHEN cigar = '*' OR un THEN 0 ELSE
  len(list_filter(range(2, n), lambda i: os[i] = 'H'))
  + len(list_filter(range(2, n), lambda i: os[i] = 'S' AND NOT (CASE WHEN i = 2 AND n = 3 THEN os[1] = 'H' OR os[3] = 'H'
     WHEN i = 2 THEN os[1] = 'H' WHEN i = n - 1 THEN os[n] = 'H' ELSE false END)))
  + len(list_filter(range(2, n), lambda i: os[i] = 'P' AND NOT (contains('MIDN=X', os[i - 1]) AND contains('MIDN=X', os[i + 1]))))
  + CASE WHEN n > 1 AND os[n] = 'P' THEN 1 ELSE 0 END
  + coalesce(list_sum(list_transform(range(1, n + 1), lambda i: len(list_filter(range(i + 1, n + 1), lambda j: os[i] IN ('I', 'D') AND os[j] = os[i]
     AND len(list_filter(range(i + 1, j), lambda k: contains('MNXP=', os[k]))) = 0)))), 0)
  + CASE WHEN regexp_matches(ops, '[MIDN=X]') THEN 0 ELSE 1 END END AS faults FROM c),
e AS (
 SELECT 'INVALID_FLAG_PROPER_PAIR' AS error_type, rid FROM f WHERE NOT p AND flag & 2 <> 0
 UNION ALL SELECT 'INVALID_FLAG_MATE_UNMAPPED', rid FROM f WHERE NOT p AND flag & 8 <> 0
 UNION ALL SELECT 'INVALID_FLAG_MATE_NEG_STRAND', rid FROM f WHERE NOT p AND flag & 32 <> 0
 UNION ALL SELECT 'INVALID_FLAG_FIRST_OF_PAIR', rid FROM f WHERE NOT p AND flag & 64 <> 0
 UNION ALL SELECT 'INVALID_FLAG_SECOND_OF_PAIR', rid FROM f WHERE NOT p AND flag & 128 <> 0
 UNION ALL SELECT 'INVALID_MATE_REF_INDEX', rid FROM f WHERE NOT p AND mate_ref_idx <> -1
 UNION ALL SELECT 'INVALID_ALIGNMENT_START', rid FROM f WHERE p AND ((mate_ref_idx = -1 AND pnext <> 0) OR (mate_ref_idx <> -1 AND pnext = 0))
 UNION ALL SELECT 'INVALID_REFERENCE_INDEX', rid FROM f WHERE p AND mate_ref_idx <> -1 AND mlen IS NULL
 UNION ALL SELECT 'INVALID_ALIGNMENT_START', rid FROM f WHERE p AND mate_ref_idx <> -1 AND pnext > mlen
 UNION ALL SELECT 'INVALID_FLAG_MATE_UNMAPPED', rid FROM f WHERE p AND mate_ref_idx = -1 AND flag & 8 = 0
 UNION ALL SELECT 'PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND', rid FROM f WHERE p AND flag & 192 = 0
 UNION ALL SELECT 'INVALID_INSERT_SIZE', rid FROM f WHERE abs(tlen) > 536870912
 UNION ALL SELECT 'INVALID_FLAG_NOT_PRIM_ALIGNMENT', rid FROM f WHERE un AND flag & 256 <> 0
 UNION ALL SELECT 'INVALID_MAPPING_QUALITY', rid FROM f WHERE (un AND mapq <> 0) OR (NOT un AND mapq >= 256)
 UNION ALL SELECT 'INVALID_CIGAR', rid FROM f WHERE NOT un AND cigar = '*'
 UNION ALL SELECT 'INVALID_FLAG_READ_UNMAPPED', rid FROM f WHERE NOT un AND ref_idx = -1
 UNION ALL SELECT 'READ_GROUP_NOT_FOUND', rid FROM f WHERE norg
 UNION ALL SELECT 'INVALID_ALIGNMENT_START', rid FROM f WHERE (ref_idx = -1 AND pos <> 0) OR (ref_idx <> -1 AND pos = 0)
 UNION ALL SELECT 'INVALID_REFERENCE_INDEX', rid FROM f WHERE ref_idx <> -1 AND len IS NULL
 UNION ALL SELECT 'INVALID_ALIGNMENT_START', rid FROM f WHERE ref_idx <> -1 AND pos > len
 UNION ALL SELECT 'EMPTY_READ', rid FROM f WHERE sl = 0 AND flag & 256 = 0
 UNION ALL SELECT 'MISMATCH_READ_LENGTH_AND_QUALS_LENGTH', rid FROM f WHERE ql <> sl AND ql <> 0
 UNION ALL SELECT 'CIGAR_MAPS_OFF_REFERENCE', rid FROM f WHERE NOT un AND last_base > len
 UNION ALL SELECT 'INVALID_CIGAR', rid FROM (SELECT rid, unnest(range(0, CAST(faults AS BIGINT))) FROM f))"""


@query("ag18_validation_report", f"""
WITH source AS MATERIALIZED (SELECT row_number() OVER () AS rid, * FROM f_damaged), {FAULTS_SQL}
SELECT error_type, CASE WHEN error_type = 'PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND' THEN 'WARNING' ELSE 'ERROR' END AS severity, count(*) AS n
FROM e GROUP BY error_type""")
def validation_report(spark, sf_dir):
    groups = table(spark, sf_dir, "region").filter("r_regionkey <> 3").select(F.concat(F.lit("G"), F.col("r_regionkey")).alias("id"))
    return V.validation_report(fixture(spark, sf_dir, "f_damaged"), fixture(spark, sf_dir, "f_dict"), groups)


MD_SQL = "CASE cigar WHEN '36M' THEN '10A25' WHEN '5S31M' THEN '31' WHEN '10M2I24M' THEN '0T33' WHEN '12M3D24M' THEN '12^ACG0C23' ELSE '5C0G23' END"


@query("sf14_reconstruct_reference", f"""
SELECT read_id, CASE cigar WHEN '36M' THEN concat(substr(seq, 1, 10), 'A', substr(seq, 12)) WHEN '5S31M' THEN concat('00000', substr(seq, 6))
 WHEN '10M2I24M' THEN concat('T', substr(seq, 2, 9), '--', substr(seq, 13)) WHEN '12M3D24M' THEN concat(substr(seq, 1, 12), 'ACG', 'C', substr(seq, 14))
 ELSE concat(substr(seq, 1, 5), 'CG', substr(seq, 8, 23), '000000') END AS ref_text FROM f_ids WHERE flag & 4 = 0""")
def reconstruct_reference(spark, sf_dir):
    mapped = fixture(spark, sf_dir, "f_ids").filter("flag & 4 = 0").withColumn("md", F.expr(MD_SQL))
    return M.reconstruct_reference(mapped, with_deletions=True)


@query("sf1_cigar_round_trip", f"""
SELECT cigar, len(regexp_extract_all(cigar, '\\d+[MIDNSHP=X]')) AS n_elements, cigar AS text, count(*) AS n FROM f_damaged GROUP BY cigar""")
def cigar_round_trip(spark, sf_dir):
    cigars = fixture(spark, sf_dir, "f_damaged").groupBy("cigar").agg(F.count(F.lit(1)).alias("n"))
    return cigars.select("cigar", F.size(C.elements("cigar")).cast("long").alias("n_elements"),
                         C.format_elements(C.elements("cigar")).alias("text"), "n")


@query("sf2_cigar_lengths", f"""
SELECT qname, CAST({sql_length('cigar', 'MDN=X')} AS INT) AS ref_len, CAST({sql_length('cigar', 'MDNP=X')} AS INT) AS padded_len,
 CAST({sql_length('cigar', 'MIS=X')} AS INT) AS read_len, CAST({sql_length('cigar', 'I')} AS INT) AS ins, CAST({sql_length('cigar', 'D')} AS INT) AS del,
 NOT regexp_matches(cigar, '[M=X]') AS maps_none FROM f_damaged""")
def cigar_lengths(spark, sf_dir):
    return fixture(spark, sf_dir, "f_damaged").select(
        "qname", C.reference_length("cigar").alias("ref_len"), C.padded_length("cigar").alias("padded_len"),
        C.read_length("cigar").alias("read_len"), C.inserted_bases("cigar").alias("ins"), C.deleted_bases("cigar").alias("del"),
        C.maps_no_base("cigar").alias("maps_none"))


@query("sf3_read_ends", f"""
SELECT qname, flag, {END_SQL} AS aln_end, CAST(pos - {LEAD} AS INT) AS unclipped_start, CAST({END_SQL} + {TAIL} AS INT) AS unclipped_end FROM f_reads""")
def read_ends(spark, sf_dir):
    return reads(spark, sf_dir).select("qname", "flag", C.alignment_end().alias("aln_end"),
                                       C.unclipped_start().alias("unclipped_start"), C.unclipped_end().alias("unclipped_end"))


@query("sf5_alignment_blocks", f"""
WITH {ALIGNED_SQL} SELECT r.read_id, CAST(b.rs AS INT) AS read_start, CAST(r.pos + b.ro AS INT) AS ref_start, b.len
FROM f_ids r JOIN blk b ON b.cigar = r.cigar WHERE b.op IN ('M', '=', 'X') AND r.flag & 4 = 0""")
def alignment_blocks(spark, sf_dir):
    mapped = fixture(spark, sf_dir, "f_ids").filter("flag & 4 = 0")
    return mapped.select("read_id", F.inline(C.alignment_blocks()))


@query("sf6_reference_position", f"""
WITH {ALIGNED_SQL}, o AS (SELECT read_id, CAST(1 + mapq % 36 AS INT) AS off FROM f_ids WHERE flag & 4 = 0)
SELECT o.read_id, o.off, coalesce(al.ref_pos, 0) AS ref_pos FROM o LEFT JOIN al ON al.read_id = o.read_id AND al.read_off = o.off""")
def reference_position(spark, sf_dir):
    offset = F.col("mapq") % 36 + 1
    mapped = fixture(spark, sf_dir, "f_ids").filter("flag & 4 = 0")
    return mapped.select("read_id", offset.alias("off"), C.reference_position(offset).alias("ref_pos"))


@query("sf8_reverse_complement", """
SELECT qname, flag, reverse(translate(seq, 'acgtACGT', 'tgcaTGCA')) AS rc, reverse(qual) AS rq, translate(upper(lower(seq)), '.', 'N') AS norm FROM f_reads""")
def reverse_complement(spark, sf_dir):
    return reads(spark, sf_dir).select("qname", "flag", B.reverse_complement("seq").alias("rc"), F.reverse("qual").alias("rq"),
                                       B.normalise(F.lower("seq")).alias("norm"))


# each level by the size of its bins and the number of its first bin
_BIN_SQL = " UNION ALL ".join(f"SELECT unnest(range({first} + b // {size}, {first} + e // {size} + 1)) FROM s" for first, size in (
    (0, 536870912), (1, 67108864), (9, 8388608), (73, 1048576), (585, 131072), (4681, 16384)))


@query("sf12_candidate_bins", f"""
WITH s AS (SELECT start_pos - 1 AS b, end_pos - 1 AS e FROM f_targets), c(bin) AS ({_BIN_SQL})
SELECT CAST(bin AS INT) AS bin, count(*) AS n FROM c GROUP BY 1""")
def candidate_bins(spark, sf_dir):
    bins = BN.candidate_bins(F.col("start_pos") - 1, F.col("end_pos"))
    return (fixture(spark, sf_dir, "f_targets").select(F.explode(bins).alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))


@query("sf13_interval_arithmetic", """
SELECT c_custkey, least(e1, e2) >= greatest(s1, s2) AS overlaps, greatest(least(e1, e2) - greatest(s1, s2) + 1, 0) AS shared,
 s1 <= s2 AND e1 >= e2 AS encloses FROM (SELECT c_custkey, CAST(c_custkey % 100 AS INT) AS s1, CAST(c_custkey % 100 + 20 AS INT) AS e1,
 CAST(c_custkey % 37 AS INT) AS s2, CAST(c_custkey % 37 + c_custkey % 11 AS INT) AS e2 FROM customer)""")
def interval_arithmetic(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", (k % 100).cast("int").alias("s1"), (k % 100 + 20).cast("int").alias("e1"),
        (k % 37).cast("int").alias("s2"), (k % 37 + k % 11).cast("int").alias("e2"))
    ends = [F.col(c) for c in ("s1", "e1", "s2", "e2")]
    return rows.select("c_custkey", BN.overlaps(*ends).alias("overlaps"), BN.overlap_length(*ends).alias("shared"),
                       BN.encloses(*ends).alias("encloses"))


@query("sf15_clipped_cigar", """
WITH a AS (SELECT c_custkey, CAST(c_custkey % 120 - 10 AS INT) AS pos FROM customer),
b AS (SELECT *, greatest(1 - pos, 0) AS l, greatest(pos + 36 - 100 - 1, 0) AS r, greatest(pos + 36 + 3 - 100 - 1, 0) AS r2 FROM a)
SELECT c_custkey, CASE WHEN 36 - l - r >= 1 THEN concat(CASE WHEN l > 0 THEN concat(l, 'S') ELSE '' END, 36 - l - r, 'M', CASE WHEN r > 0 THEN concat(r, 'S') ELSE '' END) END AS plain,
 CASE WHEN 15 - l >= 1 AND 36 - 15 - r2 >= 1 THEN concat(CASE WHEN l > 0 THEN concat(l, 'S') ELSE '' END, 15 - l, 'M3D', 36 - 15 - r2, 'M',
  CASE WHEN r2 > 0 THEN concat(r2, 'S') ELSE '' END) END AS with_indel FROM b""")
def clipped_cigar(spark, sf_dir):
    pos = (F.col("c_custkey") % 120 - 10).cast("int")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", C.clipped_cigar(pos, F.lit(36), F.lit(100)).alias("plain"),
        C.clipped_cigar_with_indel(pos, F.lit(36), F.lit(100), F.lit(15), F.lit(-3)).alias("with_indel"))


@query("sf17_packed_calls", """
SELECT c_custkey, substr('ACGT', CAST(1 + (c_custkey % 256) // 64 AS INT), 1) AS base, CAST(c_custkey % 64 AS INT) AS ratio,
 printf('%02X', xor((c_custkey * 7) % 256, 192)) || printf('%02X', xor(c_custkey % 256, 192)) AS turned FROM customer""")
def packed_calls(spark, sf_dir):
    value = (F.col("c_custkey") % 256).cast("int")
    both = F.concat(F.lpad(F.hex(value), 2, "0"), F.lpad(F.hex(F.col("c_custkey") * 7 % 256), 2, "0"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", B.sq_base(value).alias("base"), B.sq_ratio(value).alias("ratio"), sq_reverse_complement(both).alias("turned"))
