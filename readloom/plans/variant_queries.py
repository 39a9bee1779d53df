"""Queries on variant calls, dictionaries and header records."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import dictionary as D
from readloom.operators import variants as V
from readloom.operators.ordering import ordinal
from readloom.operators.skew import union_all
from readloom.plans.fixtures import fixture, table
from readloom.plans.registry import query

KEY_SQL = "chrom, pos, ref, alt"
# Names without a number, so that chrM and chrUn_1 hold calls at equal positions.
NAME_SQL = "CASE chrom_num WHEN 24 THEN 'chrY' WHEN 23 THEN 'chrX' WHEN 22 THEN 'chrM' WHEN 21 THEN 'chrUn_1' ELSE concat('chr', chrom_num) END"
A_SQL, B_SQL = (f"(SELECT *, {NAME_SQL} AS chrom FROM f_variants_{x})" for x in "ab")


def calls(spark, sf_dir):
    return tuple(fixture(spark, sf_dir, f"f_variants_{x}").withColumn("chrom", F.expr(NAME_SQL)) for x in "ab")


CHROM_SQL = "CASE n_nationkey % 5 WHEN 0 THEN concat('chr', n_nationkey + 1) WHEN 1 THEN 'chrX' WHEN 2 THEN 'chrY' WHEN 3 THEN 'chrM' ELSE concat('chrUn_', n_name) END"


def _chroms(spark, sf_dir):
    owners = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return owners.join(table(spark, sf_dir, "nation"), "n_nationkey").select("c_custkey", F.expr(CHROM_SQL).alias("chrom"))


CHROMS = f"chroms AS (SELECT c_custkey, {CHROM_SQL} AS chrom FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query("pf8_chrom_number", f"""
WITH {CHROMS} SELECT c_custkey, chrom, CASE WHEN chrom = 'chrX' THEN 23 WHEN chrom = 'chrY' THEN 24
 ELSE TRY_CAST(substr(chrom, 4) AS INT) END AS chrom_num FROM chroms""")
def chrom_number(spark, sf_dir):
    return V.chrom_number(_chroms(spark, sf_dir))


@query("pf8_unknown_chroms", f"""
WITH {CHROMS} SELECT chrom, count(*) AS n FROM chroms WHERE chrom = 'chrM' OR chrom LIKE 'chrUn%' GROUP BY chrom""")
def unknown_chroms(spark, sf_dir):
    return V.unknown_chroms(_chroms(spark, sf_dir))


@query("pf9_call_quality_filter", f"SELECT chrom_num, {KEY_SQL}, qual FROM {A_SQL} a WHERE qual >= 30")
def call_quality_filter(spark, sf_dir):
    return V.call_quality_filter(calls(spark, sf_dir)[0])


@query("sr6_variant_sort", """
SELECT row_number() OVER (ORDER BY chrom_num, pos, line) - 1 AS ord, chrom_num, pos, line FROM
 (SELECT chrom_num, pos, concat('chr', chrom_num, ':', pos, ref, '>', alt) AS line FROM f_variants_a)""")
def variant_sort(spark, sf_dir):
    a = calls(spark, sf_dir)[0]
    line = F.concat(F.lit("chr"), "chrom_num", F.lit(":"), "pos", "ref", F.lit(">"), "alt")
    return ordinal(a.select("chrom_num", "pos", line.alias("line")), V.variant_order(), stored=True).select("ord", "chrom_num", "pos", "line")


@query("sr6_variant_sort_distinct", """
SELECT DISTINCT chrom_num, pos, concat('chr', chrom_num, ':', pos, ref, '>', alt) AS line FROM f_variants_a""")
def variant_sort_distinct(spark, sf_dir):
    a = calls(spark, sf_dir)[0]
    line = F.concat(F.lit("chr"), "chrom_num", F.lit(":"), "pos", "ref", F.lit(">"), "alt")
    return V.variant_sort(a.select("chrom_num", "pos", line.alias("line")), distinct=True)


@query("jn10_match_variants", f"""
SELECT {KEY_SQL}, CASE WHEN a AND b THEN 'match' WHEN a THEN 'only_a' ELSE 'only_b' END AS status FROM (
 SELECT coalesce(x.chrom, y.chrom) AS chrom, coalesce(x.pos, y.pos) AS pos, coalesce(x.ref, y.ref) AS ref,
  coalesce(x.alt, y.alt) AS alt, x.pos IS NOT NULL AS a, y.pos IS NOT NULL AS b
 FROM (SELECT DISTINCT {KEY_SQL} FROM {A_SQL} a) x FULL JOIN (SELECT DISTINCT {KEY_SQL} FROM {B_SQL} b) y
 ON x.chrom = y.chrom AND x.pos = y.pos AND x.ref = y.ref AND x.alt = y.alt)""")
def match_variants(spark, sf_dir):
    return V.match_variants(*calls(spark, sf_dir))


@query("ag14_variant_compare", f"""
WITH a AS (SELECT DISTINCT {KEY_SQL} FROM {A_SQL} x), b AS (SELECT DISTINCT {KEY_SQL} FROM {B_SQL} x),
m AS (SELECT * FROM a INTERSECT SELECT * FROM b)
SELECT (SELECT count(*) FROM a) AS total, (SELECT count(*) FROM m) AS matches,
 (SELECT count(*) FROM a) - (SELECT count(*) FROM m) AS diff, (SELECT count(*) FROM b) - (SELECT count(*) FROM m) AS only_in_b""")
def variant_compare(spark, sf_dir):
    return V.variant_compare(*calls(spark, sf_dir))


@query("st1_union_all", f"SELECT chrom_num, {KEY_SQL}, qual FROM {A_SQL} a UNION ALL SELECT chrom_num, {KEY_SQL}, qual FROM {B_SQL} b")
def union_rows(spark, sf_dir):
    return union_all(*calls(spark, sf_dir))


@query("st2_variant_intersect", f"SELECT {KEY_SQL} FROM {A_SQL} a INTERSECT SELECT {KEY_SQL} FROM {B_SQL} b")
def variant_intersect(spark, sf_dir):
    return V.variant_intersect(*calls(spark, sf_dir))


@query("st3_variant_missing", f"SELECT {KEY_SQL} FROM {A_SQL} a EXCEPT SELECT {KEY_SQL} FROM {B_SQL} b")
def variant_missing(spark, sf_dir):
    return V.variant_missing(*calls(spark, sf_dir))


@query("st4_distinct_rows", f"SELECT DISTINCT {KEY_SQL} FROM {A_SQL} a")
def distinct_rows(spark, sf_dir):
    return calls(spark, sf_dir)[0].select(*V.KEY).distinct()


def _dictionaries(spark, sf_dir):
    base = fixture(spark, sf_dir, "f_dict")
    digest = F.when(F.col("ref_idx") % 2 == 0, F.md5("rname"))
    a = base.select("ref_idx", "rname", "length", digest.alias("md5"))
    b = base.filter("ref_idx <> 25").select(
        "ref_idx", F.when(F.col("ref_idx") % 6 == 3, F.lower(F.concat("rname", F.lit("_alt")))).otherwise(F.col("rname")).alias("rname"),
        F.expr("CASE WHEN ref_idx % 7 = 0 THEN 0 WHEN ref_idx % 7 = 1 THEN 999 ELSE length END").alias("length"),
        F.when(F.col("ref_idx") % 4 == 0, F.upper(F.md5("rname"))).when(F.col("ref_idx") % 4 == 2, F.md5(F.lit("x"))).alias("md5"))
    return a, b


@query("jn11_compare_dictionaries", """
WITH a AS (SELECT ref_idx, rname, length, CASE WHEN ref_idx % 2 = 0 THEN md5(rname) END AS m FROM f_dict),
b AS (SELECT ref_idx, CASE WHEN ref_idx % 6 = 3 THEN lower(concat(rname, '_alt')) ELSE rname END AS rname,
 CASE WHEN ref_idx % 7 = 0 THEN 0 WHEN ref_idx % 7 = 1 THEN 999 ELSE length END AS length,
 CASE WHEN ref_idx % 4 = 0 THEN md5(rname) WHEN ref_idx % 4 = 2 THEN md5('x') END AS m FROM f_dict WHERE ref_idx <> 25)
SELECT ref_idx, reason FROM (SELECT coalesce(a.ref_idx, b.ref_idx) AS ref_idx, CASE WHEN a.ref_idx IS NULL THEN 'MISSING_IN_A'
 WHEN b.ref_idx IS NULL THEN 'MISSING_IN_B' WHEN a.length <> 0 AND b.length <> 0 AND a.length <> b.length THEN 'LENGTH'
 WHEN a.m IS NOT NULL AND b.m IS NOT NULL THEN CASE WHEN a.m <> b.m THEN 'MD5' END WHEN a.rname <> b.rname THEN 'NAME' END AS reason
 FROM a FULL JOIN b ON a.ref_idx = b.ref_idx) WHERE reason IS NOT NULL""")
def compare_dictionaries(spark, sf_dir):
    return D.compare_dictionaries(*_dictionaries(spark, sf_dir))


@query("ag17_reference_length", "SELECT CAST(sum(length) AS BIGINT) AS total FROM f_dict")
def reference_length(spark, sf_dir):
    return D.reference_length(fixture(spark, sf_dir, "f_dict"))


@query("ag23_dedup_header_ids", """
SELECT kind, id, count(*) AS n FROM (SELECT 'RG' AS kind, concat('G', s_suppkey % 40) AS id FROM supplier
 UNION ALL SELECT 'PG', p_name FROM part UNION ALL SELECT 'SQ', rname FROM f_dict) GROUP BY kind, id HAVING count(*) > 1""")
def dedup_header_ids(spark, sf_dir):
    groups = table(spark, sf_dir, "supplier").select(F.lit("RG").alias("kind"), F.concat(F.lit("G"), F.col("s_suppkey") % 40).alias("id"))
    programs = table(spark, sf_dir, "part").select(F.lit("PG").alias("kind"), F.col("p_name").alias("id"))
    names = fixture(spark, sf_dir, "f_dict").select(F.lit("SQ").alias("kind"), F.col("rname").alias("id"))
    return D.dedup_header_ids(union_all(groups, programs, names))


@query("sf22_program_chain_head", """
WITH pg AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 <> 0 THEN c_custkey - 1 END AS pp FROM customer)
SELECT id, pp FROM pg WHERE id NOT IN (SELECT pp FROM pg WHERE pp IS NOT NULL)""")
def program_chain_head(spark, sf_dir):
    previous = F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey") - 1)
    return D.program_chain_head(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), previous.alias("pp")))
