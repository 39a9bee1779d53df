"""Queries on intervals of reads and targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import intervals as I
from readloom.operators import reads as R
from readloom.operators import targets as TG
from readloom.plans.base_queries import ALIGNED_SQL
from readloom.plans.fixtures import fixture
from readloom.plans.read_queries import END_SQL, MAPPED, REGION, reads
from readloom.plans.registry import query


def islands(spans: str, gap: int, name: str = "islands") -> str:
    """Gaps-and-islands over (ref_idx, s, e)."""
    return f"""{name}_f AS (SELECT *, max(e) OVER (PARTITION BY ref_idx ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM {spans}),
{name}_g AS (SELECT *, sum(CASE WHEN far IS NULL OR s > far + {gap} THEN 1 ELSE 0 END)
 OVER (PARTITION BY ref_idx ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM {name}_f),
{name} AS (SELECT ref_idx, min(s) AS start_pos, max(e) AS end_pos, count(*) AS n FROM {name}_g GROUP BY ref_idx, g)"""


SPANS = f"spans AS (SELECT ref_idx, pos AS s, {END_SQL} AS e FROM f_reads WHERE {MAPPED})"


def main_reads(spark, sf_dir):
    return R.mapped_main_chroms(reads(spark, sf_dir))


@query("ag9_merge_intervals", f"WITH {SPANS}, {islands('spans', 51)} SELECT * FROM islands")
def merge_intervals(spark, sf_dir):
    return I.merge_intervals(main_reads(spark, sf_dir))


@query("ag10_merge_intervals_padded", f"""
WITH t AS (SELECT ref_idx, start_pos AS s, end_pos AS e FROM f_targets), {islands('t', 199)}
SELECT ref_idx, greatest(start_pos - 200, 1) AS start_pos, end_pos, n FROM islands""")
def merge_intervals_padded(spark, sf_dir):
    return I.merge_intervals_padded(fixture(spark, sf_dir, "f_targets"), 200)


@query("wn4_running_reach", f"""
WITH {SPANS}, u AS (SELECT ref_idx, s, max(e) AS e, count(*) AS n FROM spans GROUP BY ref_idx, s)
SELECT ref_idx, s AS start_pos, e AS end_pos, n,
 max(e) OVER (PARTITION BY ref_idx ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS furthest FROM u""")
def running_reach(spark, sf_dir):
    rows = I.running_reach(I.read_spans(main_reads(spark, sf_dir)), tile_shift=16)
    return rows.select("ref_idx", F.col("_s").alias("start_pos"), F.col("_e").alias("end_pos"),
                       F.col("_n").alias("n"), F.col("_furthest").alias("furthest"))


@query("jn4_intersect_intervals", f"""
WITH {SPANS}, {islands('spans', 51)}
SELECT t.ref_idx, greatest(t.start_pos, i.start_pos) AS start_pos, least(t.end_pos, i.end_pos) AS end_pos,
 concat(t.ref_idx, ':', t.start_pos, '-', t.end_pos) AS a_id, i.start_pos AS b_id
FROM f_targets t JOIN islands i ON t.ref_idx = i.ref_idx AND t.start_pos <= i.end_pos AND i.start_pos <= t.end_pos""")
def intersect_intervals(spark, sf_dir):
    targets = fixture(spark, sf_dir, "f_targets")
    named = targets.withColumn("a_id", F.concat("ref_idx", F.lit(":"), "start_pos", F.lit("-"), "end_pos"))
    merged = I.merge_intervals(main_reads(spark, sf_dir)).withColumn("b_id", F.col("start_pos"))
    return I.intersect_intervals(named, merged)


@query("ag8_region_groups", f"""
WITH b AS (SELECT ref_idx, pos, CAST(ntile(7) OVER (ORDER BY {REGION}) - 1 AS INT) AS bucket FROM f_reads WHERE {MAPPED}),
f AS (SELECT bucket, count(*) AS n, min(ref_idx::BIGINT * 1000000000 + pos) AS lo, max(ref_idx::BIGINT * 1000000000 + pos) AS hi FROM b GROUP BY bucket)
SELECT bucket, n, CAST(lo // 1000000000 AS INT) AS first_ref, CAST(lo % 1000000000 AS INT) AS first_pos,
 CAST(hi // 1000000000 AS INT) AS last_ref, CAST(hi % 1000000000 AS INT) AS last_pos FROM f""")
def region_groups(spark, sf_dir):
    return I.region_groups(main_reads(spark, sf_dir), 7, R.region_order(), stored=True)


@query("ag8_region_costs", f"""
WITH o AS (SELECT ref_idx, pos, mapq, coalesce(sum(mapq) OVER (ORDER BY {REGION} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(mapq) OVER () AS total FROM f_reads WHERE {MAPPED}),
b AS (SELECT *, least(CAST(floor(before * 7 / greatest(total, 1)) AS INT), 6) AS bucket FROM o),
f AS (SELECT bucket, count(*) AS n, min(ref_idx::BIGINT * 1000000000 + pos) AS lo, max(ref_idx::BIGINT * 1000000000 + pos) AS hi,
  CAST(sum(mapq) AS BIGINT) AS cost FROM b GROUP BY bucket)
SELECT bucket, n, CAST(lo // 1000000000 AS INT) AS first_ref, CAST(lo % 1000000000 AS INT) AS first_pos,
 CAST(hi // 1000000000 AS INT) AS last_ref, CAST(hi % 1000000000 AS INT) AS last_pos, cost FROM f""")
def region_costs(spark, sf_dir):
    """Regions of equal summed mapping quality."""
    return I.region_groups(main_reads(spark, sf_dir), 7, R.region_order(), stored=True, cost=F.col("mapq"))


@query("ag11_reference_stats", """
WITH c AS (SELECT CASE WHEN pos <> 0 THEN ref_idx ELSE -1 END AS ref_idx, count_if(flag & 4 = 0 AND pos <> 0) AS a,
 count_if(flag & 4 <> 0 OR pos = 0) AS u FROM f_reads GROUP BY 1),
d AS (SELECT * FROM f_dict UNION ALL SELECT -1, '*', 0)
SELECT d.ref_idx, d.rname, d.length, coalesce(c.a, 0)::BIGINT AS aligned, coalesce(c.u, 0)::BIGINT AS unaligned
FROM d LEFT JOIN c ON c.ref_idx = d.ref_idx""")
def reference_stats(spark, sf_dir):
    return I.reference_stats(reads(spark, sf_dir), fixture(spark, sf_dir, "f_dict"))


@query("ag12_bin_counts", f"""
WITH s AS (SELECT ref_idx, pos - 1 AS b, (CASE WHEN {END_SQL} > 0 THEN {END_SQL} ELSE pos END) - 1 AS e FROM f_reads WHERE pos <> 0)
SELECT ref_idx, CAST(CASE WHEN b >> 14 = e >> 14 THEN 4681 + (b >> 14) WHEN b >> 17 = e >> 17 THEN 585 + (b >> 17)
 WHEN b >> 20 = e >> 20 THEN 73 + (b >> 20) WHEN b >> 23 = e >> 23 THEN 9 + (b >> 23)
 WHEN b >> 26 = e >> 26 THEN 1 + (b >> 26) ELSE 0 END AS INT) AS bin, count(*) AS n FROM s GROUP BY 1, 2""")
def bin_counts(spark, sf_dir):
    return I.bin_counts(reads(spark, sf_dir))


@query("ag13_window16k_coverage", f"""
WITH s AS (SELECT ref_idx, CASE WHEN {END_SQL} = 0 THEN greatest(pos - 2, 0) ELSE pos - 1 END AS b,
 CASE WHEN {END_SQL} = 0 THEN greatest(pos - 2, 0) ELSE {END_SQL} - 1 END AS e FROM f_reads WHERE pos <> 0 AND ref_idx >= 0)
SELECT ref_idx, CAST(win AS INT) AS win, count(*) AS n
FROM (SELECT ref_idx, unnest(range(b >> 14, (e >> 14) + 1)) AS win FROM s) GROUP BY 1, 2""")
def window16k_coverage(spark, sf_dir):
    return I.window16k_coverage(reads(spark, sf_dir))


# positions where mismatches hold three quarters of the quality within five positions, two bases deep
NOISY_SQL = """pile AS (SELECT ref_idx, ref_pos AS pos, count(*) AS depth, CAST(sum(bq) AS BIGINT) AS qual,
 CAST(coalesce(sum(bq) FILTER (base <> ref_base), 0) AS BIGINT) AS mm_qual FROM mm GROUP BY ALL),
near AS (SELECT *, sum(qual) OVER w AS q, sum(mm_qual) OVER w AS m FROM pile
 WINDOW w AS (PARTITION BY ref_idx ORDER BY pos RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
noisy AS (SELECT * FROM near WHERE depth >= 2 AND m > 0 AND 4 * m >= 3 * q)"""
INDEL_SQL = """o AS (SELECT ref_idx, pos, cigar, regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 1) AS ls,
  regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 2) AS os FROM f_reads WHERE flag & 4 = 0 AND ref_idx >= 0),
x AS (SELECT ref_idx, os[i] AS op, CAST(ls[i] AS INT) AS len,
  pos + coalesce(list_sum(list_transform(range(1, i), lambda j: CASE WHEN os[j] IN ('M','D','N','=','X') THEN CAST(ls[j] AS INT) ELSE 0 END)), 0) AS here
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM o)),
v AS (SELECT ref_idx, CAST(CASE WHEN op = 'I' THEN here - 1 ELSE here END AS INT) AS s, CAST(CASE WHEN op = 'I' THEN here ELSE here + len - 1 END AS INT) AS e
  FROM x WHERE op IN ('I', 'D'))"""


@query("ag22_indel_targets", f"WITH {INDEL_SQL}, {islands('v', 100)} SELECT * FROM islands")
def indel_targets(spark, sf_dir):
    return I.indel_targets(reads(spark, sf_dir), 100)


@query("ag22_noisy_positions", f"""
WITH {ALIGNED_SQL}, {NOISY_SQL} SELECT ref_idx, pos, depth, qual, mm_qual FROM noisy""")
def noisy_positions(spark, sf_dir):
    pile = TG.pile_up(fixture(spark, sf_dir, "f_ids"), fixture(spark, sf_dir, "f_refbases"))
    return TG.noisy_positions(pile, 10, 2, 0.75)


@query("ag22_realignment_targets", f"""
WITH {ALIGNED_SQL}, {NOISY_SQL}, {INDEL_SQL.replace("f_reads", "f_ids")},
a AS (SELECT ref_idx, s, e FROM v UNION ALL SELECT ref_idx, pos, pos FROM noisy
 UNION ALL SELECT chrom_num, pos, pos + CAST(length(ref) AS INT) - 1 FROM f_variants_a), {islands('a', 100)} SELECT * FROM islands""")
def realignment_targets(spark, sf_dir):
    """Indels, noisy stretches and known sites together."""
    length = F.length("ref")
    known = fixture(spark, sf_dir, "f_variants_a").select(
        F.col("chrom_num").alias("ref_idx"), F.col("pos").alias("start_pos"), (F.col("pos") + length - 1).alias("end_pos"))
    return TG.realignment_targets(fixture(spark, sf_dir, "f_ids"), fixture(spark, sf_dir, "f_refbases"), known, 100, 10, 2, 0.75)
