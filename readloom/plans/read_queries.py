"""Queries on the aligned reads: filters, placement, order, pairing, duplicates."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from readloom.functions import flags as FL
from readloom.operators import duplicates as DU
from readloom.operators import ordering as O
from readloom.operators import reads as R
from readloom.plans.fixtures import fixture, table
from readloom.plans.registry import query
from readloom.session import scratch_dir
from readloom.sources.layout import StoredReads, store_regions

CORE = ["qname", "flag", "ref_idx", "pos", "mapq", "cigar"]
CORE_SQL = ", ".join(CORE)
ALL = CORE + ["mate_ref_idx", "pnext", "tlen", "seq", "qual", "rg"]
ALL_SQL = ", ".join(ALL)


def sql_length(cigar: str, ops: str) -> str:
    return (f"coalesce(list_sum(list_transform(regexp_extract_all({cigar}, '(\\d+)[{ops}]', 1), "
            "lambda x: CAST(x AS INT))), 0)")


END_SQL = f"CAST(CASE WHEN flag & 4 <> 0 THEN 0 ELSE pos + {sql_length('cigar', 'MDN=X')} - 1 END AS INT)"
MAPPED = "flag & 4 = 0 AND ref_idx BETWEEN 1 AND 24"
COORD = ("CASE WHEN ref_idx = -1 THEN 1 ELSE 0 END, ref_idx, CASE WHEN ref_idx = -1 THEN 0 ELSE pos END, "
         "flag & 16, qname, flag, mapq, mate_ref_idx, pnext, tlen, cigar, seq, qual")
REGION = "ref_idx, pos, qname, flag, cigar, mapq, seq, qual"
NAME = ("qname, CASE WHEN flag & 1 <> 0 THEN 0 ELSE 1 END, "
        "CASE WHEN flag & 1 <> 0 AND flag & 64 <> 0 THEN 0 WHEN flag & 1 <> 0 AND flag & 128 <> 0 THEN 1 ELSE 0 END, "
        "flag & 16, flag & 256")


def as_sorted(df):
    """``ord``: where each row stands in the order that ``df`` comes in, whatever that order is: sorted and written once."""
    path = scratch_dir(df.sparkSession, "sorted")
    df.write.parquet(path)
    return O.stored_position(df.sparkSession.read.parquet(path))


def reads(spark, sf_dir):
    return fixture(spark, sf_dir, "f_reads")


@query("pf7_mapped_main_chroms", f"SELECT {ALL_SQL} FROM f_reads WHERE {MAPPED}")
def mapped_main_chroms(spark, sf_dir):
    return R.mapped_main_chroms(reads(spark, sf_dir))


@query("pf10_flag_columns", f"""
SELECT {CORE_SQL}, flag & 1 <> 0 AS is_paired,
 {', '.join(f"CASE WHEN flag & 1 <> 0 THEN flag & {bit} <> 0 END AS {name}" for name, bit in
            [('is_proper', 2), ('is_mate_unmapped', 8), ('is_mate_reverse', 32), ('is_first', 64), ('is_second', 128)])},
 {', '.join(f"flag & {bit} <> 0 AS {name}" for name, bit in
            [('is_unmapped', 4), ('is_reverse', 16), ('is_not_primary', 256), ('fails_qc', 512), ('is_duplicate', 1024)])}
FROM f_reads""")
def flag_columns(spark, sf_dir):
    return R.flag_columns(reads(spark, sf_dir).select(*CORE))


@query("pf11_primary_only", f"SELECT {ALL_SQL} FROM f_reads WHERE flag & 256 = 0")
def primary_only(spark, sf_dir):
    return R.primary_only(reads(spark, sf_dir))


@query("pf12_add_read_group", f"""
SELECT {CORE_SQL}, 'GROUP1' AS rg, 'LIB1' AS rg_lb, 'ILLUMINA' AS rg_pl, 'UNITI' AS rg_pu, 'SAMPLE1' AS rg_sm FROM f_reads""")
def add_read_group(spark, sf_dir):
    return R.add_read_group(reads(spark, sf_dir).select(*CORE), {
        "ID": "GROUP1", "LB": "LIB1", "PL": "ILLUMINA", "PU": "UNITI", "SM": "SAMPLE1"})


@query("pf13_make_unmapped", f"""
SELECT qname, CAST(CASE WHEN mapq < 10 THEN (flag & ~(1024 | 256 | 2 | 16)) | 4 ELSE flag END AS INT) AS flag,
 CASE WHEN mapq < 10 THEN -1 ELSE ref_idx END AS ref_idx, CASE WHEN mapq < 10 THEN 0 ELSE pos END AS pos,
 CASE WHEN mapq < 10 THEN 0 ELSE mapq END AS mapq, CASE WHEN mapq < 10 THEN '*' ELSE cigar END AS cigar,
 CASE WHEN mapq < 10 THEN 0 ELSE tlen END AS tlen,
 CASE WHEN mapq < 10 AND flag & 16 <> 0 THEN reverse(translate(seq, 'acgtACGT', 'tgcaTGCA')) ELSE seq END AS seq,
 CASE WHEN mapq < 10 AND flag & 16 <> 0 THEN reverse(qual) ELSE qual END AS qual FROM f_reads""")
def make_unmapped(spark, sf_dir):
    source = reads(spark, sf_dir).select(*CORE, "tlen", "seq", "qual")
    return R.make_unmapped(source, F.col("mapq") < 10)


NEAR_END = "CASE WHEN ref_idx = -1 THEN pos ELSE 1000000 - pos % 50 END"


@query("pf14_clean_reads", f"""
WITH near AS (SELECT qname, flag, ref_idx, CAST({NEAR_END} AS INT) AS pos, cigar, CAST(20 AS INT) AS mapq FROM f_reads),
sized AS (SELECT n.*, d.length - n.pos + 1 AS room, {END_SQL.replace('pos', 'n.pos')} > d.length AS past
 FROM near n LEFT JOIN f_dict d USING (ref_idx)),
combos AS (SELECT DISTINCT cigar, room FROM sized WHERE past),
els AS (SELECT cigar, room, i, CAST(regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 1)[i] AS INT) AS len,
 regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 2)[i] AS op
 FROM (SELECT *, unnest(range(1, len(regexp_extract_all(cigar, '(\\d+)([MIDNSHP=X])', 1)) + 1)) AS i FROM combos)),
walk AS (SELECT *, greatest(room - coalesce(sum(CASE WHEN op IN ('M','D','N','=','X') THEN len ELSE 0 END)
 OVER (PARTITION BY cigar, room ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS here FROM els),
kept AS (SELECT *, CASE WHEN op IN ('M','D','N','=','X') THEN least(len, here) WHEN here = 0 AND i > 1 THEN 0 ELSE len END AS k FROM walk),
done AS (SELECT cigar, room, string_agg(CAST(k AS VARCHAR) || op, '' ORDER BY i) FILTER (k > 0) AS head,
 sum(CASE WHEN op IN ('M','I','S','=','X') THEN len - k ELSE 0 END) AS clip,
 sum(CASE WHEN op = 'H' THEN len - k ELSE 0 END) AS hard FROM kept GROUP BY cigar, room)
SELECT s.qname, s.flag, s.ref_idx, s.pos, CASE WHEN s.flag & 4 <> 0 THEN 0 ELSE s.mapq END AS mapq,
 CASE WHEN s.past THEN concat(d.head, CASE WHEN d.clip > 0 THEN concat(CAST(d.clip AS BIGINT), 'S') ELSE '' END,
  CASE WHEN d.hard > 0 THEN concat(CAST(d.hard AS BIGINT), 'H') ELSE '' END) ELSE s.cigar END AS cigar
FROM sized s LEFT JOIN done d ON d.cigar = s.cigar AND d.room = s.room""")
def clean_reads(spark, sf_dir):
    near = F.when(F.col("ref_idx") == -1, F.col("pos")).otherwise(F.lit(1000000) - F.col("pos") % 50).cast("int")
    source = reads(spark, sf_dir).select("qname", "flag", "ref_idx", near.alias("pos"), "cigar", F.lit(20).alias("mapq"))
    return R.clean_reads(source, fixture(spark, sf_dir, "f_dict"))


def _ranked(order: str, where: str = "true") -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) - 1 AS ord, {CORE_SQL} FROM f_reads WHERE {where}"


@query("wn1_balance_load", f"""
SELECT {CORE_SQL}, CAST(ntile(7) OVER (ORDER BY {REGION}) - 1 AS INT) AS bucket FROM f_reads WHERE {MAPPED}""")
def balance_load(spark, sf_dir):
    rows = O.balance_load(R.mapped_main_chroms(reads(spark, sf_dir)), 7, R.region_order(), stored=True)
    return rows.select(*CORE, "bucket")


@query("wn2_ordinal", _ranked(REGION))
def ordinal(spark, sf_dir):
    return O.ordinal(reads(spark, sf_dir), R.region_order(), stored=True).select("ord", *CORE)


NAME_FILE = "qname, flag, ref_idx, pos, cigar, mapq, seq, qual"


@query("wn3_sort_violations", f"""
WITH f AS (SELECT *, row_number() OVER (ORDER BY {NAME_FILE}) - 1 AS ord, ref_idx = -1 AS un FROM f_reads),
l AS (SELECT ord, un, ref_idx, pos, lag(un) OVER w AS pun, lag(ref_idx) OVER w AS pref, lag(pos) OVER w AS ppos
 FROM f WINDOW w AS (ORDER BY ord))
SELECT ord, CASE WHEN pun THEN '*' ELSE concat(pref, ':', ppos) END AS prev_key,
 CASE WHEN un THEN '*' ELSE concat(ref_idx, ':', pos) END AS key FROM l
WHERE (pun AND NOT un) OR (NOT pun AND NOT un AND (pref > ref_idx OR (pref = ref_idx AND ppos > pos)))""")
def sort_violations(spark, sf_dir):
    return O.sort_violations(O.ordinal(reads(spark, sf_dir), NAME_FILE.split(", "), stored=True), "coordinate", run=1 << 12)


@query("sr3_coordinate_sort", _ranked(COORD))
def coordinate_sort(spark, sf_dir):
    return as_sorted(R.coordinate_sort(reads(spark, sf_dir))).select("ord", *CORE)


@query("sr4_queryname_sort", f"""
SELECT qname, min(row_number) - 1 AS first_ord, max(row_number) - 1 AS last_ord, sum(CASE WHEN flag & 64 <> 0 THEN row_number - 1 END)::BIGINT AS first_end_ords
FROM (SELECT qname, flag, row_number() OVER (ORDER BY {NAME}) AS row_number FROM f_reads) GROUP BY qname""")
def queryname_sort(spark, sf_dir):
    rows = as_sorted(R.queryname_sort(reads(spark, sf_dir)))
    return rows.groupBy("qname").agg(
        F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"),
        F.sum(F.when(FL.has(FL.FIRST), F.col("ord"))).alias("first_end_ords"))


@query("sr5_region_sort", _ranked(REGION, MAPPED))
def region_sort(spark, sf_dir):
    return as_sorted(R.region_sort(R.mapped_main_chroms(reads(spark, sf_dir)))).select("ord", *CORE)


@query("jn5_query_overlapping", f"""
SELECT {CORE_SQL} FROM f_reads WHERE ref_idx = 5 AND pos <= 600000
 AND (CASE WHEN {END_SQL} <> 0 THEN {END_SQL} ELSE pos END) >= 100000""")
def query_overlapping(spark, sf_dir):
    return R.query_overlapping(reads(spark, sf_dir), 5, 100000, 600000).select(*CORE)


@query("jn6_query_contained", f"""
SELECT {CORE_SQL} FROM f_reads WHERE ref_idx = 5 AND pos >= 100000
 AND (CASE WHEN {END_SQL} <> 0 THEN {END_SQL} ELSE pos END) <= 600000""")
def query_contained(spark, sf_dir):
    return R.query_contained(reads(spark, sf_dir), 5, 100000, 600000).select(*CORE)


@query("jn7_query_starting_at", f"""
SELECT {CORE_SQL} FROM f_reads r JOIN (SELECT pos AS top FROM f_reads WHERE ref_idx = 5
 GROUP BY pos ORDER BY count(*) DESC, pos LIMIT 1) t ON r.pos = t.top WHERE ref_idx = 5""")
def query_starting_at(spark, sf_dir):
    source = reads(spark, sf_dir)
    busiest = (source.filter("ref_idx = 5").groupBy("pos").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), "pos").first()["pos"])
    return R.query_starting_at(source, 5, busiest).select(*CORE)


@query("jn8_query_unmapped", f"SELECT {CORE_SQL} FROM f_reads WHERE ref_idx = -1")
def query_unmapped(spark, sf_dir):
    return R.query_unmapped(reads(spark, sf_dir)).select(*CORE)


_layouts: dict[tuple[str, str], StoredReads] = {}


def stored_reads(spark, sf_dir) -> StoredReads:
    """The reads in their region layout, written once per session; bins of 128 kb, as a reference has 1 Mb here."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _layouts:
        path = scratch_dir(spark, "regions")
        store_regions(reads(spark, sf_dir), path, 17)
        _layouts[key] = StoredReads(spark, path, 17)
    return _layouts[key]


@query("jn5_stored_overlapping", f"""
SELECT {CORE_SQL} FROM f_reads WHERE ref_idx = 5 AND pos <= 301000
 AND (CASE WHEN {END_SQL} <> 0 THEN {END_SQL} ELSE pos END) >= 250000""")
def stored_overlapping(spark, sf_dir):
    return stored_reads(spark, sf_dir).overlapping(5, 250000, 301000).select(*CORE)


@query("jn5_stored_targets", f"""
SELECT t.ref_idx, t.start_pos, t.end_pos, count(*) AS n, CAST(sum(pos) AS BIGINT) AS pos_sum FROM f_targets t JOIN
 (SELECT *, CASE WHEN {END_SQL} <> 0 THEN {END_SQL} ELSE pos END AS last FROM f_reads) r
 ON r.ref_idx = t.ref_idx AND r.pos <= t.end_pos AND r.last >= t.start_pos GROUP BY ALL""")
def stored_targets(spark, sf_dir):
    """Reads touching each of many regions, counted by running sums."""
    targets = fixture(spark, sf_dir, "f_targets")
    hits = stored_reads(spark, sf_dir).overlapping_each(targets, total="pos")
    return hits.withColumnRenamed("sum", "pos_sum")


@query("jn6_stored_contained", f"""
SELECT {CORE_SQL} FROM f_reads WHERE ref_idx = 5 AND pos >= 250000
 AND (CASE WHEN {END_SQL} <> 0 THEN {END_SQL} ELSE pos END) <= 301000""")
def stored_contained(spark, sf_dir):
    return stored_reads(spark, sf_dir).contained(5, 250000, 301000).select(*CORE)


@query("jn7_stored_starting_at", f"""
SELECT {CORE_SQL} FROM f_reads r JOIN (SELECT pos AS top FROM f_reads WHERE ref_idx = 5
 GROUP BY pos ORDER BY count(*) DESC, pos LIMIT 1) t ON r.pos = t.top WHERE ref_idx = 5""")
def stored_starting_at(spark, sf_dir):
    stored = stored_reads(spark, sf_dir)
    busiest = (stored.table().filter("ref_idx = 5").groupBy("pos").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), "pos").first()["pos"])
    return stored.starting_at(5, busiest).select(*CORE)


@query("jn8_stored_unmapped", f"SELECT {CORE_SQL} FROM f_reads WHERE ref_idx = -1")
def stored_unmapped(spark, sf_dir):
    return stored_reads(spark, sf_dir).unmapped().select(*CORE)


@query("jn9_mate_join", """
WITH r AS (SELECT row_number() OVER () AS id, * FROM f_reads),
m AS (SELECT r.id, r.qname, CASE WHEN r.flag & 64 <> 0 THEN 1 ELSE 2 END AS "end",
  coalesce(count_if(c.flag & 1 = 0), 0) AS unpaired,
  coalesce(count_if(c.flag & 1 <> 0 AND (CASE WHEN r.flag & 64 <> 0 THEN c.flag & 64 = 0 ELSE c.flag & 128 = 0 END)), 0) AS n,
  min(c.pos) FILTER (c.flag & 1 <> 0 AND (CASE WHEN r.flag & 64 <> 0 THEN c.flag & 64 = 0 ELSE c.flag & 128 = 0 END)) AS mpos,
  min(c.flag) FILTER (c.flag & 1 <> 0 AND (CASE WHEN r.flag & 64 <> 0 THEN c.flag & 64 = 0 ELSE c.flag & 128 = 0 END)) AS mflag
 FROM r LEFT JOIN r c ON c.qname = r.qname AND c.ref_idx = r.mate_ref_idx AND (r.mate_ref_idx = -1 OR c.pos = r.pnext)
 WHERE r.flag & 1 <> 0 GROUP BY r.id, r.qname, r.flag)
SELECT qname, "end", CASE WHEN n = 1 THEN mpos END AS mate_pos, CASE WHEN n = 1 THEN mflag END AS mate_flag,
 CAST(n AS BIGINT) AS n_mates, CASE WHEN unpaired > 0 THEN 'PAIRED_AND_UNPAIRED' WHEN n > 1 THEN 'MULTIPLE_MATES' END AS error FROM m""")
def mate_join(spark, sf_dir):
    return R.mate_join(reads(spark, sf_dir))


RGS_SQL = "SELECT concat('G', r_regionkey) AS id, concat('SM_', r_name) AS sample FROM region WHERE r_regionkey <> 3"


@query("jn12_attach_read_group", f"""
SELECT {CORE_SQL}, rg, g.sample, g.id IS NULL AS rg_missing FROM f_reads LEFT JOIN ({RGS_SQL}) g ON g.id = rg""")
def attach_read_group(spark, sf_dir):
    rgs = (table(spark, sf_dir, "region").filter("r_regionkey <> 3")
           .select(F.concat(F.lit("G"), F.col("r_regionkey")).alias("id"),
                   F.concat(F.lit("SM_"), F.col("r_name")).alias("sample")))
    return R.attach_read_group(reads(spark, sf_dir).select(*CORE, "rg"), rgs)


LEAD = sql_length("regexp_extract(cigar, '^((?:\\d+[SH])+)', 1)", "SH")
TAIL = sql_length("regexp_extract(cigar, '((?:\\d+[SH])+)$', 1)", "SH")


def dup_sql(source: str) -> str:
    """Templates of ``source`` and which of them lose."""
    end = "{'ref': ref_idx, 'five': five, 'rev': flag & 16}"
    return f"""
scored AS (SELECT *, coalesce(rg, '') AS lib, flag & 4 = 0 AND flag & 256 = 0 AS ok,
 CASE WHEN flag & 16 <> 0 THEN {END_SQL} + {TAIL} ELSE pos - {LEAD} END AS five,
 coalesce(list_sum(list_transform(range(1, length(qual) + 1), lambda i: CASE WHEN ascii(substr(qual, i, 1)) - 33 >= 15
  THEN ascii(substr(qual, i, 1)) - 33 ELSE 0 END)), 0) AS score FROM {source}),
ends AS (SELECT lib, qname, {end} AS e, score, flag & 1 <> 0 AND flag & 192 = 64 AS is_first, flag & 1 <> 0 AND flag & 192 = 128 AS is_second
 FROM scored WHERE ok AND qname IS NOT NULL),
named AS (SELECT lib, qname, count(*) AS ends, count(*) = 2 AND count_if(is_first) = 1 AND count_if(is_second) = 1 AS is_pair,
 min(e) AS low, max(e) AS high, sum(score) AS total, max(score) FILTER (e = least_end) AS one
 FROM (SELECT *, min(e) OVER (PARTITION BY lib, qname) AS least_end FROM ends) GROUP BY lib, qname),
rivals AS (SELECT *, first_value(qname) OVER (PARTITION BY lib, is_pair, low, CASE WHEN is_pair THEN high END
  ORDER BY CASE WHEN is_pair THEN total ELSE one END DESC, qname) AS winner FROM named),
taken AS (SELECT lib, low AS e FROM named WHERE is_pair UNION SELECT lib, high FROM named WHERE is_pair),
lost AS (SELECT r.lib, r.qname, r.is_pair, r.ends, r.qname <> r.winner OR (NOT r.is_pair AND t.lib IS NOT NULL) AS is_dup
 FROM rivals r LEFT JOIN taken t ON t.lib = r.lib AND t.e = r.low),
marked AS (SELECT s.*, s.ok AND coalesce(lost.is_dup, false) AS is_dup FROM scored s LEFT JOIN lost ON lost.lib = s.lib AND lost.qname = s.qname)"""


def metrics_sql(source: str) -> str:
    short = "1 / ({r}) - 1 + exp(-n / (({r}) * c)) >= 0"
    middle = "(a.low + a.high) / 2"
    return f"""WITH {dup_sql(source)},
judged AS (SELECT lib, CAST(coalesce(sum(ends) FILTER (NOT is_pair), 0) AS BIGINT) AS unpaired_examined, CAST(count_if(is_pair) AS BIGINT) AS pairs_examined,
 CAST(coalesce(sum(ends) FILTER (NOT is_pair AND is_dup), 0) AS BIGINT) AS unpaired_duplicates,
 CAST(count_if(is_pair AND is_dup) AS BIGINT) AS pair_duplicates FROM lost GROUP BY lib),
other AS (SELECT lib, CAST(count_if(flag & 4 <> 0) AS BIGINT) AS unmapped, CAST(count_if(flag & 256 <> 0) AS BIGINT) AS not_primary FROM scored GROUP BY lib),
m AS (SELECT *, pairs_examined::DOUBLE AS n, (pairs_examined - pair_duplicates)::DOUBLE AS c FROM other LEFT JOIN judged USING (lib)),
top AS (SELECT *, list_reduce(list_transform(range(0, 17), lambda i: 100::DOUBLE), lambda a, b: CASE WHEN {short.format(r='a')} THEN a * 10 ELSE a END) AS high
 FROM m),
root AS (SELECT *, list_reduce(list_transform(range(0, 41), lambda i: {{'low': 1::DOUBLE, 'high': high}}), lambda a, b: CASE WHEN {short.format(r=middle)}
  THEN {{'low': {middle}, 'high': a.high}} ELSE {{'low': a.low, 'high': {middle}}} END) AS r FROM top)
SELECT lib AS library, unmapped, not_primary, coalesce(unpaired_examined, 0) AS unpaired_examined, coalesce(pairs_examined, 0) AS pairs_examined,
 coalesce(unpaired_duplicates, 0) AS unpaired_duplicates, coalesce(pair_duplicates, 0) AS pair_duplicates,
 (unpaired_duplicates + 2 * pair_duplicates) / nullif(unpaired_examined + 2 * pairs_examined, 0) AS duplication,
 CASE WHEN c > 0 AND n > c THEN CAST(floor(c * ((r.low + r.high) / 2)) AS BIGINT) END AS library_size FROM root"""


@query("ag20_mark_duplicates", f"WITH {dup_sql('f_reads')} SELECT {ALL_SQL}, is_dup FROM marked")
def mark_duplicates(spark, sf_dir):
    return DU.mark_duplicates(reads(spark, sf_dir))


@query("ag20_mark_duplicate_pairs", f"WITH {dup_sql('f_ends')} SELECT {ALL_SQL}, is_dup FROM marked")
def mark_duplicate_pairs(spark, sf_dir):
    """As above where most templates are pairs and many share a place."""
    return DU.mark_duplicates(fixture(spark, sf_dir, "f_ends"))


@query("ag20_duplicate_metrics", metrics_sql("f_ends"))
def duplicate_metrics(spark, sf_dir):
    return DU.duplicate_metrics(fixture(spark, sf_dir, "f_ends"))
