"""Inputs derived from the given tables, one SELECT each, the same text for Spark and for SQL checks."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.operators.skew import small_or_none
from readloom.session import cut_lineage, free_shuffles, scratch_dir

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

FIXTURES = {
    "f_costar": """
SELECT DISTINCT o_custkey AS actor, l_partkey * 1000 + CAST(l_quantity AS INT) * 11 + CAST(round(l_discount * 100) AS INT) AS title
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # few titles, each with most of the performers
    "f_cast": """
SELECT DISTINCT o_custkey AS actor, l_suppkey % 20 AS title FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
UNION ALL SELECT c_custkey, 1000 + c_custkey FROM {customer} WHERE c_custkey % 5 < 2
UNION ALL SELECT c_custkey + 5, 1000 + c_custkey FROM {customer} WHERE c_custkey % 5 = 0""",
    "f_dict": """
SELECT CAST(n_nationkey AS INT) AS ref_idx, CASE n_nationkey WHEN 0 THEN 'chrM' WHEN 23 THEN 'chrX' WHEN 24 THEN 'chrY'
 ELSE concat('chr', n_nationkey) END AS rname, 1000000 AS length FROM {nation}
UNION ALL SELECT 25, 'chrUn', 1000000""",
    "f_reads": """
SELECT CASE WHEN paired THEN concat('p', ok) ELSE concat('f', ok, '_', ln, '_', pk, '_', sk) END AS qname,
 CAST(CASE WHEN paired THEN 1 + CASE WHEN ln = 1 THEN 64 ELSE 128 END + CASE WHEN ref_idx = -1 THEN 12 WHEN ln = 1 THEN 34 ELSE 18 END
      WHEN ref_idx = -1 THEN 4
      ELSE CASE WHEN pk % 2 = 1 THEN 16 ELSE 0 END + CASE WHEN pk % 17 = 0 THEN 256 ELSE 0 END + CASE WHEN pk % 29 = 0 THEN 512 ELSE 0 END END AS INT) AS flag,
 ref_idx, pos, CASE WHEN ref_idx = -1 THEN 0 ELSE q END AS mapq,
 CASE WHEN ref_idx = -1 THEN '*' WHEN pk % 5 = 0 THEN '36M' WHEN pk % 5 = 1 THEN '5S31M' WHEN pk % 5 = 2 THEN '10M2I24M' WHEN pk % 5 = 3 THEN '12M3D24M' ELSE '4H30M6S' END AS cigar,
 CASE WHEN paired THEN ref_idx ELSE -1 END AS mate_ref_idx,
 CASE WHEN NOT paired OR ref_idx = -1 THEN 0 WHEN ln = 1 THEN pos + 200 ELSE pos - 200 END AS pnext,
 CASE WHEN NOT paired OR ref_idx = -1 THEN 0 WHEN ln = 1 THEN 236 ELSE -236 END AS tlen,
 substr(repeat('ACGTTGCAAC', 5), CAST(1 + (ok + pk) % 10 AS INT), 36) AS seq,
 repeat(chr(33 + q), 36) AS qual, concat('G', sk % 4) AS rg
FROM (SELECT *, CAST(CASE WHEN ref_idx = -1 THEN 0 WHEN ln = 1 THEN 1 + (ok * 17) % 999000 WHEN ln = 2 THEN 201 + (ok * 17) % 999000
   ELSE 1 + (pk * 131 + ok * 17) % 999000 END AS INT) AS pos
 FROM (SELECT DISTINCT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, CAST(l_quantity AS INT) AS q,
   l_linenumber <= 2 AS paired,
   CAST(CASE WHEN l_linenumber <= 2 THEN l_orderkey % 27 - 1 ELSE l_suppkey % 27 - 1 END AS INT) AS ref_idx
   FROM {lineitem}) b) p""",
    # templates at few places, so that pairs and fragments compete: most are pairs, some have one mapped end or a second alignment
    "f_ends": """
SELECT qname, CAST(CASE WHEN single THEN rev ELSE 1 + 64 * k + CASE WHEN lost THEN 8 ELSE 32 - 2 * rev END + rev END AS INT) AS flag,
 ref_idx, CAST(five - CASE WHEN rev = 16 THEN 35 ELSE -clip END AS INT) AS pos, q AS mapq,
 CASE WHEN clip = 0 THEN '36M' WHEN rev = 16 THEN concat(36 - clip, 'M', clip, 'S') ELSE concat(clip, 'S', 36 - clip, 'M') END AS cigar,
 CASE WHEN single THEN -1 ELSE ref_idx END AS mate_ref_idx, CAST(CASE WHEN single THEN 0 ELSE five END AS INT) AS pnext, CAST(0 AS INT) AS tlen,
 repeat('ACGT', 9) AS seq, repeat(chr(33 + q), 36) AS qual, rg
FROM (SELECT *, five0 + CASE WHEN k = 1 THEN 0 ELSE 200 + sk % 3 * 10 END AS five, CASE WHEN (ok + k) % 2 = 0 THEN 16 ELSE 0 END AS rev,
  CAST((ln + k) % 3 * 2 AS INT) AS clip
 FROM (SELECT concat('t', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) AS qname, l_orderkey AS ok, l_suppkey AS sk,
   l_linenumber AS ln, CAST(l_suppkey % 6 AS INT) AS ref_idx, CAST(l_quantity AS INT) AS q, 1000 + l_partkey % 50 * 100 AS five0,
   l_partkey % 11 = 0 AS single, l_partkey % 11 = 1 AS lost, CASE WHEN l_orderkey % 97 <> 0 THEN concat('L', l_orderkey % 2) END AS rg FROM {lineitem}) b,
  (SELECT 1 AS k UNION ALL SELECT 2) e) p WHERE k = 1 OR NOT (single OR lost)
UNION ALL SELECT concat('t', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey), CASE WHEN l_partkey % 11 = 1 THEN 1 + 4 + 128 ELSE 256 END,
 CAST(l_suppkey % 6 AS INT), CAST(1000 + l_partkey % 50 * 100 AS INT), 0, CASE WHEN l_partkey % 11 = 1 THEN '*' ELSE '36M' END, -1, 0, 0,
 repeat('ACGT', 9), repeat('I', 36), CASE WHEN l_orderkey % 97 <> 0 THEN concat('L', l_orderkey % 2) END
FROM {lineitem} WHERE l_partkey % 11 = 1 OR l_partkey % 11 = 2""",
    "f_targets": """
SELECT CAST(p_partkey % 24 + 1 AS INT) AS ref_idx, CAST(1 + (p_partkey * 9973) % 990000 AS INT) AS start_pos,
 CAST((p_partkey * 9973) % 990000 + p_size * 100 AS INT) AS end_pos FROM {part}""",
    "f_variants_a": """
SELECT CAST(o_custkey % 24 + 1 AS INT) AS chrom_num, CAST(1 + (o_orderkey * 37) % 5000 AS INT) AS pos,
 substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) AS ref, substr('CGTA', CAST(1 + o_orderkey % 4 AS INT), 1) AS alt,
 CAST(o_custkey % 60 AS INT) AS qual FROM {orders}""",
    # a second call set: two thirds of the first's sites, some of them moved by one, so that each set has calls the other lacks
    "f_variants_b": """
SELECT CAST(o_custkey % 24 + 1 AS INT) AS chrom_num,
 CAST(1 + (o_orderkey * 37) % 5000 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS INT) AS pos,
 substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) AS ref, substr('CGTA', CAST(1 + o_orderkey % 4 AS INT), 1) AS alt,
 CAST(o_custkey % 60 AS INT) AS qual FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "f_messages": """
SELECT ts, user_id, event_type AS text, value >= 10 AS is_retweet FROM {events}""",
    "f_tagged": """
SELECT ts, user_id, concat('seen ', event_type, ' #', event_type, ' by #k', user_id % 20, ' a#b') AS text FROM {events}""",
    "f_ids": """
SELECT *, md5(concat_ws('|', qname, flag, ref_idx, pos, mapq, cigar, mate_ref_idx, pnext, tlen, seq, qual, rg)) AS read_id
FROM (SELECT DISTINCT qname, flag, ref_idx, pos, mapq, cigar, mate_ref_idx, pnext, tlen, seq, qual, rg FROM {f_reads}) d""",
    "f_refbases": """
SELECT ref_idx, tile, repeat(concat(substr('ACGTTGCAAC', 1 + (7 + ref_idx) % 10, 1), substr('ACGTTGCAAC', 1 + (14 + ref_idx) % 10, 1),
  substr('ACGTTGCAAC', 1 + (21 + ref_idx) % 10, 1), substr('ACGTTGCAAC', 1 + (28 + ref_idx) % 10, 1), substr('ACGTTGCAAC', 1 + (35 + ref_idx) % 10, 1),
  substr('ACGTTGCAAC', 1 + (42 + ref_idx) % 10, 1), substr('ACGTTGCAAC', 1 + (49 + ref_idx) % 10, 1), substr('ACGTTGCAAC', 1 + (56 + ref_idx) % 10, 1),
  substr('ACGTTGCAAC', 1 + (63 + ref_idx) % 10, 1), substr('ACGTTGCAAC', 1 + (70 + ref_idx) % 10, 1)), 100) AS bases
FROM (SELECT ref_idx, CAST(floor((pos - 1) / 1000) AS INT) AS tile FROM {f_reads} WHERE ref_idx >= 0
 UNION SELECT ref_idx, CAST(floor((pos + 38) / 1000) AS INT) FROM {f_reads} WHERE ref_idx >= 0) t""",
    "f_damaged": """
SELECT qname, CAST(CASE m WHEN 0 THEN flag | 2 WHEN 1 THEN flag | 8 WHEN 2 THEN flag | 32 WHEN 3 THEN flag | 64 WHEN 4 THEN flag | 128
  WHEN 5 THEN flag & ~192 WHEN 9 THEN flag | 4 WHEN 10 THEN flag | 260 ELSE flag END AS INT) AS flag,
 CASE m WHEN 13 THEN -1 WHEN 14 THEN 77 ELSE ref_idx END AS ref_idx, CASE m WHEN 15 THEN 0 WHEN 16 THEN 2000000 ELSE pos END AS pos,
 CASE m WHEN 11 THEN 300 ELSE mapq END AS mapq,
 CASE m WHEN 12 THEN '*' WHEN 20 THEN '5H10M' WHEN 21 THEN '3S2H10M' WHEN 22 THEN '2I3I' WHEN 23 THEN '2I5M2I' WHEN 24 THEN '2P10M'
  WHEN 25 THEN '10M2P' WHEN 26 THEN '5S5H' WHEN 27 THEN '10M5S3H' WHEN 28 THEN '3H5S10M' WHEN 29 THEN '10M5S2M' WHEN 30 THEN '4M2P3S'
  WHEN 31 THEN '2I3S2I5M' WHEN 32 THEN '1D2I1D' WHEN 33 THEN '5M3H2M' WHEN 34 THEN '10P' ELSE cigar END AS cigar,
 CASE m WHEN 6 THEN 3 WHEN 7 THEN -1 ELSE mate_ref_idx END AS mate_ref_idx, pnext, CASE m WHEN 8 THEN 600000000 ELSE tlen END AS tlen,
 CASE m WHEN 18 THEN '*' ELSE seq END AS seq, CASE m WHEN 18 THEN '*' WHEN 19 THEN substr(qual, 1, 20) ELSE qual END AS qual,
 CASE m WHEN 17 THEN 'ZZ' ELSE rg END AS rg
FROM (SELECT *, (pos + mapq * 7 + length(qname)) % 40 AS m FROM {f_reads}) d""",
}

FIXTURES["f_endbases"] = FIXTURES["f_refbases"].replace("{f_reads}", "{f_ends}")  # reference tiles under f_ends


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Read-like inputs are written once per session as parquet, as a pipeline would keep them.
STORED = {"f_costar", "f_cast", "f_reads", "f_ids", "f_refbases", "f_damaged", "f_ends"}
_stored_paths: dict[tuple[str, str, str], str] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in STORED:
        return _select(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
    if key not in _stored_paths:
        path = scratch_dir(spark, name)
        _select(spark, sf_dir, name).write.option("compression", "zstd").parquet(path)
        free_shuffles(spark)
        _stored_paths[key] = path
    return spark.read.parquet(_stored_paths[key])


def _select(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = FIXTURES[name]
    used = {t: (fixture if t in FIXTURES else table)(spark, sf_dir, t) for t in set(_names(text))}
    if name == "f_ids":
        text, used["f_reads"] = text.replace("SELECT DISTINCT ", "SELECT "), distinct_rows(used["f_reads"])
    return spark.sql(text, **used)


def distinct_rows(rows: DataFrame) -> DataFrame:
    """``rows.distinct()`` for wide rows of which few come again: only those whose hash does are compared and shuffled.

    Rows alike in hash may differ, as nulls do not count there. Where many hashes come again all rows are compared.
    """
    hashed = rows.withColumn("_hash", F.xxhash64(*rows.columns))
    again = small_or_none(cut_lineage(hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")))
    if again is None:
        return rows.distinct()
    return hashed.join(again, "_hash", "left_anti").drop("_hash").unionByName(hashed.join(again, "_hash", "left_semi").drop("_hash").distinct())


def _names(text: str) -> list[str]:
    return re.findall(r"{(\w+)}", text)


def _with_parents(name: str) -> list[str]:
    parents = [p for p in _names(FIXTURES[name]) if p in FIXTURES]
    return [n for p in parents for n in _with_parents(p)] + [name]


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with the fixtures it names, as plain CTEs over the bare table names."""
    wanted = list(dict.fromkeys(p for n in FIXTURES if re.search(rf"\b{n}\b", sql) for p in _with_parents(n)))
    if not wanted:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({re.sub(r'{(\w+)}', r'\1', FIXTURES[n]).strip()})" for n in wanted)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].strip()}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:].strip()}"
    return f"WITH {ctes}\n{body}"
