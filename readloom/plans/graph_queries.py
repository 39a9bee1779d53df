"""Degrees-of-separation queries on the performer-title table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.operators import costars as K
from readloom.operators import graph as G
from readloom.plans.fixtures import fixture, table
from readloom.plans.registry import query
from readloom.session import cut_lineage

SEED_SQL = "SELECT actor FROM f_costar GROUP BY actor ORDER BY count(*) DESC, actor LIMIT 1"

EDGES_SQL = """edges AS (SELECT DISTINCT actor AS src, title AS hub FROM f_costar
 WHERE title IN (SELECT title FROM f_costar GROUP BY title HAVING count(*) > 1))"""

WALK_SQL = f"""seed AS ({SEED_SQL}),
walk AS (
 SELECT actor AS id, 0 AS dist FROM seed
 UNION SELECT b.actor, w.dist + 1 FROM walk w JOIN f_costar a ON a.actor = w.id JOIN f_costar b ON b.title = a.title WHERE w.dist < 6),
dist AS (
 SELECT v.actor AS id, CAST(min(w.dist) AS INT) AS dist FROM (SELECT DISTINCT actor FROM f_costar) v
 LEFT JOIN walk w ON w.id = v.actor GROUP BY v.actor)"""


def bipartite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "f_costar")


def top_actor(bip: DataFrame):
    """The performer with most titles, lowest id on ties: one row."""
    return (bip.groupBy("actor").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "actor").first()["actor"])


def _vertices(bip: DataFrame) -> DataFrame:
    return bip.select(F.col("actor").alias("id")).distinct()


@query("jn1_costar_edges", f"WITH {EDGES_SQL} SELECT src, hub FROM edges")
def costar_edges(spark, sf_dir):
    return G.costar_edges(bipartite(spark, sf_dir))


@query("pf4_drop_self_pairs", """
SELECT actor AS src, title AS dst FROM f_costar WHERE actor <> title""")
def drop_self_pairs(spark, sf_dir):
    return G.drop_self_pairs(bipartite(spark, sf_dir).select(F.col("actor").alias("src"), F.col("title").alias("dst")))


@query("pf5_drop_empty_names", "SELECT text AS name, lang FROM documents WHERE length(text) > 0")
def drop_empty_names(spark, sf_dir):
    return G.drop_empty_names(table(spark, sf_dir, "documents").select(F.col("text").alias("name"), "lang"), "name")


@query("pf6_seed_distance", f"""
SELECT id, CAST(CASE WHEN id = ({SEED_SQL}) THEN 0 END AS INT) AS dist FROM (SELECT DISTINCT actor AS id FROM f_costar)""")
def seed_distance(spark, sf_dir):
    bip = bipartite(spark, sf_dir)
    return G.seed_distance(_vertices(bip), top_actor(bip))


@query("jn2_expand_frontier", f"""
WITH {EDGES_SQL}, seed AS ({SEED_SQL})
SELECT DISTINCT h.src AS id, 1 AS dist FROM seed s JOIN edges e ON e.src = s.actor JOIN edges h ON h.hub = e.hub""")
def expand_frontier(spark, sf_dir):
    bip = bipartite(spark, sf_dir)
    return G.expand_frontier(G.seed_distance(_vertices(bip), top_actor(bip)), cut_lineage(G.costar_edges(bip)))


@query("jn3_relax", f"""
WITH {EDGES_SQL}, seed AS ({SEED_SQL}),
cand AS (SELECT DISTINCT h.src AS id, 1 AS dist FROM seed s JOIN edges e ON e.src = s.actor JOIN edges h ON h.hub = e.hub)
SELECT v.id, CAST(CASE WHEN v.id = (SELECT actor FROM seed) THEN 0 ELSE c.dist END AS INT) AS dist
FROM (SELECT DISTINCT actor AS id FROM f_costar) v LEFT JOIN cand c ON c.id = v.id""")
def relax(spark, sf_dir):
    bip = bipartite(spark, sf_dir)
    start = G.seed_distance(_vertices(bip), top_actor(bip))
    return G.relax(start, G.expand_frontier(start, cut_lineage(G.costar_edges(bip))))


@query("ag1_min_by_key", "SELECT actor, min(title) AS title FROM f_costar GROUP BY actor")
def min_by_key(spark, sf_dir):
    return G.min_by_key(bipartite(spark, sf_dir), "actor", "title")


@query("ag2_adjacency", """
SELECT a.actor AS src, 0 AS page, array_to_string(list_sort(list(DISTINCT b.actor)), ',') AS nbrs
FROM f_costar a JOIN f_costar b ON a.title = b.title WHERE a.actor <> b.actor GROUP BY a.actor""")
def adjacency(spark, sf_dir):
    pairs = cut_lineage(G.costar_pairs(cut_lineage(G.costar_edges(bipartite(spark, sf_dir)))))
    return G.adjacency(pairs).withColumn("nbrs", F.array_join(F.col("nbrs").cast("array<string>"), ","))


# a performer with more than 500 titles comes in several blocks
BLOCKS_SQL = "blocks AS (SELECT DISTINCT actor, title // 500 AS part FROM f_costar)"


def blocks(bip: DataFrame) -> DataFrame:
    """One row per input block of the list."""
    return bip.select("actor", F.floor(F.col("title") / 500).alias("part")).distinct()


@query("ag3_total_records", "SELECT count(*) AS n FROM f_costar")
def total_records(spark, sf_dir):
    return G.total_records(bipartite(spark, sf_dir))


@query("ag4_distinct_titles", "SELECT count(DISTINCT title) AS n FROM f_costar")
def distinct_titles(spark, sf_dir):
    return G.distinct_titles(bipartite(spark, sf_dir))


@query("ag5_distance_histogram", f"""
WITH RECURSIVE {WALK_SQL} SELECT dist, count(*) AS n FROM dist WHERE dist BETWEEN 1 AND 6 GROUP BY dist""")
def distance_histogram(spark, sf_dir):
    bip = bipartite(spark, sf_dir)
    return G.distance_histogram(G.separation(bip, top_actor(bip)))


@query("ag6_distinct_edges", """
SELECT DISTINCT o_custkey AS src, l_partkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def distinct_edges(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("dst"))
    owners = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("src"))
    return G.distinct_edges(lines.join(owners, "k").select("src", "dst"))


@query("separation", f"WITH RECURSIVE {WALK_SQL} SELECT id, dist FROM dist")
def separation(spark, sf_dir):
    bip = bipartite(spark, sf_dir)
    return G.separation(bip, top_actor(bip))


@query("sr2_names_at_distance", f"WITH RECURSIVE {WALK_SQL} SELECT id FROM dist WHERE dist = 6 ORDER BY id")
def names_at_distance(spark, sf_dir):
    bip = bipartite(spark, sf_dir)
    return G.names_at_distance(G.separation(bip, top_actor(bip)))


@query("ag7_separation_report", f"""
WITH RECURSIVE {WALK_SQL}, {BLOCKS_SQL}
SELECT 1 AS ord, '{G.LABEL_ACTORS}' AS label, CAST(count(*) AS VARCHAR) AS value FROM blocks
UNION ALL SELECT 2, '{G.LABEL_TITLES}', CAST(count(DISTINCT title) AS VARCHAR) FROM f_costar
UNION ALL SELECT CAST(s.d + 2 AS INT), concat('{G.LABEL_AT}', s.d), CAST(count(x.id) AS VARCHAR)
 FROM (SELECT unnest(range(1, 7)) AS d) s LEFT JOIN dist x ON x.dist = s.d GROUP BY s.d
UNION ALL SELECT 9, '{G.LABEL_NAMES}6', ''
UNION ALL SELECT 10, '', CAST(id AS VARCHAR) FROM dist WHERE dist = 6""")
def separation_report(spark, sf_dir):
    bip = bipartite(spark, sf_dir)
    return G.separation_report(bip, top_actor(bip), records=blocks(bip))


# ---- crowded titles and many seeds

CAST_PAIRS_SQL = "cast_pairs AS (SELECT DISTINCT a.actor AS a, b.actor AS b FROM f_cast a JOIN f_cast b ON a.title = b.title)"


@query("jn1_costar_edges_crowded", """
SELECT DISTINCT actor AS src, title AS hub FROM f_cast WHERE title IN (SELECT title FROM f_cast GROUP BY title HAVING count(DISTINCT actor) > 1)""")
def costar_edges_crowded(spark, sf_dir):
    return G.costar_edges(fixture(spark, sf_dir, "f_cast"), hot_rows=500)


@query("ag2_costar_degree", f"""
WITH {CAST_PAIRS_SQL} SELECT a AS actor, count(*) - 1 AS degree FROM cast_pairs GROUP BY a""")
def costar_degree(spark, sf_dir):
    """From bitmaps, where most casts hold most performers."""
    return K.costar_degrees(*K.costar_bitmaps(fixture(spark, sf_dir, "f_cast")))


PAIRS_SQL = "p AS (SELECT c_custkey AS a, (c_custkey * 7 + 3) % 1600 AS b FROM customer)"


@query("ag2_are_costars", f"""
WITH {CAST_PAIRS_SQL}, {PAIRS_SQL}
SELECT p.a, p.b, p.a <> p.b AND c.a IS NOT NULL AS linked FROM p LEFT JOIN cast_pairs c ON c.a = p.a AND c.b = p.b""")
def are_costars(spark, sf_dir):
    return K.are_costars(_asked(spark, sf_dir), *K.costar_bitmaps(fixture(spark, sf_dir, "f_cast")))


@query("ag2_common_costars", f"""
WITH {CAST_PAIRS_SQL}, {PAIRS_SQL}, n AS (SELECT p.a, p.b, count(*) AS n FROM p JOIN cast_pairs x ON x.a = p.a JOIN cast_pairs y ON y.a = p.b AND y.b = x.b
 WHERE x.b <> p.a AND x.b <> p.b GROUP BY ALL)
SELECT p.a, p.b, coalesce(n.n, 0) AS common FROM p LEFT JOIN n ON n.a = p.a AND n.b = p.b""")
def common_costars(spark, sf_dir):
    return K.common_costars(_asked(spark, sf_dir), *K.costar_bitmaps(fixture(spark, sf_dir, "f_cast")))


def _asked(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("a"), ((key * 7 + 3) % 1600).alias("b"))


@query("separation_of_many", f"""
WITH RECURSIVE seeds AS (SELECT actor AS seed FROM (SELECT DISTINCT actor FROM f_costar) ORDER BY actor DESC LIMIT 70),
walk AS (
 SELECT seed, seed AS id, 0 AS dist FROM seeds
 UNION SELECT w.seed, b.actor, w.dist + 1 FROM walk w JOIN f_costar a ON a.actor = w.id JOIN f_costar b ON b.title = a.title WHERE w.dist < 2)
SELECT seed, id, CAST(min(dist) AS INT) AS dist FROM walk GROUP BY ALL""")
def separation_of_many(spark, sf_dir):
    """Two steps from 70 performers at once: two words of seeds."""
    bip = bipartite(spark, sf_dir)
    seeds = bip.select(F.col("actor").alias("id")).distinct().orderBy(F.desc("id")).limit(70)
    return G.separation_of_many(bip, cut_lineage(seeds), 2)


@query("separation_crowded", f"WITH RECURSIVE {WALK_SQL.replace('f_costar', 'f_cast')} SELECT id, dist FROM dist")
def separation_crowded(spark, sf_dir):
    bip = fixture(spark, sf_dir, "f_cast")
    return G.separation(bip, top_actor(bip), hot_rows=500)
