"""Separation, co-star edges and parsing on small hand-made graphs."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from readloom.operators import costars as K
from readloom.operators import graph as G
from readloom.sources import text as T

BIP = [("a", "t1"), ("b", "t1"), ("b", "t2"), ("c", "t2"), ("c", "t3"), ("d", "t3"), ("e", "t4"), ("f", "t5"), ("g", "t5"),
       ("a", "t1")]


@pytest.fixture(scope="module")
def bip(spark):
    return spark.createDataFrame(BIP, "actor string, title string")


def brute(pairs, seed, limit):
    cast = defaultdict(set)
    for actor, title in pairs:
        cast[title].add(actor)
    near = defaultdict(set)
    for members in cast.values():
        for m in members:
            near[m] |= members - {m}
    dist, layer = {seed: 0}, {seed}
    for d in range(1, limit + 1):
        layer = {n for m in layer for n in near[m]} - dist.keys()
        dist.update(dict.fromkeys(layer, d))
    return {a: dist.get(a) for a, _ in pairs}


@pytest.mark.parametrize("hot_rows", [1, 1 << 21])
@pytest.mark.parametrize("limit", [1, 2, 6])
def test_separation(bip, hot_rows, limit):
    got = {r.id: r.dist for r in G.separation(bip, "a", limit, hot_rows).collect()}
    assert got == brute(BIP, "a", limit)


def ladder(wide):
    """A seed with one co-star, who plays with ``wide`` others in titles of ten, who all play with a tail of three."""
    pairs = [("s", "first"), ("hub", "first")] + [(f"w{i}", f"m{i // 10}") for i in range(wide)] + [("hub", f"m{k}") for k in range(wide // 10)]
    pairs += [(f"w{i}", f"n{(i * 7) % wide // 10}") for i in range(wide)] + [("w0", "last"), ("x", "last"), ("x", "end"), ("y", "end"), ("lone", "own")]
    return pairs


@pytest.mark.parametrize("hot_rows", [20, 1 << 21])
def test_directions_agree_and_the_widest_layer_moves_fewer_rows(spark, hot_rows):
    pairs = ladder(600)
    graph = spark.createDataFrame(pairs, "actor string, title string")
    traces = {}
    for way in ("down", "up", "auto"):
        trace = traces[way] = []
        got = {r.id: r.dist for r in G.separation(graph, "s", 6, hot_rows, way, trace).collect()}
        assert got == brute(pairs, "s", 6), way
    rows = {way: {(d, side): n for d, side, _, n in trace} for way, trace in traces.items()}
    assert rows["down"][3, "titles"] >= 1200 and rows["auto"][3, "titles"] < rows["down"][3, "titles"] / 1.9
    assert all(rows["auto"][k] == min(rows["down"][k], rows["up"][k]) for k in rows["auto"])
    assert {w for _, _, w, _ in traces["auto"]} == {"down", "up"}
    with pytest.raises(ValueError):
        G.separation(graph, "s", direction="sideways")


@pytest.mark.parametrize("hot_rows", [3, 1 << 21])
def test_many_seeds_walk_as_bits(spark, hot_rows):
    pairs = ladder(150)
    graph = spark.createDataFrame(pairs, "actor string, title string")
    seeds = ["s", "hub", "lone", "nobody", "y", *[f"w{i}" for i in range(130)]]
    got = {(r.seed, r.id): r.dist for r in G.separation_of_many(graph, spark.createDataFrame([(s,) for s in seeds], "id string"), 4, hot_rows).collect()}
    want = {(s, i): d for s in seeds if s != "nobody" for i, d in brute(pairs, s, 4).items() if d is not None}
    assert got == want


@pytest.mark.parametrize("small", [0, 3, 512])
def test_costar_sets(spark, small):
    """Bitmaps of every size of cast give the pairs that a list gives."""
    pairs = [(f"p{i}", "big") for i in range(1200)] + [(f"p{i}", f"t{i // 3}") for i in range(1190, 1300)] + [("alone", "own"), ("p0", "own2")]
    pairs += [("p0", "big")]
    numbers, sets = K.costar_bitmaps(spark.createDataFrame(pairs, "actor string, title string"), small, hot_rows=100)
    cast = defaultdict(set)
    for actor, title in pairs:
        cast[title].add(actor)
    near = defaultdict(set)
    for members in cast.values():
        for m in members:
            near[m] |= members
    assert {r.actor: r.degree for r in K.costar_degrees(numbers, sets).collect()} == {a: len(n) - 1 for a, n in near.items()}
    asked = [("p0", "p1"), ("p0", "p1250"), ("p1250", "p1250"), ("p1198", "p1200"), ("alone", "p0"), ("who", "p0"), ("p0", "p0"), ("p0", "p1")]
    frame = spark.createDataFrame(asked, "a string, b string")
    linked = [(r.a, r.b, r.linked) for r in K.are_costars(frame, numbers, sets).collect()]
    assert sorted(linked) == sorted((a, b, a != b and b in near.get(a, ())) for a, b in asked)
    common = [(r.a, r.b, r.common) for r in K.common_costars(frame, numbers, sets).collect()]
    assert sorted(common) == sorted((a, b, len((near.get(a, set()) & near.get(b, set())) - {a, b})) for a, b in asked)


def test_buckets_of_many_performers(spark):
    """More performers than a bucket holds: sets of several bitmaps."""
    wide = spark.range(70000).select(F.concat(F.lit("p"), F.lpad("id", 6, "0")).alias("actor"), F.lit("t").alias("title")).filter("actor like '%7'")
    bip = wide.unionByName(spark.range(70000).select(F.concat(F.lit("p"), F.lpad("id", 6, "0")).alias("actor"), F.concat(F.lit("u"), "id").alias("title")))
    numbers, sets = K.costar_bitmaps(bip)
    got = K.costar_degrees(numbers, sets).groupBy("degree").count().collect()
    assert {r.degree: r["count"] for r in got} == {0: 63000, 6999: 7000}


def test_separation_of_unknown_seed(bip):
    assert {r.dist for r in G.separation(bip, "nobody").collect()} == {None}


def test_distances_differ_by_at_most_one_across_an_edge(spark, bip):
    dist = G.separation(bip, "a")
    ends = G.costar_pairs(G.costar_edges(bip)).join(dist.withColumnRenamed("id", "src"), "src").join(
        dist.select(F.col("id").alias("dst"), F.col("dist").alias("d2")), "dst")
    assert ends.filter("abs(dist - d2) > 1 OR (dist IS NULL) <> (d2 IS NULL)").isEmpty()


def test_a_large_cast_stays_linear_and_nothing_is_lost(spark):
    pairs = [(f"p{i}", "big") for i in range(1200)] + [("p0", "s"), ("q", "s"), ("alone", "own")]
    bip = spark.createDataFrame(pairs, "actor string, title string")
    edges = G.costar_edges(bip, hot_rows=100)
    assert {(r.src, r.hub) for r in edges.collect()} == set(pairs) - {("alone", "own")}
    seed = G.seed_distance(bip.select(F.col("actor").alias("id")).distinct(), "q")
    one = G.relax(seed, G.expand_frontier(seed, edges))
    two = G.relax(one, G.expand_frontier(one, edges))
    assert {r.id: r.dist for r in two.collect()} == brute(pairs, "q", 2)
    lists = G.adjacency(G.costar_pairs(edges, hot_rows=100), page=500).collect()
    near = defaultdict(set)
    for r in lists:
        near[r.src] |= set(r.nbrs)
    assert len(near["p7"]) == 1199 and near["p0"] == {f"p{i}" for i in range(1, 1200)} | {"q"} and near["q"] == {"p0"}
    assert max(len(r.nbrs) for r in lists) < 600


def test_adjacency_pages(spark):
    edges = spark.range(100).select(F.lit("x").alias("src"), F.col("id").alias("dst"))
    pages = G.adjacency(edges, page=30).collect()
    assert len(pages) == 4 and sorted(n for p in pages for n in p.nbrs) == list(range(100))


def test_parse_quirks(spark, tmp_path):
    text = ("Bacon, Kevin (I)\tFootloose (1984)  [Ren]  <1>\n\t\t\tBare Title\n\t\t\tDiner (1982)  [Fenwick]\n\n"
            "no tab here\n\nAlone, A\tSolo\n\n\tNameless (1990)\n\nBacon, Kevin (I)\tDiner (1982)\n").encode()
    (tmp_path / "actors").write_bytes(text + "\nAndré, Zoë\tÉté  [x]".encode("latin-1"))
    blocks = T.read_blocks(spark, str(tmp_path / "actors"), encoding="ISO-8859-1")
    got = sorted((r.actor, r.title) for r in G.parse_bipartite(blocks).collect())
    assert got == sorted([("Bacon, Kevin (I)", "Footloose (1984)"), ("Bacon, Kevin (I)", "Bare Title"), ("Bacon, Kevin (I)", "Diner (1982)"),
                          ("Alone, A", "Solo"), ("", "Nameless (1990)"), ("Bacon, Kevin (I)", "Diner (1982)"), ("André, Zoë", "Été")])
    assert G.bad_records(blocks).first().n == 1
    assert G.drop_empty_names(G.parse_bipartite(blocks)).count() == 6


def test_seed_by_substring(spark):
    vertices = spark.createDataFrame([("Bacon, Kevin (I)",), ("Bacon, Kevin (II)",), ("x",)], "id string")
    assert G.seed_distance(vertices, "Bacon, Kevin (I").filter("dist = 0").count() == 0
    assert G.seed_distance(vertices, "Bacon, Kevin (I", substring=True).filter("dist = 0").count() == 2


def test_report_lines(spark, bip, tmp_path):
    T.write_report(G.separation_report(bip, "a", 3), str(tmp_path / "r"))
    lines = [r.value for r in T.positioned_lines(spark, str(tmp_path / "r")).orderBy("ord").collect()]
    assert lines == ["(Total number of actors,7)", "(Total number of movies (and TV shows etc),5)", "(Total number of actors at distance 1,1)",
                     "(Total number of actors at distance 2,1)", "(Total number of actors at distance 3,1)",
                     "(The name of actors at distance 3,)", "(,d)"]


def test_costars_are_counted_by_class(spark, monkeypatch):
    """Performers alike in crowded titles are one class, so no set of a performer is stored; several buckets and slices."""
    monkeypatch.setattr(K, "CLASSES", 2)
    monkeypatch.setattr(K, "ASKED", 3)
    pairs = [(i, t) for i in range(300) for t in range(4) if i >> t & 1] + [(i, 100 + i // 2) for i in range(40)]
    edges, sets = K.costar_bitmaps(spark.createDataFrame(pairs, "actor long, title long"), 10)
    assert sets.classes.count() == 15 and sets.members.count() == 281
    near = defaultdict(set)
    for t in {t for _, t in pairs}:
        cast = {i for i, u in pairs if u == t}
        for i in cast:
            near[i] |= cast
    assert {r.actor: r.degree for r in K.costar_degrees(edges, sets).collect()} == {i: len(n) - 1 for i, n in near.items()}
    asked = [(i, (7 * i + 3) % 300) for i in range(0, 300, 3)]
    got = K.common_costars(spark.createDataFrame(asked, "a long, b long"), edges, sets).collect()
    assert {(r.a, r.b): r.common for r in got} == {(a, b): len((near.get(a, set()) & near.get(b, set())) - {a, b}) for a, b in asked}


def test_total_records_counts_every_row(spark, tmp_path):
    """Two titles of a performer that a block of the list would hold together."""
    from readloom.plans import registry

    registry.load_all()
    spark.createDataFrame([(1, 7, 1.0, 0.0), (1, 7, 2.0, 0.0), (2, 7, 1.0, 0.0)], "l_orderkey long, l_partkey long, l_quantity double, l_discount double"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 5), (2, 6)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    assert registry.QUERIES["ag3_total_records"](spark, str(tmp_path)).first().n == 3
