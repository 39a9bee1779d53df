"""Degrees of separation over a bipartite (actor, title) table.

The walk alternates actor -> title -> actor, so a round costs the rows it touches. The co-star relation stays
factored (performer, title); its pairs are listed only where a result consists of them (``costar_pairs``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators.ordering import number_rows
from readloom.operators.skew import HOT_ROWS, copy_rows, heavy_keys, lookup_join, slice_rows, sliced_join, sliced_pairs, union_all
from readloom.session import cut_lineage, fixed_layout

SEED_NAME = "Bacon, Kevin (I)"  # where the walk starts unless told otherwise
PAGE = 1 << 16      # neighbours per adjacency row

# Labels of the report.
LABEL_ACTORS = "Total number of actors"
LABEL_TITLES = "Total number of movies (and TV shows etc)"
LABEL_AT = "Total number of actors at distance "
LABEL_NAMES = "The name of actors at distance "


def parse_bipartite(blocks: DataFrame) -> DataFrame:
    """``value`` blocks -> (actor, title); a block without a tab gives no row."""
    head = F.split("value", "\t+", 2)
    return (
        blocks.filter(F.instr("value", "\t") > 0)
        .select(head[0].alias("actor"), F.explode(F.split(head[1], "\t+")).alias("entry"))
        .select(F.trim("actor", F.lit(" \n\r")).alias("actor"),
                F.trim(F.split("entry", "  ")[0], F.lit(" \n\r")).alias("title"))
        .filter(F.col("title") != "")
    )


def bad_records(blocks: DataFrame) -> DataFrame:
    """How many blocks ``parse_bipartite`` passes over."""
    return blocks.agg(F.count_if(F.instr("value", "\t") == 0).alias("n"))


def drop_self_pairs(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("src") != F.col("dst"))


def drop_empty_names(df: DataFrame, name: str = "actor") -> DataFrame:
    return df.filter(F.length(F.col(name).cast("string")) > 0)


def seed_distance(vertices: DataFrame, seed, substring: bool = False) -> DataFrame:
    """Distance 0 for the seed, null (not reached) for the rest; equality unless ``substring``."""
    is_seed: Column = F.contains(F.col("id"), F.lit(seed)) if substring else F.col("id") == F.lit(seed)
    return vertices.select("id", F.when(is_seed, F.lit(0)).cast("int").alias("dist"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.dropDuplicates()


def costar_edges(bip: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The co-star relation as (src, hub): any two performers of a hub are co-stars.

    One row per performer and title, for titles of two performers or more, however large a cast is.
    """
    members = bip.select(F.col("actor").alias("src"), F.col("title").alias("hub")).distinct()
    shared = members.groupBy("hub").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("hub")
    return sliced_join(members, shared, ["hub"], hot_rows=hot_rows).select("src", "hub")


def costar_pairs(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every ordered pair (src, dst) of the relation, for results that consist of the pairs."""
    other = edges.select(F.col("src").alias("dst"), "hub")
    return drop_self_pairs(sliced_pairs(edges, other, ["hub"], hot_rows).select("src", "dst")).distinct()


def adjacency(edges: DataFrame, page: int = PAGE) -> DataFrame:
    """(src, page, nbrs): distinct sorted neighbours, about ``page`` of them per row, split by neighbour hash."""
    flat = edges.select("src", "dst").distinct()
    pages = flat.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / F.lit(page)).cast("int").alias("_pages"))
    paged = sliced_join(flat, pages, ["src"]).withColumn("page", F.pmod(F.xxhash64("dst"), F.col("_pages")).cast("int"))
    return paged.groupBy("src", "page").agg(F.sort_array(F.collect_set("dst")).alias("nbrs"))


def min_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(value).alias(value))


def expand_frontier(dist: DataFrame, edges: DataFrame) -> DataFrame:
    """One step over the factored relation: (neighbour, smallest dist + 1).

    Through a hub a vertex meets itself too, one step farther; ``relax`` drops that. ``edges`` is read twice, so
    store or checkpoint it.
    """
    known = dist.filter(F.col("dist").isNotNull())
    members = edges.select(F.col("src").alias("id"), "hub")
    at_hub = min_by_key(sliced_join(members, known, ["id"]), "hub", "dist")
    return min_by_key(sliced_join(members, at_hub, ["hub"]).select("id", (F.col("dist") + 1).cast("int").alias("dist")), "id", "dist")


def relax(old: DataFrame, candidates: DataFrame) -> DataFrame:
    """Smaller of the old and the candidate distance, for the vertices of ``old``."""
    merged = union_all(old.select("id", "dist", F.lit(1).alias("_old")),
                       candidates.select("id", "dist", F.lit(0).alias("_old")))
    return (merged.groupBy("id").agg(F.min("dist").alias("dist"), F.max("_old").alias("_old"))
            .filter(F.col("_old") == 1).drop("_old"))


class _Side:
    """Edges laid out once by one endpoint; a walk step then shuffles only its frontier."""

    def __init__(self, edges: DataFrame, key: str, other: str, hot_rows: int):
        self.key, self.other, self.on = key, other, [key]
        rows = edges.select(key, other)
        degrees = edges.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        self.hot = None
        heaviest = degrees.agg(F.max("_n").alias("n")).first()["n"]
        if heaviest is not None and heaviest > hot_rows:
            self.hot = cut_lineage(heavy_keys(degrees, [key], hot_rows))
            self.on = [key, "_slot"]
            rows = slice_rows(rows, self.hot, [key])
        self.rows = cut_lineage(rows.repartition(*self.on).sortWithinPartitions(*self.on))
        self.vertices = cut_lineage(degrees.select(F.col(key).alias("id"), F.col("_n").alias("degree")).repartition("id"))

    def edges_of(self, frontier: DataFrame) -> DataFrame:
        """(id, other, ...) for every edge of the frontier's vertices, with the frontier's other columns."""
        start = frontier.withColumnRenamed("id", self.key)
        if self.hot is not None:
            start = copy_rows(start, self.hot, [self.key])
        return start.join(self.rows, self.on).drop("_slot").withColumnRenamed(self.key, "id").withColumnRenamed(self.other, "other")

    def step(self, frontier: DataFrame) -> DataFrame:
        """The other ends of all edges of ``frontier`` (id)."""
        return self.edges_of(frontier.select("id")).select(F.col("other").alias("id")).distinct()


class _Layers:
    """What a walk has reached on one side: its layers (id, degree), and the edges of the vertices not reached yet."""

    def __init__(self, side: _Side, edges: int):
        self.side, self.rest, self.layers, self.edges = side, edges, [], 0

    def add(self, found: DataFrame) -> bool:
        """Keeps a new layer; False if it is empty."""
        layer = cut_lineage(found)
        self.edges = layer.agg(F.sum("degree")).first()[0] or 0
        self.rest -= self.edges
        self.layers.append(layer)
        return self.edges > 0

    def reach(self, other: _Layers, direction: str) -> tuple[str, int]:
        """Adds the vertices next to the last layer of ``other``: (direction taken, edge rows looked at).

        Downward the edges of that layer tell their other ends, most of which are known once a layer is wide. Upward the
        vertices not reached yet look for the layer among their own neighbours, of which there are fewer then.
        """
        frontier, vertices = other.layers[-1], self.side.vertices
        if direction == "up" or (direction == "auto" and self.rest < other.edges):
            rows = self.rest
            rest = vertices.join(union_all(*self.layers).select("id"), "id", "left_anti") if self.layers else vertices
            seen = sliced_join(self.side.edges_of(rest.select("id")).select("id", "other"),
                               frontier.select(F.col("id").alias("other")), ["other"], "left_semi")
            self.add(rest.join(seen.select("id").distinct(), "id", "left_semi"))
            return "up", rows
        found = vertices.join(other.side.step(frontier), "id", "left_semi")
        self.add(found.join(self.layers[-1], "id", "left_anti") if self.layers else found)
        return "down", other.edges


def separation(bip: DataFrame, seed=SEED_NAME, max_dist: int = 6, hot_rows: int = HOT_ROWS, direction: str = "auto",
               trace: list | None = None) -> DataFrame:
    """(id, dist) for every actor; dist null if not within ``max_dist`` steps of ``seed``.

    Breadth-first over the bipartite graph, from actors to titles and back. A neighbour of a layer lies in the layer before or
    after it, so a new layer only has to drop what the last one on its side held. Each half step goes ``down`` from
    the frontier or ``up`` from the vertices not reached yet; ``auto`` takes the one with fewer edges. Layers are
    checkpointed. ``trace`` is given (distance, side, direction, edge rows) of every half step.
    """
    if direction not in ("auto", "down", "up"):
        raise ValueError("direction must be auto, down or up")
    edges = cut_lineage(bip.select("actor", "title").distinct())
    n = edges.count()
    with fixed_layout(bip.sparkSession, n):
        actors = _Layers(_Side(edges, "actor", "title", hot_rows), n)
        titles = _Layers(_Side(edges, "title", "actor", hot_rows), n)
        more, dist = actors.add(actors.side.vertices.filter(F.col("id") == F.lit(seed))), 0
        while more and dist < max_dist:
            dist += 1
            for name, here, there in (("titles", titles, actors), ("actors", actors, titles)):
                step = here.reach(there, direction)
                if trace is not None:
                    trace.append((dist, name, *step))
            more = actors.edges > 0
    layers = [layer.select("id", F.lit(k).alias("dist")) for k, layer in enumerate(actors.layers)]
    return min_by_key(union_all(*layers, actors.side.vertices.select("id", F.lit(None).cast("int").alias("dist"))), "id", "dist")


def separation_of_many(bip: DataFrame, seeds: DataFrame, max_dist: int = 6, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(seed, id, dist) for every seed of ``seeds`` (id) and actor within ``max_dist`` steps of it.

    64 seeds walk together as the bits of a word, so a vertex that many seeds reach in the same step is one row. A layer holds
    (id, word, bits); a step joins the bits at each end by OR, map-side first, and clears those the layer before had.
    """
    edges = cut_lineage(bip.select("actor", "title").distinct())
    numbered = cut_lineage(number_rows(seeds.select(F.col("id").alias("seed")).distinct(), ["seed"], "_k").drop("_total"))
    with fixed_layout(bip.sparkSession, edges.count()):
        by_actor = _Side(edges, "actor", "title", hot_rows)
        by_title = _Side(edges, "title", "actor", hot_rows)
        word, bit = F.shiftright("_k", 6).alias("word"), F.expr("shiftleft(1L, int(_k & 63))")
        start = numbered.join(by_actor.vertices.select(F.col("id").alias("seed")), "seed").groupBy(F.col("seed").alias("id"), word)
        layer = cut_lineage(start.agg(F.bit_or(bit).alias("bits")).repartition("id"))
        layers, before = [layer.withColumn("dist", F.lit(0))], None
        clear = F.bitwise_not(F.coalesce(F.col("_old"), F.lit(0).cast("long")))

        def advance(frontier, side, known):
            met = side.edges_of(frontier).groupBy(F.col("other").alias("id"), "word").agg(F.bit_or("bits").alias("bits"))
            if known is not None:
                old = known.select("id", "word", F.col("bits").alias("_old"))
                met = met.join(old, ["id", "word"], "left").withColumn("bits", F.col("bits").bitwiseAND(clear)).drop("_old")
            return cut_lineage(met.filter(F.col("bits") != 0).repartition("id"))

        for dist in range(1, max_dist + 1):
            before = advance(layer, by_actor, before)
            layer = advance(before, by_title, layer)
            if layer.isEmpty():
                break
            layers.append(layer.withColumn("dist", F.lit(dist)))
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.call_function("getbit", F.col("bits"), k) == 1)
    reached = union_all(*layers).select("id", "dist", F.explode(F.transform(places, lambda k: F.col("word") * 64 + k)).alias("_k"))
    return lookup_join(reached, numbered, ["_k"], "inner").select("seed", "id", "dist")


def total_records(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_titles(bip: DataFrame) -> DataFrame:
    return bip.agg(F.count_distinct("title").alias("n"))


def distance_histogram(dist: DataFrame, max_dist: int = 6) -> DataFrame:
    return (dist.filter(F.col("dist").between(1, max_dist))
            .groupBy("dist").agg(F.count(F.lit(1)).alias("n")))


def names_at_distance(dist: DataFrame, d: int = 6) -> DataFrame:
    return dist.filter(F.col("dist") == d).select("id").orderBy("id")


def separation_report(bip: DataFrame, seed=SEED_NAME, max_dist: int = 6, records: DataFrame | None = None) -> DataFrame:
    """(ord, label, value): totals, the histogram, then the names at ``max_dist``.

    Names share the last ord; order the report by (ord, value). ``records`` are the input blocks, which the
    first line counts; a performer can have several. Without them it counts the distinct performers.
    """
    dist = cut_lineage(separation(bip, seed, max_dist))
    counted = total_records(records if records is not None else dist)
    line = lambda df, ord_, label: df.select(
        F.lit(ord_).alias("ord"), F.lit(label).alias("label"), F.col("n").cast("string").alias("value"))
    steps = dist.sparkSession.range(1, max_dist + 1).select(F.col("id").cast("int").alias("dist"))
    histogram = steps.join(distance_histogram(dist, max_dist), "dist", "left").select(
        (F.col("dist") + 2).alias("ord"), F.concat(F.lit(LABEL_AT), F.col("dist").cast("string")).alias("label"),
        F.coalesce("n", F.lit(0)).cast("string").alias("value"))
    heading = dist.sparkSession.range(1).select(
        F.lit(max_dist + 3).alias("ord"), F.lit(f"{LABEL_NAMES}{max_dist}").alias("label"), F.lit("").alias("value"))
    names = dist.filter(F.col("dist") == max_dist).select(
        F.lit(max_dist + 4).alias("ord"), F.lit("").alias("label"), F.col("id").cast("string").alias("value"))
    return union_all(line(counted, 1, LABEL_ACTORS), line(distinct_titles(bip), 2, LABEL_TITLES),
                     histogram, heading, names)
