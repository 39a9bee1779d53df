"""Merkle manifest of a table: a tree per group of rows, one tree over their roots, and a proof for every row.

Rows are dealt into parts of neighbouring leaves, at most three times 2^BITS. Every part is one multiproof in the manner of an
octopus: from its leaves upward it lists the nodes it can neither derive from its own leaves nor from nodes already
listed, which is the least set of coordinates to ask for. They are fetched in one join, the inner nodes which the
leaves of the part share are derived once, and the proof of each leaf is read off them without another look-up.

A node is the lowercase hex SHA-256 of the hex digests of its two children, or of the one child at the end of a level.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators.ordering import number_rows
from readloom.operators.skew import lookup_join, sliced_join
from readloom.session import cut_lineage

BITS = 10            # a large tree is cut into parts of 2^BITS leaves; a pass over its nodes climbs as many levels
TOP = -1             # the number of the tree of subroots
PROOF = "array<struct<left:boolean,digest:string>>"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ASKED = "part long, tree long, level int, idx long, digest string"


def digest_of(columns: list[Column]) -> Column:
    """The leaf of a row: of each value its UTF-8 byte count, a colon and the value; ``-`` for null."""
    shown = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in shown]), 256)


def _height(leaves: int) -> int:
    return max(int(leaves) - 1, 0).bit_length()


def _node(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _climb(nodes: dict[int, str], level: int, top: int, leaves: int, missing: list | None = None) -> list[dict[int, str]]:
    """The levels ``level`` to ``top`` of a tree above known nodes.

    A sibling that is neither known nor beyond the end is asked for: with ``missing`` its coordinate (level, index) is
    noted, else the parent is not derived.
    """
    out = [nodes]
    for at in range(level, top):
        last = (leaves - 1) >> at
        below, above = out[-1], {}
        for i in sorted({i >> 1 for i in below}):
            children = [c for c in (2 * i, 2 * i + 1) if c <= last]
            unknown = [c for c in children if c not in below]
            if missing is not None:
                missing += [(at, c) for c in unknown]
                above[i] = ""
            elif not unknown:
                above[i] = _node(*[below[c] for c in children])
        out.append(above)
    return out


def _by_tree(table: pa.Table) -> list[tuple[int, np.ndarray]]:
    tree = table.column("tree").to_numpy()
    order = np.argsort(tree, kind="stable")
    cuts = np.flatnonzero(np.diff(tree[order])) + 1
    return [(int(tree[own[0]]), own) for own in np.split(order, cuts) if len(own)]


def _first_pass(trees: int, bits: int):
    """Per part: its nodes at the floor (subroots of small trees among them) and the coordinates it misses."""
    def run(table: pa.Table) -> pa.Table:
        part, rows = table.column("part")[0].as_py(), []
        pos, n, leaf = table.column("pos").to_numpy(), table.column("n").to_numpy(), table.column("leaf")
        roots = {}
        for tree, own in _by_tree(table):
            leaves = int(n[own[0]])
            known = {int(pos[k]): leaf[int(k)].as_py() for k in own}
            at = min(_height(leaves), bits)  # a part holds a small tree up to its root, a large one up to one node
            floor = _climb(known, 0, at, leaves)[-1]
            rows += [(part, tree, at, i, d) for i, d in floor.items()]
            missing = []
            _climb(dict.fromkeys(floor, ""), at, _height(leaves), leaves, missing)
            rows += [(part, tree, level, i, None) for level, i in missing]
            roots[tree] = ""
        missing = []
        _climb(roots, 0, _height(trees), trees, missing)
        rows += [(part, TOP, level, i, None) for level, i in missing]
        return _table(rows)
    return run


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [("part", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string())]
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(kinds, columns)})


def _rise(level: int, bits: int):
    """The nodes of up to ``bits`` levels above ``level``, within one run of 2^bits nodes of one tree."""
    def run(table: pa.Table) -> pa.Table:
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        known = dict(zip(table.column("idx").to_pylist(), table.column("digest").to_pylist()))
        levels = _climb(known, level, min(level + bits, _height(n)), n)
        return _table([(None, tree, level + up, i, d) for up, found in enumerate(levels) if up for i, d in found.items()])
    return run


def _upper_nodes(base: DataFrame, level: int, most: int, bits: int) -> DataFrame:
    """``base`` (tree, level, idx, digest, n), all of one level, with all nodes above it. ``most``: leaves of the largest tree."""
    out, here = base.drop("n"), base
    while _height(most) > level:
        run = F.shiftright("idx", bits).alias("_run")
        risen = here.filter(F.col("n") > F.lit(1 << level)).groupBy("tree", run).applyInArrow(_rise(level, bits), _ASKED).drop("part")
        sizes = here.select("tree", "n").distinct()
        risen = cut_lineage(risen)
        out = out.unionByName(risen)
        level += bits
        here = risen.filter(F.col("level") == level).join(sizes, "tree")
    return out


def _expand(trees: int, columns: list[str]):
    """Per part: derives the shared inner nodes from leaves and fetched nodes, and reads every proof off them."""
    def run(rows: pa.Table, fetched: pa.Table) -> pa.Table:
        pos, n = rows.column("pos").to_numpy(), rows.column("n").to_numpy()
        leaf = rows.column("leaf").to_pylist()
        given: dict[int, dict[int, dict[int, str]]] = {}
        for tree, level, i, d in zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "idx", "digest"))):
            given.setdefault(tree, {}).setdefault(level, {})[i] = d

        def grown(tree, known, leaves):
            levels = [{**known, **given.get(tree, {}).get(0, {})}]
            for at in range(_height(leaves)):
                above = _climb(levels[-1], at, at + 1, leaves)[-1]
                levels.append({**above, **given.get(tree, {}).get(at + 1, {})})
            return levels

        inner, roots = {}, {}
        for tree, own in _by_tree(rows):
            inner[tree] = grown(tree, {int(pos[k]): leaf[k] for k in own}, int(n[own[0]]))
            roots[tree] = inner[tree][-1][0]
        top = grown(TOP, roots, trees)
        left, digest, ends = [], [], [0]
        subroot, tails = [None] * len(leaf), {}

        def path(levels, i, leaves):
            for at, known in enumerate(levels[:-1]):
                beside = i ^ 1
                if beside <= (leaves - 1) >> at:
                    yield bool(i & 1), known[beside]
                else:
                    yield None, None
                i >>= 1

        for tree in roots:
            tails[tree] = list(path(top, tree, trees))
        for k, tree in enumerate(rows.column("tree").to_pylist()):
            steps = [*path(inner[tree], int(pos[k]), int(n[k])), *tails[tree]]
            left += [s[0] for s in steps]
            digest += [s[1] for s in steps]
            ends.append(len(left))
            subroot[k] = roots[tree]
        proof = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(left, pa.bool_()), pa.array(digest, pa.string())], ["left", "digest"]))
        out = {c: rows.column(c) for c in columns}
        return pa.table({**out, "subroot": pa.array(subroot, pa.string()),
                         "root": pa.array([top[-1][0]] * len(leaf), pa.string()), "proof": proof})
    return run


def prove(rows: DataFrame, tree_col: str = "lang", id_col: str = "doc_id", leaf_col: str = "leaf", bits: int = BITS) -> DataFrame:
    """``rows`` with subroot, root and proof, an array of (left, digest) from the leaf to the root.

    A tree holds the rows of one value of ``tree_col`` by ``id_col``, nulls first, then by leaf; rows alike in all of these
    are interchangeable. The subroots by that value, null first, make the last tree; a tree of one leaf is that leaf.
    A step with a null digest has no sibling. ``leaf_col`` must not be null; ``rows`` should be narrow, as they are
    sorted; its columns keep their names, but for subroot, root and proof, which are replaced. No rows give no rows.
    """
    carried = [c for c in rows.columns if c not in ("subroot", "root", "proof")]
    safe = {c: f"c{i}" for i, c in enumerate(carried)}  # clashing names are of no concern in between
    named = rows.select(*[F.col(f"`{c}`").alias(safe[c]) for c in carried])
    kinds = [f"{safe[c]} {named.schema[safe[c]].dataType.simpleString()}" for c in carried]
    tree, ident, leaf = safe[tree_col], safe[id_col], safe[leaf_col]
    numbered = number_rows(named, [tree, ident, leaf], "_row").drop("_total")
    groups = numbered.groupBy(tree).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("n"))
    groups = cut_lineage(number_rows(groups, [tree], "tree"))
    most = groups.agg(F.max("n"), F.max("_total")).first()
    if most[0] is None:
        return named.select(*[F.col(safe[c]).alias(c) for c in carried], F.lit("").alias("subroot"), F.lit("").alias("root"),
                            F.array().cast(PROOF).alias("proof"))
    largest, trees = most
    first = groups.select(F.xxhash64(tree, F.col(tree).isNull()).alias("_k"), F.col(tree).alias("_tree"), "_first", "n", "tree")
    keyed = numbered.withColumn("_k", F.xxhash64(tree, F.col(tree).isNull()))
    placed = lookup_join(keyed, first, ["_k"]).filter(F.col(tree).eqNullSafe(F.col("_tree"))).drop("_k", "_tree")
    pos, span = F.col("_row") - F.col("_first"), 1 << bits
    # a large tree is cut every ``span`` leaves, small trees are whole: a part has at most three times as many
    part = F.when(F.col("n") > span, F.col("_first") + F.shiftleft(F.shiftright(pos, bits), bits)).otherwise(
        F.shiftleft(F.shiftright("_first", bits), bits))
    leaves = placed.select(*safe.values(), "tree", "n", pos.alias("pos"), part.alias("part"))
    plain = leaves.select("part", "tree", "n", "pos", F.col(leaf).alias("leaf"))
    first_pass = cut_lineage(plain.groupBy("part").applyInArrow(_first_pass(trees, bits), _ASKED))
    sizes = groups.select("tree", "n")
    floor = first_pass.filter(F.col("digest").isNotNull()).drop("part")
    large = floor.filter(F.col("level") == bits).join(sizes.filter(F.col("n") > span), "tree")
    nodes = _upper_nodes(large, bits, largest, bits)
    small = floor.join(sizes.filter(F.col("n") <= span).select("tree"), "tree")
    height = F.length(F.bin(F.col("n") - 1))
    roots = nodes.join(sizes, "tree").filter(F.col("level") == height).select("tree", "digest")
    roots = roots.unionByName(small.select("tree", "digest"))
    top = roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "digest",
                       F.lit(trees).cast("long").alias("n"))
    nodes = nodes.unionByName(_upper_nodes(top, 0, trees, bits))
    asked = first_pass.filter(F.col("digest").isNull()).drop("digest")
    # nodes near the root are asked for by every part
    fetched = sliced_join(asked, nodes, ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "digest")
    wide = leaves.withColumn("leaf", F.col(leaf))
    schema = ", ".join([*kinds, "subroot string", "root string", f"proof {PROOF}"])
    done = wide.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(
        _expand(trees, list(safe.values())), schema)
    return done.select(*[F.col(safe[c]).alias(c) for c in carried], "subroot", "root", "proof")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    def step(known, s):
        return F.sha2(F.when(s["digest"].isNull(), known).when(s["left"], F.concat(s["digest"], known))
                      .otherwise(F.concat(known, s["digest"])), 256)
    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """SHA-256 of the siblings from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: s["digest"]), ""), 256)


def manifest(docs: DataFrame, claimed: dict[str, Column] | None = None, columns: tuple[str, ...] = COLUMNS,
             tree_col: str = "lang", id_col: str = "doc_id", bits: int = BITS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, and ``claimed_leaf``, the leaf of the row with the values ``claimed`` instead.

    Null values enter a leaf as ``-``; null ids and trees sort first; repeated rows are leaves each; an empty text is a value of
    no bytes; texts of any length only meet the digest; other columns are not read; no rows give no rows.
    """
    claimed = claimed or {}
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.col(tree_col).alias("tree"), digest_of([F.col(c) for c in columns]).alias("leaf"),
        digest_of([claimed.get(c, F.col(c)) for c in columns]).alias("claimed_leaf"))
    return prove(own, "tree", "doc_id", "leaf", bits).drop("tree")
