"""Near duplicates by SimHash, linked through the anchors of a covering code.

Two blocks of 23 fingerprint bits are read as words of the binary Golay code, which is perfect: each word has one
codeword within 3 bits. The pair of codewords nearest to a fingerprint is its home anchor. A fingerprint within t
bits of it lies within 3 + t bits of that anchor, so every fingerprint is copied to all anchors that near, and
fingerprints are compared where a home and a copy meet. All 64 bits are compared. Copies to anchors that are nobody's
home are left out early by a bitmap of fixed size. Equal fingerprints are one node throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import sieve, sieved, text_of, tidy, without_rows
from readloom.llm.components import components
from readloom.operators.skew import sliced_join
from readloom.session import cut_lineage

SHINGLE = 3
MAX_BITS = 2
HASH_SEED = 42
HOT_COPIES = 1 << 17   # documents of one fingerprint after which the look-up of its group is split

_LENGTH, _PARITY, _RADIUS = 23, 11, 3  # the Golay code
_GENERATOR = 0xC75                     # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SLICE = 1 << 16                       # hashes whose bits are counted at once


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; 0 for a text without words."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = ends[min(size, len(words)) - 1:].tolist()
    first = [0, *(ends[:len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], HASH_SEED) for a, b in zip(first, last)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at:at + _SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and print (the 64 bits as a long) per row; a null text is empty, ids pass through as they are."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), size) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "print"])

    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, print long")


def _syndrome(words: np.ndarray) -> np.ndarray:
    for bit in range(_LENGTH - 1, _PARITY - 1, -1):
        words = np.where((words >> bit) & 1, words ^ (_GENERATOR << (bit - _PARITY)), words)
    return words


def _error_table(reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Per syndrome, the error patterns of up to ``reach`` bits and their weights (99 where there is none)."""
    patterns = [np.zeros(1, np.int64)]
    for _ in range(reach):
        grown = (patterns[-1][:, None] | (1 << np.arange(_LENGTH)))
        patterns.append(np.unique(grown[grown != patterns[-1][:, None]]))
    weights = np.repeat(np.arange(reach + 1), [len(p) for p in patterns])
    patterns = np.concatenate(patterns)
    syndromes = _syndrome(patterns)
    order = np.lexsort((weights, syndromes))
    syndromes, weights, patterns = syndromes[order], weights[order], patterns[order]
    starts = np.searchsorted(syndromes, np.arange(1 << _PARITY))
    column = np.arange(len(order)) - starts[syndromes]
    table = np.zeros((1 << _PARITY, column.max() + 1), np.int64)
    weight = np.full(table.shape, 99, np.int64)
    table[syndromes, column], weight[syndromes, column] = patterns, weights
    return table, weight


class Anchors:
    """Anchors of fingerprints: pairs of codewords, given as 24 bits."""

    def __init__(self, max_bits: int):
        self.max_bits = max_bits
        self.table, self.weight = _error_table(_RADIUS + max_bits)

    def _near(self, prints: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        words = (prints >> np.uint64(shift)).astype(np.int64) & ((1 << _LENGTH) - 1)
        syndromes = _syndrome(words)
        return (words[:, None] ^ self.table[syndromes]) >> _PARITY, np.maximum(self.weight[syndromes] - _RADIUS, 0)

    def home(self, prints: np.ndarray) -> np.ndarray:
        (first, _), (second, _) = self._near(prints, 0), self._near(prints, _LENGTH)
        return (first[:, 0] << 12) | second[:, 0]  # the pattern of least weight comes first

    def reach(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, anchor) of all anchors within the radius plus the bits allowed, which both blocks share."""
        (first, over), (second, beyond) = self._near(prints, 0), self._near(prints, _LENGTH)
        index, anchor = [], []
        for a in range(self.max_bits + 1):
            left = over == a
            right = beyond <= self.max_bits - a
            for i in np.flatnonzero(left.any(axis=0)):
                row, j = np.nonzero(right & left[:, [i]])
                index.append(row)
                anchor.append((first[row, i] << 12) | second[row, j])
        return np.concatenate(index), np.concatenate(anchor)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs x < y of the distinct longs ``print`` that differ in at most ``max_bits`` bits (0 to 4)."""
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")

    def home(batches):
        anchors = Anchors(max_bits)
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(anchors.home(own)), batch.column(0)], ["anchor", "x"])

    def reach(batches):
        anchors = Anchors(max_bits)
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 11):
                own = batch.column(0).slice(start, 1 << 11).to_numpy()
                index, anchor = anchors.reach(own.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(own[index])], ["anchor", "y"])

    homes = cut_lineage(prints.select("print").mapInArrow(tidy(home), "anchor long, x long"))
    copies = prints.select("print").mapInArrow(tidy(reach), "anchor long, y long")
    copies = sieved(copies, sieve(homes, "anchor"), "anchor").filter("__hit").drop("__hit")
    near = (F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits)
    meet = homes.alias("h").join(copies.alias("c"), (F.col("h.anchor") == F.col("c.anchor")) & near)
    return meet.select("x", "y").distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, kept.

    component_id is the smallest doc_id reachable over links, the own included; kept marks the row that has it.
    Null and empty texts and texts of blanks have fingerprint zero. Equal texts, ties and repeated rows share
    a fingerprint and so a component. A null id is never the smallest unless a component has no other; such
    rows are kept. No rows give no rows; other columns are not read.
    """
    prints = cut_lineage(fingerprints(docs, size, id_col, text_col))
    nodes = cut_lineage(prints.groupBy("print").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes, max_bits), "x", "y")
    rooted = nodes.join(roots, F.col("print") == F.col("node"), "left").withColumn("root", F.coalesce("root", "print"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = cut_lineage(sliced_join(rooted.select("root", "print"), least, ["root"], "inner", HOT_COPIES)
                         .select("print", "component_id"))
    out = sliced_join(prints, groups, ["print"], "inner", HOT_COPIES)
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with the document of smallest id of each component, all columns as they were; null ids come last.

    Of several texts with that id one stays.
    """
    return without_rows(docs, lambda rows: near_duplicates(rows, size, max_bits).filter(~F.col("kept")))
