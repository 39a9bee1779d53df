"""Periodic runs: stretches of words that repeat with a period, and texts without the repeats.

The words between which a run can lie get two suffix trees by Ukkonen's algorithm, one of the words and one of their
reversal. An Euler tour of a tree leaves the shallowest node between neighbouring leaves; with minima over powers of two the lowest
common ancestor of any two leaves, and so the longest common extension of any two positions, takes constant time.
Every run holds a Lyndon root that is the longest Lyndon word at its position in one of two opposite orders of
words. There are two such words at each position; each is extended in both directions and kept if it meets itself.

Before the trees are built, words that no run can hold are set aside: a run of at least ``least`` words repeats each
of its grams of ``least / 2`` words at a distance of one period, which is half the run at most. Grams are compared by hash;
equal hashes of different grams only let more words through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import text_of

LEAST = 12           # words of the shortest run
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_MULTIPLIER = 0x9E3779B97F4A7C15


class SuffixTree:
    """Ukkonen's tree of a list of numbers above 0; leaf k is the suffix from k on, inner nodes follow the leaves.

    A node is known by its depth and by one suffix below it, which together spell its path, so edges need no labels.
    """

    def __init__(self, word: list[int]):
        text = [*word, 0]
        n = self.n = len(text)
        width = self.width = max(text) + 1
        self.depth, self.some, link = [0], [0], [0]  # of inner nodes; the root is node n
        edges = self.edges = {}
        depth, some = self.depth, self.some
        node, at, length, leaf, end = 0, 0, 0, 0, 0  # active point, next leaf
        for i, c in enumerate(text):
            waiting = -1
            end += 1
            while leaf < end:
                if length == 0:
                    at = i
                key = node * width + text[at]
                below = edges.get(key)
                if below is None:
                    edges[key] = leaf
                    if waiting >= 0:
                        link[waiting] = node
                        waiting = -1
                else:
                    here = depth[node]
                    if below >= n:
                        inner = below - n
                        step = depth[inner] - here
                        if length >= step:
                            at, length, node = at + step, length - step, inner
                            continue
                        example = some[inner]
                    else:
                        example = below
                    there = example + here + length
                    if text[there] == c:
                        length += 1
                        if waiting >= 0:
                            link[waiting] = node
                        break
                    new = len(depth)
                    depth.append(here + length)
                    some.append(example)
                    link.append(0)
                    edges[key] = n + new
                    edges[new * width + text[there]] = below
                    edges[new * width + c] = leaf
                    if waiting >= 0:
                        link[waiting] = new
                    waiting = new
                leaf += 1
                if node == 0 and length:
                    length -= 1
                    at = leaf
                elif node:
                    node = link[node]

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in the order of the words, and the depth of the shallowest node passed before each."""
        keys = np.fromiter(self.edges.keys(), np.int64, len(self.edges))
        order = np.argsort(keys)
        below = np.fromiter(self.edges.values(), np.int64, len(self.edges))[order].tolist()
        cuts = np.searchsorted(keys[order], np.arange(len(self.depth) + 1) * self.width).tolist()
        n, depth, leaves, shallow, stack = self.n, self.depth, [], [], [(self.n, 0)]
        while stack:
            node, least = stack.pop()
            if node < n:
                leaves.append(node)
                shallow.append(least)
                continue
            inner = node - n
            a, b, own = cuts[inner], cuts[inner + 1], depth[inner]
            for k in range(b - 1, a, -1):
                stack.append((below[k], own))
            stack.append((below[a], least))
        return np.array(leaves), np.array(shallow, np.int32)


class Extension:
    """Longest common extensions of positions to the right, in constant time each, from the tour of a suffix tree."""

    def __init__(self, word: list[int]):
        leaves, shallow = SuffixTree(word).tour()
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.minima = [shallow]
        while 2 << (len(self.minima) - 1) <= len(shallow):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and from ``b`` on are alike; a and b differ."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        power = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(power):
            own = power == k
            table = self.minima[k]
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << int(k)) + 1])
        return out


def _next_lower(rank: list[int]) -> list[int]:
    """For each position the next one of lower rank, or the end."""
    out, stack = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(word: list[int], least: int = LEAST) -> np.ndarray:
    """All runs (start, length, period) of a list of numbers above 0, by start, then period."""
    n = len(word)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    ahead, back = Extension(word), Extension(word[::-1])
    rank = ahead.rank[:n]
    roots = []
    for order in (rank, -rank):  # the terminal is the lowest word in one order and the highest in the other
        after = np.array(_next_lower(order.tolist()))
        i = np.flatnonzero(after < n)
        roots.append(np.stack([i, after[i] - i], 1))
    i, q = np.concatenate(roots).T
    right = ahead.common(i, i + q)
    left = np.zeros(len(i), np.int64)
    inner = i > 0
    left[inner] = back.common(n - i[inner], n - i[inner] - q[inner])
    found = np.stack([i - left, left + q + right, q], 1)
    found = found[found[:, 1] >= np.maximum(2 * q, least)]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _stretches(hashes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of words that hold every run; a run that ends with its stretch ends there in the text too.

    The word next to a stretch is in no gram that recurs near enough, so it cannot extend a run.
    """
    gram = least - least // 2
    with np.errstate(over="ignore"):
        code = np.zeros(max(len(hashes) - gram + 1, 0), np.uint64)
        for k in range(gram):
            code = code * np.uint64(_MULTIPLIER) + hashes[k:len(hashes) - gram + 1 + k]
    out, todo = [], [(0, len(hashes))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        own = code[a:b - gram + 1]
        order = np.argsort(own, kind="stable")
        alike = own[order[1:]] == own[order[:-1]]
        first, second = order[:-1][alike], order[1:][alike]
        near = second - first <= (b - a) // 2
        covered = np.zeros(b - a + 1, np.int32)
        starts = np.concatenate([first[near], second[near]])
        if not len(starts):
            continue
        marked = np.zeros(len(own), bool)
        marked[starts] = True
        starts = np.flatnonzero(marked)
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + gram, -1)
        inside = np.cumsum(covered[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        found = [(a + int(x), a + int(y)) for x, y in edges.reshape(-1, 2) if y - x >= least]
        if found == [(a, b)]:
            out += found
        else:
            todo += found
    return sorted(out)


def find_runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """All runs (start, length, period) of a list of words, by start, then period."""
    if len(words) < least:
        return np.zeros((0, 3), np.int64)
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    found = []
    for a, b in _stretches(hashes, least):
        number: dict[bytes, int] = {}
        runs = runs_of([number.setdefault(w, len(number) + 1) for w in words[a:b]], least)
        found.append(runs + np.array([a, 0, 0]))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """``words`` without those that any run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period in words, by start, then period) and collapsed, the text without repeats.

    Words are separated by ASCII white space; a run has at least ``least`` words (2 or more) and twice its period. The collapsed text joins
    the words that are left by one space. A null or empty text has no words, no runs and an empty collapsed text; null and
    repeated ids pass through; other columns are not read; no rows give no rows. A whole text is held by its task.
    """
    if least < 2:
        raise ValueError("a run has two words or more")

    def run(batches):
        for batch in batches:
            runs, texts = [], []
            for text in batch.column(1):
                words = text.as_buffer().to_pybytes().split() if len(text.as_buffer()) else []
                own = find_runs(words, least)
                runs.append(own)
                texts.append(b" ".join(without_repeats(words, own)))
            ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
            flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            columns = pa.StructArray.from_arrays([pa.array(flat[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, columns), pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs array<{RUN}>, collapsed string")
