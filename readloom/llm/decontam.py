"""Benchmark passages in documents, found with an FM-index per shard of the documents.

A shard is some MB of whole documents inside a task. Its words become numbers; only words of the benchmark have one,
any other word is a break that no window can span, and so are runs shorter than the shortest window. The runs are
sorted into a suffix array, whose Burrows-Wheeler transform is kept as a wavelet matrix with rank counts. All
windows are searched backward together; occurrences are located by walking to sampled suffix positions. Hit
spans are merged in the end. Nothing shuffles; the benchmark is sent out in blocks of checked size.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import text_of, tidy, without_rows
from readloom.operators.skew import union_all

WINDOW = 13
SHARD_BYTES = 8 << 20    # text of one index
BLOCK_BYTES = 32 << 20   # benchmark text that is searched for at once
SAMPLED = 16             # every so many-th position of a shard keeps its place in the text

_END, _BREAK, _FIRST = 0, 1, 2  # symbols: the end of the shard, a gap, the first word
# Fixed by the definition of a word: A-Z fold to a-z; other ASCII but letters and digits parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class WaveletMatrix:
    """Rank of any symbol in a sequence, by one bit vector with running counts per bit of the symbols."""

    def __init__(self, symbols: np.ndarray):
        self.zeros, self.ones = [], []
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        for level in reversed(range(self.bits)):
            bit = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``end``."""
        start = np.zeros_like(end)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k)) & 1
            start = np.where(bit == 1, zeros + ones[start], start - ones[start])
            end = np.where(bit == 1, zeros + ones[end], end - ones[end])
        return end - start


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence that ends in a symbol found nowhere else, by doubling the sorted prefix."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        later = np.zeros(n, np.int64)
        later[:max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(steps)])
        if steps.all():
            return order
        width *= 2


class FMIndex:
    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        self.last = symbols[order - 1]
        self.tree = WaveletMatrix(self.last)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols))])  # suffixes that start with a lower symbol
        self.sampled = np.where(order % SAMPLED == 0, order, -1)

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all windows; a row holds a window right-aligned after zeros."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), len(self.last), np.int64)
        for column in reversed(range(windows.shape[1])):
            at = np.flatnonzero((windows[:, column] > 0) & (low < high))
            symbol = windows[at, column]
            known = symbol < len(self.before) - 1
            high[at[~known]] = low[at[~known]]
            at, symbol = at[known], symbol[known]
            low[at], high[at] = (self.before[symbol] + self.tree.rank(symbol, x[at]) for x in (low, high))
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        out, at, steps = np.full(len(rows), -1, np.int64), rows.copy(), np.zeros(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            place = self.sampled[at[left]]
            found = place >= 0
            out[left[found]] = place[found] + steps[left[found]]
            left = left[~found]
            symbol = self.last[at[left]]
            at[left] = self.before[symbol] + self.tree.rank(symbol, at[left])
            steps[left] += 1
        return out


class Windows:
    """The distinct windows of some benchmark items, as numbers of their words."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.words: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.words.setdefault(w, _FIRST + len(self.words)) for w in words_of(text)]
            for i in range(max(len(ids) - size + 1, min(1, len(ids)))):
                owners.setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.owners = [sorted(x) for x in owners.values()]
        self.length = np.array([len(w) for w in owners], np.int64)
        self.table = np.zeros((len(owners), size), np.int64)
        for row, window in zip(self.table, owners):
            row[size - len(window):] = window
        self.shortest = int(self.length.min(initial=size))

    def hits(self, texts: list[str]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Per text: its words, merged spans of hit words, and the items with a window in it."""
        split = [words_of(x) for x in texts]
        counts = np.array([len(x) for x in split], np.int64)
        out: list = [(int(n), [], []) for n in counts]
        starts = np.cumsum(counts + 1) - counts - 1
        line = np.full(int(counts.sum()) + len(split), _BREAK, np.int64)
        get = self.words.get
        for words, start in zip(split, starts.tolist()):
            line[start:start + len(words)] = np.fromiter(map(get, words, repeat(_BREAK)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], line != _BREAK, [False]])))
        runs = edges.reshape(-1, 2)
        runs = runs[runs[:, 1] - runs[:, 0] >= self.shortest]
        if not len(runs) or not len(self.table):
            return out
        lengths = runs[:, 1] - runs[:, 0] + 1  # with the gap behind a run
        offsets = np.cumsum(lengths) - lengths
        places = np.arange(int(lengths.sum())) + np.repeat(runs[:, 0] - offsets, lengths)
        symbols = np.append(line, _BREAK)[places]
        index = FMIndex(np.append(symbols, _END))
        low, high = index.search(self.table)
        many = high - low
        window = np.repeat(np.arange(len(many)), many)
        rows = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many) + low[window]
        begin = places[index.locate(rows)]
        mark = np.zeros(len(line) + 1, np.int64)
        np.add.at(mark, begin, 1)
        np.add.at(mark, begin + self.length[window], -1)
        hit = np.cumsum(mark) > 0
        doc = np.searchsorted(starts, begin, side="right") - 1
        pairs = np.unique(np.stack([doc, window]), axis=1)
        found: dict[int, set[str]] = {}
        for d, w in pairs.T.tolist():
            found.setdefault(d, set()).update(self.owners[w])
        for d, items in found.items():
            own = np.concatenate([[False], hit[starts[d]:starts[d] + counts[d]], [False]])
            spans = np.flatnonzero(np.diff(own)).reshape(-1, 2)
            out[d] = (int(counts[d]), [tuple(x) for x in spans.tolist()], sorted(items))
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[DataFrame]:
    """Benchmark items in tables of about BLOCK_BYTES."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), text_of(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES) or 1
    return [items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).distinct() for k in range(count)]


def _search(docs: DataFrame, block: DataFrame, size: int) -> DataFrame:
    """The columns of ``docs`` but its last, the text, with the verdict of one block; blocks are read one at a time."""
    sent = docs.sparkSession.sparkContext.broadcast([(r.item, r.text) for r in block.collect()])
    keep = docs.columns[:-1]

    def run(batches):
        windows = Windows([(item or "", text) for item, text in sent.value], size)
        for batch in batches:
            sizes = pc.binary_length(batch.column(len(keep))).to_numpy()
            shard = np.cumsum(sizes) // SHARD_BYTES
            for own in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(shard)) + 1):
                rows = batch.slice(own[0], len(own)) if len(own) else batch
                found = windows.hits(rows.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    *rows.columns[:-1], pa.array([x[0] for x in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in x[1]] for x in found], _SPANS),
                    pa.array([x[2] for x in found], pa.list_(pa.string()))], [*keep, "n_words", "spans", "items"])

    kept = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.mapInArrow(tidy(run), f"{kept}, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>")


_COPIES = 1 << 16
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_hit, spans (hit runs of words, end exclusive), items (ids as sorted strings).

    A null or empty text has no words, an item without words no window. Items that repeat an id count once; a
    null item id is the empty string. Repeated documents are judged each. An empty benchmark hits nothing.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    blocks = _blocks(benchmark, item_col, item_text_col)
    if len(blocks) == 1:
        out = _search(rows, blocks[0], window)
    else:  # join the verdicts of each text; rows alike in id and text have the same, and there are as many as before
        keyed, key = rows.select("doc_id", F.sha2("text", 256).alias("sha"), "text"), ["doc_id", "sha"]
        parts = [_search(keyed, block, window).groupBy(*key).agg(
            F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n_words", "spans", "items")]) for block in blocks]
        out = (union_all(*parts).groupBy(*key).agg(
            F.max("copies").alias("copies"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .withColumn("spans", merged_spans(F.col("spans")))
            .withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(_COPIES))))  # arrays of bounded size
            .withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + _COPIES - 1, "copies"))))
            .select("doc_id", "n_words", "spans", "items"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.withColumn("n_hit", hit)


def merged_spans(spans):
    """Sorted, disjoint spans that cover the same words."""
    grow = lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:bigint,end:bigint>>"), grow)


def verdicts(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated: at least a twentieth of the words is hit."""
    return contamination(docs, benchmark, **names).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents, all columns as they were."""
    return without_rows(docs, lambda rows: verdicts(rows, benchmark).filter("contaminated"))
