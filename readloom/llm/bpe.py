"""Byte-level BPE with the ranks of a public vocabulary file.

Texts are cut by the vocabulary's pattern, and merges stay inside a piece. The next merge comes from a rank queue:
a bucket per rank holds the positions where that merge applies, and a hierarchical bitmap over the ranks finds
the lowest bucket in use by three find-first-set steps. Positions are starts of a linked list of parts. An
entry that a merge beside it has overtaken is stale and skipped when met. One queue serves all new pieces of
some MB of text, long or short. Work stays inside the partition of a row: nothing shuffles.
"""

from __future__ import annotations

import base64
import gc
import re
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import tidy

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MAX_VOCABULARY = 64 << 20  # bytes of a vocabulary file that is sent to the executors
KEPT_PIECES = 3 << 16      # pieces after which a worker sets those it knows aside; what it meets again it takes back
STEP_BYTES = 4 << 20       # text whose new pieces are merged together
KEPT_LENGTH = 64           # longer pieces are merged each time
RANK_SLICE = 1 << 16       # pairs of parts looked up at once

_WIDE = re.compile(r"\s | \s")               # a blank beside other white space
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


class RankQueue:
    """Positions by rank: a bucket for each rank, and a bitmap of the buckets in use, 64 of a level to a bit above."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels = []
        while not self.levels or ranks > 1:
            ranks = (ranks + 63) >> 6
            self.levels.append([0] * ranks)

    def _mark(self, rank: int) -> None:
        for level in self.levels:
            level[rank >> 6] |= 1 << (rank & 63)
            rank >>= 6

    def _clear(self, rank: int) -> None:
        for level in self.levels:
            level[rank >> 6] &= ~(1 << (rank & 63))
            rank >>= 6
            if level[rank]:
                return

    def _lowest(self) -> int:
        at = 0
        for level in reversed(self.levels):
            word = level[at]
            if not word:
                return -1
            at = (at << 6) | ((word & -word).bit_length() - 1)
        return at

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self._mark(rank)
        else:
            heappush(bucket, position)

    def fill(self, rank: int, positions: np.ndarray) -> None:
        """A bucket not yet in use gets an array of positions for ``take``."""
        self.buckets[rank] = [positions]
        self._mark(rank)

    def add(self, ranks: list[int], positions: list[int]) -> None:
        """Positions for ``take``, which wants no order."""
        buckets = self.buckets
        for rank, position in zip(ranks, positions):
            if rank in buckets:
                buckets[rank].append(position)
            else:
                buckets[rank] = [position]
                self._mark(rank)

    def pop(self) -> tuple[int, int] | None:
        """The lowest rank and, of its positions, the leftmost."""
        rank = self._lowest()
        if rank < 0:
            return None
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self._clear(rank)
        return rank, position

    def take(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and all its positions, in no order."""
        rank = self._lowest()
        if rank < 0:
            return None
        self._clear(rank)
        bucket = self.buckets.pop(rank)
        if isinstance(bucket[0], np.ndarray):
            first, rest = bucket[0], bucket[1:]
            return rank, np.concatenate([first, np.array(rest, np.int32)]) if rest else first
        return rank, np.array(bucket, np.int32)


class Encoder:
    """Ids of texts. ``vocabulary`` is the content of a rank file; every single byte must be in it.

    ``kept`` bounds the pieces remembered and so the memory of a worker; ids do not depend on it.
    """

    def __init__(self, vocabulary: bytes, pattern: str, kept: int = KEPT_PIECES):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        self.size = max(self.ranks.values(), default=-1) + 1
        self.cut = regex.compile(pattern).findall
        self.kept = kept
        self.by_blanks = pattern == public_tokenizers.PATTERN  # another pattern may have pieces with inner blanks
        self.known: dict[str, bytes] = {}
        self.aside: dict[str, bytes] = {}
        self.token = {rank: part for part, rank in self.ranks.items()}
        pairs = {}
        for part, rank in self.ranks.items():
            for i in range(1, len(part)):
                left, right = self.ranks.get(part[:i]), self.ranks.get(part[i:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        keys = sorted(pairs)
        self.pairs = pairs
        self.keys = np.array(keys + [1 << 62], np.int64)
        self.joined = np.array([pairs[k] for k in keys] + [-1], np.int64)
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64) if self.ranks else None

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """One piece, one merge at a time."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n, size, pairs, queue = len(piece), self.size, self.pairs, RankQueue(self.size)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        part = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        pending = [-1] * n  # rank of joining the part at i with the next one; -1: none

        def look(i: int) -> None:
            j = after[i]
            rank = pending[i] = pairs.get(part[i] * size + part[j], -1) if j < n else -1
            if rank >= 0:
                queue.push(rank, i)

        for i in range(n):
            look(i)
        while (got := queue.pop()) is not None:
            rank, i = got
            if pending[i] != rank:
                continue  # stale
            j = after[i]
            after[i], part[i], pending[j] = after[j], rank, -1
            before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        out, i = [], 0
        while i < n:
            out.append(part[i])
            i = after[i]
        return tuple(out)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of joining parts; a negative part joins with nothing. Long arrays are looked up in slices."""
        out = np.empty(len(left), np.int32)
        for a in range(0, len(left), RANK_SLICE):
            first, second = left[a:a + RANK_SLICE], right[a:a + RANK_SLICE]
            key = np.where((first < 0) | (second < 0), -1, first.astype(np.int64) * self.size + second)
            at = np.searchsorted(self.keys, key)
            out[a:a + RANK_SLICE] = np.where(self.keys[at] == key, self.joined[at], -1)
        return out

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Many pieces in one queue: they lie one after another in one linked list, parted by a gap.

        All positions of the lowest rank are merged together, from the left where they overlap. That equals one
        merge at a time as long as no merge makes a pair of lower rank; pieces where one does are
        merged again on their own.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(lengths + 1) - lengths - 1
        n = int(lengths.sum()) + len(pieces)
        part = np.full(n + 1, -1, np.int32)
        inside = np.ones(n, bool)
        inside[starts + lengths] = False
        part[:n][inside] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        pending = np.full(n + 1, -1, np.int32)
        pending[:n] = self._rank(part[:-1], part[1:])
        odd = []
        queue = RankQueue(self.size)
        order = np.flatnonzero(pending[:n] >= 0).astype(np.int32)
        order = order[np.argsort(pending[order], kind="stable")]
        for own in np.split(order, np.flatnonzero(np.diff(pending[order])) + 1) if len(order) else []:
            queue.fill(int(pending[own[0]]), own)
        while (got := queue.take()) is not None:
            rank, at = got
            at = at[pending[at] == rank]  # the rest is stale
            if len(at) > 1:
                at.sort()
                at = at[np.append(True, at[1:] != at[:-1])]
                joined = np.flatnonzero(np.append(True, after[at[:-1]] != at[1:]))  # starts of overlapping runs
                run = np.repeat(joined, np.diff(np.append(joined, len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            far = after[gone]
            early = self._rank(np.full(len(at), rank), part[far])  # the right neighbour before it changes
            after[at], before[far], part[at] = far, at, rank
            pending[gone], part[gone] = -1, -1
            near = before[at]
            near = near[near >= 0]
            seen = np.concatenate([at, near])
            found = self._rank(part[seen], part[after[seen]])
            pending[seen] = found
            low = np.concatenate([at[(early >= 0) & (early < rank)], seen[(found >= 0) & (found < rank)]])
            if len(low):
                odd.append(low)
            new = found >= 0
            queue.add(found[new].tolist(), seen[new].tolist())
        alive = part[:n] >= 0
        counts = np.add.reduceat(alive, starts) if len(pieces) else []
        ids, ends = part[:n][alive].astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
        out = [ids[a:b] for a, b in zip([0, *ends], ends)]
        if odd:
            for k in np.unique(np.searchsorted(starts, np.concatenate(odd), side="right") - 1):
                out[k] = np.array(self.merge(pieces[k]), "<i4").tobytes()
        return out

    def chunks(self, text: str) -> list[str]:
        """Cuts before each blank that stands between two other characters, where no piece can reach across."""
        if not self.by_blanks:
            return [text]
        if "\0" in text or _WIDE.search(text):
            return [x if i == 0 else " " + x for i, x in enumerate(_BETWEEN.split(text))]
        return text.replace(" ", "\0 ").split("\0")

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32; pieces not seen before are merged together.

        A text is cut twice, so that the chunks of one text are held at a time and not those of all.
        """
        if len(self.known) > self.kept:
            self.known, self.aside = {}, self.known
        gc.disable()  # nothing here is cyclic, and walking the pieces kept takes long
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _unknown(self, lists) -> set[str]:
        """The pieces not known yet; those set aside are taken back."""
        missing = set(chain.from_iterable(lists)).difference(self.known)
        found = missing.intersection(self.aside)
        self.known.update(zip(found, map(self.aside.__getitem__, found)))
        return missing - found

    def _encode(self, texts: list[str]) -> list[bytes]:
        known, ids, ranks = self.known, {}, self.ranks
        pieces, whole = {}, []
        for chunk in self._unknown(set(self.chunks(text)).difference(known) for text in texts):
            parts = self.cut(chunk)
            if parts == [chunk]:
                whole.append(chunk)
            else:
                pieces[chunk] = parts
        new = []
        for piece in self._unknown(chain([whole], pieces.values())):
            data = piece.encode()
            rank = ranks.get(data)
            if rank is None:
                new.append((piece, data))
            else:
                known[piece] = rank.to_bytes(4, "little")
        for (piece, data), own in zip(new, self.merge_all([x[1] for x in new])):
            (known if len(data) <= KEPT_LENGTH else ids)[piece] = own
        for chunk, parts in pieces.items():
            own = b"".join([ids[x] if x in ids else known[x] for x in parts])
            (known if len(chunk) <= KEPT_LENGTH else ids)[chunk] = own
        if ids:
            return [b"".join([ids[x] if x in ids else known[x] for x in self.chunks(text)]) for text in texts]
        return [b"".join(map(known.__getitem__, self.chunks(text))) for text in texts]


@lru_cache(maxsize=2)
def _encoder(vocabulary: bytes, pattern: str, kept: int = KEPT_PIECES) -> Encoder:
    """One for all tasks of a worker, with the pieces it has seen."""
    return Encoder(vocabulary, pattern, kept)


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        content = file.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    return content


def _vocabulary(spark: SparkSession, path: str | None):
    """The file is read by the driver and broadcast after a check of its size; executors need no copy."""
    return spark.sparkContext.broadcast(read_vocabulary(path or public_tokenizers.path(VOCABULARY)))


def _encoded(encoder: Encoder, batches):
    """Some rows of (id, text) at a time, about STEP_BYTES of text, and their ids as an array of lists."""
    for batch in batches:
        step = np.cumsum(pc.binary_length(batch.column(1)).to_numpy()) // STEP_BYTES
        for own in np.split(np.arange(len(step)), np.flatnonzero(np.diff(step)) + 1):
            rows = batch.slice(own[0], len(own)) if len(own) else batch
            found = encoder.encode_all(rows.column(1).to_pylist())
            offsets = np.zeros(len(found) + 1, np.int64)
            np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
            yield rows, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))


def _decoded(encoder: Encoder, ids: pa.ListArray) -> pa.Array:
    offsets, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
    token = encoder.token.__getitem__
    return pa.array([b"".join(map(token, flat[a:b].tolist())) for a, b in zip(offsets, offsets[1:])], pa.binary())


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and ids (array of int) per row, in the order of the text.

    A null or empty text has no ids. Strings of special tokens are ordinary text. Null, repeated or tied
    doc_ids pass through as they are; other columns are not read; no rows give no rows.
    """
    vocabulary = _vocabulary(docs.sparkSession, path)

    def run(batches):
        for rows, ids in _encoded(_encoder(vocabulary.value, pattern), batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids and the decoded bytes per row. Null ids are read as none; an id that the vocabulary lacks is an error."""
    vocabulary = _vocabulary(encoded.sparkSession, path)

    def run(batches):
        for batch in batches:
            ids = batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, _decoded(_encoder(vocabulary.value, pattern), ids)],
                                             ["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).alias("doc_id"),
                          F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(
        tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
               pattern: str = public_tokenizers.PATTERN, kept: int = KEPT_PIECES) -> DataFrame:
    """Digests of ids and decoded bytes per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    As ``decode(encode(docs))``, in one pass through one worker a task. Nulls and repeats: see ``encode``. A worker
    sets the pieces it knows aside once they are more than ``kept``.
    """
    vocabulary = _vocabulary(docs.sparkSession, path)

    def run(batches):
        encoder = _encoder(vocabulary.value, pattern, kept)
        for rows, ids in _encoded(encoder, batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), ids, _decoded(encoder, ids)], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    done = rows.mapInArrow(tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
