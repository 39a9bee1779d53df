"""Token counts: batch encoding in Arrow functions that return lengths only.

The pieces of many rows are put into batches of about ``BATCH`` bytes, so that a call costs the same however long
or short its texts are, and an encoding is dropped as soon as its length is known. A text longer than ``PIECE``
characters is cut at safe boundaries, so that no call holds the encoding of a whole long text.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from readloom.llm.bpe import read_vocabulary
from readloom.llm.common import text_of

VOCABULARY = "word_bpe_49k.json"
PIECE = 1 << 15     # characters of a piece, up to the next safe boundary
BATCH = 1 << 16     # bytes of text in one call
LIMIT = 2048

# Before ASCII white space, or behind an ASCII digit.
_SAFE = re.compile(r"(?=[ \t-\r])|(?<=[0-9])")
_NORMALIZERS = {"NFC", "Lowercase"}


def _parts(spec: dict | None, kind: str, members: str) -> list[dict]:
    return [] if spec is None else spec[members] if spec["type"] == kind else [spec]


def cuts_are_safe(content: bytes) -> bool:
    """Whether a vocabulary file gives a text the tokens of its pieces when it is cut at ``_SAFE``.

    White space must be dropped and every digit be a word of its own; the normaliser may only compose characters,
    lower them and fold white space, none of which looks across such a boundary; added tokens must hold neither
    white space nor digits and take none along.
    """
    spec = json.loads(content)
    first, *rest = _parts(spec["pre_tokenizer"], "Sequence", "pretokenizers") or [{"type": None}]
    words = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
    pattern = first["pattern"].get("Regex", "") if words else ""
    alternatives = pattern.split("|")
    words = words and "[\\p{N}]" in alternatives and not any(
        "\\s" in a.replace("[^\\s", "") or " " in a or re.search(r"\\d|[0-9]", a) for a in alternatives)
    words = words and all("\\p{N}" not in a or a == "[\\p{N}]" or a.startswith("[^\\s\\p{L}\\p{N}]") for a in alternatives)
    words = words and all(p["type"] == "ByteLevel" and not p["use_regex"] and not p["add_prefix_space"] for p in rest)
    for step in _parts(spec["normalizer"], "Sequence", "normalizers"):
        folds = step["type"] == "Replace" and step["pattern"].get("Regex") == "\\s+" and step["content"] == " "
        words = words and (folds or step["type"] in _NORMALIZERS)
    return bool(words) and not any(
        t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"[\s0-9]", t["content"])
        for t in spec["added_tokens"])


class Counter:
    """Counts the tokens of texts, without adding any, cutting or padding; special strings as the library does by default."""

    def __init__(self, content: bytes, piece: int = PIECE, batch: int = BATCH):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_buffer(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.piece, self.batch, self.safe = piece, batch, cuts_are_safe(content)

    def pieces(self, text: str) -> list[str]:
        if len(text) <= self.piece or not self.safe:
            return [text]
        out, start = [], 0
        while len(text) - start > self.piece:
            found = _SAFE.search(text, start + self.piece)
            if found is None:
                break
            out.append(text[start:found.start()])
            start = found.start()
        return [*out, text[start:]]

    def counts(self, texts: list[str], sizes: np.ndarray) -> np.ndarray:
        """Tokens of each text; ``sizes`` are the texts' lengths in bytes."""
        cut = [self.pieces(text) for text in texts]
        n = [len(x) for x in cut]
        owner = np.repeat(np.arange(len(texts)), n)
        weight = np.repeat(sizes / np.maximum(n, 1), n)
        flat = [piece for own in cut for piece in own]
        ends = np.flatnonzero(np.diff(np.cumsum(weight) // self.batch)) + 1
        lengths = np.zeros(len(flat), np.int64)
        for a, b in zip([0, *ends], [*ends, len(flat)]):
            lengths[a:b] = [len(x) for x in self.tokenizer.encode_batch_fast(flat[a:b], add_special_tokens=False)]
        out = np.zeros(len(texts), np.int64)
        np.add.at(out, owner, lengths)
        return out


@lru_cache(maxsize=2)
def _counter(content: bytes) -> Counter:
    return Counter(content)


def count_tokens(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) per row.

    ``path`` names a ``.json`` file of the tokenizers library. A null text is empty, and an empty text has no token. Null and
    repeated ids pass through as they are, other columns are not read, and no rows give no rows. A very long text
    is cut as the module says; one without a safe boundary, or with a file that has none, is encoded whole.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    if not str(path).endswith(".json"):
        raise ValueError("path must be a .json file of the tokenizers library")
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches):
        counter = _counter(vocabulary.value)
        for batch in batches:
            n = counter.counts(batch.column(1).to_pylist(), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"),
                       F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
