"""Token counts, periodic runs and Merkle manifests against their libraries, brute force and a plain tree."""

import hashlib
import os
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))

from helpers import edge_docs, no_docs, plain, rows  # noqa: E402

from readloom.llm import merkle, queries, runs, token_counts  # noqa: E402

SF = "/root/testdata/sf0.001"
CONTENT = open(public_tokenizers.path("word_bpe_49k.json"), "rb").read()
WHOLE = Tokenizer.from_buffer(CONTENT)


def whole_count(text):
    return len(WHOLE.encode(text or "", add_special_tokens=False))


# token counts

def test_counts_equal_the_library(spark):
    docs = edge_docs(spark).unionByName(plain(spark, [
        "<|endoftext|>a<|startoftext|> <|endoftext|>", "I'll 12345 don't x", "é É ẛ̣ İ Σς", " a\x1cb", "0́" * 9], 50),
        allowMissingColumns=True)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs).collect())
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    assert got == Counter((i, len(t.encode()), whole_count(t), whole_count(t) > 2048) for i, t in texts)
    assert token_counts.count_tokens(no_docs(spark)).collect() == []


def test_counts_of_the_table(spark):
    got = {r.doc_id: r.n_tokens for r in queries.QUERIES["op11_token_counts"](spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: whole_count(r.text) for r in texts}


SMALL = token_counts.Counter(CONTENT, piece=5, batch=16)
ALPHABET = st.sampled_from(list("ab'sStẹ́́ \t\n\r0129.,|<>  　İΣς한漢가Å\U0001f600") + [
    "<|endoftext|>", "<|startoftext|>", "'ll", "n't", "<|", "|>"])


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=60).map("".join))
def test_cuts_keep_the_tokens(text):
    pieces = SMALL.pieces(text)
    assert "".join(pieces) == text
    assert SMALL.counts([text, "x", text], np.array([len(text.encode()), 1, len(text.encode())])).tolist() == [
        whole_count(text), 1, whole_count(text)]


def test_files_without_safe_cuts_are_encoded_whole():
    assert token_counts.cuts_are_safe(CONTENT)
    other = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
    assert not token_counts.cuts_are_safe(other)
    assert token_counts.Counter(other, piece=3).pieces("a b c d e") == ["a b c d e"]


def test_long_text_is_cut(spark):
    counter = token_counts.Counter(CONTENT)
    text = "the quick brown fox " * 20000
    assert max(map(len, counter.pieces(text))) < token_counts.PIECE + 100
    assert counter.counts([text], np.array([len(text)])).tolist() == [whole_count(text)]


# periodic runs

def brute_runs(words, least):
    """Stretches of equal words at each distance, without those that a smaller period explains."""
    n, found = len(words), []
    number = np.array([{w: k for k, w in enumerate(sorted(set(words)))}[w] for w in words], int)
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], number[:-q] == number[q:], [False]])
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for a, b in edges.reshape(-1, 2):
            if b - a + q >= max(least, 2 * q):
                own = number[a:b + q]
                if not any((own[:-p] == own[p:]).all() for p in range(1, q)):
                    found.append((int(a), int(b - a + q), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=50), st.integers(0, 49), st.integers(1, 9), st.sampled_from([2, 3, 4, 5, 7, 12]))
def test_runs_equal_brute_force(word, at, period, least):
    words = [b"%d" % w for w in word]
    if at < len(words):
        words = [words[i] if i < at else words[at + (i - at) % period] for i in range(len(words))]
    assert [tuple(map(int, r)) for r in runs.find_runs(words, least)] == brute_runs(words, least)
    number = {w: k + 1 for k, w in enumerate(dict.fromkeys(words))}
    assert [tuple(map(int, r)) for r in runs.runs_of([number[w] for w in words], least)] == brute_runs(words, least)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40))
def test_tour_of_the_suffix_tree(word):
    """Leaves come in the order of the suffixes, with their common prefixes in between."""
    text = [*word, 0]
    leaves, shallow = runs.SuffixTree(word).tour()
    assert leaves.tolist() == sorted(range(len(text)), key=lambda k: text[k:])
    for k in range(1, len(leaves)):
        a, b = text[leaves[k - 1]:], text[leaves[k]:]
        assert shallow[k] == next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_runs_of_the_table(spark):
    """The query against its contract in plain Python, planted repeats included."""
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    some = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = (r.text or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words, 12)
        kept = [w.decode() for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in found)]
        best = min(((-length, s, q) for s, length, q in found), default=None)
        top = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])
        assert got[r.doc_id] == (len(found), *top, _sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), _sha(" ".join(kept)))
        some += len(found)
    assert some > 5 and len(got) == 200


def test_runs_of_difficult_rows(spark):
    docs = edge_docs(spark).unionByName(plain(spark, ["a b " * 7, "x y\x0bz x\x0cy z  x " * 5, "w " * 12, "w " * 11], 50), allowMissingColumns=True)
    got = runs.periodic_runs(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter([*[r[0] for r in rows()], 50, 51, 52, 53])
    by_id = {r.doc_id: r for r in got}
    tuples = {k: [tuple(x) for x in by_id[k].runs] for k in by_id}
    assert tuples[0] == tuples[1] == tuples[2] == [] and by_id[0].collapsed == by_id[2].collapsed == ""
    assert tuples[4] == [(0, 48000, 12)] and len(by_id[4].collapsed.split()) == 12
    assert tuples[50] == [(0, 14, 2)] and by_id[50].collapsed == "a b"
    assert tuples[51] == [(0, 35, 7)] and tuples[52] == [(0, 12, 1)] and tuples[53] == []
    assert by_id[14].collapsed == "x" * 30000
    assert runs.periodic_runs(no_docs(spark)).collect() == []


# Merkle manifests

def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_sha("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return levels


def plain_manifest(table):
    """(subroot, root, proof) of each row of (tree, id, leaf), as a list by row."""
    order = sorted(range(len(table)), key=lambda k: [(x is not None, x.encode() if isinstance(x, str) else x or 0) for x in table[k]])
    trees = {}
    for k in order:
        trees.setdefault(table[k][0], []).append(k)
    inner = [plain_levels([table[k][2] for k in own]) for own in trees.values()]
    top = plain_levels([levels[-1][0] for levels in inner])
    out = {}

    def path(levels, i):
        for level in levels[:-1]:
            yield (bool(i & 1), level[i ^ 1]) if i ^ 1 < len(level) else (None, None)
            i >>= 1

    for t, (own, levels) in enumerate(zip(trees.values(), inner)):
        for i, k in enumerate(own):
            out[k] = (levels[-1][0], top[-1][0], [*path(levels, i), *path(top, t)])
    return [out[k] for k in range(len(table))]


@pytest.mark.parametrize("bits", [1, 2, 3, 10])
def test_proofs_equal_a_plain_tree(spark, bits):
    sizes = {"a": 1, "b": 2, None: 3, "cc": 37, "ä": 8, "": 17, "z": 5} | {f"t{k}": 1 for k in range(9)}
    table = [(lang, (k * 7) % size, _sha(f"{lang}{k}")) for lang, size in sizes.items() for k in range(size)]
    table += [("cc", None, _sha("none")), ("cc", 3, _sha("tie")), ("a", 0, _sha("twin"))]
    frame = spark.createDataFrame([(*r, "x") for r in table], "lang string, doc_id long, leaf string, _row string")
    want = dict(zip([r[2] for r in table], plain_manifest(table)))
    proved = merkle.prove(frame, bits=bits)
    assert proved.columns == ["lang", "doc_id", "leaf", "_row", "subroot", "root", "proof"]
    checked = proved.withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).withColumn(
        "wrong", merkle.fold(F.sha2("leaf", 256), F.col("proof")))
    got = checked.collect()
    assert len(got) == len(table)
    for r in got:
        assert (r.subroot, r.root, [tuple(s) for s in r.proof]) == want[r.leaf]
        assert r.folded == r.root != r.wrong


def test_manifest_of_difficult_rows(spark):
    docs = edge_docs(spark)
    got = merkle.manifest(docs, {"n_chars": F.coalesce(F.col("n_chars"), F.lit(0))}, bits=2).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())

    def leaf(values):
        return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    want = Counter((i, leaf([i, source, lang, None, text]), leaf([i, source, lang, 0, text])) for i, text, lang, source, *_ in rows())
    assert Counter((r.doc_id, r.leaf, r.claimed_leaf) for r in got) == want
    assert len({r.root for r in got}) == 1
    assert merkle.manifest(no_docs(spark)).collect() == []


def test_tampering_is_found(spark):
    got = queries.QUERIES["op13_merkle_manifest"](spark, SF).collect()
    for r in got:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
