"""Registered text queries: SQL twins, columns, and the pipeline against the operators' plain definitions."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))

import corpus_pipeline  # noqa: E402
from sqlcheck import _bag, connect  # noqa: E402

from readloom.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    want = connect(SF).execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert _bag([tuple(r) for r in got.select(columns).collect()], columns) == _bag(want.fetchall(), columns)


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    """The kept documents, found again with SQL and the fingerprints of the SimHash operator."""
    con = connect(SF)
    kept = {r[0] for r in con.execute("""
        SELECT min(doc_id) FROM documents WHERE regexp_matches(coalesce(text, ''), '\\p{L}')
        GROUP BY regexp_replace(text, '[\\x20\\x09-\\x0D]+', ' ', 'g')""").fetchall()}
    prints = {r.doc_id: int(r.fingerprint, 16) for r in queries.QUERIES["op6_simhash"](spark, SF).collect() if r.doc_id in kept}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in root:
            least = min(root[j] for j in root if (prints[i] ^ prints[j]).bit_count() <= 2)
            changed, root[i] = changed or least != root[i], least
    bad = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLE['op8_decontamination']}) WHERE contaminated").fetchall()}
    want = {i for i in root if root[i] == i} - bad
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == want
