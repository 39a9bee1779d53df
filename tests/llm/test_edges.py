"""Every operator and pipeline stage on nulls, empty and very long texts, ties, repeats, no rows and clashing columns."""

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline  # noqa: E402
from helpers import edge_docs, no_docs, rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from readloom.llm import (  # noqa: E402
    bpe, decontam, exact_dedup, html, langid, pii, sharding, simhash, suffix_dedup, toxicity)

SF = "/root/testdata/sf0.001"


def _bench(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def _labels(spark):
    return spark.createDataFrame([(6, 1), (7, 0), (7, 1), (9, 0), (None, 1), (10, None)], "doc_id long, toxic int")


def _tox(docs):
    labels = _labels(docs.sparkSession)
    return toxicity.score(docs, toxicity.train(docs, labels, F.col("doc_id") % 2 == 0))


OPERATORS = {
    "exact": exact_dedup.exact_duplicates, "bpe": bpe.round_trip, "langid": lambda d: langid.predict(d, langid.train(d)),
    "suffix": suffix_dedup.strip_repeats, "simhash": simhash.near_duplicates, "pii": pii.report,
    "decontam": lambda d: decontam.verdicts(d, _bench(d.sparkSession)), "toxicity": _tox, "sharding": sharding.shard_rows,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, name):
    got = OPERATORS[name](edge_docs(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id < 20}
    if name == "exact":
        assert by_id[5].keep_id == 4 and not by_id[5].kept and by_id[0].group_size == 3  # null, empty, null id with null
        assert {by_id[k].keep_id for k in (9, 10)} == {9} and by_id[9].group_size == 4 and by_id[11].group_size == 1
    elif name == "bpe":
        assert by_id[0].n_tokens == by_id[1].n_tokens == 0 and by_id[4].ids_sha256 == by_id[5].ids_sha256
    elif name == "langid":
        assert {by_id[k].lang_pred for k in (0, 1, 2, 3)} == {"und"} and all(0 <= r.score <= 1 for r in got)
    elif name == "suffix":
        assert by_id[4].n_removed == by_id[4].n_bytes and by_id[6].n_removed == by_id[6].n_bytes and by_id[0].n_removed == 0
        assert by_id[14].n_removed == 30000 and by_id[14].n_spans == 1 and by_id[12].n_removed == 0
    elif name == "simhash":
        assert by_id[0].fingerprint == by_id[2].fingerprint == "0" * 16 and by_id[8].fingerprint == by_id[6].fingerprint
        assert by_id[5].component_id == 4 and not by_id[5].kept
    elif name == "pii":
        assert (by_id[12].n_email, by_id[12].n_phone) == (1, 1) and by_id[0].spans == ""
    elif name == "decontam":
        assert by_id[0].n_words == 0 and not any(r.contaminated for r in got)
    elif name == "toxicity":
        assert all(0 <= r.score <= 1 for r in got)
    elif name == "sharding":
        counts = Counter(r.shard for r in got)
        assert sorted(counts) == list(range(len(counts))) and max(counts.values()) == 1
        assert all(r.slot == 0 for r in got) and by_id[0].size == 8 and by_id[0].text_crc32 == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    assert OPERATORS[name](no_docs(spark)).collect() == []


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_on_difficult_rows(spark, stage):
    name, run = corpus_pipeline.STAGES[stage]
    docs = edge_docs(spark)
    got = run(spark, docs, SF)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert got.columns == docs.columns
    ids = sorted(r.doc_id for r in got.collect() if r.doc_id is not None)
    gone = {"language_id": {0, 1, 2, 3}, "exact_dedup": {1, 5, 10, 20}, "simhash_near_dedup": None}.get(name, set())
    if gone is not None:
        assert set(ids) == {r[0] for r in rows() if r[0] is not None} - gone
    else:
        assert {1, 2, 5, 8, 10, 20} & set(ids) == set() and {0, 4, 6, 9, 14} <= set(ids)
    assert run(spark, no_docs(spark), SF).collect() == []


def test_stages_judge_rows_by_their_own_text(spark):
    """Null and repeated ids: a row goes for its own verdict, not for that of another row with its id."""
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    other = "a stone bridge of the old town stands where two rivers meet below the hill"
    table = [(None, "..."), (None, "fine words"), (7, "!"), (7, "letters"), (None, passage), (8, passage), (8, other),
             (9, other), (9, other), (None, other)]
    docs = spark.createDataFrame([(*r, "en") for r in table], "doc_id long, text string, lang string")
    stages = dict(corpus_pipeline.STAGES)

    def left(stage, rows=docs):
        return Counter((r.doc_id, r.text) for r in stages[stage](spark, rows, SF).collect())

    assert left("language_id") == Counter(table[1:2] + table[3:])
    assert left("decontamination") == Counter(t for t in table if t[1] != passage)
    assert left("exact_dedup") == Counter([*table[:4], (8, passage), (8, other)])
    twins = docs.filter("doc_id = 9 or (doc_id is null and text = '...')")
    assert left("exact_dedup", twins.unionByName(twins)) == Counter([(9, other), (None, "...")])
    assert left("simhash_near_dedup", docs.filter("length(text) > 3").dropDuplicates()) == Counter(
        [(None, "fine words"), (7, "letters"), (8, passage), (8, other)])


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (3, "u", "<p>Just one paragraph, with a comma, and a stop."), (3, "u", "<div" * 5000),
         (None, "u", "<article><p>A &amp; B</p><p>C<br>D</p></article>" + "<p>x</p>" * 20000)], "page_id long, url string, html string")
    got = {(r.page_id, r.n_chars > 0): r for r in html.main_text(pages.withColumn("text", F.lit(1)), html.train(pages)).collect()}
    assert len(got) == 5 and got[1, False].text == "" and got[3, True].text.startswith("Just one")
    assert got[None, True].text.startswith("A & B\n\nC D")
    empty = pages.limit(0)
    assert html.main_text(empty, html.train(empty)).collect() == []


def test_empty_benchmark_hits_nothing(spark):
    none = _bench(spark).limit(0)
    assert not any(r.n_hit for r in decontam.verdicts(edge_docs(spark), none).collect())
