"""The registered queries of the text operators, each over its whole table with the operator's own defaults."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import (
    bpe, decontam, exact_dedup, html, langid, merkle, pii, runs, sharding, simhash, suffix_dedup, token_counts, toxicity)
from readloom.llm.common import fold_of, table, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return add


@query("op1_exact_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
  sha256(norm) AS text_sha256 FROM d WINDOW g AS (PARTITION BY norm)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op8_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, list_slice(w, i, i + 12) AS win, least(len(w), 13) AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, dw.k, item FROM dw JOIN bw USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of("doc_id", 3) == 1
    model = langid.train(docs.filter(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), fold_of("doc_id", 5)
    labels = table(spark, sf_dir, "labels").filter(fold != 0)
    model = toxicity.train(docs, labels, calibration=fold == 1)
    return toxicity.score(docs, model).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.strip_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.main_text(pages, html.train(pages))


@query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def _crc(name: str) -> Column:
    return F.crc32(F.col(name).cast("string").cast("binary"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text (by crc32 of its id) is periodic from some word on; null ids have none."""
    shift, words = F.floor(_crc("doc_id") / 10), F.regexp_extract_all(text_of(), F.lit(r"([^\x20\x09-\x0D]+)"))
    chosen = docs.select("doc_id", text_of().alias("text"), F.when(_crc("doc_id") % 10 == 0, words).alias("__words"), shift.alias("__g"))
    n = F.size("__words")
    start = (F.col("__g") % n).cast("int")
    period = (F.floor((n - start) / (3 + F.col("__g") % 8)) + 1).cast("int")
    placed = chosen.withColumns({"__a": F.when(n > 0, start), "__p": F.when(n > 0, period)})
    head, unit = F.slice("__words", F.lit(1), F.col("__a")), F.slice("__words", F.col("__a") + 1, F.col("__p"))
    turns = F.ceil((n - F.col("__a")) / F.col("__p")).cast("int")
    planted = F.slice(F.concat(head, F.flatten(F.array_repeat(unit, turns))), F.lit(1), n)
    return placed.select("doc_id", F.when(F.col("__a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("neg"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.when(F.size("runs") > 0, longest))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.neg")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-F.col("best.neg") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _leaf_sql(n_chars: str = "n_chars") -> str:
    parts = [f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
             for c in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(parts)})"


# crc32 of a decimal number: each character, then eight shifts (-1 stands for a shift)
_CRC_SQL = """xor(4294967295, list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT))"""


def _levels_sql(name: str, base: str) -> str:
    return f"""{name} AS (SELECT tree, 0 AS level, idx, digest FROM {base} UNION ALL
 SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx))
 FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, level, idx // 2)"""


@query("op13_merkle_manifest", f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf_sql()} AS leaf,
  CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql()} END AS claimed FROM documents),
o AS (SELECT *, row_number() OVER () AS rid, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM d),
leaves AS (SELECT tree, idx, leaf AS digest FROM o),
{_levels_sql('lv', 'leaves')},
subroots AS (SELECT tree, max(level) AS height, max_by(digest, level) AS digest FROM lv GROUP BY tree),
tops AS (SELECT 0 AS tree, tree AS idx, digest FROM subroots),
{_levels_sql('tv', 'tops')},
summit AS (SELECT max(level) AS height, max_by(digest, level) AS root FROM tv),
steps AS (
  SELECT rid, u.level, o.idx >> u.level AS place, lv.digest FROM o JOIN subroots s ON s.tree = o.tree, unnest(range(0, s.height)) u(level)
  LEFT JOIN lv ON lv.tree = o.tree AND lv.level = u.level AND lv.idx = xor(o.idx >> u.level, 1)
  UNION ALL
  SELECT rid, 1000 + u.level, o.tree >> u.level, tv.digest FROM o, summit, unnest(range(0, summit.height)) u(level)
  LEFT JOIN tv ON tv.level = u.level AND tv.idx = xor(o.tree >> u.level, 1)),
proofs AS (SELECT rid, coalesce(string_agg(digest, '' ORDER BY level), '') AS siblings,
  list(CASE WHEN digest IS NULL THEN '-' WHEN place % 2 = 1 THEN 'L' || digest ELSE 'R' || digest END ORDER BY level) AS path FROM steps GROUP BY rid),
folded AS (SELECT o.*, s.digest AS subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256,
  list_reduce(coalesce(path, []), lambda a, b: CASE WHEN b = '-' THEN sha256(a) WHEN b[1] = 'L' THEN sha256(b[2:] || a) ELSE sha256(a || b[2:]) END,
    claimed) AS folded_root
  FROM o JOIN subroots s ON s.tree = o.tree CROSS JOIN summit LEFT JOIN proofs USING (rid))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(_crc("doc_id") % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    proved = merkle.manifest(docs, {"n_chars": tampered})
    out = proved.withColumn("folded_root", merkle.fold(F.col("claimed_leaf"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
