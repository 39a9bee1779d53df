"""Personal data, and the words around it that give it away.

Base spans are the matches of four patterns. Every pattern is written so that it is tried once per run of its
characters and never backtracks over a run, so its cost is linear in the text. Positions come from the lengths of the gaps
and matches.

The words of a text with a match are weighed by what they tell about it (information-theoretic sanitisation): with p
estimated by the share of documents, PMI(t, e) = log2(p(t, e) / (p(t) p(e))) and IC(e) = -log2 p(e), the word t reveals
the part PMI / IC of the entity e. Words are counted over whole texts. Where the texts that hold both show the entity in
at least ``SUPPORT`` different surroundings, every occurrence of the word in every text with the entity is generalised
from ``DISCLOSURE`` on, and removed from ``REMOVAL`` on. Everything is a DataFrame operation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.common import sieve, sieved, text_of
from readloom.operators.skew import sliced_join
from readloom.session import cut_lineage, scratch_dir

SURROUNDING = 80     # characters before and after a match that tell one surrounding from another
SUPPORT = 3
DISCLOSURE, REMOVAL = 0.6, 0.9
HOT_COPIES = 1 << 17
KINDS = ("email", "ip", "card", "phone")

_MAIL = "[A-Za-z0-9._%+-]"
# The definitions of the four kinds, each tried where a run of its characters begins or the last match ended.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_MAYBE = {"email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
          "card": lambda t: t.rlike("[0-9][ -]?[0-9]"), "phone": lambda t: t.contains("+")}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORD = r"\p{L}[\p{L}\p{N}]{2,}"
_SPAN = "struct<start:int,end:int,word:string>"


def _matches(text: Column, pattern: str) -> Column:
    """Start, end and text of all matches, in code points."""
    def place(acc, pair):
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["word"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["word"].alias("word"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.slice(F.arrays_zip(gaps.alias("gap"), words.alias("word")), F.lit(1), F.size(words))
    none = F.array().cast(f"array<{_SPAN}>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.when(F.size(words) > 0, F.aggregate(pairs, start, place)["out"]).otherwise(none)


def _luhn(word: Column) -> Column:
    digits = F.reverse(F.regexp_replace(word, "[^0-9]", ""))
    doubled = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(digits)),
                    lambda i: F.when(i % 2 == 1, F.substring(digits, i, F.lit(1)).cast("int"))
                    .otherwise(doubled(F.substring(digits, i, F.lit(1)).cast("int")))),
        F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, word: Column) -> Column:
    if kind == "ip":
        return word.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return _luhn(word)
    if kind == "phone":
        return F.length(F.regexp_replace(word, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of a kind: leftmost, non-overlapping, without retries after one that fails."""
    found = F.when(_MAYBE[kind](text), _matches(text, PATTERNS[kind])).otherwise(F.array().cast(f"array<{_SPAN}>"))
    return F.filter(found, lambda s: _valid(kind, s["word"])) if kind != "email" else found


def _written(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def _entities() -> Column:
    """The different entities of a row with the hashes of their different surroundings."""
    one = lambda k: F.transform(F.col(k), lambda s: F.struct(
        F.concat(F.lit(f"{k}:"), F.lower(s["word"])).alias("entity"),
        F.xxhash64(F.substring(F.col("text"), F.greatest(s["start"] - SURROUNDING, F.lit(0)) + 1,
                               F.least(s["start"], F.lit(SURROUNDING))),
                   F.substring(F.col("text"), s["end"] + 1, F.lit(SURROUNDING))).alias("around")))
    return F.array_distinct(F.concat(*[one(k) for k in KINDS]))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower))


def _supported(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """copies summed over rows, for keys with ``SUPPORT`` different surroundings. ``arounds`` needs no more than that of a row."""
    each = rows.select("*", F.posexplode("arounds").alias("__at", "__around"))
    return (each.groupBy(*keys).agg(F.sum(F.when(F.col("__at") == 0, F.col("copies"))).alias("both"),
                                    F.count_distinct("__around").alias("support"), *more)
            .filter(F.col("support") >= SUPPORT).drop("support"))


def disclosing_words(docs: DataFrame, base: DataFrame) -> DataFrame:
    """sha, start, end, term and action of every occurrence of a word that discloses an entity of its text.

    ``base`` has sha and entities per row of ``docs``. Documents are counted with their copies; surroundings are counted
    once each, so that copies of one passage give no support. Counts of words cover all documents. As a pair is never more
    frequent than its entity, a word that is too frequent for ``DISCLOSURE`` is left out before pairs are made.
    """
    spark, total = docs.sparkSession, docs.count()
    empty = spark.createDataFrame([], "sha string, start int, end int, term string, action string")
    texts = base.filter(F.size("entities") > 0).groupBy("sha").agg(
        F.count(F.lit(1)).alias("copies"), F.first("entities").alias("entities"))
    each = cut_lineage(texts.select("sha", "copies", F.explode("entities").alias("x")).groupBy("sha", "copies", "x.entity")
                       .agg(F.slice(F.array_sort(F.collect_set("x.around")), 1, SUPPORT).alias("arounds")))
    entities = _supported(each, ["entity"]).withColumnRenamed("both", "with_entity").filter(F.col("with_entity") < total)
    most = F.col("with_entity") * F.pow(total / F.col("with_entity"), F.lit(1 - DISCLOSURE)) * (1 + 1e-9)
    held = cut_lineage(sliced_join(each, entities.withColumn("most", most), ["entity"]))
    if held.isEmpty():
        return empty
    of_text = held.groupBy("sha", "copies").agg(F.collect_list(F.struct("entity", "arounds", "with_entity", "most")).alias("entities"))
    ids, path = held.select("sha").distinct(), scratch_dir(spark, "pii-texts")
    (sieved(docs.select("text").withColumn("sha", F.sha2("text", 256)), sieve(ids, "sha"), "sha").filter("__hit")
     .groupBy("sha").agg(F.first("text").alias("text")).join(ids, "sha").write.parquet(path))
    texts = spark.read.parquet(path)
    words = texts.select("sha", F.explode(_terms(F.col("text"))).alias("term"))
    counted = (sieved(docs.select(F.explode(_terms(F.col("text"))).alias("term")), sieve(words, "term"), "term")
               .filter("__hit").groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
               .filter(F.col("with_term") <= held.agg(F.max("most")).first()[0]))
    fits = F.filter("entities", lambda e: F.col("with_term") <= e["most"])
    seen = cut_lineage(sliced_join(words, counted, ["term"]).join(of_text, "sha")
                       .select("sha", "copies", "term", "with_term", F.explode(fits).alias("x"))
                       .select("sha", "copies", "term", "with_term", "x.entity", "x.arounds", "x.with_entity"))
    pairs = _supported(seen, ["entity", "term"], F.max("with_term").alias("with_term"), F.max("with_entity").alias("with_entity"))
    pmi = F.log2(F.col("both") * F.lit(total) / (F.col("with_term") * F.col("with_entity")))
    flagged = cut_lineage(
        pairs.withColumn("disclosure", pmi / F.log2(F.lit(total) / F.col("with_entity"))).filter(F.col("disclosure") >= DISCLOSURE)
        .select("entity", "term", F.when(F.col("disclosure") >= REMOVAL, "remove").otherwise("generalise").alias("action")))
    marks = cut_lineage(sliced_join(seen.select("sha", "entity", "term"), flagged, ["entity", "term"])
                        .groupBy("sha", "term").agg(F.max("action").alias("action")))
    found = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))
    pieces = F.arrays_zip(F.slice(F.split("text", _WORD, -1), F.lit(1), F.size(found)).alias("gap"), found.alias("word"))
    end = F.sum(F.length("x.gap") + F.length("x.word")).over(Window.partitionBy("sha").orderBy("at")).cast("int")
    placed = (texts.join(marks.select("sha").distinct(), "sha").select("sha", F.posexplode(pieces).alias("at", "x"))
              .select("sha", F.lower("x.word").alias("term"), (end - F.length("x.word")).alias("start"), end.alias("end")))
    return placed.join(marks, ["sha", "term"]).select("sha", "start", "end", "term", "action")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, sha, an array of spans per kind (email, ip, card, phone) and for terms.

    Spans have start, end (exclusive, in code points) and the word; those of terms also what is done with it, and
    never overlap a base span. A null or empty text has none. Rows with equal texts get equal spans; null,
    repeated and tied ids pass through. No rows give no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    found = rows.withColumns({k: base_spans(F.col("text"), k) for k in KINDS}).withColumn("sha", F.sha2("text", 256))
    base = cut_lineage(found.select("doc_id", "sha", *KINDS, _entities().alias("entities")))
    spans = cut_lineage(
        disclosing_words(rows, base).groupBy("sha")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", F.col("term").alias("word"), "action"))).alias("term")))
    out = sliced_join(base.drop("entities"), spans, ["sha"], "left", HOT_COPIES)
    covered = F.concat(*KINDS)
    clear = F.filter("term", lambda t: ~F.exists(covered, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    none = F.array().cast("array<struct<start:int,end:int,word:string,action:string>>")
    return out.withColumn("term", F.coalesce(clear, none))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """sha and sanitised text of every different text with spans: base spans and generalised terms become a tag, others go."""
    def replaced(spans: str, by) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), by(s).alias("by")))

    def tag(kind: str):
        return lambda s: F.lit(f"[{kind}]")

    every = F.array_sort(F.concat(
        *[replaced(k, tag(k)) for k in KINDS],
        replaced("term", lambda s: F.when(s["action"] == "remove", "").otherwise("[term]"))))
    spans = (personal_data(docs, id_col, text_col).select("sha", every.alias("spans")).filter(F.size("spans") > 0)
             .groupBy("sha").agg(F.first("spans").alias("spans")))
    texts = docs.select(text_of(text_col).alias("text")).withColumn("sha", F.sha2("text", 256))
    held = sieved(texts, sieve(spans, "sha"), "sha").filter("__hit").groupBy("sha").agg(F.first("text").alias("text"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]  # of overlapping spans the first is replaced
        return F.struct(F.when(fresh, s["end"]).otherwise(F.greatest(acc["at"], s["end"])).alias("at"), F.when(
            fresh, F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), s["by"]))
            .otherwise(acc["out"]).alias("out"))

    done = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return (held.join(spans, "sha").withColumn("done", done)
            .select("sha", F.concat("done.out", F.substring(F.col("text"), F.col("done.at") + 1, F.length("text"))).alias("sanitised")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts per kind and the digests of base spans and all spans, written as kind:start:end."""
    found = personal_data(docs, id_col, text_col)
    base = [_written(k, F.col(k)) for k in KINDS]
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.concat(*base), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*base, _written("term", F.col("term"))), ",").alias("spans"),
        F.size("term").cast("long").alias("n_term"))
