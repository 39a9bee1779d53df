"""Language by two steps: the family first, then one-versus-one linear support vector machines within it.

A text is a vector of hashed byte trigrams, damped by a logarithm and scaled to unit length. Families are told apart by
one-versus-one machines too. Training takes a bounded sample of labelled rows of each language; every
machine is trained in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.common import text_of, tidy
from readloom.session import cut_lineage

SAMPLE = 800        # labelled rows of each language that a model is trained on
MAX_LANGUAGES = 2000  # bounds the table of counts that is broadcast
MAX_MACHINES = 5000  # machines of one model: 100 languages of one family; 20 kB each
CELLS = 1 << 12     # hashed trigrams
UNDETERMINED = "und"
SEED = 11

# Genealogical families of languages by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz tk ky tt",
    "semitic": "ar he mt am",
    "iranian": "fa ku ps tg",
    "indic": "hi ur bn pa mr gu ne si",
    "dravidian": "ta te kn ml",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    return _FAMILY.get(lang.split("-")[0].split("_")[0].lower(), f"only {lang}")


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells and weights of the trigrams of the whole text."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    counts = np.zeros(CELLS, np.int64)
    for start in range(0, len(data) - 2, 1 << 20):
        part = data[start:start + (1 << 20) + 2]
        mixed = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761)
        counts += np.bincount(mixed >> np.uint32(32 - CELLS.bit_length() + 1), minlength=CELLS)
    cells = np.flatnonzero(counts)
    weights = np.log1p(counts[cells])
    return cells, weights / max(1e-9, np.sqrt(weights @ weights))


def train_machine(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, rounds: int = 25, cost: float = 4.0):
    """Weights and offset of a linear machine with squared hinge loss, by coordinate descent on the dual."""
    weights = np.zeros(CELLS + 1)
    rows = [(np.append(c, CELLS), np.append(w, 1.0)) for c, w in rows]
    alpha, corner = np.zeros(len(rows)), 1 / (2 * cost)
    norms = [w @ w + corner for _, w in rows]
    order = np.random.default_rng(SEED)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            cells, values = rows[i]
            slope = signs[i] * (values @ weights[cells]) - 1 + corner * alpha[i]
            moved = max(0.0, alpha[i] - slope / norms[i])
            weights[cells] += (moved - alpha[i]) * signs[i] * values
            alpha[i] = moved
    return weights


class Model:
    """Machines by (group, first, second); a positive margin speaks for ``first``. Groups are families, or '' for them."""

    def __init__(self, languages: Iterable[str], machines: dict[tuple[str, str, str], np.ndarray]):
        self.members: dict[str, list[str]] = {"": sorted({family_of(x) for x in languages})}
        for lang in sorted(set(languages)):
            self.members.setdefault(family_of(lang), []).append(lang)
        self.machines = machines

    def _choose(self, group: str, cells: np.ndarray, weights: np.ndarray) -> tuple[str, float]:
        names = self.members[group]
        votes, sure = dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
        for first, second in combinations(names, 2):
            machine = self.machines.get((group, first, second))
            if machine is None:
                continue
            chance = 1 / (1 + np.exp(-4 * (weights @ machine[cells] + machine[CELLS])))
            votes[first] += (chance >= 0.5) + 1e-3 * chance
            votes[second] += (chance < 0.5) + 1e-3 * (1 - chance)
            sure[first], sure[second] = min(sure[first], chance), min(sure[second], 1 - chance)
        best = max(names, key=lambda x: (votes[x], x))
        return best, float(sure[best])

    def predict(self, text: str) -> tuple[str, float]:
        cells, weights = vector(text)
        family, a = self._choose("", cells, weights)
        lang, b = self._choose(family, cells, weights)
        return lang, a * b


def _sample(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows of each language, chosen by a hash of the id and text; a filter thins them before the sort."""
    counts = cut_lineage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    if counts.count() > MAX_LANGUAGES:
        raise ValueError("more languages than one model holds")
    pick = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(1 << 20))
    thin = rows.withColumn("__p", pick).join(F.broadcast(counts), "lang").filter(F.col("__p") * F.col("n") < 2.0 * bound * (1 << 20))
    first = Window.partitionBy("lang").orderBy("__p", "doc_id", F.xxhash64("text"))
    return thin.withColumn("__k", F.row_number().over(first)).filter(F.col("__k") <= bound).select("lang", "text")


def train(labelled: DataFrame, bound: int = SAMPLE, lang_col: str = "lang", text_col: str = "text",
          id_col: str = "doc_id") -> Model:
    """A model from the rows with a language and a text with letters; languages come from the labels alone."""
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), text_of(text_col).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & has_letter(F.col("text")))

    def vectors(batches):
        for batch in batches:
            found = [vector(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([c.astype(np.int32).tobytes() for c, _ in found], pa.binary()),
                pa.array([w.astype(np.float32).tobytes() for _, w in found], pa.binary())], ["lang", "cells", "weights"])

    sample = cut_lineage(_sample(rows, bound).mapInArrow(tidy(vectors), "lang string, cells binary, weights binary"))
    languages = [r.lang for r in sample.select("lang").distinct().collect()]
    model = Model(languages, {})
    tasks = [(group, a, b, lang, sign) for group, names in model.members.items() for a, b in combinations(names, 2)
             for lang in languages for own, sign in ((a, 1), (b, -1))
             if own == (lang if group else family_of(lang))]
    if not tasks:
        return model
    if len({x[:3] for x in tasks}) > MAX_MACHINES:
        raise ValueError("more pairs of languages than one model holds")
    spark = labelled.sparkSession
    duty = spark.createDataFrame(tasks, "grp string, first string, second string, lang string, sign int")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["lang", "cells", "weights"])
        rows = [(np.frombuffer(c, np.int32), np.frombuffer(w, np.float32)) for c, w in zip(part["cells"], part["weights"])]
        found = train_machine(rows, part["sign"].to_numpy())
        return part[["grp", "first", "second"]].head(1).assign(machine=[found.astype(np.float32).tobytes()])

    fitted = (sample.join(F.broadcast(duty), "lang").groupBy("grp", "first", "second")
              .applyInPandas(fit, "grp string, first string, second string, machine binary"))
    model.machines = {(r.grp, r.first, r.second): np.frombuffer(r.machine, np.float32) for r in fitted.collect()}
    return model


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) per row, from the text alone.

    A null text, one without a letter, and any text where the model knows no language is ``und`` with score
    0. Null, repeated and tied ids pass through; other columns are not read; no rows give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        for batch in batches:
            found = [own.predict(text.as_py()) if known.as_py() and own.members[""] else (UNDETERMINED, 0.0)
                     for text, known in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("known", has_letter(F.col("text")))
    return rows.mapInArrow(
        tidy(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def accepted() -> Column:
    """Holds for a prediction that names a language."""
    return F.col("lang_pred") != UNDETERMINED
