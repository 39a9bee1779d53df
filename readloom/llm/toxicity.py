"""Toxicity by two Kneser-Ney models of byte 5-grams, one of toxic and one of ordinary texts.

All labelled training texts are counted: 5-grams per class by how often they occur, shorter ones by how many bytes stand
before them. Orders 3 to 5 belong to a class; they back off to one bigram model that both classes share, so that a
rare expression speaks for neither class. A text is scored by the difference of the two log-likelihoods per byte,
over the whole text and over its strongest stretches. A logistic curve makes a probability of it; it
is fitted on rows of one fold with models that have not counted that fold.

Every counted gram and context is a row of a Spark table. Texts are dealt into shards of some MB; the different grams of
a shard are joined to the table, and what is found goes back to the shard, so no task holds the model.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from readloom.llm.common import sieve, sieved, text_of
from readloom.operators.skew import HOT_ROWS, sliced_join, union_all
from readloom.session import cut_lineage

ORDER, SHARED = 5, 2
DISCOUNT = 0.75
SHARD_BYTES = 16 << 20      # text whose different grams are looked up together
STRETCHES = (48, 256)       # bytes
CALIBRATION_ROWS = 4000     # rows that the curve is fitted on at most
_STEP = 1 << 21             # bytes handled at once
_COUNTS = ("t", "o", "ct", "co")  # toxic and ordinary: of all folds, of all but the one for calibration


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(b" " * (ORDER - 1) + text.lower().encode() + b" ", np.uint8)


def grams(data: np.ndarray) -> np.ndarray:
    """Every run of ORDER bytes as a number, the last byte lowest."""
    wide = data.astype(np.int64)
    out = np.zeros(max(0, len(data) - ORDER + 1), np.int64)
    for k in range(ORDER):
        out = out << 8 | wide[k:len(out) + k]
    return out


def count_grams(labelled: DataFrame) -> DataFrame:
    """key and four counts per 5-gram, from rows of text, toxic and calibration; combined per task before the shuffle."""
    def compact(parts):
        keys = np.concatenate([p[0] for p in parts])
        found, at = np.unique(keys, return_inverse=True)
        return found, np.bincount(at, np.concatenate([p[1] for p in parts]), len(found)).astype(np.int64)

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            kinds = pc.add(pc.multiply(batch.column(1), 2), batch.column(2)).to_numpy()
            for kind in np.unique(kinds):
                texts = batch.column(0).filter(pa.array(kinds == kind))
                waiting, size = [], 0
                for k, text in enumerate(texts):
                    waiting.append(grams(_bytes(text.as_py())))
                    size += len(waiting[-1])
                    if size >= _STEP or k == len(texts) - 1:
                        part = np.unique(np.concatenate(waiting), return_counts=True)
                        held[kind] = [compact([*held.get(kind, []), part])]
                        waiting, size = [], 0
        for kind, [(keys, counts)] in held.items():
            for at in range(0, len(keys), 1 << 16):
                own = keys[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own), pa.array(np.full(len(own), kind, np.int32)), pa.array(counts[at:at + (1 << 16)])],
                    ["key", "kind", "n"])

    rows = labelled.select("text", F.col("toxic").cast("int"), F.col("calibration").cast("int"))
    n = lambda *kinds: F.sum(F.when(F.col("kind").isin(*kinds), F.col("n")).otherwise(0))
    return rows.mapInArrow(run, "key long, kind int, n long").groupBy("key").agg(
        n(2, 3).alias("t"), n(0, 1).alias("o"), n(2).alias("ct"), n(0).alias("co"))


def _levels(counted: DataFrame) -> dict[int, DataFrame]:
    """Counts per order: below the highest, the number of different bytes before a gram."""
    levels = {ORDER: counted}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("key").bitwiseAND((1 << 8 * order) - 1).alias("key")
        levels[order] = levels[order + 1].groupBy(shorter).agg(
            *[F.sum((F.col(c) > 0).cast("long")).alias(c) for c in _COUNTS])
    return levels


def _tagged(key, order: int):
    """A gram as a key that no gram of another order has."""
    return key + (order << 8 * ORDER)


def _shared(pairs, toxic: str, ordinary: str) -> np.ndarray:
    """Chance of a byte after another, from the bigrams of both classes, smoothed down to all bytes alike."""
    table = np.zeros((256, 256))
    key = pairs["key"].to_numpy(np.int64)
    table[key >> 8, key & 255] = np.maximum(pairs[toxic], pairs[ordinary])
    single = (table > 0).sum(axis=0) + 1.0
    single /= single.sum()
    total, kinds = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
    backoff = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
    return (np.maximum(table - DISCOUNT, 0) / np.maximum(total, 1) + backoff * single).ravel()


def gram_table(counted: DataFrame) -> DataFrame:
    """Every gram of orders 3 to 5 and every context: key (tagged by its length), log ratio of the classes as a gram
    (``own``) and as a context to back off from (``weight``), null where it isn't one; ``early_`` without the fold for calibration.
    """
    spark, levels = counted.sparkSession, _levels(counted)
    pairs = levels[SHARED].toPandas()
    below = F.broadcast(spark.createDataFrame(pd.DataFrame(  # one row per pair of bytes
        {"lower": np.arange(1 << 16), **{f"below_{c}": _shared(pairs, *own) for own in (_COUNTS[:2], _COUNTS[2:]) for c in own}})))
    ratio = lambda x: [F.log(F.col(f"{x}_t") / F.col(f"{x}_o")), F.log(F.col(f"{x}_ct") / F.col(f"{x}_co"))]
    none, parts = F.lit(None).cast("double"), []
    for order in range(SHARED + 1, ORDER + 1):
        context = Window.partitionBy("h")  # 256 rows at most
        full = levels[order].withColumn("h", F.shiftright("key", 8)).withColumns(
            {f"sum_{c}": F.sum(c).over(context) for c in _COUNTS}
            | {f"kinds_{c}": F.sum((F.col(c) > 0).cast("long")).over(context) for c in _COUNTS})
        full = full.withColumns({f"w_{c}": F.when(F.col(f"sum_{c}") > 0, DISCOUNT * F.col(f"kinds_{c}") / F.col(f"sum_{c}"))
                                 .otherwise(1.0) for c in _COUNTS})
        lower = F.col("key").bitwiseAND((1 << 8 * (order - 1)) - 1)
        full = full.withColumn("lower", lower).join(below, "lower").withColumns({
            f"p_{c}": F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.greatest(f"sum_{c}", F.lit(1))
            + F.col(f"w_{c}") * F.col(f"below_{c}") for c in _COUNTS})
        full = cut_lineage(full.select("key", "h", *[f"{x}_{c}" for x in "pw" for c in _COUNTS]))
        below = full.select(F.col("key").alias("lower"), *[F.col(f"p_{c}").alias(f"below_{c}") for c in _COUNTS])
        weights = full.groupBy("h").agg(*[F.first(f"w_{c}").alias(f"w_{c}") for c in _COUNTS])  # alike within a context
        parts += [full.select(_tagged(F.col("key"), order), *ratio("p"), none, none).toDF(*_TABLE),
                  weights.select(_tagged(F.col("h"), order - 1), none, none, *ratio("w")).toDF(*_TABLE)]
    return cut_lineage(union_all(*parts).groupBy("key").agg(*[F.max(c).cast("float").alias(c) for c in _TABLE[1:]]))


_TABLE = ("key", "own", "early_own", "weight", "early_weight")


def _pieces(texts):
    """Grams of texts in lists of about ``_STEP``, with the number of the text; long texts come in several pieces."""
    waiting, size = [], 0
    for k, text in enumerate(texts):
        data = _bytes(text)
        for at in range(0, len(data) - ORDER + 1, _STEP):
            waiting.append((k, grams(data[at:at + _STEP + ORDER - 1])))
            size += len(waiting[-1][1])
            if size >= _STEP:
                yield waiting
                waiting, size = [], 0
    if waiting:
        yield waiting


def _orders(full: np.ndarray):
    """Per order, lowest first: the last bytes of every gram and their context, as keys of the table."""
    for order in range(SHARED + 1, ORDER + 1):
        key = full & ((1 << 8 * order) - 1)
        yield _tagged(key, order), _tagged(key >> 8, order - 1)


def _pack(rows: DataFrame) -> DataFrame:
    """The rows of each ``shard`` in a batch as one compressed table: texts cross the shuffle in a fraction of their bytes."""
    def run(batches):
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            own = batch.select([c for c in batch.schema.names if c != "shard"])
            order = np.argsort(shards, kind="stable")
            found, at = np.unique(shards[order], return_index=True)
            sizes, packed = [], []
            for places in np.split(order, at[1:]) if len(order) else []:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema) as writer:
                    writer.write_batch(own.take(pa.array(places)))
                data = sink.getvalue()
                sizes.append(data.size)
                packed.append(pa.compress(data, codec="zstd", asbytes=True))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                                             ["shard", "size", "rows"])

    return rows.mapInArrow(run, "shard long, size long, rows binary")


def _unpack(packed: pa.RecordBatch | pa.Table) -> Iterator[pa.Table]:
    for size, data in zip(packed.column("size").to_pylist(), packed.column("rows").to_pylist()):
        yield pa.ipc.open_stream(pa.decompress(data, size, codec="zstd")).read_all()


def _asked(_: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys that the texts of a shard need, each once."""
    held = np.zeros(0, np.int64)
    shard = None

    def texts():
        nonlocal shard
        for batch in batches:
            shard = batch.column("shard")[0].as_py()
            for table in _unpack(batch):
                yield from table.column("text").to_pylist()

    for piece in _pieces(texts()):
        found = pd.unique(np.concatenate([x for _, x in piece]))
        held = pd.unique(np.concatenate([held, found]))
    keys = pd.unique(np.concatenate([x for pair in _orders(held) for x in pair]))
    for at in range(0, len(keys), 1 << 16):
        own = keys[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), shard, np.int64)), pa.array(own)], ["shard", "key"])


class Ratios:
    """Log-likelihood ratio per byte, from the rows of the table that a shard needs."""

    def __init__(self, found: pa.Table):
        rows = found.num_rows  # a shard without any has no columns either
        column = lambda c, kind: found.column(c).to_numpy().astype(kind) if rows else np.zeros(0, kind)
        self.index = pd.Index(column("key", np.int64))
        self.own, self.weight = (np.append(column(c, float), np.nan) for c in ("own", "weight"))

    def __call__(self, full: np.ndarray) -> np.ndarray:
        places, different = pd.factorize(full)
        out = np.zeros(len(different))
        for key, context in _orders(different):
            own, weight = self.own[self.index.get_indexer(key)], self.weight[self.index.get_indexer(context)]
            out = np.where(np.isnan(own), np.where(np.isnan(weight), 0, weight) + out, own)
        return out[places]

    def features(self, texts: Iterable[str]) -> list[list[float]]:
        """Mean ratio of every text and of its strongest stretches."""
        out, own, last = [], [], 0
        for piece in _pieces(texts):
            ratios = self(np.concatenate([x for _, x in piece]))
            ends = np.cumsum([len(x) for _, x in piece])
            for (k, x), end in zip(piece, ends):
                if k != last:
                    out.append(_strongest(own))
                    own, last = [], k
                own.append(ratios[end - len(x):end])
        return [*out, _strongest(own)] if own else out


def _strongest(parts: list[np.ndarray]) -> list[float]:
    total = np.concatenate([np.zeros(1), np.cumsum(np.concatenate(parts))])
    n = len(total) - 1
    out = [float(total[-1] / n)]
    for size in STRETCHES:
        out.append(float((total[size:] - total[:-size]).max() / size) if n > size else float(total[-1] / size))
    return out


def _features(rows: DataFrame, found: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and the features per row; ``found`` has key, own and weight.

    A gram has a row per shard that needs it, so shards bound how often it is asked for.
    """
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(-(-size // SHARD_BYTES), rows.sparkSession.sparkContext.defaultParallelism)
    dealt = _pack(rows.select(*keep, "text", F.pmod(F.xxhash64(*keep, "text"), F.lit(shards)).alias("shard")))
    asked = dealt.groupBy("shard").applyInArrow(_asked, "shard long, key long")
    answered = sliced_join(asked, found, ["key"]) if shards > HOT_ROWS else asked.join(found, "key")

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return schema.empty_table()
        kept = []

        def unpacked():
            for table in _unpack(texts):
                kept.append(table.select(keep))
                yield from table.column("text").to_pylist()

        own = Ratios(answers).features(unpacked())
        return pa.concat_tables(kept).append_column("features", pa.array(own, pa.list_(pa.float64()))).cast(schema)

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    schema = to_arrow_schema(rows.select(*keep, F.lit(None).cast("array<double>").alias("features")).schema)
    return dealt.groupBy("shard").cogroup(answered.groupBy("shard")).applyInArrow(run, f"{kept}, features array<double>")


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps; features are scaled within the weights returned."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    ridge = np.diag([1.0] * x.shape[1] + [1e-3])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


class Model:
    def __init__(self, table: DataFrame, curve: np.ndarray):
        self.table, self.curve = table, curve


def train(docs: DataFrame, labels: DataFrame, calibration, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """A model from the rows of ``docs`` that ``labels`` marks 0 or 1; ``calibration`` is a condition on ``doc_id``.

    Where an id has several labels the highest counts; null labels are left out. With no labelled
    row in one of the classes every text gets the share of toxic rows (0 without any).
    """
    known = cut_lineage(labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
                        .filter("doc_id is not null and toxic is not null")
                        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = sieved(rows, sieve(known, "doc_id"), "doc_id").filter("__hit").drop("__hit")
    labelled = rows.join(known, "doc_id").withColumn("calibration", calibration)
    counted = cut_lineage(count_grams(labelled))
    known_grams = gram_table(counted)
    early = known_grams.select("key", F.col("early_own").alias("own"), F.col("early_weight").alias("weight"))
    final = known_grams.select("key", "own", "weight")
    share = known.filter(calibration).agg(F.count(F.lit(1))).first()[0]
    pick = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) * F.lit(share) < F.lit(CALIBRATION_ROWS << 20)
    sample = _features(labelled.filter(F.col("calibration") & pick), early, ["doc_id", "toxic"]).orderBy("doc_id").collect()
    y = np.array([r.toxic for r in sample], float)
    if len(set(y)) < 2:
        p = float(y.mean()) if len(y) else 0.0
        return Model(final, np.array([0.0] * (1 + len(STRETCHES)) + [np.log(max(p, 1e-12) / max(1 - p, 1e-12))]))
    return Model(final, _curve(np.array([r.features for r in sample]), y))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) per row, from the text alone.

    A null or empty text is scored as one blank. Null, repeated and tied ids pass through; other columns are not
    read; no rows give no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    line = F.lit(float(model.curve[-1]))
    for k, weight in enumerate(model.curve[:-1]):
        line = line + F.lit(float(weight)) * F.element_at("features", k + 1)
    return (_features(rows, model.table, ["doc_id"]).withColumn("score", 1 / (1 + F.exp(-line)))
            .select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
