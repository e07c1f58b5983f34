"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams (3 to 5 characters, lower case) of a whole text, hashed into 2**20 cells. The ratio of a
cell compares the shares of toxic and other training documents that hold it; ``PRIOR`` pseudo-documents split
as the classes are keep rare cells near zero. A logistic model then learns one weight per cell on the ratios.

The fit takes at most ``FIT_ROWS`` labelled documents of ``FIT_CHARS`` characters in all, drawn by the hash of the id: toxic ones up to half
of the rows, then others; the base rate is corrected for that. Ratios are counted by Spark over all of them. Cells that are not
``e`` times likelier in one class (``LEAST_RATIO``) carry no weight, however frequent; rare ones are left to the prior. The weights are
fitted on the driver, which holds four bytes for each feature of the sample that has one. Scoring reads every whole text.

Edge cases: null and empty texts have no features and get the base rate; a null label is no label; a document labelled
more than once counts with its largest label; without labels of both kinds every score is 0. Repeated rows are scored
alike. An empty table gives an empty result. Other columns travel untouched in ``reject``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import cut_lineage
from .common import carried, fold, text_in

CELLS_LOG2 = 20
ORDERS = (3, 4, 5)
FIT_ROWS = 8_000
FIT_CHARS = 16_000_000
PRIOR = 10.0
LEAST_RATIO = 1.0
PENALTY = 3e-2
STEPS = 80
FIT_CELLS = 1 << 22  # features of one pass of the fit
CHUNK = 1 << 20


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # ratio times weight of each cell
    base: float
    known: bool


class Features:
    """Distinct cells of texts; one stamp per cell tells whether the current text has shown it."""

    def __init__(self) -> None:
        self.stamp = np.zeros(1 << CELLS_LOG2, np.int32)
        self.seen = np.zeros(1 << CELLS_LOG2, np.int32)
        self.text = 0

    def cells(self, text: str | None) -> np.ndarray:
        self.text += 1
        text = (text or "").lower()
        found = []
        for at in range(0, len(text), CHUNK):
            codes = np.frombuffer(text[at : at + CHUNK + max(ORDERS) - 1].encode("utf-32-le", "replace"), np.uint32)
            rolled = codes
            for n in range(2, max(ORDERS) + 1):
                if len(rolled) < 2:
                    break
                rolled = rolled[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
                if n in ORDERS:
                    cells = rolled ^ (rolled >> np.uint32(15))
                    cells *= np.uint32(0x2C1B3C6D + 2 * n)
                    cells >>= np.uint32(32 - CELLS_LOG2)
                    places = np.arange(len(cells), dtype=np.int32)
                    self.stamp[cells] = places
                    cells = cells[(self.stamp[cells] == places) & (self.seen[cells] != self.text)]
                    self.seen[cells] = self.text
                    found.append(cells)
        return np.concatenate(found) if found else np.zeros(0, np.uint32)


def labelled(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> DataFrame:
    """``[_text, _label, _shift]`` of the sample; ``_shift`` is what the drawing by label adds to the log odds.

    The list of ids is bounded, so it is broadcast.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
    known = known.filter(F.col("_id").isNotNull() & F.col("_label").isNotNull()).groupBy("_id").agg((F.max("_label") > 0).cast("int").alias("_label"))
    known = cut_lineage(known)
    order = [F.xxhash64("_id"), F.col("_id")]
    sizes = dict(known.groupBy("_label").count().collect())
    toxic = min(sizes.get(1, 0), max(rows // 2, rows - sizes.get(0, 0)))
    chosen = known.filter("_label = 1").orderBy(*order).limit(toxic).unionByName(known.filter("_label = 0").orderBy(*order).limit(rows - toxic))
    rows_of = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    held = cut_lineage(rows_of.join(F.broadcast(chosen), "_id"))
    # at most ``rows`` ids: texts are taken in hash order while the characters last, half of them for either label
    lengths = held.select("_label", F.xxhash64("_id").alias("h"), F.coalesce(F.length("_text"), F.lit(0)).alias("n")).orderBy("h").toPandas()
    lengths["sum"] = lengths.groupby("_label")["n"].cumsum()
    cuts = lengths[lengths["sum"] > chars // 2].groupby("_label")["h"].min() if lengths["n"].sum() > chars else {}
    for value in (0, 1):
        if value in cuts:
            held = held.filter((F.col("_label") != value) | (F.xxhash64("_id") < int(cuts[value])))
    found = dict(held.groupBy("_label").count().collect())
    shift = 0.0
    if len(found) == 2 and len(sizes) == 2:
        shift = float(np.log(sizes[1] / sizes[0]) - np.log(found[1] / found[0]))
    return held.select("_text", "_label", F.lit(shift).alias("_shift"))


def fit(samples: DataFrame) -> Model:
    """Ratios from the counts of all samples, then weights from their cells."""

    def count(batches):
        features = Features()
        sums = np.zeros((2, 1 << CELLS_LOG2), np.int64)
        sizes = np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(batch.column("_text"), batch.column("_label").to_pylist()):
                sums[int(label > 0)][features.cells(text.as_py())] += 1
                sizes[int(label > 0)] += 1
        cells = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cells, -1), pa.int32()), pa.array(np.append(sums[0][cells], sizes[0])), pa.array(np.append(sums[1][cells], sizes[1]))],
            ["cell", "others", "toxic"],
        )

    counts = samples.mapInArrow(count, "cell int, others long, toxic long")
    counts = counts.groupBy("cell").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic")).toPandas()  # 2**20 rows at most
    sizes = counts[counts["cell"] == -1][["others", "toxic"]].sum().to_numpy(float)
    weights = np.zeros(1 << CELLS_LOG2, np.float32)
    if not sizes.all():
        return Model(weights, 0.0, False)
    held = counts[counts["cell"] >= 0]
    prior = PRIOR * sizes / sizes.sum()
    shares = [(held[name].to_numpy(float) + prior[k]) / (sizes[k] + 2 * prior[k]) for k, name in enumerate(("others", "toxic"))]
    ratio = np.zeros((1 << CELLS_LOG2) + 1, np.float32)  # the last cell stands for a text as such
    ratio[held["cell"].to_numpy()] = np.log(shares[1] / shares[0])
    ratio[np.abs(ratio) < LEAST_RATIO] = 0

    sent = samples.sparkSession.sparkContext.broadcast(ratio)  # 4 MB

    def gather(batches):
        features = Features()
        for batch in batches:
            found = [features.cells(text.as_py()) for text in batch.column("_text")]
            rows = [np.append(c[sent.value[c] != 0], np.uint32(1 << CELLS_LOG2)).astype(np.uint32).tobytes() for c in found]
            yield pa.RecordBatch.from_arrays([batch.column("_label"), pa.array(rows, pa.binary())], ["label", "cells"])

    shift = samples.first()["_shift"]
    rows = samples.mapInArrow(gather, "label int, cells binary").toPandas()  # FIT_ROWS texts of FIT_CHARS characters at most
    parts = [np.frombuffer(c, np.uint32) for c in rows["cells"]]
    lengths = np.array([len(c) for c in parts])
    fitted, base = _logistic(np.concatenate(parts), lengths, rows["label"].to_numpy() > 0, ratio)
    return Model(fitted, base + shift, True)


def _logistic(cells: np.ndarray, lengths: np.ndarray, target: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Full-batch Adam; the features of all texts lie end to end, and a pass takes the texts of about ``FIT_CELLS`` of them."""
    stops = np.cumsum(lengths)
    groups = np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(stops // FIT_CELLS)) + 1)
    spans = [(g, int(stops[g[0]] - lengths[g[0]]), int(stops[g[-1]])) for g in groups]
    weight, base = np.zeros(len(ratio)), float(np.log(target.mean() / (1 - target.mean())))
    m, v = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    error = np.zeros(len(target))
    for step in range(1, STEPS + 1):
        scaled, slope = (weight * ratio).astype(np.float32), np.zeros(len(ratio))
        for texts, begin, end in spans:
            here = cells[begin:end]
            logit = np.add.reduceat(scaled[here], stops[texts] - lengths[texts] - begin, dtype=np.float64) + base
            error[texts] = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target[texts]) / len(target)
            slope += np.bincount(here, np.repeat(error[texts], lengths[texts]), len(ratio))
        slope = np.append(slope * ratio + PENALTY * weight, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        move = 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weight, base = weight - move[:-1], base - move[-1]
    return (weight * ratio)[:-1].astype(np.float32), base


def score(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``[_row, score]``: every input row as a struct with its score between 0 and 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model.weights)  # 4 MB
    base, known = model.base, model.known
    rows, at, kind = carried(docs, text_column)

    def run(batches):
        features = Features()
        for batch in batches:
            sums = [float(sent.value[features.cells(t.as_py())].sum(dtype=np.float64)) for t in text_in(batch, at)]
            scores = 1 / (1 + np.exp(-np.clip(np.array(sums) + base, -30, 30))) if known else np.zeros(len(sums))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(scores, pa.float64())], ["_row", "score"])

    return rows.mapInArrow(run, f"_row {kind}, score double")


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Labelled samples outside the held-out fold."""
    return cut_lineage(labelled(docs, labels.filter(fold("doc_id", folds) != 0)))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below one half, with their columns."""
    return score(docs, fit(training_rows(docs, labels))).filter("score < 0.5").select("_row.*")
