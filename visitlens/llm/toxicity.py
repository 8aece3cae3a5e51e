"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, also cut to their first ``STEM`` bytes, pairs of neighbours and pairs
one word apart, lower-cased and hashed to ``1 << BITS`` places; each counts once per text. Training goes over
a bounded sample of labelled texts, ``sample`` rows of lowest hash and of these as many as have
``PLACES`` features together. Texts are turned into places where they are read, and only places go on, one row per
document. Every coordinate has its own rate, and L1 keeps most weights at zero; places of one text alone are left out.

One task fits the model of all rows, and two more those of either half, which score the other half. The bias is
moved to where these scores part the labels best (the highest F1), so that a score of one half
is the best cut, whatever the share of toxic texts. The model is the list of weights that are not zero, at
most one per place, and is sent to the tasks that score. Scoring reads each whole text once
and shuffles nothing.

Null and empty texts, and texts without words, have the score of the bias alone. Labelled
rows without a text, a label or an id teach nothing; an id labelled twice counts as toxic if
one of its labels does; of an id's texts, that of the lowest hash teaches. Without labelled rows every score is
0.5. Repeated documents score alike. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import blocks, stored
from visitlens.llm.decontaminate import _APART, _LOWER
from visitlens.llm.hashing import FACTOR, _word_hashes, mixed, words

BITS = 20
STEM = 6
SAMPLE_ROWS = 20_000
#: Features of all training texts together; a training task holds four bytes for each.
PLACES = 40_000_000
EPOCHS = 6
SEED = 11


class Rates(NamedTuple):
    """Constants of the update: step size, its smoothing, and the two penalties."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.01


class Model(NamedTuple):
    """Places with a weight, their weights, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float


def features(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text and the hashed place of every word, stem, neighbour pair and skip pair of a block."""
    lower = _LOWER[data]
    first, end, hashes, counts = words(lower, starts, _APART)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(counts))
    long = end - first > STEM
    stems = mixed(_word_hashes(lower, first[long], first[long] + STEM) + np.uint64(STEM))
    texts, found = [text, text[long]], [hashes, stems]
    for gap in (1, 2):
        if len(hashes) > gap:
            one = text[gap:] == text[:-gap]
            pair = mixed(hashes[:-gap] * np.uint64(FACTOR) + hashes[gap:] + np.uint64(gap))
            texts.append(text[gap:][one])
            found.append(pair[one])
    return np.concatenate(texts), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def fit(texts: list[np.ndarray], labels: np.ndarray, rates: Rates = Rates(), epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over texts given by their distinct places, in order, ``epochs`` times."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        own, seen = z[at], np.sqrt(n[at])
        # The last coordinate is the bias, without penalty.
        least = np.where(at == size, 0.0, rates.l1)
        shrunk = np.sign(own) * np.maximum(np.abs(own) - least, 0)
        return -shrunk / ((rates.beta + seen) / rates.alpha + rates.l2)

    for _ in range(epochs):
        for own, label in zip(texts, labels):
            at = np.append(own, size)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            before = n[at]
            n[at] = before + gradient * gradient
            z[at] += gradient - (np.sqrt(n[at]) - np.sqrt(before)) / rates.alpha * w
    every = weights(np.arange(size + 1))
    places = np.flatnonzero(every[:size])
    return Model(places, every[places].astype(np.float32), float(every[size]))


def shift(margins: np.ndarray, labels: np.ndarray) -> float:
    """Where a cut of margins has the highest F1, the one nearest 0 of equals; 0 without labels of both kinds."""
    if not 0 < labels.sum() < len(labels):
        return 0.0
    order = np.argsort(-margins, kind="stable")
    own = margins[order]
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(own) + 1) + hits[-1])
    below = np.r_[own[1:], own[-1] - 1]
    # Only between unlike margins can a cut be.
    best = np.flatnonzero((f1 >= f1[own > below].max() - 1e-9) & (own > below))
    cuts = (own[best] + below[best]) / 2
    return float(cuts[np.argmin(np.abs(cuts))])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS, most: int = PLACES) -> DataFrame:
    """doc_id, ``place`` (the order of training), ``label`` and ``features``, distinct places in order as
    32-bit numbers, of the sample."""
    known = labels.filter("doc_id is not null and label is not null").groupBy("doc_id")
    chosen = (
        known.agg(F.max("label").cast("int").alias("label"))
        .withColumn("place", F.xxhash64("doc_id", F.lit(SEED)))
        .orderBy("place", "doc_id")
        .limit(sample)
    )
    texts = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, starts in blocks(batch, "text"):
                of, place = features(data, starts)
                once = np.unique(of << BITS | place)
                ends = np.searchsorted(once, np.arange(end - first + 1) << BITS)
                listed = (once & ((1 << BITS) - 1)).astype(np.int32)
                found = pa.array([listed[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], found], names=["doc_id", "label", "place", "h", "features"])

    given = texts.select("doc_id", "label", "place", F.md5("text").alias("h"), "text")
    kinds = {field.name: field.dataType.simpleString() for field in given.schema}
    schema = f"doc_id {kinds['doc_id']}, label int, place long, h string, features binary"
    one_text = F.min(F.struct("h", "label", "place", "features")).alias("row")
    rows = stored(given.mapInArrow(run, schema).groupBy("doc_id").agg(one_text).select("doc_id", "row.*").drop("h"))
    # Of at most ``sample`` rows, without their features.
    before = F.sum("n").over(Window.orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    sized = rows.select("doc_id", "place", F.expr("length(features) div 4").alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    kept = sized.filter((F.col("before") + F.col("n") <= most) | (F.col("before") == 0))
    return rows.join(F.broadcast(kept.select("doc_id")), "doc_id", "left_semi")


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS, rates: Rates = Rates(), epochs: int = EPOCHS
) -> Model:
    """The model of ``docs`` (doc_id, text) with one of ``labels`` (doc_id, label 0 or 1)."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "doc_id"], kind="stable")
        found, own = [np.frombuffer(x, np.int32) for x in rows.features], rows.label.to_numpy()
        seen = sum((np.bincount(x, minlength=1 << BITS) for x in found[1:]), np.bincount(found[0], minlength=1 << BITS))
        found = [x[seen[x] > 1] for x in found]
        # Part 2 is of all rows; parts 0 and 1 learn from one half and score the other.
        half = rows.half.to_numpy()
        learn = np.flatnonzero((half == key[0]) | (key[0] == 2))
        model = fit([found[i] for i in learn], own[learn], rates, epochs)
        if key[0] == 2:
            weights = np.append(model.weights.astype(float), model.bias)
            return pd.DataFrame({"part": 2, "place": np.append(model.places, -1), "value": weights})
        every = np.zeros(1 << BITS)
        every[model.places] = model.weights
        other = np.flatnonzero(half != key[0])
        margins = [every[found[i]].sum() + model.bias for i in other]
        return pd.DataFrame({"part": key[0], "place": own[other], "value": margins})

    rows = training_rows(docs, labels, sample).withColumn("half", F.expr("pmod(place, 2)"))
    parted = rows.withColumn("part", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    made = parted.groupBy("part").applyInPandas(run, "part int, place long, value double").toPandas()
    halves, own = made[made.part < 2], made[(made.part == 2) & (made.place >= 0)].sort_values("place")
    bias = float(made.value[made.place < 0].sum())
    cut = shift(halves.value.to_numpy(), halves.place.to_numpy())
    return Model(own.place.to_numpy(np.int64), own.value.to_numpy(np.float32), bias - cut)


def scored(docs: DataFrame, model: Model, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id and ``score``, the likelihood of label 1, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS, np.float32)
        weights[model.places] = model.weights
        for batch in batches:
            found = np.empty(batch.num_rows)
            for first, end, data, starts in blocks(batch, "text"):
                of, place = features(data, starts)
                some = weights[place] != 0
                once = np.unique(of[some] << BITS | place[some])
                sums = np.bincount(once >> BITS, weights=weights[once & ((1 << BITS) - 1)], minlength=end - first)
                found[first:end] = 1 / (1 + np.exp(-np.clip(sums + model.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "score"])

    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str) -> str:
    """SQL: whether a document's label is kept from training."""
    return f"coalesce(crc32(cast({doc_id} as string)) % 5 = 0, false)"


def train_on_labels(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Model:
    """The model of the documents with a ``toxic`` label that are not held out."""
    known = labels.filter(f"not {held_out('doc_id')}").selectExpr("doc_id", "toxic as label")
    return train(docs, known, sample)
