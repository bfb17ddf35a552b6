"""Toxicity scores: logistic regression over hashed word n-grams and skip-grams, by FTRL-proximal.

Features of a text are its distinct words, pairs of neighbouring words and pairs of words with
one word between them, hashed into `1 << BITS` places. Every place has its own learning rate, and
the L1 term keeps most weights at exactly zero, so the model is a short list of places and
weights. Words are lower-cased and stripped of punctuation at their ends.

Training is sequential by nature and runs in one task over a bounded sample (about `TRAIN_ROWS`
labelled rows, all if fewer). Scoring covers every whole text. Null
and empty texts get the score of the bias alone; rows without a usable label teach nothing; with
no labelled rows at all every score is 0. Rows labelled twice count as toxic if any label is. Repeated
rows are scored alike, a score at the threshold counts as toxic, and an empty table gives no rows. Columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import blocks, hash_words, hashed_sample, mix, row_of, words_of

BITS = 20
TRAIN_ROWS = 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 1.0
THRESHOLD = 0.3
ENDS = ".,;:!?\"'()[]{}<>*#$%&|-_~`"


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every feature, in text order and with repetitions."""
    codes, offsets, words = words_of(texts)
    bare = [w.lower().strip(ENDS) for w in words.to_pylist()]
    h = hash_words(bare, len(bare))[codes]
    row = row_of(offsets)
    tag = lambda k, n: np.full(n, k, np.uint64)
    rows, places = [row], [mix(tag(1, len(h)), h)]
    for gap in (1, 2):
        same = np.flatnonzero(row[gap:] == row[:-gap])
        rows.append(row[same])
        places.append(mix(tag(1 + gap, len(same)), h[same], h[same + gap]))
    place = np.concatenate(places) >> np.uint64(64 - BITS)
    return np.concatenate(rows), place.astype(np.int64)


def fit_ftrl(rows: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> tuple[np.ndarray, float]:
    """FTRL-proximal over sparse binary rows; the last place of the state is the bias, which is
    learned as a shift of the log-odds of the labels, so that unknown words leave a text at these."""
    size = (1 << BITS) + 1
    prior = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    z, n = np.zeros(size), np.zeros(size)
    order = np.random.default_rng(seed)

    def weights(at):
        w = np.sign(z[at]) * L1 - z[at]
        w /= (BETA + np.sqrt(n[at])) / ALPHA + L2
        w[np.abs(z[at]) <= L1] = 0
        bias = at == size - 1
        w[bias] = -z[at][bias] / ((BETA + np.sqrt(n[at][bias])) / ALPHA + L2)
        return w

    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(prior + w.sum(), -35, 35))) - labels[i]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(size))
    return w[:-1], float(prior + w[-1])


def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels = [], []
    for block in blocks(batches):
        row, place = features(block.column("text"))
        pair = np.unique(row * (1 << BITS) + place)
        cut = np.searchsorted(pair >> BITS, np.arange(len(block) + 1))
        place = pair & ((1 << BITS) - 1)
        place = place.astype(np.int32)
        rows += [np.append(place[a:b], np.int32(1 << BITS)) for a, b in zip(cut[:-1], cut[1:])]
        labels += block.column("toxic").to_pylist()
    if rows:
        w, bias = fit_ftrl(rows, np.array(labels, float))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(w[at], bias))], ["place", "weight"]
        )


@dataclass
class ToxicityModel:
    places: np.ndarray
    weights: np.ndarray
    bias: float


def learn(
    docs: DataFrame, labels: DataFrame, usable, train_rows: int = TRAIN_ROWS
) -> ToxicityModel:
    """Fit on about `train_rows` labelled rows out of the `usable` ones.

    The ids of the sample are broadcast (its size is the bound), so texts move only for the
    sample. The driver receives the non-zero weights, at most one for each place.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & usable)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sample = hashed_sample(known, "doc_id", train_rows)
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    got = (
        texts.join(F.broadcast(sample), "doc_id")
        .select("text", F.col("toxic").cast("int"), F.xxhash64("doc_id").alias("h"))
        .repartition(1)
        .sortWithinPartitions("h", "text")
        .mapInArrow(_train, "place long, weight double")
        .toArrow()
    )
    if not got.num_rows:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float("-inf"))
    place, w = got["place"].to_numpy(), got["weight"].to_numpy()
    return ToxicityModel(place[:-1], w[:-1], float(w[-1]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score between 0 and 1, predicted (1 from `THRESHOLD` on)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[model.places] = model.weights
        for block in blocks(batches):
            row, place = features(block.column("text"))
            used = dense[place] != 0
            pair = np.unique(row[used] * (1 << BITS) + place[used])
            total = np.bincount(
                pair >> BITS, dense[pair & ((1 << BITS) - 1)], minlength=len(block)
            )
            s = np.exp(-np.logaddexp(0, -(total + model.bias)))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(s),
                    pa.array((s >= THRESHOLD).astype(np.int32)),
                ],
                ["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int"
    )
