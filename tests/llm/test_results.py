"""Learned operators against plain versions of their methods, and held-out quality."""

import math

import numpy as np
import pyarrow as pa
import pytest

from __spark_entry__ import queries
from pyspark.sql import functions as F
from sightline.llm import language_id, quality_rules, secret_scan, toxicity
from sightline.llm.text import fold
from tests.llm.helpers import WORD, documents

SF = "/root/testdata/sf0.01"


# ---- language identification: plain expectation-maximisation ----------------------------------


def plain_mixture(model, text):
    """Proportions of the languages of one text, by one word after the other."""
    langs = len(model.langs)
    words = []
    for w in WORD.findall(text or ""):
        gram, _ = language_id.trigrams([w])
        if len(gram):
            fit = [sum(model.log_p[g, k] for g in gram) for k in range(langs)]
            words.append([math.exp(max(x - max(fit), -60.0)) for x in fit])
    if not words:
        return None

    def maximise(pi, rounds):
        for _ in range(rounds):
            parts = [[p * s for p, s in zip(w, pi)] for w in words]
            pi = [sum(w[k] / sum(w) for w in parts) / len(words) for k in range(langs)]
        return pi, sum(math.log(sum(p * s for p, s in zip(w, pi))) for w in words)

    cost = language_id.PENALTY * math.log(len(words) + 1.0)
    alone = [sum(math.log(w[k]) for w in words) for k in range(langs)]
    score = max(alone)
    best = [float(k == alone.index(score)) for k in range(langs)]
    pi, fit = maximise([1 / langs] * langs, language_id.ROUNDS)
    for size in range(langs, 1, -1):
        if fit - (size - 1) * cost > score:
            score, best = fit - (size - 1) * cost, pi
        if size == 2 or fit - cost <= score:
            break
        least = min((s, k) for k, s in enumerate(pi) if s > 0)[1]
        rest = [0.0 if k == least else s for k, s in enumerate(pi)]
        pi, fit = maximise([s / sum(rest) for s in rest], language_id.ROUNDS // 2)
    return best


def test_mixtures_equal_plain_expectation_maximisation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.learn(docs, fold(F.col("doc_id"), 5) != 0)
    texts = [r.text for r in docs.orderBy("doc_id").limit(60).collect()]
    short = [t[:400] for t in texts if t]
    mixed = [a + " " + b for a, b in zip(short[::2], short[1::2])]
    checked = [*short, *mixed, "", "12 !!", "the"]
    best, shares = language_id.infer(model, pa.array(checked))
    assert sum((row > 0).sum() > 1 for row in shares) > 3
    for text, own, row in zip(checked, best, shares):
        want = plain_mixture(model, text)
        if want is None:
            assert own == -1
        else:
            assert np.abs(row - want).max() < 1e-6


def test_long_texts_of_language_and_toxicity(spark):
    model = language_id.learn(documents(spark, ["the house and garden"] * 9 + ["a"]), F.lit(True))
    docs = documents(spark, ["the house and the garden " * 200_000, None, ""])
    assert [r.lang_pred for r in language_id.identify(docs, model).orderBy("doc_id").collect()] == ["en", "und", "und"]
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    fitted = toxicity.learn(docs, labels, F.lit(True))
    assert toxicity.score(docs, fitted).count() == 3
    assert toxicity.score(docs.limit(0), fitted).collect() == []
    assert secret_scan.scan(docs).count() == 3


# ---- toxicity: plain FTRL-proximal --------------------------------------------------------------


def plain_ftrl(rows, labels, seed=5):
    """One coordinate after the other, in dictionaries."""
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2
    bias = 1 << toxicity.BITS
    prior = math.log((sum(labels) + 1) / (len(labels) - sum(labels) + 1))
    z, n = {}, {}

    def weight(k):
        own = z.get(k, 0.0)
        shrink = 0.0 if k == bias else l1
        if abs(own) <= shrink:
            return 0.0
        return (math.copysign(shrink, own) - own) / ((b + math.sqrt(n.get(k, 0.0))) / a + l2)

    order = np.random.default_rng(seed)
    for _ in range(toxicity.EPOCHS):
        for i in order.permutation(len(rows)):
            w = {k: weight(k) for k in rows[i].tolist()}
            g = 1 / (1 + math.exp(-min(35, max(-35, prior + sum(w.values()))))) - labels[i]
            for k in w:
                old = n.get(k, 0.0)
                step = (math.sqrt(old + g * g) - math.sqrt(old)) / a
                z[k] = z.get(k, 0.0) + g - step * w[k]
                n[k] = old + g * g
    return {k: w for k in z if k != bias and (w := weight(k))}, prior + weight(bias)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_weights_equal_plain_ftrl(seed):
    rng = np.random.default_rng(seed)
    bias = 1 << toxicity.BITS
    rows = [np.append(np.unique(rng.integers(0, 200, 15)), bias) for _ in range(250)]
    labels = np.array([float(5 in r or rng.random() < 0.05) for r in rows])
    weights, shift = toxicity.fit_ftrl(rows, labels)
    want, want_shift = plain_ftrl(rows, labels.tolist())
    assert abs(shift - want_shift) < 1e-9 and want
    assert set(np.flatnonzero(weights).tolist()) == set(want)
    assert all(abs(weights[k] - w) < 1e-9 for k, w in want.items())


def test_held_out_toxicity(spark):
    rows = {r.doc_id: r for r in queries()["op7_toxicity"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("toxic is not null").collect()
    held = [(r.toxic, rows[r.doc_id].predicted) for r in labels if rows[r.doc_id].held_out]
    toxic, clean = [p for t, p in held if t == 1], [p for t, p in held if t == 0]
    assert len(toxic) >= 10 and len(clean) >= 50
    assert np.mean(toxic) >= 0.5 and np.mean(clean) <= 0.02


# ---- quality rules: rows whose labels the rules have not seen -------------------------------------


def test_held_out_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality is not null")
    stats = quality_rules.statistics(docs).select("doc_id", "__q.*")
    seen = labels.filter(fold(F.col("doc_id"), 3) != 0)
    judged = quality_rules.judge(stats, quality_rules.learn(stats, seen))
    held = judged.join(labels.filter(fold(F.col("doc_id"), 3) == 0), "doc_id").filter("not base_failed")
    got = {(r.quality, r.kept): r["count"] for r in held.groupBy("quality", "kept").count().collect()}
    bad, good = got.get((0, False), 0) + got.get((0, True), 0), got.get((1, False), 0) + got.get((1, True), 0)
    assert bad >= 5 and got.get((0, False), 0) / bad >= 0.7
    assert got.get((1, False), 0) / good <= 0.02
