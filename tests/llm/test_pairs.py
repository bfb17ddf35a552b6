from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sightline.llm import cap_filters, jaccard_join
from sightline.llm.components import components
from tests.llm.helpers import ODD_TEXTS, documents, shingles, smallest_reachable


def near_copies(seed=3, groups=12, copies=6, words=60):
    random = Random(seed)
    word = lambda: random.choice("abcdefgh") + str(random.randrange(400))
    texts = []
    for g in range(groups):
        base = [word() for _ in range(words)]
        for c in range(copies):
            own = list(base)
            for _ in range(random.randrange(4)):
                own[random.randrange(words)] = word()
            texts.append(" ".join(own).upper() if c == 1 else " ".join(own))
    passage = " ".join(word() for _ in range(30))
    texts += [passage + " " + " ".join(word() for _ in range(40)) for _ in range(25)]
    return texts


def brute(texts, words, percent):
    sets = [shingles(t, words) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return sets, smallest_reachable(range(len(texts)), links)


@pytest.mark.parametrize("words, percent, blocks", [(4, 85, (4096, 256)), (5, 80, (5, 3)), (4, 85, (3, 2))])
def test_components_equal_brute_force(spark, words, percent, blocks):
    texts = [*near_copies(), *ODD_TEXTS]
    rows = jaccard_join.link(documents(spark, texts), words, percent, *blocks).collect()
    sets, want = brute(texts, words, percent)
    assert len(rows) == len(texts)
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in enumerate(sets)}
    assert {r.doc_id: r.component_id for r in rows} == want


def test_repeated_and_null_ids(spark):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (2, "A b c d e"), (5, "q r s t u"), (9, "q r s t u"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(
        ((r.doc_id, r.component_id, r.n_shingles) for r in jaccard_join.link(docs).collect()),
        key=lambda r: (r[0] is None, r),
    )
    assert got == [(1, 1, 0), (2, 2, 2), *[(5, 2, 2)] * 3, (9, 2, 2), (None, None, 2)]
    assert jaccard_join.link(docs.limit(0)).count() == 0


def test_signature_tree_loses_no_pair():
    random = np.random.default_rng(4)
    base = random.integers(0, 1 << 60, 400, dtype=np.uint64)
    sets = []
    for _ in range(150):
        own = base[random.random(400) < 0.97]
        sets.append(np.unique(np.concatenate([own, random.integers(0, 1 << 60, random.integers(0, 80), dtype=np.uint64)])))
    sets += [np.unique(random.integers(0, 1 << 60, random.integers(1, 900), dtype=np.uint64)) for _ in range(150)]
    sizes = np.array([len(s) for s in sets])
    pairs = jaccard_join.candidate_pairs(sizes, [jaccard_join.signature(s) for s in sets], 85)
    found = {frozenset((int(i), int(j))) for p, q in pairs for i, j in zip(p, q)}
    linked = 0
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (sizes[i] + sizes[j] - both):
                linked += 1
                assert frozenset((i, j)) in found
    assert linked and len(found) < 0.3 * len(sets) ** 2 / 2


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (200, 201)]
    edges = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    nodes = {n for e in links for n in e}
    want = smallest_reachable(nodes, links)
    assert got == {n: want[n] for n in nodes}
    assert components(edges.limit(0)).count() == 0


def vectors(seed=0, groups=40, copies=8, dim=64):
    random = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        x = random.standard_normal(dim)
        x /= np.linalg.norm(x)
        for cos in [1.0, 1.0, *random.uniform(0.91, 0.96, copies)]:
            e = random.standard_normal(dim)
            e -= e @ x * x
            e /= np.linalg.norm(e)
            out.append((g % 3, [float(v) for v in 2.5 * (cos * x + np.sqrt(max(0, 1 - cos * cos)) * e)]))
    return out


@pytest.mark.parametrize("block", [2048, 4])
def test_vector_links_equal_brute_force(spark, block):
    rows = vectors()
    odd = [(None, rows[0][1]), (0, None), (0, [0.0] * 64), (0, [float("nan")] * 64), (0, []), (0, [1.0, 2.0]), (0, [2.0, 4.0]), (0, [None] * 64)]
    data = [(i, label, x, 1, 2) for i, (label, x) in enumerate([*rows, *odd])]
    table = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>, dim int, copies int")
    got = {r.vec_id: r for r in cap_filters.near_duplicates(table, block=block).collect()}
    assert len(got) == len(data)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([k for k, _ in rows])
    near = (x @ x.T >= cap_filters.THRESHOLD) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    found = sum(got[i].n_links for i in range(len(rows)))
    assert all(got[i].n_links <= near[i].sum() for i in range(len(rows)))
    assert found >= 0.99 * near.sum()
    want = smallest_reachable(range(len(rows)), zip(*np.nonzero(near)))
    assert np.mean([got[i].component_id == want[i] for i in range(len(rows))]) >= 0.99
    n = len(rows)
    assert got[n + 5].component_id == got[n + 6].component_id == n + 5 and got[n + 5].n_links == 1
    for k in (0, 1, 2, 3, 4, 7):
        assert (got[n + k].n_links, got[n + k].component_id, got[n + k].kept) == (0, n + k, True)


def test_repeated_vectors(spark):
    data = [(4, 1, [1.0, 0.0]), (4, 1, [1.0, 0.0]), (3, 1, [1.0, 0.0]), (None, 1, [1.0, 0.0])]
    table = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
    rows = cap_filters.near_duplicates(table).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in rows if r.vec_id) == [(3, 2, 3), (4, 2, 3), (4, 2, 3)]
    assert cap_filters.near_duplicates(table.limit(0)).count() == 0


def test_recall_at_the_threshold():
    random = np.random.default_rng(5)
    x = random.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e = random.standard_normal(x.shape)
    e -= (e * x).sum(axis=1, keepdims=True) * x
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * e
    for n in (1000, 100_000):
        code = cap_filters.plan_code(n)
        shared = [set(a) & set(b) for a, b in zip(cap_filters.decode(x, *code), cap_filters.decode(y, *code))]
        assert np.mean([bool(s) for s in shared]) >= 0.99


def test_stages_keep_clean_documents(spark, tmp_path):
    prose = lambda i: " ".join(f"word{(i * 7919 + k * 104729) % 100003}" for k in range(70))
    texts = [prose(i) for i in range(30)] + [prose(0), prose(1) + " end", None, "", prose(40) + " token=abcdef99"]
    docs = documents(spark, texts).drop("n_words")
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        seen[name] = {r.doc_id: r.text for r in now.collect()}
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    assert set(seen["quality_rules"]) == {*range(32), 34}
    assert set(seen["jaccard_join"]) == {*range(30), 34}
    assert seen["secret_scan"][34].endswith("[REDACTED]")
    assert set(seen["mixing"]) == set(seen["jaccard_join"])
    packed = corpus_pipeline.run(spark, str(tmp_path))
    ids = packed.select(F.explode("doc_ids").alias("d")).distinct()
    assert {r.d for r in ids.collect()} == set(seen["mixing"])


def test_unlike_texts_of_one_id_stay_in_the_pipeline(spark):
    words = lambda c: " ".join(f"{c}{k}" for k in range(60))
    rows = [
        (1, words("a"), "s"),
        (1, words("b"), "s"),
        (1, words("b"), "s"),
        (1, words("b"), "other"),
        (2, words("b") + " end", "s"),
        (3, words("c"), "s"),
        (4, words("c"), "s"),
        (None, words("c"), "s"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for ids, want in ((docs, [(1, "a0"), (1, "b0"), (3, "c0")]), (docs.filter("doc_id > 1"), [(2, "b0"), (3, "c0")])):
        kept = corpus_pipeline.near_duplicates(spark, ids, "")
        assert kept.schema == docs.schema
        found = [(r.doc_id, r.text.split()[0]) for r in kept.collect()]
        assert sorted(x for x in found if x[0]) == want
        assert found.count((None, "c0")) == ids.filter("doc_id is null").count()
