"""The registered queries over the smallest tables, against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from check_parity import compare
from sightline.llm import tokens
from tests.llm.helpers import WORD, repeated_words, shingles, smallest_reachable

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)


def crc_fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: queries()[name](spark, SF).collect()


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda text, end: np.array(
        tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4"
    )


def test_op1(run, docs):
    rows = run("op1_language_id")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (crc_fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert np.mean(held) >= 0.95


def test_op2(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    name = "op2_license_scan"
    assert compare(spark, con, queries()[name], oracle_sql()[name], SF) == []


def test_op3(run, docs):
    rows = run("op3_mixing")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    words, used, weight, most = Counter(), Counter(), {}, Counter()
    for r in rows:
        assert r.n_tokens == len(WORD.findall(docs[r.doc_id].text or ""))
        words[r.source] += r.n_tokens
        used[r.source] += r.n_tokens * r.copies
        weight[r.source] = r.weight
        most[r.source] = max(most[r.source], r.n_tokens)
        assert 0 <= r.copies <= 4
    total = sum(words.values())
    assert abs(sum(weight.values()) - 1) < 1e-9
    for s in words:
        wanted = min(weight[s] * total, 4 * words[s])
        assert wanted - most[s] <= used[s] <= wanted + 1


def test_op4(run, docs):
    rows = run("op4_secret_scan")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        text = docs[r.doc_id].text or ""
        found = [
            [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6],
            [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
            [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24],
        ]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(len, found))
        names = ("assign", "access", "hex")
        plain = [f"{names[k]}:{a}:{b}" for a, k, b in sorted(sum(found, []))]
        assert r.base_sha256 == hashlib.sha256(",".join(plain).encode()).hexdigest()
        assert set(plain) <= set(r.spans.split(",")) | {""}


def test_op5(run, docs):
    rows = run("op5_quality_rules")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        text = docs[r.doc_id].text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        counts = (len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")))
        counts += (len(lines) - len(set(lines)), repeated_words(text))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_op6(spark, run):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in table], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r.label for r in table])
    near = (x @ x.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    want = {r.vec_id: int(n) for r, n in zip(table, near.sum(axis=1))}
    rows = run("op6_cap_filters")
    assert {r.vec_id: r.n_links for r in rows} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_op7(run, docs):
    rows = run("op7_toxicity")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (crc_fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_op8(run, docs, ids_of):
    rows = {r.doc_id: r for r in run("op8_token_files")}
    start = 0
    for doc_id in sorted(docs):
        ids = ids_of(docs[doc_id].text, 2)
        r = rows.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not rows


def test_op9(run, docs):
    rows = run("op9_jaccard_join")
    sets = {d: shingles(r.text, 4) for d, r in docs.items()}
    assert {r.doc_id: r.n_shingles for r in rows} == {d: len(s) for d, s in sets.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    assert {r.doc_id: r.component_id for r in rows} == smallest_reachable(sets, links)


def test_op10(run, docs, ids_of):
    spans, sequences = defaultdict(list), defaultdict(list)
    for r in run("op10_packing"):
        ids = ids_of(docs[r.doc_id].text, 1)
        own = ids[r.start : r.start + r.length]
        assert len(own) == r.length and r.doc_tokens == len(ids)
        assert zlib.crc32(own.tobytes()) == r.ids_crc32
        spans[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in [*spans.values(), *sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
    assert {d: sum(n for _, n in p) for d, p in spans.items()} == {
        d: len(ids_of(r.text, 1)) for d, r in docs.items()
    }
    sizes = [sum(n for _, n in p) for p in sequences.values()]
    assert all(n == 2048 or n < 2048 and not n & (n - 1) for n in sizes)


def test_pipeline(run, docs):
    rows = run("pipeline")
    found = {d for r in rows for d in r.doc_ids}
    assert found and found <= set(docs)
    assert all(r.n_tokens <= 2048 and len(r.ids) == 4 * r.n_tokens for r in rows)
