import zlib
from collections import defaultdict
from random import Random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sightline.llm import packing, token_files, tokens
from tests.llm.helpers import ODD_TEXTS, documents


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda t, end: tokenizer.encode(t or "", add_special_tokens=False).ids + [end]


def test_word_by_word_equals_whole_text(plain):
    encode = tokens.Encoder(tokens.default_path()).encode
    shouted = [t and t.upper() for t in ODD_TEXTS]
    for texts in (shouted, ODD_TEXTS, ODD_TEXTS[::-1], [], [None]):
        ids, cuts = encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
        assert got == [plain(t, 0)[:-1] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_any_text(plain, texts):
    ids, cuts = tokens.Encoder(tokens.default_path()).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [plain(t, 0)[:-1] for t in texts]


def test_memo_finds_what_it_was_given():
    memo = tokens.Memo()
    words = [f"w{i}" for i in range(1000)]
    for start in range(0, 1000, 90):
        part = words[start : start + 90]
        counts = np.array([1 + int(w[1:]) % 3 for w in part])
        memo.add(memo.keys(part), counts, np.repeat([int(w[1:]) for w in part], counts).astype(np.uint32))
    starts, counts = memo.find(memo.keys([*words, "other"]))
    assert starts[-1] == -1 and memo.size == 1000
    for i in range(1000):
        assert memo.ids[starts[i] : starts[i] + counts[i]].tolist() == [i] * (1 + i % 3)


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
def test_bit_planes_round_trip(n):
    for top in (1, 2, 49_408, 1 << 32):
        ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
        planes = token_files.open_planes(token_files.shuffle_bits(ids), n)
        for a, b in ((0, n), (0, n // 2), (n // 3, n), (n // 3, n // 2), (n, n)):
            assert (token_files.unshuffle_bits(planes, a, b) == ids[a:b]).all()


def test_token_files_hold_all_ids_in_order(spark, plain, tmp_path):
    docs = documents(spark, ODD_TEXTS)
    chunks = token_files.write_token_files(docs, str(tmp_path / "t"))
    rows = sorted(token_files.read_token_files(chunks).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == list(range(len(ODD_TEXTS)))
    start = 0
    for r, text in zip(rows, ODD_TEXTS):
        want = plain(text, 2)
        assert (r.start, r.n_tokens) == (start, len(want))
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        start += len(want)


def test_documents_longer_than_a_chunk(spark, tmp_path):
    size = token_files.CHUNK_IDS
    docs = documents(spark, ["a b c", "x " * (2 * size + 5), None, "d"])
    chunks = token_files.write_token_files(docs, str(tmp_path / "t"))
    rows = sorted(token_files.read_token_files(chunks).collect(), key=lambda r: r.start)
    assert [r.n_tokens for r in rows] == [4, 2 * size + 6, 1, 2]
    assert len(set(np.frombuffer(rows[1].ids, "<u4")[:-1])) == 1


def test_null_and_repeated_ids(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a"), (None, "b"), (3, "c"), (3, "c"), (3, None)], "doc_id long, text string")
    rows = token_files.read_token_files(token_files.write_token_files(docs, str(tmp_path / "t"))).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 3, 3, 3]
    assert [r.start for r in rows] == [0, 2, 4, 5, 7]


def test_empty_table(spark, tmp_path):
    docs = documents(spark, [])
    assert token_files.read_token_files(token_files.write_token_files(docs, str(tmp_path / "t"))).count() == 0
    assert packing.pieces_of(packing.pack_documents(docs)).count() == 0


def piece(k, n):
    return packing.Piece(k, 0, np.arange(n, dtype=np.uint32), n)


def test_pack_keeps_every_id_and_few_windows():
    random = Random(1)
    sizes = [random.choice([0, 1, 3, 7, 16, 40, 99]) for _ in range(500)]
    windows = list(packing.pack((piece(k, n) for k, n in enumerate(sizes)), 16, 4))
    assert all(packing.size(w) == 16 for w in windows[:-1])
    seen = defaultdict(list)
    for w in windows:
        for p in w:
            assert p.ids[0] == p.start
            seen[p.doc_id] += p.ids.tolist()
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in enumerate(sizes) if n}


def test_powers_of_two():
    parts = list(packing.powers_of_two([piece(0, 5), piece(1, 6)]))
    assert [packing.size(p) for p in parts] == [8, 2, 1]


def test_packed_documents(spark, plain):
    texts = [*ODD_TEXTS, *("some words " * k for k in range(40))]
    docs = documents(spark, texts).repartition(5)
    rows = packing.pieces_of(packing.pack_documents(docs, length=64, most=3)).collect()
    spans, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = plain(texts[r.doc_id], 1)
        assert r.doc_tokens == len(ids)
        own = np.array(ids[r.start : r.start + r.length], "<u4")
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32
        spans[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    for found, totals in ((spans, [len(plain(t, 1)) for t in texts]), (windows, None)):
        for k, parts in found.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == totals[k] if totals else at <= 64 and (at == 64 or not at & (at - 1))
    assert set(spans) == set(range(len(texts)))
