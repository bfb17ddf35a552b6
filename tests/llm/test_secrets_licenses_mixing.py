import math
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from __spark_entry__ import queries
from sightline.llm import license_scan, mixing, secret_scan
from sightline.llm.license_templates import TEMPLATES
from tests.llm.helpers import ODD_TEXTS, documents


def kinds(text):
    return sorted((k, text[a:b]) for a, b, k in secret_scan.scan_text(text))


@pytest.mark.parametrize(
    "text, found",
    [
        ('token = "abcdef1"', [("assign", 'token = "abcdef1')]),
        ("token: abc", []),
        ("API_KEY=ABCDEF", [("assign", "API_KEY=ABCDEF")]),
        ("x AKIA" + "A" * 16 + " y", [("access", "AKIA" + "A" * 16)]),
        ("AKIA123", []),
        ("a" * 24, [("hex", "a" * 24)]),
        ("toKen=secretsecret", [("assign", "toKen=secretsecret")]),
    ],
)
def test_base_spans(text, found):
    assert [x for x in kinds(text) if x[0] != "flow"] == found


def test_constants_are_followed():
    text = 'base = "Zx9-qqPl81mN"\nfull = base + "77aB"\ndb_password = full\nprint(base)'
    assert ("flow", "Zx9-qqPl81mN") in kinds(text)
    assert not [x for x in kinds(text.replace("db_password", "db_comment")) if x[0] == "flow"]


def test_configuration_syntax():
    assert ("flow", "hT7!kd8Pz0") in kinds('{"clientCredential": "hT7!kd8Pz0"}')
    assert ("flow", "Qm4xT9vB2kLp") in kinds("export AUTH_KEY=Qm4xT9vB2kLp")
    assert ("flow", "Qm4xT9vB2kLp") in kinds("signing.key: Qm4xT9vB2kLp")
    for harmless in ('key_name = "primary-4kR9"', "auth_key = changeme", "the key: it was good"):
        assert not [x for x in kinds(harmless) if x[0] == "flow"]


@pytest.mark.parametrize("hops", [4, 5, 40])
def test_constants_are_followed_through_any_number_of_names(hops):
    text = 'v0 = "Zx9-qqPl81mN"\n' + "".join(f"v{k + 1} = v{k}\n" for k in range(hops)) + f"api_secret_key = v{hops}"
    assert ("flow", "Zx9-qqPl81mN") in kinds(text)
    assert "Zx9" not in secret_scan.redact_text(text)


def test_self_reference_stays_small():
    text = 'a = "Zx9-qqPl81mN"\n' + "a = a + a + a\n" * 200 + "password_key = a"
    assert len(secret_scan.scan_text(text)) < 10


def test_rows_and_digest(spark):
    texts = [*ODD_TEXTS, 'ü token = "abcdef1" ' + "0123456789abcdef" * 2]
    rows = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan(documents(spark, texts))).collect()}
    assert len(rows) == len(texts)
    assert rows[0].spans == "" and rows[0].n_hex == 0
    last = rows[len(texts) - 1]
    assert last.spans == "assign:2:18,hex:20:52"
    assert (last.n_assign, last.n_hex, last.n_flow) == (1, 1, 0)


def test_redaction_keeps_the_rest(spark):
    docs = documents(spark, ["a token=abcdef9 b", None, "clean"])
    rows = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert rows[0].text == "a [REDACTED] b" and rows[0].n_chars == len(rows[0].text)
    assert rows[1].text is None and rows[2].text == "clean" and rows[2].copies == 99
    assert secret_scan.redact(docs).schema == docs.schema
    assert secret_scan.redact(docs.limit(0)).count() == 0


def test_license_texts_and_notices(spark):
    mit = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 200)
    texts = [
        f"prose of any kind\n{TEMPLATES[3][1]}\nmore prose",
        mit.upper(),
        f"Copyright 2020 A. Author\n\n{mit}\n\nend",
        "the license of the software is a matter of words " * 5,
        *ODD_TEXTS,
    ]
    rows = {r.doc_id: r for r in license_scan.scan(documents(spark, texts)).collect()}
    assert len(rows) == len(texts)
    assert rows[0].license == "Apache-2.0" and rows[0].dice == 1.0
    assert rows[1].license == "MIT" and rows[1].dice == 1.0
    assert rows[2].license == "MIT"
    assert all(rows[i].license is None and rows[i].licenses == "" for i in range(3, len(texts)))
    assert license_scan.scan(documents(spark, [])).count() == 0


def test_whole_licenses_and_plain_rights(spark):
    bodies = {n: max((t for m, t in TEMPLATES if m == n), key=len) for n, _ in TEMPLATES}
    owner = "Copyright (c) 2020, A. Author\n\n"
    texts = [
        "some prose\nAll rights reserved.",
        "All rights reserved worldwide",
        owner + bodies["BSD-2-Clause"],
        owner + bodies["BSD-3-Clause"],
        *(bodies[n] for n in ("GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "Apache-2.0", "MPL-2.0")),
        bodies["GPL-any-version"],
    ]
    rows = {r.doc_id: r for r in license_scan.scan(documents(spark, texts)).collect()}
    assert [rows[i].license for i in range(len(texts))] == [
        "All-Rights-Reserved", "All-Rights-Reserved", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0",
        "AGPL-3.0", "LGPL-3.0", "Apache-2.0", "MPL-2.0", "GPL-any-version",
    ]


def test_anchors_cannot_lose_a_match():
    words = set(license_scan.anchors())
    for _, text in TEMPLATES:
        grams = license_scan.bigrams(text)
        free = [g for g in grams if not words & set(g.split())]
        assert len(free) < license_scan.least_common(len(grams))


def sized(spark, sizes):
    """Documents of given numbers of words by source."""
    rows = [
        (k, " ".join(["w"] * n) + f" {k}" * 0, source)
        for k, (source, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


SIZES = {"big": [10] * 400, "mid": [7] * 90, "small": [5] * 40, None: [3] * 30}


def brute_entropy(shares, t):
    w = [p**t for p in shares]
    return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)


def test_weights_meet_entropy(spark):
    rows = mixing.items(sized(spark, SIZES))
    total = sum(map(sum, SIZES.values()))
    mix = mixing.plan(rows, target_entropy=0.9, repetition=None, budget=total)
    shares = [sum(v) / total for v in SIZES.values()]
    assert abs(brute_entropy(shares, mix.exponent) - 0.9 * math.log(4)) < 1e-6
    weights = {r.source: r.weight for r in mix.sources.collect()}
    assert abs(sum(weights.values()) - 1) < 1e-9
    used = defaultdict(int)
    for r in mixing.copies(rows, mix).collect():
        used[r.source] += r.copies * r.n_tokens
    for source, w in weights.items():
        most = max(SIZES[source or None])
        assert w * total - most < used[source] <= w * total + 1


def test_repetition_limit_and_whole_documents(spark):
    docs = sized(spark, SIZES)
    rows = mixing.items(docs)
    mix = mixing.plan(rows, target_entropy=1.0, repetition=2.0)
    copies = Counter(r.copies for r in mixing.copies(rows, mix).collect())
    assert set(copies) <= {1, 2} and sum(copies.values()) == docs.count()
    low = {r.source: r.epochs for r in mix.sources.collect()}
    assert low["big"] == 1


def test_emitted_schedule(spark):
    rows = mixing.items(sized(spark, SIZES))
    mix = mixing.plan(rows, target_entropy=1.0, repetition=3.0)
    out = mixing.emit(rows, mix).collect()
    assert len(out) == mixing.copies(rows, mix).agg(F.sum("copies")).first()[0]
    assert all(0 <= r.position <= 1 and r.block >= 0 for r in out)
    again = mixing.emit(rows.repartition(7), mix).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_every_block_has_each_source_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 2000)
    docs = sized(spark, {"cut": [10] * 1500, "kept": [10] * 400, "rare": [10] * 100, "empty": [0] * 3})
    rows = mixing.items(docs)
    # The large source is cut to a third; at 1.5 the rare one ends at its limit, before its budget.
    for repetition, budget in ((4.0, 20_000), (1.5, 20_000)):
        mix = mixing.plan(rows, target_entropy=1.0, repetition=repetition, budget=budget)
        out = mixing.emit(rows, mix).collect()
        whole = Counter(r.source for r in out if r.source != "empty")
        assert sum(r.source == "empty" for r in out) == 3
        for half in (0, 1):
            part = Counter(r.source for r in out if int(r.position * 2) == half)
            assert all(abs(part[s] / n - 0.5) < 0.15 for s, n in whole.items())
        blocks = Counter(r.block for r in out)
        assert len(blocks) == math.ceil(sum(r.quota for r in mix.sources.collect()) / 2000)
        assert min(blocks.values()) > 120 and max(blocks.values()) < 280
        epochs = Counter((r.doc_id, r.epoch) for r in out)
        assert set(epochs.values()) == {1}


def test_mixed_documents_lie_in_the_order_of_the_schedule(spark):
    docs = sized(spark, {"a": [10] * 300, "b": [10] * 150})
    wishes = {"target_entropy": 1.0, "repetition": 2.0}
    rows = mixing.items(docs)
    order = sorted(mixing.emit(rows, mixing.plan(rows, **wishes)).collect(), key=lambda r: r.position)
    out = [r.doc_id for r in mixing.mix_documents(docs, **wishes).collect()]
    assert out == [r.doc_id for r in order]
    assert not [1 for x, y in zip(out, out[1:]) if x == y]


def test_mixing_query_gives_the_schedule(spark):
    out = queries()["op3_mixing"](spark, "/root/testdata/sf0.001").collect()
    assert all(len(r.places) == r.copies for r in out)
    assert all([p.epoch for p in r.places] == list(range(r.copies)) or r.copies == 1 for r in out)
    assert all(0 <= p.position <= 1 and p.block >= 0 for r in out for p in r.places)


def test_mixing_keeps_rows_as_they_are(spark):
    docs = documents(spark, [*ODD_TEXTS, *ODD_TEXTS])
    docs = docs.unionByName(docs.limit(2)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    out = mixing.mix_documents(docs, target_entropy=0.95, repetition=2.0)
    assert out.schema == docs.schema
    assert docs.exceptAll(out).count() == 0
    assert out.exceptAll(docs.unionByName(docs)).count() == 0
    assert mixing.mix_documents(docs.limit(0)).count() == 0
    one = docs.filter("source = 's0'")
    assert mixing.mix_documents(one).exceptAll(one).count() == 0


@pytest.mark.parametrize(
    "line",
    [
        "aa=bb&",
        "aa=bb & ",
        "a=",
        'token = token + "aB3xQ9zLm2hh%d"\n',
        '"aB3xQ9zLm2hh%d" + ',
        "x = '\\'",
        ":=",
    ],
)
def test_scans_take_time_in_proportion_to_the_text(line):
    def seconds(n):
        text = "key = " + "".join(line % i if "%" in line else line for i in range(n // len(line)))
        start = time.process_time()
        secret_scan.scan_text(text)
        return time.process_time() - start

    seconds(10_000)
    small, large = seconds(50_000), seconds(400_000)
    assert large < 30 * max(small, 0.01)


def test_every_literal_of_a_grown_value_is_found():
    lines = "".join(f'token = token + "aB3xQ9zLm2hh{i}"\n' for i in range(300))
    spans = secret_scan.flow_spans('token = "xK7_first_pArt"\n' + lines)
    assert len(spans) == 301


def plain_flow(text):
    """Flow spans as defined: every name holds a list of (literal, start, end, hops)."""
    holds, found = {}, set()
    for name, terms in secret_scan.assignments(text):
        parts = {}
        for kind, value, a, b in terms:
            if kind == "name" and value in holds:
                for x, s, e, hops in holds[value]:
                    parts.setdefault((s, e), (x, s, e, min(hops + 1, secret_scan.COUNTED_HOPS)))
            elif kind == "text" or len(value) >= 12 and any(c.isdigit() for c in value):
                parts[a, b] = (value, a, b, 0)
        if parts:
            holds[name] = list(parts.values())
            says, whole = secret_scan.name_score(name), "".join(x for x, *_ in holds[name])
            for x, s, e, hops in holds[name] if says else ():
                score = max(secret_scan.literal_score(x), secret_scan.literal_score(whole) - 1)
                if says + score - 0.25 * hops >= secret_scan.MIN_SCORE and len(x) >= secret_scan.MIN_LITERAL:
                    found.add((s, e))
    return found


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "token", "api_key", "x.secret", "path"]),
            st.lists(
                st.sampled_from(['"aB3xQ9zLm2"', '"hunter22x"', "'Zx81_qwERTY99'", "AbC123def456ghi"]
                                + ["a", "b", "token", '"plain"', "x.secret"]),
                min_size=1, max_size=4,
            ),
        ),
        max_size=12,
    )
)
def test_flow_equals_the_plain_lists(lines):
    text = "\n".join(f"{name} = {' + '.join(terms)}" for name, terms in lines)
    assert {(a, b) for a, b, _ in secret_scan.flow_spans(text)} == plain_flow(text)


def test_scan_of_no_rows_and_of_clashing_columns(spark):
    docs = spark.createDataFrame([(1, 'token = "aB3xQ9zLm2"', "s", 5)], "doc_id long, text string, spans string, start int")
    assert secret_scan.scan(docs).first().spans[0].kind == "assign"
    assert secret_scan.scan(docs.limit(0)).collect() == [] == secret_scan.digest(secret_scan.scan(docs.limit(0))).collect()
    assert secret_scan.redact(docs).columns == docs.columns
