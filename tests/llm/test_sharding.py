"""K-d tree shards against a plain tree."""

import zlib

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from sightline.llm import sharding
from tests.llm.helpers import ODD_TEXTS, documents

SF = "/root/testdata/sf0.001"


def head(text):
    return int.from_bytes((text or "").encode()[:7].ljust(7, b"\0"), "big")


def plain_tree(rows, shards):
    """Shard of each row (dims, hash, size); dims hold None for a null."""
    out = {}

    def ends(members, d):
        known = [rows[i][0][d] for i in members if rows[i][0][d] is not None]
        nulls = any(rows[i][0][d] is None for i in members)
        return (min(known) - nulls, max(known)) if known else (0, 0)

    whole = [ends(range(len(rows)), d) for d in range(len(rows[0][0]))] if rows else []

    def split(members, first, count):
        if count == 1:
            out.update(dict.fromkeys(members, first))
            return
        if not members:
            return
        own = [ends(members, d) for d in range(len(whole))]
        widths = [(b - a) / max(1, d - c) for (a, b), (c, d) in zip(own, whole)]
        d = max(range(len(whole)), key=lambda i: (widths[i], -i))
        place = lambda i: (own[d][0] if rows[i][0][d] is None else rows[i][0][d], rows[i][1])
        goal = round(sum(rows[i][2] for i in members) * (count // 2) / count)
        keys = sorted({place(i) for i in members})
        weight = dict.fromkeys(keys, 0)
        for i in members:
            weight[place(i)] += rows[i][2]
        left, before = set(), 0
        for k in keys:
            if before >= goal:
                break
            if before + weight[k] < goal or before + weight[k] - goal <= goal - before:
                left.add(k)
            before += weight[k]
        split([i for i in members if place(i) in left], first, count // 2)
        split([i for i in members if place(i) not in left], first + count // 2, count - count // 2)

    split(list(range(len(rows))), 0, shards)
    return out


def expected(docs, shards):
    """Multiset of (doc_id, size, crc, shard), from the hashes that Spark gives."""
    rows = docs.select("doc_id", "text", "source", "lang", sharding.row_hash().alias("h")).collect()
    items = []
    for r in rows:
        size = len((r.text or "").encode()) + 16
        dims = [None if v is None else head(v) for v in (r.source, r.lang)]
        items.append(([*dims, r.doc_id, size], r.h, size))
    shard = plain_tree(items, shards)
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, items[i][2], zlib.crc32((r.text or "").encode()), shard[i])
        for i, r in enumerate(rows)
    )


def check(found, docs, shards):
    rows = found.collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.text_crc32, r.shard) for r in rows)
    assert got == expected(docs, shards)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_op12(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = check(queries()["op12_kd_shards"](spark, SF), docs, 40)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    total, largest = {}, max(r["size"] for r in rows)
    for r in rows:
        total[r.shard] = total.get(r.shard, 0) + r["size"]
    assert max(total.values()) - sum(total.values()) / 40 <= largest


@pytest.mark.parametrize("shards", [1, 2, 5, 64])
def test_odd_documents(spark, shards):
    texts = ODD_TEXTS + [f"text {i % 9} " * (i % 5) for i in range(60)]
    docs = documents(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") != 4, F.col("doc_id")))
    docs = docs.withColumn("shard", F.lit("taken")).withColumn("slot", F.lit(-1)).withColumn("hash", F.lit(0))
    check(sharding.assign(docs, shards), docs, shards)


def test_a_hot_value_is_split(spark):
    texts = ["same"] * 300 + [f"other {i}" for i in range(20)]
    docs = documents(spark, texts).withColumn("source", F.lit("hot"))
    sizes = {}
    for r in check(sharding.assign(docs, 8), docs, 8):
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 60


def test_repeated_rows_and_extreme_ids(spark):
    docs = documents(spark, ["a", "b b", None, "a"] * 10)
    ends = F.when(F.col("doc_id") == 1, F.lit(-(1 << 63) + 2)).when(F.col("doc_id") == 2, F.lit((1 << 63) - 1))
    docs = docs.withColumn("doc_id", F.coalesce(ends, F.col("doc_id") % 7))
    docs = docs.unionByName(docs.filter("doc_id < 5"))
    check(sharding.assign(docs, 6), docs, 6)


def test_no_documents(spark):
    empty = documents(spark, ["x"]).filter("doc_id < 0")
    assert sharding.assign(empty).collect() == []
    assert sharding.assign(empty, target_bytes=100).collect() == []


def test_target_bytes_and_own_dimensions(spark):
    docs = documents(spark, [f"{i:04d} " * 20 for i in range(100)])
    rows = sharding.assign(docs, dims={"id": F.col("doc_id")}, target_bytes=1160).collect()
    assert {r.shard for r in rows} == set(range(10))
    # One dimension in order: shards are stretches of ids.
    by_id = [r.shard for r in sorted(rows, key=lambda r: r.doc_id)]
    assert by_id == sorted(by_id)


def test_files_hold_all_rows_in_slot_order(spark, tmp_path):
    docs = documents(spark, ODD_TEXTS * 4)
    placed = sharding.assign(docs, 5)
    back = sharding.write_shards(docs, placed, str(tmp_path / "out"), rows_per_file=7)
    assert back.columns == [*docs.columns, "slot", "shard"]
    key = lambda r: (r.doc_id, r.text or "", r.shard, r.slot)
    wanted = [
        (r.doc_id, next(t for i, t in enumerate(ODD_TEXTS * 4) if i == r.doc_id) or "", r.shard, r.slot)
        for r in placed.collect()
    ]
    assert sorted(map(key, back.collect())) == sorted(wanted)
    for folder in (tmp_path / "out").glob("shard=*"):
        for part in folder.glob("*.parquet"):
            slots = [r.slot for r in spark.read.parquet(str(part)).collect()]
            assert slots == sorted(slots) and len(slots) <= 7
