"""Token ids in bit-plane shuffled files.

A shard holds the ids of a run of documents in ascending doc_id order as chunks of `CHUNK_IDS`
ids. A chunk is transposed: plane b holds bit b of all its ids, packed to bytes, and each plane is
compressed with zstandard by itself. High planes are nearly empty and cost next to nothing. Chunks are rows
of Parquet files written by Spark, so they can lie in any store and survive lost executors;
the columns besides the planes are the chunk index: shard, chunk, number of ids, an entry (doc_id,
first id in the shard, length) for each document that begins in the chunk, and in `carried` the
entry of the one that began before and reaches into it. So a chunk can be read by itself, and readers fetch
single chunks or planes through the index.

Documents are sorted by range partitions, never in one task. Null texts count as empty and give
the end id alone. Null ids come first. Rows of a repeated id are neighbours, in an order of no meaning. An
empty table gives no chunk. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.llm.text import joined_blocks, small_batches
from sightline.llm.tokens import BLOCK_CHARS, default_path, encoder, with_end

CHUNK_IDS = 1 << 17
LEVEL = 3
END_ID = 2
CHUNKS = (
    "shard long, chunk long, n_ids long, n_planes int, planes array<binary>, "
    "docs array<struct<doc_id: bigint, first: bigint, n_tokens: bigint>>, "
    "carried struct<doc_id: bigint, first: bigint, n_tokens: bigint>"
)


def shuffle_bits(ids: np.ndarray) -> list[bytes]:
    """One compressed plane for each bit that the largest id needs, lowest bit first."""
    if not len(ids):
        return []
    press = zstandard.ZstdCompressor(level=LEVEL)
    ids = ids.astype(np.uint32, copy=False)
    bits = [(ids >> np.uint32(b)).astype(np.uint8) & 1 for b in range(max(1, int(ids.max()).bit_length()))]
    return [press.compress(np.packbits(row, bitorder="little").tobytes()) for row in bits]


def open_planes(planes: list[bytes], n_ids: int) -> list[np.ndarray]:
    unpress = zstandard.ZstdDecompressor()
    size = -(-n_ids // 8)
    return [np.frombuffer(unpress.decompress(p, max_output_size=size), np.uint8) for p in planes]


def unshuffle_bits(opened: list[np.ndarray], start: int, end: int) -> np.ndarray:
    """The ids from `start` to before `end` of a chunk's planes."""
    first = start // 8
    out = np.zeros(max(0, end - start), np.uint32)
    for b, row in enumerate(opened):
        bits = np.unpackbits(row[first : -(-end // 8)], bitorder="little")
        out |= bits[start - 8 * first : end - 8 * first].astype(np.uint32) << np.uint32(b)
    return out


def _tokenize(
    batches: Iterable[pa.RecordBatch], path: str, end_id: int
) -> Iterator[tuple[int | None, np.ndarray]]:
    with encoder(path) as tokens:
        for block in joined_blocks(batches, max_chars=BLOCK_CHARS):
            ids, cuts = with_end(*tokens.encode(block.column("text")), end_id)
            yield from zip(block.column("doc_id").to_pylist(), np.split(ids, cuts[1:-1]))


def _chunks(docs_ids: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    parts: list[np.ndarray] = []
    docs: list[dict] = []
    carried = None
    held = first = chunk = 0

    def row() -> pa.RecordBatch:
        ids = np.concatenate(parts)
        planes = shuffle_bits(ids)
        values = [[shard], [chunk], [len(ids)], [len(planes)], [planes], [docs], [carried]]
        kinds = ["int64", "int64", "int64", "int32"]
        entry = pa.struct([("doc_id", "int64"), ("first", "int64"), ("n_tokens", "int64")])
        types = [*map(pa.type_for_alias, kinds), pa.list_(pa.binary()), pa.list_(entry), entry]
        names = ["shard", "chunk", "n_ids", "n_planes", "planes", "docs", "carried"]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    for doc_id, ids in docs_ids:
        entry = {"doc_id": doc_id, "first": first, "n_tokens": len(ids)}
        docs.append(entry)
        first += len(ids)
        while len(ids):
            take = min(len(ids), CHUNK_IDS - held)
            parts.append(ids[:take])
            ids, held = ids[take:], held + take
            if held == CHUNK_IDS:
                yield row()
                parts, docs, held, chunk = [], [], 0, chunk + 1
                carried = entry if len(ids) else None
    if held:
        yield row()


def write_token_files(
    docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Encode all documents, write the chunk rows to `folder`, and return them as read back.

    Texts are dealt into ranges before they are encoded, since the ranges are found by a first
    pass over what is dealt.
    """
    spark = docs.sparkSession
    path = path or default_path()
    small_batches(spark)
    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(lambda batches: _chunks(_tokenize(batches, path, end_id)), CHUNKS)
        .write.parquet(folder)
    )
    return spark.read.schema(CHUNKS).parquet(folder)


def read_token_files(chunks: DataFrame) -> DataFrame:
    """One row for each document: doc_id, shard, start over all shards, n_tokens, ids (binary).

    Starts add up the ids of the shards before (one row for each shard). Chunks are decoded where they are
    read; only the pieces of documents that reach over a chunk's end are sent to a common row.
    """
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kind = "shard long, doc_id long, first long, n_tokens long, at long, ids binary"
    stored = chunks.select("shard", "chunk", "n_ids", "planes", "docs", "carried")
    whole = stored.mapInArrow(_pieces(False), kind)
    # Of each chunk only the first and the last document can be cut, and only their ids are decoded.
    cut = (
        stored.mapInArrow(_pieces(True), kind)
        .groupBy("shard", "doc_id", "first", "n_tokens")
        .agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("p"))
        .withColumn("ids", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))"))
    )
    cols = ["shard", "doc_id", "first", "n_tokens", "ids"]
    return (
        whole.select(*cols)
        .unionByName(cut.select(*cols))
        # One row for each shard, that is for each task that wrote: hence a safe broadcast.
        .join(F.broadcast(starts), "shard")
        .select("doc_id", "shard", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")
    )


def _pieces(cut: bool):
    """The documents' stretches of ids in each chunk: those of whole documents, or those of documents
    that go on in other chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "doc_id", "first", "n_tokens", "at", "ids"]
        for batch in batches:
            for i in range(len(batch)):
                r = batch.slice(i, 1).to_pylist()[0]
                low, n = r["chunk"] * CHUNK_IDS, r["n_ids"]
                planes = open_planes(r["planes"], n)
                ids = None if cut else unshuffle_bits(planes, 0, n)
                out = []
                for d in ([r["carried"]] if r["carried"] else []) + (r["docs"] or []):
                    a, b = max(d["first"], low) - low, min(d["first"] + d["n_tokens"] - low, n)
                    if cut == (b - a < d["n_tokens"]):
                        own = unshuffle_bits(planes, a, b) if cut else ids[a:b]
                        piece = own.astype("<u4").tobytes()
                        out.append((r["shard"], d["doc_id"], d["first"], d["n_tokens"], a + low, piece))
                if out:
                    kinds = [pa.int64()] * 5 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names
                    )

    return run
