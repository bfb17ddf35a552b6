"""Bounded-space online packing of documents into sequences of at most `LENGTH` tokens.

Each partition keeps at most `OPEN` windows. A document's full stretches of `LENGTH` ids become
sequences at once; the rest is placed best-fit, in the window it leaves least room in. When none
has room and all windows are in use, the fullest one is completed with the head of the piece and
emitted. At the end of a partition its open windows complete each other until at most one is
left. These leftovers, one for each partition, are merged in two further rounds of the same
kind, the first in about sqrt(partitions) tasks. The very last one is cut into sequences
whose lengths are powers of two, so nothing is padded.

Null texts count as empty and give the end id alone; null and repeated ids are packed like any
other row; an empty table gives no sequence. Every id lies in exactly one piece. Columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import joined_blocks, small_batches
from sightline.llm.tokens import BLOCK_CHARS, default_path, encoder, with_end
from sightline.sources.tables import durable

LENGTH = 2048
OPEN = 64
END_ID = 1
SEQUENCES = (
    "sequence_id long, part long, leftover boolean, n_tokens int, ids binary, "
    "pieces array<struct<doc_id: bigint, start: bigint, length: bigint, doc_tokens: bigint>>"
)
_PIECE = pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens")])
_SCHEMA = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("part", pa.int64()),
        ("leftover", pa.bool_()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("pieces", pa.list_(_PIECE)),
    ]
)
PART_BITS = 33


class Piece:
    """A stretch of a document's ids."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start, ids, doc_tokens):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def cut(self, n: int) -> tuple[Piece, Piece]:
        rest = Piece(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens)
        return Piece(self.doc_id, self.start, self.ids[:n], self.doc_tokens), rest


Window = list[Piece]


def size(window: Window) -> int:
    return sum(len(p.ids) for p in window)


def pack(pieces: Iterable[Piece], length: int = LENGTH, most: int = OPEN) -> Iterator[Window]:
    """Full windows as they are completed, then at most one that is not full."""
    windows: dict[int, Window] = {}
    room: list[tuple[int, int]] = []  # (free, window), in order
    count = 0
    for piece in pieces:
        while len(piece.ids) >= length:
            head, piece = piece.cut(length)
            yield [head]
        n = len(piece.ids)
        if not n:
            continue
        # A window may stay open for long; a view would keep the ids of a whole block.
        piece.ids = piece.ids.copy()
        at = bisect_left(room, (n, -1))
        if at == len(room) and len(room) >= most:
            free, k = room.pop(0)
            head, piece = piece.cut(free)
            yield [*windows.pop(k), head]
            n = len(piece.ids)
            at = bisect_left(room, (n, -1))
        if at < len(room):
            free, k = room.pop(at)
            windows[k].append(piece)
            if free == n:
                yield windows.pop(k)
                continue
        else:
            free, k = length, count
            count += 1
            windows[k] = [piece]
        insort(room, (free - n, k))
    yield from merge([windows[k] for _, k in room], length)


def merge(windows: list[Window], length: int = LENGTH) -> Iterator[Window]:
    """Complete the fullest window with pieces of the emptiest, until at most one is left."""
    windows = sorted(windows, key=size, reverse=True)
    low, high = 0, len(windows) - 1
    while low <= high:
        window, free = windows[low], length - size(windows[low])
        low += 1
        while free and low <= high:
            piece = windows[high].pop()
            if len(piece.ids) > free:
                piece, rest = piece.cut(free)
                windows[high].append(rest)
            window.append(piece)
            free -= len(piece.ids)
            if not windows[high]:
                high -= 1
        yield window


def powers_of_two(window: Window) -> Iterator[Window]:
    """Cut a window into windows whose sizes are powers of two."""
    rest = window
    while n := size(rest):
        need, out = 1 << (n.bit_length() - 1), []
        while need:
            piece, rest = rest[0], rest[1:]
            if len(piece.ids) > need:
                piece, tail = piece.cut(need)
                rest = [tail, *rest]
            out.append(piece)
            need -= len(piece.ids)
        yield out


def _documents(batches, path: str, end_id: int) -> Iterator[Piece]:
    with encoder(path) as tokens:
        for block in joined_blocks(batches, max_chars=BLOCK_CHARS):
            ids, cuts = with_end(*tokens.encode(block.column("text")), end_id)
            for doc_id, own in zip(block.column("doc_id").to_pylist(), np.split(ids, cuts[1:-1])):
                yield Piece(doc_id, 0, own, len(own))


def _stored(batches) -> Iterator[Window]:
    for batch in batches:
        for r in batch.select(["ids", "pieces"]).to_pylist():
            ids = np.frombuffer(r["ids"], "<u4")
            ends = np.cumsum([p["length"] for p in r["pieces"]])
            yield [
                Piece(p["doc_id"], p["start"], own, p["doc_tokens"])
                for p, own in zip(r["pieces"], np.split(ids, ends[:-1]))
            ]


def _rows(windows: Iterator[Window], level: int, length: int) -> Iterator[pa.RecordBatch]:
    """Sequences as Arrow rows. Their ids hold level, partition and place in it."""
    part = TaskContext.get().partitionId()
    first = (level << 61) | (part << PART_BITS)
    rows, count = [], 0
    for window in windows:
        n = size(window)
        ids = np.concatenate([p.ids for p in window]).astype("<u4").tobytes()
        pieces = [
            {"doc_id": p.doc_id, "start": p.start, "length": len(p.ids), "doc_tokens": p.doc_tokens}
            for p in window
        ]
        rows.append((first + count, part, level < 2 and n < length, n, ids, pieces))
        count += 1
        if len(rows) == 256:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA
            )
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA
        )


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    end_id: int = END_ID,
    length: int = LENGTH,
    most: int = OPEN,
) -> DataFrame:
    """Sequences: sequence_id, n_tokens, ids (little-endian unsigned 32 bits), pieces.

    Three tables are stored, one for each round; every later round reads only the leftovers of
    the one before.
    """
    path = path or default_path()
    small_batches(docs.sparkSession)
    packed = durable(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            lambda b: _rows(pack(_documents(b, path, end_id), length, most), 0, length), SEQUENCES
        )
    )
    left = packed.filter("leftover")
    groups = max(1, math.isqrt(left.count()))
    some = durable(
        left.repartition(groups, "part")
        .sortWithinPartitions("sequence_id")
        .mapInArrow(lambda b: _rows(merge(list(_stored(b)), length), 1, length), SEQUENCES)
    )
    last = (
        some.filter("leftover")
        .repartition(1)
        .sortWithinPartitions("sequence_id")
        .mapInArrow(lambda b: _rows(_last(b, length), 2, length), SEQUENCES)
    )
    done = [df.filter(~F.col("leftover")) for df in (packed, some, last)]
    return done[0].unionByName(done[1]).unionByName(done[2]).drop("part", "leftover")


def _last(batches, length: int) -> Iterator[Window]:
    for window in merge(list(_stored(batches)), length):
        yield from ([window] if size(window) == length else powers_of_two(window))


def pieces_of(sequences: DataFrame) -> DataFrame:
    """One row for each piece, with its place in the sequence and the crc32 of its ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (
            "doc_id start length ids_crc32 doc_tokens sequence_id offset sequence_tokens".split()
        )
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                at = 0
                for p in r["pieces"]:
                    crc = zlib.crc32(r["ids"][4 * at : 4 * (at + p["length"])])
                    out.append(
                        (p["doc_id"], p["start"], p["length"], crc, p["doc_tokens"])
                        + (r["sequence_id"], at, r["n_tokens"])
                    )
                    at += p["length"]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], names
                )

    return sequences.select("sequence_id", "n_tokens", "ids", "pieces").mapInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long, sequence_tokens long",
    )
