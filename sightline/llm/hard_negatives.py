"""Hard negatives from blocks along a Hilbert curve, chosen by interval arithmetic.

Vectors are numbered along a Hilbert curve through all dimensions and stored in that order, in blocks of
`BLOCK` rows. A zone map holds the least and greatest value of every dimension, and of the label,
for each block; zones are grouped `FAN` at a time into wider zones up to one root. Anchors are
grouped in curve order as well, `GROUP` at a time.

A search asks, for every anchor, for the `k` best rows of its own label or of other labels whose score (inner
product of integers) lies in a window. For a zone, interval arithmetic bounds all scores from
both sides: each dimension gives the smaller and the larger of its two products. Zones
whose bounds miss all windows of an anchor, or that hold no label it asks for, are left out, level by level
from the root; a block is read with the list of the anchors that need it. First every group reads the
blocks its own anchors lie in; the k-th score found there raises the lower end of the window.

Positives are such a search over the whole range of scores, negatives one with a window for each
positive. Results are exact: a bound never excludes a row that belongs to a result. On vectors without
clusters the bounds of 64 dimensions exclude little, and every group then reads every block.

Nothing grows in one task but the rows it streams through: a run is one group of anchors with at most
`LANE` blocks, and its result is k rows for each window. Joins are by block and by group.

Rows with a null id, label or vector, or any null or non-finite component, take no part; nor do
vectors without components. Vectors of different lengths never meet. Repeated rows are rows of their own: an anchor
given twice is answered twice, and counts as another row for its copy. Ties go to the smaller id. A
component counts as at most sqrt(2**55 / length) in size, beyond which scores would not fit; for 64
components that is 23,726,566. An empty table, or one without anchors, gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.llm.runs import sorted_runs
from sightline.operators.ranking import global_row_number
from sightline.sources.tables import durable

SCALE = 256
CURVE_BITS = 4
BLOCK = 1024
GROUP = 1024
FAN = 256
LANE = 32
SIZE_BITS = 55
NONE = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max


# ---- curve and bounds, on arrays --------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place along the Hilbert curve of each row of cell numbers below 1 << bits.

    All rows go through the same turns: from the coarsest bit on, each dimension in turn either mirrors
    or swaps the finer bits of the first, and the result is read as a Gray code.
    """
    x = cells.astype(np.uint32).T.copy()
    first = x[0]
    for bit in range(bits - 1, 0, -1):
        finer = np.uint32((1 << bit) - 1)
        for row in x:
            mirror = (row >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(mirror, np.uint32(0), (first ^ row) & finer)
            first ^= np.where(mirror, finer, swap)
            row ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), 0)
    x ^= turn
    planes = [(x.T >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    for limit, kind in ((1 << 24, np.float32), (1 << 53, np.float64)):
        if largest < limit:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return a @ b.T


def score_bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of `a` and boxes, the least and the greatest inner product possible."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return product(up, low) + product(down, high), product(up, high) + product(down, low)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


# ---- rows, zones, groups ----------------------------------------------------------------------


def _keys(least: int, cells: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                x = (matrix(rows.column("x"), dim) - least) // cells
                key = pa.array(hilbert_keys(x, CURVE_BITS), pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns, key], [*rows.schema.names, "key"])

    return run


def curve_order(vectors: DataFrame, anchor: Column) -> DataFrame:
    """Usable rows as dim, row (1, 2, ... along the curve), node (block), vec_id, label, x, anchor."""
    e = F.col("embedding")
    sound = F.forall(e, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    size = F.size("embedding")
    most = F.floor(F.sqrt(F.pow(F.lit(2.0), F.lit(SIZE_BITS)) / size))
    whole = F.transform(e, lambda v: F.floor(v.cast("double") * SCALE))
    rows = (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            "embedding",
            F.coalesce(anchor, F.lit(False)).alias("anchor"),
        )
        .filter("vec_id is not null and label is not null")
        .filter(F.coalesce((size > 0) & sound, F.lit(False)))
        .select(
            "vec_id",
            "label",
            "anchor",
            size.cast("long").alias("dim"),
            F.transform(whole, lambda v: F.greatest(F.least(v, most), -most).cast("long")).alias("x"),
        )
    )
    ends = rows.agg(F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    cells = -(-(high - low + 1) // (1 << CURVE_BITS))
    keyed = rows.mapInArrow(
        _keys(low, cells), "vec_id long, label long, anchor boolean, dim long, x array<long>, key binary"
    )
    numbered = global_row_number(keyed, [F.col("dim"), F.col("key")], "row", unique=True)
    node = F.floor((F.col("row") - 1) / BLOCK).cast("long")
    return durable(
        numbered.select("dim", "row", node.alias("node"), "vec_id", "label", "x", "anchor")
    )


_ZONE = "dim long, node long, low array<long>, high array<long>, low_label long, high_label long"


def _extents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The extent of each run of rows of one (dim, node), in one Arrow batch or several."""
    for rows in sorted_runs(batches, ["dim", "node"]):
        dim = rows.column("dim")[0].as_py()
        low, high = (matrix(rows.column(c), dim) for c in ("low", "high"))
        labels = [rows.column("low_label").to_numpy().min(), rows.column("high_label").to_numpy().max()]
        lists = [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (low.min(axis=0), high.max(axis=0))]
        yield pa.RecordBatch.from_arrays(
            [rows.column("dim").slice(0, 1), rows.column("node").slice(0, 1), *lists]
            + [pa.array([int(v)], pa.int64()) for v in labels],
            ["dim", "node", "low", "high", "low_label", "high_label"],
        )


def zones(rows: DataFrame) -> list[DataFrame]:
    """Zone maps from the blocks up to the widest; a zone's parent is its number over `FAN`."""
    level = rows.select(
        "dim", "node", F.col("x").alias("low"), F.col("x").alias("high"),
        F.col("label").alias("low_label"), F.col("label").alias("high_label"),
    )
    # Files are in curve order, so tasks reduce nearly all rows of a block before the shuffle.
    level = level.mapInArrow(_extents, _ZONE)
    levels = []
    while True:
        level = durable(
            level.repartition("dim", "node").sortWithinPartitions("dim", "node").mapInArrow(_extents, _ZONE)
        )
        levels.append(level)
        if (level.agg(F.max("node")).first()[0] or 0) < FAN:
            return levels
        level = level.withColumn("node", F.floor(F.col("node") / FAN).cast("long"))


# ---- searches ---------------------------------------------------------------------------------

_STREAM = ["dim", "g", "lane", "node", "kind", "row", "vec_id", "label", "x", "w", "mask"]
_ANCHOR, _HEADER, _CANDIDATE = 0, 1, 2


def _stream(anchors: DataFrame, lanes: DataFrame, *parts: DataFrame) -> DataFrame:
    """Runs of (dim, g, lane): the anchors of the group, then what it is to meet, by node."""
    null = lambda kind: F.lit(None).cast(kind)
    kinds = {
        "node": "long", "kind": "int", "row": "long", "vec_id": "long", "label": "long",
        "x": "array<long>", "w": "array<long>", "mask": "binary",
    }
    first = anchors.withColumns({"node": F.lit(-1).cast("long"), "kind": F.lit(_ANCHOR)}).join(
        lanes, ["dim", "g"]
    )
    shaped = [
        df.select(
            *[F.col(c) if c in df.columns else null(kinds[c]).alias(c) for c in _STREAM]
        )
        for df in (first, *parts)
    ]
    return (
        reduce(DataFrame.unionByName, shaped)
        .repartition("dim", "g", "lane")
        .sortWithinPartitions("dim", "g", "lane", "node", "kind", "row")
    )


class Anchors:
    """The anchors of one run. Windows are (anchors, slots) matrices of lower and upper ends."""

    def __init__(self, run: tuple, rows: list[pa.RecordBatch]):
        batch = pa.concat_batches(rows)
        self.run, self.dim = run, run[0]
        self.row, self.seat, self.label = (
            batch.column(c).to_numpy() for c in ("row", "vec_id", "label")
        )
        self.x = matrix(batch.column("x"), self.dim)
        slots = max((len(w) // 2 for w in batch.column("w").to_pylist()), default=0)
        self.low = np.full((len(self.row), slots), MOST)
        self.high = np.full((len(self.row), slots), NONE)
        for i, w in enumerate(batch.column("w").to_pylist()):
            self.low[i, : len(w) // 2], self.high[i, : len(w) // 2] = w[::2], w[1::2]


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Anchors, int, pa.RecordBatch]]:
    """Anchors with each further stretch of rows of one node and kind."""
    anchors, waiting, now = None, [], None
    for batch in batches:
        if not len(batch):
            continue
        keys = [batch.column(c).to_numpy() for c in ("dim", "g", "lane", "node", "kind")]
        change = np.zeros(len(batch) - 1, bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(a, b - a)
            run, kind = tuple(int(k[a]) for k in keys[:3]), int(keys[4][a])
            if kind == _ANCHOR:
                waiting = [*waiting, part] if waiting and now == run else [part]
                now = run
            else:
                if waiting:
                    anchors, waiting = Anchors(now, waiting), []
                yield anchors, kind, part


def _select(same: bool):
    """Which zones of a run any of its anchors needs, and which anchors do."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, _, part in _segments(batches):
            low, high = matrix(part.column("x"), anchors.dim), matrix(part.column("w"), anchors.dim)
            least, most = score_bounds(anchors.x, low, high)
            first, last = (part.column(c).to_numpy()[None, :] for c in ("vec_id", "label"))
            own = anchors.label[:, None]
            need = (first <= own) & (own <= last) if same else (first != own) | (last != own)
            meets = np.zeros_like(need)
            for slot in range(anchors.low.shape[1]):
                bottom, top = anchors.low[:, slot, None], anchors.high[:, slot, None]
                meets |= (most >= bottom) & (least <= top) & (bottom <= top)
            need &= meets
            some = np.flatnonzero(need.any(axis=0))
            if len(some):
                masks = np.packbits(need[:, some].T, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), anchors.run[0])),
                        pa.array(np.full(len(some), anchors.run[1])),
                        part.column("node").take(pa.array(some)),
                        pa.array([m.tobytes() for m in masks], pa.binary()),
                    ],
                    ["dim", "g", "node", "mask"],
                )

    return run


class Best:
    """The k best (score, then smaller id) found so far for each window of a run's anchors."""

    def __init__(self, anchors: Anchors, k: int):
        self.anchors, self.k = anchors, k
        shape = (*anchors.low.shape, k)
        self.score, self.id = np.full(shape, NONE), np.full(shape, MOST)

    def meet(self, rows: np.ndarray, part: pa.RecordBatch, same: bool) -> None:
        a = self.anchors
        ids = part.column("vec_id").to_numpy()
        scores = product(a.x[rows], matrix(part.column("x"), a.dim))
        fits = a.label[rows, None] == part.column("label").to_numpy()[None, :]
        if same:
            fits &= a.row[rows, None] != part.column("row").to_numpy()[None, :]
        else:
            fits = ~fits
        for slot in range(a.low.shape[1]):
            low, high = a.low[rows, slot, None], a.high[rows, slot, None]
            inside = fits & (scores >= low) & (scores <= high)
            self._take(rows, slot, np.where(inside, scores, NONE), ids)

    def _take(self, rows: np.ndarray, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        k, least = self.k, self.score[rows, slot, -1]
        if scores.shape[1] > k:
            least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
        i, j = np.nonzero((scores >= least[:, None]) & (scores > NONE))
        if not len(i):
            return
        touched, at = np.unique(i, return_inverse=True)
        old = rows[touched]
        owner = np.concatenate([at, np.repeat(np.arange(len(touched)), k)])
        score = np.concatenate([scores[i, j], self.score[old, slot].ravel()])
        who = np.concatenate([ids[j], self.id[old, slot].ravel()])
        order = np.lexsort((who, -np.maximum(score, NONE + 1), owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        taken = place < k
        order, owner, place = order[taken], owner[taken], place[taken]
        self.score[old[owner], slot, place] = score[order]
        self.id[old[owner], slot, place] = who[order]

    def rows(self) -> pa.RecordBatch:
        i, slot, place = np.nonzero(self.score > NONE)
        seat = self.anchors.seat[i]
        columns = [seat, slot, self.score[i, slot, place], self.id[i, slot, place]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["seat", "slot", "score", "vec_id"]
        )


def _scan(k: int, same: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rows = None, np.zeros(0, int)
        for anchors, kind, part in _segments(batches):
            if best is None or best.anchors is not anchors:
                if best is not None:
                    yield best.rows()
                best = Best(anchors, k)
            if kind == _HEADER:
                mask = part.column("mask")[0].as_py()
                bits = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(anchors.row))
                rows = np.flatnonzero(bits)
            else:
                # Blocks come in pieces, so a matrix of scores stays within GROUP * BLOCK.
                for start in range(0, len(part), BLOCK):
                    best.meet(rows, part.slice(start, BLOCK), same)
        if best is not None:
            yield best.rows()

    return run


def _read(anchors: DataFrame, needed: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best for each seat and slot among the blocks `needed` (dim, g, node, mask)."""
    needed = needed.withColumn("lane", F.floor(F.col("node") / LANE).cast("long"))
    headers = needed.withColumn("kind", F.lit(_HEADER))
    candidates = (
        rows.select("dim", "node", "row", "vec_id", "label", "x")
        .join(needed.select("dim", "g", "node", "lane"), ["dim", "node"])
        .withColumn("kind", F.lit(_CANDIDATE))
    )
    lanes = needed.select("dim", "g", "lane").distinct()
    found = _stream(anchors, lanes, headers, candidates).mapInArrow(
        _scan(k, same), "seat long, slot long, score long, vec_id long"
    )
    by = W.partitionBy("seat", "slot").orderBy(F.desc("score"), "vec_id")
    # A partition holds k rows for each run that the anchor's group has.
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def needed_blocks(anchors: DataFrame, levels: list[DataFrame], same: bool) -> DataFrame:
    """dim, g, node, mask: the blocks that may hold a row of a window, and whose windows those are."""
    frontier = anchors.select("dim", "g").distinct().withColumn("parent", F.lit(0).cast("long"))
    for level in reversed(levels):
        zone = level.withColumn("parent", F.floor(F.col("node") / FAN).cast("long"))
        met = (
            zone.join(frontier.select("dim", "g", "parent"), ["dim", "parent"])
            .withColumnsRenamed({"low": "x", "high": "w", "low_label": "vec_id", "high_label": "label"})
            .withColumns({"lane": F.floor(F.col("node") / FAN).cast("long"), "kind": F.lit(_CANDIDATE)})
        )
        lanes = frontier.select("dim", "g", F.col("parent").alias("lane")).distinct()
        frontier = durable(
            _stream(anchors, lanes, met).mapInArrow(
                _select(same), "dim long, g long, node long, mask binary"
            )
        ).withColumn("parent", F.col("node"))
    return frontier.drop("parent")


def search(anchors: DataFrame, rows: DataFrame, levels: list[DataFrame], k: int, same: bool) -> DataFrame:
    """seat, slot, rank, score, vec_id of the k best rows in each window of each anchor.

    `anchors` has dim, g, row, vec_id (seat), label, x and w, the ends of the windows in turn.
    """
    sizes = anchors.groupBy("dim", "g").agg(F.count("*").alias("__n"))
    home = anchors.select("dim", "g", F.floor((F.col("row") - 1) / BLOCK).cast("long").alias("node"))
    every = F.expr("unhex(repeat('FF', cast(ceil(__n / 8) as int)))")
    home = home.distinct().join(sizes, ["dim", "g"]).select("dim", "g", "node", every.alias("mask"))
    first = _read(anchors, home, rows, k, same).filter(F.col("rank") == k)
    raised = first.groupBy("seat").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("__least")
    )
    least = F.expr(
        "transform(w, (v, i) -> if(i % 2 = 0 and __least is not null, "
        "greatest(v, coalesce(__least[cast(i / 2 as bigint)], v)), v))"
    )
    tight = durable(
        anchors.join(raised.withColumnRenamed("seat", "vec_id"), "vec_id", "left")
        .withColumn("w", least)
        .drop("__least")
    )
    return _read(tight, needed_blocks(tight, levels, same), rows, k, same)


def mine(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    lower: int = 50,
    upper: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor and each of its first `positives` rows of the same label, the first
    `negatives` rows of other labels with scores from `lower` to `upper` percent of the positive's.
    """
    rows = curve_order(vectors, anchor)
    levels = zones(rows)
    seats = global_row_number(
        rows.filter("anchor").select("dim", "row", "vec_id", "label", "x"),
        [F.col("row")],
        "seat",
        unique=True,
    )
    anchors = durable(
        seats.select(
            "dim",
            F.floor((F.col("seat") - 1) / GROUP).cast("long").alias("g"),
            "row",
            F.col("vec_id").alias("anchor_id"),
            F.col("seat").alias("vec_id"),
            "label",
            "x",
        )
    )
    whole = F.array(F.lit(NONE + 1), F.lit(MOST))
    found = durable(
        search(anchors.drop("anchor_id").withColumn("w", whole), rows, levels, positives, True).select(
            "seat", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    # Integer forms of lower * p <= 100 * score <= upper * p.
    ends = F.expr(
        f"flatten(transform(array_sort(collect_list(struct(rank, positive_score))), p -> array("
        f"{_floor_div(f'{lower} * p.positive_score + 99')}, {_floor_div(f'{upper} * p.positive_score')})))"
    )
    windows = found.groupBy(F.col("seat").alias("vec_id")).agg(ends.alias("w"))
    asking = anchors.drop("anchor_id").join(windows, "vec_id")
    worst = search(durable(asking), rows, levels, negatives, False)
    return (
        worst.select(
            "seat",
            (F.col("slot") + 1).cast("int").alias("__slot"),
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        .join(found.withColumnRenamed("rank", "__slot"), ["seat", "__slot"])
        .join(anchors.select(F.col("vec_id").alias("seat"), "anchor_id"), "seat")
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )


def _floor_div(dividend: str) -> str:
    """Hundredth part of a long, rounded down."""
    return f"(({dividend}) - pmod({dividend}, 100L)) div 100L"
