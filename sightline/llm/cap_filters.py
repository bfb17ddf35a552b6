"""Near-duplicate embeddings by spherical-cap filters.

A filter is the cap around a direction of a structured random product code: after a random
rotation the space is cut into two halves with a small code each, and every pair of codewords is
one direction. `CODES` independent codes are used. List decoding finds all directions whose inner product with a vector exceeds
the cap height, by sorting one half's inner products and searching it for each codeword of the
other. Vectors of one label that share a filter are compared exactly, in double precision.

The code grows with the number of distinct vectors, so that buckets keep their expected size,
and the cap height follows from it, so that a pair at the threshold is expected to share
`SHARED` filters of each code. Such a pair is missed with a probability of about 1e-3 (measured
at 64 dimensions; the tests hold it below 1e-2), closer pairs less often.

Equal vectors of a label are one class and are compared once. Buckets above `BLOCK` vectors are
dealt out as pairs of blocks. A pair is counted in the lowest filter that both share, by the filters
that were stored with the vectors, as short gaps; they are decoded once. Vectors
that are null, empty, zero, or hold null or non-finite components, and vectors with a null label
or id, link with nothing; vectors of different lengths are never compared. Rows repeated with
the same id are one vector with copies. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.components import components
from sightline.llm.runs import sorted_runs
from sightline.sources.tables import durable

THRESHOLD = 0.93
CODES = 8
SHARED = 3.0
BUCKET = 64.0
BLOCK = 2048
STRIP = 512
TOP = (1 << 15) - 1
SEED = 93


def plan_code(n: int, threshold: float = THRESHOLD) -> tuple[int, float]:
    """Codewords for each half, and the cap height in standard deviations, for `n` vectors."""
    normal = NormalDist()
    per_vector = 2 * SHARED
    for _ in range(20):
        words = max(16, math.ceil(math.sqrt(max(n, 1) * per_vector / BUCKET)))
        height = normal.inv_cdf(1 - min(0.4, per_vector / words**2))
        # P(y above | x above) for correlated normals, at the mean of x above the height.
        x = math.exp(-height * height / 2) / math.sqrt(2 * math.pi) / (1 - normal.cdf(height))
        above = 1 - normal.cdf((height - threshold * x) / math.sqrt(1 - threshold * threshold))
        per_vector = SHARED / above
    return words, height


@lru_cache(4 * CODES)
def code(dim: int, words: int, which: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotation and the two halves of one code, the same in every task."""
    rng = np.random.default_rng([SEED, dim, words, which])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    halves = []
    for size in (dim - dim // 2, dim // 2):
        c = rng.standard_normal((words, size))
        halves.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12) / math.sqrt(2))
    return rotation, halves


def decode(unit: np.ndarray, words: int, height: float) -> list[np.ndarray]:
    """The filters of each row of unit vectors in rising order; at least the best of each code.

    Inner products are rounded, so that a vector has the same filters in every batch.
    """
    dim = unit.shape[1]
    least = height / math.sqrt(dim)
    out: list[list[np.ndarray]] = [[] for _ in unit]
    for which in range(CODES):
        rotation, (c1, c2) = code(dim, words, which)
        turned = unit @ rotation
        first = np.round(turned[:, : c1.shape[1]] @ c1.T, 9)
        second = np.round(turned[:, c1.shape[1] :] @ c2.T, 9)
        base = which * words * words
        for a, b, lists in zip(first, second, out):
            order = np.argsort(-b, kind="stable")
            falling = -b[order]
            some = np.flatnonzero(a - least >= falling[0])
            if not len(some):
                some = a.argmax(keepdims=True)
            n = np.maximum(np.searchsorted(falling, a[some] - least, "right"), 1)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            lists.append(np.sort(base + np.repeat(some, n) * words + order[place]))
    return [np.concatenate(lists) for lists in out]


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def packed(filters: np.ndarray) -> np.ndarray:
    """Rising numbers as short gaps. A gap of `TOP` and more is spelled as some `TOP`s and the rest."""
    gaps = np.diff(filters, prepend=0)
    over = gaps // TOP
    if not over.any():
        return gaps.astype(np.int16)
    out = np.full(len(gaps) + int(over.sum()), TOP, np.int16)
    out[np.cumsum(over + 1) - 1] = gaps % TOP
    return out


def unpacked(gaps: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every filter in a column of packed ones."""
    flat = gaps.flatten().to_numpy().astype(np.int64)
    lengths = gaps.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(gaps)), lengths)
    run = np.concatenate([[0], np.cumsum(flat)])
    numbers = run[1:] - run[np.cumsum(lengths) - lengths][row]
    whole = flat != TOP
    return row[whole], numbers[whole]


def _decode(words: int, height: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for start in range(0, len(part), 1024):
                    rows = part.slice(start, 1024)
                    x = matrix(rows.column("embedding"))
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    found = decode(x, words, height)
                    lists = pa.array(found, pa.list_(pa.int64()))
                    gaps = pa.array(map(packed, found), pa.list_(pa.int16()))
                    yield pa.RecordBatch.from_arrays(
                        [*(rows.column(c) for c in ("vec_id", "label", "dim")), lists, gaps],
                        ["vec_id", "label", "dim", "filters", "gaps"],
                    )

    return run


def shares_earlier(gaps: pa.ListArray, here: int) -> np.ndarray:
    """Which rows share a filter below `here`, as a matrix."""
    n = len(gaps)
    row, lists = unpacked(gaps)
    row, lists = row[lists < here], lists[lists < here]
    _, at, count = np.unique(lists, return_inverse=True, return_counts=True)
    several = count > 1
    column = np.cumsum(several) - 1
    kept = several[at]
    # Row by filter; only filters that occur twice, in strips, so that memory stays bounded.
    row, column = row[kept], column[at[kept]]
    out = np.zeros((n, n), bool)
    for start in range(0, int(several.sum()), STRIP):
        inside = (column >= start) & (column < start + STRIP)
        some = np.unique(row[inside])
        has = np.zeros((len(some), STRIP), np.float32)
        has[np.searchsorted(some, row[inside]), column[inside] - start] = 1
        out[np.ix_(some, some)] |= has @ has.T > 0
    return out


def roots(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the smallest row it reaches."""
    low = np.arange(len(near))
    linked = near | np.eye(len(near), dtype=bool)
    while True:
        new = np.where(linked, low[None, :], len(low)).min(axis=1)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _verify(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_runs(batches, ["label", "dim", "filter", "low", "high"]):
            if len(rows) < 2:
                continue
            x = matrix(rows.column("embedding"))
            norm = np.linalg.norm(x, axis=1)
            low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
            near = (x @ x.T) / np.outer(norm, norm) >= threshold
            # The same product either way, whatever order the sums were taken in.
            near = np.triu(near, 1)
            if low != high:
                block = rows.column("block").to_numpy()
                near &= block[:, None] != block[None, :]
            near |= near.T
            touched = np.flatnonzero(near.any(axis=1))
            if not len(touched):
                continue
            near = near[np.ix_(touched, touched)]
            some = rows.take(pa.array(touched))
            counted = near & ~shares_earlier(some.column("gaps"), rows.column("filter")[0].as_py())
            linked = counted @ some.column("copies").to_numpy()
            ids = some.column("vec_id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(linked.astype(np.int64)), pa.array(ids[roots(near)])],
                ["vec_id", "linked", "root"],
            )

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of `vectors`."""
    x = F.col("embedding")
    sound = F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    ) & F.exists(x, lambda v: v != 0)
    usable = F.coalesce(sound, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = rows.withColumn("ok", usable)
    key = [
        F.xxhash64("label", "embedding").alias("k1"),
        F.xxhash64("embedding", "label", F.lit(1)).alias("k2"),
    ]
    classes = durable(
        rows.filter("ok")
        .select("vec_id", "label", "embedding", F.size("embedding").cast("long").alias("dim"), *key)
        .groupBy("k1", "k2")
        .agg(
            F.min("vec_id").alias("vec_id"),
            F.count("*").alias("copies"),
            *[F.first(c).alias(c) for c in ("label", "dim", "embedding")],
        )
    )
    words, height = plan_code(classes.count(), threshold)
    kind = dict(classes.dtypes)
    # Filters and the dealing of buckets are settled on narrow rows; vectors join last.
    decoded = durable(
        classes.select("vec_id", "label", "dim", "embedding").mapInArrow(
            _decode(words, height),
            f"vec_id long, label {kind['label']}, dim long, filters array<long>, gaps array<smallint>",
        )
    )
    at = ["label", "dim", "filter"]
    spread = decoded.select("vec_id", "label", "dim", F.explode("filters").alias("filter"))
    sizes = spread.groupBy(*at).count().filter("count > 1")
    dealt = (
        spread.join(sizes, at)
        .withColumn("blocks", F.ceil(F.col("count") / block).cast("long"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("count", "blocks", "other")
        .join(classes.select("vec_id", "copies", "embedding"), "vec_id")
        .join(decoded.select("vec_id", "gaps"), "vec_id")
    )
    found = durable(
        dealt.repartition(*at, "low", "high")
        .sortWithinPartitions(*at, "low", "high", "vec_id")
        .mapInArrow(_verify(threshold), "vec_id long, linked long, root long")
    )
    links = found.groupBy("vec_id").agg(F.sum("linked").alias("linked"))
    joined = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    result = (
        classes.select("k1", "k2", "vec_id", "copies")
        .join(links, "vec_id", "left")
        .join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "k1",
            "k2",
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    keys = rows.select("vec_id", *[F.when(F.col("ok"), k).alias(n) for k, n in zip(key, ("k1", "k2"))])
    return keys.join(result, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"),
    )
