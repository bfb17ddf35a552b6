"""Shards of near equal bytes by a k-d tree over document metadata.

A node of the tree holds documents and a number of shards. It is split along its widest dimension,
at the weighted median of that dimension's values: the place that parts the node's bytes in the ratio of
the shards on each side (halves, if their number is even). Splitting ends at single shards, which
is when leaves have reached the target bytes, all bytes over the number of shards. Documents
of one shard are thus alike in source, language, length and id.

Medians are exact and distributed. Bytes are summed in `1 << BITS` ranges of the dimension between the
node's ends; the range in which the median falls is divided again, until it holds one value, and so is the
range of hashes among the rows of that value. So a value that a third of all rows share is
split like any other. All nodes of a level take part in the same sums, and a pass reads narrow
rows (key, size, dimensions); only one row for each node comes to the driver, at most as many
as there are shards.

Dimensions are longs. Texts count by their first seven bytes, which keeps their order. A null has the place
before all values. Null texts have no bytes, and every document weighs `OVERHEAD` bytes more, so empty
ones are spread as well. Documents with the same id and the same text share their place in the
tree and so their shard, with slots of their own; null ids are a value like others. An empty table has no
rows; with more shards than documents some shards stay empty. Columns named like those of the result
are left behind by `assign` and clash with nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.ranking import global_row_number
from sightline.sources.tables import durable

SHARDS = 40
OVERHEAD = 16
BITS = 12
HASH_BITS = 62
NULL = -(1 << 63)


def text_order(c: Column) -> Column:
    """A long that sorts like the first seven bytes of a text."""
    head = F.rpad(F.hex(F.substring(F.encode(c.cast("string"), "utf-8"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("long")


def metadata(docs: DataFrame) -> dict[str, Column]:
    """The dimensions used by default, of those columns that are there."""
    have = set(docs.columns)
    found = {c: text_order(F.col(c)) for c in ("source", "lang") if c in have}
    if "doc_id" in have:
        found["doc_id"] = F.col("doc_id").cast("long")
    return found | {"size": document_size()}


def document_size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")


def row_hash() -> Column:
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - HASH_BITS)


@dataclass
class Node:
    """A node on the frontier: its shards from `first` on, and the split that is being found."""

    first: int
    shards: int
    dim: int = 0
    bytes: int = 0
    goal: int = 0
    low: int = 0
    high: int = 0
    before: int = 0
    least: int = 0
    value: int = 0
    hash: int = 0
    ends: list[tuple[int, int]] = field(default_factory=list)

    @property
    def left(self) -> int:
        return self.shards // 2


def _of(nodes: dict[int, Node], get) -> Column:
    """A column with `get(node)` for the node of each row; bounded by the number of shards."""
    items = [F.lit(x) for k, n in nodes.items() for x in (k, get(n))]
    return F.create_map(*items)[F.col("node")]


def _extents(rows: DataFrame, nodes: dict[int, Node], n_dims: int) -> None:
    """Bytes of the nodes and the ends of all their dimensions; nulls have the place before the values."""
    aggs = [F.sum("size").alias("bytes")]
    for i in range(n_dims):
        d = F.col("dims")[i]
        known = F.when(d > NULL, d)
        aggs += [F.min(known).alias(f"l{i}"), F.max(known).alias(f"h{i}"), F.min(d).alias(f"n{i}")]
    for r in rows.groupBy("node").agg(*aggs).collect():
        n = nodes[r["node"]]
        n.bytes = r["bytes"]
        ends = [(r[f"l{i}"], r[f"h{i}"], r[f"n{i}"] == NULL) for i in range(n_dims)]
        n.ends = [(NULL, NULL) if low is None else (low - nulls, high) for low, high, nulls in ends]


def _narrow(rows: DataFrame, nodes: dict[int, Node], key: Column) -> None:
    """Divide the range of every node once, and keep what there is in the part its goal falls in.

    `goal` bytes are to lie at or before the split; `before` counts those ahead of the range.
    """
    # A range may span more than a long holds; decimals do.
    wide = any(n.high - n.low >= 1 << 62 for n in nodes.values())
    kind = "decimal(38,0)" if wide else "long"
    widths = {k: -(-(n.high - n.low + 1) // (1 << BITS)) for k, n in nodes.items()}
    text = [F.lit(x) for k, w in widths.items() for x in (k, str(w))]
    low = _of(nodes, lambda n: n.low)
    inside = rows.withColumn("__key", key).filter(
        (F.col("__key") >= low) & (F.col("__key") <= _of(nodes, lambda n: n.high))
    )
    away = F.col("__key").cast(kind) - low.cast(kind)
    inside = inside.withColumns(
        {"__away": away, "__width": F.create_map(*text)[F.col("node")].cast(kind)}
    )
    sums = inside.groupBy("node", F.expr("__away div __width").alias("part")).agg(
        F.sum("size").alias("own"), F.min("__key").alias("low"), F.max("__key").alias("high")
    )
    # At most 1 << BITS rows for each node, gathered as one array and summed up in order.
    run = F.expr(
        "aggregate(array_sort(collect_list(struct(part, own, low, high))), "
        "named_struct('upto', 0L, 'own', 0L, 'low', 0L, 'high', 0L), "
        "(s, x) -> if(s.upto >= goal, s, "
        "named_struct('upto', s.upto + x.own, 'own', x.own, 'low', x.low, 'high', x.high)))"
    )
    goal = _of(nodes, lambda n: max(1, n.goal - n.before))
    found = sums.withColumn("goal", goal).groupBy("node", "goal").agg(run.alias("s"))
    for r in found.select("node", "s.*").collect():
        n = nodes[r["node"]]
        n.before += r["upto"] - r["own"]
        n.low, n.high = r["low"], r["high"]


def _medians(rows: DataFrame, nodes: dict[int, Node]) -> None:
    """Find the value and the hash up to which rows go to the left side of each node."""
    key = _value(nodes)
    while open_ := {k: n for k, n in nodes.items() if n.high > n.low}:
        _narrow(_in(rows, open_), open_, key)
    for n in nodes.values():
        n.value, n.low, n.high = n.low, 0, (1 << HASH_BITS) - 1
    tied = rows.filter(key == _of(nodes, lambda n: n.value))
    while open_ := {k: n for k, n in nodes.items() if n.high > n.low}:
        _narrow(_in(tied, open_), open_, F.col("hash"))
    for n in nodes.values():
        n.hash = n.low
    # The row at the median goes to the side that then comes nearer to its goal.
    at = _in(tied, nodes).filter(F.col("hash") == _of(nodes, lambda n: n.hash))
    for r in at.groupBy("node").agg(F.sum("size").alias("bytes")).collect():
        n = nodes[r["node"]]
        if n.before + r["bytes"] - n.goal > n.goal - n.before:
            n.hash -= 1


def _value(nodes: dict[int, Node]) -> Column:
    """The value of a row in the dimension its node is split along."""
    value = F.element_at("dims", _of(nodes, lambda n: n.dim + 1))
    return F.greatest(value, _of(nodes, lambda n: n.least))


def _open(nodes: dict[int, Node]) -> Column:
    return F.col("node").isin(list(nodes))


def _in(rows: DataFrame, nodes: dict[int, Node]) -> DataFrame:
    return rows.filter(_open(nodes))


def split(rows: DataFrame, shards: int, n_dims: int) -> DataFrame:
    """`rows` (size, dims, hash) with the shard of each, `dims` dropped.

    Every level of the tree stores its narrow rows once, with the node each is in.
    """
    frontier = {0: Node(0, shards)}
    now = durable(rows.withColumn("node", F.lit(0)))
    first = {0: 0}
    whole: list[tuple[int, int]] = []
    while frontier := {k: n for k, n in frontier.items() if n.shards > 1}:
        _extents(_in(now, frontier), frontier, n_dims)
        frontier = {k: n for k, n in frontier.items() if n.ends}
        if not frontier:
            break
        whole = whole or frontier[0].ends
        for n in frontier.values():
            # Widths count as parts of the whole table's, so that no unit of measure matters.
            widths = [(b - a) / max(1, d - c) for (a, b), (c, d) in zip(n.ends, whole)]
            n.dim = max(range(n_dims), key=lambda i: (widths[i], -i))
            n.low, n.high = n.ends[n.dim]
            n.least, n.goal = n.low, round(n.bytes * n.left / n.shards)
        _medians(_in(now, frontier), frontier)
        # Nodes are numbered like a heap: the sides of k are 2k + 1 and 2k + 2.
        value = _value(frontier)
        at = _of(frontier, lambda n: n.value)
        left = (value < at) | ((value == at) & (F.col("hash") <= _of(frontier, lambda n: n.hash)))
        moved = F.col("node") * 2 + F.when(left, 1).otherwise(2)
        now = durable(now.withColumn("node", F.when(_open(frontier), moved).otherwise(F.col("node"))))
        below = {}
        for k, n in frontier.items():
            below[2 * k + 1] = Node(n.first, n.left)
            below[2 * k + 2] = Node(n.first + n.left, n.shards - n.left)
        frontier = below
        first |= {k: n.first for k, n in below.items()}
    leaves = F.create_map(*[F.lit(x) for item in first.items() for x in item])
    return now.withColumn("shard", leaves[F.col("node")].cast("int")).drop("node", "dims")


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    dims: dict[str, Column] | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """doc_id, hash (of id and text), size, text_crc32, shard, slot: one row for each document.

    With `target_bytes` there are as many shards as leaves of at most about so many bytes need.
    Slots count from 0 in each shard, in the order of a global sort whose partitions split shards of any
    size.
    """
    dims = dims or metadata(docs)
    # The two smallest longs are kept free for nulls.
    ordinals = [
        F.when(c.isNull(), F.lit(NULL)).otherwise(F.greatest(c.cast("long"), F.lit(NULL + 2)))
        for c in dims.values()
    ]
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            row_hash().alias("hash"),
            document_size().alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
            F.array(*ordinals).alias("dims"),
        )
    )
    if target_bytes:
        total = docs.agg(F.sum(document_size())).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = split(rows, shards, len(dims))
    order = [F.col(c).asc_nulls_first() for c in ("shard", "doc_id", "hash")]
    numbered = global_row_number(placed, order, "__row")
    # One row for each shard.
    starts = numbered.groupBy("shard").agg(F.min("__row").alias("first")).collect()
    first = [F.lit(x) for r in starts for x in (r["shard"], r["first"])]
    slot = F.col("__row") - F.create_map(*first)[F.col("shard")] if first else F.col("__row")
    return numbered.withColumn("slot", slot).drop("__row")


def write_shards(docs: DataFrame, assigned: DataFrame, folder: str, rows_per_file: int = 0) -> DataFrame:
    """The documents as Parquet below `folder`/shard=<n>, in slot order, and read back.

    Columns of `docs` come first, then slot and shard. Rows of one id and text share the first of their
    slots. `rows_per_file` bounds the rows of a file (0: no bound).
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.struct(*docs.columns).alias("__row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL)).alias("__id"),
        row_hash().alias("__hash"),
    )
    places = assigned.groupBy(
        F.coalesce("doc_id", F.lit(NULL)).alias("__id"), F.col("hash").alias("__hash")
    ).agg(F.min("shard").alias("shard"), F.min("slot").alias("slot"))
    joined = texts.join(places, ["__id", "__hash"])
    (
        joined.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .select("__row.*", "shard", "slot")
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(folder)
    )
    return spark.read.parquet(folder)
