"""N-gram Jaccard join by signature trees.

A document's set are its distinct 4-word shingles (A-Z lower-cased; with fewer words the whole
sequence is the one element). Two documents link when 100 * intersection >= 85 * union.

1. Equal sets are one class, represented by its smallest id.
2. Shingles that are frequent somewhere are counted, so that all sets can be put into one global
   order with rare shingles first. Two sets that link share one of their first
   n - ceil(0.85 n) + 1 shingles (the prefix). The counts only shape that order, so the result
   does not depend on them. Each class writes its prefix and a signature: a bitmap of 4 to 8
   bits for each shingle.
3. Classes that share a prefix shingle meet in a group, named by one of them (so groups that
   hold the same classes are one). In each group a tree is built over the signatures, ordered by
   size: nodes hold the OR of the bitmaps below and the range of sizes. The tree is traversed
   against itself; a pair of nodes is left when even the most overlap its bitmaps and sizes
   allow is too little. What is left at the leaves are candidates.
4. Candidates are compared exactly on their texts, cluster by cluster. Pairs that are already
   connected need no comparison, since only the components are asked for.

Groups and clusters above a block size are dealt out as blocks: first every block with the
cluster's first class, then, only where a cluster has not come together, pairs of blocks.

Null and wordless texts have an empty set and link with nothing. Rows with a null id get their
set size and a null component. Repeated ids are one document: it has the links of all its texts.
Repeated rows give repeated rows. An empty table gives no rows; a very long text is one set like others.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.components import Union, components
from sightline.llm.runs import sorted_runs
from sightline.llm.text import blocks, hash_words, mix, words_of
from sightline.sources.tables import durable

WORDS = 4
PERCENT = 85
WINDOW = 4_000_000  # shingles that a task counts at a time
LOCALLY_FREQUENT = 4
FREQUENT = 500_000  # places in the order that are settled by counts
LEAF = 32
FANOUT = 8
GROUP_BLOCK = 4096
CLUSTER_BLOCK = 256
FILTER_WORD_BITS = 18  # 64-bit words of the filter of ids


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    codes, offsets, distinct = words_of(pc.ascii_lower(texts))
    h = hash_words(distinct.to_pylist(), len(distinct))[codes]
    n = len(h) - words + 1
    grams = mix(*[h[k : k + n] for k in range(words)]) if n > 0 else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            short = [np.array([b - a], np.uint64), *(h[k : k + 1] for k in range(a, b))]
            out.append(mix(*short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def needed(x, y, percent: int = PERCENT):
    """Least overlap of sets of sizes x and y that link."""
    return -(-percent * (x + y) // (100 + percent))


def _frequent(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        total = 0

        def flush():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LOCALLY_FREQUENT
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(n[often])], ["shingle", "n"]
            )

        for block in blocks(batches):
            for s in shingle_sets(block.column("text"), words):
                key = fingerprint(s)
                if key not in seen:
                    seen.add(key)
                    held.append(s)
                    total += len(s)
            if total >= WINDOW:
                yield flush()
                held, seen, total = [], set(), 0
        if held:
            yield flush()

    return run


def frequent_shingles(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """Up to `FREQUENT` shingles in rising order of their counts: a table of fixed size."""
    counts = (
        docs.filter(F.col("text").isNotNull())
        .select("text")
        .mapInArrow(_frequent(words), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )
    top = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    return top["shingle"].to_numpy()[::-1].view(np.uint64)


def signature(s: np.ndarray) -> bytes:
    """Bitmap with a power of two of bits, at least four for each element; bit = hash mod size."""
    bits = max(64, 1 << int(4 * len(s) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _describe(frequent: np.ndarray, words: int, percent: int):
    order = np.argsort(frequent)
    known = frequent[order]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = []
            for s in shingle_sets(block.column("text"), words):
                n = len(s)
                take = n - (percent * n + 99) // 100 + 1 if n else 0
                rank = np.zeros(n, np.int64)
                if len(known) and n:
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, order[at] + 1, 0)
                first = np.argsort(rank, kind="stable")[:take]
                often = rank[first] > 0
                rows.append(
                    (n, *fingerprint(s), s[first[~often]].view(np.int64), s[first[often]].view(np.int64))
                    + (signature(s),)
                )
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                ["doc_id", "n", "k1", "k2", "rare", "often", "bits"],
            )

    return run


def _groups(percent: int):
    """Rows (hub, rep) for shingles found in two classes or more whose sizes lie close enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, last = None, None
        for batch in batches:
            token, n, rep = (batch.column(c).to_numpy() for c in ("shingle", "n", "rep"))
            hubs, reps = [], []
            # The first class of a chain of close sizes names the group.
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (100 * n[:-1] < percent * n[1:])
            if last is not None and len(token):
                new[0] = token[0] != last[0] or 100 * last[1] < percent * n[0]
            starts = np.flatnonzero(new)
            chain = np.cumsum(new) - 1
            own = np.where(chain >= 0, rep[starts[np.maximum(chain, 0)]] if len(starts) else 0, 0)
            own = np.where(chain < 0, hub if hub is not None else 0, own)
            member = ~new
            hubs = own[member]
            reps = rep[member]
            if len(token):
                hub, last = int(own[-1]), (token[-1], n[-1])
            pair = np.unique(np.stack([hubs, reps], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0].astype(np.int64)), pa.array(pair[:, 1].astype(np.int64))],
                ["hub", "rep"],
            )

    return run


class SignatureTree:
    """Bitmaps of one group as a tree of nodes (sizes, OR of bitmaps) over rows ordered by size."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes], percent: int, width: int):
        self.percent = percent
        folded = np.stack([self._fold(np.frombuffer(b, np.uint64), width // 8) for b in bitmaps])
        self.order = np.lexsort((folded[:, 0], sizes))
        self.sizes, self.rows = sizes[self.order], folded[self.order]
        # Elements of a set beyond one for each bit: common elements may exceed common bits by these.
        self.slack = self.sizes - np.bitwise_count(self.rows).sum(axis=1, dtype=np.int64)
        n = len(sizes)
        self.levels = [[(i, min(i + LEAF, n)) for i in range(0, n, LEAF)]]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(
                [
                    (below[i][0], below[min(i + FANOUT, len(below)) - 1][1])
                    for i in range(0, len(below), FANOUT)
                ]
            )
        self.unions = [
            [np.bitwise_or.reduce(self.rows[a:b], axis=0) for a, b in spans] for spans in self.levels
        ]
        self.slacks = [[int(self.slack[a:b].max()) for a, b in spans] for spans in self.levels]

    @staticmethod
    def _fold(bits: np.ndarray, width: int) -> np.ndarray:
        return np.bitwise_or.reduce(bits.reshape(-1, width), axis=0)

    def _possible(self, level: int, i: int, j: int) -> bool:
        """Whether rows below two nodes (i before j) can link, by their sizes and bitmaps."""
        (a, b), (c, d) = self.levels[level][i], self.levels[level][j]
        low, high = int(self.sizes[a]), int(self.sizes[c])
        if i != j and 100 * int(self.sizes[b - 1]) < self.percent * high:
            return False
        common = int(np.bitwise_count(self.unions[level][i] & self.unions[level][j]).sum())
        most = common + min(self.slacks[level][i], self.slacks[level][j])
        return most >= needed(low, high, self.percent)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of rows (in tree order) that no bound rules out, from pairs of leaves."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            if not self._possible(level, i, j):
                continue
            if level:
                n = len(self.levels[level - 1])
                left = range(i * FANOUT, min((i + 1) * FANOUT, n))
                right = range(j * FANOUT, min((j + 1) * FANOUT, n))
                stack += [(level - 1, p, q) for p in left for q in right if p <= q]
                continue
            (a, b), (c, d) = self.levels[0][i], self.levels[0][j]
            both = self.rows[a:b, None] & self.rows[None, c:d]
            common = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
            most = common + np.minimum(self.slack[a:b, None], self.slack[None, c:d])
            x, y = self.sizes[a:b, None], self.sizes[None, c:d]
            fit = (most >= needed(x, y, self.percent)) & (
                100 * np.minimum(x, y) >= self.percent * np.maximum(x, y)
            )
            p, q = np.nonzero(fit)
            keep = p + a < q + c
            if keep.any():
                yield p[keep] + a, q[keep] + c


def candidate_pairs(
    sizes: np.ndarray, bitmaps: list[bytes], percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of row pairs that may link, from one tree for each bitmap width.

    Sets that link have widths that are equal or one step apart; the wider bitmap is folded.
    """
    width = np.array([len(b) for b in bitmaps])
    for w in np.unique(width).tolist():
        own = width == w
        near = (width == 2 * w) & (percent * sizes <= 100 * sizes[own].max())
        use = np.flatnonzero(own | near)
        if len(use) < 2:
            continue
        tree = SignatureTree(sizes[use], [bitmaps[i] for i in use], percent, w)
        for p, q in tree.pairs():
            p, q = use[tree.order[p]], use[tree.order[q]]
            keep = own[p] | own[q]
            yield p[keep], q[keep]


def _candidates(percent: int):
    """Rows (root, rep): clusters of classes that the tree of their group could not tell apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_runs(batches, ["hub", "low", "high"]):
            if len(rows) < 2:
                continue
            rep, block = rows.column("rep").to_numpy(), rows.column("block").to_numpy()
            cross = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
            union = Union(len(rep))
            place = np.argsort(np.argsort(rep))  # roots are the smallest ids
            touched: set[int] = set()
            sizes, bitmaps = rows.column("n").to_numpy(), rows.column("bits").to_pylist()
            for p, q in candidate_pairs(sizes, bitmaps, percent):
                if cross:
                    apart = block[p] != block[q]
                    p, q = p[apart], q[apart]
                for i, j in zip(place[p].tolist(), place[q].tolist()):
                    union.join(i, j)
                    touched |= {i, j}
            if touched:
                ids = np.sort(rep)
                own = sorted(touched)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[[union.find(i) for i in own]]),
                        pa.array(ids[own]),
                    ],
                    ["root", "rep"],
                )

    return run


def _compare(words: int, percent: int):
    """Links (a, b) among the texts of one block or pair of blocks, enough to connect them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_runs(batches, ["root", "low", "high"]):
            if len(rows) < 2:
                continue
            ids = rows.column("doc_id").to_numpy()
            block = rows.column("block").to_numpy()
            known = rows.column("component").to_pylist()
            cross = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
            sets = []
            for part in blocks([rows]):
                sets += shingle_sets(part.column("text"), words)
            sizes = np.array([len(s) for s in sets])
            order = np.lexsort((ids, sizes))
            union = Union(len(ids))
            first: dict[int, int] = {}
            for i in order.tolist():
                if known[i] is not None:
                    union.join(i, first.setdefault(known[i], i))
                union.join(i, first.setdefault(("id", int(ids[i])), i))
            found = []
            for at, i in enumerate(order.tolist()):
                for j in order[:at][::-1].tolist():
                    if 100 * sizes[j] < percent * sizes[i] or not sizes[j]:
                        break
                    if cross and block[i] == block[j] or union.find(i) == union.find(j):
                        continue
                    least = needed(int(sizes[i]), int(sizes[j]), percent)
                    if len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= least:
                        union.join(i, j)
                        found.append((int(ids[i]), int(ids[j])))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"]
                )

    return run


def _filter_bits(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64))
    word = h & np.uint64((1 << FILTER_WORD_BITS) - 1)
    return word.astype(np.int64), np.uint64(1) << (h >> np.uint64(58))


def _filter_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = np.zeros(1 << FILTER_WORD_BITS, np.uint64)
    for batch in batches:
        np.bitwise_or.at(words, *_filter_bits(batch.column(0).to_numpy()))
    at = np.flatnonzero(words)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], ["w", "bits"])


def thinned(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) without most rows whose id is not in `ids`, before texts are joined.

    A Bloom filter of fixed size is gathered from the ids. It lets through all that are in and a
    few others; with very many ids it lets through everything, so it only saves work.
    """
    rows = ids.mapInArrow(_filter_words, "w long, bits long").groupBy("w").agg(F.bit_or("bits").alias("b"))
    rows = rows.toArrow()
    words = np.zeros(1 << FILTER_WORD_BITS, np.uint64)
    words[rows["w"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            word, bit = _filter_bits(batch.column("doc_id").to_numpy())
            yield batch.filter(pa.array((words[word] & bit) != 0))

    return docs.mapInArrow(run, docs.schema)


def _dealt(rows: DataFrame, key: str, id_: str, size: int) -> DataFrame:
    """`rows` with blocks by id, once for each pair of blocks of their group that they take part in."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / size).cast("long").alias("blocks"))
    return (
        rows.join(sizes, key)
        .withColumn("block", F.pmod(F.xxhash64(id_), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "blocks")
    )


def link(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    group_block: int = GROUP_BLOCK,
    cluster_block: int = CLUSTER_BLOCK,
) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of `docs`."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    frequent = frequent_shingles(docs, words)
    described = durable(
        docs.mapInArrow(
            _describe(frequent, words, percent),
            "doc_id long, n long, k1 long, k2 long, rare array<long>, often array<long>, bits binary",
        )
    )
    # Copies fall together before the shuffle; the first of each class brings its whole row.
    first = F.struct(F.col("doc_id").alias("rep"), "n", "rare", "often", "bits")
    own = durable(
        described.filter("n > 0 and doc_id is not null")
        .groupBy("k1", "k2")
        .agg(F.min_by(first, "doc_id").alias("first"))
        .select("k1", "k2", "first.*")
    )
    classes = own.select("k1", "k2", "rep")

    rare = (
        own.select(F.explode("rare").alias("shingle"), "n", "rep")
        .repartition("shingle")
        .sortWithinPartitions("shingle", "n", "rep")
        .mapInArrow(_groups(percent), "hub long, rep long")
    )
    # Frequent shingles may be in a prefix too; their groups can be large and are formed by a
    # join, whose large side Spark can split.
    often = own.select(F.explode("often").alias("shingle"), "rep")
    hubs = often.groupBy("shingle").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
    often = often.join(hubs.filter("hub < last"), "shingle").filter("rep <> hub").select("hub", "rep")
    members = durable(rare.unionByName(often).distinct())
    members = members.unionByName(members.select("hub", F.col("hub").alias("rep")).distinct())
    trees = _dealt(members, "hub", "rep", group_block).join(
        own.select("rep", "n", "bits"), "rep"
    )
    clusters = durable(
        trees.repartition("hub", "low", "high")
        .sortWithinPartitions("hub", "low", "high", "rep")
        .mapInArrow(_candidates(percent), "root long, rep long")
        .distinct()
    )
    texts = durable(thinned(docs.filter(F.col("text").isNotNull()), clusters.select("rep")))
    compare = lambda rows: (
        rows.join(texts, F.col("rep") == F.col("doc_id"))
        .select("root", "low", "high", "block", "component", "doc_id", "text")
        .repartition("root", "low", "high")
        .sortWithinPartitions("root", "low", "high")
        .mapInArrow(_compare(words, percent), "a long, b long")
    )
    # First round: blocks of each cluster, every one with the cluster's root.
    dealt = _dealt(clusters, "root", "rep", cluster_block)
    inside = dealt.filter("low = high")
    roots = inside.filter("rep <> root").select("root", "low", "high").distinct()
    roots = roots.withColumns({"rep": F.col("root"), "block": F.col("low")})
    inside = inside.filter("rep <> root").unionByName(roots).withColumn("component", F.lit(None).cast("long"))
    equal = (
        described.filter("n > 0")
        .select("doc_id", "k1", "k2")
        .join(classes, ["k1", "k2"])
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        .filter("a <> b")
    )
    links = durable(compare(inside))
    # Second round: pairs of blocks of the clusters that have not come together.
    joined = components(links).withColumnRenamed("node", "rep")
    apart = clusters.join(joined, "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    open_ = apart.groupBy("root").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = open_.filter("x < y").select("root")
    more = _dealt(apart.join(open_, "root"), "root", "rep", cluster_block).filter("low < high")
    everything = links.unionByName(compare(more)).unionByName(equal)
    final = components(everything)
    return (
        described.select("doc_id", F.col("n").alias("n_shingles"))
        .join(final, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
