"""Mixing sources to target weights by temperature.

With p the sources' shares of all tokens, the weights are p ** tau, normalised. The exponent is
bisected between 1 (as found) and 0 (all alike): it is the largest that reaches the target
entropy, raised as far as needed to keep every source within the repetition limit. Each round
evaluates `GRID` exponents at once, as sums over one row per source, so only a few numbers come
to the driver.

Weights are realised under a token budget as block permutations. A source's stream is its
documents in one pseudo-random order after the other, each order a permutation of all of them
(an epoch). A source gives whole epochs as long as its part of the budget lasts and then the
longest stretch of the next permutation that fits. That stretch is all documents up to one hash
value, found from sums in 4096 hash ranges and from the one range where the budget ends, so no
task orders a whole source. What a source gives is stretched over the whole schedule, which is cut
into blocks of about `BLOCK_TOKENS` tokens; every block has each source in proportion, as nearly as
whole documents allow, in hash order.

Without a budget the smallest one is taken that gives every document at least once. A null
source is the source named by the empty string, null texts have no tokens. Sources without
tokens keep one copy. Rows repeated in every column share their place and fate. Very long texts are
whole items, and an empty table gives no rows. `mix_documents` keeps all columns as they are, whatever their names.
All steps are built-in column functions; sources of any size are aggregated before they meet.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.llm.text import WORD
from sightline.sources.tables import durable

GRID = 16
ROUNDS = 8
RANGE_BITS = 12
BLOCK_TOKENS = 1_000_000


@dataclass
class Mix:
    exponent: float
    budget: float
    sources: DataFrame  # source, tokens, weight, quota, epochs, last_key


def items(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens (words) and the hash that all permutations come from."""
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        F.xxhash64("doc_id", "source", "text").alias("h"),
    )


def _moments(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the sums of p ** tau and p ** tau * log p."""
    sums = [
        F.sum(x).alias(f"{n}{i}")
        for i, t in enumerate(exponents)
        for n, x in (("z", F.pow("p", F.lit(t))), ("l", F.pow("p", F.lit(t)) * F.log("p")))
    ]
    row = shares.agg(*sums).first()
    return [(row[f"z{i}"], row[f"l{i}"]) for i in range(len(exponents))]


def find_exponent(
    shares: DataFrame, target_entropy: float | None, repetition: float | None, budget_share: float | None
) -> float:
    """The exponent, for `shares` with one row p per source that has tokens.

    `target_entropy` is a fraction of the largest entropy possible, log(number of sources);
    `budget_share` is the budget as a multiple of all tokens (None: every document once).
    """
    ends = shares.agg(F.count("*").alias("n"), F.min("p").alias("low"), F.max("p").alias("high")).first()
    if not ends["n"] or ends["n"] == 1:
        return 1.0

    def entropy_short(t: float, z: float, l: float) -> bool:  # noqa: E741
        return math.log(z) - t * l / z < target_entropy * math.log(ends["n"]) - 1e-12

    def repeats_within(t: float, z: float, l: float) -> bool:  # noqa: E741
        if budget_share is None:
            return (ends["high"] / ends["low"]) ** (1 - t) <= repetition + 1e-12
        return budget_share * ends["low"] ** (t - 1) / z <= repetition + 1e-12

    def bisect(upper_side) -> tuple[float, float]:
        """Neighbouring exponents below and from which on `upper_side` holds."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            points = [low + (high - low) * (k + 1) / (GRID + 1) for k in range(GRID)]
            inside = [upper_side(t, *m) for t, m in zip(points, _moments(shares, points))]
            edges = [low, *points, high]
            k = inside.index(True) if True in inside else GRID
            low, high = edges[k], edges[k + 1]
        return low, high

    at = lambda t: (t, *_moments(shares, [t])[0])
    exponent = 1.0
    if target_entropy is not None and entropy_short(*at(1.0)):
        exponent = 0.0 if entropy_short(*at(0.0)) else bisect(entropy_short)[0]
    if repetition is not None and not repeats_within(*at(exponent)):
        exponent = bisect(repeats_within)[1] if repeats_within(*at(1.0)) else 1.0
    return exponent


def plan(
    rows: DataFrame,
    target_entropy: float | None = 0.95,
    repetition: float | None = 4.0,
    budget: int | None = None,
) -> Mix:
    """Weights and what of each source's permutations is used, for `items`.

    If the repetition limit cannot be kept at any exponent, the budget of every source is cut to
    the limit.
    """
    sources = durable(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.filter("tokens > 0").select((F.col("tokens") / F.lit(max(total, 1))).alias("p"))
    t = find_exponent(shares, target_entropy, repetition, None if budget is None else budget / max(total, 1))
    z = _moments(shares, [t])[0][0] or 1.0
    high = shares.agg(F.max("p")).first()[0] or 1.0
    whole = total * high ** (1 - t) * z if budget is None else float(budget)
    p = F.col("tokens") / F.lit(max(total, 1))
    weight = F.when(F.col("tokens") > 0, F.pow(p, F.lit(t)) / z).otherwise(0.0)
    # A hair above the quotient, so that the source that sets the budget gets its whole epoch.
    quota = F.floor(F.col("weight") * F.lit(whole) * (1 + 1e-9) + 1e-6)
    if repetition is not None:
        quota = F.least(quota, F.floor(F.col("tokens") * F.lit(float(repetition))))
    quotas = (
        sources.withColumn("weight", weight)
        .withColumn("quota", quota.cast("long"))
        .withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(F.lit(1)))
        .withColumn("rest", F.when(F.col("tokens") > 0, F.expr("quota % tokens")).otherwise(F.lit(0)))
    )
    keyed = rows.join(quotas.select("source", "epochs", "rest"), "source").select(
        "source", "n_tokens", "rest", F.xxhash64("h", "epochs").alias("key")
    )
    keyed = keyed.withColumn("range", F.shiftright("key", 64 - RANGE_BITS))
    before = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = (
        keyed.groupBy("source", "range")
        .agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"), F.max("key").alias("key"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter("before <= rest")
    )
    ranges = durable(ranges)
    fits = ranges.filter("before + n <= rest").groupBy("source").agg(F.max("key").alias("full_key"))
    edge = ranges.filter("before + n > rest").select("source", "range", "before")
    run = F.sum("n_tokens").over(W.partitionBy("source").orderBy("key"))
    part = (
        keyed.join(edge, ["source", "range"])
        .withColumn("upto", F.col("before") + run)
        .filter("upto <= rest")
        .groupBy("source")
        .agg(F.max("key").alias("part_key"))
    )
    ends = quotas.join(fits, "source", "left").join(part, "source", "left")
    last = F.when(F.col("rest") > 0, F.greatest("full_key", "part_key"))
    return Mix(t, whole, durable(ends.select("source", "tokens", "weight", "quota", "epochs", last.alias("last_key"))))


def _dealt(rows: DataFrame, mix: Mix) -> DataFrame:
    sources = mix.sources.withColumnsRenamed({"source": "__source", "tokens": "source_tokens"})
    tail = F.coalesce(F.xxhash64("h", "epochs") <= F.col("last_key"), F.lit(False)).cast("long")
    return (
        rows.join(sources, F.col("source") == F.col("__source"))
        .withColumn("copies", F.col("epochs") + tail)
        .drop("__source")
    )


def copies(rows: DataFrame, mix: Mix) -> DataFrame:
    """`rows` (with source and h) and the weight of their source and their number of copies."""
    return _dealt(rows, mix).drop("last_key", "quota")


def mix_documents(docs: DataFrame, **wishes) -> DataFrame:
    """`docs` with every row as often as its source's weight asks for; columns stay as they are.

    Rows are laid out in the order of the schedule, each partition a stretch of it.
    """
    mix = plan(durable(items(docs)), **wishes)
    rows = docs.select(
        F.struct(*docs.columns).alias("__row"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.xxhash64("doc_id", "source", "text").alias("h"),
    )
    out = emit(rows, mix).select("__row", "block", "position", "h", "epoch")
    order = ["block", "position", "h", "epoch"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select("__row.*")


def scheduled(rows: DataFrame, mix: Mix) -> DataFrame:
    """`copies` and `places`, the epoch, block and position of each copy; none if it has no copy.

    `position` runs from 0 to 1 over the whole schedule; sorting by it gives the training order.
    """
    unit = lambda key: F.shiftright(key, 11) / F.lit(float(1 << 53)) + 0.5
    used = mix.sources.agg(F.sum("quota")).first()[0] or 0
    n_blocks = max(1, math.ceil(used / BLOCK_TOKENS))
    # The tail ends at its last key even where few documents make that differ from its tokens' part.
    given = F.col("quota") / F.greatest("source_tokens", F.lit(1))
    length = F.greatest(given, F.col("epochs") + unit(F.col("last_key")), F.col("epochs").cast("double"))
    out = _dealt(rows, mix).withColumn("__length", F.nullif(length, F.lit(0.0)))

    def place(epoch):
        at = (epoch + unit(F.xxhash64("h", epoch))) / F.col("__length")
        return F.struct(
            epoch.alias("epoch"),
            F.least(F.floor(at * n_blocks), F.lit(n_blocks - 1)).cast("long").alias("block"),
            at.alias("position"),
        )

    places = F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), place)
    none = F.array().cast("array<struct<epoch: bigint, block: bigint, position: double>>")
    return out.withColumn("places", F.when(F.col("copies") > 0, places).otherwise(none)).drop(
        "__length", "last_key", "quota"
    )


def emit(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row for each copy of a document, with epoch, block and position as in `scheduled`."""
    out = scheduled(rows, mix).withColumn("__place", F.explode("places"))
    return out.select("*", "__place.*").drop("__place", "places")
