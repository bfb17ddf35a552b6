"""Quality rules: a decision list learned from labelled text statistics, as Spark conditions.

Statistics of a text are plain column expressions. Labelled documents are reduced to one row of
statistics each, cut at quantiles into bins. Sequential covering then learns rules that reject:
a rule grows by the threshold condition of highest information gain on the growing part, is
pruned back to the prefix of highest value on the pruning part, and is taken up if it is precise
enough there; what it covers leaves the table. Every step is one aggregate over the labelled
rows and brings a histogram of fixed size to the driver. The result is an ordered list of
conjunctions, emitted as one CASE expression.

Null texts have no words. Rows without a label teach nothing; a document labelled twice counts
with its lower label; with no labels at all the list is empty and only the base rules hold. Null
ids get their row like all others. An empty table gives no rows. Rules are tried in order, so a text
that several cover counts for the first. Statistics are taken from whole texts of any length; columns other than
doc_id and text are kept beside them and never read.

The list is bounded by parameters: at most `MAX_RULES` rules of `MAX_CONDITIONS` conditions, with `CUTS` cuts for
each statistic. Covering usually ends before, when no rule is precise enough on the pruning part.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import WHITE, WORD
from sightline.sources.tables import durable

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
}
CUTS = 24
MAX_RULES = 12
MAX_CONDITIONS = 3
MIN_PRECISION = 0.9
MIN_COVER = 5
HIST = ("grow_bad", "grow_good", "prune_bad", "prune_good")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_in(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more.

    Windows are compared by 64-bit hashes. A text without equal windows, the usual case, is done
    after one pass; else windows are sorted by hash, so that equal ones are neighbours.
    """

    def among(windows: Column) -> Column:
        def neighbours(s: Column) -> Column:
            h = lambda k: F.get(s, k)["h"]
            equal = lambda k, j: F.coalesce(h(k) == h(j), F.lit(False))
            place = lambda k: F.when(equal(k, k - 1) | equal(k, k + 1), F.get(s, k)["i"])
            found = F.array_compact(F.transform(F.sequence(F.lit(0), F.size(s) - 1), place))
            spread = F.flatten(F.transform(found, lambda i: F.array(i, i + 1, i + 2)))
            return F.size(F.array_distinct(spread))

        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(F.sort_array(placed), neighbours)
        )

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(F.transform(at, window), among))

    return let(words, of)


def statistics(docs: DataFrame) -> DataFrame:
    """`docs` with a struct column `__q` of the counts that all features are made of."""
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    duplicates = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    words = let(
        words_in(text),
        lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r")),
    )
    counts = F.struct(
        words.alias("w"),
        duplicates.alias("l"),
        (F.length(text) - count(r"[\x20\x09-\x0D]")).alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count("[A-Z]").alias("n_capitals"),
        count("[!?]").alias("n_marks"),
        count("[0-9]").alias("n_digits"),
    )
    q = let(
        counts,
        lambda c: F.struct(
            c["w"]["n"].cast("long").alias("n_words"),
            c["word_chars"].cast("long").alias("word_chars"),
            c["n_symbols"].alias("n_symbols"),
            (c["l"]["n"] - c["l"]["d"]).cast("long").alias("n_dup_lines"),
            c["w"]["r"].cast("long").alias("n_repeat_words"),
            c["l"]["n"].cast("long").alias("n_lines"),
            *[c[n].alias(n) for n in ("n_capitals", "n_marks", "n_digits")],
        ),
    )
    return docs.withColumn("__q", q)


def base_failed(q: Callable[[str], Column]) -> Column:
    return (q("n_words") < MIN_WORDS) | (100 * q("n_repeat_words") > MOST_REPEATED * q("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = list[Condition]


def rule_column(rules: list[Rule]) -> Column:
    """The first rule that holds, as text, over the columns of `statistics`; null if none does."""
    out = None
    for rule in rules:
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.column()
        text = F.lit(" and ".join(map(str, rule)))
        out = F.when(holds, text) if out is None else out.when(holds, text)
    return F.lit(None).cast("string") if out is None else out


def _gain(bad: float, good: float, all_bad: float, all_good: float) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules from the labelled rows of `stats` (doc_id and the counts) that pass the base rules.

    Two thirds of the labelled rows grow rules and one third prunes them, by a hash of the id.
    """
    known = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id")
    known = known.agg((F.min("quality") == 0).alias("bad"))
    values = F.array(*[F.expr(x).cast("double") for x in FEATURES.values()])
    rows = (
        stats.filter(~base_failed(F.col))
        .join(known, "doc_id")
        .select("bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"), values.alias("v"))
    )
    names = list(FEATURES)
    shares = [F.lit((k + 1) / (CUTS + 1)) for k in range(CUTS)]
    # Cuts come from the rejected rows as well as from all, so that rare junk is resolved.
    cuts = rows.agg(
        *[
            F.array_distinct(
                F.concat(
                    F.percentile_approx(F.get("v", F.lit(i)), F.array(*shares), 1000),
                    F.coalesce(
                        F.percentile_approx(
                            F.when(F.col("bad"), F.get("v", F.lit(i))), F.array(*shares), 1000
                        ),
                        F.array().cast("array<double>"),
                    ),
                )
            ).alias(n)
            for i, n in enumerate(names)
        ]
    ).first()
    if cuts[0] is None:
        return []
    edges = [sorted(cuts[n]) for n in names]

    def bin_of(i: int, cuts: list[float]) -> Column:
        """How many cuts a value reaches."""
        reached = F.filter(F.array(*map(F.lit, cuts)), lambda t: t <= F.get("v", F.lit(i)))
        return F.size(reached)

    binned = durable(
        rows.select(
            "bad",
            "prune",
            F.array(*[bin_of(i, e) for i, e in enumerate(edges)]).alias("bins"),
        )
        .groupBy("bad", "prune", "bins")
        .agg(F.count("*").alias("n"))
    )

    def test(i: int, at_least: bool, k: int) -> Column:
        b = F.get("bins", F.lit(i))
        return b >= k if at_least else b < k

    def histogram(covered: Column) -> dict:
        sums = [
            F.sum(F.when((F.col("prune") == p) & (F.col("bad") == b), F.col("n")).otherwise(0))
            for p in (False, True)
            for b in (True, False)
        ]
        got = binned.filter(covered).select("*", F.posexplode("bins").alias("i", "k"))
        got = got.groupBy("i", "k").agg(*[s.alias(n) for s, n in zip(sums, HIST)])
        return {(r["i"], r["k"]): [float(r[n]) for n in HIST] for r in got.collect()}

    def candidates(h: dict):
        """Each condition with the counts of the rows it covers."""
        for i, e in enumerate(edges):
            cells = [h.get((i, k), [0.0] * 4) for k in range(len(e) + 1)]
            below = [0.0] * 4
            total = [sum(c[j] for c in cells) for j in range(4)]
            for k in range(1, len(e) + 1):
                below = [x + y for x, y in zip(below, cells[k - 1])]
                yield (i, False, k), below
                yield (i, True, k), [x - y for x, y in zip(total, below)]

    rules: list[Rule] = []
    free = F.lit(True)
    for _ in range(MAX_RULES):
        covered, grown, trail = free, [], []
        for _ in range(MAX_CONDITIONS):
            h = histogram(covered)
            total = [sum(c[j] for (i, _), c in h.items() if i == 0) for j in range(4)]
            if not total[0] or not total[1]:
                break
            found = [
                (_gain(c[0], c[1], total[0], total[1]), key, c)
                for key, c in candidates(h)
                if c[0] >= MIN_COVER
            ]
            if not found:
                break
            gain, key, counts = max(found, key=lambda x: (x[0], [-y for y in x[1]]))
            if gain <= 1e-9:
                break
            grown.append(key)
            trail.append(counts)
            covered = covered & test(*key)
        if not grown:
            break
        value = [(c[2] - c[3]) / max(c[2] + c[3], 1.0) for c in trail]
        keep = max(range(len(grown)), key=lambda j: (value[j], -j)) + 1
        bad, good = trail[keep - 1][2:]
        if bad < MIN_COVER / 2 or bad < MIN_PRECISION * (bad + good):
            break
        grown = grown[:keep]
        rules.append([Condition(names[i], up, edges[i][k - 1]) for i, up, k in grown])
        held = F.lit(True)
        for key in grown:
            held = held & test(*key)
        free = free & ~held
    return rules


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """`stats` with base_failed, kept and the rule that rejected the row."""
    rule = F.when(~base_failed(F.col), rule_column(rules))
    out = stats.withColumn("rule", rule).withColumn("base_failed", base_failed(F.col))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
