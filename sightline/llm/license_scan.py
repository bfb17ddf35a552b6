"""Licence scans: normalised text against licence templates by Dice over word bigrams.

A text is compared as a whole, by paragraphs (blank lines between them) and by lines, so a licence
file is found, and a notice inside a document if it makes up nearly all of a paragraph or line. A
notice of several lines that shares its paragraph with much other text, or a sentence within a
much longer line, is not found. Units are lower-cased and cut into words at
everything but letters and digits. With A and B the sets of word bigrams of unit and template, the
unit matches if 2 |A and B| / (|A| + |B|) is at least the threshold t.

Two bounds prune without losing a match. By size, a match needs
t / (2 - t) |B| <= |A| <= (2 - t) / t |B|. By content, it holds at least t / (2 - t) |B| bigrams
of B, so it has a word from any set of words that touches more of B's bigrams than may be missing; a
text or unit without any such anchor word is left after one look at its words. Templates of `LONG`
bigrams and more have anchor words of their own, which count only in units long enough for them.

Everything is built-in column expressions over the row, with no join and no shuffle. Null,
empty and wordless texts match nothing, and neither do units of one word. Equal values are
settled by licence name. Rows keep their number; ids may be null or repeated. An empty table gives no
rows. Very long texts are cut into units like others. Columns other than doc_id and text are left behind.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.license_templates import TEMPLATES
from sightline.llm.quality_rules import let

THRESHOLD = 0.8
NO_WORD = r"[^\p{L}\p{N}]+"
PARAGRAPHS = r"\n[ \t\r]*\n"
LONG = 400
#: Words that say little; anchors are taken from the others as far as those suffice.
COMMON = frozenset(
    "that this with from have your such which will their other under these they them been than "
    "when where what about into also only more must makes make each does".split()
)
#: Keeps equality at the bounds safe from rounding.
SLACK = 1e-9


def bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def least_common(n: int, threshold: float = THRESHOLD) -> float:
    return n * threshold / (2 - threshold)


def anchors(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every match of any template has one, chosen to be few and long."""
    chosen: dict[str, None] = {}
    for _, text in templates:
        grams = bigrams(text)
        need = len(grams) - least_common(len(grams), threshold)
        covered = lambda: sum(any(w in chosen for w in g.split()) for g in grams)
        while covered() <= need:
            open_ = [g for g in grams if not any(w in chosen for w in g.split())]
            gain = Counter(w for g in open_ for w in set(g.split()))
            chosen[max(gain, key=lambda w: (len(w) > 3 and w not in COMMON, gain[w], len(w), w))] = None
    return list(chosen)


def _anchored(words: Column, threshold: float) -> Column:
    """False only if a unit, or a text with all its units, can match no template."""
    has = lambda chosen: F.arrays_overlap(words, F.array(*map(F.lit, chosen)))
    sizes = [(len(bigrams(body)), (name, body)) for name, body in TEMPLATES]
    short = has(anchors([t for n, t in sizes if n < LONG], threshold))
    long_ = [(n, t) for n, t in sizes if n >= LONG]
    if not long_:
        return short
    least = least_common(min(n for n, _ in long_), threshold)
    return short | ((F.size(words) > least) & has(anchors([t for _, t in long_], threshold)))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")


def _matches(words: Column, templates: Column, threshold: float) -> Column:
    """(dice, license) of all templates that a unit's words match, once per licence and value."""

    def pairs(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 2)
        gram = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))
        return F.array_distinct(F.transform(at, gram))

    def compare(a: Column) -> Column:
        n = F.size(a)
        low, high = threshold / (2 - threshold), (2 - threshold) / threshold
        fit = F.filter(templates, lambda t: (n >= t["n"] * low - SLACK) & (n <= t["n"] * high + SLACK))
        dice = lambda t: (2.0 * F.size(F.array_intersect(a, t["grams"]))) / (n + t["n"])
        scored = F.transform(
            fit, lambda t: F.struct(dice(t).alias("dice"), t["license"].alias("license"))
        )
        return F.filter(scored, lambda s: s["dice"] >= threshold)

    none = F.array().cast("array<struct<dice: double, license: string>>")
    return let(
        words,
        lambda w: F.when((F.size(w) > 1) & _anchored(w, threshold), let(pairs(w), compare)).otherwise(none),
    )


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license (best match, null if none), dice, licenses (all, by name), n_matches."""
    text = F.coalesce(F.col("text"), F.lit(""))
    templates = F.array(
        *[
            F.struct(
                F.lit(name).alias("license"),
                F.lit(len(bigrams(body))).alias("n"),
                F.split(F.lit("|".join(bigrams(body))), r"\|").alias("grams"),
            )
            for name, body in TEMPLATES
        ]
    )
    paragraphs, lines = F.split(text, PARAGRAPHS), F.split(text, "\n")
    more = lambda units: F.when(F.size(units) > 1, units).otherwise(F.array().cast("array<string>"))
    units = F.array_distinct(F.concat(F.array(text), more(paragraphs), more(lines)))
    found = F.flatten(F.transform(units, lambda u: _matches(words_of(u), templates, threshold)))
    none = F.array().cast("array<struct<dice: double, license: string>>")
    hits = let(words_of(text), lambda w: F.when(_anchored(w, threshold), found).otherwise(none))
    top = F.array_max(F.transform(F.col("__hits"), lambda h: h["dice"]))
    names = F.array_sort(F.array_distinct(F.transform(F.col("__hits"), lambda h: h["license"])))
    best = F.array_min(
        F.transform(F.filter(F.col("__hits"), lambda h: h["dice"] == top), lambda h: h["license"])
    )
    return docs.select(F.col("doc_id").cast("long"), hits.alias("__hits")).select(
        "doc_id",
        best.alias("license"),
        top.alias("dice"),
        F.concat_ws(",", names).alias("licenses"),
        F.size("__hits").cast("long").alias("n_matches"),
    )


def sql(threshold: float = THRESHOLD) -> str:
    """The same result, with neither bound, as SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n".join(f"({i}, {quote(n)}, {quote(t)})" for i, (n, t) in enumerate(TEMPLATES))
    words = r"[x for x in string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+') if x <> '']"
    grams = "list_distinct([{0}[i] || ' ' || {0}[i + 1] for i in range(1, len({0}))])"
    return f"""
with templates(i, license, body) as (values {values}),
t as (
  select i, license, {grams.format('w')} as g
  from (select i, license, {words.format('body')} as w from templates)
),
texts as (select row_number() over () as r, doc_id, coalesce("text", '') as x from documents),
parts as (
  select r, x as u from texts
  union all
  select r, unnest(p) from (select r, string_split_regex(x, '\\n[ \\t\\r]*\\n') as p from texts) where len(p) > 1
  union all
  select r, unnest(p) from (select r, string_split(x, chr(10)) as p from texts) where len(p) > 1
),
units as (
  select r, {grams.format('w')} as g
  from (select r, {words.format('u')} as w from (select distinct r, u from parts)) where len(w) > 1
),
hits as (
  select r, license, 2.0::double * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) as dice
  from units u, t
  where 2.0::double * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) >= {threshold}
),
best as (
  select r, max(dice) as dice, string_agg(distinct license, ',' order by license) as licenses,
    count(*) as n_matches, arg_min(license, struct_pack(a := -dice, b := license)) as license
  from hits group by r
)
select doc_id, license, dice, coalesce(licenses, '') as licenses,
  coalesce(n_matches, 0)::bigint as n_matches
from texts left join best using (r)
"""
