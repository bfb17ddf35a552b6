"""Column builders shared by the cleaning jobs. Everything stays inside Spark's built-ins."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"
US_STYLE = r"^(\d{1,2})/(\d{1,2})/(\d{4})\b"
ISO_STYLE = r"^\d{4}-\d{1,2}-\d{1,2}"
ANY_DAY = rf"{US_STYLE}|{ISO_STYLE}"
US_MINUTES = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$"
LONG_DIGITS = r"^[0-9]{10,13}$"
MILLIS_FROM, MILLIS_TO = 10_000_000_000, 253_402_300_800_000  # up to the end of year 9999
MAYBE_WHOLE = r"^[^A-Za-z]*[0-9]"
MAYBE_NUMBER = r"^[^/:]*[0-9][^/:]*$"
NAMED_MONTH = r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def upper_trim(c: Column, default: str) -> Column:
    return F.trim(F.upper(F.coalesce(c, F.lit(default))))


def parse_number(c: Column) -> Column:
    """Plain decimal text to double; exponents and bare points are rejected."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def try_whole(c: Column) -> Column:
    """`try_cast` to int. Texts with a letter before any digit are never cast: Spark raises and catches
    an exception for each text that is no number, which costs more than all else that a row asks for."""
    return F.when(c.rlike(MAYBE_WHOLE), c.try_cast("int"))


def parse_timestamp(c: Column) -> Column:
    """Text that starts with `M/d/yyyy` or `yyyy-M-d`, with or without a time, free of zones."""
    iso = F.regexp_replace(c, US_STYLE, "$3-$1-$2")
    return F.when(c.rlike(ANY_DAY), iso.try_cast("timestamp_ntz"))


def parse_date(c: Column) -> Column:
    """As `parse_timestamp`, plus `d-MMM-yyyy`."""
    named = F.when(c.rlike(NAMED_MONTH), F.try_to_date(F.initcap(c), "d-MMM-yyyy"))
    return F.coalesce(F.to_date(parse_timestamp(c)), named)


def from_millis(c: Column) -> Column:
    return F.timestamp_add("SECOND", F.floor(c / 1000), F.lit("1970-01-01").cast("timestamp_ntz"))


def timestamp_rules(c: Column, fallback: Column | None = None) -> list[tuple[str, Column]]:
    """The ordered attempts at reading a timestamp, by name; the first non-null one wins."""
    c = c.cast("string")
    # No number holds these signs or lacks a digit, but for those without an end, which are no time.
    number = F.when(c.rlike(MAYBE_NUMBER), c.try_cast("double"))
    rules = [
        ("us_minutes", F.when(c.rlike(US_MINUTES), parse_timestamp(c))),
        ("generic", parse_timestamp(c)),
        ("epoch_millis", F.when((number > MILLIS_FROM) & (number < MILLIS_TO), from_millis(number))),
        ("digits", F.when(c.rlike(LONG_DIGITS), from_millis(number))),
    ]
    if fallback is not None:
        rules.append(("fallback", parse_timestamp(fallback)))
    return rules


def coerce_timestamp(c: Column, fallback: Column | None = None) -> Column:
    return F.coalesce(*[attempt for _, attempt in timestamp_rules(c, fallback)])


def timestamp_rule_name(c: Column, fallback: Column | None = None) -> Column:
    """Name of the rule that reads a value. Numbers too large for any timestamp, which the rules
    leave to the fallback, are reported as `epoch_out_of_range`."""
    number = c.cast("string").try_cast("double")
    beyond = F.when(number >= MILLIS_TO, F.lit("epoch_out_of_range"))
    named = [F.when(a.isNotNull(), F.lit(n)) for n, a in timestamp_rules(c, fallback)]
    return F.coalesce(*named[:2], beyond, *named[2:], F.lit("none"))


def day_of(ts: Column) -> Column:
    """Midnight of the day, kept as a timestamp without zone."""
    return F.to_date(ts).cast("timestamp_ntz")


def period_start(ts: Column, unit: str) -> Column:
    return F.trunc(F.to_date(ts), unit).cast("timestamp_ntz")


def day_number(d: Column) -> Column:
    return F.unix_date(F.to_date(d))


def bucket(c: Column, decimals: int = 1) -> Column:
    return F.round(c, decimals)


def bucket_text(c: Column) -> Column:
    return c.cast("decimal(18,1)").cast("string")


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def surrogate_key(*parts: Column, sep: str = "-") -> Column:
    """md5 over the parts as text; a null part counts as empty text."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def sequence_suffix(n: Column, width: int = 6) -> Column:
    """Zero-padded number that keeps its digits beyond the width."""
    text = n.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def in_range(c: Column, low, high) -> Column:
    return F.when(c.between(low, high), c)


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def contains_any(c: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def ladder(steps: Iterable[tuple[Column, object]], default=None) -> Column:
    """First condition that holds gives the label."""
    out = None
    for condition, label in steps:
        label = label if isinstance(label, Column) else F.lit(label)
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def upto(c: Column, bands, above: str, default: str | None = None, strict: bool = False) -> Column:
    """Ascending upper limits (exclusive when `strict`), then everything above them."""
    steps = [((c < limit) if strict else (c <= limit), label) for limit, label in bands]
    last = bands[-1][0]
    return ladder([*steps, ((c >= last) if strict else (c > last), above)], default)


def atleast(c: Column, floors, below: str, default: str | None = None) -> Column:
    """Descending lower limits, then everything below; `default` is for null input."""
    steps = [(c >= limit, label) for limit, label in floors]
    if default is None:
        return ladder(steps, below)
    return ladder([*steps, (c < floors[-1][0], below)], default)


def within(c: Column, ranges, default: str, above: tuple | None = None) -> Column:
    steps = [(c.between(low, high), label) for low, high, label in ranges]
    if above is not None:
        steps.append((c > above[0], above[1]))
    return ladder(steps, default)


def by_words(c: Column, families, default) -> Column:
    """Keyword families over upper-cased text."""
    text = F.upper(c)
    return ladder([(contains_any(text, words), label) for label, words in families], default)


def by_members(c: Column, groups: dict, default) -> Column:
    return ladder([(c.isin(list(members)), label) for label, members in groups.items()], default)
