"""Secret scans by assignment-aware lexing.

The base scan finds three kinds of spans by pattern. The method adds `flow` spans: assignments
in source or configuration syntax are parsed into pairs of a name and a literal, constants are
propagated through later assignments of a name to a name and through concatenations, and a
literal is scored by how sensitive the names are that it reaches and by its own form. The span
of a `flow` finding is the literal where it is written.

Handled syntax: `name = "literal"`, `name := literal`, `name: literal`, `"name": "literal"`,
`name => literal`, with `export`, `set`, `const`, types and attribute paths before the name,
quotes of either kind or none, and `a = b + "x"`. Prose with a colon is no assignment: bare
literals count only if they look like a key, and the name has to be an identifier.

Work is in proportion to the text: chains of terms are walked once, names share the literals they hold,
and a literal is not scored again for what it was scored for before.

Offsets are code points, ends exclusive. Null texts count as empty. Every text is scanned
whole. Rows keep their order and number; null and repeated ids are scanned like any other. An empty
table gives no rows. `scan` reads doc_id and text alone, so other columns clash with nothing; `redact`
keeps all columns and changes text and n_chars.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import blocks

KINDS = ("assign", "access", "hex", "flow")
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Quick tests for texts that hold none of a kind.
STEMS = ("passw", "secret", "token", "api")
LONG_HEX = re.compile(r"[0-9a-f]{24}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*(?:[.-][A-Za-z_$][A-Za-z0-9_$]*)*", re.ASCII)
OPERATOR = re.compile(r":=|=>|[:=]")
VALUE = re.compile(
    r"[ \t]*(?:\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|([A-Za-z0-9+/_.=$-]+))", re.ASCII
)
PLUS = re.compile(r"[ \t]*[+.&][ \t]*(?=[\"'A-Za-z_$])")
SPLIT_NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Parts of names and how much they say that a value is secret.
SENSITIVE = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 2, "apikey": 3,
    "credential": 3, "credentials": 3, "private": 1, "access": 1, "auth": 2, "api": 1, "key": 2,
    "signing": 1, "encryption": 1, "bearer": 2, "session": 1, "client": 1, "salt": 1, "dsn": 2,
}
#: Parts of names that say the value only describes or points to a secret.
HARMLESS = frozenset("id name file path url uri type length size count limit field label".split())
PLACEHOLDER = re.compile(
    r"(?i)(?:x+|\*+|\.+|none|null|true|false|changeme|example|placeholder|your[_-].*|test|todo)$"
)
MIN_LITERAL = 6
MIN_SCORE = 4.0
#: Further hops take nothing more from a literal's score; literals are followed through any number.
COUNTED_HOPS = 4


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    lower = text.lower()
    if any(stem in lower for stem in STEMS):
        found = [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= MIN_ASSIGN
        ]
    if "AKIA" in text:
        hits = (m.span() for m in ACCESS.finditer(text))
        found += [(a, b, "access") for a, b in hits if b - a >= MIN_ACCESS]
    if LONG_HEX.search(text):
        hits = (m.span() for m in HEX.finditer(text))
        found += [(a, b, "hex") for a, b in hits if b - a >= MIN_HEX]
    return found


def entropy(literal: str) -> float:
    n = len(literal)
    return -sum(c / n * math.log2(c / n) for c in map(literal.count, set(literal)))


def name_score(name: str) -> float:
    parts = [p.lower() for p in SPLIT_NAME.findall(name)]
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    return float(sum(SENSITIVE.get(p, 0) for p in parts))


def literal_score(literal: str) -> float:
    """Up to 3: different kinds of characters and high entropy look like a key."""
    if len(literal) < MIN_LITERAL or PLACEHOLDER.match(literal) or len(set(literal)) < 4:
        return -10.0
    kinds = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return (kinds - 1) * 0.5 + (1.0 if entropy(literal) > 3.0 else 0.0) - ("\x20" in literal)


def _name_before(text: str, at: int) -> str:
    """The identifier, quoted or not, that ends before the operator at `at`."""
    end = at
    while end and text[end - 1] in " \t":
        end -= 1
    if end and text[end - 1] in "\"'":
        end -= 1
    start = end
    while start and (text[start - 1].isalnum() or text[start - 1] in "_$.-"):
        start -= 1
    m = NAME.fullmatch(text, start, end) or NAME.fullmatch(text, min(start + 1, end), end)
    return m[0] if m else ""


def assignments(text: str) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """Name and terms (kind, text, start, end) of every assignment, in text order.

    A chain of terms is walked once. An operator inside a chain, like the second one of
    `a=b&c=d`, takes only what follows up to the next operator or the end of its own term.
    """
    at, chained = 0, 0
    ends: list[int] = []
    while m := OPERATOR.search(text, at):
        at = m.end()
        name = _name_before(text, m.start())
        if not name:
            continue
        terms, pos = [], at
        if pos < chained:
            own = ends[bisect_right(ends, pos)]
            after = OPERATOR.search(text, pos, own)
            own = after.start() if after else own
            v = VALUE.match(text, pos, own)
            if v and v[3] is not None:
                kind = "name" if NAME.fullmatch(v[3]) else "bare"
                terms.append((kind, v[3], v.start(3), v.end(3)))
            if terms:
                yield name, terms
            continue
        ends = []
        while v := VALUE.match(text, pos):
            quoted = v[3] is None
            group = v.lastindex
            kind = "text" if quoted else "name" if NAME.fullmatch(v[3]) else "bare"
            terms.append((kind, v[group], v.start(group), v.end(group)))
            pos = v.end()
            ends.append(pos)
            more = PLUS.match(text, pos)
            if not more:
                break
            pos = more.end()
        if terms:
            yield name, terms
            chained = ends[-1]
            at = max(at, pos if terms[-1][0] == "text" else at)


class Run:
    """The literals a name holds, in order, with what is needed to score them as one text.

    A literal is (value's score, its length, start, end, the version it came with). Every further
    assignment of the run to a name is a new version, and a hop for the literals it has.
    """

    __slots__ = ("literals", "spans", "version", "shared", "chars", "size", "head", "tested")

    def __init__(self):
        self.literals: list[tuple[float, int, int, int, int]] = []
        self.spans: set[tuple[int, int]] = set()
        self.version, self.size, self.shared, self.head = 0, 0, False, ""
        self.chars: dict[str, int] = {}
        self.tested: dict[tuple[float, float, int], int] = {}

    def add(self, value: str, a: int, b: int, hops: int = 0) -> None:
        if (a, b) in self.spans:
            return
        self.spans.add((a, b))
        self.literals.append((literal_score(value), len(value), a, b, self.version - hops))
        for c in value:
            self.chars[c] = self.chars.get(c, 0) + 1
        self.size += len(value)
        if len(self.head) < 64:
            self.head += value

    def score(self) -> float:
        """`literal_score` of all literals put together."""
        if len(self.head) == self.size:
            return literal_score(self.head)
        if len(self.chars) < 4 or re.match("(?i)your[_-]", self.head):
            return -10.0
        kinds = sum(any(re.match(p, c) for c in self.chars) for p in ("[a-z]", "[A-Z]", "[0-9]"))
        bits = -sum(c / self.size * math.log2(c / self.size) for c in self.chars.values())
        return (kinds - 1) * 0.5 + (1.0 if bits > 3.0 else 0.0) - ("\x20" in self.chars)

    def sensitive(self, says: float, offset: int) -> Iterator[tuple[int, int]]:
        """Spans that score enough under a name that says so much.

        Literals that have all counted hops behind them score alike in every version, so they are
        tested once for a score of the name and of the whole.
        """
        whole = self.score() - 1
        start = settled = self.tested.get((says, whole, offset), 0)
        for i in range(start, len(self.literals)):
            own, size, a, b, version = self.literals[i]
            hops = min(self.version - version + offset, COUNTED_HOPS)
            if hops == COUNTED_HOPS and settled == i:
                settled = i + 1
            if says + max(own, whole) - 0.25 * hops >= MIN_SCORE and size >= MIN_LITERAL:
                yield a, b
        self.tested[says, whole, offset] = settled


def _gathered(text: str, name: str, terms: list, holds: dict[str, tuple[Run, int]]) -> tuple[Run, int] | None:
    """The run, and hops besides its own, that `name` holds after an assignment."""
    literals = [
        (value, a, b)
        for kind, value, a, b in terms
        if kind == "text"
        or (kind != "name" or value not in holds)
        and len(value) >= 12
        and any(c.isdigit() for c in value)
    ]
    names = [value for kind, value, *_ in terms if kind == "name" and value in holds]
    first = terms[0]
    if names and all(n == names[0] for n in names) and first[0] == "name" and first[1] == names[0]:
        run, offset = holds[names[0]]
        if not literals and names[0] != name:
            # Another name of the same run.
            run.shared = True
            return run, offset + 1
        if names[0] == name and not run.shared:
            run.version += 1
            for value, a, b in literals:
                run.add(value, a, b)
            return run, offset
    own, written = Run(), set(literals)
    for kind, value, a, b in terms:
        if kind == "name" and value in holds:
            run, offset = holds[value]
            for _, _, s, e, version in run.literals:
                own.add(text[s:e], s, e, min(run.version - version + offset + 1, COUNTED_HOPS))
        elif (value, a, b) in written:
            own.add(value, a, b)
    return (own, 0) if own.literals else None


def flow_spans(text: str) -> list[tuple[int, int, str]]:
    if ":" not in text and "=" not in text:
        return []
    holds: dict[str, tuple[Run, int]] = {}
    found: set[tuple[int, int]] = set()
    for name, terms in assignments(text):
        held = _gathered(text, name, terms, holds)
        if held is not None:
            holds[name] = held
            says = name_score(name)
            if says:
                found.update(held[0].sensitive(says, held[1]))
    return [(a, b, "flow") for a, b in found]


def joined(spans: Iterable[tuple[int, int, str]]) -> str:
    """kind:start:end, by start and then kind as listed, joined by commas."""
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in order)


def scan_text(text: str | None) -> list[tuple[int, int, str]]:
    return base_spans(text) + flow_spans(text) if text else []


def redact_text(text: str | None, mark: str = "[REDACTED]") -> str | None:
    """The text with every span, and what overlapping spans cover together, replaced."""
    spans = sorted(scan_text(text))
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and, of each row's whole text, spans (start, end, kind) in order."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            rows = [
                [{"start": a, "end": b, "kind": k} for a, b, k in scan_text(t)]
                for t in block.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(rows, pa.list_(span))], ["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<start: bigint, end: bigint, kind: string>>"
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_flow"]
        for batch in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for spans in batch.column("spans").to_pylist():
                own = [(s["start"], s["end"], s["kind"]) for s in spans]
                kinds = [s[2] for s in own]
                base = joined(s for s in own if s[2] != "flow")
                row = [*map(kinds.count, KINDS[:3]), hashlib.sha256(base.encode()).hexdigest()]
                for c, v in zip(cols, [*row, joined(own), kinds.count("flow")]):
                    c.append(v)
            kinds_of = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds_of))], names
            )

    return scanned.select("doc_id", "spans").mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_flow long",
    )


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with the secrets in `text` replaced, and `n_chars` where the text has changed; all
    other columns and rows stay."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            old = block.column("text").to_pylist()
            new = [redact_text(t) for t in old]
            out = block.set_column(
                block.schema.get_field_index("text"), "text", pa.array(new, block.column("text").type)
            )
            if "n_chars" in block.schema.names:
                own = block.column("n_chars")
                sizes = [n if a is b else len(b) for n, a, b in zip(own.to_pylist(), old, new)]
                at = block.schema.get_field_index("n_chars")
                out = out.set_column(at, "n_chars", pa.array(sizes, own.type))
            yield out

    return docs.mapInArrow(run, docs.schema)
