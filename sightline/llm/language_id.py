"""Language identification by multilingual mixture inference.

Each language is a multinomial over hashed character trigrams, learned from labelled rows. A
document is a mixture of languages: every word comes from one of them, with the likelihood of
its trigrams, and expectation-maximisation estimates the proportions. Which languages take part
is settled by penalised likelihood: the language with the smallest share is removed as long as
that does not cost more log-likelihood than it saves in penalty.

Texts are processed whole, in blocks of bounded size. Null texts and texts without a letter give
`und` with score 0. Rows with a null id are scored but never learned from. Repeated rows are
scored alike, ties go to the first language in alphabetic order, and an empty table gives none.
Columns other than doc_id, text and, for learning, lang are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.text import blocks, hashed_sample, row_of, words_of

BUCKET_BITS = 16
TRAIN_ROWS = 20_000
SMOOTHING = 0.5
PENALTY = 2.0
ROUNDS = 10
UNKNOWN = "und"


@lru_cache(1)
def letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all other code points."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = ord(c.lower()[0])
    return table


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around every letter of the words, and the word each comes from."""
    points = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le"), np.uint32)
    word = np.zeros(len(points), np.int64)
    np.cumsum(points[:-1] == 10, out=word[1:])
    c = letters()[points]
    keep = c > 0
    keep[1:] |= c[:-1] > 0
    c, word = c[keep], word[keep]
    before, after = np.zeros_like(c), np.zeros_like(c)
    before[1:], after[:-1] = c[:-1], c[1:]
    at = c > 0
    h = before * np.uint32(0x9E3779B1) + c * np.uint32(0x85EBCA6B) + after * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - BUCKET_BITS))[at].astype(np.int64), word[at]


@dataclass
class LanguageModel:
    langs: list[str]
    log_p: np.ndarray  # bucket x language


def _counts(langs: list[str]) -> Callable:
    place = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BUCKET_BITS, len(langs)))
        for block in blocks(batches):
            codes, offsets, words = words_of(block.column("text"))
            if not len(words):
                continue
            lang = np.array([place[x] for x in block.column("lang").to_pylist()])
            pair = codes * len(langs) + lang[row_of(offsets)]
            seen = np.bincount(pair, minlength=len(words) * len(langs)).reshape(len(words), -1)
            gram, word = trigrams(words.to_pylist())
            for i in range(len(langs)):
                total[:, i] += np.bincount(gram, seen[word, i], minlength=1 << BUCKET_BITS)
        gram, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(gram), pa.array(total[gram, lang])], ["lang", "gram", "n"]
        )

    return run


def learn(docs: DataFrame, usable, train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fit on about `train_rows` rows for each language out of the `usable` ones (all, if fewer).

    The driver receives the names of the languages and one count for each language and trigram
    bucket, both independent of the number of documents.
    """
    usable = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0)))
    share = F.create_map(
        *[F.lit(x) for k in langs for x in (k, int(min(1.0, train_rows / sizes[k]) * (1 << 30)))]
    )
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < share[F.col("lang")]
    rows = (
        usable.filter(chosen)
        .select("text", "lang")
        .mapInArrow(_counts(langs), "lang long, gram long, n double")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.full((1 << BUCKET_BITS, len(langs)), SMOOTHING)
    counts[rows["gram"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy()
    return LanguageModel(langs, np.log(counts / counts.sum(axis=0)))


def _maximise(p, row, starts, n, pi, rounds):
    """EM over words: `p` holds each word's likelihoods, `pi` the proportions of each row."""
    for _ in range(rounds):
        r = p * pi[row]
        r /= r.sum(axis=1, keepdims=True)
        pi = np.add.reduceat(r, starts, axis=0) / n[:, None]
    fit = np.add.reduceat(np.log((p * pi[row]).sum(axis=1)), starts)
    return pi, fit


def infer(model: LanguageModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Best language (its place, -1 for unknown) and the proportions of all, for each text."""
    rows, n_langs = len(texts), len(model.langs)
    best, shares = np.full(rows, -1), np.zeros((rows, n_langs))
    codes, offsets, words = words_of(texts)
    if not n_langs or not len(words):
        return best, shares
    gram, word = trigrams(words.to_pylist())
    fits = np.zeros((len(words), n_langs))
    for i in range(n_langs):
        fits[:, i] = np.bincount(word, model.log_p[gram, i], minlength=len(words))
    has_letter = np.bincount(word, minlength=len(words)) > 0
    fits -= fits.max(axis=1, keepdims=True)
    likely = np.exp(np.maximum(fits, -60.0))

    use = has_letter[codes]
    row, codes = row_of(offsets)[use], codes[use]
    n = np.bincount(row, minlength=rows)
    live = np.flatnonzero(n)
    if not len(live):
        return best, shares
    dense = np.zeros(rows, np.int64)
    dense[live] = np.arange(len(live))
    row, n = dense[row], n[live]
    starts = np.concatenate([[0], np.cumsum(n)[:-1]])
    p = likely[codes]
    cost = PENALTY * np.log(n + 1.0)

    alone = np.add.reduceat(np.log(p), starts, axis=0)
    single = alone.argmax(axis=1)
    chosen = np.zeros((len(live), n_langs))
    chosen[np.arange(len(live)), single] = 1.0
    score = alone.max(axis=1)

    pi, fit = _maximise(p, row, starts, n, np.full((len(live), n_langs), 1 / n_langs), ROUNDS)
    todo = np.arange(len(live))
    for size in range(n_langs, 1, -1):
        better = fit - (size - 1) * cost[todo] > score[todo]
        score[todo[better]] = (fit - (size - 1) * cost[todo])[better]
        chosen[todo[better]] = pi[better]
        # A subset fits no better than this set, so rows that cannot gain any more are done.
        open_ = fit - cost[todo] > score[todo]
        if size == 2 or not open_.any():
            break
        keep_words = open_[row]
        dense = np.cumsum(open_) - 1
        p, row = p[keep_words], dense[row[keep_words]]
        todo, n, pi = todo[open_], n[open_], pi[open_]
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        pi = pi.copy()
        rest = np.where(pi > 0, pi, np.inf)
        pi[np.arange(len(pi)), rest.argmin(axis=1)] = 0
        total = pi.sum(axis=1, keepdims=True)
        pi = np.where(total > 0, pi / np.where(total > 0, total, 1), 1 / n_langs)
        pi, fit = _maximise(p, row, starts, n, pi, ROUNDS // 2)
    shares[live] = chosen
    best[live] = chosen.argmax(axis=1)
    return best, shares


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (share of that language), n_langs (size of the chosen set)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        for block in blocks(batches):
            best, shares = infer(model, block.column("text"))
            top = shares.max(axis=1) if shares.shape[1] else np.zeros(len(best))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(names[best], pa.string()),
                    pa.array(np.clip(top, 0.0, 1.0)),
                    pa.array((shares > 0).sum(axis=1)),
                ],
                ["doc_id", "lang_pred", "score", "n_langs"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, n_langs long"
    )
