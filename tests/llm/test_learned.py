import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sightline.llm import language_id, quality_rules, toxicity
from sightline.llm.text import fold
from tests.llm.helpers import ODD_TEXTS, WORD, documents, repeated_words

EN = "the house and the garden with those thoughts which they shared when leaving"
DE = "das Haus und der Garten mit den Gedanken welche sie beim Verlassen teilten"


def test_letters_match_the_text_rules():
    table = language_id.letters()
    assert table[ord("A")] == table[ord("a")] == ord("a")
    assert table[ord("ß")] and not table[ord("1")] and not table[ord(" ")]


def two_languages(spark, n=120):
    return documents(spark, [EN] * n, "en").unionByName(
        documents(spark, [DE] * n, "de").withColumn("doc_id", F.col("doc_id") + n)
    )


def test_languages_and_mixtures(spark):
    model = language_id.learn(two_languages(spark), fold(F.col("doc_id"), 5) != 0)
    assert model.langs == ["de", "en"]
    texts = [EN, DE, f"{EN} {EN} {DE}", None, "", "12 34 !!", "the"]
    best, shares = language_id.infer(model, pa.array(texts))
    assert best.tolist()[:3] == [1, 0, 1] and best.tolist()[3:6] == [-1] * 3
    assert 0.55 < shares[2, 1] < 0.75 and shares[0].tolist() == [0, 1]


def test_language_rows_and_odd_texts(spark):
    model = language_id.learn(two_languages(spark), F.lit(True))
    docs = documents(spark, ODD_TEXTS).unionByName(documents(spark, ODD_TEXTS[:2]))
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == len(ODD_TEXTS) + 2
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].lang_pred == by_id[1].lang_pred == by_id[2].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in rows)
    assert by_id[4].score == by_id[10].score


def test_language_without_training_rows(spark):
    docs = documents(spark, ["some text", None])
    model = language_id.learn(docs, F.lit(False))
    assert {r.lang_pred for r in language_id.identify(docs, model).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_toxicity_learns_words_and_ignores_the_rest(spark):
    texts = [f"plain words number {i} {'you awful troll' if i % 10 == 0 else 'good day'}" for i in range(600)]
    docs = documents(spark, texts)
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    labels = labels.unionByName(labels.limit(3)).unionByName(labels.limit(1).withColumn("toxic", F.lit(None).cast("int")))
    model = toxicity.learn(docs, labels, fold(F.col("doc_id"), 4) != 2)
    assert 0 < len(model.places) < 200
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(rows[i].predicted == (i % 10 == 0) for i in rows)
    odd = toxicity.score(documents(spark, ODD_TEXTS), model).collect()
    assert len(odd) == len(ODD_TEXTS) and all(0 <= r.score <= 1 and not r.predicted for r in odd)


def test_toxicity_without_labels(spark):
    docs = documents(spark, ["a", None])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, F.lit(True))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0, 0.0]


def test_statistics_equal_plain_counts(spark):
    texts = [*ODD_TEXTS, "l 1\nl 1\n\n\nl 1 \n|#|\n|#|", "a b c a b c d", "p q r s " * 60]
    rows = quality_rules.statistics(documents(spark, texts)).select("doc_id", "__q.*").collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert r.n_words == len(words)
        assert r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated_words(text)


def fresh(i, n=80):
    return " ".join(f"w{(i * 7919 + k * 104729) % 100003}x" for k in range(n))


def test_rules_reject_what_labels_call_bad(spark):
    texts = [fresh(i) if i % 3 else fresh(i).replace("x", "#|") for i in range(300)]
    docs = documents(spark, [*texts, None, "short"])
    labels = docs.filter("doc_id < 300").select(
        "doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality")
    )
    stats = quality_rules.statistics(docs.drop("n_words")).select("doc_id", "__q.*")
    rules = quality_rules.learn(stats, labels)
    assert 1 <= len(rules) <= 2 and all(1 <= len(r) <= quality_rules.MAX_CONDITIONS for r in rules)
    rows = {r.doc_id: r for r in quality_rules.judge(stats, rules).collect()}
    assert all(rows[i].kept == (i % 3 != 0) for i in range(300))
    assert rows[300].base_failed and rows[301].base_failed and not rows[300].kept


def test_no_labels_no_rules(spark):
    docs = documents(spark, [fresh(1), None])
    stats = quality_rules.statistics(docs).select("doc_id", "__q.*")
    rules = quality_rules.learn(stats, spark.createDataFrame([], "doc_id long, quality int"))
    assert rules == []
    assert {r.doc_id: r.kept for r in quality_rules.judge(stats, rules).collect()} == {0: True, 1: False}
    assert quality_rules.judge(stats.limit(0), rules).count() == 0


def test_ftrl_is_sparse():
    rng = np.random.default_rng(0)
    rows = [np.append(np.unique(rng.integers(100, 5000, 20)), [1 << toxicity.BITS]) for _ in range(300)]
    labels = np.zeros(300)
    for i in range(0, 300, 3):
        rows[i] = np.insert(rows[i], 0, 7)
        labels[i] = 1
    w, bias = toxicity.fit_ftrl(rows, labels)
    assert w[7] > 2 and (w != 0).sum() < 50 and bias < 0
