import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import language

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "ber"], "cc": ["eau", "oui", "tré"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(2, 4))) for _ in range(n))


def labelled(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, lang, 40), lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows, rng


def test_held_out_accuracy_and_mixtures(spark):
    docs, rows, rng = labelled(spark)
    model = language.LanguageModel.fit(docs, language.learnable())
    assert model.languages == sorted(SYLLABLES)
    got = language.identify(docs.drop("lang"), model).where(~language.learnable()).collect()
    assert len(got) > 10 and all(r["lang_pred"] == rows[r["doc_id"]][2] and r["score"] > 0.9 for r in got)
    mixed = spark.createDataFrame([(0, prose(rng, "aa", 60) + " " + prose(rng, "bb", 30))], "doc_id long, text string")
    r = language.identify(mixed, model).first()
    assert r["lang_pred"] == "aa" and 0.55 < r["score"] < 0.75


def test_same_as_a_loop_over_words(spark):
    """Counts and single-language likelihoods against plain dictionaries."""
    docs, rows, _ = labelled(spark)
    model = language.LanguageModel.fit(docs, F.lit(True))
    text = "kalo schung"
    raw = np.frombuffer(text.encode(), np.uint8)
    buckets, first, at = language.word_grams(raw, np.array([0, len(raw)]))
    assert len(buckets) == len(text) - 1 and first.tolist() == [0, 4] and at.tolist() == [0, 2]
    grams = ["  k", " ka", "kal", "alo", "  s", " sc", "sch", "chu", "hun", "ung"]
    # equal trigrams share a bucket, whatever precedes them
    again, _, _ = language.word_grams(np.frombuffer(b"zz kalo", np.uint8), np.array([0, 7]))
    assert again[2:].tolist() == buckets[:4].tolist() and len(set(buckets.tolist())) == len(set(grams)) == 10


def test_case_of_latin_letters():
    low = language.word_grams(np.frombuffer("élan été".encode(), np.uint8), np.array([0, 11]))[0]
    high = language.word_grams(np.frombuffer("ÉLAN ÉTÉ".encode(), np.uint8), np.array([0, 11]))[0]
    assert low.tolist() == high.tolist()


def test_odd_rows(spark, odd_docs, odd_rows):
    model = language.LanguageModel.fit(odd_docs, language.learnable())
    extra = odd_docs.withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit(1))
    got = language.identify(extra, model).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1


def test_nothing_learned(no_docs, odd_docs):
    model = language.LanguageModel.fit(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in language.identify(odd_docs, model).collect()} == {"und"}
    assert language.identify(no_docs, model).count() == 0


def test_text_of_four_languages():
    words = ["kalo", "schung", "eaux", "wyrd"]
    logs = np.full((1 << language.BITS, 4), np.log(1e-6), np.float32)
    for i, word in enumerate(words):
        logs[language.word_grams(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)]))[0], i] = np.log(0.1)
    raw = np.frombuffer(" ".join(w for w, n in zip(words, (36, 22, 21, 21)) for _ in range(n)).encode(), np.uint8)
    best, score = language.LanguageModel(list("abcd"), logs).predict(raw, np.array([0, len(raw)]))
    assert best.tolist() == [0] and abs(score[0] - 0.36) < 0.01


def test_clashing_columns(spark, odd_docs):
    model = language.LanguageModel.fit(odd_docs, language.learnable())
    docs = odd_docs.withColumns({c: F.lit(c) for c in ("_text", "_own", "left", "lang_pred")})
    got = language.identify(docs, model)
    assert {tuple(r) for r in got.select("_text", "_own", "left").collect()} == {("_text", "_own", "left")}
    assert sorted(map(str, got.select("doc_id", "text", "lang_pred", "score").collect())) == \
        sorted(map(str, language.identify(odd_docs, model).select("doc_id", "text", "lang_pred", "score").collect()))
