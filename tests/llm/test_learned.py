import random

import numpy as np
from texts import awkward, documents, prose

from orderflow.llm import language_id, toxicity

STEMS = {"aa": "the and with from", "bb": "der und mit von", "cc": "les des avec pour", "dd": "los las con para", "ee": "il che non per", "ff": "och att det som"}


def corpus(languages, each, seed=1):
    source = random.Random(seed)
    rows = []
    for lang in languages:
        for _ in range(each):
            words = source.choices(STEMS[lang].split(), k=30) + prose(source.randrange(10**6), 10).split()
            source.shuffle(words)
            rows.append((len(rows), " ".join(words), lang))
    return rows


def language_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages_held_out(spark):
    for languages in (["aa", "bb"], list(STEMS)):
        model = language_id.fit(language_docs(spark, corpus(languages, 60)))
        fresh = corpus(languages, 15, seed=2)
        found = language_id.predict(language_docs(spark, fresh), model).collect()
        right = {i: lang for i, _, lang in fresh}
        assert np.mean([right[r["doc_id"]] == r["lang_pred"] for r in found]) > 0.95
        assert all(0 <= r["score"] <= 1 for r in found)


def test_codewords_are_apart():
    for n in range(2, 12):
        code = language_id.codewords(n).astype(int)
        distance = (code[:, None] != code[None]).sum(2)[~np.eye(n, dtype=bool)]
        assert distance.min() >= 1 and len({tuple(r) for r in code}) == n


def test_languages_awkward(spark):
    model = language_id.fit(language_docs(spark, [*corpus(["aa", "bb"], 20), (500, None, "aa"), (501, "x", None)]))
    found = {r["doc_id"]: r for r in language_id.predict(documents(spark, awkward()), model).collect()}
    assert all(found[k]["lang_pred"] == "und" and found[k]["score"] == 0 for k in (1, 2, 3, 6))
    assert found[4]["lang_pred"] in ("aa", "bb")
    assert language_id.predict(documents(spark, []), model).count() == 0
    nothing = language_id.fit(language_docs(spark, []))
    assert {r["lang_pred"] for r in language_id.predict(documents(spark, awkward()), nothing).collect()} == {"und"}
    single = language_id.fit(language_docs(spark, corpus(["aa"], 5)))
    assert {r["lang_pred"] for r in language_id.predict(documents(spark, [(1, "some text")]), single).collect()} == {"aa"}


def test_one_sided_risk_stays_bounded():
    """With a large prior the bracket turns negative early; the fit must not run away."""
    rows = np.repeat(np.arange(400), 5)
    cols = np.random.default_rng(0).integers(0, 50, 2000)
    positive = np.arange(400) < 100
    cols[:500:5] = 99
    w, bias = toxicity.fit_weights(rows, cols, positive, 0.3)
    assert w[99] > 0 and np.isfinite(w).all() and np.isfinite(bias)


def test_toxicity_held_out(spark):
    source = random.Random(4)
    rows, labels = [], []
    for k in range(900):
        words = prose(k, 40).split()
        toxic = k % 8 == 0
        if toxic:
            words[source.randrange(40)] = source.choice(["vile", "nasty"])
        rows.append((k, " ".join(words)))
        if k < 600 and k % 2 == 0:
            labels.append((k, int(toxic)))
    docs = documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert np.mean([found[k] == int(k % 8 == 0) for k in range(600, 900)]) > 0.97


def test_toxicity_awkward(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(4, 1), (2, None), (None, 1), (77, 0)], "doc_id bigint, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(scored) == 8 and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.fit(docs, labels.filter("false")) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), None).count() == 0
