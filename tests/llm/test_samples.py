"""The training samples: rows over the size bound aren't lost where others are too few."""

from loopweave.llm import language_id, toxicity


def test_language_with_long_texts_only_is_learnt(spark):
    en = "the quick brown fox jumps over the lazy dog and runs away from the house "
    de = "der schnelle braune fuchs springt über den faulen hund und läuft davon "
    rows = [(i, en * 3, "en") for i in range(20)] + [(100 + i, de * 200, "de") for i in range(20)] + [(None, "x" * 9000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.langs == ["de", "en"]
    asked = spark.createDataFrame([(1, "ein fauler hund läuft über das haus"), (2, "a lazy dog runs over the house")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.identify(asked, model).collect()} == {1: "de", 2: "en"}


def test_sample_of_languages_is_bounded_with_repeated_ids(spark):
    rows = [(7, f"text number {i}", "en") for i in range(500)] + [(None, f"null id {i}", "fr") for i in range(300)]
    got = language_id.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang", 50, 100)
    assert {k: len(v) for k, v in got.items()} == {"en": 50, "fr": 50}
    long = spark.createDataFrame([(1, "ab" * 500, "en"), (2, "short", "en")], "doc_id long, text string, lang string")
    assert [len(t) for t in language_id.sample(long, "doc_id", "text", "lang", 50, 100)["en"]] == [5, 100]


def test_toxicity_is_learnt_from_long_rows_and_labels_without_documents(spark):
    words = "some ordinary words about the weather and the harvest in the valley of the river ".split()
    clean = [" ".join(words[i % 7 :] + words) for i in range(40)]
    docs = [(i, clean[i] * 300) for i in range(30)] + [(100 + i, (clean[i] + " you idiot scum ") * 300) for i in range(30)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = [(i, 0) for i in range(30)] + [(100 + i, 1) for i in range(30)] + [(10_000 + i, i % 2) for i in range(400)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels, per_class=25)
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert model is not None and got == {i: int(i >= 100) for i in got}
