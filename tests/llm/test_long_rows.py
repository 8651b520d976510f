from shelfwise.llm import language


def test_language_of_long_texts_alone_is_sampled(spark):
    rows = [(i, "ein kurzer Satz", "de") for i in range(9)] + [(i, "un mot " * 4000, "fr") for i in range(20, 29)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.lang: r.n for r in language.sample(docs).groupBy("lang").agg({"text": "count"}).toDF("lang", "n").collect()}
    folds = docs.where(language._fold("doc_id") != 1).groupBy("lang").count().collect()
    assert got == {r["lang"]: r["count"] for r in folds} and set(got) == {"de", "fr"}


def test_one_row_at_least(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_CHARS", 0)
    docs = spark.createDataFrame([(i, f"text {i}", "en") for i in range(9)], "doc_id long, text string, lang string")
    assert language.sample(docs).count() == 1
