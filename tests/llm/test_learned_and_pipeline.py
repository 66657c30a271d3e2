"""Learned operators, templates, the pipeline, and the driver's contract."""

import importlib

from claimlake.llm import language_mixture, templates, toxicity
from claimlake.llm.common import held_out, table

SMALL = "/root/testdata/sf0.001"


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SMALL, "documents", "doc_id", "text", "lang").withColumn("held", held_out("doc_id", 4, 2))
    model = language_mixture.learn(docs.where("NOT held"))
    rows = language_mixture.predict(docs, model).where("held AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark, docs_of):
    train = spark.createDataFrame(
        [("the thin cat with that hat " * 9, "en"), ("der dicke hund und das rad " * 9, "de"), (None, "fr"), ("x", None)], "text string, lang string"
    )
    model = language_mixture.learn(train)
    mixed = "the thin cat with that hat der dicke hund und das rad " * 5
    rows = {r.doc_id: r for r in language_mixture.predict(docs_of((1, None), (2, ""), (3, "12 !?"), (4, "der hund und das rad"), (5, mixed)), model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 3, 4)] == ["und", "und", "und", "de"] and rows[1].score == 0 == rows[3].score
    assert rows[5].languages == "de,en" and 0.3 < rows[5].score < 0.8 and rows[4].languages == "de"
    nothing = language_mixture.learn(train.limit(0))
    assert {r.lang_pred for r in language_mixture.predict(docs_of((1, "abc")), nothing).collect()} == {"und"}
    assert language_mixture.predict(docs_of().limit(0), model).count() == 0


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "toxic")
    scorer = toxicity.fit(docs, labels.where(~held_out("doc_id", 5, 0)))
    rows = scorer.score(docs).join(labels.where(held_out("doc_id", 5, 0)), "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    empty = scorer.score(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert [r.predicted for r in empty] == [0, 0]
    # columns under the names of features and of the model's own, repeated rows and a very long text
    toxic = next(r.text for r in rows if r.predicted)
    names = ["features", "probability", "rawPrediction", "prediction", "calibrated", "raw_score", "length", "you", "a.b"]
    odd = spark.createDataFrame([(i, t, "old", *"abcdefghi") for i, t in ((1, toxic), (1, toxic), (2, toxic * 2_000), (3, None))], ["doc_id", "text", "score", *names])
    scored = scorer.score(odd)
    assert scored.columns == ["doc_id", "text", *names, "score", "predicted"]
    found = sorted(tuple(r) for r in scored.collect())
    assert [r[2:-2] for r in found] == [tuple("abcdefghi")] * 4 and [r[0] for r in found] == [1, 1, 2, 3]
    assert found[0] == found[1] and found[0][-1] == 1 and found[0][1] == toxic and found[3][-1] == 0


def test_toxicity_features_and_missing_classes(spark, docs_of):
    lexicon = {"idiot": 3.0}
    found = dict(zip(toxicity.FEATURES, toxicity.features("You idiot, YOU ARE an 1d10t! id.iot", lexicon), strict=True))
    assert (found["hits"], found["hidden"], found["near_you"]) == (1, 2, 1) and found["shouted"] > 0
    assert set(toxicity.features(None, lexicon)) == {0.0}
    docs = docs_of((1, "a"), (2, "b"))
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.fit(docs, labels).score(docs).collect()} == {(0.0, 0)}
    assert {r.score for r in toxicity.fit(docs, labels.limit(0)).score(docs).collect()} == {0.0}


def test_templates_find_changed_values_that_correspond(spark, docs_of):
    item = "Yesterday Alice bought 3 apples and 5 pears for 12 euros at the market near Paris today while Alice sang"
    other = "Yesterday Bob bought 7 apples and 9 pears for 20 dollars at the market near London today while Bob sang"
    mixed_up = other.replace("Bob sang", "Eve sang")
    long_text = "word " * 2000 + item + " more" * 2000
    docs = docs_of((1, "so. " + item + " and on"), (2, other), (3, mixed_up), (4, None), (5, ""), (6, item.upper()), (7, "nothing of it"), (None, "one two three four"), (8, long_text), (2, other))
    bench = spark.createDataFrame([(1, item), (2, "one two three four"), (3, None), (4, "too short")], "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in templates.contaminated(docs, bench).collect()}
    assert set(rows) == {(1, 1), (2, 1), (6, 1), (8, 1), (None, 2)}
    assert rows[2, 1].changed_slots > 0 == rows[1, 1].changed_slots and rows[2, 1].coverage == 1
    assert set(templates.contaminated(docs, bench, most_broadcast=0).select("doc_id").collect()) == {(1,), (2,), (6,), (8,), (None,)}
    assert templates.contaminated(docs.limit(0), bench).count() == templates.contaminated(docs, bench.limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = table(spark, SMALL, "documents")
    odd = spark.createDataFrame([(9001, None, None, "s", None), (9002, "12 34", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(odd)
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).persist()
        left = {r[0] for r in docs.select("doc_id").collect()}
        assert left <= before
        if name == "language":
            assert before - left == {9001, 9002}
        before = left
    assert docs.columns == ["doc_id", "n_tokens", "ids", "exact"] and docs.where("NOT exact").count() == 0
    assert len(before) > 150


def test_contract_names():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_held_out_folds(spark):
    import zlib

    rows = spark.range(50).select("id", held_out("id", 4, 2).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
