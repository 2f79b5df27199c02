from baflow.llm import langid
from baflow.llm.common import fold, read
from baflow.llm.queries import QUERIES
from tests.llm.helpers import SMALL, documents, odd_documents


def test_held_out_accuracy(spark):
    got = QUERIES["op6_ftrl_langid"](spark, SMALL).toPandas().merge(documents(), on="doc_id")
    held = got[got["held_out"] & got["lang"].notna()]
    assert len(held) > 20 and (held["lang"] == held["lang_pred"]).mean() > 0.95
    assert got["score"].between(0, 1).all()


def test_odd_rows(spark):
    model = langid.train(read(spark, SMALL, "documents"), may_learn=fold("doc_id", 4) != 2)
    docs = odd_documents(spark)
    got = langid.identify(docs, model).collect()
    assert len(got) == docs.count()
    und = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 4}
    assert langid.accepted(docs, model, 0.0).columns == docs.columns
    assert langid.identify(docs.where("false"), model).count() == 0


def test_no_training_rows(spark):
    docs = odd_documents(spark)
    model = langid.train(docs.where("false"))
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"}
    one = langid.train(docs.where("lang = 'fr'"))
    assert {r["lang_pred"] for r in langid.identify(docs.where("doc_id = 8"), one).collect()} == {"fr"}


def test_training_rows_without_letters(spark):
    """Junk among the labelled rows, one row to a task: batches without a letter, and nothing but junk."""
    junk = [(k, t, lab) for k, (t, lab) in enumerate([("", "en"), (" ", "de"), ("12 345 ...", "en"), (None, "fr"), ("!!", "xx")])]
    good = [(100 + k, f"the cat and the dog number {k}", "en") for k in range(6)] + [
        (200 + k, f"der hund und die katze zahl {k}", "de") for k in range(6)]
    rows = spark.createDataFrame(junk + good, "doc_id long, text string, lang string").repartition(17)
    model = langid.train(rows)
    assert model.langs == ["de", "en"] and model.predict("the dog and the cat")[0] == "en"
    assert langid.train(rows.where("doc_id < 100")).langs == []


def test_rare_languages_are_drawn(spark):
    many = [(f"the cat sat on the mat and saw dog {k}", "en") for k in range(3000)] + [("the same text again", "en")] * 1000
    rare = [(f"il gatto dorme sul tetto della casa {k}", "it") for k in range(12)]
    rows = spark.createDataFrame(many + rare, "text string, label string")
    got = {r["label"]: r["count"] for r in langid.draw(rows, 200).groupBy("label").count().collect()}
    assert got["it"] == 12 and 60 <= got["en"] <= 150
