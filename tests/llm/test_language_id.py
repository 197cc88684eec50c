import zlib

from llm_rows import ODD, frame

from sheetdoc.llm import language_id
from sheetdoc.llm.queries import op8_language_id


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = op8_language_id(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held) > 0


def model():
    import numpy as np

    rows = [{"the": 0, "der": 1}, {"e": 2, "d": 3, "t": 4}, {}, {"the": 5, "der": 6}, {}, {}]
    logs = np.log([[0.9, 0.1], [0.1, 0.9], [0.5, 0.5], [0.4, 0.6], [0.6, 0.4], [0.8, 0.2], [0.2, 0.8]])
    return language_id.LanguageModel(["en", "de"], rows, logs)


def test_backoff_order():
    m = model()
    assert m.known("the") == [0]  # a known word
    assert m.known("them") == [5]  # its longest known n-gram
    assert m.known("ed") == [2, 3]  # down to characters
    assert m.known("zz") == []
    assert m.words(["the", "zz"])[1].tolist() == [0.0, 0.0]


def test_odd_rows(spark):
    rows = ODD + [(1, "123 ... ²"), (2, "the the"), (3, "DER der"), (4, "zz"), (5, "the " * 20000), (6, "a" * 100_000)]
    got = {(r.doc_id, r.text): r.language for r in language_id.predict(frame(spark, rows), model()).collect()}
    assert got[7001, None].lang == got[7002, ""].lang == got[1, "123 ... ²"].lang == "und"
    assert got[2, "the the"].lang == "en" and got[3, "DER der"].lang == "de"
    assert got[4, "zz"].lang == "en" and got[4, "zz"].score == 0.5  # a tie: first by position
    assert got[5, "the " * 20000].score == 1.0
    assert language_id.predict(frame(spark, []), model()).collect() == []
    assert {r.language.lang for r in language_id.predict(frame(spark, rows), None).collect()} == {"und"}


def test_training_on_nothing(spark):
    empty = spark.createDataFrame([(1, None, "x"), (2, "en", None)], "doc_id long, lang string, text string")
    assert language_id.train(empty) is None
    learned = language_id.train(spark.createDataFrame([(1, "en", "the cat"), (2, "de", "der hund")], "doc_id long, lang string, text string"))
    assert learned.langs == ["de", "en"]


def test_a_rare_language_is_learned(spark):
    from pyspark.sql import functions as F

    n = F.col("id")
    many = spark.range(40_000).select(
        F.when(n % 2 == 0, "en").otherwise("de").alias("lang"),
        F.concat(F.when(n % 2 == 0, "the house and the dog ").otherwise("das haus und der hund "), F.translate(n.cast("string"), "0123456789", "abcdefghij")).alias("text"),
    )
    rare = spark.createDataFrame([("fi", f"talo ja koira {chr(97 + i)}x") for i in range(20)], "lang string, text string")
    model = language_id.train(many.union(rare))
    assert model.langs == ["de", "en", "fi"]
    got = language_id.predict(spark.createDataFrame([("koira ja talo",), ("the dog",)], "text string"), model).collect()
    assert [r.language.lang for r in got] == ["fi", "en"]


def test_repeated_texts_count_once(spark):
    rows = [("en", f"the dog number {w}") for w in ("one", "two", "three")] + [("de", f"der hund {w}") for w in ("eins", "zwei", "drei")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    again = docs.union(spark.createDataFrame([rows[0]] * 50, "lang string, text string"))
    once, more = language_id.train(docs), language_id.train(again)
    assert more.langs == once.langs and more.rows == once.rows
    assert (more.logs == once.logs).all()


def test_a_rare_language_keeps_its_own_grams(spark, monkeypatch):
    for name, value in (("WORDS_KEPT", 4), ("GRAMS_KEPT", 4), ("LEAST_KEPT", 3)):
        monkeypatch.setattr(language_id, name, value, raising=False)
    rows = [("en", f"the dog and cat number {w} " * 9) for w in ("one", "two", "three")] + [("fi", "talo ja talo ja koira")]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    assert {"talo", "ja"} <= set(model.rows[0])
