import zlib

from roadcast.llm import language
from roadcast.llm.language import fit, grams, identify

from .helpers import docs, odd_rows, table


def test_held_out_accuracy_and_fold(spark):
    t = table(spark, sf="/root/testdata/sf0.01")
    got = {r["doc_id"]: r for r in identify(t, fit(t)).collect()}
    lang = {r["doc_id"]: r["lang"] for r in t.collect()}
    assert len(got) == len(lang)
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in lang)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(got[i]["lang_pred"] == lang[i] for i in held) >= 0.95 * len(held)


def test_counts_agree_with_sets(spark):
    rows = [(4 * i, t, lang) for i, (t, lang) in enumerate([("abcde abcde abcde", "aa"), ("xyzw xyzw xyzw abcd abcd abcd", "bb")] * 30)]
    model = fit(docs(spark, rows))
    counts = dict(zip(model.languages, model.counts(grams("abcde xyzw"))))
    sure = {"aa": {" abc", "abcd", "bcde", "cde "}, "bb": {" abc", "abcd", " xyz", "xyzw", "yzw "}}
    for lang, own in sure.items():           # a Bloom filter never misses
        assert counts[lang] >= sum(g in own for g in [" abc", "abcd", "bcde", "cde ", " xyz", "xyzw", "yzw "])


def test_prediction_ignores_label_source_and_id(spark):
    t = table(spark)
    model = fit(t)
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(t, model).collect()}
    from pyspark.sql import functions as F
    b = identify(t.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")).withColumn("doc_id", -F.col("doc_id")), model)
    assert {-r["doc_id"]: (r["lang_pred"], r["score"]) for r in b.collect()} == a


def test_odd_rows(spark):
    d = docs(spark, odd_rows())
    got = identify(d, fit(table(spark))).collect()
    assert len(got) == len(odd_rows())
    und = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 8}
    none = fit(docs(spark, []))
    assert {r["lang_pred"] for r in identify(d, none).collect()} == {"und"}
    assert identify(docs(spark, []), none).count() == 0


def test_text_without_letters_is_und(spark):
    texts = ["²³ ½", "Ⅷ ³", "123 --", "\u0301", "_", "", None, "²x"]
    train = [(4 * i, "some plain words of text", "en") for i in range(20)]
    t = docs(spark, train + [(1001 + i, x, "en") for i, x in enumerate(texts)])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(t, fit(t)).collect() if r["doc_id"] > 1000}
    assert {i for i, (lang, _) in got.items() if lang == "und"} == set(range(1001, 1008))
    assert got[1008][0] == "en" or got[1008][1] == 0.0


def test_rows_stay_out_of_the_python_workers(spark):
    """The worker gets a text once and returns its prediction only, whatever columns are kept."""
    t = table(spark)
    keep = tuple(c for c in t.columns if c != "doc_id")
    found = identify(t, fit(t), keep=keep)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("ArrowEvalPython [predict(text") == 1
    assert sorted(map(str, found.select(*t.columns).collect())) == sorted(map(str, t.collect()))


def test_partial_counts_give_the_same_filters(spark, monkeypatch):
    t = table(spark)
    whole = fit(t)
    monkeypatch.setattr(language, "COUNT_AT", 500)
    parts = fit(t)
    assert parts.languages == whole.languages and all((a == b).all() for a, b in zip(parts.slices, whole.slices))
