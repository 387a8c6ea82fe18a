from pyspark.sql import functions as F

from ledgerline.llm import language_mix as L


def folds(documents):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))


def test_held_out_accuracy(documents):
    fold = folds(documents)
    r = L.predict(documents.where(fold == 0), documents.where(fold != 0)).select("lang", F.col("mixture.lang").alias("p")).collect()
    assert len(r) > 20
    assert sum(x["lang"] == x["p"] for x in r) >= 0.95 * len(r)


def test_mixtures_and_edges(spark, make, documents):
    text = {r["lang"]: r["t"] for r in documents.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("t")).collect()}
    cut = lambda lang, n: " ".join(text[lang].split()[:n])
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, cut("en", 150) + "\n" + cut("de", 150)), (5, cut("fr", 300)), (5, cut("fr", 300)),
            (6, cut("en", 40) * 2000), (None, "the 😀 of 𝒳"), (7, cut("es", 270) + " " + cut("fr", 30))]
    got = L.predict(make(rows).selectExpr("*", "1 AS mixture", "2 AS l"), documents, carry=["doc_id"]).select("doc_id", F.col("mixture.*")).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    for i in (1, 2, 3):
        assert (by[i]["lang"], by[i]["score"], by[i]["langs"]) == ("und", 0.0, [])
    assert set(by[4]["langs"]) == {"de", "en"} and 0.4 <= by[4]["score"] <= 0.6
    assert by[5]["lang"] == "fr" and by[5]["langs"] == ["fr"] and by[6]["lang"] == "en" and by[None]["lang"] == "en"
    assert by[7]["lang"] == "es" and set(by[7]["langs"]) == {"es", "fr"} and 0.8 <= by[7]["score"] <= 0.97
    assert all(abs(sum(r["shares"]) - 1) < 1e-6 for r in got if r["langs"])


def test_nothing_to_learn_and_empty_tables(make, documents):
    none = make([])
    assert [r[0] for r in L.predict(make([(1, "some words")]), none).select("mixture.lang").collect()] == ["und"]
    assert L.predict(none, documents).count() == 0
