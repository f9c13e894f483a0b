"""Language identification."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybuy.llm import language_id, queries
from tests.llm.helpers import ODD, documents

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    train = docs.where("doc_id % 2 = 0")
    return language_id.fit_language_model(train), docs.where("doc_id % 2 = 1")


def test_text_alone_finds_the_language(fitted):
    model, rest = fitted
    rows = language_id.identify(rest, model, declared=None, host=None).collect()
    right = np.mean([r.language == r.lang for r in rows])
    assert right > 0.95 and np.mean([r.accepted for r in rows]) > 0.98


def test_clean_documents_are_kept(fitted):
    model, rest = fitted
    rows = language_id.identify(rest, model).collect()
    assert np.mean([r.accepted for r in rows]) > 0.99
    assert np.mean([r.language == r.lang for r in rows]) > 0.97


def _model():
    """Two languages: 'aaa' words and 'bbb' words."""
    weights = np.full((language_id._CELLS + 1, 3), np.log(1e-6), np.float32)
    weights[:, 2] = -np.log(language_id._CELLS)
    weights[-1] = 0
    for k, word in enumerate(("aaa", "bbb")):
        weights[language_id._codes(word.encode(), np.array([3]))[0], k] = np.log(0.5)
    return language_id.LanguageModel(("aa", "bb"), (0.6, 0.4), weights)


def _brute_force(row, rows, model, trust=0.9, suffix_weight=20.0, host_weight=10.0):
    """Posterior of each class from the counts of all rows, term by term."""
    names = model.languages
    declared = row["lang"] if row["lang"] in names else None
    text = (row["text"] or "").encode().lower()
    scores = np.zeros(3)
    if len(text) > 2:
        for code in language_id._codes(text, np.array([len(text)]))[:-2]:
            scores += model.weights[code]

    def level(match, before, weight):
        n = np.array([sum(match(r) and r["lang"] == name for r in rows) for name in names], float)
        if declared:
            n[names.index(declared)] -= 1
        return (n + weight * before) / (n.sum() + weight)

    def suffix(host):
        return host.rsplit(".", 1)[1] if host and "." in host else None

    prior = np.array(model.shares)
    if suffix(row["source"]) and any(suffix(r["source"]) == suffix(row["source"]) for r in rows):
        prior = level(lambda r: suffix(r["source"]) == suffix(row["source"]), prior, suffix_weight)
    if row["source"]:
        prior = level(lambda r: r["source"] == row["source"], prior, host_weight)
    said = np.zeros(3)
    if declared:
        said = np.log([trust if n == declared else 1 - trust for n in names] + [0.5])
    logs = np.append(np.log(0.99 * prior + 1e-9), np.log(0.01)) + said + scores / 3
    p = np.exp(logs - logs.max())
    return p / p.sum()


def test_posteriors_match_brute_force(spark):
    texts = ["aaa aaa", "bbb", "", None, "aaa bbb", "zzz qqq www eee rrr ttt", "aaa", "bbb bbb", "", ""]
    langs = ["aa", "bb", "bb", "aa", None, "aa", "bb", "xx", "bb", None]
    hosts = ["x.de", "x.de", "x.de", "y.de", "y.de", "lone", None, "z.fr", "z.fr", ""]
    rows = [dict(doc_id=k, text=t, lang=la, source=h) for k, (t, la, h) in enumerate(zip(texts, langs, hosts))]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id bigint, text string, lang string, source string")
    model = _model()
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    for row in rows:
        p = _brute_force(row, rows, model)
        r = got[row["doc_id"]]
        assert r.language == ("aa", "bb", "und")[int(p.argmax())]
        assert r.confidence == pytest.approx(p.max(), abs=1e-4)
    assert got[5].language == "und" and not got[5].accepted and got[2].accepted


def test_page_evidence(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://u:p@Blog.Example.DE:80/a?b", "<!DOCTYPE html><html class=x lang='de-AT'><script>no</script><p>Ja&nbsp;<!-- x -->doch</p>"),
            (2, "nonsense", "plain"),
            (3, None, None),
        ],
        "page_id bigint, url string, html string",
    )
    got = {r.doc_id: r for r in language_id.page_evidence(pages).withColumn("suffix", language_id.suffix_of(F.col("host"))).collect()}
    assert (got[1].declared, got[1].host, got[1].suffix) == ("de", "blog.example.de", "de")
    assert got[1].text.split() == ["Ja&nbsp;", "doch"] and got[2].declared is None and got[3].text is None


def test_odd_texts_and_clashing_names(spark):
    docs = documents(spark, ODD).withColumn("language", F.lit("clash"))
    own = ("_text", "_host", "_declared", "_suffix", "_n_host", "_n_suffix", "_logs", "_top", "_row", "a.b")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in own})
    rows = language_id.identify(docs, _model()).collect()
    assert rows[0].__fields__ == [*[c for c in docs.columns if c != "language"], "language", "confidence", "accepted"]
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in own)
    assert len(rows) == len(ODD) and {r.language for r in rows} <= {"aa", "bb", "und"}
    empty = documents(spark, [])
    assert language_id.identify(empty, language_id.fit_language_model(empty)).collect() == []
    alone = language_id.identify(docs, language_id.fit_language_model(docs, least_rows=100)).collect()
    assert not any(r.accepted for r in alone)


SPANISH = "la casa del pueblo est\u00e1 cerca del r\u00edo y los ni\u00f1os juegan por la tarde con sus amigos del barrio"
GREEK = "\u03b7 \u03b3\u03bb\u03ce\u03c3\u03c3\u03b1 \u03c4\u03c9\u03bd \u03b5\u03bb\u03bb\u03ae\u03bd\u03c9\u03bd \u03b5\u03af\u03bd\u03b1\u03b9 \u03c0\u03b1\u03bb\u03b9\u03ac \u03ba\u03b1\u03b9 \u03cc\u03bc\u03bf\u03c1\u03c6\u03b7"


def test_rare_labels_are_languages(spark):
    """17 Spanish rows of the smallest set, and one row of an alphabet of its own, with labels in any case."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    more = documents(spark, [GREEK], [9000]).withColumn("lang", F.lit("EL"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.upper("lang")).otherwise(F.col("lang"))).unionByName(more)
    model = language_id.fit_language_model(docs)
    assert model.languages == ("de", "el", "en", "es", "fr") and sum(model.shares) == pytest.approx(1)
    rows = language_id.identify(docs, model).collect()
    spanish = [r for r in rows if (r.lang or "").lower() == "es"]
    assert 0 < len(spanish) < 20 and all(r.language == "es" and r.accepted for r in spanish)
    assert [(r.language, r.accepted) for r in rows if r.doc_id == 9000] == [("el", True)]


def test_few_or_no_labels_reject_nothing(spark):
    few = documents(spark, [SPANISH, SPANISH + " y m\u00e1s", SPANISH + " hoy"]).withColumn("lang", F.lit("es"))
    rows = language_id.identify(few, language_id.fit_language_model(few)).collect()
    assert [(r.language, r.accepted) for r in rows] == [("es", True)] * 3
    for none in (F.lit(None).cast("string"), F.lit(""), F.lit("und")):
        docs = few.withColumn("lang", none)
        rows = language_id.identify(docs, language_id.fit_language_model(docs)).collect()
        assert len(rows) == 3 and all(r.language == "und" and r.accepted for r in rows)


def test_pages_query_fuses_markup_and_addresses(spark, tmp_path):
    """All pages; the text outweighs a wrong markup, and a suffix decides what neither text nor markup does."""
    small = "/root/testdata/sf0.001"
    spark.read.parquet(f"{small}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    spanish = spark.read.parquet(f"{small}/documents.parquet").where("lang = 'es' AND length(text) > 500").first().text
    more = [(9000, "http://wrong.example/x", f"<html lang=fr><p>{spanish}</p></html>"), (9001, "http://new.zz/", "<html><p>12</p></html>")]
    more += [(9100 + k, f"http://h{k}.zz/", f"<html lang=el><p>{GREEK}</p></html>") for k in range(30)]
    pages = spark.read.parquet(f"{small}/pages.parquet")
    pages.unionByName(spark.createDataFrame(more, "page_id bigint, url string, html string")).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in queries.QUERIES["op9_language_id_pages"](spark, str(tmp_path)).collect()}
    assert len(got) == pages.count() + len(more)
    assert got[9000].language == "es" and got[9000].declared == "fr"
    assert got[9001].declared is None and got[9001].language == "el" and got[9001].accepted
    assert all(got[9100 + k].language == "el" and got[9100 + k].accepted for k in range(30))
