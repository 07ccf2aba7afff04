"""Every operator on odd rows and on an empty table."""

import pytest
from pyspark.sql import functions as F

from meshwork.llm import exact_dedup, html_extract, langid, media, packing, pieces, quality, simhash, toxicity, urls
from meshwork.llm.common import fresh_path


def read_back(spark, docs):
    path = fresh_path(spark, "media")
    name = media.write_media(docs, path)
    found = media.features(media.read_media(spark, path, name))
    return spark.read.parquet(f"{path}/manifest").select(F.col("id").alias("doc_id"), "key", "n_bytes").join(found, "key")


PER_ROW = {
    "simhash": lambda s, d, lab: simhash.near_duplicates(d),
    "media": lambda s, d, lab: read_back(s, d),
    "quality": lambda s, d, lab: quality.resample(d, quality.fit(d, lab)),
    "language": lambda s, d, lab: langid.predictions(d, langid.fit(d)),
    "toxicity": lambda s, d, lab: toxicity.toxicity(d, toxicity.fit(d, lab)),
    "exact": lambda s, d, lab: exact_dedup.exact_duplicates(d),
    "pieces": lambda s, d, lab: pieces.decode_column(pieces.encode_column(d)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_result_for_each_row(spark, odd, none, labels, name):
    got = sorted((r["doc_id"] for r in PER_ROW[name](spark, odd, labels).collect()), key=str)
    assert got == sorted((r["doc_id"] for r in odd.collect()), key=str)
    assert PER_ROW[name](spark, none, labels).count() == 0
    PER_ROW[name](spark, odd, labels.limit(0)).count()


def test_filters_on_odd_rows(spark, odd, none, labels):
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    known = langid.keep_identified(odd)
    assert known.columns == odd.columns
    assert {r["doc_id"] for r in known.collect()}.isdisjoint({3, 4, 7, 8})
    assert quality.keep_good(none, labels).count() == langid.keep_identified(none).count() == 0


def test_packing_of_odd_rows(odd, none):
    got = packing.pack(odd).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in odd.collect()}
    by = {r["doc_id"]: (r["n"], r["m"]) for r in got}
    assert by[3] == by[4] == (1, 1) and by[6][0] == 2 * by[6][1]
    assert packing.pack(none).count() == 0


def test_pages_on_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "no scheme", "", "x"), (3, "http://A.net/en/1", "<p>a<p>b", "x"), (3, "http://A.net/en/1", "<p>a<p>b", "x"), (4, "://", "<div><b>x", "x"), (5, "http://u.example.net", "text only &amp; more", "x")], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(pages).collect()}
    assert got == {1: "", None: "", 3: "a\n\nb", 4: "x", 5: "text only & more"}
    assert html_extract.main_texts(pages.limit(0)).count() == 0
    seen = urls.verdicts(pages, urls.fit(pages)).collect()
    assert len(seen) == 6 and {r["verdict"] for r in seen} <= {"allow", "block"}
    by = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in seen}
    assert by[1] == by[None] == by[4] == ("", "", None) and by[3] == ("a.net", "/en/1", "net/") and by[5] == ("u.example.net", "", None)
    assert urls.verdicts(pages.limit(0), urls.fit(pages.limit(0))).count() == 0
