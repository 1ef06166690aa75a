"""Queries over texts read them to the end: literal documents whose start says nothing."""

from __future__ import annotations

import pytest

from brindle.plans.catalogue import QUERIES

HEAD = " ".join(["same"] * 200)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("texts"))
    tail = {"en": "zulu yankee", "fr": "quebec oscar"}
    rows = [(i, f"{HEAD} {tail[x]}", x, "s", 1) for i in range(60) for x in ["fr" if i % 2 else "en"]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_pairs_of_words_at_the_end_count(spark, folder):
    got = {(r.term, r.synonym): r.support for r in QUERIES["synonym_pmi"](spark, folder).collect()}
    assert got["zulu", "yankee"] == 30 == got["quebec", "oscar"]


def test_words_at_the_end_tell_the_class(spark, folder):
    nb = {r.review_id: r.label for r in QUERIES["text_class_nb"](spark, folder).where("rank = 1").collect()}
    assert nb == {i: "fr" if i % 2 else "en" for i in range(0, 60, 5)}
    fitted = QUERIES["text_classifier"](spark, folder).collect()
    assert fitted and all(r.guess == r.label for r in fitted)


def test_normal_form_of_the_whole_text(spark, folder):
    assert all(r.query_norm.endswith(("zulu yankee", "quebec oscar")) for r in QUERIES["normalized_queries"](spark, folder).collect())
