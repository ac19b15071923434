"""Whole pages and texts: what the training-data operators must neither fail on nor leave out."""

import numpy as np

from tidemark.llm import html_main, quality


def test_foreign_data_y_is_no_label(spark):
    rows = [(k, "u", f"<body><article><p {y}>a b c</p></article></body>") for k, y in enumerate(['data-y="x"', 'data-y="1.5"', 'data-y=""', 'data-y="-1"', "data-y=7", "data-y='1'", ""])]
    got = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(got) == set(range(len(rows))) and set(got.values()) == {got[6]}
    assert html_main.parse('<body><div data-y=1><p data-y="x">a</p></div></body>').label == [0, 0, 1, 1]


def test_every_word_group_is_a_feature():
    groups = html_main._GROUPS
    page = html_main.parse(f'<body><div class="{" ".join(html_main._WORDS[g].split()[-1] for g in groups)}">a</div></body>')
    features = set(html_main.Forest.of([page]).features[2].tolist())
    assert page.groups[2] == frozenset(groups)
    assert {html_main._BASE_WORDS + k for k in range(len(groups))} <= features


def test_training_takes_whole_texts(spark, monkeypatch):
    texts = [" ".join(f"{k * 7919 % 999_983:06d}" for k in range(n)) for n in (9000, 40, 41, 42)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(4)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(quality, "fit", lambda rows, grades: rows)
    whole = [quality.features(t).tolist() for t in texts]
    assert len(whole[0]) > 4009
    assert [r.tolist() for r in quality.train(docs, labels)] == whole
    monkeypatch.setattr(quality, "MAX_TRAIN_SLOTS", len(whole[0]) + 9)
    some = [r.tolist() for r in quality.train(docs, labels)]
    assert len(some) < 4 and all(r in whole for r in some)


def test_toxic_documents_are_rejected(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 4 != 0"))
    held = quality.score(docs, model).join(labels.where("doc_id % 4 = 0").withColumn("grade", quality.grade_column()), "doc_id").toPandas()
    assert (held["grade"] == 1).sum() >= 50
    assert np.mean(~held[held["grade"] == 1]["kept"].astype(bool)) > 0.9  # 0.97 over four folds when written
    assert np.mean(held[held["grade"] == 2]["kept"].astype(bool)) > 0.98


def test_rows_that_share_an_id_count_once(spark, monkeypatch):
    rows = [(0, "one two three")] * 200 + [(0, "one two three four"), (1, "five six"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(3)], "doc_id long, quality int, toxic int")
    wanted = [quality.features(t).tolist() for t in ("one two three", "five six", None)]
    monkeypatch.setattr(quality, "fit", lambda rows, grades: rows)
    monkeypatch.setattr(quality, "MAX_TRAIN_SLOTS", sum(map(len, wanted)))
    assert [r.tolist() for r in quality.train(docs, labels)] == wanted
