"""Models that are learned from all labelled rows, not from a sample of them."""

import collections

import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import labelled, text_convolution
from pagemill.session import table

FOLDER = "/root/testdata/sf0.1"


def test_words_are_counted_over_all_labelled_rows(spark):
    rows = [(i, f"alpha w{i % 700} v{i % 1900}" + (" bad" if i % 30 == 0 else ""), "en", int(i % 30 == 0)) for i in range(16_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = text_convolution.fit(frame.drop("toxic"), frame.select("doc_id", "toxic"))
    train = {r.doc_id for r in labelled.training_ids(frame.select("doc_id", "toxic"), "toxic", None).filter("not test").collect()}
    counts = collections.Counter(w for i, text, *_ in rows if i in train for w in set(text.split()))
    own = text_convolution.PlainWords()
    want = {own[w.encode()] for w, n in counts.items() if n >= max(3, round(0.0015 * len(train)))}
    assert len(train) > 10_000 and 2 < len(want) < len(counts) and set(model.known.tolist()) == want


def test_bitmaps_keep_every_labelled_row(spark):
    documents, labels = table(spark, FOLDER, "documents").select("doc_id", "text"), table(spark, FOLDER, "labels")
    ids = labelled.training_ids(labels.unionByName(labels), "toxic", None)
    for kind in ("long", "string"):
        docs, wanted = documents.withColumn("doc_id", F.col("doc_id").cast(kind)), ids.withColumn("doc_id", F.col("doc_id").cast(kind))
        got, want = labelled.all_labelled(docs, wanted), labelled.labelled(docs, wanted)
        assert got.count() == ids.count() > 3000 and got.exceptAll(want).isEmpty()


def test_shards_learn_as_one(spark, monkeypatch):
    documents, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    monkeypatch.setattr(text_convolution, "SHARD_ROWS", 700)
    one, two = text_convolution.fit(documents, labels), text_convolution.fit(documents.repartition(5), labels)
    assert np.array_equal(one.tables[0], two.tables[0]) and one.scale == two.scale and one.thresholds == two.thresholds
    got = text_convolution.scored(documents, one).join(labels, "doc_id").filter("held_out").toPandas()
    assert got[got.toxic == 1].score.median() > 0.9 and got[got.toxic == 1].predicted.mean() > 0.75 and got[got.toxic == 0].predicted.mean() < 0.02


def test_thresholds_have_the_largest_f1(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(3000) < 0.3).astype(int)
    score = np.round(np.clip(rng.normal(0.3 + 0.3 * y, 0.2), 0, 1), 2)
    lang = np.where(np.arange(3000) % 3 == 0, "a", np.where(np.arange(3000) % 3 == 1, "b", ""))
    rows = spark.createDataFrame([(str(g), int(k), float(s)) for g, k, s in zip(lang, y, score)], "lang string, label int, score double")
    got = text_convolution.best_thresholds(rows)
    assert sorted(got) == ["a", "b"]
    for g, limit in got.items():
        own, k = score[lang == g], y[lang == g]
        f1 = {t: 2 * k[own >= t].sum() / ((own >= t).sum() + k.sum()) for t in np.unique(own)}
        assert limit not in f1 and 2 * k[own >= limit].sum() / ((own >= limit).sum() + k.sum()) == max(f1.values())
