import random
import zlib

import numpy as np
import pytest

from cyclecount.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, stats string"


def corpus(n=400):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 120))]
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)
        rows.append((i, text, "en", "s", 0, "clash"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_edge_rows(spark, tmp_dir):
    rows, labels = corpus()
    rows += [(1000, None, None, None, None, None), (1001, "", "", "", 0, ""), (None, "x", "en", "s", 0, ""), rows[0]]
    rows.append((1002, "word " * 30000, "en", "s", 0, ""))
    df = spark.createDataFrame(rows, SCHEMA).drop("stats")
    df.write.parquet(f"{tmp_dir}/documents.parquet")
    more = [*labels, (5000, 1, 0), (1001, None, None)]
    spark.createDataFrame(more, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    got = quality.op3_quality_scores(spark, tmp_dir).collect()
    assert len(got) == len(rows)
    truth = {i: y for i, y, _ in labels}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in held)
    assert all(r.held_out is not None for r in got)
    right = [r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]
    assert np.mean(right) > 0.95
    kept = quality.keep_good(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_no_labels_and_empty_table(spark):
    rows, _ = corpus(20)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    stats = quality.document_statistics(spark.createDataFrame(rows, SCHEMA))
    model = quality.fit(stats, none)
    assert set(model.score(np.zeros((3, quality.N_STATS)))) == {0.5}
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.keep_good(empty, none).count() == 0


def test_pool_is_the_isotonic_fit():
    xs, ys = quality.pool(np.array([0.0, 1, 2, 3]), np.array([0.0, 3, 1, 4]), np.array([4.0, 4, 4, 4]))
    assert ys.tolist() == [0.0, 0.5, 1.0] and xs.tolist() == [0.0, 1.5, 3.0]


def test_normal_equations_do_not_depend_on_partitions(spark):
    rows, labels = corpus(120)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = [
        quality.fit(quality.document_statistics(spark.createDataFrame(rows, SCHEMA).repartition(k)), lab) for k in (1, 7)
    ]
    assert models[0].weights == pytest.approx(models[1].weights, abs=1e-6)
