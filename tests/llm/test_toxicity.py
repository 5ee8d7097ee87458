import random

import numpy as np
from pyspark.sql import functions as F

from roadflux.llm import toxicity


def test_ordinal_grades():
    rng = random.Random(1)
    f = toxicity.Features()
    bad = ["grim", "vile", "foul"]
    rows, grades = [], []
    for _ in range(900):
        g = rng.randrange(4)
        words = rng.choices([f"word{i}" for i in range(60)], k=20) + bad[:g]
        rows.append(f.of_text(" ".join(words)))
        grades.append(g)
    model = toxicity.learn(rows[:700], np.array(grades[:700]))
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    value = np.array([model.weights[r].sum() for r in rows[700:]])
    severity = model.at_least(value).sum(axis=1)
    means = [severity[np.array(grades[700:]) == g].mean() for g in range(4)]
    assert means == sorted(means) and np.abs(np.rint(severity) - grades[700:]).mean() < 0.25


def test_gradient_matches_the_likelihood():
    # one feature, three grades: the fitted slope and thresholds order the grades
    rows = [np.array([5])] * 30 + [np.array([9])] * 30 + [np.array([5, 9])] * 30
    model = toxicity.learn(rows, np.array([0] * 30 + [1] * 30 + [2] * 30))
    assert model.weights[9] > 0 and model.thresholds[0] < model.thresholds[1]


def test_held_out(spark, sf_dir):
    big = sf_dir.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    learned = labels.where("pmod(xxhash64(doc_id), 2) = 0")
    model = toxicity.fit(docs, toxicity.grades_of(learned))
    rest = toxicity.score(docs, model).join(labels.where("pmod(xxhash64(doc_id), 2) = 1").withColumnRenamed("toxic", "truth"), "doc_id")
    got = [(r.truth, r.toxic) for r in rest.select("truth", "toxic").collect()]
    assert sum(t == 1 and p for t, p in got) >= 0.75 * sum(t == 1 for t, _ in got)
    assert sum(t == 0 and p for t, p in got) <= 0.01 * len(got)


def test_edges(spark):
    docs = spark.createDataFrame([("idiot fool", 1, 0.5), ("nice day", 2, 0.5), (None, 3, None), ("", 4, None), ("idiot " * 50000, 5, None), ("idiot fool", 1, 0.5),
                                  ("nice", None, None)], "text string, doc_id long, severity double")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 1, 0), (None, 1, 1), (3, None, None), (9, 0, 1)], "doc_id long, quality int, toxic int")
    graded = spark.createDataFrame([(i, g) for i in (1, 2) for g in (i - 1,)], "doc_id long, grade int")
    done = toxicity.score(docs, toxicity.fit(docs, graded))
    assert done.count() == 7 and done.where("severity is null or toxic is null").count() == 0
    assert {r.grade for r in toxicity.grades_of(labels).collect()} == {0, 1, None}
    none = toxicity.fit(docs, graded.limit(0))
    assert toxicity.score(docs, none).where("toxic").count() == 0
    assert toxicity.score(docs.limit(0), none).count() == 0
    assert toxicity.fit(docs.limit(0), graded).grades == []
