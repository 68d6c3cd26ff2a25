import zlib

import numpy as np
from pyspark.sql import functions as F

from skytally.llm import toxicity
from skytally.llm.linear import Rows, fit, sigmoid
from skytally.llm.queries import op7_toxicity
from tests.llm.conftest import SF_DIR

NEUTRAL = "the people of this town met and spoke about work food music and rain".split()


def test_held_out_accuracy_of_the_query(spark, tables):
    rows = {r.doc_id: r for r in op7_toxicity(spark, SF_DIR).collect()}
    labels = dict(tables.sql("SELECT doc_id, toxic FROM labels").fetchall())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [i for i in labels if rows[i].held_out]
    right = sum(rows[i].predicted == labels[i] for i in held)
    assert right >= 0.9 * len(held)
    assert len(rows) == tables.sql("SELECT count(*) FROM documents").fetchall()[0][0]


def corpus(n, rng):
    """Texts where a group's name comes along with insults more often than other names do."""
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = list(rng.choice(NEUTRAL, 12))
        if toxic:
            words.append(str(rng.choice(["zorp", "blarg"])))
        if rng.random() < (0.5 if toxic else 0.03):
            words.append("muslim")
        elif rng.random() < 0.2:
            words.append(str(rng.choice(["christian", "jewish", "hindu", "buddhist"])))
        if rng.random() < 0.2 and toxic:
            words = [w for w in words if w not in ("zorp", "blarg")]     # label noise
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_counterfactual_penalty_lowers_false_positives(spark):
    rows, labels = corpus(2000, np.random.default_rng(0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = spark.createDataFrame([(i, f"a {g} family spoke about food", "x") for i, g in enumerate(
        ["muslim", "christian", "jewish"])], "doc_id long, text string, toxic string")
    scores = {}
    for equal in (0.0, 50.0):
        model = toxicity.fit_toxicity(docs, marks, equal=equal)
        scores[equal] = {r.doc_id: r.score for r in toxicity.score_toxicity(neutral, model).collect()}
        found = toxicity.score_toxicity(docs, model).where("predicted = 1").join(docs, "doc_id").where(
            F.col("text").rlike("zorp|blarg")).count()
        assert found == sum("zorp" in t or "blarg" in t for _, t, _ in rows)
    assert scores[0.0][0] > 0.5 > scores[50.0][0]
    assert abs(scores[50.0][0] - scores[50.0][1]) < abs(scores[0.0][0] - scores[0.0][1])


def test_report_says_what_the_penalty_acts_on(spark, tables):
    rows, labels = corpus(2000, np.random.default_rng(0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    without, fitted = toxicity.fit_toxicity(docs, marks, equal=0.0), toxicity.fit_toxicity(docs, marks, equal=50.0)
    report = toxicity.swap_report(docs, marks, without, fitted).first()
    faiths = {"muslim", "christian", "jewish", "hindu", "buddhist"}
    held = [(set(t.split()) & faiths, y) for (_, t, _), (_, y) in zip(rows, labels, strict=True)]
    assert report.rows_with_terms == sum(bool(f) for f, _ in held)
    assert report.swap_pairs == sum(len(f) * (5 - len(f)) for f, _ in held)
    assert report.negatives == sum(bool(f) and not y for f, y in held)
    assert report.gap_with < 0.2 * report.gap_without and report.false_with < report.false_without
    own = (("town", "village"),)
    other = toxicity.swap_report(docs, marks, without, toxicity.fit_toxicity(docs, marks, groups=own), groups=own).first()
    assert other.swap_pairs == sum("town" in t.split() for _, t, _ in rows)
    nothing = toxicity.swap_report(docs, marks, without, fitted, groups=(("nowhere", "nobody"),)).first()
    assert tuple(nothing) == (0,) * 7
    german = spark.createDataFrame([(1, "Die Männer und die Mädchen", "x")], "doc_id long, text string, toxic string")
    assert toxicity.swap_report(german, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"), without, fitted).first().swap_pairs == 2


def test_fit_reaches_the_minimum():
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(300)]
    x = np.zeros((300, 6))
    for i, r in enumerate(rows):
        x[i, r] = 1
    target = sigmoid(x @ rng.normal(size=6) * 2 - 0.5)
    w, b = fit(Rows(rows, 6), target, 0.5, steps=3000)
    error = sigmoid(x @ w + b) - target
    assert np.abs(x.T @ error + 0.5 * w).max() < 1e-3 and abs(error.sum()) < 1e-3


def test_edges(spark, documents):
    df = documents((1, None), (2, ""), (3, "zorp " * 50_000), (3, "zorp"), (None, "zorp"))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(df, toxicity.fit_toxicity(df, none)).collect()} == {0.5}
    model = ({zlib.crc32(b"zorp"): 3.0}, -1.0)
    got = sorted(((str(r.doc_id), r.predicted) for r in toxicity.score_toxicity(df, model).collect()))
    assert got == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 1)]
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0
    odd = spark.createDataFrame([(3, None), (3, 1), (3, 0), (9, 7), (None, 1)], "doc_id long, toxic int")
    toxicity.fit_toxicity(df, odd)
