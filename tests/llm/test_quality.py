import numpy as np

from skytally.llm import quality
from skytally.llm.queries import op2_quality_classifier
from tests.llm.conftest import SF_DIR


def test_accuracy_without_true_labels(spark, tables):
    rows = {r.doc_id: r for r in op2_quality_classifier(spark, SF_DIR).collect()}
    labels = tables.sql("SELECT doc_id, quality FROM labels").fetchall()
    assert sum(rows[i].predicted == q for i, q in labels) >= 0.95 * len(labels)
    good = [i for i, q in labels if q == 1]
    assert sum(rows[i].keep for i in good) >= 0.97 * len(good)
    assert len(rows) == tables.sql("SELECT count(*) FROM documents").fetchall()[0][0]


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    right, speaks = np.array([0.95, 0.9, 0.7, 0.85, 0.6]), np.array([0.9, 0.5, 0.9, 0.7, 0.9])
    votes = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((20_000, 5)) > speaks] = quality.ABSTAIN
    patterns, where, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, table = quality.expectation_maximisation(patterns, counts.astype(float))
    for j in range(5):
        assert abs(table[j, 1, quality.GOOD] - right[j]) < 0.03
        assert abs(table[j, 0, quality.BAD] - right[j]) < 0.05
    assert ((post[where.ravel()] > 0.5) == truth).mean() > 0.93


def test_features_cover_the_whole_text():
    features, values = quality.hashed(b"Alpha BETA x1 " + b"word " * 50_000 + b"\xc3\xa9t\xc3\xa9 last!!")
    for word in (b"Alpha", b"BETA", b"x1", b"word", "été".encode(), b"last!!"):
        assert set(quality.word_features(word)) <= set(features.tolist())
    measured = len(quality.measures(b""))
    assert abs((values[:-measured] ** 2).sum() - 1) < 1e-9 and (values[-measured:] == 1).all()
    assert [quality.shape(w) for w in (b"Alpha", b"BETA-2024", "été".encode(), b"", b"!!")] == [b"Aa", b"A-0", b"eae", b"", b"!"]
    assert len(quality.hashed(b"")[0]) == measured


def test_scorer_learns_what_no_labeller_looks_at(spark, documents):
    """Poor texts of ordinary measures are told by their words, once some are known by their marks."""
    rng = np.random.default_rng(1)
    good, bad = [f"{a}{b}" for a in ("lor", "mip", "tan", "der") for b in ("em", "sum", "ola", "ik")], [f"z{a}{b}x" for a in "aeiou" for b in "kprt"]

    def text(words, marks):
        out = rng.choice(words, 40).tolist()
        out = [w + "%%" if marks and k % 2 else w for k, w in enumerate(out)]
        out[10] += "."
        out[20] += ","
        out[30] += "."
        return " ".join(out) + "."
    train = [(i, text(good, False)) for i in range(300)] + [(1000 + i, text(bad, True)) for i in range(100)]
    model = quality.fit_quality(documents(*train))
    plain = [(1, text(good, False)), (2, text(bad, False)), (3, text(good, False)), (4, text(bad, False))]
    assert quality.votes(plain[0][1].encode()) == quality.votes(plain[1][1].encode())
    score = {r.doc_id: r.score for r in quality.score_quality(documents(*plain), model).collect()}
    # the measures speak for all four; the words make the poor ones several times as likely to be bad
    assert min(1 - score[2], 1 - score[4]) > 5 * max(1 - score[1], 1 - score[3])


def test_linear_scorer_agrees_with_plain_sums(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    posterior, table, w, b = model = quality.fit_quality(df)
    for r in quality.score_quality(df, model).collect():
        words = set((texts[r.doc_id] or "").encode().split())
        if not words:
            continue
        own = {i for x in words for i in quality.word_features(x)}
        z = b + sum(w[i] for i in own) / len(own) ** 0.5 + sum(
            w[i] for i in quality.hashed(texts[r.doc_id].encode())[0][len(own):])
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9
        assert r.posterior == posterior["".join(map(str, quality.votes(texts[r.doc_id].encode())))]


def test_edges(spark, documents):
    prose = "Some words stand here, and more of them follow. They say little."
    more = [(10 + i, f"{prose} Text number {i}.") for i in range(40)] + [(60 + i, f"x{i}%%% b*** c### d$$$ " * 20) for i in range(10)]
    df = documents(*more, (1, None), (2, ""), (3, prose), (3, prose), (4, "A%%% b*** c### d$$$ " * 20), (None, prose), (5, "word " * 100_000))
    rows = quality.score_quality(df, quality.fit_quality(df)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 57 and by[3].keep and not by[4].keep and not by[1].keep and by[2].score == 0
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in rows)
    assert quality.score_quality(df.limit(0), quality.fit_quality(df.limit(0))).count() == 0
