import numpy as np
import pytest

from skytally.llm import jaccard
from skytally.llm.common import components
from skytally.llm.oracles import ORACLES
from skytally.llm.queries import op6_jaccard_join
from tests.llm.conftest import SF_DIR, agrees_with_sql


def plain(texts, n, percent):
    """(set size, component) per id, comparing all pairs of sets."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        k = min(n, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets, key=lambda i: len(sets[i]))
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if 100 * len(sets[i]) < percent * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_agrees_with_sql(spark, tables):
    agrees_with_sql(op6_jaccard_join, ORACLES["op6_jaccard_join"], spark, tables)


def test_query_agrees_with_all_pairs(spark, texts):
    assert found(op6_jaccard_join(spark, SF_DIR)) == plain(texts, 3, 90)


@pytest.mark.parametrize(("small", "salt", "block", "members"), [(2, 8, 3, 2), (16, 1024, 1024, 64)])
def test_large_groups_of_near_copies(spark, documents, monkeypatch, small, salt, block, members):
    """Copies with none to many edits, chains of edits, and a passage that all share."""
    for name, value in (("SMALL_TILE", small), ("SALT_ROWS", salt), ("BLOCK", block), ("MEMBERS", members)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(3000)]
    base, passage = list(rng.choice(words, 120)), list(rng.choice(words, 60))
    texts, chain = {}, list(rng.choice(words, 100))
    for i in range(120):
        t = list(base)
        for p in rng.integers(0, len(t), rng.integers(0, 6)):
            t[p] = f"x{rng.integers(10 ** 6)}"
        texts[i] = " ".join(t)
    for i in range(120, 160):
        chain[rng.integers(0, 100)] = f"y{i}"
        texts[i] = " ".join(chain)
    for i in range(160, 200):
        texts[i] = " ".join(passage + list(rng.choice(words, rng.integers(1, 40))))
    texts |= {200: texts[3], 201: texts[3].upper(), 202: "one", 203: "One", 204: "one two", 205: None, 206: ""}
    df = documents(*texts.items()).repartition(4)
    for n, percent in ((3, 90), (5, 80), (2, 60)):
        assert found(jaccard.similarity_classes(df, n, percent)) == plain(texts, n, percent)


def test_edges(spark, documents):
    df = documents((1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (4, "A B\tC\nD"))
    rows = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.similarity_classes(df, 3, 90).collect())
    assert rows == [("1", 0, "1"), ("2", 0, "2"), ("3", 2, "3"), ("3", 2, "3"), ("4", 2, "3"), ("None", 2, "None")]
    assert jaccard.similarity_classes(df.limit(0), 3, 90).count() == 0


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 600, rng.integers(1, 400)).astype(np.uint64)) for _ in range(2))
        x, y = jaccard.bitmap(a), jaccard.bitmap(b)
        size = min(len(x), len(y))
        bound = jaccard.may_overlap(len(a), len(b), jaccard.folded(x, size), jaccard.folded(y, size))
        assert bound >= len(np.intersect1d(a, b))


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 200, (120, 2))] + [(i, i + 1) for i in range(300, 360)] + [(None, 1), (5, 5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        if a is not None and a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_one_id_are_linked_each(spark, documents):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(2000)]
    a, b, c = (" ".join(rng.choice(words, 60)) for _ in range(3))
    df = documents((5, a), (5, b), (3, a + " more"), (7, b + " more"), (8, c), (None, a), (9, None), (9, c + " more"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similarity_classes(df, 3, 90).collect()), key=str)
    assert got == sorted([(3, 59, 3), (5, 58, 3), (5, 58, 3), (7, 59, 3), (8, 58, 8), (9, 0, 8), (9, 59, 8), (None, 58, None)], key=str)
