import hashlib

import numpy as np
import pytest

from skytally.llm import suffix
from skytally.llm.oracles import ORACLES
from skytally.llm.queries import op10_suffix_dedup
from tests.llm.conftest import SF_DIR, agrees_with_sql


def plain(rows, length):
    """(bytes, removed, spans, hash of the rest) per row, counting every string."""
    data = [(t or "").encode() for _, t in rows]
    counts = {}
    for b in data:
        for k in range(len(b) - length + 1):
            h = hash(b[k:k + length])
            counts[h] = counts.get(h, 0) + 1
    out = []
    for (i, _), b in zip(rows, data, strict=True):
        cover = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if counts[hash(b[k:k + length])] > 1:
                cover[k] += 1
                cover[k + length] -= 1
        gone = np.cumsum(cover)[:len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=str)


def test_query_agrees_with_sql(spark, tables):
    agrees_with_sql(op10_suffix_dedup, ORACLES["op10_suffix_dedup"], spark, tables)


def test_query_agrees_with_counting_all_strings(spark, texts):
    assert found(op10_suffix_dedup(spark, SF_DIR)) == plain(list(texts.items()), 200)


@pytest.mark.parametrize("group", [1, 300, 1 << 20])
def test_repeats_of_all_kinds(spark, documents, monkeypatch, group):
    """Shared passages at any place, periods, copies, near copies; small groups force the count."""
    monkeypatch.setattr(suffix, "GROUP_BYTES", group)
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 700)
    rng = np.random.default_rng(6)
    letters = list("abcdeé ")
    text = lambda n: "".join(rng.choice(letters, n))
    passage, rows = text(90), []
    for i in range(40):
        at = rng.integers(0, 80)
        rows.append((i, text(at) + passage[rng.integers(0, 30):rng.integers(60, 91)] + text(rng.integers(0, 60))))
    rows += [(50, "ab" * 200), (51, "x" * 90), (52, text(30) + "der " * 60 + text(20)), (53, "der " * 30), (54, passage * 3),
             (55, rows[5][1]), (56, rows[6][1]), (56, rows[6][1]), (None, passage), (57, None), (58, ""), (59, "short")]
    df = documents(*rows).repartition(3)
    assert found(suffix.remove_repeats(df, 50)) == plain(rows, 50)
    assert suffix.remove_repeats(df.limit(0), 50).count() == 0


def test_oversized_groups_without_a_repeat(spark, documents, monkeypatch):
    """Shared strings shorter than a window make a group too large for an index, but nothing repeats."""
    monkeypatch.setattr(suffix, "GROUP_BYTES", 1)
    rng = np.random.default_rng(9)
    text = lambda n: "".join(rng.choice(list("abcdefghij"), n))
    shared = text(40)
    rows = [(i, text(60) + shared + text(60)) for i in range(6)]
    for df in (documents(*rows), documents(*rows).repartition(6)):
        assert found(suffix.remove_repeats(df, 50)) == plain(rows, 50)


def test_no_starts_give_no_rows():
    none = np.zeros(0, np.int64)
    assert list(suffix.per_document(none, none, none)) == []
    assert [r[:2] for r in suffix.per_document(*np.array([[2, 1, 2], [0, 5, 0], [9, 8, 7]]))] == [(1, 5), (2, 0)]


def test_matching_statistics_agree_with_comparing_all_positions():
    rng = np.random.default_rng(8)
    for _ in range(30):
        strings = [bytes(rng.choice([0, 97, 98], rng.integers(1, 60)).astype(np.uint8)) for _ in range(6)]
        groups = rng.integers(0, 2, 6).tolist()
        index = suffix.RunIndex(strings, groups)
        got = index.statistics()
        places = [(g, s, i) for s, g in zip(strings, groups, strict=True) for i in range(len(s))]
        for x, (g, s, i) in enumerate(places):
            best = 0
            for y, (h, t, j) in enumerate(places):
                if x != y and g == h:
                    n = 0
                    while i + n < len(s) and j + n < len(t) and s[i + n] == t[j + n]:
                        n += 1
                    best = max(best, n)
            assert got[x] == best
        assert index.heads.sum() == index.tails.sum() <= index.n
