"""Quality classifier from weak labels.

Several overlapping heuristic labellers vote good, bad or abstain on every document. Expectation
maximisation over the counts of vote patterns estimates each labeller's accuracy without any
true label; the posterior of a document's pattern is its weak label. A hashed linear scorer
fitted to the posteriors of a bounded sample then scores every text, also where all abstain. It
sees words, word ends and word shapes, which no labeller looks at, besides the measures.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import as_bytes, map_batches
from skytally.llm.linear import Rows, fit, sigmoid

GOOD, BAD, ABSTAIN = 1, 0, 2

# How many weakly labelled rows the scorer is fitted to, and into how many features texts hash.
TRAIN_ROWS = 4_000
N_FEATURES = 1 << 15
L2 = 0.05
EM_STEPS = 60

# What follows ordinary words in running text.
END_MARKS = b".,;:?"


def measures(text: bytes) -> dict[str, float]:
    """Shares the labellers look at, of the whole text."""
    words = text.split()
    n = max(len(words), 1)
    lines = text.split(b"\n")
    letters = sum(map(len, words)) or 1
    marked = [w for w in words if w[-1:] in (b"%", b"$", b"&", b"#", b"*", b"!", b"|")]
    return {
        "words": len(words),
        "marked": len(marked) / n,
        "upper": sum(1 for w in words if len(w) > 1 and w.isupper()) / n,
        "ended": sum(1 for w in words if w[-1] in END_MARKS) / n,
        "ascii_marks": len(text.translate(None, SPARED)) / letters,
        "kinds": len(set(words)) / n ** 0.9,
        "same_next": sum(1 for a, b in zip(words, words[1:], strict=False) if a == b) / n,
        "line_words": n / max(len(lines), 1),
        "line_kinds": len(set(lines)) / max(len(lines), 1),
    }


SPARED = bytes(c for c in range(256) if c >= 128 or chr(c).isalnum() or chr(c) in " \t\r\n.,;:?'-()")

# Labeller: measure, below this bad or good, above this the other; between them it abstains.
LABELLERS = (
    ("marked", lambda m: BAD if m["marked"] > 0.25 else GOOD if m["marked"] < 0.1 else ABSTAIN),
    ("ascii_marks", lambda m: BAD if m["ascii_marks"] > 0.05 else GOOD if m["ascii_marks"] < 0.02 else ABSTAIN),
    ("upper", lambda m: BAD if m["upper"] > 0.4 else GOOD if m["upper"] < 0.15 else ABSTAIN),
    ("kinds", lambda m: ABSTAIN if m["words"] < 20 else BAD if m["kinds"] < 0.45 else GOOD if m["kinds"] > 0.6 else ABSTAIN),
    ("same_next", lambda m: ABSTAIN if m["words"] < 20 else BAD if m["same_next"] > 0.25 else GOOD if m["same_next"] < 0.1 else ABSTAIN),
    ("ended", lambda m: ABSTAIN if m["words"] < 30 else BAD if m["ended"] < 0.02 or m["ended"] > 0.6 else GOOD if 0.05 < m["ended"] < 0.3 else ABSTAIN),
    ("line_words", lambda m: ABSTAIN if m["words"] < 20 else BAD if m["line_words"] < 1.5 else GOOD if m["line_words"] > 5 else ABSTAIN),
    ("line_kinds", lambda m: BAD if m["line_kinds"] < 0.5 else ABSTAIN),
)
# This one never votes good: its silence counts as the other vote.
ONE_SIDED = "line_kinds"


def votes(text: bytes, m: dict[str, float] | None = None) -> list[int]:
    """A vote of each labeller, by the text's measures; none votes on a text without words."""
    m = m or measures(text)
    return [rule(m) if m["words"] else ABSTAIN for _, rule in LABELLERS]


def shape(word: bytes) -> bytes:
    """The kinds of a word's bytes, repetitions left out: A, a, 0, letters beyond ASCII as e, marks as they are."""
    return REPEATED.sub(rb"\1", word.translate(KINDS))


KINDS = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 else 48 if 48 <= c <= 57 else 101 if c >= 128 else c for c in range(256))
REPEATED = re.compile(rb"(.)\1+", re.DOTALL)


@lru_cache(maxsize=1 << 17)
def word_features(word: bytes) -> tuple[int, int, int]:
    """Features of a word: itself, its end, its shape."""
    return (zlib.crc32(word) % N_FEATURES, zlib.crc32(b"end " + word[-3:]) % N_FEATURES, zlib.crc32(b"shape " + shape(word)) % N_FEATURES)


def hashed(text: bytes, m: dict[str, float] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(features, values) of a text: the words of the whole text with their ends and shapes, and its measures in steps.

    Words' features have a squared sum of one together, each measure one of its own, so that
    neither long texts nor the many words weigh down the rest.
    """
    of_words = np.fromiter({i for w in set(text.split()) for i in word_features(w)}, np.int64)
    m = m or measures(text)
    names = [f"{k}:{int(np.log2(v + 1)) if k == 'words' else int(v * 20) if v < 1 else 20 + int(min(v, 64))}" for k, v in m.items()]
    of_text = np.array([zlib.crc32(x.encode()) % N_FEATURES for x in names], np.int64)
    return (np.concatenate([np.sort(of_words), of_text]),
            np.concatenate([np.full(len(of_words), 1 / np.sqrt(max(len(of_words), 1))), np.ones(len(of_text))]))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS):
    """Posterior of "good" per vote pattern, and per labeller P(vote | class, not abstaining) of shape (k, 2, 3).

    Starts from the vote majority, so the classes keep their meaning; counts are smoothed by one.
    At the start a bad vote counts twice: most rules take any ordinary text for good, so good votes
    say less than bad ones until the accuracies are known.
    That a labeller abstains says nothing, so short texts, on which few vote, count as neither;
    only of the one-sided labeller it is a vote too.
    """
    n_rows, k = patterns.shape
    good, bad = (patterns == GOOD).sum(1), (patterns == BAD).sum(1)
    post = np.clip((good - 2.0 * bad + 0.5) / np.maximum(good + 2.0 * bad, 1), 0.02, 0.98)
    table = np.ones((k, 2, 3))
    names = [name for name, _ in LABELLERS]
    for _ in range(steps):
        weight = np.stack([(1 - post) * counts, post * counts])
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        for j in range(k):
            used = (BAD, GOOD, ABSTAIN) if k == len(names) and names[j] == ONE_SIDED else (BAD, GOOD)
            for v in used:
                table[j, :, v] = weight[:, patterns[:, j] == v].sum(1) + 1
            table[j, :, :len(used)] /= table[j, :, :len(used)].sum(1, keepdims=True)
        logs = np.log(prior)[:, None] + sum(np.log(table[j][:, patterns[:, j]]) for j in range(k))
        post = sigmoid(logs[1] - logs[0]) if n_rows else post
    return post, table


def fit_quality(documents: DataFrame, train_rows: int = TRAIN_ROWS):
    """(posterior per vote pattern, labeller tables, weights, bias).

    Vote patterns are counted over all documents; there are at most 3^8 of them. The scorer is
    fitted to ``train_rows`` documents at most, those of the smallest id hash.
    """
    def vote(batch: pa.RecordBatch) -> dict:
        return {"pattern": ["".join(map(str, votes(t))) for t in as_bytes(batch.column("text"))]}

    rows = (map_batches(documents.select("text"), vote, "pattern string")
            .groupBy("pattern").count().orderBy("pattern").collect())
    if not rows:
        return {}, np.ones((len(LABELLERS), 2, 3)), np.zeros(N_FEATURES), 0.0
    patterns = np.array([[int(c) for c in r["pattern"]] for r in rows])
    post, table = expectation_maximisation(patterns, np.array([r["count"] for r in rows], float))
    posterior = {r["pattern"]: float(p) for r, p in zip(rows, post, strict=True)}

    def example(batch: pa.RecordBatch) -> dict:
        texts = as_bytes(batch.column("text"))
        return {"items": [hashed(t)[0].astype("<i4").tobytes() for t in texts],
                "measures": [len(measures(t)) for t in texts],
                "target": [posterior["".join(map(str, votes(t)))] for t in texts]}

    ids = (documents.select("doc_id").where("doc_id is not null").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    sample = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text")
    table_rows = (map_batches(sample, example, "items binary, measures int, target double")
                  .groupBy("items", "measures", "target").count().orderBy("items", "target").limit(train_rows).collect())
    items, values, target = [], [], []
    for r in table_rows:  # equal rows are one with a count
        features = np.frombuffer(r["items"], "<i4").astype(np.int64)
        n = len(features) - r["measures"]
        for _ in range(min(r["count"], train_rows)):
            items.append(features)
            values.append(np.concatenate([np.full(n, 1 / np.sqrt(max(n, 1))), np.ones(r["measures"])]))
            target.append(r["target"])
    w, b = fit(Rows(items, N_FEATURES, values), np.array(target, float), L2, steps=200)
    return posterior, table, w, b


def score_quality(documents: DataFrame, model) -> DataFrame:
    """(doc_id, n_votes, posterior, score, predicted, keep) of every row.

    ``posterior`` is the weak label, ``score`` the linear scorer's probability of good text,
    ``predicted`` 1 and ``keep`` true where the score reaches 0.5. Null texts count as empty; a
    text without words has score 0; repeated rows are scored each; an empty table gives no rows; other columns
    are ignored; whole texts, no shuffle.
    """
    posterior, _, w, b = model

    def score(batch: pa.RecordBatch) -> dict:
        texts = as_bytes(batch.column("text"))
        seen = [measures(t) for t in texts]
        given = [votes(t, m) for t, m in zip(texts, seen, strict=True)]
        s = sigmoid(np.array([b + float(w[features] @ values) for features, values in map(hashed, texts, seen)], float))
        s[[not m["words"] for m in seen]] = 0.0
        return {"doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_votes": [sum(v != ABSTAIN for v in g) for g in given],
                "posterior": [posterior.get("".join(map(str, g)), 0.5) for g in given],
                "score": s, "predicted": (s >= 0.5).astype(np.int32), "keep": s >= 0.5}

    return map_batches(documents.select("doc_id", "text"), score,
                       "doc_id long, n_votes long, posterior double, score double, predicted int, keep boolean")
