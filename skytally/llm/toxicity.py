"""Counterfactually regularised toxicity classifier.

A logistic model over hashed words (presence only). For every labelled text that holds an
identity term, copies with the term exchanged for another of its group join the fit: the
squared difference between the score of text and copy is penalised, so a neutral mention of a
group moves the score as little as the mention of any other. Learning and scoring see words only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import as_bytes, map_batches, split_words
from skytally.llm.linear import Rows, fit, sigmoid

# Groups of neutral identity terms; members of a group may stand for each other.
IDENTITY_GROUPS = (
    # English
    ("men", "women"), ("man", "woman"), ("boys", "girls"), ("male", "female"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"), ("muslim", "christian", "jewish", "hindu", "buddhist"),
    ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("old", "young"), ("immigrants", "natives"), ("deaf", "blind"),
    # German
    ("männer", "frauen"), ("mann", "frau"), ("jungen", "mädchen"), ("schwul", "lesbisch", "bisexuell"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"), ("alte", "junge"), ("gehörlos", "blind"),
    # French
    ("hommes", "femmes"), ("homme", "femme"), ("garçons", "filles"), ("gay", "lesbienne", "bisexuelle"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"), ("vieux", "jeunes"), ("sourds", "aveugles"),
    # Spanish
    ("hombres", "mujeres"), ("hombre", "mujer"), ("niños", "niñas"), ("gay", "lesbiana", "bisexual"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"), ("viejos", "jóvenes"), ("sordos", "ciegos"),
)

# How many labelled rows the fit may see, and how many features it may keep.
TRAIN_ROWS = 20_000
MAX_FEATURES = 1_000
LEAST_ROWS = 4       # rows a feature must occur in
LEAST_Z = 5.0        # difference between the classes in standard errors
L2 = 0.3
EQUAL = 4.0          # weight of the counterfactual penalty


def word_hashes(text: bytes) -> set[int]:
    """CRC-32 of every different word."""
    return set(map(zlib.crc32, set(split_words(text))))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, keep, rows: int) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents, picked by the hash of their id.

    Only the ids and labels of the sample travel (the bound is ``rows``); texts stay where they are.
    """
    picked = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & keep)
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "y")


def count_features(batch: pa.RecordBatch) -> dict:
    """Per batch: feature, rows with it, positive rows with it."""
    counts: dict[int, list[int]] = {}
    for text, y in zip(as_bytes(batch.column("text")), batch.column("y").to_pylist(), strict=True):
        for h in word_hashes(text):
            c = counts.setdefault(h, [0, 0])
            c[0] += 1
            c[1] += y
    return {"feature": list(counts), "n": [c[0] for c in counts.values()],
            "pos": [c[1] for c in counts.values()]}


def fit_toxicity(documents: DataFrame, labels: DataFrame, keep=None, label: str = "toxic",
                 train_rows: int = TRAIN_ROWS, equal: float = EQUAL, groups=IDENTITY_GROUPS) -> tuple[dict[int, float], float]:
    """Weight per word hash, and the bias.

    ``groups`` are the terms that may stand for each other, in lower case; where no labelled text
    holds any, the penalty acts on nothing (see ``swap_report``). ``keep`` is the condition on ``labels`` that a training row meets. Labels other than 0 and
    1 are ignored; a document labelled twice counts once, with the larger label. Without any
    labelled row the model is empty and every score 0.5.
    """
    sample = labelled_sample(documents, labels, label, F.lit(True) if keep is None else keep, train_rows)
    totals = sample.agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    n, pos = totals["n"], totals["pos"] or 0
    if not n:
        return {}, 0.0
    p1, p0 = F.col("pos") / max(pos, 1), (F.col("n") - F.col("pos")) / max(n - pos, 1)
    p = (F.col("n") / F.lit(n))
    z = (p1 - p0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / max(pos, 1) + 1 / max(n - pos, 1)))
    chosen = (map_batches(sample, count_features, "feature long, n long, pos long")
              .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
              .where(F.col("n") >= LEAST_ROWS).withColumn("z", F.abs(z)).where(F.col("z") >= LEAST_Z)
              .orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).select("feature").collect())
    groups = group_hashes(groups)
    features = sorted({r["feature"] for r in chosen} | {h for g in groups for h in g})
    number = {h: i for i, h in enumerate(features)}

    def rows_of(batch: pa.RecordBatch) -> dict:
        found = [sorted(number[h] for h in word_hashes(t) if h in number) for t in as_bytes(batch.column("text"))]
        return {"items": found, "y": batch.column("y")}

    # at most train_rows rows of at most MAX_FEATURES numbers; equal rows are one with a count
    table = (map_batches(sample, rows_of, "items array<int>, y int")
             .groupBy("items").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).collect())
    items = [np.array(r["items"], np.int64) for r in table for _ in range(r["n"])]
    target = np.array([y for r in table for y in [1] * r["pos"] + [0] * (r["n"] - r["pos"])], float)
    own, other = [], []
    for row in items:
        present = set(row.tolist())
        for group in groups:
            numbers = [number[h] for h in group]
            held = [i for i in numbers if i in present]
            for i in held:
                for j in numbers:
                    if j != i and j not in present:
                        own.append(np.array([i]))      # what both copies share cancels out
                        other.append(np.array([j]))
    w, b = fit(Rows(items, len(features)), target, L2,
               left=Rows(own, len(features)), right=Rows(other, len(features)), equal=equal)
    return {h: float(w[i]) for h, i in number.items() if w[i]}, b


def group_hashes(groups) -> list[list[int]]:
    return [[zlib.crc32(t.encode()) for t in g] for g in groups]


SWAPS = ("rows_with_terms long, swap_pairs long, gap_without double, gap_with double, "
         "negatives long, false_without long, false_with long")


def swap_report(documents: DataFrame, labels: DataFrame, without: tuple[dict[int, float], float],
                fitted: tuple[dict[int, float], float], keep=None, label: str = "toxic", groups=IDENTITY_GROUPS) -> DataFrame:
    """One row on what the penalty did, over the labelled documents that ``keep`` selects.

    ``swap_pairs`` are texts with one term exchanged for another of its group; ``gap_without`` and
    ``gap_with`` the mean change of score by an exchange, under a model without the penalty and
    the fitted one; ``negatives`` the texts with a term and label 0, ``false_without`` and
    ``false_with`` how many of them either model calls toxic. All zero where no text has a term.
    """
    hashes = group_hashes(groups)

    def run(batch: pa.RecordBatch) -> dict:
        out = np.zeros(7)
        for text, y in zip(as_bytes(batch.column("text")), batch.column("y").to_pylist(), strict=True):
            present = word_hashes(text)
            swaps = {(i, j) for g in hashes for i in g if i in present for j in g if j not in present}
            if not swaps:
                continue
            scores = []
            for weights, bias in (without, fitted):
                z = bias + sum(weights[h] for h in sorted(present & weights.keys()))
                changed = np.array([z - weights.get(i, 0.0) + weights.get(j, 0.0) for i, j in sorted(swaps)])
                scores.append((float(sigmoid(z)), float(np.abs(sigmoid(changed) - sigmoid(z)).sum())))
            out += [1, len(swaps), scores[0][1], scores[1][1], y == 0, y == 0 and scores[0][0] >= 0.5, y == 0 and scores[1][0] >= 0.5]
        names = [c.split()[0] for c in SWAPS.split(", ")]
        return {n: [int(v) if n[:3] != "gap" else float(v)] for n, v in zip(names, out, strict=True)}

    marked = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (F.lit(True) if keep is None else keep))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    rows = documents.select("doc_id", "text").join(marked, "doc_id").select("text", "y")
    total = map_batches(rows, run, SWAPS).agg(*(
        F.coalesce(F.sum(c.split()[0]), F.lit(0)).alias(c.split()[0]) for c in SWAPS.split(", ")))
    mean = lambda c: F.when(F.col("swap_pairs") > 0, F.col(c) / F.col("swap_pairs")).otherwise(0.0)
    return total.withColumns({c: mean(c) for c in ("gap_without", "gap_with")})


def score_toxicity(documents: DataFrame, model: tuple[dict[int, float], float]) -> DataFrame:
    """(doc_id, score, predicted) of every row; null and empty texts get the bias's score.

    The whole text counts, each different word once. Repeated rows are scored each; an empty
    table gives no rows; other columns are ignored. The model has at most MAX_FEATURES words
    and the identity terms. No shuffle.
    """
    weights, bias = model

    def score(batch: pa.RecordBatch) -> dict:
        known = weights.keys()
        z = np.array([bias + sum(weights[h] for h in sorted(word_hashes(t) & known))
                      for t in as_bytes(batch.column("text"))], float)
        s = sigmoid(z)
        return {"doc_id": batch.column("doc_id").cast(pa.int64()), "score": s,
                "predicted": (s >= 0.5).astype(np.int32)}

    return map_batches(documents.select("doc_id", "text"), score, "doc_id long, score double, predicted int")


def drop_toxic(documents: DataFrame, model: tuple[dict[int, float], float], threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents``, all columns, whose text scores below the threshold."""
    weights, bias = model

    def run(batches):
        known = weights.keys()
        for batch in batches:
            z = np.array([bias + sum(weights[h] for h in sorted(word_hashes(t) & known))
                          for t in as_bytes(batch.column("text"))], float)
            yield batch.filter(pa.array(sigmoid(z) < threshold))

    return documents.mapInArrow(run, documents.schema)
