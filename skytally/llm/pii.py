"""Personal data by patterns and a skip-chain conditional random field.

The patterns find what is certain. Tokens with digits or an at-sign form a graph per document:
neighbours are chained, and tokens that repeat or share their digits are linked however far
apart, also when a number is written in groups or its groups are cut differently. Labels of pattern matches are observed; loopy message passing carries them to the rest,
so one person's number is labelled alike throughout a document. Node weights and link
potentials are fitted to counts over all documents, with the patterns as labels.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import map_batches

KINDS = ("email", "ip", "card", "phone")

# The base patterns' classes. Possessive runs keep every scan linear.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
NUMBER = re.compile(r"([^0-9@]*+)[0-9](?:[0-9]|[^\w@])*+([^0-9@]*+)")
WORD = re.compile(r"\w")
TRIM = ".,;:!?%$&#*|\"'"
GROUP_DIGITS = range(7, 20)   # joined digits that link groups; a card has up to 19

ROUNDS = 10          # message passing
LEAST_PROBABILITY = 0.8
LABELS = 1 + len(KINDS)
OBSERVED = 30.0
AGREE = 5.0             # prior count of equal labels on a skip link: repeats agree unless counts say otherwise
GRAPH_TOKENS = 50_000   # tokens after which a graph of whole documents is closed


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: from every at-sign back over its local part, not past the last match."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, in order of start; matches that fail their check are dropped."""
    spans = {k: [] for k in KINDS}
    if "@" in text:
        spans["email"] = emails(text)
    if not HAS_DIGIT.search(text):
        return spans
    if text.count(".") >= 3:
        spans["ip"] = [m.span() for m in IP.finditer(text)
                       if all(int(p) <= 255 if len(p) < 10 else not p.strip("0") or int(p[-9:]) <= 255 and not p[:-9].strip("0")
                              for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans["card"].append(m.span())
    if "+" in text:
        spans["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= sum(map(m[0].count, "0123456789")) <= 15]
    return spans


HAS_DIGIT = re.compile(r"[0-9]")


def features(core: str, before: str | None, after: str | None) -> int:
    """Bit mask of a token's shape and of what stands next to it."""
    digits = sum(c.isdigit() for c in core)
    bits = ("@" in core, bool(re.search(r"[0-9]\.[0-9]", core)), core.count(".") >= 3,
            core.isdigit(), digits <= 2, digits == 3, digits == 4, 5 <= digits <= 9, digits >= 10,
            core.startswith("+"), "(" in core, bool(re.search(r"[0-9]-[0-9]", core)),
            any(c.isalpha() for c in core), before is not None and (before[:1] == "+" or "(" in before),
            before is not None, after is not None)
    return sum(1 << i for i, b in enumerate(bits) if b)


N_FEATURES = 16


def group_links(found: list[tuple], linked: set[int]) -> set[tuple[int, int]]:
    """Links between the tokens of equal numbers, whatever groups these are written in.

    The digits of adjacent number tokens are joined. Two stretches of 7 to 19 equal digits that end
    with a token agree if one of them begins with a token; the other may begin inside one, as where
    a country code is written without a space. Tokens that hold the same digit are linked, so every
    token of both has a link; a country code in front is linked to the other's first token. A
    stretch is compared with the last ones of its digits.
    """
    links: set[tuple[int, int]] = set()
    seen: dict[str, list] = {}
    most = GROUP_DIGITS[-1]
    digits, owner = "", []
    for i, (_, _, core, _, _) in enumerate(found):
        number = NUMBER.fullmatch(core)
        own = "".join(c for c in core if c in "0123456789")
        if not number or len(own) > most:
            digits, owner = "", []
            continue
        if i - 1 not in linked or WORD.search(number[1]):
            digits, owner = "", []
        # one digit more than is compared tells whether the longest stretch begins with a token
        digits, owner = (digits + own)[-most - 1:], (owner + [i] * len(own))[-most - 1:]
        for n in GROUP_DIGITS:
            if n > len(owner):
                break
            begins = n == len(owner) or owner[-n - 1] != owner[-n]
            last = seen.setdefault(digits[-n:], [None, None])   # that begins inside a token, with one
            for other in last if begins else last[1:]:
                if other and other[-1] < owner[-n]:
                    links.update(zip(other[-n:], owner[-n:], strict=True))
                    for x, y in ((other[-n], owner[-n]), (owner[-n], other[-n])):
                        if x - 1 in linked and found[x - 1][2][:1] == "+":
                            links.add((min(x - 1, y), max(x - 1, y)))
            last[begins] = owner
        if number[2]:
            digits, owner = "", []
    return links


def token_graph(text: str, spans: dict[str, list[tuple[int, int]]]):
    """Tokens (start, end, mask, label or 0), chain links and skip links of one text."""
    found = []
    for m in CANDIDATE.finditer(text):
        core = m[0].strip(TRIM)
        if core:
            start = m.start() + m[0].index(core)
            found.append((start, start + len(core), core, m.start(), m.end()))
    chain = [(i, i + 1) for i in range(len(found) - 1)
             if found[i + 1][3] - found[i][4] <= 2 and text[found[i][4]:found[i + 1][3]].isspace()]
    linked = {i for i, _ in chain}
    flat = sorted((a, b, k + 1) for k, kind in enumerate(KINDS) for a, b in spans[kind])
    tokens, at = [], 0
    for i, (a, b, core, _, _) in enumerate(found):
        while at < len(flat) and flat[at][1] <= a:
            at += 1
        label = next((k for s, e, k in flat[at:at + 4] if s < b and e > a), 0)
        tokens.append((a, b, features(core, found[i - 1][2] if i - 1 in linked else None,
                                      found[i + 1][2] if i in linked else None), label))
    skip, seen = set(), {}
    for i, (_, _, core, _, _) in enumerate(found):
        digits = "".join(c for c in core if c.isdigit())
        for key in ((0, core.lower()) if len(core) >= 6 else None, (1, digits) if len(digits) >= 6 else None):
            if key:
                if key in seen and seen[key] != i:
                    skip.add((seen[key], i))
                seen[key] = i
    return tokens, chain, sorted(skip | group_links(found, linked))


def count_batch(batch: pa.RecordBatch) -> dict:
    """Counts for the fit: (0, mask, label) of nodes, (1 or 2, label, label) of links."""
    counts: Counter = Counter()
    for text in batch.column("text").to_pylist():
        if text and ("@" in text or HAS_DIGIT.search(text)):
            tokens, chain, skip = token_graph(text, base_spans(text))
            label = [t[3] for t in tokens]
            # what repeats an observed token without matching itself has no known label: its shape
            # counts half for none, half for the label it repeats; all counts are doubled
            open_ones = {t: max(label[i], label[j]) for i, j in skip if (label[i] == 0) != (label[j] == 0)
                         for t in (i, j) if not label[t]}
            for n, t in enumerate(tokens):
                counts[0, t[2], t[3]] += 1
                counts[0, t[2], open_ones.get(n, t[3])] += 1
            for kind, links in ((1, chain), (2, skip)):
                for i, j in links:
                    if i not in open_ones and j not in open_ones:
                        counts[kind, *((label[i], label[j]) if kind == 1 else sorted((label[i], label[j])))] += 2
    kind, left, right = zip(*counts, strict=True) if counts else ((), (), ())
    return {"kind": kind, "a": left, "b": right, "n": list(counts.values())}


def association(pairs: dict[tuple[int, int], float], agree: float = 0.5) -> np.ndarray:
    """Smoothed log ratio of a pair's count to what its labels alone would give, within +-4.

    ``agree`` is the prior count of equal labels.
    """
    n = np.full((LABELS, LABELS), 0.5)
    np.fill_diagonal(n, agree)
    for (a, b), c in pairs.items():
        n[a, b] += c
    expected = n.sum(1, keepdims=True) * n.sum(0, keepdims=True) / n.sum()
    return np.clip(np.log(n / expected), -4, 4)


def fit_crf(documents: DataFrame) -> dict[str, np.ndarray]:
    """Node weights (features + bias, labels), chain and skip potentials, from all documents.

    What comes to the driver are counts of feature masks, at most 2^16 times 5 rows.
    """
    rows = (map_batches(documents.select("text"), count_batch, "kind int, a int, b int, n long")
            .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect())
    nodes = sorted((r["a"], r["b"], r["n"]) for r in rows if r["kind"] == 0)
    x = np.array([[m >> i & 1 for i in range(N_FEATURES)] + [1] for m, _, _ in nodes], float).reshape(-1, N_FEATURES + 1)
    y, n = np.array([b for _, b, _ in nodes], int), np.array([c for _, _, c in nodes], float)
    w = np.zeros((N_FEATURES + 1, LABELS))
    if len(nodes):
        n = n / n.sum()
        target = np.eye(LABELS)[y]
        for _ in range(500):
            p = np.exp(x @ w - (x @ w).max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            w += 1.0 * (x.T @ (n[:, None] * (target - p)) - 1e-5 * w)
    pairs = {k: {(r["a"], r["b"]): r["n"] / 2 for r in rows if r["kind"] == k} for k in (1, 2)}
    both = Counter()
    for (a, b), c in pairs[2].items():
        both[a, b] += c / 2
        both[b, a] += c / 2
    return {"node": w, "chain": association(pairs[1]), "skip": association(both, AGREE)}


def marginals(unary: np.ndarray, links: np.ndarray, potentials: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities by damped loopy sum-product; link e has ``potentials[e]`` (labels x labels)."""
    if not len(links):
        belief = unary
    else:
        i, j = links[:, 0], links[:, 1]
        forth = np.zeros((len(links), LABELS))   # log messages i -> j
        back = np.zeros((len(links), LABELS))
        weight = np.exp(potentials)
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, j, forth)
            np.add.at(belief, i, back)

            def send(sender: np.ndarray, got: np.ndarray, table: np.ndarray) -> np.ndarray:
                z = belief[sender] - got
                z = np.exp(z - z.max(1, keepdims=True))
                m = np.log(np.einsum("el,elk->ek", z, table) + 1e-30)
                return m - m.max(1, keepdims=True)

            new_forth = send(i, back, weight)
            new_back = send(j, forth, weight.transpose(0, 2, 1))
            forth, back = 0.5 * forth + 0.5 * new_forth, 0.5 * back + 0.5 * new_back
        belief = unary.copy()
        np.add.at(belief, j, forth)
        np.add.at(belief, i, back)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def label_batch(texts: list[str], model: dict[str, np.ndarray], least: float) -> list[tuple[dict, dict]]:
    """(base spans, added spans) of every text; documents share a graph up to GRAPH_TOKENS."""
    base = [base_spans(t) if t else {k: [] for k in KINDS} for t in texts]
    added = [{k: [] for k in KINDS} for _ in texts]
    tokens, links, kinds, owner = [], [], [], []

    def label() -> None:
        x = np.array([[t[2] >> i & 1 for i in range(N_FEATURES)] + [1] for t in tokens], float)
        unary = x @ model["node"]
        unary -= unary.max(1, keepdims=True)
        label = np.array([t[3] for t in tokens])
        seen = label > 0
        unary[seen] = -OBSERVED
        unary[seen, label[seen]] = 0
        tables = np.stack([model["chain"], model["skip"]])
        p = marginals(unary, np.array(links, int).reshape(-1, 2), tables[np.array(kinds, int)])
        best = p.argmax(1)
        for t in np.flatnonzero(~seen & (best > 0) & (p.max(1) >= least)):
            added[owner[t]][KINDS[best[t] - 1]].append(tokens[t][:2])

    for d, text in enumerate(texts):
        if not text or not ("@" in text or HAS_DIGIT.search(text)):
            continue  # no candidate token
        own, chain, skip = token_graph(text, base[d])
        offset = len(tokens)
        tokens += own
        owner += [d] * len(own)
        links += [(offset + i, offset + j) for i, j in chain + skip]
        kinds += [0] * len(chain) + [1] * len(skip)
        if len(tokens) >= GRAPH_TOKENS:
            label()
            tokens, links, kinds, owner = [], [], [], []
    if tokens:
        label()
    return list(zip(base, added, strict=True))


def listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def find_pii(documents: DataFrame, model: dict[str, np.ndarray], least: float = LEAST_PROBABILITY) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans) of every row.

    Spans are kind:start:end in code points, by kind, then start. Counts are of pattern matches;
    ``spans`` adds those of the field, which never overlap a pattern match. Null texts are
    empty; repeated rows are scanned each; an empty table gives no rows; other columns are
    ignored. Whole texts, no shuffle.
    """
    def scan(batch: pa.RecordBatch) -> dict:
        found = label_batch(batch.column("text").to_pylist(), model, least)
        out = {f"n_{k}": [len(b[k]) for b, _ in found] for k in KINDS}
        out["doc_id"] = batch.column("doc_id").cast(pa.int64())
        out["base_spans"] = [listed(b) for b, _ in found]
        out["spans"] = [listed({k: b[k] + a[k] for k in KINDS}) for b, a in found]
        return out

    return map_batches(documents.select("doc_id", "text"), scan,
                       "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                       "base_spans string, spans string")


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    parts, last, end = [], 0, 0
    for a, b, kind in sorted(spans):
        if a >= end:
            parts += [text[last:a], f"[{kind.upper()}]"]
        last = end = max(end, b)
    return "".join(parts) + text[last:]


def mask_pii(documents: DataFrame, model: dict[str, np.ndarray], least: float = LEAST_PROBABILITY) -> DataFrame:
    """``documents`` with personal data masked in ``text`` and ``n_chars`` counted again."""
    names = documents.columns

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = label_batch(texts, model, least)
            clean = [None if t is None else mask(t, [(a, b, k) for s in pair for k in KINDS for a, b in s[k]])
                     for t, pair in zip(texts, found, strict=True)]
            columns = {n: batch.column(n) for n in names}
            columns["text"] = pa.array(clean, batch.schema.field("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in clean]).cast(
                    batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], schema=batch.schema)

    return documents.mapInArrow(run, documents.schema)
