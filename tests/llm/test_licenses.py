import random
import re
import sys

from skytally.llm.licenses import ALL_TEMPLATES, BASE_PHRASES, LICENSE_TEXTS, compile_templates, scan_licenses
from skytally.llm.queries import op4_license_scan
from tests.llm.conftest import SF_DIR

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for p, label in BASE_PHRASES.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    first = [i for i, _ in places]
    return (len(words), len(places), min(first, default=None), max(first, default=None),
            ",".join(sorted({x for _, x in places})))


def test_base_agrees_with_plain_search(spark, texts):
    rows = op4_license_scan(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_regions():
    a = compile_templates([("x", "under [[the [[open]]]] <mit/bsd> license {{1..2}} end")])

    def ends(text):
        return [(b, c) for _, b, c in a.scan([w.encode() for w in text.split()])]
    assert ends("under the open mit license z end") == [(0, 7)]
    assert ends("so under bsd license z z end") == [(1, 7)]
    assert ends("under open mit license z end") == []      # inner region without the outer
    assert ends("under mit license end") == []             # too few replaceable words
    assert ends("under mit license z z z end") == []       # too many
    assert ends("under gpl license z end") == []           # mandatory wording differs


def parts(template):
    """A template as nested lists: words, ("any", low, high), ("of", words) and ("maybe", parts)."""
    stack = [[]]
    for token in re.findall(r"\[\[|\]\]|\{\{\d+\.\.\d+\}\}|<[^>]+>|[^\s\[\]{}<>]+", template):
        if token == "[[":
            stack.append([])
        elif token == "]]":
            inner = stack.pop()
            stack[-1].append(("maybe", inner))
        elif token[0] == "{":
            stack[-1].append(("any", *map(int, re.findall(r"\d+", token))))
        elif token[0] == "<":
            stack[-1].append(("of", token[1:-1].lower().split("/")))
        else:
            stack[-1] += WORD.findall(token.lower())
    return stack[0]


def ends_of(parts_left, words, at):
    """All places where the parts can end when they begin at a word, by trying everything."""
    if not parts_left:
        return {at}
    head, rest = parts_left[0], parts_left[1:]
    if isinstance(head, str):
        return ends_of(rest, words, at + 1) if at < len(words) and words[at] == head else set()
    if head[0] == "of":
        return ends_of(rest, words, at + 1) if at < len(words) and words[at] in head[1] else set()
    if head[0] == "any":
        return set().union(*(ends_of(rest, words, at + n) for n in range(head[1], head[2] + 1) if at + n <= len(words)))
    return ends_of(rest, words, at) | ends_of(list(head[1]) + rest, words, at)


def brute_force(words):
    sys.setrecursionlimit(10_000)
    found = {}
    for label, template in ALL_TEMPLATES:
        for i in range(len(words)):
            for end in ends_of(parts(template), words, i):
                found[label, i] = max(end, found.get((label, i), 0))
    return sorted((label, i, end) for (label, i), end in found.items())


def spelt(template, rng, fill):
    """A random text that the template accepts."""
    out = []
    for p in parts(template) if isinstance(template, str) else template:
        if isinstance(p, str):
            out.append(p)
        elif p[0] == "of":
            out.append(rng.choice(p[1]))
        elif p[0] == "any":
            out += [rng.choice(fill) for _ in range(rng.randint(p[1], p[2]))]
        elif rng.random() < 0.5:
            out += spelt(p[1], rng, fill)
    return out


def test_all_templates_agree_with_trying_everything():
    """Texts that the templates accept, with and without a wrong mandatory word, between other words."""
    automaton, rng = compile_templates(), random.Random(2)
    fill = ["acme", "corp", "the", "license", "software", "3", "mit"]
    for label, template in ALL_TEMPLATES:
        for _ in range(3):
            words = spelt(template, rng, fill)
            for wrong in (False, True):
                text = [rng.choice(fill) for _ in range(3)] + list(words) + [rng.choice(fill) for _ in range(3)]
                if wrong:
                    text[rng.randrange(3, len(text) - 3)] = "wrong"
                want = brute_force(text)
                assert sorted(automaton.scan([w.encode() for w in text])) == want
                assert wrong or (label, 3) in {m[:2] for m in want}


def test_whole_license_texts_are_told_apart(spark, documents):
    rng = random.Random(5)
    texts = {label: " ".join(spelt(t, rng, ["acme", "inc"])).title() for label, t in LICENSE_TEXTS}
    rows = scan_licenses(documents(*((i, f"Copyright 2020 Acme. {t} End.") for i, t in enumerate(texts.values())))).collect()
    whole = {}
    for r, label in zip(sorted(rows), texts, strict=True):
        assert label in r.labels.split(",") and r.score == 1.0
        whole[label] = {m.label for m in r.matches if m.end - m.first > 60}
    assert whole["bsd-2-clause"] == {"bsd-2-clause"} and whole["bsd-3-clause"] == {"bsd-3-clause"}
    assert whole["mit"] == {"mit"} and whole["isc"] == {"isc"} and whole["zlib"] == {"zlib"}


def test_edges(spark, documents):
    df = documents((1, None), (2, ""), (3, "Released under the MIT License."), (3, "Released under the MIT License."),
                   (4, "mité license MIT license mit LICENSE"), (5, "x " * 200_000 + "apache license"))
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.labels, r.score)
           for r in scan_licenses(df).collect()}
    assert got == {(1, 0, 0, None, "", 0.0), (2, 0, 0, None, "", 0.0), (3, 5, 1, 3, "mit", 1.0),
                   (4, 6, 2, 2, "mit", 0.5), (5, 200_002, 1, 200_000, "apache", 0.5)}
    assert scan_licenses(df).count() == 6
    assert scan_licenses(df.limit(0)).count() == 0
