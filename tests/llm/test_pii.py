import hashlib
import re

import numpy as np

from skytally.llm import pii
from skytally.llm.queries import op5_pii
from tests.llm.conftest import SF_DIR

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def plain(text):
    text = text or ""
    out = {"email": [m.span() for m in EMAIL.finditer(text)],
           "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
           "card": [m.span() for m in CARD.finditer(text)
                    if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))],
           "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]}
    return out


def test_base_agrees_with_plain_patterns(spark, texts):
    rows = op5_pii(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in pii.KINDS)
        base = pii.listed(want)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_hard_strings_agree_with_plain_patterns():
    rng = np.random.default_rng(5)
    for alphabet in ("0123.", "a1@.-", "+1 ()-9", "0 -4", "ab@.%+ 1é١"):
        for _ in range(400):
            text = "".join(rng.choice(list(alphabet), rng.integers(0, 60)))
            assert pii.base_spans(text) == plain(text), text
    assert pii.base_spans("4" * 100_000 + "@" + "a" * 100_000)["email"] == []


def test_skip_links_carry_labels(spark, documents):
    filler = " words of no account" * 50
    rows = [(i, f"call +1 (743) 555-{3000 + i} now.{filler} again 555-{3000 + i} and room 12") for i in range(40)]
    df = documents(*rows)
    got = {r.doc_id: r for r in pii.find_pii(df, pii.fit_crf(df)).collect()}
    for i, text in rows:
        at = text.rindex("555-")
        assert f"phone:{at}:{at + 8}" in got[i].spans      # repeats part of an observed number
        assert f":{text.rindex('12')}:" not in got[i].spans
    alone = documents((1, "nothing but 555-3001 here"))
    assert pii.find_pii(alone, pii.fit_crf(df)).first().spans == ""


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    unary, table = rng.normal(size=(3, pii.LABELS)), rng.normal(size=(2, pii.LABELS, pii.LABELS))
    p = pii.marginals(unary, np.array([[0, 1], [1, 2]]), table, rounds=60)   # a tree: exact
    z = (unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None]
         + table[0][:, :, None] + table[1][None])
    z = np.exp(z - z.max())
    for node, axes in ((0, (1, 2)), (1, (0, 2)), (2, (0, 1))):
        want = z.sum(axes) / z.sum()
        assert np.allclose(p[node], want, atol=1e-6)


def test_edges(spark, documents):
    df = documents((1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"))
    model = pii.fit_crf(df)
    assert sorted((r.doc_id, r.n_email, r.spans) for r in pii.find_pii(df, model).collect()) == [
        (1, 0, ""), (2, 0, ""), (3, 1, "email:0:6"), (3, 1, "email:0:6")]
    clean = {(r.doc_id, r.text) for r in pii.mask_pii(df, model).collect()}
    assert clean == {(1, None), (2, ""), (3, "[EMAIL]")}
    assert pii.find_pii(df.limit(0), pii.fit_crf(df.limit(0))).count() == 0


def test_unmatched_documents_are_labelled_alike(spark, documents, monkeypatch):
    known = [(i, f"call +1 ({200 + i}) 555-{3000 + i} or a{i}@b.co in room {i % 90} of {1900 + i}") for i in range(60)]
    model = pii.fit_crf(documents(*known))
    text = "call (743) 555-3001 in room 12"
    far = text + " word" * 50 + " x@y.co"
    one = {r.doc_id: r.spans for r in pii.find_pii(documents((1, text), (2, far)), model).collect()}
    assert [s for s in one[2].split(",") if s.startswith("phone")] == ["phone:5:10", "phone:11:19"]
    assert one[1] == "phone:5:10,phone:11:19"          # the unrelated address decides nothing
    assert pii.mask_pii(documents((1, text)), model).first().text == "call [PHONE] [PHONE] in room 12"
    texts = [text, "", far, None, "no number"] * 3
    whole = pii.label_batch(texts, model, pii.LEAST_PROBABILITY)
    monkeypatch.setattr(pii, "GRAPH_TOKENS", 1)
    assert pii.label_batch(texts, model, pii.LEAST_PROBABILITY) == whole


def test_groups_of_a_number_are_linked_in_any_spelling(spark, documents):
    filler = " words of no account" * 30
    model = pii.fit_crf(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    pairs = [("+1 743 555 3001", "743 555 3001"), ("+1 (743) 555-3001", "743 555 3001"), ("+1 (743) 555-3001", "743-555-3001"),
             ("+1 (743) 555-3001", "7435553001"), ("+17435553001", "743 555 3001"), ("+1 743 555 3001", "001 743 5553001")]
    rows = [(i, f"call {a} now.{filler} again {b} in room 12") for i, (a, b) in enumerate(pairs)]
    got = {r.doc_id: r.spans for r in pii.find_pii(documents(*rows), model).collect()}
    for i, (_, b) in enumerate(pairs):
        at = rows[i][1].rindex(b)
        want = {f"phone:{at + m.start()}:{at + m.end()}" for m in re.finditer(r"\S+", b)}
        assert want <= set(got[i].split(",")), pairs[i]
        assert f":{rows[i][1].rindex('12')}:" not in got[i]

    def links(text):
        found = pii.token_graph(text, pii.base_spans(text))
        return [(text[found[0][i][0]:found[0][i][1]], text[found[0][j][0]:found[0][j][1]]) for i, j in found[2]]

    assert links(f"743 555 3001{filler} 743 555 3001") == [("743", "743"), ("555", "555"), ("3001", "3001")]
    assert links(f"743 555 3001{filler} 212 555 3001") == [("555", "555"), ("3001", "3001")]   # not the area codes
    assert links(f"1743555300{filler} 2843555300") == []       # neither shared stretch begins with a token
    assert links(f"743 555{filler} 743 555") == []             # too few digits
    assert links(f"tel:743 555 3001{filler} 7435553001x") == [("tel:743", "7435553001x"), ("555", "7435553001x"), ("3001", "7435553001x")]
