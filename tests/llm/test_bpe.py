import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skytally.llm import bpe
from skytally.llm.queries import op12_bpe
from tests.llm.conftest import SF_DIR

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PLAIN.encode_special_tokens = True


def own(texts, special=True):
    return [x.tolist() for x in bpe.encoder(bpe.public(bpe.VOCABULARY), special).encode(texts)]


def library(texts, special=True):
    return [e.ids for e in (TOKENIZER if special else PLAIN).encode_batch(texts, add_special_tokens=False)]


def test_query_agrees_with_the_library(spark, texts):
    rows = {r.doc_id: r for r in op12_bpe(spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
        decoded = TOKENIZER.decode(ids, skip_special_tokens=False)
        assert tuple(rows[i])[1:] == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "\n a", "a\n b", "a \n b", "\t\tx\r\n", "don't we'll I'M 's 'd", "x\0 y\0", "\0",
    "aaaa aaaaaaa" * 9, "1234567890 12,345.67", "...!!?? --- ###", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|",
    "a b  c　d", "漢字テスト 日本語 ロx", "🙂🙃 x🙂 👩‍👩‍👧", "Ünï çödé “quoted” — dash…", "՘֋౜ ₏1꟎ x\U000107bb",
    "Ⅰ²٣ ٣٤٥", "éà", "=" * 3000, "abcdefghij" * 800, "Zm9vYmFyYmF6" * 700,
])
def test_texts_of_all_kinds(text):
    for special in (True, False):
        assert own([text, text + " x"], special) == library([text, text + " x"], special)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_any_characters(texts):
    assert own(texts) == library(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 'sre\n\t.,1<|>endoftext\0é—"), max_size=60), max_size=4))
def test_any_spacing(texts):
    assert own(texts) == library(texts)


def test_kinds_of_later_characters():
    """One character of each of many blocks, beside letters, digits, marks and spaces."""
    chars = [chr(c) for c in range(0x250, 0x30000, 37) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1{c}.{c} {c}{c} \n{c} " for c in chars]
    assert own(texts) == library(texts)


def test_units_forgotten(monkeypatch):
    monkeypatch.setattr(bpe, "UNITS_KEPT", 3)
    encoder = bpe.Encoder(bpe.vocabulary(bpe.public(bpe.VOCABULARY)), True)
    for text in ("one two three four five", "six two one", "", "one <|endoftext|> two"):
        assert [x.tolist() for x in encoder.encode([text, text])] == library([text, text])
    assert encoder.encode([]) == []


def test_merge_rounds_agree_with_merging_one_pair_at_a_time():
    v = bpe.vocabulary(bpe.public(bpe.VOCABULARY))
    rank = dict(zip(v.keys.tolist(), v.rank.tolist(), strict=True))
    rng = np.random.default_rng(4)
    words = [bytes(rng.choice(list(b"aenrst h"), rng.integers(1, 30)).astype(np.uint8)) for _ in range(200)]
    ids, count = v.merge(words)
    for w, got in zip(words, np.split(ids, np.cumsum(count)[:-1]), strict=True):
        symbols = [int(v.of_byte[b]) for b in w]
        while True:
            ranks = [rank.get(a * v.base + b, bpe.NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
            if not ranks or min(ranks) == bpe.NONE:
                break
            at = ranks.index(min(ranks))
            symbols[at:at + 2] = [int(v.product[ranks[at]])]
        assert got.tolist() == symbols


def test_edges(spark, documents):
    long = "wörd and 12 more— " * 60_000
    df = documents((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, long)).repartition(3)
    rows = sorted((tuple(r) for r in bpe.encode_documents(df).collect()), key=str)
    assert [r[:2] for r in rows if r[0] in (1, 2)] == [(1, 0), (2, 0)]
    assert sum(r[0] == 3 and r[1] == 2 for r in rows) == 2 and sum(r[0] is None for r in rows) == 1
    assert next(r[2] for r in rows if r[0] == 4) == np.array(library([long])[0], "<u4").tobytes()
    assert bpe.round_trip(df.limit(0)).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r)[1:] for r in bpe.round_trip(df).where("doc_id in (1, 2)").collect()} == {(0, empty, empty)}
    plain = bpe.encode_documents(documents((1, "a<|endoftext|>")), special=False).first()
    assert np.frombuffer(plain.ids, "<u4").tolist() == library(["a<|endoftext|>"], False)[0]


def test_ids_that_are_no_text(spark):
    ids = [b"", None, np.array([50256, 447], "<u4").tobytes()]
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(ids)], bpe.TOKENS)
    assert [r.text for r in bpe.decode_documents(df).orderBy("doc_id").collect()] == [
        "", "", TOKENIZER.decode([50256, 447], skip_special_tokens=False)]
