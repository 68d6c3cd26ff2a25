import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from skytally.llm import packing
from skytally.llm.queries import op3_packing
from tests.llm.conftest import SF_DIR


def reference_ids(text):
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text or "", add_special_tokens=False).ids + [0]


def check_layout(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_query_agrees_with_the_tokenizer(spark, texts):
    rows = op3_packing(spark, SF_DIR).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
    assert set(own) == set(texts)
    total = 0
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        found = sorted(own[i], key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(len(found)))
        assert sum(r.length for r in found) == len(ids)
        assert all(r.length == 2048 for r in found[1:]) and (len(ids) > 2048 or len(found) == 1)
        at = 0
        for r in found:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        total += len(ids)
    assert check_layout(rows, 2048) <= -(-total // 2048) * 1.01 + 1


def test_fast_and_reference_encoder_agree():
    rng = np.random.default_rng(0)
    letters = [chr(c) for c in range(0x250) if not 0xD800 <= c < 0xE000]
    for c in letters:
        for text in (c, f"a{c}b", f" {c}", f"{c} {c}", f"1{c}\n{c}", f"{c}{c}  x"):
            assert packing.encode(text).tolist() == reference_ids_cached(text)
    for _ in range(300):
        text = "".join(rng.choice(letters, 40))
        assert packing.encode(text).tolist() == reference_ids_cached(text)
    for text in ("a<|endoftext|>b", "漢字 テスト", "🙂🙂", ""):
        assert packing.encode(text).tolist() == reference_ids_cached(text)


TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids_cached(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids + [0]


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(3)
    for size in (8, 64, 2048):
        for _ in range(20):
            lengths = rng.integers(1, size + 1, rng.integers(0, 400)).tolist()
            counts = Counter(lengths)
            plan = packing.plan_sequences(dict(counts), size)
            used = Counter()
            for combination, n in plan:
                assert sum(combination) <= size and n > 0
                for x in combination:
                    used[x] += n
            assert used == counts
            sequences = sum(n for _, n in plan)
            least = max(-(-sum(lengths) // size), sum(x > size / 2 for x in lengths))
            assert sequences <= least * 1.25 + 1


def test_exact_fills():
    assert packing.plan_sequences({5: 3, 3: 3}, 8) == [((5, 3), 3)]
    assert packing.plan_sequences({4: 1, 3: 1, 1: 1}, 8) == [((4, 3, 1), 1)]
    assert packing.plan_sequences({4: 1, 2: 1, 1: 2}, 8) == [((4, 2, 1, 1), 1)]


def test_edges(spark, documents):
    df = documents((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "é " * 30_000)).repartition(3)
    rows = packing.pack(df).collect()
    assert Counter(r.doc_id for r in rows)[3] == 2 and Counter(r.doc_id for r in rows)[None] == 1
    assert {(r.length, r.ids_crc32) for r in rows if r.doc_id in (1, 2)} == {(1, zlib.crc32(bytes(4)))}
    assert sum(r.length for r in rows if r.doc_id == 4) == len(reference_ids("é " * 30_000))
    check_layout(rows, 2048)
    assert packing.pack(df.limit(0)).count() == 0
