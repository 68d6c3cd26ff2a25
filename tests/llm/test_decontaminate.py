import pytest

from skytally.llm import decontaminate as dc
from skytally.llm.oracles import ORACLES
from skytally.llm.queries import op8_decontamination
from tests.llm.conftest import agrees_with_sql


def test_agrees_with_sql(spark, tables):
    agrees_with_sql(op8_decontamination, ORACLES["op8_decontamination"], spark, tables)


def test_blocks_and_segments_do_not_change_the_result(spark, tables, monkeypatch):
    monkeypatch.setattr(dc, "SEGMENT_BYTES", 10_000)
    monkeypatch.setattr(dc, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(dc, "PIECE_WORDS", 16)
    agrees_with_sql(op8_decontamination, ORACLES["op8_decontamination"], spark, tables)


def places(spark, documents, rows, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_matches(dc.build_index(documents(*rows)), bench, **options).collect()
    return sorted((r.doc_id, r.n_words, [tuple(m) for m in r.matches]) for r in found)


def test_phrases_and_proximity(spark, documents):
    got = places(spark, documents, [
        (1, "x A b, c d y"), (2, "a z b c w d"), (3, "a z b z z c d"), (4, "d c b a"), (5, "a b"), (6, "c d")],
        [(7, "a b c d")], window=4, slop=2)
    assert got == [(1, 6, [(7, 1, 5, False)]), (2, 6, [(7, 0, 6, True)]), (3, 7, []), (4, 4, []),
                   (5, 2, []), (6, 2, [])]   # 5 and 6 lie side by side in one segment


def test_overlaps_are_one_match(spark, documents):
    assert places(spark, documents, [(1, "a a a a a b")], [(1, "a a a"), (2, None), (None, "a")], window=2, slop=0) == [
        (1, 6, [(1, 0, 5, False)])]


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (2, "")]])
def test_edges(spark, documents, rows):
    df = documents(*rows) if rows else documents((1, "a")).limit(0)
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    got = dc.contamination(dc.find_matches(dc.build_index(df), bench)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got) == [(i, 0, 0, False) for i, _ in rows]
    none = dc.contamination(dc.find_matches(dc.build_index(df), bench.limit(0))).collect()
    assert len(none) == len(rows)
