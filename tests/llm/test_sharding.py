from collections import Counter

from bidloom.llm import sharding


def table(docs, weights=(1.0,) * 5, added=1.0):
    return sharding.record_table(docs, list(weights), added).collect()


def test_slots_are_gapless_and_growth_moves_only_into_the_new_shard(docs_of):
    rows = table(docs_of([(i, f"text {i}") for i in range(2000)]))
    for shard in range(5):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {5} and 250 < len(moved) < 420


def test_weights(docs_of):
    count = Counter(r.shard for r in table(docs_of([(i, "") for i in range(4000)]), (3.0, 1.0)))
    assert 2.7 < count[0] / count[1] < 3.4


def test_a_hot_row_unfolds(docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "UNFOLD", 7)
    rows = table(docs_of([(1, "same")] * 50 + [(i, "x") for i in range(2, 10)]))
    hot = [r for r in rows if r.doc_id == 1]
    assert len(rows) == 58 and len(hot) == 50 and len({r.slot for r in hot}) == 50 and len({r.shard for r in hot}) == 1


def test_odd_rows(odd_docs, docs_of):
    rows = table(odd_docs)
    assert len(rows) == 11
    sizes = {(r.doc_id, r.size) for r in rows}
    assert (3, 16) in sizes and (4, 16) in sizes and (6, 300_016) in sizes
    assert {r.text_crc32 for r in rows if r.size == 16} == {0}
    assert table(docs_of([])) == []


def test_shard_column_is_replaced(odd_docs):
    out = sharding.shards(odd_docs, "doc_id", [1.0, 2.0])
    assert out.columns == odd_docs.columns and {r.shard for r in out.collect()} <= {0, 1}
