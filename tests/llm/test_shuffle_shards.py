"""Feistel shards: exact permutation, both directions, even counts, gapless slots."""

import collections
import zlib

import numpy as np
import pytest

from conftest import SF_DIR
from llm_cases import no_docs, odd_docs, texts  # noqa: F401
from profilelake.llm import queries
from profilelake.llm import shuffle_shards as ss


@pytest.mark.parametrize("count", [1, 2, 3, 5, 16, 17, 1000, 4099, 65_536])
def test_permutation_and_inverse(count):
    numbers = np.arange(count)
    places = ss.positions(numbers, count)
    assert sorted(places) == list(numbers)
    assert (ss.row_numbers(places, count) == numbers).all()
    if count > 100:
        assert (places != ss.positions(numbers, count, ss.KEY + 1)).mean() > 0.9
        assert abs(np.corrcoef(numbers, places)[0, 1]) < 0.1


def test_large_numbers_are_walked():
    count = 10**12 + 39
    numbers = np.array([0, 1, 10**6, count - 1])
    places = ss.positions(numbers, count)
    assert ((places >= 0) & (places < count)).all() and len(set(places)) == 4
    assert (ss.row_numbers(places, count) == numbers).all()


def test_query(spark, texts):
    rows = queries.op11_shards(spark, SF_DIR).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts.items()
    }
    check_places(rows, 40)
    again = queries.op11_shards(spark, SF_DIR)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, rows), key=str)
    # Places follow from row numbers alone.
    count = len(rows)
    places = ss.positions(np.array([r.row_number for r in rows]), count)
    assert [(p % 40, p // 40) for p in places] == [(r.shard, r.slot) for r in rows]


def check_places(rows, shards):
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_places_do_not_depend_on_the_layout(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('text ', id % 7) AS text")
    a = {r.doc_id: (r.shard, r.slot) for r in ss.assign(docs.repartition(1)).collect()}
    b = {r.doc_id: (r.shard, r.slot) for r in ss.assign(docs.orderBy(-docs.doc_id).repartition(13)).collect()}
    assert a == b


def test_hot_key(spark, monkeypatch):
    monkeypatch.setattr(ss, "BLOCK", 100)
    docs = spark.range(3000).selectExpr("if(id < 1234, -1, id) AS doc_id", "if(id < 1234, 'same', 'x') AS text")
    rows = ss.assign(docs).collect()
    assert len(rows) == 3000 and len({r.row_number for r in rows}) == 3000
    check_places(rows, 40)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = ss.assign(odd_docs, shards=4).collect()
    assert len(rows) == odd_docs.count()
    check_places(rows, 4)
    assert sorted(r.size for r in rows if r.doc_id is None) == [16, 35]
    assert ss.assign(no_docs).count() == 0 and ss.shuffled(no_docs).count() == 0
    whole = ss.shuffled(odd_docs, shards=4)
    got = whole.selectExpr("row.*").collect()
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got)) == sorted(map(key, odd_docs.collect()))
    by_place = whole.selectExpr("shard", "slot", "row.doc_id AS doc_id").collect()
    assert sorted((r.shard, r.slot) for r in by_place) == sorted((r.shard, r.slot) for r in rows)
