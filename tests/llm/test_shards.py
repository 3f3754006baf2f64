"""Shards against a plain layout, decoding, and reading on from any slot."""

import collections
import zlib

import numpy as np
import pytest
import zstandard

from conftest import SF_DIR
from llm_cases import no_docs, odd_docs, texts  # noqa: F401
from profilelake.llm import queries, shards
from profilelake.llm.secrets import vocabulary

RANKS = queries.TOKEN_IDS


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_permutation(count):
    slots = shards.permuted(np.arange(count), count)
    assert sorted(slots.tolist()) == list(range(count))
    other = shards.permuted(np.arange(count), count, key=9)
    assert count < 17 or (other != slots).any()


def encoded(text):
    return [*vocabulary(queries.RANKS, queries.RANKS_PATTERN).encode_ordinary(text or ""), 50256]


def layout(rows, size=shards.SEQUENCE):
    """slot -> (document, where in it, ids, crc) of documents in one stream."""
    stream, where = [], []
    for i, text in rows:
        ids = encoded(text)
        where += [(-1 if i is None else i, k) for k in range(len(ids))]
        stream += ids
    cut = [(where[k], stream[k : k + size]) for k in range(0, len(stream), size)]
    slots = shards.permuted(np.arange(len(cut)), len(cut))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u2").tobytes())
    return {int(s): (*w, len(ids), crc(ids)) for s, (w, ids) in zip(slots, cut)}


def got(rows):
    return {r.slot: (r.doc_id, r.start, r.n, r.ids_crc) for r in rows}


def test_query(spark, texts):
    rows = queries.op4_token_shards(spark, SF_DIR).collect()
    stored = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert stored.rdd.getNumPartitions() == 1
    assert got(rows) == layout((r.doc_id, r.text) for r in stored.collect())


def test_sequences_are_stored_in_less_than_each_alone(spark, texts, tmp_path):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1)
    cut = shards.cut_sequences(docs, RANKS, 100, str(tmp_path / "cut"))
    stored = sum(f.stat().st_size for f in (tmp_path / "cut").glob("*.parquet"))
    alone = [len(zstandard.compress(np.array(ids, "<u2").tobytes())) for *_, ids in layout_ids(texts, 100)]
    assert cut.count() == len(alone) and stored < sum(alone)


def layout_ids(texts, size):
    """The ids of every sequence of one stream."""
    stream = [x for text in texts.values() for x in encoded(text)]
    return [(k, stream[k : k + size]) for k in range(0, len(stream), size)]


def test_decoding_gives_the_texts(spark, texts, tmp_path):
    """All ids of a document, gathered from the records it lies in, decode to its text."""
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(7)
    cut = shards.cut_sequences(docs, RANKS, 100)
    done = shards.write_shards(cut, str(tmp_path), RANKS, 100, 64)
    rows = shards.read_shards(spark, done, str(tmp_path), RANKS, 0, 100, 64, with_ids=True).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    records = {r.slot: r for r in rows}
    pieces = collections.defaultdict(list)
    for r in shards.packed_documents(cut).collect():
        pieces[r.doc_id].append((r.start, records[r.slot].ids[r.at : r.at + r.n]))
        assert r.at or (records[r.slot].doc_id, records[r.slot].start) == (r.doc_id, r.start)
    encoding = vocabulary(queries.RANKS, queries.RANKS_PATTERN)
    assert set(pieces) == set(texts)
    for i, found in pieces.items():
        ids = [x for _, part in sorted(found) for x in part]
        assert ids[-1] == 50256 and encoding.decode(ids[:-1]) == texts[i]


@pytest.mark.parametrize("ids", [RANKS, shards.byte_ids(), RANKS._replace(kind="<u4")], ids=["16", "bytes", "32"])
def test_layout_resume_and_odd_rows(spark, odd_docs, no_docs, tmp_path, ids):
    folder, size, per = str(tmp_path / "s"), 64, 50
    docs = odd_docs.coalesce(1)
    cut = shards.cut_sequences(docs, ids, size, str(tmp_path / "cut"))
    done = shards.write_shards(cut, folder, ids, size, per)
    rows = sorted(shards.read_shards(spark, done, folder, ids, 0, size, per).collect())
    if ids is RANKS:
        assert got(rows) == layout(((r.doc_id, r.text) for r in docs.collect()), size)
    later = sorted(shards.read_shards(spark, done, folder, ids, 73, size, per).collect())
    assert later == rows[73:]
    stride = shards.HEAD_BYTES + size * ids.size
    files = sorted((tmp_path / "s").glob("shard-*.bin"))
    assert sum(f.stat().st_size for f in files) == stride * len(rows)
    before = {f: f.stat().st_mtime_ns for f in files}
    files[1].write_bytes(b"half")  # an unfinished shard is written again, the others stay
    again = spark.read.schema(shards.CUT).parquet(str(tmp_path / "cut"))
    assert shards.write_shards(again, folder, ids, size, per).count() == len(files)
    after = {f: f.stat().st_mtime_ns for f in files}
    assert [f for f in files if before[f] != after[f]] == [files[1]]
    assert sorted(shards.read_shards(spark, done, folder, ids, 0, size, per).collect()) == rows
    none = shards.cut_sequences(no_docs, ids, size)
    assert shards.write_shards(none, str(tmp_path / "n"), ids, size, per).count() == 0
    assert shards.packed_documents(none).count() == 0


def test_input_after_a_shuffle(spark, texts, tmp_path):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").orderBy("text")
    cut = shards.cut_sequences(docs, RANKS)
    done = shards.write_shards(cut, str(tmp_path), RANKS)
    rows = shards.read_shards(spark, done, str(tmp_path), RANKS).collect()
    assert sum(r.n for r in rows) == sum(len(encoded(t)) for t in texts.values())
