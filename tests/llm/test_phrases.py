"""Phrase mining against plain counting, and the index against plain search."""

import collections
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from compare import connect, duck_rows, spark_rows
from conftest import SF_DIR
from llm_cases import no_docs, odd_docs  # noqa: F401
from profilelake.llm import phrases, queries

LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(docs, least, longest, top):
    """Rows (lang, rank, phrase, a, l, r, n, score) by plain counting."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    rows = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        inside = set()
        for g, b in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    if b >= counts[g[i : i + k]]:
                        inside.add(g[i : i + k])
        scored = []
        for g, a in found.items():
            if g not in inside:
                cuts = [(counts[g[:k]], counts[g[k:]]) for k in range(1, len(g))]
                score, _, (left, right) = min((1000 * a * n[lang] // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
                scored.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (s, a, g, left, right) in enumerate(sorted(scored)[:top], 1):
            rows.append((lang, rank, g.decode(), -a, left, right, n[lang], -s))
    return sorted(rows)


def got(df):
    return sorted(tuple(r)[:8] for r in df.collect())


def noisy(seed, size, vocabulary, marks=" ,. \t\n"):
    rng = random.Random(seed)
    words = [rng.choice("abcdeÉé漢X") * rng.randrange(1, 3) + str(i) for i in range(vocabulary)]
    fixed = [" ".join(rng.choice(words) for _ in range(rng.randrange(2, 8))) for _ in range(12)]
    out = []
    for _ in range(size):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else rng.choice(words) for _ in range(rng.randrange(25))]
        out.append((rng.choice(["en", "fr", None, ""]), "".join(p + rng.choice(marks) for p in parts)))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 24, 1500])
def test_against_plain_counting(spark, shard_bytes):
    docs = noisy(1, 400, 60)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    for least, longest in ((5, 5), (9, 3), (20, 2)):
        want = brute(docs, least, longest, 50)
        assert len(want) > 20
        assert got(phrases.collocations(df, least, longest, 50, shard_bytes=shard_bytes)) == want


def test_parts_lose_nothing():
    for seed in range(20):
        rng = random.Random(seed)
        text = "".join(rng.choice("ab .,é") for _ in range(rng.randrange(400)))
        text += "a" * rng.choice([0, 100]) + rng.choice(["", ".b c"])
        cut = list(phrases._parts(text.encode(), 40))
        assert b"".join(cut).decode() == text
        assert [w for p in cut for w in pieces(p.decode()) if w] == [w for w in pieces(text) if w]


@pytest.mark.parametrize("seed", range(6))
def test_index_counts(seed):
    rng = np.random.default_rng(seed)
    sequence = phrases._closed_up(rng.choice([0, 1, 2, 3, 4, 7], 300, p=[0.2, 0.3, 0.2, 0.1, 0.1, 0.1]))
    plain = sequence.tolist()
    index = phrases.Index(sequence, 5, 7)
    for grow in ("lrlr", "llll", "rrrr", "rllr"):
        found = index.words()
        for step in grow:
            found = index.left(found) if step == "l" else index.right(found)
            k = found.words.shape[1]
            windows = collections.Counter(tuple(plain[i : i + k]) for i in range(len(plain) - k + 1))
            want = {w: n for w, n in windows.items() if 0 not in w}
            assert dict(zip(map(tuple, found.words.tolist()), found.n.tolist())) == want


def test_blocks_of_a_shard_share_their_words(spark):
    docs = noisy(2, 300, 40)
    df = spark.createDataFrame(docs, "lang string, text string").na.fill("und", ["lang"]).coalesce(1)
    rows = df.mapInArrow(phrases._shards(1000), phrases.SHARDS).collect()
    words = [r for r in rows if r.word is not None]
    blocks = [r for r in rows if r.sequence is not None]
    shards = {r.shard for r in rows}
    assert len(blocks) > 2 * len(shards) > 4 and shards == {r.shard for r in blocks}
    assert len({(r.shard, r.lang, r.word) for r in words}) == len({(r.shard, r.local) for r in words}) == len(words)
    spelled = {(r.shard, r.local): (r.lang, r.word) for r in words}
    met = collections.Counter()
    for r in blocks:
        met.update((r.shard, *spelled[r.shard, i]) for i in np.frombuffer(r.sequence, np.int32).tolist() if i)
    assert met == {(r.shard, r.lang, r.word): r.n for r in words}
    want = collections.Counter((lang if lang is not None else "und", w) for lang, text in docs for p in pieces(text) for w in p)
    found = collections.Counter()
    for r in words:
        found[r.lang, r.word] += r.n
    assert found == want


def test_a_pair_leaves_a_shard_once():
    blocks = [np.array(b, np.int32).tobytes() for b in ([0, 1, 2, 1, 2], [0, 2, 1, 2, 3], [0, 3])]
    left = pa.table({"shard": [7] * 3, "sequence": pa.array(blocks, pa.binary())})
    words = {"shard": [7] * 3, "x": [1, 2, 3], "y": [30, 10, 20], "pair": [False] * 3}
    rows = phrases._pairs(left, pa.table(words)).to_pylist()
    assert {(r["a"], r["b"]): r["n"] for r in rows} == {(30, 10): 3, (10, 30): 2, (10, 20): 1} and len(rows) == 3
    known = {"shard": [7] * 5, "x": [1, 2, 3, 30, 10], "y": [30, 10, 20, 10, 30], "pair": [False] * 3 + [True] * 2}
    grams = phrases._longer(3)(left, pa.table(known)).to_pylist()
    assert sorted((r["gram"], r["n"]) for r in grams) == [([10, 30, 10], 2), ([30, 10, 30], 1)]


def test_query_against_plain_counting_and_sql(spark):
    docs = duckdb.sql(f"SELECT lang, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    found = queries.op12_phrases(spark, SF_DIR)
    want = brute(docs, 100, 5, 2000)
    assert got(found) == want and len(want) > 10
    con = connect(SF_DIR)
    assert duck_rows(con, queries.oracle_sql()["op12_phrases"]) == spark_rows(found)


def test_products_past_64_bits(spark):
    n = "cast(100000000000 as bigint)"  # ten times this squared passes 64 bits
    row = spark.sql(f"SELECT {n} AS n, {n} AS all, {n} - 1 AS l, {n} + 1 AS r").select(
        phrases._exact("n").alias("n"), phrases._exact("all").alias("all"), phrases._exact("l").alias("l"), phrases._exact("r").alias("r")
    )
    assert row.selectExpr("cast(1000 as decimal(4,0)) * n * all div (l * r) AS s").first()["s"] == 1000


def test_odd_rows(spark, odd_docs, no_docs):
    found = phrases.collocations(odd_docs, least=20)
    docs = [(r.lang, r.text) for r in odd_docs.collect()]
    assert got(found) == brute(docs, 20, 5, 2000)
    for docs in (no_docs, odd_docs.where("text is null"), odd_docs.where("trim(text) = 'word'")):
        assert phrases.collocations(docs).count() == 0


def test_extensions(spark):
    docs = [("en", "a b c. a b d. x a b. " * 4)]
    rows = phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), least=4)
    assert {r.phrase: (r.a, r.n_left, r.n_right) for r in rows.collect()} == {
        "a b": (12, 1, 2), "a b c": (4, 0, 0), "a b d": (4, 0, 0), "x a b": (4, 0, 0),
    }
