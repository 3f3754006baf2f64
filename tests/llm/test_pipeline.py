"""The pipeline against its stages applied by brute force, and the entry point."""

import hashlib

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as entry_point
import corpus_pipeline
from conftest import SF_DIR
from llm_cases import no_docs, odd_docs, texts  # noqa: F401
from profilelake.llm import queries, rule_ensemble, secrets
from test_near_duplicates import brute
from test_secrets import expected


def plain_words(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def contaminated(texts, items):
    """Ids of the texts that hold an item with at most a fifth of its words edited.

    Dynamic programming over all texts at once; unknown words between them cost more
    than any budget.
    """
    items = [w for w in map(plain_words, items) if w]
    gap = max(len(w) for w in items) // 5 + 2
    names, owner, line = {}, [], []
    for i, text in texts.items():
        words = [names.setdefault(w, len(names)) for w in plain_words(text)]
        line += [*words, *[-1] * gap]
        owner += [i] * (len(words) + gap)
    line, owner, found = np.array(line), np.array(owner), set()
    steps = np.arange(len(line) + 1)
    for words in items:
        row = np.zeros(len(line) + 1, np.int64)
        for k, w in enumerate(words, 1):
            new = np.empty_like(row)
            new[0] = k
            new[1:] = np.minimum(row[:-1] + (line != names.get(w, -2)), row[1:] + 1)
            row = np.minimum.accumulate(new - steps) + steps
        found |= set(owner[row[1:] <= min(len(words) // 5, len(words) - 1)])
    return found


def masked(text):
    """The text with a mark for every stretch that spans cover, starts in order."""
    encoding = secrets.vocabulary(queries.RANKS, queries.RANKS_PATTERN)
    base = [tuple(map(int, s.split(":")[1:])) for s in expected(text).split(",") if s]
    spans = sorted(base + [(s, e) for s, _, e in secrets.random_spans(text, encoding, 2.0)])
    out, at = "", 0
    for start, end in spans:
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_run(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    good = rule_ensemble.classify(docs, labels).where("predicted = 1").select("doc_id").collect()
    left = {r.doc_id: texts[r.doc_id] for r in good}
    classes = brute(left)
    left = {i: t for i, t in left.items() if classes[i] == i}
    bench = [b.text or "" for b in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    gone = contaminated(left, bench)
    assert gone
    left = {i: masked(t) for i, t in left.items() if i not in gone}
    assert sum("[SECRET]" in t for t in left.values()) > 3
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    want = {}
    for i, text in left.items():
        ids = library.encode(text)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))
        want[i] = (len(ids), *digests)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want
    assert len(rows) == len(want)


def test_stages_keep_the_columns(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        docs = out.cache()
        assert docs.count() <= odd_docs.count()
    assert docs.where("doc_id = -7 or doc_id = 5").count() == 2


def test_empty_documents(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF_DIR).count() == 0


def test_registered():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_point.queries()
    assert {"op7_warc", "op12_phrases"} <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("text, spans", [("a secret: abcdefghijklmnop", 1), ("token: secret: abcdefghijklmnop", 0), ("", 0)])
def test_plain_masking(text, spans):
    assert masked(text).count("[SECRET]") == spans
