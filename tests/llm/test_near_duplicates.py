"""Near-duplicate classes against all pairs, and signatures against exact similarity."""

import collections
import random

import numpy as np
import pytest

from conftest import SF_DIR
from llm_cases import no_docs, odd_docs, texts  # noqa: F401
from profilelake.llm import near_duplicates as nd
from profilelake.llm import queries


def bag(text):
    w = text.lower().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute(texts, least=0.8):
    """Class of every text, all pairs compared."""
    bags = {i: bag(t or "") for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(set)
    for i, b in bags.items():
        for s in b or [None]:
            holders[s].add(i)
    tried = set()
    for members in holders.values():
        for a in members:
            for b in members:
                if a < b and (a, b) not in tried and root(a) != root(b):
                    tried.add((a, b))
                    x, y = bags[a], bags[b]
                    if x is None or sum((x & y).values()) >= least * sum((x | y).values()):
                        low, high = sorted((root(a), root(b)))
                        parent[high] = low
    return {i: root(i) for i in texts}


def test_query(spark, texts):
    rows = queries.op5_near_duplicates(spark, SF_DIR).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute(texts)


def test_large_family_of_noisy_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = {}
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    for i in range(200, 240):  # share half of the base: similar, but no copies
        texts[i] = " ".join(base[:75] + [f"y{rng.randrange(10**6)}" for _ in range(75)])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert dict(nd.duplicate_classes(df).collect()) == brute(texts)


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    errors = []
    for k in range(150):
        a = rng.integers(0, 2**62, 200)
        b = a.copy()
        changed = int(rng.integers(0, 20))
        b[rng.integers(0, 200, changed)] = rng.integers(0, 2**62, changed)
        if k % 2:  # weights: one stretch repeated many times
            a = np.concatenate([a, np.tile(a[:7], 30)])
        s = nd.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]))
        sizes = np.array([len(a), len(b)])
        found, n = nd.elements(np.concatenate([a, b]), sizes)
        errors.append((s[0] == s[1]).mean() - nd.similarity_of(found[: n[0]], found[n[0] :]))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.07


def test_signatures_do_not_depend_on_neighbours():
    rng = np.random.default_rng(2)
    sizes = np.array([0, 1, 3, 5, 900, 0, 40])
    words = rng.integers(-(2**62), 2**62, sizes.sum())
    together = nd.signatures(words, sizes)
    ends = np.cumsum(sizes)
    for i, n in enumerate(sizes):
        alone = nd.signatures(words[ends[i] - n : ends[i]], sizes[i : i + 1])
        assert (alone[0] == together[i]).all()
        assert (together[i] != 0).all() == (n > 0)


def test_similarity_against_counting():
    rng = random.Random(2)
    for _ in range(300):
        texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(2)]
        one, other = (bag(t) or collections.Counter() for t in texts)
        words = [np.array([hash(w) for w in t.split()], np.int64) for t in texts]
        found, n = nd.elements(np.concatenate(words), np.array([len(w) for w in words]))
        want = sum((one & other).values()) / max(1, sum((one | other).values())) if one or other else 1.0
        assert abs(nd.similarity_of(found[: n[0]], found[n[0] :]) - want) < 1e-12


@pytest.mark.parametrize("levels", [1, 2])
def test_large_bucket_of_dissimilar_texts(spark, monkeypatch, levels):
    """Texts that share a passage and nothing else: pairs compared grow with them, not their square."""
    monkeypatch.setattr(nd, "LEVELS", levels)
    rng = random.Random(9)
    shared = " ".join(f"s{i}" for i in range(60))
    texts = {i: shared + " " + " ".join(f"w{rng.randrange(10**7)}" for _ in range(60)) for i in range(400)}
    for i in range(20):  # and some true copies among them
        texts[1000 + i] = texts[i * 7] + " more"
    met = []
    compared = nd._compared

    def counted(pairs, *rest):
        met.append(pairs.distinct().count())
        return compared(pairs, *rest)

    monkeypatch.setattr(nd, "_compared", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert dict(nd.duplicate_classes(df).collect()) == {i: (i - 1000) * 7 if i >= 1000 else i for i in texts}
    assert levels == 1 or sum(met) < 20 * len(texts)


def test_copies_with_edits_of_their_own_do_not_all_meet(spark, monkeypatch):
    """Copies about the wanted similarity: pairs compared grow with them, not with their square."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(150)]
    texts = {}
    for i in range(500):
        words = list(base)
        for _ in range(1 + i % 12):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    met, compared = [], nd._compared

    def counted(pairs, *rest):
        met.append(pairs.distinct().count())
        return compared(pairs, *rest)

    monkeypatch.setattr(nd, "_compared", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert dict(nd.duplicate_classes(df).collect()) == brute(texts)
    assert sum(met) < 20 * len(texts)


@pytest.mark.parametrize("seed", range(4))
def test_differences_from_cores_lose_no_link(spark, seed):
    """One bucket with copies of several texts, edits that are alike, and texts unlike all."""
    rng = random.Random(seed)
    sets = {}
    for family in range(3):
        base = range(1000 * family, 1000 * family + rng.randrange(20, 60))
        for _ in range((90, 30, 20)[family]):
            kept = [e for e in base if rng.random() > 0.12]
            own = [10**6 + rng.randrange((40, 10**6)[family % 2]) for _ in range(rng.randrange(6))]
            sets[len(sets)] = sorted({*kept, *own})
    for _ in range(15):
        sets[len(sets)] = sorted({rng.randrange(3000) for _ in range(rng.randrange(1, 30))})
    want = {i: i for i in sets}
    for a in sets:
        for b in range(a):
            x, y = set(sets[a]), set(sets[b])
            if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                low, high = sorted((want[a], want[b]))
                want = {i: low if c == high else c for i, c in want.items()}
    hashed = spark.createDataFrame(list(sets.items()), "node bigint, elements array<bigint>")
    members = spark.createDataFrame([(i, 7) for i in sets], "node bigint, key bigint")
    classes = spark.createDataFrame([(i, i, 1, i) for i in sets], "node bigint, first bigint, weight bigint, class bigint")
    got = {r.node: r["class"] for r in nd._apart(members, classes, hashed, 0.8).collect()}
    assert got == want and len(set(want.values())) > 20


def test_similar_members_of_one_large_bucket_only_are_linked(spark):
    """Two similar members among many that are not, with no second bucket in common."""
    sets = {i: list(range(10 * i, 10 * i + 10)) + list(range(10 * (i + 1) % 800, 10 * (i + 1) % 800 + 10)) for i in range(80)}
    sets[80] = list(range(1000, 1019)) + [0]
    sets[81] = list(range(1000, 1019)) + [10]
    sets[82], sets[83] = list(range(2000, 2008)) + [20, 30], list(range(2000, 2008)) + [20, 40]  # 9 of 11
    hashed = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node bigint, elements array<bigint>")
    members = spark.createDataFrame([(i, 7, 0) for i in sets], "node bigint, key bigint, last int")
    classes = spark.createDataFrame([(i, i, 84, i) for i in sets], "node bigint, first bigint, weight bigint, class bigint")
    got = {r.node: r["class"] for r in nd.linked(members, classes, hashed, 0.8).collect()}
    assert got == {i: i for i in range(80)} | {80: 80, 81: 80, 82: 82, 83: 82}


def test_only_elements_of_nodes_in_pairs_are_shuffled(spark, monkeypatch):
    hashed = spark.createDataFrame([(i, [i, i + 1]) for i in range(1000)], "node bigint, elements array<bigint>")
    pairs = spark.createDataFrame([(1, 2), (1, 2), (5, 9)], "a bigint, b bigint")
    passed, may_hold = [], nd.may_hold

    def counted(*args):
        passed.append(may_hold(*args))
        return passed[-1]

    monkeypatch.setattr(nd, "may_hold", counted)
    assert [tuple(r) for r in nd._compared(pairs, hashed, 0.3).collect()] == [(1, 2)]
    assert [p.count() for p in passed] == [4]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 21), (5, 4)]
    got = dict(nd.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20}


def test_odd_rows(odd_docs, no_docs):
    rows = nd.duplicate_classes(odd_docs).collect()
    got = collections.Counter((r.doc_id, r.class_id) for r in rows)
    assert got == {(1, 1): 1, (2, 1): 1, (3, 1): 1, (4, 4): 1, (5, 5): 2, (6, 6): 1, (-7, -7): 1,
                   (None, None): 2}
    kept = nd.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [-7, 0, 0, 1, 4, 5, 6]
    assert nd.duplicate_classes(no_docs).count() == 0 and nd.keep_one(no_docs).count() == 0
