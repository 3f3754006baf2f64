"""Phrases whose words stand together more often than apart, counted by FM-indexes.

Documents are cut into blocks of a bounded number of bytes, and a few blocks of a
task make a shard. A block's texts become one sequence of word ids with a separator
between pieces, and an FM-index over it (Burrows-Wheeler transforms of the sequence
and of its reverse, suffixes sorted to the depth of the longest phrase). All phrases
of one length are intervals of the index; one extension step turns the intervals of
one length into those of the next, to the left by the transform of the sequence, to
the right by that of the reverse, keeping both intervals in step. The blocks of a
shard number their words alike, so words, pairs and what is known of them leave or
reach a shard once, not once a block; an index holds one block, or as many words of
several as are left of one. The counts of all shards are summed per phrase.

A phrase can only reach the least count if its parts do, so the work is done in
three rounds, each over sequences from which more has been cut out: words are
counted; pairs of frequent words are counted; longer phrases are enumerated within
runs of frequent pairs. What is frequent comes back to a shard by a join on the
shard, so it gets only what occurs in it, and nothing is broadcast or collected.
Products are decimals, so they are exact past 64 bits.

Cases: null and empty texts have no words; a null language is ``und``; repeated rows
count as often as they occur; ids are not used, and other columns are left aside,
whatever their names; ties are ordered by count, then by the phrase's bytes; an empty
table gives no row. Texts are used whole; one longer than a block is cut into parts
between pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import staged

LEAST = 100
LONGEST = 5
TOP = 2000
SHARD_BYTES = 1 << 23  # of text in one block
BLOCKS = 4  # of a shard
RUN_WORDS = 1 << 20  # of the runs of a shard that are indexed together
SEQUENCE_BITS, LOCAL_BITS = 12, 27  # of the shards of a task, and of the words of a shard
NO_LANG = "und"

# White space within a piece, and the marks between pieces.
BLANKS = b" \t"
MARKS = b".,;:!?\n\x0b\x0c\r"

SHARDS = "shard bigint, lang string, word string, local int, n bigint, sequence binary"
PAIRS = "shard bigint, a bigint, b bigint, n bigint"
GRAMS = "gram array<bigint>, n bigint"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(MARKS)] = 2


# Words ---------------------------------------------------------------------------


def tokenised(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """(ids with a zero before every piece, the distinct words by id from 1 on)."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = _KIND[raw]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(1, np.int32), pa.array([], pa.string())
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    data = _LOWER[raw[inside]]
    words = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(data)
    ).dictionary_encode()
    marks = np.cumsum(kind == 2, dtype=np.int32)
    first = np.ones(len(starts), bool)
    first[1:] = marks[starts[1:]] != marks[ends[:-1] - 1]
    sequence = np.zeros(len(starts) + int(first.sum()), np.int32)
    sequence[np.arange(len(starts)) + np.cumsum(first)] = words.indices.to_numpy() + 1
    return sequence, words.dictionary


def _parts(text: bytes, shard_bytes: int) -> Iterator[bytes]:
    """A text in parts of about a block at most, cut at marks."""
    while len(text) > shard_bytes:
        at = max(text.rfind(m, 0, shard_bytes) for m in (bytes([m]) for m in MARKS))
        if at < 0:  # one piece longer than a block: it ends at the first mark after
            found = [k for m in MARKS if (k := text.find(bytes([m]), shard_bytes)) >= 0]
            if not found:
                break
            at = min(found)
        yield text[: at + 1]
        text = text[at + 1 :]
    yield text


class _Numbering:
    """The words of a shard by language, with their ids from 1 on and their counts."""

    def __init__(self):
        self.words: dict[str, pa.Array] = {}
        self.local: dict[str, np.ndarray] = {}
        self.counts: dict[str, np.ndarray] = {}
        self.last = 0

    def numbered(self, lang: str, texts: list[bytes]) -> np.ndarray:
        """The sequence of one block's texts, in the ids of the shard."""
        sequence, words = tokenised(texts)
        known = self.words.get(lang, pa.array([], pa.string()))
        local = self.local.get(lang, np.zeros(0, np.int32))
        at = pc.index_in(words, value_set=known)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        place = at.fill_null(0).to_numpy(zero_copy_only=False).copy()
        place[new] = len(known) + np.arange(len(new))
        fresh = np.arange(self.last + 1, self.last + 1 + len(new), dtype=np.int32)
        self.last += len(new)
        self.words[lang] = pa.concat_arrays([known, words.take(pa.array(new))])
        self.local[lang] = local = np.concatenate([local, fresh])
        counts = np.zeros(len(local), np.int64)
        counts[: len(known)] = self.counts.get(lang, 0)
        counts[place] += np.bincount(sequence, minlength=len(words) + 1)[1:]
        self.counts[lang] = counts
        return np.concatenate([np.zeros(1, np.int32), local[place]])[sequence]


def _shards(shard_bytes: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SHARDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
        number = TaskContext.get().partitionId() << SEQUENCE_BITS
        end = number + (1 << SEQUENCE_BITS)
        held: dict[str, list[bytes]] = {}
        size = blocks = 0
        numbering = _Numbering()

        def block() -> pa.RecordBatch:
            if number == end:
                raise ValueError(f"a task has more than {1 << SEQUENCE_BITS} shards: use smaller partitions")
            sequences = [numbering.numbered(lang, texts) for lang, texts in held.items()]
            columns = [[number], [None], [None], [None], [None], [np.concatenate(sequences).tobytes()]]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        def words() -> Iterator[pa.RecordBatch]:
            for lang, found in numbering.words.items():
                n = len(found)
                columns = [np.full(n, number), [lang] * n, found, numbering.local[lang], numbering.counts[lang], [None] * n]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                for part in _parts(text.as_py().encode(), shard_bytes):
                    held.setdefault(lang, []).append(part)
                    size += len(part) + 1
                    if size >= shard_bytes:
                        yield block()
                        held, size, blocks = {}, 0, blocks + 1
                        if blocks == BLOCKS:
                            yield from words()
                            numbering, blocks, number = _Numbering(), 0, number + 1
        if held:
            yield block()
        yield from words()

    return shards


# The index -----------------------------------------------------------------------


def suffix_order(sequence: np.ndarray, depth: int) -> np.ndarray:
    """Places of words, in order of the ``depth`` words from there to the piece's end."""
    at = np.flatnonzero(sequence)
    padded = np.zeros(len(sequence) + depth, np.int64)
    padded[: len(sequence)] = sequence
    span, order = 1, np.argsort(padded[at], kind="stable")
    while span < depth and len(at):
        step = min(span, depth - span)
        key = padded[at] * (padded.max() + 1) + padded[at + step]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) + 1
        padded[at[order]] = rank
        span += step
    return at[order]


class Side:
    """One direction of the index: the transform, and where its rows lead."""

    def __init__(self, sequence: np.ndarray, depth: int, symbols: int, extend: bool = True):
        order = suffix_order(sequence, depth)
        self.before = sequence[order - 1]
        counts = np.bincount(sequence, minlength=symbols + 1)
        counts[0] = 0
        self.starts = np.concatenate([[0], np.cumsum(counts)])  # of each word's block of rows
        if extend:
            # Rows that begin with a separator are left out; they would come first, so
            # words in front of one take the first rows of their block.
            ends = sequence[:-1][sequence[1:] == 0]
            skipped = np.bincount(ends, minlength=symbols + 1)
            skipped[0] = 0
            by_word = np.argsort(self.before, kind="stable")
            words = self.before[by_word]
            first = np.searchsorted(words, np.arange(symbols + 1))
            self.leads = np.empty(len(order), np.int64)
            self.leads[by_word] = self.starts[words] + skipped[words] + np.arange(len(words)) - first[words]


class Intervals(NamedTuple):
    """Phrases of one length: their words, rows in both directions, and how often each occurs."""

    words: np.ndarray
    low: np.ndarray
    back_low: np.ndarray
    n: np.ndarray


class Index:
    """A bidirectional FM-index of a sequence whose separators are zeros, the first entry one."""

    def __init__(self, sequence: np.ndarray, depth: int, symbols: int):
        closed = np.append(sequence, np.zeros(1, sequence.dtype))
        self.symbols = symbols
        self.forth = Side(closed, depth, symbols)
        self.back = Side(closed[::-1].copy(), depth, symbols)

    def words(self) -> Intervals:
        low, n = self.forth.starts[1:-1], np.diff(self.forth.starts)[1:]
        some = n > 0
        words = np.flatnonzero(some)[:, None] + 1
        return Intervals(words, low[some], low[some], n[some])

    def _extended(self, side: Side, low: np.ndarray, other: np.ndarray, n: np.ndarray):
        """(phrase, word, rows in this direction, rows in the other, count) of all extensions."""
        owner, word, first, n_new, before = _neighbours(side.before, low, n, self.symbols)
        real = word > 0
        owner, word, before = owner[real], word[real], before[real]
        return owner, word, side.leads[first[real]], other[owner] + before, n_new[real]

    def left(self, of: Intervals) -> Intervals:
        """All phrases one word longer at their beginning."""
        owner, word, low, back, n = self._extended(self.forth, of.low, of.back_low, of.n)
        return Intervals(np.column_stack([word, of.words[owner]]), low, back, n)

    def right(self, of: Intervals) -> Intervals:
        """All phrases one word longer at their end."""
        owner, word, back, low, n = self._extended(self.back, of.back_low, of.low, of.n)
        return Intervals(np.column_stack([of.words[owner], word]), low, back, n)


def _neighbours(before: np.ndarray, low: np.ndarray, n: np.ndarray, symbols: int):
    """The distinct words in front of each interval's rows.

    (interval, word, first row, rows, rows of the interval with a smaller word)
    """
    owner = np.repeat(np.arange(len(n)), n)
    begin = np.cumsum(n) - n
    rows = np.arange(len(owner)) - begin[owner] + low[owner]
    key = owner * (symbols + 1) + before[rows]
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    owner, word = key[at] // (symbols + 1), key[at] % (symbols + 1)
    return owner, word, rows[order[at]], np.diff(np.append(at, len(key))), at - begin[owner]


def phrases_of(sequence: np.ndarray, symbols: int, longest: int) -> Iterator[Intervals]:
    """The phrases of 2, 3, ... words with their counts, extended at either end in turn."""
    index = Index(sequence, longest, symbols)
    found = index.words()
    for length in range(2, longest + 1):
        found = index.right(found) if length % 2 else index.left(found)
        yield found


# Rounds --------------------------------------------------------------------------


def _closed_up(sequence: np.ndarray) -> np.ndarray:
    """The sequence with one zero in front and none after another."""
    sequence = np.concatenate([np.zeros(1, sequence.dtype), sequence])
    keep = sequence > 0
    keep[0] = True
    keep[1:] |= sequence[:-1] > 0
    return sequence[keep]


def _symbols(sequence: bytes | pa.Buffer, local: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence over the frequent words only, numbered in order of their ids; the ids from 1 on)."""
    raw = np.frombuffer(sequence, np.int32)
    order = np.argsort(ids)
    names = np.zeros(int(max(raw.max(initial=0), local.max(initial=0))) + 1, np.int32)
    names[local[order]] = np.arange(1, len(ids) + 1)
    return names[raw], np.concatenate([[0], ids[order]])


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct keys, the sum of each)."""
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[at], np.add.reduceat(n[order], at)


def _pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    names = [c.split()[0] for c in PAIRS.split(", ")]
    empty = pa.table({c: pa.array([], pa.int64()) for c in names})
    if not left.num_rows or not right.num_rows:
        return empty
    keys, counts = [], []
    for raw in left["sequence"]:
        sequence, ids = _symbols(raw.as_buffer(), right["x"].to_numpy(), right["y"].to_numpy())
        symbols = len(ids) - 1
        closed = np.append(_closed_up(sequence), np.zeros(1, np.int32))
        side = Side(closed, 2, symbols, extend=False)
        owner, word, _, n, _ = _neighbours(
            side.before, side.starts[1:-1], np.diff(side.starts)[1:], symbols
        )
        real = word > 0
        keys.append(word[real] * len(ids) + owner[real] + 1)
        counts.append(n[real])
    key, n = _summed(np.concatenate(keys), np.concatenate(counts))
    columns = [np.full(len(key), left["shard"][0].as_py()), ids[key // len(ids)], ids[key % len(ids)], n]
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, columns)})


def _runs(sequence: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """Where three words or more stand in a row all of whose pairs are known: these, and a zero before each run."""
    sequence = _closed_up(sequence).astype(np.int64)
    met = np.isin(sequence[:-1] * size + sequence[1:], known)
    # A word stays if it lies in three words all of whose pairs are frequent.
    triple = np.flatnonzero(met[:-1] & met[1:])
    stays = np.zeros(len(sequence), bool)
    for k in range(3):
        stays[triple + k] = True
    kept = np.flatnonzero(stays)
    cut = np.ones(len(kept), bool)
    cut[1:] = (np.diff(kept) > 1) | ~met[kept[1:] - 1]
    runs = np.zeros(len(kept) + int(cut.sum()), np.int64)
    runs[np.arange(len(kept)) + np.cumsum(cut)] = sequence[kept]
    return runs


def _longer(longest: int):
    def grams(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("gram", pa.list_(pa.int64())), ("n", pa.int64())])
        pair = right["pair"].to_numpy(zero_copy_only=False).astype(bool)
        x, y = right["x"].to_numpy(), right["y"].to_numpy()
        if not left.num_rows or not pair.any():
            return schema.empty_table()
        held, parts = [], []

        def indexed() -> None:
            names, runs = np.unique(np.concatenate(held), return_inverse=True)  # the first is the separator
            held.clear()
            for found in phrases_of(runs, len(names) - 1, longest):
                length = found.words.shape[1]
                if length > 2 and len(found.n):
                    flat = pa.array(ids[names[found.words.ravel()]], pa.int64())
                    ends = pa.array(np.arange(0, (len(found.n) + 1) * length, length), pa.int32())
                    parts.append(pa.table([pa.ListArray.from_arrays(ends, flat), pa.array(found.n, pa.int64())], schema=schema))

        known = None
        for raw in left["sequence"]:
            sequence, ids = _symbols(raw.as_buffer(), x[~pair], y[~pair])
            if known is None:
                known = np.searchsorted(ids, x[pair]) * np.int64(len(ids)) + np.searchsorted(ids, y[pair])
            runs = _runs(sequence, len(ids), known)
            if len(runs):
                held.append(runs)
            if sum(map(len, held)) >= RUN_WORDS:
                indexed()
        if held:
            indexed()
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return grams


class Counted(NamedTuple):
    words: DataFrame  # id, lang, word, n: the frequent words
    grams: DataFrame  # gram, n: the frequent phrases of two words and more
    totals: DataFrame  # lang, n: all words


def counted(
    documents: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    text_col: str = "text",
    lang_col: str = "lang",
    shard_bytes: int = SHARD_BYTES,
) -> Counted:
    """The words and phrases that occur at least ``least`` times in a language."""
    plain = documents.select(
        F.coalesce(documents[lang_col], F.lit(NO_LANG)).alias("lang"),
        F.coalesce(documents[text_col], F.lit("")).alias("text"),
    )
    shards = staged(plain.mapInArrow(_shards(shard_bytes), SHARDS), "word-shards")
    occurring = shards.filter("word IS NOT NULL").select("shard", "lang", "word", "local", "n")
    totals = staged(occurring.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    # The rows of a word meet once: in its count, and in its id, which is its place in
    # the first of its shards. That shard's row carries the word itself.
    own = F.shiftleft("shard", LOCAL_BITS).bitwiseOR(F.col("local").cast("bigint"))
    met = (
        occurring.withColumn("own", own)
        .withColumn("f", F.expr("sum(n) OVER (PARTITION BY lang, word)"))
        .withColumn("id", F.expr("min(own) OVER (PARTITION BY lang, word)"))
        .filter(F.col("f") >= least)
    )
    first = F.col("id") == F.col("own")
    mine = met.select(
        "shard", F.col("local").cast("bigint").alias("x"), F.col("id").alias("y"),
        *(F.when(first, F.col(c)).alias(c) for c in ("lang", "word", "f")),
    )
    mine = staged(mine, "shard-words")
    words = mine.filter("f IS NOT NULL").select(F.col("y").alias("id"), "lang", "word", F.col("f").alias("n"))
    mine = mine.select("shard", "x", "y", F.lit(False).alias("pair"))
    sequences = shards.filter("sequence IS NOT NULL").select("shard", "sequence").groupBy("shard")
    pairs = sequences.cogroup(mine.groupBy("shard")).applyInArrow(_pairs, PAIRS)
    pairs = pairs.withColumn("total", F.expr("sum(n) OVER (PARTITION BY a, b)")).filter(F.col("total") >= least)
    pairs = staged(pairs.drop("n"), "pairs")
    facts = mine.unionAll(pairs.select("shard", F.col("a").alias("x"), F.col("b").alias("y"), F.lit(True)))
    longer = sequences.cogroup(facts.groupBy("shard")).applyInArrow(_longer(longest), GRAMS)
    longer = longer.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    two = pairs.groupBy("a", "b").agg(F.first("total").alias("n")).select(F.array("a", "b").alias("gram"), "n")
    grams = two.unionAll(longer) if longest > 2 else two
    return Counted(words, staged(grams, "phrases"), totals)


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(14,0)")


def collocations(
    documents: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int | None = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The best phrases of every language, from rank 1 on; all of them without ``top``.

    ``n_left`` and ``n_right`` say how many phrases are one word longer at that end.
    """
    words, grams, totals = counted(documents, least, longest, text_col, lang_col, shard_bytes)
    size = F.size("gram")
    sub = grams.filter(size > 2).select(
        "n",
        F.explode(
            F.array(
                F.struct(F.expr("slice(gram, 1, size(gram) - 1)").alias("gram"), F.lit(1).alias("right")),
                F.struct(F.expr("slice(gram, 2, size(gram) - 1)").alias("gram"), F.lit(0).alias("right")),
            )
        ).alias("sub"),
    )
    longer = sub.groupBy("sub.gram").agg(
        F.max("n").alias("longer"), F.sum("sub.right").alias("n_right"), F.sum(1 - F.col("sub.right")).alias("n_left")
    )
    open_ = grams.join(longer, "gram", "left").filter("longer IS NULL OR longer < n")
    known = words.select(F.array("id").alias("part"), F.col("n").alias("f")).unionAll(
        grams.filter(size < longest).select(F.col("gram").alias("part"), F.col("n").alias("f"))
    )
    langs = words.select(F.col("id").alias("first"), "lang")
    scored = (
        open_.withColumn("first", F.get("gram", F.lit(0)))
        .join(langs, "first")
        .join(totals.withColumnRenamed("n", "all"), "lang")
        .withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
        .withColumn("head", F.expr("slice(gram, 1, k)"))
        .withColumn("tail", F.expr("slice(gram, k + 1, size(gram) - k)"))
        .join(known.select(F.col("part").alias("head"), F.col("f").alias("l")), "head")
        .join(known.select(F.col("part").alias("tail"), F.col("f").alias("r")), "tail")
        .withColumn("above", F.lit(1000).cast("decimal(4,0)") * _exact("n") * _exact("all"))
        .withColumn("below", _exact("l") * _exact("r"))
        .withColumn("score", F.expr("above div below"))
        .groupBy("lang", "gram", F.col("n").alias("a"), F.col("all").alias("n"), "n_left", "n_right")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    spelled = (
        scored.select("gram", F.posexplode("gram").alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy("gram")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("gram", F.concat_ws(" ", "words.word").alias("phrase"))
    )
    named = scored.join(spelled, "gram").select("*", "cut.score", "cut.l", "cut.r")
    ranked = named.withColumn(
        "rank",
        F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)").cast("bigint"),
    )
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score",
        *(F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_left", "n_right")),
    )
