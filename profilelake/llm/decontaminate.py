"""Benchmark decontamination by pigeonhole edit matching.

An item may appear in a document with at most ``budget`` word edits, a share of
its length. Cut into ``budget + 1`` pieces, one piece must then appear unedited.
All pieces of a block of items form one Aho-Corasick automaton; every document is
read once against it. Each hit fixes where the item could lie, and Myers'
bit-parallel algorithm (one machine word or long integer per item, one step per
word of the text) finds the least edit distance of the item to any part of that
stretch. Words are what edits count in: runs of letters and digits, lower case.

The items are the query set: they are stored in blocks of bounded size, which tasks
read from the shared folder, and each block is matched with all documents before the
next, so no process's memory grows with the benchmark, the driver's neither.

Cases: items without words match nothing; equal items each give their rows; null
and empty texts have no matches; repeated rows of a document give repeated rows;
texts are used whole, and an item may appear in one any number of times (the best
place is reported).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow.dataset import dataset
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm import files
from profilelake.llm.common import scratch, staged, texts

BUDGET = 0.2  # edits per word of the item
BLOCK_CHARS = 16_000_000  # characters of items that one task holds

MATCHES = "doc_id bigint, item_id bigint, distance int, item_words int, first_word int, end_word int"


# Letters and digits of any script, as str.isalnum has them.
WORD = re.compile(r"[^\W_]+")


def word_list(text: str) -> list[str]:
    return WORD.findall(text.lower())


def myers(pattern: list[str], text: list[str]) -> tuple[int, int]:
    """(least distance of the pattern to a part of the text, where that part ends)."""
    size = len(pattern)
    masks: dict[str, int] = {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    every, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = every, 0, size
    best, end = size, 0
    for j, word in enumerate(text, 1):
        equal = masks.get(word, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | ~(horizontal | up) & every
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & every
        minus = minus << 1 & every
        up = minus | ~(vertical | plus) & every
        down = plus & vertical
        if score < best:
            best, end = score, j
    return best, end


class Items:
    """A block of items and the automaton over their pieces."""

    def __init__(self, rows: tuple[tuple[int, str], ...], budget: float):
        import ahocorasick

        self.items = []
        pieces: dict[str, list[tuple[int, int, int]]] = {}
        for item_id, text in rows:
            words = word_list(text)
            if not words:
                continue
            edits = min(int(budget * len(words)), len(words) - 1)
            number = len(self.items)
            self.items.append((item_id, words, edits))
            for k in range(edits + 1):
                start = k * len(words) // (edits + 1)
                stop = (k + 1) * len(words) // (edits + 1)
                piece = " " + " ".join(words[start:stop]) + " "
                pieces.setdefault(piece, []).append((number, start, stop - start))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if pieces:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item, distance, item's words, first word, end word) of items in the text."""
        words = word_list(text)
        if not words or not self.items:
            return []
        line = " " + " ".join(words) + " "
        hits: dict[int, set[int]] = {}
        seen_chars, seen_words = 0, 0
        for end, (length, owners) in self.automaton.iter(line):
            start = end - length + 1
            if start >= seen_chars:  # words before the hit, counted on from the last hit
                seen_words += line.count(" ", seen_chars, start)
                seen_chars, at = start, seen_words
            else:
                at = seen_words - line.count(" ", start, seen_chars)
            for number, offset, _ in owners:
                hits.setdefault(number, set()).add(at - offset)
        found = []
        for number, places in hits.items():
            item_id, pattern, edits = self.items[number]
            best, stretch, reach = None, None, -1
            for place in sorted(places):
                low, high = place - edits, place + len(pattern) + edits
                if stretch and low <= reach:
                    stretch[1] = reach = high
                    continue
                best = self._verify(pattern, edits, words, stretch, best)
                stretch, reach = [low, high], high
            best = self._verify(pattern, edits, words, stretch, best)
            if best:
                found.append((item_id, best[0], len(pattern), best[1], best[2]))
        return found

    @staticmethod
    def _verify(pattern, edits, words, stretch, best):
        if not stretch:
            return best
        low, high = max(0, stretch[0]), min(len(words), stretch[1])
        distance, end = myers(pattern, words[low:high])
        if distance > edits or best and best[0] <= distance:
            return best
        # Where it starts: the reversed item against the reversed stretch that ends there.
        _, back = myers(pattern[::-1], words[low : low + end][::-1][: len(pattern) + edits])
        return distance, low + end - back, low + end


@lru_cache(maxsize=1)
def built(path: str, budget: float) -> Items:
    """The automaton of a stored block, built once in each Python process."""
    where, name = files.at(path)
    rows = dataset(name, filesystem=where, format="parquet").to_table(columns=["item_id", "text"])
    found = zip(rows["item_id"].to_pylist(), rows["text"].to_pylist())
    return Items(tuple(sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1]))), budget)


def _blocks(benchmark: DataFrame, block_chars: int) -> list[str]:
    """Where the items are stored, in blocks of bounded size; the driver sees only how many."""
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    ).filter(F.length("text") > 0)
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-total // block_chars)
    if not parts:
        return []
    parts = 1 if parts == 1 else 2 * parts
    path = scratch(benchmark.sparkSession, "items")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int").alias("block")
    items.select("*", block).write.partitionBy("block").parquet(path)
    held = benchmark.sparkSession.read.parquet(path).select("block").distinct().collect()
    return [f"{path}/block={r['block']}" for r in sorted(held)]


def _matcher(path: str, budget: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = built(path, budget)
        schema = pa.schema(
            [("doc_id", pa.int64()), ("item_id", pa.int64())]
            + [(n, pa.int32()) for n in ("distance", "item_words", "first_word", "end_word")]
        )
        for batch in batches:
            found = [
                (doc.as_py(), *row)
                for doc, text in zip(batch["doc_id"], batch["text"])
                for row in items.matches(text.as_py())
            ]
            columns = list(zip(*found)) if found else [[]] * len(schema)
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return match


def matches(
    documents: DataFrame,
    benchmark: DataFrame,
    budget: float = BUDGET,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item that it holds: distance and the words it spans."""
    docs = texts(documents)
    blocks = _blocks(benchmark, block_chars)
    found = documents.sparkSession.createDataFrame([], MATCHES)
    for path in blocks:
        rows = docs.mapInArrow(_matcher(path, budget), MATCHES)
        # One automaton at a time: each block is matched before the next.
        found = found.unionAll(rows if len(blocks) == 1 else staged(rows, "matches"))
    return found


def remove_contaminated(
    documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The documents that hold no item, with all their columns.

    The matcher runs once per row beside the row's own columns, so rows without an
    id are judged too, and nothing is joined.
    """
    blocks = _blocks(benchmark, block_chars)
    kept = documents
    for path in blocks:
        kept = kept.filter(_holds_none(path, BUDGET)(F.col("text")))
        kept = kept if path == blocks[-1] else staged(kept, "clean")
    return kept


def _holds_none(path: str, budget: float):
    @F.arrow_udf("boolean")
    def holds_none(column: pa.Array) -> pa.Array:
        items = built(path, budget)
        return pa.array([not items.matches(t.as_py() or "") for t in column], pa.bool_())

    return holds_none.asNondeterministic()
