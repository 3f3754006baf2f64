"""Exact merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

Encoding finds the one segmentation that repeated merging would give without
merging the text:

* an Aho-Corasick automaton over the pieces gives, for every position, the
  pieces that start there; the longest is tried first, then shorter ones;
* a piece may follow another only if merging the two texts anew gives exactly
  these two pieces (what may follow a piece is kept per longest piece there, which
  settles what the shorter ones are);
* where no piece fits, the last piece is taken back and its end position is
  struck from a bit field, so no position fails twice.

The segmentation whose adjacent pieces are all compatible is unique and is the
merge result, so the search is exact and linear in the text.

Cases: a null text is empty; an empty text has no ids and decodes to an empty
text; characters outside the vocabulary become byte pieces; U+2581 decodes to a
space, as in the library; repeated rows are coded alike; an empty table gives no
row; ``digests`` reads id and text only, whatever other columns are called. Texts of
any length are encoded whole: matches are held for a few blocks at a time.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm.common import texts

SPACE = "▁"
NO_TEXT = hashlib.sha256(b"").hexdigest()
BLOCK = 4096  # characters whose matches are looked up at once
KEPT_BYTES = 96_000_000  # of encoded words that a Python worker remembers
ENTRY_BYTES = 330  # of one, beside the characters of its word
PAIRS_KEPT = 500_000  # answers on what may follow a piece that a Python worker remembers
SLICE = 256  # texts of a batch that are Python strings at once


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one-byte", _one_byte)


class _Words(dict):
    """What a word is encoded to, kept up to a number of bytes; long words are not kept.

    Once half of the bytes are filled, the words held become the older half in place of
    those that were; a word met again comes back from there, so frequent words stay.
    """

    def __init__(self, coder: Pieces):
        self.coder = coder
        self.held = 0
        self.older: dict = {}

    def coded(self, word: str):
        return array("i", self.coder.to_ids(self.coder.segment(word))).tobytes()

    def __missing__(self, word: str):
        found = self.older.pop(word, None)
        if found is None:
            found = self.coded(word)
        if len(word) <= 64:
            self.held += ENTRY_BYTES + 12 * len(word)
            if self.held > KEPT_BYTES // 2:
                self.older = dict(self)
                self.clear()
                self.held = ENTRY_BYTES + 12 * len(word)
            self[word] = found
        return found


class _Digested(_Words):
    """(number of ids, the ids as decimals with a comma after each, the bytes they decode to)."""

    def coded(self, word: str) -> tuple[int, bytes, bytes]:
        counts, decimals, surfaces = zip(*map(self.coder.facts.__getitem__, self.coder.segment(word)))
        return sum(counts), b"".join(decimals), b"".join(surfaces)


class _Facts(dict):
    """Of a piece what ``_Digested`` keeps of a word; only pieces of the vocabulary are kept."""

    def __init__(self, coder: Pieces):
        self.coder = coder

    def __missing__(self, piece: str) -> tuple[int, bytes, bytes]:
        ids = self.coder.to_ids([piece])
        found = len(ids), ("%d," * len(ids) % tuple(ids)).encode(), b"".join(map(self.coder.surface.__getitem__, ids))
        if piece in self.coder.ids:
            self[piece] = found
        return found


class Pieces:
    """The vocabulary of one BPE model, and the coder over it."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_ids = [-1] * 256
        self.surface: list[bytes] = [b""] * size
        self.plain = np.zeros(size, dtype=bool)
        self.control = np.zeros(size, dtype=bool)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes_ids[value] = i
                self.surface[i] = bytes([value])
            elif model.is_control(i):
                self.control[i] = True
            elif model.is_unknown(i):
                self.surface[i] = model.decode([i]).encode()
            else:
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
                self.surface[i] = piece.replace(SPACE, " ").encode()
                self.plain[i] = True
        self.unknown = model.unk_id()
        self.byte_fallback = min(self.bytes_ids) >= 0
        self.longest = max(map(len, self.ids), default=1)
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1:  # a single character is always a candidate
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.words = self._word_pattern()
        self.known = _Words(self)
        self.digested = _Digested(self)
        self.facts = _Facts(self)
        self.steps: dict[str, tuple[str, int, dict]] = {}
        self.answers = 0

    def _word_pattern(self) -> re.Pattern:
        """Cuts a text only where no piece can lie across the cut.

        That holds between a character and a following space mark if no piece
        holds the two in this order, and on either side of a character that is
        in no piece of several characters.
        """
        several = [p for p in self.ids if len(p) > 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in several):
            return re.compile(r"(?s).+")
        joined = set("".join(several))
        alone = re.escape("".join(c for c in map(chr, range(128)) if c not in joined))
        if not alone:
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(f"[{alone}]|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")

    def merge(self, text: str) -> list[str]:
        """The text's pieces by merging: best score first, then leftmost."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two pieces' text anew gives these two pieces."""
        if not left:
            return self.merge(right) == [right]
        return left + right not in self.ids and self.merge(left + right) == [left, right]

    def _step(self, piece: str) -> tuple[str, int, dict]:
        """(piece, its length, what may follow it per longest piece there, as far as known)."""
        found = self.steps.get(piece)
        if found is None:
            found = self.steps[piece] = piece, len(piece), {}
        return found

    def _options(self, left: str, longest: str) -> tuple:
        """The steps to all pieces that may follow, longest first."""
        if self.answers >= PAIRS_KEPT:
            for _, _, known in self.steps.values():
                known.clear()
            self.steps.clear()
            self.answers = 0
        pieces = (longest[:length] for length in range(len(longest), 0, -1))
        options = tuple(
            self._step(piece)
            for piece in pieces
            if (len(piece) == 1 or piece in self.ids) and self.compatible(left, piece)
        )
        self.answers += 1
        self._step(left)[2][longest] = options
        return options

    def _longest(self, text: str, block: int) -> list[int]:
        """For each position of a block the length of the longest piece there."""
        start = block * BLOCK
        size = min(len(text) - start, BLOCK)
        found = [1] * size
        if size == len(text):
            for end, length in self.automaton.iter(text):  # of a start, the longest comes last
                found[end - length + 1] = length
            return found
        for end, length in self.automaton.iter(
            text, start, min(len(text), start + size + self.longest)
        ):
            if end - length + 1 < start + size:
                found[end - length + 1 - start] = length
        return found

    def segment(self, text: str) -> list[str]:
        """The pieces of a text, found by backtracking."""
        size = len(text)
        number, block = 0, self._longest(text, 0)
        failed = None
        out, path, known = [], [], self._step("")[2]
        at, skip = 0, 0
        while at < size:
            if at // BLOCK != number:
                number = at // BLOCK
                block = self._longest(text, number)
            longest = text[at : at + block[at - number * BLOCK]]
            options = known.get(longest)
            if options is None:
                options = self._options(out[-1] if out else "", longest)
            for piece, length, follows in options:
                end = at + length
                if failed is not None and (length >= skip > 0 or failed[end >> 3] >> (end & 7) & 1):
                    continue
                out.append(piece)
                path.append(known)
                at, skip, known = end, 0, follows
                break
            else:
                if failed is None:
                    failed = bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                skip = len(out.pop())
                at -= skip
                known = path.pop()
        return out

    def to_ids(self, pieces: list[str]) -> list[int]:
        ids: list[int] = []
        for piece in pieces:
            found = self.ids.get(piece)
            if found is not None:
                ids.append(found)
            elif self.byte_fallback:
                ids.extend(self.bytes_ids[b] for b in piece.encode())
            else:
                ids.append(self.unknown)
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, as the bytes of 32-bit integers."""
        if not text:
            return b""
        words = self.words.findall(SPACE + text.replace(" ", SPACE))
        return b"".join(map(self.known.__getitem__, words))

    def digests(self, text: str) -> tuple[int, str, str]:
        """(number of ids, digest of the ids, digest of the text that they decode to).

        A text is cut where no piece lies across, so the ids of its words one after
        another are its ids, and as encoding gives no control ids and whole characters
        only, their bytes one after another are what ``decode`` gives.
        """
        if not text:
            return 0, NO_TEXT, NO_TEXT
        words = self.words.findall(SPACE + text.replace(" ", SPACE))
        counts, decimals, surfaces = zip(*map(self.digested.__getitem__, words))
        decoded = b"".join(surfaces)
        return (
            sum(counts),
            hashlib.sha256(memoryview(b"".join(decimals))[:-1]).hexdigest(),
            hashlib.sha256(memoryview(decoded)[decoded.startswith(b" ") :]).hexdigest(),
        )

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the mark that encoding puts in front."""
        if not len(ids):
            return ""
        controls = np.flatnonzero(self.control[ids])
        if len(controls):  # bytes on both sides of one make no character
            runs = [r for r in np.split(ids, controls) if len(r)]
            runs = [r[1:] if self.control[r[0]] else r for r in runs]
            runs = [r for r in runs if len(r)]
        else:
            runs = [ids]
        parts = [b"".join(map(self.surface.__getitem__, r.tolist())) for r in runs]
        if parts and self.plain[runs[0][0]] and parts[0][:1] == b" ":
            parts[0] = parts[0][1:]
        return "".join(p.decode("utf-8", "one-byte") for p in parts)


@lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    """The model, read once in each Python process."""
    return Pieces(model_file)


def encode(text: Column, model_file: str) -> Column:
    """``array<int>`` of the ids of a text; a null text is an empty one."""

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def piece_ids(column: pa.Array) -> pa.Array:
        coder = pieces(model_file)
        parts = [coder.encode(x.as_py() or "") for x in column]
        offsets = np.zeros(len(parts) + 1, dtype=np.int64)
        np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(parts), dtype=np.int32))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return piece_ids.asNondeterministic()(text)


def decode(ids: Column, model_file: str) -> Column:
    """The text of an ``array<int>`` of ids; null and empty ones give an empty text."""

    @F.arrow_udf(T.StringType())
    def piece_text(column: pa.Array) -> pa.Array:
        coder = pieces(model_file)
        column = column.fill_null([])
        values = column.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        return pa.array([coder.decode(values[a:b]) for a, b in zip(starts, ends)], pa.string())

    return piece_text.asNondeterministic()(ids)


def digests(documents: DataFrame, model_file: str) -> DataFrame:
    """One row per document: number and digest of its ids, digest of what they decode to.

    Ids and decoded texts do not leave the task that makes them.
    """

    @F.arrow_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def coded(column: pa.Array) -> pa.Array:
        coder = pieces(model_file)
        rows = (
            coder.digests(text or "")
            for start in range(0, len(column), SLICE)
            for text in column.slice(start, SLICE).to_pylist()
        )
        n, ids, decoded = zip(*rows) if len(column) else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    found = texts(documents).select("doc_id", coded.asNondeterministic()(F.col("text")).alias("coded"))
    return found.select("doc_id", "coded.*")
