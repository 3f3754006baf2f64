"""Secret spans by fixed patterns and by a token-efficiency test.

Patterns find assignments, access keys and long hexadecimal runs. The
efficiency test adds strings that no pattern names: a run of key characters
with few characters per token under a byte-pair vocabulary is random, since
words, paths and identifiers compress. Known shapes are not secrets and are left
out before the test: digests (hexadecimal of a digest's length), UUIDs, plain
numbers, and identifiers: words that the vocabulary holds, joined by ``_``, ``-``,
``/``, capitals or short numbers. Letters alone are no such shape. A run that is
readable as a whole (a path, a name before a key) is tested by its parts as well.

Spans count code points, ends are exclusive. A null or empty text has no span.
Rows are judged alone and whole, so repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm.common import sha256_hex, texts

# The kinds, in their order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18

LEAST = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
DIGESTS = {32, 40, 48, 56, 64, 96, 128}
HEXADECIMAL = re.compile(r"[0-9a-f]+")
UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
# What an identifier consists of. Words of LONG letters or more must make
# up WORDY of its letters and digits; other parts of SHORT letters or more must be words too.
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
LONG, SHORT, WORDY, DIGIT_GROUP = 4, 3, 2 / 3, 4

# The parts of a run, from what length on a part's ratio shows that it is
# text, and what follows a key.
RUN_PART = re.compile(rf"(?<![A-Za-z0-9])(?:{UUID.pattern})(?![A-Za-z0-9])|[A-Za-z0-9]+", re.IGNORECASE)
TELLING = 8
MIXED = re.compile(r"[a-z][A-Z]")
PADDING = re.compile(r"={1,2}(?![A-Za-z0-9=])")

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType(), False),
            T.StructField("kind", T.IntegerType(), False),
            T.StructField("end", T.IntegerType(), False),
        ]
    ),
    False,
)


@lru_cache(maxsize=2)
def vocabulary(ranks_file: str, pattern: str):
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def known_shape(value: str) -> bool:
    """Digests, UUIDs and numbers."""
    bare = value.strip("=-_/+")
    lower = bare.lower()
    if not any(c.isalpha() for c in bare):
        return True
    if any(c.isdigit() for c in bare) and len(bare) in DIGESTS and HEXADECIMAL.fullmatch(lower):
        return True
    return bool(UUID.fullmatch(bare))


def is_word(part: str, encoding) -> bool:
    """Whether the vocabulary holds the letters as one token, in some usual case."""
    lower = part.lower()
    forms = (part, lower, lower.capitalize(), " " + lower, " " + lower.capitalize())
    return any(f.encode() in encoding._mergeable_ranks for f in forms)


def identifier(value: str, encoding) -> bool:
    """Words joined by separators, capitals and short numbers, in whatever case.

    The parts are cut in one pass; random strings have letters that are no words.
    """
    wordy = total = 0
    for part in PART.findall(value):
        total += len(part)
        if part[0].isdigit():
            if len(part) > DIGIT_GROUP:
                return False
        elif len(part) >= SHORT:
            if not is_word(part, encoding):
                return False
            wordy += len(part) if len(part) >= LONG else 0
    return wordy >= WORDY * total


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find."""
    spans = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_VALUE:
                spans.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LENGTH:
                spans.append((m.start(), 1, m.end()))
    spans.extend((m.start(), 2, m.end()) for m in HEX.finditer(text))
    return spans


def is_random(value: str, encoding, chars_per_token: float) -> bool:
    """Whether the vocabulary can't shorten a value that is no known shape."""
    if known_shape(value) or identifier(value, encoding):
        return False
    return len(value) < chars_per_token * len(encoding.encode_ordinary(value))


def readable(part: str, encoding, chars_per_token: float) -> bool | None:
    """Whether a part is text; None if it is too short to tell, or a number."""
    if UUID.fullmatch(part):
        return True
    if part.isdigit():
        return None
    if identifier(part, encoding):
        return True if len(part) >= LONG else None
    if len(part) < chars_per_token * len(encoding.encode_ordinary(part)):
        return None if len(part) < LONG and part.isalpha() and not MIXED.search(part) else False
    return True if len(part) >= TELLING else None


def random_stretches(value: str, encoding, chars_per_token: float) -> list[tuple[int, int]]:
    """The random stretches of a run that is readable as a whole, in one pass.

    Readable parts and ``=`` before more part them; what is between is joined, so a
    base64 key with ``/``, ``+``, ``-`` or ``_`` is judged as one, and its padding is
    added. Where a stretch as a whole passes for text, its long parts are judged alone.
    """
    stretches: list[list[tuple[int, int, bool]]] = [[]]
    end = 0
    for m in RUN_PART.finditer(value):
        says = readable(m.group(), encoding, chars_per_token)
        if "=" in value[end : m.start()]:
            stretches.append([])
        end = m.end()
        if says:
            stretches.append([])
        else:
            stretches[-1].append((m.start(), m.end(), says is False))
    found = []
    for parts in stretches:
        random = [i for i, p in enumerate(parts) if p[2]]
        if not random:
            continue
        # A short part at an end may belong to a key that holds separators.
        first, last = random[0], random[-1]
        wide_first = first - (first > 0 and parts[first - 1][1] - parts[first - 1][0] < LONG)
        wide_last = last + (last + 1 < len(parts) and parts[last + 1][1] - parts[last + 1][0] < LONG)
        for i, j in ((wide_first, wide_last), (first, last)):
            whole = padded(value, parts[i][0], parts[j][1])
            if whole[1] - whole[0] >= LEAST and is_random(value[slice(*whole)], encoding, chars_per_token):
                found.append(whole)
                break
        else:
            found.extend(random_parts(value, parts, encoding, chars_per_token))
    return found


def random_parts(
    value: str, parts: list[tuple[int, int, bool]], encoding, chars_per_token: float
) -> list[tuple[int, int]]:
    """The long parts of a stretch that are random alone."""
    found = []
    for start, stop, _ in parts:
        alone = padded(value, start, stop)
        if alone[1] - alone[0] >= LEAST and is_random(value[slice(*alone)], encoding, chars_per_token):
            found.append(alone)
    return found


def padded(value: str, start: int, end: int) -> tuple[int, int]:
    """The stretch with up to two ``=`` behind it, unless a value follows them."""
    after = PADDING.match(value, end)
    return (start, after.end() if after else end)


def random_spans(text: str, encoding, chars_per_token: float) -> list[tuple[int, int, int]]:
    """Runs of key characters that the vocabulary can't shorten, or stretches of them."""
    spans = []
    for m in CANDIDATE.finditer(text):
        value = m.group()
        if known_shape(value):
            continue
        if is_random(value, encoding, chars_per_token):
            spans.append((m.start(), 3, m.end()))
        elif not value.isalnum():
            spans.extend(
                (m.start() + a, 3, m.start() + b)
                for a, b in random_stretches(value, encoding, chars_per_token)
            )
    return spans


def secret_spans(
    text: Column, ranks_file: str, pattern: str, chars_per_token: float = 2.0
) -> Column:
    """``array<struct<start,kind,end>>`` by start, then kind; kinds index ``KINDS``."""

    @F.arrow_udf(SPANS)
    def spans(column: pa.Array) -> pa.Array:
        encoding = vocabulary(ranks_file, pattern)
        found = []
        for value in column:
            t = value.as_py() or ""
            rows = sorted(base_spans(t) + random_spans(t, encoding, chars_per_token))
            found.append([{"start": s, "kind": k, "end": e} for s, k, e in rows])
        item = pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")])
        return pa.array(found, pa.list_(item))

    return spans.asNondeterministic()(text)


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]
            ),
        ),
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by a mark; overlapping spans give one mark."""
    state = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["parts"],
                    F.array(F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)),
                ).alias("parts"),
            ),
        ).otherwise(
            F.struct(
                F.greatest(a["at"], s["end"]).alias("at"), a["parts"].alias("parts")
            )
        ),
        lambda a: F.concat_ws(
            "", F.concat(a["parts"], F.array(F.substr(text, a["at"] + 1)))
        ),
    )
    return F.when(F.size(spans) > 0, state).otherwise(text)


def scan(df: DataFrame, ranks_file: str, pattern: str, chars_per_token: float = 2.0) -> DataFrame:
    """One row per document: counts per base kind, base digest, all spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    found = texts(df).select(
        "doc_id", secret_spans(F.col("text"), ranks_file, pattern, chars_per_token).alias("found")
    )
    base = joined(F.filter("found", lambda s: s["kind"] < 3))
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        sha256_hex(base).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        count(3).alias("n_random"),
    )


def mask(
    documents: DataFrame, ranks_file: str, pattern: str, chars_per_token: float = 2.0
) -> DataFrame:
    """All rows and columns, the secrets of ``text`` replaced; ``n_chars`` follows it."""
    rows = documents.select(
        F.struct("*").alias("row"), secret_spans(F.col("text"), ranks_file, pattern, chars_per_token).alias("found")
    )
    text = redacted(F.col("row.text"), F.col("found"))
    masked = rows.select(F.col("row").withField("text", text).alias("row"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        length = F.coalesce(F.length("row.text").cast(kind), F.col("row.n_chars"))
        masked = masked.select(F.col("row").withField("n_chars", length).alias("row"))
    return masked.select("row.*")
