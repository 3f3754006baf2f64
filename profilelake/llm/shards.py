"""Token ids written in training order, as fixed-stride binary shards.

Documents are encoded once, packed and cut into sequences: each partition of the scan
is one stream of documents, an end id after each, so only a stream's last sequence is
short. The sequences are stored in the shared folder, many compressed together, numbered by
where they were cut; how many each partition has is all that comes to the driver. A keyed
Feistel network permutes the numbers of all sequences; numbers that leave the range
walk on along their cycle until they are back in it, so every sequence gets one global
slot and every slot one sequence. Slots are cut into shards, and each task gets a range
of shards, sorts it and writes it from start to end.

A record has a fixed stride: the id of the document that it begins in, the id's place
in that document, the number of ids (little-endian int64, int64, int32), then the ids,
16 or 32 bits each, the short ones padded with zeros. So slot ``s`` is found by a
division, reading on from any slot is sequential, and a complete shard is known by its
size: a run that is started again from the same stored sequences leaves complete shards
alone. ``packed_documents`` lists what each record holds of which document.

Cases: null and empty texts are an end id; rows with null ids are written with id
-1; repeated rows are written as often; other columns are left aside, whatever their
names; texts of any length are encoded and cut whole; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profilelake.llm import files
from profilelake.llm.common import scratch, staged, texts
from profilelake.llm.near_duplicates import mix
from profilelake.llm.secrets import vocabulary

SEQUENCE = 2048
SHARD_SLOTS = 4096
KEY = 20_240_101
ROUNDS = 6
HEAD = "<qqi"
HEAD_BYTES = struct.calcsize(HEAD)

_PIECE = "doc_id bigint, at int, start bigint, n int"
CUT = f"p int, k bigint, doc_id bigint, start bigint, n int, pieces array<struct<{_PIECE}>>, data binary"
SLOTTED = "slot bigint, doc_id bigint, start bigint, n int, data binary"
SHARDS = "shard bigint, slots int"
READ = "slot bigint, doc_id bigint, start bigint, n int, ids_crc bigint"


class Ids(NamedTuple):
    """How texts become ids: ``load`` gives the encoder in a task, ``end`` closes a document."""

    load: Callable[[], Callable[[str], np.ndarray]]
    end: int
    kind: str  # NumPy's name of the stored type

    @property
    def size(self) -> int:
        return np.dtype(self.kind).itemsize


def byte_ids() -> Ids:
    """One id per byte of the text, and 255, which no text holds, for the end."""
    return Ids(lambda: lambda text: np.frombuffer(text.encode(), np.uint8), 255, "<u1")


def rank_ids(ranks_file: str, pattern: str, end: int, kind: str = "<u2") -> Ids:
    """The ids of a byte-pair vocabulary given as ranks."""

    def load() -> Callable[[str], np.ndarray]:
        encoding = vocabulary(ranks_file, pattern)
        return lambda text: encoding.encode_to_numpy(text, disallowed_special=())

    return Ids(load, end, kind)


def permuted(numbers: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """The slots of numbers below ``count``: a keyed permutation of that range."""
    half = max(1, ((count - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key & (1 << 63) - 1))
    slots = numbers.astype(np.uint64)
    walking = np.ones(len(slots), bool)
    while walking.any():
        x = slots[walking]
        left, right = x >> np.uint64(half), x & low
        for round_key in keys:
            left, right = right, left ^ (mix(right ^ round_key) & low)
        slots[walking] = left << np.uint64(half) | right
        walking = slots >= np.uint64(count)
    return slots.astype(np.int64)


@lru_cache(maxsize=1)
def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3)


@lru_cache(maxsize=1)
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _streamed(
    batches: Iterator[pa.RecordBatch], ids: Ids, sequence: int
) -> Iterator[tuple[list[tuple], bytes]]:
    """(pieces, ids) of the stream's sequences; a piece is (document, at, start, n)."""
    encode = ids.load()
    pieces: list[tuple] = []
    parts: list[np.ndarray] = []
    held = 0

    def closed() -> tuple[list[tuple], bytes]:
        return pieces, np.concatenate(parts).tobytes()

    for batch in batches:
        for id_, text in zip(batch["doc_id"], batch["text"]):
            found = np.append(encode(text.as_py()), ids.end).astype(ids.kind)
            id_, at = id_.as_py(), 0
            id_ = -1 if id_ is None else id_
            while at < len(found):
                take = min(sequence - held, len(found) - at)
                pieces.append((id_, held, at, take))
                parts.append(found[at : at + take])
                held, at = held + take, at + take
                if held == sequence:
                    yield closed()
                    pieces, parts, held = [], [], 0
    if held:
        yield closed()


def _cut(ids: Ids, sequence: int):
    names = ["p", "k", "doc_id", "start", "n", "pieces", "data"]
    piece = pa.struct([("doc_id", pa.int64()), ("at", pa.int32()), ("start", pa.int64()), ("n", pa.int32())])
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(piece), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, k, rows = TaskContext.get().partitionId(), 0, []

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for pieces, data in _streamed(batches, ids, sequence):
            held = [dict(zip(("doc_id", "at", "start", "n"), x)) for x in pieces]
            n = sum(x[3] for x in pieces)
            rows.append((p, k, pieces[0][0], pieces[0][2], n, held, data))
            k += 1
            if len(rows) == 512:
                yield batch()
                rows = []
        if rows:
            yield batch()

    return cut


def cut_sequences(
    documents: DataFrame, ids: Ids, sequence: int = SEQUENCE, path: str | None = None
) -> DataFrame:
    """The encoded sequences of all documents, stored; with ``path`` there, for later runs."""
    spark = documents.sparkSession
    found = texts(documents).mapInArrow(_cut(ids, sequence), CUT)
    path = path or scratch(spark, "sequences")
    # Pages hold many sequences, so they pack better than each alone.
    found.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(CUT).parquet(path)


def _begins(cut: DataFrame) -> tuple[dict[int, int], int]:
    """(where the numbers of each partition's sequences begin, how many there are)."""
    counts = {r["p"]: r["n"] for r in cut.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    begins, count = {}, 0
    for p in sorted(counts):
        begins[p], count = count, count + counts[p]
    return begins, count


def slots(cut: DataFrame, key: int = KEY) -> tuple[DataFrame, int]:
    """(the sequences with their slots, how many there are)."""
    begins, count = _begins(cut)

    @F.arrow_udf("bigint")
    def slot(p: pa.Array, k: pa.Array) -> pa.Array:
        first = np.array([begins[x] for x in p.to_pylist()], dtype=np.int64)
        numbers = first + k.to_numpy(zero_copy_only=False)
        return pa.array(permuted(numbers, count, key), pa.int64())

    return cut.withColumn("slot", slot("p", "k")), count


def packed_documents(cut: DataFrame, key: int = KEY) -> DataFrame:
    """What each record holds: document, where in the record, where in the document, how many ids."""
    found, _ = slots(cut.select("p", "k", "pieces"), key)
    return found.select("slot", F.inline("pieces"))


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


@F.arrow_udf(T.BinaryType())
def packed(data: pa.Array) -> pa.Array:
    """Each sequence compressed, for the shuffle that deals them out one by one."""
    return pa.array([_packer().compress(x.as_buffer()) for x in data], pa.binary())


def _writer(folder: str, count: int, stride: int, shard_slots: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for row in zip(*(batch[k] for k in ("slot", "doc_id", "start", "n", "data")))
        )
        row = next(rows, None)
        while row is not None:
            shard = row[0].as_py() // shard_slots
            held = min(shard_slots, count - shard * shard_slots)
            if files.size(shard_path(folder, shard)) == held * stride:  # written before
                while row is not None and row[0].as_py() // shard_slots == shard:
                    row = next(rows, None)
            else:
                with files.writing(shard_path(folder, shard)) as out:
                    while row is not None and row[0].as_py() // shard_slots == shard:
                        _, doc, start, n, data = (x.as_py() for x in row)
                        ids = _unpacker().decompress(data)
                        out.write((struct.pack(HEAD, doc, start, n) + ids).ljust(stride, b"\0"))
                        row = next(rows, None)
            yield pa.record_batch(
                [pa.array([shard], pa.int64()), pa.array([held], pa.int32())],
                names=["shard", "slots"],
            )

    return write


def write_shards(
    cut: DataFrame,
    folder: str,
    ids: Ids,
    sequence: int = SEQUENCE,
    shard_slots: int = SHARD_SLOTS,
    key: int = KEY,
) -> DataFrame:
    """Write stored sequences in training order; one row per shard."""
    files.make_folder(folder)
    found, count = slots(cut.select("p", "k", "doc_id", "start", "n", "data"), key)
    shards = -(-count // shard_slots)
    tasks = max(1, min(shards, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    per_task = max(1, -(-shards // tasks))
    ranged = (
        found.select("slot", "doc_id", "start", "n", packed("data").alias("data"))
        .repartitionById(
            max(1, -(-shards // per_task)),
            F.floor(F.col("slot") / (shard_slots * per_task)).cast("int"),
        )
        .sortWithinPartitions("slot")
    )
    stride = HEAD_BYTES + sequence * ids.size
    return staged(ranged.mapInArrow(_writer(folder, count, stride, shard_slots), SHARDS), "shards")


def read_shards(
    spark: SparkSession,
    shards: DataFrame,
    folder: str,
    ids: Ids,
    first_slot: int = 0,
    sequence: int = SEQUENCE,
    shard_slots: int = SHARD_SLOTS,
    with_ids: bool = False,
) -> DataFrame:
    """The sequences from a slot on: one row each, with the CRC-32 of the ids.

    A shard before the slot is not opened, and the slot's own shard is entered at
    the slot's place. ``with_ids`` adds the ids themselves.
    """
    stride, size, kind = HEAD_BYTES + sequence * ids.size, ids.size, ids.kind
    schema = READ + (", ids array<int>" if with_ids else "")
    names = ["slot", "doc_id", "start", "n", "ids_crc", "ids"][: 6 if with_ids else 5]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, slots in zip(batch["shard"].to_pylist(), batch["slots"].to_pylist()):
                begin = max(0, first_slot - shard * shard_slots)
                where, name = files.at(shard_path(folder, shard))
                with where.open_input_file(name) as source:
                    source.seek(begin * stride)
                    while begin < slots:
                        rows = []
                        for k in range(begin, min(begin + 512, slots)):
                            record = source.read(stride)
                            doc, start, n = struct.unpack_from(HEAD, record)
                            raw = record[HEAD_BYTES : HEAD_BYTES + n * size]
                            row = (shard * shard_slots + k, doc, start, n, zlib.crc32(raw))
                            rows.append((*row, np.frombuffer(raw, kind)) if with_ids else row)
                        begin += len(rows)
                        yield pa.record_batch(
                            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names
                        )

    wanted = shards.filter((F.col("shard") + 1) * shard_slots > first_slot)
    return wanted.mapInArrow(read, schema)
