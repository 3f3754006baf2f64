"""Whitened embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are turned into whole numbers once and packed, in blocks of about a
megabyte, into a staged table. Sums per dimension are exact, so rows are centred
exactly before anything is multiplied. Each step of the bidiagonalisation is one
pass over the blocks: the product with the centred rows ``X v`` and the product
``X' u`` back are summed by Spark per entry. A left vector is kept as the
combination of columns that gives it (``u = X w``), so tasks get a few short
vectors and nothing as long as the table exists outside it. Left and right vectors
are fully reorthogonalised. The singular value decomposition of the small
bidiagonal matrix gives components and deviations; one more pass rotates them
within their span (Rayleigh-Ritz), and a last one measures the covariance of what
comes out.

The steps end when the leading components no longer change and nothing that was
not seen yet can be larger: what is left of the trace is less than the last wanted
variance, or a second, random start within the unseen rest changed nothing, or the
number of dimensions is reached.

Cases: rows whose vector is null or holds null or non-finite entries are dropped;
the others are kept, also those with a null or repeated id; a vector shorter than
the longest counts as zero where it has no entry; numbers beyond 2^53 are held
at that; components without variance cannot be whitened and are left out, so one
row, equal rows and an empty table give no result. Other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Context, Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import staged

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
BLOCK_VALUES = 1 << 20  # entries of a block
HELD = float(1 << 53)
SEED = 5

BLOCKS = "ids array<bigint>, width int, base bigint, item int, x binary, sums array<decimal(38,0)>"
SUMS = "at int, value double"
WHITE = (
    "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)

_EXACT = Context(prec=60)


def _rows(ids: pa.Array, vectors: pa.Array) -> tuple[list, np.ndarray]:
    """Ids and whole numbers of the vectors without null or non-finite entries."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry is NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(sizes)
    good = np.flatnonzero(bad[ends] == bad[ends - sizes])
    width = int(sizes[good].max(initial=0))
    entries = np.zeros((len(good), width))
    columns = np.arange(width)
    inside = columns < sizes[good][:, None]
    entries[inside] = values[((ends - sizes)[good][:, None] + columns)[inside]]
    whole = np.floor(np.clip(entries * SCALE, -HELD, HELD)).astype(np.int64) + SHIFT
    return [ids[int(i)].as_py() for i in good], whole


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("ids", pa.list_(pa.int64())), ("width", pa.int32()), ("base", pa.int64()),
         ("item", pa.int32()), ("x", pa.binary()), ("sums", pa.list_(pa.decimal128(38, 0)))]
    )
    for batch in batches:
        ids, whole = _rows(batch["id"], batch["vector"])
        step = max(1, BLOCK_VALUES // max(1, whole.shape[1]))
        for start in range(0, len(ids), step):
            part = whole[start : start + step]
            base = int(part.min(initial=0)) if part.size else 0
            item = next(b for b in (1, 2, 4, 8) if b == 8 or part.size == 0 or part.max() - base < 1 << 8 * b)
            low = (part & 0xFFFFFFFF).sum(axis=0, dtype=np.int64)
            high = (part >> 32).sum(axis=0, dtype=np.int64)
            sums = [Decimal((int(h) << 32) + int(k)) for h, k in zip(high, low)]
            row = [ids[start : start + step], part.shape[1], base, item,
                   (part - base).astype(f"<u{item}").tobytes(), sums]
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)


class Rows(NamedTuple):
    """Staged blocks with what centring needs: ``sums[j] = n * floor[j] + rest[j]``."""

    blocks: DataFrame
    n: int
    floor: np.ndarray
    rest: np.ndarray


def packed(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Rows:
    """The vectors as whole numbers, staged in blocks, with their exact sums."""
    plain = embeddings.filter(F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    blocks = staged(plain.mapInArrow(_packed, BLOCKS), "blocks")
    n = blocks.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n")).first()["n"]
    sums = (
        blocks.select(F.size("ids").alias("n"), F.posexplode("sums").alias("at", "sum"))
        .groupBy("at")
        .agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
        .orderBy("at")
        .collect()
    )
    totals = [int(r["sum"]) + (n - r["n"]) * SHIFT for r in sums]
    floor = np.array([t // n for t in totals], dtype=np.int64)
    return Rows(blocks, n, floor, np.array([t % n for t in totals], dtype=np.int64))


def _whole(block: dict, floor: np.ndarray) -> np.ndarray:
    """A block's numbers less ``floor``, as wide as ``floor``."""
    width = block["width"]
    x = np.frombuffer(block["x"], f"<u{block['item']}").reshape(-1, width) if width else None
    out = np.full((len(block["ids"]), len(floor)), SHIFT, np.int64)
    if x is not None:
        out[:, :width] = x.astype(np.int64) + block["base"]
    return out - floor


def _summed(rows: Rows, product: Callable[[np.ndarray], list[np.ndarray]]) -> np.ndarray:
    """Entrywise sums over all blocks of what ``product`` makes of a block's centred rows."""
    floor, offset, root = rows.floor, rows.rest / rows.n, np.sqrt(rows.n)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch.to_pylist():
                centred = (_whole(block, floor) - offset) / root
                part = np.concatenate([np.ravel(p) for p in product(centred)])
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())],
                names=["at", "value"],
            )

    # The sums column is dropped, so it is not read again.
    found = rows.blocks.select("ids", "width", "base", "item", "x").mapInArrow(partial, SUMS)
    sums = found.groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(sums))
    for r in sums:
        out[r["at"]] = r["value"]
    return out


def _fresh(rng: np.random.Generator, seen: np.ndarray) -> np.ndarray:
    """A random unit vector orthogonal to the columns of ``seen``."""
    v = rng.standard_normal(seen.shape[0])
    for _ in range(3):
        v -= seen @ (seen.T @ v)
        v /= np.linalg.norm(v)
    return v


def bidiagonalised(rows: Rows, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(orthonormal columns that span the leading components, the trace of the covariance)."""
    d = len(rows.floor)
    rng = np.random.default_rng(SEED)
    right = np.zeros((d, 0))  # v of every step
    combined = np.zeros((d, 0))  # w of every step: u = X w
    back = np.zeros((d, 0))  # X' u of every step
    trace = float(_summed(rows, lambda x: [np.array([(x * x).sum()])])[0]) if rows.n else 0.0
    alphas, betas = [], []
    if not trace:
        return right, trace
    v, beta, restarted, before = _fresh(rng, right), 0.0, False, None
    tiny = 1e-13 * np.sqrt(trace)
    while True:
        q = v - beta * combined[:, -1] if beta else v
        held = combined.copy()

        def product(x: np.ndarray, q=q, held=held) -> list[np.ndarray]:
            p = x @ q
            return [np.array([p @ p]), x.T @ p, (x @ held).T @ p]

        sums = _summed(rows, product)
        norm2, back_p, c = sums[0], sums[1 : d + 1], sums[d + 1 :]
        alpha = np.sqrt(max(0.0, norm2 - c @ c))
        right = np.column_stack([right, v])
        if alpha <= tiny:  # a direction without variance: nothing lies beyond it
            alpha, w, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, z = (q - held @ c) / alpha, (back_p - back @ c) / alpha
        combined, back = np.column_stack([combined, w]), np.column_stack([back, z])
        alphas.append(alpha)
        betas.append(beta)
        k = len(alphas)
        u_small, sigma, vt = np.linalg.svd(np.diag(alphas) + np.diag(betas[1:], 1))
        r = z - alpha * v
        for _ in range(2):
            r -= right @ (right.T @ r)
        beta = float(np.linalg.norm(r))
        lead = sigma[:components]
        if k == d:
            break
        loose = beta * np.abs(u_small[-1, : len(lead)])
        if k > components and loose.max() <= 1e-14 * sigma[0]:
            rest = trace - float((sigma**2).sum())
            same = before is not None and np.allclose(before, lead, rtol=1e-10, atol=0)
            if rest < 0.5 * lead[-1] ** 2 or rest <= 1e-12 * trace or (restarted and same):
                break
            if not restarted or not same:
                restarted, before, beta = True, lead.copy(), 0.0
        if beta <= tiny:
            beta = 0.0
        v = r / beta if beta else _fresh(rng, right)
    return right @ vt[: min(components, len(sigma))].T, trace


class Whitening(NamedTuple):
    components: np.ndarray  # one column each, unit length
    variances: np.ndarray
    trace: float
    identity_error: float


def fitted(rows: Rows, components: int = COMPONENTS) -> Whitening:
    """The leading components, their variances, and how far the whitened rows' covariance is off."""
    span, trace = bidiagonalised(rows, components)
    if not span.shape[1]:
        return Whitening(span, np.zeros(0), trace, 0.0)

    def squared(basis: np.ndarray) -> np.ndarray:
        k = basis.shape[1]
        return _summed(rows, lambda x: [(x @ basis).T @ (x @ basis)]).reshape(k, k)

    span, _ = np.linalg.qr(span)
    small = squared(span)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, span = values[order], span @ turn[:, order]
    keep = values > 1e-12 * trace
    values, span = values[keep], span[:, keep]
    span = span * np.where(span[np.abs(span).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)
    off = np.abs(squared(span / np.sqrt(values)) - np.eye(len(values))).max() if len(values) else 0.0
    return Whitening(span, values, trace, float(off))


def _deviations(whole: np.ndarray, n: int, rest: np.ndarray) -> pa.Array:
    """Exact sums of squares of ``n * whole - rest``; null beyond 38 digits."""
    largest = n * (int(np.abs(whole).max(initial=0)) + 1)
    if largest * largest * max(1, whole.shape[1]) < 1 << 63:
        off = n * whole - rest
        return pa.array((off * off).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
    off = whole.astype(object) * n - rest.astype(object)
    sums = [int(v) for v in (off * off).sum(axis=1)]
    held = [Decimal(v) if v < 10**38 else None for v in sums]
    return pa.array([None if v is None else _EXACT.plus(v) for v in held], pa.decimal128(38, 0))


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector and component: the exact deviation and the whitened coordinate."""
    rows = packed(embeddings, id_col, vector_col)
    fit = fitted(rows, components)
    n, floor, rest = rows.n, rows.floor, rows.rest
    matrix = fit.components / np.sqrt(fit.variances)
    explained = fit.variances / fit.trace if fit.trace else fit.variances
    k, off = matrix.shape[1], fit.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in WHITE.split(", ")]
        for batch in batches:
            for block in batch.to_pylist():
                whole = _whole(block, floor)
                white = (whole - rest / n) @ matrix
                m = len(whole)
                each = np.repeat(np.arange(m), k)
                columns = [
                    pa.array(block["ids"], pa.int64()).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()),
                    _deviations(whole, n, rest).take(pa.array(each)),
                    pa.array(white.ravel(), pa.float64()),
                    pa.array(np.tile(explained, m), pa.float64()),
                    pa.array(np.full(m * k, off), pa.float64()),
                ]
                yield pa.record_batch(columns, names=names)

    source = rows.blocks.select("ids", "width", "base", "item", "x")
    return (source if k else source.limit(0)).mapInArrow(project, WHITE)
