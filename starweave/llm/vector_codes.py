"""Product codes of vectors with exact integer arithmetic: limb-split products, then the first least distance.

Components become integers floor(scale * x). A vector is cut into equal parts, each with a codebook of its own that a
fixed number of rounds of assignment and integer means makes from all vectors. Distances are exact: integers are split
into limbs of 16 bits, the limbs go through float64 matrix products, whose sums stay below 2**53, and the products are
put together in int64; x.x - 2 x.c + c.c then has the true value, and ``argmin`` takes the first of equals. Sums per
entry are exact in the same way (one-hot rows times limbs).

The vectors are packed once into a written table. Every round is one pass over it: a task sends a sum and a count per
entry, Spark adds them up, and the driver gets parts * entries * width numbers, whatever the number of vectors.

Defined cases: a row whose vector is null or holds null or non-finite components is dropped; vectors of unequal or
indivisible length raise, and so do components too large for exact distances in 64 bits (4 * length * reach**2 must
stay below 2**63); with fewer vectors than entries the codebook has as many entries as vectors; the first entries are
the vectors with the smallest vec_ids, null ids last, equal ids by their packed bytes; equal rows are coded each; null
labels are one group; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import checked_broadcast

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMB_BITS = 16
#: Rows whose arrays a task holds at once.
ROWS = 8192


def limbs(v: np.ndarray) -> Iterator[np.ndarray]:
    """``v`` (int64) as float64 limbs of ``LIMB_BITS`` bits in [-2**15, 2**15), lowest first; at least one."""
    half, mask = 1 << (LIMB_BITS - 1), (1 << LIMB_BITS) - 1
    while True:
        low = ((v + half) & mask) - half
        yield low.astype(np.float64)
        v = (v - low) >> LIMB_BITS
        if not v.any():
            return


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The int64 matrix product a @ b by float64 products of limbs."""
    if a.shape[-1] << (2 * LIMB_BITS - 2) >= 1 << 53:
        raise ValueError("too many terms for exact products of limbs")
    out = 0
    right = list(limbs(b))
    for i, x in enumerate(limbs(a)):
        for j, y in enumerate(right):
            out = out + ((x @ y).astype(np.int64) << (LIMB_BITS * (i + j)))
    return out


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first nearest entry, squared distance) of every row of ``part`` (rows x width) in ``book`` (entries x width)."""
    score = (book * book).sum(axis=1) - 2 * exact_product(part, book.T)
    best = score.argmin(axis=1)
    return best, (part * part).sum(axis=1) + score[np.arange(len(part)), best]


def _pack_task(scale: int):
    def task(rows):
        for batch in rows:
            lists = batch.column(2)
            lengths = np.diff(lists.offsets.to_numpy())
            first, last = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
            values = lists.values.slice(first, last - first).to_numpy(zero_copy_only=False)  # null components become NaN
            keep = lists.is_valid().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            keep[owner[~np.isfinite(values)]] = False
            whole = np.floor(np.where(keep[owner], values, 0.0) * scale)
            if len(whole) and np.abs(whole).max() >= 2.0**31:
                raise ValueError(f"components of {np.abs(whole).max() / scale:g} are too large for exact distances in 64 bits")
            whole = whole[keep[owner]].astype("<i4")
            ends = np.concatenate(([0], np.cumsum(lengths[keep])))
            packed = pa.Array.from_buffers(
                pa.binary(), int(keep.sum()), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(whole)])
            reach = [int(np.abs(whole[a:b].astype(np.int64)).max(initial=0)) for a, b in zip(ends, ends[1:])]
            chosen = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(chosen), batch.column(1).filter(chosen), packed, pa.array(reach, pa.int64())],
                ["vec_id", "label", "packed", "reach"])

    return task


def pack(vectors: DataFrame, *, scale: int = SCALE, parts: int = PARTS) -> tuple[DataFrame, int]:
    """(written table of vec_id, label, packed, reach; length of the vectors, 0 for none). A packed vector is its integers as
    little-endian int32."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    kind = rows.schema["label"].dataType.simpleString()
    packed = materialize(rows.mapInArrow(_pack_task(scale), f"vec_id long, label {kind}, packed binary, reach long"), "packed")
    size = F.octet_length("packed")
    low, high, reach = packed.agg(F.min(size), F.max(size), F.max("reach")).first()
    if low is None:
        return packed, 0
    if low != high or high == 0 or high // 4 % parts:
        raise ValueError(f"vectors of {low // 4} to {high // 4} components cannot be cut into {parts} equal parts")
    if high * reach * reach >= 1 << 63:  # high is 4 times the length
        raise ValueError(f"components up to {reach / scale:g} are too large for exact distances in 64 bits")
    return packed, high // 4


def _matrices(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, int64 rows x components) by at most ``ROWS`` rows of the batch."""
    packed = batch.column(column)
    _, offsets, data = packed.buffers()
    for i in range(0, len(packed), ROWS):
        n = min(ROWS, len(packed) - i)
        at = int(np.frombuffer(offsets, np.int32)[packed.offset + i])
        yield i, np.frombuffer(data, "<i4", n * width, at).reshape(n, width).astype(np.int64)


def _sums_task(books: np.ndarray):
    parts, entries, d = books.shape

    def task(rows):
        sums, counts = np.zeros((parts, entries, d), np.int64), np.zeros((parts, entries), np.int64)
        for batch in rows:
            for _, m in _matrices(batch, "packed", parts * d):
                for p in range(parts):
                    part = m[:, p * d : (p + 1) * d]
                    best, _ = nearest(part, books[p])
                    chosen = np.zeros((entries, len(part)), np.int64)
                    chosen[best, np.arange(len(part))] = 1
                    sums[p] += exact_product(chosen, part)
                    counts[p] += chosen.sum(axis=1)
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]),
                 pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return task


def _next_books(packed: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry replaced by the floored mean of the parts that are nearest to it."""
    sent = packed.select("packed").mapInArrow(_sums_task(books), "part int, entry int, n long, sums array<long>")
    exact = F.col("s").cast("decimal(20,0)")
    added = sent.select("part", "entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("part", "entry", "at").agg(
        F.sum("n").alias("n"), F.sum(exact).alias("s"))
    out = books.copy()
    for r in added.collect():  # parts * entries * width rows at most
        out[r.part, r.entry, r.at] = int(r.s) // r.n
    return out


def fit_codebooks(packed: DataFrame, length: int, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts x entries x width, int64) of all packed vectors."""
    first = packed.orderBy(F.col("vec_id").asc_nulls_last(), "packed").select("packed").limit(entries).collect()
    start = np.array([np.frombuffer(r.packed, "<i4") for r in first], np.int64).reshape(len(first), parts, length // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds):
        books = _next_books(packed, books)
    return books


def _encode_task(books: np.ndarray):
    parts, _, d = books.shape

    def task(rows):
        for batch in rows:
            for i, m in _matrices(batch, "packed", parts * d):
                error, codes = np.zeros(len(m), np.int64), np.zeros((len(m), parts), np.uint8)
                for p in range(parts):
                    best, far = nearest(m[:, p * d : (p + 1) * d], books[p])
                    codes[:, p] = best
                    error += far
                text = codes.tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(i, len(m)), batch.column("label").slice(i, len(m)),
                     pa.array([text[k : k + step] for k in range(0, len(text), step)], pa.string()), pa.array(error)],
                    ["vec_id", "label", "code", "error"])

    return task


def encode(packed: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of packed vectors: two hex digits a part, and the squared distance to what the code
    stands for."""
    if books.shape[1] > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    kind = packed.schema["label"].dataType.simpleString()
    return packed.select("vec_id", "label", "packed").mapInArrow(
        _encode_task(books), f"vec_id long, label {kind}, code string, error long")


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, *, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row of ``vectors`` (vec_id, embedding, label)."""
    packed, length = pack(vectors, scale=scale, parts=parts)
    books = (fit_codebooks(packed, length, parts=parts, entries=entries, rounds=rounds) if length
             else np.zeros((parts, 0, 0), np.int64))
    coded = materialize(encode(packed, books), "codes")
    by_label = checked_broadcast(materialize(
        coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """The rounds written out as DuckDB SQL."""
    steps = [f"""
k as (select vec_id, label, embedding, len(embedding) // {PARTS} as d from embeddings
    where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
v as materialized (select vec_id, p::int as p, [floor({SCALE} * x::double)::bigint for x in embedding[p * d + 1 : p * d + d]] as v
    from k, range(0, {PARTS}) r(p)),
b0 as materialized (select p, e, v as c from v join (select vec_id, row_number() over (order by vec_id) - 1 as e from k
    order by vec_id limit {ENTRIES}) using (vec_id))"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
n{i} as materialized (select vec_id, p, v.v, min({{'far': list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v.v, c)])::bigint,
      'e': e}}) as near from v join b{i} using (p) group by vec_id, p, v.v)""")
        if i < ROUNDS:
            steps.append(f"""
m{i} as (select p, e, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from (
    select p, near.e as e, i, sum(x)::bigint as s, count(*) as n
    from (select p, near, unnest(v) as x, generate_subscripts(v, 1) as i from n{i}) group by all) group by p, e),
b{i + 1} as materialized (select p, e, coalesce(m{i}.c, b{i}.c) as c from b{i} left join m{i} using (p, e))""")
    final = f"""
f as (select vec_id, string_agg(printf('%02x', near.e), '' order by p) as code, sum(near.far)::bigint as error from n{ROUNDS} group by vec_id),
h as (select sha256(string_agg(x::varchar, ',' order by p, e, i)) as codebooks_sha256
    from (select p, e, unnest(c) as x, generate_subscripts(c, 1) as i from b{ROUNDS}))
select f.vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from f join k using (vec_id), h"""
    return "with" + ",".join(steps) + "," + final


ORACLE = _oracle()
