"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers.  A block of rows keeps one bitmap per attribute and bit.  For a query, the high slices are
added up with bitmap arithmetic (carry-save adders, weights by shifting), which gives every row's score from below with a known
error; the k-th best of these sums is found from the most significant slice downward, and the rows that the error leaves open are
resolved by exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

BLOCK = 8192  # rows of an index block
CHUNK = 2048  # queries that meet a block at once
LOW_BITS = 4  # slices left out of the sums
LIMIT = 2**57  # of quantised components; scores of up to 2048 such fit into 38 digits
LONGS = (-(2**63), 2**63 - 1)

BLOCKS = "block int, dim int, ids binary, values binary, slices binary, bits int, low bigint"
QUERIES = "dim int, q_ids binary, q_values binary"
FOUND = "query_id bigint, vec_id bigint, score decimal(38,0)"


def quantised(vectors: DataFrame, key: str, vector: str, unit: int) -> DataFrame:
    """``id`` and integer ``values``; vectors that are null, hold null, non-finite or boundless components, or lack an id drop out."""
    x = F.col(vector).cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float(LIMIT // unit))))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(F.coalesce(sound, F.lit(False))).select(
        F.col(key).cast("bigint").alias("id"), F.transform(x, lambda v: F.floor(v * F.lit(float(unit))).cast("bigint")).alias("values"))


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """All rows of a task as (dimension, ids, matrix)."""
    parts: dict[int, list] = {}
    for batch in batches:
        ids, lists = batch.column("id").to_numpy(zero_copy_only=False), batch.column("values")
        flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.offsets)
        starts, sizes = ends[:-1] - ends[0], np.diff(ends)
        for dim in np.unique(sizes):
            rows = np.flatnonzero(sizes == dim)
            parts.setdefault(int(dim), []).append((ids[rows], flat[starts[rows][:, None] + np.arange(dim)]))
    for dim, found in parts.items():
        yield dim, np.concatenate([i for i, _ in found]), np.concatenate([m for _, m in found])


def slice_block(matrix: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Bitmaps (dim, bit, word) of the values above the block's lowest value, number of bits, lowest value."""
    low = int(matrix.min(initial=0))
    above = (matrix - low).T.astype(np.int64)
    bits = max(1, int(above.max(initial=0)).bit_length())
    rows = np.zeros((above.shape[0], -(-above.shape[1] // 64) * 64), np.int64)
    rows[:, : above.shape[1]] = above
    planes = [np.packbits((rows >> b & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64) for b in range(bits)]
    return np.stack(planes, axis=1), bits, low


def _packed(matrix: np.ndarray) -> bytes:
    """Four bytes a component where they suffice, else eight."""
    return matrix.astype(np.int32 if np.abs(matrix).max(initial=0) < 2**31 else np.int64).tobytes()


def _unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.int64 if dim and len(data) == 8 * rows * dim else np.int32).reshape(rows, dim).astype(np.int64)


def index_blocks(vectors: DataFrame, blocks: int) -> DataFrame:
    """The index: one row per block and dimension, every vector in exactly one."""
    def build(batches):
        block = TaskContext.get().partitionId()
        for dim, ids, matrix in _by_dim(batches):
            order = np.argsort(ids, kind="stable")
            ids, matrix = ids[order], matrix[order]
            slices, bits, low = slice_block(matrix)
            yield pa.RecordBatch.from_pylist([{
                "block": block, "dim": dim, "ids": ids.astype(np.int64).tobytes(), "values": _packed(matrix),
                "slices": slices.tobytes(), "bits": bits, "low": low}], schema=_BLOCK_SCHEMA)
    return vectors.repartition(blocks).mapInArrow(build, BLOCKS)


_BLOCK_SCHEMA = pa.schema([
    ("block", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("values", pa.binary()), ("slices", pa.binary()),
    ("bits", pa.int32()), ("low", pa.int64())])
_QUERY_SCHEMA = pa.schema([("dim", pa.int32()), ("q_ids", pa.binary()), ("q_values", pa.binary())])
_FOUND_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0))])


def query_chunks(vectors: DataFrame, chunks: int) -> DataFrame:
    def pack(batches):
        for dim, ids, matrix in _by_dim(batches):
            yield pa.RecordBatch.from_pylist(
                [{"dim": dim, "q_ids": ids.astype(np.int64).tobytes(), "q_values": _packed(matrix)}], schema=_QUERY_SCHEMA)
    return vectors.repartition(chunks).mapInArrow(pack, QUERIES)


def add_bitmaps(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Add stacks of bitmaps, each worth 2**weight per set bit; returns one bitmap per bit of the sums."""
    out, weight = [], 0
    while columns:
        stack = np.concatenate(columns.pop(weight)) if weight in columns else None
        if stack is None:
            out.append(None)
        else:
            while len(stack) > 1:
                third = len(stack) // 3
                if third:  # full adders on three bitmaps each
                    a, b, c = stack[:third], stack[third: 2 * third], stack[2 * third: 3 * third]
                    half = a ^ b
                    carry, stack = (a & b) | (half & c), np.concatenate([half ^ c, stack[3 * third:]])
                else:
                    carry, stack = stack[:1] & stack[1:], stack[:1] ^ stack[1:]
                columns.setdefault(weight + 1, []).append(carry)
            out.append(stack[0])
        weight += 1
    return out


def scaled_sums(slices: np.ndarray, bits: int, query: np.ndarray, low_bits: int) -> tuple[list, int]:
    """Bit slices of the sum of |q| times the high part of each attribute, and the most that the true sum lies above it."""
    shift = min(low_bits, bits - 1)
    size = np.abs(query).astype(np.int64)
    used = slices[:, shift:bits]
    flipped = np.where((query < 0)[:, None, None], ~used, used)
    columns: dict[int, list] = {}
    for power in range(int(size.max()).bit_length()):
        chosen = flipped[(size >> power & 1) == 1]
        if len(chosen):
            for bit in range(chosen.shape[1]):
                columns.setdefault(power + bit, []).append(chosen[:, bit])
    return add_bitmaps(columns), sum(size.tolist()) * ((1 << shift) - 1), shift


def top_value(planes: list, alive: np.ndarray, k: int) -> int:
    """The k-th largest sum among the rows of ``alive``, found from the most significant slice downward; 0 if there are fewer."""
    if int(np.bitwise_count(alive).sum()) <= k:
        return 0
    value, better, open_ = 0, 0, alive
    for weight in range(len(planes) - 1, -1, -1):
        ones = open_ & planes[weight] if planes[weight] is not None else np.zeros_like(open_)
        n = int(np.bitwise_count(ones).sum())
        if better + n >= k:
            open_, value = ones, value | 1 << weight
        else:
            better, open_ = better + n, open_ & ~ones
    return value


def at_least(planes: list, alive: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the rows whose sum is ``value`` or more."""
    if value <= 0:
        return alive
    more, same = np.zeros_like(alive), alive
    for weight in range(max(len(planes), value.bit_length()) - 1, -1, -1):
        plane = planes[weight] if weight < len(planes) and planes[weight] is not None else np.zeros_like(alive)
        if value >> weight & 1:
            same = same & plane
        else:
            more, same = more | (same & plane), same & ~plane
    return more | same


def search_block(ids, matrix, slices, bits, query_id, query, k, low_bits=LOW_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact scores of the k best rows of a block, best first, ties to the smaller id; the query's own rows stay out."""
    n = len(ids)
    alive = np.zeros(slices.shape[2] * 64, np.uint8)
    alive[:n] = ids != query_id
    alive = np.packbits(alive, bitorder="little").view(np.uint64)
    if query.any():
        planes, error, shift = scaled_sums(slices, bits, query, low_bits)
        scaled_error = -(-error // (1 << shift))  # in units of the lowest slice that was added
        floor = top_value(planes, alive, k) - scaled_error
        alive = at_least(planes, alive, floor)
    rows = np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little"))
    most = bits + int(np.abs(query).max(initial=0)).bit_length() + len(query).bit_length() + 1
    if most + int(np.abs(matrix).max(initial=0)).bit_length() - bits < 63:
        scores = matrix[rows].astype(np.int64) @ query.astype(np.int64)
    else:  # whole numbers of any size
        scores = matrix[rows].astype(object) @ query.astype(object)
    best = sorted(range(len(rows)), key=lambda i: (-scores[i], ids[rows[i]]))[:k] if scores.dtype == object else np.lexsort((ids[rows], -scores))[:k]
    return ids[rows][best], scores[best]


def top_k(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 10, unit: int = 1024,
    block: int = BLOCK, chunk: int = CHUNK,
) -> DataFrame:
    """The k vectors with the highest integer inner product for each query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    ``queries`` has the columns of ``vectors``.  Components are floor(unit * x).  Vectors without an id, and null ones or such with null,
    non-finite or boundless (2^57 and more) components take no part on either side; a score that a 64-bit number cannot hold counts as it is
    and is shown as the nearest one that it can; empty vectors score 0 with each other; only vectors of one length are compared; a vector never finds its own id, repeated rows included; repeated
    rows of another id are found as often as they occur; equal scores go to the smaller id; no vectors or no queries give no rows.
    Index blocks and query chunks of bounded size are paired, and each pair returns at most k rows a query.
    """
    sound, asked = quantised(vectors, key, vector, unit), quantised(queries, key, vector, unit)
    blocks = max(1, -(-sound.count() // block))
    chunks = max(1, -(-asked.count() // chunk))
    everywhere = query_chunks(asked, chunks).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = index_blocks(sound, blocks).join(everywhere, ["block", "dim"])

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                dim, ids = row["dim"], np.frombuffer(row["ids"], np.int64)
                matrix = _unpacked(row["values"], len(ids), dim)
                slices = np.frombuffer(row["slices"], np.uint64).reshape(dim, row["bits"], -(-len(ids) // 64))
                asked_ids = np.frombuffer(row["q_ids"], np.int64)
                asked_values = _unpacked(row["q_values"], len(asked_ids), dim)
                for query_id, query in zip(asked_ids, asked_values, strict=True):
                    found, scores = search_block(ids, matrix, slices, row["bits"], query_id, query, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), query_id)), pa.array(found), pa.array([Decimal(int(x)) for x in scores], pa.decimal128(38, 0))], schema=_FOUND_SCHEMA)

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        pairs.mapInArrow(search, FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.greatest(
            F.lit(LONGS[0]), F.least(F.lit(LONGS[1]), F.col("score"))).cast("bigint").alias("score"))
    )


ORACLE = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 10"""
