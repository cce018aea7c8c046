"""SimHash near-duplicates: 64-bit fingerprints linked within a few differing bits, found with vantage-point trees.

The distinct fingerprints are cut into shards by a tree over a bounded sample: a node holds a vantage point and a radius, and
a fingerprint goes inside or outside by its Hamming distance to that point.  By the triangle inequality only a fingerprint
whose distance lies within the link distance of the radius can have a partner on the other side; such a one is sent there too,
as a guest.  A shard is searched the same way, shell by shell around vantage points of its own, and returns a spanning forest of its
links, so a dense group never unfolds into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from terraloom.llm.common import hashed_sample, stored, text_bytes
from terraloom.llm.graph import components

WIDTH = 3  # words of a shingle
DISTANCE = 2  # differing bits up to which fingerprints are linked
SEED = 42
SHARD = 20_000  # distinct fingerprints aimed at per shard
SAMPLE_PER_SHARD = 64
MOST_SAMPLED = 1_000_000  # bound of the sample the tree is built on
PART = 16_384  # shingles unpacked at once
PAIRS = 1 << 22  # comparisons above which a shard is divided further


def fingerprint(data: bytes, width: int = WIDTH, seed: int = SEED) -> bytes:
    """Fingerprint of a text as 8 bytes, most significant first; a text without words has fingerprint zero."""
    words = data.lower().split()  # of bytes: lowers A-Z only, cuts at ASCII white space only
    if not words:
        return bytes(8)
    if len(words) < width:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_digest
    packed = np.frombuffer(b"".join([digest(s, seed) for s in shingles]), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(packed), PART):
        ones += np.unpackbits(packed[at: at + PART], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(packed)).tobytes()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``key``, md5 ``digest`` of the text and signed 64-bit ``fp`` of every document."""
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.md5(text_bytes(F.col(text))).alias("digest"), text_bytes(F.col(text)).alias("data"))

    def run(batches):
        for batch in batches:
            raw = b"".join([fingerprint(d.as_py(), width) for d in batch.column("data")])
            fps = np.frombuffer(raw, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("digest"), pa.array(fps)], names=["key", "digest", "fp"])

    return rows.mapInArrow(run, "key bigint, digest string, fp bigint")


def distances(values: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint64(point)).astype(np.int64)


class Tree:
    """Vantage points, radii and children as arrays; child -1-i is shard i."""

    def __init__(self, sample: np.ndarray, shards: int, distance: int):
        self.points, self.radii, self.inside, self.outside, self.shards, self.distance = [], [], [], [], 0, distance
        self.top = self._grow(sample, shards, np.random.default_rng(SEED))

    def _grow(self, sample: np.ndarray, shards: int, random) -> int:
        split = self._split(sample, random) if shards > 1 else None
        if split is None:
            self.shards += 1
            return -self.shards
        point, radius, within = split
        node = len(self.points)
        self.points.append(point), self.radii.append(radius), self.inside.append(0), self.outside.append(0)
        self.inside[node] = self._grow(sample[within], shards // 2, random)
        self.outside[node] = self._grow(sample[~within], shards - shards // 2, random)
        return node

    def _split(self, sample: np.ndarray, random):
        """Of a few vantage points, the one whose middle radii leave the fewest fingerprints on the boundary.

        Where no radius is near the middle, the most even one that leaves both sides something.
        """
        best = None
        for point in sample[random.integers(0, len(sample), 8)] if len(sample) > 1 else ():
            far = distances(sample, point)
            counts = np.bincount(far, minlength=65 + self.distance)
            below = np.cumsum(counts) / len(sample)
            for radius in np.flatnonzero(below[:64] < 1):
                uneven = max(0.0, abs(below[radius] - 0.5) - 0.2)
                cost = (uneven, counts[radius + 1: radius + 1 + self.distance].sum())
                if best is None or cost < best[0]:
                    best = (cost, point, int(radius), far <= radius)
        return best and best[1:]

    def route(self, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, indices, home) of all copies: each value once at home, and as a guest wherever a partner may be."""
        stack = [(self.top, np.arange(len(values)), np.ones(len(values), bool))]
        while stack:
            node, rows, home = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -1 - node, rows, home
                continue
            far, radius = distances(values[rows], self.points[node]), self.radii[node]
            # Two values at home on different sides meet inside, so nothing at home inside has to go out.
            into = far <= radius + self.distance
            out = np.where(home, far > radius, far > radius - self.distance)
            stack.append((self.inside[node], rows[into], (home & (far <= radius))[into]))
            stack.append((self.outside[node], rows[out], home[out]))


class Forest:
    """Union of groups over small arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up


def search(values: np.ndarray, members: np.ndarray, guests: np.ndarray, distance: int, forest: Forest, depth: int = 0) -> None:
    """Unite all values within the distance; ``members`` and ``guests`` index values, guests are only compared with members."""
    asked = np.concatenate([members, guests])
    if len(members) * len(asked) > PAIRS and depth < 4:
        point = values[members[len(members) // 2]]
        near, far = distances(values[members], point), distances(values[asked], point)
        shells = np.unique(near)
        if len(shells) > 1:
            for shell in shells:
                own = near == shell
                # A pair in two shells is found from the inner one.
                reach = (far >= shell) & (far <= shell + distance)
                reach[: len(members)] &= ~own
                reach[len(members):] = np.abs(far[len(members):] - shell) <= distance
                search(values, members[own], asked[reach], distance, forest, depth + 1)
            return
    step = max(1, PAIRS // max(1, len(members)))
    for at in range(0, len(asked), step):
        some = asked[at: at + step]
        left, right = np.nonzero(np.bitwise_count(values[some][:, None] ^ values[members][None, :]) <= distance)
        forest.unite(some[left], members[right])


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def links(distinct: DataFrame, distance: int = DISTANCE, shard: int = SHARD) -> DataFrame:
    """Edges ``a``, ``b`` that connect the same fingerprints ``fp`` as all pairs within the distance do."""
    spark = distinct.sparkSession
    shards = max(1, -(-distinct.count() // shard))
    size = min(MOST_SAMPLED, shards * SAMPLE_PER_SHARD) if shards > 1 else 0  # a single shard needs no tree
    sample = hashed_sample(distinct.select("fp"), "fp", size).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(Tree(sample, shards, distance))

    def route(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for leaf, rows, home in tree.value.route(values):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), leaf, np.int32)), pa.array(values[rows].view(np.int64)), pa.array(home)], names=["shard", "fp", "home"])

    def within(table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy()
        forest = Forest(len(values))
        search(values, np.flatnonzero(home), np.flatnonzero(~home), distance, forest)
        linked = np.flatnonzero(forest.parent != np.arange(len(values)))
        signed = values.view(np.int64)
        return pa.Table.from_arrays([pa.array(signed[linked]), pa.array(signed[forest.parent[linked]])], schema=_LINKS)

    routed = distinct.select("fp").mapInArrow(route, "shard int, fp bigint, home boolean")
    return routed.groupBy("shard").applyInArrow(within, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, distance: int = DISTANCE, shard: int = SHARD,
) -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest key reachable), ``digest``, ``root``.

    A null text counts as empty, and texts without words share fingerprint zero, which links like any other.  Rows with a null
    key belong to their component but never name it, unless it has no other; repeated rows are returned as often as they come;
    no documents give no rows.  Equal fingerprints are grouped before the search, whatever their number.
    """
    marked = stored(fingerprints(docs, key, text, width), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("key").alias("first")), "simhash-distinct")
    roots = components(links(distinct, distance, shard))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "simhash-roots")
    least = stored(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    named = stored(named.select("fp", "root").join(least, "root"), "simhash-components")
    return marked.join(named, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "digest", "root")


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with one of each component: that with the smallest key, and of repeated rows one."""
    found = stored(near_duplicates(docs, key, text, **options), "simhash-found").withColumn("_key", F.col(key).cast("bigint"))
    order = F.struct(F.col("_key").isNull(), F.col("_key"), F.col("digest"))
    kept = stored(
        found.groupBy("root").agg(F.min(order).alias("one"))
        .select(F.col("one._key").alias("_kept"), F.col("one.digest").alias("_digest")), "simhash-kept")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col(key).cast("bigint").alias("_key"), F.md5(text_bytes(F.col(text))).alias("_text"))
    rows = rows.join(kept, F.col("_key").eqNullSafe(F.col("_kept")) & (F.col("_text") == F.col("_digest")), "left_semi")
    if not found.groupBy("_key", "digest").count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates(["_key", "_text"])
    return rows.select("_row.*")
