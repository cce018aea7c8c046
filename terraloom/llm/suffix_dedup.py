"""Removal of passages that occur anywhere else, by column-wise construction over aligned suffixes.

Every string of ``length`` bytes contains an anchor: the position of its least 32-byte hash, which depends on the string alone.  Equal strings
so have equal anchors at equal places, and only anchors whose hash occurs twice can lie in a repeated string.  The bytes around such
anchors are short documents, aligned at the anchor.  They are dealt out by anchor hash, and each shard is built column by column from
the right, as a collection's Burrows-Wheeler transform is: a round puts one symbol of every document before its suffix; the symbols in
the old order are that column of the transform, their stable sort is the new order of all suffixes, and the common
prefixes of neighbours follow from the least old prefix between them, plus one.  A string is repeated where the common prefix with a
neighbour reaches ``length``.  Only the current column's order and prefixes are kept, in arrays that a round reads and writes in sequence: suffixes of
different columns start at different places of their anchor and cannot be equal strings.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terraloom.llm.common import as_batch, forget, forget_stored, record_batches, shared_path, stored, text_bytes

LENGTH = 200
GRAM = 32  # bytes hashed at each position
PLACE_BITS = 24  # of a position within a segment
SEGMENT = 1 << 22  # bytes of a text searched at once
BUCKET_BYTES = 16 << 20
BATCH = 40_000  # documents of a shard built together, whole anchor groups
HOT = 50_000  # occurrences of an anchor above which its strings are counted one by one
SEND_BYTES = 4 << 20
BITS = 26  # of a slot number of the table of repeated anchors: 8 MB
BLOCK = 1 << 16  # bytes of that table sent as one
# Odd multipliers.
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))


def gram_hashes(data: bytes) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    n = len(data) - GRAM + 1
    x = words[:n] * MIX[0]
    for i in (1, 2, 3):
        x += words[8 * i: 8 * i + n] * MIX[i]
    x ^= x >> np.uint64(32)
    x *= MIX[4]
    return x ^ (x >> np.uint64(29))


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Position, first and last string start, and hash of each anchor; every start belongs to exactly one anchor."""
    found = []
    for base in range(0, max(0, len(data) - length + 1), SEGMENT):
        part = data[base: base + SEGMENT + length - 1]
        hashes = gram_hashes(part)
        mask = np.uint64((1 << PLACE_BITS) - 1)
        # Hash above, place below: the least value is the leftmost of the least hashes.
        least = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
        span, width = length - GRAM + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if span > width:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width:])
        at = (least & mask).astype(np.int64)
        opens = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        closes = np.append(opens[1:], len(at)) - 1
        found.append((at[opens] + base, opens + base, closes + base, hashes[at[opens]].view(np.int64)))
    if not found:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def without_repeats(data: bytes, found: tuple[np.ndarray, ...], length: int = LENGTH) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Anchors without those whose strings are, byte for byte, those of the anchor before, and the first and last starts of all such strings.

    A stretch of short period thus keeps one anchor for each of its parts, however long it is.
    """
    at, lo, hi, h = found
    alike = np.flatnonzero((h[1:] == h[:-1]) & (np.diff(hi - lo) == 0) & (np.diff(at - lo) == 0))
    same = [i for i in alike.tolist() if data[lo[i]: hi[i] + length] == data[lo[i + 1]: hi[i + 1] + length]]
    if not same:
        return found, lo[:0], hi[:0]
    again = np.zeros(len(at) + 1, bool)
    again[np.array(same) + 1] = True
    either = again[:-1] | again[1:]
    first, last = lo[either], hi[either]
    opens = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1] + 1]))
    return tuple(x[~again[:-1]] for x in found), first[opens], last[np.append(opens[1:], len(first)) - 1]


def repeated_starts(documents: list[bytes], places: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """(document, start) flags: whether the string from a start on is found at the same place of another document's anchor.

    ``places`` is where the anchor lies in each document.  One round per column, from the right.
    """
    before = int(places.max())
    sizes = np.array([len(d) for d in documents])
    first = before - places
    width = int((first + sizes).max())
    table = np.zeros((len(documents), width), np.uint8)
    for row, (at, document) in enumerate(zip(first.tolist(), documents, strict=True)):
        table[row, at: at + len(document)] = np.frombuffer(document, np.uint8)
    table = np.ascontiguousarray(table.T)
    end = first + sizes
    order = np.arange(len(documents))
    common = np.zeros(len(documents) + 1, np.int16)
    flags = np.zeros((len(documents), max(1, int((sizes - length).max()) + 1)), bool)
    for column in range(width - 1, -1, -1):
        present = (first <= column) & (column < end)
        symbols = np.where(present, table[column].astype(np.uint16) + 1, 0)[order]  # this column of the transform
        step = np.argsort(symbols, kind="stable")
        symbols, order = symbols[step], order[step]
        # Least old prefix between suffixes that now are neighbours.
        between = np.minimum.reduceat(common, step + 1)
        common = np.zeros(len(documents) + 1, np.int16)
        same = (symbols[1:] == symbols[:-1]) & (symbols[1:] > 0)
        common[1:-1][same] = between[:-1][same] + 1
        if column + length <= width:
            long = np.flatnonzero(np.maximum(common[:-1], common[1:]) >= length)
            rows = order[long]
            flags[rows, column - first[rows]] = True
    return flags


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of set flags."""
    padded = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    padded[:, 1:-1] = flags
    change = np.diff(padded, axis=1)
    rows, opens = np.nonzero(change == 1)
    return rows, opens, np.nonzero(change == -1)[1] - 1


def build_shard(hashes: list, contexts: list[bytes], places: list[int], length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(row, first start, last start) of repeated strings among the contexts of whole anchor groups.

    Equal contexts are one document, all of whose strings are repeated; groups with a single document need no rounds.
    """
    classes: dict[tuple, list[int]] = {}
    groups: dict[int, int] = {}
    for row, key in enumerate(zip(hashes, places, contexts, strict=True)):
        if key not in classes:
            classes[key] = []
            groups[key[0]] = groups.get(key[0], 0) + 1
        classes[key].append(row)
    open_: list[int] = []
    for key, rows in classes.items():
        if len(rows) > 1:
            for row in rows:
                yield row, 0, len(key[2]) - length
        if groups[key[0]] > 1:
            open_.append(rows[0])
    single = {rows[0] for rows in classes.values() if len(rows) == 1}
    if open_:
        flags = repeated_starts([contexts[r] for r in open_], np.array([places[r] for r in open_]), length)
        for i, first, last in zip(*(x.tolist() for x in runs(flags)), strict=True):
            if open_[i] in single:
                yield open_[i], first, last


def keyed(docs: DataFrame, text: str) -> list:
    """Columns that name a text by 92 bits of its digest, and its bytes."""
    digest = F.sha2(text_bytes(F.col(text)), 256)
    return [
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("k1"), F.conv(F.substring(digest, 16, 8), 16, 10).cast("bigint").alias("k2"),
        text_bytes(F.col(text)).alias("data")]


_TEXTS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("data", pa.binary()), ("copies", pa.int64())])


class Texts:
    """The distinct texts with their number of copies, bucketed by key in the shared folder: joins by key move the other side only."""

    def __init__(self, docs: DataFrame, text: str):
        spark = docs.sparkSession
        rows = docs.select(*keyed(docs, text))
        size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
        # Spark joins by buckets only if there are at least as many as its shuffles would have partitions.
        buckets = max(-(-size // BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.name, self.path = f"texts_{uuid.uuid4().hex}", shared_path(spark, "texts")

        def once(batches):
            """A task passes each text on once, and at its end how often it came again."""
            seen: dict[tuple, int] = {}
            for batch in batches:
                keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True))
                new = []
                for row, key in enumerate(keys):
                    if key not in seen:
                        new.append(row)
                    seen[key] = seen.get(key, 0) + 1
                kept = batch.take(pa.array(new, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([1] * len(new), pa.int64())], schema=_TEXTS)
            yield from record_batches(_TEXTS, ((*key, None, n - 1) for key, n in seen.items() if n > 1))

        parts = rows.mapInArrow(once, "k1 bigint, k2 bigint, data binary, copies bigint").repartition(buckets, "k1", "k2")
        whole = parts.groupBy("k1", "k2").agg(F.first("data", ignorenulls=True).alias("data"), F.sum("copies").alias("copies"))
        whole.write.bucketBy(buckets, "k1", "k2").options(path=self.path, compression="zstd").saveAsTable(self.name)
        self.table = spark.table(self.name)

    def forget(self) -> None:
        spark = self.table.sparkSession
        spark.sql(f"DROP TABLE {self.name}")
        forget(spark, self.path)


_ANCHORS = pa.schema([(c, pa.int64()) for c in ("k1", "k2", "h", "at", "lo", "hi")])
_CONTEXTS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("h", pa.int64()), ("place", pa.int32()), ("lo", pa.int64()), ("context", pa.binary())])
_BITS = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def all_anchors(texts: DataFrame, length: int, wanted: np.ndarray | None = None) -> DataFrame:
    """Anchors of all texts; with a table of bits only those whose hash may be wanted, and as rows without a hash the starts that repeat within a stretch."""
    sent = texts.sparkSession.sparkContext.broadcast(wanted)

    def find(batches):
        for batch in batches:
            for k1, k2, data in zip(*(batch.column(c) for c in ("k1", "k2", "data")), strict=True):
                data = data.as_py()
                (at, lo, hi, h), first, last = without_repeats(data, anchors(data, length), length)
                known = np.zeros(len(at), bool)
                if sent.value is not None:
                    kept = is_set(sent.value, slots(h))
                    at, lo, hi, h = (np.concatenate([x[kept], y]) for x, y in ((at, first), (lo, first), (hi, last), (h, np.zeros(len(first), np.int64))))
                    known = np.arange(len(at)) >= kept.sum()
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), k.as_py())) for k in (k1, k2)] + [pa.array(h, mask=known)] + [pa.array(x) for x in (at, lo, hi)],
                        schema=_ANCHORS)
    return texts.select("k1", "k2", "data").mapInArrow(find, "k1 bigint, k2 bigint, h bigint, at bigint, lo bigint, hi bigint")


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)


def is_set(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return table[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def slot_table(hashes: DataFrame) -> np.ndarray:
    """A table of bits, of fixed size, in which the slots of all hashes ``h`` are set; tasks send the blocks that they touch."""
    def mark(batches):
        table = np.zeros(1 << (BITS - 3), np.uint8)
        for batch in batches:
            at = slots(batch.column("h").to_numpy(zero_copy_only=False))
            np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
        blocks = table.reshape(-1, BLOCK)
        yield from record_batches(_BITS, [(int(b), blocks[b].tobytes()) for b in np.flatnonzero(blocks.any(axis=1))], 64)

    def merge(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("bits"), strict=True):
                part = np.frombuffer(raw.as_py(), np.uint8)
                found[block] = found[block] | part if block in found else part
        yield from record_batches(_BITS, [(b, x.tobytes()) for b, x in found.items()], 64)

    table = np.zeros(1 << (BITS - 3), np.uint8)
    marked = hashes.select("h").mapInArrow(mark, "block int, bits binary").repartition("block").mapInArrow(merge, "block int, bits binary")
    for block, raw in marked.collect():  # 8 MB at most
        table[block * BLOCK: (block + 1) * BLOCK] = np.frombuffer(raw, np.uint8)
    return table


def contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of all strings of each wanted anchor."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "at", "lo", "hi")).alias("anchors"))

    def cut(batches):
        block, size = [], 0
        for batch in batches:
            for k1, k2, data, found in zip(*(batch.column(c) for c in ("k1", "k2", "data", "anchors")), strict=True):
                k1, k2, data = k1.as_py(), k2.as_py(), data.as_py()
                for a in found.as_py():
                    part = data[a["lo"]: a["hi"] + length]
                    block.append((k1, k2, a["h"], a["at"] - a["lo"], a["lo"], part))
                    size += len(part)
                    if size > SEND_BYTES:
                        yield as_batch(_CONTEXTS, block)
                        block, size = [], 0
        if block:
            yield as_batch(_CONTEXTS, block)

    joined = texts.select("k1", "k2", "data").join(lists, ["k1", "k2"])
    return joined.mapInArrow(cut, "k1 bigint, k2 bigint, h bigint, place int, lo bigint, context binary")


def shard_spans(cuts: DataFrame, length: int, batch_size: int = BATCH) -> DataFrame:
    """``k1``, ``k2``, ``first``, ``last`` start of repeated strings; contexts are dealt out by anchor hash."""
    def build(batches):
        rows: list[list] = [[] for _ in range(6)]

        def done(upto):
            k1, k2, h, place, lo, context = (x[:upto] for x in rows)
            found = [(k1[r], k2[r], lo[r] + a, lo[r] + b) for r, a, b in build_shard(h, context, place, length)]
            for x in rows:
                del x[:upto]
            yield from record_batches(_SPANS, found)

        for batch in batches:
            for x, column in zip(rows, batch.columns, strict=True):
                x.extend(column.to_pylist())
            if len(rows[0]) >= batch_size:
                upto = len(rows[2])
                while upto and rows[2][upto - 1] == rows[2][-1]:
                    upto -= 1
                if upto:  # the last group may go on
                    yield from done(upto)
        if rows[0]:
            yield from done(len(rows[0]))

    dealt = cuts.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(build, "k1 bigint, k2 bigint, first bigint, last bigint")


def counted_spans(cuts: DataFrame, length: int) -> DataFrame:
    """The same for contexts of very frequent anchors: every string by digest, counted before and split after the shuffle."""
    strings = cuts.select("k1", "k2", "lo", "context", F.explode(F.sequence(F.lit(0), F.octet_length("context") - length)).alias("i")).select(
        "k1", "k2", (F.col("lo") + F.col("i")).alias("first"), F.unhex(F.md5(F.substring("context", F.col("i") + 1, F.lit(length)))).alias("digest"))
    # Stored, so that both sides of the join are shuffled for it and a very common string can be split.
    again = stored(strings.groupBy("digest").count().where("count > 1").select("digest"), "strings")
    return strings.join(again, "digest").select("k1", "k2", "first", F.col("first").alias("last"))


def merged(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by strings with starts in the spans."""
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


_RESULTS = pa.schema([
    ("k1", pa.int64()), ("k2", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ("kept", pa.binary())])


def distinct_results(docs: DataFrame, text: str, length: int, hot: int, batch_size: int, keep_text: bool) -> DataFrame:
    """One stored row per distinct text: its key, sizes, digest of what is kept and, on request, the kept bytes of a text that loses some."""
    texts = Texts(docs, text)
    found = all_anchors(texts.table, length)
    repeated = stored(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    # Most anchors occur once: those that the table of bits does not know stay where they are.
    near = all_anchors(texts.table, length, slot_table(repeated)).withColumn("_h", F.coalesce("h", F.xxhash64("k1", "k2", "lo")))
    matched = near.join(repeated.select(F.col("h").alias("_h"), "n"), "_h", "left").where("n IS NOT NULL OR h IS NULL").drop("_h")
    matched = stored(matched, "matched")

    def cuts(which):
        return contexts(texts.table, matched.where(F.col("h").isNotNull() & which).drop("n"), length)

    spans = shard_spans(cuts(F.col("n") <= hot), length, batch_size)
    spans = spans.unionByName(matched.where("h IS NULL").select("k1", "k2", F.col("lo").alias("first"), F.col("hi").alias("last")))
    if not repeated.where(F.col("n") > hot).isEmpty():
        spans = spans.unionByName(counted_spans(cuts(F.col("n") > hot), length))
    lists = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def remove(batches):
        for batch in batches:
            block, size = [], 0
            for k1, k2, data, copies, spans in zip(*(batch.column(c) for c in ("k1", "k2", "data", "copies", "spans")), strict=True):
                data = data.as_py()
                if copies.as_py() > 1 and len(data) >= length:
                    gone = [(0, len(data))]
                else:
                    gone = merged([(s["first"], s["last"]) for s in spans.as_py() or ()], length)
                cuts = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join([data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)])
                block.append((
                    k1.as_py(), k2.as_py(), len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if keep_text and gone else None))
                size += len(kept) if keep_text and gone else 0
                if size > SEND_BYTES:
                    yield as_batch(_RESULTS, block)
                    block, size = [], 0
            yield as_batch(_RESULTS, block)

    joined = texts.table.join(lists, ["k1", "k2"], "left").select("k1", "k2", "data", "copies", "spans")
    results = stored(joined.mapInArrow(
        remove, "k1 bigint, k2 bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"), "kept")
    texts.forget()
    forget_stored(repeated), forget_stored(matched)
    return results


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT, batch_size: int = BATCH,
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every document.

    A byte goes if it lies in a string of ``length`` bytes that starts anywhere else too, in this or another document; strings are those of the input,
    and no occurrence is spared.  A null text is empty; texts shorter than ``length`` stay whole; rows with equal texts, repeated rows included,
    lose everything if long enough; null keys are kept; no documents give no rows.
    """
    results = distinct_results(docs, text, length, hot, batch_size, False).drop("kept")
    named = docs.select(F.col(key).alias("_key"), *keyed(docs, text)[:2])
    return named.join(results, ["k1", "k2"]).select(F.col("_key").alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeated_passages(
    docs: DataFrame, text: str = "text", chars: str = "n_chars", length: int = LENGTH, hot: int = HOT, batch_size: int = BATCH,
) -> DataFrame:
    """The documents with their texts cut; bytes of a character cut in two go with it, and ``chars`` is counted anew where it exists.

    A text that loses nothing stays as it is, null texts included.
    """
    results = distinct_results(docs, text, length, hot, batch_size, True).where("n_removed > 0").select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("kept").alias("_kept"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(f"_{n}") for c, n in zip(keyed(docs, text), ("k1", "k2"))])
    joined = row.join(results, ["_k1", "_k2"], "left").withColumn("_cut", F.when(F.col("_kept").isNotNull(), F.try_validate_utf8(F.col("_kept").cast("string"))))
    whole = F.coalesce("_cut", F.regexp_replace(F.make_valid_utf8(F.col("_kept").cast("string")), "�", ""))
    columns = []
    for c in docs.columns:
        value = F.col(f"_row.`{c}`")
        if c == text:
            value = F.when(F.col("_kept").isNull(), value).otherwise(whole)
        elif c == chars:
            value = F.when(F.col("_kept").isNull(), value).otherwise(F.char_length(whole).cast(docs.schema[c].dataType))
        columns.append(value.alias(c))
    return joined.select(*columns)
