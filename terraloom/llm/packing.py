"""Packing token sequences by patterns of few documents, fitted to the length histogram.

Documents become pieces of at most ``capacity`` tokens.  From the histogram of piece lengths, which has at most ``capacity`` entries,
all patterns of up to three lengths that fill a sequence exactly get repeat counts by non-negative least squares; the counts
are rounded to what the histogram holds, and what remains is packed best-fit, longest first, on counts of equal lengths.  The
plan is a list of sequence kinds with their numbers; pieces find their place by their rank among those of equal length.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from terraloom.llm.common import record_batches, stored, text_bytes

CAPACITY = 2048
END_ID = 0
STEPS = 400  # of the projected gradient
CACHED_WORDS = 800_000  # per generation of a worker's word cache
LONG_WORD = 200  # bytes; longer words are not cached
WORD_END = "</w>"  # fixed values: the vocabulary's mark of a word end, and stops that end a run of letters
STOPS = ".,;:!?"
RANKED_ROWS = 100_000  # pieces ranked together, roughly


class WordIds:
    """Token ids of words, as little-endian 32-bit bytes.

    The vocabulary's normaliser, splitter and added tokens never look across white space, so a text's ids are those of its words in a
    row.  An added token that a word spells out is that token, as the plain call of the tokenizer has it.
    Words of letters, with at most one stop behind them, are encoded in one call: every run of letters or stops ends with a
    token that is marked as a word end, which tells the words apart again.  Two generations of at most ``CACHED_WORDS`` words
    bound the cache, which lives as long as its worker.
    """

    _shared: dict[str, WordIds] = {}

    @classmethod
    def shared(cls, path: str) -> WordIds:
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # spares the search for added tokens in words that hold none
        self.added = [token.content for token in self.plain.get_added_tokens_decoder().values()]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(WORD_END)]] = True
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode(self, words: list[str], tokenizer=None) -> list[bytes]:
        return [array("I", one.ids).tobytes() for one in (tokenizer or self.tokenizer).encode_batch_fast(words, add_special_tokens=False)]

    def _encode_plainly(self, words: list[str]) -> list[bytes]:
        return self._encode(words, self.plain)

    def _encode_together(self, words: list[str], runs: list[int]) -> list[bytes]:
        """Ids of words made of so many runs each; each run has one word end at least, so a total that fits fits everywhere."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != sum(runs) or ends[-1] != len(ids):
            return self._encode(words)
        cuts = ends[np.cumsum(runs) - 1].tolist()
        raw = ids.tobytes()
        return [raw[4 * a: 4 * b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that the young generation lacks."""
        found, simple, runs, others, marked = {}, [], [], [], []
        for word in words:
            ids = self.old.get(word)
            if ids is not None:
                found[word] = self.young[word] = ids
                continue
            text = word.decode("utf-8", "replace")
            if text.isalpha():
                simple.append((word, text)), runs.append(1)
            elif text[-1] in STOPS and text[:-1].isalpha():
                simple.append((word, text)), runs.append(2)
            else:
                (marked if any(token in text for token in self.added) else others).append((word, text))
        for group, encode in ((simple, lambda texts: self._encode_together(texts, runs)), (others, self._encode), (marked, self._encode_plainly)):
            if group:
                for (word, _), ids in zip(group, encode([text for _, text in group]), strict=True):
                    found[word] = ids
                    if len(word) <= LONG_WORD:
                        self.young[word] = ids
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        return found

    def text_ids(self, data: bytes) -> bytes:
        words = data.split()
        ids = list(map(self.young.get, words))
        if None in ids:
            found = self.learn({word for word, known in zip(words, ids, strict=True) if known is None})
            ids = [found[word] if known is None else known for word, known in zip(words, ids, strict=True)]
        return b"".join(ids)


_PIECES = pa.schema([("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``start``, ``length`` and the CRC-32 of its ids."""
    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = WordIds.shared(vocabulary)
        end = array("I", [END_ID]).tobytes()

        def rows():
            for batch in batches:
                for name, data in zip(batch.column("key").to_pylist(), batch.column("data"), strict=True):
                    ids = words.text_ids(data.as_py()) + end
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at: at + 4 * capacity]
                        yield name, number, at // 4, len(part) // 4, zlib.crc32(part)

        yield from record_batches(_PIECES, rows())

    rows = docs.select(F.col(key).cast("bigint").alias("key"), text_bytes(F.col(text)).alias("data"))
    return rows.mapInArrow(cut, "key bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All (a, b, c) with a >= b >= c that sum to the capacity and whose non-zero parts are among the lengths."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    found = []
    for a in lengths[lengths * 3 >= capacity]:
        b = np.arange((capacity - a + 1) // 2, min(a, capacity - a) + 1)
        c = capacity - a - b
        good = there[b] & there[c] & (c <= b)
        found.append(np.stack([np.full(good.sum(), a), b[good], c[good]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), int)


def fit_repeats(rows: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 with the least squares of weighted (A x - counts), by accelerated projected gradient.

    A pattern's column of A counts its lengths; an error is weighted by its length, so that few tokens stay over.
    """
    size = len(counts)
    weight = np.arange(size) / (size - 1)
    square = weight**2

    def forward(x):
        return sum(np.bincount(rows[:, i], x, size) for i in range(3))

    def back(r):
        return sum((square * r)[rows[:, i]] for i in range(3))

    v = np.ones(len(rows))
    for _ in range(20):  # largest eigenvalue of the normal matrix
        v = back(forward(v))
        norm = np.linalg.norm(v)
        if norm == 0:
            return np.zeros(len(rows))
        v /= norm
    rate = 0.9 / norm
    x = y = np.zeros(len(rows))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - rate * back(forward(y) - counts))
        momentum, before = (1 + np.sqrt(1 + 4 * momentum**2)) / 2, momentum
        y = new + (before - 1) / momentum * (new - x)
        x = new
    return x


def pattern_kinds(counts: np.ndarray, capacity: int) -> tuple[list[tuple[tuple, int]], np.ndarray]:
    """Sequence kinds from fitted patterns, and the counts that remain."""
    left = counts.copy()
    kinds = []
    rows = patterns(np.flatnonzero(counts), capacity)
    if len(rows):
        x = fit_repeats(rows, counts.astype(float))
        order = np.argsort(-x, kind="stable")
        # Rounded counts first; then whatever still fits exactly.
        for wanted in (np.floor(x + 0.5), np.full(len(rows), np.inf)):
            for at in order:
                if wanted[at] < 1:
                    continue
                need = defaultdict(int)
                for length in rows[at]:
                    if length:
                        need[int(length)] += 1
                repeats = int(min(wanted[at], min(left[n] // m for n, m in need.items())))
                if repeats:
                    for n, m in need.items():
                        left[n] -= repeats * m
                    kinds.append((tuple(need.items()), repeats))
    return kinds, left


def best_fit_kinds(counts: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best-fit decreasing on counts: sequences of equal content are one entry."""
    open_: dict[int, list] = defaultdict(list)  # free tokens -> [content, number]
    spaces = np.zeros(capacity + 1, np.int64)  # number of sequences by free tokens

    def put(free, content, number):
        open_[free].append((content, number))
        spaces[free] += number

    for length in np.flatnonzero(counts)[::-1].tolist():
        count = int(counts[length])
        while count:
            roomy = np.flatnonzero(spaces[length:])
            if not len(roomy):
                break
            free = length + int(roomy[0])
            content, number = open_[free].pop()
            spaces[free] -= number
            each = min(free // length, max(1, count // number))
            used = min(number, count // each)
            put(free - each * length, (*content, (length, each)), used)
            if number > used:
                put(free, content, number - used)
            count -= used * each
        each = capacity // length
        if count // each:
            put(capacity - each * length, ((length, each),), count // each)
        if count % each:
            put(capacity - count % each * length, ((length, count % each),), 1)
    return [kind for group in open_.values() for kind in group]


def plan(counts: np.ndarray) -> list[tuple[tuple, int]]:
    """Sequence kinds ((length, times), ...) and their numbers, for counts by length; every piece has a place."""
    capacity = len(counts) - 1
    kinds, left = pattern_kinds(counts, capacity)
    return kinds + best_fit_kinds(left, capacity)


def places(kinds: list[tuple[tuple, int]], capacity: int) -> dict[int, np.ndarray]:
    """By length, in order of rank: first rank, pieces per sequence, first sequence and offset of each kind it occurs in."""
    out: dict[int, list] = defaultdict(list)
    ranks, sequence = np.zeros(capacity + 1, np.int64), 0
    for content, number in kinds:
        offset = 0
        for length, times in content:
            out[length].append((ranks[length], times, sequence, offset))
            ranks[length] += times * number
            offset += length * times
        sequence += number
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def ranked(table: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 among the pieces of one length; a common length is ranked in many parts."""
    parts = max(64, table.count() // RANKED_ROWS)
    table = table.withColumn("part", F.pmod(F.xxhash64("key", "piece"), F.lit(parts)))
    sizes = table.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "part").orderBy("key", "piece", "start", "ids_crc32")
    numbered = table.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(starts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("at")).drop("first", "at", "part")


_PLACED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece.

    A null or empty text is the end id alone; rows with a null or repeated key are packed one by one like all others; no documents give no
    rows.  The driver sees the histogram of lengths only.  The plan holds at most one entry per fitted pattern and
    a few per length, however many documents there are, and is sent to the tasks.
    """
    table = stored(pieces(docs, vocabulary, key, text, capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in table.groupBy("length").count().collect():
        counts[length] = n
    where = docs.sparkSession.sparkContext.broadcast(places(plan(counts), capacity))

    def place(batches):
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequences, offsets = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                spots = where.value[int(length)]
                spot = spots[np.searchsorted(spots[:, 0], ranks[rows], "right") - 1]
                inside = ranks[rows] - spot[:, 0]
                sequences[rows] = spot[:, 2] + inside // spot[:, 1]
                offsets[rows] = spot[:, 3] + inside % spot[:, 1] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in _PIECES), pa.array(sequences), pa.array(offsets)], schema=_PLACED)

    kind = "key bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    placed = ranked(table).select(*(f.name for f in _PIECES), "rank").mapInArrow(place, kind)
    return placed.withColumnRenamed("key", key)
