"""Language identification: scripts narrow the candidates, and a Viterbi path over word scores labels spans.

A language's model is the distribution of hashed letter trigrams within words, counted over all labelled training documents, and the share
of each script among its words.  A word scores only for the languages that use its script.  The best path through a document's
words pays a penalty for each change of language, so that single odd words do not break a span.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.llm.common import text_bytes

BUCKETS = 1 << 15
SMOOTHING = 0.5
SCRIPT_SHARE = 0.002  # of a language's words; below it the language is no candidate for the script
BARRED = -60.0  # score of a word for a language that is no candidate
SWITCH = 8.0  # penalty of a change of language, in nats
HELD_OUT = (4, 2)  # modulus and remainder of the documents that are not learnt from
COUNTED_WORDS = 200_000  # distinct words counted before they are turned into trigrams
CACHED_WORDS = 300_000
PATH_WORDS = 400_000  # words whose paths are sought together
UNKNOWN = "und"

# First code points of blocks of letters, by script; everything below the first is Latin.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0780, "Thaana"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Other"), (0x3400, "Han"), (0xA000, "Other"),
    (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF00, "Other"),
    (0x20000, "Han"),
)
_FIRST = [first for first, _ in SCRIPTS]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_ID = {name: i for i, name in enumerate(SCRIPT_NAMES)}


def held_out(key: Column, fold: tuple[int, int] = HELD_OUT) -> Column:
    """Whether a document is kept out of training; one without a key always is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % fold[0] == fold[1], F.lit(True))


def letters(word: bytes) -> str:
    """The word's letters in lower case."""
    text = word.decode("utf-8", "replace").lower()
    return text if text.isalpha() else "".join([c for c in text if c.isalpha()])


def script(word: str) -> int:
    return _SCRIPT_ID[SCRIPTS[bisect_right(_FIRST, ord(word[0])) - 1][1]]


def trigrams(word: str) -> list[int]:
    """Buckets of the trigrams of a word with its ends marked."""
    marked = f"^{word}$"
    hashed = zlib.crc32
    return [hashed(marked[i:i + 3].encode()) % BUCKETS for i in range(len(marked) - 2)]


_COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts by language (buckets from 0), and word counts by script (below 0), of one task."""
    totals: dict[str, np.ndarray] = {}
    words: dict[str, Counter] = {}

    def turn():
        for lang, counter in words.items():
            table = totals.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
            for word, n in counter.items():
                if plain := letters(word):
                    for bucket in trigrams(plain):
                        table[bucket] += n
                    table[BUCKETS + script(plain)] += n
            counter.clear()

    for batch in batches:
        for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data"), strict=True):
            words.setdefault(lang, Counter()).update(data.as_py().split())
            if sum(map(len, words.values())) > COUNTED_WORDS:
                turn()
    turn()
    for lang, table in totals.items():
        there = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(there)), pa.array(np.where(there < BUCKETS, there, BUCKETS - 1 - there).astype(np.int32)), pa.array(table[there])],
            schema=_COUNTS)


class Model:
    """Languages in order, log-probabilities (trigram, language) and, by script, the scores that bar languages."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        place = {lang: i for i, lang in enumerate(self.langs)}
        grams = np.zeros((BUCKETS, len(self.langs)))
        scripts = np.zeros((len(SCRIPT_NAMES), len(self.langs)))
        for lang, bucket, n in rows:
            if bucket >= 0:
                grams[bucket, place[lang]] = n
            else:
                scripts[-1 - bucket, place[lang]] = n
        self.grams = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)
        common = scripts >= SCRIPT_SHARE * scripts.sum(axis=0)
        known = common.any(axis=1, keepdims=True)
        self.bars = np.where(common | ~known, 0.0, BARRED).astype(np.float32)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Counts over every labelled document that is not held out."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key))).select(
        F.col(lang).alias("lang"), text_bytes(F.col(text)).alias("data"))
    counts = rows.mapInArrow(count_features, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return Model([tuple(r) for r in counts.collect()])


class WordScores:
    """Scores and letter counts of words, remembered up to a bound; entry 0 is a word without letters."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.places: dict[bytes, int] = {}
        self.scores = np.zeros((1024, len(self.model.langs)), np.float32)
        self.letters = np.zeros(1024, np.int64)
        self.used = 1

    def lookup(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.places.get, words))
        if None in found:
            self._learn({w for w, f in zip(words, found, strict=True) if f is None})
            found = [self.places[w] if f is None else f for w, f in zip(words, found, strict=True)]
        return np.array(found, np.int64)

    def _learn(self, words: set[bytes]) -> None:
        named = []
        for word in words:
            if plain := letters(word):
                named.append((word, plain))
            else:
                self.places[word] = 0
        if not named:
            return
        need = self.used + len(named)
        if need > len(self.scores):
            more = max(need, 2 * len(self.scores)) - len(self.scores)
            self.scores = np.concatenate([self.scores, np.zeros((more, self.scores.shape[1]), np.float32)])
            self.letters = np.concatenate([self.letters, np.zeros(more, np.int64)])
        grams = [trigrams(plain) for _, plain in named]
        starts = np.cumsum([0] + [len(g) for g in grams[:-1]])
        flat = np.array([b for g in grams for b in g])
        sums = np.add.reduceat(self.model.grams[flat], starts, axis=0)
        rows = slice(self.used, need)
        self.scores[rows] = sums + self.model.bars[[script(plain) for _, plain in named]]
        self.letters[rows] = [len(plain) for _, plain in named]
        for place, (word, _) in enumerate(named, self.used):
            self.places[word] = place
        self.used = need


def best_paths(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Language of each word on the best path of its document; documents advance side by side, a word at a time.

    ``scores`` is (word, language), document i holds ``sizes[i]`` words from ``starts[i]`` on.  Ties stay in the language, or go to the first one.
    """
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left")  # documents with a word at step t
    path = np.zeros(len(scores), np.int64)
    origin = np.zeros(scores.shape, np.uint16)
    own = np.arange(scores.shape[1], dtype=np.uint16)
    value = np.zeros((len(sizes), scores.shape[1]))
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        best = value[:n].argmax(axis=1)
        jump = (value[np.arange(n), best] - switch)[:, None]
        changed = jump > value[:n]
        origin[at] = np.where(changed, best[:, None], own)
        value[:n] = np.where(changed, jump, value[:n]) + scores[at]
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = state[:n]
        state[:n] = origin[at, state[:n]]
    return path


def _groups(batch: pa.RecordBatch, scores: WordScores) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of a batch's rows: first row, end row, word entries, starts and sizes."""
    first, entries, sizes, words = 0, [], [], 0
    column = batch.column("_data")
    for row in range(len(column)):
        found = scores.lookup(column[row].as_py().split())
        entries.append(found), sizes.append(len(found))
        words += len(found)
        if words >= PATH_WORDS or row == len(column) - 1:
            sized = np.array(sizes)
            yield first, row + 1, np.concatenate(entries), np.cumsum(sized) - sized, sized
            first, entries, sizes, words = row + 1, [], [], 0


def _labelled(batch: pa.RecordBatch, scores: WordScores) -> Iterator:
    for first, end, entries, starts, sizes in _groups(batch, scores):
        path = best_paths(scores.scores[entries], starts, sizes)
        yield first, end, path, scores.letters[entries], starts, sizes
        if scores.used > CACHED_WORDS:
            scores.clear()


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``_row`` (the document's columns), ``lang_pred`` and ``score``: the language of most letters and its share of them.

    A text that is null or has no letters, or any text where nothing was learnt, gets ``und`` and score 0; ties go to the first language by name.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_bytes(F.col(text)).alias("_data"))

    def run(batches):
        langs = np.array([*known.value.langs, UNKNOWN], object)
        scores = WordScores(known.value)
        for batch in batches:
            if not known.value.langs:
                yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array([UNKNOWN] * len(batch)), pa.array([0.0] * len(batch))], names=_OUT)
                continue
            for first, end, path, weight, starts, sizes in _labelled(batch, scores):
                count = len(langs) - 1
                doc = np.repeat(np.arange(end - first), sizes)
                shares = np.bincount(doc * count + path, weight, (end - first) * count).reshape(-1, count)
                whole = shares.sum(axis=1)
                best = np.where(whole > 0, shares.argmax(axis=1), count)
                score = shares.max(axis=1) / np.maximum(whole, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(first, end - first), pa.array(langs[best], pa.string()), pa.array(score)], names=_OUT)

    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, lang_pred string, score double"
    return rows.mapInArrow(run, schema)


_OUT = ["_row", "lang_pred", "score"]


def spans(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per span of one language: ``key``, ``first_word`` and ``end_word`` (white-space words, from 0), ``lang``.

    Words without letters belong to the span they stand in; documents without words have no span.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("key", pa.int64()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("lang", pa.string())])

    def run(batches):
        scores = WordScores(known.value)
        langs = np.array(known.value.langs, object)
        for batch in batches if len(langs) else ():
            keys = batch.column("key").to_pylist()
            for first, end, path, _, starts, sizes in _labelled(batch, scores):
                doc = np.repeat(np.arange(end - first), sizes)
                opens = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])]) if len(path) else [])
                closes = np.append(opens[1:], len(path))
                of = doc[opens]
                yield pa.RecordBatch.from_arrays([
                    pa.array([keys[first + d] for d in of], pa.int64()), pa.array(opens - starts[of]), pa.array(closes - starts[of]),
                    pa.array(langs[path[opens]], pa.string())], schema=schema)

    rows = docs.select(F.col(key).cast("bigint").alias("key"), text_bytes(F.col(text)).alias("_data"))
    return rows.mapInArrow(run, "key bigint, first_word bigint, end_word bigint, lang string").withColumnRenamed("key", key)


def languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key``, ``held_out``, ``lang_pred`` and ``score`` of every document; repeated rows and rows without a key are judged like any other."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = identified(slim, train(docs, key, text, lang))
    return found.select(F.col("_row.key").alias(key), held_out(F.col("_row.key")).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language can be told."""
    return identified(docs, train(docs, key, text, lang), text).where(F.col("lang_pred") != UNKNOWN).select("_row.*")
