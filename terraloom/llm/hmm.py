"""Scoring texts with a hidden Markov language model trained by Baum-Welch.

Symbols are the most frequent training tokens, up to ``HEAD``, an end mark, and ``CLASSES`` classes of all other tokens by their last bytes.  A token
outside the head has the probability of its class times its own smoothed share of the class, so every token of the corpus counts as what
it is; the head bounds what tasks hold in memory, and the counts of all other tokens are joined by shuffle.  Baum-Welch first runs over
one in ``SHARE`` training documents, which gives the states a start, and then over every one, each time until the log-likelihood
settles: each task adds up expected counts, blocks of which are summed in a shuffle.  The scaled forward recursion gives the exact
likelihood of whole documents.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from terraloom.llm.common import record_batches, stored, text_bytes

STATES = 8
HEAD = 50_000
CLASSES = 256
SUFFIX = 3  # bytes that name a token's class
LONGEST = 64  # bytes of a head token, which bounds the head's size
ADDED = 0.1  # to every count
PULL = 200.0  # pseudo-tokens by which each state is drawn to the corpus distribution
SETTLED = 1e-3  # gain of a round, as a share of the log-likelihood, below which it is the last
SHARE = 8  # one in so many training documents is read by the rounds that give the states a start
RUN = 1024  # tokens trained on in a row; the rest of a longer document is the next sequence
HELD_OUT = (10, 0)
COUNTED_WORDS = 150_000
ENCODED_ROWS = 1000  # documents encoded as one record batch
GROUP_WORDS = 1_000_000  # tokens that advance side by side
BLOCK = 2048  # symbols summed as one record
END = b""  # the end mark; no word is empty
SEED = 11


def held_out(key: Column, fold: tuple[int, int] = HELD_OUT) -> Column:
    """Whether a document is kept out of training; one without a key always is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % fold[0] == fold[1], F.lit(True))


def tokens(data: bytes) -> list[bytes]:
    """Words with A-Z lowered, then the end mark."""
    return [*data.lower().split(), END]


_TOKENS = pa.schema([("token", pa.binary()), ("n", pa.int64())])


def token_counts(training: DataFrame) -> DataFrame:
    """``token`` and ``n`` over all rows of ``data``; tasks count before the shuffle."""
    def count(batches):
        counter: Counter = Counter()
        for batch in batches:
            for data in batch.column("data"):
                counter.update(tokens(data.as_py()))
                if len(counter) > COUNTED_WORDS:
                    yield from record_batches(_TOKENS, counter.items(), 16_384)
                    counter.clear()
        yield from record_batches(_TOKENS, counter.items(), 16_384)

    return training.select("data").mapInArrow(count, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def class_of(token: bytes) -> int:
    return zlib.crc32(token[-SUFFIX:]) % CLASSES


def class_column(token: Column) -> Column:
    """The same for a binary column."""
    size = F.octet_length(token)
    tail = F.when(size > SUFFIX, F.substring(token, -SUFFIX, SUFFIX)).otherwise(token)
    return (F.crc32(tail) % CLASSES).cast("int")


@dataclass
class Symbols:
    """Head tokens by number (0 is the end mark, then the head, then the classes), and what the counts say of each."""

    numbers: dict[bytes, int]
    counts: np.ndarray  # training count of the end mark and each head token
    class_totals: np.ndarray  # smoothed training count of each class
    total: int
    distinct: int

    def __len__(self) -> int:
        return len(self.counts) + CLASSES

    @property
    def unigram(self) -> np.ndarray:
        weights = np.concatenate([self.counts + ADDED, self.class_totals])
        return weights / weights.sum()


def symbols(counts: DataFrame, head: int = HEAD) -> Symbols:
    """The head is the tokens above the least frequency that at most ``head`` of them reach, in steps of a 16th of an octave."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words = counts.where((F.octet_length("token") > 0) & (F.octet_length("token") <= LONGEST))
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)
    least, held = None, 0
    for at, kinds in words.groupBy(level.alias("at")).count().orderBy(F.col("at").desc()).collect():
        held += kinds
        if held > head:
            break
        least = at
    top = words.where(level >= least if least is not None else F.lit(False))
    rows = sorted(((bytes(t), n) for t, n in top.collect()), key=lambda r: (-r[1], r[0]))
    ends = counts.where(F.octet_length("token") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rest = counts.where(F.octet_length("token") > 0).join(F.broadcast(top.select("token")), "token", "left_anti")
    totals = np.full(CLASSES, ADDED)  # a place for what was never seen
    for number, n, kinds in rest.groupBy(class_column(F.col("token")).alias("c")).agg(F.sum("n"), F.count("*")).collect():
        totals[number] = n + ADDED * (kinds + 1)
    numbers = {END: 0} | {t: i for i, (t, _) in enumerate(rows, 1)}
    return Symbols(numbers, np.array([ends, *(n for _, n in rows)], float), totals, total, distinct)


_ENCODED = "rid bigint, key bigint, held_out boolean, n_tokens bigint, symbols binary, rest array<struct<token:binary,n:int>>"


def encoded(docs: DataFrame, known: Symbols, key: str, text: str) -> DataFrame:
    """Every document as symbol numbers, with the tokens outside the head and how often each occurs; stored."""
    table = docs.sparkSession.sparkContext.broadcast(known.numbers)
    classes = len(known.counts)

    def encode(batches):
        for batch in (b.slice(at, ENCODED_ROWS) for b in batches for at in range(0, len(b), ENCODED_ROWS)):
            numbers, sizes, raw, ends, names, times = table.value, [], [], [0], [], []
            for data in batch.column("data"):
                words = tokens(data.as_py())
                found = list(map(numbers.get, words))
                others = Counter([w for w, f in zip(words, found, strict=True) if f is None])
                if others:
                    found = [classes + class_of(w) if f is None else f for w, f in zip(words, found, strict=True)]
                sizes.append(len(words))
                raw.append(np.array(found, "<i4").tobytes())
                names.extend(others), times.extend(others.values())
                ends.append(len(names))
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(names, pa.binary()), pa.array(times, pa.int32())], names=["token", "n"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("key"), batch.column("held_out"), pa.array(sizes, pa.int64()), pa.array(raw, pa.binary()), rest],
                names=["rid", "key", "held_out", "n_tokens", "symbols", "rest"])

    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(key).cast("bigint").alias("key"), held_out(F.col(key)).alias("held_out"),
        text_bytes(F.col(text)).alias("data"))
    return stored(rows.mapInArrow(encode, _ENCODED), "hmm-encoded")


@dataclass
class Model:
    start: np.ndarray  # (state)
    step: np.ndarray  # (from, to)
    emit: np.ndarray  # (symbol, state)

    @cached_property
    def by_state(self) -> np.ndarray:
        return np.ascontiguousarray(self.emit.T)


def first_model(unigram: np.ndarray, states: int) -> Model:
    """States that differ from the corpus distribution by reproducible noise, and tend to stay."""
    random = np.random.default_rng(SEED)
    emit = unigram[:, None] * np.exp(random.normal(0, 0.7, (len(unigram), states)))
    step = np.full((states, states), 0.5 / states) + 0.5 * np.eye(states)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by length, and for every step the number of documents that still have a token, and where its tokens begin when
    all first tokens come first, then all second ones, and so on."""
    order = np.argsort(-sizes, kind="stable")
    steps = int(sizes.max()) if len(sizes) else 0
    active = np.searchsorted(-sizes[order], -np.arange(steps), "left")
    return order, active, np.concatenate([[0], np.cumsum(active)])


def by_step(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of documents, one after the other, reordered step by step."""
    order, active, at = layout(sizes)
    starts = (np.cumsum(sizes) - sizes)[order]
    step = np.repeat(np.arange(len(active)), active)
    place = np.arange(len(values)) - at[step]
    return values[starts[place] + step], order, active, at


def forward(
    model: Model, values: np.ndarray, active: np.ndarray, at: np.ndarray, keep: bool,
) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray] | None]:
    """Scaled forward recursion: log-likelihood of each document; with ``keep`` also emissions and state probabilities (state, token), and scales.

    States are rows, so that a step works on whole runs of documents.  Likelihoods are worked out in double precision, what is kept in single.
    """
    documents = int(active[0]) if len(active) else 0
    kind = np.float32 if keep else np.float64
    emit, step = model.by_state.astype(kind, copy=False), model.step.T.astype(kind)
    scales = np.empty(len(values), kind)
    emissions = np.take(emit, values, axis=1) if keep else None
    alphas = np.empty((len(model.start), len(values)), kind) if keep else None
    alpha = np.repeat(model.start.astype(kind)[:, None], documents, axis=1)
    for t, n in enumerate(active.tolist()):
        rows = slice(at[t], at[t + 1])
        alpha = (alpha if t == 0 else step @ alpha[:, :n]) * (emissions[:, rows] if keep else np.take(emit, values[rows], axis=1))
        scale = alpha.sum(axis=0)
        alpha /= scale
        scales[rows] = scale
        if keep:
            alphas[:, rows] = alpha
    place = np.arange(len(values)) - np.repeat(at[:-1], active)
    like = np.bincount(place, np.log(scales.astype(float)), documents)
    return like, (emissions, alphas, scales) if keep else None


def expected_counts(model: Model, values: np.ndarray, sizes: np.ndarray, into: list[np.ndarray]) -> float:
    """Add a group's expected starts, steps and emissions to ``into``; returns its log-likelihood."""
    values, _, active, at = by_step(values, sizes)
    like, (emissions, alphas, scales) = forward(model, values, active, at, True)
    starts, steps, emitted = into
    states, step = len(model.start), model.step.astype(np.float32)
    moved = np.zeros((states, states))
    active = active.tolist()
    beta = np.ones((states, active[-1] if active else 0), np.float32)
    for t in range(len(active) - 1, -1, -1):
        n, rows = active[t], slice(at[t], at[t + 1])
        if beta.shape[1] < n:  # documents that end here
            beta = np.concatenate([beta, np.ones((states, n - beta.shape[1]), np.float32)], axis=1)
        if t:
            weighted = emissions[:, rows] * beta
            weighted /= scales[rows]
            moved += alphas[:, at[t - 1]: at[t - 1] + n] @ weighted.T
        alphas[:, rows] *= beta
        if t:
            beta = step @ weighted
        else:
            starts += alphas[:, rows].sum(axis=1)
    steps += model.step * moved
    for state in range(states):
        emitted[:, state] += np.bincount(values, alphas[state], len(emitted))
    return float(like.sum())


def training_runs(values: np.ndarray, sizes: np.ndarray, longest: int) -> np.ndarray:
    """Sizes of the sequences that are trained on: documents, in runs of at most ``longest`` tokens; every token is in one."""
    whole, last = np.divmod(sizes, longest)
    runs = np.full((whole + (last > 0)).sum(), longest, np.int64)
    ends = np.cumsum(whole + (last > 0)) - 1
    runs[ends[last > 0]] = last[last > 0]
    return runs


def groups(batch: pa.RecordBatch, column: str = "symbols") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``GROUP_WORDS`` symbols: first row, end row, symbols, sizes."""
    sizes = batch.column("n_tokens").to_numpy()
    first = words = 0
    for row, size in enumerate(sizes):
        words += size
        if words >= GROUP_WORDS or row == len(sizes) - 1:
            raw = b"".join([x.as_py() for x in batch.column(column).slice(first, row + 1 - first)])
            yield first, row + 1, np.frombuffer(raw, "<i4"), sizes[first: row + 1]
            first, words = row + 1, 0


def baum_welch(rows: DataFrame, model: Model, unigram: np.ndarray) -> tuple[Model, float]:
    """One round over encoded rows: the new model, and the log-likelihood under the old one."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    states, size = len(model.start), len(unigram)

    def expect(batches):
        into = [np.zeros(states), np.zeros((states, states)), np.zeros((size, states))]
        like, seen = 0.0, False
        for batch in batches:
            for _, _, values, sizes in groups(batch):
                like, seen = like + expected_counts(sent.value, values, training_runs(values, sizes, RUN), into), True
        if seen:
            rest = np.concatenate([[like], into[0], into[1].ravel()])
            yield from record_batches(_BLOCKS, [(-1, rest.tobytes())])
            for block in range(0, size, BLOCK):
                part = into[2][block: block + BLOCK].astype(np.float32)
                yield from record_batches(_BLOCKS, [(block, part.tobytes())])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("sums"), strict=True):
                part = np.frombuffer(raw.as_py(), np.float64 if block < 0 else np.float32).astype(float)
                sums[block] = sums[block] + part if block in sums else part
        yield from record_batches(_BLOCKS, [(block, part.tobytes()) for block, part in sums.items()])

    partial = rows.select("n_tokens", "symbols").mapInArrow(expect, "block int, sums binary")
    found = {block: np.frombuffer(raw) for block, raw in partial.repartition("block").mapInArrow(add, "block int, sums binary").collect()}
    sent.unpersist()
    if not found:
        return model, 0.0
    rest = found.pop(-1)
    emissions = np.concatenate([found[b] for b in sorted(found)]).reshape(size, states) + PULL * unigram[:, None]
    steps = rest[1 + states:].reshape(states, states) + 1.0 / states
    starts = rest[1: 1 + states] + 1.0 / states
    return Model(starts / starts.sum(), steps / steps.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0)), rest[0]


_BLOCKS = pa.schema([("block", pa.int32()), ("sums", pa.binary())])


def train(rows: DataFrame, unigram: np.ndarray, states: int = STATES, share: int = SHARE, settled: float = SETTLED, most: int | None = None) -> Model:
    """Rounds over all training documents until the log-likelihood settles, after rounds over one in ``share`` have done so.

    The first rounds only give the states a start; which documents they read is decided by a hash, so their number grows with the input.
    ``most`` bounds the rounds of either kind, where a caller wants that.
    """
    training = rows.where("NOT held_out")
    model = first_model(unigram, states)
    some = training.where(F.pmod(F.xxhash64("rid"), F.lit(share)) == 0) if share > 1 else None
    for data in (some, training):
        if data is None:
            continue
        if data is some:
            data = stored(data.select("n_tokens", "symbols"), "hmm-start")
        before, done = -np.inf, 0
        while most is None or done < most:
            model, like = baum_welch(data, model, unigram)
            done += 1
            if like - before <= settled * abs(like):  # no training documents: 0 after the second round
                break
            before = like
    return model


def likelihoods(rows: DataFrame, model: Model, known: Symbols) -> DataFrame:
    """``rid`` and what the symbols alone say: ``path`` log10-likelihood, ``plain`` base score and ``met`` known tokens."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    base = np.log10((known.counts + ADDED) / (known.total + ADDED * (known.distinct + 1)))
    base = np.concatenate([base, np.zeros(CLASSES)])  # tokens of a class are added one by one later
    there = np.concatenate([known.counts > 0, np.zeros(CLASSES, bool)])

    def score(batches):
        for batch in batches:
            for first, end, values, sizes in groups(batch):
                stepped, order, active, at = by_step(values, sizes)
                like = np.empty(end - first)
                like[order], _ = forward(sent.value, stepped, active, at, False)
                starts = np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(first, end - first) for c in ("rid", "key", "held_out", "n_tokens")), pa.array(like / np.log(10)),
                    pa.array(np.add.reduceat(base[values], starts)), pa.array(np.add.reduceat(there[values].astype(np.int64), starts))],
                    names=["rid", "key", "held_out", "n_tokens", "path", "plain", "met"])

    schema = "rid bigint, key bigint, held_out boolean, n_tokens bigint, path double, plain double, met bigint"
    return rows.select("rid", "key", "held_out", "n_tokens", "symbols").mapInArrow(score, schema)


def rest_scores(rows: DataFrame, counts: DataFrame, known: Symbols) -> DataFrame:
    """``rid`` and the shares of its tokens outside the head: ``rest_path``, ``rest_plain``, ``rest_met``."""
    totals = F.split(F.lit(",".join(repr(float(x)) for x in known.class_totals)), ",").cast("array<double>")
    each = rows.select("rid", F.explode("rest").alias("r")).select("rid", F.col("r.token").alias("token"), F.col("r.n").alias("times"))
    n = F.coalesce(F.col("n"), F.lit(0)) + F.lit(ADDED)
    return (
        each.join(counts, "token", "left")
        .select(
            "rid", (F.log10(n / F.get(totals, class_column(F.col("token")))) * F.col("times")).alias("a"),
            (F.log10(n / F.lit(known.total + ADDED * (known.distinct + 1))) * F.col("times")).alias("b"),
            F.when(F.col("n") > 0, F.col("times")).otherwise(0).cast("bigint").alias("c"))
        .groupBy("rid").agg(F.sum("a").alias("rest_path"), F.sum("b").alias("rest_plain"), F.sum("c").alias("rest_met"))
    )


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", head: int = HEAD, **training) -> DataFrame:
    """Token counts, base score and model score (log10) of every document.

    A null or empty text is the end mark alone.  Documents without a key are held out; repeated rows are counted and scored
    one by one; a token that occurs in held-out documents only is scored as unseen, and two such tokens alike within a class; no
    training documents leave the smoothed model; no documents give no rows.
    """
    training_rows = docs.where(~held_out(F.col(key))).select(text_bytes(F.col(text)).alias("data"))
    counts = stored(token_counts(training_rows), "hmm-counts")
    known = symbols(counts, head)
    rows = encoded(docs, known, key, text)
    model = train(rows, known.unigram, **training)
    whole = likelihoods(rows, model, known).join(rest_scores(rows, counts, known), "rid", "left")
    plus = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("rest_path", "rest_plain", "rest_met")}
    return whole.select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("met") + plus["rest_met"]).alias("n_known"),
        F.lit(known.total).cast("bigint").alias("train_tokens"), (F.col("plain") + plus["rest_plain"]).alias("base_score"),
        (F.col("path") + plus["rest_path"]).alias("score"))
