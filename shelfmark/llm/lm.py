"""Language-model scores by a subword lattice.

A text is read as its words, A-Z lower-cased, each with a space before it, and one
end. An existing vocabulary's pieces span a lattice of all segmentations of a word's
bytes. Where a word may begin, the model deals either the end or a piece that begins
with the space; after that, pieces without one; and with every piece it says whether
the word goes on or stops. So each piece has two weights, and

    P(text) = P(end) * product over words of the sum over segmentations of the product of weights,

in which all texts together have probability 1 and a text's sum over all its
segmentations is the product of its words' sums. A forward recursion in log space takes
a word's sum. The weights start from the vocabulary's own scores (its ranks, read as a
Zipf law); ``ROUNDS`` of expectation-maximisation (forward-backward over all training
words, as often as they come) fit them to the corpus. The vocabulary is never changed.

The counts of all words of all documents are one table. Its ``FREQUENT`` most frequent
words of up to ``FREQUENT_BYTES`` bytes, and ``FREQUENT_LONG`` of up to ``LONG_BYTES``,
travel with the task as a dictionary of bounded size; all others meet their scores in a
join on the word, of which adaptive execution splits a partition that grows hot.

Cases: a null or empty text is one end; a null doc_id counts as held out; repeated
rows learn and score like others and each get a row; without training documents
the weights are those of the ranks; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.bpe import default_vocabulary, load_ranks
from shelfmark.llm.textbytes import mix64
from shelfmark.plans.shared import drop_shared, shared_table

ROUNDS = 4
#: Words sent along with the tasks, and the bytes that each may have: some 8 MB, and 4 MB at most.
FREQUENT, FREQUENT_BYTES = 100_000, 32
FREQUENT_LONG, LONG_BYTES = 1000, 4096
#: What every weight is worth beside the counts.
SMOOTHING = 0.1
#: Words that a task counts before it passes them on.
COUNTED_AT_ONCE = 300_000
#: Words that are looked up in the lattice at once.
WORDS_AT_ONCE = 50_000
#: Bits of a hash by which most strings that are no piece are told from pieces.
LEADING_BITS = 18
END = b""
_U = np.uint64
_LOG10 = math.log(10)


class Lattice:
    """Pieces with log weights of going on and of stopping after them, that of the end, and the recursions over batches of words."""

    def __init__(self, pieces: list[bytes], log_open: np.ndarray, log_last: np.ndarray, log_end: float):
        self.pieces, self.log_open, self.log_last, self.log_end = pieces, log_open, log_last, log_end

    @cached_property
    def tables(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per piece length: sorted hashes, the numbers of their pieces, and which leading bits occur among the hashes."""
        by: dict[int, list[int]] = {}
        for i, p in enumerate(self.pieces):
            by.setdefault(len(p), []).append(i)
        out = {}
        for n, numbers in by.items():
            body = np.frombuffer(b"".join(self.pieces[i] for i in numbers), np.uint8).reshape(-1, n)
            h = _hash_columns([body[:, k] for k in range(n)])
            order = np.argsort(h)
            some = np.zeros(1 << LEADING_BITS, bool)
            some[h >> _U(64 - LEADING_BITS)] = True
            out[n] = h[order], np.array(numbers, np.int32)[order], some
        return out

    def batches(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, tuple[int, int, int], tuple[np.ndarray, ...]]]:
        """(places of words, shape [word, end, length], arcs) for words of one byte length at a time.

        Arcs are the pieces in those words: the word's number among them, the end and the length of the piece, and its number.
        """
        tables = self.tables
        longest_piece = max(tables)
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w) + 1, []).append(i)
        for n, places in by.items():
            longest = min(longest_piece, n)  # no longer piece is in these words
            at_once = max(1, (1 << 19) // (n * longest))
            for a in range(0, len(places), at_once):
                some = places[a : a + at_once]
                body = np.frombuffer(b"".join([b" " + words[i] for i in some]), np.uint8).reshape(len(some), n)
                h = np.zeros((len(some), n), _U)
                power, arcs = 1, []
                for length in range(1, longest + 1):
                    with np.errstate(over="ignore"):
                        h = h[:, : n - length + 1] + (body[:, length - 1 :].astype(_U) + _U(1)) * _U(power)
                    power = power * _BASE & ((1 << 64) - 1)
                    if length in tables:
                        keys, numbers, leading = tables[length]
                        mixed = mix64(h)
                        at, start = np.nonzero(leading[mixed >> _U(64 - LEADING_BITS)])
                        mixed = mixed[at, start]
                        to = np.minimum(np.searchsorted(keys, mixed), len(keys) - 1)
                        hit = keys[to] == mixed
                        arcs.append((at[hit], start[hit] + length, np.full(int(hit.sum()), length), numbers[to[hit]]))
                yield np.array(some), (len(some), n + 1, longest + 1), tuple(map(np.concatenate, zip(*arcs, strict=True)))

    @staticmethod
    def forward(w: np.ndarray) -> np.ndarray:
        """log sums over all segmentations of the first j bytes; w is [word, end, length]."""
        n_words, ends, lengths = w.shape
        alpha = np.full((n_words, lengths - 1 + ends), -np.inf)  # padded in front
        alpha[:, lengths - 1] = 0.0
        for j in range(1, ends):
            ahead = alpha[:, j : j + lengths - 1][:, ::-1]  # ends of the parts before, by the last piece's length
            alpha[:, lengths - 1 + j] = _logsum(ahead + w[:, j, 1:])
        return alpha[:, lengths - 1 :]

    @staticmethod
    def backward(w: np.ndarray) -> np.ndarray:
        """log sums over all segmentations of what follows the first i bytes."""
        n_words, ends, lengths = w.shape
        beta = np.full((n_words, ends + lengths - 1), -np.inf)
        beta[:, ends - 1] = 0.0
        from_start = _by_start(w, -np.inf)
        for i in range(ends - 2, -1, -1):
            beta[:, i] = _logsum(beta[:, i + 1 : i + lengths] + from_start[:, i, 1:])
        return beta[:, :ends]

    def read(self, shape: tuple[int, int, int], arcs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        """The log weights of the arcs, and as [word, end, length]; a piece that ends where its word does is its last."""
        at, end, length, number = arcs
        logs = np.where(end == shape[1] - 1, self.log_last[number], self.log_open[number])
        w = np.full(shape, -np.inf)
        w[at, end, length] = logs
        return logs, w

    def log_marginal(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's sum over all segmentations."""
        out = np.zeros(len(words))
        for places, shape, arcs in self.batches(words):
            out[places] = self.forward(self.read(shape, arcs)[1])[:, -1]
        return out

    def expected(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """(2, pieces): how often each piece goes on and is last over all segmentations of words that come ``times``."""
        none = len(self.pieces)
        out = np.zeros((2, none))
        for places, shape, arcs in self.batches(words):
            at, end, length, number = arcs
            logs, w = self.read(shape, arcs)
            share = _plain_shares(logs, w, arcs)
            low = ~np.isfinite(share)
            if low.any():  # sums too small for plain arithmetic
                words_ = np.unique(at[low])
                alpha, beta = self.forward(w[words_]), self.backward(w[words_])
                mine = np.isin(at, words_)
                k = np.searchsorted(words_, at[mine])
                share[mine] = np.exp(alpha[k, end[mine] - length[mine]] + logs[mine] + beta[k, end[mine]] - alpha[k, -1])
            share *= times[places][at]
            last = end == shape[1] - 1
            for k, some in enumerate((~last, last)):
                out[k] += np.bincount(number[some], weights=share[some], minlength=none)
        return out


def _by_start(w: np.ndarray, empty: float) -> np.ndarray:
    """[word, end, length] as [word, start, length]."""
    out = np.full(w.shape, empty)
    for length in range(1, w.shape[2]):
        out[:, : w.shape[1] - length, length] = w[:, length:, length]
    return out


def _plain_shares(logs: np.ndarray, w: np.ndarray, arcs: tuple[np.ndarray, ...]) -> np.ndarray:
    """The share of its word's segmentations that each arc is in, by weight, from sums of plain products; nan in words whose sum is near the least of doubles."""
    at, end, length, _ = arcs
    n_words, ends, lengths = w.shape
    w = np.exp(w)
    alpha = np.zeros((n_words, lengths - 1 + ends))
    alpha[:, lengths - 1] = 1.0
    for j in range(1, ends):
        alpha[:, lengths - 1 + j] = np.einsum("ij,ij->i", alpha[:, j : j + lengths - 1][:, ::-1], w[:, j, 1:])
    beta = np.zeros((n_words, ends + lengths - 1))
    beta[:, ends - 1] = 1.0
    from_start = _by_start(w, 0.0)
    for i in range(ends - 2, -1, -1):
        beta[:, i] = np.einsum("ij,ij->i", beta[:, i + 1 : i + lengths], from_start[:, i, 1:])
    whole = alpha[:, -1]
    whole = np.where(whole > 1e-250, whole, np.nan)
    return alpha[at, lengths - 1 + end - length] * np.exp(logs) * beta[at, end] / whole[at]


_BASE = 0x9E3779B97F4A7C15


def _hash_columns(columns: list[np.ndarray]) -> np.ndarray:
    h, power = np.zeros(len(columns[0]), _U), 1
    with np.errstate(over="ignore"):
        for c in columns:
            h = h + (c.astype(_U) + _U(1)) * _U(power)
            power = power * _BASE & ((1 << 64) - 1)
    return mix64(h)


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    base = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return base + np.log(np.exp(x - base[:, None]).sum(axis=1))


def _normalised(pieces: list[bytes], open_: np.ndarray, last: np.ndarray, end: float) -> Lattice:
    """The lattice of these weights: one distribution over the end and what a word may begin with, one over what may follow in it."""
    first = np.array([p[0] == 0x20 for p in pieces])
    last = np.where([p == b" " for p in pieces], 0.0, last)  # a word has more than its space
    begin, inside = (open_ + last)[first].sum() + end, (open_ + last)[~first].sum()
    whole = np.where(first, begin, inside)
    with np.errstate(divide="ignore"):
        return Lattice(pieces, np.log(open_ / whole), np.log(last / whole), math.log(end / begin))


def initial_lattice(ranks: dict[bytes, int]) -> Lattice:
    """The vocabulary's pieces that can occur in a lower-cased word, weighted by rank; all single bytes are among them."""
    apart = {0x20, *range(9, 14)}
    never = {*range(9, 14), *range(65, 91)}
    usable = [p for p in ranks if not apart & set(p[1:]) and not never & set(p)]
    pieces = sorted({*usable, *(bytes([c]) for c in range(256) if c not in never)}, key=lambda p: (ranks.get(p, len(ranks)), p))
    order = np.array([len(ranks) if len(p) == 1 else ranks[p] for p in pieces], np.float64)
    weight = 1 / (order + 50)
    return _normalised(pieces, weight / 2, weight / 2, weight.sum() / 100)


def _words(text: str | None) -> list[bytes]:
    """bytes.lower and bytes.split know A-Z and the six ASCII white-space bytes only, as the contract does."""
    return (text or "").encode().lower().split()


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    train: Counter = Counter()
    other: set = set()

    def rows():
        names = [*train, *(w for w in other if w not in train)]
        counts = [train.get(w, 0) for w in names]
        train.clear()
        other.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(counts, pa.int64())], ["word", "c"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            words = _words(text.as_py())
            if held_out(doc_id):
                other.update(words)
                other.add(END)
            else:
                train.update(words)
                train[END] += 1
            if len(train) + len(other) > COUNTED_AT_ONCE:
                yield rows()
    if train or other:
        yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c): every word of every document, and the end as b'', with its count in training documents."""
    return docs.mapInArrow(_counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _many(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words and counts of several batches, up to ``WORDS_AT_ONCE`` words and some more."""
    words: list[bytes] = []
    counts: list[np.ndarray] = []
    for batch in batches:
        words += batch.column("word").to_pylist()
        counts.append(batch.column("c").to_numpy())
        if len(words) >= WORDS_AT_ONCE:
            yield words, np.concatenate(counts)
            words, counts = [], []
    if words:
        yield words, np.concatenate(counts)


def fit_lattice(counts: DataFrame, ranks: dict[bytes, int], rounds: int, texts: int) -> Lattice:
    """The lattice fitted to every word of counts(word, c) as often as it comes, and to ``texts`` ends."""
    lattice = initial_lattice(ranks)
    learn = counts.filter((F.col("c") > 0) & (F.octet_length("word") > 0)).select("word", "c")
    for _ in range(rounds):
        shared = counts.sparkSession.sparkContext.broadcast((lattice.pieces, lattice.log_open, lattice.log_last, lattice.log_end))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = Lattice(*shared.value)
            total = np.zeros((2, len(model.pieces)))
            for words, c in _many(batches):
                total += model.expected(words, c.astype(np.float64))
            some = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], ["piece", "o", "l"])

        # At most one row a piece of the vocabulary comes back.
        rows = learn.mapInArrow(expect, "piece long, o double, l double").groupBy("piece").agg(F.sum("o").alias("o"), F.sum("l").alias("l")).toArrow()
        if not rows.num_rows:
            break
        found = np.full((2, len(lattice.pieces)), SMOOTHING)
        for k, c in enumerate("ol"):
            found[k, rows.column("piece").to_numpy()] += rows.column(c).to_numpy()
        lattice = _normalised(lattice.pieces, *found, texts + SMOOTHING)
    return lattice


def _word_scores(counts: DataFrame, lattice: Lattice, n: int, v: int) -> DataFrame:
    """(word, known, base, score): the log10 probabilities of every token."""
    shared = counts.sparkSession.sparkContext.broadcast((lattice.pieces, lattice.log_open, lattice.log_last, lattice.log_end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Lattice(*shared.value)
        for words, c in _many(batches):
            base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
            spelled = [w for w in words if w != END]
            score = np.full(len(words), model.log_end)
            score[[w != END for w in words]] = model.log_marginal(spelled)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array((c > 0).astype(np.int64)), pa.array(base), pa.array(score / _LOG10)], ["word", "known", "base", "score"]
            )

    return counts.mapInArrow(run, "word binary, known long, base double, score double")


def _frequent(counts: DataFrame, scores: DataFrame, frequent: int) -> pa.Table:
    """The scores of the end and of the words that come most often, of bounded number and size."""
    size, order = F.octet_length("word"), (F.octet_length("word") > 0, F.col("c").desc(), "word")  # the end is first
    short = counts.filter(size <= FREQUENT_BYTES).orderBy(*order).limit(frequent)
    long = counts.filter((size > FREQUENT_BYTES) & (size <= LONG_BYTES)).orderBy(*order).limit(min(frequent, FREQUENT_LONG))
    top = short.unionByName(long).select("word")
    return scores.join(F.broadcast(top), "word", "left_semi").toArrow()


def score_texts(docs: DataFrame, vocabulary: str | None = None, rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs(doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = shared_table(word_counts(docs), "word_counts")
    size = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"),
        F.coalesce(F.sum(F.when(F.octet_length("word") == 0, F.col("c"))), F.lit(0)).alias("texts"),
    ).first()
    n = size["n"]
    lattice = fit_lattice(counts, load_ranks(vocabulary or default_vocabulary()), rounds, size["texts"])
    scores = shared_table(_word_scores(counts, lattice, n, size["v"]), "word_scores")
    table = _frequent(counts, scores, frequent)
    drop_shared(counts)
    place = {w: i for i, w in enumerate(table.column("word").to_pylist())}
    # A word that is not there has the last place, which adds nothing.
    values = np.zeros((3, len(place) + 1))
    for k, c in enumerate(("known", "base", "score")):
        values[k, :-1] = table.column(c).to_numpy()
    shared = spark.sparkContext.broadcast((place, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document one row of what the frequent words add up to, and a row for each other word."""
        place, values = shared.value
        rare = len(place)
        names = ["doc_id", "th", "copies", "word", "n", "known", "base", "score"]

        def rows(ids, copies, words, times, sums=None):
            """Rows of the documents ``ids``, (doc_id, th); without sums, of rare words."""
            more = [pa.nulls(len(words), k) for k in (pa.int64(), pa.float64(), pa.float64())] if sums is None else [pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])]
            fixed = [pa.array([i for i, _ in ids], pa.int64()), pa.array([t for _, t in ids], pa.int64()), pa.array([copies] * len(words), pa.int64())]
            return pa.RecordBatch.from_arrays([*fixed, pa.array(words, pa.binary()), pa.array(times, pa.int64()), *more], names)

        for batch in batches:
            ids = list(zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), strict=True))
            totals, tokens = np.zeros((3, len(ids))), []
            of, words, times = [], [], []
            for k, text in enumerate(batch.column("text")):
                found = _words(text.as_py())
                found.append(END)
                tokens.append(len(found))
                at = np.fromiter(map(place.get, found, repeat(rare)), np.int64, len(found))
                totals[:, k] = values[:, at].sum(axis=1)
                others = Counter([found[i] for i in np.flatnonzero(at == rare)])
                of += [ids[k]] * len(others)
                words += others.keys()
                times += others.values()
                if len(words) > 50_000:
                    yield rows(of, 0, words, times)
                    of, words, times = [], [], []
            yield rows(of, 0, words, times)
            # White space is in no word: these rows meet nothing in the join, and spread evenly over it.
            yield rows(ids, 1, [b" %d %d" % (i or 0, t) for i, t in ids], tokens, totals)

    rows = docs.withColumn("th", F.xxhash64("text")).mapInArrow(run, "doc_id long, th long, copies long, word binary, n long, known long, base double, score double")
    own = rows.withColumnsRenamed({"known": "k0", "base": "b0", "score": "s0"}).join(scores, "word", "left")
    summed = own.groupBy("doc_id", "th").agg(
        F.sum("copies").alias("copies"),
        F.sum(F.when(F.col("copies") > 0, F.col("n"))).alias("n"),
        F.sum(F.coalesce("k0", F.col("n") * F.col("known"), F.lit(0))).alias("known"),
        F.sum(F.coalesce("b0", F.col("n") * F.col("base"))).alias("base"),
        F.sum(F.coalesce("s0", F.col("n") * F.col("score"))).alias("score"),
    )
    whole = lambda c: (F.col(c) / F.col("copies")).cast("long").alias(f"n_{c}" if c == "known" else "n_tokens")
    out_id = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    # Fully repeated rows were summed up together; each gets its row back.
    return summed.withColumn("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id", out_id.alias("held_out"), whole("n"), whole("known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"),
    )


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice scores of all whole texts."""
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
