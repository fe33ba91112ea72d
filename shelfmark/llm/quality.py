"""Quality classifier from weak labels.

Eight overlapping heuristic labellers vote good, junk or nothing on every
document. Expectation-maximisation over the counts of vote patterns (at most 3^8
of them, whatever the corpus) estimates each labeller's accuracy on good documents and
on each kind of junk, without any gold label, and with them the posterior of
every pattern. Posteriors of a bounded, hash-chosen sample (``TRAIN_ROWS``) train a
linear scorer on hashed byte trigrams, which then scores every document; those
with a probability of being good under ``KEEP_FROM`` are rejected.

Cases: a null, empty or white-space text has nothing to keep and is rejected with
score 0; a null doc_id changes nothing; repeated rows have equal results; with no
text at all, or votes on one side only, the scorer falls back to the posterior's
prior and keeps; an empty table gives an empty result; extra columns pass through
``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.textbytes import batch_bytes, word_hashes

#: Documents that train the scorer, about; chosen by a hash over the whole corpus.
TRAIN_ROWS = 4096
DIMS = 2048
DAMPING = 64
KEEP_FROM = 0.5
#: Training stops where a round moves no weight by more than this part of the largest.
STEP_ENDS = 1e-3
PRIOR_GOOD = 0.8
#: Frequent function words of the corpus's four languages (fixed values).
FUNCTION_WORDS = (
    "the of and to in is that for with as on by this be are from it an at or "
    "der die das und den von zu mit ist ein eine nicht auf für im "
    "le la les de des et un une du en que qui pour dans par "
    "el los las y a con del se su una no por"
).split()
#: Labellers whose junk votes are symptoms of a kind of junk.
SYMPTOMS = ("symbols", "capitals", "repeats", "separators", "shouting")
LABELLERS = ("symbols", "capitals", "repeats", "separators", "shouting", "sentence_marks", "word_length", "function_words")


def _class_tables() -> np.ndarray:
    """(5, 256) masks of bytes: symbols, A-Z, a-z, white space, anything else than white space."""
    t = np.zeros((5, 256), np.int64)
    t[0, list(b"#$%&*@^~|<>{}[]=_+\\/")] = 1
    t[1, 0x41:0x5B] = 1
    t[2, 0x61:0x7B] = 1
    t[3, [0x20, *range(9, 14)]] = 1
    t[4] = 1 - t[3]
    return t


def _sums(per_byte: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums per text; empty texts have 0."""
    total = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def votes(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(n, 8) votes of 1 (good), -1 (junk) or 0; and nothing but 0 for texts without words."""
    n = len(offsets) - 1
    classes = _class_tables()
    symbols, upper, lower, _, solid = (_sums(t[body], offsets) for t in classes)
    space = classes[3].astype(bool)[body]
    words, owner = word_hashes(body, offsets)
    count = np.bincount(owner, minlength=n)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    # A byte ends a word if white space or the text's end follows.
    last = np.ones(len(body), bool)
    last[:-1] = space[1:]
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    last &= ~space
    # What comes before a text's first byte is white space, not the end of the text before.
    before = np.full(len(body), 0x20, np.uint8)
    before[1:] = body[:-1]
    before[offsets[:-1][offsets[:-1] < len(body)]] = 0x20
    ends = lambda chars: last & np.isin(body, np.frombuffer(chars, np.uint8))
    marks, shouts = _sums(ends(b".,;:!?"), offsets), _sums(ends(b"!") & (before == 0x21), offsets)
    alone = _sums(ends(b"|*-=~#") & classes[3].astype(bool)[before], offsets)
    names = np.frombuffer(" ".join(FUNCTION_WORDS).encode(), np.uint8)
    known, _ = word_hashes(names, np.array([0, len(names)]))
    function = np.bincount(owner[np.isin(words, known)], minlength=n)
    some = np.maximum(count, 1)
    letters = np.maximum(upper + lower, 1)

    def vote(value, junk_from, good_to, enough=count > 0):
        return np.where(enough, np.where(value >= junk_from, -1, np.where(value <= good_to, 1, 0)), 0)

    length = solid / some
    return np.stack(
        [
            vote(symbols / np.maximum(solid, 1), 0.15, 0.03),
            vote(upper / letters, 0.5, 0.2),
            vote(np.bincount(owner[same], minlength=n) / some, 0.3, 0.05, count >= 5),
            vote(alone / some, 0.25, 0.05),
            vote(shouts / some, 0.3, 0.05),
            np.where(count < 20, 0, np.where((marks / some >= 0.01) & (marks / some <= 0.35), 1, -1)),
            vote(np.abs(length - 6.5), 5.5, 3.5),
            -vote(function / some, 0.08, 0.01, count >= 20),
        ],
        axis=1,
    ).astype(np.int8)


def patterns(v: np.ndarray) -> np.ndarray:
    """Votes as one number in base 3."""
    return (v.astype(np.int64) + 1) @ (3 ** np.arange(v.shape[1]))


def features(body: np.ndarray, offsets: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """(n, dims) square roots of the shares of hashed byte trigrams; digits count as one.

    ``DAMPING`` more trigrams than a text has keep short texts from being judged by a few.
    """
    n = len(offsets) - 1
    out = np.zeros((n, dims), np.float32)
    seen = np.where((body >= 0x30) & (body <= 0x39), np.uint8(0x30), body)
    for i in range(n):
        part = seen[offsets[i] : offsets[i + 1]]
        counts = np.zeros(dims, np.int64)
        for a in range(0, max(len(part) - 2, 0), 1 << 20):
            p = part[a : a + (1 << 20) + 2].astype(np.uint32)
            h = (p[:-2] | p[1:-1] << np.uint32(8) | p[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
            counts += np.bincount(h >> np.uint32(21), minlength=dims)
        if total := counts.sum():
            out[i] = np.sqrt(counts / (total + DAMPING))
    return out


def estimate(pattern: np.ndarray, count: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """EM over counted vote patterns: the classes' shares, P(good vote | class) of each labeller, each pattern's P(good).

    Class 0 is good; the others are kinds of junk, one for each labeller in ``SYMPTOMS``,
    since junk of one kind has none of the other kinds' symptoms. A labeller that
    casts no vote says nothing.
    """
    k, kinds = len(LABELLERS), [LABELLERS.index(x) for x in SYMPTOMS]
    v = pattern[:, None] // 3 ** np.arange(k) % 3  # 0 junk, 1 nothing, 2 good
    yes, no = (v == 2).astype(float), (v == 0).astype(float)
    shown = no[:, kinds]
    ill = shown.sum(axis=1) > 0
    belief = np.where(ill[:, None], np.hstack([np.full((len(v), 1), 0.1), 0.9 * shown / np.maximum(shown.sum(axis=1, keepdims=True), 1)]),
                      np.hstack([np.full((len(v), 1), 0.98), np.full((len(v), len(kinds)), 0.02 / len(kinds))]))
    # Pseudo-counts: good documents get good votes, and each kind its labeller's junk vote.
    for_yes, for_no = np.full((len(kinds) + 1, k), 8.0), np.full((len(kinds) + 1, k), 0.5)
    for_yes[0], for_no[0] = 50.0, 0.5
    for c, j in enumerate(kinds):
        for_yes[c + 1, j], for_no[c + 1, j] = 1.0, 19.0
    share, table = np.zeros(len(kinds) + 1), np.zeros((len(kinds) + 1, k))
    start = np.array([PRIOR_GOOD, *[(1 - PRIOR_GOOD) / len(kinds)] * len(kinds)])
    for _ in range(rounds):
        weight = (belief * count[:, None]).T
        table = (weight @ yes + for_yes) / (weight @ (yes + no) + for_yes + for_no)
        share = (weight.sum(axis=1) + 40 * start) / (count.sum() + 40)
        logs = np.log(share) + yes @ np.log(table).T + no @ np.log1p(-table).T
        new = np.exp(logs - logs.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - belief).max(initial=0) < 1e-7:
            break
        belief = new
    return share, table, dict(zip(pattern.tolist(), belief[:, 0].tolist(), strict=True))


def train(x: np.ndarray, y: np.ndarray, rounds: int = 400, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient descent; weights for raw features.

    All of it is in the type of ``x``, so that products need no copy of the table. It
    stops where no weight moves by more than ``STEP_ENDS`` of the largest.
    """
    kind = x.dtype.type
    mean, std = x.mean(axis=0, dtype=np.float64).astype(kind), x.std(axis=0, dtype=np.float64).astype(kind) + kind(0.01)
    z = (x - mean) / std
    y = y.astype(kind)
    n, d = z.shape
    w, b, ahead_w, ahead_b = np.zeros(d, kind), kind(0), np.zeros(d, kind), kind(0)
    rate = kind(4.0 / (max(float(np.einsum("ij,ij->", z, z, dtype=np.float64)) / n, 1.0) + 1.0))
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead_w + ahead_b, -30, 30)))
        gap = p - y
        new_w, new_b = ahead_w - rate * (gap @ z / kind(n) + kind(penalty) * ahead_w), ahead_b - rate * gap.mean() * kind(20)
        still = np.abs(new_w - w).max(initial=0) <= STEP_ENDS * np.abs(new_w).max(initial=0)
        ahead_w, ahead_b = new_w + kind(t / (t + 3)) * (new_w - w), new_b + kind(t / (t + 3)) * (new_b - b)
        w, b = new_w, new_b
        if still:
            break
    return w / std, float(b - (mean / std) @ w)


def _slices(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    _, offsets = batch_bytes(batch.column("text"))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, min(a + 1024, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1))
        yield batch.slice(a, b - a)
        a = b


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, int] = {}
    for whole in batches:
        for batch in _slices(whole):
            for p, c in zip(*np.unique(patterns(votes(*batch_bytes(batch.column("text")))), return_counts=True), strict=True):
                counts[int(p)] = counts.get(int(p), 0) + int(c)
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _slices(whole):
            raw = batch_bytes(batch.column("text"))
            data = [row.tobytes() for row in features(*raw).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([pa.array(patterns(votes(*raw))), pa.array(data, pa.binary())], ["pattern", "data"])


class Model:
    """A fitted classifier: small enough to travel with the task."""

    def __init__(self, share: np.ndarray, table: np.ndarray, posterior: dict[int, float], weights: np.ndarray | None, bias: float):
        self.share, self.table, self.posterior, self.weights, self.bias = share, table, posterior, weights, bias
        self.prior = float(share[0])

    def accuracies(self) -> dict[str, float]:
        """Each labeller's estimated accuracy where it votes."""
        hit = self.share[0] * self.table[0] + self.share[1:] @ (1 - self.table[1:])
        return dict(zip(LABELLERS, hit.tolist(), strict=True))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit labellers and scorer on docs(doc_id, text)."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.lit(17), "doc_id", "text").alias("h"))
    rows = texts.select("text").mapInArrow(_voted, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    pattern, count = np.array([r.pattern for r in rows], np.int64), np.array([r.n for r in rows], np.float64)
    if not len(rows):
        return Model(np.array([PRIOR_GOOD, 1 - PRIOR_GOOD]), np.full((2, len(LABELLERS)), 0.5), {}, None, 0.0)
    shares, table, posterior = estimate(pattern, count)
    share = min(1.0, train_rows / count.sum())
    bound = int(share * 2**63) * 2 - 2**63 - 1  # of the signed hash
    sample = texts.filter((F.col("h") <= F.lit(min(bound, 2**63 - 1))) & (F.trim("text") != "")).select("text")
    got = sample.mapInArrow(_featured, "pattern long, data binary").toArrow()
    y = np.array([posterior.get(p, shares[0]) for p in got.column("pattern").to_pylist()])
    if not len(y) or y.min() > 0.5 or y.max() < 0.5:
        return Model(shares, table, posterior, None, 0.0)
    x = np.stack([np.frombuffer(d, np.float16) for d in got.column("data").to_pylist()]).astype(np.float32)
    weights, bias = train(x, y)
    return Model(shares, table, posterior, weights.astype(np.float32), bias)


def score(docs: DataFrame, model: Model, keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with n_votes, posterior (of its votes), score (probability of good) and kept."""
    added = ["n_votes", "posterior", "score", "kept"]
    kept = [c for c in docs.columns if c not in added]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                raw = batch_bytes(batch.column("text"))
                v = votes(*raw)
                posterior = np.array([model.posterior.get(p, model.prior) for p in patterns(v).tolist()])
                if model.weights is None:
                    p = posterior
                else:
                    p = 1 / (1 + np.exp(-np.clip(features(*raw) @ model.weights + model.bias, -30, 30)))
                blank = _sums(_class_tables()[4][raw[0]], raw[1]) == 0
                p = np.where(blank, 0.0, p).astype(np.float64)
                columns = [pa.array((v != 0).sum(axis=1).astype(np.int32)), pa.array(posterior), pa.array(p), pa.array(p >= keep_from)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *added])

    return docs.mapInArrow(run, f"{schema}, n_votes int, posterior double, score double, kept boolean")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier, fitted on them, keeps."""
    return score(docs, fit(docs.select("doc_id", "text"), **options)).filter("kept").select(*docs.columns)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior, score and decision for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, fit(docs)).select("doc_id", "n_votes", "posterior", "score", "kept")
