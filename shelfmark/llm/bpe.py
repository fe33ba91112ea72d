r"""Byte-level BPE encoding and decoding by ranked merges.

The vocabulary is a file of byte strings and ranks; its path is a parameter. The
driver reads it once (under 1 MB) and every task gets it as a broadcast. Texts are
split by the tokenizer's pattern; each distinct word's bytes are folded by the
merge of lowest rank, leftmost first, until none applies.

Two forms share that definition. ``encode_native`` is the fold written with
Spark's higher-order functions over a literal rank map, for tables of distinct
words. ``encode`` and the query run the same fold on Arrow batches, over all new
distinct words of some texts at once, and remember words up to a bound; see the
README for the figures behind that choice.

Cases: a null text is empty and has no tokens; very long words are merged with a
heap, in n log n; repeated rows have equal results; an empty table gives an empty
result; extra columns pass through ``encode``, and columns that it adds replace
columns of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The split pattern of the GPT-2 family of tokenizers (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same on texts of ASCII letters only, for the plain library; control characters above 13 are no white space there either.
ASCII_PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Words of a generation that a task remembers, beside the generation before.
CACHE_WORDS = 100_000
#: Words of a longer text that are handled at once, and the letters of short texts that are.
WORDS_AT_ONCE, LONG_TEXT = 1 << 17, 1 << 20
#: Words beyond this many bytes are merged with a heap, the others many at a time.
LONG_WORD, FOLDED_AT_ONCE = 48, 1 << 14
NO_MERGE = np.iinfo(np.int32).max
SLOTS = 1 << 14


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _lasts(sizes) -> np.ndarray:
    """Whether each of the rows' entries, one row after the other, is its row's last."""
    ends = np.cumsum(sizes)
    out = np.zeros(ends[-1], bool)
    out[ends - 1] = True
    return out


class Codec:
    """Encoder and decoder over one rank map.

    Tokens are numbered by rank. A pair of neighbouring parts can merge where the
    concatenation of their bytes has a rank, so all merges there are form one table of
    pairs of numbers: ``keys`` (left * size + right, sorted) and ``results``; pairs of
    single bytes are looked up directly in ``first``.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks = ranks
        self.pieces = {i: p for p, i in ranks.items()}
        self.split = regex.compile(pattern)
        self.split_ascii = re.compile(ASCII_PATTERN) if pattern == PATTERN else self.split
        self.numbers: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}
        self.older: tuple[dict[str, bytes], dict[str, bytes]] | None = None
        self.size = max(self.pieces, default=0) + 1
        #: The decimal text of an id with a comma, and under the id plus ``size`` with a semicolon.
        self.decimal = {i: b"%d," % i for i in self.pieces} | {i + self.size: b"%d;" % i for i in self.pieces}
        get = ranks.get
        if missing := [c for c in range(256) if bytes([c]) not in ranks]:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        pairs = [(a * self.size + b, i) for p, i in ranks.items() for k in range(1, len(p)) if (a := get(p[:k])) is not None and (b := get(p[k:])) is not None]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.results = np.append(table[:, 0], self.size**2 - 1), np.append(table[:, 1], NO_MERGE).astype(np.int32)
        self.byte_ids = np.array([get(bytes([c]), 0) for c in range(256)], np.int32)
        self.first = self._rank(self.byte_ids[:, None], self.byte_ids[None, :])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, which is the number of what it merges into; ``NO_MERGE`` where it has none."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.results[at], np.int32(NO_MERGE))

    def fold(self, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, one row for each word of the byte matrix ``body``, and how many each row has.

        Every round merges the leftmost pair of lowest rank in each word that has one,
        so the words still open are always of equal length; only the two pairs beside a
        merge get new ranks.
        """
        ids, ranks = self.byte_ids[body], self.first[body[:, :-1], body[:, 1:]]
        out, sizes, open_ = np.zeros(body.shape, np.int32), np.zeros(len(body), np.int64), np.arange(len(body))
        while len(open_):
            n = ids.shape[1]
            at = ranks.argmin(axis=1) if n > 1 else np.zeros(len(ids), np.int64)
            best = ranks[np.arange(len(ids)), at] if n > 1 else np.full(len(ids), NO_MERGE, np.int32)
            more = best != NO_MERGE
            done = open_[~more]
            out[done, :n], sizes[done] = ids[~more], n
            open_, ids, ranks, at, best = open_[more], ids[more], ranks[more], at[more], best[more]
            rows, place = np.arange(len(ids)), np.arange(n - 1)
            ids[rows, at] = best
            ids = np.take_along_axis(ids, place + (place > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks, place[:-1] + (place[:-1] > at[:, None]), axis=1)
            r = np.flatnonzero(at > 0)
            ranks[r, at[r] - 1] = self._rank(ids[r, at[r] - 1], best[r])
            r = np.flatnonzero(at < n - 2)
            ranks[r, at[r]] = self._rank(best[r], ids[r, at[r] + 1])
        return out, sizes

    def _merge_long(self, word: bytes) -> list[int]:
        n = len(word)
        ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        live = [True] * n
        get = self.ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i] if live[i] else n
            if j >= n or ends[j] != end:  # either part has changed since
                continue
            ends[i], after[i], live[j] = end, after[j], False
            if after[i] < n:
                before[after[i]] = i
                if (r := get(word[i : ends[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, ends[after[i]]))
            if (p := before[i]) >= 0 and (r := get(word[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        return [self.ranks[word[i : ends[i]]] for i in range(n) if live[i]]

    def merge(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """For each word its ids as comma-joined decimals, and the bytes that those decode to; words of one length are folded together."""
        numbers, decoded = [b""] * len(words), [b""] * len(words)
        whole = list(map(self.ranks.get, words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        cuts = np.flatnonzero(np.diff(sizes[order], prepend=-1)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=False):
            n = int(sizes[order[a]])
            for first in range(a, b, FOLDED_AT_ONCE):
                some = order[first : min(first + FOLDED_AT_ONCE, b)].tolist()
                known = [k for k in some if whole[k] is not None]
                some = [k for k in some if whole[k] is None]
                flat = [whole[k] for k in known]
                last = np.ones(len(flat), bool)
                if some and n > LONG_WORD:
                    rows = [self._merge_long(words[k]) for k in some]
                    flat += chain.from_iterable(rows)
                    last = np.append(last, _lasts(list(map(len, rows))))
                elif some:
                    ids, counts = self.fold(np.frombuffer(b"".join([words[k] for k in some]), np.uint8).reshape(len(some), n))
                    flat += ids[np.arange(n) < counts[:, None]].tolist()
                    last = np.append(last, _lasts(counts))
                codes = (np.array(flat, np.int64) + last * self.size).tolist()
                # A word's last number ends with a semicolon, and all words here have n bytes.
                places = known + some
                texts = b"".join(map(self.decimal.__getitem__, codes)).split(b";")
                bytes_ = b"".join(map(self.pieces.__getitem__, flat))
                for i, k in enumerate(places):
                    numbers[k], decoded[k] = texts[i], bytes_[i * n : i * n + n]
        return numbers, decoded

    def learn(self, words: Iterable[str]) -> None:
        """Put at least these words into ``numbers``, with the decimal text of their ids, and ``decoded``, with the bytes that those stand for.

        Remembered are the words of the last two generations of ``CACHE_WORDS`` or more.
        """
        if len(self.numbers) > CACHE_WORDS:
            self.older, self.numbers, self.decoded = (self.numbers, self.decoded), {}, {}
        new = set(words).difference(self.numbers)
        if self.older:
            numbers, decoded = self.older
            again = new.intersection(numbers)
            self.numbers.update((w, numbers[w]) for w in again)
            self.decoded.update((w, decoded[w]) for w in again)
            new -= again
        new = list(new)
        numbers, decoded = self.merge([w.encode() for w in new])
        self.numbers.update(zip(new, numbers, strict=True))
        self.decoded.update(zip(new, decoded, strict=True))

    def runs(self, texts: Iterable[str]) -> Iterator[Iterator[list[str]]]:
        """The words of every text, in one or more lists, each learned when it is given out.

        Words of several short texts are learned together; a long text's are never all in memory.
        """
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) <= LONG_TEXT:
                waiting.append((self.split_ascii if text.isascii() else self.split).findall(text))
                size += len(text)
                if size <= LONG_TEXT:
                    continue
            self.learn(chain.from_iterable(waiting))
            yield from ([words] for words in waiting)
            waiting, size = [], 0
            if len(text) > LONG_TEXT:
                yield self._long_run(text)
        self.learn(chain.from_iterable(waiting))
        yield from ([words] for words in waiting)

    def _long_run(self, text: str) -> Iterator[list[str]]:
        found = (self.split_ascii if text.isascii() else self.split).finditer(text)
        while words := [m[0] for m in islice(found, WORDS_AT_ONCE)]:
            self.learn(words)
            yield words

    def decimals(self, words: list[str]) -> bytes:
        """The ids of learned words as comma-joined decimals."""
        return b",".join(map(self.numbers.__getitem__, words))

    def encode(self, text: str) -> list[int]:
        return [int(i) for run in self.runs([text]) for words in run if words for i in self.decimals(words).split(b",")]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """The codec of a broadcast rank map; a Python worker makes it once for all its tasks."""
    ranks = shared.value
    if id(ranks) not in _codecs:
        _codecs.clear()
        _codecs[id(ranks)] = Codec(ranks)
    return _codecs[id(ranks)]


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    for x in batch.column(name):
        yield x.as_py() or ""


def _vocabulary(df: DataFrame, path: str | None):
    return df.sparkSession.sparkContext.broadcast(load_ranks(path or default_vocabulary()))


def encode(df: DataFrame, text: str = "text", path: str | None = None, out: str = "ids") -> DataFrame:
    """``df`` with the ids of its texts as ``array<int>``."""
    ranks = _vocabulary(df, path)
    kept = [c for c in df.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out) + f", `{out}` array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks)
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                flat, ends = [np.zeros(0, np.int32)], [0]
                for words in codec.runs(_texts(batch, text)):
                    some = [np.fromstring(codec.decimals(w), np.int32, sep=",") for w in words if w]
                    flat += some
                    ends.append(ends[-1] + sum(map(len, some)))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), ids], [*kept, out])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for; a null is empty."""
    ranks = _vocabulary(df, path)
    kept = [c for c in df.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out) + f", `{out}` binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks)
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                texts = pa.array([codec.decode(x.as_py() or ()) for x in batch.column(ids)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], [*kept, out])

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of df(doc_id, text), without moving the ids to the JVM."""
    ranks = _vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for run_of_text in codec.runs(_texts(batch, "text")):
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for words in run_of_text:
                    if words:
                        numbers = codec.decimals(words)
                        of_ids.update(b"," * (n > 0) + numbers)
                        of_text.update(b"".join(map(codec.decoded.__getitem__, words)))
                        n += numbers.count(b",") + 1
                counts.append(n)
                ids_sha.append(of_ids.hexdigest())
                text_sha.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_native(words: DataFrame, word: str = "word", path: str | None = None, out: str = "ids") -> DataFrame:
    """The fold by higher-order functions, for tables of distinct non-empty words.

    The rank map is a literal array of small maps, addressed by the CRC of the
    piece: a map of all ranks would be searched from end to end at every step.
    """
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for piece, rank in load_ranks(path or default_vocabulary()).items():
        slots[zlib.crc32(piece) % SLOTS][piece.hex().upper()] = rank
    table = F.from_json(F.lit(json.dumps(slots)), "array<map<string,int>>")

    def rank(piece):
        return F.try_element_at(F.element_at(table, (F.crc32(piece) % SLOTS + 1).cast("int")), F.hex(piece))

    body = F.col(word).cast("binary")
    parts = F.transform(F.sequence(F.lit(1), F.octet_length(body)), lambda i: F.substring(body, i, F.lit(1)))

    def step(a, _):
        pairs = F.transform(F.sequence(F.lit(1), F.size(a) - 1), lambda i: F.struct(rank(F.concat(F.element_at(a, i), F.element_at(a, i + 1))).alias("r"), i.alias("i")))
        best = F.array_min(F.filter(pairs, lambda p: p["r"].isNotNull()))
        i = best["i"]
        merged = F.concat(F.slice(a, F.lit(1), i - 1), F.array(F.concat(F.element_at(a, i), F.element_at(a, i + 1))), F.slice(a, i + 2, F.size(a)))
        return F.when((F.size(a) > 1) & best.isNotNull(), merged).otherwise(a)

    folded = F.aggregate(F.sequence(F.lit(1), F.octet_length(body)), parts, step)
    return words.withColumn(out, F.transform(folded, rank))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and what they decode to, as digests."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
