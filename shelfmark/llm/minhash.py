"""Near-duplicates by fast similarity sketches, banding and exact verification.

Shingles are of two words in ``op5_minhash`` and of five in the pipeline.

The sketch is that of Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching"
(2017): in each round every shingle is hashed into one of t bins with a value,
bins keep the least value of the first round that reaches them, and after t such
rounds each further round fills one given bin, so every coordinate is filled
after at most 2t rounds. Coordinates agree with probability the Jaccard
similarity, with concentration bounds like those of t independent hashes.

Plan. Texts with equal shingle sets are one class, represented by its smallest
doc_id. Classes that share a band of the sketch are candidates:

1. band after band (``ROUNDS`` of them at a time), a bucket's members are compared
   with its smallest member, unless links found before have put both into one
   component, and the components are closed again;
2. then, only in buckets whose members are not all in one component, pairs from
   different components are compared: as rows in buckets of up to ``FEW`` members,
   and tile against tile inside a task in larger ones, where only links leave it.

So a bucket of many copies costs a pass over its members, and no pair that could
join two components is left out. Pairs are first screened by four bits of each
coordinate (a pair at the threshold fails that screen with a probability under
1e-6) and then verified on the full shingle sets. With 51 bands of 5
coordinates, a pair of similarity 0.8 shares no band with probability 2e-9.
Members of one bucket that are all just under the threshold cost work, though not
rows, in the square of their number: each pair of them has to be ruled out.

Cases: a text without words (or null) has an empty set and links with nothing;
a row with a null doc_id gets the component of a class with equal shingles, if there
is one, and is never marked kept, but ``deduplicate`` lets such rows stay, once a
text; repeated rows have equal results; an empty table gives an empty result; extra
columns are ignored by the query and pass through ``deduplicate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.textbytes import batch_bytes, mix64, shingle_sets
from shelfmark.plans.graph import connected_components
from shelfmark.plans.shared import drop_shared, shared_table

COORDINATES = 256
BANDS, BAND_ROWS = 51, 5
#: First bands of the rounds in which bucket heads are compared.
ROUNDS = (0, 3)
#: Coordinates, of 256, whose four bits differ, beyond which a pair is not verified: at the
#: threshold 48 are expected with a standard deviation of 6.2; this is five of them more.
MAX_APART = 80
PERCENT = 80
#: Members of a bucket up to which its pairs are rows.
FEW = 16
#: Members, and shingles of all their sets, in a tile of a larger bucket.
TILE, TILE_SHINGLES = 512, 1 << 21
#: Columns of a tile product that are dense at once.
COLUMNS = 2048
_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def fast_sketch(sets: np.ndarray, offsets: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """(n, t) sketches of n sets given one after the other; rows of empty sets hold the largest value."""
    n = len(offsets) - 1
    out = np.full(n * t, _EMPTY, _U)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    items = sets
    for i in range(2 * t):
        if not len(items):
            break
        with np.errstate(over="ignore"):
            h = mix64(items + _U(i + 1) * _U(0x9E3779B97F4A7C15))
        place = (h % _U(t)).astype(np.int64) if i < t else np.full(len(items), i - t)
        value = (_U(i) << _U(48)) | (h >> _U(16))
        np.minimum.at(out, owner * t + place, value)
        open_ = (out.reshape(n, t) == _EMPTY).any(axis=1)
        more = open_[owner]
        items, owner = items[more], owner[more]
    return out.reshape(n, t)


def bands_of(sketch: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of the sketch's bands; the band's number is part of the hash."""
    part = sketch[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=_U) * _U(0xC2B2AE3D27D4EB4F)), part.shape[:2]).copy()
        for j in range(BAND_ROWS):
            h = mix64(h * _U(0x9E3779B97F4A7C15) ^ part[:, :, j])
    return h.view(np.int64)


def bits_of(sketch: np.ndarray) -> np.ndarray:
    """(n, 16) words of four bits of each of 256 coordinates."""
    four = (mix64(sketch) >> _U(60)).astype(np.uint8)
    return np.ascontiguousarray(four[:, 0::2] << 4 | four[:, 1::2]).view(np.int64)


def _docs_at_a_time(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` text bytes; a longer text is a slice of its own."""
    _, offsets = batch_bytes(batch.column("text"))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def _longs(values: np.ndarray, width: int) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).reshape(-1))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), flat)


def _sketched(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _docs_at_a_time(whole):
            sets, at = shingle_sets(*batch_bytes(batch.column("text")), width)
            sketch = fast_sketch(sets, at)
            keys = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(at)), pa.array(keys, pa.binary()), _longs(bits_of(sketch), 16), _longs(bands_of(sketch), BANDS)],
                ["doc_id", "text_key", "n_shingles", "set_key", "bits", "bands"],
            )


def _with_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _docs_at_a_time(whole):
            sets, at = shingle_sets(*batch_bytes(batch.column("text")), width)
            keys = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at[:-1], at[1:], strict=True)]
            values = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(keys, pa.binary()), values], ["rep", "set_key", "shingles"])


def _apart(a: str, b: str):
    """How many coordinates' four bits differ."""

    def word(i: int):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))

    return reduce(lambda x, y: x + y, [word(i) for i in range(16)])


def _possible(pairs: DataFrame) -> DataFrame:
    """Pairs that size and sketch bits leave possible."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return pairs.filter((small * 100 >= large * PERCENT) & (_apart("bits_a", "bits_b") <= MAX_APART))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach the threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("both", both)
    union = F.size("set_a") + F.size("set_b") - F.col("both")
    return joined.filter(F.col("both") * 100 >= union * PERCENT).select(F.col("a").alias("src"), F.col("b").alias("dst"))


def _tile_pairs(table: pa.Table) -> pa.Table:
    """The pairs of one or two tiles that parts, sizes and sketch bits leave possible and no earlier band has met."""
    band, i, j = (table.column(c)[0].as_py() for c in ("band", "i", "j"))
    no, tile = table.column("no")[0].as_py(), table.column("tile").to_numpy()
    rep, part, n = (table.column(c).to_numpy() for c in ("rep", "part", "n"))
    bits, bands = (table.column(c).combine_chunks().flatten().to_numpy().reshape(len(rep), w) for c, w in (("bits", 16), ("bands", BANDS)))
    x, y = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    small, large = np.minimum.outer(n[x], n[y]), np.maximum.outer(n[x], n[y])
    open_ = (part[x][:, None] != part[y]) & (small * 100 >= large * PERCENT)
    if i == j:
        open_ &= rep[x][:, None] < rep[y]
    for k in range(no):
        open_ &= bands[x, k][:, None] != bands[y, k]
    a, b = np.nonzero(open_)
    apart = np.zeros(len(a), np.int64)
    for k in range(16):
        w = (bits[x[a], k] ^ bits[y[b], k]).view(_U)
        w |= w >> _U(1)
        w |= w >> _U(2)
        apart += np.bitwise_count(w & _U(0x1111111111111111))
    near = apart <= MAX_APART
    a, b = rep[x[a[near]]], rep[y[b[near]]]
    rows = [{"band": band, "i": i, "j": j, "a": a, "b": b}] if len(a) else []
    return pa.Table.from_pylist(rows, _TILED)


_TILED = pa.schema([("band", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))])


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[k] and b[k], exact; ``left`` and ``right`` are the distinct a and b."""
    if len(a) * 64 < len(left) * len(right):
        return np.array([len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for p, q in zip(a, b, strict=True)], np.int64)
    values, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = uses[column] > 1
    column, owner = (np.cumsum(uses > 1) - 1)[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(left), len(right)), np.int64)
    width = int((uses > 1).sum())
    for first in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, (first, first + COLUMNS))
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[owner[lo:hi], column[lo:hi] - first] = 1
        total += (dense[left] @ dense[right].T).astype(np.int64)
    return total[np.searchsorted(left, a), np.searchsorted(right, b)]


def _tile_links(pairs: pa.Table, members: pa.Table) -> pa.Table:
    """The pairs of a tile whose whole shingle sets reach the threshold."""
    reps = members.column("rep").to_numpy()
    order = np.argsort(reps)
    lists = members.column("shingles").combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    sets = [flat[at[k] : at[k + 1]] for k in order]
    reps = reps[order]
    a, b = (np.searchsorted(reps, pairs.column(c)[0].values.to_numpy()) for c in "ab")
    both = _common(sets, np.unique(a), np.unique(b), a, b)
    sizes = np.array([len(s) for s in sets], np.int64)
    linked = both * 100 >= (sizes[a] + sizes[b] - both) * PERCENT
    return pa.table({"src": reps[a[linked]], "dst": reps[b[linked]]})


def _tiled_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between parts inside large buckets, of members(band, no, rep, part, n, bits, bands, tiles)."""
    tiled = members.withColumn("tile", F.pmod(F.xxhash64("rep", "band"), "tiles"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    tiled = tiled.select("band", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "no", "tile", "rep", "part", "n", "bits", "bands")
    key = ["band", "i", "j"]
    pairs = shared_table(tiled.groupBy(*key).applyInArrow(_tile_pairs, "band long, i long, j long, a array<long>, b array<long>"), "tile_pairs")
    of = [f"of_{k}" for k in key]
    needed = pairs.select(*(F.col(k).alias(o) for k, o in zip(key, of, strict=True)), F.explode(F.array_distinct(F.concat("a", "b"))).alias("rep"))
    needed = needed.join(sets.select("rep", "shingles"), "rep")
    links = pairs.groupBy(*key).cogroup(needed.groupBy(*of)).applyInArrow(_tile_links, "src long, dst long")
    out = shared_table(links, "tile_links")
    drop_shared(pairs)
    return out


def _with_links(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after ``links``; only the graph of earlier components and new links is closed."""
    if parts is None:
        found = connected_components(links)
        out = shared_table(found, "parts")
        drop_shared(found)
        return out
    p, q = (parts.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}")) for x in ("src", "dst"))
    between = links.join(p, "src", "left").join(q, "dst", "left")
    between = between.select(F.coalesce("part_src", "src").alias("src"), F.coalesce("part_dst", "dst").alias("dst"))
    found = connected_components(between)
    closed = shared_table(found, "closed")
    drop_shared(found)
    moved = closed.select(F.col("node").alias("component"), F.col("component").alias("into"))
    old = parts.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    out = shared_table(old.unionByName(closed.join(parts, "node", "left_anti")), "parts")
    drop_shared(closed, parts)
    return out


def near_duplicates(docs: DataFrame, width: int = 2) -> DataFrame:
    """(doc_id, n_shingles, set_key, component_id, kept, text_key) per row of docs(doc_id, text), on shingles of ``width`` words.

    A table is deleted as soon as its last reader has run; the result reads two narrow ones.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = shared_table(
        docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(
            lambda batches: _sketched(batches, width), "doc_id long, text_key long, n_shingles long, set_key binary, bits array<long>, bands array<long>"
        ),
        "sketches",
    )
    classes = shared_table(
        sketched.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"), F.first("bands").alias("bands")),
        "classes",
    )
    rows = shared_table(sketched.select("doc_id", "text_key", "n_shingles", "set_key"), "set_keys")
    drop_shared(sketched)
    in_band = classes.select("rep", "n", F.posexplode("bands").alias("no", "band"))
    heads = shared_table(
        in_band.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("members")).filter("members > 1").drop("members"), "buckets"
    )
    members = shared_table(in_band.join(heads, "band"), "members")
    drop_shared(heads)
    about = classes.select("rep", "n", "bits")
    a = about.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = about.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    candidates = shared_table(members.select("rep").distinct().join(classes.select("rep", "set_key"), "rep"), "candidates")
    # The candidates of a part of the documents are small beside its texts, which need no sorting then.
    wanted = candidates.select(F.col("rep").alias("doc_id")).hint("shuffle_hash")
    texts = docs.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("rep"), "text")
    built = texts.mapInArrow(lambda batches: _with_sets(batches, width), "rep long, set_key binary, shingles array<long>")
    # A doc_id may come with several texts; the representative's is the one with its class's key.
    sets = shared_table(built.join(candidates, ["rep", "set_key"], "left_semi").dropDuplicates(["rep"]), "shingle_sets")
    drop_shared(candidates)
    tests, parts = [], None
    for first, last in zip(ROUNDS, (*ROUNDS[1:], BANDS), strict=True):
        to_head = members.filter((F.col("no") >= first) & (F.col("no") < last) & (F.col("rep") != F.col("head"))).select(F.col("head").alias("a"), F.col("rep").alias("b"))
        if parts is not None:
            p, q = (parts.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}")) for x in "ab")
            to_head = to_head.join(p, "a", "left").join(q, "b", "left").filter(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")
        near = shared_table(_possible(to_head.distinct().join(a, "a").join(b, "b")).select("a", "b"), "head_pairs")
        found = shared_table(_verified(near, sets), "head_links")
        tests.append(near)
        parts = _with_links(parts, found)
        drop_shared(found)
    placed = members.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    placed = shared_table(placed.select("band", "no", "rep", "n", F.coalesce("component", "rep").alias("part")), "placed")
    drop_shared(members)
    mixed = placed.groupBy("band").agg(F.min("part").alias("p0"), F.max("part").alias("p1"), F.count("*").alias("members"), F.sum("n").alias("shingles"))
    tiles = F.ceil(F.greatest(F.col("members") / TILE, F.col("shingles") / TILE_SHINGLES))
    mixed = shared_table(mixed.filter("p0 <> p1").select("band", "members", tiles.alias("tiles")), "mixed_buckets")
    few = placed.join(mixed.filter(F.col("members") <= FEW).select("band"), "band").join(about.select("rep", "bits"), "rep")
    few = shared_table(few, "few")
    x = few.select("band", F.col("rep").alias("a"), F.col("part").alias("part_a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    y = few.select("band", F.col("rep").alias("b"), F.col("part").alias("part_b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
    across = _possible(x.join(y, "band").filter("part_a <> part_b and a < b")).select("a", "b").distinct()
    tested = reduce(lambda s, t: s.unionByName(t), tests).distinct()
    across = shared_table(across.join(tested, ["a", "b"], "left_anti"), "across_pairs")
    drop_shared(few, *tests)
    many = placed.join(mixed.filter(F.col("members") > FEW).select("band", "tiles"), "band").join(classes.select("rep", "bits", "bands"), "rep")
    in_tiles = _tiled_links(many, sets)
    parts = _with_links(parts, _verified(across, sets).unionByName(in_tiles))
    drop_shared(placed, mixed, across, in_tiles, sets)
    of_class = classes.select("set_key", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = shared_table(of_class.select("set_key", F.coalesce("component", "rep").alias("of_class")), "class_components")
    drop_shared(classes, parts)
    rows = rows.join(of_class, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("of_class", "doc_id")).otherwise(F.col("doc_id"))
    rows = rows.withColumn("component_id", component)
    return rows.select("doc_id", "n_shingles", "set_key", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "text_key")


def deduplicate(docs: DataFrame, width: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest doc_id of each group, once, and every text without words.

    Rows are chosen by (doc_id, hash of the text) alone, and texts are shuffled once, to
    meet that choice. Of several rows with one doc_id and text, the one with the
    smallest hash of its other columns stays; only where there are any, a second pass
    is made for them.
    """
    key = ["_id", "_none", "_text"]
    of = lambda df, text: df.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_none": F.col("doc_id").isNull(), "_text": text})
    near = near_duplicates(docs, width).filter(F.col("kept") | F.col("doc_id").isNull())
    stay = shared_table(of(near, F.col("text_key")).groupBy(*key).agg(F.count("*").alias("times")), "stay")
    keyed = of(docs, F.xxhash64("text"))
    # At every size texts go to hash tables of ids; they are never sorted, and never on the side that is held in memory.
    whole = keyed.join(stay.filter("times = 1").select(*key).hint("shuffle_hash"), key, "left_semi").select(*docs.columns)
    if stay.filter("times > 1").isEmpty():
        return whole
    again = keyed.join(stay.filter("times > 1").select(*key), key, "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(*others) if others else F.lit(0))
    return whole.unionByName(again.groupBy(*key).agg(first.alias("row")).select("row.*"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on two-word shingles at 80 per cent."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, width=2).select("doc_id", "n_shingles", "component_id", "kept")


#: Shingles as pairs of words; a text of one word is that word and an empty second.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 1 THEN [ws[1] || chr(10)]
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || chr(10) || ws[i + 1]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), sets AS (SELECT doc_id, md5(string_agg(g, chr(11) ORDER BY g)) AS k FROM s GROUP BY 1
), rep AS (SELECT k, min(doc_id) AS r FROM sets GROUP BY 1
), rs AS (SELECT doc_id, g FROM s WHERE doc_id IN (SELECT r FROM rep)
), pairs AS (
  SELECT a.doc_id AS i, b.doc_id AS j FROM rs a JOIN rs b USING (g) WHERE a.doc_id < b.doc_id
  GROUP BY 1, 2
  HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE n.doc_id = a.doc_id) + (SELECT n FROM n WHERE n.doc_id = b.doc_id) - count(*))
), edges AS (SELECT i, j FROM pairs UNION ALL SELECT j, i FROM pairs
), reach AS (
  SELECT r AS i, r AS j FROM rep
  UNION
  SELECT reach.i, e.j FROM reach JOIN edges e ON reach.j = e.i
), comp AS (SELECT i, min(j) AS c FROM reach GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.c, w.doc_id) AS component_id,
       w.doc_id = coalesce(comp.c, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN sets ON sets.doc_id = w.doc_id
LEFT JOIN rep ON rep.k = sets.k LEFT JOIN comp ON comp.i = rep.r
"""
