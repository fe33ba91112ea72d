"""TF-IDF weights as rows, dense vectors, cosines and centroids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.operators import tiles
from shelfmark.plans.shared import drop_shared, shared_table

TOKEN = r"(?U)\b\w\w+\b"


def terms(c: Column) -> Column:
    """Lower-case one- and two-grams of tokens of two characters or more."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0))

    def grams(w: Column) -> Column:
        pairs = F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda x, y: F.concat(x, F.lit(" "), y))
        return F.concat(w, F.filter(pairs, lambda p: p.isNotNull()))

    # Bound as a lambda's variable, the words are extracted once.
    return F.flatten(F.transform(F.array(words), grams))


#: Characters of a chunk, whose terms one task counts: of a large vocabulary, where that is enough for all cores, and of a small one.
TASK_CHARS, LEAST_CHARS = 8_000_000, 1_000_000
#: Terms of a vocabulary that is sent to every executor.
SENT_TERMS = 200_000


def term_counts(df: DataFrame, row: str, text: str, *kept: str, large: bool = False) -> DataFrame:
    """(_chunk, row, term, tf), and the columns ``kept``, which depend on the row.

    Whole texts are dealt out to chunks by row, each once, and not their terms, which are several times
    as long; a row's terms are counted where its text is, and whatever is grouped by row or chunk stays there.
    """
    chars = df.agg(F.sum(F.length(text))).first()[0] or 0
    chunks = 1 + (max(chars // TASK_CHARS, min(chars // LEAST_CHARS, 2 * df.sparkSession.sparkContext.defaultParallelism)) if large else chars // LEAST_CHARS)
    placed = df.select(row, *kept, F.col(text).alias("_text"), F.pmod(F.xxhash64(row), F.lit(chunks)).cast("int").alias("_chunk"))
    texts = placed.repartitionById(chunks, F.col("_chunk"))
    found = texts.select("_chunk", row, *kept, F.explode(terms(F.col("_text"))).alias("term"))
    counts = found.groupBy("_chunk", row, *kept, "term").agg(F.count("*").alias("tf"))
    counts._chunks = chunks
    return counts


def _kept(found: DataFrame, n: int, min_df: int, max_df: float) -> DataFrame:
    return found.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n))


def frequencies(counts: DataFrame, n: int, min_df: int = 3, max_df: float = 0.95, copies: str | None = None) -> DataFrame:
    """(term, df) of the terms in at least ``min_df`` rows and at most a share of ``max_df`` of all n; a row counts ``copies`` times."""
    return _kept(counts.groupBy("term").agg((F.sum(copies) if copies else F.count("*")).alias("df")), n, min_df, max_df)


def chunk_frequencies(counts: DataFrame, n: int, min_df: int = 3, max_df: float = 0.95, copies: str | None = None) -> DataFrame:
    """(_chunk, term, df): those of :func:`frequencies` that each chunk has.

    Only a chunk's distinct terms are shuffled, with the number of its rows that have them. Those with one first
    word are one row with a text of their second words: most terms are rare ones, and they take a fraction so.
    """
    own = counts.groupBy("_chunk", "term").agg((F.sum(copies) if copies else F.count("*")).alias("_own"))
    first = F.substring_index("term", " ", 1)
    words = own.select("_chunk", "_own", first.alias("_first"), F.substring("term", F.length(first) + 2, F.length("term")).alias("_second"))
    lists = words.groupBy("_chunk", "_first").agg(F.collect_list(F.struct("_second", "_own")).alias("e"))
    sent = lists.select("_chunk", "_first", F.array_join("e._second", " ").alias("_seconds"), F.col("e._own").alias("_owns")).repartition(counts._chunks, "_first")
    back = sent.select("_chunk", "_first", F.inline(F.arrays_zip(F.split("_seconds", " ").alias("_second"), F.col("_owns").alias("_own"))))
    found = back.withColumn("df", F.sum("_own").over(W.partitionBy("_first", "_second")))  # a term has a row a chunk
    return _kept(found, n, min_df, max_df).select("_chunk", F.rtrim(F.concat("_first", F.lit(" "), "_second")).alias("term"), "df")


def with_frequencies(counts: DataFrame, frequency: DataFrame) -> DataFrame:
    """``counts`` with the frequencies of their terms; those of chunks are sent to the chunks, and pairs of rows and terms stay where they are."""
    if "_chunk" not in frequency.columns:
        return counts.join(frequency, "term")
    return counts.join(frequency.repartitionById(counts._chunks, F.col("_chunk")).hint("shuffle_hash"), ["_chunk", "term"])


def weighted(counts: DataFrame, frequency: DataFrame, n: int, row: str) -> DataFrame:
    """(row, term, weight): sublinear tf times smoothed idf, of unit length per row."""
    raw = with_frequencies(counts, frequency).select("_chunk", row, "term", ((1 + F.log("tf")) * (F.log((1 + n) / (1 + F.col("df"))) + 1)).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("_chunk", row)))  # over a row's own terms
    return raw.select(row, "term", (F.col("w") / norm).alias("weight"))


def tfidf(df: DataFrame, row: str, text: str, min_df: int = 3, max_df: float = 0.95, copies: str | None = None, large: bool = False) -> DataFrame:
    """(row, term, weight) of every row that has a term, over all rows; a row stands for ``copies``.

    The frequencies are written first: a small vocabulary is then broadcast, and nothing but the texts is shuffled. Of one that
    is ``large``, each chunk of texts gets what it has: that takes longer, but pairs of rows and terms are not shuffled at any size.
    """
    counts = term_counts(df, row, text, *([copies] if copies else []), large=large)
    n = df.agg(F.sum(copies) if copies else F.count("*")).first()[0] or 0
    found = (chunk_frequencies if large else frequencies)(counts, n, min_df, max_df, copies)
    return weighted(counts, shared_table(found, "term_frequency"), n, row)


def packed_tfidf(df: DataFrame, row: str, text: str, min_df: int = 3, max_df: float = 0.95, copies: str | None = None, name: str = "weights") -> DataFrame:
    """(row, terms, weights), written: the weights of :func:`tfidf` before rows are brought to unit length, and terms as numbers.

    Such weights take few values and such terms few bytes, so the table and its shuffles are a
    fraction of those of texts; a row's length is found again where its arrays are read.
    """
    counts = term_counts(df, row, text, *([copies] if copies else []))
    n = df.agg(F.sum(copies) if copies else F.count("*")).first()[0] or 0
    numbered = frequencies(counts, n, min_df, max_df, copies).withColumn("_id", F.monotonically_increasing_id())
    frequency = shared_table(numbered, "term_frequency")
    sent = F.broadcast(frequency) if frequency.count() <= SENT_TERMS else frequency
    raw = (1 + F.log("tf")) * (F.log((1 + n) / (1 + F.col("df"))) + 1)
    own = counts.join(sent, "term").groupBy(row).agg(F.collect_list(F.struct("_id", raw.alias("w"))).alias("e"))
    out = shared_table(own.select(row, F.col("e._id").alias("terms"), F.col("e.w").alias("weights")), name)
    drop_shared(frequency)
    return out


def packed(weights: DataFrame, row: str) -> DataFrame:
    """(row, terms, weights): a row's own terms as two arrays."""
    e = weights.groupBy(row).agg(F.collect_list(F.struct("term", "weight")).alias("e"))
    return e.select(row, F.col("e.term").alias("terms"), F.col("e.weight").alias("weights"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector at unit length; a zero vector stays."""
    n = norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(0.0))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-12))


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, centroid): the mean of unit vectors, at unit length; sums are partial before the shuffle."""
    parts = df.select(key, F.posexplode(unit(F.col(vector)))).groupBy(key, "pos").agg(F.avg("col").alias("v"))
    whole = parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda x: x["v"]).alias("mean"))
    return whole.select(key, unit(F.col("mean")).alias("centroid"))


def similar_pairs(df: DataFrame, row: str, block: list[str], vector: str, threshold: float) -> DataFrame:
    """(src, dst, sim) of one block with cosine >= threshold, from products of tiles of the block's rows."""
    return tiles.links(df, row, block, threshold, vector)


def similar_rows(weights: DataFrame, row: str, block: DataFrame, block_columns: list[str], threshold: float) -> DataFrame:
    """(src, dst, sim) of sparse unit rows of one block with a cosine >= threshold.

    Only pairs that share a term of both rows' prefixes are compared. Terms are put in
    one order, rare ones first; a row's prefix is what is left when its most frequent
    terms are taken away while they are shorter than the threshold in all. If the first
    term that two rows share were outside a prefix, all that they share would be, and
    their product would be under the threshold. So no pair is lost, and a term that
    nearly every row has brings rows together only where it makes up most of one.
    """
    order = weights.groupBy("term").agg(F.count("*").alias("_df"))
    behind = W.partitionBy(row).orderBy(F.col("_df").desc(), "term")  # a row's own terms only
    ranked = weights.join(order, "term").withColumn("_length", F.sum(F.col("weight") * F.col("weight")).over(behind))
    prefix = ranked.filter(F.col("_length") >= (threshold - 1e-9) ** 2).select(row, "term").join(block, row)
    a = prefix.select(*block_columns, "term", F.col(row).alias("src"))
    b = prefix.select(*block_columns, "term", F.col(row).alias("dst"))
    pairs = a.join(b, [*block_columns, "term"]).filter("src < dst").select("src", "dst").distinct()
    whole = weights.groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("term", "weight"))).alias("m"))  # a row's own terms
    of = lambda name, m: whole.select(F.col(row).alias(name), F.col("m").alias(m))
    terms_ = F.map_entries("ma")
    sim = F.aggregate(terms_, F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(F.col("mb"), e["key"]), F.lit(0.0)))
    found = pairs.join(of("src", "ma"), "src").join(of("dst", "mb"), "dst").select("src", "dst", sim.alias("sim"))
    return found.filter(F.col("sim") >= threshold - 1e-9)
