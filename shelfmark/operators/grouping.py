"""Grouping: blocking, similarity within blocks, components, medoids, readable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfmark.functions import parse as P
from shelfmark.functions import text as T
from shelfmark.operators import tiles
from shelfmark.operators import vectors as V
from shelfmark.plans.graph import connected_components
from shelfmark.plans.shared import drop_shared, shared_table

LEADING = "renewed|refurbished|restored|certified|open|box"


def with_block(df: DataFrame) -> DataFrame:
    """``df`` with b_sub, b_brand and b_bucket."""
    sub = F.coalesce(F.nullif(F.trim(F.lower(T.or_empty(F.col("sub_category")))), F.lit("")), F.lit("unknown"))
    return df.withColumns({
        "b_sub": sub,
        "b_brand": F.coalesce(T.normalize_brand(F.col("brand")), F.lit("_unknown")),
        "b_bucket": P.size_bucket(sub, F.col("axes.size.screen_inches")),
    })


BLOCK = ["b_sub", "b_brand", "b_bucket"]


def family_phrase(title: Column, brand: Column) -> Column:
    """The first five words of a title after its brand and after words on condition."""
    b = F.trim(F.lower(F.coalesce(brand, F.lit(""))))

    def phrase(whole: Column) -> Column:
        words = F.split(whole, " ")
        rest = F.when((b != "") & (words[0] == b), F.array_join(F.slice(words, 2, 10_000), " ")).otherwise(whole)
        head = F.array_join(F.slice(F.split(F.regexp_replace(rest, rf"^(?:(?:{LEADING})(?: |$))+", ""), " "), 1, 5), " ")
        return T.bound(F.trim(head), lambda h: F.when(h != "", h).otherwise(whole))

    return T.bound(T.canonical_title(title), phrase)


def base_group_id(brand: Column, title: Column) -> Column:
    b = F.lower(F.coalesce(brand, F.lit("unknown")))
    return F.concat_ws("_", b, T.slugify(family_phrase(title, b)), P.extract_year(title))


def nearest(rows: DataFrame, row: str, times: Column | None = None) -> DataFrame:
    """(component, medoid) of rows(row, component, terms, weights): the row most similar to its component's centroid; ties go to the smallest row."""
    sims = tiles.to_centroids(rows.filter("size(terms) > 0"), row, "component", times)
    every = rows.select(row, "component").join(sims, row, "left").withColumn("sim", F.round(F.coalesce("sim", F.lit(0.0)), 9))
    return every.groupBy("component").agg(F.max_by(row, F.struct("sim", -F.col(row))).alias("medoid"))


def medoids(weights: DataFrame, row: str, parts: DataFrame) -> DataFrame:
    """(component, medoid) as :func:`nearest` finds them; ``weights`` has (row, term, weight), ``parts`` has (row, component)."""
    return nearest(parts.join(V.packed(weights, row), row, "left"), row)


def numbered_links(rows: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """(src, dst) that connect rows(row_id, tid, block columns) of one block whose titles' units(tid, terms, weights) are alike.

    Copies of a title in a block are linked to the first of them; the firsts are connected by
    a forest of their links. A title without terms is like nothing, not even its copy.
    """
    first = shared_table(rows.groupBy(*BLOCK, "tid").agg(F.min("row_id").alias("first"), F.count("*").alias("copies")), "distinct_titles")
    known = units.filter("size(terms) > 0")
    some = first.filter("copies > 1").join(known.select("tid"), "tid").drop("copies")
    copies = rows.join(some, [*BLOCK, "tid"]).filter("row_id <> first").select(F.col("first").alias("src"), F.col("row_id").alias("dst"))
    return tiles.links(first.join(known, "tid"), "first", BLOCK, threshold, connecting=True).unionByName(copies)


def title_links(rows: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """:func:`numbered_links` of rows(row_id, t, block columns) with titles t, whose terms are weights(row_id, term, weight)."""
    ids = rows.groupBy("t").agg(F.min("row_id").alias("tid"))
    units = V.packed(weights.withColumnRenamed("row_id", "tid").join(ids.select("tid"), "tid", "left_semi"), "tid")
    return numbered_links(rows.join(ids, "t").drop("t"), units, threshold)


def group_products(df: DataFrame, threshold: float = 0.82, vector: str | None = None, min_df: int = 3, max_df: float = 0.95,
                   with_members: bool = False) -> tuple[DataFrame, DataFrame]:
    """``df`` with group_id, and (group_id, brand, family, generation).

    Rows of a block are linked at a cosine of ``threshold``; with a ``vector`` column
    those vectors are compared, else TF-IDF weights of titles over all rows.
    ``with_members`` adds member_ids, an array that is as long as a group is large; the
    members are also the rows of the first result with that group_id.
    """
    rows = shared_table(with_block(df).select("row_id", "name", *BLOCK, *([vector] if vector else [])), "blocked")
    if vector:
        pairs = tiles.links(rows, "row_id", BLOCK, threshold, vector, connecting=True)
    else:
        titles = shared_table(rows.select("row_id", *BLOCK, T.canonical_title(F.col("name")).alias("t")), "titles")
        # A title's terms are weighed and compared once, however many rows have it.
        distinct = shared_table(titles.groupBy("t").agg(F.min("row_id").alias("tid"), F.count("*").alias("copies")), "title_ids")
        units = V.packed_tfidf(distinct, "tid", "t", min_df, max_df, "copies", "title_weights")
        raw, titles = titles, shared_table(titles.join(distinct, "t").select("row_id", *BLOCK, "tid"), "numbered_titles")
        drop_shared(raw, distinct)
        pairs = numbered_links(titles, units, threshold)
    joined = connected_components(pairs)
    found = joined.withColumnRenamed("node", "row_id")
    parts = shared_table(rows.select("row_id").join(found, "row_id", "left").select("row_id", F.coalesce("component", "row_id").alias("component")), "group_parts")
    drop_shared(joined)
    if vector:
        dims = F.sequence(F.lit(0), F.size(vector) - 1)
        chosen = nearest(parts.join(rows.select("row_id", dims.alias("terms"), V.unit(F.col(vector)).alias("weights")), "row_id"), "row_id")
    else:
        # The rows of a component that have one title are equally near; the first stands for all.
        same = parts.join(titles, "row_id").groupBy("component", "tid").agg(F.min("row_id").alias("row_id"), F.count("*").alias("copies"))
        same = shared_table(same, "component_titles")
        chosen = nearest(same.join(units, "tid", "left"), "row_id", F.col("copies"))
    chosen = chosen.withColumnRenamed("medoid", "row_id")
    named = rows.select("row_id", "name", *BLOCK).join(chosen, "row_id")
    brand = F.when(F.col("b_brand") != "_unknown", F.col("b_brand"))
    named = named.withColumns({"brand": brand, "base": base_group_id(brand, F.col("name")), "family": family_phrase(F.col("name"), F.coalesce(brand, F.lit("unknown"))), "generation": P.extract_year(F.col("name"))})
    use = F.row_number().over(W.partitionBy("base").orderBy(*BLOCK, "row_id"))
    named = named.withColumn("_use", use)
    named = named.withColumn("group_id", F.when(F.col("_use") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("_use").cast("string"))))
    named = shared_table(named.select("component", "group_id", "brand", "family", "generation"), "groups")
    drop_shared(rows, *([] if vector else [titles, units, same]))
    assigned = parts.join(named.select("component", "group_id"), "component").select("row_id", "group_id")
    groups = named
    if with_members:
        groups = named.join(parts.groupBy("component").agg(F.sort_array(F.collect_list("row_id")).alias("member_ids")), "component")
    return df.join(assigned, "row_id"), groups.drop("component")
