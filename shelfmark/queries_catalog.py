"""Queries of the catalog operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import parse as P
from shelfmark.functions import specs as S
from shelfmark.functions import text as T
from shelfmark.operators import axes, bundles, grouping, models, quality, reports, scoring, tiles, variants, vectors
from shelfmark.plans.graph import connected_components
from shelfmark.plans.shared import new_path, only_result, only_results, shared_table
from shelfmark.sources import products as feed
from shelfmark.sources.catalog import catalog
from shelfmark.sources.sinks import export_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Compatibility forms of " fi A1 2 e" with a combining accent on the last.
COMPATIBLE = " \ufb01 \uff21\uff11 \u00b2 e\u0301"
#: Similarity threshold of the queries on the embeddings table.
TAU = 0.30
#: And of the grouping of the derived catalog, whose titles have few words in common.
GROUP_TAU = 0.40


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def on_catalog(name: str, **columns) -> None:
    """Register a query that computes columns over the raw catalog."""
    QUERIES[name] = lambda spark, d: enriched(spark, d).select("product_id", *[c().alias(n) for n, c in columns.items()])


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return feed.enrich(catalog(spark, d), clean=False)


def with_axes(spark: SparkSession, d: str) -> DataFrame:
    return axes.infer_axes(enriched(spark, d))


_prepared: dict[tuple[str, str, str], DataFrame] = {}


def prepared(spark: SparkSession, d: str, make: Callable[[], tuple[DataFrame, ...]], *names: str) -> DataFrame:
    """The first of the frames that ``make`` gives, each written once for a session and a folder: the queries that start from them share them."""
    catalog(spark, d)  # written before, as it stays
    key = lambda name: (spark.sparkContext.applicationId, d, name)
    if key(names[0]) not in _prepared:
        _prepared.update(zip(map(key, names), only_results(make, *names), strict=True))
    return _prepared[key(names[0])]


def grouped(spark: SparkSession, d: str) -> DataFrame:
    """The catalog with axes and the groups that the whole grouping finds."""
    columns = ("row_id", "product_id", "seller_id", "brand", "sub_category", "name", "ml_text", "axes")

    return prepared(spark, d, lambda: grouping.group_products(stored(with_axes(spark, d), *columns), GROUP_TAU), "grouped", "groups")


def groups_of(spark: SparkSession, d: str) -> DataFrame:
    """(group_id, brand, family, generation)"""
    grouped(spark, d)
    return _prepared[(spark.sparkContext.applicationId, d, "groups")]


def with_variants(spark: SparkSession, d: str) -> DataFrame:
    return variants.build_variants(grouped(spark, d))[0]


def featured(spark: SparkSession, d: str) -> DataFrame:
    """The products with their groups, variants and the features that a score is made of."""
    rows = with_variants(spark, d)
    return prepared(spark, d, lambda: (scoring.features(rows, vectors.packed_tfidf(rows, "row_id", "ml_text")),), "featured")


def stored(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` written once: plans that read them several times, or nest more expressions on theirs, then start from a scan."""
    return shared_table(rows.select(*columns) if columns else rows, "rows")



# ---------------------------------------------------------------- sources
@query
def scan_csv(spark, d):
    path = new_path(spark, "feed")
    export_csv(catalog(spark, d), path)
    return feed.scan_csv(spark, [path]).select("product_id", "name", "details")


@query
def scan_projected(spark, d):
    """Two columns of a feed, one of them with a type of its own."""
    path = new_path(spark, "feed")
    export_csv(catalog(spark, d), path)
    return feed.scan_csv(spark, [path], ["product_id", "seller_id"], {"seller_id": "int"}).drop("_file", "_path")


@query
def union_sources(spark, d):
    rows = catalog(spark, d)
    odd = rows.filter("row_id % 2 = 1").select("product_id", "name", "brand")
    even = rows.filter("row_id % 2 = 0").select("product_id", "name")
    return even.unionByName(odd, allowMissingColumns=True)


@query
def sample_n(spark, d):
    return feed.sample_n(catalog(spark, d), 100, 42, "product_id").select("product_id", "name")


@query
def schema_backfill(spark, d):
    return feed.backfill(catalog(spark, d).drop("category", "model")).select("product_id", "category", "model", "brand")


@query
def json_parse_stats(spark, d):
    return feed.parse_stats(catalog(spark, d))


# ---------------------------------------------------------------- text
@query
def text_nfkc(spark, d):
    """Texts with some compatibility forms after them, which the tables themselves lack."""
    return table(spark, d, "documents").select("doc_id", F.md5(T.nfkc(F.concat("text", F.lit(COMPATIBLE)))).alias("text_md5"))


@query
def text_strip_ctrl(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.strip_ctrl(F.col("html"))).alias("text_md5"))


@query
def text_dehtml(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.dehtml(F.col("html"))).alias("text_md5"))


@query
def text_punct(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.punct(F.col("text"))).alias("text_md5"))


@query
def text_squeeze(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.squeeze(F.col("text"))).alias("text_md5"))


on_catalog("smart_case", title=lambda: T.prettify(F.col("name")))
on_catalog("model_code", model_code=lambda: T.model_code(F.when(F.col("row_id") % 5 == 0, " nan ").when(F.col("row_id") % 5 == 1, "  ").otherwise(F.concat(F.lit(" A  "), F.col("model")))))
on_catalog("ml_text", ml_text=lambda: F.col("ml_text"))
on_catalog("canonical_title", title=lambda: T.canonical_title(F.col("name")))
on_catalog("normalize_brand", brand_norm=lambda: T.normalize_brand(F.col("brand")))
on_catalog("normalize_color", color=lambda: T.normalize_color(S.spec_value(F.col("details_map"), "color")))
on_catalog("probe_clean", text=lambda: T.probe_clean(F.concat_ws(" ", F.col("name"), F.lit("\\n<b>NEW</b>\\t"), F.col("brief_description"))))
on_catalog("model_text", text=axes.model_text)


@query
def slugify(spark, d):
    return table(spark, d, "documents").select("doc_id", T.slugify(F.col("text")).alias("slug"))


# ---------------------------------------------------------------- parsers
_screen = lambda: P.parse_screen(F.col("name"))
on_catalog("parse_storage", storage_gb=lambda: P.parse_storage(F.col("name")))
on_catalog("parse_ram", ram_gb=lambda: P.parse_ram(F.col("name")))
on_catalog("parse_screen", screen_inches=_screen)
on_catalog("screen_valid", valid=lambda: P.screen_valid(F.col("sub_category"), _screen(), F.col("name")))
on_catalog("normalize_cpu", cpu=lambda: P.normalize_cpu(F.col("name")))
_gpu_text = lambda: F.concat_ws(" ", F.col("name"), F.element_at(F.array(*[F.lit(x) for x in ("Iris Xe", "RTX 4050", "GTX 960", "Radeon 680M", "Radeon", "10core Apple", "none")]), (F.col("row_id") % 7 + 1).cast("int")))
on_catalog("normalize_gpu", gpu=lambda: P.normalize_gpu(_gpu_text()))
_res_text = lambda: F.element_at(F.array(*[F.lit(x) for x in ("8K TV", "Ultra HD", "QHD", "Full  HD", "hd ready", "3840 x 2160", "3440x1440", "1920 x 1080", "100 x 200")]), (F.col("row_id") % 9 + 1).cast("int"))
on_catalog("normalize_resolution", resolution=lambda: P.normalize_resolution(_res_text()))
_hz_text = lambda: F.element_at(F.array(*[F.lit(x) for x in ("120 Hz", "refresh rate 60", "999hz refresh: 75", "10 hz", "none")]), (F.col("row_id") % 5 + 1).cast("int"))
on_catalog("normalize_refresh", refresh_hz=lambda: P.normalize_refresh(_hz_text()))
_panel_text = lambda: F.element_at(F.array(*[F.lit(x) for x in ("QD-OLED", "OLED", "Mini LED", "micro-led", "QLED", "IPS panel", "VA", "lava lcd", "led", "x")]), (F.col("row_id") % 10 + 1).cast("int"))
on_catalog("panel_type", panel=lambda: P.panel_type(_panel_text()))
on_catalog("condition", item_condition=lambda: P.condition(F.concat_ws(" ", F.col("name"), F.col("brief_description"))))
on_catalog("half_inch", half=lambda: P.half_inch(_screen() + F.col("row_id") % 4 / 4))
on_catalog("extract_year", year=lambda: P.extract_year(F.col("name")))
on_catalog("size_bucket", bucket=lambda: P.size_bucket(F.col("sub_category"), _screen()))
on_catalog("pack_qty", pack=lambda: P.pack_qty(F.col("name")))
on_catalog("cpu_readable", cpu=lambda: P.cpu_readable(P.normalize_cpu(F.col("name"))))
on_catalog("weird_chars", weird=lambda: P.weird_chars(F.concat(F.col("name"), F.when(F.col("row_id") % 3 == 0, "@").otherwise(""))))


@query
def storage_anomalies(spark, d):
    rows = catalog(spark, d).withColumn("name", F.concat(F.col("name"), F.when(F.col("row_id") % 17 == 0, " 20 TB 9000GB 5 MB").otherwise("")))
    return quality.storage_anomalies(rows)


@query
def screen_anomalies(spark, d):
    return quality.screen_anomalies(catalog(spark, d))


# ---------------------------------------------------------------- JSON and arrays
@query
def json_safe(spark, d):
    return table(spark, d, "events").select("event_id", S.spec_value(S.json_safe(F.col("props")), "k").alias("k"))


_ram_key = lambda: S.spec_value(F.col("specs"), "RAM Memory")
on_catalog("specs_map", ram=_ram_key, screen=lambda: S.spec_value(F.col("specs"), "Screen Size"), n=lambda: F.size("specs"))


@query
def canonical_specs(spark, d):
    rows = enriched(spark, d).select("product_id", F.explode("spec_entries").alias("e"))
    pairs = [(k, c) for c, keys in S.SYNONYMS.items() for k in keys]  # a fixed dimension of some 40 rows
    names = spark.createDataFrame(pairs, "key string, canonical string")
    return rows.join(F.broadcast(names), F.col("e.key") == names["key"]).select("product_id", "canonical", F.col("e.value").alias("value"))


on_catalog("spec_first", **{c: (lambda c=c: S.spec_first(F.col("spec_entries"), c)) for c in ("ram_gb", "screen_inches", "color", "condition")})
on_catalog(
    "spec_all", colors=lambda: F.array_join(S.spec_all(F.col("spec_entries"), "color"), "|"), has_color=lambda: S.spec_has(F.col("spec_entries"), "color"),
)
on_catalog("accessories_text", accessories=lambda: F.array_join(S.accessories_in(F.col("name")), ","))
on_catalog("array_dedupe", words=lambda: F.array_join(F.array_distinct(F.split(F.concat_ws(" ", F.col("name"), F.col("name")), " ")), " "))


@query
def json_key_counts(spark, d):
    return quality.key_counts(catalog(spark, d))


# ---------------------------------------------------------------- axes
@query
def weak_labels(spark, d):
    return axes.parsed(enriched(spark, d)).selectExpr("product_id", "p_ram as ram_gb", "p_storage as storage_gb", "p_screen as screen_inches", "p_color as color", "p_cpu as cpu")


@query
def label_index(spark, d):
    return axes.label_index(axes.parsed(enriched(spark, d)), "p_cpu")


@query
def axis_model(spark, d):
    """The class of RAM size that the text model gives every product, and how sure it is."""
    rows = stored(axes.parsed(enriched(spark, d)), "row_id", "product_id", "ml_text", "p_ram")
    rows = rows.join(models.TextVectors().fit(rows).transform(rows), "row_id")
    return models.TextClassifier().fit(rows, "p_ram").predict(rows, "guess").select("product_id", "p_ram", "guess", "guess_proba")


@query
def axes_imputed(spark, d):
    """Axes after the models of all five labels have filled what parsing left open, with the source of each value."""
    columns = ("row_id", "product_id", "name", "brand", "sub_category", "ml_text", "specs", "spec_entries", *models.AxisModeler.KINDS)
    rows = stored(axes.parsed(enriched(spark, d)), *columns)
    filled = models.AxisModeler().fit(rows).transform(rows)
    return filled.select("product_id", *models.AxisModeler.KINDS, *[f"{k[2:]}_src" for k in models.AxisModeler.KINDS])


def _axis(name_: str, *members: str) -> None:
    QUERIES[name_] = lambda spark, d: with_axes(spark, d).select("product_id", *[F.col(f"axes.{m}").alias(m.split(".")[1]) for m in members])


_axis("axes_config", "config.ram_gb", "config.storage_gb", "config.color")
_axis("axes_size", "size.screen_inches")
_axis("axes_silicon", "silicon.cpu", "silicon.gpu")
_axis("axes_packaging", "packaging.bundle", "packaging.condition")


@query
def axes_region(spark, d):
    return with_axes(spark, d).select("product_id", F.col("axes.region").alias("region"), F.col("axes.carrier").alias("carrier"))


# ---------------------------------------------------------------- vectors and models
@query
def tfidf_weights(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return vectors.tfidf(docs, "doc_id", "text", large=True).select("doc_id", "term", F.round("weight", 4).alias("weight"))


@query
def tfidf_top_terms(spark, d):
    w = vectors.tfidf(table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("row"), "text"), "row", "text")
    return w.groupBy("term").agg(F.round(F.sum("weight"), 4).alias("total")).orderBy(F.col("total").desc(), "term").limit(50)


@query
def bundle_model(spark, d):
    rows = stored(enriched(spark, d))
    return models.bundle_probability(rows, bundles.weak_label(), 40, 1).select("product_id", F.round("p_bundle", 4).alias("p_bundle"))


@query
def calibrated_score(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    share = F.length(F.regexp_replace("text", r"[A-Za-z\s]", "")) / F.greatest(F.length("text"), F.lit(1))
    rows = docs.select("doc_id", "quality", share.alias("odd_share"), F.log1p("n_chars").alias("size"))
    return models.calibrate(rows, ["odd_share", "size"], "quality").select("doc_id", "quality", "calibrated")


@query
def cosine_pairs(spark, d):
    """Every vector with the centroid of its label."""
    e = table(spark, d, "embeddings")
    c = vectors.centroids(e, "label", "embedding")  # a row a label
    return e.join(c, "label").select("vec_id", "label", F.round(vectors.cosine(F.col("embedding"), F.col("centroid")), 6).alias("cosine"))


@query
def centroids(spark, d):
    c = vectors.centroids(table(spark, d, "embeddings"), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("dim", "v")).select("label", "dim", F.round("v", 6).alias("v"))


@query
def class_weights(spark, d):
    return axes.class_weights(axes.parsed(enriched(spark, d)), "p_ram").select("label", "n", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------- grouping
@query
def block_sizes(spark, d):
    return grouping.with_block(with_axes(spark, d)).groupBy(*grouping.BLOCK).agg(F.count("*").alias("n"))


def _links(spark, d):
    return vectors.similar_pairs(table(spark, d, "embeddings"), "vec_id", ["label"], "embedding", TAU)


@query
def similarity_join(spark, d):
    return _links(spark, d).select("src", "dst", F.round("sim", 6).alias("sim"))


def _parts(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    links = tiles.links(e, "vec_id", ["label"], TAU, "embedding", connecting=True)
    return e.join(connected_components(links).withColumnRenamed("node", "vec_id"), "vec_id", "left").withColumn("component", F.coalesce("component", "vec_id"))


@query
def components(spark, d):
    return _parts(spark, d).select("vec_id", "component")


@query
def medoids(spark, d):
    parts = shared_table(_parts(spark, d), "parts")
    dims = F.sequence(F.lit(0), F.size("embedding") - 1)
    return grouping.nearest(parts.select("vec_id", "component", dims.alias("terms"), vectors.unit(F.col("embedding")).alias("weights")), "vec_id")


on_catalog("family_phrase", family=lambda: grouping.family_phrase(F.col("name"), T.normalize_brand(F.col("brand"))))


@query
def group_ids(spark, d):
    """Suffixed ids where every row is its own group, so that SQL can follow them."""
    from pyspark.sql import Window as W

    rows = grouping.with_block(with_axes(spark, d))
    brand = F.when(F.col("b_brand") != "_unknown", F.col("b_brand"))
    rows = rows.withColumn("base", grouping.base_group_id(brand, F.col("name")))
    use = F.row_number().over(W.partitionBy("base").orderBy(*grouping.BLOCK, "row_id"))
    return rows.withColumn("use", use).select("product_id", F.when(F.col("use") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("use").cast("string"))).alias("group_id"))


@query
def grouped_products(spark, d):
    """The whole grouping: blocks, title similarity, components, medoids and ids."""
    catalog(spark, d)  # written before, as it stays

    def make() -> DataFrame:
        rows, _ = grouping.group_products(stored(with_axes(spark, d), "row_id", "product_id", "brand", "sub_category", "name", "axes"), GROUP_TAU)
        return rows.select("product_id", "group_id")

    return only_result(make, "product_groups")


@query
def group_records(spark, d):
    return groups_of(spark, d).select("group_id", "brand", "family", "generation")


# ---------------------------------------------------------------- variants
@query
def variant_ids(spark, d):
    return with_variants(spark, d).select("product_id", "variant_id")


@query
def variant_snapshot(spark, d):
    _, records = variants.build_variants(with_variants(spark, d).drop("variant_id"))
    return records.select("variant_id", F.col("axes.config.ram_gb").alias("ram_gb"), F.col("axes.size.screen_inches").alias("screen_inches"), F.col("axes.packaging.bundle").alias("bundle"))


@query
def variant_counts(spark, d):
    return with_variants(spark, d).groupBy("variant_id").agg(F.count("*").alias("product_count"))


@query
def assignments(spark, d):
    return variants.assignments(with_variants(spark, d))


@query
def export_assignments(spark, d):
    """The assignments as they are read back from the CSV that is exported."""
    path = new_path(spark, "assignments")
    export_csv(variants.assignments(with_variants(spark, d)), path)
    return feed.scan_csv(spark, [path]).drop("_file", "_path")


@query
def variant_records(spark, d):
    _, records = variants.build_variants(with_variants(spark, d).drop("variant_id"))
    return records.select("variant_id", "group_id", "product_count", F.to_json("axes.config").alias("config"))


# ---------------------------------------------------------------- scoring
@query
def numeric_consistency(spark, d):
    rows = with_variants(spark, d)
    c = scoring.numeric_consistency(rows, "group_id", F.col("axes.config.ram_gb").cast("double"), 8.0)
    return c.select("group_id", F.round("mode_frac", 6).alias("mode_frac"), F.round("std", 6).alias("std"), "n")


@query
def cohesion(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"), "label", "embedding")
    weights = e.select("row_id", F.posexplode(vectors.unit(F.col("embedding"))).alias("term", "weight"))
    return scoring.cohesion(e, weights, "label", "sim").select("row_id", F.round("sim", 6).alias("sim"))


@query
def axes_presence(spark, d):
    return with_axes(spark, d).select("product_id", scoring.axes_presence().alias("axes_presence"))


@query
def confidence(spark, d):
    return featured(spark, d).select("product_id", F.round(scoring.confidence(), 4).alias("confidence"))


@query
def evidence(spark, d):
    return featured(spark, d).select("product_id", scoring.evidence().alias("evidence"))


@query
def scored_assignments(spark, d):
    """Assignments scored with TF-IDF cohesion over the catalog, with their features."""
    rows = with_variants(spark, d)
    scored = only_result(lambda: scoring.score(rows, vectors.packed_tfidf(rows, "row_id", "ml_text"), return_features=True), "scored")
    return scored.withColumns({f: F.round(f, 6) for f in scoring.FEATURES})


# ---------------------------------------------------------------- bundles and probe
on_catalog("bundle_weak_label", label=bundles.weak_label)
on_catalog("main_product", main_product=bundles.main_product)


@query
def bundle_detect(spark, d):
    return bundles.detect_bundles(enriched(spark, d)).withColumn("accessories", F.array_join("accessories", ","))


@query
def bundle_detect_model(spark, d):
    """Bundles with the probability of the model that is trained on the weak labels."""
    rows = stored(enriched(spark, d))
    found = models.bundle_probability(rows, bundles.weak_label(), 40, 1)
    return bundles.detect_bundles(found, F.col("p_bundle")).withColumn("accessories", F.array_join("accessories", ","))


@query
def apply_bundle(spark, d):
    rows = with_axes(spark, d)
    return bundles.apply_bundles(rows, bundles.detect_bundles(rows)).select("product_id", F.col("axes.packaging.bundle").alias("bundle"))


def _probed(spark, d):
    return bundles.probe(enriched(spark, d))


@query
def bundle_probe_score(spark, d):
    return _probed(spark, d).select("product_id", "bundle_score", "evidence_triggers", "evidence_accessories", "evidence_spec_hint")


@query
def probe_multipack(spark, d):
    return _probed(spark, d).select("product_id", "evidence_multipack")


@query
def probe_extra_terms(spark, d):
    rows = bundles.probe(enriched(spark, d), ("widget", "gizmo"))
    return bundles.accessory_term_counts(rows).filter(F.col("term").isin("widget", "gizmo"))


@query
def bundle_candidates(spark, d):
    return bundles.bundle_candidates(_probed(spark, d)).select("product_id", "bundle_score")


@query
def non_bundle_sample(spark, d):
    return bundles.non_bundle_sample(_probed(spark, d).select("product_id", "bundle_score"))


@query
def accessory_term_counts(spark, d):
    return bundles.accessory_term_counts(_probed(spark, d))


# ---------------------------------------------------------------- reports
@query
def product_groups(spark, d):
    return reports.product_groups(with_variants(spark, d), groups_of(spark, d))


@query
def run_summary(spark, d):
    return reports.run_summary(featured(spark, d).withColumn("confidence", F.round(scoring.confidence(), 4)))


@query
def group_product_counts(spark, d):
    return with_variants(spark, d).groupBy("group_id").agg(F.countDistinct("product_id").alias("product_count"))


@query
def group_variant_counts(spark, d):
    return with_variants(spark, d).groupBy("group_id").agg(F.countDistinct("variant_id").alias("variant_count"))


@query
def safe_mode(spark, d):
    return reports.safe_mode(axes.parsed(enriched(spark, d)), "sub_category", "p_cpu")


@query
def base_specs(spark, d):
    return reports.base_specs(grouped(spark, d))


def _dq(spark, d):
    """Data quality with the confidences of an assignments table that lacks every third product."""
    scored = featured(spark, d)
    return quality.dq_rows(grouped(spark, d), scored.filter("row_id % 3 > 0").select("product_id", F.round(scoring.confidence(), 4).alias("confidence")))


def _means(df, key):
    """Means to six places, just off the ties that engines round differently: scores have four places."""
    return df.select(key, *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in df.columns if c != key])


@query
def brand_quality(spark, d):
    return _means(quality.by_cohort(_dq(spark, d), "brand"), "brand")


@query
def seller_quality(spark, d):
    return _means(quality.by_cohort(_dq(spark, d), "seller_id"), "seller_id")


@query
def value_counts(spark, d):
    return quality.value_counts(catalog(spark, d), "sub_category")


@query
def distinct_brands(spark, d):
    return catalog(spark, d).select(F.trim(F.lower("brand")).alias("brand")).distinct()


@query
def top_brands(spark, d):
    return quality.top_brands(catalog(spark, d))


@query
def anomalies(spark, d):
    return quality.anomalies(_dq(spark, d)).drop("name")


@query
def dq_flags(spark, d):
    return quality.dq_flags(with_axes(spark, d)).select("product_id", *quality.PENALTIES)


@query
def dq_rows(spark, d):
    return _dq(spark, d).select("product_id", "confidence", "dq_score")


@query
def guess_brand(spark, d):
    rows = catalog(spark, d).withColumn("name", F.concat(F.col("name"), F.element_at(F.array(*[F.lit(x) for x in (" by HP", " LG and Dell", "", " Vizio")]), (F.col("row_id") % 4 + 1).cast("int"))))
    return quality.guess_brand(rows).select("product_id", "guessed_brand")


@query
def event_windows(spark, d):
    """The windowed counts of the events table, drained as a stream."""
    from shelfmark.streaming.incremental import drain, windowed_counts

    events = table(spark, d, "events").select("ts", "event_type", "value")
    source = new_path(spark, "events")
    events.write.parquet(source)
    out, mark = new_path(spark, "windows"), new_path(spark, "stream")
    drain(spark, windowed_counts(spark.readStream.schema(events.schema).parquet(source)), out, mark, mode="complete")
    return spark.read.schema("window_start timestamp, event_type string, n long, total double").parquet(out)
