"""The catalog pipeline from feed to exports, and its command line."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import axes, grouping, models, reports, scoring, variants, vectors
from shelfmark.plans.shared import shared_table
from shelfmark.sources.products import load_products
from shelfmark.sources.sinks import export_csv, export_json, export_json_lines


def run_frames(products: DataFrame, threshold: float = 0.82, vector: str | None = None, impute: bool = False, return_features: bool = False) -> dict[str, DataFrame]:
    """All results of a run over enriched products."""
    parsed = axes.parsed(products)
    if impute:
        parsed = shared_table(parsed, "parsed")  # read by the vectors, the models and their guesses
        parsed = models.AxisModeler().fit(parsed).transform(parsed)
    rows = shared_table(axes.with_axes(parsed), "axes")
    grouped, groups = grouping.group_products(rows, threshold, vector)
    grouped = shared_table(grouped, "grouped")
    with_ids, records = variants.build_variants(grouped)
    weights = vectors.packed_tfidf(with_ids, "row_id", "ml_text")
    scored = shared_table(scoring.score(with_ids, weights, return_features=return_features), "scored")
    return {
        "products": with_ids, "product_groups": reports.product_groups(with_ids, groups), "variants": records,
        "assignments": scored, "summary": reports.run_summary(scored, threshold=threshold),
    }


def run_pipeline(spark: SparkSession, input_csv, output_dir: str, sample: int | None = None, seed: int = 42, vector: str | None = None,
                 group_threshold: float = 0.82, impute: bool = True, return_scoring_features: bool = False) -> dict:
    """Load, infer, group, score and export; returns the summary."""
    start = time.time()
    out = run_frames(load_products(spark, input_csv, sample, seed), group_threshold, vector, impute, return_scoring_features)
    export_json_lines(out["product_groups"].orderBy("group_id"), f"{output_dir}/product_groups")
    export_json_lines(out["variants"].orderBy("variant_id"), f"{output_dir}/variants")
    export_csv(out["assignments"], f"{output_dir}/assignments")
    summary = out["summary"].first().asDict() | {"processing_time_seconds": round(time.time() - start, 2), "vectors_used": vector is not None}
    export_json(spark, f"{output_dir}/summary.json", summary)
    return summary


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True, nargs="+")
    p.add_argument("--output", required=True)
    p.add_argument("--sample", type=int)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--vector", help="a column of precomputed embeddings to group by")
    p.add_argument("--threshold", type=float, default=0.82)
    p.add_argument("--features", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    print(run_pipeline(spark, a.input, a.output, a.sample, a.seed, a.vector, a.threshold, return_scoring_features=a.features))


if __name__ == "__main__":
    main()
