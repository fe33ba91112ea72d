"""The analysis commands: bundle probe, quality report and dataset profile, from files to CSV files and previews.

    python -m shelfmark.commands probe --input products.csv --outdir out [--top 50] [--sample-non 50] [--extra-lexicon a,b]
    python -m shelfmark.commands quality --input products.csv --assign assignments --outdir out
    python -m shelfmark.commands profile --input products.csv
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import axes, bundles, quality
from shelfmark.plans.shared import shared_table
from shelfmark.sources import products as feed
from shelfmark.sources.sinks import export_csv

PROBED = ("product_id", "name", "brief_description", "bundle_score", "evidence_triggers", "evidence_accessories", "evidence_multipack", "evidence_spec_hint")
#: Rows that a preview shows.
PREVIEW, PREVIEW_TERMS = 10, 25


def run_probe(spark: SparkSession, source, outdir: str, top: int = 50, sample_non: int = 50, extra_terms: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Score every product, and write the likeliest bundles, a sample of the others, and how often each accessory was named."""
    rows = feed.backfill(feed.scan_csv(spark, source), ("product_id", "name", "brief_description", "details", "model", "brand"))
    probed = bundles.probe(feed.enrich(rows, clean=False), tuple(t.strip().lower() for t in extra_terms if t.strip()))
    probed = shared_table(probed.select(*PROBED, "found"), "probed")
    out = {
        "bundle_candidates": bundles.bundle_candidates(probed, top).select(*PROBED),
        "non_bundle_sample": bundles.non_bundle_sample(probed, sample_non).select(*PROBED),
        "accessory_term_counts": bundles.accessory_term_counts(probed).orderBy(F.col("count").desc(), "term"),
    }
    for name, df in out.items():
        export_csv(df, f"{outdir}/{name}", single=True)  # at most ``top``, ``sample_non`` and the lexicon's rows
    return out


def with_stored_axes(df: DataFrame) -> DataFrame:
    """``df`` with ``axes`` read back from its text (JSON, or a printed dict); without that column, all axes are missing."""
    if "axes" not in df.columns:
        return df.withColumn("axes", F.lit(None).cast(axes.AXES))
    words = {"None": "null", "True": "true", "False": "false"}
    text = F.col("axes").cast("string")
    for python, json in words.items():
        text = F.regexp_replace(text, rf"([:\[,]\s*){python}\b", rf"$1{json}")
    return df.withColumn("axes", F.from_json(text, axes.AXES))


def run_quality(spark: SparkSession, source, assigned, outdir: str) -> dict[str, DataFrame]:
    """Score all rows of a products file with the confidences of an assignments file; write rows, brands, sellers and anomalies."""
    rows = with_stored_axes(feed.backfill(feed.scan_csv(spark, source), ("product_id", "seller_id", "sub_category", "name", "brand")).drop("_file", "_path"))
    confidences = feed.scan_csv(spark, assigned).select("product_id", F.col("confidence").try_cast("double").alias("confidence"))
    report = quality.quality_report(rows, confidences)
    for name, df in report.items():
        flat = df.withColumn("axes", F.to_json("axes")) if "axes" in df.columns else df
        export_csv(flat, f"{outdir}/{name}")
    return report


def run_profile(spark: SparkSession, source) -> dict[str, DataFrame]:
    rows = feed.backfill(feed.scan_csv(spark, source), feed.REQUIRED).drop("_file", "_path")
    return quality.profile(shared_table(rows, "profiled"))


def preview(title: str, rows: DataFrame, *columns: str, n: int = PREVIEW) -> list[str]:
    """The first n rows as lines under a heading."""
    return [f"\n=== {title} ===", *("  ".join(str(r[c])[:100] for c in columns) for r in rows.select(*columns).limit(n).collect())]


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    kinds = p.add_subparsers(dest="command", required=True)
    probe, report, profile = (kinds.add_parser(c) for c in ("probe", "quality", "profile"))
    for k in (probe, report, profile):
        k.add_argument("--input", required=True, nargs="+")
    for k in (probe, report):
        k.add_argument("--outdir", required=True)
    probe.add_argument("--top", type=int, default=50)
    probe.add_argument("--sample-non", type=int, default=50)
    probe.add_argument("--extra-lexicon", default="")
    report.add_argument("--assign", required=True, nargs="+")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    lines: list[str] = []
    try:
        if a.command == "probe":
            out = run_probe(spark, a.input, a.outdir, a.top, a.sample_non, tuple(a.extra_lexicon.split(",")))
            lines += preview("Bundle candidates", out["bundle_candidates"], "bundle_score", "product_id", "name")
            lines += preview("Non-bundle sample", out["non_bundle_sample"], "bundle_score", "product_id", "name")
            lines += preview("Accessory terms", out["accessory_term_counts"], "term", "count", n=PREVIEW_TERMS)
        elif a.command == "quality":
            out = run_quality(spark, a.input, a.assign, a.outdir)
            lines += preview("Lowest brands", out["brand_quality"], "brand", "dq_score", "confidence")
            lines += preview("Lowest sellers", out["seller_quality"], "seller_id", "dq_score", "confidence")
            lines += preview("Anomalies", out["anomalies"], "product_id", "dq_score", "name")
        else:
            for name, df in run_profile(spark, a.input).items():
                lines += preview(name, df, *df.columns)
    except FileNotFoundError as e:
        lines = [f"File not found: {e}"]
    print("\n".join(lines))


if __name__ == "__main__":
    main()
