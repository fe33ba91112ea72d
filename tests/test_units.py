"""Literal inputs and expected values, one branch of a function each."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import parse as P
from shelfmark.functions import specs as S
from shelfmark.functions import text as T
from shelfmark.operators import grouping, variants
from shelfmark.plans.graph import connected_components

CASES = [
    (P.parse_screen, "15.6 inch Laptop", 15.6), (P.parse_screen, '15.6" Laptop', None), (P.parse_screen, '15.6"Laptop', 15.6),
    (P.parse_screen, "15.6 inches", None), (P.parse_screen, "15.6-inch", 15.6), (P.parse_screen, "1080 in", 80.0),
    (P.parse_ram, "256GB SSD 8GB RAM", 256), (P.parse_ram, "RAM: 16", 16), (P.parse_ram, None, None),
    (P.parse_storage, "8GB RAM 1TB", 8), (P.parse_storage, "1.5 TB", 1536), (P.parse_storage, "2.5 GB", 2), (P.parse_storage, "3.5 GB", 4),
    (P.normalize_cpu, "intel core i5-1235u", "intel_i5_1235u"), (P.normalize_cpu, "m1 processor", "apple_m1_pro"), (P.normalize_cpu, "core_i5", None),
    (P.normalize_cpu, "ryzen 7 7840u", "amd_ryzen7_7840u"), (P.cpu_readable, "amd_ryzen7_7730u", "AMD Ryzen 7"), (P.cpu_readable, "amd_ryzen7_5800", "AMD Ryzen 5800"),
    (P.condition, "Restored: Like New", "new"), (P.condition, "Restored", "refurbished"), (P.normalize_resolution, "3440 x 1440", "1440p"),
    (P.panel_type, "Samsung QD-OLED", "qd_oled"), (P.panel_type, "lava lamp", None), (P.normalize_refresh, "999hz refresh: 75", 75),
    (P.pack_qty, "1920 x 1080", None), (P.pack_qty, "2-pack", 2), (P.pack_qty, "60 pack", None), (P.extract_year, "model 2024x 2019", "2019"),
    (T.normalize_color, "Space Grey", "space_gray"), (T.normalize_brand, "Brand: HP Inc.", "hp"), (T.normalize_brand, "", None),
    (T.slugify, "Straße Größe", "strae_groe"), (T.slugify, "!!", "product"), (T.slugify, "a" * 60, "a" * 48),
    (T.punct, "a–b!!  “c”\\d", 'a-b!  "c" d'), (T.squeeze, " -a   b/ ", "a b"), (T.strip_ctrl, "a​b\x07c", "ab c"),
    (T.dehtml, "a&lt;b&gt;c &amp; d", "a c & d"), (T.prettify, "SAMSUNG 4K TV 16GB WI-FI SILVER", "Samsung 4K TV 16Gb WI-FI Silver"), (T.prettify, "SAMSUNG 4k tv", "SAMSUNG 4k tv"), (T.prettify, None, ""),
    (T.model_code, " nan ", None), (T.model_code, " A  1 ", "A 1"), (T.nfkc, "ｆｕｌｌ", "full"),
    (lambda c: F.array_join(S.accessories_in(c), ","), "Microsoft", "mic"),
    (lambda c: S.spec_value(S.json_safe(c), "a"), '{"a": 1}', "1"), (lambda c: S.spec_value(S.json_safe(c), "a"), "[1]", None),
    (lambda c: S.spec_value(S.json_safe(c), "a"), "{bad", None),
    (lambda c: grouping.family_phrase(c, F.lit("hp")), "HP renewed open Pavilion x y z w v", "pavilion x y z w"),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(spark, i):
    f, text, expected = CASES[i]
    assert spark.createDataFrame([(text,)], "x string").select(f(F.col("x")).alias("y")).first().y == expected


def test_size_bucket(spark):
    rows = spark.createDataFrame([("laptop", 15.25), ("tv", 62.5), ("tv", None)], "s string, x double")
    assert [r.b for r in rows.select(P.size_bucket(F.col("s"), F.col("x")).alias("b")).collect()] == ["15.0", "60", "u"]


def test_variant_without_axes(spark):
    from shelfmark.operators.axes import AXES

    df = spark.createDataFrame([(None,)], f"axes {AXES}")
    assert df.select(variants.variant_id(F.lit("g")).alias("v")).first().v == "g/config:unk"


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(1, 2), (2, 1), (3, 3), (None, 4), (7, 5), (5, 6)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {1: 1, 2: 1, 5: 5, 6: 5, 7: 5}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_pipeline_round_trip(spark, sf_dir, tmp_path):
    from shelfmark.pipeline import run_pipeline
    from shelfmark.sources.catalog import catalog

    catalog(spark, sf_dir).drop("row_id").write.option("header", True).option("escape", '"').csv(str(tmp_path / "in"))
    summary = run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), impute=False)
    n = summary["total_products"]
    assert n == 200 and summary["products_assigned"] == n and 0.0832 <= summary["average_confidence"] <= 0.8808
    assert spark.read.json(str(tmp_path / "out" / "variants")).selectExpr("sum(product_count) AS n").first().n == n
    rows = spark.read.option("header", True).csv(str(tmp_path / "out" / "assignments"))
    assert rows.filter("not startswith(variant_id, concat(group_id, '/'))").count() == 0


def test_entry_survives_without_corpus_package(tmp_path):
    """The registry imports where the corpus subpackage and its pipeline are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "shelfmark", tmp_path / "shelfmark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'variant_counts' in q and 'pipeline' not in q and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace as Some

    from shelfmark.plans.shared import shared_dir

    session = lambda master, named: Some(sparkContext=Some(master=master, getConf=lambda: Some(get=lambda _: named)))
    assert shared_dir(session("local[8]", None)).startswith("file:")
    assert shared_dir(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            shared_dir(session(master, None))
