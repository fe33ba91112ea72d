"""Catalog operators on small tables against brute force: similarity, numbering, scans, models, commands."""

import collections
import csv
import json
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfmark import commands
from shelfmark.operators import grouping, models, reports, vectors
from shelfmark.plans.numbering import number_rows
from shelfmark.sources import products as feed


def unit_rows(seed, n, common):
    """Sparse unit rows; all have the term ``common``, with more or less weight."""
    r = random.Random(seed)
    rows = {}
    for i in range(n):
        w = {common: r.random() * 2} | {f"t{r.randrange(12)}": r.random() for _ in range(r.randrange(1, 6))}
        length = math.sqrt(sum(x * x for x in w.values()))
        rows[i] = {t: x / length for t, x in w.items()}
    return rows


@pytest.mark.parametrize("threshold", [0.4, 0.82, 0.99])
def test_similar_rows_loses_no_pair(spark, threshold):
    rows = unit_rows(3, 60, "all")
    rows[60] = dict(rows[5])  # an equal row
    weights = spark.createDataFrame([(i, t, x) for i, w in rows.items() for t, x in w.items()], "row_id long, term string, weight double")
    blocks = spark.createDataFrame([(i, i % 2) for i in rows], "row_id long, b int")
    got = {(r.src, r.dst): r.sim for r in vectors.similar_rows(weights, "row_id", blocks, ["b"], threshold).collect()}
    dot = lambda a, b: sum(x * rows[b].get(t, 0.0) for t, x in rows[a].items())
    want = {(a, b): dot(a, b) for a in rows for b in rows if a < b and a % 2 == b % 2 and dot(a, b) >= threshold - 1e-9}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    assert want


def test_title_copies_are_linked_without_all_pairs(spark):
    titles = ["blue lamp stand"] * 40 + ["red lamp"] * 3 + ["", "", "unique"]
    rows = spark.createDataFrame([(i, "s", "b", "u", t) for i, t in enumerate(titles)], "row_id long, b_sub string, b_brand string, b_bucket string, t string")
    weights = vectors.tfidf(rows, "row_id", "t", 2, 1.0)
    links = [(r.src, r.dst) for r in grouping.title_links(rows, weights, 0.82).collect()]
    assert sorted(links) == [(0, i) for i in range(1, 40)] + [(40, 41), (40, 42)]


def test_rows_are_numbered_in_order(spark):
    values = list(range(500)) * 2 + [None]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "x int").repartition(7)
    got = number_rows(df, "n", order=["x"]).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1001)) and [r.x for r in got] == [None, *sorted(v for v in values if v is not None)]
    assert sorted(r.n for r in number_rows(df, "n").collect()) == list(range(1001))
    assert number_rows(df.limit(0), "n").count() == 0


def test_scan_unites_files_by_name_in_order(spark, tmp_path):
    files = []
    for i, (names, n) in enumerate([(["product_id", "name"], 3), (["name", "brand", "product_id"], 40), (["product_id", "name"], 2), (["product_id"], 0)]):
        path = tmp_path / f"f {9 - i}+.csv"  # not in order of their names, which are to be decoded
        with open(path, "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(names)
            for k in range(n):
                row = {"product_id": f"{i}-{k}", "name": f'line\nbreak "{k}", é', "brand": "b"}
                out.writerow([row[c] for c in names])
        files.append(str(path))
    rows = feed.load_products(spark, files, clean=False).orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(45))
    assert [r.product_id for r in rows] == [f"{i}-{k}" for i, n in ((0, 3), (1, 40), (2, 2)) for k in range(n)]
    assert rows[1]["name"] == 'line\nbreak "1", é' and rows[0].brand in (None, "") and rows[5].brand == "b"
    folder = str(tmp_path / "folder")
    spark.createDataFrame([(str(i), "x") for i in range(10)], "product_id string, name string").repartition(3).write.option("header", True).csv(folder)
    both = feed.load_products(spark, [files[0], folder]).collect()
    assert sorted(r.row_id for r in both) == list(range(13)) and {r.product_id for r in both if r.row_id < 3} == {"0-0", "0-1", "0-2"}
    with pytest.raises(FileNotFoundError):
        feed.scan_csv(spark, str(tmp_path / "none*.csv"))


def test_text_vectors_are_the_tfidf_weights(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice(["red", "blue", "lamp", "desk", "oak", "pine"]) for _ in range(r.randrange(9))) for _ in range(40)] + [None, "rare words only"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, ml_text string")
    got = models.TextVectors(min_df=2).fit(df).transform(df).select("row_id", vector_to_array("features").alias("v")).collect()
    want = collections.defaultdict(dict)
    for w in vectors.tfidf(df, "row_id", "ml_text", 2).collect():
        want[w.row_id][w.term] = w.weight
    assert len(got) == len(texts)
    for g in got:
        assert sorted(x for x in g.v if x) == pytest.approx(sorted(want[g.row_id].values()))


def test_classifier_takes_any_number_of_classes(spark):
    rows = [(i, f"kind k{i % 90} item", f"label{i % 90}") for i in range(540)] + [(1000, "kind k7 item", None), (1001, None, None)]
    df = spark.createDataFrame(rows, "row_id long, ml_text string, y string")
    df = df.join(models.TextVectors(places=4096).fit(df).transform(df), "row_id")
    got = {r.row_id: r for r in models.TextClassifier().fit(df, "y").predict(df, "guess").collect()}
    assert len(got) == len(rows) and got[1000].guess == "label7" and 0 < got[1000].guess_proba <= 1
    assert np.mean([got[i].guess == f"label{i % 90}" for i in range(540)]) > 0.99
    few = models.TextClassifier().fit(df.filter("row_id < 5"), "y").predict(df, "guess")
    assert few.filter("guess is not null").count() == 0


def test_axes_are_imputed_with_their_source(spark):
    rows = []
    for i in range(60):
        color = ["silver", "black"][i % 2]
        details = json.dumps({"specifications": {"Color": color}})
        name = f"Laptop {['alpha', 'beta'][i % 2]} 15 inch 8GB RAM 256 GB" if i % 5 else f"Laptop {['alpha', 'beta'][i % 2]} plain"
        rows.append((str(i), name, "Laptop", "", details if i else "", "", "m"))
    rows.append(("60", "", "Laptop", "alpha", "", "", "m"))
    raw = spark.createDataFrame(rows, "product_id string, name string, sub_category string, brief_description string, details string, brand string, model string")
    from shelfmark.operators import axes

    parsed = axes.parsed(feed.enrich(number_rows(raw, order=["product_id"]), clean=False))
    got = {r.product_id: r for r in models.AxisModeler().fit(parsed).transform(parsed).collect()}
    assert len(got) == len(rows)
    assert (got["1"].p_ram, got["1"].ram_src) == (8, "parse") and got["1"].color_src == "parse" and got["1"].cpu_src == "none"
    assert got["5"].ram_src in ("model", "none") and got["60"].color_src in ("model", "none")


def test_modes_ties_and_gaps(spark):
    rows = [("a", "x", 2.5), ("a", "y", 2.5), ("a", "none", None), ("a", "", 10.0), ("b", None, None), ("c", "z", 9.5), ("c", "z", 10.0)]
    df = spark.createDataFrame(rows, "k string, s string, v double")
    got = {r.k: (r.s, r.v) for r in reports.modes(df, "k", {"s": F.col("s"), "v": F.col("v")}).collect()}
    assert got == {"a": ("x", "2.5"), "b": (None, None), "c": ("z", "10.0")}
    assert {r.k: r.mode for r in reports.safe_mode(df, "k", "v").collect()} == {"a": 2.5, "c": 10.0}


def test_of_repeated_products_the_last_row_counts(spark):
    from shelfmark.operators import scoring
    from shelfmark.operators.axes import AXES

    axes = lambda ram: {"config": {"ram_gb": ram}, "size": {"screen_inches": 15.0}}
    rows = [(0, "p", "one", "laptop", "g", "v1", axes(8)), (1, "q", "two", "laptop", "g", "v1", axes(8)), (2, "p", "three", "laptop", "g", "v2", None), (3, None, "x", "tv", "h", "v3", axes(4))]
    df = spark.createDataFrame(rows, f"row_id long, product_id string, name string, sub_category string, group_id string, variant_id string, axes {AXES}")
    weights = spark.createDataFrame([(0, "a", 1.0), (1, "a", 1.0), (2, "b", 1.0), (3, "c", 1.0)], "row_id long, term string, weight double")
    got = {(r.product_id, r.variant_id): r for r in scoring.score(df, weights, return_features=True).collect()}
    assert len(got) == 4
    assert got["p", "v1"].axes_presence == 0 and got["p", "v2"].axes_presence == 0 and got["q", "v1"].axes_presence == 0.4
    # v1's members are the row of q and the last row of p, so its centroid lies between a and b.
    assert got["p", "v1"].variant_sim == pytest.approx(math.sqrt(0.5)) and got["p", "v2"].variant_sim == 1.0


def test_commands(spark, tmp_path, capsys):
    names = ["Laptop bundle with mouse and bag 2-pack", "Laptop 8GB RAM 256 GB", "TV @@ set of 2 mounts", None]
    path = tmp_path / "products.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["product_id", "name", "brief_description", "details", "brand", "seller_id", "sub_category", "axes"])
        for i in range(40):
            axes = "{'config': {'ram_gb': 512, 'storage_gb': None}, 'size': {'screen_inches': 15.0}}" if i % 4 == 1 else ""
            out.writerow([i, names[i % 4], "", "", ["hp", ""][i % 2], i % 3, "Laptop", axes])
    commands.run_probe(spark, str(path), str(tmp_path / "probe"), 5, 4, ("mounts",))
    read = lambda p: spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / p)).collect()
    top = read("probe/bundle_candidates")
    assert len(top) == 5 and all("bundle" in r["name"] for r in top) and len(read("probe/non_bundle_sample")) == 4
    terms = {r.term: int(r["count"]) for r in read("probe/accessory_term_counts")}
    assert terms["mouse"] == 10 and terms["mounts"] == 10
    with open(tmp_path / "assignments.csv", "w") as f:
        f.write("product_id,group_id,variant_id,confidence\n1,g,v,0.6\n2,g,v,0.9\n")
    commands.run_quality(spark, str(path), str(tmp_path / "assignments.csv"), str(tmp_path / "dq"))
    scored = {r.product_id: r for r in read("dq/rows_scored")}
    assert len(scored) == 40 and scored["1"].implausible_ram == "1" and float(scored["1"].confidence) == 0.6 and scored["5"].confidence == "0.0"
    brands = read("dq/brand_quality")
    assert [float(r.dq_score) for r in brands] == sorted(float(r.dq_score) for r in brands)
    assert len(read("dq/seller_quality")) == 3 and len(read("dq/anomalies")) > 0
    commands.main(["profile", "--input", str(path)])
    assert "top_brands" in capsys.readouterr().out
    commands.main(["profile", "--input", str(tmp_path / "missing.csv")])
    assert "File not found" in capsys.readouterr().out
