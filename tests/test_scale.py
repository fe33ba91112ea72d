"""Plans that must stay whole and bounded on larger tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import axes, tiles
from shelfmark.sources import catalog as source
from shelfmark.sources import products as feed


def test_parsing_is_dealt_out_under_filters_too(spark, monkeypatch):
    whole = {tuple(r) for r in source.catalog(spark, "/root/testdata/sf0.001").collect()}
    monkeypatch.setattr(source, "TASK_ROWS", 20)
    monkeypatch.setattr(source, "_written", {})
    rows = source.catalog(spark, "/root/testdata/sf0.001")
    parsed = axes.parsed(feed.enrich(rows, clean=False)).filter(F.col("p_cpu").isNotNull())
    sizes = parsed.select("p_cpu").rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len([n for n in sizes if n]) > 2 and max(sizes) < sum(sizes) / 2
    assert {tuple(r) for r in rows.collect()} == whole


def closure(n, edges):
    part = list(range(n))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, b in edges:
        part[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def sparse_rows(n):
    r = random.Random(4)
    rows = []
    for _ in range(n):
        w = {f"t{r.randrange(60)}": r.random() for _ in range(r.randrange(1, 5))}
        length = math.sqrt(sum(x * x for x in w.values()))
        rows.append({t: x / length for t, x in w.items()})
    return rows


def dot(a, b):
    return sum(x * b.get(t, 0.0) for t, x in a.items())


@pytest.mark.parametrize(("least", "terms"), [(0.5, 4096), (0.9, 7), (0.999, 4096)])
def test_forests_connect_what_links_connect_and_are_linear(monkeypatch, least, terms):
    monkeypatch.setattr(tiles, "BATCH", 5)
    monkeypatch.setattr(tiles, "TERMS", terms)
    rows = sparse_rows(90)
    m = tiles.Sparse([list(w) for w in rows], [list(w.values()) for w in rows])
    for left, right in ((np.arange(90), None), (np.arange(0, 90, 3), np.setdiff1d(np.arange(90), np.arange(0, 90, 3)))):
        side = lambda i: right is None or i % 3 == 0  # noqa: B023, E731
        want = [(a, b) for a in range(90) for b in range(a) if (right is None or side(a) != side(b)) and dot(rows[a], rows[b]) >= least]
        got = list(tiles.forest(m, left, right, least))
        assert closure(90, got) == closure(90, want) and len(got) < 90
        assert all(dot(rows[a], rows[b]) >= least - 1e-9 for a, b in got)


def test_blocks_of_many_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(tiles, "DENSE_ROWS", 40)
    monkeypatch.setattr(tiles, "SPARSE_ROWS", 40)
    r = np.random.default_rng(1)
    v = r.normal(size=(300, 6))
    v[7] = 0
    data = [(i, i % 2, [float(x) for x in v[i]]) for i in range(300)] + [(300, 0, None), (301, None, [1.0] * 6), (302, 0, [1.0] * 5), (303, 0, [1.0, None] * 3)]
    df = spark.createDataFrame(data, "vec_id long, b int, v array<double>")
    with np.errstate(all="ignore"):
        u = np.nan_to_num(v / np.linalg.norm(v, axis=1, keepdims=True))
    want = {(a, b): u[a] @ u[b] for a in range(300) for b in range(a + 1, 300) if a % 2 == b % 2 and u[a] @ u[b] >= 0.8}
    rows = tiles.links(df, "vec_id", ["b"], 0.8, "v").collect()
    assert len(rows) == len(want) and {(x.src, x.dst) for x in rows} == set(want)
    assert all(x.sim == pytest.approx(want[x.src, x.dst]) for x in rows)
    some = [(x.src, x.dst) for x in tiles.links(df, "vec_id", ["b"], 0.8, "v", connecting=True).collect()]
    assert closure(300, some) == closure(300, want) and len(some) < len(want)
    rows = sparse_rows(150)
    df = spark.createDataFrame([(i, 0, list(w), list(w.values())) for i, w in enumerate(rows)], "row_id long, b int, terms array<string>, weights array<double>")
    some = [(x.src, x.dst) for x in tiles.links(df, "row_id", ["b"], 0.7, connecting=True).collect()]
    assert closure(150, some) == closure(150, [(a, b) for a in range(150) for b in range(a) if dot(rows[a], rows[b]) >= 0.7])


def test_large_cohorts_are_summed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(tiles, "COHORT_ROWS", 20)
    rows = sparse_rows(120)
    df = spark.createDataFrame([(i, "big" if i < 90 else f"k{i % 3}", list(w), list(w.values()), 1 + i % 2) for i, w in enumerate(rows)], "row_id long, key string, terms array<string>, weights array<double>, n int")
    got = {x.row_id: x.sim for x in tiles.to_centroids(df, "row_id", "key", F.col("n")).collect()}
    assert len(got) == 120
    for members in (range(90), *[[i for i in range(90, 120) if i % 3 == k] for k in range(3)]):
        c = {}
        for i in members:
            for t, x in rows[i].items():
                c[t] = c.get(t, 0.0) + x * (1 + i % 2)
        n = math.sqrt(dot(c, c))
        assert all(got[i] == pytest.approx(dot(rows[i], c) / n) for i in members)


def test_only_results_stay_on_disk(spark, monkeypatch):
    from shelfmark import queries_catalog as q
    from shelfmark.plans import shared

    monkeypatch.setattr(q, "_prepared", {})
    source.catalog(spark, "/root/testdata/sf0.001")
    before = {path for _, path in shared._made}
    q.featured(spark, "/root/testdata/sf0.001")
    left = [path.rsplit("/", 1)[1].rsplit("-", 1)[0] for _, path in shared._made if path not in before]
    assert sorted(left) == ["featured", "grouped", "groups"]


def test_weights_are_written_as_numbers(spark):
    from shelfmark.operators import vectors

    texts = spark.createDataFrame([(0, "red lamp red"), (1, "red lamp"), (2, "blue lamp"), (3, None)], "row_id long, t string")
    got = {r.row_id: r for r in vectors.packed_tfidf(texts, "row_id", "t", 1, 1.0).collect()}
    want = {}
    for r in vectors.tfidf(texts, "row_id", "t", 1, 1.0).collect():
        want.setdefault(r.row_id, []).append(r.weight)
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert all(isinstance(t, int) for t in r.terms)
        w = np.array(r.weights)
        assert sorted(w / np.sqrt((w * w).sum())) == pytest.approx(sorted(want[i]))


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_runs_that_end_in_a_batch_come_at_once(size):
    import pandas as pd

    keys = [f"k{i:02}" for i in range(20) for _ in range(1 + 9 * (i % 7 == 3))]
    rows = pd.DataFrame({"k": keys, "n": range(len(keys))})
    got = list(tiles.whole_runs((rows.iloc[i : i + size] for i in range(0, len(rows), size)), "k"))
    assert pd.concat(got)["n"].tolist() == list(range(len(keys)))
    assert [k for g in got for k in g["k"].unique()] == sorted(set(keys)) and len(got) <= 2 + len(rows) // size


def test_compatibility_forms_are_made_of_pieces(spark, monkeypatch):
    import unicodedata

    from shelfmark.functions import text as T

    texts = ["", "plain", "éá", "́x", "ﬁ Ａ１ ² é", "a¨b̈́ c", "한 ẍ̣", "\U0001d400z\n①", None, "x\u0000é"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.n for r in df.select("i", T.nfkc(F.col("t")).alias("n")).collect()}
    assert got == {i: None if t is None else unicodedata.normalize("NFKC", t) for i, t in enumerate(texts)}
    sent = df.select(F.regexp_extract_all("t", F.lit(T.FOREIGN), F.lit(0)).alias("p")).collect()
    assert sent[1].p == [] and sent[4].p == [" ".join(["ﬁ"]), " Ａ１", " ²", "é"]  # not the whole text


def test_models_learn_from_a_partition_a_core(spark, monkeypatch):
    from shelfmark.operators import models

    seen, fit = [], models.LogisticRegression.fit
    monkeypatch.setattr(models.LogisticRegression, "fit", lambda self, rows: (seen.append(rows.rdd.getNumPartitions()), fit(self, rows))[1])
    df = spark.createDataFrame([(i, f"kind k{i % 2} item", f"y{i % 2}") for i in range(80)], "row_id long, ml_text string, y string").repartition(60)
    vectors = models.TextVectors(places=64).fit(df).transform(df)
    rows = df.join(F.broadcast(vectors), "row_id")
    assert rows.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    models.TextClassifier().fit(rows, "y")
    assert seen and max(seen) <= spark.sparkContext.defaultParallelism


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_vectors_are_not_shuffled_to_be_marked(spark):
    df = spark.createDataFrame([(i, i % 2, ["a", "b"], [1.0, 2.0]) for i in range(9)], "row_id long, b int, terms array<string>, weights array<double>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (tiles.links(df, "row_id", ["b"], 0.5), tiles.to_centroids(df, "row_id", "b")):
            assert "SortMergeJoin" not in plan_of(found)[1] and found.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_forms_are_sent_as_texts_not_lists(spark):
    from shelfmark.functions import text as T

    df = spark.createDataFrame([("é",)], "t string")
    assert "array_join(regexp_extract_all" in plan_of(df.select(T.nfkc(F.col("t"))))[0]


def test_the_probe_is_computed_once(spark):
    from shelfmark.operators import bundles

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        seen.add(1)
        return float(i % 5)

    rows = spark.createDataFrame([(i, f"p{i}") for i in range(200)], "i long, product_id string").withColumn("bundle_score", score("i"))
    got = bundles.non_bundle_sample(rows, 7).collect()
    assert len(got) == 7 and all(r.bundle_score <= 1 for r in got) and seen.value == 200
    found = spark.createDataFrame([(1, "a mouse pad and usb"), (2, "none"), (3, None)], "i int, t string").withColumn("found", F.split("t", " "))
    counts = bundles.accessory_term_counts(found)
    assert "size(" not in plan_of(counts)[0] and {r.term: r["count"] for r in counts.collect()} == {w: 1 for w in "a mouse pad and usb none".split()}


def test_titles_are_searched_once_for_a_pattern(spark):
    rows = axes.parsed(feed.enrich(source.catalog(spark, "/root/testdata/sf0.001"), clean=False))
    labels = axes.label_index(rows, "p_cpu")
    plan = plan_of(labels)[0]
    assert plan.count("bryzen") <= 4 and "isnotnull(coalesce" not in plan  # the test, the family, the model or none
    assert labels.filter("label is null").isEmpty() and [r["index"] for r in labels.orderBy("index").collect()] == list(range(labels.count()))
    from shelfmark.operators import grouping

    assert plan_of(rows.select(grouping.base_group_id(F.col("brand"), F.col("name")).alias("g")))[0].count('[^a-z0-9" ]+') == 1


def test_pairs_of_rows_and_terms_are_not_shuffled(spark, monkeypatch):
    from shelfmark.operators import vectors

    monkeypatch.setattr(vectors, "TASK_CHARS", 40)
    r = random.Random(3)
    texts = {i: " ".join(r.choice(["red", "blue", "élan", "x1", "lamp", "a"]) for _ in range(r.randrange(12))) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "row_id long, t string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = vectors.tfidf(docs, "row_id", "t", 3, 0.9, large=True)
        counts = vectors.term_counts(docs, "row_id", "t", large=True)
        assert counts._chunks > 8
        for df in (found, vectors.chunk_frequencies(counts, 60)):
            assert plan_of(df)[1].count("Exchange ") == 2 and "SortMergeJoin" not in plan_of(df)[1]
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    words = {i: [w for w in t.split() if len(w) > 1] for i, t in texts.items()}
    grams = {i: w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)] for i, w in words.items()}
    df = {t: sum(t in g for g in grams.values()) for g in grams.values() for t in g}
    want = {}
    for i, g in grams.items():
        w = {t: (1 + math.log(g.count(t))) * (math.log(61 / (1 + df[t])) + 1) for t in set(g) if 3 <= df[t] <= 54}
        want |= {(i, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    assert {(x.row_id, x.term): x.weight for x in rows} == pytest.approx(want) and len(rows) == len(want)


def test_patterns_are_searched_only_where_their_letters_are(spark):
    import re

    from shelfmark.operators import bundles

    texts = ["mouse pad w/ usb drive", "mousepads & pens", "set of 3 x4 2-pack 5pk", "includes a kit + combo", "include set with bundled packages", "", None, "box x 2 sd cards, sd card"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, name string")
    rows = rows.selectExpr("*", "'' as brief_description", "cast(map() as map<string,string>) as specs", "cast(array() as array<struct<key:string,value:string>>) as spec_entries")
    probed = bundles.probe(rows, ("gizmo",))
    assert plan_of(probed.select("evidence_multipack"))[0].lower().count("contains(") >= 4
    for r in probed.collect():
        t = r.name or ""
        assert r.evidence_accessories == ", ".join(w for w in sorted(bundles.PROBE_LEXICON) if re.search(rf"\b{w}\b", t))
        assert r.evidence_triggers == ", ".join(n for n, p in sorted(bundles.TRIGGERS.items()) if re.search(p, t))
        assert r.evidence_multipack == ", ".join(f"{p}:{n}" for p in bundles.MULTIPACKS for n in re.findall(p, t))
