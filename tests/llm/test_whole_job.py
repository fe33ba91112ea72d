"""Cases in which an operator once did less than the whole job."""

import base64
import collections
import math
import random

import numpy as np

import corpus_pipeline
from shelfmark import queries_catalog
from shelfmark.llm import lm, minhash, pii
from shelfmark.operators import models

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts], DOC)


def five_words(text):
    w = text.encode().lower().split()  # A-Z and ASCII white space only
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_minhash_stage_takes_five_words(spark):
    whole = [f"w{i}" for i in range(100)]
    edited = lambda *at: " ".join("new" + w if i in at else w for i, w in enumerate(whole))
    rows = [(1, edited()), (2, edited(20, 50, 80)), (3, edited(0)), (4, edited(60)), (5, "a b c"), (6, "A b c"), (7, "a b"), (8, ""), (9, edited(10, 11, 12))]
    sets = {i: five_words(t) for i, t in rows}
    low = {i: i for i in sets}
    for _ in sets:  # as many rounds as any chain is long
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    low[a] = low[b] = min(low[a], low[b])
    want = sorted(i for i in sets if low[i] == i)
    assert 2 in want and 3 not in want  # three lone words of a hundred leave 0.73; pairs of words 0.89
    out = corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), "")
    assert sorted(r.doc_id for r in out.collect()) == want
    two = minhash.near_duplicates(table(spark, rows)).filter("kept").collect()
    assert 2 not in {r.doc_id for r in two}
    sizes = collections.Counter((r.doc_id, r.n_shingles) for r in minhash.near_duplicates(table(spark, rows), 5).collect())
    assert sizes == collections.Counter((i, len(s)) for i, s in sets.items())


def test_terms_far_from_their_entity_disclose_it(spark):
    r = random.Random(4)
    fill = lambda n: " ".join(r.choice("the of and red green blue lamp table chair over under with".split()) for _ in range(n))
    rows = [(i, f"Quillfeather {fill(120)} ask {fill(5)} q@mail.org {fill(5)}") for i in range(12)]
    # Half of the documents have the name next to the address: counted there only, it would fall short.
    rows += [(20 + i, f"{fill(6)} Brackenmoor {fill(3)} b@mail.org {fill(9)}" if i % 2 else f"Brackenmoor {fill(120)} b@mail.org {fill(9)}") for i in range(12)]
    # Copies of one passage are one surrounding, however often they come.
    rows += [(40 + i, f"Onlycopies {fill(120)} write to the one desk {'x ' * 60} c@mail.org {'y ' * 60}") for i in range(12)]
    rows += [(60 + i, fill(60)) for i in range(60)] + [(200, "Quillfeather alone"), (201, "brackenmoor alone"), (202, "onlycopies alone")]
    texts = {x.doc_id: x.text for x in pii.sanitise(table(spark, rows)).collect()}
    assert "uillfeather" not in texts[200].lower() and "rackenmoor" not in texts[201].lower()
    assert texts[202] == "onlycopies alone" and texts[100] == dict(rows)[100]


def every_way(text, pieces):
    return [[text[:k], *rest] for k in range(1, len(text) + 1) if text[:k] in pieces for rest in every_way(text[k:], pieces)] if text else [[]]


def way_weight(parts, goes_on, stops):
    return math.prod(goes_on[p] for p in parts[:-1]) * stops[parts[-1]]


def test_lattice_takes_long_pieces():
    letters = [c for c in range(256) if not 65 <= c <= 90 and not 9 <= c <= 13]
    ranks = {bytes([c]): c for c in letters} | {b" everything": 256, b" every": 257, b"thing": 258, b" " + b"x" * 40: 259}
    model = lm.initial_lattice(ranks | {b"A": 300, b" a b": 301, b"\n": 302})
    assert set(model.pieces) == set(ranks)  # no other piece can occur in a word
    goes_on, stops = (dict(zip(model.pieces, np.exp(w))) for w in (model.log_open, model.log_last))
    words = [b"everything", b"x" * 40, b"a"]
    want = [sum(way_weight(w, goes_on, stops) for w in every_way(b" " + x, set(ranks))) for x in words]
    assert np.allclose(model.log_marginal(words), np.log(want), rtol=1e-12)


def test_lm_score_is_the_lattice_marginal(spark, tmp_path):
    pieces = [*(bytes([c]) for c in range(256)), b" ab", b"ab", b" abab", b"ba"]
    ranks = {p: k for k, p in enumerate(pieces)}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % k for p, k in ranks.items()))
    rows = [(i, t) for i, t in enumerate(["abab ab", "AB  abba", "", "ba ab ab abab", "unseen words", "x" * 50 + " ab"] * 3)] + [(None, "abab")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, x int")
    train = collections.Counter(w for i, t in rows if not lm.held_out(i) for w in lm._words(t))
    texts = sum(not lm.held_out(i) for i, _ in rows)
    model = lm.initial_lattice(ranks)
    goes_on, stops = (dict(zip(model.pieces, np.exp(w))) for w in (model.log_open, model.log_last))
    end = math.exp(model.log_end)
    for rounds in (0, 1, 2):
        if rounds:
            fitted = [dict.fromkeys(model.pieces, 0.1), {p: 0.1 * (p != b" ") for p in model.pieces}]
            for w, c in train.items():
                ways = every_way(b" " + w, goes_on)
                whole = sum(way_weight(parts, goes_on, stops) for parts in ways)
                for parts in ways:
                    for k, p in enumerate(parts):
                        fitted[k == len(parts) - 1][p] += c * way_weight(parts, goes_on, stops) / whole
            total = {f: sum(d[p] for d in fitted for p in model.pieces if p.startswith(b" ") == f) + f * (texts + 0.1) for f in (False, True)}
            goes_on, stops = ({p: n / total[p.startswith(b" ")] for p, n in d.items()} for d in fitted)
            end = (texts + 0.1) / total[True]
        for frequent in (2, 100):
            for r in lm.score_texts(df, str(path), rounds, frequent).join(df, "doc_id").collect():
                want = math.log10(end) + sum(math.log10(sum(way_weight(w, goes_on, stops) for w in every_way(b" " + x, goes_on))) for x in lm._words(r.text))
                assert math.isclose(r.score, want, rel_tol=1e-9), r


def test_event_windows_count_every_event(spark, sf_dir):
    rows = queries_catalog.event_windows(spark, sf_dir).collect()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert sum(r.n for r in rows) == events.count()
    assert len({(r.window_start, r.event_type) for r in rows}) == len(rows)


def test_calibrated_rows_with_missing_features_stay(spark):
    rows = [(i, float(i % 10), float(i % 10 > 4)) for i in range(40)] + [(100, None, 1.0), (101, float("nan"), None), (102, 3.0, None)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    got = {r.id: r.calibrated for r in models.calibrate(df, ["x"], "y").collect()}
    assert got.keys() == {r[0] for r in rows}
    assert got[100] is None and got[101] is None and got[102] < 0.5 < got[9]
