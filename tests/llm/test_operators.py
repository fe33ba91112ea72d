"""The ten operators on small tables with nulls, empties, ties, repeats and clashing columns, against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from shelfmark.llm import bpe, embedding_dedup, lm, minhash, mixing, pii, quality, sharding, textbytes, topk, vectors, warc

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and red green blue lamp table chair over under with from that this were was is a to in garden house river stone".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.1 else "") for _ in range(n))


def table(spark, rows, extra=True):
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    df = spark.createDataFrame(full, DOC)
    # Columns with names that the operators use for their own results.
    return df.selectExpr("*", "1 AS size", "'x' AS spans", "2 AS shard", "3 AS ids", "4 AS score", "'k' AS kept") if extra else df


@pytest.fixture(scope="module")
def docs():
    long_text = prose(1, 20_000)
    rows = [(i, prose(i, 40 + i), ["a", "b", None][i % 3]) for i in range(30)]
    rows += [(30, None, "a"), (31, "", "b"), (32, "   \n\t", "a"), (33, "one", None), (34, "ONE", "b"), (35, long_text, "a"), (36, long_text + " end", "a")]
    rows += [(37, prose(5, 45), "a"), (38, prose(5, 45) + " more", "b"), (39, "two words", "a"), (39, "two words", "a"), (None, "lonely text here", "b")]
    return rows


def test_word_hashes_cut_nothing(monkeypatch):
    monkeypatch.setattr(textbytes, "SLICE_BYTES", 16)
    text = "alpha beta gamma-delta " * 5 + "x" * 70 + " tail"
    body = np.frombuffer(text.encode(), np.uint8)
    got, owner = textbytes.word_hashes(body, np.array([0, len(body)]))
    assert len(got) == len(text.split()) and len(set(got.tolist())) == len(set(text.split())) and set(owner) == {0}


# ------------------------------------------------------------------ personal data
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii(spark, docs):
    tricky = [
        "a@b.com_x@d.org", "é😀 mail a.b@c.de, 1.2.3.4.5.6.7.8 and 256.1.1.1", "4539 1488 0343 6467 and 4539-1488-0343-6468", "+1 (555) 123-4567 +12 +1-2-3",
        "@@a@b", "x@y", "1" * 5000, "a" * 3000 + "@b.c", "0255.001.1.1", "+" * 50 + "49 (30) 1234567", "4539148803436467" * 3,
    ]
    secret = [f"{prose(900 + i, 6)} zorblatt agent {prose(950 + i, 4)} zed{i % 2}@mail.org {prose(70 + i, 6)}" for i in range(12)]
    rows = docs + [(100 + i, t, "a") for i, t in enumerate(tricky)] + [(200 + i, t.replace("zed1", "zed0"), "b") for i, t in enumerate(secret)] + [(300, "zorblatt alone", "b")]
    df = table(spark, rows)
    got = {(r.doc_id, r.text): r for r in pii.with_spans(df).collect()}
    for i, t, _ in rows:
        spans = [f"{s.kind}:{s.start}:{s.end}" for s in got[i, t].spans if s.kind != "term"]
        assert spans == base_spans(t), t[:50]
    found = [s.value for s in got[300, "zorblatt alone"].spans]
    assert found == ["zorblatt"]  # it always comes with one entity, in many surroundings
    clean = pii.sanitise(df)
    assert clean.columns == df.columns and clean.count() == len(rows)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[100] == "[EMAIL]_x@d.org" or "[EMAIL]" in texts[100]
    assert "zed0@mail.org" not in texts[200] and "zorblatt" not in texts[300] and texts[5] == docs[5][1] and texts[30] is None
    assert pii.with_spans(df.limit(0)).count() == 0


def disclosed_by(rows):
    """{term: replacement} of (doc_id, text) rows, from the definitions, for texts with one mention of an entity at most."""
    run = bpe.regex.compile(r"[\p{L}\p{M}\p{N}]+")
    words = lambda t: {w.lower() for w in run.findall(t)}
    terms, held, contexts = [words(t) for _, t in rows], collections.defaultdict(set), collections.defaultdict(dict)
    for i, (_, t) in enumerate(rows):
        for kind, start, end in (s.split(":") for s in base_spans(t)):
            a, b = int(start), int(end)
            value = t[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", t[a:b])
            before, after = t[max(0, a - 100) : a], t[b : b + 100]
            before = re.sub(r"^\S*", "", before) if a > 100 else before
            after = re.sub(r"\S*$", "", after) if len(after) == 100 else after
            near = before + " | " + after
            for _, pattern in PATTERNS:
                near = re.sub(pattern, " ", near)
            held[kind, value].add(i)
            contexts[kind, value][i] = frozenset(words(near))
    found, n = {}, len(rows)
    for c, where in held.items():
        if len(set(contexts[c].values())) < pii.MIN_CONTEXTS or len(where) == n:
            continue
        for t in set().union(*(terms[i] for i in where)):
            n_ct, n_t = sum(t in terms[i] for i in where), sum(t in x for x in terms)
            strength = math.log(n_ct * n / len(where) / n_t) / math.log(n / len(where))
            shown = {contexts[c][i] for i in where if t in terms[i]} | {x for x in contexts[c].values() if t in x}
            if strength >= pii.DISCLOSURE - 1e-12 and len(shown) >= pii.MIN_CONTEXTS:
                found[t] = "[TERM]"
    led = collections.defaultdict(collections.Counter)
    w = r"[\p{L}\p{M}\p{N}]"
    pattern = bpe.regex.compile(rf"{w}++[^\p{{L}}\p{{M}}\p{{N}}]{{1,3}}(?<!{w})(?:{'|'.join(sorted(found, reverse=True))})(?!{w})", bpe.regex.I)
    for _, t in rows:
        for m in pattern.findall(t) if found else ():
            first, *_, last = run.findall(m.lower())
            led[last][first] += 1
    for t, c in led.items():
        role = min(c, key=lambda x: (-c[x], x))
        if 2 * c[role] >= c.total() and role not in found:
            found[t] = f"[{role}]"
    return found


def test_pii_terms_by_brute_force(spark, tmp_path):
    r = random.Random(11)
    rows = [(i, f"{prose(900 + i, 6)} agent Zorblatt {prose(950 + i, 40)} zed@mail.org {prose(70 + i, 6)}") for i in range(12)]
    rows += [(20 + i, f"Xu {prose(300 + i, 60)} from 10.1.2.3 {prose(330 + i, 9)}") for i in range(8)]
    rows += [(40 + i, f"{prose(400 + i, 9)} {'y' * 90}é7 ask +49 30 12345670 {prose(430 + i, 9)}") for i in range(10)]
    rows += [(60 + i, f"7g {prose(5, 30)} copies@mail.org {prose(6, 30)}") for i in range(9)]  # one surrounding
    rows += [(70, "repeated rows ask Quent q@mail.org for more")] * 5 + [(80 + i, f"{prose(500 + i, 5)} Quent {prose(520 + i, 7)} q@mail.org {prose(i, 5)}") for i in range(4)]
    rows += [(100 + i, "agent " + prose(600 + i, 50)) for i in range(60)]
    rows += [(200, "ZORBLATT, xu; 7g"), (201, f"{'Y' * 90}É7"), (None, "agent zorblatt Quent"), (202, ""), (203, "zorblatty xux agentzorblatt")]
    r.shuffle(rows)
    want = disclosed_by(rows)
    assert want["zorblatt"] == "[agent]" and {"xu", "y" * 90 + "é7", "quent"} <= set(want) and "7g" not in want and "the" not in want
    got = pii.with_spans(spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n int")).collect()
    assert len(got) == len(rows)
    for g in got:
        base = [tuple(map(int, s.split(":")[1:])) for s in base_spans(g.text)]
        spans = [(m.start(), m.end(), want[m[0].lower()]) for m in bpe.regex.finditer(r"[\p{L}\p{M}\p{N}]+", g.text) if m[0].lower() in want]
        spans = [s for s in spans if not any(a < s[1] and s[0] < b for a, b in base)]
        assert [(s.start, s.end, s.replacement) for s in g.spans if s.kind == "term"] == spans, g.text
    # The query and its SQL, with texts that name entities several times.
    rows += [(300 + i, f"{rows[i][1]} {rows[-i][1]}") for i in range(30)] + [(400, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    twin = con.execute(pii.OP1_SQL)
    names = [c[0] for c in twin.description]
    want = collections.Counter(twin.fetchall())
    out = pii.op1_pii(spark, str(tmp_path))
    assert sorted(out.columns) == sorted(names) and collections.Counter(tuple(r[c] for c in names) for r in out.collect()) == want
    assert sum(n * r[names.index("n_term")] for r, n in want.items()) > 30


# ------------------------------------------------------------------ archives
def test_warc(spark):
    big = "<p>" + "x" * 200 + "</p>"
    rows = [(i, f"http://h{i % 3}.example.com/p{i}?q=1", big if i % 2 else f"{big}{i}") for i in range(40)]
    rows += [(40, None, None), (41, "not a url", ""), (42, "http://[bad", "short"), (43, "http://a.b/c", "short"), (44, "http://a.b/é ü\r\nX: y", "<é>" * 100)]
    rows += [(45, "http://same.org/", big), (45, "http://same.org/", big), (None, "http://null.org/", "nothing" * 30)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, length int")
    root = warc.new_path(spark, "test_archive")
    captures = warc.write_archives(pages, root)
    directory = warc.build_index(captures, root, block_lines=4)
    assert directory.count() >= 10
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.lookup(warc.page_keys(pages), root, directory).collect())
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= 100:
            first[h] = min(p, first.get(h, p))
    want = []
    for p, _, h in rows:
        body = (h or "").encode()
        f = first.get(h)
        # A null page_id is never the smallest, and revisits only what another page has.
        revisit = f is not None and p != f
        want.append((str(p), len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    assert got == sorted(want)
    assert warc.surt("http://User@M.Example.com:8080/a/b?c=d#e") == "com,example,m:8080)/a/b?c=d"
    one = spark.createDataFrame([(warc.capture_key(rows[3][1], 3),), ("com,nowhere)/ -",)], "key string")
    assert [r.page_id for r in warc.lookup(one, root, directory).collect()] == [3]
    empty = pages.limit(0)
    root = warc.new_path(spark, "empty_archive")
    directory = warc.build_index(warc.write_archives(empty, root), root)
    assert warc.lookup(warc.page_keys(empty), root, directory).count() == 0


# ------------------------------------------------------------------ mixing
def water_fill(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        target = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target | {s: most * sizes[s] for s in full}
        full |= over


def test_mixing(spark, docs):
    df = table(spark, docs + [(500 + i, prose(i, 10), "z" * (i % 5)) for i in range(60)])
    rows = mixing.with_repetitions(df).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.Counter()
    for r in rows:
        assert r["size"] == size(r.text)
        sizes[r.source] += r["size"]
    targets = water_fill(dict(sizes))
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        assert math.isclose(r.target, targets[r.source], rel_tol=1e-9) and r.source_size == sizes[r.source] and 0 <= r.repetitions <= 3
        taken[r.source] += r["size"] * r.repetitions
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - targets[s]) <= 1.5 * largest[s] for s in sizes)
    again = mixing.with_repetitions(df.repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.repetitions) for r in rows) == collections.Counter((r.doc_id, r.repetitions) for r in again)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.repetitions for r in rows)
    assert mixing.with_repetitions(df.limit(0)).count() == 0


# ------------------------------------------------------------------ vectors
def test_embedding_dedup_and_topk(spark, monkeypatch):
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[0] + r.normal(size=16) * 0.05).tolist()) for i in range(60)]
    rows += [(200, base[1].tolist()), (201, (2 * base[1]).tolist()), (202, None), (203, [0.0] * 16), (204, [float("nan")] * 16), (205, [1.0, None]), (206, []), (207, [1.0, 2.0]), (208, [2.0, 4.0])]
    rows += [(300, base[2].tolist()), (300, base[2].tolist()), (350, base[3].tolist())]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<double>, label int, n int")
    ok = lambda v: v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    linked = collections.defaultdict(set)
    for a, (_, x) in enumerate(rows):
        for b, (_, y) in enumerate(rows):
            if a != b and ok(x) and ok(y) and len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                linked[a].add(b)
    for small in (4096, 16):
        got = collections.Counter((g.vec_id, g.n_links, g.component_id, g.kept) for g in embedding_dedup.near_vectors(df, rows=small).collect())
        want = collections.Counter()
        for a, (i, _) in enumerate(rows):
            seen, todo = {a}, [a]
            while todo:
                for b in linked[todo.pop()] - seen:
                    seen.add(b)
                    todo.append(b)
            low = min(rows[b][0] for b in seen)
            want[i, len(linked[a]), low, i == low] += 1
        assert got == want
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0
    packed = topk.numbered(df)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    want = collections.Counter()
    for a, (i, q) in enumerate(whole):
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, c, strict=True)), j) for b, (j, c) in enumerate(whole) if a != b and len(c) == len(q))[:5]
            want.update((i, k + 1, j, -s) for k, (s, j) in enumerate(scores))
    assert sum(n for (i, k, *_), n in want.items() if (i, k) == (300, 1)) == 2  # a repeated row is a query of its own
    for rows_a_block, lists, few, groups in ((4096, 16, 64, 64), (4096, 3, 6, 8), (20, 5, 1, 64)):
        for name, value in (("CANDIDATE_ROWS", rows_a_block), ("LISTS_AT_ONCE", lists), ("FEW", few), ("GROUPS", groups)):
            monkeypatch.setattr(topk, name, value)
        got = topk.top_k(packed.filter("vec_id % 50 = 0"), packed).collect()
        assert collections.Counter(tuple(g) for g in got) == want
    assert topk.top_k(packed.limit(0), packed).count() == 0


def test_topk_outsiders_are_ruled_out_before_the_lists_end():
    r = np.random.default_rng(6)
    centres = r.normal(size=(40, 64))
    x = np.floor(256 * (centres[r.integers(0, 40, 3000)] + 0.2 * r.normal(size=(3000, 64))))
    q = x[:50]
    read = []
    for i, places, lists in topk.survivors(q, x, np.arange(50), 5):
        best = np.argsort(-np.where(np.arange(3000) == i, -np.inf, x @ q[i]), kind="stable")[:5]
        assert set(best) <= set(places) and i not in places
        read.append(lists)
    assert len(read) == 50 and np.mean(read) < 64


# ------------------------------------------------------------------ near-duplicates
def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return set(zip(w, w[1:], strict=False)) if len(w) > 1 else {tuple(w)} if w else set()


def expect_components(spark, rows):
    """near_duplicates of ``rows``, held against all pairs."""
    got = minhash.near_duplicates(table(spark, rows)).collect()
    sets = [(i, shingles(t)) for i, t, _ in rows]
    low = list(range(len(sets)))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 80 * (len(sets[a][1]) + len(sets[b][1]) - both):
                low[max(root(a), root(b))] = min(root(a), root(b))
    members = collections.defaultdict(list)
    for k, (i, _) in enumerate(sets):
        if i is not None:
            members[root(k)].append(i)
    want = collections.Counter()
    for k, (i, s) in enumerate(sets):
        c = min(members[root(k)], default=None) if s else i
        want[i, len(s), c, i is not None and i == c] += 1
    assert collections.Counter((g.doc_id, g.n_shingles, g.component_id, g.kept) for g in got) == want
    return got


def copies(n, words, edits, first=1000):
    r = random.Random(8)
    seedling = [f"w{r.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        copy = list(seedling)
        for _ in range(r.randrange(*edits)):
            copy[r.randrange(words)] = f"w{r.randrange(10**6)}"
        rows.append((first + i, " ".join(copy), "a"))
    return rows


def test_minhash(spark, docs):
    rows = docs + copies(80, 120, (0, 8))
    got = expect_components(spark, rows)
    kept = minhash.deduplicate(table(spark, rows))
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted({g.doc_id for g in got if g.kept}) and None in ids
    assert minhash.near_duplicates(table(spark, rows).limit(0)).count() == 0


def test_deduplicate_chooses_rows_by_id_and_text(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (1, "another text of the same id", "z"), (2, "A b c d", "x"), (3, "a b c d e f", "x"),
            (None, "a b c d", "p"), (None, "a b c d", "q"), (4, "", "x"), (4, "", "x"), (5, None, "x"), (6, "nothing like it at all", "x")]
    df = spark.createDataFrame([(i, t, s, 0) for i, t, s in rows], "doc_id long, text string, source string, times int")
    got = minhash.deduplicate(df)
    assert got.columns == df.columns
    kept = collections.Counter((r.doc_id, r.text) for r in got.collect())
    want = [(1, "a b c d"), (1, "another text of the same id"), (3, "a b c d e f"), (None, "a b c d"), (4, ""), (5, None), (6, "nothing like it at all")]
    assert kept == collections.Counter(want)
    again = {(r.doc_id, r.text): r.source for r in minhash.deduplicate(df.repartition(5)).collect()}
    assert again == {(r.doc_id, r.text): r.source for r in got.collect()}


def test_minhash_copies_about_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 16)  # several tiles a bucket
    got = expect_components(spark, copies(150, 200, (4, 16)))
    assert 1 < len({g.component_id for g in got}) < 150


def test_common_counts_by_either_way(monkeypatch):
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 90, 60)) for _ in range(24)]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(9), np.arange(9, 24)))
    want = [len(np.intersect1d(sets[p], sets[q])) for p, q in zip(a, b)]
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    assert minhash._common(sets, np.unique(a), np.unique(b), a, b).tolist() == want
    assert minhash._common(sets, np.unique(a), np.unique(b), a[:2], b[:2]).tolist() == want[:2]


def test_sketch_estimates_similarity():
    r = np.random.default_rng(1)
    items = r.integers(0, 2**63, 3000).astype(np.uint64)
    both = np.concatenate([np.sort(items[:2000]), np.sort(items[400:2400])])
    s = minhash.fast_sketch(both, np.array([0, 2000, 4000]))
    assert abs((s[0] == s[1]).mean() - 1600 / 2400) < 0.12
    tiny = minhash.fast_sketch(items[:1], np.array([0, 1]))
    assert (tiny != minhash._EMPTY).all()


# ------------------------------------------------------------------ sharding
def test_sharding(spark, docs):
    df = table(spark, docs)
    placed = sharding.assign(df, "doc_id", [1.0] * 5, grown_weight=1.0)
    rows = placed.select("doc_id", "shard", "grown_shard").collect()
    assert all(g.grown_shard in (g["shard"], 5) for g in rows) and len({g["shard"] for g in rows}) > 1
    slots = collections.defaultdict(list)
    for g in sharding.with_slots(placed, "shard", ["doc_id", "text"]).collect():
        slots[g["shard"]].append(g.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(docs)
    many = spark.range(20_000).select(sharding.rendezvous(sharding.F.col("id"), [1.0, 3.0]).alias("s")).groupBy("s").count().collect()
    n = {g.s: g["count"] for g in many}
    assert abs(n[1] / 20_000 - 0.75) < 0.02
    assert sharding.with_slots(placed.limit(0), "shard", ["doc_id"]).count() == 0


# ------------------------------------------------------------------ BPE
def test_bpe(spark, docs, monkeypatch):
    import tiktoken

    ranks = bpe.load_ranks(bpe.default_vocabulary())
    enc = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["a" * 4000, "ab" * 300, "\x1c\x1d ​　  y", "It's 10€ — naïve\n\n  x", "<|endoftext|>"]
    df = table(spark, docs + [(600 + i, t, "a") for i, t in enumerate(odd)])
    out = bpe.decode(bpe.encode(df)).collect()
    assert len(out) == len(docs) + len(odd)
    for r in out:
        assert list(r.ids) == enc.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = collections.Counter()
    for i, t, _ in [*docs, *((600 + i, t, "a") for i, t in enumerate(odd))]:
        ids = enc.encode_ordinary(t or "")
        want[i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())] += 1
    assert None in {k[0] for k in want}
    for at_once, remembered in ((bpe.WORDS_AT_ONCE, bpe.CACHE_WORDS), (7, 20)):
        # Texts in several runs, and words that are forgotten and met again.
        monkeypatch.setattr(bpe, "WORDS_AT_ONCE", at_once)
        monkeypatch.setattr(bpe, "CACHE_WORDS", remembered)
        monkeypatch.setattr(bpe, "LONG_TEXT", at_once * 8)
        assert collections.Counter(tuple(r) for r in bpe.digests(df).collect()) == want
    words = [w for t in odd[2:] for w in bpe.regex.findall(bpe.PATTERN, t)]
    native = bpe.encode_native(spark.createDataFrame([(w,) for w in words], "word string").coalesce(1)).collect()
    assert all(list(r.ids) == enc.encode_ordinary(r.word) for r in native)
    assert bpe.encode(df.limit(0)).count() == 0


def test_bpe_folds_like_the_library():
    import tiktoken

    ranks = bpe.load_ranks(bpe.default_vocabulary())
    enc = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec, r = bpe.Codec(ranks), random.Random(1)
    letter = lambda: chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x3000), r.randrange(0x10000, 0x11000)]))
    texts = ["".join(letter() for _ in range(r.randrange(200))) for _ in range(300)] + ["a" * n for n in range(100)] + ["ab" * n for n in range(50)]
    assert [codec.encode(t) for t in texts] == [enc.encode_ordinary(t) for t in texts]


# ------------------------------------------------------------------ quality
def test_quality(spark, docs):
    clean = [(i, prose(i, 60), "a") for i in range(1, 200)]
    junk = []
    for i in range(15):
        w = prose(500 + i, 40).split()
        junk += [(1000 + i, " ".join(x + "$$$" for x in w), "a"), (2000 + i, " ".join(x.upper() + "!!" for x in w), "a"),
                 (3000 + i, " | ".join(w), "a"), (4000 + i, " ".join(x for x in w[:4] for _ in range(12)), "a")]
    rows = clean + junk + [(9000, None, "a"), (9001, "", "a"), (9002, "Short note.", "a"), (9002, "Short note.", "a")]
    df = table(spark, rows)
    got = {r.doc_id: r for r in quality.score(df, quality.fit(df)).collect()}
    assert all(got[i].kept for i, _, _ in clean) and got[9002].kept and not got[9000].kept and not got[9001].kept
    assert sum(not got[i].kept for i, _, _ in junk) >= 0.9 * len(junk)
    assert quality.fit(df).accuracies()["symbols"] > 0.8
    assert quality.keep_good(df).columns == df.columns
    empty = df.limit(0)
    assert quality.keep_good(empty).count() == 0


def plain_votes(text):
    """A text's votes, word by word."""
    words = text.encode().split()
    if not words:
        return [0] * 8
    n, solid = len(words), sum(map(len, words))
    body, low = text.encode(), [w.lower() for w in words]
    upper, lower = sum(65 <= c <= 90 for c in body), sum(97 <= c <= 122 for c in body)

    def vote(value, junk_from, good_to, enough=True):
        return 0 if not enough else -1 if value >= junk_from else 1 if value <= good_to else 0

    marks = sum(w[-1] in b".,;:!?" for w in words) / n
    known = {w.encode() for w in quality.FUNCTION_WORDS}
    return [
        vote(sum(c in b"#$%&*@^~|<>{}[]=_+\\/" for c in body) / solid, 0.15, 0.03),
        vote(upper / max(upper + lower, 1), 0.5, 0.2),
        vote(sum(a == b for a, b in zip(low, low[1:], strict=False)) / n, 0.3, 0.05, n >= 5),
        vote(sum(w in (b"|", b"*", b"-", b"=", b"~", b"#") for w in words) / n, 0.25, 0.05),
        vote(sum(w.endswith(b"!!") for w in words) / n, 0.3, 0.05),
        0 if n < 20 else 1 if 0.01 <= marks <= 0.35 else -1,
        vote(abs(solid / n - 6.5), 5.5, 3.5),
        -vote(sum(w in known for w in low) / n, 0.08, 0.01, n >= 20),
    ]


def test_votes_are_counted_text_by_text():
    texts = ["", "  ", "wow!!", "! hello", "|", "| a | b", prose(1, 60), prose(2, 60).upper(), "A a A a a a a", "x$$$ y### z@@@", "é ü ß " * 30, "the of and " * 40 + "!!", "nothing!! here!!"]
    texts += [prose(i, 5 + i) + "!" * (i % 3) for i in range(30)] + [prose(9, 200_000)]
    body = "".join(texts).encode()
    at = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    assert quality.votes(np.frombuffer(body, np.uint8), at).tolist() == [plain_votes(t) for t in texts]


def test_em_over_patterns_is_em_over_rows():
    r = np.random.default_rng(5)
    kinds = [quality.LABELLERS.index(x) for x in quality.SYMPTOMS]
    truth = r.random(400) < 0.8
    v = np.where(r.random((400, 8)) < 0.6, np.where(r.random((400, 8)) < 0.9, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None]), 0).astype(np.int8)
    numbers, counts = np.unique(quality.patterns(v), return_counts=True)
    share, table, posterior = quality.estimate(numbers, counts.astype(float), rounds=3)
    # The same three rounds, a row at a time.
    beliefs = []
    for row in v:
        ill = [float(row[j] == -1) for j in kinds]
        beliefs.append([0.1, *(0.9 * x / sum(ill) for x in ill)] if sum(ill) else [0.98, *[0.02 / len(kinds)] * len(kinds)])
    for _ in range(3):
        shares, tables = [], []
        for c in range(len(kinds) + 1):
            start = quality.PRIOR_GOOD if c == 0 else (1 - quality.PRIOR_GOOD) / len(kinds)
            shares.append((sum(b[c] for b in beliefs) + 40 * start) / (len(v) + 40))
            tables.append([])
            for j in range(8):
                yes, no = (50.0, 0.5) if c == 0 else (1.0, 19.0) if j == kinds[c - 1] else (8.0, 0.5)
                good = sum(b[c] for b, row in zip(beliefs, v, strict=True) if row[j] == 1) + yes
                bad = sum(b[c] for b, row in zip(beliefs, v, strict=True) if row[j] == -1) + no
                tables[-1].append(good / (good + bad))
        beliefs = []
        for row in v:
            p = [s * math.prod(t if x == 1 else 1 - t for t, x in zip(ts, row, strict=True) if x) for s, ts in zip(shares, tables, strict=True)]
            beliefs.append([x / sum(p) for x in p])
    assert np.allclose(share, shares) and np.allclose(table, tables)
    assert np.allclose([posterior[int(k)] for k in quality.patterns(v)], [b[0] for b in beliefs])


def test_scorer_training_ends_where_the_loss_is_flat():
    r = np.random.default_rng(8)
    x = r.random((300, 20)).astype(np.float32)
    y = 1 / (1 + np.exp(-(x @ r.normal(size=20) * 3)))
    w, b = quality.train(x, y)
    mean, std = x.mean(axis=0), x.std(axis=0) + 0.01
    z, inside = (x - mean) / std, w * std
    gap = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(z.T @ gap / 300 + 1e-3 * inside).max() < 2e-3 and abs(gap.mean()) < 1e-3


# ------------------------------------------------------------------ language model
def words_over(letters, most):
    return [bytes(x) for n in range(1, most + 1) for x in itertools.product(letters, repeat=n)]


def test_lattice_sums_all_segmentations():
    r = np.random.default_rng(2)
    pieces = [b" ", b"a", b"b", b"ab", b" a", b"ba", b" ab"]
    model = lm._normalised(pieces, r.random(7), r.random(7) + 2, 0.7)
    goes_on, stops = (dict(zip(pieces, np.exp(w))) for w in (model.log_open, model.log_last))
    end = math.exp(model.log_end)

    def total(rest):
        return sum((stops[p] if p == rest else goes_on[p] * total(rest[len(p):])) for p in pieces if rest.startswith(p)) if rest else 0.0

    words = [b"a", b"abba", b"bab", b"aaaaaab", b"b" * 40]
    got = np.exp(model.log_marginal(words[:4]))
    assert np.allclose(got, [total(b" " + w) for w in words[:4]])
    assert np.isfinite(model.log_marginal(words)).all()
    # One of all words, or the end, has probability 1; so have all texts, which are any number of words and one end.
    every = np.exp(model.log_marginal(words_over(b"ab", 12))).sum() + end
    assert 0.995 < every < 1 + 1e-9
    counts = model.expected([b"ab", b"abab"], np.array([1.0, 3.0]))
    assert math.isclose(sum(counts[:, i].sum() * len(p) for i, p in enumerate(pieces)), 3 + 3 * 5)  # every byte is covered once
    assert math.isclose(counts[1].sum(), 4)  # and every word has one last piece


def test_lm(spark, docs):
    df = table(spark, docs)
    for frequent in (5, 40_000):
        got = lm.score_texts(df, frequent=frequent, rounds=1).collect()
        assert len(got) == len(docs)
        train = collections.Counter()
        for i, t, _ in docs:
            if not lm.held_out(i):
                train.update([*lm._words(t), b""])
        n, v = sum(train.values()), len(train)
        want = collections.Counter()
        for i, t, _ in docs:
            w = [*lm._words(t), b""]
            base = sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
            want[i, len(w), sum(train[x] > 0 for x in w), round(base, 4), zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0] += 1
        assert collections.Counter((g.doc_id, g.n_tokens, g.n_known, round(g.base_score, 4), g.held_out) for g in got) == want
        assert all(g.train_tokens == n and g.score < 0 and math.isfinite(g.score) for g in got)
        scores = {(g.doc_id, g.n_tokens): round(g.score, 6) for g in got}
        assert frequent == 5 or scores == before  # noqa: F821
        before = scores  # noqa: F841
    assert lm.score_texts(df.limit(0)).count() == 0
