"""The registered queries on the smallest tables, and the pipeline's stages on what each was given."""

import collections

import duckdb
import tiktoken
from test_operators import base_spans, disclosed_by, water_fill
from test_whole_job import five_words

import corpus_pipeline
from shelfmark.llm import bpe, quality
from shelfmark.llm.queries import ORACLE_SQL, QUERIES
from shelfmark.plans import shared
from shelfmark.plans.shared import shared_table


def test_twins(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        df = QUERIES[name](spark, sf_dir)
        q = con.execute(sql)
        names = [c[0] for c in q.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(map(str, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(str, q.fetchall())), name


def smallest_of_groups(texts):
    """The doc_ids that are the smallest of those that resemblance on five words reaches."""
    sets = {i: five_words(t or "") for i, t in texts.items()}
    low = {i: i for i in sets}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    by_shingle = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            by_shingle[g].append(i)
    for a, s in sets.items():
        common = collections.Counter(b for g in s for b in by_shingle[g] if b > a)
        for b, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[b]) - n):
                low[max(root(a), root(b))] = min(root(a), root(b))
    return sorted(i for i in sets if root(i) == i)


def hidden(text, terms):
    """The text with its spans replaced: of those that overlap, the one that starts first, then the longest."""
    spans = [(int(a), int(b), f"[{kind.upper()}]") for kind, a, b in (s.split(":") for s in base_spans(text))]
    base = list(spans)
    for m in bpe.regex.finditer(r"[\p{L}\p{M}\p{N}]+", text or ""):
        if m[0].lower() in terms and not any(a < m.end() and m.start() < b for a, b, _ in base):
            spans.append((m.start(), m.end(), terms[m[0].lower()]))
    out, at = [], 0
    for a, b, put in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], put]
            at = b
    return "".join(out) + text[at:] if spans else text


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality", "minhash", "pii", "mixing", "bpe"]
    enc = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.default_vocabulary()), special_tokens={})
    for name, stage in corpus_pipeline.STAGES:
        out = shared_table(stage(spark, docs, sf_dir), "test_stage")
        assert name == "bpe" or out.columns == corpus_pipeline.COLUMNS
        before, rows = docs.collect(), out.collect()
        texts = {r.doc_id: r.text for r in before}
        if name == "quality":
            good = {r.doc_id for r in quality.score(docs, quality.fit(docs)).filter("kept").collect()}
            assert {r.doc_id for r in rows} == good
        if name == "minhash":
            assert sorted(r.doc_id for r in rows) == smallest_of_groups(texts)
        if name == "pii":
            terms = disclosed_by([(r.doc_id, r.text) for r in before])
            assert {r.doc_id: r.text for r in rows} == {i: hidden(t, terms) for i, t in texts.items()} and len(rows) == len(before)
        if name == "mixing":
            taken, sizes, largest = collections.Counter(), collections.Counter(), collections.Counter()
            for r in before:
                sizes[r.source] += len((r.text or "").encode().split())
                largest[r.source] = max(largest[r.source], len((r.text or "").encode().split()))
            for r in rows:
                taken[r.source] += len((r.text or "").encode().split())
            assert all(abs(taken[s] - t) <= 1.5 * largest[s] for s, t in water_fill(dict(sizes)).items())
            assert max(collections.Counter(r.doc_id for r in rows).values()) <= 3 and all(texts[r.doc_id] == r.text for r in rows)
        if name == "bpe":
            assert collections.Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in rows) == collections.Counter(
                (r.doc_id, len(ids), tuple(ids)) for r in before for ids in [enc.encode_ordinary(r.text or "")]
            )
        docs = out


def test_run_is_all_stages_and_leaves_one_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), "test_stage")
    before = {path for _, path in shared._made}
    out = corpus_pipeline.run(spark, sf_dir)
    assert {path for _, path in shared._made} - before == {shared.table_path(out)}
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in out.collect()) == collections.Counter((r.doc_id, tuple(r.ids)) for r in docs.collect())
