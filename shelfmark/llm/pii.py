"""Personal data and the terms that disclose it (native: DataFrame functions only).

Protected entities are the e-mail addresses, IP addresses, card numbers and phone
numbers in the texts. Over the whole corpus, the co-occurrence of a term t (a whole word of any length) with
an entity c is measured by pointwise mutual information in documents, which are the
rows; relative to the entity's information content IC(c) = -log2 p(c),

    disclosure(t, c) = PMI(t, c) / IC(c)

is 1 if every document with t has c, and 0 if they are independent. Both are
counted over whole documents, however far apart they stand. A term discloses c
if that is at least ``DISCLOSURE`` and if at least ``MIN_CONTEXTS`` different
surroundings of c show it, so that copies of one passage count once: those
that have the term in them, and one of every document that has both.

A disclosing term is generalised to its role, where the corpus shows one: the word that
leads at least ``ROLE_SHARE`` of the term's occurrences that a word leads (ties to the
smaller), if that word does not itself disclose anything. ``agent Zorblatt`` becomes
``agent [agent]``. Else the term is removed, as ``[TERM]``. Either way all its
occurrences become spans in every document, next to the pattern spans.

Cases: a null or empty text has no spans; a null doc_id is a value like others; repeated rows
count as so many documents and have equal results; an empty table gives an empty
result; extra columns pass through, and columns that the operator adds replace
columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.plans.shared import shared_table

# Possessive forms of the patterns: each part is followed by what it cannot
# contain, so giving characters back never helps. A run is entered only at its
# start or where the last match ended, which is where its leftmost match begins.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
HINTS = {"email": "@", "phone": "+"}

#: Letters on either side of an entity that tell its surroundings apart.
CONTEXT = 100
_WORD = r"[\p{L}\p{M}\p{N}]"
TERM = f"{_WORD}++"
DISCLOSURE = 0.9
MIN_CONTEXTS = 3
ROLE_SHARE = 0.5

_SPAN = "array<struct<start:int,end:int,value:string>>"
_CHUNK = 512


def _located(found: str, gaps: str) -> str:
    """SQL: code-point spans of the matches in ``found``, between which the text has ``gaps``.

    Offsets are summed in chunks, so appending to arrays stays linear in long texts.
    """
    acc = f"struct<at:int,out:{_SPAN}>"
    # Matches and gaps are bound as a lambda's variable: they are found once, however many chunks there are.
    return f"""
    transform(array(named_struct('f', {found}, 'g', {gaps})), z -> transform(array(transform(sequence(0, cast((size(z.f) - 1) div {_CHUNK} as int)), c ->
      aggregate(
        zip_with(slice(z.f, c * {_CHUNK} + 1, {_CHUNK}),
                 slice(z.g, c * {_CHUNK} + 1, least({_CHUNK}, size(z.f) - c * {_CHUNK})),
                 (m, g) -> struct(length(g) as gap, length(m) as len, m as value)),
        cast(named_struct('at', 0, 'out', array()) as {acc}),
        (a, x) -> cast(named_struct('at', a.at + x.gap + x.len, 'out', concat(a.out, array(
            named_struct('start', a.at + x.gap, 'end', a.at + x.gap + x.len, 'value', x.value)))) as {acc})))),
      parts -> flatten(zip_with(parts,
        aggregate(parts, cast(named_struct('at', 0, 'offs', array()) as struct<at:int,offs:array<int>>),
          (a, p) -> cast(named_struct('at', a.at + p.at, 'offs', concat(a.offs, array(a.at))) as struct<at:int,offs:array<int>>)).offs,
        (p, o) -> transform(p.out, s -> named_struct('start', s.start + o, 'end', s.end + o, 'value', s.value)))))[0])[0]"""


def _valid(kind: str) -> str:
    """SQL over ``s.value``: whether a match of the pattern counts."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return rf"regexp_like(s.value, '^{part}(?:[.]{part}){{3}}$')"
    if kind == "card":
        digits = "regexp_replace(s.value, '[^0-9]', '')"
        luhn = f"""aggregate(sequence(0, length({digits}) - 1), 0, (a, i) -> a +
            (case when i % 2 = 0 then cast(substring({digits}, -1 - i, 1) as int)
                  else element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), cast(substring({digits}, -1 - i, 1) as int) + 1) end)) % 10 = 0"""
        return f"(length({digits}) between 13 and 19) and {luhn}"
    if kind == "phone":
        return "length(regexp_replace(s.value, '[^0-9]', '')) between 9 and 15"
    return "true"


def _sql_text(s: str) -> str:
    return "r'" + s + "'"


def with_base_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``_base``: array of (kind index, kind, start, end, value) by kind, then start."""
    body = f"coalesce(`{text}`, '')"
    steps = {}
    for k, pattern in KINDS.items():
        hint = f"contains({body}, '{HINTS[k]}')" if k in HINTS else "true"
        steps[f"_m_{k}"] = F.expr(f"case when {hint} then regexp_extract_all({body}, {_sql_text(pattern)}, 0) else array() end")
    df = df.withColumns(steps)
    parts = []
    for i, (k, pattern) in enumerate(KINDS.items()):
        where = _located(f"_m_{k}", f"split({body}, {_sql_text(pattern)}, -1)")
        parts.append(
            f"""case when size(_m_{k}) > 0 then transform(filter({where}, s -> {_valid(k)}),
            s -> named_struct('k', {i}, 'kind', '{k}', 'start', s.start, 'end', s.end, 'value', s.value))
            else cast(array() as array<struct<k:int,kind:string,start:int,end:int,value:string>>) end"""
        )
    return df.withColumn("_base", F.expr(f"concat({', '.join(parts)})")).drop(*steps)


def _terms(text: Column) -> Column:
    """Distinct lower-case terms."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _row_key(doc_id: str, text: str) -> Column:
    """The same for repeated rows only."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(doc_id).isNull(), text)


def mentions(based: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(key, entity, terms, context): one row per entity span, with the terms near it."""
    rows = based.filter(F.size("_base") > 0).select(_row_key(doc_id, text).alias("key"), F.col(text).alias("text"), F.explode("_base").alias("s"))
    before = F.expr(f"substring(text, greatest(s.start - {CONTEXT}, 0) + 1, least(s.start, {CONTEXT}))")
    after = F.expr(f"substring(text, s.end + 1, {CONTEXT})")
    # A word cut at the rim is not a term, nor are the parts of another entity.
    before = F.when(F.expr(f"s.start > {CONTEXT}"), F.regexp_replace(before, r"^\S*", "")).otherwise(before)
    after = F.when(F.length(after) == CONTEXT, F.regexp_replace(after, r"\S*$", "")).otherwise(after)
    near = F.concat_ws(" | ", before, after)
    for pattern in KINDS.values():
        near = F.regexp_replace(near, pattern, " ")
    value = F.when(F.col("s.kind").isin("card", "phone"), F.regexp_replace("s.value", "[^0-9]", "")).otherwise(F.lower("s.value"))
    return rows.select(
        "key", F.concat_ws(":", "s.kind", value).alias("entity"), F.array_sort(_terms(near)).alias("terms")
    ).withColumn("context", F.md5(F.array_join("terms", " ")))


def disclosing_terms(df: DataFrame, based: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = DISCLOSURE,
                     min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """(term, disclosure): the terms to sanitise, each with the strongest disclosure it has."""
    met = shared_table(mentions(based, text, doc_id), "pii_mentions")
    n = df.count()
    # Without that many surroundings of its own, no term can show an entity in them.
    several = met.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("contexts"))
    met = met.join(shared_table(several.filter(F.col("contexts") >= min_contexts).select("entity"), "pii_entities"), "entity", "left_semi")
    held = shared_table(met.groupBy("entity", "key").agg(F.min("context").alias("context")), "pii_held")
    of_document = df.select(_row_key(doc_id, text).alias("key"), F.col(text).alias("text")).join(held.select("key").distinct(), "key", "left_semi")
    # The rows that hold entities, with their terms: rows with one key are repeats, and each counts.
    of_document = shared_table(of_document.select("key", _terms(F.col("text")).alias("terms")), "pii_holders")
    n_c = held.select("entity", "key").join(of_document.select("key"), "key").groupBy("entity").agg(F.count("*").alias("n_c"))
    pairs = held.join(of_document.select("key", F.explode("terms").alias("term")), "key")
    counted = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_ct"))
    words = df.select(F.explode(_terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    log_n = F.log2(F.lit(float(max(n, 1))))
    scored = (
        counted.join(n_c, "entity").join(words, "term")
        .withColumn("ic", log_n - F.log2("n_c"))
        .filter("ic > 0")
        .withColumn("disclosure", (F.log2("n_ct") + log_n - F.log2("n_c") - F.log2("n_t")) / F.col("ic"))
        .filter(F.col("disclosure") >= threshold - 1e-12)
    )
    scored = shared_table(scored.select("entity", "term", "disclosure"), "pii_scored")
    near = met.select("entity", F.explode("terms").alias("term"), "context")
    shown = pairs.select("entity", "term", "context").unionByName(near).join(scored.select("entity", "term"), ["entity", "term"], "left_semi")
    # Two steps of distinct counts, so that no task holds a hot pair's documents.
    by_context = shown.distinct().groupBy("entity", "term").agg(F.count("*").alias("contexts")).filter(F.col("contexts") >= min_contexts)
    scored = scored.join(by_context.drop("contexts"), ["entity", "term"], "left_semi")
    return shared_table(scored.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii_disclosing")


#: SQL: a pattern of the longest of the terms in ``_terms``, as whole words; only letters, marks and digits make up a term, so it needs no escaping.
_ANY_TERM = f"concat(r'(?iu)(?<!{_WORD})(?:', array_join(reverse(array_sort(_terms)), '|'), r')(?!{_WORD})')"


def roles(holders: DataFrame, found: DataFrame) -> DataFrame:
    """(term, role) of the terms that have one, of holders(text, _terms): the rows in which terms occur, with those."""
    led = F.expr(f"regexp_extract_all(text, concat(r'{_WORD}++[^\\p{{L}}\\p{{M}}\\p{{N}}]{{1,3}}', {_ANY_TERM}), 0)")
    pairs = holders.select(F.explode(led).alias("m")).select(F.regexp_extract_all(F.lower("m"), F.lit(TERM), F.lit(0)).alias("w"))
    counts = pairs.select(F.element_at("w", -1).alias("term"), F.element_at("w", 1).alias("role")).groupBy("term", "role").agg(F.count("*").alias("n"))
    best = counts.groupBy("term").agg(F.sum("n").alias("all"), F.min_by("role", F.struct(-F.col("n"), F.col("role"))).alias("role"), F.max("n").alias("n"))
    best = best.filter(F.col("n") >= F.col("all") * ROLE_SHARE).select("term", "role")
    return best.join(found.select(F.col("term").alias("role")), "role", "left_anti").select("term", "role")


def with_spans(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``df`` with ``spans``: array of (k, kind, start, end, value, replacement).

    Pattern spans come first, by kind and start; term spans (kind ``term``) follow, by start.
    """
    based = with_base_spans(df, text)
    found = disclosing_terms(df, based, text, doc_id, **options)
    keyed = df.select(_row_key(doc_id, text).alias("_key"), F.col(text).alias("text"))
    # A row per different document that has a disclosing term.
    holders = keyed.select("_key", F.explode(_terms(F.col("text"))).alias("term")).join(found.select("term"), "term")
    holders = shared_table(holders.groupBy("_key").agg(F.collect_set("term").alias("_terms")), "pii_holders_of_terms")
    role = shared_table(roles(keyed.join(holders, "_key"), found), "pii_roles")
    named = found.join(role, "term", "left").select("term", F.coalesce(F.concat(F.lit("["), "role", F.lit("]")), F.lit("[TERM]")).alias("replacement"))
    hits = holders.select("_key", F.explode("_terms").alias("term")).join(named, "term")
    hits = hits.groupBy("_key").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("term", "replacement")))).alias("_hits"))
    hits = shared_table(hits, "pii_hits")
    rows = based.withColumn("_key", _row_key(doc_id, text)).join(hits, "_key", "left")
    pattern = _ANY_TERM.replace("_terms", "map_keys(_hits)")
    body = f"coalesce(`{text}`, '')"
    rows = rows.withColumn("_p", F.expr(f"case when _hits is not null then {pattern} end"))
    rows = rows.withColumn("_m_t", F.expr(f"case when _p is not null then regexp_extract_all({body}, _p, 0) else array() end"))
    where = _located("_m_t", f"split({body}, _p, -1)")
    term = "struct<k:int,kind:string,start:int,end:int,value:string,replacement:string>"
    spans = f"""concat(
      transform(_base, s -> cast(named_struct('k', s.k, 'kind', s.kind, 'start', s.start, 'end', s.end, 'value', s.value,
                'replacement', concat('[', upper(s.kind), ']')) as {term})),
      case when size(_m_t) > 0 then
        filter(transform({where}, s -> cast(named_struct('k', {len(KINDS)}, 'kind', 'term', 'start', s.start, 'end', s.end, 'value', s.value,
               'replacement', coalesce(_hits[lower(s.value)], '[TERM]')) as {term})),
               t -> not exists(_base, b -> b.start < t.end and t.start < b.end))
      else cast(array() as array<{term}>) end)"""
    return rows.withColumn("spans", F.expr(spans)).drop("_key", "_hits", "_p", "_m_t")


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def sanitise(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``df`` with every span of its text replaced: ``[EMAIL]`` and so on, terms by their role or ``[TERM]``.

    Overlapping spans are replaced once, by the one that starts first (then the longest).
    """
    rows = with_spans(df, text, doc_id, **options)
    acc = "struct<at:int,out:array<string>>"
    rewritten = f"""case when size(spans) = 0 then `{text}` else
      array_join(aggregate(
        array_sort(spans, (a, b) -> case when a.start <> b.start then a.start - b.start else b.end - a.end end),
        cast(named_struct('at', 0, 'out', array()) as {acc}),
        (a, s) -> cast(case when s.start < a.at then named_struct('at', a.at, 'out', a.out)
          else named_struct('at', s.end, 'out', concat(a.out, array(substring(`{text}`, a.at + 1, s.start - a.at), s.replacement))) end as {acc}),
        a -> concat(a.out, array(substring(`{text}`, a.at + 1)))), '') end"""
    return rows.withColumn(text, F.expr(rewritten)).select(*df.columns)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data and disclosing terms in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = with_spans(docs)
    counts = [F.expr(f"cast(size(filter(_base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    terms = F.expr("cast(size(filter(spans, s -> s.kind = 'term')) as long)").alias("n_term")
    every = F.size("spans").cast("long").alias("n_spans")
    return rows.select("doc_id", *counts, F.sha2(_joined("_base"), 256).alias("base_sha256"), _joined("spans").alias("spans"), terms, every)


def _oracle() -> str:
    """DuckDB SQL of ``op1_pii``: its patterns need no look-around, and a term's spans are found among all words."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    word = r"[\p{L}\p{M}\p{N}]+"
    # The matches of a pattern and the gaps between them, cut into rows with the code points before each.
    cut = lambda p, columns, source: f"""SELECT {columns}, v, CAST(sum(len(gap) + len(v)) OVER (PARTITION BY rid ORDER BY i) - len(v) AS BIGINT) AS a FROM (
      SELECT *, f[i] AS v, g[i] AS gap FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (SELECT *, regexp_extract_all(t, '{p}') AS f, string_split_regex(t, '{p}') AS g FROM {source})))"""  # noqa: E731
    near = "concat_ws(' | ', before, after)"
    for p in plain.values():
        near = f"regexp_replace({near}, '{p}', ' ', 'g')"
    found = " UNION ALL ".join(cut(p, f"rid, t, {i} AS k, '{kind}' AS kind", "r") for i, (kind, p) in enumerate(plain.items()))
    return rf"""
WITH r AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({found}),
dg AS (SELECT *, a + len(v) AS b, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM s),
base AS MATERIALIZED (SELECT * FROM dg WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: len(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INTEGER), 0) > 255)) = 0
    WHEN 'card' THEN len(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(0, len(d)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(d[len(d) - i] AS INTEGER)
      ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][CAST(d[len(d) - i] AS INTEGER) + 1] END)) % 10 = 0
    WHEN 'phone' THEN len(d) BETWEEN 9 AND 15 ELSE true END),
around AS (SELECT rid, kind || ':' || CASE WHEN kind IN ('card', 'phone') THEN d ELSE lower(v) END AS entity,
    CASE WHEN a > 100 THEN regexp_replace(substr(t, a - 99, 100), '^\S*', '') ELSE substr(t, 1, a) END AS before,
    CASE WHEN len(substr(t, b + 1, 100)) = 100 THEN regexp_replace(substr(t, b + 1, 100), '\S*$', '') ELSE substr(t, b + 1, 100) END AS after FROM base),
met AS MATERIALIZED (SELECT rid, entity, list_sort(list_distinct(regexp_extract_all(lower({near}), '{word}'))) AS terms FROM around),
shown_at AS (SELECT *, md5(array_to_string(terms, ' ')) AS context FROM met),
known AS MATERIALIZED (SELECT * FROM shown_at WHERE entity IN (SELECT entity FROM shown_at GROUP BY entity HAVING count(DISTINCT context) >= {MIN_CONTEXTS})),
held AS (SELECT entity, rid, min(context) AS context FROM known GROUP BY 1, 2),
words AS MATERIALIZED (SELECT rid, unnest(list_distinct(regexp_extract_all(lower(t), '{word}'))) AS term FROM r),
n_t AS (SELECT term, count(*) AS n_t FROM words GROUP BY 1),
n_c AS (SELECT entity, count(*) AS n_c FROM held GROUP BY 1),
pairs AS MATERIALIZED (SELECT entity, term, context FROM held JOIN words USING (rid)),
scored AS MATERIALIZED (SELECT entity, term FROM (SELECT entity, term, count(*) AS n_ct FROM pairs GROUP BY 1, 2) JOIN n_c USING (entity) JOIN n_t USING (term), (SELECT count(*) AS n FROM r)
  WHERE n_c < n AND (log2(n_ct) + log2(n) - log2(n_c) - log2(n_t)) / (log2(n) - log2(n_c)) >= {DISCLOSURE} - 1e-12),
evidence AS (SELECT entity, term, context FROM pairs UNION SELECT entity, unnest(terms), context FROM known),
found AS MATERIALIZED (SELECT DISTINCT term FROM (SELECT entity, term FROM evidence JOIN scored USING (entity, term) GROUP BY 1, 2 HAVING count(DISTINCT context) >= {MIN_CONTEXTS})),
holders AS (SELECT * FROM r WHERE rid IN (SELECT rid FROM words WHERE term IN (SELECT term FROM found))),
w AS ({cut(word, "rid", "holders")}),
terms AS (SELECT rid, a, a + len(v) AS b FROM w WHERE lower(v) IN (SELECT term FROM found)
  AND NOT EXISTS (SELECT 1 FROM base WHERE base.rid = w.rid AND base.a < w.a + len(w.v) AND w.a < base.b)),
spans AS (SELECT rid, k, kind, a, b FROM base UNION ALL SELECT rid, {len(KINDS)}, 'term', a, b FROM terms),
of_row AS (SELECT rid, count(*) AS n, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in (*KINDS, "term"))},
  string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) FILTER (k < {len(KINDS)}) AS own, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY k, a) AS every FROM spans GROUP BY 1)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in (*KINDS, "term"))}, sha256(coalesce(own, '')) AS base_sha256, coalesce(every, '') AS spans, coalesce(n, 0) AS n_spans FROM r LEFT JOIN of_row USING (rid)
"""


OP1_SQL = _oracle()
