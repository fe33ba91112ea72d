"""DuckDB twins of the catalog queries, written from the operators' definitions."""

from __future__ import annotations

from shelfmark.functions.text import ACRONYMS
from shelfmark.sources.catalog import CATALOG_SQL



def _ram(t: str) -> str:
    return rf"""coalesce(try_cast(regexp_extract({t}, '(\d+)\s*gb', 1, 'i') AS INTEGER), try_cast(regexp_extract({t}, 'ram[^0-9]{{0,6}}(\d+)', 1, 'i') AS INTEGER))"""


def _storage(t: str) -> str:
    p = r"'(\d+(?:\.\d+)?)\s*(tb|gb)\b'"
    return f"""CAST(round_even(try_cast(regexp_extract({t}, {p}, 1, 'i') AS DOUBLE) * CASE lower(regexp_extract({t}, {p}, 2, 'i')) WHEN 'tb' THEN 1024 ELSE 1 END, 0) AS INTEGER)"""


def _screen(t: str) -> str:
    return rf"""try_cast(regexp_extract({t}, '(\d{{2,3}}|\d{{1,2}}\.\d)\s*(?:"|inch|in|-inch)\b', 1, 'i') AS DOUBLE)"""


def _valid(x: str, sub: str = "sub_category", name: str = "name") -> str:
    return f"""coalesce(CASE WHEN contains(lower({name}), 'projector') OR contains(lower({name}), 'laser tv') THEN {x} BETWEEN 10 AND 150
      WHEN lower({sub}) = 'laptop' THEN {x} BETWEEN 10 AND 18 WHEN lower({sub}) = 'tv' THEN {x} BETWEEN 18 AND 130 ELSE {x} BETWEEN 10 AND 130 END, false)"""


def _cpu(t: str) -> str:
    ap, i1 = r"'\b(m[123])\b(?:\s*(pro|max))?'", r"'\bintel\s*core\s*i([3579])[- ]?(\d{4,5}[a-z]{0,2})?'"
    i2, ry = r"'\bi([3579])[- ]?(\d{4,5}[a-z]{0,2})\b'", r"'\bryzen\s*([3579])\b(?:\s*(\d{4,5}[a-z]{0,2}))?'"
    s = f"lower({t})"
    arm = lambda p, lead: f"WHEN regexp_matches({s}, {p}) THEN '{lead}' || regexp_extract({s}, {p}, 1) || CASE WHEN regexp_extract({s}, {p}, 2) <> '' THEN '_' || regexp_extract({s}, {p}, 2) ELSE '' END"
    return f"CASE {arm(ap, 'apple_')} {arm(i1, 'intel_i')} {arm(i2, 'intel_i')} {arm(ry, 'amd_ryzen')} END"


def _gpu(t: str) -> str:
    s = f"lower({t})"
    return rf"""CASE WHEN contains({s}, 'iris xe') THEN 'intel_iris_xe'
      WHEN regexp_matches({s}, '\brtx\s*\d{{4}}\b') THEN 'nvidia_rtx_' || regexp_extract({s}, '\brtx\s*(\d{{4}})\b', 1)
      WHEN regexp_matches({s}, '\bgtx\s*\d{{3,4}}\b') THEN 'nvidia_gtx_' || regexp_extract({s}, '\bgtx\s*(\d{{3,4}})\b', 1)
      WHEN regexp_matches({s}, '\bradeon\s*[a-z0-9]+\b') THEN 'amd_radeon_' || regexp_extract({s}, '\bradeon\s*([a-z0-9]+)\b', 1)
      WHEN contains({s}, 'radeon') THEN 'amd_radeon' WHEN contains({s}, '10core') AND contains({s}, 'apple') THEN 'apple_10core' END"""


def _color(t: str) -> str:
    s = f"lower(trim({t}))"
    return f"""nullif(replace(CASE {s} WHEN 'space grey' THEN 'space_gray' WHEN 'space gray' THEN 'space_gray' WHEN 'midnight' THEN 'midnight_blue'
      WHEN 'grey' THEN 'gray' WHEN 'rose' THEN 'pink' ELSE {s} END, ' ', '_'), '')"""


def _condition(t: str) -> str:
    s = f"lower({t})"
    return rf"""CASE WHEN regexp_matches({s}, '\bnew\b') THEN 'new' WHEN contains({s}, 'renew') THEN 'renewed'
      WHEN contains({s}, 'refurb') OR contains({s}, 'remanufactur') OR contains({s}, 'restored') THEN 'refurbished'
      WHEN contains({s}, 'open box') OR contains({s}, 'open-box') THEN 'open_box'
      WHEN contains({s}, 'used') OR contains({s}, 'pre-owned') OR contains({s}, 'preowned') THEN 'used' END"""


def _brand(t: str) -> str:
    s = rf"regexp_replace(regexp_replace(lower(trim({t})), '^brand:\s*', ''), '\s+\(refurbished\)$', '')"
    return f"""nullif(CASE {s} WHEN 'hewlett-packard' THEN 'hp' WHEN 'hp inc.' THEN 'hp' WHEN 'samsung®' THEN 'samsung' WHEN 'lg electronics' THEN 'lg'
      WHEN 'lgelectronics' THEN 'lg' WHEN 'insignia™' THEN 'insignia' WHEN 'amazon renewed' THEN 'amazon' ELSE {s} END, '')"""


def _bucket(sub: str, x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN 'u' WHEN lower({sub}) = 'laptop' THEN printf('%.1f', CAST(round_even({x} * 2, 0) / 2 AS DOUBLE))
      ELSE CAST(CAST(round_even({x} / 5, 0) * 5 AS INTEGER) AS VARCHAR) END"""


def _pack(t: str) -> str:
    s = f"lower({t})"
    one = lambda p: f"(SELECT CASE WHEN q BETWEEN 2 AND 50 THEN q END FROM (SELECT try_cast(regexp_extract({s}, '{p}', 1) AS INTEGER) AS q))"
    return "coalesce(" + ", ".join(one(p) for p in (r"\b(\d+)\s*pack\b", r"\b(\d+)\s*pk\b", r"\b(\d+)\s*-\s*pack\b", r"\bx\s*(\d+)\b", r"\b(\d+)\s*count\b")) + ")"


def _readable(t: str) -> str:
    return rf"""CASE WHEN starts_with({t}, 'apple_m') THEN 'Apple ' || upper(split_part({t}, '_', 2))
      WHEN starts_with({t}, 'intel_i') THEN 'Intel Core ' || upper(split_part({t}, '_', 2))
      WHEN starts_with({t}, 'amd_ryzen') THEN 'AMD Ryzen' || coalesce(' ' || coalesce(list_filter(string_split({t}, '_'), lambda x: regexp_full_match(x, '\d+'))[1],
        nullif(regexp_replace(split_part({t}, '_', 2), '\D', '', 'g'), '')), '') END"""


def _title(t: str) -> str:
    return rf"""trim(regexp_replace(regexp_replace(lower(coalesce({t}, '')), '[^a-z0-9" ]+', ' ', 'g'), '\s+', ' ', 'g'))"""


def _slug(t: str) -> str:
    s = rf"trim(regexp_replace(lower(regexp_replace(strip_accents({t}), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"coalesce(nullif(rtrim(substr({s}, 1, 48), '_'), ''), 'product')"


def _family(t: str, brand: str) -> str:
    w = f"string_split({_title(t)}, ' ')"
    rest = f"CASE WHEN coalesce({brand}, '') <> '' AND {w}[1] = {brand} THEN array_to_string({w}[2:], ' ') ELSE {_title(t)} END"
    head = f"trim(array_to_string(string_split(regexp_replace({rest}, '^(?:(?:renewed|refurbished|restored|certified|open|box)(?: |$))+', ''), ' ')[1:5], ' '))"
    return f"coalesce(nullif({head}, ''), {_title(t)})"


def _squeeze(t: str) -> str:
    return rf"regexp_replace({t}, '\s+', ' ', 'g')"


_spec = lambda k: f"""CASE WHEN json_valid(details) THEN json_extract_string(details, '$.specifications."{k}"') END"""
_top = lambda k: f"CASE WHEN json_valid(details) THEN json_extract_string(details, '$.{k}') END"

E = f"""WITH products AS ({CATALOG_SQL}), e AS (
  SELECT *, {_spec('RAM Memory')} AS s_ram, {_spec('Screen Size')} AS s_screen, {_spec('Color')} AS s_color, {_spec('Condition')} AS s_cond,
    {_top('brand')} AS d_brand, {_top('color')} AS d_color FROM products
)"""
A = f"""{E}, a0 AS (
  SELECT *, coalesce(nullif({_ram('s_ram')}, 0), {_ram('name')}) AS ram, coalesce(nullif({_storage("''")}, 0), {_storage('name')}) AS storage,
    coalesce(nullif({_screen('s_screen')}, 0), {_screen('name')}) AS inches, coalesce({_color("coalesce(s_color, '')")}, {_color('name')}) AS color,
    {_cpu('name')} AS cpu, {_gpu('name')} AS gpu, {_condition("name || ' ' || coalesce(s_cond, '')")} AS cond,
    len(list_filter([' bundle', ' kit', ' combo', ' with ', '+', ' includes '], lambda w: contains(lower(name), w))) > 0 AS bundle
  FROM e
), a AS (
  SELECT * EXCLUDE (inches), CASE WHEN inches = 0 OR {_valid('inches')} THEN inches END AS screen,
    coalesce(nullif(trim(lower(sub_category)), ''), 'unknown') AS b_sub, coalesce({_brand('brand')}, '_unknown') AS b_brand FROM a0
), b AS (SELECT *, {_bucket('b_sub', 'screen')} AS b_bucket FROM a)"""
def _tfidf(source: str, p: str = "") -> str:
    """CTEs ending in w(row, term, weight) over source(row, text); their names begin with ``p``."""
    return rf"""{p}src AS ({source}), {p}tok AS (SELECT row, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}\p{{M}}_]{{2,}}') AS t FROM {p}src),
  {p}grams AS (SELECT row, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM {p}tok),
  {p}tf AS (SELECT row, term, count(*) AS tf FROM {p}grams GROUP BY 1, 2), {p}n AS (SELECT count(*) AS n FROM {p}src),
  {p}df AS (SELECT term, count(*) AS df FROM {p}tf GROUP BY 1 HAVING count(*) >= 3 AND count(*) <= 0.95 * (SELECT n FROM {p}n)),
  {p}raw AS (SELECT row, term, (1 + ln(tf)) * (ln((1 + (SELECT n FROM {p}n)) / (1 + df)) + 1) AS w FROM {p}tf JOIN {p}df USING (term)),
  {p}w AS (SELECT row, term, w / sqrt(sum(w * w) OVER (PARTITION BY row)) AS weight FROM {p}raw)"""


_UNKNOWN = "CASE b_brand WHEN '_unknown' THEN 'unknown' ELSE b_brand END"
#: The grouping: titles' cosines within blocks, their closure, medoids and ids; gr has a row a component.
G = rf"""{A.replace("WITH ", "WITH RECURSIVE ", 1)}, {_tfidf(f"SELECT row_id AS row, {_title('name')} AS text FROM b", "t")},
  tp AS (SELECT x.row AS i, y.row AS j FROM tw x JOIN tw y USING (term) JOIN b bx ON bx.row_id = x.row JOIN b bz ON bz.row_id = y.row
    WHERE x.row < y.row AND bx.b_sub = bz.b_sub AND bx.b_brand = bz.b_brand AND bx.b_bucket = bz.b_bucket GROUP BY 1, 2 HAVING sum(x.weight * y.weight) >= 0.40 - 1e-9),
  te AS (SELECT i, j FROM tp UNION ALL SELECT j, i FROM tp),
  reach AS (SELECT row_id AS i, row_id AS j FROM b UNION SELECT r.i, te.j FROM reach r JOIN te ON r.j = te.i),
  comp AS (SELECT i AS row_id, min(j) AS component FROM reach GROUP BY 1),
  cl AS (SELECT component, row_id, term, weight FROM comp JOIN tw ON tw.row = comp.row_id), cs AS (SELECT component, term, sum(weight) AS c FROM cl GROUP BY 1, 2),
  cn AS (SELECT component, sqrt(sum(c * c)) AS cn FROM cs GROUP BY 1), cx AS (SELECT component, row_id, sum(weight * c / cn) AS s FROM cl JOIN cs USING (component, term) JOIN cn USING (component) GROUP BY 1, 2),
  med AS (SELECT component, row_id FROM comp LEFT JOIN cx USING (component, row_id) QUALIFY row_number() OVER (PARTITION BY component ORDER BY round(coalesce(s, 0), 9) DESC, row_id) = 1),
  nm AS (SELECT med.component, b.*, nullif(b_brand, '_unknown') AS g_brand, {_family('name', _UNKNOWN)} AS family, nullif(regexp_extract(name, '\b(20[1-3]\d)\b', 1), '') AS generation FROM med JOIN b USING (row_id)),
  nb AS (SELECT *, concat_ws('_', {_UNKNOWN}, {_slug('family')}, generation) AS base FROM nm),
  gr AS (SELECT *, base || CASE WHEN row_number() OVER o = 1 THEN '' ELSE '-' || row_number() OVER o END AS group_id FROM nb WINDOW o AS (PARTITION BY base ORDER BY b_sub, b_brand, b_bucket, row_id))"""
V = rf"""{G}, seg AS (
  SELECT b.*, gr.group_id,
    concat_ws('_', b.ram || 'gb', b.storage || 'gb', CASE WHEN b.color NOT IN ('', 'none') THEN b.color END) AS c1,
    regexp_replace(printf('%.1f', CAST(round(b.screen + 1e-8, 1) AS DOUBLE)), '\.0$', '') AS c2, concat_ws('_', b.cpu, b.gpu) AS c3,
    concat_ws('_', b.cond, CASE WHEN b.bundle THEN 'bundle' END) AS c4 FROM b JOIN comp USING (row_id) JOIN gr USING (component)
), v AS (
  SELECT *, group_id || '/' || coalesce(nullif(concat_ws('/', 'config:' || nullif(c1, ''), 'size:' || c2, 'silicon:' || nullif(c3, ''), 'packaging:' || nullif(c4, '')), ''), 'config:unk') AS variant_id FROM seg
)"""
_ml = _squeeze("concat_ws(' ', nullif(name, ''), nullif(coalesce(nullif(d_brand, ''), brand), ''), nullif(d_color, ''), 'X', nullif(s_ram, ''), nullif(s_screen, ''), nullif(s_color, ''), nullif(s_cond, ''))")
M = f"{E}, m AS (SELECT *, trim({_ml}) AS ml_text FROM e)"
_WEIRD = r"""regexp_matches({t}, '[^\w\s\-+.:,/#()''"]')"""
_pick = lambda values, n: "[" + ", ".join(f"'{x}'" for x in values) + f"][row_id % {n} + 1]"

_cos = lambda k, p: f"""{p}l AS (SELECT v.{k}, v.row_id, term, weight FROM v JOIN mw ON mw.row = v.row_id), {p}s AS (SELECT {k}, term, sum(weight) AS c FROM {p}l GROUP BY 1, 2),
  {p}n AS (SELECT {k}, sqrt(sum(c * c)) AS n FROM {p}s GROUP BY 1), {p}c AS (SELECT row_id, least(greatest(sum(weight * c / n), 0), 1) AS {p} FROM {p}l JOIN {p}s USING ({k}, term) JOIN {p}n USING ({k}) GROUP BY 1)"""  # noqa: E731
_mode = lambda x, step, p: f"""{p}q AS (SELECT variant_id, round_even({x} / {step}, 0) AS q, count(*) AS c FROM v WHERE {x} IS NOT NULL GROUP BY 1, 2), {p}m AS (SELECT variant_id, max(c) / sum(c) AS {p} FROM {p}q GROUP BY 1)"""
F_ = rf"""{V}, ml AS (SELECT row_id AS row, trim({_ml}) AS text FROM e), {_tfidf("SELECT * FROM ml", "m")}, {_cos('variant_id', 'vs')}, {_cos('group_id', 'gs')},
  {_mode('ram', '8.0', 'mr')}, {_mode('storage', '128.0', 'ms')}, {_mode('screen', '0.5', 'mi')}, sized AS (
  SELECT v.*, coalesce(vs, 0) AS vs, coalesce(gs, 0) AS gs, (coalesce(mr, 0) + coalesce(ms, 0) + coalesce(mi, 0)) / 3 AS ac,
    count(*) OVER (PARTITION BY variant_id) AS vn, count(*) OVER (PARTITION BY group_id) AS gn
  FROM v LEFT JOIN vsc USING (row_id) LEFT JOIN gsc USING (row_id) LEFT JOIN mrm USING (variant_id) LEFT JOIN msm USING (variant_id) LEFT JOIN mim USING (variant_id)
), f AS (
  SELECT *,
    (CAST(ram IS NOT NULL AS INT) + CAST(storage IS NOT NULL AS INT) + CAST(color IS NOT NULL AS INT) + CAST(screen IS NOT NULL AS INT) + CAST(cpu IS NOT NULL AS INT)) / 5 AS ap,
    1 - 2 / (exp(2 * least(vn, 3000) / 5) + 1) AS vz, 1 - 2 / (exp(2 * least(gn, 3000) / 10) + 1) AS gz,
    CASE WHEN screen IS NOT NULL AND NOT {_valid('screen')} THEN 1.0 ELSE 0.0 END AS inv FROM sized
), s AS (
  SELECT *, round(1 / (1 + exp(-4 * (0.45 * vs + 0.20 * gs + 0.15 * ap + 0.10 * ac + 0.06 * vz + 0.04 * gz - 0.10 * inv - 0.5))), 4) AS confidence FROM f
)"""
_EVIDENCE = """concat_ws(',', CASE WHEN vs >= 0.85 THEN 'variant_text_strong' WHEN vs >= 0.7 THEN 'variant_text_good' ELSE 'variant_text_weak' END,
      CASE WHEN gs >= 0.8 THEN 'group_text_strong' WHEN gs >= 0.65 THEN 'group_text_good' END, CASE WHEN ap >= 0.8 THEN 'axes_complete' WHEN ap >= 0.4 THEN 'axes_partial' ELSE 'axes_sparse' END,
      CASE WHEN ac >= 0.9 THEN 'variant_axes_consistent' WHEN ac >= 0.7 THEN 'variant_axes_mostly_consistent' END, CASE WHEN vz >= 0.7 THEN 'variant_popular' END,
      CASE WHEN gz >= 0.7 THEN 'group_popular' END, CASE WHEN inv > 0.5 THEN 'screen_out_of_range' END)"""
D = rf"""{F_}, fl AS (
  SELECT *, CAST(coalesce(brand, '') = '' AS INT) AS missing_brand, CAST(ram IS NULL AND storage IS NULL AS INT) AS missing_axes_config,
    CAST(screen IS NULL AS INT) AS missing_screen, CAST({_WEIRD.format(t='name')} AS INT) AS weird_title_chars,
    CAST(coalesce(ram < 2 OR ram > 128, false) AS INT) AS implausible_ram, CAST(coalesce(storage < 16 OR storage > 8192, false) AS INT) AS implausible_storage,
    CAST(NOT {_valid('screen')} AS INT) AS screen_out_of_range, CASE WHEN row_id % 3 > 0 THEN confidence ELSE 0.0 END AS known FROM s
), dq AS (
  SELECT * EXCLUDE (confidence, known), known AS confidence, CAST(greatest(0.0, least(100.0, 100 - 15 * missing_brand - 10 * missing_axes_config - 5 * missing_screen - 5 * weird_title_chars - 20 * implausible_ram
    - 20 * implausible_storage - 10 * screen_out_of_range - CASE WHEN known < 0.5 THEN 10 WHEN known < 0.7 THEN 5 ELSE 0 END)) AS DOUBLE) AS dq_score FROM fl
)"""
_DQ_COLUMNS = ("dq_score", "confidence", "missing_brand", "missing_axes_config", "missing_screen", "weird_title_chars", "implausible_ram", "implausible_storage", "screen_out_of_range")
_cohort = lambda k: f"{D} SELECT {k}, " + ", ".join(f"round(avg({c}) + 1e-9, 6) AS {c}" for c in _DQ_COLUMNS) + f" FROM dq GROUP BY {k}"

_UNIT = """u AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS u FROM embeddings)"""
_LINKS = f"""{_UNIT}, links AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_inner_product(a.u, b.u) AS sim FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE list_inner_product(a.u, b.u) >= 0.30 - 1e-12)"""
_COMP = f"""WITH RECURSIVE {_LINKS}, e AS (SELECT src AS i, dst AS j FROM links UNION ALL SELECT dst, src FROM links),
  reach AS (SELECT vec_id AS i, vec_id AS j FROM embeddings UNION SELECT r.i, e.j FROM reach r JOIN e ON r.j = e.i),
  comp AS (SELECT i AS vec_id, min(j) AS component FROM reach GROUP BY i)"""
_DIMS = "long AS (SELECT vec_id, label, unnest(range(0, len(u))) AS dim, unnest(u) AS x FROM u)"
_CENT = f"""{_UNIT}, {_DIMS}, mean AS (SELECT label, dim, avg(x) AS v FROM long GROUP BY 1, 2),
  cent AS (SELECT label, dim, v / sqrt(sum(v * v) OVER (PARTITION BY label)) AS v FROM mean),
  cos AS (SELECT vec_id, long.label, sum(x * v) AS c FROM long JOIN cent USING (label, dim) GROUP BY 1, 2)"""


_LEX = "['soundbar','subwoofer','mount','wall mount','hdmi cable','cable','dock','bag','backpack','sleeve','case','cover','mouse','keyboard','stylus','headset','earbuds','headphones','webcam','mic','microphone','micro sd','sd card','memory card','usb drive','flash drive','adapter','charger','power adapter','pen','stand']"
_PROBE_LEX = "['bag','backpack','sleeve','case','cover','mouse','mousepad','mouse pad','keyboard','combo','dock','docking','hub','stand','mount','stylus','pen','charger','adapter','power adapter','ac adapter','charger cable','cable','hdmi','usb','displayport','vga','headset','headphones','earbuds','earphones','mic','microphone','webcam','camera','tripod','sd card','micro sd','memory card','flash drive','usb drive','cleaning kit','cloth','screen protector','soundbar','subwoofer','speakers','remote','antenna','controller','gamepad']"
B = rf"""{M}, d0 AS (
  SELECT *, {_pack('ml_text')} AS pack_qty, list_filter({_LEX}, lambda a: contains(lower(ml_text), a)) AS acc,
    regexp_matches(lower(ml_text), '\b(bundle|kit|combo)\b') AS word, contains(lower(ml_text), ' with ') OR contains(lower(ml_text), ' + ') OR contains(lower(ml_text), ' includes ') AS joined FROM m
), d1 AS (SELECT *, greatest(0.5, CASE WHEN word THEN 0.9 ELSE 0 END, CASE WHEN joined THEN 0.7 ELSE 0 END, CASE WHEN pack_qty IS NOT NULL THEN 0.85 ELSE 0 END) AS p FROM d0
), d AS (SELECT *, CASE WHEN pack_qty >= 2 THEN 'multi_pack' WHEN p >= 0.6 AND len(acc) >= 1 THEN 'accessory_bundle' ELSE 'standalone' END AS kind FROM d1)"""
R = rf"""{E}, t AS (
  SELECT *, trim({_squeeze("lower(trim(" + _squeeze('name') + ") || ' ' || trim(" + _squeeze('brief_description') + "))")}) AS t FROM e
), h AS (
  SELECT *, list_filter([CASE WHEN contains(t, '&') THEN '&' END, CASE WHEN regexp_matches(t, '\w\s*\+\s*\w') THEN '+' END, CASE WHEN regexp_matches(t, '\bcombo\b') THEN 'combo' END,
      CASE WHEN regexp_matches(t, '\bincludes?\b') THEN 'includes?' END, CASE WHEN regexp_matches(t, '\bkit\b') THEN 'kit' END, CASE WHEN regexp_matches(t, '\bpackage\b') THEN 'package' END,
      CASE WHEN regexp_matches(t, '\bset\b') THEN 'set' END, CASE WHEN regexp_matches(t, '\bbundle\b') THEN 'undle' END, CASE WHEN regexp_matches(t, '\bw/\b') THEN 'w\/' END,
      CASE WHEN regexp_matches(t, '\bwith\b') THEN 'with' END], lambda x: x IS NOT NULL) AS trig,
    list_sort(list_filter({_PROBE_LEX}, lambda a: contains(' ' || regexp_replace(t, '[^a-z0-9_]', ' ', 'g') || ' ', ' ' || a || ' '))) AS acc,
    len(regexp_extract_all(t, '\b(\d+)[-\s]?(?:pack|pk)\b')) + len(regexp_extract_all(t, '\bset\s+of\s+(\d+)\b')) + len(regexp_extract_all(t, '\bx\s?(\d+)\b')) AS packs FROM t
), pr AS (SELECT *, CAST(2.0 * len(trig) + least(len(acc), 6) + 2.0 * packs AS DOUBLE) AS bundle_score FROM h)"""

_mode_of = lambda x, p: f"{p}0 AS (SELECT group_id, {x} AS x, count(*) AS n FROM v WHERE {x} IS NOT NULL AND CAST({x} AS VARCHAR) NOT IN ('', 'none') GROUP BY 1, 2), {p} AS (SELECT group_id, arg_min(x, (-n, CAST(x AS VARCHAR))) AS {p} FROM {p}0 GROUP BY 1)"
_PANEL = """CASE WHEN contains(lower(name), 'oled') THEN 'oled' WHEN contains(lower(name), 'ips') THEN 'ips_lcd' WHEN contains(lower(name), 'va') THEN 'va_lcd' WHEN contains(lower(name), 'lcd') THEN 'lcd' WHEN contains(lower(name), 'led') THEN 'led' END"""
_BASE = f"""{_mode_of(_readable('cpu'), 'm_cpu')}, {_mode_of('round_even(screen, 1)', 'm_inch')}, {_mode_of(_PANEL, 'm_panel')}, {_mode_of('sub_category', 'm_sub')},
  base AS (SELECT group_id, CASE WHEN lower(m_sub) = 'laptop' THEN 'laptop' END AS form_factor, CASE WHEN lower(m_sub) = 'tv' THEN m_panel END AS display_type, CAST(m_inch AS DOUBLE) AS screen_size_inches, m_cpu AS processor_family
    FROM (SELECT DISTINCT group_id FROM v) LEFT JOIN m_cpu USING (group_id) LEFT JOIN m_inch USING (group_id) LEFT JOIN m_panel USING (group_id) LEFT JOIN m_sub USING (group_id))"""
_letters = "regexp_replace(k, '[^A-Za-z]', '', 'g')"
_titled = "array_to_string(list_transform(range(1, len(k) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches(substr(k, i - 1, 1), '[A-Za-z]') THEN lower(substr(k, i, 1)) ELSE upper(substr(k, i, 1)) END), '')"
_smart = f"""CASE WHEN upper(k) IN ({", ".join(f"'{a}'" for a in sorted(ACRONYMS))}) THEN upper(k) WHEN {_letters} = '' OR ({_letters} <> upper({_letters}) AND {_letters} <> lower({_letters})) THEN k
      WHEN len({_letters}) <= 3 AND {_letters} = k THEN upper(k) ELSE {_titled} END"""
_html = "html"
for _a, _b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _html = f"replace({_html}, '{_a}', '{_b}')"
_single = "translate(text, '–—−’“”`', '---''\"\"''')"
for _c in "!?.,;:":
    _single = f"regexp_replace({_single}, '[{_c}]{{2,}}', '{_c}', 'g')"

ORACLE_SQL: dict[str, str] = {
    "scan_csv": f"{E} SELECT product_id, name, nullif(details, '') AS details FROM e",
    "scan_projected": f"{E} SELECT product_id, try_cast(seller_id AS INTEGER) AS seller_id FROM e",
    "spec_all": f"{E} SELECT product_id, coalesce(s_color, '') AS colors, s_color IS NOT NULL AS has_color FROM e",
    "axes_region": f"{E} SELECT product_id, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS VARCHAR) AS carrier FROM e",
    "export_assignments": f"{V} SELECT product_id, group_id, variant_id FROM v",
    "probe_multipack": rf"""{R}, m AS (SELECT product_id, list_concat(list_concat(list_transform(regexp_extract_all(t, '\b(\d+)[-\s]?(?:pack|pk)\b', 1), lambda n: '\b(\d+)[-\s]?(?:pack|pk)\b:' || n),
      list_transform(regexp_extract_all(t, '\bset\s+of\s+(\d+)\b', 1), lambda n: '\bset\s+of\s+(\d+)\b:' || n)), list_transform(regexp_extract_all(t, '\bx\s?(\d+)\b', 1), lambda n: '\bx\s?(\d+)\b:' || n)) AS x FROM t)
      SELECT product_id, array_to_string(x, ', ') AS evidence_multipack FROM m""",
    "probe_extra_terms": f"{R}, x AS (SELECT unnest(['widget', 'gizmo']) AS term) SELECT term, count(*) AS count FROM x JOIN t ON contains(' ' || regexp_replace(t, '[^a-z0-9_]', ' ', 'g') || ' ', ' ' || term || ' ') GROUP BY 1",
    "union_sources": f"{E} SELECT product_id, name, CASE WHEN row_id % 2 = 1 THEN brand END AS brand FROM e",
    "sample_n": f"{E} SELECT product_id, name FROM e ORDER BY md5('42:' || product_id), product_id LIMIT 100",
    "schema_backfill": f"{E} SELECT product_id, '' AS category, '' AS model, brand FROM e",
    "json_parse_stats": f"{E} SELECT count(*) AS n_rows, count(*) FILTER (trim(details) <> '') AS n_details, count(*) FILTER (trim(details) <> '' AND NOT json_valid(details)) AS n_errors FROM e",
    "text_nfkc": "SELECT doc_id, md5(nfc_normalize(text || ' fi A1 2 e' || chr(769))) AS text_md5 FROM documents",
    "text_strip_ctrl": r"SELECT page_id, md5(regexp_replace(regexp_replace(html, '[\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{00AD}]', '', 'g'), '[\x{0000}-\x{001F}\x{007F}-\x{009F}]', ' ', 'g')) AS text_md5 FROM pages",
    "text_dehtml": f"SELECT page_id, md5(regexp_replace({_html}, '<[^>]+>', ' ', 'g')) AS text_md5 FROM pages",
    "text_punct": f"SELECT doc_id, md5(replace({_single}, chr(92), ' ')) AS text_md5 FROM documents",
    "text_squeeze": r"SELECT doc_id, md5(trim(regexp_replace(text, '[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'), ' -_/|')) AS text_md5 FROM documents",
    "smart_case": rf"""{E}, p AS (SELECT product_id, trim({_squeeze('name')}) AS s, regexp_replace(name, '[^A-Za-z]', '', 'g') AS l FROM e)
      SELECT product_id, trim(CASE WHEN len(l) > 0 AND (len(regexp_replace(l, '[^A-Z]', '', 'g')) > 0.8 * len(l) OR len(regexp_replace(l, '[^a-z]', '', 'g')) > 0.8 * len(l))
        THEN array_to_string(list_transform(string_split(s, ' '), lambda k: {_smart}), ' ') ELSE s END, ' -_/|') AS title FROM p""",
    "model_code": f"{E} SELECT product_id, CASE WHEN row_id % 5 < 2 THEN NULL ELSE 'A X' END AS model_code FROM e",
    "ml_text": f"{M} SELECT product_id, ml_text FROM m",
    "canonical_title": f"{E} SELECT product_id, {_title('name')} AS title FROM e",
    "slugify": f"SELECT doc_id, {_slug('text')} AS slug FROM documents",
    "normalize_brand": f"{E} SELECT product_id, {_brand('brand')} AS brand_norm FROM e",
    "normalize_color": f"{E} SELECT product_id, {_color('d_color')} AS color FROM e",
    "probe_clean": f"{E} SELECT product_id, lower(trim({_squeeze('name' + " || ' new ' || " + 'brief_description')})) AS text FROM e",
    "model_text": f"{M} SELECT product_id, trim({_squeeze("concat_ws(' ', ml_text, name, nullif(brand, ''), nullif(s_ram, ''), nullif(s_screen, ''), nullif(s_color, ''), nullif(s_cond, ''))")}) AS text FROM m",
    "parse_storage": f"{E} SELECT product_id, {_storage('name')} AS storage_gb FROM e",
    "parse_ram": f"{E} SELECT product_id, {_ram('name')} AS ram_gb FROM e",
    "parse_screen": f"{E} SELECT product_id, {_screen('name')} AS screen_inches FROM e",
    "screen_valid": f"{E} SELECT product_id, {_valid(_screen('name'))} AS valid FROM e",
    "normalize_cpu": f"{E} SELECT product_id, {_cpu('name')} AS cpu FROM e",
    "normalize_gpu": f"{E} SELECT product_id, {_gpu("name || ' ' || " + _pick(('Iris Xe', 'RTX 4050', 'GTX 960', 'Radeon 680M', 'Radeon', '10core Apple', 'none'), 7))} AS gpu FROM e",
    "normalize_resolution": f"{E} SELECT product_id, {_pick(('8k', '4k', '1440p', '1080p', '720p', '4k', '1440p', '1080p'), 9)} AS resolution FROM e",
    "normalize_refresh": f"{E} SELECT product_id, [120, 60, 75, NULL, NULL][row_id % 5 + 1] AS refresh_hz FROM e",
    "panel_type": f"{E} SELECT product_id, {_pick(('qd_oled', 'oled', 'mini_led', 'micro_led', 'qled', 'ips_lcd', 'va_lcd', 'lcd', 'led'), 10)} AS panel FROM e",
    "condition": f"{E} SELECT product_id, {_condition("name || ' ' || brief_description")} AS item_condition FROM e",
    "half_inch": f"{E} SELECT product_id, CAST(round_even(({_screen('name')} + row_id % 4 / 4) * 2, 0) / 2 AS DOUBLE) AS half FROM e",
    "extract_year": rf"{E} SELECT product_id, nullif(regexp_extract(name, '\b(20[1-3]\d)\b', 1), '') AS year FROM e",
    "size_bucket": f"{E} SELECT product_id, {_bucket('sub_category', _screen('name'))} AS bucket FROM e",
    "pack_qty": f"{E} SELECT product_id, {_pack('name')} AS pack FROM e",
    "cpu_readable": f"{A} SELECT product_id, {_readable('cpu')} AS cpu FROM a",
    "weird_chars": f"{E} SELECT product_id, {_WEIRD.format(t='name')} OR row_id % 3 = 0 AS weird FROM e",
    "storage_anomalies": rf"""{E}, n AS (SELECT product_id, name || CASE WHEN row_id % 17 = 0 THEN ' 20 TB 9000GB 5 MB' ELSE '' END AS name FROM e),
      m AS (SELECT product_id, name, unnest(regexp_extract_all(name, '(\d+\.?\d*)\s*(TB|GB|MB)', 1, 'i')) AS v, unnest(regexp_extract_all(name, '(\d+\.?\d*)\s*(TB|GB|MB)', 2, 'i')) AS u FROM n)
      SELECT product_id, 'Suspicious storage: ''' || v || ' ' || u || ''' in title: ''' || substr(name, 1, 100) || '...''' AS message FROM m
      WHERE (upper(u) = 'TB' AND CAST(v AS DOUBLE) > 10) OR (upper(u) = 'GB' AND CAST(v AS DOUBLE) > 8192)""",
    "screen_anomalies": rf"""{E}, m AS (SELECT product_id, name, unnest(regexp_extract_all(name, '(\d+\.?\d*)\s*(?:inch|")', 1, 'i')) AS v FROM e)
      SELECT product_id, 'Unusual screen size: ''' || v || '"'' in title: ''' || substr(name, 1, 100) || '...''' AS message FROM m WHERE NOT CAST(v AS DOUBLE) BETWEEN 10 AND 100""",
    "json_safe": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "specs_map": f"{E} SELECT product_id, s_ram AS ram, s_screen AS screen, CASE WHEN json_valid(details) THEN 4 ELSE 0 END AS n FROM e",
    "canonical_specs": f"{E} SELECT product_id, unnest(['ram_gb', 'screen_inches', 'color', 'condition']) AS canonical, unnest([s_ram, s_screen, s_color, s_cond]) AS value FROM e WHERE json_valid(details)",
    "spec_first": f"{E} SELECT product_id, nullif(s_ram, '') AS ram_gb, nullif(s_screen, '') AS screen_inches, nullif(s_color, '') AS color, nullif(s_cond, '') AS condition FROM e",
    "accessories_text": f"{E} SELECT product_id, array_to_string(list_filter({_LEX}, lambda a: contains(lower(name), a)), ',') AS accessories FROM e",
    "array_dedupe": f"""{E}, w AS (SELECT product_id, string_split(name || ' ' || name, ' ') AS w FROM e)
      SELECT product_id, array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ') AS words FROM w""",
    "json_key_counts": f"{E}, k AS (SELECT unnest(json_keys(details, '$.specifications')) AS spec_key FROM e WHERE json_valid(details)) SELECT spec_key, count(*) AS n FROM k GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100",
    "weak_labels": f"{A} SELECT product_id, ram AS ram_gb, storage AS storage_gb, screen AS screen_inches, color, cpu FROM a",
    "label_index": f"{A} SELECT label, CAST(row_number() OVER (ORDER BY length(label), label) - 1 AS INTEGER) AS index FROM (SELECT DISTINCT cpu AS label FROM a WHERE cpu IS NOT NULL)",
    "axes_config": f"{A} SELECT product_id, ram AS ram_gb, storage AS storage_gb, color FROM a",
    "axes_size": f"{A} SELECT product_id, screen AS screen_inches FROM a",
    "axes_silicon": f"{A} SELECT product_id, cpu, gpu FROM a",
    "axes_packaging": f"{A} SELECT product_id, bundle, cond AS condition FROM a",
    "tfidf_weights": f"WITH {_tfidf('SELECT doc_id AS row, text FROM documents')} SELECT row AS doc_id, term, round(weight, 4) AS weight FROM w",
    "tfidf_top_terms": f"WITH {_tfidf("SELECT conv_id || '-' || turn AS row, text FROM conversations")} SELECT term, round(sum(weight), 4) AS total FROM w GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50",
    "cosine_pairs": f"WITH {_CENT} SELECT vec_id, label, round(c, 6) AS cosine FROM cos",
    "centroids": f"WITH {_CENT} SELECT label, CAST(dim AS INTEGER) AS dim, round(v, 6) AS v FROM cent",
    "class_weights": f"{A}, c AS (SELECT ram AS label, count(*) AS n FROM a WHERE ram IS NOT NULL GROUP BY 1) SELECT label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c",
    "block_sizes": f"{A} SELECT b_sub, b_brand, b_bucket, count(*) AS n FROM b GROUP BY 1, 2, 3",
    "similarity_join": f"WITH {_LINKS} SELECT src, dst, round(sim, 6) AS sim FROM links",
    "components": f"{_COMP} SELECT vec_id, component FROM comp",
    "medoids": f"""{_COMP}, {_DIMS}, cl AS (SELECT component, vec_id, dim, x FROM long JOIN comp USING (vec_id)), cs AS (SELECT component, dim, sum(x) AS c FROM cl GROUP BY 1, 2),
      cn AS (SELECT component, sqrt(sum(c * c)) AS n FROM cs GROUP BY 1), sims AS (SELECT component, vec_id, round(sum(x * c / n), 9) AS s FROM cl JOIN cs USING (component, dim) JOIN cn USING (component) GROUP BY 1, 2)
      SELECT component, vec_id AS medoid FROM sims QUALIFY row_number() OVER (PARTITION BY component ORDER BY s DESC, vec_id) = 1""",
    "family_phrase": f"{A} SELECT product_id, {_family('name', "nullif(b_brand, '_unknown')")} AS family FROM a",
    "group_ids": rf"""{A}, g AS (SELECT *, concat_ws('_', CASE b_brand WHEN '_unknown' THEN 'unknown' ELSE b_brand END, {_slug(_family('name', "CASE b_brand WHEN '_unknown' THEN 'unknown' ELSE b_brand END"))},
      nullif(regexp_extract(name, '\b(20[1-3]\d)\b', 1), '')) AS base FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY b_sub, b_brand, b_bucket, row_id) AS use FROM g)
      SELECT product_id, base || CASE WHEN use = 1 THEN '' ELSE '-' || use END AS group_id FROM r""",
    "variant_ids": f"{V} SELECT product_id, variant_id FROM v",
    "variant_snapshot": f"{V} SELECT variant_id, arg_min(ram, row_id) AS ram_gb, arg_min(screen, row_id) AS screen_inches, CASE WHEN bool_or(bundle) THEN true END AS bundle FROM v GROUP BY 1",
    "variant_counts": f"{V} SELECT variant_id, count(*) AS product_count FROM v GROUP BY 1",
    "assignments": f"{V} SELECT product_id, group_id, variant_id FROM v",
    "variant_records": f"""{V} SELECT variant_id, group_id, count(*) AS product_count, '{{' || concat_ws(',', '"ram_gb":' || any_value(ram), '"storage_gb":' || any_value(storage), '"color":"' || any_value(color) || '"') || '}}' AS config
      FROM v GROUP BY 1, 2""",
    "numeric_consistency": f"""{V}, q AS (SELECT group_id, round_even(ram / 8, 0) * 8 AS q FROM v WHERE ram IS NOT NULL), c AS (SELECT group_id, q, count(*) AS c FROM q GROUP BY 1, 2)
      SELECT group_id, round(max(c.c) / sum(c.c), 6) AS mode_frac, round((SELECT stddev_pop(q.q) FROM q WHERE q.group_id = c.group_id), 6) AS std, CAST(sum(c.c) AS BIGINT) AS n FROM c GROUP BY 1""",
    "cohesion": f"WITH {_CENT} SELECT vec_id AS row_id, round(least(greatest(c, 0), 1), 6) AS sim FROM cos",
    "axes_presence": f"{F_} SELECT product_id, CAST(ap AS DOUBLE) AS axes_presence FROM f",
    "confidence": f"{F_} SELECT product_id, confidence FROM s",
    "evidence": f"{F_} SELECT product_id, {_EVIDENCE} AS evidence FROM f",
    "scored_assignments": f"""{F_} SELECT product_id, group_id, variant_id, confidence, {_EVIDENCE} AS evidence, round(vs, 6) AS variant_sim, round(gs, 6) AS group_sim, round(CAST(ap AS DOUBLE), 6) AS axes_presence,
      round(CAST(ac AS DOUBLE), 6) AS axes_consistency, round(vz, 6) AS variant_size_norm, round(gz, 6) AS group_size_norm, CAST(inv AS DOUBLE) AS screen_invalid_flag FROM s""",
    "grouped_products": f"{G} SELECT b.product_id, gr.group_id FROM b JOIN comp USING (row_id) JOIN gr USING (component)",
    "group_records": f"{G} SELECT group_id, g_brand AS brand, family, generation FROM gr",
    "bundle_weak_label": rf"""{M} SELECT product_id, CASE WHEN regexp_matches(lower(ml_text), '\b(bundle|kit|combo)\b') THEN 1
      WHEN regexp_matches(lower(ml_text), '\bwith\b') AND regexp_matches(lower(ml_text), '\b(mouse|bag|soundbar|case|keyboard|micro sd|sd card|dock|mount)\b') THEN 1
      WHEN regexp_matches(lower(ml_text), '\b(laptop|tv)\s+only\b') THEN 0 END AS label FROM m""",
    "main_product": f"{E} SELECT product_id, lower(sub_category) AS main_product FROM e",
    "bundle_detect": f"""{B} SELECT product_id, kind <> 'standalone' AS is_bundle, kind AS bundle_type, CAST(p AS DOUBLE) AS bundle_confidence, lower(sub_category) AS main_product,
      array_to_string(acc, ',') AS accessories, pack_qty, concat_ws(',', CASE WHEN word THEN 'word:bundle/kit/combo' END, CASE WHEN joined THEN 'with/plus/includes' END, 'pack:' || pack_qty,
      CASE WHEN len(acc) > 0 THEN 'acc:' || len(acc) END, CASE WHEN p >= 0.8 THEN 'model:strong' WHEN p >= 0.6 THEN 'model:weak' END) AS bundle_evidence FROM d""",
    "apply_bundle": B + A[len(E):].replace("FROM e\n", "FROM e\n", 1) + " SELECT b.product_id, b.bundle OR d.kind <> 'standalone' AS bundle FROM b JOIN d ON d.product_id = b.product_id",
    "bundle_probe_score": f"{R} SELECT product_id, bundle_score, array_to_string(trig, ', ') AS evidence_triggers, array_to_string(acc, ', ') AS evidence_accessories, false AS evidence_spec_hint FROM pr",
    "bundle_candidates": f"{R} SELECT product_id, bundle_score FROM pr ORDER BY bundle_score DESC, product_id LIMIT 50",
    "non_bundle_sample": f"""{R}, o AS (SELECT product_id, bundle_score, row_number() OVER (ORDER BY bundle_score DESC, product_id) - 1 AS r FROM pr)
      SELECT product_id, bundle_score FROM o WHERE r >= (SELECT CAST(floor(0.6 * count(*)) AS BIGINT) FROM pr) ORDER BY md5('42:' || product_id), product_id LIMIT 50""",
    "accessory_term_counts": f"{R}, x AS (SELECT unnest(acc) AS term FROM pr) SELECT term, count(*) AS count FROM x GROUP BY 1",
    "product_groups": f"""{V}, {_BASE}, counts AS (SELECT group_id, count(DISTINCT product_id) AS product_count, count(DISTINCT variant_id) AS variant_count FROM v GROUP BY 1)
      SELECT group_id, g_brand AS brand, family, generation, form_factor, display_type, screen_size_inches, processor_family, product_count, variant_count FROM gr JOIN base USING (group_id) JOIN counts USING (group_id)""",
    "run_summary": f"""{F_} SELECT count(*) AS total_products, count(DISTINCT group_id) AS total_groups, count(DISTINCT variant_id) AS total_variants, count(DISTINCT product_id) AS products_assigned,
      count(*) - count(DISTINCT product_id) AS products_unassigned, round(avg(confidence), 4) AS average_confidence, CAST(0.82 AS DOUBLE) AS group_threshold FROM s""",
    "group_product_counts": f"{V} SELECT group_id, count(DISTINCT product_id) AS product_count FROM v GROUP BY 1",
    "group_variant_counts": f"{V} SELECT group_id, count(DISTINCT variant_id) AS variant_count FROM v GROUP BY 1",
    "safe_mode": f"{A}, c AS (SELECT sub_category, cpu, count(*) AS n FROM a WHERE cpu IS NOT NULL GROUP BY 1, 2) SELECT sub_category, arg_min(cpu, (-n, cpu)) AS mode FROM c GROUP BY 1",
    "base_specs": f"{V}, {_BASE} SELECT group_id, form_factor, display_type, screen_size_inches, processor_family FROM base",
    "brand_quality": _cohort("brand"),
    "seller_quality": _cohort("seller_id"),
    "value_counts": f"{E} SELECT sub_category AS value, count(*) AS n FROM e GROUP BY 1",
    "distinct_brands": f"{E} SELECT DISTINCT trim(lower(brand)) AS brand FROM e",
    "top_brands": f"{E} SELECT trim(lower(brand)) AS brand, count(*) AS n FROM e WHERE brand IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "anomalies": f"""{D} SELECT product_id, brand, seller_id, sub_category, dq_score, CAST(confidence AS DOUBLE) AS confidence, implausible_ram, implausible_storage, screen_out_of_range, missing_brand,
      missing_axes_config, missing_screen FROM dq WHERE implausible_ram = 1 OR implausible_storage = 1 OR screen_out_of_range = 1 OR dq_score < 60""",
    "dq_flags": f"{D} SELECT product_id, missing_brand, missing_axes_config, missing_screen, weird_title_chars, implausible_ram, implausible_storage, screen_out_of_range FROM dq",
    "dq_rows": f"{D} SELECT product_id, CAST(confidence AS DOUBLE) AS confidence, dq_score FROM dq",
    "guess_brand": f"""{E} SELECT product_id, list_filter(['apple','dell','hp','lenovo','asus','acer','microsoft','samsung','lg','sony','toshiba','msi','razer','google','hisense','tcl','vizio'],
      lambda b: contains(lower(name || [' by HP', ' LG and Dell', '', ' Vizio'][row_id % 4 + 1]), b))[1] AS guessed_brand FROM e""",
    "event_windows": "SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2",
}
