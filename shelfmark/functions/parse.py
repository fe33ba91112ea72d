"""Value parsers: text to number or token, first match wins, no match is null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import bound

# ---- Fixed values: patterns ----
STORAGE = r"(?i)(\d+(?:\.\d+)?)\s*(tb|gb)\b"
RAM = (r"(?i)(\d+)\s*gb", r"(?i)ram[^0-9]{0,6}(\d+)")
SCREEN = r'(?i)(\d{2,3}|\d{1,2}\.\d)\s*(?:"|inch|in|-inch)\b'
CPU_APPLE = r"\b(m[123])\b(?:\s*(pro|max))?"
CPU_INTEL = (r"\bintel\s*core\s*i([3579])[- ]?(\d{4,5}[a-z]{0,2})?", r"\bi([3579])[- ]?(\d{4,5}[a-z]{0,2})\b")
CPU_RYZEN = r"\bryzen\s*([3579])\b(?:\s*(\d{4,5}[a-z]{0,2}))?"
RESOLUTION_WORDS = {
    "8k": r"\b(?:8k|4320p)\b",
    "4k": r"\b(?:4k|uhd|ultra\s*hd|2160p)\b",
    "1440p": r"\b(?:1440p|qhd|wqhd|uwqhd|ultrawide\s*qhd|2k)\b",
    "1080p": r"\b(?:1080p|fhd|full\s*hd)\b",
    "720p": r"\b(?:720p|hd\s*ready)\b",
}
GRID = r"(\d{3,5})\s*[x×]\s*(\d{3,5})"
REFRESH = (r"(\d{2,3})\s*hz\b", r"refresh[^0-9]{0,6}(\d{2,3})")
PANELS = (
    ("qd_oled", ("qd-oled", "qd oled", "qdoled")),
    ("oled", ("oled",)),
    ("mini_led", ("mini led", "mini-led", "miniled")),
    ("micro_led", ("micro led", "micro-led", "microled")),
    ("qled", ("qled",)),
    ("ips_lcd", ("ips",)),
    ("va_lcd", ("va",)),
    ("lcd", ("lcd",)),
    ("led", ("led",)),
)
CONDITIONS = (
    ("renewed", ("renew",)),
    ("refurbished", ("refurb", "remanufactur", "restored")),
    ("open_box", ("open box", "open-box")),
    ("used", ("used", "pre-owned", "preowned")),
)
PACKS = (r"\b(\d+)\s*pack\b", r"\b(\d+)\s*pk\b", r"\b(\d+)\s*-\s*pack\b", r"\bx\s*(\d+)\b", r"\b(\d+)\s*count\b")
GPU_RTX, GPU_GTX, GPU_RADEON = r"\brtx\s*(\d{4})\b", r"\bgtx\s*(\d{3,4})\b", r"\bradeon\s*([a-z0-9]+)\b"
#: Least and greatest of the shorter and of the longer side of a screen's grid; None is no bound.
GRIDS = {
    "8k": ((4300, None), (7600, None)), "4k": ((2100, None), (3800, None)), "1440p": ((1410, 1470), (2500, 3600)),
    "1080p": ((1070, 1090), (1910, 1940)), "720p": ((710, 730), (1270, 1295)),
}
# ---- end of fixed values ----


def group(c: Column, pattern: str, i: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))


def number(c: Column, pattern: str, kind: str = "int") -> Column:
    return F.regexp_extract(c, pattern, 1).try_cast(kind)  # of no match, an empty text, null


def any_of(c: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def first_true(pairs: list[tuple[str, Column]]) -> Column:
    out = F.when(pairs[0][1], F.lit(pairs[0][0]))
    for name, test in pairs[1:]:
        out = out.when(test, F.lit(name))
    return out


def parse_storage(c: Column) -> Column:
    unit = F.lower(F.regexp_extract(c, STORAGE, 2))
    return F.bround(number(c, STORAGE, "decimal(20,6)") * F.when(unit == "tb", 1024).otherwise(1), 0).try_cast("int")


def parse_ram(c: Column) -> Column:
    return F.coalesce(*[number(c, p) for p in RAM])


def parse_screen(c: Column) -> Column:
    return number(c, SCREEN, "double")


def screen_valid(sub: Column, inches: Column, title: Column) -> Column:
    s, t = F.lower(F.coalesce(sub, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    ok = (
        F.when(F.contains(t, F.lit("projector")) | F.contains(t, F.lit("laser tv")), inches.between(10, 150))
        .when(s == "laptop", inches.between(10, 18)).when(s == "tv", inches.between(18, 130)).otherwise(inches.between(10, 130))
    )
    return F.coalesce(ok, F.lit(False))


def normalize_cpu(c: Column) -> Column:
    return cpu_token(F.lower(c))


def cpu_token(s: Column) -> Column:
    """The CPU of a lower-case text; one search for each pattern that does not match."""
    first = lambda p: F.regexp_extract(s, p, 1)
    token = lambda p, lead: F.when(first(p) != "", F.concat(F.lit(lead), first(p), F.coalesce(F.concat(F.lit("_"), group(s, p, 2)), F.lit(""))))
    return F.coalesce(token(CPU_APPLE, "apple_"), *[token(p, "intel_i") for p in CPU_INTEL], token(CPU_RYZEN, "amd_ryzen"))


def normalize_gpu(c: Column) -> Column:
    return gpu_token(F.lower(c))


def gpu_token(s: Column) -> Column:
    """The GPU of a lower-case text."""
    first = lambda p: F.regexp_extract(s, p, 1)
    named = lambda p, lead: F.when(first(p) != "", F.concat(F.lit(lead), first(p)))
    radeon = F.when(F.contains(s, F.lit("radeon")), F.coalesce(named(GPU_RADEON, "amd_radeon_"), F.lit("amd_radeon")))
    return F.coalesce(
        F.when(F.contains(s, F.lit("iris xe")), F.lit("intel_iris_xe")), named(GPU_RTX, "nvidia_rtx_"),
        named(GPU_GTX, "nvidia_gtx_"), radeon,
        F.when(F.contains(s, F.lit("10core")) & F.contains(s, F.lit("apple")), F.lit("apple_10core")),
    )


def normalize_resolution(c: Column) -> Column:
    s = F.lower(c)
    w, h = group(s, GRID).try_cast("int"), group(s, GRID, 2).try_cast("int")
    within = lambda side, low, high: side >= low if high is None else side.between(low, high)
    grids = [(name, within(F.least(w, h), *short) & within(F.greatest(w, h), *long)) for name, (short, long) in GRIDS.items()]
    return first_true([*((k, s.rlike(p)) for k, p in RESOLUTION_WORDS.items()), *grids])


def normalize_refresh(c: Column) -> Column:
    found = [number(F.lower(c), p) for p in REFRESH]
    return F.coalesce(*[F.when(x.between(24, 300), x) for x in found])


def panel_type(c: Column) -> Column:
    s = F.lower(c)
    return first_true([(k, any_of(s, w) & ~F.contains(s, F.lit("lava")) if k == "va_lcd" else any_of(s, w)) for k, w in PANELS])


def condition(c: Column) -> Column:
    return condition_token(F.lower(c))


def condition_token(s: Column) -> Column:
    """The condition that a lower-case text names."""
    return first_true([("new", s.rlike(r"\bnew\b")), *((k, any_of(s, w)) for k, w in CONDITIONS)])


def half_inch(x: Column) -> Column:
    return F.bround(x * 2, 0) / 2


def extract_year(c: Column) -> Column:
    return group(c, r"\b(20[1-3]\d)\b")


def size_bucket(sub: Column, inches: Column) -> Column:
    five = (F.bround(inches / 5, 0) * 5).cast("int").cast("string")
    return F.when(inches.isNull(), "u").when(F.lower(F.coalesce(sub, F.lit(""))) == "laptop", F.format_string("%.1f", half_inch(inches))).otherwise(five)


def pack_qty(c: Column) -> Column:
    found = bound(F.lower(c), lambda s: F.filter(F.array(*[number(s, p) for p in PACKS]), lambda x: x.between(2, 50)))
    return F.try_element_at(found, F.lit(1))


def cpu_readable(c: Column) -> Column:
    """A label of a CPU token: its family, and for Ryzen a purely numeric model if there is one."""
    parts = F.split(c, "_")
    model = F.try_element_at(F.filter(parts, lambda p: p.rlike(r"^\d+$")), F.lit(1))
    family = F.nullif(F.regexp_replace(F.try_element_at(parts, F.lit(2)), r"\D", ""), F.lit(""))
    return (
        F.when(c.startswith("apple_m"), F.concat(F.lit("Apple "), F.upper(parts[1])))
        .when(c.startswith("intel_i"), F.concat(F.lit("Intel Core "), F.upper(parts[1])))
        .when(c.startswith("amd_ryzen"), F.concat(F.lit("AMD Ryzen"), F.coalesce(F.concat(F.lit(" "), F.coalesce(model, family)), F.lit(""))))
    )


def format_gb(x: Column) -> Column:
    return F.concat(x.cast("int").cast("string"), F.lit("gb"))


def format_inches(x: Column) -> Column:
    # format_string writes a null out, so it is kept from it.
    return F.when(x.isNotNull(), F.regexp_replace(F.format_string("%.1f", F.round(x + F.lit(1e-8), 1)), r"\.0$", ""))


def weird_chars(c: Column) -> Column:
    return F.coalesce(c.rlike(r"""(?U)[^\w\s\-+.:,/#()'"]"""), F.lit(False))


def implausible(x: Column, low: int, high: int) -> Column:
    return F.coalesce((x < low) | (x > high), F.lit(False))
