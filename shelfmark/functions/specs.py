"""JSON details, specification lists and accessory lexicons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import or_empty

# ---- Fixed values: specification names of feeds, by canonical name ----
SYNONYMS = {
    "ram_gb": ("ram memory", "system memory (ram)", "system memory", "ram", "ram memory installed size", "ram installed size", "ram size"),
    "storage_gb": ("hard drive capacity", "solid state drive capacity", "hard disk size", "total storage capacity", "hard_drive_capacity", "solid_state_drive_capacity"),
    "screen_inches": ("screen size", "standing_screen_display_size", "display size", "product diagonal"),
    "cpu_brand": ("processor brand", "processor_brand", "chipset_brand"),
    "cpu_family": ("processor type", "processor"),
    "cpu_model": ("cpu model", "processor model", "processor model number", "processor_model"),
    "gpu_model": ("graphics", "gpu brand", "gpu brand:", "graphics type", "graphics card description", "graphics_coprocessor", "card_description"),
    "color": ("color",),
    "condition": ("condition",),
    "panel_type": ("display technology", "display type", "television type"),
    "refresh_hz": ("refresh rate",),
    "resolution": ("screen resolution", "resolution", "display resolution", "max_screen_resolution"),
}
ACCESSORIES = (
    "soundbar", "subwoofer", "mount", "wall mount", "hdmi cable", "cable", "dock", "bag", "backpack", "sleeve", "case", "cover", "mouse",
    "keyboard", "stylus", "headset", "earbuds", "headphones", "webcam", "mic", "microphone", "micro sd", "sd card", "memory card",
    "usb drive", "flash drive", "adapter", "charger", "power adapter", "pen", "stand",
)
VARIATION_ADDS = r"\b\+\s*\d* ?(micro sd|sd card|bag|mouse|case|keyboard|dock|mount)\b"
VARIATION_WORDS = (
    ("micro sd", ("micro sd", "sd card", "memory card")), ("bag", ("bag",)), ("mouse", ("mouse",)), ("case", ("case", "sleeve")),
    ("keyboard", ("keyboard",)), ("dock", ("dock",)), ("mount", ("mount",)),
)
# ---- end of fixed values ----

ENTRY = "array<struct<key:string,value:string>>"


def json_safe(c: Column) -> Column:
    """A JSON object as a map; anything else is an empty map."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.coalesce(F.from_json(F.nullif(F.trim(c), F.lit("")), "map<string,string>", {"mode": "PERMISSIVE"}), empty)


def json_retry(c: Column) -> Column:
    """As ``json_safe``, with another try without control characters."""
    one = F.from_json(F.nullif(F.trim(c), F.lit("")), "map<string,string>")
    two = F.from_json(F.nullif(F.trim(F.regexp_replace(c, r"[\x00-\x1F\x7F]", " ")), F.lit("")), "map<string,string>")
    return F.coalesce(one, two, F.from_json(F.lit("{}"), "map<string,string>"))


def spec_map(details: Column) -> Column:
    """The ``specifications`` object of a details map."""
    return json_safe(F.try_element_at(details, F.lit("specifications")))


def spec_entries(details: Column) -> Column:
    """Specifications in document order, keys lower-cased."""
    return F.transform(F.map_entries(spec_map(details)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))


def spec_all(entries: Column, canon: str) -> Column:
    """All values of a canonical name, in order."""
    names = F.array(*[F.lit(s) for s in SYNONYMS[canon]])
    return F.transform(F.filter(entries, lambda e: F.array_contains(names, e["key"])), lambda e: e["value"])


def spec_first(entries: Column, canon: str) -> Column:
    """The first value that is not empty."""
    some = F.filter(spec_all(entries, canon), lambda v: v.isNotNull() & ~v.isin("", "[]", "{}"))
    return F.try_element_at(some, F.lit(1))


def spec_has(entries: Column, canon: str) -> Column:
    return F.size(spec_all(entries, canon)) > 0


def spec_value(specs: Column, key: str) -> Column:
    """The value of an exact key."""
    return F.try_element_at(specs, F.lit(key))


def accessories_in(c: Column) -> Column:
    """Lexicon terms that the text contains, in lexicon order."""
    s = F.lower(c)
    return F.filter(F.array(*[F.lit(a) for a in ACCESSORIES]), lambda a: F.contains(s, a))


def accessories_listed(entries: Column) -> Column:
    """The ``accessories included`` value, split."""
    value = F.try_element_at(F.filter(entries, lambda e: e["key"] == "accessories included"), F.lit(-1))["value"]
    parts = F.transform(F.split(F.lower(or_empty(value)), r"[,|;/]+"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def variation_options(details: Column) -> Column:
    """All option texts of ``productVariations``, lower-cased."""
    schema = "array<struct<options:map<string,string>>>"
    variations = F.from_json(F.try_element_at(details, F.lit("productVariations")), schema)
    values = F.flatten(F.transform(variations, lambda v: F.coalesce(F.map_values(v["options"]), F.array().cast("array<string>"))))
    return F.coalesce(F.transform(values, lambda v: F.lower(v)), F.array().cast("array<string>"))


def accessories_varied(details: Column) -> Column:
    adds = F.filter(variation_options(details), lambda v: v.rlike(VARIATION_ADDS))

    def named(v: Column) -> Column:
        hits = [F.when(_any(v, words), F.lit(name)) for name, words in VARIATION_WORDS]
        return F.filter(F.array(*hits), lambda x: x.isNotNull())

    return F.array_distinct(F.flatten(F.transform(adds, named)))


def _any(v: Column, words: tuple[str, ...]) -> Column:
    out = F.contains(v, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(v, F.lit(w))
    return out
