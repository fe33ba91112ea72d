"""Text cleaning as Column expressions; three Arrow functions for what Spark lacks."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# ---- Fixed values ----
ACRONYMS = (
    "TV OLED QLED IPS HDR UHD FHD HD MICRO QNED SSD HDD NVME USB HDMI CPU GPU RAM DDR GB TB MHZ GHZ "
    "M1 M2 M3 RTX GTX RX WI-FI WIFI 4K 8K 2K 1440P 1080P 720P"
).split()
BRAND_ALIASES = {
    "hewlett-packard": "hp",
    "hp inc.": "hp",
    "hp (refurbished)": "hp",
    "dell (refurbished)": "dell",
    "samsung®": "samsung",
    "lg electronics": "lg",
    "lgelectronics": "lg",
    "insignia™": "insignia",
    "amazon renewed": "amazon",
}
COLOR_ALIASES = {"space grey": "space_gray", "space gray": "space_gray", "midnight": "midnight_blue", "grey": "gray", "rose": "pink"}
ML_TEXT_SPECS = (
    "Processor Brand", "Processor Type", "Processor Model", "Processor Speed", "RAM Memory", "System Memory (RAM)",
    "Hard Drive Capacity", "Solid State Drive Capacity", "Screen Size", "Screen Resolution", "Display Technology", "Color", "Condition",
)
MODEL_TEXT_SPECS = (
    "Processor Brand", "Processor Type", "Processor Model", "RAM Memory", "Hard Drive Capacity", "Solid State Drive Capacity",
    "Screen Size", "Color", "Condition",
)
NAMED_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}
ZERO_WIDTH = r"[​-‍⁠﻿­]"
CONTROL = r"[\u0000-\u001F\u007F-\u009F]"
RIM = " -_/|"
#: What compatibility forms may change: text that is not ASCII, with the character before it, which a combining mark may join. An ASCII
#: character joins nothing before it, so the forms of such pieces are those of the whole text.
FOREIGN = r"[\x00-\x7F]?[^\x00-\x7F]+"


def or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def lookup(aliases: dict[str, str], c: Column) -> Column:
    """The alias of a value, or the value."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it, and in pushed-down predicates too."""
    return F.transform(F.array(c), f)[0]


@F.pandas_udf(ArrayType(StringType()))
def _nfkc_pieces(s: pd.Series) -> pd.Series:
    """Forms of the pieces of texts that :data:`FOREIGN` pieces and one ASCII character after each make up."""
    return s if s.isna().all() else s.map(lambda x: None if x is None else [unicodedata.normalize("NFKC", p) for p in re.findall(FOREIGN, x)])


def nfkc(c: Column) -> Column:
    """Compatibility forms; only the pieces that they may change are sent to Python."""
    foreign = F.octet_length(c) > F.length(c)
    # Joined by a character that no piece can hold but at its beginning, as Arrow's writer goes over all lists of a batch for each row.
    changed = _nfkc_pieces(F.when(foreign, F.array_join(F.regexp_extract_all(c, F.lit(FOREIGN), F.lit(0)), "\n")))
    whole = F.array_join(F.zip_with(F.split(c, FOREIGN, -1), changed, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(foreign, whole).otherwise(c)


@F.pandas_udf(StringType())
def unescape_all(s: pd.Series) -> pd.Series:
    """All HTML5 entities."""
    return s.map(lambda x: None if x is None else html.unescape(x))


@F.pandas_udf(StringType())
def smart_case(s: pd.Series) -> pd.Series:
    """Title case by token, but acronyms and short names upper and mixed case as it is."""

    def one(token: str) -> str:
        upper = token.upper()
        letters = [c for c in token if c.isalpha()]
        if upper in ACRONYMS:
            return upper
        cases = {c.isupper() for c in letters if c.isupper() or c.islower()}
        if not letters or len(cases) != 1 or any(not (c.isupper() or c.islower()) for c in letters):
            return token
        return upper if len(letters) <= 3 and token.isalpha() else token.title()

    return s.map(lambda x: None if x is None else " ".join(map(one, x.split(" "))))


def strip_ctrl(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, ZERO_WIDTH, ""), CONTROL, " ")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def dehtml(c: Column) -> Column:
    """Entities, then tags, so that encoded tags vanish too; the common named entities only."""
    return strip_tags(reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), NAMED_ENTITIES.items(), c))


def dehtml_full(c: Column) -> Column:
    return strip_tags(unescape_all(c))


def punct(c: Column) -> Column:
    """Plain dashes and quotes, single punctuation marks, no backslashes."""
    plain = F.translate(c, "–—−’“”`", "---'\"\"'")
    return F.translate(F.regexp_replace(plain, r"([!?.,;:])\1+", "$1"), "\\", " ")


def squeeze(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(RIM))


def prettify(c: Column) -> Column:
    """The loader's cleaning of a text field; a null is empty."""
    s = F.trim(F.regexp_replace(punct(dehtml_full(strip_ctrl(nfkc(or_empty(c))))), r"(?U)\s+", " "))
    count = lambda kind: F.length(F.regexp_replace(s, rf"[^\p{{{kind}}}]", ""))
    shouting = (count("L") > 0) & ((count("Lu") > 0.8 * count("L")) | (count("Ll") > 0.8 * count("L")))
    return squeeze(F.when(shouting, smart_case(s)).otherwise(s))


def canonical_title(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(or_empty(c)), '[^a-z0-9" ]+', " "), r"\s+", " "))


def _accents() -> tuple[str, str]:
    """Letters whose compatibility form begins with one ASCII letter, and that letter."""
    found = {}
    for i in range(0x80, 0x250):
        plain = unicodedata.normalize("NFKD", chr(i)).encode("ascii", "ignore").decode()
        if len(plain) == 1 and plain.isalpha():
            found[chr(i)] = plain
    return "".join(found), "".join(found.values())


def slugify(c: Column, most: int = 48) -> Column:
    """ASCII letters and digits joined by underscores, at most ``most`` characters, never empty."""
    plain = F.lower(F.regexp_replace(F.translate(c, *_accents()), r"[^\x00-\x7F]", ""))
    slug = F.btrim(F.regexp_replace(plain, "[^a-z0-9]+", "_"), F.lit("_"))
    cut = F.rtrim(F.substring(slug, 1, most), F.lit("_"))
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("product"))


def normalize_brand(c: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"^brand:\s*", ""), r"\s+\(refurbished\)$", "")
    return F.nullif(lookup(BRAND_ALIASES, s), F.lit(""))


def normalize_color(c: Column) -> Column:
    return F.nullif(F.replace(lookup(COLOR_ALIASES, F.lower(F.trim(c))), F.lit(" "), F.lit("_")), F.lit(""))


def model_code(c: Column) -> Column:
    s = F.trim(c)
    return F.when((s == "") | (F.lower(s) == "nan"), None).otherwise(F.regexp_replace(s, r"(?U)\s+", " "))


def probe_clean(c: Column, fold: bool = True) -> Column:
    """The bundle probe's cleaning: tags go, entities stay, lower case."""
    s = nfkc(or_empty(c)) if fold else or_empty(c)
    s = F.regexp_replace(F.replace(s, F.lit("\u0000"), F.lit(" ")), ZERO_WIDTH, "")
    for mark in ("\\n", "\\t", "\\r", "\\"):
        s = F.replace(s, F.lit(mark), F.lit(" "))
    return F.lower(F.trim(F.regexp_replace(strip_tags(s), r"(?U)\s+", " ")))


def join_texts(*parts: Column) -> Column:
    """Non-empty parts with one space between."""
    return F.trim(F.regexp_replace(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]), r"(?U)\s+", " "))


