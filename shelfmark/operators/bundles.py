"""Bundle detection by rules and a weakly supervised model, and the bundle probe."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import parse as P
from shelfmark.functions import specs as S
from shelfmark.functions import text as T
from shelfmark.plans.numbering import number_rows
from shelfmark.plans.shared import shared_table

# ---- Fixed values ----
ADDED = r"\b(mouse|bag|soundbar|case|keyboard|micro sd|sd card|dock|mount)\b"
#: The names are reported as they are, cut letters included.
TRIGGERS = {
    "with": r"\bwith\b", "includes?": r"\bincludes?\b", "undle": r"\bbundle\b", "combo": r"\bcombo\b", "kit": r"\bkit\b",
    "package": r"\bpackage\b", "set": r"\bset\b", r"w\/": r"\bw\/\b", "+": r"\w\s*\+\s*\w", "&": r"\&",
}
MULTIPACKS = (r"\b(\d+)[-\s]?(?:pack|pk)\b", r"\bset\s+of\s+(\d+)\b", r"\bx\s?(\d+)\b")
#: Letters that every match of a trigger has where they are not its name, and those of which a multipack has some.
TRIGGER_LETTERS = {"includes?": "include", "undle": "bundle", r"w\/": "w/"}
PACK_LETTERS = dict(zip(MULTIPACKS, (("pack", "pk"), ("set",), ("x",)), strict=True))
PROBE_LEXICON = (
    "bag", "backpack", "sleeve", "case", "cover", "mouse", "mousepad", "mouse pad", "keyboard", "combo", "dock", "docking", "hub", "stand",
    "mount", "stylus", "pen", "charger", "adapter", "power adapter", "ac adapter", "charger cable", "cable", "hdmi", "usb", "displayport",
    "vga", "headset", "headphones", "earbuds", "earphones", "mic", "microphone", "webcam", "camera", "tripod", "sd card", "micro sd",
    "memory card", "flash drive", "usb drive", "cleaning kit", "cloth", "screen protector", "soundbar", "subwoofer", "speakers", "remote",
    "antenna", "controller", "gamepad",
)
WEAK_BUNDLE, WEAK_SINGLE, WEAK_UNIT = r"\b(bundle|kit|combo)\b", r"\b(laptop|tv)\s+only\b", "unit only"
JOINING = (" with ", " + ", " includes ")
TAG_WORD, TAG_JOINED, TAG_PACK, TAG_ACCESSORIES, TAG_STRONG, TAG_WEAK = "word:bundle/kit/combo", "with/plus/includes", "pack:", "acc:", "model:strong", "model:weak"
CONTENT_SPECS = ("accessories included", "package contents", "included", "in the box", "items included")
# ---- end of fixed values ----


def gather_text() -> Column:
    return F.coalesce(F.nullif(T.or_empty(F.col("ml_text")), F.lit("")), T.or_empty(F.col("name")))


def weak_label() -> Column:
    """1 for an evident bundle, 0 for an evident single product, else null."""
    t = F.lower(gather_text())
    listed = F.try_element_at(F.filter(F.col("spec_entries"), lambda e: e["key"] == "accessories included"), F.lit(-1))["value"]
    varied = F.exists(S.variation_options(F.col("details_map")), lambda v: v.rlike(S.VARIATION_ADDS))
    return (
        F.when(t.rlike(WEAK_BUNDLE), 1)
        .when((t.rlike(r"\bwith\b") | t.rlike(r"\b\+\b")) & t.rlike(ADDED), 1)
        .when(F.coalesce(F.length(listed) >= 3, F.lit(False)), 1)
        .when(varied, 1)
        .when(t.rlike(WEAK_SINGLE) | F.contains(t, F.lit(WEAK_UNIT)), 0)
    )


def main_product() -> Column:
    t = F.lower(gather_text())
    guess = P.first_true([("laptop", P.any_of(t, ("laptop", "chromebook", "macbook"))), ("tv", P.any_of(t, ("tv", "television"))), ("monitor", P.any_of(t, ("monitor",)))])
    return F.coalesce(F.nullif(F.trim(F.lower(T.or_empty(F.col("sub_category")))), F.lit("")), guess, F.lit("product"))


def detect_bundles(df: DataFrame, probability: Column | None = None) -> DataFrame:
    """Bundle annotations per product; ``probability`` is a model's, 0.5 without one."""
    df = df.withColumn("_text", gather_text())
    df = df.withColumn("_low", F.lower("_text"))
    text, t = F.col("_text"), F.col("_low")
    word = t.rlike(WEAK_BUNDLE)
    joined = P.any_of(t, JOINING)
    df = df.withColumns({
        "pack_qty": P.pack_qty(text),
        "accessories": F.array_distinct(F.concat(S.accessories_in(text), S.accessories_listed(F.col("spec_entries")), S.accessories_varied(F.col("details_map")))),
        "main_product": main_product(),
        "_word": word, "_joined": joined,
        "_p": F.coalesce(probability if probability is not None else F.lit(0.5), F.lit(0.5)),
    })
    pack, n = F.col("pack_qty"), F.size("accessories")
    p = F.greatest("_p", F.when(F.col("_word"), 0.9), F.when(F.col("_joined"), 0.7), F.when(pack.isNotNull(), 0.85))
    df = df.withColumn("_p", p)
    kind = F.when(pack >= 2, "multi_pack").when((F.col("_p") >= 0.6) & (n >= 1), "accessory_bundle").otherwise("standalone")
    tags = F.concat_ws(
        ",", F.when(F.col("_word"), TAG_WORD), F.when(F.col("_joined"), TAG_JOINED),
        F.concat(F.lit(TAG_PACK), pack.cast("string")), F.when(n > 0, F.concat(F.lit(TAG_ACCESSORIES), n.cast("string"))),
        F.when(F.col("_p") >= 0.8, TAG_STRONG).when(F.col("_p") >= 0.6, TAG_WEAK),
    )
    return df.select(
        "product_id", (kind != "standalone").alias("is_bundle"), kind.alias("bundle_type"),
        F.round(F.least(F.greatest("_p", F.lit(0.0)), F.lit(1.0)), 4).alias("bundle_confidence"), "main_product", "accessories", "pack_qty", tags.alias("bundle_evidence"),
    )


def apply_bundles(df: DataFrame, bundles: DataFrame) -> DataFrame:
    """Set the bundle flag of products that are annotated as bundles; it is never cleared."""
    hits = bundles.groupBy(F.col("product_id").cast("string").alias("_pid")).agg(F.bool_or("is_bundle").alias("_hit"))
    joined = df.join(hits, F.col("product_id").cast("string") == F.col("_pid"), "left")
    flag = F.coalesce(F.col("_hit"), F.lit(False)) | F.coalesce(F.col("axes.packaging.bundle"), F.lit(False))
    return joined.withColumn("axes", F.col("axes").withField("packaging.bundle", flag)).drop("_pid", "_hit")


def _whole_word(term: str) -> str:
    escaped = "".join(c if c.isalnum() else "\\" + c for c in term)
    return rf"\b{escaped}\b"


def probe(df: DataFrame, extra_terms: tuple[str, ...] = (), fold: bool = True) -> DataFrame:
    """``df`` with bundle_score and its evidence: triggers, accessories, multipack, spec_hint."""
    keys = F.map_keys(F.map_from_entries(F.array_distinct(F.transform(F.col("spec_entries"), lambda e: F.struct(e["key"], F.lit(1))))))
    spec = lambda k: T.probe_clean(S.spec_value(F.col("specs"), k), fold)
    text = T.join_texts(T.probe_clean(F.col("name"), fold), T.probe_clean(F.col("brief_description"), fold), *[spec(k) for k in ("Accessories Included", "Package Contents", "Included", "In the Box")])
    by_key = lambda k: F.try_element_at(F.filter(F.col("spec_entries"), lambda e: e["key"] == k), F.lit(-1))["value"]
    df = df.withColumn("_t", text)
    df = df.withColumn("_hay", F.concat_ws(" ", F.col("_t"), *[F.nullif(T.probe_clean(by_key(k), fold), F.lit("")) for k in CONTENT_SPECS]))

    def hits(c: Column, named: dict[str, str], needed: Callable[[str], str] = lambda n: n) -> Column:
        # A pattern is searched only where the letters are that each of its matches has: they are found by comparing bytes.
        each = lambda x: F.filter(F.array(*[F.when(F.contains(x, F.lit(needed(n))) & x.rlike(p), F.lit(n)) for n, p in sorted(named.items())]), lambda h: h.isNotNull())
        return T.bound(c, lambda x: F.when(x.isNull(), F.array().cast("array<string>")).otherwise(each(x)))

    lexicon = {t: _whole_word(t) for t in {*PROBE_LEXICON, *extra_terms}}

    def counted(pattern: str) -> Column:
        found = F.transform(F.regexp_extract_all("_t", F.lit(pattern), F.lit(1)), lambda n: F.concat(F.lit(pattern + ":"), n))
        return F.when(P.any_of(F.col("_t"), PACK_LETTERS[pattern]), found).otherwise(F.when(F.col("_t").isNotNull(), F.array().cast("array<string>")))

    packs = [counted(p) for p in MULTIPACKS]
    df = df.withColumns({
        "triggers": hits(F.col("_t"), TRIGGERS, lambda n: TRIGGER_LETTERS.get(n, n)), "found": hits(F.col("_hay"), lexicon), "packs": F.concat(*packs),
        "evidence_spec_hint": F.arrays_overlap(keys, F.array(*[F.lit(k) for k in CONTENT_SPECS[:4]])),
    })
    total = 2.0 * F.size("triggers") + F.least(F.size("found"), F.lit(6)) + 2.0 * F.size("packs") + F.when(F.col("evidence_spec_hint"), 2.0).otherwise(0.0)
    return df.withColumns({
        "bundle_score": total, "evidence_triggers": F.array_join("triggers", ", "), "evidence_accessories": F.array_join("found", ", "),
        "evidence_multipack": F.array_join("packs", ", "),
    }).drop("_t", "_hay", "triggers", "packs")


def bundle_candidates(probed: DataFrame, n: int = 50) -> DataFrame:
    return probed.orderBy(F.col("bundle_score").desc(), "product_id").limit(max(1, n))


def non_bundle_sample(probed: DataFrame, n: int = 50, seed: int = 42, share: float = 0.6) -> DataFrame:
    """n rows, chosen by a seeded hash, of the tail after the first ``share`` of rows by score.

    The cut is found from counts per score; only rows of the score that it falls into are ranked. As rows are read
    several times, they are written once; ``probed`` should have only the columns that are wanted.
    """
    from pyspark.sql import Window as W

    probed = probed if hasattr(probed, "_shelfmark_path") else shared_table(probed, "probed")
    total = probed.count()
    cut = int(share * total)
    counts = probed.groupBy("bundle_score").agg(F.count("*").alias("c"))
    ahead = W.orderBy(F.col("bundle_score").desc()).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("bundle_score", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("start"), "c")
    rows = probed.join(F.broadcast(starts), "bundle_score").filter(F.col("start") + F.col("c") > cut)
    # At most one score is cut through; its rows are numbered by product in all tasks.
    inside = rows.filter(F.col("start") < cut)
    inside = number_rows(inside, "_r", order=["product_id"]).filter(F.col("start") + F.col("_r") >= cut).drop("_r")
    tail = inside.unionByName(rows.filter(F.col("start") >= cut))
    return tail.drop("start", "c").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("product_id"))), "product_id").limit(max(1, n))


def accessory_term_counts(probed: DataFrame) -> DataFrame:
    # An inner explode would be given a filter on its array, which is pushed down and searches every text twice.
    terms = probed.select(F.explode_outer("found").alias("term")).groupBy("term").agg(F.count("*").alias("count"))
    return terms.filter("term is not null")
