"""MLlib models: weak-label axis classifiers, the bundle classifier, the confidence calibrator."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shelfmark.functions import parse as P
from shelfmark.functions import specs as S
from shelfmark.functions import text as T
from shelfmark.operators import vectors as V
from shelfmark.operators.axes import class_weights, label_index
from shelfmark.plans.shared import shared_table, table_path

#: Places that terms are hashed into. A class of a model takes 8 bytes for each that some
#: term has, however many terms there are; terms that share a place share a coefficient.
PLACES = 1 << 16


class TextVectors:
    """TF-IDF vectors of texts: one- and two-grams, sublinear, of unit length, hashed into ``PLACES``, of which those in use are numbered."""

    def __init__(self, text: str = "ml_text", row: str = "row_id", min_df: int = 3, max_df: float = 0.95, places: int = PLACES):
        self.text, self.row, self.min_df, self.max_df, self.places = text, row, min_df, max_df, places
        self.frequency: DataFrame | None = None
        self.used: DataFrame | None = None
        self.n = self.size = 0

    def fit(self, df: DataFrame) -> TextVectors:
        self.n = df.count()
        self.frequency = shared_table(V.frequencies(V.term_counts(df, self.row, self.text), self.n, self.min_df, self.max_df), "term_frequency")
        used = self.frequency.select(self._place().alias("place")).distinct()  # a row a place
        self.used = shared_table(used.withColumn("i", F.row_number().over(W.orderBy("place")) - 1), "term_places")
        self.size = max(1, self.used.count())
        return self

    def _place(self) -> Column:
        return F.pmod(F.xxhash64("term"), F.lit(self.places)).cast("int")

    def transform(self, df: DataFrame) -> DataFrame:
        """(row, features), a vector for every row of ``df``; one without known terms is empty."""
        weights = V.weighted(V.term_counts(df, self.row, self.text), self.frequency, self.n, self.row)
        placed = weights.withColumn("place", self._place()).join(F.broadcast(self.used), "place").groupBy(self.row, "i").agg(F.sum("weight").alias("w"))
        entries = placed.groupBy(self.row).agg(F.sort_array(F.collect_list(F.struct("i", "w"))).alias("e"))  # a row's own terms
        every = df.select(self.row).join(entries, self.row, "left").withColumn("e", F.coalesce("e", F.array().cast("array<struct<i:int,w:double>>")))
        sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.size).alias("size"), F.col("e.i").alias("indices"), F.col("e.w").alias("values"))
        written = shared_table(every.select(self.row, sparse.alias("features")), "text_vectors")
        # What is stored is a vector's own form, so it is read as vectors without a function on rows.
        schema = StructType([written.schema[self.row], StructField("features", VectorUDT())])
        return df.sparkSession.read.schema(schema).parquet(table_path(written))


class TextClassifier:
    """Balanced multinomial logistic regression on text vectors; fitted only with enough labels, for any number of classes."""

    def __init__(self, min_rows: int = 10, min_classes: int = 2):
        self.min_rows, self.min_classes = min_rows, min_classes
        self.model = self.classes = None

    def fit(self, df: DataFrame, label: str) -> TextClassifier:
        """Fit on the rows of ``df``, which has ``features``, that have a label."""
        weights = class_weights(df, label).collect()  # a row a class
        if sum(r.n for r in weights) < self.min_rows or len(weights) < self.min_classes:
            return self
        index = {r["label"]: r["index"] for r in label_index(df, label).collect()}
        table = [(str(r.label), float(index[str(r.label)]), float(r.weight)) for r in weights]
        self.classes = df.sparkSession.createDataFrame(table, "_name string, _y double, _wt double")
        rows = df.filter(F.col(label).isNotNull()).join(self.classes, F.col(label).cast("string") == F.col("_name"))
        total = sum(r.weight * r.n for r in weights)
        # Every partition sends a gradient of all classes and places in every round: with one partition a core they are no more for a larger table.
        cores = df.sparkSession.sparkContext.defaultParallelism
        lr = LogisticRegression(featuresCol="features", labelCol="_y", weightCol="_wt", family="multinomial", regParam=1 / total, standardization=False, maxIter=100)
        self.model = lr.fit(rows.select("features", "_y", "_wt").coalesce(cores))
        return self

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with ``out`` (the likeliest class) and ``out_proba``; nulls without a model."""
        if self.model is None:
            return df.withColumns({out: F.lit(None).cast("string"), f"{out}_proba": F.lit(None).cast("double")})
        scored = self.model.transform(df).withColumn(f"{out}_proba", F.array_max(vector_to_array("probability")))
        names = self.classes.select(F.col("_y").alias("prediction"), F.col("_name").alias(out))
        return scored.join(names, "prediction", "left").select(*df.columns, out, f"{out}_proba")


class AxisModeler:
    """Axis classifiers from weak labels on one set of text vectors; ``transform`` fills what parsing left open.

    Labels are what :func:`shelfmark.operators.axes.parsed` found: screens to the half inch, and
    colours only from specifications, since a title that stands in for a colour is no class.
    """

    KINDS = {"p_ram": "int", "p_storage": "int", "p_screen": "double", "p_color": "string", "p_cpu": "string"}
    #: A guessed colour needs this probability.
    COLOR_FROM = 0.55

    def __init__(self, min_class_support: int = 10, min_df: int = 3, max_df: float = 0.95):
        self.min_rows = max(min_class_support, 8)
        self.vectors = TextVectors("_model_text", min_df=min_df, max_df=max_df)
        self.models: dict[str, TextClassifier] = {}

    def _with_vectors(self, parsed: DataFrame, fit: bool) -> DataFrame:
        from shelfmark.operators.axes import model_text

        texts = parsed.select("row_id", model_text().alias("_model_text"))
        if fit:
            self.vectors.fit(texts)
        return parsed.join(self.vectors.transform(texts), "row_id")

    def fit(self, parsed: DataFrame) -> AxisModeler:
        color = T.normalize_color(F.coalesce(S.spec_first(F.col("spec_entries"), "color"), F.lit("")))
        labels = {"p_screen": P.half_inch(F.col("p_screen")), "p_color": F.nullif(color, F.lit(""))}
        rows = self._with_vectors(parsed, True).select("features", *[labels.get(k, F.col(k)).alias(k) for k in self.KINDS])
        rows = rows.persist()  # read several times by each of five models
        self.models = {k: TextClassifier(self.min_rows).fit(rows, k) for k in self.KINDS}
        rows.unpersist()
        return self

    def transform(self, parsed: DataFrame) -> DataFrame:
        """``parsed`` with open axes guessed, and for each of them ``<axis>_src``: parse, model or none."""
        out = self._with_vectors(parsed, False)
        for label, kind in self.KINDS.items():
            out = self.models[label].predict(out, "_guess")
            guess = F.col("_guess").try_cast(kind)
            if label == "p_screen":
                guess = F.when(P.screen_valid(F.col("sub_category"), guess, F.col("name")), guess)
            if label == "p_color":
                guess = F.when(F.col("_guess_proba") >= self.COLOR_FROM, guess)
            source = F.when(F.col(label).isNotNull(), "parse").when(guess.isNotNull(), "model").otherwise("none")
            out = out.withColumns({label: F.coalesce(F.col(label), guess), f"{label[2:]}_src": source}).drop("_guess", "_guess_proba")
        return out.drop("features")


def bundle_probability(df: DataFrame, label: Column, min_positive: int = 40, min_negative: int = 60) -> DataFrame:
    """``df`` (with row_id) with p_bundle from a model on the weak labels; 0.5 with too few of either."""
    n = df.agg(F.count_if(label == 1).alias("pos"), F.count_if(label == 0).alias("neg")).first()
    if n.pos < min_positive or n.neg < min_negative:
        return df.withColumn("p_bundle", F.lit(0.5))
    texts = df.select("row_id", "ml_text")
    rows = df.join(TextVectors().fit(texts).transform(texts), "row_id")
    scored = TextClassifier().fit(rows.select("features", label.alias("_label")), "_label").predict(rows, "_guess")
    return scored.withColumn("p_bundle", F.when(F.col("_guess") == "1", F.col("_guess_proba")).otherwise(1 - F.col("_guess_proba"))).drop("_guess", "_guess_proba", "features")


def calibrate(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """``df`` with calibrated: the probability of the label given the features, null where one is missing."""
    known = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="skip")
    train = known.transform(df.filter(F.col(label).isNotNull()).withColumn("_y", (F.col(label) > 0.5).cast("double")))
    model = LogisticRegression(featuresCol="_x", labelCol="_y", maxIter=100).fit(train)
    p = F.element_at(vector_to_array("probability"), 2)
    whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features])
    every = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep")
    return model.transform(every.transform(df)).withColumn("calibrated", F.when(whole, p)).select(*df.columns, "calibrated")
