"""Character n-gram TF-IDF and the merchant categoriser.

Descriptions repeat, so all text work runs on distinct descriptions with their counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gradus.functions.columns import md5_int, with_row
from gradus.operators.ledger import BEHAVIOUR
from gradus.operators.ordering import running_totals
from gradus.operators.softmax import fit_softmax, text_blocks
from gradus.sources.tables import materialise


def char_ngrams(text: Column, low: int = 2, high: int = 5) -> Column:
    """Character n-grams inside word boundaries: each word padded with a space on both sides;
    a padded word shorter than ``n`` is not repeated."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def grams(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), F.length(padded)))
        return F.flatten(F.transform(sizes, lambda n: F.transform(
            F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substring(padded, i, n)
        )))

    return F.flatten(F.transform(words, grams))


def description_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("description").agg(F.count(F.lit(1)).alias("documents"))


def term_counts(descriptions: DataFrame) -> DataFrame:
    """(description, documents, gram, tf): grams of each distinct description."""
    return (
        descriptions.select("description", "documents", F.explode(char_ngrams(F.col("description"))).alias("gram"))
        .groupBy("description", "documents", "gram").agg(F.count(F.lit(1)).alias("tf"))
    )


def fit_idf(ledger: DataFrame, min_df: int = 2) -> DataFrame:
    """Smoothed idf of every gram found in at least ``min_df`` transactions."""
    descriptions = materialise(description_counts(ledger))
    size = descriptions.agg(F.sum("documents").alias("_n"))
    frequency = term_counts(descriptions).groupBy("gram").agg(F.sum("documents").alias("df")).where(F.col("df") >= min_df)
    idf = F.ln((F.lit(1.0) + F.col("_n")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return with_row(frequency, size).select("gram", "df", idf.alias("idf"))


def tfidf(descriptions: DataFrame, idf: DataFrame) -> DataFrame:
    """Unit-length weights, ``(1 + ln tf) * idf``, of distinct descriptions as long rows."""
    weighted = term_counts(descriptions).join(idf, "gram").select(
        "description", "gram", ((F.lit(1.0) + F.ln("tf")) * F.col("idf")).alias("w"), *[c for c in idf.columns if c == "position"]
    )
    length = weighted.groupBy("description").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_length"))
    return weighted.join(length, "description").withColumn("weight", F.col("w") / F.col("_length")).drop("w", "_length")


def numbered(idf: DataFrame) -> DataFrame:
    """Give every gram a position, in hashed order, without gathering the vocabulary."""
    keyed = materialise(idf.select("gram", "idf", md5_int(F.col("gram"), 15).alias("place"), F.lit(1).cast("bigint").alias("one")))
    ranked = running_totals(keyed, "place", ["one"], ties=["gram"])
    return materialise(ranked.select("gram", "idf", (F.col("cum_one") - 1).cast("int").alias("position")))


@dataclass(frozen=True)
class Categoriser:
    """Fitted categoriser: a table of grams, and what every class adds to that.

    ``grams`` has gram, idf and weights (one per class).  ``scaler`` and ``behaviour`` hold, for each
    behavioural column if used, its mean and population deviation and its weights per class.
    ``rounds`` is how many the fit took.
    """

    grams: DataFrame
    classes: list[str]
    intercepts: list[float]
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    behaviour: dict[str, list[float]] = field(default_factory=dict)
    rounds: int = 0

    def text_margins(self, rows: DataFrame) -> DataFrame:
        """described and margins (one per class) of each distinct description with a known gram.

        A sparse product: grams of a description meet their weights in a join and are summed
        per class, together with the length that makes the weights a unit vector.
        """
        met = term_counts(description_counts(rows)).join(self.grams, "gram")
        w = (F.lit(1.0) + F.ln("tf")) * F.col("idf")
        sums = [F.sum(w * F.col("weights")[k]).alias(f"m{k}") for k in range(len(self.classes))]
        summed = met.groupBy(F.col("description").alias("described")).agg(F.sqrt(F.sum(w * w)).alias("length"), *sums)
        return summed.select("described", F.array(*[F.col(f"m{k}") / F.col("length") for k in range(len(self.classes))]).alias("margins"))

    def transform(self, rows: DataFrame, out: str = "category") -> DataFrame:
        """Add the likeliest class.  A row without a description, or without known grams, keeps
        its place: its other columns decide.  Of equal classes the first is taken."""
        margins = self.text_margins(rows).select(F.col("described").alias("_described"), F.col("margins").alias("_margins"))
        joined = rows.join(margins, F.col("description") == F.col("_described"), "left")
        scaled = [(F.col(c) - F.lit(mean)) * F.lit(1.0 / deviation if deviation else 0.0) for c, (mean, deviation) in self.scaler.items()]
        # Missing values are set aside first: sums that cannot be null need far less code, and run five times as fast.
        whole = reduce(lambda x, y: x & y, [v.isNotNull() for v in scaled], F.lit(True))
        ready = joined.withColumns({
            "_margins": F.coalesce("_margins", F.array(*[F.lit(0.0)] * len(self.classes))), "_whole": whole,
            **{f"_scaled_{i}": F.coalesce(v, F.lit(0.0)) for i, v in enumerate(scaled)},
        })
        scores = []
        for k, base in enumerate(self.intercepts):
            score = F.lit(base) + F.coalesce(F.get("_margins", F.lit(k)), F.lit(0.0))
            for i, c in enumerate(self.scaler):
                score = score + F.col(f"_scaled_{i}") * F.lit(self.behaviour[c][k])
            scores.append(score)
        chosen = ready.withColumn("_scores", F.array(*scores))
        best = F.array_position("_scores", F.array_max("_scores")).cast("int")
        names = F.array(*[F.lit(c) for c in self.classes])
        own = ["_described", "_margins", "_whole", "_scores", *[f"_scaled_{i}" for i in range(len(scaled))]]
        return chosen.withColumn(out, F.when(F.col("_whole"), F.get(names, best - 1))).drop(*own)

    def save(self, folder: str) -> None:
        """The grams as a table, the rest as one row a class."""
        spark = self.grams.sparkSession
        self.grams.write.mode("overwrite").parquet(f"{folder}/grams")
        scaler = [(c, *self.scaler[c]) for c in self.scaler]
        rows = [(k, name, self.intercepts[k], scaler, [self.behaviour[c][k] for c in self.scaler], self.rounds) for k, name in enumerate(self.classes)]
        schema = "place int, class string, intercept double, scaler array<struct<name:string,mean:double,deviation:double>>, behaviour array<double>, rounds int"
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/classes")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Categoriser:
        rows = spark.read.parquet(f"{folder}/classes").orderBy("place").collect()
        scaler = {x["name"]: (x["mean"], x["deviation"]) for x in rows[0]["scaler"]} if rows else {}
        behaviour = {c: [r["behaviour"][i] for r in rows] for i, c in enumerate(scaler)}
        return cls(spark.read.parquet(f"{folder}/grams"), [r["class"] for r in rows], [r["intercept"] for r in rows], scaler, behaviour, rows[0]["rounds"] if rows else 0)


def _text_cells(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """_described and _cells, the (position, weight) of its known grams, of each distinct description that has some."""
    return tfidf(description_counts(rows), vocabulary).groupBy(F.col("description").alias("_described")).agg(
        F.sort_array(F.collect_list(F.struct("position", "weight"))).alias("_cells")
    )


def _vectors(rows: DataFrame, vocabulary: DataFrame, size: int, scaled: dict[str, Column], keep: list[Column]) -> DataFrame:
    """``keep`` and ``x``, the sparse vector of text and scaled columns, as a written table.

    A vector is stored as a struct of its kind, size, positions and values, so it is put
    together by SQL functions and only read back as a vector.
    """
    joined = rows.join(_text_cells(rows, vocabulary), F.col("description") == F.col("_described"), "left")
    found = F.coalesce(F.col("_cells"), F.array().cast("array<struct<position:int,weight:double>>"))
    places = F.concat(found["position"], F.array(*[F.lit(size + i) for i in range(len(scaled))]).cast("array<int>"))
    values = F.concat(found["weight"], F.array(*scaled.values()).cast("array<double>"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size + len(scaled)).alias("size"), places.alias("indices"), values.alias("values"))
    out = joined.select(vector.alias("x"), *keep)
    read_as = StructType([StructField("x", VectorUDT()), *out.schema.fields[1:]])
    return materialise(out, read_as)


def _fit_text(train: DataFrame, vocabulary: DataFrame, size: int, label: Column, c: float, max_iter: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Weights (class x position), intercepts and rounds of a fit on text alone, equal rows counted."""
    weighted = train.groupBy("description", "true_category").agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    ready = _vectors(weighted, vocabulary, size, {}, [label.alias("label"), F.col("_weight").alias("weight")])
    n = ready.agg(F.sum("weight")).first()[0]
    model = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="weight", family="multinomial", regParam=1.0 / (c * n), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter,
    ).fit(ready)
    return model.coefficientMatrix.toArray(), model.interceptVector.toArray(), int(model.summary.totalIterations)


def _fit_hybrid(
    train: DataFrame, vocabulary: DataFrame, size: int, label: Column, counts: list[int], scaled: dict[str, Column], flat: list[bool], c: float, max_iter: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """The same of a fit on text and ``scaled`` columns, those that are ``flat`` having one value.

    Few rows are equal here, so a description's vector is shared by its rows instead (see ``softmax``).
    """
    cells = materialise(_text_cells(train, vocabulary).select(
        F.col("_described").alias("described"), F.col("_cells")["position"].alias("positions"), F.col("_cells")["weight"].alias("weights")
    ))
    blocks, n = text_blocks(train, cells, label, list(scaled.values()))
    places = cells.select("described", F.explode(F.arrays_zip("positions", "weights")).alias("x")).join(description_counts(train), F.col("described") == F.col("description"))
    x, times = F.col("x")["weights"], F.col("documents")
    moments = places.groupBy(F.col("x")["positions"].alias("position")).agg(F.sum(times * x).alias("s"), F.sum(times * x * x).alias("q")).toArrow()
    means, deviations = np.zeros(size + len(scaled)), np.r_[np.zeros(size), [0.0 if one else 1.0 for one in flat]]
    at, mean = np.asarray(moments["position"]), np.asarray(moments["s"]) / n
    variance = np.asarray(moments["q"]) / n - mean * mean
    means[at], deviations[at] = mean, np.sqrt(np.where(variance > 1e-12, variance, 0.0))
    return fit_softmax(blocks, n, deviations, means, len(scaled), np.array(counts, float) / n, 1.0 / (c * n), max_iter)


def fit_categoriser(train: DataFrame, behaviour: bool, c: float = 5.0, max_iter: int = 2000, min_df: int = 2) -> Categoriser:
    """Multinomial logistic model on text, or on text and standardised behaviour.

    The vocabulary stays a table; its size and one weight per gram and class reach the driver.
    Text-only rows that are equal are fitted once, weighted; rows with behaviour share the vector of their text.
    """
    vocabulary = numbered(fit_idf(train, min_df))
    size = vocabulary.count()
    found = train.groupBy("true_category").agg(F.count(F.lit(1)).alias("n")).orderBy("true_category").collect()
    classes = [r["true_category"] for r in found]
    label = F.lit(None).cast("double")
    for i, name in enumerate(classes):
        label = F.when(F.col("true_category") == name, F.lit(float(i))).otherwise(label)
    scaler = {}
    if behaviour:
        row = train.agg(*[f(c).alias(f"{c}_{n}") for c in BEHAVIOUR for n, f in (("mean", F.avg), ("deviation", F.stddev_pop))]).first()
        scaler = {c: (row[f"{c}_mean"], row[f"{c}_deviation"]) for c in BEHAVIOUR}
        scaled = {c: (F.col(c) - F.lit(mean)) * F.lit(1.0 / deviation if deviation else 0.0) for c, (mean, deviation) in scaler.items()}
        flat = [not deviation for _, deviation in scaler.values()]
        weights, intercepts, rounds = _fit_hybrid(train, vocabulary, size, label, [r["n"] for r in found], scaled, flat, c, max_iter)
    else:
        weights, intercepts, rounds = _fit_text(train, vocabulary, size, label, c, max_iter)
    positions = train.sparkSession.createDataFrame(pa.table({
        "position": pa.array(range(size), pa.int32()), "weights": pa.array(list(weights.T[:size]), pa.list_(pa.float64())),
    }))
    grams = materialise(vocabulary.join(positions, "position").select("gram", "idf", "weights"))
    return Categoriser(
        grams, classes, [float(x) for x in intercepts], scaler, {name: weights[:, size + i].tolist() for i, name in enumerate(scaler)}, rounds,
    )


def accuracy(predicted: DataFrame, true: str = "true_category", guess: str = "category") -> DataFrame:
    return predicted.agg(
        (F.count_if(F.col(true) == F.col(guess)).cast("double") / F.count(F.lit(1)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def class_report(predicted: DataFrame, true: str = "true_category", guess: str = "category") -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    confusion = predicted.groupBy(F.col(true).alias("t"), F.col(guess).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    # classes x classes rows from here on
    sides = confusion.select(F.explode(F.array(
        F.struct(F.col("t").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"), F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("g").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hit")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").cast("double").alias("hit"))
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("guessed").cast("double")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hit"), F.col("support").cast("double")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return sums.select("label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")
