"""Sensitive documents by their names: character n-grams within words, TF-IDF, and a linear support vector machine."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from umbra.functions import lexicon as lx, naming


def char_grams(text: Column, low: int = 2, high: int = 5) -> Column:
    """The n-grams of each word padded with a blank at both ends; a shorter padded word is one gram."""
    words = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda w: w != "")

    def grams(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        sizes = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda n: (n <= F.length(padded)) | (n == low))
        return F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda k: F.substring(padded, k, n))))

    return F.flatten(F.transform(words, grams))


def default_training(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, "sensitive") for n in lx.SENSITIVE_NAMES] + [(n, "normal") for n in lx.NORMAL_NAMES], "name string, label string").coalesce(1)


class DocClassifier:
    """Fitted on names (name, label in sensitive, normal); predicts on the stem of paths."""

    def __init__(self, training: DataFrame):
        rows = training.select(char_grams(F.col("name")).alias("grams"), F.when(F.col("label") == "sensitive", 1.0).otherwise(0.0).alias("y"))
        share = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
        total = sum(share.values())
        weighted = rows.withColumn("weight", F.create_map(*[F.lit(x) for y, n in share.items() for x in (y, total / (2.0 * n))])[F.col("y")])
        counts = CountVectorizer(inputCol="grams", outputCol="counts", minDF=1.0).fit(weighted)
        self._features = PipelineModel([counts])
        scaled = self._sublinear(counts.transform(weighted))
        self._rest = Pipeline(stages=[IDF(inputCol="tf", outputCol="tfidf"), Normalizer(inputCol="tfidf", outputCol="features", p=2.0)]).fit(scaled)
        self._model = LinearSVC(featuresCol="features", labelCol="y", weightCol="weight", regParam=0.01, maxIter=40, standardization=False).fit(self._rest.transform(scaled))

    @staticmethod
    def _sublinear(df: DataFrame) -> DataFrame:
        return df.withColumn("tf", array_to_vector(F.transform(vector_to_array("counts"), lambda c: F.when(c > 0, 1.0 + F.log(c)).otherwise(0.0))))

    def predict(self, files: DataFrame, path: str = "path") -> DataFrame:
        """(path, is_sensitive, score)."""
        rows = files.select(F.col(path).alias("path"), char_grams(naming.stem(F.col(path))).alias("grams"))
        scored = self._model.transform(self._rest.transform(self._sublinear(self._features.transform(rows))))
        margin = vector_to_array("rawPrediction")[1]
        return scored.select("path", (margin > 0).alias("is_sensitive"), (1 / (1 + F.exp(-margin))).alias("score"))


__all__ = ["DocClassifier", "char_grams", "default_training"]
