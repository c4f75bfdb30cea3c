"""Gradient-boosted trees of Spark ML on a feature array, with degenerate cases defined."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Share of the trees' own probability in a calibrated score: it orders what
# the steps of the isotonic function would leave tied.
TIE_SHARE = 0.001


@dataclass(frozen=True)
class BoostedModel:
    """Trees, or a constant probability where labels had one class or none."""

    trees: GBTClassificationModel | None
    constant: float
    isotonic: IsotonicRegressionModel | None = None


def fit_boosted(rows: DataFrame, features: str, label: str, calibration: DataFrame | None = None,
                trees: int = 20, depth: int = 3, step: float = 0.25, seed: int = 7) -> BoostedModel:
    """Fit on ``rows`` (a feature array and a 0/1 label); calibrate on other rows.

    Labels of one class give that class as a constant, no labels give 0.
    Without calibration rows of both classes scores stay uncalibrated.
    """
    n, pos = rows.agg(F.count(label), F.coalesce(F.sum(label), F.lit(0))).first()
    if pos == 0 or pos == n:
        return BoostedModel(None, 1.0 if n and pos == n else 0.0)
    gbt = GBTClassifier(featuresCol="__vec", labelCol=label, predictionCol="__pred",
                        maxIter=trees, maxDepth=depth, stepSize=step, seed=seed)
    model = gbt.fit(rows.select(array_to_vector(F.col(features)).alias("__vec"),
                                F.col(label).cast("double").alias(label)))
    model.setProbabilityCol("__prob").setRawPredictionCol("__raw")
    fitted = BoostedModel(model, 0.0)
    if calibration is None:
        return fitted
    pairs = score_boosted(calibration, features, fitted, "__p").select("__p", F.col(label).cast("double").alias(label))
    n, pos = pairs.agg(F.count(label), F.coalesce(F.sum(label), F.lit(0.0))).first()
    if pos == 0 or pos == n:
        return fitted
    iso = IsotonicRegression(featuresCol="__p", labelCol=label, predictionCol="__cal").fit(pairs)
    return BoostedModel(model, 0.0, iso)


def score_boosted(df: DataFrame, features: str, model: BoostedModel, out: str) -> DataFrame:
    """Add the probability of label 1 as ``out`` and drop the features.

    The other columns are packed into one while Spark ML works, so that any names are allowed.
    """
    kept = [c for c in df.columns if c != features]
    if model.trees is None:
        return df.drop(F.col(f"`{features}`")).withColumn(out, F.lit(model.constant))
    packed = df.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("__row"),
                       array_to_vector(F.col(features)).alias("__vec"))
    p = model.trees.transform(packed).select("__row", vector_to_array(F.col("__prob"))[1].alias("__p1"))
    score = F.col("__p1")
    if model.isotonic is not None:
        model.isotonic.setFeaturesCol("__p1")
        p = model.isotonic.transform(p)
        blended = (1 - TIE_SHARE) * F.col("__cal") + TIE_SHARE * F.col("__p1")
        score = F.least(F.greatest(blended, F.lit(0.0)), F.lit(1.0))
    return p.select(*[F.col("__row").getField(c).alias(c) for c in kept], score.alias(out))


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def bounded_sample(rows: DataFrame, key: str, max_rows: int, seed: int = 11) -> DataFrame:
    """About ``max_rows`` rows chosen by a hash of the key; all, if they are fewer."""
    n = rows.count()
    if n <= max_rows:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
