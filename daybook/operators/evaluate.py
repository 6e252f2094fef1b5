"""Model training and evaluation for the run (M1-M3).

Metrics come from the confusion counts ``groupBy(label, prediction)`` — a
table with at most classes² rows, aggregated map-side — so no per-row data
is brought anywhere; weighted precision / recall / F1 follow the usual
definitions (a class never predicted has precision 0, weights are the true
class supports).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRIC_DIGITS = 9


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M2: one row ``accuracy, precision, recall, f1`` (weighted averages)."""
    conf = confusion_counts(df, label, prediction)
    per_class = (
        conf.select(F.col("y").alias("c"), F.col("n").alias("support"), F.lit(0).alias("predicted"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"))
        .unionByName(conf.select(F.col("p").alias("c"), F.lit(0).alias("support"), F.col("n").alias("predicted"), F.lit(0).alias("tp")))
        .groupBy("c")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    scored = per_class.select("c", "support", "tp", prec.alias("prec"), rec.alias("rec"))
    f1 = F.when(F.col("prec") + F.col("rec") > 0, 2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(F.lit(0.0))
    total = F.sum("support")
    return scored.select("*", f1.alias("f1")).agg(
        F.round(F.sum("tp") / total, METRIC_DIGITS).alias("accuracy"),
        F.round(F.sum(F.col("support") * F.col("prec")) / total, METRIC_DIGITS).alias("precision"),
        F.round(F.sum(F.col("support") * F.col("rec")) / total, METRIC_DIGITS).alias("recall"),
        F.round(F.sum(F.col("support") * F.col("f1")) / total, METRIC_DIGITS).alias("f1"),
    )


def hash_split(key: str, seed: int, test_fraction: float):
    """Is the row of this key in the test set?  Decided by md5 of ``seed:key`` alone, so it
    is the same on any cluster and partitioning."""
    part = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(part < F.lit(int(test_fraction * 2**32)), F.lit(False))


def train_logistic(
    df: DataFrame, features: str, label: str, key: str, *, seed: int = 42, max_iter: int = 1000, test_fraction: float = 0.2,
    inverse_penalty: float = 1.0,
):
    """M1: seeded split by ``key``, multinomial logistic regression (L-BFGS), test predictions.

    ``inverse_penalty`` weighs the data loss against half the squared weights
    (an L2 penalty of 1 by default); MLlib takes it per training row.

    ``features`` may be an ``array<float|double>`` column; it is turned into
    an ML vector with ``array_to_vector`` (no Python per row).  Returns
    ``(model, predictions)``; training is MLlib's distributed tree aggregate.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = df.select("*", array_to_vector(F.col(features)).alias("_features"), F.col(label).cast("double").alias("_label"))
    is_test = hash_split(key, seed, test_fraction)
    train, test = data.where(~is_test), data.where(is_test)
    rows = train.count()
    lr = LogisticRegression(
        featuresCol="_features", labelCol="_label", maxIter=max_iter, family="multinomial",
        regParam=1.0 / (inverse_penalty * max(rows, 1)), elasticNetParam=0.0, standardization=False,
    )
    model = lr.fit(train)
    pred = model.transform(test).withColumnRenamed("prediction", "_prediction")
    return model, pred


#: Rounds of the Newton solver and decimal places that weights keep between rounds.
NEWTON_ROUNDS = 12
WEIGHT_DIGITS = 9


def newton_sums(train: DataFrame, weights: list[list[float]], classes: list) -> DataFrame:
    """``(k, j, g, c)``: gradient and curvature of the log loss by class ``k`` and feature ``j``, summed over the rows.

    ``train`` holds ``(x array<double>, y)``; the last weight of a class is its intercept, whose feature is 1. With
    the probabilities ``p`` of a row, feature ``j`` of class ``k`` adds ``(p_k - [y = k]) x_j`` and ``p_k (1 - p_k) x_j^2``.
    Batches are summed in numpy before anything is shuffled: a batch sends one row per class and feature.
    A null or absent component counts as 0.
    """
    w, number = np.array(weights), {c: k for k, c in enumerate(classes)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(0)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            x = np.zeros((batch.num_rows, w.shape[1]))
            x[:, :-1][np.arange(w.shape[1] - 1) < sizes[:, None]] = pc.fill_null(lists.flatten(), 0.0).to_numpy(zero_copy_only=False)
            x[:, -1] = 1.0
            y = np.array([number[v] for v in batch.column(1).to_pylist()])
            z = x @ w.T
            e = np.exp(z - z.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            g = (p - np.eye(len(number))[y]).T @ x
            c = (p * (1 - p)).T @ (x * x)
            k, j = np.indices(g.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.ravel()) for a in (k.astype(np.int32), j.astype(np.int32), g, c)], names=["k", "j", "g", "c"]
            )

    return train.mapInArrow(sums, "k int, j int, g double, c double").groupBy("k", "j").agg(F.sum("g").alias("g"), F.sum("c").alias("c"))


def train_newton(
    df: DataFrame, features: str, label: str, key: str, *, seed: int = 42, rounds: int = NEWTON_ROUNDS, test_fraction: float = 0.2,
    penalty: float = 1.0,
):
    """M1 by a fixed number of Newton steps: ``(weights by class, test rows with _prediction)``.

    The same objective as :func:`train_logistic` (multinomial log loss summed over the rows, half the squared weights
    times ``penalty``, the intercept free). Each round is one pass over the training rows that sums gradients and
    curvatures per class and feature, and moves every weight by ``gradient / curvature``. Weights are rounded to
    ``WEIGHT_DIGITS`` between rounds, so the order of the sums does not matter. What reaches the driver is
    classes x (features + 1) sums. Ties go to the smallest class; rows without label or features teach nothing.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull())
    is_test = hash_split(key, seed, test_fraction)
    x = F.transform(F.col(features), lambda v: v.cast("double"))
    train = rows.where(~is_test).select(x.alias("x"), F.col(label).alias("y"))
    shape = train.agg(F.array_sort(F.collect_set("y")).alias("classes"), F.max(F.size("x")).alias("width")).first()
    classes, width = list(shape["classes"]), (shape["width"] or 0) + 1
    w = np.zeros((len(classes), width))
    for _ in range(rounds if classes else 0):
        step = np.zeros_like(w)
        for r in newton_sums(train, w.tolist(), classes).collect():
            ridge = penalty if r["j"] < width - 1 else 0.0
            curvature = r["c"] + ridge
            step[r["k"], r["j"]] = (r["g"] + ridge * w[r["k"], r["j"]]) / curvature if curvature > 0 else 0.0
        w = np.round(w - step, WEIGHT_DIGITS) + 0.0
    scores = [
        F.round(F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in row[:-1]]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + float(row[-1]), WEIGHT_DIGITS)
        for row in w
    ]
    best = F.array_max(F.array(*[F.struct(s.alias("s"), F.lit(-k).alias("k")) for k, s in enumerate(scores)])) if classes else None
    found = F.element_at(F.array(*[F.lit(c) for c in classes]), F.lit(1) - best["k"]) if classes else F.lit(None)
    return dict(zip(classes, w.tolist(), strict=True)), rows.where(is_test).withColumn("_prediction", found)


def run_metrics(df: DataFrame, features: str, label: str, params: dict | None = None) -> DataFrame:
    """M3: one row per recorded value ``(metric, value, text)``: feature count,
    class count, row count, and the parameters of the run; a parameter that
    is no number has a null ``value`` and its ``text``."""
    stats = df.agg(
        F.max(F.size(features)).cast("double").alias("n_features"),
        F.countDistinct(label).cast("double").alias("n_classes"),
        F.count(F.lit(1)).cast("double").alias("n_rows"),
    )

    def row(name: str, value, text=None):
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"), F.lit(text).cast("string").alias("text"))

    rows = [row(c, F.col(c)) for c in ("n_features", "n_classes", "n_rows")]
    for k, v in (params or {}).items():
        number = isinstance(v, (int, float)) and not isinstance(v, bool)
        rows.append(row(k, F.lit(float(v)) if number else F.lit(None), None if number else str(v)))
    return stats.select(F.inline(F.array(*rows)))
