"""Error measures, baselines and classification metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrec.functions.scalar import single
from sitrec.operators.ordering import totals_before


def squared(a, b) -> Column:
    return F.pow(F.col(a) - b if isinstance(a, str) else a - b, F.lit(2.0))


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: RMSE of the rows with a finite prediction, and how many were left out."""
    usable = F.col(prediction).isNotNull() & ~F.isnan(F.col(prediction).cast("double"))
    error = F.when(usable, squared(label, F.col(prediction)))
    return df.agg(
        F.sqrt(F.avg(error)).alias("rmse"),
        F.count(error).alias("n"),
        F.count_if(~usable).alias("dropped"),
    )


def rmse_joined(
    predictions: DataFrame,
    truth: DataFrame,
    keys: tuple[str, str] = ("userid", "itemid"),
    denominator: str = "matched",
) -> DataFrame:
    """RMSE of predictions joined to the truth by user and item: the chosen one of ``rmses_joined``."""
    if denominator not in ("matched", "all"):
        raise ValueError("denominator must be 'matched' or 'all'")
    both = rmses_joined(predictions, truth, keys)
    return both.filter(F.col("denominator") == denominator).select("rmse", "matched")


def rmses_joined(predictions: DataFrame, truth: DataFrame, keys: tuple[str, str] = ("userid", "itemid")) -> DataFrame:
    """``denominator, rmse, matched`` of predictions joined to the truth by user and item.

    ``matched`` divides by the joined pairs, ``all`` by the rows of the truth (a pair without prediction then
    adds no error).  Repeated pairs count in all combinations, as in a join, but both sides are summed per pair
    first, about their means: sum (p - r)^2 = n_r C_p + n_p C_r + n_p n_r (mean p - mean r)^2.  All terms
    are positive, so nearly exact predictions lose no digits.
    """

    def per_pair(df: DataFrame, value: str, tag: str) -> DataFrame:
        x = F.col(value).cast("double")
        sums = {"n": F.count(x), "m": F.avg(x), "c": F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0))}
        return df.groupBy(*keys).agg(*(e.alias(f"{name}_{tag}") for name, e in sums.items()))

    joined = per_pair(predictions, "prediction", "p").join(per_pair(truth, "rating", "r"), list(keys))
    error = F.expr("n_r * c_p + n_p * c_r + n_p * n_r * (m_p - m_r) * (m_p - m_r)")
    sums = joined.agg(F.sum(error).alias("e"), F.coalesce(F.sum(F.expr("n_p * n_r")), F.lit(0)).alias("matched"))
    by = F.array(
        F.struct(F.lit("matched").alias("denominator"), F.col("matched").alias("n")),
        F.struct(F.lit("all").alias("denominator"), single(truth, F.count(F.lit(1))).alias("n")),
    )
    rows = sums.select("e", "matched", F.explode(by).alias("d"))
    return rows.select("d.denominator", F.sqrt(F.try_divide("e", F.col("d.n"))).alias("rmse"), "matched")


def baseline(training: DataFrame, test: DataFrame, label: str = "rating") -> DataFrame:
    """One row: mean rating of the training rows and the RMSE of predicting it for the test rows."""
    mean = single(training, F.avg(label))
    return test.agg(
        F.first(mean).alias("mean_rating"), F.sqrt(F.avg(squared(label, mean))).alias("baseline_rmse")
    )


def report(training: DataFrame, predictions: DataFrame, label: str = "rating") -> DataFrame:
    """Mean rating, baseline and model RMSE, improvement in percent, and the same as text."""
    mean = single(training, F.avg(label))
    measured = predictions.agg(
        F.first(mean).alias("mean_rating"),
        F.sqrt(F.avg(squared(label, mean))).alias("baseline_rmse"),
        F.sqrt(F.avg(squared(label, F.col("prediction")))).alias("rmse"),
    )
    gain = F.try_divide(F.col("baseline_rmse") - F.col("rmse"), F.col("baseline_rmse")) * 100
    text = F.format_string(
        "mean rating %.3f, baseline RMSE %.3f, model RMSE %.3f, improvement %1.2f",
        "mean_rating",
        "baseline_rmse",
        "rmse",
        "improvement",
    )
    return measured.withColumn("improvement", gain).withColumn("report", text)


def rounded_accuracy(df: DataFrame, label: str = "rating", prediction: str = "prediction", places: int = 0) -> DataFrame:
    same = F.round(label, places) == F.round(prediction, places)
    return df.agg(F.avg(same.cast("double")).alias("accuracy"))


def residuals(df: DataFrame, *keys: str, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    delta = F.abs(F.col(label) - F.col(prediction))
    return df.select(*keys, F.col(label).alias("label"), F.col(prediction).alias("prediction"), delta.alias("delta"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def multiclass_metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy and label-weighted recall, precision and F-measure from a confusion table."""
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = matrix.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("claimed"), hit.alias("hit")),
                F.struct(F.col("predicted").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("c").agg(F.sum("actual").alias("actual"), F.sum("claimed").alias("claimed"), F.sum("hit").alias("hit"))
    recall = F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0))
    precision = F.coalesce(F.try_divide("hit", "claimed"), F.lit(0.0))
    both = F.coalesce(F.try_divide(F.lit(2.0) * F.col("hit"), F.col("actual") + F.col("claimed")), F.lit(0.0))
    n = F.sum("actual")
    return per.agg(
        (F.sum("hit") / n).alias("accuracy"),
        (F.sum(recall * F.col("actual")) / n).alias("recall"),
        (F.sum(precision * F.col("actual")) / n).alias("precision"),
        (F.sum(both * F.col("actual")) / n).alias("f_measure"),
    )


def auc(df: DataFrame, positive: Column, score: str) -> DataFrame:
    """Exact area under the ROC curve; equal scores count half.

    Rows are counted per distinct score first, then positives are met with the negatives below them.
    """
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    below = totals_before(counts, [F.col("score").asc()], {"neg_below": F.col("neg")})
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2))
    return below.agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))
