"""Factorization machine: model table, scoring, gradient.

The model is a table ``idx, w, v0 .. v(k-1)`` with one row per feature and a small header.  It is
joined to the data, never gathered: with one feature per user and item it grows with the data.
The score of a row is ``w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum (v_if x_i)^2]``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitrec.functions.scalar import clamp, known, plus, sigmoid
from sitrec.operators.encoding import ENCODED, block_bytes, block_join
from sitrec.operators.joins import BROADCAST_BYTES, lookup_join

REGRESSION, CLASSIFICATION = "regression", "classification"
FORMAT, VERSION = "sitrec.fm", "1.0"


@dataclass(frozen=True)
class FMModel:
    factors: DataFrame
    intercept: float
    num_features: int
    num_factors: int
    low: float = -1.0
    high: float = 1.0
    task: str = REGRESSION

    def __post_init__(self):
        if self.task not in (REGRESSION, CLASSIFICATION):
            raise ValueError(f"unknown task {self.task!r}")
        if self.num_features < 1 or self.num_factors < 1:
            raise ValueError("a model needs at least one feature and one factor")

    @property
    def v(self) -> list[str]:
        return factor_columns(self.num_factors)

    def link(self, raw: Column) -> Column:
        """Raw score to prediction: clamped to the label range, or a probability."""
        return clamp(raw, self.low, self.high) if self.task == REGRESSION else sigmoid(raw)

    def with_factors(self, factors: DataFrame) -> FMModel:
        return replace(self, factors=factors)

    def save(self, path: str) -> None:
        """Write the factor table and the header, replacing what is there."""
        spark = self.factors.sparkSession
        self.factors.select("idx", "w", *self.v).write.mode("overwrite").parquet(f"{path}/factors")
        header = [
            (FORMAT, VERSION, self.task, self.num_features, self.num_factors, self.intercept, self.low, self.high)
        ]
        schema = (
            "format string, version string, task string, num_features bigint, num_factors int, "
            "intercept double, low double, high double"
        )
        spark.createDataFrame(header, schema).write.mode("overwrite").json(f"{path}/header")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FMModel:
        """Read a saved model; another format or counts that do not fit are errors."""
        header = spark.read.json(f"{path}/header").first()
        if header is None or (header["format"], header["version"]) != (FORMAT, VERSION):
            raise ValueError(f"{path} holds no {FORMAT} {VERSION} model")
        factors = spark.read.parquet(f"{path}/factors")
        rows, wide = factors.count(), len([c for c in factors.columns if c.startswith("v")])
        if rows != header["num_features"]:
            raise ValueError(f"expected {header['num_features']} features, found {rows}")
        if wide != header["num_factors"]:
            raise ValueError(f"expected {header['num_factors']} factors, found {wide}")
        return FMModel(
            factors, header["intercept"], rows, wide, header["low"], header["high"], header["task"]
        )


def factor_columns(k: int) -> list[str]:
    return [f"v{f}" for f in range(k)]


# ---- scoring -----------------------------------------------------------------------------------


def pair_term(k: int) -> str:
    """Pairwise part of the score from the columns ``s0.. , q``."""
    return f"({plus([f's{f} * s{f}' for f in range(k)])} - q) / 2"


def score_sums(
    long: DataFrame,
    model: FMModel,
    key: str = "row_id",
    *keep: Column,
    hot: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per row: linear part ``lin``, factor sums ``s0..``, sum of squares ``q`` and ``raw`` score.

    ``long`` has ``key, idx, val``; a row without features stands in it once, with NULL for both (see
    ``long_features(..., empty=True)``).  Features outside the model add nothing.  ``keep`` are further
    aggregates of the row.
    """
    joined = lookup_join(
        long,
        model.factors.select("idx", "w", *model.v),
        "idx",
        F.col(key),
        hot=hot,
        size=model.num_features * 16 * (model.num_factors + 2),
        broadcast_bytes=broadcast_bytes,
    )
    x = [f"{known(v)} * {known('val')}" for v in model.v]
    sums = joined.groupBy(key).agg(
        F.expr(f"sum({known('w')} * {known('val')}) as lin"),
        *(F.expr(f"sum({e}) as s{f}") for f, e in enumerate(x)),
        F.expr(f"sum({plus([f'{e} * {e}' for e in x])}) as q"),
        *keep,
    )
    return sums.withColumn("raw", F.expr(f"{model.intercept!r}D + lin + {pair_term(model.num_factors)}"))


def score_long(long: DataFrame, model: FMModel, key: str = "row_id", output: str = "prediction") -> DataFrame:
    """``key, prediction`` for sparse rows in long form."""
    return score_sums(long, model, key).select(key, model.link(F.col("raw")).alias(output))


def dictionary_factors(dictionary: DataFrame, model: FMModel) -> DataFrame:
    """The dictionary with the factors of every value: one join of two model-sized tables."""
    return dictionary.join(model.factors.select("idx", "w", *model.v), "idx")


def score_contextual(
    df: DataFrame,
    dictionary: DataFrame,
    model: FMModel,
    spread: Column,
    columns: Sequence[str] = ENCODED,
    parts: bool = False,
    output: str = "prediction",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Score rows that have one feature per column.

    Every column brings its own weights, so a row is scored where it stands: no long form and no
    grouping back.  Unknown values add nothing.  With ``parts`` the raw score and its parts stay.
    """
    k, kept = model.num_factors, list(df.columns)

    def take(b: int) -> list[str]:
        return [f"w as _w{b}", *(f"{v} as _v{b}_{f}" for f, v in enumerate(model.v))]

    joined = block_join(
        df,
        dictionary_factors(dictionary, model),
        columns,
        spread,
        take,
        block_bytes(dictionary, 64 + 16 * (k + 1)),
        broadcast_bytes,
    )
    blocks = range(len(columns))
    cell = [[known(f"_v{b}_{f}") for b in blocks] for f in range(k)]
    summed = joined.selectExpr(
        *kept,
        f"{plus([known(f'_w{b}') for b in blocks])} as lin",
        *(f"{plus(row)} as s{f}" for f, row in enumerate(cell)),
        f"{plus([f'{c} * {c}' for row in cell for c in row])} as q",
    )
    scored = summed.withColumn("raw", F.expr(f"{model.intercept!r}D + lin + {pair_term(k)}"))
    scored = scored.withColumn(output, model.link(F.col("raw")))
    return scored if parts else scored.select(*kept, output)


# ---- gradient ----------------------------------------------------------------------------------


def row_loss(task: str, raw: Column, label: Column) -> Column:
    """Half squared error, or the logistic loss of a label above or below zero."""
    if task == REGRESSION:
        return F.pow(raw - label, F.lit(2.0)) / 2
    margin = -sign_label(label) * raw
    return F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))


def row_slope(task: str, raw: Column, label: Column) -> Column:
    """Derivative of ``row_loss`` by the raw score."""
    if task == REGRESSION:
        return raw - label
    y = sign_label(label)
    return -y * sigmoid(-y * raw)


def sign_label(label: Column) -> Column:
    return F.when(label > 0, 1.0).otherwise(-1.0)


def row_slopes(
    long: DataFrame,
    model: FMModel,
    key: str = "row_id",
    clamp_in_training: bool = False,
    hot: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``key, s0.., e, loss``: factor sums, slope and loss of every row of ``key, idx, val, label``."""
    scored = score_sums(
        long, model, key, F.max("label").alias("label"), hot=hot, broadcast_bytes=broadcast_bytes
    )
    raw = model.link(F.col("raw")) if clamp_in_training and model.task == REGRESSION else F.col("raw")
    return scored.select(
        key,
        *(f"s{f}" for f in range(model.num_factors)),
        row_slope(model.task, raw, F.col("label")).alias("e"),
        row_loss(model.task, raw, F.col("label")).alias("loss"),
    )


def mean_loss(slopes: DataFrame) -> DataFrame:
    """One row ``n, loss, dw0``."""
    return slopes.agg(F.count(F.lit(1)).alias("n"), F.avg("loss").alias("loss"), F.avg("e").alias("dw0"))


def gradient(long: DataFrame, slopes: DataFrame, model: FMModel, n: int, key: str = "row_id") -> DataFrame:
    """Mean gradient over ``n`` rows as a table ``idx, dw, dv0..``.

    The slopes are joined back on the row and summed per feature.  The sums are combined in each
    task first, so a feature that occurs in most rows does not meet in one task.
    """
    k = model.num_factors
    sums = (
        long.select(key, "idx", "val")
        .filter("idx is not null")
        .join(slopes.drop("loss"), key)
        .groupBy("idx")
        .agg(
            F.expr("sum(e * val) as ex"),
            F.expr("sum(e * val * val) as exx"),
            *(F.expr(f"sum(e * val * s{f}) as es{f}") for f in range(k)),
        )
    )
    # a feature the model does not have gets no gradient
    return sums.join(model.factors.select("idx", *model.v), "idx").selectExpr(
        "idx",
        f"ex / {n} as dw",
        *(f"(es{f} - {v} * exx) / {n} as d{v}" for f, v in enumerate(model.v)),
    )


def l2_update(
    model: FMModel,
    grad: DataFrame,
    dw0: float,
    step: float,
    iteration: int = 1,
    dim: tuple[bool, bool, int] | None = None,
    reg: tuple[float, float, float] = (0.0, 1e-3, 1e-4),
) -> tuple[FMModel, DataFrame]:
    """One descent step ``p - eta (g + r p)`` with eta = step / sqrt(iteration).

    Returns the new model and a row ``penalty`` = half the weighted squares of the new parameters.
    """
    k0, k1, k = dim or (True, True, model.num_factors)
    r0, r1, r2 = reg
    eta = step / float(iteration) ** 0.5
    joined = model.factors.join(grad, "idx", "left")

    def moved(p: str, r: float) -> str:
        return f"{p} - {eta!r}D * ({known('d' + p)} + {float(r)!r}D * {p}) as {p}"

    factors = joined.selectExpr("idx", moved("w", r1) if k1 else "w", *(moved(v, r2) for v in model.v[:k]))
    intercept = model.intercept - eta * (dw0 + r0 * model.intercept) if k0 else model.intercept
    squares = f"{float(r2)!r}D * ({plus([f'{v} * {v}' for v in model.v[:k]])})"
    if k1:
        squares += f" + {float(r1)!r}D * w * w"
    bias = float(r0 * intercept * intercept) if k0 else 0.0
    penalty = factors.agg(F.expr(f"(sum({squares}) + {bias!r}D) / 2 as penalty"))
    return replace(model, factors=factors, intercept=intercept), penalty
