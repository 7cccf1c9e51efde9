"""Early-warning model: encoding, balanced logistic regression, scoring."""

from dataclasses import dataclass
from datetime import date
from typing import Optional

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.risk import LABEL, training_set
from ..operators.scores import evaluate_scores
from ..params import DEFAULTS, Params
from ..session import materialise
from ..tables import Tables
from .split import stratified_split

# The features of the model.
NUMERIC = (
    "credit_score",
    "annual_income_nzd",
    "roll3_paid_full_rate",
    "roll3_missed_cnt",
    "roll3_avg_arrears",
    "eop_balance",
    "interest_rate_apr",
)
CATEGORIES = ("product_type", "channel", "employment_type", "dpd_bucket")


@dataclass(frozen=True)
class TrainedRisk:
    model: PipelineModel
    scores: DataFrame
    metrics: DataFrame


def _numeric_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in NUMERIC})


def encoder() -> Pipeline:
    """Numeric columns as they are, one indicator per category; an unseen category gives zeros."""
    indexed = [f"{c}_index" for c in CATEGORIES]
    encoded = [f"{c}_encoded" for c in CATEGORIES]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(CATEGORIES),
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            # "keep" adds an index for unseen values; dropping the last leaves them all zero
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            VectorAssembler(inputCols=[*NUMERIC, *encoded], outputCol="features"),
        ]
    )


def feature_names(encoding: PipelineModel) -> list[str]:
    indexer = encoding.stages[0]
    indicators = [
        f"{column}={value}"
        for column, values in zip(CATEGORIES, indexer.labelsArray)
        for value in values
    ]
    return [*NUMERIC, *indicators]


def named_features(encoding: PipelineModel, df: DataFrame) -> DataFrame:
    """The encoded vector as one column per feature."""
    vector = vector_to_array("features")
    encoded = encoding.transform(_numeric_as_double(df)).withColumn("v", vector)
    return encoded.select(
        "loan_id", "month_end", *[F.col("v")[i].alias(n) for i, n in enumerate(feature_names(encoding))]
    )


def fit_encoder(df: DataFrame) -> PipelineModel:
    return encoder().fit(_numeric_as_double(df))


def _class_sizes(train: DataFrame) -> dict[int, int]:
    """Rows of each class. Names the numeric columns that hold NULL before a fit fails on one."""
    missing = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in NUMERIC]
    found = train.groupBy(LABEL).agg(F.count(F.lit(1)).alias("rows"), *missing).collect()
    sizes = {row[LABEL]: row["rows"] for row in found}
    if set(sizes) != {0, 1}:
        raise ValueError(f"training needs both classes, found {sorted(sizes)}")
    counts = {c: sum(row[c] for row in found) for c in NUMERIC}
    bad = ", ".join(f"{c} ({n})" for c, n in counts.items() if n)
    if bad:
        raise ValueError(f"NULL in numeric features: {bad}")
    return sizes


def fit_risk_model(train: DataFrame, params: Params = DEFAULTS) -> PipelineModel:
    """Logistic regression with class weights n / (2 * class size) and an L2 penalty of 1.

    The weights sum to n, so a penalty weight of 1/n gives the usual sum objective. It is strictly
    convex, so its minimum is what any solver should find; `fit_gradient` tells how near it is.
    """
    sizes = _class_sizes(train)
    encoding = fit_encoder(train)
    fitted = _fit_regression(encoding.transform(_numeric_as_double(train)), sizes, params)
    return PipelineModel([*encoding.stages, fitted])


def _fit_regression(encoded: DataFrame, sizes: dict[int, int], params: Params) -> LogisticRegressionModel:
    regression = LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        weightCol="class_weight",
        maxIter=params.max_iter,
        regParam=1 / (sizes[0] + sizes[1]),
        elasticNetParam=0.0,
        standardization=False,
        tol=params.fit_tolerance,
    )
    return regression.fit(encoded.withColumn("class_weight", _class_weight(sizes)))


def _class_weight(sizes: dict[int, int]) -> Column:
    n = sizes[0] + sizes[1]
    return F.when(F.col(LABEL) == 1, n / (2 * sizes[1])).otherwise(n / (2 * sizes[0]))


def fit_gradient(model: PipelineModel, train: DataFrame) -> DataFrame:
    """Rows (feature, gradient): the first-order condition of a fit on its training rows.

    Per feature and for the intercept the derivative of the mean weighted loss plus penalty, with
    the feature in units of its standard deviation, so that features of any scale compare. At
    the minimum all are 0. One aggregation over the rows.
    """
    sizes = {row[LABEL]: row["count"] for row in train.groupBy(LABEL).count().collect()}
    n = sum(sizes.values())
    fitted = model.stages[-1]
    rows = model.transform(_numeric_as_double(train)).select(
        vector_to_array("features").alias("v"),
        (_class_weight(sizes) * (vector_to_array("probability")[1] - F.col(LABEL))).alias("residual"),
    )
    one = lambda name, slope: F.struct(F.lit(name).alias("feature"), slope.alias("gradient"))
    parts = [one("intercept", F.sum("residual") / n)]
    for i, (name, weight) in enumerate(zip(feature_names(model), fitted.coefficients)):
        value = F.col("v")[i]
        slope = (F.sum(F.col("residual") * value) + F.lit(float(weight))) / n
        spread = F.stddev_pop(value)
        parts.append(one(name, slope / F.when(spread > 0, spread).otherwise(1.0)))
    return rows.agg(F.array(*parts).alias("parts")).select(F.explode("parts").alias("p")).select("p.*")


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Probability of reaching 60+ for every row."""
    return model.transform(_numeric_as_double(df)).select(
        *df.columns, vector_to_array("probability")[1].alias("risk_score")
    )


def score_with_coefficients(named: DataFrame, coefficients: dict[str, float], intercept: float) -> DataFrame:
    """Scores of rows with one column per feature, from coefficients that were fitted before."""
    total = F.lit(float(intercept))
    for name, weight in coefficients.items():
        total = total + F.lit(float(weight)) * F.col(f"`{name}`")
    return named.select("loan_id", "month_end", (1 / (1 + F.exp(-total))).alias("risk_score"))


def train_risk_model(t: Tables, params: Params = DEFAULTS, as_of: Optional[date] = None) -> TrainedRisk:
    """Train on a stratified share, evaluate on the rest, score every recent loan-month.

    The labelled rows are written once for the split and the fit of the encoder. They are encoded once
    as well: the passes of the regression and the scoring read the stored features. So do metrics and
    scores with the scored rows.
    """
    rows = stratified_split(materialise(training_set(t, params, as_of)), LABEL, params)
    train = ~F.col("is_test")
    sizes = _class_sizes(rows.where(train))
    encoding = fit_encoder(rows.where(train))
    encoded = materialise(
        encoding.transform(_numeric_as_double(rows)).select("loan_id", "month_end", LABEL, "is_test", "features")
    )
    regression = _fit_regression(encoded.where(train), sizes, params)
    model = PipelineModel([*encoding.stages, regression])
    probability = vector_to_array("probability")[1].alias("risk_score")
    scored = materialise(
        regression.transform(encoded).select("loan_id", "month_end", probability, LABEL, "is_test")
    )
    metrics = evaluate_scores(
        scored.where("is_test").select("risk_score", LABEL), LABEL, params.threshold
    )
    return TrainedRisk(model, scored.select("loan_id", "month_end", "risk_score", LABEL), metrics)
