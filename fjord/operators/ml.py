"""Model training and scoring with Spark ML (M1, M3, M4, M6, M7).

Feature prep is a fitted ``Pipeline``: ``StringIndexer(handleInvalid="keep")``
gives unseen and NULL categories their own slot (the reference's "missing"
dummy), ``OneHotEncoder`` and ``VectorAssembler`` build the vector, and a
``GBTClassifier`` weighted by the class ratio replaces the single-machine
boosted trees. Training runs as distributed Spark jobs; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.operators import metrics
from fjord.operators.features import CATEGORICAL, HASHED, frequency_table, stratified_split, with_frequencies
from fjord.operators.quality import class_weight
from fjord.session import reliable_checkpoint


def feature_pipeline(categorical: Sequence[str], numeric: Sequence[str]) -> list:
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                        outputCols=[f"{c}__ohe" for c in categorical], handleInvalid="keep", dropLast=False)
    asm = VectorAssembler(inputCols=[f"{c}__ohe" for c in categorical] + list(numeric),
                          outputCol="features", handleInvalid="keep")
    return [*idx, ohe, asm]


def prepare(df: DataFrame, label: str, numeric: Sequence[str], weight: float | None = None) -> DataFrame:
    out = df.withColumn("label", F.col(label).cast("double"))
    for c in numeric:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    if weight is not None:
        out = out.withColumn("weight", F.when(F.col("label") == 1.0, F.lit(float(weight))).otherwise(F.lit(1.0)))
    return out


def train(df: DataFrame, numeric: Sequence[str], label: str = "is_fraud",
          categorical: Sequence[str] = CATEGORICAL, max_iter: int = 300, step_size: float = 0.05,
          max_depth: int = 5, seed: int = 42, key: str = "tr_id", hashed: Sequence[str] = HASHED,
          ) -> tuple[PipelineModel, DataFrame, DataFrame, dict[str, DataFrame]]:
    """M1–M3: stratified split, class-weighted GBT; returns (model, scored test set, metrics row, frequencies).

    The weight is negatives / max(positives, 1) over the training split (A11).
    Hash columns enter as their frequency in the training split; the tables
    are part of the model.
    """
    # an iterative trainer reads its input many times: materialise it once (lineage cut)
    split = reliable_checkpoint(stratified_split(df, label=label, key=key, seed=seed))
    train_df = split.filter(F.col("split") == "train")
    test_df = split.filter(F.col("split") == "test")
    w = class_weight(train_df, label).first()["scale_pos_weight"]  # one scalar
    tables = {c: reliable_checkpoint(frequency_table(train_df, c)) for c in hashed if c in df.columns}
    train_df, test_df = with_frequencies(train_df, tables), with_frequencies(test_df, tables)
    numeric = [*numeric, *[f"{c}_freq" for c in tables]]
    gbt = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=max_iter,
                        stepSize=step_size, maxDepth=max_depth, seed=seed)
    model = Pipeline(stages=[*feature_pipeline(categorical, numeric), gbt]).fit(
        prepare(train_df, label, numeric, w))
    scored = reliable_checkpoint(score(model, prepare(test_df, label, numeric)))
    curve = metrics.pr_curve(scored, "label", "score")
    best = metrics.best_f1_threshold(curve)
    report = metrics.average_precision(curve).select(
        F.col("average_precision").alias("pr_auc"),
        best.select("threshold").scalar().alias("best_threshold"),  # one-row scalar subqueries
        best.select("f1").scalar().alias("best_f1"),
        F.lit(float(w)).alias("scale_pos_weight"),
        F.array(*[F.lit(c) for c in [*categorical, *numeric]]).alias("feature_columns"))
    return model, scored, report, tables


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M4: probability of the positive class as a plain double column."""
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def save_bundle(model: PipelineModel, report: DataFrame, path: str, frequencies: Mapping[str, DataFrame] | None = None) -> None:
    """M6: model, metrics (threshold included) and frequency tables side by side."""
    model.write().overwrite().save(f"{path}/model")
    for c, t in (frequencies or {}).items():
        t.write.mode("overwrite").parquet(f"{path}/frequencies/{c}")
    report.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")


def log_run(report: DataFrame, runs_path: str, run_name: str, feature_count: int) -> None:
    """M7: append one tracking row (params + metrics) to a runs table."""
    (report.withColumn("run_name", F.lit(run_name))
           .withColumn("feature_count", F.lit(feature_count))
           .withColumn("logged_at", F.current_timestamp())
           .write.mode("append").parquet(runs_path))


def evaluate(model: PipelineModel, df: DataFrame, threshold: float, numeric: Sequence[str], label: str = "is_fraud",
             frequencies: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """M5: score with a saved model and its threshold; PR points, AP, matrix, report.

    Returns lazy DataFrames; ``save_evaluation`` writes them. The PR points
    replace the reference's plot.
    """
    encoded = with_frequencies(df, frequencies or {})
    scored = reliable_checkpoint(score(model, prepare(encoded, label, [*numeric, *[f"{c}_freq" for c in frequencies or {}]])))
    curve = metrics.pr_curve(scored, "label", "score")
    return {
        "pr_curve": curve,
        "pr_auc": metrics.average_precision(curve),
        "confusion_matrix": metrics.confusion_matrix(scored, "label", "score", threshold),
        "classification_report": metrics.classification_report(scored, "label", "score", threshold),
    }


def save_evaluation(results: dict[str, DataFrame], path: str) -> None:
    """K7: one JSON output per evaluation artefact; the PR curve has a row per distinct score and keeps its partitions."""
    for name, df in results.items():
        small = df if name == "pr_curve" else df.coalesce(1)
        small.write.mode("overwrite").json(f"{path}/{name}")
