"""Writing stage tables, models and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", by: str = "category") -> None:
    """Write a stage table in one folder per category, for partition pruning.

    Rows are grouped by category before they are written, so there are few files; the rebalance
    splits a category with a large part of the rows over several tasks.
    """
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def save_load_model(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return type(model).load(path)


def write_topic_report(sections: dict[str, DataFrame], path: str) -> list[str]:
    """One Parquet table per report section."""
    written = []
    for name, frame in sections.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
        written.append(f"{path}/{name}")
    return written


def summary_json(summary: DataFrame) -> DataFrame:
    """The summary rows as JSON documents."""
    return summary.select(F.to_json(F.struct(*summary.columns)).alias("value"))


def write_summary_json(summary: DataFrame, path: str) -> None:
    summary_json(summary).write.mode("overwrite").text(path)


def export_filtered_csv(df: DataFrame, path: str, now: datetime | None = None) -> str:
    """Write the frame as CSV into a folder whose name ends in the time of export."""
    target = f"{path}_{(now or datetime.now()).strftime('%Y%m%d_%H%M%S')}"
    df.write.mode("overwrite").option("header", True).csv(target)
    return target


def write_eval_summary(metrics: DataFrame, path: str) -> None:
    """One row of headline metrics per model, as CSV."""
    metrics.select("model", "accuracy", "precision", "recall", "f1").write.mode(
        "overwrite"
    ).option("header", True).csv(path)
