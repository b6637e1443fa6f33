"""Writers: Parquet for the clean table, single-file CSV for small results,
and fitted ``PipelineModel`` save/load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed Parquet write: one file per task, no shuffle."""
    df.write.mode(mode).parquet(path)


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV part file with a header.

    Only for result tables whose size is bounded by construction (a funnel
    of 7 rows, one row per model, 10 importances, a 1000-row sample, 30
    histogram bins): ``coalesce(1)`` sends every row through one task.
    """
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def publish_tables(tables: Mapping[str, DataFrame | None], base: str, parallelism: int = 4) -> dict[str, str]:
    """Write each present result table to ``{base}/{name}`` as one CSV file.

    Absent tables (``None``) are skipped, as the reference's collector skips
    missing part files. The tables are small and independent, so they are
    written from concurrent driver threads. Returns the names written with
    their paths.
    """
    present = {name: df for name, df in tables.items() if df is not None}
    paths = {name: f"{base.rstrip('/')}/{name}" for name in present}
    if parallelism <= 1 or len(present) <= 1:
        for name, df in present.items():
            write_single_csv(df, paths[name])
        return paths
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target

    with ThreadPoolExecutor(max_workers=min(parallelism, len(present))) as pool:
        futures = [
            pool.submit(inheritable_thread_target(df.sparkSession)(write_single_csv), df, paths[name])
            for name, df in present.items()
        ]
        for f in futures:
            f.result()
    return paths


def model_path(base: str, model_name: str) -> str:
    """``{base}_{name with spaces as underscores}``."""
    return f"{base}_{model_name.replace(' ', '_')}"


def save_pipeline_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
