"""The snapshot lake the registered queries read: adapter views written once as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starfold.session import configure, write_work
from starfold.sources.adapters import ADAPTERS, adapter_view

_WRITTEN: dict[tuple[str, str, str], str] = {}


def lake_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One lake table of a data folder, read in place and not written.

    For queries that scan a table once: only the columns that they use are read, shuffled and summed.
    """
    return adapter_view(configure(spark), sf_dir, name)


def lake_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One lake table of a data folder.

    Grouped adapters are written below the shared folder on first use: operators scan a fact table
    several times, a written table has exact size statistics for Spark's join choices, and it
    survives lost executors. Plain projections are read in place.
    """
    configure(spark)
    if not ADAPTERS[name][1]:
        return adapter_view(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = write_work(adapter_view(spark, sf_dir, name), f"lake-{name}", release=True)
    return spark.read.parquet(_WRITTEN[key])
