"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.session import configure

# Rows of one Arrow batch. Texts may be long, so batches stay small.
ARROW_ROWS = "256"

ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these jobs: adaptive plans, skew joins, small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet, compared without case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Run a columns-in, columns-out function over every Arrow batch of `df`.

    `make` is called once per task and returns the batch function, so that a task can load a model
    once. The function gets {column: Python list} and returns {column: list} of `schema`.
    """
    spark = df.sparkSession
    target = pa_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            out = fn({n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns, strict=True)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in target], schema=target
            )

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
