"""CSV sources (S1, S2, S5) with declared schemas.

Schema inference costs a full extra pass over the input, so the default is a
declared schema; ``infer=True`` is an explicit opt-in.  A directory of part
files is read as one dataset (S5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer: bool = False, **options) -> DataFrame:
    """Read CSV text (a file, glob or folder of ``part-*`` files).

    ``schema`` may be a ``StructType`` or DDL string.  Without a schema and
    without ``infer`` every column is a string (the all-strings header form).
    PERMISSIVE mode turns malformed fields into NULL.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def all_strings(columns: list[str]) -> StructType:
    """Schema of an un-inferred header CSV: every column a nullable string."""
    return StructType([StructField(c, StringType(), True) for c in columns])
