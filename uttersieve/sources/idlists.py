"""Id lists kept as text: one id per line, or comma-separated lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A field of a comma-separated line: quoted with doubled quotes, or bare.
_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def read_ids(spark: SparkSession, path: str, name="utt_id") -> DataFrame:
    """One id per line.  A ``subset=...`` folder becomes a column."""
    return spark.read.text(path).withColumnRenamed("value", name)


def read_id_rows(spark: SparkSession, path: str, name="utt_id") -> DataFrame:
    """Comma-separated ids, any number of lines."""
    lines = spark.read.text(path).filter(F.col("value") != "")
    field = F.explode(F.regexp_extract_all("value", F.lit(_FIELD), F.lit(1)))
    bare = F.when(
        F.col(name).startswith('"'),
        F.regexp_replace(F.expr(f"substring(`{name}`, 2, length(`{name}`) - 2)"), '""', '"'),
    ).otherwise(F.col(name))
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(*rest, field.alias(name)).withColumn(name, bare)
