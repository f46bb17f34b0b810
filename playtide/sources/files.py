"""Catalogue files, record files and column-wise JSON, in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide import schemas
from playtide.functions import nan_to_null


def read_catalogue(spark: SparkSession, path: str,
                   schema: T.StructType = schemas.CATALOGUE) -> DataFrame:
    """Track catalogue CSV with a header whose first column is an unnamed row number."""
    numbered = T.StructType([T.StructField("_row", T.LongType()), *schema.fields])
    rows = spark.read.schema(numbered).csv(path, header=True, enforceSchema=True,
                                           escape='"', multiLine=False)
    return nan_to_null(rows.drop("_row"))


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = True) -> DataFrame:
    """JSON files holding an array of records, one record per file, or one per line.

    ``multi_line`` files are each read by one task; lines (``multi_line=False``) can be split.
    """
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line; null fields are written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_column_json(spark: SparkSession, path: str, types: dict[str, str], multi_line: bool = False) -> DataFrame:
    """Column-wise JSON ``{"column": {"0": value, ...}, ...}`` as rows with their ``row_id``.

    One document per line; a file that is one single document is read with ``multi_line``.
    """
    text = spark.read.text(path, wholetext=multi_line)
    columns = F.from_json("value", "map<string,map<string,string>>")
    cells = (text.select(F.explode(columns).alias("name", "cells"))
             .select("name", F.explode("cells").alias("row_id", "cell")))
    return (cells.groupBy(F.col("row_id").cast("bigint").alias("row_id"))
            .agg(*[F.max(F.when(F.col("name") == name, F.col("cell"))).cast(kind).alias(name)
                   for name, kind in types.items()]))


def write_column_json(df: DataFrame, path: str, row_id: str, rows_per_document: int = 1_000) -> None:
    """Write rows in the column-wise form that ``read_column_json`` reads.

    Each line is one document with a run of ``rows_per_document`` row numbers, so a result of
    any size is written by many tasks.
    """
    columns = [c for c in df.columns if c != row_id]
    run = F.floor(F.col(row_id) / rows_per_document).alias("run")
    documents = df.groupBy(run).agg(*[
        F.map_from_entries(F.array_sort(F.collect_list(
            F.struct(F.col(row_id).alias("row_id"), F.col(c).alias("cell"))))).alias(c)
        for c in columns])
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    documents.select(text.alias("value")).write.text(path)


def topic_messages(df: DataFrame, topic: str) -> DataFrame:
    """Rows as keyless JSON messages of a topic, nulls written and text left unescaped."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.lit(topic).alias("topic"), value.alias("value"))


def write_messages(messages: DataFrame, path: str | None = None,
                   servers: str | None = None) -> None:
    """Send ``(topic, value)`` to a broker, or append them below ``path`` as JSON lines."""
    if servers:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("kafka.enable.idempotence", "true").save())
    elif path:
        messages.write.mode("append").json(path)
    else:
        raise ValueError("give a path or servers")
