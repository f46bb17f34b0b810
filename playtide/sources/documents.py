"""Records out of large JSON documents that hold an array of them, read by many tasks.

A document of one array has no line to split at. Here the text source cuts it at every closing brace,
which it can do from any byte range, and every piece says how many quotes it has. Whether a piece
starts inside a string follows from the parity of the quotes before it, how deep it is from the braces
outside strings before it, and which record it belongs to from the records closed before it. Each of
these is a running sum: within a run of pieces by a window, for a run that starts outside and one that starts
inside a string, and over the runs of a file by one row per run. The pieces of a record are then put together
again and parsed.

A byte range is cut into runs of ``1 << _RUN_BITS`` pieces, and these are dealt to tasks by their number, so a
task holds a few runs or records at once, never a document or a whole byte range.

Defined results: files may hold an array of objects, one object, or objects one after the other; white
space and line breaks are free. Records that are not JSON of the schema have null fields. Elements of
the array that are no objects are left out, as are files without an object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtide.session import dealt, work_path

_RUN = ["file", "block", "run"]
_RUN_BITS = 14  # a run has at most so many bits of pieces
_COUNTS = "quotes int, opens0 int, closes0 int, opens1 int, closes1 int"
_PIECE = f"file string, block bigint, run bigint, place bigint, value string, bare_end boolean, {_COUNTS}"
_WITHIN = f"{_PIECE}, step0 bigint, step1 bigint, before0 bigint, before1 bigint"


def read_array_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Every object of the arrays in the files under ``path``, with the columns of ``schema``."""
    records = record_texts(spark, path)
    return records.select(F.from_json("record", schema, {"mode": "PERMISSIVE"}).alias("data")).select("data.*")


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """``file, number, record``: the text of each object at the top of a document or its array, in order."""
    folder = work_path(spark, "json-runs")
    pieces = _pieces(spark, path)
    dealt(pieces, pieces.count(), *_RUN).transform(_within_runs).write.parquet(folder)
    runs = spark.read.schema(_WITHIN).parquet(folder)
    # One row per run of pieces: whether it starts inside a string, and how deep.
    earlier = W.partitionBy("file").orderBy("block", "run").rowsBetween(W.unboundedPreceding, -1)
    sums = runs.groupBy(*_RUN).agg(F.sum("quotes").alias("quotes"), *[F.sum(f"step{i}").alias(f"step{i}") for i in (0, 1)],
                                   F.max("place").alias("end"), F.max(F.when(F.col("bare_end"), F.col("place"))).alias("bare_place"))
    begun = sums.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    begun = begun.withColumn("depth", F.coalesce(F.sum(F.when(F.col("inside") == 1, F.col("step1")).otherwise(F.col("step0")))
                                                 .over(earlier), F.lit(0)))
    # The piece behind a file's last brace has no brace of its own.
    final = F.lead("run").over(W.partitionBy("file").orderBy("block", "run")).isNull()
    begun = begun.select(*_RUN, "inside", "depth", F.when(final & (F.col("end") == F.col("bare_place")), F.col("end")).alias("last_place"))

    n = runs.count()
    placed = dealt(runs, n, *_RUN).join(begun, _RUN)
    picked = lambda name: F.when(F.col("inside") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    last = F.coalesce(F.col("place") == F.col("last_place"), F.lit(False))
    placed = placed.select(*_RUN, "place", "value", last.alias("last"), picked("opens").alias("opens"),
                           F.when(last, F.lit(0)).otherwise(picked("closes")).alias("closes"),
                           (F.col("depth") + picked("before")).alias("depth_before"))
    after = F.col("depth_before") + F.col("opens") - F.col("closes")
    here = W.partitionBy(*_RUN).orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    ended = (placed.withColumn("ends", F.when((F.col("closes") == 1) & (after == 0), F.lit(1)).otherwise(F.lit(0)))
             .withColumn("number_here", F.coalesce(F.sum("ends").over(here), F.lit(0)))
             .where("not last or depth_before > 0 or opens > 0")
             .select(*_RUN, "place", "value", "ends", "number_here"))
    folder = work_path(spark, "json-ends")
    ended.write.parquet(folder)
    ended = spark.read.schema(ended.schema).parquet(folder)
    counted = (ended.groupBy(*_RUN).agg(F.sum("ends").alias("ends"))
               .select(*_RUN, F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("number_before")))
    numbered = dealt(ended.join(counted, _RUN)
                     .withColumn("number", F.col("number_before") + F.col("number_here")), n, "file", "number")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "value"))), lambda p: p["value"]), "}")
    # Only commas, brackets and other elements of the array stand before a record's brace.
    return (numbered.groupBy("file", "number").agg(body.alias("text"), F.sum("ends").alias("ends"))
            .withColumn("text", F.when(F.col("ends") > 0, F.concat("text", F.lit("}"))).otherwise(F.col("text")))
            .select("file", "number", F.regexp_replace("text", r'(?s)^(?:[^{"]|"(?:[^"\\]|\\.)*")*', "").alias("record"))
            .where("record <> ''"))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between closing braces, with the byte range it was read from, its place there and its run of places; written out once."""
    text = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value")
    text = text.withColumn("run", F.shiftright("place", _RUN_BITS))
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = _count(plain, '"')
    counted = text.withColumn("quotes", quotes).withColumn("bare_end", ~F.col("value").rlike(r"\{"))
    for i in (0, 1):
        # What is outside strings, which begin and end at a quote, if the piece starts outside (0) or inside one (1).
        bare = F.regexp_replace(F.concat(F.lit('"' * i), plain), r'(?s)"[^"]*("|$)', "")
        counted = counted.withColumn(f"opens{i}", _count(bare, "{")).withColumn(
            f"closes{i}", F.when((quotes + i) % 2 == 0, F.lit(1)).otherwise(F.lit(0)))
    folder = work_path(spark, "json-pieces")
    counted.select(_names(_PIECE)).write.parquet(folder)
    return spark.read.schema(_PIECE).parquet(folder)


def _within_runs(pieces: DataFrame) -> DataFrame:
    """Add how deep each piece is within its run (``before``), and what it adds (``step``), if the run starts outside or inside a string."""
    here = W.partitionBy(*_RUN).orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    inside = pieces.withColumn("odd", F.coalesce(F.sum("quotes").over(here), F.lit(0)) % 2)
    both = lambda name, i: F.when(F.col("odd") == i, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    shaped = inside.select("file", "block", "run", "place", "value", "bare_end", "quotes",
                           *[both(name, i).alias(f"{name}{i}") for name in ("opens", "closes") for i in (0, 1)])
    for i in (0, 1):
        shaped = shaped.withColumn(f"step{i}", (F.col(f"opens{i}") - F.col(f"closes{i}")).cast("bigint"))
    return shaped.withColumns({f"before{i}": F.coalesce(F.sum(f"step{i}").over(here), F.lit(0)) for i in (0, 1)}).select(
        _names(_WITHIN))


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))
