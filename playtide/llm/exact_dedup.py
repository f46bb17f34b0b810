"""Exact duplicates by sorting content.

Rows are dealt to ranges of their normalised bytes. The splitters are sampled by
Spark from the first bytes of each text (they must stay small, texts need not), with
SHA-256 behind them so that equal beginnings are told apart, and a salt so that one
text with a third of all rows is dealt over all ranges. Within a range an external
sort places equal bytes next to each other, and the group boundaries are found by
comparing neighbours in full. That leaves at most one row per text and salt; these
are brought together and sorted and compared once more.

Defined results: null text counts as empty, and empty texts equal each other. A null
identifier loses against any other. Of repeated rows (same text, same identifier)
exactly one is kept. An empty table gives an empty result. Other columns are carried
along whatever their names are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtide.llm.frames import all_columns, spread, whole_text

SPLITTER_BYTES = 48  # of a text, in the sampled splitters


def unchanged(text: Column) -> Column:
    return text


def _order(keep: str) -> Column:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    return F.col("id").asc_nulls_last() if keep == "smallest" else F.col("id").desc_nulls_last()


def _sorted_runs(rows: DataFrame, keep: str) -> DataFrame:
    """Rank and size of each row among its equals of the same salt."""
    parts = spread(rows.sparkSession)
    keyed = (rows.withColumn("digest", F.sha2("body", 256))
             .withColumn("head", F.substring("body", 1, SPLITTER_BYTES))
             .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")))
    ranged = keyed.repartitionByRange(parts, "head", "digest", "salt")
    run = Window.partitionBy("head", "digest", "salt", "body")
    return (ranged.withColumn("place", F.row_number().over(run.orderBy(_order(keep))))
            .withColumn("copies", F.count(F.lit(1)).over(run)))


def _merged(runs: DataFrame, keep: str) -> DataFrame:
    """The first of each run, ranked among the first rows of the other salts."""
    heads = runs.where("place = 1").repartition(spread(runs.sparkSession), "digest")
    group = Window.partitionBy("digest", "head", "body")
    ordered = group.orderBy(_order(keep), "salt")
    return (heads.withColumn("final", F.row_number().over(ordered))
            .withColumn("keep", F.first("id").over(ordered))
            .withColumn("total", F.sum("copies").over(group)))


def _rows(docs: DataFrame, text: str, id_column: str, normalise: Callable[[Column], Column]) -> list[Column]:
    return [F.col(f"`{id_column}`").alias("id"), normalise(whole_text(text)).cast("binary").alias("body")]


def copy_report(docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep: str = "smallest",
                normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """One row per document: its id, the id that stays, the group's size, whether it stays, SHA-256 of the text."""
    runs = _sorted_runs(docs.select(*_rows(docs, text, id_column, normalise)), keep)
    merged = _merged(runs, keep).select("digest", "salt", "final", "keep", "total")
    members = runs.select("id", F.col("digest").alias("own"), F.col("salt").alias("own_salt"), "place")
    # Null-safe, although neither is null: a filter that the join put below only one of the
    # two uses of the ranged rows would keep Spark from dealing them out once for both.
    same = F.col("own").eqNullSafe(F.col("digest")) & F.col("own_salt").eqNullSafe(F.col("salt"))
    return members.join(merged, same).select(
        F.col("id").alias(id_column), F.col("keep").alias("keep_id"), F.col("total").alias("group_size"),
        ((F.col("place") == 1) & (F.col("final") == 1)).alias("kept"), F.col("own").alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", id_column: str = "doc_id", keep: str = "smallest",
                normalise: Callable[[Column], Column] = unchanged) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = docs.select(*_rows(docs, text, id_column, normalise), all_columns(docs).alias("row"))
    return _merged(_sorted_runs(rows, keep), keep).where("final = 1").select("row.*")
