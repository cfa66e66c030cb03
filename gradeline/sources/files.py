"""Raw CSV files as all-text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """CSV with a header, every column a string, nothing inferred.

    Quoted fields may hold line breaks and a doubled quote stands for one quote. With
    line breaks allowed a file cannot be split and is read by one task: deliver many
    files. ``multi_line=False`` reads files known to hold none in splits.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )


# A record of RFC 4180, where quotes appear only around fields and doubled inside.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",\r\n]*+)'
_RECORD_PATTERN = rf"^{_FIELD}(?:,{_FIELD})*+\z"
# Fixed value: no JVM string holds more, so no reader could return a longer record.
MAX_RECORD_BYTES = 2**31 - 1


def read_raw_csv_split(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same table as ``read_raw_csv``, reading every file in parallel splits.

    For files too big for one task each. A line break ends a record when an even number
    of quotes precedes it in its file, so each split only needs to know whether it starts
    inside a quoted field, which follows from the quote counts of the splits before it.
    That holds for RFC 4180 text; a record that is not raises an error, and its file
    has to be read with ``read_raw_csv``.

    The lines are shuffled once, by split. What crosses splits is one row per split and
    the text of the records that straddle one. A quote left open shows as a record longer
    than any string and is refused before its text is gathered.
    """
    names = read_raw_csv(spark, path).columns
    split_key = ["file", "block"]
    in_split = Window.partitionBy(*split_key).orderBy("at")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            quotes.alias("quotes"),
            F.endswith("value", F.lit("\r")).alias("ends_in_cr"),
        )
        .withColumns(
            {
                "line": F.row_number().over(in_split),
                "local": F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2,
            }
        )
    )
    joined = lines.join(_split_states(lines, split_key), split_key)
    starts = F.when((F.col("local") + F.col("inside")) % 2 == 0, F.col("line"))
    pieces = (
        joined.withColumn("record", F.max(starts).over(in_split))
        .groupBy(*split_key, "record", "open_block", "open_record", "crlf")
        .agg(_joined_in_order("line", "value").alias("text"))
    )

    continued = (
        pieces.filter(F.col("record").isNull())
        .groupBy("file", F.col("open_block").alias("head_block"), F.col("open_record").alias("head_record"))
        .agg(_joined_in_order("block", "text").alias("tail"))
    )
    heads = pieces.filter(F.col("record").isNotNull())
    whole = F.when(
        F.col("record") == F.col("head_record"), F.concat_ws("\n", "text", "tail")
    ).otherwise(F.col("text"))
    records = heads.join(
        continued.withColumnRenamed("head_block", "block"), split_key, "left"
    ).select(
        *split_key,
        "record",
        F.when(F.col("crlf"), F.regexp_replace(whole, r"\r(\n|\z)", "$1")).otherwise(whole).alias("text"),
    )
    is_header = (F.col("block") == 0) & (F.col("record") == 1)
    checked = F.when(F.col("text").rlike(_RECORD_PATTERN), F.col("text")).otherwise(
        F.raise_error(F.concat(F.lit("record is not RFC 4180, in file "), F.col("file")))
    )
    schema = ", ".join("`{}` string".format(name.replace("`", "``")) for name in names)
    parsed = F.from_csv(checked, schema, {"escape": '"'})
    return (
        records.filter(~is_header & (F.col("text") != ""))
        .select(parsed.alias("row"))
        .select("row.*")
    )


def _joined_in_order(order: str, text: str) -> Column:
    """The texts of a group as lines, in order."""
    ordered = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(ordered, lambda item: item[text]), "\n")


def _split_states(lines: DataFrame, split_key: list[str]) -> DataFrame:
    """Per split: does it start inside a quoted field, and which record is open then?

    Records start at lines with an even quote count before them. Within a split that is
    known up to the state it starts in, so the last start is kept for both states. The
    first line of a file tells whether its lines end in CR LF.
    """
    in_file = Window.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    first_line = (F.col("block") == 0) & (F.col("line") == 1)
    last_start = F.when(F.col("inside") == 0, F.col("last_even")).otherwise(F.col("last_odd"))
    return (
        lines.groupBy(*split_key)
        .agg(
            F.sum("quotes").alias("quotes"),
            F.max(F.when(F.col("local") == 0, F.col("line"))).alias("last_even"),
            F.max(F.when(F.col("local") == 1, F.col("line"))).alias("last_odd"),
            F.max(F.when(first_line, F.col("ends_in_cr"))).alias("ends_in_cr"),
        )
        .withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
        .withColumn("last_start", last_start)
        .select(
            *split_key,
            "inside",
            F.last(F.when(F.col("last_start").isNotNull(), F.col("block")), True)
            .over(earlier)
            .alias("open_block"),
            F.last("last_start", True).over(earlier).alias("open_record"),
            F.max("ends_in_cr").over(Window.partitionBy("file")).alias("crlf"),
            F.lag("last_start").over(in_file).isNull().alias("runs_through"),
        )
        .withColumn(
            "inside",
            F.when(
                F.col("runs_through") & (F.col("block") - F.col("open_block") > MAX_RECORD_BYTES),
                F.raise_error(F.concat(F.lit("record is not RFC 4180, quote left open in file "), "file")),
            ).otherwise(F.col("inside")),
        )
    )
