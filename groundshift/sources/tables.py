"""CSV samples, growth metrics and scene metadata."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from groundshift import config as c
from groundshift.config import DASHBOARD_COLUMNS, METRICS_SCHEMA, SAMPLE_COLUMNS, SAMPLE_SCHEMA  # noqa: F401
from groundshift.operators.small import sized


def read_samples_csv(spark: SparkSession, paths, schema: str | None = None) -> DataFrame:
    """CSV with a header; types are inferred unless a schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(paths)


def write_csv(df: DataFrame, path: str, selectors: list[str]) -> None:
    """CSV with exactly these columns in this order."""
    df.select(*selectors).write.mode("overwrite").option("header", True).csv(path)


def read_samples_tolerant(spark: SparkSession, paths, required: list[str] = DASHBOARD_COLUMNS) -> DataFrame:
    """The required columns, as text, of every sound file that has them all.

    One pass gives every file a verdict (``audit``); unfit files leave whole. The
    lines of the others are joined with their file's header and parsed by it, so
    files of all layouts are read together and no list of files is kept anywhere.
    Blank lines and repeats of the header are no rows; a row with fewer fields than
    the header ends in missing ones.
    """
    lines = _lines(spark, paths)
    good, small = sized(audit(spark, paths, required, lines).where("verdict = 'good'").select("path", "header", "width"))
    width = good.agg(F.max("width")).first()[0]
    empty = ", ".join(f"`{n}` string" for n in required)
    if width is None:
        return spark.createDataFrame([], empty)
    schema = ", ".join(f"c{i} string" for i in range(width))

    def fields(line: Column) -> Column:
        return F.from_csv(line, F.lit(schema))

    names = [f"c{i}" for i in range(width)]
    at = good.withColumn("f", fields(F.col("header"))).withColumn("f", F.array(*[F.col(f"f.{n}") for n in names]))
    at = at.select("path", "header", *[F.array_position("f", n).cast("int").alias(f"at{i}") for i, n in enumerate(required)])
    rows = lines.where("line <> ''").join(F.broadcast(at) if small else at, "path").where("line <> header")
    rows = rows.withColumn("f", fields(F.col("line"))).withColumn("f", F.array(*[F.col(f"f.{n}") for n in names]))
    return rows.select(*[F.element_at("f", F.col(f"at{i}")).alias(n) for i, n in enumerate(required)])


def _lines(spark: SparkSession, paths) -> DataFrame:
    """``path, block, octets, valid, line``: what can be read of all files, line by line."""
    text = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).option("lineSep", "\n").text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.octet_length("value").alias("octets"),
        F.is_valid_utf8("value").alias("valid"),
        F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"),
    )


def audit(spark: SparkSession, paths, required: list[str], lines: DataFrame | None = None) -> DataFrame:
    """``path, header, width, verdict`` of every file that can be opened.

    ``header`` is the first line that is not blank; only the block of a file that
    begins it is asked for it. Verdicts, the first that applies: ``damaged`` (bytes
    that are no text, a quotation mark without its partner, so also a quoted line
    break; a gzip file that gives fewer or more octets than its end says, as one
    that is cut off or joined from several does), ``empty``, ``ragged`` (a row with
    more fields than the header), ``columns`` (a required column is missing), ``good``.
    """
    lines = _lines(spark, paths) if lines is None else lines
    bare = F.regexp_replace("line", '"[^"]*"', "")
    lines = lines.withColumn("bare", bare).withColumn("wide", F.length("bare") - F.length(F.replace("bare", F.lit(","))) + 1)
    seen = lines.groupBy("path").agg(
        F.first(F.when((F.col("block") == 0) & (F.col("line") != ""), F.col("line")), ignorenulls=True).alias("header"),
        F.max(F.when(F.col("line") != "", F.col("wide"))).alias("widest"),
        F.bool_or(~F.col("valid") | F.contains("bare", F.lit('"'))).alias("broken"),
        F.sum("octets").alias("octets"),
        F.count("*").alias("n"),
    )
    ends = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(paths).select(
        F.col("_metadata.file_path").alias("path"), F.hex(F.expr("substring(content, -4, 4)")).alias("tail")
    )
    swapped = F.concat(*[F.substring("tail", k, 2) for k in (7, 5, 3, 1)])
    seen = seen.join(ends.select("path", F.conv(swapped, 16, 10).cast("bigint").alias("said")), "path", "left")
    # every line but perhaps the last ends in a line break, which is no part of it
    whole = F.col("said").isin(*[(F.col("octets") + F.col("n") - k) % (1 << 32) for k in (0, 1)])
    width = F.length(F.regexp_replace("header", '"[^"]*"', "")) - F.length(F.replace(F.regexp_replace("header", '"[^"]*"', ""), F.lit(","))) + 1
    have = F.split(F.regexp_replace("header", '"', ""), ",")
    verdict = (
        F.when(F.col("broken") | (F.col("said").isNotNull() & ~whole), "damaged")
        .when(F.col("header").isNull(), "empty")
        .when(F.col("widest") > width, "ragged")
        .when(~F.forall(F.array(*map(F.lit, required)), lambda n: F.array_contains(have, n)), "columns")
        .otherwise("good")
    )
    return seen.select("path", "header", width.cast("int").alias("width"), verdict.alias("verdict"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table; empty, with the same columns, if there is none."""
    try:
        return spark.read.schema(METRICS_SCHEMA).option("header", True).csv(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], METRICS_SCHEMA)


def write_scenes(scenes: DataFrame, path: str) -> None:
    """Scene metadata, one folder per sensor collection."""
    scenes.write.mode("overwrite").partitionBy("collection").parquet(path)


def scan_scenes(spark: SparkSession, path: str, year: int) -> DataFrame:
    """Scenes of the sensor that serves an epoch; only its folder is read."""
    if year not in c.SENSORS:
        raise ValueError(f"unsupported year: {year}; use one of {sorted(c.SENSORS)}")
    return spark.read.parquet(path).where(F.col("collection") == c.SENSORS[year])
