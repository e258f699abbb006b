"""Dataset profiling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .segments import quality_reasons


def profile_files(frames: list[DataFrame], columns: DataFrame | None = None, max_columns: int | None = None) -> DataFrame:
    """Per file - type, rows, and the NULL share of each column (or of the
    first ``max_columns`` ones), in long form (one row per file and column).
    ``columns`` (source_file, column_name) are the columns each file has (see
    ``raw_file_columns``); without it those of its format. One aggregate per
    format frame."""
    out = []
    for f in frames:
        cols = [c for c in f.columns if c != "source_file"][:max_columns]
        agg = f.groupBy("source_file").agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"n{i}") for i, c in enumerate(cols)],
        )
        stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_ratio")) for i, c in enumerate(cols)]))
        out.append(
            agg.select(
                "source_file",
                F.lower(F.regexp_extract("source_file", r"\.([A-Za-z0-9]+)$", 1)).alias("file_type"),
                "rows",
                stack.alias("c"),
            ).select("source_file", "file_type", "rows", "c.column_name", "c.null_ratio")
        )
    found = reduce(lambda a, b: a.unionByName(b), out)
    return found if columns is None else found.join(columns, ["source_file", "column_name"], "left_semi").select(*found.columns)


def first_rows(frames: list[DataFrame], n: int) -> list[DataFrame]:
    """M4: of each file the first ``n`` rows, as they were read. Every task
    hands on ``n`` rows a file at most before the files' rows meet."""
    first = Window.partitionBy("source_file").orderBy("_read")
    return [f.withColumn("_read", F.monotonically_increasing_id()).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= n).drop("_read", "_r") for f in frames]


def column_frequency(columns: DataFrame) -> DataFrame:
    """In how many files each (lower-cased) column appears, most common
    first; ``columns`` as of ``raw_file_columns``."""
    own = columns.select("source_file", F.lower("column_name").alias("column_name")).distinct()
    return own.groupBy("column_name").agg(F.count(F.lit(1)).alias("files")).orderBy(F.desc("files"), "column_name")


def schema_drift(columns: DataFrame) -> DataFrame:
    """Columns that some files have and others lack, with counts;
    ``columns`` as of ``raw_file_columns``."""
    own = columns.select("source_file", F.lower("column_name").alias("column_name")).distinct()
    files = own.agg(F.countDistinct("source_file").alias("n_files"))
    have = own.groupBy("column_name").agg(F.count(F.lit(1)).alias("files_with"))
    joined = have.withColumn("_k", F.lit(1)).join(F.broadcast(files.withColumn("_k", F.lit(1))), "_k")  # one row
    return joined.select("column_name", "files_with", (F.col("n_files") - F.col("files_with")).alias("files_without")).filter(F.col("files_without") > 0)


def file_health(spark, path: str) -> DataFrame:
    """Per raw file its bytes, its non-blank ``lines`` (0 for Parquet),
    the ``records`` that the readers take and those ``rejected``, the rejected
    lines among them (``bad_lines``), the ``error`` of a file that can't be
    read as a whole (a document that does not parse, an unreadable footer), and
    whether it is empty."""
    from ..sources.raw import EXT_GLOB, csv_records, json_records, read_parquet, rejected_records, text_lines

    # Spark's readers pass over files of no bytes, so the names and lengths
    # come from the listing, as any read makes one on the driver.
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed, found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True), []
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString()
        kind = name.lower().rpartition(".")[2]
        if kind in EXT_GLOB:
            found.append((name, kind, status.getLen()))
    files = spark.createDataFrame(found, "source_file string, file_type string, bytes long")
    taken, lines = [], []
    if (rows := csv_records(spark, path)) is not None:
        taken.append(rows[0].where("error is null"))
    if (rows := json_records(spark, path)) is not None:
        taken.append(rows.where("error is null"))
    if (rows := read_parquet(spark, path)) is not None:
        taken.append(rows)
    for kind in ("csv", "json"):
        if (rows := text_lines(spark, path, kind)) is not None:
            lines.append(rows)
    count = lambda frames, name: reduce(DataFrame.unionByName, (f.select("source_file") for f in frames)).groupBy("source_file").agg(F.count(F.lit(1)).alias(name))
    bad = rejected_records(spark, path).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rejected"), F.count_if(F.col("scope") == "line").alias("bad_lines"), F.min(F.when(F.col("scope") == "file", F.col("reason"))).alias("error")
    )
    rows = files.join(bad, "source_file", "left")
    for frames, name in ((taken, "records"), (lines, "lines")):
        rows = rows.join(count(frames, name), "source_file", "left") if frames else rows.withColumn(name, F.lit(0))
    rows = rows.select("source_file", "file_type", "bytes", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("lines", "records", "rejected", "bad_lines")), "error")
    return rows.withColumn("empty", (F.col("bytes") == 0) | ((F.col("lines") == 0) & (F.col("file_type") != "parquet")))


def quality_summary(silver_all: DataFrame) -> DataFrame:
    """Rows per quality reason (D17), plus the row total."""
    q = quality_reasons(silver_all)
    per = q.select(F.explode("quality_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    total = silver_all.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("all_rows").alias("reason"), "rows")
    return per.unionByName(total)
