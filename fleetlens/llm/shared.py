"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import intermediate, scratch_path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder of ``spark.checkpoint.dir``."""
    return f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage,
    survives lost executors, and gives a later join an exchange on this side
    too, so that adaptive execution can split its hot keys."""
    spark = df.sparkSession
    path = intermediate(spark, shared_folder(spark, name))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and text columns alone, under fixed names: other columns of the
    input, whatever they are called, can't clash with ours."""
    rows, (id_, text) = numbered(docs, id_col, text_col)
    return rows.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def numbered(docs: DataFrame, *cols: str) -> tuple[DataFrame, list[str]]:
    """docs with its columns called c0, c1, ... by place, and the new names of
    the given ones: whatever the columns of a table are called (dots, quotes,
    blanks, names of ours, one name twice), nothing clashes. ``toDF`` with the
    old names undoes it."""
    names = [c.lower() for c in docs.columns]
    at = [docs.columns.index(c) if c in docs.columns else names.index(c.lower()) for c in cols]
    return docs.toDF(*(f"c{i}" for i in range(len(names)))), [f"c{i}" for i in at]


def apart(docs: DataFrame, id_col: str, text_col: str, **more: str) -> tuple[DataFrame, Callable[[DataFrame, Column], DataFrame]]:
    """(doc_id, same, text, rest, ...): ``same`` tells the texts of one id
    apart, ``rest`` is a struct of all columns but the text, so that a text
    goes to Python once; ``more`` names further columns, as strings. And a
    function that makes docs' own columns again from rows with ``rest`` and a
    column for the text."""
    rows, (id_, text_, *others) = numbered(docs, id_col, text_col, *more.values())
    text = F.col(text_).cast("string")
    rest = F.struct(*(c for c in rows.columns if c != text_)).alias("rest")
    named = [F.col(c).cast("string").alias(name) for c, name in zip(others, more)]
    rows = rows.select(F.col(id_).cast("long").alias("doc_id"), F.xxhash64(text).alias("same"), text.alias("text"), rest, *named)

    def whole(got: DataFrame, text: Column) -> DataFrame:
        own = docs.schema[int(text_[1:])].dataType
        return got.select(*(F.col(f"rest.c{i}") if f"c{i}" != text_ else text.cast(own) for i in range(len(docs.columns)))).toDF(*docs.columns)

    return rows, whole
