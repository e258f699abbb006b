"""Raw file sources: mixed CSV / JSON / Parquet folders, JSON in any of its
three shapes, nested objects flattened to dotted names (S1-S6, U1)."""

from __future__ import annotations

import csv
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..session import materialize

EXT_GLOB = {
    "csv": "*.[cC][sS][vV]",
    "json": "*.[jJ][sS][oO][nN]",
    "parquet": "*.[pP][aA][rR][qQ][uU][eE][tT]",
}


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields become top-level columns named by their dotted
    path (``msgBusWayPoint.vehicle``); arrays stay as they are."""

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            yield path

    cols = []
    for f in df.schema.fields:
        for path in walk(f.dataType, [f.name]):
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def _with_source(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def _reader(spark: SparkSession, fmt: str, kind: str):
    """A recursive reader of one format over the files of one kind."""
    return spark.read.format(fmt).option("recursiveFileLookup", "true").option("pathGlobFilter", EXT_GLOB[kind])


def text_lines(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """(source_file, at, i, line): the lines with a character of all files of
    one kind, without byte-order marks; ``at`` is where the line's split of
    the file begins, ``i`` rises within a split. None without such files."""
    try:
        lines = _reader(spark, "text", kind).load(path)
    except AnalysisException as exc:  # nothing of this kind under the path
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise
    line = F.replace("value", F.lit("\ufeff"), F.lit(""))
    own = lines.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("i"), line.alias("line"))
    return own.where(F.trim("line") != "")


def _first_lines(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """(source_file, line): the first line with a character of each file, from
    one distributed text pass; None when there is no such file."""
    lines = text_lines(spark, path, kind)
    return None if lines is None else lines.groupBy("source_file").agg(F.min_by("line", F.struct("at", "i")).alias("line"))


def _unite(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _as_text(df: DataFrame) -> DataFrame:
    """Files may disagree on a column's type; unite as text, type later."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def _header_names(line: str) -> list[str]:
    return [c.strip() for c in next(csv.reader([line]))]


def csv_headers(spark: SparkSession, path: str) -> DataFrame | None:
    """(source_file, line): each CSV file's header; None without such files."""
    return _first_lines(spark, path, "csv")


def csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, list[str]]] | None:
    """Every CSV row by position (c0, c1, ...) with its file, its file's header
    ``line``, and in ``error`` why it is no row of that file; and the distinct
    headers (layouts, not files, reach the driver)."""
    headers = csv_headers(spark, path)
    if headers is None:
        return None
    headers = materialize(headers, "csv-headers")
    layouts = {r.line: _header_names(r.line) for r in headers.select("line").distinct().collect()}
    if not layouts:  # files without a line
        return None
    width = max(len(names) for names in layouts.values())
    # One column more than any header has: what lies behind a row's header.
    kind = ", ".join(f"c{i} string" for i in range(width + 1)) + ", _raw string"
    rows = _with_source(_reader(spark, "csv", "csv").schema(kind).option("header", "true").option("columnNameOfCorruptRecord", "_raw").load(path))
    rows = rows.withColumn("place", F.col("_metadata.file_block_start"))
    if len(layouts) > 1:
        rows = rows.join(headers, "source_file")
    else:
        rows = rows.withColumn("line", F.lit(next(iter(layouts))))
    behind = [(F.col("line") == line) & F.coalesce(*(F.col(f"c{i}") for i in range(len(names), width + 1))).isNotNull() for line, names in layouts.items()]
    more = behind[0]
    for x in behind[1:]:
        more = more | x
    # The reader gives the text only of rows whose length is not the schema's.
    text = F.coalesce("_raw", F.to_csv(F.struct(*(f"c{i}" for i in range(width + 1)))))
    return rows.withColumns({"error": F.when(more, F.lit("more fields than the header")), "_raw": F.when(more, text)}), layouts


def read_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """Every CSV file by its own header, united by column name, all text.

    All files are parsed in one read, by position; a file's layout, joined on
    its name, tells which position is which column. Rows with more fields than
    their header are left out (``rejected_records`` lists them)."""
    found = csv_records(spark, path)
    if found is None:
        return None
    rows, layouts = found
    columns: dict[str, list] = {}
    for line, names in layouts.items():
        for i, name in enumerate(names):
            columns.setdefault(name, []).append(F.when(F.col("line") == line, F.col(f"c{i}")))
    return rows.where("error is null").select(*(F.coalesce(*own).alias(name) for name, own in columns.items() if name), "source_file")


# --------------------------------------------------------------------- JSON


def json_records(spark: SparkSession, path: str) -> DataFrame | None:
    """Every JSON record under ``path``: (source_file, place, scope, raw,
    record, error), ``record`` a VARIANT, ``scope`` a line, an element or the
    whole file. A file whose first line is a whole object is
    JSON lines, each line a record. Any other file is one document: an array,
    whose elements are records, or an object over several lines. What does not
    parse, or is no object, has an ``error`` and no record. No file name
    leaves the tasks; a document is put together from its lines in one task.
    What shape a file has is written first, so that the lines of JSON lines
    need not meet by file."""
    lines = text_lines(spark, path, "json")
    if lines is None:
        return None
    whole = F.col("line").rlike(r"^\s*\[") | F.try_parse_json("line").isNull()
    shapes = materialize(_first_lines(spark, path, "json").select("source_file", whole.alias("whole")), "json-shapes")
    lines = lines.withColumnRenamed("line", "raw").join(shapes, "source_file")
    place, record = F.struct("at", "i").alias("place"), F.try_parse_json("raw")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "i", "raw"))), lambda x: x["raw"]), "\n")
    single = lines.where("not whole").select("source_file", place, F.lit("line").alias("scope"), "raw", record.alias("v"), F.col("raw").rlike(r"^\s*\{").alias("object"))
    docs = lines.where("whole").groupBy("source_file").agg(text.alias("raw"), F.min(F.struct("at", "i")).alias("place")).withColumn("v", record)
    parsed = F.col("v").isNotNull()
    parts = F.when(F.trim("raw").startswith("["), F.expr("try_cast(v as array<variant>)")).otherwise(F.array("v"))
    # A document's text goes along only where it does not parse.
    docs = docs.select("source_file", "place", F.when(parsed, F.lit("element")).otherwise(F.lit("file")).alias("scope"), F.when(~parsed, F.col("raw")).alias("raw"), F.explode_outer(F.when(parsed, parts)).alias("v")).withColumn("object", F.schema_of_variant("v").startswith("OBJECT"))
    # An array without elements has no record, and nothing is wrong with it.
    rows = single.unionByName(docs.where("scope = 'file' or v is not null"))
    error = F.when(F.col("v").isNull(), F.lit("not JSON")).when(~F.col("object"), F.lit("not an object"))
    return rows.withColumn("error", error).select("source_file", "place", "scope", F.coalesce("raw", F.to_json("v")).alias("raw"), F.when(F.col("error").isNull(), F.col("v")).alias("record"), "error")


_TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BOOLEAN": T.BooleanType()}


def variant_type(text: str) -> T.DataType:
    """The type that a variant's schema text (``OBJECT<a: BIGINT, ...>``)
    stands for: objects are structs, fractions doubles; what is always null,
    or of kinds that don't agree, is text."""

    def read(at: int) -> tuple[T.DataType, int]:
        word = re.compile(r"[A-Z]+(\(\d+,\s*\d+\))?").match(text, at)
        at = word.end()
        if word[0] == "OBJECT":
            fields, at = [], at + 1
            while text[at] != ">":
                if text[at] == "`":
                    end = at + 1
                    while text[end : end + 2] == "``" or text[end] != "`":
                        end += 2 if text[end : end + 2] == "``" else 1
                    name, at = text[at + 1 : end].replace("``", "`"), end + 1
                else:
                    end = text.index(":", at)
                    name, at = text[at:end], end
                kind, at = read(at + 2)
                fields.append(T.StructField(name, kind))
                at += 2 if text[at] == "," else 0
            return T.StructType(fields), at + 1
        if word[0] == "ARRAY":
            kind, at = read(at + 1)
            return T.ArrayType(kind), at + 1
        if word[0].startswith("DECIMAL"):
            p, s = map(int, re.findall(r"\d+", word[0]))
            return (T.DoubleType() if s else T.LongType() if p < 19 else T.DecimalType(p, 0)), at
        return _TYPES.get(word[0], T.StringType()), at

    return read(0)[0]


def leaf_names(kind: T.DataType, path: tuple[str, ...] = ()) -> list[str]:
    """Dotted names of the leaves of nested objects."""
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields for x in leaf_names(f.dataType, (*path, f.name))]
    return [".".join(path)]


def read_json_flexible(spark: SparkSession, path: str, mode: str = "DROPMALFORMED") -> DataFrame | None:
    """S3: JSON in any shape (see ``json_records``), typed by the schema that
    all records have together. What is no record is dropped, kept as a row of
    NULLs (``PERMISSIVE``) or raised (``FAILFAST``), as the parse ``mode``
    says."""
    records = json_records(spark, path)
    if records is None:
        return None
    if mode.upper() == "FAILFAST":
        fail = F.raise_error(F.concat(F.lit("malformed JSON record in "), F.col("source_file")))
        records = records.withColumn("record", F.when(F.col("error").isNotNull(), fail.cast("variant")).otherwise(F.col("record")))
    elif mode.upper() != "PERMISSIVE":
        records = records.where("error is null")
    text = records.agg(F.schema_of_variant_agg("record")).first()[0]
    kind = variant_type(text) if text else None
    if not isinstance(kind, T.StructType) or not kind.fields:
        return None
    return records.select(F.variant_get("record", "$", _ddl(kind)).alias("r"), "source_file").select("r.*", "source_file")


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind.fields) + ">"
    return f"array<{_ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()


# ------------------------------------------------------------------ Parquet


def _footer(batches):
    import json

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    def leaves(fields, path=()):
        for f in fields:
            own = [*path, f.name]
            yield from leaves(f.type, own) if pa.types.is_struct(f.type) else [(own, str(f.type))]

    for batch in batches:
        out = {"source_file": [], "layout": [], "error": []}
        for name in batch.column(0).to_pylist():
            layout = error = None
            try:
                # What Spark calls file:/x is /x to other readers.
                store, at = fs.FileSystem.from_uri(re.sub(r"^file:(?=/(?!/))", "", name))
                layout = json.dumps(list(leaves(pq.read_schema(at, filesystem=store))))
            except (OSError, ValueError) as exc:  # no Parquet file; others are read
                error = str(exc).splitlines()[0][:200]
            for c, x in zip(out.values(), (name, layout, error)):
                c.append(x)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.string()) for c in out]))


def parquet_layouts(spark: SparkSession, path: str) -> DataFrame | None:
    """(source_file, layout, error) of every Parquet file, from its footer,
    read in tasks: ``layout`` is a JSON list of (path, type) of its columns;
    a file without a readable footer has an ``error``. None without files."""
    try:
        files = _reader(spark, "binaryFile", "parquet").load(path).select("path")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise
    return files.mapInArrow(_footer, "source_file string, layout string, error string")


#: Which of two kinds a column widens to, smallest first.
WIDER = ["int8", "int16", "int32", "int64", "float", "double"]


def wider(kinds: list[str]) -> str:
    """The Spark type that holds all of the given Parquet column types: of
    whole numbers and fractions the widest, of dates and times a timestamp,
    of all else text."""
    if all(k in WIDER for k in kinds):
        widest = max(kinds, key=WIDER.index)
        fraction = any(k in ("float", "double") for k in kinds)
        return "double" if fraction and (widest == "double" or any(k in ("int32", "int64") for k in kinds)) else {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint"}.get(widest, "float")
    if all(k.startswith(("date32", "timestamp")) for k in kinds):
        return "timestamp"
    return "string"


def read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """Every Parquet file, columns united by name, nested ones by dotted
    path. Files of one layout are one read; where layouts disagree on a
    column's type it is widened (``wider``). The plan grows with the layouts,
    not with the files. Files without a readable footer are left out
    (``rejected_records`` lists them)."""
    import json

    footers = parquet_layouts(spark, path)
    if footers is None:
        return None
    footers = materialize(footers, "parquet-layouts")
    each = [json.loads(r.layout) for r in footers.where("layout is not null").select("layout").distinct().collect()]
    if not each:
        return None
    kinds: dict[str, set[str]] = {}
    for layout in each:
        for names, kind in layout:
            kinds.setdefault(".".join(names), set()).add(kind)
    clash = {name: wider(sorted(k)) for name, k in kinds.items() if len(k) > 1}
    broken = footers.where("error is not null").limit(1).count()
    if not clash and not broken:
        return _with_source(_reader(spark, "parquet", "parquet").option("mergeSchema", "true").load(path))
    frames = []
    for layout in each:  # the files of a layout by name, as a listing gives them
        names = [r.source_file for r in footers.where(F.col("layout") == json.dumps(layout)).select("source_file").collect()]
        own = flatten_struct(_with_source(spark.read.parquet(*names)))
        frames.append(own.select(*(F.col(f"`{c}`").cast(clash[c]).alias(c) if c in clash else F.col(f"`{c}`") for c in own.columns)))
    return _unite(frames)


# ----------------------------------------------------- columns and rejects


def _names_of(parse):
    """(source_file, text) -> a row per column name that ``parse`` finds."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            pairs = [(f, c) for f, text in zip(*(x.to_pylist() for x in batch.columns)) for c in dict.fromkeys(parse(text)) if c]
            yield pa.RecordBatch.from_pydict({"source_file": [p[0] for p in pairs], "column_name": [p[1] for p in pairs]}, schema=pa.schema([("source_file", pa.string()), ("column_name", pa.string())]))

    return run


def _layout_names(text: str) -> list[str]:
    import json

    return [".".join(names) for names, _ in json.loads(text)]


def raw_file_columns(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, column_name): the columns that each raw file itself has,
    values or not: a CSV file's header, the keys of a JSON file's records, a
    Parquet file's footer; nested ones by dotted path."""
    found = []
    headers = csv_headers(spark, path)
    if headers is not None:
        found.append((headers, _header_names))
    records = json_records(spark, path)
    if records is not None:
        kinds = records.where("error is null").groupBy("source_file").agg(F.schema_of_variant_agg("record").alias("text"))
        found.append((kinds, lambda text: leaf_names(variant_type(text))))
    footers = parquet_layouts(spark, path)
    if footers is not None:
        found.append((footers.where("layout is not null").select("source_file", "layout"), _layout_names))
    if not found:
        raise FileNotFoundError(f"no CSV, JSON or Parquet files under {path}")
    return _unite([df.mapInArrow(_names_of(parse), "source_file string, column_name string") for df, parse in found])


def rejected_records(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, file_type, place, scope, reason, raw): what the readers
    leave out. JSON lines, elements and documents that do not parse or are no
    objects, CSV rows with more fields than their header, Parquet files without
    a readable footer. ``place`` is where the split of the file begins,
    ``scope`` says whether a line, an element or the whole file is meant."""
    out = []
    add = lambda rows, kind, place, scope, reason, raw: out.append(rows.where("error is not null").select("source_file", F.lit(kind).alias("file_type"), place.cast("long").alias("place"), scope.alias("scope"), reason.alias("reason"), raw.cast("string").alias("raw")))
    if (found := csv_records(spark, path)) is not None:
        add(found[0], "csv", F.col("place"), F.lit("line"), F.col("error"), F.col("_raw"))
    if (found := json_records(spark, path)) is not None:
        add(found, "json", F.col("place.at"), F.col("scope"), F.col("error"), F.col("raw"))
    if (found := parquet_layouts(spark, path)) is not None:
        add(found, "parquet", F.lit(0), F.lit("file"), F.lit("no readable footer"), F.lit(None))
    if not out:
        raise FileNotFoundError(f"no CSV, JSON or Parquet files under {path}")
    return _unite(out)


def read_raw_frames(spark: SparkSession, path: str, json_mode: str = "DROPMALFORMED", flatten: bool = True) -> list[DataFrame]:
    """One DataFrame per file format found under ``path`` (each with its own
    columns), flattened, all columns as text, with ``source_file``."""
    frames = [f for f in (read_csv(spark, path), read_json_flexible(spark, path, json_mode), read_parquet(spark, path)) if f is not None]
    if not frames:
        raise FileNotFoundError(f"no CSV, JSON or Parquet files with rows under {path}")
    return [_as_text(flatten_struct(f) if flatten else f) for f in frames]


def read_raw(spark: SparkSession, path: str, json_mode: str = "DROPMALFORMED", flatten: bool = True) -> DataFrame:
    """Every CSV, JSON and Parquet file under ``path``
    (recursive, extension case-insensitive), columns united by name with
    missing ones NULL, nested objects flattened, and ``source_file``. All
    columns are text; typing is done by ``map_schema``."""
    return _unite(read_raw_frames(spark, path, json_mode, flatten))


def read_mapped(spark: SparkSession, path: str, candidates=None, mapping: DataFrame | None = None, json_mode: str = "DROPMALFORMED") -> DataFrame:
    """Raw files to normalized events, each row by its own file's names."""
    from ..operators.normalize import map_schema
    from ..settings import Candidates

    return map_schema(read_raw(spark, path, json_mode), candidates or Candidates(), mapping)
