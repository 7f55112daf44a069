"""File sources and sinks with fixed schemas (no inference pass).

* text lines: one ``value`` column; gzip is not splittable, so the scan is
  repartitioned right away to spread the parse over the cluster;
* headered CSV: all columns as strings (cast later with ``try_cast``) or an
  explicit typed schema; malformed lines fail the read, or are kept apart by
  ``sources.quarantine``;
* headerless CSV: positional ``_c0.._cN`` strings renamed in one ``toDF``;
* result tables: CSV folders, or one ordered file, published by a rename;
* dictionaries: Parquet partitioned by ``column_name`` (partition pruning when
  one column's dictionary is read).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.encode import MAPPING_SCHEMA
from tessera.sources.quarantine import CSV_OPTIONS, as_schema, fail_on_bad, with_raw_line
from tessera.sources.tables import fresh_name, spread


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Text lines as ``value``; gzip files are one split each, so a read with
    too few splits is spread over the task slots before parsing."""
    df = spark.read.text(path)
    return df.repartition(partitions) if partitions else spread(df)


def write_lines(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """One-column string DataFrame -> text files (gzip by default)."""
    df.write.mode("overwrite").option("compression", compression).text(path)


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# NULL is written as this text, so that it differs from an empty string.
NULL_TEXT = "\\N"


def escape_lines(text: Column) -> Column:
    """Text without line ends: backslash, line feed and carriage return as two
    characters each."""
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape_lines(text: Column) -> Column:
    """What ``escape_lines`` was given."""
    parts = F.transform(F.split(text, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(parts, "\\")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
             multi_line: bool = False, null_text: str = NULL_TEXT, escaped: bool = False) -> DataFrame:
    """CSV with a given schema; a header line must name its columns. A line
    with too few or too many fields, or a field that is not of its type, fails
    the job: ``quarantine.read_checked_csv`` keeps such lines apart instead.
    ``multi_line`` reads line ends inside quotes, but a file is then one
    split: leave it off for large files. ``null_text`` is what stands for
    NULL (files of other origin often use the empty string). ``escaped`` undoes
    what ``write_csv`` did under that name."""
    schema = as_schema(schema)
    line = fresh_name([f.name for f in schema.fields], "csv_line")
    df = fail_on_bad(with_raw_line(spark, path, schema, line, header, multi_line, null_text), line)
    if not escaped:
        return df
    return df.select(*[unescape_lines(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else f.name for f in schema.fields])


def read_string_csv(spark: SparkSession, path: str, null_text: str = "") -> DataFrame:
    """Headered CSV with all columns as strings, named by the header (of the
    first file; the others must agree)."""
    names = spark.read.options(**CSV_OPTIONS).option("header", True).csv(path).columns
    return read_csv(spark, path, string_schema(names), null_text=null_text)


def read_named_csv(spark: SparkSession, path: str, types: dict[str, str], null_text: str = "") -> DataFrame:
    """The named columns of a headered CSV, typed; the header decides where they
    stand. Other columns are checked for their number only. A name that the
    header lacks is an error."""
    names = spark.read.options(**CSV_OPTIONS).option("header", True).csv(path).columns
    missing = [c for c in types if c not in names]
    if missing:
        raise ValueError(f"columns missing from the header of {path}: {missing}")
    schema = T.StructType([T.StructField(n, T.DataType.fromDDL(types.get(n, "string"))) for n in names])
    return read_csv(spark, path, schema, null_text=null_text).select(*types)


def read_positional_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Headerless CSV whose columns are known by position: read as strings
    named ``_c0..``, then renamed in one projection."""
    raw = read_csv(spark, path, string_schema([f"_c{i}" for i in range(len(names))]), header=False)
    return raw.toDF(*names)


def write_csv(df: DataFrame, path: str, header: bool = True, multi_line: bool = False, escaped: bool = False) -> None:
    """CSV that ``read_csv`` reads back unchanged. Text that would not survive
    (the NULL text itself; line ends, unless ``multi_line``) fails the job.
    With ``escaped`` line ends and backslashes are written as escapes, so any
    text survives and the files can still be split between lines."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if escaped:
        out = df.select(*[escape_lines(F.col(f.name)).alias(f.name) if f.name in texts else F.col(f.name) for f in df.schema.fields])
    elif texts:
        first = _refusing(texts, multi_line)
        out = df.select(*[first.alias(c) if c == texts[0] else F.col(c) for c in df.columns])
    else:
        out = df
    (out.write.mode("overwrite").options(**CSV_OPTIONS)
     .option("nullValue", NULL_TEXT).option("emptyValue", '""').option("quoteAll", True).option("header", header).csv(path))


def _refusing(names: list[str], multi_line: bool) -> Column:
    """The first of the columns, which fails the job where any of them holds
    text that CSV would not give back. One expression over an array of them: a
    check a column makes generated code too long for the JVM to compile."""
    def lost(v: Column) -> Column:
        bad = v == NULL_TEXT
        if not multi_line:
            bad = bad | F.contains(v, F.lit("\r")) | F.contains(v, F.lit("\n"))
        return F.coalesce(bad, F.lit(False))

    nth = F.array_position(F.transform(F.array(*names), lost), True)
    said = F.concat(F.lit("column "), F.element_at(F.array(*map(F.lit, names)), nth.cast("int")), F.lit(" holds text that CSV would not give back"))
    return F.when(nth > 0, F.raise_error(said)).otherwise(F.col(names[0]))


# A result file is meant to be read by people and scripts.
MAX_RESULT_ROWS = 1_000_000


def write_result_file(df: DataFrame, path: str, order_by: list[str | Column], max_rows: int = MAX_RESULT_ROWS,
                      header: bool = True, null_text: str = "") -> str:
    """Write a result table as the one CSV file ``path``, its rows in the given
    order. The table may have at most ``max_rows`` rows (checked before anything
    is written, as one task writes the file). The file appears complete, by a
    rename within its folder, and replaces an older one in the same step:
    readers never see a part of it, and a job that fails leaves what was there."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"more than {max_rows} rows do not go into one file")
    spark = df.sparkSession
    folder, _, name = path.rstrip("/").rpartition("/")
    hidden = f"{folder}/_{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    try:
        (df.repartition(1).sortWithinPartitions(*order_by).write.options(**CSV_OPTIONS).option("nullValue", null_text)
         .option("emptyValue", '""').option("header", header).csv(hidden))
        home = fs.Path(hidden).getFileSystem(conf)
        part = [f.getPath() for f in home.listStatus(fs.Path(hidden)) if f.getPath().getName().startswith("part-")]
        if len(part) != 1:  # a table without rows and a file per task otherwise
            raise RuntimeError(f"{len(part)} files were written, not one")
        replace = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        replace[0] = fs.Options.Rename.OVERWRITE
        fs.FileContext.getFileContext(part[0].toUri(), conf).rename(part[0], home.makeQualified(fs.Path(path)), replace)
    finally:
        fs.Path(hidden).getFileSystem(conf).delete(fs.Path(hidden), True)
    return path


def write_report(tables: dict[str, DataFrame], out_dir: str, fmt: str = "csv",
                 order_by: dict[str, list[str | Column]] | None = None) -> dict[str, str]:
    """Write each result table of an analysis to ``out_dir/<name>`` (CSV with
    a header, or Parquet); returns the paths. Result tables are small
    aggregates, but they are written by the executors like any table. Tables
    named in ``order_by`` become one ordered file, ``out_dir/<name>.csv``."""
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        if fmt == "csv" and name in (order_by or {}):
            path = write_result_file(df, f"{path}.csv", order_by[name])
        elif fmt == "csv":
            write_csv(df, path)
        else:
            df.write.mode("overwrite").format(fmt).save(path)
        paths[name] = path
    return paths


def write_mapping(mapping: DataFrame, path: str) -> None:
    """One folder per column, one file each (dictionaries are small next to
    the data they encode)."""
    mapping.repartition("column_name").write.mode("overwrite").partitionBy("column_name").parquet(path)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MAPPING_SCHEMA).parquet(path).select("column_name", "value", "id")
