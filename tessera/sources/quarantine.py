"""CSV whose faulty lines are kept apart instead of turning into NULLs.

One pass over the text writes a Parquet table with a partition of good rows and
one of bad lines; both are then read from there, columnar and pruned, and
cannot disagree. The written table also makes the outcome independent of what
is selected later: Spark's CSV reader converts only the fields a query asks
for, so a filter on its corrupt-record column lets faults in other fields pass.

A line is bad if

* ``quote``: a quoted field does not end,
* ``short`` / ``long``: it has fewer or more fields than the schema,
* ``type``: a field cannot be read as its column's type (``reasons`` names the
  columns),
* ``other``: the reader refuses it for another reason.

Every line has exactly one outcome, so the counts add up to the lines read;
empty lines are no rows, as everywhere in Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path
from tessera.sources.tables import fresh_name

CSV_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
OUTCOMES = ("good", "quote", "short", "long", "type", "other")


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def with_raw_line(spark: SparkSession, path: str, schema: T.StructType, line: str, header: bool = True,
                  multi_line: bool = False, null_text: str = "") -> DataFrame:
    """The file's columns and ``line``: the whole line where it is faulty, else
    NULL. A header must name the schema's columns in their order."""
    full = T.StructType([*schema.fields, T.StructField(line, T.StringType(), True)])
    return (spark.read.schema(full).options(**CSV_OPTIONS).option("nullValue", null_text).option("header", header)
            .option("enforceSchema", False).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", line).csv(path))


def _unquoted(line: Column) -> Column:
    """The line without what stands in quotes."""
    return F.regexp_replace(line, r'(?:(?<=^)|(?<=,))"(?:[^"]|"")*+"(?=,|$)', "")


def field_count(line: str | Column) -> Column:
    """Fields of a line: separators outside quotes, and one."""
    bare = _unquoted(F.col(line) if isinstance(line, str) else line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _reasons(schema: T.StructType, line: str, null_text: str) -> Column:
    """What is wrong with a bad line, as an array."""
    n = field_count(line)
    texts = T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(len(schema))])
    options = {**{k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_OPTIONS.items()}, "nullValue": null_text}
    fields = F.from_csv(line, texts.simpleString()[len("struct<"):-1].replace(":", " "), options)
    untyped = [F.when(fields[f"c{i}"].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f"type:{f.name}"))
               for i, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)]
    size = (F.when(_unquoted(F.col(line)).rlike('(?:^|,)"'), F.lit("quote"))
            .when(n < len(schema), F.lit("short")).when(n > len(schema), F.lit("long")))
    return F.array_compact(F.array(size, *untyped))


def _outcome(line: str, reasons: str) -> Column:
    first = F.get(F.col(reasons), F.lit(0))
    return (F.when(F.col(line).isNull(), F.lit("good")).when(first.isNull(), F.lit("other"))
            .when(first.startswith("type:"), F.lit("type")).otherwise(first))


@dataclass(frozen=True)
class CheckedCsv:
    """The written table and how its columns are named."""
    table: DataFrame
    columns: list[str]
    line: str
    reasons: str
    outcome: str

    @property
    def good(self) -> DataFrame:
        """Rows of the schema."""
        return self.table.filter(F.col(self.outcome) == "good").select(*[f"`{c}`" for c in self.columns])

    @property
    def bad(self) -> DataFrame:
        """(line, outcome, reasons, n_fields) of the lines that are no rows."""
        return self.table.filter(F.col(self.outcome) != "good").select(
            F.col(self.line).alias("line"), F.col(self.outcome).alias("outcome"), F.col(self.reasons).alias("reasons"),
            field_count(self.line).alias("n_fields"))

    def counts(self) -> DataFrame:
        """(outcome, n): every outcome that occurs; the sum is the file's rows."""
        return self.table.groupBy(F.col(self.outcome).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))

    def type_faults(self) -> DataFrame:
        """(column_name, n): how many lines fail in which column."""
        each = self.bad.select(F.explode("reasons").alias("reason")).filter(F.col("reason").startswith("type:"))
        return each.groupBy(F.substring("reason", len("type:") + 1, 1_000_000).alias("column_name")).agg(F.count(F.lit(1)).alias("n"))

    def good_or_fail(self, most: int = 0) -> DataFrame:
        """The good rows, if at most ``most`` lines are bad."""
        n = self.bad.count()
        if n > most:
            raise ValueError(f"{n} malformed lines, {most} allowed")
        return self.good


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                     multi_line: bool = False, null_text: str = "", out: str | None = None) -> CheckedCsv:
    """Read a CSV once, good rows and bad lines apart. ``out`` is where the
    table is kept (a fresh folder of the shared scratch space by default)."""
    schema = as_schema(schema)
    names = [f.name for f in schema.fields]
    line, reasons, outcome = (fresh_name(names, c) for c in ("csv_line", "csv_reasons", "csv_outcome"))
    raw = with_raw_line(spark, path, schema, line, header, multi_line, null_text)
    none = F.lit(None).cast("array<string>")
    marked = raw.withColumn(reasons, F.when(F.col(line).isNotNull(), _reasons(schema, line, null_text)).otherwise(none))
    out = out or scratch_path(spark, "checked-csv")
    marked.withColumn(outcome, _outcome(line, reasons)).write.mode("overwrite").partitionBy(outcome).parquet(out)
    full = T.StructType([*schema.fields, T.StructField(line, T.StringType()), T.StructField(reasons, T.ArrayType(T.StringType())),
                         T.StructField(outcome, T.StringType())])
    return CheckedCsv(spark.read.schema(full).parquet(out), names, line, reasons, outcome)


def fail_on_bad(df: DataFrame, line: str) -> DataFrame:
    """The rows without the ``line`` column; a faulty one fails the job. The
    message names all columns, so that every field is read and checked, whatever
    the query selects."""
    names = [c for c in df.columns if c != line]
    said = F.concat_ws(" | ", F.lit("malformed line"), F.col(line), F.lit("read as"), *[F.col(f"`{c}`").cast("string") for c in names])
    return df.filter(F.when(F.col(line).isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean"))).drop(line)
