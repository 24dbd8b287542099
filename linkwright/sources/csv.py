"""CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.casts import na_tokens_to_null

# RFC 4180 quoting (doubled quotes, embedded newlines), as pandas reads and writes it.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def list_entries(spark: SparkSession, folder: str) -> list[str]:
    """Full paths of the entries directly inside ``folder`` (listing only,
    through Hadoop's FileSystem API so any store works)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(path))


def _stem(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name else name


_EXTRA = "_beyond_header"


def read_text_csv(spark: SparkSession, path: str, na_tokens: bool = True,
                  multi_line: bool = True) -> DataFrame:
    """A CSV file, or a folder of files of one header, as an all-text table in
    one scan: header row, no type inference, pandas' NA tokens become NULL (F17).

    A row with more fields than the header raises, as pandas does; a shorter
    one is filled with NULL. Quoted newlines are kept, which makes a file one
    task; without any, ``multi_line=False`` lets large files be split.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).option("inferSchema", "false").csv(path).columns
    schema = StructType([StructField(n, StringType(), True) for n in [*names, _EXTRA]])
    df = spark.read.options(**options).schema(schema).csv(path)
    too_long = F.raise_error(F.concat(F.lit(f"more fields than the header of {path}: "), F.col(f"`{_EXTRA}`")))
    df = df.where(F.when(F.col(f"`{_EXTRA}`").isNull(), True).otherwise(too_long.cast("boolean"))).drop(_EXTRA)
    return na_tokens_to_null(df) if na_tokens else df


def read_typed_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Typed CSV scan (S12): an explicit schema (preferred at scale: no
    detection pass) or, without one, the narrowest type that all values of a column have."""
    if schema is not None:
        return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    return cast_detected(read_text_csv(spark, path))


# The types a text column can have, narrowest first, with the form of a value (spaces around it
# do not count) and the SQL type. A column's type is the first one that all of its values have; bigint values
# are doubles too and dates are timestamps, so a mixed column widens; else it is text. Fixed values.
TYPE_FORMS = {
    "boolean": (r"(?i)^(true|false)$", "boolean"),
    "bigint": (r"^[+-]?[0-9]{1,18}$", "bigint"),
    "double": (r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$", "double"),
    "date": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "date"),
    "timestamp": (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?$", "timestamp"),
}


def type_counts(df: DataFrame) -> DataFrame:
    """One row per column of an all-text table: ``column_name, n_rows, n_null``, ``n_<type>`` (values that have
    that type) and ``detected`` (S12).

    One pass over all rows: the counts of every column are one aggregate, combined in the tasks before the
    shuffle, so type detection needs no sample and a value in the last row still widens its column. A column
    without values is ``string``, as is one whose values share no narrower type; the counts say which.
    """
    def cell(i: int, column: str) -> list[Column]:
        text = F.trim(F.col(f"`{column}`").cast("string"))
        found = [F.count_if(text.rlike(form) & text.try_cast(kind).isNotNull()).alias(f"c{i}_{name}")
                 for name, (form, kind) in TYPE_FORMS.items()]
        return [F.count_if(text.isNull()).alias(f"c{i}_null"), *found]

    sums = df.agg(F.count(F.lit(1)).alias("n_rows"), *[c for i, name in enumerate(df.columns) for c in cell(i, name)])
    rows = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(f"c{i}_null").alias("n_null"),
                              *[F.col(f"c{i}_{t}").alias(f"n_{t}") for t in TYPE_FORMS])
                     for i, name in enumerate(df.columns)])
    flat = sums.select("n_rows", F.inline(rows))
    values = F.col("n_rows") - F.col("n_null")
    detected = F.when(values == 0, "string")
    for name, (_, kind) in TYPE_FORMS.items():
        detected = detected.when(F.col(f"n_{name}") == values, kind)
    return flat.select("column_name", "n_rows", "n_null", *[f"n_{t}" for t in TYPE_FORMS],
                       detected.otherwise("string").alias("detected"))


def cast_detected(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """An all-text table with each column cast to its detected type (or to ``types``); text stays as it is."""
    if types is None:
        types = {r["column_name"]: r["detected"] for r in type_counts(df).collect()}   # one row per column
    return df.select(*[F.col(f"`{c}`") if types.get(c, "string") == "string"
                       else F.trim(F.col(f"`{c}`")).cast(types[c]).alias(c) for c in df.columns])


def load_csv_dump(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """One all-text table per entry of a folder whose name ends in ``csv``, as in
    the reference, named by its stem (M11). The entry is a file, or a folder of
    part files of one table, which is one scan however many parts there are. Files
    without quoted newlines are split into many tasks with ``multi_line=False``."""
    return {_stem(p): read_text_csv(spark, p, multi_line=multi_line)
            for p in list_entries(spark, folder) if p.rstrip("/")[-3:] == "csv"}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a table as CSV with a header, quoting like the reader expects."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def save_tables(tables: Mapping[str, DataFrame], base: str, mode: str = "errorifexists",
                fmt: str = "parquet") -> None:
    """Write each table under ``base/<name>``. The default fails when a target
    already exists (S11), like the reference's loader."""
    for name, df in tables.items():
        df.write.mode(mode).format(fmt).save(f"{base}/{name}")
