"""CSV, Parquet and JSON sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from brandlens.functions.text import na_to_null


# A whole quoted field, at the start of a line or after a comma; possessive, so long fields need no stack.
_QUOTED_FIELD = r'(^|,)"(?:[^"]++|"")*+"(?=,|$)'


def files_with_quoted_newlines(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files that must be read whole, because a line break stands inside quotes.

    A file starts outside of quotes, and a line whose quotes all belong to whole fields leaves it
    there. So the first line with a quote left over tells that its end may be inside one; no state
    is carried from line to line, and one pass over the splits decides. Stray quotes in bare
    fields count as such, too.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value").filter(F.col("value").contains('"'))
    left = lines.filter(F.regexp_replace("value", _QUOTED_FIELD, "$1").contains('"'))
    return [r.file for r in left.select("file").distinct().orderBy("file").collect()]  # names of files


def read_brand_csv(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """All-string CSV scan with header, in which the usual NA words are null.

    The column names come from the first header alone, so no inference pass over the data runs. A
    file whose header differs, and a line with too few or too many fields, stop the read.
    A file with quoted newlines is read in one task, any other is split. By default a pass over the
    lines tells them apart; True reads every file in one task and False splits all of them, both
    without that pass.
    """
    whole = files_with_quoted_newlines(spark, path) if multi_line is None else []

    def reader(by_file: bool) -> DataFrameReader:
        return (spark.read.option("multiLine", by_file)
                .option("quote", '"').option("escape", '"').option("inferSchema", False))

    header = reader(bool(multi_line or whole)).csv(path).first()
    names = [str(c).strip("\ufeff") for c in header] if header else []
    if not names:
        raise ValueError("The CSV holds no header.")
    duplicates = sorted({c for c in names if names.count(c) > 1})
    if duplicates:
        raise ValueError(f"CSV column names must be unique: {duplicates}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])

    def scan(by_file: bool) -> DataFrame:
        return reader(by_file).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").schema(schema).csv(path)

    if whole:
        # The file names prune the listing: no file is opened by both scans.
        file = F.col("_metadata.file_path")
        df = scan(False).filter(~file.isin(whole)).unionByName(scan(True).filter(file.isin(whole)))
    else:
        df = scan(bool(multi_line))
    return df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in names])


def require_rows(df: DataFrame) -> DataFrame:
    """Refuse an input without rows."""
    if df.isEmpty():
        raise ValueError("The input holds no rows.")
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a report or a result; CSV is UTF-8 with header and keeps text untouched."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        (writer.option("header", True).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    elif fmt == "json":
        writer.json(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"Unknown format {fmt!r}")


def read_json_object(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file with exactly one object, as a one-row frame."""
    df = spark.read.option("multiLine", True).option("mode", "FAILFAST").json(path)
    if len(df.limit(2).collect()) != 1:
        raise ValueError(f"Expected one JSON object in {path}")
    return df
