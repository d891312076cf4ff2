"""Corpus files: CSV in and out, landed Parquet, size guard, text dump."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.schemas import CORPUS_COLUMNS, CORPUS_SCHEMA, MIN_FILE_BYTES, NA_TOKENS
from newsloom.sources.csv_ranges import RANGE_BYTES, fixed_ranges, read_ranges


def read_csv(spark, path, schema=CORPUS_SCHEMA, na_tokens=NA_TOKENS) -> DataFrame:
    """Full CSV scan with quoted newlines and doubled quotes.

    Columns are taken by the names in the header: a missing one is null, others
    are left out, and ``profile.schema_check`` of ``read_any_csv`` tells which.
    The texts in ``na_tokens`` read as null. A missing path raises
    PATH_NOT_FOUND. Here one task reads a file; ``land`` reads a large one in
    many.
    """
    raw = read_any_csv(spark, path)
    return raw.select(*_conformed(raw, schema, na_tokens))


def _conformed(raw, schema, na_tokens):
    """The columns of a schema, from those that a header names."""
    tokens = list(na_tokens)

    def column(name):
        if name not in raw.columns:
            return F.lit(None).cast("string").alias(name)
        c = F.col(f"`{name}`")
        return F.when(~c.isin(tokens), c).alias(name)

    return [column(field.name) for field in schema]


def read_any_csv(spark, path) -> DataFrame:
    """CSV with the columns the header names, all strings, for a schema check."""
    return (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )


def land(
    spark, csv_path, parquet_path, schema=CORPUS_SCHEMA, na_tokens=NA_TOKENS, range_bytes=RANGE_BYTES,
) -> DataFrame:
    """CSV to Parquet once, with the file order kept as (source_file, ord).

    Files are read in byte ranges, so that one large file is the work of many tasks.
    """
    names = read_any_csv(spark, csv_path).columns  # of the header; nothing else is read
    raw = read_ranges(spark, csv_path, names, range_bytes)
    df = raw.select(*_conformed(raw, schema, na_tokens), "source_file", "ord")
    with fixed_ranges(spark, range_bytes):
        df.write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def write_csv(df: DataFrame, path, columns=None) -> None:
    """Export; the default keeps every column. Reading back gives the same rows."""
    df = df.select(*columns) if columns else df
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path, mode="overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_cleaned(cleaned: DataFrame, folder, columns=CORPUS_COLUMNS) -> None:
    """Three tables: cleaned (flagged rows included), flagged short, flagged long.

    The cleaned table is written first and the flagged ones are read from it,
    so the cleaning runs once.
    """
    cleaned.write.mode("overwrite").parquet(f"{folder}/cleaned")
    done = cleaned.sparkSession.read.parquet(f"{folder}/cleaned")
    done.filter("is_short").select(*columns).write.mode("overwrite").parquet(f"{folder}/flagged_short")
    done.filter("is_long").select(*columns).write.mode("overwrite").parquet(f"{folder}/flagged_long")


def undersized_files(spark, path, floor=MIN_FILE_BYTES) -> DataFrame:
    """Landed files below the size floor; advisory, content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length").filter(F.col("length") < floor)


def file_sizes(spark, path) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", (F.col("length") / 1e6).alias("size_mb"))


def dump_text(df: DataFrame, path, column="text_original") -> None:
    """The texts of the given rows as plain text."""
    df.select(F.coalesce(F.col(column), F.lit(""))).write.mode("overwrite").text(path)
