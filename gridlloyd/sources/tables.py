"""Tables: headered CSV, Parquet, and result sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

NULL_TEXT = "None"
#: Texts that CSV files have for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Headered CSV. Giving a schema saves the extra pass that finds the types.

    The texts of ``MISSING`` are nulls. Without a schema a column is BIGINT or DOUBLE if all its other
    values are such numbers, else STRING: a literal ``?`` makes its column categorical. A line with more
    or fewer fields than the header is an error.
    """
    if not path.rstrip("/").endswith(".csv"):
        raise ValueError(f"the dataset must be a .csv path, not {path}")
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    names = reader.option("inferSchema", False).csv(path).columns
    # Declared as text, so that the reader counts the fields of every line.
    texts = reader.option("enforceSchema", True).schema(
        StructType([StructField(n, StringType()) for n in names])).csv(path)
    columns = [F.col(f"`{n}`") for n in names]
    known = texts.select(*[F.when(~F.trim(c).isin(*MISSING), c).alias(n) for c, n in zip(columns, names)])
    if schema is None:
        schema = infer_numbers(known, names)
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return known.select(*[
        F.col(f"`{n}`").cast(f.dataType).alias(f.name) for n, f in zip(names, schema)])


def infer_numbers(df: DataFrame, names: Sequence[str], whole: bool = True) -> StructType:
    """BIGINT (if ``whole``) or DOUBLE for text columns in which every value is such a number, STRING for
    the others; one pass. A column without any value is DOUBLE."""
    facts = []
    for i, n in enumerate(names):
        x = F.col(f"`{n}`")
        for kind in ("double", "bigint"):
            facts.append(F.count_if(x.isNotNull() & x.try_cast(kind).isNull()).alias(f"{kind}{i}"))
        facts.append(F.count(x).alias(f"n{i}"))
    found = df.agg(*facts).first()
    kinds = [
        StringType() if found[f"double{i}"] else LongType() if whole and found[f"n{i}"] and not found[f"bigint{i}"]
        else DoubleType() for i in range(len(names))]
    return StructType([StructField(n, kind) for n, kind in zip(names, kinds)])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def supervised_view(df: DataFrame, target: str | None = None) -> tuple[DataFrame, DataFrame, str]:
    """(features, target, target name); the target is the last column unless named."""
    name = target or df.columns[-1]
    return df.drop(name), df.select(name), name


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns by name; a name that does not exist is an error."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return df.drop(*columns)


def none_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls as the text ``None``, turning the columns into strings."""
    names = list(columns) if columns is not None else df.columns
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in names})


def write_results(df: DataFrame, path: str, format: str = "csv") -> None:
    """Result table with header and ``None`` for nulls, or Parquet. A result is one row per
    configuration, small enough for a single file."""
    writer = df.coalesce(1).write.mode("overwrite")
    if format == "csv":
        writer.option("header", True).option("nullValue", NULL_TEXT).csv(path)
    else:
        writer.format(format).save(path)


def read_results(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read a result CSV back, the text ``None`` as null."""
    reader = spark.read.option("header", True).option("nullValue", NULL_TEXT)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def string_columns(df: DataFrame) -> list[str]:
    """Categorical columns: those of string type."""
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def csv_paths(spark: SparkSession, folder: str) -> list[str]:
    """The CSV data sets in a folder, by name: files, or folders of part files, that end in ``.csv``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(str(f.getPath()) for f in found if f.getPath().getName().endswith(".csv"))
