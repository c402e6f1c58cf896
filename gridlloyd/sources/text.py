"""Text converters: sensor logs and ARFF files, read as distributed line tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .tables import infer_numbers

SENSOR_NAMED = 3
SENSOR_ATTRIBUTES = 16


def sensor_columns(header: str) -> list[str]:
    """Column names of a sensor log: the first three header names, then attr0..attr15."""
    names = [part.strip().replace(" ", "_") for part in header.strip().split(",")][:SENSOR_NAMED]
    return names + [f"attr{i}" for i in range(SENSOR_ATTRIBUTES)]


def read_sensor_text(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace-separated sensor logs (one file or a folder searched for ``*.txt``) as doubles.

    The first line of each file is its header: the CSV reader drops it where the file begins, however
    the rest is split, while every other line stays one uncut column. All files must have the same names;
    ``read_sensor_tables`` takes folders in which they differ.
    """
    files = _sensor_files(spark, path)
    found = _sensor_names(files, path)
    names = [tuple(r["names"]) for r in found.select("names").distinct().limit(2).collect()]
    if not names:
        raise ValueError(f"no sensor text under {path}")
    if len(names) > 1:
        raise ValueError(f"the files under {path} have different headers: {sorted(names)}; use read_sensor_tables")
    return _sensor_table(_sensor_lines(files, path), names[0])


def read_sensor_tables(spark: SparkSession, path: str) -> dict[tuple[str, ...], DataFrame]:
    """A table for each distinct list of names among the sensor logs under ``path``, by these names.

    Every file is read under its own header, its lines being joined to the files of that header.
    """
    files = _sensor_files(spark, path)
    found = _sensor_names(files, path)
    lines = _sensor_lines(files, path, "_metadata.file_path AS file")
    tables = {}
    for row in found.select("names").distinct().orderBy("names").collect():  # one for each header, not for each file
        own = found.where(F.col("names") == F.array(*map(F.lit, row["names"]))).select("file")
        tables[tuple(row["names"])] = _sensor_table(lines.join(own, "file", "left_semi"), row["names"])
    return tables


def _sensor_files(spark: SparkSession, path: str):
    files = spark.read.option("recursiveFileLookup", True)
    return files if path.endswith(".txt") else files.option("pathGlobFilter", "*.txt")


def _sensor_names(files, path: str) -> DataFrame:
    """(file, names): the first three names in the header of every file, as ``sensor_columns`` makes them."""
    starts = files.text(path).where(F.col("_metadata.file_block_start") == 0).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    first = starts.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    named = F.transform(F.split(strip(F.col("header")), ","), lambda c: F.replace(strip(c), F.lit(" "), F.lit("_")))
    return first.select("file", F.slice(named, 1, SENSOR_NAMED).alias("names"))


def _sensor_lines(files, path: str, *more: str) -> DataFrame:
    lines = (
        files.schema("line string").option("header", True).option("enforceSchema", True)
        .option("sep", "\u0001").option("quote", "").option("escape", "").csv(path))
    return lines.selectExpr("line", *more)


def _sensor_table(lines: DataFrame, named: Sequence[str]) -> DataFrame:
    names = [*named, *[f"attr{i}" for i in range(SENSOR_ATTRIBUTES)]]
    fields = F.split(F.regexp_replace(F.trim("line"), " +", " "), " ")
    whole = F.when(F.size(fields) == len(names), fields).otherwise(F.raise_error(
        F.concat(F.lit(f"a sensor line must have {len(names)} fields: "), F.col("line"))))
    return lines.select(whole.alias("f")).select(
        *[F.get("f", F.lit(i)).cast("double").alias(name) for i, name in enumerate(names)])


def _marked(value: Column, keyword: str) -> Column:
    return value.contains(f"@{keyword.lower()}") | value.contains(f"@{keyword.upper()}")


def read_arff(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """ARFF files (one, or a folder of files with the same header) as a table.

    Lines starting with ``%`` are comments anywhere. Attribute names come from the lines above the
    data mark, everything below it is CSV. Keywords are all lower or all upper case. Attribute types
    are ignored; unless a schema is given, columns whose values are all numbers become DOUBLE.

    A line's place in its file is (start of its split, order inside the split); the data mark of
    every file is found by one aggregation. A line with more or fewer values than there are attributes is
    an error.
    """
    reader = spark.read
    if not path.endswith(".arff"):
        reader = reader.option("pathGlobFilter", "*.arff")
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")).alias("at"))
    content = lines.where(~F.col("value").startswith("%"))
    marks = content.where(
        _marked(F.col("value"), "data") & ~_marked(F.col("value"), "attribute")
    ).groupBy("file").agg(F.min("at").alias("mark"))
    placed = content.join(marks, "file")
    words = F.split(F.trim("value"), r"\s+")
    keyword = F.array_position(words, "@attribute")
    keyword = F.when(keyword > 0, keyword).otherwise(F.array_position(words, "@ATTRIBUTE"))
    heads = (
        placed.where((F.col("at") < F.col("mark")) & _marked(F.col("value"), "attribute"))
        .groupBy("file").agg(F.array_sort(F.collect_list(F.struct("at", F.get(words, keyword.cast("int")).alias("name")))).alias("a"))
        .select(F.col("a.name").alias("names")).distinct().collect())
    if not heads:
        raise ValueError(f"no ARFF header under {path}")
    if len(heads) > 1:
        raise ValueError(f"the files under {path} have different headers")
    names = heads[0]["names"]
    body = placed.where((F.col("at") > F.col("mark")) & (F.trim("value") != "")).select("value")
    as_text = StructType([StructField(n, StringType()) for n in names])
    parsed = body.select(F.from_csv("value", as_text.toDDL(), {"mode": "FAILFAST"}).alias("r")).select("r.*")
    if schema is None:
        schema = infer_numbers(parsed, names, whole=False)
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return parsed.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
