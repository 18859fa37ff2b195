"""Typed CSV, XML, JSON, log and directory scans, and their sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """Rows of a CSV of a fixed schema; a row that doesn't fit is an error, blanks are null, and a header has to be in the schema's order."""
    return spark.read.schema(schema).options(header=header, sep=sep, mode="FAILFAST", enforceSchema=not header, nullValue="").csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """CSV with CRLF line ends, as the readers of other systems expect."""
    df.write.options(header=header, sep=sep, lineSep="\r\n", emptyValue="").csv(path)


def header_of(spark: SparkSession, path: str) -> list[str]:
    return spark.read.text(path).first()[0].rstrip("\r").split(",")


def check_order(spark: SparkSession, path: str, schema: T.StructType) -> None:
    found = header_of(spark, path)
    if found != schema.names:
        raise ValueError(f"columns {found}, expected {schema.names}")


def check_newlines(spark: SparkSession, path: str) -> int:
    """Number of lines that don't end with CRLF."""
    return spark.read.option("lineSep", "\n").text(path).where(~F.endswith("value", F.lit("\r"))).count()


def line_report(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """One row: whether every header line has these columns in this order, the lines that aren't headers, and how many of them don't end with CRLF."""
    lines = spark.read.option("lineSep", "\n").text(path)
    text = F.regexp_replace("value", "\r$", "")
    head = F.array_sort(F.split(text, ",")) == F.array_sort(F.array(*[F.lit(n) for n in names]))
    bare = ~F.endswith("value", F.lit("\r"))
    return lines.agg(F.bool_and(F.when(head, text == ",".join(names))).alias("ordered"), F.count_if(~head).alias("lines"), F.count_if(~head & bare).alias("bare"))


def read_clinical(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose types follow from its column names: spaces go, the ids and ages are integers, dates are month/day/year."""
    ints = {"REDCapID", "AgeAtCollection", "PackYears"}
    names = [c.replace(" ", "") for c in header_of(spark, path)]
    raw = spark.read.options(header=True, nullValue="").csv(path).toDF(*names)
    typed = lambda c: F.col(c).cast("int") if c in ints else F.to_date(c, "M/d/yyyy") if "Date" in c else F.col(c)
    return raw.select(*[typed(c).alias(c) for c in names])


def constants(df: DataFrame, key: str, names: list[str], unit_of: dict[str, str] | None = None) -> DataFrame:
    """Name-value rows as one row a key; a value in pixels is divided by the constant that its unit names."""
    wide = df.groupBy(key).pivot("name", names).agg(F.first("value"))
    for name, scale in (unit_of or {}).items():
        wide = wide.withColumn(name, F.col(name) / F.col(scale))
    return wide


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, "project string, cohort string, slide_id long, message string, time string", header=False, sep=";")


def scan_directory(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Names, lengths and times of the files under a path whose name fits; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return files.where(F.regexp_extract("path", r"[^/]*$", 0).rlike(pattern))


def union_numbered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of all CSV files under a path, numbered within each file in file order."""
    from pyspark.sql import Window

    rows = spark.read.schema(schema).options(header=True, mode="FAILFAST").csv(path)
    rows = rows.withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
    return rows.withColumn("layer", F.row_number().over(Window.partitionBy("file").orderBy("at"))).drop("at")


def annotation_rows(xml: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Annotations, regions and vertices of XML texts with nested Annotation, Region and V elements."""
    v = "array<struct<_X:long,_Y:long>>"
    region = f"array<struct<_Id:long,_Neg:long,V:{v}>>"
    schema = f"Annotation array<struct<_Layer:long,_Name:string,Region:{region}>>"
    a = xml.select(key, F.explode(F.from_xml(column, schema)["Annotation"]).alias("a"))
    annotations = a.select(key, F.col("a._Layer").alias("layer"), F.col("a._Name").alias("name"))
    r = a.select(key, F.col("a._Layer").alias("layer"), F.posexplode("a.Region").alias("m", "r"))
    regions = r.select(key, "layer", (1000 * F.col("layer") + F.col("m") + 1).alias("regionid"), F.col("r._Neg").alias("neg"), F.size("r.V").alias("nvert"))
    vertices = r.select(key, (1000 * F.col("layer") + F.col("m") + 1).alias("regionid"), F.posexplode("r.V").alias("vid", "v"))
    return annotations, regions, vertices.select(key, "regionid", "vid", F.col("v._X").alias("x"), F.col("v._Y").alias("y"))


def pack_int32(values: Column) -> Column:
    """An array of integers as a block of little-endian 32-bit ones."""
    word = lambda v: F.lpad(F.hex(F.pmod(v.cast("long"), F.lit(2**32))), 8, "0")
    turned = F.transform(values, lambda v: F.concat(*[F.substring(word(v), k, 2) for k in (7, 5, 3, 1)]))
    return F.unhex(F.array_join(turned, ""))


def unpack_int32(block: Column) -> Column:
    """The array of a block of little-endian 32-bit integers."""
    digits, n = F.hex(block), F.floor(F.octet_length(block) / 4).cast("int")

    def value(i: Column) -> Column:
        word = F.concat(*[digits.substr(8 * i + k, F.lit(2)) for k in (7, 5, 3, 1)])
        v = F.conv(word, 16, 10).cast("long")
        return F.when(v >= 2**31, v - 2**32).otherwise(v)

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), value)).otherwise(F.array().cast("array<bigint>"))
