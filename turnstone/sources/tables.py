"""Tables with declared schemas, files, and the gates around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The passages table.
PASSAGES = T._parse_datatype_string(
    "session_id string, session_date string, session_type string, session_kind string, convened_as string, quorum_failed boolean, "
    "sesion string, reunion string, seq bigint, type string, event_type string, turn_id double, chapter string, chapter_title string, "
    "speaker_raw string, text string, pages array<bigint>, font string, font_style string, size double, source_file string, "
    "source_format string, source_sha256 string, parser_version string"
)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reference tables: header, quoted line breaks, never inferred."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', enforceSchema=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def read_rows_json(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """``{"table": {"rows": [...]}}`` documents, trailing commas tolerated."""
    text = spark.read.text(path, wholetext=True)
    mended = F.regexp_replace("value", ",(\\s*[\\]}])", "$1")
    return text.select(F.from_json(mended, f"table struct<rows: array<struct<{row_schema}>>>").alias("j")).select(F.inline("j.table.rows"))


def conform(df: DataFrame, schema: T.StructType = PASSAGES) -> DataFrame:
    """The schema's columns in order and type; missing ones null, texts trimmed."""
    out = []
    for f in schema:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        out.append((F.trim(c) if f.name == "text" else c).alias(f.name))
    return df.select(*out)


def write_passages(df: DataFrame, path: str, *partition: str) -> None:
    """Overwrites only the partitions that ``df`` holds."""
    w = conform(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partition) if partition else w).parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents as bytes with their format and digest."""
    df = spark.read.format("binaryFile").load(path)
    return df.select("path", "length", "content", sniffed(F.col("content")).alias("source_format"), F.sha2("content", 256).alias("source_sha256"))


def sniffed(content: Column) -> Column:
    """'pdf' by its magic bytes, else 'html'."""
    return F.when(F.substring(content, 1, 4) == F.lit(b"%PDF"), "pdf").otherwise("html")


def mended_marks(c: Column) -> Column:
    """Lone brackets of a symbol font, which are inverted marks."""
    return F.regexp_replace(F.regexp_replace(c, "(?<![\\w\\]])\\](?=\\p{Lu})", "¿"), "(?<![\\w\\[])\\[(?=\\p{Lu}[^\\]]*!)", "¡")


def require_all(listed: DataFrame, held: DataFrame, key: str) -> None:
    """Raises unless every listed key is held; names a few of those that are not."""
    lacking = [r[key] for r in listed.select(key).distinct().join(held.select(key), key, "left_anti").orderBy(key).limit(5).collect()]
    if lacking:
        raise ValueError(f"not held: {', '.join(map(str, lacking))}")


def session_id(date: Column, meeting: Column, stem: Column) -> Column:
    """Date and meeting number; ``rxx`` for a number that is none, the file's stem without a date."""
    n = F.trim(meeting).try_cast("int")
    return F.when(date.isNull(), stem).otherwise(F.concat(date, F.lit("_r"), F.when(n.isNull(), "xx").otherwise(F.lpad(n.cast("string"), 2, "0"))))
