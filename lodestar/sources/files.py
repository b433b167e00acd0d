"""Typed readers and writers for CSV, headerless CSV, text lines, Parquet and key/value text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

#: Malformed-record policies and the reader mode each one stands for.
POLICIES = {"drop": "DROPMALFORMED", "fail": "FAILFAST", "null": "PERMISSIVE"}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    malformed: str = "null",
) -> DataFrame:
    """Typed CSV scan. Give a schema: inference costs an extra pass, and one bad value would
    turn a whole column into text."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", POLICIES[malformed])
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_headerless_csv(spark: SparkSession, path: str, ddl: str, dates: dict[str, str] | None = None) -> DataFrame:
    """Positional CSV. ``dates`` maps a text column to its date pattern, e.g. ``yyyyMMdd``."""
    df = read_csv(spark, path, ddl, header=False)
    return df.withColumns({c: F.to_date(c, pattern) for c, pattern in (dates or {}).items()})


def _checked(raw: Column, typed: Column, field: str, malformed: str) -> Column:
    """Typed field under the policy: ``fail`` raises when the text does not convert."""
    if malformed != "fail":
        return typed
    message = F.concat(F.lit(f"malformed field {field}: "), F.coalesce(raw, F.lit("missing")))
    return F.when(typed.isNotNull(), typed).otherwise(F.raise_error(message))


def read_text_records(
    spark: SparkSession,
    path: str,
    ddl: str,
    sep: str = ",",
    header_prefix: str | None = None,
    malformed: str = "drop",
) -> DataFrame:
    """Lines split by hand into typed columns.

    Blank lines and lines that start with ``header_prefix`` (a header repeated per file) are
    no records. A record with missing fields or text that does not convert is dropped, fails
    the job, or keeps nulls with the line in ``_corrupt_record`` (``null``).
    """
    if malformed not in POLICIES:
        raise ValueError(f"malformed must be one of {sorted(POLICIES)}")
    fields = _parse_datatype_string(ddl).fields
    lines = spark.read.text(path).toDF("_line").filter(F.trim("_line") != "")
    if header_prefix:
        lines = lines.filter(~F.col("_line").startswith(header_prefix))
    pieces = lines.select("_line", F.split("_line", _literal(sep), -1).alias("_f"))
    raw = [F.trim(F.get("_f", F.lit(i))) for i in range(len(fields))]
    typed = [_checked(r, r.try_cast(f.dataType), f.name, malformed).alias(f.name) for r, f in zip(raw, fields)]
    records = pieces.select("_line", *typed)
    good = F.lit(True)
    for f in fields:
        good = good & F.col(f.name).isNotNull()
    if malformed == "null":
        return records.withColumn("_corrupt_record", F.when(~good, F.col("_line"))).drop("_line")
    if malformed == "drop":
        records = records.filter(good)
    return records.drop("_line")


def _literal(sep: str) -> str:
    return f"\\Q{sep}\\E"


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", sep: str = ",") -> None:
    """One file per partition plus the success marker."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_text_pairs(df: DataFrame, path: str, key: str, value: str) -> None:
    """``key<TAB>value`` lines; refuses an existing directory."""
    df.select(F.concat_ws("\t", F.col(key), F.col(value)).alias("value")).write.mode("errorifexists").text(path)


def keyed_hash(df: DataFrame, prefix: str, id_col: str, fields: Sequence[str]) -> DataFrame:
    """Key/hash rows: ``prefix:id`` and a map of the fields as text."""
    pairs = [c for f in fields for c in (F.lit(f), F.col(f).cast("string"))]
    return df.select(
        F.concat(F.lit(f"{prefix}:"), F.col(id_col).cast("string")).alias("key"), F.create_map(*pairs).alias("fields")
    )
