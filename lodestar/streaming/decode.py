"""Message decoding, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Payload lines of an event-stream text start with this marker (fixed by that format).
EVENT_MARK = "data: "


def decode_json(df: DataFrame, col: str, ddl: str, drop_malformed: bool = False) -> DataFrame:
    """JSON text (or bytes) to typed columns; other columns stay.

    Text that does not parse gives a row of nulls. ``drop_malformed`` removes those rows (and null
    texts), so they do not form a null group later; documents without any of the fields stay.
    """
    rest = [c for c in df.columns if c != col]
    if not drop_malformed:
        return df.withColumn("_m", F.from_json(F.col(col).cast("string"), ddl)).select(*rest, "_m.*")
    judged = F.from_json(F.col(col).cast("string"), f"{ddl}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    decoded = df.withColumn("_m", judged).filter("_m is not null and _m._broken is null")
    return decoded.select(*rest, F.col("_m").dropFields("_broken").alias("_m")).select(*rest, "_m.*")


def decode_event_lines(df: DataFrame, line_col: str, ddl: str, required: str) -> DataFrame:
    """Payload lines of an event stream to typed columns, without events that miss ``required``."""
    payload = df.filter(F.col(line_col).startswith(EVENT_MARK)).select(
        F.substring(F.col(line_col), F.lit(len(EVENT_MARK) + 1), F.length(line_col)).alias("_json")
    )
    return decode_json(payload, "_json", ddl).filter(F.col(required).isNotNull())


def variant_field(df: DataFrame, col: str, path: str, type_: str, out: str) -> DataFrame:
    """One field of a free-form document; null where the document has no such field."""
    return df.withColumn(out, F.try_variant_get(F.try_parse_json(col), path, type_))


