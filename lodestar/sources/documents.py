"""Documents: nested rows out, generated ids in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_documents(
    df: DataFrame, target: str, fmt: str = "json", options: dict[str, str] | None = None, mode: str = "overwrite"
) -> None:
    """One nested row becomes one document.

    ``fmt="json"`` writes JSON lines to ``target``. With ``fmt="mongodb"`` the connector must
    be on the class path and ``target`` names the collection; the options carry the address.
    """
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if fmt == "mongodb":
        writer.option("collection", target).save()
    else:
        writer.save(target)


def with_document_id(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Add a unique ``_id``: random, or a digest of ``cols`` that a repeated load reproduces."""
    if cols is None:
        return df.withColumn("_id", F.uuid())
    return df.withColumn("_id", F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256))
