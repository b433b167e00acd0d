"""Tables over JDBC. The connection dict is all that differs between databases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Slices:
    """Parallel read of one table: ``count`` range queries over a numeric, date or time column.

    The bounds only place the cuts; rows outside them are still read by the outer slices.
    """

    column: str
    lower: str
    upper: str
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


def jdbc_options(conn: dict[str, str], table: str, slices: Slices | None = None) -> dict[str, str]:
    """Spark's reader/writer options for a connection (url, driver, user, password, …)."""
    if "url" not in conn:
        raise ValueError("a connection needs a url")
    return {"fetchsize": "10000", **conn, "dbtable": table, **(slices.options() if slices else {})}


def read_jdbc(spark: SparkSession, conn: dict[str, str], table: str, slices: Slices | None = None) -> DataFrame:
    """Read a table; filters and column choice are pushed into the database by Spark.

    Without ``slices`` the whole table comes through one connection: right for dimensions,
    wrong for facts.
    """
    return spark.read.format("jdbc").options(**jdbc_options(conn, table, slices)).load()


def write_jdbc(df: DataFrame, conn: dict[str, str], table: str, mode: str = "overwrite") -> None:
    """Write a result table. ``overwrite`` truncates, so the table keeps its definition.

    ``numPartitions`` in the connection bounds how many connections write at once.
    """
    options = {"truncate": "true", "batchsize": "10000", **jdbc_options(conn, table)}
    df.write.format("jdbc").options(**options).mode(mode).save()
