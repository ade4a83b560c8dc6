"""Small constant tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table from literal rows (name TYPE, ...), known to the optimizer with its size, without a Python stage."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    cols = ", ".join(f"CAST(c{i} AS {t}) AS {n}" for i, (n, t) in enumerate(fields))
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({', '.join(f'c{i}' for i in range(len(fields)))})")
