"""Typed scans and sinks of reference files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPES = {"BIGINT": "bigint", "INT": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "STRING": "string"}


def read_reference(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A CSV with a header as the declared columns and types. An empty cell is null, but in a string column an empty string. A missing column is an error."""
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    cast = lambda c, t: F.coalesce(F.col(c), F.lit("")) if t.upper() == "STRING" else F.col(c).cast(TYPES.get(t.upper(), t))
    return raw.select(*[cast(c, t).alias(c) for c, t in columns.items()])


def load_reference(spark: SparkSession, folder: str, tables: dict[str, dict[str, str]], out: str) -> dict[str, int]:
    """Every reference file as a Parquet table; rows of each."""
    counts = {}
    for name, columns in tables.items():
        read_reference(spark, f"{folder}/{name}.csv", columns).write.mode("overwrite").parquet(f"{out}/{name}")
        counts[name] = spark.read.parquet(f"{out}/{name}").count()
    return counts


def source_views(df: DataFrame, column: str = "source_system", prefix: str = "source_") -> list[str]:
    """A filtered view for each system in the contract."""
    from kinweave.sources.guests import SYSTEMS

    for s in SYSTEMS:
        df.where(F.col(column) == s).createOrReplaceTempView(prefix + s)
    return [prefix + s for s in SYSTEMS]


def render(template: str, values: dict[str, str]) -> str:
    """``{{name}}`` filled in; a name left over is an error."""
    import re

    out = re.sub(r"\{\{(\w+)\}\}", lambda m: str(values[m[1]]) if m[1] in values else m[0], template)
    if left := re.findall(r"\{\{\w+\}\}", out):
        raise ValueError(f"no value for {sorted(set(left))}")
    return out


def statements(script: str, mark: str = "-- COMMAND ----------") -> list[str]:
    """Statements of a script; those that only read must be collected, or their assertions never run."""
    return [s.strip().rstrip(";") for s in script.split(mark) if s.strip().rstrip(";")]


def evidence_js(evidence: dict, name: str = "RELEASE_EVIDENCE") -> str:
    """A bounded evidence document as a script."""
    return f"const {name} = {json.dumps(evidence, indent=2, sort_keys=True, ensure_ascii=False)};\n"
