"""Scans of Parquet tables.

Reads are lazy: Catalyst prunes the columns a plan uses and pushes filters
into the Parquet scan, so no reader selects columns by hand.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def require_columns(df: DataFrame, columns: list[str], what: str = "input") -> None:
    """Fail before planning when a required column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns in {what}: {', '.join(missing)}")


def find_column(df: DataFrame, candidates: list[str], case_insensitive: bool = True) -> str | None:
    """First candidate present in ``df`` (case-insensitive by default)."""
    if case_insensitive:
        lookup = {c.lower(): c for c in df.columns}
        for cand in candidates:
            if cand.lower() in lookup:
                return lookup[cand.lower()]
        return None
    for cand in candidates:
        if cand in df.columns:
            return cand
    return None


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Strip names; ``.`` and space become ``_`` (case is kept)."""
    return df.toDF(*[c.strip().replace(".", "_").replace(" ", "_") for c in df.columns])
