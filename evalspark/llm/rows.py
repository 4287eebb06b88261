"""A caller's columns under names that no working column has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_aside(columns: list[str]) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`").alias(f"kept_{i}") for i, c in enumerate(columns)]


def put_back(columns: list[str]) -> list[Column]:
    return [F.col(f"kept_{i}").alias(c) for i, c in enumerate(columns)]
