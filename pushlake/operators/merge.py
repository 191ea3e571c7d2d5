"""Ordered upserts of documents (U1) and replace-into (K5 helper)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pushlake.operators.ordered import last_write_wins


def merge_docs(docs: DataFrame, updates: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] | str) -> DataFrame:
    """Merge parsed fields into documents.

    Updates of one key are applied in ``order`` (the last one wins, W3). A matched
    document gets exactly ``fields`` overwritten, null values included; its other
    fields are kept. An unmatched update inserts a document with only ``fields``.
    Documents without update are unchanged. One full outer join on ``key``: both
    sides are unique per key after W3, so the join has no skew."""
    latest = last_write_wins(updates, key, order, fields).withColumn("_u", F.lit(True))
    d = docs.alias("d")
    u = latest.alias("u")
    j = d.join(u, F.col(f"d.{key}") == F.col(f"u.{key}"), "full_outer")
    matched = F.col("u._u").isNotNull()
    out = [F.coalesce(F.col(f"d.{key}"), F.col(f"u.{key}")).alias(key)]
    for c in docs.columns:
        if c == key:
            continue
        if c in fields:
            out.append(F.when(matched, F.col(f"u.{c}")).otherwise(F.col(f"d.{c}")).alias(c))
        else:
            out.append(F.col(f"d.{c}").alias(c))
    for c in fields:
        if c not in docs.columns:
            out.append(F.col(f"u.{c}").alias(c))
    return j.select(*out)


def replace_into(table: DataFrame, rows: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """K5 replace-into: rows replace table rows with the same key, others appended.
    Of several rows with one key the last in ``order`` wins (default: the largest by
    all other columns, so the result does not depend on row order). Write the result
    to a new table and swap it in: the plan still reads ``table``."""
    rest = [c for c in rows.columns if c not in key]
    by = F.struct(*(order or rest or key))
    rows = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), by).alias("_last")).select(*[F.col(f"_last.`{c}`") for c in rows.columns])
    kept = table.join(rows.select(*key), list(key), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)
