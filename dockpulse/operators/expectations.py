"""Table expectations: each returns the violating rows, so an empty result means a pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count; rows with a NULL key are left out."""
    present = df
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Unexpected values with counts; NULL never fails."""
    return value_counts(df, column).where(~F.col("value_field").isin(*values))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent row."""
    keys = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    return (
        child.select(F.col(column).alias("from_field"))
        .where(F.col("from_field").isNotNull())
        .join(keys, F.col("from_field") == F.col("_parent_key"), "left_anti")
    )


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys without a parent and how many child rows carry them.

    The child is counted per key before the shuffle, so a key with a third of all rows costs no
    more than the others.
    """
    keys = value_counts(child.where(F.col(column).isNotNull()), column)
    known = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    return keys.join(known, F.col("value_field") == F.col("_parent_key"), "left_anti")


@dataclass(frozen=True)
class Constraint:
    """A rule that must not be false (NULL passes, as in SQL CHECK)."""

    name: str
    rule: Column


def _not_null(column: str) -> Constraint:
    return Constraint(f"{column}_not_null", F.col(column).isNotNull())


def _not_negative(column: str) -> Constraint:
    return Constraint(f"{column}_not_negative", F.col(column) >= 0)


def _percentage(column: str) -> Constraint:
    return Constraint(f"{column}_0_to_100", F.col(column).between(0, 100))


def station_constraints() -> list[Constraint]:
    required = ("station_id", "station_name", "capacity")
    return [*map(_not_null, required), _not_negative("capacity")]


def availability_constraints() -> list[Constraint]:
    required = (
        "station_id",
        "snapshot_timestamp",
        "num_bikes_available",
        "num_docks_available",
        "is_installed",
        "is_renting",
        "is_returning",
        "is_empty",
        "is_full",
        "is_operational",
        "ingestion_timestamp",
    )
    counts = (
        "num_bikes_available",
        "num_bikes_available_mechanical",
        "num_bikes_available_ebike",
        "num_docks_available",
    )
    rates = ("occupancy_rate", "availability_rate", "service_rate")
    return [*map(_not_null, required), *map(_not_negative, counts), *map(_percentage, rates)]


def violations(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Rows of ``df`` once per broken constraint, with its name; one pass for all constraints."""
    broken = F.filter(
        F.array(*[F.when(~c.rule, F.lit(c.name)) for c in constraints]), lambda name: name.isNotNull()
    )
    return df.withColumn("constraint_name", F.explode(broken))


def violation_counts(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Broken rows per constraint, including zeros."""
    counted = df.agg(*[F.count_if(~c.rule).alias(c.name) for c in constraints])
    entries = F.array(
        *[F.struct(F.lit(c.name).alias("constraint_name"), F.col(c.name).alias("violations")) for c in constraints]
    )
    return counted.select(F.explode(entries).alias("e")).select("e.*")
