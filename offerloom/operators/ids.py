"""Resolving alternative ids to the entity id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.fixed_values import APP_ID_TYPE
from offerloom.functions import map_codes


def resolve_id(df: DataFrame, id_map: DataFrame, id_type: str = "cagm", col: str = "cagm") -> DataFrame:
    """Replace ``col`` by ``enterprise_id``. One alternative id may belong to several entities."""
    keys = (
        id_map.filter(F.col("id_type") == id_type)
        .select("enterprise_id", F.col("alternative_id").alias(col))
        .distinct()
    )
    return df.join(keys, on=col).drop(col)


def resolve_id_multi(df: DataFrame, id_map: DataFrame, app_id_type: Mapping[str, str] = APP_ID_TYPE) -> DataFrame:
    """Resolve by the id type of each row's application; the member number wins over the plain id."""
    typed = df.withColumn("id_type", map_codes("app", app_id_type)).withColumn("id", F.coalesce("cagm", "id"))
    keys = id_map.dropDuplicates(["enterprise_id", "id_type", "alternative_id"]).select(
        "enterprise_id", "id_type", F.col("alternative_id").alias("id")
    )
    return typed.join(keys, on=["id_type", "id"])


def calls_without_interaction(calls: DataFrame, interactions: DataFrame, key: str = "call_guid") -> DataFrame:
    """Calls that never reached the agent."""
    return calls.join(interactions.select(key), on=key, how="left_anti")
