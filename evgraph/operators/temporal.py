"""What was known when: snapshots, versions in force, leakage, staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from evgraph.operators.ordered import ROWS, with_buckets, with_last_known
from evgraph.session import written


def asof(df: DataFrame, ts_col: str, cutoff) -> DataFrame:
    """Rows publicly available at the cutoff (a literal or a column)."""
    limit = cutoff if isinstance(cutoff, Column) else F.lit(cutoff).cast("date")
    return df.where(F.col(ts_col) <= limit)


def leaked(inputs: DataFrame, ts_col: str, cutoff) -> DataFrame:
    """Inputs that became available only after the cutoff; must be empty for a prediction."""
    limit = cutoff if isinstance(cutoff, Column) else F.lit(cutoff).cast("date")
    return inputs.where(F.col(ts_col) > limit)


def org_asof(records: DataFrame, versions: DataFrame, at: str) -> DataFrame:
    """Records with the organisation version in force at ``at``; null where none was.
    The office is the hash key, the half-open interval a residual condition."""
    v = versions.select(
        F.col("office").alias("_office"), F.col("version"), F.col("name").alias("org_name"), "valid_from", "valid_to"
    )
    in_force = (F.col(at) >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))
    )
    return records.join(v, (F.col("office") == F.col("_office")) & in_force, "left").drop("_office")


def current_offices(versions: DataFrame, as_of) -> DataFrame:
    """Offices with a version in force at ``as_of``, one row each."""
    limit = F.lit(as_of).cast("date")
    live = (F.col("valid_from") <= limit) & (F.col("valid_to").isNull() | (F.col("valid_to") > limit))
    return versions.where(live).select("office").distinct()


def legacy(records: DataFrame, versions: DataFrame, as_of) -> DataFrame:
    """Records whose office has only closed versions, with the last one and its end."""
    limit = F.lit(as_of).cast("date")
    live = F.col("valid_to").isNull() | (F.col("valid_to") > limit)
    closed = (
        versions.where(F.col("valid_from") <= limit)
        .groupBy("office")
        .agg(
            F.count_if(live).alias("_live"),
            F.max_by("name", "valid_from").alias("last_version"),
            F.max("valid_to").alias("closed_on"),
        )
        .where("_live = 0")
        .drop("_live")
    )
    return records.join(closed, "office")


def last_before(
    events: DataFrame, observations: DataFrame, keys: list[str], at: str, event_id: str, value: str, rows: int = ROWS
) -> DataFrame:
    """Each event with the most recent observation at or before it. Both sides go
    through one ordered pass, so there is no range join. Histories of more than ``rows`` rows are cut at
    their own quantiles, so one key within one day spreads over tasks as well."""
    obs = observations.select(
        *keys, F.col(at), F.lit(0).alias("_side"), F.col(event_id).alias("_id"),
        F.struct(F.col(value).alias("value"), F.col(at).alias("at")).alias("_obs"),
    )
    ev = events.select(
        *keys, F.col(at), F.lit(1).alias("_side"), F.col(event_id).alias("_id"),
        F.lit(None).cast(obs.schema["_obs"].dataType).alias("_obs"),
    )
    order = [at, "_side", "_id"]
    both = written(obs.unionByName(ev), "observations")  # counted, drawn from and ordered
    merged = written(with_buckets(both, keys, order, "_part", rows), "parts")
    merged = with_last_known(merged, keys, order, "_obs", F.col("_part"), "_last")
    return merged.where("_side = 1").select(
        *keys, F.col("_id").alias(event_id), at, F.col("_last.value").alias(f"last_{value}"),
        F.col("_last.at").alias("last_at"),
    )


def staleness(df: DataFrame, observed: Column, as_of, sla_days: Column | int = 180) -> DataFrame:
    """Days since observation and fresh, stale or undated; unparsable dates are undated."""
    seen = observed.try_cast("date")
    limit = F.lit(sla_days) if isinstance(sla_days, int) else sla_days
    age = F.date_diff(F.lit(as_of).cast("date"), seen)
    status = F.when(age.isNull(), "undated").when(age <= limit, "fresh").otherwise("stale")
    return df.withColumn("age_days", age).withColumn("freshness", status)


def source_staleness(registry: DataFrame, retrievals: DataFrame, as_of) -> DataFrame:
    """Each source against its own cadence: days since its last successful retrieval, fresh while no more than
    ``cadence_days`` have passed, undated where nothing was ever retrieved. ``registry``: source_id, cadence_days;
    ``retrievals``: source, status, retrieved_at. Retrievals of a source combine in each task before the shuffle."""
    got = F.col("status") == "retrieved"
    seen = retrievals.groupBy("source").agg(
        F.max(F.when(got, F.to_date("retrieved_at"))).alias("last_retrieved_on"),
        F.count(F.lit(1)).alias("n_documents"), F.count_if(got).alias("n_retrieved"),
    )
    cadence = registry.select(F.col("source_id").alias("source"), "cadence_days").distinct()
    rated = cadence.join(seen, "source", "left").fillna(0, ["n_documents", "n_retrieved"])
    return staleness(rated, F.col("last_retrieved_on"), as_of, F.col("cadence_days"))
