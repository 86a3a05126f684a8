"""Logs of request attempts: which answer counts, what to wait, what to retry with more room."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK, TRANSIENT, INCOMPLETE, FAILED = "ok", "transient", "incomplete", "error"

# Retry budget, back-off base and token limits.
RETRIES = 3
BACKOFF_S = 15.0
MIN_RECOVERY_TOKENS = 16384
MAX_RECOVERY_TOKENS = 32768


def backoff_seconds(attempt: Column, base: float = BACKOFF_S) -> Column:
    """Wait after a failed attempt: base, 2*base, 4*base, ..."""
    return F.lit(base) * F.pow(F.lit(2.0), attempt - 1)


def first_valid_attempt(attempts: DataFrame, retries: int = RETRIES, base: float = BACKOFF_S) -> DataFrame:
    """One row per request: the first good answer, or else the last failure.

    ``attempts(request_id, attempt, status, body, error)``. Both picks are plain
    aggregates with map-side combine, so a request with very many attempts costs
    one row per map task. ``waited_s`` adds up the back-off after each transient
    failure that still had a retry left.
    """
    answer = F.struct("attempt", "body")
    failure = F.struct("attempt", F.coalesce(F.col("error"), F.col("status")).alias("error"))
    waits = (F.col("status") == TRANSIENT) & (F.col("attempt") <= retries)
    picked = attempts.groupBy("request_id").agg(
        F.min(F.when(F.col("status") == OK, answer)).alias("good"),
        F.max(F.when(F.col("status") != OK, failure)).alias("bad"),
        F.count(F.lit(1)).alias("n_attempts"),
        F.sum(F.when(waits, backoff_seconds(F.col("attempt"), base)).otherwise(0.0)).alias("waited_s"),
    )
    ok = F.col("good").isNotNull()
    return picked.select(
        "request_id", ok.alias("ok"),
        F.coalesce(F.col("good.attempt"), F.col("bad.attempt")).alias("attempt"),
        F.col("good.body").alias("body"),
        F.when(~ok, F.col("bad.error")).alias("error"),
        "n_attempts", "waited_s",
    )


def recovery_tokens(max_tokens: Column) -> Column:
    return F.least(F.greatest(max_tokens * 2, F.lit(MIN_RECOVERY_TOKENS)), F.lit(MAX_RECOVERY_TOKENS))


def escalation_plan(attempts: DataFrame) -> DataFrame:
    """Adds next_max_tokens and retry: cut-off output is tried once more with a larger limit."""
    larger = recovery_tokens(F.col("max_tokens"))
    retry = (F.col("status") == INCOMPLETE) & (larger > F.col("max_tokens")) & ~F.col("escalated")
    return attempts.withColumn("next_max_tokens", larger).withColumn("retry", F.coalesce(retry, F.lit(False)))
