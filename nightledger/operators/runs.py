"""The registry of runs: which are usable, how fresh they are, what they lack."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.operators.relational import keep_one

#: Windows that a search may have.
MAX_WINDOWS = 1_000


def is_stable(status: str = "status", counts: str = "artifact_counts") -> Column:
    """A completed run with both a room inventory and property features."""
    c = F.col(counts)
    return (F.col(status) == "completed") & F.coalesce(c["room_inventory"] > 0, F.lit(False)) & F.coalesce(c["property_features"] > 0, F.lit(False))


def freshness(registry: DataFrame, today: date, limit_days: int = 7) -> DataFrame:
    """One row: the last stable run, its age in days, and whether it's stale (older than the limit, or there is none)."""
    last = registry.where(is_stable()).agg(F.max(F.struct("finished_at", "run_id")).alias("last"))
    age = F.datediff(F.lit(today), F.col("last.finished_at").cast("date"))
    return last.select(F.col("last.run_id").alias("run_id"), age.alias("age_days"), F.coalesce(age > limit_days, F.lit(True)).alias("stale"))


def register(registry: DataFrame, entries: DataFrame) -> DataFrame:
    """The registry with the entries, each in place of an older one of its run."""
    return registry.join(entries.select("run_id").distinct(), "run_id", "left_anti").unionByName(entries, allowMissingColumns=True)


def failure_rollup(failures: DataFrame) -> DataFrame:
    """A row for each run and category, with the failures that mention a challenge or an aborted load."""
    text = F.concat_ws(" ", "final_url", "message")
    return failures.groupBy("run_id", "category").agg(F.count("*").alias("failures"), F.count_if(text.contains("chal_t")).alias("chal_t"), F.count_if(text.contains("ERR_ABORTED")).alias("err_aborted"))


def pending(targets: DataFrame, windows: DataFrame, priced: DataFrame, failed: DataFrame, final: list[str]) -> DataFrame:
    """Targets that lack a window which is neither priced nor failed for good.

    The windows are a search's own, at most ``MAX_WINDOWS``, and are inlined into each target's row.
    """
    key = ["property_url", "lead_time_days", "stay_length_days"]
    done = priced.select(*key).unionByName(failed.where(F.col("category").isin(final)).select(*key)).distinct()
    listed = windows.select(*key[1:]).distinct().limit(MAX_WINDOWS + 1).collect()
    if len(listed) > MAX_WINDOWS:
        raise ValueError(f"more than {MAX_WINDOWS} windows")
    if not listed:
        return targets.select("property_url", F.lit(0).cast("long").alias("missing")).limit(0)
    grid = F.array(*[F.struct(*[F.lit(r[k]).alias(k) for k in key[1:]]) for r in listed])
    need = targets.select("property_url").distinct().select("property_url", F.inline(grid))
    return need.join(done, key, "left_anti").groupBy("property_url").agg(F.count("*").alias("missing"))


def search_base_date(metadata: DataFrame, rows: DataFrame) -> DataFrame:
    """(run_id, base): the date in the run's metadata, else the first dated row's checkin less its lead time."""
    first = keep_one(rows.where(F.col("checkin").isNotNull() & F.col("lead_time_days").isNotNull()), ["run_id"], [F.col("line")])
    inferred = first.select("run_id", F.date_sub("checkin", F.col("lead_time_days")).alias("inferred"))
    return metadata.select("run_id", F.col("search_base_date").cast("date").alias("given")).join(inferred, "run_id", "full_outer").select("run_id", F.coalesce("given", "inferred").alias("base"))
