"""Metadata of scheduled jobs: owners, lineage, use of tables in the query log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dialect import ilike_any, like_plain
from ..operators.history import explode_lineage, latest_version, split_address
from ..operators.joins import role_join

Tables = Mapping[str, DataFrame]

# States of jobs that no longer run.
GONE = ("DELETED", "ARCHIVED")
STOPPED = ("DELETED", "ARCHIVED", "INACTIVE")


def job_owners(t: Tables, *, projects: Sequence[int], name_pattern: str = "%") -> DataFrame:
    """Latest version of each job with the names of its creator and last editor."""
    jobs = t["jobs"].filter(
        F.col("project_id").isin(*projects) & ~F.col("state").isin(*GONE) & like_plain("name", name_pattern, ignore_case=True)
    )
    # the version maximum is over all items of a job; filtering the jobs first does not change it
    items = t["job_items"].select("job_id", "job_version").join(jobs.select(F.col("id").alias("job_id")), "job_id", "left_semi")
    newest = items.groupBy("job_id").agg(F.max("job_version").alias("job_version"))
    out = newest.join(jobs, newest["job_id"] == jobs["id"])
    out = role_join(out, t["users"], "create_user_id", "id", "create", ["user_name"])
    out = role_join(out, t["users"], "update_user_id", "id", "update", ["user_name"])
    return out.select(
        "job_id", "name", "cron", "state", "create_user_name", "update_user_name", F.col("created_at").cast("date").alias("created_at"),
        F.col("updated_at").cast("date").alias("updated_at"), "job_version", "project_id",
    ).distinct()


def jobs_by_text(jobs: DataFrame, *, projects: Sequence[int], patterns: Sequence[str]) -> DataFrame:
    """Running jobs whose SQL mentions any of the patterns."""
    return jobs.filter(
        F.col("project_id").isin(*projects) & ~F.col("state").isin(*STOPPED) & ilike_any("raw_sql", patterns)
    ).select("project_id", "id", "name")


def latest_items(t: Tables, *, projects: Sequence[int]) -> DataFrame:
    """All items of the newest version of each running job."""
    jobs = t["jobs"].filter(F.col("project_id").isin(*projects) & ~F.col("state").isin(*STOPPED))
    items = t["job_items"].join(jobs.select(F.col("id").alias("job_id")), "job_id", "left_semi")
    return latest_version(items, ["job_id"], "job_version")


def source_tables(items: DataFrame, job_id: int | None = None) -> DataFrame:
    """Tables the newest version of a job (or of every job) reads."""
    rows = items if job_id is None else items.filter(F.col("job_id") == job_id)
    return explode_lineage(latest_version(rows, ["job_id"], "job_version"), "source_tables", ["job_id"])


def target_tables(items: DataFrame, job_id: int | None = None) -> DataFrame:
    """Tables the newest version of a job (or of every job) writes."""
    rows = items if job_id is None else items.filter(F.col("job_id") == job_id)
    return split_address(latest_version(rows, ["job_id"], "job_version"), "target_table", ["job_id"])


def table_usage(log: DataFrame, *, patterns: Sequence[str], year: int, skip_users: Sequence[str] = ()) -> DataFrame:
    """Queries of a year that mention all patterns, with the day of their last run; the shuffle key is a hash of the text."""
    lo, hi = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
    rows = log.filter((F.col("end_date") >= lo) & (F.col("end_date") < hi))
    if skip_users:
        rows = rows.filter(~F.lower("user_name").isin(*skip_users))
    for pattern in patterns:
        rows = rows.filter(like_plain("query_text", pattern, ignore_case=True))
    return rows.groupBy("user_name", "query_type", F.md5("query_text").alias("query_hash")).agg(
        F.max("end_date").alias("query_last_run"), F.max("query_text").alias("query_text")
    )
