"""Run one job: ``spark-submit run_job.py <job> --root DIR [--landing GLOB]``.

Landing jobs (customer, cart, cart_item, product) read landed JSON files;
derived jobs (derive_customers, derive_carts) read tables loaded before. Master
and resources come from spark-submit.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from stratakeep.plans.pipelines import DERIVED_JOBS, LANDING_JOBS, JobOptions, LoadResult
from stratakeep.plans.warehouse import Warehouse
from stratakeep.session import SETTINGS
from stratakeep.sources.landing import read_landing
from stratakeep.sources.schemas import LANDING_SCHEMAS
from stratakeep.sources.tables import scratch_scope


def run_job(
    spark: SparkSession,
    job: str,
    root: str,
    landing: str | None = None,
    load_id: str | None = None,
    legacy: bool = False,
    late: bool = False,
    load_ts: datetime | None = None,
    rejects: str | None = None,
    whole: bool = False,
) -> LoadResult:
    """Run a job by name and return what it loaded.

    Rows that could not be loaded are written as JSON to ``rejects`` if given. ``whole``
    has derive_carts look at all cart lines, not only at changed ones. Nothing
    that was staged is left behind.
    """
    if job in LANDING_JOBS and landing is None:
        raise ValueError(f"job {job} needs a landing path")
    warehouse = Warehouse(spark, root, load_id, load_ts)
    with scratch_scope(spark):
        if job == "derive_carts":
            result = DERIVED_JOBS[job](warehouse, legacy, changed_only=not whole, late=late)
        elif job in DERIVED_JOBS:
            result = DERIVED_JOBS[job](warehouse, legacy, late=late)
        else:
            options = JobOptions(legacy_dates=legacy, mode="batch" if legacy else "sequenced", late=late)
            result = LANDING_JOBS[job](warehouse, read_landing(spark, landing, LANDING_SCHEMAS[job]), options)
        if rejects and result.rejects is not None:
            result.rejects.write.mode("overwrite").json(rejects)
    return LoadResult(result.rows)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="stratakeep", description=__doc__)
    parser.add_argument("job", choices=[*LANDING_JOBS, *DERIVED_JOBS])
    parser.add_argument("--root", required=True, help="warehouse directory")
    parser.add_argument("--landing", help="landed files, may hold glob patterns")
    parser.add_argument("--load-id", help="name of the load; a rerun under the same name replaces it")
    parser.add_argument("--load-ts", type=datetime.fromisoformat, help="time of the load, ISO 8601, UTC if without zone")
    parser.add_argument("--legacy", action="store_true", help="literal historic dates, comparison and email rule")
    parser.add_argument("--late", action="store_true", help="events may be older than stored ones; also for the derived job after such a load")
    parser.add_argument("--whole", action="store_true", help="derive_carts looks at all cart lines, not only at changed ones")
    parser.add_argument("--rejects", help="directory for rows that could not be loaded")
    options = parser.parse_args(arguments)

    builder = SparkSession.builder.appName(f"stratakeep {options.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    result = run_job(
        spark,
        options.job,
        options.root,
        options.landing,
        options.load_id,
        options.legacy,
        options.late,
        options.load_ts,
        options.rejects,
        options.whole,
    )
    for table, rows in result.rows.items():
        print(f"{table}: {rows} rows")


if __name__ == "__main__":
    main()
