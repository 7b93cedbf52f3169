"""Nightly batch job: ``spark-submit rollbook/job.py --tables <dir> --out <dir> ...``

Reads one parquet dataset per SIS table under ``--tables`` (or a metastore
database with ``--database``), writes every extract under ``--out`` and prints
the run log.  The session comes from spark-submit; nothing here picks masters,
memory or local folders.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from rollbook.params import ExtractParams
from rollbook.plans.registry import all_extracts
from rollbook.plans.runner import run_batches
from rollbook.session import ensure_checkpoint_dir
from rollbook.sources.catalog import Tables

# every SIS table any extract reads
SIS_TABLES = (
    "schools", "terms", "calendar_day", "cycle_day", "period", "bell_schedule", "bell_schedule_items",
    "courses", "sections", "schedulesections", "section_meeting", "cc", "students", "reenrollments",
    "studentcorefields", "studentrace", "person", "emailaddress", "personemailaddressassoc",
    "personphonenumberassoc", "personaddressassoc", "personaddress", "codeset", "studentcontactassoc",
    "studentcontactdetail", "users", "schoolstaff", "storedgrades", "standard", "standardscore",
    "assignmentstandardassoc", "standardgradesectioncomment", "standardgraderollupcomment", "log", "gen",
    "incident", "incident_action", "incident_person_role", "attendance", "healthconcerns", "psm_studentalert",
    "cst_pubstuspeddata", "s_nd_stu_x", "s_nd_stu_homelessprograms_c", "fee", "fee_transaction",
)


#: Windows that a run can set itself.
WINDOWS = {
    "window_start": dt.date.fromisoformat, "window_end": dt.date.fromisoformat,
    "year_window_start": dt.date.fromisoformat, "year_window_end": dt.date.fromisoformat,
    "behavior_start": dt.date.fromisoformat, "behavior_end": dt.date.fromisoformat,
    "transcript_end_year": int,
}


def parse(argv=None):
    ap = argparse.ArgumentParser(description=__doc__)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="directory with one parquet dataset per SIS table")
    src.add_argument("--database", help="catalog database holding the SIS tables")
    ap.add_argument("--out", required=True, help="output folder (shared storage)")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    ap.add_argument("--end-year", type=int, default=None, help="school year by its end year")
    ap.add_argument("--school-id", type=int, default=None)
    for name, kind in WINDOWS.items():
        ap.add_argument("--" + name.replace("_", "-"), type=kind, default=None,
                        help="instead of what follows from the school year")
    ap.add_argument("--batches", default="1,2,3,4")
    ap.add_argument("--only", default="", help="comma-separated extract names")
    ap.add_argument("--parallelism", type=int, default=4, help="extracts submitted at once")
    ap.add_argument("--quality", action="store_true", help="also write the quality summary")
    return ap.parse_args(argv)


def main(argv=None) -> int:
    a = parse(argv)
    spark = SparkSession.builder.appName("rollbook-nightly").getOrCreate()
    # runtime re-planning: partition sizes from the data, skewed joins split,
    # small sides broadcast only after their runtime size is known
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, "true")
    ensure_checkpoint_dir(spark)
    if a.tables:
        tables = Tables.from_dir(spark, a.tables, SIS_TABLES)
    else:
        tables = Tables.from_catalog(spark, a.database, SIS_TABLES)
    end_year = a.end_year or (a.as_of.year + 1 if a.as_of.month >= 7 else a.as_of.year)
    windows = {k: v for k in WINDOWS if (v := getattr(a, k)) is not None}
    params = ExtractParams.for_run(a.as_of, end_year, a.school_id, **windows)
    names = {n for n in a.only.split(",") if n} or None
    unknown = (names or set()) - set(all_extracts())
    if unknown:
        print(f"unknown extracts: {sorted(unknown)}", file=sys.stderr)
        return 2
    log = run_batches(spark, tables, a.out, params, batches=tuple(int(b) for b in a.batches.split(",")),
                      names=names, quality=a.quality, parallelism=a.parallelism)
    log.show(log.count(), truncate=False)
    return 0 if log.where("status <> 'OK'").limit(1).count() == 0 else 1


if __name__ == "__main__":
    sys.exit(main())
