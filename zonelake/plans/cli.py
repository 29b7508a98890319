"""Command-line runner: the refinement jobs as separate applications.

    spark-submit zonelake/plans/cli.py <job> --root <lake uri> [--customer P] [--accelerometer P] [--step-trainer P]
    python -m zonelake <job> ...            (same, with a local session)

Jobs: ``customer-trusted`` (needs --customer), ``accelerometer-trusted``
(--accelerometer), ``step-trainer-trusted`` (--step-trainer), ``curated``
(reads the trusted zone tables) and ``all``.  Each job reads its inputs
from landing files or zone tables and commits its outputs as zone tables.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from zonelake import schemas
from zonelake.plans import refine
from zonelake.plans.jobs import report
from zonelake.session import configure
from zonelake.sinks.zone import ZoneStore
from zonelake.sources.catalog import Zones, read_zone
from zonelake.sources.landing import read_landing

JOBS = ("customer-trusted", "accelerometer-trusted", "step-trainer-trusted", "curated", "all")


FLAGS = {
    "customer_landing": "--customer",
    "accelerometer_landing": "--accelerometer",
    "step_trainer_landing": "--step-trainer",
}


def _commit(store: ZoneStore, spark: SparkSession, df: DataFrame, zone: str, table: str, mode: str) -> DataFrame:
    # every job output is unique per record key by construction (keep-latest,
    # or a (key, rn) pair), so the writer skips its own deduplication
    keys, order = refine.TABLE_KEYS[table]
    store.write(df, zone, table, keys, order, mode=mode, unique=True, numbered="rn" if "rn" in keys else None)
    return read_zone(spark, zone, table, store.zones)


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, tuple[int, str]]:
    """Run one job (or all); return the committed tables' row counts and schemas."""
    configure(spark)
    store = ZoneStore(args.root, Zones(args.prefix))
    store.zones.create(spark)
    done: dict[str, DataFrame] = {}

    def landing(name: str, path: str | None) -> DataFrame:
        if not path:
            raise SystemExit(f"{FLAGS[name]} is required for job {args.job}")
        return read_landing(spark, path, schemas.LANDING_SCHEMAS[name], required=schemas.REQUIRED_KEYS[name])

    def table(zone: str, name: str) -> DataFrame:
        if name not in done:
            store.register(spark, zone, name)  # this application's catalog may not know the table yet
        return done[name] if name in done else read_zone(spark, zone, name, store.zones)

    def customers() -> DataFrame:
        return table("trusted", "customer_trusted")

    if args.job in ("customer-trusted", "all"):
        df = refine.customer_trusted(landing("customer_landing", args.customer))
        done["customer_trusted"] = _commit(store, spark, df, "trusted", "customer_trusted", args.mode)
    if args.job in ("accelerometer-trusted", "all"):
        df = refine.accelerometer_trusted(landing("accelerometer_landing", args.accelerometer), customers(), at_most=refine.customer_size(customers()))
        done["accelerometer_trusted"] = _commit(store, spark, df, "trusted", "accelerometer_trusted", "replace")
    if args.job in ("step-trainer-trusted", "all"):
        df = refine.step_trainer_trusted(landing("step_trainer_landing", args.step_trainer), customers(), at_most=refine.customer_size(customers()))
        done["step_trainer_trusted"] = _commit(store, spark, df, "trusted", "step_trainer_trusted", "replace")
    if args.job in ("curated", "all"):
        accel = table("trusted", "accelerometer_trusted")
        steps = table("trusted", "step_trainer_trusted")
        cust = customers()
        done["customer_curated"] = _commit(
            store, spark, refine.customer_curated(accel, cust), "curated", "customer_curated", args.mode
        )
        done["machine_learning_curated"] = _commit(
            store, spark, refine.ml_curated(steps, accel, cust, owners=done["customer_curated"] if args.mode == "replace" else None, same_user=args.same_user), "curated",
            "machine_learning_curated", "replace"
        )
    return {r["table_name"]: (r["row_count"], r["columns"]) for r in report(done).collect()}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="zonelake", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    p.add_argument("job", choices=JOBS)
    p.add_argument("--root", required=True, help="lake root (shared file system or object store URI)")
    p.add_argument("--prefix", default="lake", help="catalog databases <prefix>_trusted, <prefix>_curated")
    p.add_argument("--customer", help="customer landing file or folder (JSON lines)")
    p.add_argument("--accelerometer", help="accelerometer landing folder (JSON lines)")
    p.add_argument("--step-trainer", dest="step_trainer", help="step-trainer landing folder (JSON lines)")
    p.add_argument(
        "--same-user", dest="same_user", action="store_true",
        help="pair device and accelerometer readings of the same user only (default: same time only)",
    )
    p.add_argument(
        "--mode", choices=("replace", "upsert"), default="replace",
        help="customer tables: replace (default) or upsert into the existing table",
    )
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName(f"zonelake {args.job}").getOrCreate()
    for table, (n, columns) in run(session, args).items():
        print(f"{table}\t{n}\t{columns}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
