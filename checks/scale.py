"""Time a whole build on many events made from the events table: ``python -m checks.scale [folder] [times]``.

Each supplied event becomes ``times`` events of other users at other seconds. Then a
third of all rows are copies of one event, and one user has a third of the others.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as b
from checks.compare import local_session
from clicktide.plans import warehouse
from clicktide.plans.warehouse import JobConfig, run
from clicktide.session import scratch_path
from clicktide.sources.tables import write_table


def many_events(spark: SparkSession, folder: str, times: int) -> DataFrame:
    rows = b.flat_source(spark, folder).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times))))
    user = F.when(F.pmod(F.xxhash64("user_pseudo_id", "n"), F.lit(3)) == 0, "hot").otherwise(F.concat("user_pseudo_id", F.lit("."), "n"))
    moved = rows.withColumns(
        {
            "user_pseudo_id": user,
            "session_id": F.concat(user, F.lit("-"), F.date_format("event_timestamp", "yyyyMMdd")),
            "event_timestamp": F.col("event_timestamp") + F.make_dt_interval(secs=F.pmod(F.col("n"), F.lit(50))),
            "transaction_id": F.concat("transaction_id", F.lit("."), "n"),
        }
    ).drop("n")
    one = moved.limit(1)
    copies = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(rows.count() // 2)))).drop("n")
    return moved.unionByName(copies)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    source = scratch_path(spark, "many-events")
    write_table(many_events(spark, folder, int(sys.argv[2]) if len(sys.argv) > 2 else 100), source, "event_date")
    took: dict[str, float] = {}
    keep = warehouse.keep

    def timed(cfg, done, name, df) -> None:
        began = time.perf_counter()
        keep(cfg, done, name, df)
        took[name] = round(time.perf_counter() - began, 1)

    warehouse.keep = timed
    cfg = JobConfig(scratch_path(spark, "base"), source, b.BOUNDS, scratch_path(spark, "no-items"), first_visit=b.FIRST_VISIT, steps=b.STEPS)
    run(spark, cfg)
    print(json.dumps({"total": round(sum(took.values()), 1), "tables": took}))
    spark.stop()


if __name__ == "__main__":
    main()
