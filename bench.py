"""Time every query on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; print one JSON line.

``refresh`` is the whole load (raw tables to judged tables and rejects); the queries
after it read what it wrote, as reports read a loaded database.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parcelyard import session  # noqa: E402
from parcelyard.plans import catalogue  # noqa: E402


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session.build(
        f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    # Start the JVM's own machinery on something that is not measured.
    spark.range(1000).selectExpr("sum(id)").collect()

    run = catalogue.refresh_of(spark, sf_dir)
    seconds = {"refresh": timed(lambda: [run.judged("shipments"), run.rejects()])}
    for name in catalogue.QUERIES:
        frame = catalogue.named(name)
        seconds[name] = timed(
            lambda: frame(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total seconds, refresh and all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
