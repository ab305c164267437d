"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) holds the tables, ``BENCH_CPUS`` (default 8) is
the number of local cores, ``BENCH_RUNS`` (default 3) the number of timed runs, of which the
median counts, after one run to warm up. ``BENCH_COPIES`` (default 200) enlarges the users
for the ``large_*`` queries: every customer becomes that many users, a third of them in one
country, written to scratch before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import tables as t  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from checks.scratch import scratch  # noqa: E402
from checks.session import local_session  # noqa: E402
from rollcall.operators import (  # noqa: E402
    age_distribution,
    city_distribution,
    classify_users,
    country_distribution,
    daily_distributions,
    gender_distribution,
    latest_by_key,
)

HEADLINE = [
    "gender_distribution",
    "age_distribution",
    "country_distribution",
    "city_distribution",
    "daily_distributions",
    "decode_users",
    "encode_roundtrip",
    "latest_by_key",
    "flatten_profiles",
    "results_for_date",
    "chart_series",
    "stream_decode_users",
    "run_daily",
]


def write_large_users(spark: SparkSession, sf_dir: str, copies: int) -> str:
    """``copies`` users per customer with their own ids and cities, and one hot country."""
    path = scratch(spark) + "/users"
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    users = t.full_users(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    users.select("*", copy).withColumn(
        "id", F.concat(F.lpad("copy", 8, "0"), F.substr("id", F.lit(9)))
    ).withColumn(
        "address",
        F.when(
            F.col("copy") % 3 == 0, F.regexp_replace("address", "[^,]*$", " Hotland")
        ).otherwise(F.regexp_replace("address", ", ", F.concat(F.lit(", "), "copy", F.lit(" ")))),
    ).drop("copy").write.parquet(path)
    return path


def large_queries(spark: SparkSession, path: str) -> dict[str, Callable[[], DataFrame]]:
    users = spark.read.parquet(path)
    t.messages(users).write.parquet(f"{path}-messages")
    messages = spark.read.parquet(f"{path}-messages")

    def four_scans() -> DataFrame:
        parts = [
            f(users, t.AS_OF)
            for f in (
                age_distribution,
                gender_distribution,
                city_distribution,
                country_distribution,
            )
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])

    return {
        "large_daily_distributions": lambda: daily_distributions(users, t.AS_OF),
        "large_four_distributions": four_scans,
        "large_latest_by_key": lambda: latest_by_key(
            users.select("username", "gender", "address", "dob", "id"), ["username"], ["id"]
        ),
        "large_classify_users": lambda: classify_users(messages, ["seq"]),
    }


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(query: Callable[[], DataFrame], runs: int) -> float:
    run(query())
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run(query())
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    copies = int(os.environ.get("BENCH_COPIES", "200"))
    spark = local_session("bench", cpus)
    queries = {name: (lambda q=QUERIES[name]: q(spark, sf_dir)) for name in HEADLINE}
    if copies:
        queries.update(large_queries(spark, write_large_users(spark, sf_dir, copies)))
    seconds = {name: median_seconds(query, runs) for name, query in queries.items()}
    spark.stop()
    line = {
        "metric": "total median seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
