"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks import tables as t
from checks.scratch import scratch
from rollcall.functions import parse_dob
from rollcall.operators import (
    age_distribution,
    chart_arrays,
    chart_series,
    city_distribution,
    classify_users,
    country_distribution,
    daily_distributions,
    decode_users,
    flatten_profiles,
    gender_distribution,
    latest_by_key,
    reject_counts,
    rejected_for_analysis,
    share,
    split_profiles,
    split_valid,
    watch_rejects,
    with_address_part,
    with_age,
    with_bins,
    with_places,
)
from rollcall.plans import DailyPaths, run_daily, run_produce, run_rejects
from rollcall.schema import DIMENSIONS, USER_FIELDS, message_schema
from rollcall.sources import (
    Snapshot,
    append_user_log,
    compact_users,
    ensure_changes,
    ensure_tables,
    fold_changes,
    latest_users,
    publish_current_users,
    publish_version,
    read_chart_series,
    read_raw_profiles,
    read_refused,
    read_result_days,
    read_results,
    read_user_log,
    users_by_id,
    write_chart_series,
    write_results,
    write_user_messages,
)
from rollcall.streaming import IngestProgress, run_ingest

# Everyone alive today is past 70 on this date, so four of the five age groups are empty.
FAR_AS_OF = "2100-06-30"
# Orders of this day and later play the messages that arrive after the first snapshot.
SNAPSHOT_DAY = "1998-01-01"


# --- scans, projections ---------------------------------------------------------------------


def scan_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.users(spark, sf_dir)


def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_profiles(t.profiles(spark, sf_dir), id_from=["login.username"])


def _land_responses(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """One API response per customer, as lines of JSON."""
    response = F.struct(F.array(F.struct("*")).alias("results"))
    t.profiles(spark, sf_dir).select(F.to_json(response).alias("value")).write.text(folder)


def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses landed as JSON lines, read back, flattened; without those lacking an address."""
    landed = scratch(spark) + "/landed"
    _land_responses(spark, sf_dir, landed)
    users = flatten_profiles(read_raw_profiles(spark, landed), id_from=["login.username"])
    return split_profiles(users)[0]


def first_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of two profiles each, and of none: the first profile is the user."""
    landed = scratch(spark) + "/landed"
    people = t.profiles(spark, sf_dir)
    other = F.struct(*[
        F.concat(F.lit("other-"), "email").alias("email") if c == "email" else F.col(c) for c in people.columns
    ])
    both = people.select(F.array(F.struct("*"), other).alias("results"))
    none = people.select(F.slice(F.array(F.struct("*")), 1, 0).alias("results"))
    responses = both.unionByName(none).select(F.to_json(F.struct("results")).alias("value"))
    responses.write.text(landed)
    return flatten_profiles(read_raw_profiles(spark, landed), id_from=["login.username"]).select("id", "email")


def random_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are drawn: how many, how many different ones, and whether all are version 4 UUIDs."""
    ids = flatten_profiles(t.profiles(spark, sf_dir)).select("id")
    shape = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return ids.agg(
        F.count("*").alias("ids"), F.count_distinct("id").alias("different"),
        F.bool_and(F.col("id").rlike(shape)).alias("all_uuids"),
    )


def profiles_by_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole addresses and lacking ones, told apart."""
    users = flatten_profiles(t.profiles(spark, sf_dir), id_from=["login.username"])
    whole, lacking = split_profiles(users)
    return whole.select("id", F.lit(True).alias("whole")).unionByName(
        lacking.select("id", F.lit(False).alias("whole"))
    )


def parse_dob_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = parse_dob(F.col("dob")).cast("string")
    return t.users(spark, sf_dir).select("id", born.alias("born"))


def parse_dob_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = parse_dob(F.col("dob")).cast("string")
    return t.event_profiles(spark, sf_dir).select("id", born.alias("born"))


def age_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_age(t.users(spark, sf_dir), t.AS_OF).select("id", "age")


def age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    aged = with_age(t.users(spark, sf_dir), t.AS_OF)
    return with_bins(aged, "age", "age_group").select("id", "age_group")


def address_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_address_part(t.users(spark, sf_dir), -1, "country").select("id", "country")


def address_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_address_part(t.users(spark, sf_dir), -2, "city").select("id", "city")


def address_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = with_address_part(t.event_profiles(spark, sf_dir), -1, "country")
    return with_address_part(parts, -2, "city").select("id", "country", "city")


def analysis_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_for_analysis(t.event_profiles(spark, sf_dir))


# --- distributions --------------------------------------------------------------------------


def event_type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share(t.table(spark, sf_dir, "events"), "event_type")


def event_type_share_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a list that lacks one of the types and has one that never occurs."""
    return share(t.table(spark, sf_dir, "events"), "event_type", t.DECLARED_EVENT_TYPES)


def gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gender_distribution(t.users(spark, sf_dir), t.AS_OF)


def age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return age_distribution(t.users(spark, sf_dir), t.AS_OF)


def age_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return age_distribution(t.users(spark, sf_dir), FAR_AS_OF)


def country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_distribution(t.users(spark, sf_dir), t.AS_OF)


def city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_distribution(t.users(spark, sf_dir), t.AS_OF)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_distributions(t.users(spark, sf_dir), t.AS_OF)


def daily_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons for rejection, counted while the distributions of the same users are written."""
    users = t.event_profiles(spark, sf_dir).withColumn("gender", F.lit("any"))
    watched, seen = watch_rejects(users)
    write_results(daily_distributions(watched, t.AS_OF), scratch(spark) + "/results")
    return reject_counts(spark, seen)


def daily_from_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day out of the counts of the day before, corrected by the users that have changed."""
    paths = replace(_daily_paths(base := scratch(spark)), counts=f"{base}/counts")
    _append_log(t.full_users(spark, sf_dir), paths.log, "0", "2024-06-01")
    run_daily(spark, paths, t.AS_OF, "files")
    _append_log(t.user_updates(spark, sf_dir), paths.log, "1", t.NEXT_DAY)
    return run_daily(spark, paths, t.NEXT_DAY, "files", previous=t.AS_OF)


# --- messages and the keyed table -----------------------------------------------------------


def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_users(t.messages(t.full_users(spark, sf_dir)))


def decode_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_users(t.event_messages(spark, sf_dir), ["event_id"])
    return decoded.select("event_id", "id", "gender", "post_code", "dob")


def classify_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = classify_users(t.event_messages(spark, sf_dir), ["event_id"])
    return classified.select("event_id", "id", "gender", "post_code", "raw", "reason")


def split_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, refused = split_valid(t.event_messages(spark, sf_dir), ["event_id"])
    accepted = valid.select("event_id", "id", F.lit(None).cast("string").alias("reason"))
    return accepted.unionByName(
        refused.select("event_id", F.lit(None).cast("string").alias("id"), "reason")
    )


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("string").alias("ts"), "event_id", "event_type", "value"
    )
    return latest_by_key(events, ["user_id"], ["ts", "event_id"])


def _land(spark: SparkSession, messages: DataFrame, folder: str) -> None:
    """Message files, at least three and as many as the cluster has cores."""
    files = max(3, spark.sparkContext.defaultParallelism)
    write_user_messages(messages.repartition(files), folder, kind="files")


def _start_ingest(
    spark: SparkSession, folder: str, base: str, changes: str | None = None
) -> StreamingQuery:
    """The stream over what is new in ``folder``, in several micro-batches."""
    per_batch = max(1, spark.sparkContext.defaultParallelism // 3)
    return run_ingest(
        spark,
        folder,
        f"{base}/log",
        f"{base}/checkpoint",
        kind="files",
        trigger={"availableNow": True},
        changes=changes,
        maxFilesPerTrigger=per_batch,
    )


def _ingest(spark: SparkSession, folder: str, base: str, changes: str | None = None) -> str:
    """Run the stream to the end of what is there; the path of the log."""
    _start_ingest(spark, folder, base, changes).awaitTermination()
    return f"{base}/log"


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark)
    _land(spark, t.messages(t.full_users(spark, sf_dir)), f"{base}/messages")
    log = _ingest(spark, f"{base}/messages", base)
    return read_user_log(spark, log, "files").select(*USER_FIELDS, "reason")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer announces itself, then every order changes its customer's profile."""
    base = scratch(spark)
    _land(spark, t.messages(t.full_users(spark, sf_dir)), f"{base}/messages")
    _ingest(spark, f"{base}/messages", base)
    _land(spark, t.messages(t.user_updates(spark, sf_dir)), f"{base}/messages")
    return latest_users(spark, _ingest(spark, f"{base}/messages", base), "files")


def stream_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused messages of a stream that is mostly defective."""
    base = scratch(spark)
    messages = t.event_messages(spark, sf_dir).withColumnRenamed("event_id", "seq")
    _land(spark, messages, f"{base}/messages")
    return read_refused(spark, _ingest(spark, f"{base}/messages", base), "files")


def produce_and_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses to messages to the keyed table, both steps as streams."""
    base = scratch(spark)
    _land_responses(spark, sf_dir, f"{base}/landed")
    run_produce(
        spark,
        f"{base}/landed",
        f"{base}/messages",
        f"{base}/published",
        kind="files",
        id_from=["login.username"],
        trigger={"availableNow": True},
    ).awaitTermination()
    return latest_users(spark, _ingest(spark, f"{base}/messages", base), "files")


def produce_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two responses per customer in one batch and one file: the later line is the user."""
    base = scratch(spark)
    people = t.profiles(spark, sf_dir)
    turns = people.withColumn("phone", F.lit("first")).unionByName(
        people.withColumn("phone", F.concat(F.lit("second-"), "phone"))
    )
    response = F.struct(F.array(F.struct("*")).alias("results"))
    lines = turns.select("email", "phone", F.to_json(response).alias("value"))
    # All first responses of a file come before all second ones.
    lines = lines.repartition(3, "email").sortWithinPartitions("phone")
    lines.select("value").write.text(f"{base}/landed")
    run_produce(
        spark, f"{base}/landed", f"{base}/messages", f"{base}/published", kind="files",
        id_from=["login.username"], trigger={"availableNow": True},
    ).awaitTermination()
    return latest_users(spark, _ingest(spark, f"{base}/messages", base), "files")


def profile_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with paths knocked out by key: how many are published, and why others are not."""
    base = scratch(spark)
    key = F.substr("email", F.lit(5)).substr(F.lit(1), F.instr("email", "@") - 5).cast("long")
    people = t.profiles(spark, sf_dir).withColumn("k", key)
    for column, rest in (("login", 3), ("dob", 4), ("phone", 5)):
        kept = F.when(F.col("k") % 10 != rest, F.col(column))
        people = people.withColumn(column, kept)
    found = F.when(F.col("k") % 10 != 6, F.array(F.struct(*people.drop("k").columns)))
    response = F.struct(found.alias("results"))
    people.select(F.to_json(response).alias("value")).write.text(f"{base}/landed")
    how = {"id_from": ["login.username"], "trigger": {"availableNow": True}}
    run_produce(
        spark, f"{base}/landed", f"{base}/messages", f"{base}/c1", kind="files", **how
    ).awaitTermination()
    run_rejects(spark, f"{base}/landed", f"{base}/rejected", f"{base}/c2", **how).awaitTermination()
    published = spark.read.schema(message_schema("files")).parquet(f"{base}/messages")
    rejected = spark.read.schema("raw string, reason string").parquet(f"{base}/rejected")
    reasons = rejected.select("reason").unionByName(
        published.select(F.lit("published").alias("reason"))
    )
    return reasons.groupBy("reason").agg(F.count("*").alias("n"))


def _append_log(records: DataFrame, log: str, batch: str = "0", day: str = t.AS_OF) -> None:
    """Classified messages as one batch of the log, spread over the cores like a topic's."""
    spread = records.repartition(records.sparkSession.sparkContext.defaultParallelism)
    classified = classify_users(t.messages(spread), ["seq"])
    append_user_log(classified, log, batch, day, "files")


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the older updates, then a second one from it and the newer updates."""
    base = scratch(spark)
    log = f"{base}/log"
    updates = t.user_updates(spark, sf_dir)
    before = F.col("o_orderdate") < F.lit(SNAPSHOT_DAY).cast("timestamp_ntz")
    _append_log(updates.where(before), log)
    first, second = _snapshot(base, "first"), _snapshot(base, "second")
    spark.sql(f"CREATE DATABASE {first.table.split('.')[0]} LOCATION '{base}/database'")
    compact_users(spark, log, first, "files")
    _append_log(updates.where(~before), log, "1")
    first_day = F.expr(t.update_seq(f"'{SNAPSHOT_DAY}'").removesuffix(" + o_orderkey"))
    newer = F.col("seq") >= first_day
    return compact_users(spark, log, second, "files", first, newer).drop("seq")


def log_after_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the raw log by reason, after a stream that was stopped and started three times."""
    base = scratch(spark)
    messages = t.event_messages(spark, sf_dir).withColumnRenamed("event_id", "seq")
    for part in range(2):
        _land(spark, messages.where(F.col("seq") % 2 == part), f"{base}/messages")
        log = _ingest(spark, f"{base}/messages", base)
    log = read_user_log(spark, _ingest(spark, f"{base}/messages", base), "files")
    return log.groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("seq").alias("messages"))


def ingest_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener saw of an ingestion in several batches, most of it defective."""
    base = scratch(spark)
    messages = t.event_messages(spark, sf_dir).withColumnRenamed("event_id", "seq")
    _land(spark, messages, f"{base}/messages")
    progress = IngestProgress()
    spark.streams.addListener(progress)
    try:
        progress.wait(_start_ingest(spark, f"{base}/messages", base))
    finally:
        spark.streams.removeListener(progress)
    seen = progress.frame(spark)
    sums = [F.sum(c).alias(c) for c in ("read", "accepted", "refused", "lost")]
    return seen.agg((F.count_distinct("batch") > 1).alias("several_batches"), *sums)


def users_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The richest customer of every nation, looked up by id in a snapshot of all."""
    base = scratch(spark)
    _append_log(t.full_users(spark, sf_dir), f"{base}/log")
    snapshot = _snapshot(base, "lookup")
    spark.sql(f"CREATE DATABASE {_database(base)} LOCATION '{base}/database'")
    compact_users(spark, f"{base}/log", snapshot, "files")
    richest = latest_by_key(
        t.table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_acctbal", "c_custkey"]
    ).selectExpr(f"upper({t.uuid_of('c_custkey')}) as id")
    return users_by_id(spark, snapshot, richest, "files").drop("seq")


def created_users_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of users: a snapshot of the customers, and the orders' updates as change sets."""
    base = scratch(spark)
    database, buckets = _database(base), spark.sparkContext.defaultParallelism
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    changes, snapshot = f"{database}.changes", _snapshot(base, "current")
    ensure_changes(spark, changes, buckets, "files")
    _land(spark, t.messages(t.full_users(spark, sf_dir)), f"{base}/messages")
    _ingest(spark, f"{base}/messages", base, changes)
    fold_changes(spark, changes, snapshot, kind="files")
    _land(spark, t.messages(t.user_updates(spark, sf_dir)), f"{base}/messages")
    _ingest(spark, f"{base}/messages", base, changes)
    publish_current_users(spark, changes, database, snapshot, "files")
    return spark.table(f"{database}.created_users")


def _database(base: str) -> str:
    """A database name of its own for every scratch folder."""
    return "rollcall_" + base[-8:].replace("-", "_").lower()


def _snapshot(base: str, name: str) -> Snapshot:
    return Snapshot(f"{base}/{name}", f"{_database(base)}.{name}")


# --- stored results and charts --------------------------------------------------------------


def _stored_day(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark) + "/results"
    write_results(daily(spark, sf_dir), path)
    return path


def _stored_days(spark: SparkSession, sf_dir: str) -> str:
    """Two days of results."""
    path = scratch(spark) + "/results"
    people = t.users(spark, sf_dir)
    first, second = (daily_distributions(people, day) for day in (t.AS_OF, t.NEXT_DAY))
    write_results(first.unionByName(second), path)
    return path


def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of results, the second day written again over a day of other users."""
    path = scratch(spark) + "/results"
    people = t.users(spark, sf_dir)
    write_results(daily_distributions(people, t.AS_OF), path)
    write_results(daily_distributions(t.user_updates(spark, sf_dir), t.NEXT_DAY), path)
    write_results(daily_distributions(people, t.NEXT_DAY), path)
    return read_result_days(spark, path)


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City shares of the customers, overlaid with those of the order updates."""
    path = scratch(spark) + "/results"
    write_results(city_distribution(t.users(spark, sf_dir), t.AS_OF), path)
    newer = daily_distributions(t.user_updates(spark, sf_dir), t.AS_OF)
    write_results(newer, path, mode="merge", as_of=t.AS_OF)
    return read_result_days(spark, path)


def results_for_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_results(spark, _stored_days(spark, sf_dir), "country", t.NEXT_DAY)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chart_series(read_result_days(spark, _stored_day(spark, sf_dir)))


def arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lists, element by element."""
    lists = chart_arrays(read_result_days(spark, _stored_day(spark, sf_dir)))
    bars = F.posexplode(F.arrays_zip("categories", "percentages")).alias("position", "bar")
    return lists.select("dimension", "analysis_date", "chunk", bars).select(
        "dimension",
        "analysis_date",
        "chunk",
        "position",
        F.col("bar.categories").alias("category"),
        F.col("bar.percentages").alias("percentage"),
    )


def arrays_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charts cut into lists of a few bars: the chunks in order are the whole, largest first."""
    lists = chart_arrays(read_result_days(spark, _stored_day(spark, sf_dir)), max_items=4)
    earlier = Window.partitionBy("dimension", "analysis_date").orderBy("chunk")
    before = F.sum(F.size("categories")).over(earlier) - F.size("categories")
    placed = lists.withColumn("before", before)
    return placed.select(
        "dimension", "analysis_date", "before", F.posexplode("percentages")
    ).select(
        "dimension",
        "analysis_date",
        (F.col("before") + F.col("pos")).alias("position"),
        F.col("col").alias("percentage"),
    )


def upsert_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day written again by users without a gender: results and charts of it are gone."""
    base = scratch(spark)
    people = t.users(spark, sf_dir)
    for users in (people, people.withColumn("gender", F.lit(None).cast("string"))):
        write_results(daily_distributions(users, t.AS_OF), f"{base}/results", as_of=t.AS_OF)
        stored = read_result_days(spark, f"{base}/results")
        write_chart_series(chart_series(stored), f"{base}/charts", t.AS_OF)
    charts = read_chart_series(spark, f"{base}/charts").select("dimension", "category")
    return stored.select(F.lit("results").alias("kind"), "dimension", "category").unionByName(
        charts.select(F.lit("charts").alias("kind"), "dimension", "category")
    )


def views_over_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables made twice over days that were stored before: the views show every day."""
    base = scratch(spark)
    path = _stored_days(spark, sf_dir)
    database = _database(base)
    for _ in range(2):
        ensure_tables(spark, f"{base}/log", path, database, "files", f"{base}/db")
    return spark.table(f"{database}.country")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bar with its place, from charts cut into lists of three."""
    lists = chart_arrays(read_result_days(spark, _stored_day(spark, sf_dir)), max_items=3)
    bars = F.posexplode(F.arrays_zip("categories", "percentages")).alias("at", "bar")
    return lists.select("dimension", "analysis_date", "chunk", bars).select(
        "dimension", "analysis_date", (F.col("chunk") * 3 + F.col("at")).cast("long").alias("place"),
        F.col("bar.categories").alias("category"), F.col("bar.percentages").alias("percentage"),
    )


def event_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's place in time among those of its type, the longest lists of the tables."""
    events = t.table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    placed = with_places(events, ["event_type"], [F.asc("ts"), F.asc("event_id")])
    return placed.select("event_type", "event_id", "place")


def republished_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day published at once, then published again over other users: before and after."""
    base = scratch(spark)
    database = _database(base)
    ensure_tables(spark, f"{base}/log", f"{base}/results", database, "files", f"{base}/db")
    shown = []
    for n, people in enumerate((t.users(spark, sf_dir), t.user_updates(spark, sf_dir))):
        day = daily_distributions(people, t.AS_OF)
        publish_version(spark, day, f"{base}/results", t.AS_OF, database)
        views = [f"SELECT '{d}' AS dimension, {c} AS category, percentage FROM {database}.{d}" for d, c in DIMENSIONS.items()]
        now = spark.sql(" UNION ALL ".join(views)).withColumn("version", F.lit(n))
        now.write.parquet(f"{base}/shown-{n}")
        shown.append(spark.read.parquet(f"{base}/shown-{n}"))
    return shown[0].unionByName(shown[1])


def chart_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart data of two days, written and read back."""
    charts = scratch(spark) + "/charts"
    results = read_result_days(spark, _stored_days(spark, sf_dir))
    write_chart_series(chart_series(results), charts)
    return read_chart_series(spark, charts).select(
        "analysis_date", "dimension", "file_name", "category", "label"
    )


def _daily_paths(base: str) -> DailyPaths:
    return DailyPaths(
        log=f"{base}/log",
        snapshots=f"{base}/snapshots",
        results=f"{base}/results",
        charts=f"{base}/charts",
        rejected=f"{base}/rejected",
        database=_database(base),
        database_location=f"{base}/database",
    )


def _run_daily(spark: SparkSession, sf_dir: str) -> DailyPaths:
    """The daily job on a log that holds several rows per user."""
    paths = _daily_paths(scratch(spark))
    _append_log(t.full_users(spark, sf_dir), paths.log)
    _append_log(t.user_updates(spark, sf_dir), paths.log, "1")
    run_daily(spark, paths, t.AS_OF, "files")
    return paths


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_result_days(spark, _run_daily(spark, sf_dir).results)


def tables_and_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What plain SQL finds after the daily job: every view of results, and the user count."""
    db = _run_daily(spark, sf_dir).database
    return spark.sql(
        f"""SELECT 'age' AS source, age_group AS name, percentage FROM {db}.age
        UNION ALL SELECT 'gender', gender, percentage FROM {db}.gender
        UNION ALL SELECT 'city', city, percentage FROM {db}.city
        UNION ALL SELECT 'country', country, percentage FROM {db}.country
        UNION ALL SELECT 'created_users', max(last_name), cast(count(*) AS double)
        FROM {db}.created_users"""
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_users": scan_users,
    "flatten_profiles": flatten,
    "raw_profiles": raw_profiles,
    "raw_profiles_first": first_profile,
    "random_ids": random_ids,
    "split_profiles": profiles_by_address,
    "parse_dob": parse_dob_users,
    "parse_dob_variants": parse_dob_variants,
    "age_years": age_years,
    "age_group": age_group,
    "address_country": address_country,
    "address_city": address_city,
    "address_variants": address_variants,
    "analysis_rejects": analysis_rejects,
    "share": event_type_share,
    "share_declared": event_type_share_declared,
    "gender_distribution": gender,
    "age_distribution": age,
    "age_distribution_zero_fill": age_zero_fill,
    "country_distribution": country,
    "city_distribution": city,
    "daily_distributions": daily,
    "daily_reject_counts": daily_reject_counts,
    "daily_from_changes": daily_from_changes,
    "encode_roundtrip": encode_roundtrip,
    "decode_users": decode_event_messages,
    "classify_users": classify_event_messages,
    "split_valid": split_event_messages,
    "latest_by_key": latest_event,
    "stream_decode_users": stream_decode,
    "stream_upsert_users": stream_upsert,
    "stream_refused": stream_refused,
    "log_after_restart": log_after_restart,
    "ingest_progress": ingest_progress,
    "produce_and_ingest": produce_and_ingest,
    "produce_repeated_profile": produce_repeated,
    "compact_users": compact,
    "users_by_id": users_by_key,
    "created_users_current": created_users_current,
    "upsert_results": upsert_replace,
    "upsert_results_merge": upsert_merge,
    "upsert_results_emptied": upsert_emptied,
    "views_over_existing_results": views_over_existing,
    "profile_rejects": profile_rejects,
    "chart_arrays_long": arrays_long,
    "results_for_date": results_for_date,
    "chart_series": series,
    "chart_arrays": arrays,
    "chart_places": places,
    "event_places": event_places,
    "chart_dataset": chart_dataset,
    "republished_day": republished_day,
    "run_daily": daily_job,
    "tables_and_views": tables_and_views,
}
