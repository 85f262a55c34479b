"""Adapters from the driver's test tables to the reference's input shapes.

They are Spark expressions over the given tables (so their work grows with the
tables) and are used by the registered queries, tests and the benchmark.  The
same rules are written in SQL in ``__spark_entry__.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values of the fixture mapping ---------------------------------------
# testdata event types admitted to silver, and the roll-up counters over them
FIXTURE_VALID_TYPES = ("click", "purchase", "signup", "view")
FIXTURE_COUNTERS = {"watch_count": "click", "fork_count": "signup", "push_count": "view"}
# order status -> cluster state
ORDER_STATE = {"O": "RUNNING", "P": "RESIZING", "F": "TERMINATED"}
FIXTURE_EPOCH = "2024-01-01 00:00:00"
# --------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_events(events: DataFrame) -> DataFrame:
    """``events`` -> nested raw archive events (id, type, actor, repo, org,
    created_at, public)."""
    uid, eid = F.col("user_id"), F.col("event_id")
    return events.select(
        eid.cast("string").alias("id"),
        F.col("event_type").alias("type"),
        F.struct(F.concat(F.lit("user_"), uid.cast("string")).alias("login"), uid.alias("id")).alias("actor"),
        F.struct(
            F.concat(F.lit("repo_"), (uid % 40).cast("string")).alias("name"), (uid % 40).alias("id")
        ).alias("repo"),
        F.when(eid % 3 != 0, F.struct(F.concat(F.lit("org_"), (uid % 5).cast("string")).alias("login"))).alias(
            "org"
        ),
        F.col("ts").cast("string").alias("created_at"),
        (eid % 2 == 0).alias("public"),
    )


def fixture_ssn(custkey: str = "c_custkey"):
    k = F.col(custkey)

    def pad(x, n):
        return F.lpad(x.cast("string"), n, "0")

    made = F.concat_ws("-", pad(100 + k % 500, 3), pad(1 + k % 98, 2), pad(1 + k % 9998, 4))
    return (
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 0, F.lit("912-70-1234"))
        .when(k % 13 == 0, F.lit("000-12-3456"))
        .when(k % 17 == 0, F.lit("n/a"))
        .otherwise(made)
    )


def customers(customer: DataFrame) -> DataFrame:
    """``customer`` -> customer feed rows (customer_id, customer_name, ssn,
    account_balance, record_id, source_system, event_ts).  Deterministic ids and
    times (the reference uses uuid() / now(), which no comparison can pin)."""
    k = F.col("c_custkey")
    return customer.select(
        k.cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        fixture_ssn().alias("ssn"),
        F.col("c_acctbal").alias("account_balance"),
        F.concat(F.lit("r"), k.cast("string")).alias("record_id"),
        F.lit("seed").alias("source_system"),
        (F.lit(FIXTURE_EPOCH).cast("timestamp") + F.make_interval(secs=k.cast("int"))).alias("event_ts"),
    )


def customer_second_load(customer: DataFrame) -> DataFrame:
    """The second load of the customer feed (30 days later): every customer with
    ``c_custkey % 5 == 0`` corrects the SSN to a valid one and every third
    customer gets a new balance."""
    k = F.col("c_custkey")
    made = F.concat_ws(
        "-",
        F.lpad((100 + k % 500).cast("string"), 3, "0"),
        F.lpad((1 + k % 98).cast("string"), 2, "0"),
        F.lpad((1 + k % 9998).cast("string"), 4, "0"),
    )
    return customer.select(
        k.cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(k % 5 == 0, made).otherwise(fixture_ssn()).alias("ssn"),
        F.when(k % 3 == 0, F.col("c_acctbal") + 100.0).otherwise(F.col("c_acctbal")).alias("account_balance"),
        F.concat(F.lit("s"), k.cast("string")).alias("record_id"),
        F.lit("seed").alias("source_system"),
        (F.lit(FIXTURE_EPOCH).cast("timestamp") + F.make_interval(days=F.lit(30), secs=k.cast("int"))).alias(
            "event_ts"
        ),
    )


def customer_changes(customer: DataFrame) -> DataFrame:
    """Both loads of the customer feed: ``customers`` then ``customer_second_load``."""
    return customers(customer).unionByName(customer_second_load(customer))


def cluster_samples(orders: DataFrame) -> DataFrame:
    """``orders`` -> cluster-state samples (run_id, sampled_at, cluster_id, state,
    num_workers, queries_run)."""
    status = F.col("o_orderstatus")
    state = F.lit(None).cast("string")
    for code, name in ORDER_STATE.items():
        state = F.when(status == code, F.lit(name)).otherwise(state)
    return orders.select(
        F.concat(F.lit("run_"), (F.col("o_orderkey") % 50).cast("string")).alias("run_id"),
        F.col("o_orderdate").cast("timestamp").alias("sampled_at"),
        F.concat(F.lit("cluster_"), (F.col("o_custkey") % 7).cast("string")).alias("cluster_id"),
        state.alias("state"),
        (F.col("o_orderkey") % 4).cast("int").alias("num_workers"),
        (F.col("o_custkey") % 3).cast("bigint").alias("queries_run"),
    )


LOCATIONS = 50  # users are grouped into this many API locations (a bounded source configuration)


def location_id(user_id: str = "user_id"):
    return (F.col(user_id) % LOCATIONS).alias("location_id")


def location_of(loc: str = "location_id"):
    """Deterministic name and coordinates of a location."""
    u = F.col(loc)
    return (
        F.concat(F.lit("loc_"), u.cast("string")).alias("location_name"),
        (F.lit(40.0) + (u % 10).cast("double")).alias("latitude"),
        (F.lit(-80.0) - (u % 7).cast("double")).alias("longitude"),
    )


def hourly_readings(events: DataFrame) -> DataFrame:
    """One reading per (location, hour): the largest ``value`` of its users' events."""
    return events.groupBy(location_id(), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.max("value").alias("reading")
    )


def api_responses(events: DataFrame) -> DataFrame:
    """Per (location, day): an API-style JSON body with parallel hourly arrays.

    Readings are aggregated per hour first (partial aggregation over all
    events), so a body holds at most 24 elements however many events a hot
    location-day has.
    """
    hourly = hourly_readings(events)
    per_day = hourly.groupBy("location_id", F.date_trunc("day", "hour").cast("timestamp_ntz").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct("hour", "reading"))).alias("h")
    )
    name, lat, lon = location_of()
    body = F.to_json(
        F.struct(
            F.struct(
                F.transform("h", lambda e: F.date_format(e["hour"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                F.transform("h", lambda e: e["reading"]).alias("temperature_2m"),
            ).alias("hourly"),
            F.struct(F.lit("°C").alias("temperature_2m")).alias("hourly_units"),
            lat,
            lon,
            F.lit(100.0).alias("elevation"),
            F.lit(0.25).alias("generationtime_ms"),
            F.lit(0).alias("utc_offset_seconds"),
            F.lit("GMT").alias("timezone"),
            F.lit("GMT").alias("timezone_abbreviation"),
        )
    )
    return per_day.select("location_id", "day", name, body.alias("body"))


def location_ranges(events: DataFrame) -> DataFrame:
    """Per user: [first hour, last event) — the range a sliced source covers."""
    return events.groupBy("user_id").agg(
        F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").alias("start"), F.max("ts").alias("end")
    )


# ------------------------------------------------------------------ file drops for the streamed flows
RECORDS_PER_FILE = 2500
# Beyond this many files a drop's files hold more rows, and not more files: a stream takes a fixed number of files a batch.
FILES_PER_DROP = 40


def records_per_file(rows: DataFrame) -> int:
    """The most rows that a file of a drop of ``rows`` holds."""
    return max(RECORDS_PER_FILE, -(-rows.count() // FILES_PER_DROP))


def raw_event_lines(events: DataFrame, mutate: bool = True) -> DataFrame:
    """JSON lines of raw events.  With ``mutate``: every 50th event carries an
    unknown ``extra_field``, every 77th a mistyped ``public`` ("yes"), every 59th
    a mistyped ``repo.id`` ("none"), and every 83rd is cut off (a corrupt line)."""
    line = F.to_json(F.struct(*[F.col(c) for c in raw_events(events).columns]))
    df = raw_events(events).select(F.col("id").cast("bigint").alias("__eid"), line.alias("value"))
    if mutate:
        eid, v = F.col("__eid"), F.col("value")
        v = F.when(eid % 77 == 0, F.regexp_replace(v, '"public":(true|false)', '"public":"yes"')).otherwise(v)
        v = F.when(eid % 59 == 0, F.regexp_replace(v, '("repo":.*?"id":)[0-9]+', '$1"none"')).otherwise(v)
        v = F.when(eid % 50 == 0, F.concat(F.substring(v, 1, F.length(v) - 1), F.lit(',"extra_field":123}'))).otherwise(v)
        v = F.when(eid % 83 == 0, F.concat(F.lit("cut "), eid.cast("string"))).otherwise(v)
        df = df.select(v.alias("value"))
    return df.select("value")


def write_event_drop(events: DataFrame, folder: str, mutate: bool = True) -> str:
    """Write raw event JSON lines as several files (no shuffle: split by count)."""
    raw_event_lines(events, mutate).write.option("maxRecordsPerFile", records_per_file(events)).mode("overwrite").text(folder)
    return folder


def write_plain_drop(rows: DataFrame, folder: str, part: int) -> None:
    """Rows of any table as JSON lines (times as text).  Part 1 carries an unknown key ``added``, and every 14th
    (7, 21, ...) a mistyped ``value``."""
    columns = [F.col(c).cast("string").alias(c) if t.startswith("timestamp") else F.col(c) for c, t in rows.dtypes]
    more = [F.lit(1).alias("added")] if part else []
    line = F.to_json(F.struct(*columns, *more))
    if part:
        line = F.when(F.col("event_id") % 14 == 7, F.regexp_replace(line, '"value":[^,}]+', '"value":"n/a"')).otherwise(line)
    writer = rows.select(line.alias("value")).write.option("maxRecordsPerFile", records_per_file(rows))
    writer.mode("append" if part else "overwrite").text(folder)


def write_customer_csv_drop(customer: DataFrame, folder: str) -> str:
    """Three CSV batches whose headers differ: (id, name, balance); + segment;
    reordered + nation."""
    k = F.col("c_custkey")
    base = customer.select(
        k.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_acctbal").alias("account_balance"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        k,
    )
    groups = [
        base.filter(k % 3 == 0).select("customer_id", "customer_name", "account_balance"),
        base.filter(k % 3 == 1).select("customer_id", "customer_name", "account_balance", "segment"),
        base.filter(k % 3 == 2).select("segment", "account_balance", "customer_id", "customer_name", "nation"),
    ]
    most = records_per_file(customer)
    for i, g in enumerate(groups):
        g.write.option("header", "true").option("maxRecordsPerFile", most).mode(
            "overwrite" if i == 0 else "append"
        ).csv(folder)
    return folder


def write_customer_code_drop(customer: DataFrame, folder: str, part: int, mode: str) -> None:
    """CSV files of the customers of even (0: codes of nine digits) or odd keys (1:
    codes with a letter, and a further column); a header holds a dot."""
    k = F.col("c_custkey")
    digits, letters = F.lpad(k.cast("string"), 9, "0"), F.concat(F.lit("x"), k.cast("string"))
    more = [F.col("c_nationkey").alias("nation")] if part else []
    customer.filter(k % 2 == part).select(
        (letters if part else digits).alias("customer_code"),
        F.col("c_name").alias("customer_name"),
        F.col("c_acctbal").alias("account.balance"),
        *more,
    ).write.option("header", "true").mode(mode).csv(folder)


def write_customer_feed(customer: DataFrame, folder: str) -> str:
    """The two customer loads appended one after the other (append-only table)."""
    customers(customer).write.mode("overwrite").parquet(folder)
    customer_second_load(customer).write.mode("append").parquet(folder)
    return folder


def write_api_responses(events: DataFrame, folder: str) -> str:
    """API bodies as JSON lines per location folder (``location_name=<name>``).

    Clustered by location first, so each location folder is written by one task
    (one file) instead of one file per task per location."""
    # explicit count: AQE may not coalesce it into one task writing every folder
    parts = 2 * events.sparkSession.sparkContext.defaultParallelism
    bodies = api_responses(events).select("location_name", "body").repartition(parts, "location_name")
    bodies.write.partitionBy("location_name").mode("overwrite").text(folder)
    return folder


def fixture_locations(events: DataFrame) -> DataFrame:
    """Distinct locations (at most ``LOCATIONS``) with coordinates."""
    name, lat, lon = location_of()
    return events.select(location_id()).distinct().select(name.alias("name"), lat, lon)
