"""Readers and decoders, on the sample files or on files Spark derives from them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.names import normalize_columns, snake_columns
from meterline.functions.numbers import to_money
from meterline.queries.base import GREEN, RAW, ZONES, query
from meterline.schemas import DOUBLE, INT, LONG, TEXT, struct
from meterline.schemas import ZONES as ZONE_SCHEMA
from meterline.session import run_dir
from meterline.sinks.tables import rebalanced
from meterline.sources import catalog, files, messages, pages
from meterline.sources.sample import raw_trips, raw_zones, table
from meterline.streaming.jobs import replay_messages


@query("scan_parquet", "SELECT * FROM supplier")
def scan_parquet(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/supplier.parquet")


def land_monthly(spark, sf_dir, service: str, prefix: str) -> str:
    """Raw trips of a service as monthly Parquet folders."""
    root, month = run_dir(spark, "monthly"), f"{service}_tripdata_"
    trips = raw_trips(spark, sf_dir, service).withColumn(month, F.date_format(f"{prefix}_pickup_datetime", "yyyy-MM"))
    rebalanced(trips, month).write.partitionBy(month).parquet(root)
    return root


@query(
    "scan_parquet_glob",
    f"WITH {GREEN} SELECT VendorID, pickup AS lpep_pickup_datetime, PULocationID, trip_distance, total_amount FROM green",
)
def scan_parquet_glob(spark, sf_dir):
    root = land_monthly(spark, sf_dir, "green", "lpep")
    return files.read_monthly(spark, root, "green").select(
        "VendorID", "lpep_pickup_datetime", "PULocationID", "trip_distance", "total_amount"
    )


@query(
    "scan_zones",
    f"WITH {ZONES} SELECT location_id AS LocationID, borough AS Borough, zone AS Zone, service_zone FROM zones",
)
def scan_zones(spark, sf_dir):
    path = run_dir(spark, "zones")
    raw_zones(spark, sf_dir).write.option("header", "true").csv(path)
    return files.read_csv(spark, path, ZONE_SCHEMA)


@query(
    "scan_csv_gz",
    f"""WITH {RAW} SELECT CAST(year(pickup) AS BIGINT) AS year, CAST(month(pickup) AS BIGINT) AS month, COUNT(*) AS row_count,
    MIN(pickup) AS earliest, MAX(dropoff) AS latest, CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM raw WHERE line_status = 'O' GROUP BY ALL""",
)
def scan_csv_gz(spark, sf_dir):
    root, month = run_dir(spark, "csv"), "yellow_tripdata_"
    trips = raw_trips(spark, sf_dir, "yellow").withColumn(month, F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    (
        rebalanced(trips, month)
        .write.partitionBy(month)
        .option("header", "true")
        .option("compression", "gzip")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(root)
    )
    loaded = files.drop_missing_pickup(files.read_month_csv(spark, root, "yellow"), "yellow")
    return loaded.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("tpep_pickup_datetime").alias("earliest"),
        F.max("tpep_dropoff_datetime").alias("latest"),
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue"),
    )


@query("scan_pruned", "SELECT user_id, ts, value FROM events")
def scan_pruned(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "ts", "value")


@query(
    "external_table_profile",
    """SELECT COUNT(*) AS total_rows, MIN(l_shipdate) AS earliest_trip, MAX(l_shipdate) AS latest_trip FROM lineitem""",
)
def external_table_profile(spark, sf_dir):
    name = f"external_{uuid.uuid4().hex}"
    rows = files.external_table(spark, name, f"{sf_dir}/lineitem.parquet")
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("l_shipdate").alias("earliest_trip"),
        F.max("l_shipdate").alias("latest_trip"),
    )


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
)
def table_row_counts(spark, sf_dir):
    return catalog.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


@query(
    "table_sizes",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS row_count, COUNT(*) AS column_count, TRUE AS has_bytes
        FROM (DESCRIBE {t})"""
        for t in TABLES
    ),
)
def table_sizes(spark, sf_dir):
    sizes = catalog.table_sizes({t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES})
    return sizes.select("table_name", "row_count", "column_count", (F.col("size_bytes") > 0).alias("has_bytes"))


@query("normalize_columns", 'SELECT s_suppkey AS "supplier_key", s_name AS "supplier_name", s_acctbal AS "balance" FROM supplier')
def normalize(spark, sf_dir):
    spaced = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Supplier Key"), F.col("s_name").alias("Supplier Name"), F.col("s_acctbal").alias("Balance")
    )
    return normalize_columns(spaced)


@query(
    "snake_case_columns",
    "SELECT o_orderkey AS trip_key, o_orderdate AS trip_pickup_date_time, o_totalprice AS tip_amt FROM orders",
)
def snake_case(spark, sf_dir):
    camel = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("TripKey"),
        F.col("o_orderdate").alias("Trip_Pickup_DateTime"),
        F.col("o_totalprice").alias("Tip_Amt"),
    )
    return snake_columns(camel)


def green_messages(spark, sf_dir):
    """Events as green trip messages: errors hold NaN, views are cut short, signups have a bad time."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    whole = messages.to_message(
        [
            F.col("user_id").cast("int").alias("PULocationID"),
            (F.col("user_id") + 1).cast("int").alias("DOLocationID"),
            F.when(kind != "purchase", 1.0).alias("passenger_count"),
            F.col("value").alias("trip_distance"),
            F.col("value").alias("tip_amount"),
            F.col("value").alias("total_amount"),
            F.when(kind == "signup", "not a time").otherwise(stamp).alias("lpep_pickup_datetime"),
            stamp.alias("lpep_dropoff_datetime"),
        ]
    )
    spoiled = F.when(kind == "error", F.replace(whole, F.lit('"passenger_count":1.0'), F.lit('"passenger_count":NaN')))
    spoiled = spoiled.when(kind == "view", F.left(whole, F.length(whole) - 5)).otherwise(whole)
    return events.select(spoiled.alias("value"))


@query(
    "json_tolerant_decode",
    """SELECT CAST(user_id AS BIGINT) AS "PULocationID", CAST(CASE WHEN event_type <> 'purchase' THEN 1.0 END AS DOUBLE) AS passenger_count,
    value AS total_amount, date_trunc('second', ts) AS event_timestamp FROM events WHERE event_type NOT IN ('error', 'view', 'signup')""",
)
def json_tolerant_decode(spark, sf_dir):
    decoded = messages.decode_green_events(green_messages(spark, sf_dir))
    return decoded.select("PULocationID", "passenger_count", "total_amount", "event_timestamp")


def ride_messages(spark, sf_dir):
    """Events as ride messages."""
    events = table(spark, sf_dir, "events")
    return replay_messages(
        events.select(
            F.col("user_id").cast("int").alias("PULocationID"),
            (F.col("user_id") + 1).cast("int").alias("DOLocationID"),
            F.col("value").alias("trip_distance"),
            F.col("value").alias("total_amount"),
            F.unix_millis("ts").alias("tpep_pickup_datetime"),
        )
    )


RIDES_SQL = """SELECT user_id AS "PULocationID", user_id + 1 AS "DOLocationID", value AS trip_distance, value AS total_amount,
epoch_us(ts) // 1000 AS tpep_pickup_datetime, date_trunc('milliseconds', ts) AS event_timestamp FROM events"""


@query("ride_decode", RIDES_SQL)
def ride_decode(spark, sf_dir):
    return messages.decode_rides(ride_messages(spark, sf_dir))


@query(
    "replay_to_json",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value, CAST(ts AS VARCHAR) AS ts FROM events""",
)
def replay_to_json(spark, sf_dir):
    path = run_dir(spark, "replay")
    events = table(spark, sf_dir, "events")
    spoiled = events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        "ts",
    )
    replay_messages(spoiled).write.text(path)
    return messages.decode(spark.read.text(path), struct(event_id=LONG, value=DOUBLE, ts=TEXT))


PAGE_RECORD = struct(Event_Id=LONG, Payment_Type=TEXT, Tip_Amt=DOUBLE, Trip_Pickup_DateTime=TEXT)


@query(
    "paged_scan",
    "SELECT event_id, event_type AS payment_type, value AS tip_amt, CAST(ts AS VARCHAR) AS trip_pickup_date_time FROM events",
)
def paged_scan(spark, sf_dir):
    path = run_dir(spark, "pages")
    events = table(spark, sf_dir, "events").select(
        F.expr("event_id DIV 1000 + 1").alias("page"),
        F.col("event_id").alias("Event_Id"),
        F.col("event_type").alias("Payment_Type"),
        F.col("value").alias("Tip_Amt"),
        F.col("ts").cast("string").alias("Trip_Pickup_DateTime"),
    )
    pages.land_pages(events, "page", path)
    return pages.read_numbered_pages(spark, path, PAGE_RECORD)


BOOK_RECORD = struct(key=LONG, title=TEXT, author_name=T.ArrayType(TEXT), firstPublishYear=INT)


def _books(spark, sf_dir):
    """Parts as books, landed as offset pages of 100 and read back."""
    path = run_dir(spark, "books")
    parts = table(spark, sf_dir, "part")
    docs = parts.select(
        F.expr("p_partkey DIV 100 * 100").alias("page"),
        F.struct(
            F.col("p_partkey").alias("key"),
            F.col("p_name").alias("title"),
            F.split("p_name", " ").alias("author_name"),
            F.col("p_size").alias("firstPublishYear"),
        ).alias("doc"),
    )
    found = parts.agg(F.count(F.lit(1)).alias("n")).scalar()
    responses = docs.select("page", F.struct(found.alias("numFound"), F.array("doc").alias("docs")).alias("body"))
    responses.write.json(path)
    return pages.read_offset_pages(spark, path, BOOK_RECORD, 100)


@query(
    "paged_offset_scan",
    "SELECT p_partkey AS key, p_name AS title, CAST(p_size AS BIGINT) AS first_publish_year FROM part",
)
def paged_offset_scan(spark, sf_dir):
    return _books(spark, sf_dir).drop("author_name")


@query(
    "child_tables",
    """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)
    SELECT p_partkey AS parent_key, CAST(i AS BIGINT) AS position, words[i + 1] AS value
    FROM w, LATERAL (SELECT unnest(range(len(words))) AS i)""",
)
def child_tables(spark, sf_dir):
    _, children = pages.split_child_tables(_books(spark, sf_dir), "key")
    return children["author_name"]


@query(
    "scan_drifting",
    f"""WITH {GREEN} SELECT VendorID, RatecodeID, pickup AS lpep_pickup_datetime, total_amount, trip_type FROM green""",
)
def scan_drifting(spark, sf_dir):
    """Months of three kinds: as they should be, with BIGINT ids and DOUBLE codes, and without the trip type's number type."""
    root = run_dir(spark, "drifting")
    trips = raw_trips(spark, sf_dir, "green").withColumn("month", F.date_format("lpep_pickup_datetime", "yyyy-MM"))
    drift = [
        {},
        {"VendorID": F.col("VendorID").cast("bigint"), "RatecodeID": F.col("RatecodeID").cast("double")},
        {"trip_type": F.col("trip_type").cast("double"), "PULocationID": F.col("PULocationID").cast("bigint")},
    ]
    for kind, changed in enumerate(drift):
        part = trips.where(F.month("lpep_pickup_datetime") % len(drift) == kind).withColumns(changed)
        rebalanced(part, "month").write.mode("append").partitionBy("month").parquet(f"{root}/{kind}")
    merged = [files.read_drifting(spark, _months_below(spark, f"{root}/{kind}"), files.get_schema("green")) for kind in range(len(drift))]
    wanted = ["VendorID", "RatecodeID", "lpep_pickup_datetime", "total_amount", "trip_type"]
    return reduce(DataFrame.unionByName, merged).select(*wanted)


def _months_below(spark, root: str) -> list[str]:
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return sorted(r.folder for r in listed.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).distinct().collect())


@query(
    "csv_whole_numbers",
    f"WITH {GREEN} SELECT VendorID, PULocationID, COUNT(*) AS row_count FROM green GROUP BY ALL",
)
def csv_whole_numbers(spark, sf_dir):
    """Whole-number columns written as n.0."""
    path = run_dir(spark, "whole")
    ids = {c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("VendorID", "PULocationID", "RatecodeID")}
    raw_trips(spark, sf_dir, "green").withColumns(ids).write.option("header", "true").csv(path)
    loaded = files.conform(files.read_csv(spark, path), files.get_schema("green"))
    return loaded.groupBy("VendorID", "PULocationID").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "json_bad_field",
    """SELECT CASE WHEN event_type <> 'view' THEN CAST(user_id AS BIGINT) END AS "PULocationID", CAST(user_id + 1 AS BIGINT) AS "DOLocationID",
    value AS total_amount FROM events WHERE event_type <> 'error'""",
)
def json_bad_field(spark, sf_dir):
    """Views have text in a number field, which is NULL; errors are cut short, which drops the record."""
    kind = F.col("event_type")
    whole = messages.to_message(
        [F.col("user_id").alias("PULocationID"), (F.col("user_id") + 1).alias("DOLocationID"), F.col("value").alias("total_amount")]
    )
    bad_field = F.regexp_replace(whole, r'"PULocationID":[0-9]+', '"PULocationID":"abc"')
    spoiled = F.when(kind == "view", bad_field).when(kind == "error", F.left(whole, F.length(whole) - 3)).otherwise(whole)
    given = table(spark, sf_dir, "events").select(spoiled.alias("value"))
    return messages.decode(given, struct(PULocationID=INT, DOLocationID=INT, total_amount=DOUBLE))


@query(
    "money_ties",
    "SELECT l_orderkey, l_linenumber, CAST(CAST((l_orderkey % 4001 - 2000) / 16.0 / 100 AS DOUBLE) AS DECIMAL(18,3))::DOUBLE AS amount FROM lineitem",
)
def money_ties(spark, sf_dir):
    """Amounts in sixteenths of a hundredth: many of them are exact ties of thousandths."""
    amount = (F.col("l_orderkey") % 4001 - 2000) / F.lit(16.0) / F.lit(100)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", to_money(amount).alias("amount"))
