"""Row operators on ordinary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.feeds import DOUBLE, LONG, STRING, struct
from headway.functions import keys
from headway.functions.presence import first_text
from headway.operators import quality, rows
from headway.operators.capture import drop_unchanged
from headway.queries import making, query, tables
from headway.queries.tables import EVENTS, events, table
from headway.sources import snapshots
from headway.sources.shared import shared_folder
from headway.streaming.capture import changed_only


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, l_linenumber AS line_no, l_partkey, l_quantity
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""")
def leaf_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each order; an order without any keeps one row."""
    line = F.struct("l_linenumber", "l_partkey", "l_quantity")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(line).alias("lines")
    )
    orders = table(spark, sf_dir, "orders")
    nested = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    return rows.leaf_outer(
        nested,
        [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")],
        F.col("lines"),
        {"line_no": "l_linenumber", "l_partkey": "l_partkey", "l_quantity": "l_quantity"},
    )


@query("""
    SELECT conv_id, turn,
           coalesce([x for x in lines if length(x) % 2 = 0][1], lines[1]) AS first_text,
           lines[1] AS all_tagged, NULL::VARCHAR AS none
    FROM (SELECT *, string_split(text, chr(10)) AS lines FROM conversations)
""", name="first_text")
def first_text_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text of each turn's lines: the first untagged, else the first of all."""
    alert = tables.alert_entities(spark, sf_dir)
    at = F.split("entity.id", "-")
    return alert.select(
        at[0].cast("long").alias("conv_id"),
        at[1].cast("long").alias("turn"),
        first_text(F.col("entity.alert.header_text.translation")).alias("first_text"),
        first_text(F.col("entity.alert.description_text.translation")).alias("all_tagged"),
        first_text(F.col("entity.alert.url.translation")).alias("none"),
    )


def _first_by_role(spark: SparkSession, sf_dir: str, untagged: str) -> DataFrame:
    """One text per conversation, turns of one role counting as untagged.

    Only the first turn and the first untagged one can be chosen, so these two are gathered and
    a conversation of any length stays one small row.
    """
    translation = F.struct(
        "text", F.when(F.col("role") != untagged, F.col("role")).alias("language")
    )
    turn = F.struct("turn", "text")
    firsts = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.min_by(translation, turn).alias("first"),
        F.min_by(translation, F.when(F.col("role") == untagged, turn)).alias("untagged"),
    )
    candidates = F.filter(F.array("first", "untagged"), lambda t: t.isNotNull())
    return firsts.select("conv_id", first_text(candidates).alias("text"))


def _first_by_role_sql(untagged: str) -> str:
    return f"""
        SELECT conv_id, coalesce(arg_min(text, (turn, text)) FILTER (WHERE role = '{untagged}'),
                                 arg_min(text, (turn, text))) AS text
        FROM conversations GROUP BY conv_id
    """


@query(_first_by_role_sql("system"))
def first_text_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_by_role(spark, sf_dir, "system")


@query(_first_by_role_sql("assistant"))
def first_text_assistant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_by_role(spark, sf_dir, "assistant")


LINE = struct(entity_id=STRING, stop_sequence=LONG, stop_id=STRING, delay=DOUBLE, vehicle_id=STRING)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("stop_sequence"),
        F.col("l_orderkey").alias("entity_id"),
        F.col("l_partkey").alias("stop_id"),
        F.lit(None).alias("vehicle_id"),
        F.col("l_quantity").cast("int").alias("delay"),
    )


@query("""
    SELECT l_orderkey::VARCHAR AS entity_id, l_linenumber::BIGINT AS stop_sequence,
           l_partkey::VARCHAR AS stop_id, l_quantity::INT::DOUBLE AS delay,
           NULL::VARCHAR AS vehicle_id
    FROM lineitem
""")
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types and order, whatever those of the input."""
    return rows.conform(_lines(spark, sf_dir), LINE)


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-row distinct of lines that are all there twice and more."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    return rows.distinct_rows(lines.unionAll(lines))


@query(f"""
    SELECT DISTINCT user_id, hour, [k, 0] [1] AS first_k, n
    FROM (SELECT user_id, hour, k, CASE WHEN event_type <> 'error' THEN k % 3 END AS n
          FROM ({EVENTS}))
""")
def distinct_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct over a nested column and NULLs, opened afterwards for comparison."""
    nested = events(spark, sf_dir).select(
        "user_id",
        "hour",
        F.array(F.struct("k", F.lit("x").alias("tag"))).alias("nested"),
        F.when(F.col("event_type") != "error", F.col("k") % 3).alias("n"),
    )
    return rows.distinct_rows(nested).select(
        "user_id", "hour", F.col("nested")[0]["k"].alias("first_k"), "n"
    )


@query(f"SELECT event_id::VARCHAR AS event_id, date, hour, k FROM ({EVENTS})")
def union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose columns differ in order and type, as one table."""
    all_events = events(spark, sf_dir)
    parity = F.col("hour").cast("int") % 2
    even = all_events.where(parity == 0).select("event_id", "date", "hour", "k")
    odd = all_events.where(parity == 1).select(
        "hour", "date", F.col("k").cast("int").alias("k"), F.col("event_id").cast("string")
    )
    return rows.union_parts([even, odd], struct(event_id=STRING, date=STRING, hour=STRING, k=LONG))


@query(f"""
    SELECT date, event_id, k,
           row_number() OVER (PARTITION BY date ORDER BY k NULLS LAST, event_id) AS position
    FROM (SELECT date, event_id, CASE WHEN event_type <> 'error' THEN k END AS k FROM ({EVENTS}))
""")
def day_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days sorted with NULL keys last, as they lie in the written files."""
    path = shared_folder(spark, "day-sort")
    keyed = events(spark, sf_dir).select(
        F.to_date("date").alias("date"),
        "event_id",
        F.when(F.col("event_type") != "error", F.col("k")).alias("k"),
    )
    making.write_days(rows.day_sort(keyed, ["k", "event_id"]), path)
    schema = T.StructType([*keyed.schema.fields[1:], keyed.schema.fields[0]])
    written = spark.read.schema(schema).parquet(path)
    return making.with_positions(written).withColumn("date", F.col("date").cast("string"))


KEYED = f"""
    SELECT *, 'raw/' || event_type || '/' || strftime(ts, '%Y/%m/%d/%H') || '/' || event_type
              || '_' || epoch || '.pb' AS key
    FROM ({EVENTS})
"""
KEYS = f"SELECT event_id, key FROM ({KEYED})"


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", keys.raw_key(F.col("event_type"), F.col("at")).alias("key")
    )


@query(KEYS)
def raw_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key each event would be stored under."""
    return _keys(spark, sf_dir)


@query(f"""
    SELECT event_id, regexp_extract(key, '^raw/([^/]+)/', 1) AS feed,
           replace(regexp_extract(key, '/(\\d+/\\d+/\\d+)/', 1), '/', '-') AS date,
           regexp_extract(key, '/(\\d+)/[^/]*$', 1) AS hour,
           regexp_extract(key, '^(.*)/[^/]*$', 1) AS hour_prefix,
           regexp_extract(key, '_(\\d+)\\.pb$', 1)::BIGINT AS epoch,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS captured_at
    FROM ({KEYED})
""")
def key_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed, day, hour and capture time read back from the keys."""
    key = F.col("key")
    return _keys(spark, sf_dir).select(
        "event_id",
        keys.feed_of(key).alias("feed"),
        keys.date_of(key).alias("date"),
        keys.hour_of(key).alias("hour"),
        keys.hour_prefix(key).alias("hour_prefix"),
        keys.captured_epoch(key).alias("epoch"),
        F.date_format(keys.captured_at(key), "yyyy-MM-dd HH:mm:ss").alias("captured_at"),
    )


@query(f"""
    SELECT regexp_extract(key, '^(.*)/[^/]*$', 1) AS hour_prefix, count(*) AS n_keys,
           min(key) AS first_key, max(key) AS last_key
    FROM ({KEYS}) GROUP BY ALL
""")
def hour_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys grouped by the hour folder they share."""
    return (
        _keys(spark, sf_dir)
        .groupBy(keys.hour_prefix(F.col("key")).alias("hour_prefix"))
        .agg(
            F.count("key").alias("n_keys"),
            F.min("key").alias("first_key"),
            F.max("key").alias("last_key"),
        )
    )


@query(f"SELECT date, hour, count(*) AS n_rows FROM ({EVENTS}) GROUP BY date, hour")
def hourly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each hour that has any."""
    return quality.hourly_rows(events(spark, sf_dir))


@query(f"""
    SELECT event_type AS feed, date, count(*) AS discovered,
           count(*) FILTER (WHERE event_type <> 'error' AND k NOT IN (0, 1)) AS succeeded,
           count(*) FILTER (WHERE k = 0) AS download_failed,
           count(*) FILTER (WHERE k <> 0 AND (event_type = 'error' OR k = 1)) AS parse_failed
    FROM ({EVENTS}) GROUP BY event_type, date
""")
def snapshot_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one object: unreadable, cut short, empty, or good.

    The counts come from decoding the payloads.
    """
    outcome = (
        F.when(F.col("k") == 0, "lost")
        .when(F.col("k") == 1, "empty")
        .when(F.col("event_type") == "error", "cut")
        .otherwise("good")
    )
    entity = F.struct(F.col("event_id").cast("string").alias("id"))
    attempts = events(spark, sf_dir).select(
        F.col("event_type").alias("feed"),
        "date",
        outcome.alias("outcome"),
        F.col("epoch").alias("header_timestamp"),
        entity.alias("entity"),
    )
    payloads = making.pack(attempts, ["feed", "date", "outcome"], max_entities=1)
    content = (
        F.when(F.col("outcome") == "lost", F.lit(None))
        .when(F.col("outcome") == "empty", F.lit(b""))
        .when(F.col("outcome") == "cut", F.expr("substring(content, 1, length(content) - 1)"))
        .otherwise(F.col("content"))
    )
    spec = tables.feeds.registry()["vehicle_positions"]
    decoded = snapshots.decode(payloads.withColumn("content", content), spec, ["feed", "date"])
    return quality.snapshot_accounting(snapshots.objects_of(decoded), ["feed", "date"])


@query(f"""
    SELECT *, download_failed + parse_failed AS failed,
           CASE WHEN discovered = 0 THEN 0.0::DOUBLE
                ELSE (download_failed + parse_failed)::DOUBLE / discovered END AS failure_rate,
           24::BIGINT AS expected, discovered::DOUBLE / 24 AS coverage
    FROM (SELECT event_type AS feed, date, count(*) AS discovered,
                 count(*) FILTER (WHERE k BETWEEN 1 AND 50) AS succeeded,
                 count(*) FILTER (WHERE k = 0) AS download_failed,
                 count(*) FILTER (WHERE k > 50) AS parse_failed
          FROM (SELECT event_type, date, hour, min(k) AS k FROM ({EVENTS}) GROUP BY ALL)
          GROUP BY ALL)
""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of hourly objects per event type and day, 24 expected."""
    status = (
        F.when(F.min("k") == 0, quality.DOWNLOAD_FAILED)
        .when(F.min("k") > 50, quality.PARSE_FAILED)
        .otherwise(quality.OK)
    )
    hourly = (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("feed"), "date", "hour")
        .agg(status.alias("status"))
    )
    return quality.completeness(quality.snapshot_accounting(hourly, ["feed", "date"]), 24)


CHANGED = """
    SELECT event_id, user_id, event_type
    FROM (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS n
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE n = 1 OR event_type IS DISTINCT FROM before
"""


@query(CHANGED, name="drop_unchanged")
def change_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user that differ in type from the one before."""
    kept = drop_unchanged(
        events(spark, sf_dir).select("event_id", "user_id", "event_type", "at", "epoch"),
        ["user_id"],
        ["at", "event_id"],
        "event_type",
        3600,
    )
    return kept.select("event_id", "user_id", "event_type")


@query(f"""
    SELECT event_type AS feed, key, identity
    FROM (SELECT *, lag(identity) OVER w AS before, row_number() OVER w AS n
          FROM (SELECT event_type, ts, event_id, key, sha256((k // 20)::VARCHAR) AS identity
                FROM ({KEYED}))
          WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))
    WHERE n = 1 OR identity IS DISTINCT FROM before
""")
def captured_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of five feeds, kept where the payload changed, with the key it is stored under.

    A feed here holds a fifth of all rows and more; the minute slices spread it.
    """
    payload = F.floor(F.col("k") / 20).cast("string").cast("binary")
    polls = events(spark, sf_dir).select(
        F.col("event_type").alias("feed"),
        "at",
        "event_id",
        "epoch",
        keys.raw_key(F.col("event_type"), F.col("at")).alias("key"),
        F.sha2(payload, 256).alias("identity"),
    )
    kept = drop_unchanged(polls, ["feed"], ["at", "event_id"], "identity", 60)
    return kept.select("feed", "key", "identity")


@query(CHANGED)
def captured_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of :func:`change_only` as a stream. They come in four instalments by time, and
    the stream is started anew for each, to go on from its checkpoint."""
    lake = shared_folder(spark, "polls")
    polls = events(spark, sf_dir).select("event_id", "user_id", "event_type", "at", "epoch")
    first, last = polls.agg(F.min("epoch"), F.max("epoch")).first()
    instalment = F.floor((F.col("epoch") - first) * 4 / (last - first + 1))
    for part in range(4):
        polls.where(instalment == part).write.mode("append").parquet(f"{lake}/polls")
        stream = spark.readStream.schema(polls.schema).parquet(f"{lake}/polls")
        changed = changed_only(stream, ["user_id"], ["at", "event_id"], "event_type")
        kept = changed.select("event_id", "user_id", "event_type").writeStream.format("parquet")
        kept = kept.option("path", f"{lake}/kept").option("checkpointLocation", f"{lake}/progress")
        kept.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{lake}/kept")
