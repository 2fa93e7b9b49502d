"""The given tables, read as transit data: entities of each feed and the columns they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import feeds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the capture time's parts and ``k``, the number in ``props``."""
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        at.alias("at"),
        F.date_format(at, "yyyy-MM-dd").alias("date"),
        F.date_format(at, "HH").alias("hour"),
        F.unix_timestamp(at).alias("epoch"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "props",
    )


# The same columns in SQL.
EVENTS = """
    SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
           floor(epoch(ts))::BIGINT AS epoch, user_id, event_type, value,
           json_extract(props, '$.k')::BIGINT AS k, props
    FROM events
"""


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows over as many tasks as a shuffle has.

    Ranges keep neighbours together for packing; the hash lets them cut through a value that many
    rows share.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(tasks, *by, F.xxhash64(*df.columns))


def only(condition: Column, value: Column) -> Column:
    """The value where the condition holds, else unset."""
    return F.when(condition, value)


def vehicle_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event as a vehicle position, with many fields unset and many set to zero or empty.

    The header time is the hour; every fifth hour has none.
    """
    k, kind, user = F.col("k"), F.col("event_type"), F.col("user_id")
    number = user.cast("string")
    trip = F.struct(
        F.concat(F.lit("T"), number).alias("trip_id"),
        only(kind != "error", kind).alias("route_id"),
        (k % 2).alias("direction_id"),
        only(k % 5 == 0, F.lit("05:40:00")).alias("start_time"),
        F.regexp_replace("date", "-", "").alias("start_date"),
        only(k % 4 != 0, F.lit(0)).alias("schedule_relationship"),
    )
    vehicle = F.struct(
        number.alias("id"),
        only(k % 3 != 0, F.when(k % 3 == 1, F.lit("")).otherwise(kind)).alias("label"),
        F.lit(None).alias("license_plate"),
    )
    position = F.struct(
        (user % 90).alias("latitude"),
        F.lit(8.31).cast("float").alias("longitude"),
        only(k % 2 == 0, F.lit(0.0)).alias("bearing"),
        F.col("value").alias("odometer"),
        (k / 2).alias("speed"),
    )
    carriages = F.transform(
        F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), (k % 3).cast("int")),
        lambda i: F.struct(
            F.when(i == 1, F.lit("")).otherwise(F.concat(F.lit("car-"), number)).alias("id"),
            only(i == 1, F.lit("A")).alias("label"),
            (k % 9).alias("occupancy_status"),
            F.lit(None).alias("occupancy_percentage"),
            i.alias("carriage_sequence"),
        ),
    )
    body = F.struct(
        only(k % 7 != 0, trip).alias("trip"),
        vehicle.alias("vehicle"),
        only(k % 3 != 0, position).alias("position"),
        k.alias("current_stop_sequence"),
        only(k % 2 == 0, F.lit("")).alias("stop_id"),
        (k % 3).alias("current_status"),
        F.col("epoch").alias("timestamp"),
        only(kind != "view", k % 5).alias("congestion_level"),
        only(kind == "click", k % 9).alias("occupancy_status"),
        only(k <= 60, k).alias("occupancy_percentage"),
        carriages.alias("multi_carriage_details"),
    )
    slot = F.expr("epoch div 3600")
    entity = F.struct(number.alias("id"), only(k != 13, body).alias("vehicle"))
    return spread(events(spark, sf_dir), "at").select(
        "date",
        "hour",
        only(slot % 5 != 0, slot * 3600).alias("header_timestamp"),
        entity.cast(feeds.VEHICLE_ENTITY).alias("entity"),
    )


# The curated rows of those vehicles, before the distinct.
VEHICLE_ROWS = f"""
    SELECT date, hour,
           CASE WHEN (epoch // 3600) % 5 <> 0 THEN epoch // 3600 * 3600 END AS header_timestamp,
           user_id::VARCHAR AS entity_id,
           CASE WHEN k <> 13 AND k % 7 <> 0 THEN 'T' || user_id END AS trip_id,
           CASE WHEN k <> 13 AND k % 7 <> 0 AND event_type <> 'error' THEN event_type END AS route_id,
           CASE WHEN k <> 13 AND k % 7 <> 0 THEN k % 2 END AS direction_id,
           CASE WHEN k <> 13 AND k % 7 <> 0 AND k % 5 = 0 THEN '05:40:00' END AS start_time,
           CASE WHEN k <> 13 AND k % 7 <> 0 THEN replace(date, '-', '') END AS start_date,
           CASE WHEN k <> 13 AND k % 7 <> 0 AND k % 4 <> 0 THEN 0::BIGINT END AS schedule_relationship,
           CASE WHEN k <> 13 THEN user_id::VARCHAR END AS vehicle_id,
           CASE WHEN k <> 13 AND k % 3 = 1 THEN ''
                WHEN k <> 13 AND k % 3 = 2 THEN event_type END AS vehicle_label,
           NULL::VARCHAR AS license_plate,
           CASE WHEN k <> 13 AND k % 3 <> 0 THEN (user_id % 90)::DOUBLE END AS latitude,
           CASE WHEN k <> 13 AND k % 3 <> 0 THEN 8.31::FLOAT::DOUBLE END AS longitude,
           CASE WHEN k <> 13 AND k % 3 <> 0 AND k % 2 = 0 THEN 0.0::DOUBLE END AS bearing,
           CASE WHEN k <> 13 AND k % 3 <> 0 THEN value END AS odometer,
           CASE WHEN k <> 13 AND k % 3 <> 0 THEN k::DOUBLE / 2 END AS speed,
           CASE WHEN k <> 13 THEN k END AS current_stop_sequence,
           CASE WHEN k <> 13 AND k % 2 = 0 THEN '' END AS stop_id,
           CASE WHEN k <> 13 THEN k % 3 END AS current_status,
           CASE WHEN k <> 13 THEN epoch END AS timestamp,
           CASE WHEN k <> 13 AND event_type <> 'view' THEN k % 5 END AS congestion_level,
           CASE WHEN k <> 13 AND event_type = 'click' THEN k % 9 END AS occupancy_status,
           CASE WHEN k <> 13 AND k <= 60 THEN k END AS occupancy_percentage,
           CASE WHEN k = 13 OR k % 3 = 0 THEN ''
                WHEN k % 3 = 1 THEN '-/A/' || (k % 9) || '/-/1'
                ELSE '-/A/' || (k % 9) || '/-/1,car-' || user_id || '/-/' || (k % 9) || '/-/2'
           END AS carriages
    FROM ({EVENTS})
"""


def carriages_as_text(rows: DataFrame) -> DataFrame:
    """Replaces the carriage list by one text, for comparing with SQL."""
    names = [field.name for field in feeds.CARRIAGE]
    text = F.array_join(
        F.transform(
            "multi_carriage_details",
            lambda c: F.concat_ws(
                "/", *[F.coalesce(c[n].cast("string"), F.lit("-")) for n in names]
            ),
        ),
        ",",
    )
    return rows.withColumn("carriages", text).drop("multi_carriage_details")


def trip_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order line as a trip update: two stops if its quantity is over 40, else none."""
    line, order = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    shipped = F.col("l_shipdate").cast("timestamp")
    epoch = F.unix_timestamp(shipped)
    trip = F.struct(
        order.alias("trip_id"),
        only(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("route_id"),
        (line % 2).alias("direction_id"),
        F.lit(None).alias("start_time"),
        F.date_format(shipped, "yyyyMMdd").alias("start_date"),
        F.lit(None).alias("schedule_relationship"),
    )
    early = (F.col("l_quantity") - 45).cast("long")
    arriving = F.struct(early.alias("delay"), F.lit(None).alias("time"))
    leaving = F.struct(F.lit(0).alias("delay"), epoch.alias("time"))
    stops = F.array(
        F.struct(
            line.alias("stop_sequence"),
            F.col("l_partkey").cast("string").alias("stop_id"),
            arriving.alias("arrival"),
            F.lit(None).cast("struct<delay:long,time:long>").alias("departure"),
            F.lit(None).cast("long").alias("departure_occupancy_status"),
            F.lit(0).cast("long").alias("schedule_relationship"),
        ).cast(_STOP),
        F.struct(
            (line + 10).alias("stop_sequence"),
            F.col("l_suppkey").cast("string").alias("stop_id"),
            F.lit(None).cast("struct<delay:long,time:long>").alias("arrival"),
            leaving.alias("departure"),
            (F.col("l_suppkey") % 9).alias("departure_occupancy_status"),
            F.lit(None).cast("long").alias("schedule_relationship"),
        ).cast(_STOP),
    )
    update = F.struct(
        trip.alias("trip"),
        only(
            F.col("l_linestatus") == "O",
            F.struct(F.col("l_suppkey").cast("string").alias("id"), F.lit(None).alias("label")),
        ).alias("vehicle"),
        F.lit(None).alias("timestamp"),
        F.round(F.col("l_discount") * 100).cast("long").alias("delay"),
        only(F.col("l_quantity") > 40, stops).alias("stop_time_update"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    return spread(lines, "l_shipdate").select(
        F.date_format(shipped, "yyyy-MM-dd").alias("date"),
        F.lit("00").alias("hour"),
        epoch.alias("header_timestamp"),
        F.struct(order.alias("id"), update.alias("trip_update"))
        .cast(feeds.TRIP_ENTITY)
        .alias("entity"),
    )


_STOP = feeds.TRIP_ENTITY["trip_update"].dataType["stop_time_update"].dataType.elementType

TRIP_ROWS = """
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS date,
           floor(epoch(l_shipdate))::BIGINT AS header_timestamp,
           l_orderkey::VARCHAR AS entity_id, l_orderkey::VARCHAR AS trip_id,
           CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS route_id,
           (l_linenumber % 2)::BIGINT AS direction_id,
           NULL::VARCHAR AS start_time, strftime(l_shipdate, '%Y%m%d') AS start_date,
           NULL::BIGINT AS schedule_relationship,
           CASE WHEN l_linestatus = 'O' THEN l_suppkey::VARCHAR END AS vehicle_id,
           NULL::VARCHAR AS vehicle_label, NULL::BIGINT AS timestamp,
           round(l_discount * 100)::BIGINT AS delay,
           CASE leaf WHEN 1 THEN l_linenumber WHEN 2 THEN l_linenumber + 10 END::BIGINT AS stop_sequence,
           CASE leaf WHEN 1 THEN l_partkey::VARCHAR WHEN 2 THEN l_suppkey::VARCHAR END AS stop_id,
           CASE leaf WHEN 1 THEN l_quantity - 45 END::BIGINT AS arrival_delay,
           NULL::BIGINT AS arrival_time,
           CASE leaf WHEN 2 THEN 0 END::BIGINT AS departure_delay,
           CASE leaf WHEN 2 THEN floor(epoch(l_shipdate)) END::BIGINT AS departure_time,
           CASE leaf WHEN 2 THEN l_suppkey % 9 END::BIGINT AS departure_occupancy_status,
           CASE leaf WHEN 1 THEN 0 END::BIGINT AS stop_schedule_relationship
    FROM (SELECT *, unnest(CASE WHEN l_quantity > 40 THEN [1, 2] ELSE [0] END) AS leaf FROM lineitem)
"""


def alert_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation turn as an alert: its lines are translations, its number modulo four counts
    the selectors.

    In the header text, lines of even length have no language; the description tags all.
    """
    turn, text = F.col("turn"), F.col("text")
    lines = F.split(text, "\n", -1)
    mixed = F.transform(
        lines,
        lambda line: F.struct(
            line.alias("text"),
            F.when(F.length(line) % 4 == 0, F.lit(None))
            .when(F.length(line) % 4 == 2, F.lit(""))
            .otherwise(F.lit("fr"))
            .alias("language"),
        ),
    )
    tagged = F.transform(
        lines, lambda line: F.struct(line.alias("text"), F.lit("fr").alias("language"))
    )
    periods = F.array(
        F.struct(turn.alias("start"), only(turn % 2 == 0, F.col("conv_id")).alias("end"))
    )
    informed = F.transform(
        F.sequence(F.lit(1).cast("long"), F.greatest(turn % 4, F.lit(1))),
        lambda i: F.struct(
            F.lit(None).alias("agency_id"),
            F.concat(F.lit("R"), i).alias("route_id"),
            only(i % 2 == 0, F.lit(0)).alias("route_type"),
            only(
                i % 3 != 0,
                F.struct(only(i % 3 == 1, F.col("conv_id").cast("string")).alias("trip_id")),
            ).alias("trip"),
            only(i == 2, F.lit("")).alias("stop_id"),
            (i % 2).alias("direction_id"),
        ),
    )
    alert = F.struct(
        only(turn != 3, turn % 3 + 1).alias("cause"),
        only(F.col("role") == "user", F.lit(8)).alias("effect"),
        F.lit(None).alias("severity_level"),
        F.struct(mixed.alias("translation")).alias("header_text"),
        F.struct(tagged.alias("translation")).alias("description_text"),
        only(turn == 0, F.struct(F.array().alias("translation"))).alias("url"),
        only(turn > 0, periods).alias("active_period"),
        only(turn % 4 > 0, informed).alias("informed_entity"),
    )
    entity = F.struct(F.concat_ws("-", "conv_id", "turn").alias("id"), alert.alias("alert"))
    day = F.lpad((F.col("conv_id") % 28 + 1).cast("string"), 2, "0")
    return spread(table(spark, sf_dir, "conversations"), "conv_id").select(
        F.concat(F.lit("2024-01-"), day).alias("date"),
        F.lpad((turn % 24).cast("string"), 2, "0").alias("hour"),
        only(turn != 1, F.col("conv_id")).alias("header_timestamp"),
        entity.cast(feeds.ALERT_ENTITY).alias("entity"),
    )


ALERT_ROWS = """
    SELECT '2024-01-' || lpad((conv_id % 28 + 1)::VARCHAR, 2, '0') AS date,
           CASE WHEN turn <> 1 THEN conv_id END AS header_timestamp,
           conv_id || '-' || turn AS entity_id,
           CASE WHEN turn <> 3 THEN turn % 3 + 1 END AS cause,
           CASE WHEN role = 'user' THEN 8::BIGINT END AS effect,
           NULL::BIGINT AS severity_level,
           coalesce([x for x in lines if length(x) % 2 = 0][1], lines[1]) AS header_text,
           lines[1] AS description_text, NULL::VARCHAR AS url,
           CASE WHEN turn = 0 THEN '' WHEN turn % 2 = 0 THEN turn || '-' || conv_id
                ELSE turn || '-?' END AS active_period,
           NULL::VARCHAR AS agency_id,
           CASE WHEN i > 0 THEN 'R' || i END AS route_id,
           CASE WHEN i > 0 AND i % 2 = 0 THEN 0::BIGINT END AS route_type,
           CASE WHEN i > 0 AND i % 3 = 1 THEN conv_id::VARCHAR END AS trip_id,
           CASE WHEN i = 2 THEN '' END AS stop_id,
           CASE WHEN i > 0 THEN i % 2 END AS direction_id
    FROM (SELECT *, string_split(text, chr(10)) AS lines,
                 unnest(CASE WHEN turn % 4 > 0 THEN range(1, turn % 4 + 1) ELSE [0::BIGINT] END) AS i
          FROM conversations)
"""
