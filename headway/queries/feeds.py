"""The three feeds end to end: tables packed to snapshots, decoded, shaped, made distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.feeds import DOUBLE, LONG, STRING, FeedSpec, registry, struct
from headway.operators.rows import distinct_rows
from headway.plans.compact import curated_rows
from headway.queries import making, query, tables
from headway.sources import snapshots


def with_repeats(payloads: DataFrame) -> DataFrame:
    """Snapshots of every seventh hour twice, as a poll of an unrefreshed feed gives."""
    hours = F.floor(F.unix_timestamp(F.concat_ws(" ", "date", "hour"), "yyyy-MM-dd HH") / 3600)
    copies = F.when(hours % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return payloads.select("*", F.explode(copies).alias("copy"))


def _curated(entities: DataFrame, feed: str) -> DataFrame:
    spec = registry()[feed]
    decoded = snapshots.decode(with_repeats(making.pack(entities)), spec)
    return distinct_rows(curated_rows(decoded, spec).drop("hour"))


@query(f"SELECT DISTINCT * EXCLUDE (hour) FROM ({tables.VEHICLE_ROWS})")
def vp_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions through the whole pipeline."""
    rows = _curated(tables.vehicle_entities(spark, sf_dir), "vehicle_positions")
    return tables.carriages_as_text(rows)


@query(f"SELECT DISTINCT * FROM ({tables.TRIP_ROWS})")
def tu_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip updates through the whole pipeline, trips without stops included."""
    return _curated(tables.trip_entities(spark, sf_dir), "trip_updates")


@query(f"SELECT DISTINCT * FROM ({tables.ALERT_ROWS})")
def sa_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service alerts through the whole pipeline, with texts and periods."""
    rows = _curated(tables.alert_entities(spark, sf_dir), "service_alerts")
    periods = F.transform(
        "active_period",
        lambda p: F.concat_ws("-", p["start"], F.coalesce(p["end"].cast("string"), F.lit("?"))),
    )
    return rows.withColumn("active_period", F.array_join(periods, ","))


@query(tables.VEHICLE_ROWS)
def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unset, zero and empty values of vehicles, shaped straight from entity rows."""
    rows = registry()["vehicle_positions"].shape(tables.vehicle_entities(spark, sf_dir))
    return tables.carriages_as_text(rows)


@query(f"""
    SELECT user_id::VARCHAR AS entity_id, CASE WHEN k <> 13 THEN epoch END AS timestamp,
           CASE WHEN k = 13 THEN 0 ELSE k % 3 END AS n_carriages,
           CASE WHEN i > 0 THEN i - 1 END AS pos,
           CASE WHEN i = 2 THEN 'car-' || user_id END AS id,
           CASE WHEN i = 1 THEN 'A' END AS label,
           CASE WHEN i > 0 THEN k % 9 END AS occupancy_status,
           CASE WHEN i > 0 THEN i END AS carriage_sequence
    FROM (SELECT *, unnest(CASE WHEN k = 13 OR k % 3 = 0 THEN [0::BIGINT]
                                ELSE range(1, k % 3 + 1) END) AS i
          FROM ({tables.EVENTS}))
""")
def nested_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rebuilt carriage lists, opened again; none is an empty list, not NULL."""
    rows = registry()["vehicle_positions"].shape(tables.vehicle_entities(spark, sf_dir))
    opened = rows.select(
        "entity_id",
        "timestamp",
        F.size("multi_carriage_details").cast("long").alias("n_carriages"),
        F.posexplode_outer("multi_carriage_details").alias("pos", "carriage"),
    )
    return opened.select(
        "entity_id",
        "timestamp",
        "n_carriages",
        F.col("pos").cast("long").alias("pos"),
        "carriage.id",
        "carriage.label",
        "carriage.occupancy_status",
        "carriage.carriage_sequence",
    )


def _with_load(entities: DataFrame) -> DataFrame:
    return entities.select(
        *[c for c in entities.columns if c not in ("header_timestamp", "entity")],
        "header_timestamp",
        F.col("entity.id").alias("entity_id"),
        F.col("entity.vehicle.load_kg").alias("load_kg"),
        F.col("entity.depot.name").alias("depot"),
        F.col("entity.depot.bays").alias("bays"),
    )


# A feed of one's own: a field more on vehicles, and a message that the definition lacks.
LOADS = FeedSpec(
    "vehicle_loads",
    struct(header_timestamp=LONG, entity_id=STRING, load_kg=DOUBLE, depot=STRING, bays=LONG),
    ("entity_id", "header_timestamp"),
    struct(id=STRING, vehicle=struct(load_kg=DOUBLE), depot=struct(name=STRING, bays=LONG)),
    _with_load,
    messages={
        "VehiclePosition": {"load_kg": ("double", 1001)},
        "FeedEntity": {"depot": ("Depot", 1002)},
        "Depot": {"name": ("string!", 1), "bays": ("sint64", 2)},
    },
)


@query(f"""
    SELECT DISTINCT date, epoch // 3600 * 3600 AS header_timestamp, event_id::VARCHAR AS entity_id,
           CASE WHEN k % 3 > 0 THEN value END AS load_kg,
           CASE WHEN k % 4 > 0 THEN event_type END AS depot,
           CASE WHEN k % 4 > 1 THEN -k END AS bays
    FROM ({tables.EVENTS})
""")
def custom_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed defined here, with wire fields of its own, through the whole pipeline."""
    k = F.col("k")
    vehicle = F.struct(F.col("value").alias("load_kg"))
    depot = F.struct(
        F.col("event_type").alias("name"), tables.only(k % 4 > 1, -k).alias("bays")
    )
    entity = F.struct(
        F.col("event_id").cast("string").alias("id"),
        tables.only(k % 3 > 0, vehicle).alias("vehicle"),
        tables.only(k % 4 > 0, depot).alias("depot"),
    )
    entities = tables.spread(tables.events(spark, sf_dir), "at").select(
        "date", "hour", F.expr("epoch div 3600 * 3600").alias("header_timestamp"),
        entity.cast(LOADS.entity).alias("entity"),
    )
    payloads = making.pack(entities, messages=LOADS.messages)
    decoded = snapshots.decode(with_repeats(payloads), LOADS)
    return distinct_rows(curated_rows(decoded, LOADS).drop("hour"))
