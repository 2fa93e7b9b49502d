"""Feed definitions: curated schema, sort keys, wire fields and shaping of each feed.

Schemas are declared, never inferred, so every day stacks on the others. Identifiers
stay strings, enums stay integer codes, instants are POSIX seconds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from headway.sources import wire

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()

# A snapshot is expected every 20 seconds of a UTC day.
POLL_SECONDS = 20
EXPECTED_SNAPSHOTS = 86400 // POLL_SECONDS

# The feeds the capture side stores and expects to be curated.
CAPTURED_FEEDS = ("vehicle_positions", "trip_updates", "service_alerts")


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


@dataclass(frozen=True)
class FeedSpec:
    """One feed.

    ``entity`` lists the wire fields to decode, by their names in the message definition;
    ``shape`` turns decoded entities (columns ``header_timestamp`` and ``entity`` plus any
    others to keep) into rows of ``schema``. ``messages`` adds wire fields that the message
    definition lacks, as message -> field -> (type, number). A new feed needs nothing beyond such
    a spec; one that does not fit the messages or its own schema is refused here.
    """

    name: str
    schema: T.StructType
    sort_keys: tuple[str, ...]
    entity: T.StructType
    shape: Callable[[DataFrame], DataFrame]
    expected: int = EXPECTED_SNAPSHOTS
    messages: wire.Messages = field(default_factory=dict)

    def __post_init__(self):
        faults = [f"cannot sort by {k}, no such column" for k in self.sort_keys if k not in self.schema.names]
        faults += wire.mismatches(self.entity, "FeedEntity", self.messages)
        if faults:
            raise ValueError(f"feed {self.name}: {'; '.join(faults)}")


# The curated columns, in order.
CARRIAGE = struct(
    id=STRING,
    label=STRING,
    occupancy_status=LONG,
    occupancy_percentage=LONG,
    carriage_sequence=LONG,
)
PERIOD = struct(start=LONG, end=LONG)

VEHICLE_POSITIONS = struct(
    header_timestamp=LONG,
    entity_id=STRING,
    trip_id=STRING,
    route_id=STRING,
    direction_id=LONG,
    start_time=STRING,
    start_date=STRING,
    schedule_relationship=LONG,
    vehicle_id=STRING,
    vehicle_label=STRING,
    license_plate=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    bearing=DOUBLE,
    odometer=DOUBLE,
    speed=DOUBLE,
    current_stop_sequence=LONG,
    stop_id=STRING,
    current_status=LONG,
    timestamp=LONG,
    congestion_level=LONG,
    occupancy_status=LONG,
    occupancy_percentage=LONG,
    multi_carriage_details=T.ArrayType(CARRIAGE),
)

TRIP_UPDATES = struct(
    header_timestamp=LONG,
    entity_id=STRING,
    trip_id=STRING,
    route_id=STRING,
    direction_id=LONG,
    start_time=STRING,
    start_date=STRING,
    schedule_relationship=LONG,
    vehicle_id=STRING,
    vehicle_label=STRING,
    timestamp=LONG,
    delay=LONG,
    stop_sequence=LONG,
    stop_id=STRING,
    arrival_delay=LONG,
    arrival_time=LONG,
    departure_delay=LONG,
    departure_time=LONG,
    departure_occupancy_status=LONG,
    stop_schedule_relationship=LONG,
)

SERVICE_ALERTS = struct(
    header_timestamp=LONG,
    entity_id=STRING,
    cause=LONG,
    effect=LONG,
    severity_level=LONG,
    header_text=STRING,
    description_text=STRING,
    url=STRING,
    active_period=T.ArrayType(PERIOD),
    agency_id=STRING,
    route_id=STRING,
    route_type=LONG,
    trip_id=STRING,
    stop_id=STRING,
    direction_id=LONG,
)

# The wire fields each feed reads, nested as on the wire.
_TRIP = struct(
    trip_id=STRING,
    route_id=STRING,
    direction_id=LONG,
    start_time=STRING,
    start_date=STRING,
    schedule_relationship=LONG,
)
_STOP_EVENT = struct(delay=LONG, time=LONG)
_TEXT = struct(translation=T.ArrayType(struct(text=STRING, language=STRING)))

VEHICLE_ENTITY = struct(
    id=STRING,
    vehicle=struct(
        trip=_TRIP,
        vehicle=struct(id=STRING, label=STRING, license_plate=STRING),
        position=struct(
            latitude=DOUBLE, longitude=DOUBLE, bearing=DOUBLE, odometer=DOUBLE, speed=DOUBLE
        ),
        current_stop_sequence=LONG,
        stop_id=STRING,
        current_status=LONG,
        timestamp=LONG,
        congestion_level=LONG,
        occupancy_status=LONG,
        occupancy_percentage=LONG,
        multi_carriage_details=T.ArrayType(CARRIAGE),
    ),
)

TRIP_ENTITY = struct(
    id=STRING,
    trip_update=struct(
        trip=_TRIP,
        vehicle=struct(id=STRING, label=STRING),
        timestamp=LONG,
        delay=LONG,
        stop_time_update=T.ArrayType(
            struct(
                stop_sequence=LONG,
                stop_id=STRING,
                arrival=_STOP_EVENT,
                departure=_STOP_EVENT,
                departure_occupancy_status=LONG,
                schedule_relationship=LONG,
            )
        ),
    ),
)

ALERT_ENTITY = struct(
    id=STRING,
    alert=struct(
        cause=LONG,
        effect=LONG,
        severity_level=LONG,
        header_text=_TEXT,
        description_text=_TEXT,
        url=_TEXT,
        active_period=T.ArrayType(PERIOD),
        informed_entity=T.ArrayType(
            struct(
                agency_id=STRING,
                route_id=STRING,
                route_type=LONG,
                trip=struct(trip_id=STRING),
                stop_id=STRING,
                direction_id=LONG,
            )
        ),
    ),
)


def registry() -> dict[str, FeedSpec]:
    """The feeds that can be compacted, by name."""
    from headway.plans import shapes

    specs = (
        FeedSpec(
            "vehicle_positions",
            VEHICLE_POSITIONS,
            ("entity_id", "timestamp"),
            VEHICLE_ENTITY,
            shapes.vehicle_positions,
        ),
        FeedSpec(
            "trip_updates",
            TRIP_UPDATES,
            ("entity_id", "stop_sequence", "header_timestamp"),
            TRIP_ENTITY,
            shapes.trip_updates,
        ),
        FeedSpec(
            "service_alerts",
            SERVICE_ALERTS,
            ("route_id", "entity_id", "header_timestamp"),
            ALERT_ENTITY,
            shapes.service_alerts,
        ),
    )
    return {spec.name: spec for spec in specs}


def uncurated(captured: Iterable[str] = CAPTURED_FEEDS) -> list[str]:
    """Feeds that are captured but have no spec, so nothing curates them."""
    return sorted(set(captured) - set(registry()))
