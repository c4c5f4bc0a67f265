"""Configuration values shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------- #
# These must equal the source system's contract for results to
# match. Event types accepted into Bronze, the topic name recorded in
# `source_topic`, the default city for events without one, the valid-city set
# used by the quality gate and table tests, the stream trigger interval.
# --------------------------------------------------------------------------- #
VALID_EVENT_TYPES = (
    "ride_requested",
    "ride_accepted",
    "ride_started",
    "ride_ended",
    "payment_completed",
    "ride_cancelled",
)
DEFAULT_TOPIC = "ride-events"
DEFAULT_CITY = "Karachi"
VALID_CITIES = ("Karachi",)
TRIGGER_INTERVAL = "10 seconds"


@dataclass(frozen=True)
class LakeConfig:
    """Per-deployment settings.

    The source system hard-codes a single city; here city defaulting and the
    valid set are parameters so other fleets (and the test lens, which uses
    region names) can run the same jobs.
    """

    default_city: str = DEFAULT_CITY
    valid_cities: tuple[str, ...] = VALID_CITIES
    topic: str = DEFAULT_TOPIC
    event_types: tuple[str, ...] = VALID_EVENT_TYPES
    # rows per output file when landing large batches (0 = no cap)
    max_records_per_file: int = 5_000_000
    # whether appends to Bronze are shuffled by partition first, so that files are few
    rebalance_appends: bool = True
