"""State machines of orders, partners and restaurants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# States in the order a healthy record passes through them.
ORDER_STATES = (
    "PLACED", "ACCEPTED", "PREPARING", "READY", "ASSIGNED", "PICKED_UP", "DELIVERED", "REJECTED", "CANCELLED",
)
ORDER_TERMINAL = ("REJECTED", "DELIVERED", "CANCELLED")
PARTNER_STATES = (
    "OFFLINE", "IDLE", "ASSIGNED", "EN_ROUTE_TO_RESTAURANT", "WAITING_AT_RESTAURANT", "PICKED_UP",
    "EN_ROUTE_TO_CUSTOMER", "DELIVERED",
)
NOT_BUSY = ("IDLE", "OFFLINE")
RESTAURANT_STATES = ("ONLINE", "OFFLINE", "BUSY", "NORMAL")

# Legal moves, by machine.
LEGAL_MOVES = {
    "order": {
        "PLACED": ("ACCEPTED", "REJECTED", "CANCELLED"),
        "ACCEPTED": ("PREPARING", "CANCELLED"),
        "PREPARING": ("READY", "CANCELLED"),
        "READY": ("ASSIGNED", "CANCELLED"),
        "ASSIGNED": ("PICKED_UP", "CANCELLED"),
        "PICKED_UP": ("DELIVERED",),
    },
    "dp": {
        "OFFLINE": ("IDLE",),
        "IDLE": ("OFFLINE", "ASSIGNED"),
        "ASSIGNED": ("EN_ROUTE_TO_RESTAURANT",),
        "EN_ROUTE_TO_RESTAURANT": ("WAITING_AT_RESTAURANT",),
        "WAITING_AT_RESTAURANT": ("PICKED_UP",),
        "PICKED_UP": ("EN_ROUTE_TO_CUSTOMER",),
        "EN_ROUTE_TO_CUSTOMER": ("DELIVERED",),
        "DELIVERED": ("IDLE", "ASSIGNED", "OFFLINE"),
    },
    # the stream never emits the partner's ASSIGNED, so trips start from IDLE
    "dp_observed": {
        "IDLE": ("EN_ROUTE_TO_RESTAURANT",),
    },
}


def legal_pairs(*machines: str) -> list[tuple[str, str]]:
    return [(src, dst) for m in machines for src, targets in LEGAL_MOVES[m].items() for dst in targets]


def legal_moves_frame(spark: SparkSession, *machines: str) -> DataFrame:
    """``(from_state, to_state)`` rows; at most a few dozen, whatever the data size."""
    return spark.createDataFrame(legal_pairs(*machines), "from_state string, to_state string")


def state_ordinal(state: Column, states: tuple[str, ...] = ORDER_STATES) -> Column:
    """Position of a state in its life cycle; breaks ties between equal event times."""
    return F.array_position(F.array(*[F.lit(s) for s in states]), state).cast("int")
