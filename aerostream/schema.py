"""Record schemas and fixed values shared by every operator.

All flight times are epoch milliseconds (``LongType``); derived timestamps are
``timestamp_ntz`` so every result is independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: flight record field names (must match the upstream Avro schema) ---
FLIGHT_NUMBER = "flightNumber"
AIRLINE = "airline"
ORIGIN = "origin"
DESTINATION = "destination"
SCHEDULED = "scheduledDeparture"
ACTUAL = "actualDeparture"
STATUS = "status"
SEQ = "seq"  # arrival order (Kafka partition offset in production)

FLIGHT_FIELDS = [FLIGHT_NUMBER, AIRLINE, ORIGIN, DESTINATION, SCHEDULED, ACTUAL, STATUS]

FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField(FLIGHT_NUMBER, T.StringType(), True),
        T.StructField(AIRLINE, T.StringType(), True),
        T.StructField(ORIGIN, T.StringType(), True),
        T.StructField(DESTINATION, T.StringType(), True),
        T.StructField(SCHEDULED, T.LongType(), True),
        T.StructField(ACTUAL, T.LongType(), True),
        T.StructField(STATUS, T.StringType(), True),
    ]
)

# The same record plus the arrival sequence, as every batch operator receives it.
SEQUENCED_FLIGHT_SCHEMA = T.StructType([T.StructField(SEQ, T.LongType(), True), *FLIGHT_SCHEMA.fields])

# --- fixed values: status vocabulary (upper-case after normalisation) ---
SCHEDULED_STATUS = "SCHEDULED"
BOARDING = "BOARDING"
DELAYED = "DELAYED"
ON_TIME = "ON_TIME"
CANCELLED = "CANCELLED"

# --- fixed values: wire format of the flight value, for ``from_avro`` / ``to_avro`` ---
FLIGHT_AVRO_SCHEMA = """{
  "type": "record",
  "name": "Flight",
  "namespace": "flights",
  "fields": [
    {"name": "flightNumber", "type": "string"},
    {"name": "airline", "type": "string"},
    {"name": "origin", "type": "string"},
    {"name": "destination", "type": "string"},
    {"name": "scheduledDeparture", "type": "long"},
    {"name": "actualDeparture", "type": ["null", "long"], "default": null},
    {"name": "status", "type": "string"}
  ]
}"""

# --- fixed values: relational sink table (column renames applied by the JDBC sink) ---
SINK_RENAMES = {
    FLIGHT_NUMBER: "flight_number",
    AIRLINE: "airline",
    ORIGIN: "departure_airport",
    DESTINATION: "arrival_airport",
    SCHEDULED: "scheduled_departure_time",
    ACTUAL: "actual_departure_time",
    STATUS: "status",
}
SINK_KEY = "flight_number"
SINK_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


# Text stream record: one line per record, null key.
TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])
# JSON text table of the SQL word count: one field, missing fields allowed.
MESSAGE_SCHEMA = T.StructType([T.StructField("message", T.StringType(), True)])

