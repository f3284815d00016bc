"""Hand-made flight records: seq, flightNumber, airline, origin, destination, scheduled, actual, status."""

from aerostream.schema import SEQUENCED_FLIGHT_SCHEMA

LATEST_CASE = [
    (0, "QX1", "QX", "OSL", "LIS", 5000, None, "ON_TIME"),
    (1, "QX2", "QX", "VIE", "RIX", 6000, None, "SCHEDULED"),
    (2, "QX1", "QX", "OSL", "LIS", 5000, 5900, "DELAYED"),
]

# a delay, a second flight that is late from its first record, a change of
# origin, a recovery, an origin that is not known, and its return
RETRACTION_CASE = [
    (0, "QX1", "QX", "OSL", "LIS", 5000, 5900, "DELAYED"),
    (1, "QX2", "QX", "VIE", "RIX", 6000, None, "SCHEDULED"),
    (2, "QX2", "QX", "OSL", "RIX", 6000, 6700, "DELAYED"),
    (3, "QX1", "QX", "VIE", "LIS", 5000, 5900, "DELAYED"),
    (4, "QX1", "QX", "VIE", "LIS", 5000, 5900, "ON_TIME"),
    (5, "QX2", "QX", None, "RIX", 6000, 6700, "DELAYED"),
    (6, "QX2", "QX", "OSL", "RIX", 6000, 6700, "DELAYED"),
]
# delayed count per origin after each record; an origin once named stays, at 0
RETRACTION_STEPS = [
    {"OSL": 1},
    {"OSL": 1, "VIE": 0},
    {"OSL": 2, "VIE": 0},
    {"OSL": 1, "VIE": 1},
    {"OSL": 1, "VIE": 0},
    {"OSL": 0, "VIE": 0},
    {"OSL": 1, "VIE": 0},
]


def flights_df(spark, rows):
    return spark.createDataFrame(rows, SEQUENCED_FLIGHT_SCHEMA)
