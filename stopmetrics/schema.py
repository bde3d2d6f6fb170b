"""Names, schema and fixed value lists of raw stop events."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names of the published daily files, in file order.
RAW_COLUMNS = (
    "BETRIEBSTAG",
    "FAHRT_BEZEICHNER",
    "BETREIBER_ID",
    "BETREIBER_ABK",
    "BETREIBER_NAME",
    "PRODUKT_ID",
    "LINIEN_ID",
    "LINIEN_TEXT",
    "UMLAUF_ID",
    "VERKEHRSMITTEL_TEXT",
    "ZUSATZFAHRT_TF",
    "FAELLT_AUS_TF",
    "BPUIC",
    "HALTESTELLEN_NAME",
    "ANKUNFTSZEIT",
    "AN_PROGNOSE",
    "AN_PROGNOSE_STATUS",
    "ABFAHRTSZEIT",
    "AB_PROGNOSE",
    "AB_PROGNOSE_STATUS",
    "DURCHFAHRT_TF",
    "SLOID",
)

# Columns without which a daily file is refused, in the order error messages list them.
REQUIRED_COLUMNS = (
    "BETRIEBSTAG",
    "VERKEHRSMITTEL_TEXT",
    "AN_PROGNOSE_STATUS",
    "ANKUNFTSZEIT",
    "AN_PROGNOSE",
    "FAELLT_AUS_TF",
)

# Texts a pandas CSV reader takes for missing. Compared without trimming.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Texts that count as true (lower case) and statuses that carry a measured arrival.
TRUE_TEXTS = ("true", "1", "t", "yes")
DELAY_STATUSES = ("REAL", "ESTIMATED")
KNOWN_STATUSES = ("REAL", "ESTIMATED", "FORECAST", "UNKNOWN")

# Every raw field is text: types drift between daily files, so typing happens once, in staging.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

STAGING_NAMES = {
    "BETRIEBSTAG": "operating_day",
    "FAHRT_BEZEICHNER": "trip_id",
    "BETREIBER_ID": "operator_id",
    "BETREIBER_ABK": "operator_abbr",
    "BETREIBER_NAME": "operator_name",
    "PRODUKT_ID": "product_id",
    "LINIEN_ID": "line_id",
    "LINIEN_TEXT": "line_name",
    "UMLAUF_ID": "circuit_id",
    "VERKEHRSMITTEL_TEXT": "transport_type",
    "ZUSATZFAHRT_TF": "is_extra",
    "FAELLT_AUS_TF": "is_cancelled",
    "BPUIC": "station_code",
    "HALTESTELLEN_NAME": "station_name",
    "ANKUNFTSZEIT": "scheduled_arrival_at",
    "AN_PROGNOSE": "actual_arrival_at",
    "AN_PROGNOSE_STATUS": "arrival_status",
    "ABFAHRTSZEIT": "scheduled_departure_at",
    "AB_PROGNOSE": "actual_departure_at",
    "AB_PROGNOSE_STATUS": "departure_status",
    "DURCHFAHRT_TF": "is_pass_through",
    "SLOID": "sloid",
}

DAY_COLUMN = "betriebstag_date"
CLUSTER_COLUMN = "VERKEHRSMITTEL_TEXT"
