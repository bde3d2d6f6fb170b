from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stopmetrics.schema import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402
from stopmetrics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def raw(spark):
    """Builds raw stop events from dicts; fields not given are NULL."""

    def build(*events: dict):
        rows = [tuple(event.get(name) for name in RAW_COLUMNS) for event in events]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return build


@pytest.fixture
def table_name():
    return lambda: f"days_{uuid.uuid4().hex}"


def stop(trip="t1", station="8500001", arrival="01.03.2026 10:00", actual="01.03.2026 10:02:00", **fields):
    """A measured stop on 1 March 2026."""
    event = {
        "BETRIEBSTAG": "01.03.2026",
        "FAHRT_BEZEICHNER": trip,
        "BPUIC": station,
        "HALTESTELLEN_NAME": f"Station {station}",
        "VERKEHRSMITTEL_TEXT": "S",
        "LINIEN_TEXT": "S1",
        "BETREIBER_ID": "85:11",
        "FAELLT_AUS_TF": "false",
        "DURCHFAHRT_TF": "false",
        "ANKUNFTSZEIT": arrival,
        "AN_PROGNOSE": actual,
        "AN_PROGNOSE_STATUS": "REAL",
    }
    event.update(fields)
    return event
