from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql.types import StructField, StructType

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rooftally.schema import LISTING, SEQ  # noqa: E402
from rooftally.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

SCHEMA = StructType([*LISTING.fields, StructField("_seq", SEQ)])

BASE = {
    "id": "row", "source": "yad2", "city": "עכו", "neighborhood": "הצפון הישן", "street": "שדרות האלון 7",
    "deal_type": "למכירה", "property_type": "קוטג'", "rooms": 4.5, "floor": 1, "size_sqm": 117.0,
    "price": 1_740_000.0, "description": "גינה ושתי מרפסות", "scraped_at": "2031-03-09T04:30:00+00:00",
    "agent_phone": "08-0000000",
}


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-")
    session = local_session("4", shuffle_partitions=4, settings={"spark.sql.warehouse.dir": scratch})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def listings(spark):
    """Builds listings from overrides of the base one, in order, with ``_seq``."""
    def build(*overrides: dict):
        rows = [
            tuple({**BASE, **o}[name] for name in LISTING.names) + ((0, "", 0, place),)
            for place, o in enumerate(overrides)
        ]
        return spark.createDataFrame(rows, SCHEMA)
    return build
