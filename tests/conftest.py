import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from danji.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", "4g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


SALES = (
    "address string, complex string, area_m2 double, price bigint, ym int, day int, floor_no int, "
    "built_year int, road string, cancelled_on string, deal_type string"
)
RENTS = (
    "address string, complex string, rent_kind string, area_m2 double, deposit bigint, ym int, "
    "day int, floor_no int, built_year int, road string"
)
COORDS = "road_key string, lon double, lat double"
COMPLEXES = "lot_address string, complex string, households int, kind_code string"
TARGETS = "address string, complex string, area_m2 double"


def dicts(df):
    return [row.asDict(recursive=True) for row in df.collect()]
