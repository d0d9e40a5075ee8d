import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridseries.schema import OBS_SCHEMA  # noqa: E402
from gridseries.session import build_session  # noqa: E402

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def hours():
    return lambda n: START + dt.timedelta(hours=n)


@pytest.fixture(scope="session")
def make_obs(spark):
    """Rows of (loc_id, hour, value), optionally with tier and variable."""
    def make(rows, tier="historic", var="temperature_2m", source="nasapower"):
        full = [(source, r[3] if len(r) > 3 else tier, r[4] if len(r) > 4 else var, r[0],
                 START + dt.timedelta(hours=r[1]), r[2]) for r in rows]
        return spark.createDataFrame(full, OBS_SCHEMA)
    return make


@pytest.fixture(scope="session")
def make_catalogue(spark):
    def make(points, source="nasapower"):
        rows = [(source, i, float(lat), float(lon)) for i, (lat, lon) in enumerate(points)]
        return spark.createDataFrame(rows, "source string, loc_id int, latitude double, longitude double")
    return make
