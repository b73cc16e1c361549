from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from obslake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="obslake-tests")
    yield s
    s.stop()


def reading(temp=80.0, rain=0.0, interval=900, extra=None, drop=()):
    cur = {
        "time": "2025-09-09T15:00", "interval": interval, "temperature_2m": temp,
        "relative_humidity_2m": 70.0, "apparent_temperature": temp + 5,
        "is_day": 1, "cloud_cover": 40.0, "surface_pressure": 1010.0,
        "precipitation": 0.0, "rain": rain, "showers": 0.0, "weather_code": 2,
        "pressure_msl": 1012.0, "wind_speed_10m": 10.0, "wind_direction_10m": 90.0,
        "wind_gusts_10m": 15.0,
    }
    cur.update(extra or {})
    for d in drop:
        cur.pop(d, None)
    return {"latitude": 25.0, "longitude": 80.0, "current": cur}


class Lake:
    """A temp lake laid out as ``date=<d>/<city>/<city>_<d>.json``."""

    def __init__(self, root: str):
        self.root = root

    def put(self, date: str, city: str, body, name: str | None = None) -> str:
        d = os.path.join(self.root, f"date={date}", city)
        os.makedirs(d, exist_ok=True)
        p = os.path.join(d, name or f"{city}_{date}.json")
        with open(p, "w") as f:
            f.write(body if isinstance(body, str) else json.dumps(body))
            f.write("\n")
        return p


@pytest.fixture()
def lake():
    return Lake(tempfile.mkdtemp(prefix="obslake-lake-"))


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="obslake-out-")
