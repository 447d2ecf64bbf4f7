import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadweave.schemas import SIGHTING_FIELDS, SIGHTING_SCHEMA  # noqa: E402
from leadweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


BLANK = {n: "" if t.simpleString() == "string" else None for n, t in SIGHTING_FIELDS} | {"score": 0, "scraped_date": "2024-01-01"}


def make(spark, rows):
    """Sightings from partial dicts, numbered in order."""
    full = [{"seq": i} | BLANK | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f.name] for f in SIGHTING_SCHEMA) for r in full], SIGHTING_SCHEMA)
