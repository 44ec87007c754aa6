import os
import sys
from datetime import datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

from netvigil.schema import EVENT_SCHEMA  # noqa: E402
from netvigil.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(spark):
    from netvigil.session import new_path

    return new_path(spark, "test")


def at(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, timezone.utc)


def event_rows(spark, rows):
    """Events from dicts: ``ms`` and any event fields; metrics as decimals, so means are exact."""
    fields = []
    for field in EVENT_SCHEMA.fields:
        fields.append(T.StructField(field.name, T.DecimalType(8, 3)) if isinstance(field.dataType, T.FloatType) else field)
    made = []
    for given in rows:
        given = dict(given)
        values = {"timestamp": at(given.pop("ms")) if "ms" in given else None}
        for name, value in given.items():
            values[name] = Decimal(str(value)) if isinstance(value, (int, float)) else value
        made.append(tuple(values.get(f.name) for f in fields))
    return spark.createDataFrame(made, T.StructType(fields))


def dicts(frame) -> list[dict]:
    return [r.asDict(recursive=True) if isinstance(r, Row) else r for r in frame.collect()]
