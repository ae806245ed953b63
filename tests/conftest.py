import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ridegauge import session  # noqa: E402

ROUTE_COLUMNS = (
    "id bigint, passengerCapacity bigint, origin string, destination string, "
    "transportType string, operator string, seq bigint, ts timestamp"
)
TRIP_COLUMNS = (
    "id bigint, routeId bigint, passengerId bigint, transportType string, seq bigint"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    built = session.build(
        "ridegauge-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def make_routes(spark):
    """Routes from (id, capacity, type, operator) tuples, published in list order."""

    def make(rows, ts="2024-01-01 10:00:00"):
        import datetime

        when = datetime.datetime.fromisoformat(ts)
        data = [
            (row[0], row[1], None, None, row[2], row[3], seq, when) for seq, row in enumerate(rows)
        ]
        return spark.createDataFrame(data, ROUTE_COLUMNS)

    return make


@pytest.fixture(scope="session")
def make_trips(spark):
    """Trips from (routeId, passengerId, type) tuples, in list order."""

    def make(rows):
        data = [(seq, row[0], row[1], row[2], seq) for seq, row in enumerate(rows)]
        return spark.createDataFrame(data, TRIP_COLUMNS)

    return make


def values(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
