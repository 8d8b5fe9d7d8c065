import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from parcelsight.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        cpus=8, partitions=4, options={"spark.sql.warehouse.dir": warehouse}
    )
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate columns on hand-made rows: values(schema, rows, column) -> list."""

    def run(schema, rows, column):
        return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]

    return run
