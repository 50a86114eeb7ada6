import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerspark.session import get_spark
    s = get_spark("local[2]", app="ledgerspark-tests", shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh")),
                         "spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (default: all) as a list of tuples."""
    cols = cols or df.columns
    return [tuple(r) for r in df.select(*cols).collect()]
