import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from isolake.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4", "spark.driver.memory": "3g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": "file://" + str(tmp_path_factory.mktemp("shared")),
    })
    yield s
    s.stop()


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
