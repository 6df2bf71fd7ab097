import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from given import GOLDEN  # noqa: E402

from shoptrail.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shoptrail-tests",
        "local[*]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    from shoptrail.schemas import BEHAVIOR_LOG

    return spark.createDataFrame(GOLDEN, BEHAVIOR_LOG)


@pytest.fixture(scope="session")
def pairs_of(spark):
    from shoptrail.schemas import USER_ITEM_PAIRS

    def make(pairs, partitions=3):
        return spark.createDataFrame(sorted(pairs), USER_ITEM_PAIRS).repartition(partitions)

    return make
