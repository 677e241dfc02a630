import pytest

from sedimenta.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, "3g", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return session
