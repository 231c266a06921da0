import pytest

from siltstone.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}", spark__sql__warehouse__dir=f"file://{tmp_path_factory.mktemp('warehouse')}")
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
