import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lodestack.session import session

    out = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    out.sparkContext.setLogLevel("ERROR")
    out.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield out
    out.stop()


@pytest.fixture
def catalog(spark, tmp_path):
    from lodestack.sources.catalog import Catalog

    out = Catalog(spark, str(tmp_path))
    out.create_namespace("b.s")
    return out


@pytest.fixture(scope="session")
def folder():
    return DATA
