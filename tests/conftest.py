import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.contracts import EVENT_SCHEMA  # noqa: E402
from ledgerlake.session import build_session, work_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
           "spark.sql.maxMetadataStringLength": "5000",
           # Tiny inputs: compiling generated code would cost more than running the queries.
           "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN",
           # A zone with daylight saving: no result may depend on it.
           "spark.sql.session.timeZone": "America/Sao_Paulo"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return work_dir(spark)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def event(id, item, when, state, quantity=None, school=1, recorded=None, uf="DF", origin="vistoria_presencial", lsn=None):
    when = at(when) if isinstance(when, str) else when
    recorded = when if recorded is None else (at(recorded) if isinstance(recorded, str) else recorded)
    return (id, item, school, uf, origin, when, recorded, state, quantity, when.strftime("%Y-%m"), lsn)


@pytest.fixture
def events(spark):
    return lambda rows: spark.createDataFrame(rows, EVENT_SCHEMA)
