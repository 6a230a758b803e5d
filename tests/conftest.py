import os
import sys
from datetime import datetime, timedelta

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from barlab.schemas import RAW_SCHEMA  # noqa: E402
from barlab.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = open_session(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def make_bars(spark):
    """Bars from closes: {pair: [close, ...]} or {pair: [(hours, close), ...]}."""

    def build(closes, timeframe="1h", opens=None):
        rows = []
        for pair, values in closes.items():
            for i, value in enumerate(values):
                hours, close = value if isinstance(value, tuple) else (i, value)
                price = close if close is not None else 0.0
                opened = price - 1.0 if opens is None else opens
                rows.append((
                    START + timedelta(hours=hours), pair, timeframe, opened,
                    max(opened, price), min(opened, price), close, i + 1,
                ))
        fields = {f.name: f.dataType.simpleString() for f in RAW_SCHEMA}
        columns = ["Date", "Pair", "Timeframe", "Open", "High", "Low", "Close", "Volume"]
        schema = ", ".join(f"{c} {fields.get(c, 'string')}" for c in columns)
        return spark.createDataFrame(rows, schema)

    return build
