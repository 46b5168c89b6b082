from __future__ import annotations

import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerspark.schemas import TABLES  # noqa: E402
from ledgerspark.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        # Plans are compared as text: do not shorten what scans push down.
        "spark.sql.maxMetadataStringLength": "10000",
    }
    session = build_session("tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def table(spark):
    """Rows of an exchange table from dictionaries; columns left out are null."""

    def make(name: str, *rows: dict):
        schema = TABLES[name].schema
        filled = []
        for row in rows:
            row = {"taxpayer_id": "tp", **row}
            assert set(row) <= set(schema.names), set(row) - set(schema.names)
            values = []
            for field in schema:
                value = row.get(field.name)
                if field.dataType.typeName() == "decimal" and value is not None:
                    value = Decimal(str(value))
                values.append(value)
            filled.append(tuple(values))
        return spark.createDataFrame(filled, schema)

    return make


@pytest.fixture(scope="session")
def frame(spark):
    """A frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
