import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.sql.codegen.wholeStage": "false",  # compiling would dominate on a few rows
            "spark.checkpoint.dir": f"file:{shared}",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Literal frame from a DDL schema and tuples; text is cast to dates and moments."""

    def make(schema, *data):
        names = [c.split()[0] for c in schema.split(", ")]
        types = [c.split()[1] for c in schema.split(", ")]
        text = {"date", "timestamp_ntz"}
        loose = ", ".join(
            f"{n} {'string' if t in text or t.startswith('decimal') else t}"
            for n, t in zip(names, types)
        )
        df = spark.createDataFrame([tuple(r) for r in data], loose)
        return df.select(*[df[n].cast(t).alias(n) for n, t in zip(names, types)])

    return make


def plain(value):
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return str(value) if value.__class__.__name__ == "Decimal" else value


def bag(df, *columns):
    """Rows as sorted tuples, dates and decimals as text."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(plain(v) for v in row) for row in picked.collect()),
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


@pytest.fixture(name="bag")
def _bag():
    return bag
