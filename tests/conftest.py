import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from courtside.session import build_session

    s = build_session(4, shuffle_partitions=4, app_name="courtside-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def rows(df, order=None):
    """Collected rows as plain dicts, sorted by ``order`` (or all columns) for comparisons."""
    out = [r.asDict() for r in df.collect()]
    key = order or list(df.columns)
    return sorted(out, key=lambda d: tuple((d[k] is None, str(d[k])) for k in key))


def make(spark, table, records):
    """A raw table from a few dicts; missing columns are NULL, types from the declared schema."""
    from courtside.sources import schemas
    from courtside.sources.tables import conform

    schema = schemas.SCHEMAS[table]
    full = [{f.name: r.get(f.name) for f in schema.fields} for r in records]
    return conform(spark.createDataFrame(full, schema), schema)
