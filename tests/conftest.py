import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import local_session  # noqa: E402
from tidewater.sources.catalog import Sources  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 3, 15, 12, 0, 0)  # fixture run time (FIXTURES.md)


@pytest.fixture(scope="session")
def spark():
    return local_session("*", shuffle_partitions=8, app="tidewater-tests")


@pytest.fixture(scope="session")
def schemas(spark):
    from pyspark.sql.types import StructField, StructType
    t = Sources.from_testdata(spark, SF_SMALL, AS_OF)
    return {name: StructType([StructField(f.name, f.dataType, True) for f in t[name].schema.fields])
            for name in t}


@pytest.fixture
def tables(spark, schemas):
    """Build a Sources from hand-written rows; unspecified columns are NULL,
    ``_fivetran_deleted`` defaults to False, unspecified tables are empty."""

    def make(**rows):
        frames = {}
        for name, schema in schemas.items():
            data = rows.get(name, [])
            full = []
            for r in data:
                d = {f.name: None for f in schema.fields}
                if "_fivetran_deleted" in d:
                    d["_fivetran_deleted"] = False
                d.update(r)
                full.append(tuple(d[f.name] for f in schema.fields))
            frames[name] = spark.createDataFrame(full, schema)
        return Sources.from_tables(spark, frames)

    return make
