import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from perkspark.session import build_session

    warehouse = tempfile.mkdtemp(prefix="perkspark-warehouse-")
    session = build_session(
        "local[4]",
        shuffle_partitions=4,
        app_name="perkspark-tests",
        extra_conf={"spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_pipeline(spark):
    from perkspark.plans.pipeline import LoyaltyPipeline

    return LoyaltyPipeline.from_warehouse(spark, SF_SMALL)


def rows(df, *cols):
    """Collected rows as tuples of the given columns, sorted (None first)."""
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
