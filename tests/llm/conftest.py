import pytest

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture(scope="session")
def batch_bytes(spark):
    return spark.conf.get(BATCH_BYTES)


@pytest.fixture(autouse=True)
def own_batches(spark, batch_bytes):
    """Stages bound the session's Arrow batches and leave them so; each test
    begins with the session's own bound, whatever ran before it."""
    spark.conf.set(BATCH_BYTES, batch_bytes)
