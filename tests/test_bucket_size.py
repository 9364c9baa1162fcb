"""Buckets that fit a task."""

import pytest

from ordermart.sources.catalog import BUCKET_BYTES, bucket_count


def test_a_bucket_fits_a_task():
    """A task sorts its bucket in memory, some sixty times the bytes of the source, and has about a gigabyte for it."""
    assert 60 * BUCKET_BYTES < 512 << 20


@pytest.mark.parametrize("most", [7, 50])
def test_no_more_buckets_than_the_session_allows(spark, most):
    df, conf = spark.range(1000), "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(conf)
    spark.conf.set(conf, most)
    try:
        assert bucket_count([df], bucket_bytes=10) == most
    finally:
        spark.conf.set(conf, before)
