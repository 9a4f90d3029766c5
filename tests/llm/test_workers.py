"""What workers keep between operators."""

import os

import psutil
import pyarrow as pa
import pytest

from geoloom.llm.arrow import slices
from geoloom.llm.chunks import _TRIM, Cache
from geoloom.session import BATCH_BYTES


def freed(n=100_000):
    """Leaves about ``n`` KB free in the C library's heap, with something in use above them."""
    held = [os.urandom(1000) for _ in range(n)]
    last = held[-1]
    del held
    return last


def resident():
    return psutil.Process().memory_info().rss >> 20


@pytest.mark.skipif(_TRIM is None, reason="the C library has no malloc_trim")
def test_a_task_first_returns_what_others_freed():
    last = freed()
    before = resident()
    assert not list(slices(iter([])))
    assert before - resident() > 50, last[:1]


@pytest.mark.skipif(_TRIM is None, reason="the C library has no malloc_trim")
def test_a_dropped_cache_is_returned():
    cache = Cache(lambda chunks: [os.urandom(1000) for _ in chunks])
    cache.fill([[str(i) for i in range(100_000)]])
    last = os.urandom(1000)
    before = resident()
    Cache.use(None)
    assert before - resident() > 50, last[:1]


def test_workers_get_batches_of_bounded_bytes(spark):
    """2,000 texts of 5 KB would come in one batch."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["bytes"])

    got = [r["bytes"] for r in spark.range(0, 2000, 1, 1).selectExpr("repeat('abcde', 1000) as text").mapInArrow(sizes, "bytes long").collect()]
    assert sum(got) > 2000 * 5000 and max(got) < BATCH_BYTES + 10_000, got
