"""What a task of a reader holds of a batch in Python's objects."""

import tracemalloc

import pyarrow as pa

from loomtable.sources import cut


def test_a_batch_is_never_whole_in_objects():
    n = 20_000
    batch = pa.record_batch([pa.array(["f"] * n), pa.array([0] * n), pa.array([f"{k:01000}" for k in range(n)])], names=["file", "start", "value"])
    tracemalloc.start()
    seen = sum(int(value) for _, _, value in cut._runs(iter([batch, batch.slice(0, 0)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n * (n - 1) // 2 and peak < 2_000_000
