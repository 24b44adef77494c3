"""Memory of the Python workers."""

from __future__ import annotations

import sys

import pyarrow as pa
import pytest

from activity_engine.llm.common import slices


def resident() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_task_gives_its_memory_back():
    work = slices(iter([pa.RecordBatch.from_pydict({"x": [1]})]))
    next(work)
    held = [bytearray(60_000) for _ in range(4000)]
    pinned = bytearray(60_000)  # the heap cannot shrink from its end
    for block in held:
        block[::4096] = b"1" * len(block[::4096])
    del held, block
    before = resident()
    assert not list(work)
    assert before - resident() > 100 << 20 and pinned is not None
