"""What a reused Python worker holds between tasks."""

import re
from pathlib import Path

from millrace.llm import _arrow


def own_mb():
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


class Rows:
    """Stands for a DataFrame; keeps the function that would run in a worker."""

    sparkSession = None

    def mapInArrow(self, run, schema):
        return run


def test_a_task_gives_its_memory_back(monkeypatch):
    monkeypatch.setattr(_arrow, "_send_package", lambda spark: None)
    survivors = []

    def fill(batches):
        for batch in batches:
            pieces = [bytes(1500) for _ in range(100_000)]
            survivors.append(pieces[-1])  # lies above the others, so the heap can't shrink by itself
            yield batch

    before = own_mb()
    assert list(_arrow.in_arrow(Rows(), fill, "x int")(iter([7]))) == [7]
    assert own_mb() - before < 40
