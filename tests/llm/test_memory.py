"""What Python workers keep between blocks and stages."""

from __future__ import annotations

import subprocess
import sys

import numpy as np

from tallyslip.llm import common, quality

KEPT = """
import re
from pathlib import Path
import pyarrow as pa
from tallyslip.llm.common import text_blocks

def own_mb():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) // 1024

def stream():
    for i in range(3):
        yield pa.RecordBatch.from_pydict({"text": [f"{i}{j} " + "x" * 4000 for j in range(10_000)]})

before = own_mb()
for block in text_blocks(stream(), 0):
    words = [block.column(0).to_pylist() for _ in range(2)]
    more = pa.array(words[0] * 4)
    del words, more
del block
print(own_mb() - before)
"""


def test_caches_of_words_are_bounded():
    """300,000 words seen, few kept; the means are those of a new reader."""
    reader = quality.Reader(quality.Scorer())
    blocks = [[" ".join(f"w{b}x{i}" for i in range(k, k + 100)) + " the of and" for k in range(0, 30_000, 100)] for b in range(10)]
    for block in blocks:
        got = reader.means(block)
        assert np.array_equal(got, quality.Reader(quality.Scorer()).means(block))
        assert len(reader.table.index) < 150_000


def test_operators_without_caches_drop_what_others_left():
    common.worker_state("words", lambda: [1])
    common.forget()
    assert common.worker_state("words", lambda: [2]) == [2]
    common.forget()


def test_freed_memory_goes_back_to_the_system():
    """Blocks of 40 MB come and go; what the worker holds after them is a small part of that."""
    out = subprocess.run([sys.executable, "-c", KEPT], capture_output=True, text=True, check=True, cwd=common.__file__.split("/tallyslip/")[0])
    assert int(out.stdout) < 30
