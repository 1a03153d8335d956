"""Memory of a worker that runs the mappers of all pipeline stages one after another, as workers on a cluster do."""

from __future__ import annotations

import json
import os
import subprocess
import sys

SCRIPT = r"""
import json, random, resource, sys
from types import SimpleNamespace as Thing

import numpy as np
import pyarrow as pa

from recspark.llm import dartminhash, langid, packing, text, toxicity, winnow
from recspark.llm.queries import tokenizer_path

rng = random.Random(1)
words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
rows = [" ".join(rng.choices(words, k=rng.choice([60, 300, 600, 1200]))) for _ in range(8_000)]
batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], names=["id", "text"])
del rows
sent = lambda value: Thing(value=value)
spark = Thing(sparkContext=Thing(broadcast=sent))
units = np.sort(np.random.default_rng(0).integers(0, 2**63, 100_000).astype(np.uint64))
model = toxicity.Model(units, np.ones(len(units), np.int64), np.full(len(units), 9), 0.1)

def resident():
    return int(next(line for line in open("/proc/self/status") if line.startswith("VmRSS")).split()[1]) / 1024

def peak():
    return int(next(line for line in open("/proc/self/status") if line.startswith("VmHWM")).split()[1]) / 1024

def drain(run):
    for _ in run(iter([batch])):
        pass

packing.TaskContext = Thing(get=lambda: Thing(partitionId=lambda: 0))
mappers = {
    "toxicity": lambda: toxicity.scorer(spark, model).func(batch.column(1)),
    "language ID": lambda: langid._score(sent(np.zeros((4, langid.BUCKETS), np.float32))).func(batch.column(1)),
    "near-duplicates": lambda: drain(dartminhash._signed(5, 24, 4, False)),
    "decontamination": lambda: drain(winnow._document_windows(10, 6, (3, 5), sent((units, winnow.Known(units).bits)))),
    "packing": lambda: drain(packing._pieces(tokenizer_path(), 2048, 0, False)),
}
text.give_back()
before, told = resident(), {}
for name, mapper in mappers.items():
    open("/proc/self/clear_refs", "w").write("5")  # the peak starts anew
    mapper()
    most = peak() - before
    text.give_back()
    told[name] = [round(most), round(resident() - before)]
print(json.dumps(told))
"""


def test_no_stage_needs_or_keeps_much_memory():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"PYTHONPATH": os.pathsep.join([root, os.environ.get("PYTHONPATH", "")]), "OMP_NUM_THREADS": "1"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, env=env, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    told = json.loads(done.stdout.splitlines()[-1])
    assert all(most < 250 for most, _ in told.values()), told
    assert all(kept < 120 for _, kept in told.values()), told
