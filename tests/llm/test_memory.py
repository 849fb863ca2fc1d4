import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from terrace.llm.arrays import give_back, slices
from terrace.session import BATCH_BYTES

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_stages_hold_few_rows_of_long_texts_at_once(spark, sf):
    """Each stage that goes through Python ends Arrow batches by their bytes: 10,000 long texts are not held together."""
    rows = spark.range(0, 8000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 150) AS text", "'en' AS lang", "'a' AS source")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    widest = lambda: max(r["n"] for r in rows.mapInArrow(sizes, "n long").collect())
    few = rows.limit(3)
    for name, stage in corpus_pipeline.STAGES:
        if name == "mixture":
            continue
        spark.conf.unset(SETTING)
        assert widest() > 2 * BATCH_BYTES
        assert stage(spark, few, sf).count() <= 3
        assert widest() < 1.1 * BATCH_BYTES
    spark.conf.unset(SETTING)


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc and asks glibc")
def test_a_worker_gives_back_what_small_arrays_held():
    """Freed small arrays below one that stays would keep an idle worker as large as it ever was."""
    own = lambda: int(re.search(r"Rss:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024
    # what earlier tests freed would hold the arrays without a byte more
    give_back()
    before = own()
    held = [np.ones(12_000) for _ in range(2000)]
    assert own() > before + 150
    last = held[-1]
    del held
    texts = pa.RecordBatch.from_pydict({"text": ["one two", None, "three"]})
    assert sum(b.num_rows for b in slices([texts])) == 3
    assert own() < before + 60 and last.sum() == 12_000
