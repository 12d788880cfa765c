"""Published regression results, if a folder with them is given.

WATTLINE_GOLDEN_DIR holds `input.csv` (bucket_start, machine_id, both targets, the features) and result
tables under the names of `RegressionRun.tables()`, each with a `target` column.
"""

from __future__ import annotations

import os

import pandas as pd
import pytest

from wattline.plans.regression import run_targets
from wattline.sources import readers
from wattline.sources.seed_csv import null_if_missing

GOLDEN = os.environ.get("WATTLINE_GOLDEN_DIR")
KEYS = ["target", "model_type", "parameter", "feature", "variable", "direction"]


@pytest.mark.skipif(not GOLDEN, reason="WATTLINE_GOLDEN_DIR is not set")
def test_results_equal_the_published_ones(spark):
    text = readers.scan_csv_text(spark, f"{GOLDEN}/input.csv")
    rows = text.select(*[null_if_missing(text[c]).alias(c) for c in text.columns])
    tables = run_targets(rows.withColumn("bucket_start", rows["bucket_start"].cast("timestamp").cast("timestamp_ntz"))).tables()
    compared = 0
    for name, table in tables.items():
        path = f"{GOLDEN}/{name}.csv"
        if not os.path.exists(path):
            continue
        wanted, got = pd.read_csv(path), table.toPandas()
        keys = [c for c in KEYS if c in wanted.columns]
        wanted, got = wanted.set_index(keys).sort_index(), got.set_index(keys).sort_index()
        assert list(wanted.index) == list(got.index), name
        for column in wanted.columns:
            for have, want in zip(got[column], wanted[column], strict=True):
                assert (pd.isna(have) and pd.isna(want)) or have == pytest.approx(want, rel=1e-5, abs=1e-12), (name, column)
                compared += 1
    assert compared > 100
