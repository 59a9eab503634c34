"""Stored copies that queries make on their way end with them."""

from pathlib import Path

import pytest

from sievemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_pivot_near_dedup", "op5_jaccard_join", "op8_bit_plane_ids", "op10_packing", "op11_whitening"])
def test_only_the_result_is_left(text_spark, name):
    scratch = Path(text_spark.conf.get("spark.checkpoint.dir")) / "materialised"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    found = QUERIES[name](text_spark, SF_DIR)
    assert len(set(scratch.iterdir()) - before) == 1
    assert found.count() > 0
