"""Increments of the streamed chart are dealt to more files as the input grows."""

import glob

from chartlake.plans.catalog import tables


def test_increments_have_more_files_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 1_000)
    out = tables._streamed_gold(spark, "/root/testdata/sf0.001", ("track_catalog",))
    assert len(glob.glob(f"{out}/incoming/*.parquet")) == 6
    assert len(glob.glob(f"{out}/bronze/batch=*")) == 2
