"""Streaming ingest: incremental, exactly-once into the same store layout as the batch ingest."""

from __future__ import annotations

import pytest
from test_ingest import MALFORMED

from fleetlens import operators as ops
from fleetlens.session import shared_dir
from fleetlens.sources import ingest_csv_to_store, read_ingested
from fleetlens.streaming import start_ingest_stream

MORE = """
2013-01-07 08:00:00,1,A,1,-6.25,53.35,10,33145,279,1
2013-01-07 08:30:00,1,A,0,-6.25,53.35,10,33145,279,1
"""


def test_stream_ingest_incremental(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "a.csv").write_text(MALFORMED.strip() + "\n")
    dest = shared_dir(spark, "stream-store")

    q = start_ingest_stream(spark, str(src), dest)
    q.awaitTermination(120)
    good, bad = read_ingested(spark, dest)
    assert (good.count(), bad.count()) == (1, 5)

    # a new file: only it is processed on the next run, which finds the checkpoint by itself
    (src / "b.csv").write_text(MORE.strip() + "\n")
    q = start_ingest_stream(spark, str(src), dest)
    q.awaitTermination(120)
    good, bad = read_ingested(spark, dest)
    assert (good.count(), bad.count()) == (3, 5)

    # the operators run on the streamed store unchanged
    out = ops.congestion_by_hour(good, hours=["08"])
    # two reports at 08 in the box (one congested); the malformed file adds none at 08
    assert [tuple(r) for r in out.collect()] == [("08", 50.0, 2, 1)]


def test_stream_ingest_continuous_trigger(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "a.csv").write_text(MORE.strip() + "\n")
    dest = shared_dir(spark, "stream-store-cont")
    q = start_ingest_stream(
        spark, str(src), dest, available_now=False, processing_time="1 second",
        max_files_per_trigger=1,
    )
    try:
        q.processAllAvailable()
        (src / "b.csv").write_text(MALFORMED.strip() + "\n")
        q.processAllAvailable()
    finally:
        q.stop()
    good, bad = read_ingested(spark, dest)
    assert (good.count(), bad.count()) == (3, 5)


def test_a_new_checkpoint_is_refused(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    (src / "a.csv").write_text(MORE.strip() + "\n")
    dest = shared_dir(spark, "stream-store-ckpt")
    start_ingest_stream(spark, str(src), dest).awaitTermination(120)
    with pytest.raises(ValueError, match="checkpoint"):
        start_ingest_stream(spark, str(src), dest, checkpoint=shared_dir(spark, "other-ckpt"))
    # another name is another stream
    start_ingest_stream(spark, str(src), dest, name="second").awaitTermination(120)
    assert read_ingested(spark, dest).good.count() == 4


def test_batches_and_streams_share_a_store(spark, tmp_path):
    src, more = tmp_path / "landing", tmp_path / "batch"
    src.mkdir()
    more.mkdir()
    (src / "a.csv").write_text(MORE.strip() + "\n")
    (more / "b.csv").write_text(MALFORMED.strip() + "\n")
    dest = shared_dir(spark, "mixed-store")
    ingest_csv_to_store(spark, str(more), dest, batch="b1")
    start_ingest_stream(spark, str(src), dest).awaitTermination(120)
    good, bad = read_ingested(spark, dest)
    assert (good.count(), bad.count()) == (3, 5)
    ingest_csv_to_store(spark, str(more), dest, batch="b2")
    (src / "c.csv").write_text(MORE.strip() + "\n")
    start_ingest_stream(spark, str(src), dest).awaitTermination(120)
    good, bad = read_ingested(spark, dest)
    assert (good.count(), bad.count()) == (6, 10)
