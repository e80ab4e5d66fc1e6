"""Events without any time, or none at all, are staged and landed whole."""

from motorlake.session import run_dir
from motorlake.streaming import ingest as I


def test_events_without_any_time_are_landed(spark):
    events = spark.createDataFrame([(i, None, 1, "x", 1.0, None) for i in range(5)], I.EVENT_SCHEMA)
    root = run_dir(spark, "untimed")
    chunks = I.stage_events(events, f"{root}/staged")
    assert chunks == [None]
    I.land_chunks(spark, f"{root}/staged", f"{root}/landing", chunks)
    I.run_to_parquet(I.read_events_stream(spark, f"{root}/landing"), f"{root}/out", f"{root}/ckpt")
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/out").collect()) == list(range(5))
    assert I.stage_events(events.limit(0), f"{root}/none") == []
