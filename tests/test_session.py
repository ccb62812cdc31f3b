"""Sizing of shuffle and scan settings for the target scale."""

from ledgerline.session import scale_settings


def test_scale_settings_100tb():
    conf = scale_settings(100 << 40, executor_memory_bytes=16 << 30, cores_per_executor=4, executors=1000)
    parts = int(conf["spark.sql.shuffle.partitions"])
    target = int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"])
    assert target == 256 << 20
    assert parts * target >= 100 << 40 and parts >= 4000
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scale_settings_small_input_keeps_slots():
    conf = scale_settings(1 << 30, cores_per_executor=8, executors=1)
    assert int(conf["spark.sql.shuffle.partitions"]) == 8
