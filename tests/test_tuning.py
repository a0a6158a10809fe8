from ohlcflow.plans.tuning import MIB, scale_conf


def test_small_input_uses_core_count():
    c = scale_conf(10 * MIB, 8)
    assert c["spark.sql.shuffle.partitions"] == "8"
    assert c["spark.sql.adaptive.enabled"] == "true"


def test_100tb_partitions_fit_target_size():
    tb = 1 << 40
    c = scale_conf(100 * tb, 8000)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0
    # shuffle volume (half the input) / partitions stays near the 256 MiB target
    assert (50 * tb) / parts <= 256 * MIB
    assert int(c["spark.sql.files.maxPartitionBytes"]) <= 512 * MIB


def test_executor_shape_caps_partition_size():
    gib = 1 << 30
    # 8 GiB executors with 8 cores: ~614 MiB per task -> the 256 MiB target stands
    roomy = scale_conf(10 * gib, 64, executor_memory_bytes=8 * gib, cores_per_executor=8)
    # 2 GiB executors with 8 cores: ~154 MiB per task -> partitions of ~77 MiB
    tight = scale_conf(10 * gib, 64, executor_memory_bytes=2 * gib, cores_per_executor=8)
    assert int(tight["spark.sql.shuffle.partitions"]) > int(roomy["spark.sql.shuffle.partitions"])
    assert int(tight["spark.sql.files.maxPartitionBytes"]) < 100 * MIB
