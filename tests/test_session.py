"""Session helpers: partition sizing and the shared scratch folder."""

from tessera.session import shared_dir, shuffle_partitions_for


def test_shuffle_partitions_for_volume():
    assert shuffle_partitions_for(100 * 2 ** 40) == 409600      # 100 TiB at 256 MiB per partition
    assert shuffle_partitions_for(10 * 2 ** 20) == 200          # small inputs keep the floor
    assert shuffle_partitions_for(2 ** 40, target_bytes=2 ** 30) == 1024


def test_shared_dir_is_under_the_configured_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    a, b = shared_dir(spark, "x", "y"), shared_dir(spark, "x", "y")
    assert a != b and a.startswith(base.rstrip("/") + "/x/y/") and b.startswith(base.rstrip("/") + "/x/y/")
