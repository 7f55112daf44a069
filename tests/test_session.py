from tessera.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_reused_and_scratch_paths_are_fresh(spark):
    first = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(first) and b.startswith(first)
