from innkeeper import session


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = session.ensure_checkpoint_dir(spark)
    if configured:
        assert got == configured
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    base = session.ensure_checkpoint_dir(spark).rstrip("/")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(base + "/x-") and b.startswith(base + "/x-")
