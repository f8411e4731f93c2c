from hitlens.session import shared_dir, stored_table_path


def test_shared_dir_uses_the_session_setting(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured
    assert shared_dir(spark) == configured
    a, b = stored_table_path(spark, "t"), stored_table_path(spark, "t")
    assert a != b and a.startswith(configured.rstrip("/"))
