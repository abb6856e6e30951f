"""Session helpers: the scratch root follows the session's checkpoint folder."""

from tablejobs.session import (
    scratch_path,
    scratch_root,
    session_scratch,
    table_path,
    unique_name,
)


def test_scratch_root_is_the_sessions_checkpoint_folder(spark):
    root = scratch_root(spark)
    assert root == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert scratch_root(spark) == root          # never replaced once set


def test_scratch_paths_and_names_are_unique(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(session_scratch(spark) + "/x-")
    assert session_scratch(spark).startswith(scratch_root(spark) + "/tablejobs/")
    assert unique_name("v") != unique_name("v")
    assert unique_name("v").replace("_", "").isalnum()


def test_table_path_accepts_trailing_slash():
    assert table_path("/data/sf1/", "orders") == table_path("/data/sf1", "orders")
