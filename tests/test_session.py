import pytest

from plumbline.session import _shared_root, path_exists, scratch_dir


def test_scratch_folders_are_fresh(spark, folder):
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first != second and not path_exists(spark, first) and path_exists(spark, folder)
    if root := spark.conf.get("spark.checkpoint.dir", None):
        assert first.startswith(f"{root.rstrip('/')}/a-")


def test_only_a_local_session_may_go_without_a_shared_folder():
    assert _shared_root("/shared", "yarn") == "/shared"
    assert _shared_root(None, "local[8]").startswith("/tmp/spark-")
    with pytest.raises(ValueError):
        _shared_root(None, "yarn")
