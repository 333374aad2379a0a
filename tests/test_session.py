"""Shared storage resolution and sink layout."""

from lumenlog.session import run_folder, shared_root


def test_shared_root_is_the_checkpoint_dir(spark):
    root = shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = run_folder(spark, "job"), run_folder(spark, "job")
    assert a != b and a.startswith(root + "/lumenlog/job-") and b.startswith(root + "/lumenlog/job-")
