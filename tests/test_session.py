"""The shared folder is read from the session; a private one is registered
through the context only when none is set (the core setting is read-only
at runtime)."""

from ridgeline.session import scratch_path, shared_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):  # pragma: no cover - must not be called
        raise AssertionError("spark.checkpoint.dir cannot be set at runtime")


class _Ctx:
    master = "local[2]"
    applicationId = "app"

    def __init__(self, value=None):
        self.value = value

    def getCheckpointDir(self):
        return self.value

    def setCheckpointDir(self, path):
        self.value = path


class _Session:
    def __init__(self, conf_value, ctx_value=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Ctx(ctx_value)


def test_reads_session_setting():
    assert shared_dir(_Session("hdfs://nn/shared/ckpt/")) == "hdfs://nn/shared/ckpt"
    assert scratch_path(_Session("hdfs://nn/shared"), "x").startswith("hdfs://nn/shared/ridgeline/x-")


def test_falls_back_to_context_then_private_folder():
    assert shared_dir(_Session(None, "file:/data/ckpt/abc")) == "file:/data/ckpt/abc"
    s = _Session(None, None)
    path = shared_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest
    from ridgeline.session import shared_dir

    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d),
                            sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(spark)


def test_scratch_folders_go_with_their_scope(spark):
    from ridgeline.session import child_names, clear_scratch, scratch_path, scratch_scope
    kept = scratch_path(spark, "kept")
    with scratch_scope(spark):
        inner = scratch_path(spark, "inner")
        spark.range(3).write.parquet(inner)
        spark.read.parquet(inner).write.parquet(kept)
    assert child_names(spark, inner) == [] and spark.read.parquet(kept).count() == 3
    clear_scratch(spark)
    assert child_names(spark, kept) == []
