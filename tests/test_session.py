"""Lineage cuts go to the folder named by spark.checkpoint.dir."""

from tessera.operators.merge import assert_unique
from tessera.session import checkpoint_dir, materialize


def test_materialize_uses_checkpoint_dir(spark):
    shared = checkpoint_dir(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:  # a configured shared folder always wins
        assert shared == conf
    df = materialize(spark.range(10), "probe")
    files = df.inputFiles()
    assert files and all(shared.rstrip("/") in f for f in files)
    assert df.count() == 10


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k long, v string")
    assert [r.k for r in assert_unique(df, ["k"]).collect()] == [1]


def test_fallback_when_unset_uses_set_checkpoint_dir():
    """Unset config (local runs): one scratch folder per context, registered
    through setCheckpointDir, never through the rejected runtime conf."""
    calls = []

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        def getConf(self):
            return Conf()

        def setCheckpointDir(self, path):
            calls.append(path)

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    s = Session()
    first, second = checkpoint_dir(s), checkpoint_dir(s)
    assert first == second and calls == [first] and first.startswith("/tmp/tessera-ckpt-")


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
