import pytest

from quartermark.session import shared_dir, written_once
from quartermark.sources.files import open_stream, resolve


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, folder=None, **conf):
        self.sparkContext, self.conf = Context(master, folder), Conf(conf)


def test_the_configured_folder_wins():
    session = Session("yarn", "x:/other", **{"spark.checkpoint.dir": "hdfs://n/shared/"})
    first, second = shared_dir(session, "a"), shared_dir(session, "a")
    assert first.startswith("hdfs://n/shared/a-") and first != second
    assert shared_dir(Session("yarn", "hdfs://n/set"), "a").startswith("hdfs://n/set/a-")


def test_a_cluster_gets_no_machine_local_folder():
    with pytest.raises(RuntimeError):
        shared_dir(Session("spark://host"), "a")
    local = Session("local[2]")
    assert shared_dir(local, "a").startswith(local.sparkContext.folder)


def test_written_once_reads_back(spark, rows):
    df = spark.range(3)
    stored = written_once(df, "t")
    assert rows(stored) == rows(df) and stored.inputFiles()


def test_paths_as_spark_lists_them(tmp_path):
    file = tmp_path / "a b+ç%20.txt"
    file.write_text("x")
    for path in (f"file:{file}", f"file://{file}", str(file)):
        assert resolve(path)[1] == str(file)
        with open_stream(path) as stream:
            assert stream.read() == b"x"
