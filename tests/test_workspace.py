from types import SimpleNamespace

import pytest

from tideline import workspace


class Clustered:
    """The test session, seen as one of a cluster; tasks may write elsewhere than the driver looks."""

    def __init__(self, spark, folder, elsewhere=None):
        self._spark, self._elsewhere = spark, elsewhere
        self.conf = SimpleNamespace(get=lambda name, default=None: folder)
        self.sparkContext = SimpleNamespace(master="spark://head:7077", applicationId=folder, defaultParallelism=3)

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def range(self, *args):
        rows = self._spark.range(*args)
        if not self._elsewhere:
            return rows
        kept = SimpleNamespace(parquet=lambda path: rows.write.parquet(path.replace("/mine/", f"/{self._elsewhere}/")))
        return SimpleNamespace(write=kept)


@pytest.mark.parametrize("scheme", ["file://", ""])
def test_mounted_folder_serves_a_cluster(spark, tmp_path, scheme):
    folder = f"{scheme}{tmp_path}"
    session = Clustered(spark, folder)
    assert workspace.shared_folder(session) == folder
    assert workspace.new_folder(session, "rows").startswith(f"{folder}/rows-")
    assert workspace.new_table_folder(session, "default.rows")
    assert not list(tmp_path.glob("trial-*"))


def test_folder_that_tasks_do_not_share_is_refused(spark, tmp_path):
    session = Clustered(spark, f"file://{tmp_path}/mine", "theirs")
    for _ in range(2):
        with pytest.raises(ValueError, match="folder of one machine"):
            workspace.shared_folder(session)
