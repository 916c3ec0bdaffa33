"""Shared folders: qualified names, files of any scheme, tables that are dropped again."""

from __future__ import annotations

import os

import pytest

from dqspark.llm import common


def test_folders_are_named_with_their_file_system(spark):
    folder = common.new_dir(spark, "x")
    assert folder.startswith("file:/")
    filesystem, path = common.open_fs(folder)
    assert path == "/" + folder.removeprefix("file:").lstrip("/") and filesystem.type_name == "local"
    assert common.open_fs("file:///a/b")[1] == "/a/b"


@pytest.mark.parametrize("uri", ["s3a://bucket/a", "s3n://bucket/a", "s3://bucket/a"])
def test_s3_by_any_of_its_names(uri, monkeypatch):
    monkeypatch.setenv("AWS_EC2_METADATA_DISABLED", "true")
    monkeypatch.setenv("AWS_DEFAULT_REGION", "us-east-1")
    from pyarrow import fs

    asked = []
    monkeypatch.setattr(common, "open_fs", common.open_fs)

    class Known:
        @staticmethod
        def from_uri(u):
            asked.append(u)
            return None, u

    monkeypatch.setattr(fs, "FileSystem", Known)
    common.open_fs(uri)
    assert asked == ["s3://bucket/a"]


def test_saved_tables_can_be_dropped(spark):
    before = set(common._SAVED)
    df = common.saved(spark.range(5).toDF("x"), "drop-me")
    assert df.count() == 5
    mine = common._SAVED - before
    folder = next(iter(mine)).removeprefix("file:")
    assert len(mine) == 1 and os.path.isdir(folder)
    common._SAVED.clear()
    common._SAVED.update(mine)
    common.drop_all_saved(spark)
    assert not os.path.isdir(folder) and not common._SAVED
    common._SAVED.update(before)
