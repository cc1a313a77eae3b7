"""Intermediate tables live under the session's checkpoint folder."""

import re

import pytest

from cupola.session import checkpoint_dir, materialise


def _path(uri: str) -> str:
    # file:/x, file:///x -> /x (other schemes are left as they are)
    return re.sub(r"^file:/+", "/", uri)


def test_materialise_writes_under_the_checkpoint_folder(spark):
    base = _path(checkpoint_dir(spark).rstrip("/"))
    df = materialise(spark.range(10).selectExpr("id", "id * 2 as twice"))
    files = [_path(f) for f in df.inputFiles()]
    assert files and all(f.startswith(base + "/tables/") for f in files)
    assert sorted(r.twice for r in df.collect()) == [2 * i for i in range(10)]


def test_tables_are_dropped(spark, monkeypatch):
    from cupola import session

    monkeypatch.setattr(session, "_TABLES", [])
    df = materialise(spark.range(3).toDF("id"))
    assert df.count() == 3 and session.drop_tables(spark) == 1 and session._TABLES == []
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()
