"""Listings against a walk of the folders."""

import os

import pytest

from weblens.sources import list_entries


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a/b c/empty").mkdir(parents=True)
    (tmp_path / "a/one.log").write_text("x" * 10)
    (tmp_path / "a/b c/_hidden%20.txt").write_text("")
    (tmp_path / ".dot").write_text("é")
    (tmp_path / "link").symlink_to(tmp_path)
    (tmp_path / "dangling").symlink_to(tmp_path / "nothing")
    return str(tmp_path)


def walked(folder):
    found = set()
    for place, folders, files in os.walk(folder):
        found |= {(n, f"file:{place}/{n}", "directory", 0) for n in folders}
        sizes = [(n, f"{place}/{n}") for n in files if os.path.exists(f"{place}/{n}")]
        found |= {(n, f"file:{p}", "file", os.path.getsize(p)) for n, p in sizes}
    return found


def rows(df):
    got = df.collect()
    assert all(r.modified is not None for r in got)
    assert len({r.path for r in got}) == len(got)
    return {(r.name, r.path, r.type, r.size) for r in got}


def test_all_levels(spark, folder):
    assert rows(list_entries(spark, folder)) == walked(folder)
    assert rows(list_entries(spark, f"file://{folder}/")) == walked(folder)


def test_one_level(spark, folder):
    got = rows(list_entries(spark, folder, recursive=False))
    assert {r[0] for r in got} == {"a", ".dot", "link"}


def test_nothing_there(spark, folder):
    assert list_entries(spark, f"{folder}/a/b c/empty").count() == 0
    with pytest.raises(Exception, match="No such file"):
        list_entries(spark, f"{folder}/missing")
