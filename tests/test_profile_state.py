import os

import pytest

from ingot.operators import profile_state
from ingot.operators.profile import json_facts, merge_facts
from ingot.operators.profile_state import ProfileState, StateConflict
from ingot.sources.listing import list_files
from ingot.sources.ndjson import raw_lines
from tests.conftest import jl, write_gz


def rows(df):
    return {tuple(r) for r in df.collect()}


def scratch(spark, root):
    return rows(merge_facts(json_facts(raw_lines(spark, root, "*.gz").select("value"))))


def test_added_changed_and_withdrawn_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "d")
    state = ProfileState(spark, str(tmp_path / "state"), sample=0)
    assert state.profile().collect() == []
    write_gz(f"{root}/f/a.gz", jl({"id": 1, "x": 2}, {"id": 2, "x": "3"}))
    write_gz(f"{root}/f/b.gz", jl({"id": 1.5, "tags": [{"k": 1}]}) + ["junk"])
    listed = lambda: list_files(spark, root, "*.gz")
    did = lambda files: tuple(map(state.update(files).get, ("scanned", "withdrawn")))
    assert did(listed()) == (2, 0)
    assert rows(state.profile()) == scratch(spark, root) and {r.type for r in state.profile().where("path = 'id'").collect()} == {"FLOAT"}
    # one file comes, one goes: its kinds go with it
    write_gz(f"{root}/g/c.gz", jl({"id": 7, "when": "2020-01-01"}))
    os.remove(f"{root}/f/b.gz")
    read = []
    monkeypatch.setattr(profile_state, "heads_of", lambda df, *a, f=profile_state.heads_of: (read.append(df.count()), f(df, *a))[1])
    assert did(listed()) == (1, 1) and read == [1] and state.runs()[-1]["run"] == 1
    assert rows(state.profile()) == scratch(spark, root) and {r.type for r in state.profile().where("path = 'id'").collect()} == {"INTEGER"}
    assert state.profile().where("path like 'tags%'").count() == 0
    # a changed file is retracted and added; a file comes back
    write_gz(f"{root}/f/a.gz", jl({"id": "text", "y": None}, {"y": [None, 1]}, {}))
    write_gz(f"{root}/f/b.gz", jl({"id": 1}))
    assert did(listed()) == (2, 1)
    assert rows(state.profile()) == scratch(spark, root)
    assert did(listed()) == (0, 0) and rows(state.profile()) == scratch(spark, root)
    assert did(listed().where("false")) == (0, 3) and state.profile().collect() == []


def test_one_update_of_a_run_counts(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "d")
    write_gz(f"{root}/f/a.gz", jl({"id": 1}))
    state = ProfileState(spark, str(tmp_path / "state"))
    real = profile_state.fs_create_new

    def late(s, path, text):
        monkeypatch.setattr(profile_state, "fs_create_new", real)
        ProfileState(s, str(tmp_path / "state")).update(list_files(s, root, "*.gz"))  # another is faster
        return real(s, path, text)

    monkeypatch.setattr(profile_state, "fs_create_new", late)
    with pytest.raises(StateConflict):
        state.update(list_files(spark, root, "*.gz"))
    assert [tuple(r) for r in state.profile().collect()] == [("id", "INTEGER", "NULLABLE", 1)]


def test_sampled_state(spark, tmp_path):
    root = str(tmp_path / "d")
    write_gz(f"{root}/f/a.gz", jl({"id": 1}, {"id": 2}, {"id": "late"}))
    state = ProfileState(spark, str(tmp_path / "state"), sample=2)
    state.update(list_files(spark, root, "*.gz"))
    assert [tuple(r) for r in state.profile().collect()] == [("id", "INTEGER", "NULLABLE", 2)]
