"""The rule by which a stored manifest covers a wanted one, from properties that hold for any JSON, and the file itself."""

import copy
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftmill.plans.manifest import Manifest, covers

SCALARS = st.none() | st.integers(-3, 3) | st.text("xy", max_size=2)
KEYS = st.sampled_from(["rows", "shards", "inputs", "seed"])
JSON = st.recursive(SCALARS, lambda inner: st.lists(inner, max_size=3) | st.dictionaries(KEYS, inner, max_size=3), max_leaves=12)


def places(value, at=()):
    """The path of every value inside of a JSON value, itself included."""
    yield at
    for key, inner in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        yield from places(inner, (*at, key))


def edited(value, at, edit):
    """A copy in which the value at a place went through edit."""
    if not at:
        return edit(copy.deepcopy(value))
    out = copy.deepcopy(value)
    inner = out
    for key in at[:-1]:
        inner = inner[key]
    inner[at[-1]] = edit(inner[at[-1]])
    return out


@settings(max_examples=200, deadline=None)
@given(JSON, st.data())
def test_objects_may_have_more_keys_at_any_depth(value, data):
    objects = [at for at in places(value) if isinstance(edited_at(value, at), dict)]
    richer = value
    if objects:
        richer = edited(value, data.draw(st.sampled_from(objects)), lambda d: d | {"written_by": "a later step"})
        assert covers(richer, value) is False
    assert covers(value, richer)


@settings(max_examples=200, deadline=None)
@given(JSON, st.data())
def test_lists_are_neither_cut_nor_extended(value, data):
    lists = [at for at in places(value) if isinstance(edited_at(value, at), list)]
    if lists:
        longer = edited(value, data.draw(st.sampled_from(lists)), lambda items: [*items, {}])
        assert not covers(longer, value) and not covers(value, longer)


@settings(max_examples=200, deadline=None)
@given(JSON, st.data())
def test_a_changed_leaf_is_noticed(value, data):
    leaves = [at for at in places(value) if not isinstance(edited_at(value, at), (dict, list))]
    if leaves:
        other = edited(value, data.draw(st.sampled_from(leaves)), lambda leaf: [leaf])
        assert not covers(other, value) and not covers(value, other)


def edited_at(value, at):
    for key in at:
        value = value[key]
    return value


SCREEN = {"sample": "100k", "round": {"top": 500, "random": 500, "seed": None}, "source_files": [{"path": "H12.smi.gz", "fingerprint": {"size": 81}}, {"path": "H13.smi.gz"}]}


def test_a_screen_with_some_of_its_entries_left_out():
    files = SCREEN["source_files"]
    assert covers({}, SCREEN) and covers({"round": {}}, SCREEN) and covers({"round": {"seed": None}}, SCREEN)
    assert covers({"source_files": [{"fingerprint": {"size": 81}}, {}]}, SCREEN)
    for wrong in ({"round": {"salt": None}}, {"round": None}, {"source_files": files[::-1]}, {"source_files": files[:1]}, {"sample": 100}, {"source_files": [{"fingerprint": {"size": 82}}, {}]}):
        assert not covers(wrong, SCREEN), wrong


def test_the_file(tmp_path):
    where = tmp_path / "screens" / "one" / "manifest.json"
    with pytest.raises(FileNotFoundError):
        Manifest(where).load()
    assert not Manifest(where).exists() and not Manifest(where).complete({})
    Manifest(where, SCREEN).save()
    assert json.loads(where.read_text()) == SCREEN and [p.name for p in where.parent.iterdir()] == [where.name]
    assert Manifest(where).load() == Manifest(where, dict(reversed(SCREEN.items()))) == SCREEN
    Manifest(where).load().update({"round": {}})
    assert Manifest(where).complete({"sample": "100k"}) and not Manifest(where).complete({"round": SCREEN["round"]})
    where.write_text(where.read_text()[:-5])
    assert not Manifest(where).complete({})
