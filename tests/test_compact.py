"""The store of pose records: nothing lost, nothing twice, whatever dies in between."""

import pytest

from siftmill.operators import runs
from siftmill.operators.compact import pack_pose_files, pose_store
from siftmill.operators.runs import Change, Run, State

SCHEMA = "path string, id string, member_id string, site_id string, content string, mode int, text string"


def block(mode, affinity, end="\n"):
    return end.join([f"MODEL {mode}", f"REMARK VINA RESULT:   {affinity}  0.0  0.0", "ATOM      1  C", "ENDMDL", ""])


def files(spark, *rows):
    return spark.createDataFrame([(p, i, "M", "M:1", c, 7, "clash") for p, i, c in rows], SCHEMA)


def keys(store):
    return sorted((r.id, r.mode, r.affinity_kcal_mol) for r in store.read().collect())


def test_records_once_from_untidy_files(spark, tmp_path):
    store = pose_store(spark, f"file://{tmp_path}/s")
    two = block(1, -7.5) + block(2, -7.1)
    pack_pose_files(
        store,
        files(
            spark,
            ("a", "A", two),
            ("a", "A", two),  # listed twice
            ("a.1", "A", two.replace("\n", "\r\n")),  # other line ends are no other text
            ("a.2", "A", block(1, -7.5)),  # a part of another file
            ("b", "B", "REMARK VINA RESULT: -5.5 0.0 0.0\nATOM"),  # no MODEL line: mode 1
            ("c", "C", None),
            ("d", "D", ""),
            ("e", "E", "MODEL 1\nREMARK VINA RES"),  # broken off
            ("f", None, block(1, -3.0)),
            (None, "G", "x" * 100_000 + "\n" + block(4, -9.25)),
        ),
    )
    found = store.read()
    assert sorted((r.id or "-", r.mode, r.affinity_kcal_mol) for r in found.collect()) == [
        ("-", 1, -3.0), ("A", 1, -7.5), ("A", 2, -7.1), ("B", 1, -5.5), ("G", 1, -9.25)
    ]
    assert {r.text for r in found.where("id = 'A' and mode = 1").collect()} == {block(1, -7.5)}


def test_copies_with_other_text_stay(spark, tmp_path):
    store = pose_store(spark, f"file://{tmp_path}/s")
    pack_pose_files(store, files(spark, ("a", "A", block(1, -7.5)), ("b", "A", block(1, -7.5).replace("C", "N"))))
    assert keys(store) == [("A", 1, -7.5)] * 2


def one_of(n):
    return (f"{n}", f"L{n:03}", block(1, -5.0 - n / 1000))


def test_added_twice(spark, tmp_path):
    store, rows = pose_store(spark, f"file://{tmp_path}/s"), files(spark, one_of(1), one_of(2))
    assert pack_pose_files(store, rows)[0].rows == 2
    before = store.journal.state()
    assert pack_pose_files(store, rows) == [] and store.journal.state().runs == before.runs
    assert keys(store) == [("L001", 1, -5.001), ("L002", 1, -5.002)]
    # The same records in other files are taken in as files, not as records.
    assert pack_pose_files(store, files(spark, ("other", *one_of(1)[1:])))[0].rows == 0
    assert len(keys(store)) == 2
    # All files of an addition are seen as taken in, some of a larger one are.
    assert pack_pose_files(store, files(spark, one_of(2), one_of(3)))[0].rows == 1


def test_many_small_additions_leave_few_files(spark, tmp_path):
    """Files below a unit are merged as soon as there are two, full tiers into the next, and each file has its tier's size."""
    store = pose_store(spark, f"file://{tmp_path}/s", unit=400, fanout=3, top=2)
    for n in range(40):
        pack_pose_files(store, files(spark, one_of(n)))
        live = store.journal.state().of("records")
        tiers = [store.records.tier(r.size) for r in live]
        assert sum(r.size < 400 for r in live) <= 1 and all(tiers.count(t) <= 3 for t in tiers)
    assert sum(r.rows for r in live) == 40 and len(keys(store)) == 40
    assert max(tiers) >= 2 and all(r.size / r.files >= 400 * 3 ** min(t, 2) * 0.5 for r, t in zip(live, tiers, strict=True) if r.size >= 400)
    assert len(store.journal.state().of("inputs")) < 12


def test_parts_are_transactions_of_their_own(spark, tmp_path):
    store = pose_store(spark, f"file://{tmp_path}/s", unit=500, fanout=2, top=0)
    made = pack_pose_files(store, files(spark, *map(one_of, range(60)), *(("x", *one_of(n)[1:]) for n in range(9))), parts=4)
    assert [r.kind for r in made].count("records") >= 5 and len(keys(store)) == 60
    assert sum(r.slots > 1 for r in made)


def test_slots_that_hold_no_new_hash_are_not_read(spark, tmp_path):
    store = pose_store(spark, f"file://{tmp_path}/s", unit=200, fanout=8, top=0)
    pack_pose_files(store, files(spark, *map(one_of, range(200))))
    state = store.journal.state()
    run = state.of("records")[0]
    assert run.slots >= 64 and run.files == run.slots - len(run.empty)
    some = store.records.read(state, [0, 5], 4)
    assert 0 < len(some.inputFiles()) < run.files / 4
    expected = {r.id for r in store.read().withColumn("p", runs.slot_of(store.records.hash, 16)).where("p in (0, 5)").collect()}
    assert {r.id for r in some.collect()} == expected
    assert pack_pose_files(store, files(spark, ("again", *one_of(7)[1:]), one_of(300)))[0].rows == 1


@pytest.mark.parametrize("dies", ["write", "commit", "vacuum"])
def test_a_step_that_dies_is_done_again(spark, tmp_path, monkeypatch, dies):
    root, rows = f"file://{tmp_path}/s", files(spark, one_of(1), one_of(2))
    pack_pose_files(pose_store(spark, root), files(spark, one_of(0)))
    owner = runs.Table if dies == "write" else runs.Journal
    whole = getattr(owner, dies)

    def die(self, *args):
        if dies == "write":
            whole(self, *args)
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(owner, dies, die)
        pack_pose_files(pose_store(spark, root), rows)
    assert len(keys(pose_store(spark, root))) == (3 if dies == "vacuum" else 1)
    pack_pose_files(pose_store(spark, root), rows)
    assert [k[0] for k in keys(pose_store(spark, root))] == ["L000", "L001", "L002"]
    store = pose_store(spark, root, retention=0.0)
    store.vacuum()
    there = {p.name for p in (tmp_path / "s/data").iterdir()}
    assert there == {r.name for r in store.journal.state().runs} and len(keys(store)) == 3


def test_two_writers(spark, tmp_path, monkeypatch):
    """While one prepares its step the other commits the same records: the first looks again and adds none of them."""
    root = f"file://{tmp_path}/s"
    one, two = pose_store(spark, root), pose_store(spark, root)
    write, raced = runs.Table.write, []

    def slow(self, *args):
        run = write(self, *args)
        if not raced and self.kind == "records":
            raced.append(1)
            pack_pose_files(two, files(spark, ("other", *one_of(1)[1:]), one_of(5)))
        return run

    monkeypatch.setattr(runs.Table, "write", slow)
    pack_pose_files(one, files(spark, one_of(1), one_of(2)))
    assert [k[0] for k in keys(one)] == ["L001", "L002", "L005"]


def test_a_version_is_committed_once(spark, tmp_path):
    journal = pose_store(spark, f"file://{tmp_path}/s").journal
    state = State(1, (Run("a", "records", 1, (), 1, 5, 9),))
    assert journal.commit(state) and not journal.commit(State(1))
    assert journal.state().runs == state.runs
    assert journal.transact(lambda s: Change("merge", [Run("b", "records", 1, (), 1, 5, 9)], ["a"])).step == "merge"
    assert [r.name for r in journal.state().runs] == ["b"] and list(journal.state().gone) == ["a"]
    # Somebody whose version was deleted since, as he slept, doesn't commit.
    assert not journal.commit(State(9)) and journal.state().version == 2
    journal.retention = 0.0
    for n in range(3, 7):
        assert journal.commit(State(n, journal.state().runs))
    journal.vacuum()
    assert journal._versions() == [6] and not any(journal.commit(State(n)) for n in (1, 2, 4, 6, 8))
    assert journal.state().version == 6


def test_readers_keep_their_files(spark, tmp_path):
    store = pose_store(spark, f"file://{tmp_path}/s")
    pack_pose_files(store, files(spark, one_of(1)))
    early = store.read()
    pack_pose_files(store, files(spark, one_of(2)))
    assert early.count() == 1 and store.read().count() == 2


def test_empty_table(spark, tmp_path):
    store = pose_store(spark, f"file://{tmp_path}/s")
    assert pack_pose_files(store, files(spark).limit(0)) == [] and store.read().count() == 0
    for wrong in ({"fanout": 1}, {"unit": 0}, {"top": -1}):
        with pytest.raises(ValueError):
            pose_store(spark, f"file://{tmp_path}/t", **wrong)
    with pytest.raises(ValueError):
        pack_pose_files(store, files(spark), parts=0)
