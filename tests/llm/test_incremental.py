"""New batches against history, against a plain loop over rows."""

import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siftmill.llm import incremental
from siftmill.llm.incremental import History, named_files, one_apart, repeated_rows

SELECTIONS = "row_no long, batch_no int, path string, id string, smiles string, status string, key string, row long"
SPECS = "batch_no int, status string, output_path string, exclude_inputs array<string>, path string"


def distance(a, b):
    """Edit distance with swaps of neighbours."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_one_apart(spark):
    """All pairs of short strings over two letters, and others drawn from three."""
    short = ["".join(t) for n in range(5) for t in itertools.product("ab", repeat=n)]
    chance = random.Random(5)
    pairs = [*itertools.product(short, short), *(("".join(chance.choices("ab1", k=chance.randrange(7))), "".join(chance.choices("ab1", k=chance.randrange(7)))) for _ in range(2000))]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for a, b, one in frame.select("a", "b", one_apart(F.col("a"), F.col("b"))).collect():
        assert one is (distance(a, b) == 1), (a, b)


def plain(text):
    return re.sub("[^0-9A-Za-z]", "", text).lower()


def names(entry, path):
    entry = (entry or "").strip()
    if not entry:
        return False
    if "*" in entry or "?" in entry:
        return re.fullmatch("".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in entry), path) is not None
    return path == entry or path.rpartition("/")[0] == entry.rstrip("/")


def brute(selections, specs):
    accepted, new, found = [], [], set()
    for row, batch, path, name in selections:
        if name is not None and batch in specs:
            status, _ = specs[batch]
            (accepted if status == "accepted" else new if status == "new" else []).append((row, batch, path, plain(name)))
    for row, batch, path, name in sorted(new, key=lambda r: (r[1], r[0])):
        hits = [r for r, b, p, n in accepted if (any(names(e, p) for e in specs[batch][1]) or (b == batch and r < row)) and distance(name, n) <= 1]
        if hits:
            found.add((min(hits), row))
        else:
            accepted.append((row, batch, path, name))
    return found


def got(spark, selections, specs):
    rows = spark.createDataFrame([(*r, None, "x", "x", 0) for r in selections], SELECTIONS)
    listed = spark.createDataFrame([(b, s, "o", e, "x") for b, (s, e) in specs.items()], SPECS)
    return sorted(tuple(r) for r in repeated_rows(rows, listed).collect())


def test_by_hand(spark):
    specs = {1: ("accepted", None), 2: ("new", [" d/a/ ", None, ""]), 3: ("new", ["d/b/f?", "nowhere"]), 4: ("failed", ["d/a"])}
    rows = [
        (10, 1, "d/a/f1", "LYQ-AAA1"), (11, 1, "d/c/f1", "LYQCCC1"), (12, 1, "d/a/f1", None), (13, 1, "d/a/e", "--"),
        (20, 2, "d/b/f1", "lyq aaa1"),  # equal
        (21, 2, "d/b/f1", "LYQAA1A"),  # two swapped
        (22, 2, "d/b/f1", "LYQCCC1"),  # history that isn't named
        (23, 2, "d/b/f1", "LYQCC1"),  # of the same batch, one missing
        (24, 2, "d/b/f1", None), (25, 2, "d/b/f1", "?"),
        (30, 3, "d/b/g", "LYQCCC12"),  # an accepted row of batch 2
        (31, 3, "d/b/g", "LYQCC1"),  # a repeat itself, so it isn't accepted, but 22 is
        (9, 3, "d/b/g", "LYQAAA1"), (40, 4, "d/a/f1", "LYQAAA1"), (41, 5, "d/a/f1", "LYQAAA1"),
    ]
    assert got(spark, rows, specs) == [(10, 20), (10, 21), (13, 25), (22, 23), (22, 30), (22, 31)]
    assert got(spark, [], specs) == [] == got(spark, rows, {})


@pytest.mark.parametrize(("seed", "window", "at_once"), [(1, 200, 10**6), (2, 2, 40), (3, 2, 3)])
def test_random_rows(spark, monkeypatch, seed, window, at_once):
    """Ids over few letters, so that chains of near ones are long, keys are crowded and parts of links large."""
    monkeypatch.setattr(incremental, "WINDOW", window)
    monkeypatch.setattr(incremental, "AT_ONCE", at_once)
    chance = random.Random(seed)
    specs = {b: ("accepted" if b < 4 else "new", [chance.choice(["s/*/f?", "s/3", "s/4/", f"s/{b - 1}/f1", "s/?/f*", " s/5/f2 ", "s/9"]) for _ in range(2)]) for b in range(1, 8)}
    rows = []
    for n in chance.sample(range(1000), 260):
        b = chance.randrange(1, 8)
        name = "".join(chance.choice("ab") for _ in range(chance.choice([0, 1, 2, 7, 8, 8, 9])))
        rows.append((n, b, f"s/{b}/f{chance.randrange(3)}", chance.choice([name, name.upper(), f" {name}!", None]) if n % 9 == 0 else name))
    assert got(spark, rows, specs) == sorted(brute(rows, specs))


def test_an_id_with_very_many_rows(spark):
    specs = {1: ("accepted", []), 2: ("new", ["d"])}
    rows = [(n, 1 + n % 2, "d/f", "X" * (3 + n % 3)) for n in range(3000)]
    expected = defaultdict(int)
    for low, _ in got(spark, rows, specs):
        expected[low] += 1
    assert sum(expected.values()) == 1500 and set(expected) <= {0, 2, 4}
    long = "a" * 3000
    assert got(spark, [(1, 1, "d/f", long), (2, 2, "d/f", long[1:]), (3, 2, "d/f", long + "bb")], specs) == [(1, 2)]


def test_files(spark):
    specs = spark.createDataFrame([(1, "new", "", ["a/b", "a/b/", "a.b/x+(1)?", "*", "a/*/c", "", None, "  "], ""), (2, "new", "", None, "")], SPECS)
    paths = ["a/b", "a/b/c", "a/b/c/d", "a.b/x+(1)z", "aXb/x+(1)z", "top", "a/b/", None, "a/bb/c"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    expected = {p for p in paths if p and any(names(e, p) for e in ["a/b", "a/b/", "a.b/x+(1)?", "*", "a/*/c"])}
    assert {r.path for r in named_files(specs, frame).collect()} == expected


def chain(length):
    """Ids each of which is one edit from the next alone."""
    return ["b" * n + "a" * (length - n) for n in range(length)]


class Jobs:
    """Jobs of a session while it is open."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.spark.sparkContext.setJobGroup("counted", "")
        self.before = len(self.spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        return self

    def __exit__(self, *_):
        self.n = len(self.spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - self.before
        self.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_chains(spark):
    counted = []
    for length in (6, 300):
        rows = [(n, 2, "d/f", name) for n, name in enumerate(chain(length))]
        with Jobs(spark) as jobs:
            found = got(spark, rows, {2: ("new", [])})
        assert found == [(n - 1, n) for n in range(1, length, 2)]
        counted.append(jobs.n)
    assert counted[1] <= counted[0] + 6


def test_connected_parts_of_a_long_chain(spark):
    links = [(n, n + 1) for n in range(200)] + [(500 - n, 501 - n) for n in range(100)] + [(900, 901), (901, 900)]
    found = incremental._parts(spark.createDataFrame(links, "row long, there long"))
    assert {r.node: r.part for r in found.collect()} == {n: 0 for n in range(201)} | {n: 401 for n in range(401, 502)} | {900: 900, 901: 900}


def frames(spark, rows, specs):
    return spark.createDataFrame([(*r, None, "x", "x", 0) for r in rows], SELECTIONS), spark.createDataFrame([(b, s, "o", e, "x") for b, (s, e) in specs.items()], SPECS)


def test_history_of_earlier_calls(spark, tmp_path):
    """With a kept history a later call needs the new batch alone and gives what it would with all rows."""
    specs = {1: ("accepted", []), 2: ("new", ["a"]), 3: ("new", ["a", "b"])}
    rows = [(1, 1, "a/f", "AAAA"), (2, 2, "b/f", "AAAB"), (3, 2, "b/f", "CCCC"), (4, 3, "c/f", "CCC"), (5, 3, "c/f", "DDDD"), (6, 3, "c/f", "AAAAB")]

    def call(rows, specs, root):
        return sorted(tuple(r) for r in repeated_rows(*frames(spark, rows, specs), root).collect())

    root = f"file://{tmp_path}"
    assert call(rows[:3], {k: specs[k] for k in (1, 2)}, root) == [(1, 2)]
    later = {1: specs[1], 2: ("accepted", []), 3: specs[3]}
    everything = call(rows, later, None)
    assert everything == [(1, 6), (3, 4)] == call([r for r in rows if r[1] != 1], {k: later[k] for k in (2, 3)}, root)
    before = History(spark, root).journal.state()
    assert call(rows, later, root) == everything  # batches that it holds are skipped
    assert History(spark, root).journal.state().runs == before.runs
    late = [*rows, (7, 1, "a/g", "DDDDD")]  # a late row of an old batch
    assert call(late, later, root) == [(1, 6), (3, 4), (7, 5)] == call(late, later, None)


def test_runs_are_merged_and_read_by_range(spark, tmp_path):
    """What a small batch opens of the history stays the same while the history grows."""
    opened = []
    for n in (1, 4):
        history = History(spark, f"file://{tmp_path}/{n}", unit=2000, fanout=2, top=0)
        chance = random.Random(n)
        for batch in range(n):
            ids = ["".join(chance.choices("abcdefghij0123456789", k=19)) for _ in range(1500)]
            history.accept(spark.createDataFrame([(batch, 10_000 * batch + i, "p", x) for i, x in enumerate(ids)], "batch_no int, row_no long, path string, id string"))
        state = history.journal.state()
        assert len(state.of("keys")) <= 2 and sum(r.rows for r in state.of("keys")) == 4 * 2 * 1500 * n / 2 and sum(r.rows for r in state.of("places")) == 1500 * n
        new = spark.createDataFrame([("x" + ids[7][1:],)], "id string")
        assert [tuple(r) for r in history.matches(new, 1).collect()] == [("x" + ids[7][1:], ids[7])]
        near = history.keys.around(state, incremental._keys(new), 4)
        opened.append(len(near.inputFiles()))
        assert opened[-1] <= 4 * len(state.of("keys")) < sum(r.files for r in state.of("keys")) / 4
    assert opened[1] <= opened[0] + 4
