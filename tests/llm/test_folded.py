"""Copies in other spelling, against canonical strings."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftmill.llm import folded
from siftmill.llm.folded import NOTATION, PLAIN, STRUCTURE, folded_copies, folded_records, raw_bytes, rolling_hashes, same_folded

SCHEMA = "row_no long, smiles string, id string, k1 int, structure string, copies string"
ID = "LYQ0123456789ABCDEF"


def canonical(text, extra=""):
    return "".join(c.lower() for c in text if (c.isascii() and c.isalnum()) or c in extra)


def found(spark, *rows):
    frame = spark.createDataFrame([(n, s, i, 1, "x", "y") for n, s, i in rows], SCHEMA)
    return sorted(tuple(r) for r in folded_copies(frame).where("row_no <> first_row_no").collect())


def test_spellings(spark):
    rows = [
        (5, "C(=O)N", ID),
        (7, " c(=o)​n;", "lyq-0123 4567_89ab|cdef"),
        (3, ID.lower(), "'C(=O)N'"),  # the other way round
        (8, "C(O)N", ID),  # notation counts
        (9, "C(=O)N", ID[:-1] + "0"),
        (10, None, ID), (11, None, ID), (12, "", ID), (13, "«»", ID), (14, "C", None), (15, "C", "--"), (16, "C", "--"),
        (17, "é", "é"), (18, "é", "é"),  # letters beyond ASCII don't count
    ]
    assert found(spark, *rows) == [(3, 5), (3, 7)]
    assert [tuple(r) for r in folded_records(folded_copies(spark.createDataFrame([(n, s, i, 1, "", "") for n, s, i in rows], SCHEMA))).collect()] == [(3, 3)]


def test_empty_long_and_hot(spark):
    assert found(spark) == []
    long = "C" * 200_000
    assert found(spark, (1, long, ID), (2, long.lower() + " ", ID), (3, long + "N", ID)) == [(1, 2)]
    assert len(found(spark, *[(n, "CC" + " " * (n % 5), ID) for n in range(500)])) == 499


def test_colliding_rows_are_told_apart(spark, monkeypatch):
    """With hashes that all collide, classes are still those of the canonical text."""
    monkeypatch.setattr(folded, "_keyed", _all_alike)
    rows = [(1, "CC", ID), (2, "NN", ID), (3, "cc", ID), (4, "n n", ID), (5, "O", ID)]
    assert found(spark, *rows) == [(1, 3), (2, 4)]


def _all_alike(prefix, length):
    def run(batches):
        for b in batches:
            zero = pa.array(np.zeros(len(b), np.int64))
            yield pa.RecordBatch.from_arrays([b.columns[0], zero, zero, *b.columns[1:]], names=["row_no", "k1", "k2", "structure", "name"])

    return run


def test_random_rows_against_brute_force(spark):
    random.seed(3)
    base = [("".join(random.choice("CNO=()#") for _ in range(6)), "LYQ" + "".join(random.choice("01A") for _ in range(16))) for _ in range(12)]

    def dirty(text):
        return "".join(random.choice([c, c.lower()]) + random.choice(["", "", " ", "　", ";", "“"]) for c in text)

    rows = []
    for n in range(400):
        s, i = map(dirty, random.choice(base))
        rows.append((n, i, s) if random.random() < 0.2 else (n, s, i))
    random.shuffle(rows)
    classes = {}
    for n, s, i in rows:
        if re.fullmatch("lyq.{16}", canonical(s)) and not re.fullmatch("lyq.{16}", canonical(i)):
            s, i = i, s
        key = canonical(s, NOTATION), canonical(i)
        if all(key):
            classes.setdefault(key, []).append(n)
    assert found(spark, *rows) == sorted((min(c), n) for c in classes.values() for n in c if n != min(c))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("aA-(= é", max_size=8), st.text("aA-(= é", max_size=8)), max_size=6))
def test_bytes_agree_with_canonical_strings(pairs):
    left, right = pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string())
    for table, extra in ((PLAIN, ""), (STRUCTURE, NOTATION)):
        expected = [canonical(a, extra) == canonical(b, extra) for a, b in pairs]
        assert same_folded(left, right, table).tolist() == expected
        x, y = rolling_hashes(*raw_bytes(left), table), rolling_hashes(*raw_bytes(right), table)
        assert [(x[0][i], x[1][i]) == (y[0][i], y[1][i]) and x[2][i] == y[2][i] for i in range(len(pairs))] == expected


@pytest.mark.parametrize("end", ["", "x"])
def test_long_strings_are_compared_in_chunks(end):
    a, b = "aB" * 90_000, "A b" * 90_000
    assert same_folded(pa.array([a]), pa.array([b + end]), PLAIN).tolist() == [not end]
