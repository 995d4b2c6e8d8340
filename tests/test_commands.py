"""External programs and models, task lists, documents, logs."""

import json
import logging
import sys

import numpy as np
import pytest

from siftmill.functions.commands import CommandDocking, box_arguments, detected, parsed_poses, scored_by
from siftmill.functions.providers import ProviderNotAvailable, docked
from siftmill.plans.tasks import clean_prefix, logged, require_distinct, write_plan, write_sites
from siftmill.sources.pockets import read_sites

PROGRAM = """
import pathlib, sys
out, *files = sys.argv[1:]
for f in map(pathlib.Path, files):
    text = f.read_text()
    if "crash" in text:
        sys.exit(3)
    if "none" not in text:
        (pathlib.Path(out) / f"{f.stem}_out.pdbqt").write_text(f"MODEL 1\\nREMARK VINA RESULT: -{len(text)}.5 0 0\\nENDMDL\\nMODEL 2\\nREMARK VINA RESULT: -1 2 3\\n")
"""


def test_poses_of_a_text():
    assert [p[:4] for p in parsed_poses("REMARK VINA RESULT: -5 0 0\nMODEL 1\r\nREMARK VINA RESULT: -4 1 2")] == [(1, -5.0, 0.0, 0.0), (1, -4.0, 1.0, 2.0)]
    assert parsed_poses("") == []


def test_docking_by_a_program(spark, tmp_path):
    script = tmp_path / "dock.py"
    script.write_text(PROGRAM)
    provider = CommandDocking(sys.executable, lambda files, out, s=str(script): [s, str(out), *map(str, files)])
    ligands = spark.createDataFrame([("a", "CC"), ("b", "CCC"), ("c", "none"), ("d", "crash"), ("e", None)], "id string, conformer string")
    found = sorted((r.id, r.status, r.mode, r.affinity_kcal_mol) for r in docked(ligands.coalesce(1), provider, "M", "M:1").collect() if r.mode != 2)
    assert found == [("a", "docked", 1, -2.5), ("b", "docked", 1, -3.5), ("c", "missing", None, None), ("d", "quarantined", None, None), ("e", "skipped", None, None)]
    with pytest.raises(ProviderNotAvailable):
        docked(ligands, CommandDocking("no-such-program", lambda f, o: []), "M", "M:1")
    assert box_arguments((0, 1, 2), (10, 30, 25))[-6:] == ["--size_x", "25.000", "--size_y", "30.000", "--size_z", "25.000"]


def test_detection(spark):
    rows = spark.createDataFrame([("m", "2"), ("n", "0")], "member_id string, content string")
    found = detected(rows, lambda member, content: [{"rank": i, "score": 1.5} for i in range(int(content))], "rank int, score double")
    assert sorted((r.member_id, r["rank"], r.score) for r in found.collect()) == [("m", 0, 1.5), ("m", 1, 1.5)]
    with pytest.raises(Exception, match="ValueError"):
        detected(rows.selectExpr("member_id", "'x' as content"), lambda m, c: [{"rank": int(c), "score": 0.0}], "rank int, score double").collect()


class Half:
    def predict_proba(self, x):
        return np.stack([1 - x[:, 0], x[:, 0]], 1)


def test_external_model(spark):
    rows = spark.createDataFrame([(1, [0.25, 1.0]), (2, [float("nan"), 1.0]), (3, None)], "n int, f array<float>")
    assert {r.n: r.score for r in scored_by(rows, Half(), ["f"]).collect()} == {1: 0.25, 2: None, 3: None}


def test_plan(tmp_path):
    (tmp_path / "in/d").mkdir(parents=True)
    for name, size in (("a", 4), ("b", 4), ("c", 4), ("d/big", 30)):
        (tmp_path / "in" / name).write_text("x" * size)
    assert write_plan(tmp_path / "in", "**/*", tmp_path / "p.json", tmp_path / "f.json", 8) == [["a", "b"], ["c"], ["d/big"]]
    assert json.loads((tmp_path / "p.json").read_text())["batches"][0] == ["a", "b"] and len(json.loads((tmp_path / "f.json").read_text())["source_files"]) == 4


def test_site_document(spark, tmp_path):
    rows = spark.createDataFrame([("E", "M", "M:2", [1.0, 2.0, 3.0], None), ("E", "M", "M:1", [0.0, 0.0, 0.5], 2.5), ("F", "N", "N:1", None, None)], "ensemble_id string, member_id string, site_id string, center array<double>, pocket_score double")
    assert write_sites(rows, "E", tmp_path / "e.json") == 2
    assert "pocket_score" not in json.loads((tmp_path / "e.json").read_text())["binding_sites"][1]
    assert [r.site_id for r in read_sites(spark, str(tmp_path / "e.json"), "E").collect()] == ["M:1", "M:2"]
    with pytest.raises(ValueError):
        write_sites(rows, "G", tmp_path / "g.json")


def test_cleaning(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    for wrong in ("", "/", "..", "a/../.."):
        with pytest.raises(ValueError):
            clean_prefix(spark, f"file://{tmp_path}", wrong)
    clean_prefix(spark, f"file://{tmp_path}", "a/b/")
    assert (tmp_path / "a").is_dir() and not (tmp_path / "a/b").exists()


def test_log_lines(caplog):
    @logged
    def half(x):
        return 1 / x

    with caplog.at_level(logging.INFO, "siftmill"):
        assert half(2) == 0.5
        with pytest.raises(ZeroDivisionError):
            half(0)
    assert [json.loads(r.message)["status"] for r in caplog.records] == ["ok", "error"]
    with pytest.raises(ValueError):
        require_distinct(["a", "a"], "names")
