"""Manifests, configuration, retries, providers, the loop, the intake stream."""

import errno

import pytest
from pyspark.sql import functions as F

from siftmill.functions.features import FEATURES
from siftmill.functions.providers import (
    FeatureProvider, FingerprintFeature, HashedDocking, HashedFeature, ProviderNotAvailable, docked, featurized, stand_in_conformer, with_conformers,
)
from siftmill.operators.surrogate import Settings
from siftmill.plans.active import run_rounds
from siftmill.plans.config import ConfigError, Round, screen_of
from siftmill.plans.layout import Layout, labels_up_to
from siftmill.plans.manifest import changed, described, run_once
from siftmill.plans.retry import retried
from siftmill.plans.thresholds import kept_threshold
from siftmill.queries import QUERIES
from siftmill.sources.structures import download
from siftmill.streaming.intake import take_in

def test_steps_run_once(tmp_path):
    ran = []

    def step():
        ran.append(1)
        (tmp_path / "out").write_text("x")
        return {"rows": 1}

    for expected in (True, False):
        assert run_once(tmp_path / "m", {"n": 1}, (tmp_path / "out").exists, step) is expected
    assert run_once(tmp_path / "m", {"n": 2}, (tmp_path / "out").exists, step) and len(ran) == 2


def test_changed_files(tmp_path):
    for n in ("a", "b", "c"):
        (tmp_path / n).write_text("1")
    entries = described(sorted(tmp_path.iterdir()), tmp_path, hashed=True)
    (tmp_path / "a").write_text("2")
    (tmp_path / "b").unlink()
    assert changed(entries, tmp_path) == ["a", "b"]


def screen(**surrogate):
    return {
        "x-note": 1, "name": " s ", "candidates": "1m",
        "targets": {"min_pocket_score": 1, "ensembles": [{"id": "e", "members": [{"pdb_id": "1abc", "weight": 0.25}, {"pdb_id": "2abc", "weight": 0.75}]}]},
        "filter": {"surrogate": {"feature_types": ["ecfp"], "validation": 10, "rounds": [{"top": 0, "random": 5}, {"top": 2, "random": 3}], "random_seed": 1, "active_percentile": 1} | surrogate},
    }


def test_screen():
    good = screen_of(screen())
    assert good.samples == 20 and good.name == "s"
    good.require_fits({"ecfp", "rdf"}, 20)
    for features, size in ((set(), 20), ({"ecfp"}, 19)):
        with pytest.raises(ConfigError):
            good.require_fits(features, size)
    for wrong in ({"rounds": [{"top": 1, "random": 5}]}, {"feature_types": ["cns_mpo"]}, {"active_percentile": 0}, {"validation": 0}, {"rounds": []}, {"other": 1}):
        with pytest.raises(ConfigError):
            screen_of(screen(**wrong))
    heavy = screen()
    heavy["targets"]["ensembles"][0]["members"][0]["weight"] = 0.3
    with pytest.raises(ConfigError, match="sum to 1"):
        screen_of(heavy)
    twice = screen()
    twice["targets"]["ensembles"] *= 2
    with pytest.raises(ConfigError, match="unique"):
        screen_of(twice)


def test_layout():
    layout = Layout("/data/", "s")
    assert layout.results("e", "m:1", "round_0").endswith("screens/s/filter/surrogate/ensembles/e/m:1/round_0/docking.results.parquet")
    assert layout.shards("1m", "raw") == "/data/candidates/samples/1m/raw/shards" and labels_up_to(1) == ["round_0", "round_1"]
    with pytest.raises(ValueError):
        layout.sample("1m", "cooked")


def test_retries():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError(errno.EIO, "io")
        return 7

    assert retried(flaky, sleep=waits.append) == 7 and waits == [2.0, 4.0]
    with pytest.raises(PermissionError):
        retried(lambda: (_ for _ in ()).throw(PermissionError(errno.EACCES, "no")), sleep=waits.append)
    with pytest.raises(RuntimeError):
        retried(lambda: (_ for _ in ()).throw(FileNotFoundError()), attempts=2, sleep=waits.append)


def test_download(tmp_path):
    def get(url):
        if "1ABC.cif" in url:
            return b"cif"
        if "2ABC.pdb" in url:
            return b"pdb"
        raise OSError("down")

    waits = []
    found = download([" 1abc ", "2abc", "", "1ABC"], tmp_path, "http://x/", get, waits.append)
    assert [p.name for p in found.values()] == ["1ABC.cif", "2ABC.pdb"]
    with pytest.raises(RuntimeError, match="3ABC, 4ABC"):
        download(["3abc", "4abc", "1abc"], tmp_path, "http://x", get, waits.append)


def test_kept_threshold(spark, tmp_path):
    rows = spark.createDataFrame([(-1.0,), (-2.0,), (3.0,)], "affinity_kcal_mol double")
    assert kept_threshold(rows, tmp_path / "t", 1, {"size": 1}) == -2.0
    assert kept_threshold(rows.limit(0), tmp_path / "t", 1, {"size": 1}) == -2.0  # not taken again
    assert kept_threshold(rows, tmp_path / "t", 100, {"size": 1}) == -1.0
    with pytest.raises(ValueError):
        kept_threshold(rows.limit(0), tmp_path / "t", 1, {"size": 2})


class Picky(FeatureProvider):
    name = "cns_mpo"

    def vectors(self, structures):
        if "bad" in structures:
            raise RuntimeError("bad")
        return [None if s == "none" else [1.0] * (4 if s == "short" else 5) for s in structures]


def test_featurized(spark):
    rows = spark.createDataFrame([(1, "C", "x"), (2, "bad", "x"), (3, "", "x"), (4, None, "x"), (5, "none", "x"), (6, "short", "x")], "n int, conformer string, smiles string")
    made = featurized(rows, [Picky(), HashedFeature("functional_groups")])
    assert "smiles" not in made.columns and "conformer" not in made.columns
    found = {r.n: r for r in made.collect()}
    assert [n for n in sorted(found) if found[n].cns_mpo_valid] == [1]
    assert [n for n in sorted(found) if found[n].functional_groups_valid] == [1, 2, 5, 6]
    assert all(len(r.functional_groups) == FEATURES["functional_groups"].width for r in found.values())
    assert found[3].cns_mpo[0] != found[3].cns_mpo[0]
    assert featurized(rows.limit(0), [Picky()]).count() == 0
    with pytest.raises(ProviderNotAvailable):
        featurized(rows, [FingerprintFeature("ecfp", "ECFPFingerprint")])


def test_conformers_and_docking(spark):
    rows = spark.createDataFrame([("a", "CC"), ("b", ""), ("c", None), ("d", "12"), ("e", "N!")], "id string, smiles string")
    made = with_conformers(rows, lambda s: 1 / 0 if "!" in s else stand_in_conformer(s))
    assert {r.id: bool(r.conformer) for r in made.collect()} == {"a": True, "b": False, "c": False, "d": False, "e": False}
    ligands = spark.createDataFrame([(f"l{i}", "C" if i % 10 else "bad") for i in range(50)] + [("s", "")], "id string, conformer string")
    found = docked(ligands, HashedDocking(2, "bad"), "M", "M:1")
    assert {(r.status, r.n) for r in found.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()} == {("docked", 90), ("quarantined", 5), ("skipped", 1)}


def test_rounds(spark):
    rows = spark.range(300).select(F.format_string("m%03d", "id").alias("id"), (F.col("id") % 2).cast("int").alias("shard_id"), F.array((F.col("id") % 17).cast("float"), (F.col("id") % 5).cast("float")).alias("f"), F.lit(True).alias("f_valid"))

    def dock(picked):
        return picked.select("id", F.lit(1).alias("mode"), (-5 - F.col("f")[0] / 4).cast("double").alias("affinity_kcal_mol"))

    out = run_rounds(rows, dock, [Round(0, 15), Round(5, 5), Round(5, 5)], 15, 20, ["f"], settings=Settings(trees=3, depth=2, leaf=1))
    assert {k: v.count() for k, v in out.selections.items()} == {"validation": 30, "round_0": 30, "round_1": 20, "round_2": 20}
    every = out.selections["validation"].select("id")
    for k in ("round_0", "round_1", "round_2"):
        every = every.union(out.selections[k].select("id"))
    assert every.distinct().count() == 100  # nothing is picked twice, validation included
    assert set(out.metrics) == {"round_0", "round_1", "round_2"} and out.threshold < -5
    with pytest.raises(ValueError):
        run_rounds(rows, dock, [Round(1, 1)], 5, 20, ["f"])


def test_intake_takes_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.smi").write_text("C a\nN b\n\nbroken\n")
    for text in (None, "O c\n", None):
        if text:
            (tmp_path / "in/b.smi").write_text(text)
        take_in(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "done"), 4).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("name,module", [("surrogate_scores", "siftmill.queries"), ("active_rounds", "siftmill.plans.active")])
def test_queries_train_with_the_operators_settings(spark, folder, monkeypatch, name, module):
    """The registered queries train as large a model as the operator does by itself."""

    class Seen(Exception):
        pass

    def train(rows, settings=Settings()):
        raise Seen(settings)

    monkeypatch.setattr(f"{module}.trained", train)
    with pytest.raises(Seen) as seen:
        QUERIES[name](spark, folder)
    assert seen.value.args[0] == Settings() and (Settings().trees, Settings().depth) == (100, 5)
