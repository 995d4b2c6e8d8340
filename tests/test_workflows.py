"""The steps put together: what runs, what doesn't run again, and what goes on after it died."""

import errno
import gzip
import json

import pytest
from pyspark.sql import functions as F

from siftmill.functions import chemistry, scores
from siftmill.functions.features import FEATURES, all_valid
from siftmill.functions.providers import HashedFeature, ProviderNotAvailable, stand_in_conformer
from siftmill.operators import sampling, sharding
from siftmill.operators.surrogate import Settings, load_model, prepared, save_model, scored, trained
from siftmill.plans import workflows
from siftmill.plans.config import ConfigError, Round, Screen, candidates_of, checked
from siftmill.plans.files import LOCAL, HadoopFiles, LocalFiles
from siftmill.plans.layout import Layout
from siftmill.plans.manifest import Manifest, changed, described, found, gate
from siftmill.plans.retry import copied
from siftmill.plans.tasks import mark_success
from siftmill.plans.workflows import featurize, load_candidates, load_targets, plan_surrogate, preprocess, sample_candidates
from siftmill.runtime import shared_folder
from siftmill.sources.pockets import read_sites, structure_atoms
from siftmill.sources.tables import resolve
from siftmill.streaming.intake import candidate_runs, take_into_runs


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "library"
    folder.mkdir()
    for i in range(5):
        with gzip.open(folder / f"H{i:02}.smi.gz", "wt") as f:
            f.write("".join(f"{'C' * (n + 1)}\tZ{i}_{n}\n\n" for n in range(40)))
    return folder


def test_load_runs_once_and_again_if_its_sources_change(spark, tmp_path, source):
    root = f"file://{tmp_path}/pool"
    size = max(p.stat().st_size for p in source.iterdir())
    first = load_candidates(spark, f"file://{source}", root, shards=8, batch_bytes=2 * size)
    assert first == {"sharded": 3, "merged": True, "rows": 200}
    table = spark.read.parquet(f"{root}/shards")
    assert table.select("id").distinct().count() == 200 and set(table.columns) == {"smiles", "id", "shard_id"}
    assert table.where(F.col("shard_id") != sharding.shard_of("id", 8)).count() == 0
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "pool/shards").glob("shard_id=*"))
    assert not (tmp_path / "pool/staging").exists()
    assert load_candidates(spark, f"file://{source}", root, shards=8, batch_bytes=2 * size) == {"sharded": 0, "merged": False, "rows": 200}
    with gzip.open(source / "H99.smi.gz", "wt") as f:
        f.write("CC new\n")
    assert load_candidates(spark, f"file://{source}", root, shards=8)["rows"] == 201
    with pytest.raises(ValueError, match="outside"):
        load_candidates(spark, f"file://{source}", root, shards=4)
    with pytest.raises(FileNotFoundError):
        load_candidates(spark, f"file://{tmp_path}", root)


def test_load_goes_on_where_it_died(spark, tmp_path, source, monkeypatch):
    root, size = f"file://{tmp_path}/pool", max(p.stat().st_size for p in source.iterdir())
    write, calls = sharding.write_shards, []

    def dying(rows, path, *args):
        calls.append(path)
        if len(calls) == 3:
            raise OSError("lost")
        write(rows, path, *args)

    monkeypatch.setattr(workflows, "write_shards", dying)
    with pytest.raises(OSError):
        load_candidates(spark, f"file://{source}", root, shards=4, batch_bytes=2 * size)
    assert load_candidates(spark, f"file://{source}", root, shards=4, batch_bytes=2 * size) == {"sharded": 1, "merged": True, "rows": 200}
    assert spark.read.parquet(f"{root}/shards").count() == 200


def test_checks_of_a_layout(spark, tmp_path):
    final, staged = f"file://{tmp_path}/final", [f"file://{tmp_path}/a", f"file://{tmp_path}/b"]
    assert workflows.layout_problems(spark, "staging-complete", staged, final, 2)[0].startswith("staged batches are missing: 2")
    spark.range(9).select("id", (F.col("id") % 3).cast("int").alias("shard_id")).write.partitionBy("shard_id").parquet(final)
    assert workflows.layout_problems(spark, "final-in-range", [], final, 2) == ["final shards outside the expected ones: 1 (such as 2)"]
    assert workflows.layout_problems(spark, "final-in-range", [], final, 3) == [] == workflows.layout_problems(spark, "merge-complete", staged, final, 3)
    assert workflows.layout_problems(spark, "merge-complete", [final], final, 3)[0].startswith("staged batches are left")


def test_sample_to_features(spark, tmp_path, source):
    root = f"file://{tmp_path}/pool"
    load_candidates(spark, f"file://{source}", root, shards=4)
    layout, steps = Layout(f"file://{tmp_path}/data", "s"), []
    for total in (41, 41, 80):
        steps.append(
            (
                sample_candidates(spark, layout, f"{root}/shards", "few", total, number=4),
                preprocess(spark, layout, "few", stand_in_conformer, "stand-in"),
                featurize(spark, layout, "few", [HashedFeature("whim"), HashedFeature("usrcat")]),
            )
        )
    assert steps == [(True,) * 3, (False,) * 3, (True,) * 3]
    made = spark.read.parquet(layout.shards("few", "featurized"))
    assert made.groupBy("shard_id").count().where("count <> 20").count() == 0 and made.where(all_valid(made)).count() == 80
    assert "conformer" in spark.read.parquet(layout.shards("few", "preprocessed")).columns
    with pytest.raises(FileNotFoundError):
        preprocess(spark, layout, "none", stand_in_conformer, "stand-in")
    with pytest.raises(ProviderNotAvailable):
        featurize(spark, layout, "few", chemistry.feature_providers(["usrcat"]))


def test_targets(spark, tmp_path):
    atoms = spark.createDataFrame([("1ABC", 1, 0.0, 0.0, 3.0), ("1ABC", 2, 0.0, 4.0, 0.0)], "member_id string, serial int, x double, y double, z double")
    columns = "member_id string, rank string, center_x string, center_y string, center_z string, score string, probability string, surf_atom_ids string"
    pockets = spark.createDataFrame([("1ABC", "1", "0", "0", "0", "12.5", "0.9", "1 2 9"), ("1ABC", "2", "0", "0", "0", "3", "0.1", "1")], columns)
    layout = Layout(f"file://{tmp_path}", "s")
    assert [load_targets(spark, layout, "ens", pockets, atoms, "tool", 10.0, {"members": [m]}) for m in ("1ABC", "1ABC", "2ABC")] == [True, False, True]
    sites = read_sites(spark, f"{layout.ensemble('ens')}/binding_sites.json", "ens").collect()
    assert [(s.site_id, s.pocket_score) for s in sites] == [("1ABC:tool:1", 12.5)]


def test_plan_of_a_surrogate(spark, tmp_path):
    for part in ("f", "c"):
        (tmp_path / part).mkdir()
        for n in (2, 1):
            (tmp_path / part / f"shard_{n}.parquet").write_text(part)
    (tmp_path / "model.bin").write_text("m")
    for files, root in ((LOCAL, str(tmp_path)), (HadoopFiles(spark), f"file://{tmp_path}")):
        plan = plan_surrogate(root, "f/*.parquet", "c/*.parquet", f"{root}/plan.json", f"{root}/state/sources.json", "model.bin", files)
        assert plan == json.loads((tmp_path / "plan.json").read_text()) == {"features": ["shard_1.parquet", "shard_2.parquet"], "conformers": ["shard_1.parquet", "shard_2.parquet"], "models": ["model.bin"]}
        assert len(Manifest(f"{root}/state/sources.json", files=files).load().data["source_files"]) == 5
    (tmp_path / "c/shard_2.parquet").rename(tmp_path / "c/shard_3.parquet")
    with pytest.raises(ValueError, match=r"only features \['shard_2.parquet'\], only conformers \['shard_3.parquet'\]"):
        plan_surrogate(str(tmp_path), "f/*", "c/*", str(tmp_path / "p"), str(tmp_path / "q"))
    with pytest.raises(FileNotFoundError):
        plan_surrogate(str(tmp_path), "g/*", "c/*", str(tmp_path / "p"), str(tmp_path / "q"))


@pytest.mark.parametrize("kind", ["local", "hadoop"])
def test_manifests_on_any_file_system(spark, tmp_path, kind):
    files, root = (LOCAL, str(tmp_path)) if kind == "local" else (HadoopFiles(spark), f"file://{tmp_path}")
    for name, text in (("in/a", "1"), ("in/b", "22"), ("in/c.txt", "x" * 3_000_000)):
        files.write(f"{root}/{name}", text.encode())
    entries = found(f"{root}/in", "*.txt", "?", hashed=True, files=files)
    assert [(e["path"], e["size"]) for e in entries] == [("a", 1), ("b", 2), ("c.txt", 3_000_000)]
    assert entries[2]["sha256"] == LOCAL.digest(str(tmp_path / "in/c.txt")) and files.read(f"{root}/in/b") == b"22"
    manifest = Manifest(f"{root}/state/m.json", {"n": 1, "source_files": described([f"{root}/in/a", f"{root}/in/b"], f"{root}/in", files=files)}, files).save()
    again = Manifest(manifest.path, files=files).load()
    assert again == manifest and again.sources(f"{root}/in") == [f"{root}/in/a", f"{root}/in/b"] and again.same_sources(f"{root}/in", "?")
    assert again.add_hashes({"a": "h"}).data["source_files"][0]["sha256"] == "h"
    with pytest.raises(ValueError, match="zz"):
        again.add_hashes({"zz": "h"})
    result = f"{root}/out/result"
    assert gate(manifest.path, {"n": 1}, result, f"{root}/in", ["?"], files) and files.read(result) == b"true"
    files.write(f"{root}/in/b", b"333")
    assert changed(entries, f"{root}/in", files) == ["b"]
    assert not gate(manifest.path, {"n": 1}, result, f"{root}/in", ["?"], files) and files.read(result) == b"false"
    assert gate(manifest.path, {"n": 1}, result, files=files) and not gate(f"{root}/none", {}, result, files=files)
    assert not Manifest(f"{root}/x", {}, files).same_sources(root, "*")
    mark_success(f"{root}/ok.json", {"rows": 3}, files)
    assert Manifest(f"{root}/ok.json", files=files).complete({"status": "ok", "rows": 3})


CIF = """data_1ABC
loop_
_atom_site.group_PDB
_atom_site.id
_atom_site.label_atom_id
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.pdbx_PDB_model_num
ATOM 1 "O5'" 1.5 -2.0 3.25 1
ATOM 2 'C A' 0 0 1e1 1
ATOM 2 CA 7 8 9 1
HETATM 3 ZN ? . 0 1
ATOM 4 N 1 1 1 2
#
loop_
_other.id
5
"""
PDB = "ATOM      1  N   ALA A   1      11.104   6.134  -6.504  1.00  0.00           N\nEND\n"


def test_atoms_of_either_format(spark):
    rows = spark.createDataFrame([("1ABC", CIF), ("2ABC", PDB), ("3ABC", None), ("4ABC", "")], "member_id string, content string")
    assert sorted(tuple(r) for r in structure_atoms(rows).collect()) == [("1ABC", 1, 1.5, -2.0, 3.25), ("1ABC", 2, 7.0, 8.0, 9.0), ("2ABC", 1, 11.104, 6.134, -6.504)]


def test_registries_of_chemistry(spark):
    assert {p.name for p in chemistry.feature_providers([*FEATURES, "ecfp"])} == set(FEATURES)
    for refused in (lambda: chemistry.feature_provider("none"), lambda: chemistry.feature_providers([]), lambda: chemistry.docking_provider("none")):
        with pytest.raises(ValueError):
            refused()
    for needs in (chemistry.Conformers().require, chemistry.feature_provider("cns_mpo").require, chemistry.docking_provider("gpu", receptor="", center=[0, 0, 0], edges=[1, 1, 1]).require):
        try:
            needs()
        except ProviderNotAvailable:
            pass
    numbers = [(mw, clogd, tpsa, float(hbd), c) for mw in (100.0, 400.0, 600.0) for clogd in (-1.0, 1.0, 3.0, 4.5, 6.0) for tpsa in (10.0, 30.0, 60.0, 100.0, 130.0) for hbd in range(5) for c in (True, False)]
    frame = spark.createDataFrame(numbers, "mw double, clogd double, tpsa double, hbd double, c boolean")
    for r in frame.withColumn("s", scores.mpo_score(F.col("mw"), F.col("clogd"), F.col("tpsa"), F.col("hbd"), F.col("c"))).collect():
        assert abs(chemistry.property_score(*r[:5]) - r.s) < 1e-9


def test_the_docking_command(tmp_path):
    provider = chemistry.docking_provider("gpu", receptor="R", center=[1, 2, 3], edges=[5, 30, 40], modes=4)
    out = tmp_path / "out"
    out.mkdir()
    line = provider.command([tmp_path / "0.pdbqt", tmp_path / "1.pdbqt"], out)
    assert (tmp_path / "receptor.pdbqt").read_text() == "R"
    for flag, value in (("--center_y", "2.000"), ("--size_x", "25.000"), ("--size_z", "40.000"), ("--num_modes", "4"), ("--dir", str(out)), ("--scoring", "vina")):
        assert line[line.index(flag) + 1] == value
    assert line[line.index("--gpu_batch") + 1 : line.index("--search_mode")] == [str(tmp_path / "0.pdbqt"), str(tmp_path / "1.pdbqt")]


def test_models_are_saved(spark, tmp_path):
    rows = spark.createDataFrame([([float(i % 7), float(i % 3)], True, int(i % 7 > 3)) for i in range(80)], "usrcat array<double>, usrcat_valid boolean, active int")
    model = trained(prepared(rows, ["usrcat"]), Settings(trees=3, depth=2))
    for _ in range(2):
        save_model(model, f"file://{tmp_path}/m")
    again = load_model(f"file://{tmp_path}/m")
    assert [r.score for r in scored(rows, again, ["usrcat"]).collect()] == [r.score for r in scored(rows, model, ["usrcat"]).collect()]
    with pytest.raises(Exception, match="none"):
        load_model(f"file://{tmp_path}/none")


def test_places_and_own_output(spark):
    rows = spark.createDataFrame([(i, "x") for i in range(10)], "place long, id string")
    assert sorted(r.place for r in sampling.taken_at(rows, spark.createDataFrame([(3,), (3,), (9,), (99,)], "place long")).collect()) == [3, 9]
    assert sampling.earlier_outputs(["a/", "b", "b", "c"], "a") == ["b", "c"]


def test_no_files_is_an_error_or_a_warning(spark, tmp_path, caplog):
    with pytest.raises(FileNotFoundError):
        resolve(spark, f"file://{tmp_path}/none/*")
    assert resolve(spark, f"file://{tmp_path}/none/*", missing="warn") == [] and "no files" in caplog.text
    with pytest.raises(ValueError):
        resolve(spark, "x", missing="maybe")


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_a_stream_leaves_few_files(spark, tmp_path):
    """Files that come one by one are one run in the end, each line once, also where a batch is repeated."""
    (tmp_path / "in").mkdir()
    for day in range(2):
        for n in range(4):
            (tmp_path / f"in/{day}{n}.smi").write_text(f"C x{day}{n}\nCC\nCCC y{day}{n}\n")
        take_into_runs(spark, str(tmp_path / "in"), f"file://{tmp_path}/runs", str(tmp_path / "done"), 4, files_per_batch=1).awaitTermination(200)
    runs = candidate_runs(spark, f"file://{tmp_path}/runs")
    state = runs.journal.state()
    assert sorted(r.id for r in runs.read(state).collect()) == sorted(f"{c}{d}{n}" for c in "xy" for d in range(2) for n in range(4))
    assert len(state.of("candidates")) == 1 and state.notes["batch"] == 7
    # The last batch again, as after a crash between the commit of its run and that of the stream.
    for name in ("7", ".7.crc"):
        (tmp_path / "done/commits" / name).unlink(missing_ok=True)
    take_into_runs(spark, str(tmp_path / "in"), f"file://{tmp_path}/runs", str(tmp_path / "done"), 4, files_per_batch=1).awaitTermination(200)
    assert runs.read(runs.journal.state()).count() == 16


def pool_config(**changes):
    base = {
        "x-note": 1, "storage": {"base": "lib"},
        "candidate_pool": {
            "storage": {"base": "pool", "smiles": "lines", "parquet": "tables", "shards": {"staging": "tmp", "merged": "done", "manifests": "state"}},
            "sharding": {"max_batch_gib": 2, "num_shards": 16},
        },
        "samples": {"few": {"num_samples": 160, "feature_types": ["usrcat", "whim"], "storage": {"raw": "r", "preprocessed": "p", "featurized": "f"}}},
    }
    return base | changes


def test_configuration_of_the_pool():
    good = candidates_of(pool_config())
    assert good.batch_bytes == 2 << 30 and good.shards == 16 and good.folders["merged"] == "done"
    assert good.sample_folder("few", "featurized") == "lib/samples/few/f" and good.sample("few").features == ("usrcat", "whim")
    sample, pool = pool_config()["samples"]["few"], pool_config()["candidate_pool"]
    for wrong in (
        {"samples": {"Few!": sample}}, {"samples": {"few": sample | {"num_samples": 0}}}, {"samples": {"few": sample | {"feature_types": ["whim", "whim"]}}},
        {"samples": {"few": sample | {"feature_types": []}}}, {"samples": {"few": sample | {"feature_types": ["cns_mpo"]}}}, {"samples": {"few": sample | {"more": 1}}},
        {"samples": {"few": sample | {"storage": {"raw": "r", "preprocessed": "r/p", "featurized": "f"}}}}, {"samples": {"few": sample | {"storage": {"raw": "r", "preprocessed": "../p", "featurized": "f"}}}},
        {"samples": {"few": sample | {"storage": {"raw": "r"}}}}, {"storage": {"base": "/lib"}}, {"other": 1}, {"candidate_pool": pool | {"sharding": {"max_batch_gib": 1, "num_shards": 0}}},
    ):
        with pytest.raises(ConfigError):
            candidates_of(pool_config(**wrong))
    with pytest.raises(ConfigError, match="few"):
        good.sample("many")


def test_screens_fit_their_samples():
    pool = candidates_of(pool_config())
    screen = lambda name, rows, features=("whim",), sample="few": Screen(name, sample, {}, 0.0, features, rows, (Round(0, 10),), 1, 1.0)
    checked([screen("a", 150), screen("b", 1)], pool)
    for wrong in ([screen("a", 1), screen("a", 1)], [screen("a", 151)], [screen("a", 1, ("rdf",))], [screen("a", 1, sample="none")]):
        with pytest.raises(ConfigError):
            checked(wrong, pool)


def test_copies_are_retried(tmp_path):
    for n in range(5):
        (tmp_path / f"{n}").write_text(str(n))

    class Flaky(LocalFiles):
        failed = set()

        def read(self, path):
            if path not in self.failed:
                self.failed.add(path)
                raise OSError(errno.EIO, "io")
            return super().read(path)

    assert copied([(str(tmp_path / f"{n}"), str(tmp_path / f"to/{n}")) for n in range(5)], Flaky(), sleep=lambda s: None) == 5
    assert [(tmp_path / f"to/{n}").read_text() for n in range(5)] == list("01234")
    with pytest.raises(RuntimeError):
        copied([(str(tmp_path / "none"), str(tmp_path / "x"))], sleep=lambda s: None)
