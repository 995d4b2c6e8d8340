"""Operators on small tables with their dirty cases."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siftmill.functions import names, scores
from siftmill.functions.features import all_valid, flattened
from siftmill.functions.hashing import blake3_shard_of, blake3_words, shard_of
from siftmill.operators import cleaning, labels, packing, sampling, sharding, sites
from siftmill.operators.surrogate import Settings, prepared, scored, trained
from siftmill.sources.pockets import atoms_of, read_sites, trimmed_pockets
from siftmill.sources.pose_text import pose_records
from siftmill.sources.poses import read_ligands, read_results, write_results
from siftmill.sources.smi import parse_lines, read_smi
from siftmill.sources.tables import listing, resolve, scan


def values(frame, *columns):
    return sorted((tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in frame.collect()), key=str)


def test_blake3_of_known_messages():
    def digest(m):
        return blake3_words([m])[0].astype("<u4").tobytes().hex()

    assert digest(b"") == "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262"
    assert digest(b"abc") == "6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85"
    long = bytes(i % 251 for i in range(2049))
    assert digest(long[:1024])[:32] == "42214739f095a406f3fc83deb889744a"
    assert digest(long[:1025])[:32] == "d00278ae47eb27b34faecf67b4fe263f"
    assert digest(long)[:32] == "5f4d72f40d7a5f82b15ca2b2e44b1de3"


def test_shards(spark):
    rows = spark.createDataFrame([("A",), ("B",), (None,), ("",)], "id string")
    both = rows.select("id", shard_of("id", 7).alias("m"), blake3_shard_of("id", 7).alias("b")).collect()
    assert all((r.m is None) == (r.id is None) == (r.b is None) for r in both)
    assert {r.id: r.b for r in both}["A"] == int.from_bytes(blake3_words([b"A"])[0].astype("<u4").tobytes()[:8], "little") % 7
    with pytest.raises(ValueError):
        shard_of("id", 0)
    placed = sharding.assigned(rows, shards=2)
    with pytest.raises(ValueError):
        sharding.assigned(placed)
    with pytest.raises(ValueError, match="missing"):
        sharding.require_layout(placed, 50)


def test_shards_are_written_and_merged(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").cast("string").alias("id"))
    sharding.write_shards(rows, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 200 and back.select("shard_id").distinct().count() == 4
    assert len(list((tmp_path / "s").glob("shard_id=*/*.parquet"))) == 4
    assert sharding.write_merged(sharding.merged(spark, str(tmp_path / "s")), str(tmp_path / "m")) == 200
    with pytest.raises(ValueError):
        sharding.require_written(spark, str(tmp_path / "m"), 199)
    with pytest.raises(ValueError):
        sharding.merged(spark)


def test_lines(spark, tmp_path):
    lines = [("C c",), ("",), ("N\tid with blank",), ("  O x \r",), ("S",), (None,)]
    rows = spark.createDataFrame(lines, "value string")
    assert values(parse_lines(rows, missing="drop"), "smiles", "id") == [("C", "c"), ("N", "id with blank"), ("O", "x")]
    assert ("S", None) in values(parse_lines(rows, missing="null"), "smiles", "id")
    with pytest.raises(Exception, match="line without id"):
        parse_lines(rows).collect()
    import gzip

    with gzip.open(tmp_path / "t1.smi.gz", "wt") as f:
        f.write("C a\nN b\n")
    assert values(read_smi(spark, str(tmp_path)), "smiles", "id", "source") == [("C", "a", "t1"), ("N", "b", "t1")]


def test_samples_do_not_depend_on_layout(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("int").alias("shard_id"), F.sin("id").alias("s"))
    for pick in (
        lambda r: sampling.sampled(r, 5),
        lambda r: sampling.select_top_and_random(r, 3, 4, "s").select("id", "selection_group"),
        lambda r: sampling.top_scored(r, 4, "s"),
        lambda r: sampling.split(r).where("part = 'test'"),
    ):
        assert len({tuple(values(pick(rows.repartition(n)), "id")) for n in (1, 3, 8)}) == 1
    assert sampling.sampled(rows, 5).count() == 15
    assert values(sampling.sampled(rows, 5), "id") != values(sampling.sampled(rows, 5, seed=2), "id")
    both = sampling.select_top_and_random(rows, 3, 4, "s")
    assert both.count() == 21 and both.select("id").distinct().count() == 21
    assert sampling.sampled(rows.limit(0), 5).count() == 0 and sampling.sampled(rows, 10**6).count() == 500


def test_scores_that_are_missing_are_never_picked(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("b", 0, float("nan")), ("c", 0, None), ("d", 0, 1.0)], "id string, shard_id int, s double")
    assert values(sampling.top_scored(rows, 3, "s"), "id") == ["a", "d"]
    assert values(sampling.top_scored(rows, 1, "s"), "id") == ["a"]  # ties go by key
    assert values(sampling.select_top_and_random(rows, 1, 5, "s"), "id", "selection_group") == [("a", "top"), ("d", "random")]


def test_quotas_and_seeds():
    assert sampling.quotas(500, 512) == [1] * 500 + [0] * 12 and sampling.quotas(500, 512, floor=True) == [0] * 512
    assert sum(sampling.quotas(1000, 7)) == 1000
    assert sampling.round_seeds(5, 2) == {"validation": 5, "round_0": 6, "round_1": 7}


def test_exclusion_and_differences(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    gone = spark.createDataFrame([("a",), (None,)], "id string")
    assert values(sampling.not_selected(rows, gone), "id") == [None, "b"]
    assert values(cleaning.difference(rows, gone, "id"), "key", "side") == [("b", "left")]
    present, absent = cleaning.present_and_absent(rows, gone, ["id"])
    assert values(present, "id") == ["a"] and values(absent, "id") == [None, "b"]
    assert values(cleaning.duplicated(rows.union(rows), ["id"]), "copies") == [2, 2, 2]


def test_validity(spark):
    rows = spark.createDataFrame([(1, True, True), (2, True, None), (3, False, True)], "n int, a_valid boolean, b_valid boolean")
    assert values(rows.where(all_valid(rows)), "n") == [1]
    plain = rows.select("n")
    assert plain.where(all_valid(plain)).count() == 3 and plain.where(all_valid(plain, none=False)).count() == 0
    table = spark.createDataFrame([([1.0, 2.0], 3)], "v array<float>, k int")
    assert table.select(flattened(table, ["k", "v"]).alias("x")).first().x == [3.0, 1.0, 2.0]
    with pytest.raises(ValueError):
        flattened(table, [])


def test_training_rows(spark):
    features = spark.createDataFrame([("a", 2, True), ("a", 1, True), ("b", 3, None), ("c", 4, True)], "id string, vec_no int, f_valid boolean")
    poses = spark.createDataFrame([("a", 2, -5.0), ("a", 1, -4.0), ("b", 1, -9.0), ("c", 1, 0.0), ("c", 2, float("nan"))], "id string, mode int, affinity_kcal_mol double")
    found = cleaning.training_rows(features, poses, [F.col("vec_no")], [F.col("mode")])
    assert values(found, "id", "vec_no", "affinity_kcal_mol") == [("a", 1, -4.0)]


def test_alignment(spark):
    left = spark.createDataFrame([(0, "a"), (1, "b")], "p int, id string")
    right = spark.createDataFrame([(0, "a"), (1, "x"), (2, "c")], "p int, id string")
    assert values(cleaning.aligned(left, right, "p"), "p", "same") == [(0, True), (1, False), (2, False)]
    with pytest.raises(ValueError, match="2 rows"):
        cleaning.require_aligned(cleaning.aligned(left, right, "p"))
    assert cleaning.require_aligned(cleaning.aligned(left, left, "p")).count() == 2


@pytest.mark.parametrize(("percent", "expected"), [(1, -10.0), (50, -5.0), (100, -1.0), (45, -6.0), (10, -9.0)])
def test_nearest_quantile(spark, percent, expected):
    rows = spark.createDataFrame([(float(-i),) for i in range(1, 11)] + [(None,), (float("nan"),)], "a double")
    assert labels.require_threshold(labels.nearest_quantile(rows, "a", percent)) == expected


def test_labels(spark):
    rows = spark.createDataFrame([(-9.0,), (-1.0,), (float("nan"),), (None,)], "a double")
    limit = spark.createDataFrame([(-5.0,)], "threshold double")
    assert values(labels.labelled(rows, limit, "a"), "active") == [0, 0, 0, 1]
    many = spark.createDataFrame([(0,), (3,), (3,)], "active int")
    assert values(labels.histogram(many), "value", "rows") == [(0, 1), (1, 0), (2, 0), (3, 2)]
    assert labels.histogram(many.limit(0)).count() == 0
    with pytest.raises(ValueError):
        labels.require_threshold(labels.nearest_quantile(rows.limit(0), "a", 5))
    with pytest.raises(ValueError):
        labels.nearest_quantile(rows, "a", 0)


def test_enrichment(spark):
    rows = spark.createDataFrame([(i, float(i), int(i >= 95)) for i in range(100)] + [(100, None, 0)], "k int, s double, y int")
    found = {r.percent: r for r in labels.enrichment(rows, "s", "y", "k").collect()}
    assert (found[1.0].precision, found[1.0].caught, found[5.0].recall, found[15.0].caught) == (1.0, 1, 1.0, 5)
    assert labels.enrichment(rows.limit(0), "s", "y", "k").count() == 0
    assert labels.enrichment(rows.withColumn("y", F.lit(0)), "s", "y", "k").first().recall is None


def test_scores(spark):
    row = spark.createDataFrame([(430.0, 1.0, 105.0, 1.5)], "mw double, clogd double, tpsa double, hbd double")
    got = row.select(*(scores.desirability(c, c).alias(c) for c in scores.CURVES), scores.mpo_score(*(F.col(c) for c in ("mw", "clogd", "tpsa", "hbd")), F.lit(True)).alias("s")).first()
    assert (got.mw, got.clogd, got.tpsa, got.hbd, got.s) == (0.5, 0.5, 0.5, 0.5, 2.5)
    edge = row.select(scores.desirability(F.lit(float("nan")), "mw"), scores.desirability(F.lit(6.0), "clogd"), scores.desirability(F.lit(-1.0), "clogd"), scores.desirability(F.lit(0.0), "mw")).first()
    assert tuple(edge) == (None, 0.0, 0.0, 1.0)


def test_names(spark):
    row = spark.range(1).select(
        names.source_stem(F.lit("/a/b/H04.smi.gz")), names.slug(F.lit("  HSP90 (N-term)! ")), names.structure_ids(F.lit(" 1abc, ,2XYZ,")),
        names.site_id(F.lit("M"), "tool", F.lit(3)), names.box_edge(F.lit(3.0)), names.box_edge(F.lit(30.0)), names.box_edge(F.lit(None).cast("double")),
    ).first()
    assert tuple(row) == ("H04", "hsp90-n-term", ["1ABC", "2XYZ"], "M:tool:3", 25.0, 30.0, None)
    assert [names.memory_unit(t) for t in ("6Gi", "6G", "512Mi", "7")] == ["6GiB", "6GB", "512MiB", "7"]


def test_packing(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), ("d", 20), ("e", 1), ("f", None), (None, 4)], "path string, size int")
    assert values(packing.packed(rows, 10), "path", "batch") == [("a", 0), ("b", 0), ("c", 1), ("d", 2), ("e", 3), ("f", 3)]
    assert packing.packed(rows.limit(0), 10).count() == 0
    with pytest.raises(Exception, match="exceeds"):
        packing.packed(rows, 10, strict=True).collect()


def test_pockets_and_atoms(spark):
    header = " name ,rank, score,probability,sas_points,surf_atoms,center_x,center_y,center_z,residue_ids, surf_atom_ids,more"
    raw = spark.createDataFrame([("p", " 1", "9.5 ", "0.7", "1", "2", "0", "0", "0", "A_1", " 1 2 77 ", "x")], header.split(","))
    pockets = trimmed_pockets(raw).withColumn("member_id", F.lit("M"))
    with pytest.raises(ValueError, match="rank"):
        trimmed_pockets(raw.drop("rank"))

    def atom(serial, x):
        return f"ATOM  {serial:>5}  CA  GLY A   1    {x:8.3f}{0.0:8.3f}{0.0:8.3f}  1.00"

    text = "\n".join(["MODEL 1", atom(1, 3.0), atom(2, 9.0), atom(2, 4.0), "ATOM  broken", "ENDMDL", "MODEL 2", atom(1, 99.0), "ENDMDL"])
    atoms = atoms_of(spark.createDataFrame([("M", text), ("N", None)], "member_id string, content string"))
    assert values(atoms, "serial", "x") == [(1, 3.0), (2, 4.0)]
    site = sites.pocket_sites(pockets, atoms, "tool").collect()
    assert len(site) == 1 and (site[0].site_id, site[0].missing) == ("M:tool:1", 1) and math.isclose(site[0].radius, 12.5**0.5)
    assert sites.pocket_sites(pockets, atoms.where("serial > 5"), "tool").count() == 0


def test_site_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"ensemble_id": "E", "binding_sites": [{"site_id": "M:1", "member_id": "M", "center": [1, 2.5, 3], "pocket_score": null}]}')
    assert read_sites(spark, str(tmp_path / "s.json"), "E").first().center == [1.0, 2.5, 3.0]
    with pytest.raises(ValueError, match="not of ensemble"):
        read_sites(spark, str(tmp_path / "s.json"), "F")
    (tmp_path / "t.json").write_text('{"ensemble_id": "E", "binding_sites": []}')
    with pytest.raises(ValueError, match="no sites"):
        read_sites(spark, str(tmp_path / "t.json"), "E")


def test_result_lines(spark):
    text = "MODEL 1\nREMARK VINA RESULT:  -7.5  0.0  0.0\nREMARK VINA RESULT: -7.4 0 1\nENDMDL\nMODELX\r\nREMARK VINA RESULT:-1 2 3\rREMARK VINA RESULT: 1 2"
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "no result")], "n int, content string")
    assert values(pose_records(rows), "n", "mode", "affinity_kcal_mol") == [(1, 1, -7.4), (1, 1, -7.5), (1, 2, -1.0)]
    with pytest.raises(ValueError, match="clash"):
        pose_records(rows.withColumn("mode", F.lit(1)))


def test_results_sink(spark, tmp_path):
    rows = spark.createDataFrame([("a", "M", "S", 1, -5.0, None, None, "x"), ("b", "M", "S", None, None, None, None, "")], "id string, member_id string, site_id string, mode int, affinity_kcal_mol double, rmsd_lb double, rmsd_ub double, pose_pdbqt string")
    assert write_results(rows, str(tmp_path / "r")) == 1
    assert read_results(spark, str(tmp_path / "r")).first().pose_pdbqt == ""
    assert write_results(rows, str(tmp_path / "p"), poses=True) == 1 and read_results(spark, str(tmp_path / "p")).first().pose_pdbqt == "x"
    assert write_results(rows.limit(0), str(tmp_path / "e")) == 0 and read_results(spark, str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError, match="conformer"):
        read_ligands(rows)
    files = resolve(spark, f"file://{tmp_path}/r/docking.results.parquet")
    assert len(files) >= 1 and scan(spark, files, ["id"]).columns == ["id"]
    assert listing(spark, f"{tmp_path}/r/docking.results.parquet/*.parquet", hashed=True).first().sha256
    with pytest.raises(FileNotFoundError):
        resolve(spark, f"file://{tmp_path}/none*")


def test_surrogate_scores_only_what_it_can(spark):
    rows = spark.createDataFrame([(str(i), [float(i % 10), float(i % 3)], True, int(i % 10 > 4)) for i in range(200)], "id string, f array<float>, f_valid boolean, active int")
    model = trained(prepared(rows, ["f"]), Settings(trees=3, depth=2))
    more = spark.createDataFrame([("n", [9.0, 1.0], True), ("v", [9.0, 1.0], None), ("w", [9.0], True), ("x", [9.0, float("inf")], True), ("y", None, True)], "id string, f array<float>, f_valid boolean")
    found = {r.id: (r.eligible, r.score) for r in scored(more, model, ["f"]).collect()}
    assert found["n"][0] and found["n"][1] > 0.5
    assert all(found[k] == (False, None) for k in "vwxy")
    with pytest.raises(ValueError):
        trained(prepared(rows.where("active = 1"), ["f"]))


def test_enrichment_against_a_sort(spark):
    import random

    chance = random.Random(4)
    data = [(i, chance.choice([None, float("nan"), 0.5, 0.25, chance.random(), -chance.random()]), chance.randint(0, 1)) for i in range(700)]
    order = sorted(data, key=lambda r: (r[1] is None or r[1] != r[1], -(r[1] if r[1] is not None and r[1] == r[1] else 0), r[0]))
    percents = [0.1, 1, 10, 33, 80, 100]
    found = {r.percent: r for r in labels.enrichment(spark.createDataFrame(data, "k int, s double, y int").repartition(5), "s", "y", "k", percents).collect()}
    for p in percents:
        end = max(1, int(700 * p / 100))
        caught = sum(r[2] for r in order[:end])
        assert (found[p].caught, found[p].precision, found[p].actives) == (caught, caught / end, sum(r[2] for r in data))


def test_first_reaching_by_groups(spark):
    from siftmill.operators.ranks import coarse, first_reaching

    rows = spark.createDataFrame([(None, 3.0), (None, 1.0), ("a", -2.0), ("a", -2.0), ("a", 1e-30), ("a", 7.5)], "g string, v double")
    found = first_reaching(rows, ["g"], "v", F.col("upto") * 2 >= F.col("total"))
    assert {(r.g, r.value, r.upto, r.total) for r in found.collect()} == {(None, 1.0, 1, 2), ("a", -2.0, 2, 4)}
    numbers = [float("-inf"), -1e308, -3.0, -1.0, -1e-300, 0.0, 1e-19, 1.0, 1.5, 1.999999999, 2.0, 63.9, 64.0, 1e9, float("inf")]
    bins = [r.b for r in spark.createDataFrame([(x,) for x in numbers], "x double").select("x", coarse(F.col("x")).alias("b")).orderBy("x").collect()]
    assert bins == sorted(bins)
    assert spark.range(1).select(coarse(F.lit(None).cast("double")), coarse(F.lit(float("nan")))).first() == (None, None)


def folded_plainly(rows, limit):
    out, batch, filled = [], -1, None
    for path, size in sorted(rows):
        if filled is None or filled + size > limit:
            batch, filled = batch + 1, 0
        filled += size
        out.append((path, size, batch))
    return sorted(out)


@pytest.mark.parametrize("sizes", ["many small", "some too large", "zeros", "one path"])
def test_packing_in_parts(spark, monkeypatch, sizes):
    """Parts that are packed at once give what one pass in order does."""
    monkeypatch.setattr(packing, "PART", 40)
    chance = random.Random(sizes)
    draw_ = {"many small": lambda: chance.randint(1, 9), "some too large": lambda: chance.choice([3, 50, 101, 250]), "zeros": lambda: chance.choice([0, 0, 0, 100, 1]), "one path": lambda: chance.randint(0, 60)}[sizes]
    rows = [("same" if sizes == "one path" else f"p{chance.randint(0, 400):03}", draw_()) for _ in range(500)]
    found = packing.packed(spark.createDataFrame(rows, "path string, size long"), 100)
    assert sorted(tuple(r) for r in found.collect()) == folded_plainly(rows, 100)
    assert found.select("batch").distinct().count() == max(b for _, _, b in folded_plainly(rows, 100)) + 1
    with pytest.raises(Exception, match="negative"):
        packing.packed(spark.createDataFrame([("a", -1)], "path string, size long"), 100).collect()


def test_top_and_random_by_group_limits(spark):
    rows = [(i, i % 3, float(i % 50)) for i in range(600)] + [(7, 1, 49.5), (7, 1, 0.5), (None, 2, 99.0), (None, 2, None), (9, None, 1.0)]
    frame = spark.createDataFrame(rows, "id long, shard_id int, score double")
    found = sampling.select_top_and_random(frame, 4, 6, "score")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4
    picked = [(r.id, r.shard_id, r.selection_group) for r in found.collect()]
    assert Counter((s, g) for _, s, g in picked) == {(s, g): n for s in range(3) for g, n in (("top", 4), ("random", 6))} | {(None, "top"): 1}
    assert (7, 1, "top") in picked and (7, 1, "random") not in picked and (None, 2, "random") not in picked
    assert len(set(picked)) == len(picked)


def test_shards_in_several_files(spark, tmp_path):
    rows = spark.range(2000).select("id", (F.col("id") % 5).cast("int").alias("shard_id"))
    sharding.write_shards(rows, str(tmp_path / "s"), shards=5, files_per_shard=3)
    assert {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "s").iterdir() if p.is_dir()} == {f"shard_id={i}": 3 for i in range(5)}
    sharding.write_shards(rows, str(tmp_path / "t"), shards=5)
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "t").iterdir() if p.is_dir())
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2000
    with pytest.raises(ValueError):
        sharding.write_shards(rows, str(tmp_path / "u"), files_per_shard=0)


def test_null_is_a_group_of_labels(spark):
    rows = spark.createDataFrame([(None, -5.0), (None, -1.0), ("a", -2.0), ("b", None)], "g string, v double")
    limits = labels.nearest_quantile(rows, "v", 1.0, ["g"])
    assert sorted((r.g or "", r.v, r.active) for r in labels.labelled(rows, limits, "v", ["g"]).collect()) == [("", -5.0, 1), ("", -1.0, 0), ("a", -2.0, 1)]
