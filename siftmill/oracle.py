"""SQL that gives the same rows as the core queries, where SQL can express them."""

_RESULT = r"^REMARK VINA RESULT:\s*(-?\d+\.?\d*)\s+(-?\d+\.?\d*)\s+(-?\d+\.?\d*)"
_RECORDS = rf"""
    SELECT file_no, id, member_id, site_id, greatest(1, block - 1 + CASE WHEN starts_with(content, 'MODEL') THEN 1 ELSE 0 END)::INTEGER AS mode, text,
           regexp_extract(line, '{_RESULT}', 1)::DOUBLE AS affinity_kcal_mol, regexp_extract(line, '{_RESULT}', 2)::DOUBLE AS rmsd_lb,
           regexp_extract(line, '{_RESULT}', 3)::DOUBLE AS rmsd_ub
    FROM (SELECT *, unnest(string_split(text, chr(10))) AS line
          FROM (SELECT *, unnest(blocks) AS text, generate_subscripts(blocks, 1) AS block
                FROM (SELECT *, string_split(substr(replace(chr(10) || n, chr(10) || 'MODEL', chr(10) || chr(1) || 'MODEL'), CASE WHEN starts_with(n, 'MODEL') THEN 3 ELSE 2 END), chr(1)) AS blocks
                      FROM (SELECT *, replace(replace(content, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS n
                            FROM pose_files WHERE content IS NOT NULL))))
    WHERE regexp_matches(line, '{_RESULT}')
"""
_POSES = f"SELECT DISTINCT id, member_id, site_id, mode, affinity_kcal_mol, rmsd_lb, rmsd_ub, text FROM ({_RECORDS})"


def _shard(key: str, shards: int) -> str:
    return f"(('0x' || substr(md5({key}), 1, 15))::BIGINT % {shards})::INTEGER"


def _lot(key: str) -> str:
    return f"md5('1000:' || {key}::VARCHAR)"


_SCORED = "SELECT vec_no, id, shard_id, cns_mpo[5]::DOUBLE AS score FROM features WHERE coalesce(cns_mpo_valid, false)"
_FIT = f"SELECT * FROM ({_SCORED}) WHERE score IS NOT NULL AND NOT isnan(score)"
_REST = f"SELECT * FROM ({_FIT}) f WHERE NOT EXISTS (SELECT 1 FROM selections s WHERE s.id = f.id)"
_TRAINING = """
    SELECT f.id, f.vec_no, f.cns_mpo, l.pose_no, l.affinity_kcal_mol
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY vec_no) AS place FROM features WHERE usrcat_valid AND cns_mpo_valid) f
    JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY mode NULLS FIRST, pose_no) AS place FROM docking_results WHERE affinity_kcal_mol < 0) l
      ON f.id = l.id WHERE f.place = 1 AND l.place = 1
"""
_PROPERTIES = "SELECT vec_no, cns_mpo[1]::DOUBLE AS mw, cns_mpo[2]::DOUBLE AS clogd, cns_mpo[3]::DOUBLE AS tpsa, cns_mpo[4]::DOUBLE AS hbd FROM features WHERE cns_mpo_valid AND len(cns_mpo) = 5"


def _threshold(percent: float) -> str:
    return f"""
    SELECT member_id, site_id, n, affinity_kcal_mol AS threshold
    FROM (SELECT member_id, site_id, affinity_kcal_mol, row_number() OVER (PARTITION BY member_id, site_id ORDER BY affinity_kcal_mol) AS place,
                 count(*) OVER (PARTITION BY member_id, site_id) AS n
          FROM docking_results WHERE affinity_kcal_mol < 0)
    WHERE place = floor((n - 1) * {percent / 100} + 0.5) + 1
    """


#: Desirability as SQL, written out.
_DESIRABILITY = {
    "clogd": "CASE WHEN clogd < 0 OR clogd > 5 THEN 0 WHEN clogd < 2 THEN clogd / 2 WHEN clogd <= 4 THEN 1 ELSE 5 - clogd END",
    "mw": "CASE WHEN mw <= 360 THEN 1 WHEN mw >= 500 THEN 0 ELSE (500 - mw) / 140 END",
    "tpsa": "CASE WHEN tpsa < 20 OR tpsa > 120 THEN 0 WHEN tpsa < 40 THEN (tpsa - 20) / 20 WHEN tpsa <= 90 THEN 1 ELSE (120 - tpsa) / 30 END",
    "hbd": "CASE WHEN hbd <= 0 THEN 1 WHEN hbd >= 3 THEN 0 ELSE (3 - hbd) / 3 END",
}


def _term(c: str) -> str:
    return f"CASE WHEN NOT isnan({c}) THEN ({_DESIRABILITY[c]})::DOUBLE END"


_RADIUS = """sqrt(list_sum(list_transform(extent.points, lambda p: (p[1] - center[1])**2 + (p[2] - center[2])**2 + (p[3] - center[3])**2)) / len(extent.points))"""

ORACLE: dict[str, str] = {
    "p2_found": f"SELECT DISTINCT id, member_id, site_id, mode FROM ({_POSES})",
    "p2_records": f"""SELECT member_id, site_id, count(*) AS records, count(DISTINCT id) AS ligands, min(affinity_kcal_mol) AS best
        FROM ({_POSES}) GROUP BY member_id, site_id""",
    "shard_counts": f"SELECT {_shard('id', 512)} AS shard_id, count(*) AS rows FROM candidates WHERE id IS NOT NULL GROUP BY 1",
    "missing_shards": f"SELECT range::INTEGER AS shard_id FROM range(4096) WHERE range NOT IN (SELECT {_shard('id', 4096)} FROM candidates WHERE id IS NOT NULL)",
    "unexpected_shards": f"SELECT DISTINCT {_shard('id', 512)} AS shard_id FROM candidates WHERE id IS NOT NULL AND {_shard('id', 512)} >= 500",
    "smi_parse": r"""SELECT row_no, regexp_extract(l, '^(\S+)', 1) AS smiles, regexp_extract(l, '(?s)^\S+\s+(.*)$', 1) AS id
        FROM (SELECT row_no, regexp_replace(concat_ws(chr(9), smiles, id), '^\s+|\s+$', '', 'g') AS l FROM candidates) WHERE regexp_matches(l, '\S\s')""",
    "merge_tranches": r"SELECT regexp_replace(regexp_replace(source_file, '^.*/', ''), '\.smi\.gz$', '') AS source, count(*) AS rows FROM candidates GROUP BY 1",
    "pack_batches": """WITH RECURSIVE o AS (
            SELECT path, coalesce(size_bytes, 0) AS size, row_number() OVER (ORDER BY path, coalesce(size_bytes, 0)) AS n FROM pose_files),
        f AS (SELECT n, path, size, 0::BIGINT AS batch, size AS filled FROM o WHERE n = 1
            UNION ALL SELECT o.n, o.path, o.size, f.batch + CASE WHEN f.filled + o.size > 200000 THEN 1 ELSE 0 END,
                CASE WHEN f.filled + o.size > 200000 THEN o.size ELSE f.filled + o.size END FROM f JOIN o ON o.n = f.n + 1)
        SELECT path, size, batch FROM f""",
    "shard_sample": f"""SELECT vec_no, shard_id FROM (SELECT vec_no, shard_id, row_number() OVER (PARTITION BY shard_id ORDER BY {_lot('vec_no')}, vec_no) AS place
        FROM features) WHERE place <= 5""",
    "sample_clip": "SELECT shard_id, count(*) AS rows FROM features GROUP BY shard_id",
    "train_test_split": f"SELECT vec_no, CASE WHEN ('0x' || substr({_lot('vec_no')}, 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.8 THEN 'train' ELSE 'test' END AS part FROM features",
    "topk_per_shard": f"""SELECT vec_no, shard_id, score FROM (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY score DESC, vec_no) AS place
        FROM ({_FIT})) WHERE place <= 5""",
    "select_top_random": f"""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY score DESC, vec_no) AS place FROM ({_REST}))
        SELECT vec_no, shard_id, 'top' AS selection_group FROM ranked WHERE place <= 5
        UNION ALL SELECT vec_no, shard_id, 'random' FROM (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY {_lot('vec_no')}, vec_no) AS lot
            FROM ranked WHERE place > 5) WHERE lot <= 3""",
    "exclude_selected": "SELECT source_file, count(*) AS rows FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM selections s WHERE s.id = c.id) GROUP BY source_file",
    "valid_rows": "SELECT vec_no FROM features WHERE usrcat_valid AND cns_mpo_valid",
    "keep_first_pose": """SELECT pose_no FROM (SELECT pose_no, row_number() OVER (PARTITION BY id, site_id ORDER BY mode NULLS FIRST, pose_no) AS place
        FROM docking_results) WHERE place = 1""",
    "training_rows": f"SELECT id, vec_no, pose_no, affinity_kcal_mol FROM ({_TRAINING})",
    "aligned_rows": """SELECT coalesce(f.id = c.id, false) AS same, count(*) AS rows FROM features f FULL JOIN candidates c ON f.vec_no = c.row_no GROUP BY 1""",
    "alignment_diff": """SELECT DISTINCT id AS key, 'left' AS side FROM features f WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM candidates c WHERE c.id = f.id)
        UNION ALL SELECT DISTINCT id, 'right' FROM candidates c WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM features f WHERE c.id = f.id)""",
    "negative_affinities": "SELECT member_id, site_id, count(*) AS rows FROM docking_results WHERE affinity_kcal_mol < 0 GROUP BY ALL",
    "active_thresholds": _threshold(1.0),
    "label_histogram": f"""SELECT coalesce((d.affinity_kcal_mol <= t.threshold)::INTEGER, 0) AS value, count(*) AS rows
        FROM docking_results d JOIN ({_threshold(5.0)}) t ON d.member_id = t.member_id AND d.site_id = t.site_id GROUP BY 1""",
    "enrichment_metrics": f"""WITH r AS (SELECT (affinity_kcal_mol <= -8)::INTEGER AS y, count(*) OVER () AS n, sum((affinity_kcal_mol <= -8)::INTEGER) OVER () AS actives,
            row_number() OVER (ORDER BY CASE WHEN isnan(cns_mpo[5]) THEN NULL ELSE cns_mpo[5] END DESC NULLS LAST, id) AS place FROM ({_TRAINING})),
        p AS (SELECT unnest([1.0, 5.0, 10.0, 15.0])::DOUBLE AS percent)
        SELECT percent, sum(y)::DOUBLE / any_value(k) AS precision, sum(y)::DOUBLE / nullif(any_value(actives), 0) AS recall,
            sum(y)::BIGINT AS caught, any_value(actives)::BIGINT AS actives
        FROM (SELECT percent, y, place, actives, greatest(1, floor(n * percent / 100)::BIGINT) AS k FROM r CROSS JOIN p) WHERE place <= k GROUP BY percent""",
    "flatten_features": """SELECT vec_no, len(x)::INTEGER AS width, x[1] AS first, x[len(cns_mpo) + 1] AS middle, x[len(x)] AS last
        FROM (SELECT vec_no, cns_mpo, list_concat(list_concat(cns_mpo::DOUBLE[], usrcat::DOUBLE[]), [shard_id::DOUBLE]) AS x FROM features
              WHERE usrcat_valid AND cns_mpo_valid AND cns_mpo IS NOT NULL AND usrcat IS NOT NULL AND shard_id IS NOT NULL)""",
    "desirability_terms": f"SELECT vec_no, {', '.join(f'round({_term(c)}, 9) AS {c}' for c in _DESIRABILITY)} FROM ({_PROPERTIES})",
    "mpo_scores": f"SELECT vec_no, round(2 * {_term('clogd')} + {_term('mw')} + {_term('tpsa')} + {_term('hbd')} + 1, 9) AS score FROM ({_PROPERTIES})",
    "search_boxes": f"""SELECT site_id, round(greatest(25.0, 2 * CASE WHEN extent.kind = 'sphere' THEN extent.radius WHEN len(extent.points) > 0 AND len(center) = 3 THEN {_RADIUS} END), 6) AS edge
        FROM binding_sites""",
    "pocket_radius": f"""SELECT site_id || ':cloud:1' AS site_id, round({_RADIUS}, 6) AS radius, 1::BIGINT AS missing FROM binding_sites
        WHERE extent.kind = 'point_cloud' AND len(center) = 3 AND len(extent.points) > 0""",
    "pocket_filter": "SELECT site_id FROM binding_sites WHERE pocket_score >= 10 AND NOT isnan(pocket_score)",
    "sites_flatten": "SELECT ensemble_id, site_id, member_id, to_json(center)::VARCHAR AS center FROM binding_sites",
    "ensemble_slugs": "SELECT DISTINCT ensemble_id, trim(regexp_replace(lower(ensemble_id), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM binding_sites",
    "member_lists": "SELECT upper(member_id) AS structure, 2 * count(*) AS times FROM binding_sites GROUP BY 1",
    "vina_records": f"SELECT file_no, mode, affinity_kcal_mol, rmsd_lb, rmsd_ub FROM ({_RECORDS})",
    "best_pose": f"""SELECT id, site_id, mode, affinity_kcal_mol FROM (SELECT *, row_number() OVER (PARTITION BY id, site_id ORDER BY mode, affinity_kcal_mol, file_no) AS place
        FROM ({_RECORDS})) WHERE place = 1""",
    "empty_files": "SELECT count(*) FILTER (coalesce(content, '') <> '') AS kept, count(*) FILTER (coalesce(content, '') = '') AS skipped FROM pose_files",
    "missing_pose_files": """SELECT EXISTS (SELECT 1 FROM pose_files p WHERE p.path = d.pose_pdbqt) AS present, count(*) AS rows
        FROM docking_results d WHERE pose_pdbqt <> '' GROUP BY 1""",
    "duplicated_paths": "SELECT path, count(*) AS copies FROM pose_files GROUP BY path HAVING count(*) > 1",
    "site_rounds": "SELECT site_id, round_label FROM binding_sites CROSS JOIN (SELECT DISTINCT round_label FROM sample_specs)",
    "written_shards": f"SELECT {_shard('id', 64)} AS shard_id, count(*) AS rows FROM candidates WHERE id IS NOT NULL GROUP BY 1",
    "written_results": """SELECT member_id, site_id, count(*) AS rows, 0::BIGINT AS texts FROM docking_results
        WHERE id IS NOT NULL AND member_id IS NOT NULL AND site_id IS NOT NULL AND mode IS NOT NULL AND affinity_kcal_mol IS NOT NULL GROUP BY ALL""",
    "pocket_table": "SELECT site_id AS name, coalesce(pocket_score, 0) AS score, center[1] AS x FROM binding_sites WHERE len(center) = 3",
    "site_documents": "SELECT ensemble_id, member_id, site_id, pocket_score FROM binding_sites WHERE ensemble_id IS NOT NULL",
    "conformer_features": r"SELECT source_file, count(*) FILTER (coalesce(regexp_matches(smiles, '\p{L}'), false)) AS valid, count(*) AS rows FROM candidates GROUP BY source_file",
    "stand_in_docking": r"""SELECT 'docked' AS status, mode::INTEGER AS mode, count(*) AS rows
        FROM (SELECT unnest([1, 2, 3]) AS mode FROM candidates WHERE regexp_matches(smiles, '\p{L}')) GROUP BY mode""",
    "active_rounds": """WITH c AS (SELECT id, shard_id, coalesce(usrcat_valid AND cns_mpo_valid AND len(usrcat) = 60 AND len(list_filter(usrcat, lambda v: v IS NOT NULL AND isfinite(v))) = 60, false) AS fit
            FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY vec_no) AS place FROM features WHERE id IS NOT NULL) WHERE place = 1),
        v AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY md5('1000:' || id), id) AS lot FROM c),
        r AS (SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY md5('1001:' || id), id) AS next FROM v WHERE lot > 8)
        SELECT 'validation' AS label, count(*) AS rows FROM v WHERE lot <= 8
        UNION ALL SELECT 'round_0', count(*) FROM r WHERE next <= 8
        UNION ALL SELECT 'round_1', sum(least(8, n))::BIGINT FROM (SELECT count(*) AS n FROM r WHERE next > 8 AND fit GROUP BY shard_id)""",
    "written_sample": f"""SELECT id, shard_id FROM (SELECT id, shard_id, row_number() OVER (PARTITION BY shard_id ORDER BY {_lot('id')}, id) AS place
        FROM (SELECT DISTINCT id, {_shard('id', 64)} AS shard_id FROM candidates WHERE id IS NOT NULL)) WHERE place <= 3""",
    "atoms_of_structures": """SELECT site_id, unnest(['older', 'newer']) AS format, serial::INTEGER AS serial, round(p[1], 3) AS x, round(p[2], 3) AS y, round(p[3], 3) AS z
        FROM (SELECT site_id, unnest(extent.points) AS p, generate_subscripts(extent.points, 1) AS serial FROM binding_sites WHERE extent.kind = 'point_cloud')""",
    "taken_places": "SELECT vec_no AS place, shard_id FROM features WHERE vec_no IN (SELECT row_no FROM selections)",
    "screen_threshold": """WITH r AS (SELECT affinity_kcal_mol AS v, row_number() OVER (ORDER BY affinity_kcal_mol) AS place, count(*) OVER () AS n FROM docking_results WHERE affinity_kcal_mol < 0)
        SELECT unnest([0, 1])::INTEGER AS time, v AS threshold FROM r WHERE place = floor((n - 1) * 0.025 + 0.5) + 1""",
    "rounds_so_far": """SELECT i::INTEGER AS round, (SELECT count(*) FROM selections s JOIN (SELECT DISTINCT batch_no, round_label FROM sample_specs) b USING (batch_no)
            WHERE b.round_label IN ('round_0', 'round_1', 'round_2') AND right(b.round_label, 1)::INTEGER <= i) AS rows FROM range(3) t(i)""",
    "model_scores": """SELECT vec_no, CASE WHEN len(list_filter(cns_mpo, lambda v: v IS NOT NULL AND isfinite(v))) = 5
            THEN round((1 / (1 + exp(-(cns_mpo[5]::DOUBLE - 0.5 * cns_mpo[2]::DOUBLE))))::FLOAT::DOUBLE, 3) END AS score FROM features WHERE len(cns_mpo) = 5 AND cns_mpo_valid""",
    "docking_statuses": r"""SELECT status, sum(n)::BIGINT AS rows FROM (SELECT CASE WHEN NOT coalesce(regexp_matches(smiles, '\p{L}'), false) THEN 'skipped' WHEN contains(smiles, 'B') THEN 'quarantined' ELSE 'docked' END AS status,
            CASE WHEN coalesce(regexp_matches(smiles, '\p{L}'), false) AND NOT contains(smiles, 'B') THEN 2 ELSE 1 END AS n FROM candidates) GROUP BY status""",
}
