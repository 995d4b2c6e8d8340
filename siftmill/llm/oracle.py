"""SQL that gives the same rows as the pN_ queries, where SQL can express them."""

_COUNTING = """
    SELECT id, member_id, site_id, mode, affinity_kcal_mol, min(pose_no) AS pose_no
    FROM docking_results
    WHERE affinity_kcal_mol < 0 AND NOT isnan(affinity_kcal_mol)
    GROUP BY id, member_id, site_id, mode, affinity_kcal_mol, rmsd_lb, rmsd_ub, pose_pdbqt, docked_at
"""

_COPIES = r"""
    SELECT row_no, min(row_no) OVER w AS first_row_no, count(*) OVER w AS copies FROM (
        SELECT row_no,
               lower(regexp_replace(CASE WHEN turned THEN id ELSE smiles END, '[^0-9A-Za-z()\[\]=#+\-@/\\.:%*$~]', '', 'g')) AS s,
               lower(regexp_replace(CASE WHEN turned THEN smiles ELSE id END, '[^0-9A-Za-z]', '', 'g')) AS i
        FROM (SELECT *, regexp_full_match(lower(regexp_replace(smiles, '[^0-9A-Za-z]', '', 'g')), 'lyq[0-9a-z]{16}')
                        AND NOT regexp_full_match(lower(regexp_replace(id, '[^0-9A-Za-z]', '', 'g')), 'lyq[0-9a-z]{16}') AS turned
              FROM candidates WHERE smiles IS NOT NULL AND id IS NOT NULL))
    WHERE s <> '' AND i <> ''
    WINDOW w AS (PARTITION BY s, i)
"""

_CUTS = f"""
    SELECT c.member_id, c.site_id, g.permille, min(c.affinity_kcal_mol) AS cutoff, min(c.below) AS kept, any_value(c.total) AS total
    FROM (SELECT member_id, site_id, affinity_kcal_mol, sum(n) OVER (PARTITION BY member_id, site_id ORDER BY affinity_kcal_mol)::BIGINT AS below,
                 sum(n) OVER (PARTITION BY member_id, site_id)::BIGINT AS total
          FROM (SELECT member_id, site_id, affinity_kcal_mol, count(*) AS n FROM ({_COUNTING}) GROUP BY ALL)) c
    JOIN (SELECT member_id, site_id, max(keep_permille)::BIGINT AS permille FROM cutoff_targets WHERE keep_permille IS NOT NULL GROUP BY ALL) g
      ON c.member_id = g.member_id AND c.site_id = g.site_id
    WHERE c.below * 1000 >= g.permille * c.total
    GROUP BY c.member_id, c.site_id, g.permille
"""

#: Rows of new batches one after the other: each is accepted unless an accepted row that it may look at is equal or one edit away.
_REPEATS = r"""
    WITH RECURSIVE entry AS (
        SELECT batch_no, regexp_replace(e, '^[\s\x{A0}\x{200B}\x{3000}]+|[\s\x{A0}\x{200B}\x{3000}]+$', '', 'g') AS e
        FROM (SELECT batch_no, unnest(exclude_inputs) AS e FROM sample_specs WHERE status = 'new')),
    rule AS (
        SELECT batch_no, rtrim(e, '/') AS folder, e AS file, regexp_matches(e, '[*?]') AS wild,
               replace(replace(regexp_replace(e, '([\\.^$|()\[\]{}+])', '\\\1', 'g'), '*', '[^/]*'), '?', '[^/]') AS pattern
        FROM entry WHERE e <> ''),
    named AS (
        SELECT DISTINCT r.batch_no, p.path FROM rule r, (SELECT DISTINCT path FROM selections WHERE path IS NOT NULL) p
        WHERE CASE WHEN r.wild THEN regexp_full_match(p.path, r.pattern)
                   ELSE p.path = r.file OR (contains(p.path, '/') AND regexp_replace(p.path, '/[^/]*$', '') = r.folder) END),
    held AS (
        SELECT row_no, batch_no, path, status, lower(regexp_replace(id, '[^0-9A-Za-z]', '', 'g')) AS k
        FROM selections JOIN (SELECT DISTINCT batch_no, status FROM sample_specs WHERE status IN ('accepted', 'new')) USING (batch_no) WHERE id IS NOT NULL),
    link AS MATERIALIZED (
        SELECT n.row_no, n.batch_no, o.row_no AS there, o.status
        FROM held n JOIN held o ON n.status = 'new' AND n.row_no <> o.row_no AND abs(length(n.k) - length(o.k)) <= 1 AND damerau_levenshtein(n.k, o.k) <= 1
        WHERE (o.batch_no = n.batch_no AND o.row_no < n.row_no)
           OR ((o.status = 'accepted' OR o.batch_no < n.batch_no) AND EXISTS (SELECT 1 FROM named f WHERE f.batch_no = n.batch_no AND f.path = o.path))),
    old AS MATERIALIZED (SELECT row_no, min(there) AS there FROM link WHERE status = 'accepted' GROUP BY row_no),
    open AS MATERIALIZED (
        SELECT row_no, list(there) AS there, row_number() OVER (ORDER BY batch_no, row_no) AS n
        FROM link WHERE status = 'new' AND row_no NOT IN (SELECT row_no FROM old) GROUP BY batch_no, row_no),
    out AS MATERIALIZED (SELECT list(row_no) AS rows FROM old),
    step AS (
        SELECT 0::BIGINT AS n, coalesce((SELECT rows FROM out), []::BIGINT[]) AS refused
        UNION ALL
        SELECT o.n, CASE WHEN len(list_filter(o.there, lambda x: NOT list_contains(s.refused, x))) > 0 THEN list_append(s.refused, o.row_no) ELSE s.refused END
        FROM step s JOIN open o ON o.n = s.n + 1),
    final AS (SELECT refused FROM step ORDER BY n DESC LIMIT 1),
    hit AS (SELECT row_no, there FROM old UNION ALL SELECT row_no, there FROM link WHERE status = 'new' AND NOT list_contains((SELECT refused FROM final), there))
    SELECT min(there) AS accepted_row_no, row_no FROM hit GROUP BY row_no
"""

ORACLE: dict[str, str] = {
    "p1_found": """WITH v AS (SELECT vec_no, usrcat::DOUBLE[] AS x FROM features WHERE usrcat_valid AND len(usrcat) = 60
            AND len(list_filter(usrcat, lambda e: e IS NOT NULL AND isfinite(e))) = 60),
        near AS (SELECT a.vec_no AS a, b.vec_no AS b, row_number() OVER (PARTITION BY a.vec_no ORDER BY list_distance(a.x, b.x), b.vec_no) AS place
            FROM v a JOIN v b ON a.vec_no <> b.vec_no)
        SELECT DISTINCT least(a, b) AS vec_no_a, greatest(a, b) AS vec_no_b FROM near WHERE place <= 5""",
    "p3_found": f"SELECT first_row_no, row_no FROM ({_COPIES}) WHERE row_no <> first_row_no",
    "p3_records": f"SELECT DISTINCT first_row_no, copies FROM ({_COPIES}) WHERE copies > 1",
    "p4_found": _REPEATS,
    "p5_found": f"SELECT r.pose_no FROM ({_COUNTING}) r JOIN ({_CUTS}) c ON r.member_id = c.member_id AND r.site_id = c.site_id WHERE r.affinity_kcal_mol <= c.cutoff",
    "p5_cutoffs": _CUTS,
    "p6_found": f"""SELECT pose_no FROM (SELECT pose_no, row_number() OVER (PARTITION BY id
        ORDER BY affinity_kcal_mol, site_id NULLS FIRST, mode NULLS FIRST, pose_no) AS rank FROM ({_COUNTING})) WHERE rank <= 3""",
    "p8_goals": r"""WITH t AS (SELECT source, max(target_share) AS target_share, min(coalesce(max_repeats, 1))::BIGINT AS max_repeats FROM mix_targets
            WHERE target_share > 0 AND source IS NOT NULL GROUP BY source),
        f AS (SELECT *, max_repeats >= 1 AND source IN (SELECT source FROM documents WHERE regexp_matches(text, '\S') AND source IS NOT NULL) AS fit FROM t)
        SELECT source, target_share, max_repeats, round(CASE WHEN fit THEN target_share / sum(target_share) FILTER (fit) OVER () ELSE 0 END, 9) AS share FROM f""",
}
