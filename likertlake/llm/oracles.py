"""SQL for the queries whose results plain SQL can state; names as in ``queries``."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

REPEATS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
     win AS (SELECT r, p, array_to_string(w[p:p + 34], ' ') AS s
             FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
     many AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
     gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS q FROM win JOIN many USING (s)),
     each AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
     kept AS (SELECT r, count(gone.q) AS n, string_agg(x, ' ' ORDER BY q) FILTER (WHERE gone.q IS NULL) AS t
              FROM each LEFT JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS w FROM documents),
     i AS (SELECT item_id::VARCHAR AS item, w, least(13, len(w)) AS k
           FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0 AND item_id IS NOT NULL),
     known AS (SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS s
               FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM i)),
     win AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS s
             FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p
                   FROM d JOIN (SELECT DISTINCT k FROM known) ON len(w) >= k)),
     hit AS (SELECT r, k, p, item FROM win JOIN known USING (k, s)),
     covered AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(p, p + k)) FROM hit) GROUP BY r),
     found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS t
               FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(f.n, 0)::BIGINT AS n_items,
       sha256(coalesce(t, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)
"""

VECTORS = """
WITH RECURSIVE v AS (
       SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
       WHERE label IS NOT NULL AND len(embedding) > 0
         AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
         AND len([x FOR x IN embedding IF x <> 0]) > 0),
     link AS (
       SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
       WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.93),
     reach AS (
       SELECT a AS x, a AS y FROM (SELECT DISTINCT a FROM link)
       UNION SELECT x, b FROM reach JOIN link ON y = a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least(c, vec_id), vec_id) AS component_id,
       coalesce(least(c, vec_id), vec_id) = vec_id AS kept
FROM embeddings
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT x AS vec_id, min(y) AS c FROM reach GROUP BY x) USING (vec_id)
"""


_FIELD = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = lambda text: f"sha256({' || '.join(map(_FIELD, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
#: The checksum bit by bit: bits of the id's digits, lowest first, into a register of 32.
_CRC32 = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || flatten([[(ascii(x) >> k)::BIGINT & 1 FOR k IN range(8)] FOR x IN string_split(doc_id::VARCHAR, '')]),
    lambda c, b: xor(c >> 1, CASE WHEN c & 1 <> b THEN 3988292384 ELSE 0 END)))"""


def _manifest(group_levels: int = 8, top_levels: int = 4) -> str:
    """Both trees level by level; a tree of one node passes on as it is."""
    parts = [
        f"""d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, {_LEAF('text')} AS leaf,
              CASE WHEN {_CRC32} % 3 = 0 THEN {_LEAF(_LOWERED)} ELSE {_LEAF('text')} END AS new FROM documents)""",
        """n0 AS MATERIALIZED (SELECT lang AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, new) - 1 AS p,
              count(*) OVER (PARTITION BY lang) AS n, leaf AS h, r FROM d)""",
        "f0 AS MATERIALIZED (SELECT r, t, p, new AS h, '' AS proof FROM n0 JOIN d USING (r))",
    ]

    def level(k: int) -> list[str]:
        joined = f"FROM f{k} f JOIN n{k} c ON c.t IS NOT DISTINCT FROM f.t AND c.p // 8 = f.p // 8 GROUP BY f.r, f.t, f.p, f.h, f.proof"
        return [
            f"""n{k + 1} AS MATERIALIZED (SELECT t, p // 8 AS p, (max(n) + 7) // 8 AS n,
              CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE max(h) END AS h FROM n{k} GROUP BY t, p // 8)""",
            f"""f{k + 1} AS MATERIALIZED (SELECT f.r, f.t, f.p // 8 AS p,
              CASE WHEN max(c.n) > 1 THEN sha256(string_agg(CASE WHEN c.p = f.p THEN f.h ELSE c.h END, '' ORDER BY c.p)) ELSE f.h END AS h,
              f.proof || coalesce(string_agg(c.h, '' ORDER BY c.p) FILTER (WHERE c.p <> f.p), '') AS proof {joined})""",
        ]

    for k in range(group_levels):
        parts += level(k)
    g = group_levels
    parts += [
        f"s AS MATERIALIZED (SELECT t AS lang, h AS subroot, row_number() OVER (ORDER BY t NULLS FIRST) - 1 AS q FROM n{g})",
        f"n{g + 1} AS MATERIALIZED (SELECT 0 AS t, q AS p, count(*) OVER () AS n, subroot AS h FROM s)",
        f"f{g + 1} AS MATERIALIZED (SELECT r, 0 AS t, q AS p, h, proof FROM f{g} JOIN s ON t IS NOT DISTINCT FROM lang)",
    ]
    for k in range(g + 1, g + 1 + top_levels):
        parts += level(k)
    last = g + 1 + top_levels
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, e.h AS root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = e.h AS verified
FROM d JOIN s ON d.lang IS NOT DISTINCT FROM s.lang JOIN f{last} f USING (r) CROSS JOIN n{last} e"""


FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
     h AS (SELECT *, len(u) AS n, [('0x' || x[k:k + 7])::BIGINT FOR k IN [1, 9, 17, 25]] AS v FROM d),
     c AS (SELECT *, least(v[1] % (n + 1), v[2] % (n + 1)) AS a, greatest(v[1] % (n + 1), v[2] % (n + 1)) AS b,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR v[3] % 100 >= 100 THEN 'plain'
                       WHEN v[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
     p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def all_oracles() -> dict[str, str]:
    return {
        "op6_repeated_substrings": REPEATS,
        "op8_decontamination": CONTAMINATION,
        "op10_vector_duplicates": VECTORS,
        "op11_dataset_manifest": _manifest(),
        "op12_fill_in_middle": FILL_IN_MIDDLE,
    }
