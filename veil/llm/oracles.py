"""DuckDB SQL of the spelling variants and of the Merkle manifest, written without their code."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a SQL text, four bits at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    digits = f"hex(encode({text}))"
    nibbles = f"list_transform(range(0, strlen({digits})), lambda i: CAST(strpos('0123456789ABCDEF', substr({digits}, xor(CAST(i AS INT), 1) + 1, 1)) - 1 AS BIGINT))"
    step = f"xor(list_extract({table}::BIGINT[], CAST((xor(c, x) & 15) + 1 AS INT)), c >> 4)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), lambda c, x: {step}), 4294967295::BIGINT)"


VARIANTS = f"""
    WITH RECURSIVE cut AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
      FROM documents),
    hashed AS (SELECT run, {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM cut WHERE length(run) >= 5),
    typed AS (
      SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word
      FROM hashed),
    words AS MATERIALIZED (SELECT word, count(*) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
    without AS MATERIALIZED (
      SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM words)),
    near AS MATERIALIZED (
      SELECT a.word, b.word AS other, b.n AS m FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word AND length(a.word) = length(b.word)
      UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word),
    best AS (
      SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, struct_pack(a := -m, b := encode(other))) AS other FROM near GROUP BY word),
    forms AS MATERIALIZED (
      SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
      FROM words w LEFT JOIN best b ON w.word = b.word),
    chain(word, root) AS (
      SELECT word, word FROM forms
      UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
    SELECT f.*, c.root FROM forms f JOIN chain c ON f.word = c.word JOIN forms e ON e.word = c.root WHERE e.form IS NULL"""


def _leaf(n_chars: str) -> str:
    def field(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


def _tree(name: str, rows: str) -> str:
    """CTEs of a tree over ``rows`` (grp, i, h): its nodes, its root, and the steps of every leaf."""
    return f"""
    {name}_node(grp, lvl, i, h, alone) AS (
      SELECT grp, 0, i, h, count(*) OVER (PARTITION BY grp) = 1 FROM {rows}
      UNION ALL
      SELECT grp, lvl, i, h, count(*) OVER (PARTITION BY grp) = 1 FROM (
        SELECT grp, lvl + 1 AS lvl, i // 2 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}_node WHERE NOT alone GROUP BY grp, lvl, i // 2)),
    {name}_all AS MATERIALIZED (SELECT * FROM {name}_node),
    {name}_root AS (SELECT grp, h FROM {name}_all WHERE alone),
    {name}_step AS (
      SELECT r.grp, r.i, list(CASE WHEN s.h IS NULL THEN '-' WHEN (r.i >> t.lvl) % 2 = 1 THEN '<' || s.h ELSE '>' || s.h END ORDER BY t.lvl) AS steps
      FROM {rows} r JOIN (SELECT DISTINCT grp, lvl FROM {name}_all WHERE NOT alone) t ON r.grp = t.grp
      LEFT JOIN {name}_all s ON s.grp = r.grp AND s.lvl = t.lvl AND s.i = xor(r.i >> t.lvl, 1)
      GROUP BY r.grp, r.i)"""


MERKLE = f"""
    WITH RECURSIVE leaf AS MATERIALIZED (
      SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf("n_chars")} AS h,
             {_leaf(f"n_chars + CAST({crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 AS INT)")} AS changed FROM documents),
    leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM leaf),
    {_tree("low", "leaves")},
    tops AS MATERIALIZED (SELECT '' AS grp, row_number() OVER (ORDER BY encode(grp)) - 1 AS i, h, grp AS own FROM low_root),
    {_tree("top", "tops")},
    proof AS (
      SELECT l.doc_id, l.h AS leaf, l.changed, t.h AS subroot, (SELECT h FROM top_root) AS root,
             list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
      FROM leaves l JOIN tops t ON t.own = l.grp
      LEFT JOIN low_step a ON a.grp = l.grp AND a.i = l.i LEFT JOIN top_step b ON b.i = t.i),
    folded AS (
      SELECT *, list_reduce(list_prepend(changed, steps), lambda a, s: sha256(
        CASE substr(s, 1, 1) WHEN '<' THEN substr(s, 2) || a WHEN '>' THEN a || substr(s, 2) ELSE a END)) AS folded_root FROM proof)
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: substr(s, 2)), '')) AS proof_sha256,
           folded_root, folded_root = root AS verified FROM folded"""
