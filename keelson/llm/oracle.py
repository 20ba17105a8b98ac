"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

_CONTROLS = r"([<\[])(\\*)(s>|/s>|SYS\]|INST\]|/INST\]|ROLE\]|/ROLE\])"



def _merkle_sql(heights: int = 8, tops: int = 3) -> str:
    """Trees of up to 8 ** heights rows a group and 8 ** tops groups, level by level."""
    level = """
{n}{h} AS (SELECT {tree}, rank // 8 AS rank, (any_value(size) + 7) // 8 AS size,
            CASE WHEN any_value(size) = 1 THEN min(digest)
                 ELSE sha256(string_agg(digest, '' ORDER BY rank)) END AS digest
     FROM {n}{g} GROUP BY {tree}, rank // 8),
{s}{g} AS (SELECT {tree}, rank, size,
            coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING
                                                  AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING
                                                  AND UNBOUNDED FOLLOWING), '') AS r
     FROM {n}{g} WINDOW run AS (PARTITION BY {tree}, rank // 8 ORDER BY rank)),"""
    fold = """
{p}{h} AS (SELECT p.* REPLACE (CASE WHEN s.size = 1 THEN folded
                               ELSE sha256(s.l || folded || s.r) END AS folded,
                               proof || s.l || s.r AS proof)
     FROM {p}{g} p JOIN {s}{g} s ON s.rank = p.{rank} // {step}{on}),"""
    part = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"
    head = " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = part.format(f"translate(text, '{upper}', '{upper.lower()}')")
    return f"""
WITH RECURSIVE bits(v, c, k) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1
  FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, lang, sha256({head} || {part.format('text')}) AS leaf, sha256({head} || {low}) AS forged,
      xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
        lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1])), 4294967295) AS crc
      FROM documents, crc_table),
g AS (SELECT *, row_number() OVER w - 1 AS rank, count(*) OVER (PARTITION BY lang) AS size,
      dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
      FROM d WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)),
n0 AS (SELECT tree, rank, size, leaf AS digest FROM g),""" + "".join(
        level.format(n="n", s="s", tree="tree", g=h, h=h + 1) for h in range(heights)) + f"""
m0 AS (SELECT 0 AS one, tree AS rank, count(*) OVER () AS size, digest FROM n{heights}),""" + "".join(
        level.format(n="m", s="u", tree="one", g=h, h=h + 1) for h in range(tops)) + """
p0 AS (SELECT *, CASE WHEN crc % 3 = 0 THEN forged ELSE leaf END AS folded, '' AS proof
       FROM g),""" + "".join(
        fold.format(p="p", s="s", g=h, h=h + 1, rank="rank", step=8 ** h, on=" AND s.tree = p.tree")
        for h in range(heights)) + f"""
q0 AS (SELECT * FROM p{heights}),""" + "".join(
        fold.format(p="q", s="u", g=h, h=h + 1, rank="tree", step=8 ** h, on="")
        for h in range(tops)) + f"""
z AS (SELECT digest AS root FROM m{tops})
SELECT doc_id, leaf, m0.digest AS subroot, root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = root AS verified
FROM q{tops} q JOIN m0 ON m0.rank = q.tree, z
"""


SQL: dict[str, str] = {
    "op11_hard_negatives": """
WITH v AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS a, v.id, a.label = v.label AS same,
             list_inner_product(a.e, v.e)::BIGINT AS score
      FROM v a JOIN v ON a.id <> v.id WHERE a.id % 50 = 0),
p AS (SELECT a, id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= 5)
SELECT p.a AS anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.a, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same
 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
""",
    "op13_merkle_manifest": _merkle_sql(),
    "op2_mix_sources": r"""
WITH d AS (SELECT doc_id, source, md5(doc_id::VARCHAR || ':20') AS key,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
      FROM d GROUP BY source),
l AS (SELECT *, 3 * source_size AS cap, 3 * source_size / weight AS level FROM s),
w AS (SELECT *, (sum(source_size) OVER ()
                 - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))
             AS share
      FROM l WINDOW b AS (ORDER BY level, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN level >= share
             THEN max(CASE WHEN level >= share THEN share END) OVER () * weight
             ELSE cap::DOUBLE END AS target FROM w),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
             (coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (budget // greatest(source_size, 1)) + greatest(0, least(size,
        budget % greatest(source_size, 1) - ahead)))::BIGINT AS taken
FROM r
""",
    "op5_chat_format": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, lag(role, 1, '^') OVER w AS before, row_number() OVER w AS place,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
s AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
             coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS trained,
             sum(length(regexp_replace(text, '{_CONTROLS}', '\1\2\\\3', 'g'))
                 + 4 + CASE role WHEN 'system' THEN 9 WHEN 'user' THEN 10 WHEN 'assistant' THEN 8
                       ELSE 14 + length(regexp_replace(role, '{_CONTROLS}', '\1\2\\\3', 'g')) END
             ) AS formatted_chars,
             bool_and(CASE before WHEN '^' THEN role IN ('system', 'user')
                                  WHEN 'system' THEN role = 'user' AND place = 2
                                  WHEN 'user' THEN role = 'assistant'
                                  WHEN 'assistant' THEN role = 'user' ELSE false END)
             AND bool_or(back = 1 AND role = 'assistant') AS valid
      FROM p GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(trained) AS loss_chars,
       sha256(trained) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars, valid
FROM s
""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op8_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x,
         generate_subscripts(string_split(text, chr(10)), 1) AS line
  FROM documents WHERE text IS NOT NULL),
content AS (
  SELECT doc_id, x, line, row_number() OVER d AS c,
         x || chr(10) || lead(x, 1) OVER d || chr(10) || lead(x, 2) OVER d AS run
  FROM lines WHERE trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''
  WINDOW d AS (PARTITION BY doc_id ORDER BY line)),
first AS (
  SELECT doc_id, c, row_number() OVER (PARTITION BY run ORDER BY doc_id, c) AS place
  FROM content WHERE run IS NOT NULL),
long AS (
  SELECT doc_id, c, row_number() OVER (PARTITION BY x ORDER BY doc_id, c) AS place
  FROM content WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) > 50),
gone AS (
  SELECT doc_id, c + k AS c FROM first, (SELECT unnest([0, 1, 2]) AS k) WHERE place > 1
  UNION SELECT doc_id, c FROM long WHERE place > 1),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.c) AS n_removed,
         coalesce(string_agg(l.x, chr(10) ORDER BY l.line) FILTER (g.c IS NULL), '') AS rest
  FROM lines l LEFT JOIN content c ON c.doc_id = l.doc_id AND c.line = l.line
  LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.c = c.c GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
""",
}
