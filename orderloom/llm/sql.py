"""The queries that SQL can express, as SQL over the test tables."""

from __future__ import annotations

OP2 = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
           FROM embeddings),
     s AS (SELECT q.vec_id AS query_id, c.vec_id,
                  CAST(list_sum([CAST(a[1] * a[2] AS BIGINT) FOR a IN list_zip(q.e, c.e)])
                       AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM s) WHERE rank <= 20"""

OP5 = """
WITH m AS (
  SELECT DISTINCT conv_id, turn,
         CASE WHEN length(n) > 0 THEN n ELSE 'unknown' END AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM (SELECT *, trim(regexp_replace(replace(role, '<|', '< |'), '[\\x00-\\x20]+', ' ', 'g')) AS n
        FROM conversations)),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'),
o AS (SELECT *, CAST(floor(turn / 64.0) AS BIGINT) AS block, substr(text, 1, 256) AS head,
             md5(text) AS digest FROM m),
k AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, block
               ORDER BY turn NULLS LAST, speaker, head, digest) - 1) // 512 AS slice FROM o),
r AS (SELECT k.conv_id, perspective, block, slice, turn, speaker, head, digest, text,
             speaker = perspective AS mine,
             '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant'
               WHEN speaker = 'system' THEN speaker ELSE 'user name=' || speaker END
               || chr(10) AS header
      FROM k JOIN p ON k.conv_id IS NOT DISTINCT FROM p.conv_id),
l AS (SELECT *, length(header) + length(text) + 11 AS size, sum(length(header) + length(text) + 11)
               OVER (PARTITION BY conv_id, perspective, block, slice
                     ORDER BY turn NULLS LAST, speaker, head, digest
                     ROWS UNBOUNDED PRECEDING) AS upto FROM r)
SELECT conv_id, perspective, block, slice, count(*) AS n_messages,
       string_agg(header || text || '<|im_end|>' || chr(10), ''
                  ORDER BY turn NULLS LAST, speaker, head, digest) AS text,
       coalesce(string_agg(CAST(upto - size + length(header) AS VARCHAR) || '-' ||
                           CAST(upto AS VARCHAR), ','
                           ORDER BY turn NULLS LAST, speaker, head, digest)
                FILTER (WHERE mine), '') AS mask
FROM l GROUP BY conv_id, perspective, block, slice"""

OP7 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, i, string_split(text, chr(10))[i] AS line
      FROM (SELECT r, source, text,
                   unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS t FROM l),
pages AS (SELECT source, count(*) AS n FROM d GROUP BY source),
bad AS (SELECT k.source, t FROM k JOIN pages ON k.source IS NOT DISTINCT FROM pages.source
        WHERE t <> '' GROUP BY k.source, t, n
        HAVING count(DISTINCT r) >= 2 AND count(DISTINCT r) > n * CAST(0.02 AS DOUBLE)),
c AS (SELECT r, count(*) AS n_lines, count(bad.t) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE bad.t IS NULL), '') AS text
      FROM k LEFT JOIN bad ON k.t = bad.t AND k.source IS NOT DISTINCT FROM bad.source GROUP BY r)
SELECT doc_id, source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, c.text
FROM d LEFT JOIN c USING (r)"""

_WORDS = """[w FOR w IN regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')]"""

OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1],
               ' ') AS s
        FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b
              WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes
             WHERE len(w) >= n)),
hit AS (SELECT r, i, occ.n, item FROM occ JOIN win ON occ.s = win.s AND occ.n = win.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit
          FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit))
          GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r),
marked AS (SELECT r, p, p - row_number() OVER (PARTITION BY r ORDER BY p) AS run
           FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hit)),
spans AS (SELECT r, string_agg(CAST(s AS VARCHAR) || '-' || CAST(e AS VARCHAR), ',' ORDER BY s) AS x
          FROM (SELECT r, min(p) - 1 AS s, max(p) AS e FROM marked GROUP BY r, run) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated, coalesce(x, '') AS hit_spans
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r) LEFT JOIN spans USING (r)"""



def _rounds(last: int) -> str:
    """After round r: c{r}, the codebooks, and before it a{r}, each part's nearest entry."""
    steps = []
    for r in range(last + 1):
        steps.append(f"""
d{r} AS (SELECT r, part, entry, sum((x - y) * (x - y)) AS d FROM p JOIN c{r} USING (part, pos)
        GROUP BY r, part, entry),
a{r} AS MATERIALIZED (SELECT r, part, entry, d FROM (SELECT *, row_number() OVER (
        PARTITION BY r, part ORDER BY d, entry) AS k FROM d{r}) WHERE k = 1)""")
        if r < last:
            steps.append(f"""
m{r} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM p JOIN a{r} USING (r, part)
        GROUP BY part, entry, pos),
c{r + 1} AS MATERIALIZED (SELECT part, entry, pos, CASE WHEN n IS NULL THEN y
        ELSE (s - ((s % n) + n) % n) // n END AS y FROM c{r} LEFT JOIN m{r} USING (part, entry, pos))""")
    return ",".join(steps)


OP11 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
         [CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
w AS (SELECT CAST(greatest(1, ceil(max(len(e)) / 8)) AS BIGINT) AS size FROM v),
p AS MATERIALIZED (SELECT r, i // size AS part, i % size AS pos, coalesce(e[i + 1], 0) AS x
  FROM (SELECT r, e, size, unnest(range(0, 8 * size)) AS i FROM v, w)),
f AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS entry
  FROM (SELECT vec_id, arg_min(r, e) AS r FROM v GROUP BY vec_id)),
c0 AS MATERIALIZED (SELECT part, entry, pos, x AS y FROM p JOIN f USING (r) WHERE entry < 16),
{_rounds(6)},
codes AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d) AS error
          FROM a6 GROUP BY r)
SELECT vec_id, code, CAST(error AS BIGINT) AS error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c6)
         AS codebooks_sha256
FROM v JOIN codes USING (r)"""

OP13 = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w
  FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS i FROM d
        WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
met AS (SELECT a.r AS u, b.r AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r),
links AS MATERIALIZED (SELECT u, v FROM met JOIN n x ON x.r = u JOIN n y ON y.r = v
  WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach AS (SELECT r AS u, r AS v FROM d
  UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least_id AS (SELECT u, min(doc_id) AS component_id FROM reach JOIN d ON reach.v = d.r GROUP BY u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (r) JOIN least_id ON least_id.u = d.r"""

ALL: dict[str, str] = {
    "op2_exact_top_k": OP2,
    "op5_chat_perspectives": OP5,
    "op7_line_dedup": OP7,
    "op9_benchmark_decontamination": OP9,
    "op11_vector_codes": OP11,
    "op13_ngram_jaccard_join": OP13,
}
