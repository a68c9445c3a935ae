"""SQL that DuckDB runs over the same tables, for the queries SQL can express."""

from __future__ import annotations

from gaugeline.llm.curriculum import PASSES, SCHEDULES, SHARE, WEIGHTS
from gaugeline.llm.mean_search import CENTROIDS, COMPONENTS, ROUNDS, SCALE, SEED
from gaugeline.llm.prefix_trie import GROUP, SHARED
from gaugeline.llm.quality_rules import RULES, STOP_WORDS, WINDOW

_WORD = r"[^\x20\x09-\x0D]+"


def _rule(rule) -> str:
    per = rule.per or "1"
    below = f"{rule.measure} < {per} * {rule.low}::DOUBLE" if rule.low is not None else "false"
    above = f"{rule.measure} > {per} * {rule.high}::DOUBLE" if rule.high is not None else "false"
    return f"({below} OR {above})"


QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d
), windows AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS k
  FROM w, unnest(range(1, len(words) - {WINDOW - 2})) AS t(i) WHERE len(words) >= {WINDOW}
), places AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, k) > 1
), steps AS (
  SELECT r, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, {WINDOW})) AS n FROM places
), covered AS (
  SELECT r, sum(n) AS n FROM steps GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         (length(text) - length(replace(text, '!!', ''))) // 2 AS n_exclaimed,
         len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))}))) AS n_stop_words,
         len(lines) AS n_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipsis_lines
  FROM w LEFT JOIN covered USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR {" OR ".join(map(_rule, RULES))}) AS kept
FROM m
"""


def _moment(u: str, schedules) -> str:
    """For schedules of one straight span each."""
    cases = []
    for turn, schedule in enumerate(schedules):
        (_, w0), (_, w1) = schedule
        slope, area = w1 - w0, (w0 + w1) / 2
        rest = f"greatest({u} * {area}::DOUBLE - 0::DOUBLE, 0::DOUBLE)"
        if slope:
            step = f"(sqrt(greatest({w0 * w0}::DOUBLE + {2 * slope}::DOUBLE * {rest}, 0::DOUBLE)) - {w0}::DOUBLE) / {slope}::DOUBLE"
        else:
            step = f"{rest} / {w0}::DOUBLE"
        cases.append(f"WHEN {turn} THEN round(least(0::DOUBLE + {step}, 1::DOUBLE), 6)")
    return f"CASE WHEN {u} IS NOT NULL THEN CASE turn {' '.join(cases)} END END"


CURRICULUM = rf"""
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS o, hash(text) AS h FROM documents
), each AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS turn FROM s GROUP BY source
), weighed AS (
  SELECT *, {list(map(float, WEIGHTS))}[turn + 1]::DOUBLE AS weight, source_size * {PASSES}::DOUBLE AS room FROM each
), levels AS (
  SELECT *, greatest((sum(source_size) OVER ())::DOUBLE * {SHARE}::DOUBLE - coalesce(sum(room) OVER (
              ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
            / sum(weight) OVER (ORDER BY room / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), settled AS (
  SELECT *, first_value(CASE WHEN level * weight <= room THEN level END IGNORE NULLS) OVER (
              ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l FROM levels
), targets AS (
  SELECT source, turn, source_size, least(coalesce(l * weight, room), room) AS target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM settled
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.turn, t.source_size, t.target, t.passes, t.target - t.passes * t.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id, size, h
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), fitted AS (
  SELECT *, size > 0 AND start + size <= rest AS fits FROM placed
), summed AS (
  SELECT *, coalesce(sum(CASE WHEN fits THEN size END) OVER (PARTITION BY source), 0)::BIGINT AS got FROM fitted
), offered AS (
  SELECT *, CASE WHEN size > 0 AND NOT fits AND abs(size - (rest - got)) < rest - got
            THEN row_number() OVER (PARTITION BY source, size > 0 AND NOT fits ORDER BY abs(size - (rest - got)), start) = 1
            ELSE false END AS closes FROM summed
), ended AS (
  SELECT *, passes * source_size + got
         + coalesce(max(CASE WHEN closes THEN size END) OVER (PARTITION BY source), 0) AS everything FROM offered
), starts AS (
  SELECT *, list_filter([CASE WHEN size > 0 AND passes > 0 THEN start END,
                         CASE WHEN size > 0 AND passes > 1 THEN source_size + start END,
                         CASE WHEN fits THEN passes * source_size + start
                              WHEN closes THEN passes * source_size + got END], lambda x: x IS NOT NULL) AS begun FROM ended
), shares AS (
  SELECT *, (begun[1] + size / 2) / everything AS u1, (begun[2] + size / 2) / everything AS u2 FROM starts
)
SELECT doc_id, size, source_size, target, (len(begun) * size)::BIGINT AS taken,
       {_moment("u1", SCHEDULES)} AS first_position, {_moment("u2", SCHEDULES)} AS second_position
FROM shares
"""


def _rounds(rounds: int, centroids: int, size: int) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT r, vec_id, v, cluster, distance FROM (
    SELECT w.r, w.vec_id, w.v, c.cluster,
           list_sum(list_transform(list_zip(w.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM whole w, centroids{k} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1
)""")
        if k < rounds:
            steps.append(f"""centroids{k + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v FROM centroids{k} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
      SELECT cluster, i, sum(v[i]) AS s, count(*) AS n
      FROM near{k}, unnest(range(1, {size} + 1)) AS t(i) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster)
)""")
    return ",\n".join(steps)


CLUSTERING = f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}
), centroids0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::INTEGER AS cluster, v
  FROM whole QUALIFY cluster < {CENTROIDS}
), {_rounds(ROUNDS, CENTROIDS, COMPONENTS)}
SELECT vec_id, n.cluster, distance, (sum(distance) OVER (PARTITION BY n.cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near{ROUNDS} n JOIN centroids{ROUNDS} c ON n.cluster = c.cluster
"""

# crc32 is not built in: a step of eight bits at a time over the digits of an id.
_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"

PREFIX_TRIE = rf"""
WITH RECURSIVE crc(conv_id, rest, c, bits) AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR, 4294967295::BIGINT, 0 FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT conv_id, CASE WHEN bits = 0 THEN rest[2:] ELSE rest END,
         CASE WHEN bits = 0 THEN xor(c, ord(rest[1])::BIGINT) ELSE {_CRC_STEP} END, (bits + 1) % 9
  FROM crc WHERE bits > 0 OR rest <> ''
), shares AS (
  SELECT conv_id, xor(c, 4294967295) % {SHARED} AS h, conv_id - conv_id % {GROUP} AS base
  FROM crc WHERE bits = 0 AND rest = ''
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM (
    SELECT conv_id, turn, coalesce(text, '') AS text,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL)
), kept AS (
  SELECT s.conv_id, 0 AS own, t.place, t.digest, t.text FROM shares s JOIN turns t ON t.conv_id = s.base AND t.place <= s.h
  UNION ALL
  SELECT s.conv_id, 1, t.place, t.digest, t.text FROM shares s JOIN turns t ON t.conv_id = s.conv_id AND t.place > s.h
), rebuilt AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER (w ROWS UNBOUNDED PRECEDING) AS path,
         len(regexp_extract_all(text, '{_WORD}')) AS words
  FROM kept WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)
  UNION ALL SELECT conv_id, 0, '', 0 FROM shares
), members AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM rebuilt
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM members GROUP BY path
), parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.path AS above
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, (64 * (n.depth - 1))::INTEGER)
), children AS (
  SELECT above AS path, count(*) AS n_children FROM parents WHERE above IS NOT NULL GROUP BY above
), own AS (
  SELECT parents.*, coalesce(n_children, 0) AS n_children FROM parents LEFT JOIN children USING (path)
), below AS (
  SELECT left(u.path, (64 * d)::INTEGER) AS path, u.n_children, u.n_convs, u.words
  FROM own u, unnest(range(0, u.depth + 1)) AS t(d)
), totals AS (
  SELECT path, sum((n_children = 0)::INTEGER)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM below GROUP BY path
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM own JOIN totals USING (path)
"""

ORACLES = {
    "op6_curriculum_mix": CURRICULUM,
    "op8_quality_rules": QUALITY_RULES,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_mean_search_clustering": CLUSTERING,
}
