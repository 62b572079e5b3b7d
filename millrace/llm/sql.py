"""SQL that computes what the registered queries of this package return, where SQL can say it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from millrace.llm import licences

#: Whole numbers of SQL's integer division are cut towards zero; means are to go down.
_FLOOR = "(s - ((s % n) + n) % n) // n"


def codes(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Codebooks of every part, for vectors of one length, ``parts`` times some number."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        far{i} AS (
          SELECT p.vec_id, p.part, b.entry,
                 list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM parts p JOIN book{i} b ON b.part = p.part),
        own{i} AS (SELECT vec_id, part, min({{'d': d, 'e': entry}}) AS b FROM far{i} GROUP BY 1, 2)""")
        if i < rounds:
            steps.append(f"""
        mean{i} AS (
          SELECT part, entry, list({_FLOOR} ORDER BY k) AS v
          FROM (SELECT p.part, o.b.e AS entry, u.k, sum(p.v[u.k])::BIGINT AS s, count(*) AS n
                FROM own{i} o JOIN parts p ON p.vec_id = o.vec_id AND p.part = o.part, unnest(range(1, len(p.v) + 1)) AS u(k)
                GROUP BY 1, 2, 3)
          GROUP BY 1, 2),
        book{i + 1} AS (
          SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN mean{i} m ON m.part = b.part AND m.entry = b.entry)""")
    return f"""
      WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      parts AS (
        SELECT vec_id, j AS part, v[j * len(v) // {parts} + 1:(j + 1) * len(v) // {parts}] AS v
        FROM kept, unnest(range({parts})) AS r(j)),
      book0 AS (
        SELECT p.part, f.entry, p.v
        FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}) f
        JOIN parts p ON p.vec_id = f.vec_id),
      {",".join(steps)},
      coded AS (
        SELECT k.vec_id, k.label, string_agg(lower(printf('%02x', o.b.e)), '' ORDER BY o.part) AS code, sum(o.b.d)::BIGINT AS error
        FROM own{rounds} o JOIN kept k ON k.vec_id = o.vec_id GROUP BY 1, 2),
      books AS (
        SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM book{rounds})
      SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
      FROM coded, books"""


def clusters(dim: int = 64, scale: int = 64, k: int = 16, rounds: int = 3) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        own{i} AS (
          SELECT vec_id, v, min({{'d': d, 'c': c}}) AS b
          FROM (SELECT x.vec_id, x.v, m.c,
                       list_sum(list_transform(list_zip(x.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                FROM kept x, centre{i} m)
          GROUP BY 1, 2)""")
        if i < rounds:
            steps.append(f"""
        mean{i} AS (
          SELECT c, list({_FLOOR} ORDER BY j) AS v
          FROM (SELECT o.b.c AS c, u.j, sum(o.v[u.j])::BIGINT AS s, count(*) AS n
                FROM own{i} o, unnest(range(1, {dim + 1})) AS u(j) GROUP BY 1, 2)
          GROUP BY 1),
        centre{i + 1} AS (SELECT a.c, coalesce(m.v, a.v) AS v FROM centre{i} a LEFT JOIN mean{i} m ON m.c = a.c)""")
    return f"""
      WITH kept AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      centre0 AS (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v FROM kept
        ORDER BY sha256('1:' || vec_id) LIMIT {k}),
      {",".join(steps)}
      SELECT o.vec_id, o.b.c::INTEGER AS cluster, o.b.d AS distance, sum(o.b.d) OVER (PARTITION BY o.b.c)::BIGINT AS cluster_inertia,
             sum(o.b.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
      FROM own{rounds} o JOIN centre{rounds} m ON m.c = o.b.c"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licence_scan(templates: Sequence[tuple[str, str]], phrases: Mapping[str, str]) -> str:
    """Templates as regular expressions over the words, each followed by a blank."""
    base = []
    for phrase, label in phrases.items():
        words = licences.words(phrase)
        there = " AND ".join(f"w[i + {n + 1}] = {_quoted(x.decode())}" for n, x in enumerate(words))
        base.append(f"list_transform(list_filter(range(len(w)), lambda i: {there}), lambda i: {{'place': i, 'label': {_quoted(label)}}})")
    found = [f"CASE WHEN regexp_matches(joined, {_quoted(' ' + licences.pattern(licences.parse(markup)))}) THEN {_quoted(label)} END"
             for label, markup in templates]
    distinct = "array_to_string(list_sort(list_distinct({})), ',')"
    return f"""
      WITH split AS (
        SELECT doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), ' ') AS w
        FROM documents),
      cut AS (SELECT doc_id, CASE WHEN w = [''] THEN [] ELSE w END AS w FROM split),
      named AS (
        SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS joined, flatten([{", ".join(base)}]) AS base FROM cut),
      kept AS (
        SELECT doc_id, w, base, list_transform(base, lambda b: b.place) AS place, list_transform(base, lambda b: b.label) AS own,
               list_filter([{", ".join(found)}], lambda x: x IS NOT NULL) AS found
        FROM named)
      SELECT doc_id, len(w)::BIGINT AS n_words, len(base)::BIGINT AS n_base, list_min(place)::BIGINT AS first_word,
             list_max(place)::BIGINT AS last_word, {distinct.format("own")} AS base_labels,
             {distinct.format("list_concat(own, found)")} AS labels,
             CASE WHEN len(found) > 0 THEN 1.0 WHEN len(own) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
      FROM kept"""


def mix(weights: Sequence[int], epochs: int, seed: int = 7, ranges: int = 1 << 12) -> str:
    """Sources in the order in which they fill up; documents in the order of their hash, by range first."""
    cycle = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
      WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
               md5(concat_ws(':', '{seed}', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS draw FROM documents),
      cut AS (SELECT *, ('0x' || left(draw, 8))::BIGINT % {ranges} AS range FROM sized),
      sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM cut GROUP BY 1),
      weighed AS (
        SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {cycle} END::BIGINT AS weight FROM sums),
      filling AS (
        SELECT *, {epochs} * source_size AS cap, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place FROM weighed),
      sharing AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
               (sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights FROM filling),
      levels AS (SELECT *, rest * weight / weights >= cap AS is_full, rest / weights AS level FROM sharing),
      plan AS (
        SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE weight * (SELECT arg_min(level, place) FROM levels WHERE NOT is_full) END AS target FROM levels),
      whole AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS times FROM plan),
      spare AS (SELECT *, target - times * source_size AS extra FROM whole),
      ran AS (SELECT source, range, sum(size)::BIGINT AS n FROM cut GROUP BY 1, 2),
      upto AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY range) AS upto FROM ran),
      ends AS (
        SELECT s.source, min(u.range) AS last FROM upto u JOIN spare s ON u.source IS NOT DISTINCT FROM s.source WHERE u.upto > s.extra GROUP BY 1),
      placed AS (
        SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY range, draw, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM cut)
      SELECT p.doc_id, p.size, s.source_size, s.target,
             p.size * (s.times + CASE WHEN e.last IS NULL OR p.range > e.last THEN 0 WHEN p.range < e.last THEN 1
                                      WHEN p.size > 0 AND p.before + p.size / 2 <= s.extra THEN 1 ELSE 0 END) AS taken
      FROM placed p JOIN spare s ON p.source IS NOT DISTINCT FROM s.source LEFT JOIN ends e ON e.source IS NOT DISTINCT FROM p.source"""
