"""SQL of the queries over repeated words, licenses and centroids, written independently of the operators."""

from __future__ import annotations

# h = crc32 of the decimal id: a table of 256 steps, then a step per digit.
RUNS_SQL = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT i, c FROM bits WHERE k = 8),
digits(doc_id, s, k, c) AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR, 0, 4294967295 FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT d.doc_id, d.s, d.k + 1, xor(d.c >> 8, t.c)
  FROM digits d JOIN tab t ON t.i = (xor(d.c, ascii(d.s[d.k + 1])::BIGINT) & 255) WHERE d.k < len(d.s)),
hashed AS (SELECT doc_id, xor(c, 4294967295) AS h FROM digits WHERE k = len(s)),
split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sized AS (
  SELECT r, s.doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, h // 10 AS g
  FROM split s LEFT JOIN hashed USING (doc_id)),
placed AS (
  SELECT *, CASE WHEN planted THEN g % n END AS a, CASE WHEN planted THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sized),
given AS (
  SELECT r, doc_id, n,
         CASE WHEN planted THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE ws END AS ws
  FROM placed),
w AS (SELECT r, n, unnest(ws) AS word, unnest(range(n)) AS i FROM given),
same AS (SELECT x.r, y.i - x.i AS p, x.i FROM w x JOIN w y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
stretches AS (
  SELECT r, p, min(i) AS start, count(*) + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM same) GROUP BY r, p, island),
runs AS (SELECT r, start, length, min(p) AS period FROM stretches WHERE length >= greatest(6, 4 * p) GROUP BY r, start, length),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text
  FROM runs GROUP BY r),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY length / period::DOUBLE DESC, start, period) = 1),
kept AS (
  SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM w WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.r = w.r AND w.i >= runs.start + runs.period AND w.i < runs.start + runs.length)
  GROUP BY w.r)
SELECT g.doc_id, coalesce(n_runs, 0) AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       ((1000 * best.length) // best.period)::BIGINT AS exponent_milli,
       sha256(coalesce(listed.text, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM given g LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def _words(text: str) -> str:
    return "".join(f" {word} " for word in text.split())


def _maybe(*ways: str) -> str:
    return f"({'|'.join(ways)})?"


def _any(low: int, high: int) -> str:
    return f"( [^ ]+ ){{{low},{high}}}"


_HOLDER = _maybe(_words("copyright") + _any(1, 12))
_TERMS = _maybe(_words("terms of the"))
_FSF = _maybe(_words("as published by the free software foundation"))
_LATER = _maybe(_words("of the license")) + _maybe(_words("or at your option any later version"))
_GPL = (
    _maybe(_maybe(_words("this work is")) + _maybe(_words("licensed")) + _words("under the") + _TERMS)
    + _words("gnu general public license") + _FSF + _maybe(_words("either")) + _words("version")
)
_THIS = _maybe(_words("this") + _any(1, 3) + _words("is"))

#: Label and regular expression over words that each have a space on both sides.
_PATTERNS = [
    ("mit", _words("under the mit license")),
    ("apache-2", _words("apache license version 2")),
    ("cc-by-nc", _words("cc by nc")),
    ("mit", _maybe(_words("released"), _words("licensed")) + _words("under the terms of the mit license")),
    (
        "mit",
        _maybe(_words("the mit license") + _maybe(_words("mit"))) + _HOLDER
        + _words("permission is hereby granted free of charge to any person obtaining a copy of this") + _any(1, 6)
        + _words("and associated documentation files the software to deal in the software without restriction including without limitation")
        + _words("the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons")
        + _words("to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice")
        + _maybe(_words("including the next paragraph")) + _words("shall be included in all copies or substantial portions of the software")
        + _maybe(_words("the software is provided as is without warranty of any kind express or implied")),
    ),
    (
        "isc",
        _maybe(_words("isc license")) + _HOLDER
        + _words("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted")
        + _maybe(_words("provided that the above copyright notice and this permission notice appear in all copies")),
    ),
    (
        "bsd",
        _HOLDER + _words("redistribution and use in source and binary forms with or without modification are permitted")
        + _words("provided that the following conditions are met"),
    ),
    (
        "apache-2",
        _words("licensed under the apache license version 2 0")
        + _maybe(_words("the license") + _any(0, 20) + _words("compliance with the license")),
    ),
    ("gpl-2", _GPL + _words("2") + _LATER),
    ("gpl-3", _GPL + _words("3") + _LATER),
    ("lgpl", _maybe(_words("under the") + _TERMS) + _words("gnu lesser general public license") + _FSF),
    ("mpl-2", _words("subject to the terms of the mozilla public license v 2 0")),
    ("mpl-2", _words("mozilla public license version 2 0")),
    (
        "cc-by-nc",
        _maybe(_THIS + _words("licensed under") + _maybe(_words("a"), _words("the")) + _maybe(_words("creative commons")))
        + _words("cc by nc") + _any(0, 2),
    ),
    (
        "cc-by-nc",
        _THIS + _maybe(_words("licensed under a")) + _words("creative commons attribution noncommercial") + _any(0, 2)
        + _maybe(_words("international")) + _words("license"),
    ),
    ("cc-by", _words("creative commons attribution") + _any(0, 2) + _maybe(_words("international")) + _words("license")),
    ("unlicense", _words("this is free and unencumbered software released into the public domain")),
]

LICENSE_SQL = (
    r"""
WITH patterns(label, pattern) AS (VALUES """
    + ", ".join(f"('{label}', '({pattern})')" for label, pattern in _PATTERNS)
    + r"""),
phrases(label, words) AS (VALUES ('mit', ['under', 'the', 'mit', 'license']), ('apache-2', ['apache', 'license', 'version', '2']),
                                 ('cc-by-nc', ['cc', 'by', 'nc'])),
given AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
base AS (
  SELECT r, label, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1 : i + len(words)] = words)) AS start
  FROM given, phrases),
counted AS (
  SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY r),
spaced AS (SELECT r, len(ws) AS n, ' ' || array_to_string(ws, '  ') || ' ' AS line FROM given),
met AS (
  SELECT r, n, label, unnest(regexp_extract_all(line, pattern, 1)) AS place
  FROM spaced, patterns WHERE regexp_matches(line, 'license|licensed|permission|redistribution|unencumbered| cc ')),
labelled AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max((len(place) - len(replace(place, ' ', ''))) // 2 / n::DOUBLE) AS score
  FROM met GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0e0) AS score
FROM given LEFT JOIN counted USING (r) LEFT JOIN labelled USING (r)
"""
)


def centroid_sql(clusters: int, rounds: int) -> str:
    """Every round as tables: a (nearest centroid of each vector) and c (components of each centroid)."""

    def assigned(k: int) -> str:
        return f"""a{k} AS (
  SELECT r, best.j AS j, best.d AS d FROM (
    SELECT r, min({{'d': d, 'j': j}}) AS best
    FROM (SELECT x.r, c.j, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM parts x JOIN c{k} c USING (i) GROUP BY x.r, c.j) GROUP BY r))"""

    def moved(k: int) -> str:
        return f"""m{k} AS (
  SELECT a.j, x.i, sum(x.x) AS s, count(*) AS n FROM a{k - 1} a JOIN parts x USING (r) GROUP BY a.j, x.i),
c{k} AS (
  SELECT j, i, coalesce((m.s - (((m.s % m.n) + m.n) % m.n)) // m.n, c.x)::BIGINT AS x FROM c{k - 1} c LEFT JOIN m{k} m USING (j, i))"""

    steps = [assigned(0)]
    for k in range(1, rounds + 1):
        steps += [moved(k), assigned(k)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), embedding) - 1 AS r, vec_id, embedding AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, floor(256 * unnest(e)::DOUBLE)::BIGINT AS x FROM kept),
c0 AS (SELECT r AS j, i, x FROM parts WHERE r < {clusters}),
{", ".join(steps)},
named AS (SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j)
SELECT vec_id, a.j::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN named n ON n.j = a.j
""".replace("AS (\n", "AS MATERIALIZED (\n")
