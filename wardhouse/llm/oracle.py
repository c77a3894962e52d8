"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from wardhouse.llm import licenses


def _clusters(size: int, k: int, rounds: int) -> str:
    """Rounds of assignment and means, one after the other."""
    steps = [
        f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster, v AS c
            FROM (SELECT * FROM v ORDER BY sha256('3:' || vec_id) LIMIT {k}))""",
    ]
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT vec_id, v, unnest(min(struct_pack(distance := CAST({distance} AS BIGINT), cluster := cluster)))
            FROM v, c{n} GROUP BY vec_id, v)""")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT cluster, dim, sum(x) AS total, count(*) AS n
                FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, {size + 1})) AS dim FROM a{n}) GROUP BY cluster, dim)""")
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(moved, c) AS c FROM c{n} LEFT JOIN (
                SELECT cluster, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS moved FROM m{n} GROUP BY cluster) USING (cluster))""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
            CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
            CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (cluster)"""


def _licenses() -> str:
    """Phrases and templates as words; grams joined to grams, votes by diagonal, diagonals by their distance."""
    words = lambda text: [w for w in re.split(licenses.SEPARATORS, text.lower()) if w]
    listed = lambda pairs: ", ".join(f"('{label}', {n}, [{', '.join(repr(w) for w in words(text))}])" for n, (label, text) in enumerate(pairs))
    grams = lambda source, k: f"""SELECT *, array_to_string(words[i + 1:i + {k}], ' ') AS gram
        FROM (SELECT *, unnest(range(greatest(len(words) - {k - 1}, 0))) AS i FROM {source})"""  # noqa: E731
    short, long = licenses.PHRASE_GRAM, licenses.TEMPLATE_GRAM
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
      phrases(label, phrase, words) AS (VALUES {listed([(v, p) for p, v in licenses.PHRASES.items()])}),
      templates(label, template, words) AS (VALUES {listed(licenses.TEMPLATES)}),
      pg AS (SELECT *, len(words) - {short - 1} AS grams FROM ({grams('phrases', short)})),
      tg AS (SELECT *, len(words) - {long - 1} AS grams FROM ({grams('templates', long)})),
      base AS (SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, list(DISTINCT label ORDER BY label) AS labels
        FROM (SELECT g.doc_id, p.phrase, p.label, g.i - p.i AS diagonal, any_value(p.grams) AS grams, count(*) AS votes
          FROM ({grams('d', short)}) g JOIN pg p USING (gram) GROUP BY ALL) WHERE votes = grams GROUP BY doc_id),
      hits AS (SELECT g.doc_id, t.template, t.label, t.grams, t.i AS place, g.i AS pos, g.i - t.i AS diagonal FROM ({grams('d', long)}) g JOIN tg t USING (gram)),
      steps AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {licenses.NEIGHBOUR_WORDS}, true) AS starts FROM hits),
      spans AS (SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY doc_id, template ORDER BY diagonal RANGE UNBOUNDED PRECEDING) AS span FROM steps),
      shares AS (SELECT doc_id, label, any_value(grams) AS grams, CASE WHEN max(pos) - min(pos) < 2 * any_value(grams) THEN count(DISTINCT place) / any_value(grams) ELSE 0 END AS share
        FROM spans GROUP BY doc_id, template, label, span),
      found AS (SELECT doc_id, max(share) AS share, list(DISTINCT label) FILTER (share >= CASE WHEN grams < {licenses.SHORT_GRAMS} THEN 1 ELSE {licenses.COVERAGE} END) AS labels
        FROM shares GROUP BY doc_id)
      SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
        array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
        CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
      FROM d LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)"""


TEXTS = {
    "op6_license_scan": _licenses(),
    "op3_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents
        ), g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM t JOIN g USING (body)
    """,
    "op11_warc": """
        WITH t AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        r AS (SELECT page_id, strlen(body) AS n, sha256(body) AS digest, min(page_id) OVER (PARTITION BY body) AS first_id FROM t),
        v AS (SELECT *, n >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS refers FROM r)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
            CASE WHEN refers THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN refers THEN first_id END AS refers_to
        FROM v
    """,
    "op12_centroids": _clusters(64, 8, 10),
    "op13_lexical_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
        s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d WHERE len(terms) > 0),
        tf AS (SELECT doc_id, len(terms) AS n, term, count(*) AS tf
            FROM (SELECT doc_id, terms, unnest(terms) AS term FROM d) GROUP BY doc_id, terms, term),
        qf AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest(terms) AS term FROM i) GROUP BY item_id, term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, s GROUP BY term),
        p AS (SELECT item_id, doc_id, CAST(sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
            FROM qf JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM p WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
    """,
}
