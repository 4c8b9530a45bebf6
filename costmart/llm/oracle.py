"""DuckDB SQL of the operators' queries that SQL can express.

The other operators (bit-ball links, bin packing, suffix ranks, a trained
network, tree scoring, boosted candidates) are tested against brute force.
"""

from . import mixing

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, key: str) -> str:
    text = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"SELECT {key}, regexp_extract_all({text}, '{_WORD}') AS w FROM {table}"


OP3 = f"""
WITH doc AS MATERIALIZED ({_words("documents", "doc_id")}),
item AS ({_words("benchmark", "item_id")}),
windows AS (
  SELECT item_id, unnest([w[i : i + 9] FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS phrase
  FROM item WHERE len(w) > 0),
known AS (SELECT DISTINCT item_id, array_to_string(phrase, ' ') AS phrase, len(phrase) AS n FROM windows),
sizes AS (SELECT DISTINCT n FROM known),
place AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, sizes WHERE len(w) >= n),
found AS (
  SELECT DISTINCT doc_id, i, place.n, item_id FROM place
  JOIN known ON known.n = place.n AND known.phrase = array_to_string(w[i : i + place.n - 1], ' ')),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) t GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) t GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit ON hit.doc_id = doc.doc_id LEFT JOIN items ON items.doc_id = doc.doc_id
"""

# base32: 32 groups of five bits, cut from eight groups of five hex digits
OP4 = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id
  FROM pages)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last_id THEN last_id END AS refers_to
FROM page
"""

OP6 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _mixing() -> str:
    """Raking unrolled: one common table for each marginal of each round."""
    dims = mixing.DIMENSIONS
    steps = [
        """doc AS MATERIALIZED (
  SELECT doc_id, source, lang,
    CASE WHEN contains(text, ' | ') THEN 'table'
      WHEN contains(text, 'License') OR contains(text, 'Licensed under') THEN 'licensed'
      WHEN contains(text, '@') OR contains(text, '+1 (') THEN 'contact'
      WHEN length(text) < 400 THEN 'note' WHEN length(text) >= 8000 THEN 'long' ELSE 'prose' END AS topic,
    CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+')), 0) AS BIGINT) AS tokens,
    CAST(CAST('0x' || substr(md5('mix' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 AS draw
  FROM documents)""",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS raked "
        "FROM doc GROUP BY ALL)",
    ]
    for d in dims:
        steps.append(
            f"share_{d} AS MATERIALIZED (SELECT {d}, pow(t, {mixing.TEMPER}) / sum(pow(t, {mixing.TEMPER})) OVER () AS share "
            f"FROM (SELECT {d}, sum(tokens) AS t FROM c0 GROUP BY {d}) x)"
        )
    n = 0
    for _ in range(mixing.ROUNDS):
        for d in dims:
            n += 1
            steps.append(
                f"c{n} AS MATERIALIZED (SELECT source, lang, topic, tokens, raked * share * (SELECT sum(tokens) FROM c0) "
                f"/ sum(raked) OVER (PARTITION BY {d}) AS raked FROM c{n - 1} JOIN share_{d} USING ({d}))"
            )
    steps.append(f"cell AS MATERIALIZED (SELECT *, raked / tokens AS weight FROM c{n})")
    steps.append(
        """step AS (
  SELECT weight, (0.6 * (SELECT sum(tokens) FROM cell) - full_tokens) / ((SELECT sum(raked) FROM cell) - gone) AS scale
  FROM (SELECT weight,
      coalesce(sum(sum(tokens)) OVER (ORDER BY weight DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_tokens,
      coalesce(sum(sum(raked)) OVER (ORDER BY weight DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone
    FROM cell GROUP BY weight) x),
scale AS MATERIALIZED (SELECT max_by(scale, weight) AS scale FROM step WHERE scale * weight <= 1),
chance AS (
  SELECT doc_id, source, lang, topic, doc.tokens, weight, draw,
    CASE WHEN doc.tokens > 0 THEN least(1.0, weight * (SELECT scale FROM scale)) ELSE 0.0 END AS probability
  FROM doc JOIN cell USING (source, lang, topic))"""
    )
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT doc_id, source, lang, topic, tokens, round(weight, 6) AS weight, "
        "round(probability, 6) AS probability, draw < probability AS sampled FROM chance"
    )


ORACLE: dict[str, str] = {"op3_decontaminate": OP3, "op4_warc": OP4, "op6_topk": OP6, "op7_mixing": _mixing()}
