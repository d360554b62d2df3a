"""The queries that SQL can express, for the oracle engine."""

from __future__ import annotations

from sightlog.llm import licenses, secrets

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _matches(kind: int, pattern: str, group: int, test: str) -> str:
    return f"""
  SELECT doc_id, source, {kind} AS kind, val, span_start, span_start + length(full_text) AS span_end FROM (
    SELECT doc_id, source, m[i] AS full_text, v[i] AS val,
           list_sum(list_transform(g[1:i], lambda x: length(x))) +
           coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS span_start
    FROM (SELECT doc_id, source, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT doc_id, source, regexp_extract_all(t, {_text(pattern)}, 0) AS m,
             regexp_extract_all(t, {_text(pattern)}, {group}) AS v, string_split_regex(t, {_text(pattern)}) AS g FROM d)))
  WHERE {test}"""


_KINDS = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secrets.KINDS)) + " END"
_LISTED = f"string_agg({_KINDS} || ':' || span_start::BIGINT || ':' || span_end::BIGINT, ',' ORDER BY span_start, kind)"

SECRETS = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
base AS ({_matches(0, secrets.ASSIGN, 2, f"length(val) >= {secrets.ASSIGN_VALUE}")}
  UNION ALL {_matches(1, secrets.ACCESS, 0, "true")}
  UNION ALL {_matches(2, secrets.HEX, 0, "true")}),
opaque AS (
  SELECT * FROM ({_matches(3, secrets.OPAQUE, 0, "regexp_matches(val, '[0-9]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[A-Z]')")}) o
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.span_start < o.span_end AND o.span_start < b.span_end)),
candidates AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
known AS (
  SELECT val, count(*) AS repos, count(DISTINCT owner) AS owners
  FROM (SELECT DISTINCT val, doc_id, coalesce(source, chr(1)) AS owner FROM candidates) GROUP BY val),
found AS (SELECT c.*, owners <= {secrets.MAX_OWNERS} AND repos <= {secrets.MAX_REPOS} AS live FROM candidates c JOIN known USING (val)),
by_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex, {_LISTED} FILTER (kind < 3) AS base_spans,
         {_LISTED} FILTER (kind < 3 OR live) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN by_doc USING (doc_id)"""

SUBSTRING = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

_BENCH_WORDS = rf"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
    FROM items WHERE len(w) > 0)),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM d, (SELECT DISTINCT n FROM wanted) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN wanted USING (n, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _templates() -> str:
    rows = []
    for i, (name, words) in enumerate(licenses.template_words(licenses.TEMPLATES)):
        places = range(len(words) - licenses.SHINGLE + 1)
        shingles = sorted({" ".join(words[p : p + licenses.SHINGLE]) for p in places})
        width = licenses.width_of(len(places))
        rows += [f"({i}, {_text(name)}, {width}, {licenses.stride(width)}, {len(shingles)}, {_text(s)})" for s in shingles]
    return "(VALUES " + ", ".join(rows) + ") v(template, name, width, step, wanted, shingle)"


LICENSES = f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '{licenses.WORD}'), []) AS w FROM documents),
t AS (SELECT * FROM {_templates()}),
shingles AS (
  SELECT doc_id, len(w) - 4 AS n, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
met AS (SELECT doc_id, n, p, t.* FROM shingles JOIN t USING (shingle)),
windows AS (
  SELECT *, unnest(range(greatest(0, CAST(ceil((p - width + 1) / step) AS BIGINT)), p // step + 1)) * step AS place FROM met),
shared AS (
  SELECT doc_id, name, place, width, count(DISTINCT shingle) / max(wanted) AS share FROM windows
  WHERE place <= greatest(0, CAST(ceil((n - width) / step) AS BIGINT)) * step
  GROUP BY doc_id, template, name, place, width HAVING count(DISTINCT shingle) / max(wanted) >= {licenses.MIN_SHARE}),
found AS (SELECT doc_id, name, place, width, max(share) AS share FROM shared GROUP BY ALL),
by_doc AS (
  SELECT doc_id, count(*) AS n_windows, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(share) AS share
  FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_windows, 0) AS n_windows, coalesce(licenses, '') AS licenses, coalesce(share, 0.0) AS share
FROM d LEFT JOIN by_doc USING (doc_id)"""

def _features(table: str, key: str) -> str:
    words = f"SELECT {key} AS doc_id, {_BENCH_WORDS} AS w FROM {table}"
    return (
        f"SELECT doc_id, len(w) AS n_words, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f "
        f"FROM ({words})"
    )


def _crc_table() -> str:
    """Each byte through an empty CRC-32 register, bit by bit, as nested selects."""
    query = "SELECT i, i AS c FROM (SELECT unnest(range(256)) AS i)"
    for _ in range(8):
        query = f"SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM ({query})"
    return query


IMPORTANCE = f"""
WITH RECURSIVE table_of AS ({_crc_table()}),
d AS ({_features('documents', 'doc_id')}),
t AS ({_features('benchmark', 'item_id')}),
distinct_features AS (SELECT DISTINCT unnest(f) AS f FROM d UNION SELECT DISTINCT unnest(f) FROM t),
bytes AS (SELECT f, hex(encode(f)) AS h FROM distinct_features),
crc AS (
  SELECT f, h, 0 AS pos, 4294967295::BIGINT AS c FROM bytes
  UNION ALL
  SELECT f, h, pos + 1, xor(table_of.c, crc.c >> 8)
  FROM crc JOIN table_of ON table_of.i = xor(crc.c, ('0x' || substr(h, 2 * pos + 1, 2))::BIGINT) & 255
  WHERE 2 * pos < length(h)),
bucket_of AS (SELECT f, xor(c, 4294967295) % 10000 AS b FROM crc WHERE 2 * pos = length(h)),
s AS (SELECT b, count(*) AS n FROM (SELECT unnest(f) AS f FROM d) JOIN bucket_of USING (f) GROUP BY b),
u AS (SELECT b, count(*) AS n FROM (SELECT unnest(f) AS f FROM t) JOIN bucket_of USING (f) GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln((coalesce(u.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0)::DOUBLE FROM s) + 10000)
                  / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0)::DOUBLE FROM u) + 10000))))::BIGINT AS g
  FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN s USING (b) LEFT JOIN u USING (b)),
weights AS (
  SELECT doc_id, floor(sum(g) / count(*)::DOUBLE)::BIGINT AS weight
  FROM (SELECT doc_id, unnest(f) AS f FROM d) JOIN bucket_of USING (f) JOIN gain USING (b) GROUP BY doc_id),
scored AS (
  SELECT doc_id, n_words, len(f)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20
  QUALIFY rank <= (SELECT 25 * count(*) // 100 FROM scored WHERE n_words >= 20))
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (doc_id)"""

_TERMS = r"coalesce(regexp_extract_all(translate(text, '{}', '{}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])".format(UPPER, LOWER)

LEXICAL = f"""
WITH d AS (SELECT doc_id, w, len(w)::BIGINT AS n FROM (SELECT doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), totals),
adds AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS a
  FROM tf JOIN weights USING (term), totals),
scores AS (SELECT item_id, doc_id, sum(a)::BIGINT AS score FROM adds JOIN wanted USING (term) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50"""

ORACLE = {
    "op1_secrets": SECRETS,
    "op3_substring": SUBSTRING,
    "op8_decontamination": DECONTAMINATION,
    "op9_licenses": LICENSES,
    "op11_importance": IMPORTANCE,
    "op13_lexical_search": LEXICAL,
}
