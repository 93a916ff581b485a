"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from eventmart.llm import centroids, jaccard, lexical, licenses, urls, vectors
from eventmart.llm.license_texts import PHRASES, TEMPLATES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Ends a query with ``links`` (x, y, both ways) and ``nodes`` (node): what each node reaches.
REACH = """reach(node, r) AS (SELECT node, node FROM nodes UNION SELECT reach.node, links.y FROM reach JOIN links ON links.x = reach.r),
components AS (SELECT node, min(r) AS component_id FROM reach GROUP BY 1)"""

JACCARD = f"""WITH RECURSIVE words AS MATERIALIZED (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {jaccard.WORDS} THEN [array_to_string(w, ' ')]
 ELSE list_distinct(list_transform(range(1, len(w) - {jaccard.WORDS - 2}), lambda i: array_to_string(w[i:i + {jaccard.WORDS - 1}], ' '))) END AS s FROM words),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
 GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= {jaccard.PERCENT} * (a.n + b.n - count(*))),
links AS MATERIALIZED (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
nodes AS (SELECT doc_id AS node FROM documents),
{REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN components ON node = doc_id"""

EMBEDDINGS = f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
 WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
 WHERE list_cosine_similarity(a.e, b.e) >= {vectors.THRESHOLD}),
nodes AS (SELECT vec_id AS node FROM embeddings),
{REACH},
counts AS (SELECT x, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON node = vec_id LEFT JOIN counts ON x = vec_id"""


def _noisy() -> str:
    """The same over every vector and its noisy copies."""
    shift = "CAST((vec_id * 7919 + copy * 104729 + copy * i * i * i * 31337 + vec_id * i * 613) % 201 - 100 AS DOUBLE)"
    copies = f"""noisy AS MATERIALIZED (SELECT vec_id * {vectors.COPIES} + copy AS vec_id,
 list_transform(embedding, lambda x, i: CASE WHEN copy = 0 THEN CAST(x AS DOUBLE) ELSE CAST(x AS DOUBLE) + {shift} * {vectors.NOISE!r}::DOUBLE END) AS embedding
 FROM embeddings, range({vectors.COPIES}) AS c(copy)),
"""
    return EMBEDDINGS.replace("embeddings", "noisy").replace("WITH RECURSIVE ", "WITH RECURSIVE " + copies, 1)


def _rules() -> str:
    cases = "".join(
        f" WHEN (host = '{h}' OR suffix(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
        for v, h, p in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    )
    return f"CASE{cases} END"


def _model(kind: str) -> str:
    """Interpolated probability of a gram's last character, from counts joined as k (gram) and c (context) of each order."""
    p = f"{1.0 / urls.ALPHABET!r}::DOUBLE"
    for k in range(1, urls.ORDER + 1):
        context = f"total_{kind}" if k == 1 else f"coalesce(c{k}.{kind}, 0)"
        p = f"((coalesce(k{k}.{kind}, 0) + {urls.STRENGTH} * {p}) / ({context} + {urls.STRENGTH}))"
    return p


def _urls() -> str:
    n, edge = urls.ORDER, f"repeat(chr(2), {urls.ORDER})"
    joins = "".join(f" LEFT JOIN counts k{k} ON k{k}.key = right(gram, {k})" for k in range(1, n + 1))
    joins += "".join(f" LEFT JOIN counts c{k} ON c{k}.key = left(right(gram, {k}), {k - 1})" for k in range(2, n + 1))
    suffixes = ", ".join(f"right(gram, {k})" for k in range(1, n + 1))
    step = f"CAST(round(greatest({-urls.BOUND}, least({urls.BOUND}, score)) / {urls.STEP}) AS BIGINT)"
    return f"""WITH parts AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
judged AS MATERIALIZED (SELECT page_id, host, path, {_rules()} AS fit,
 CASE WHEN contains(url, '://') THEN left(url, strpos(url, '://') + 2) || host || substr(rest, len(raw) + 1) ELSE coalesce(url, '') END AS text FROM (
 SELECT page_id, url, rest, raw, translate(raw, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, len(raw) + 1), '^[^?#]*') AS path FROM hosts)),
texts AS MATERIALIZED (SELECT text, max(CASE WHEN fit LIKE 'allow%' THEN 1 WHEN fit IS NOT NULL THEN 0 END) AS label FROM judged GROUP BY 1),
rows AS MATERIALIZED (SELECT judged.text, CASE WHEN fit LIKE 'allow%' THEN 1 WHEN fit IS NOT NULL THEN 0 END AS label,
 {_crc('judged.text')} % 5 = 0 AS held FROM judged),
grams AS MATERIALIZED (SELECT gram, count(*) FILTER (WHERE label = 1 AND NOT held) AS good, count(*) FILTER (WHERE label = 0 AND NOT held) AS bad FROM (
 SELECT substr({edge} || text || chr(3), unnest(range(1, len(text) + 3)), {n}) AS gram, label, held FROM rows) GROUP BY 1),
counts AS MATERIALIZED (SELECT key, sum(good) AS good, sum(bad) AS bad FROM (SELECT unnest([{suffixes}]) AS key, good, bad FROM grams WHERE good + bad > 0) GROUP BY 1),
scores AS MATERIALIZED (SELECT gram, ln({_model('good')}) - ln({_model('bad')}) AS ratio FROM grams,
 (SELECT coalesce(sum(good), 0) AS total_good, coalesce(sum(bad), 0) AS total_bad FROM grams WHERE NOT suffix(gram, chr(2))){joins} WHERE NOT suffix(gram, chr(2))),
scored AS MATERIALIZED (SELECT text, label, {_crc('text')} % 5 = 0 AS held, avg(ratio) AS score FROM (
 SELECT text, label, substr({edge} || text || chr(3), unnest(range(2, len(text) + 3)), {n}) AS gram FROM texts) JOIN scores USING (gram) GROUP BY 1, 2),
steps AS (SELECT {step} AS step, sum(label) AS good, sum(1 - label) AS bad FROM scored WHERE held AND label IS NOT NULL GROUP BY 1),
edges AS (SELECT (step - 0.5) * {urls.STEP} AS edge, ((all_good - coalesce(sum(good) OVER before, 0)) / all_good + coalesce(sum(bad) OVER before, 0) / all_bad) / 2 AS quality
 FROM steps, (SELECT sum(good) AS all_good, sum(bad) AS all_bad FROM steps) WHERE all_good > 0 AND all_bad > 0
 WINDOW before AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
threshold AS (SELECT coalesce((SELECT edge FROM edges WHERE quality > 0.5 ORDER BY quality DESC, abs(edge), edge DESC LIMIT 1), 0) AS least)
SELECT page_id, host, path, CASE WHEN fit IS NULL THEN NULL ELSE substr(fit, 7) END AS rule,
 coalesce(left(fit, 5), CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict
FROM judged JOIN scored USING (text), threshold"""


def _crc(text: str) -> str:
    """The unsigned CRC-32 of a text, which DuckDB lacks: bit by bit over its bytes."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    byte = "list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: " + step + ")"
    data = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i - 1 AS INTEGER), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda crc, b: {byte}), 4294967295::BIGINT)"


LEXICAL = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{lexical.TERM}') AS t FROM documents WHERE text IS NOT NULL),
stats AS MATERIALIZED (SELECT count(*) FILTER (WHERE len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d),
terms AS MATERIALIZED (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{lexical.TERM}')) AS term FROM benchmark),
tfs AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM terms) GROUP BY 1, 2),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, stats GROUP BY 1),
sizes AS (SELECT r, doc_id, 100 - 90 + (90 * len(t) * n_docs) // n_terms AS m FROM d, stats WHERE len(t) > 0),
scores AS (SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
 FROM terms JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (r) GROUP BY 1, 2, 3),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {lexical.BEST}"""


def _words(text: str) -> list[str]:
    return [w.decode() for w in licenses.words(text)]


def _licenses() -> str:
    phrases = ", ".join(f"('{label}', {_words(text)})" for label, text in PHRASES)
    rows = []
    for k, (label, text) in enumerate(TEMPLATES):
        own = _words(text)
        size = len(set(own))
        rows.append(f"({k}, '{label}', {licenses.width_of(len(own))}, {size}, {sorted(set(own))})")
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
 regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
phrases(label, p) AS (VALUES {phrases}),
templates(k, label, width, size, own) AS (VALUES {", ".join(rows)}),
vocabulary AS MATERIALIZED (SELECT k, label, width, size, unnest(own) AS word FROM templates),
places AS MATERIALIZED (SELECT r, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
base AS MATERIALIZED (SELECT r, label, pos FROM places JOIN d USING (r) JOIN phrases ON word = p[1] WHERE w[pos + 1:pos + len(p)] = p),
blocks AS MATERIALIZED (SELECT r, k, label, CAST(count(DISTINCT word) AS DOUBLE) / size AS score FROM (
  SELECT r, n, k, label, width, size, word, unnest([pos // width, pos // width - 1]) AS block FROM places JOIN vocabulary USING (word))
 WHERE block >= 0 AND block < greatest(1, (n + width - 1) // width - 1)
 GROUP BY r, k, label, size, block HAVING 100 * count(DISTINCT word) >= {licenses.PERCENT} * size),
bases AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM base GROUP BY 1),
every AS (SELECT r, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(score) AS score
 FROM (SELECT r, label, 1.0::DOUBLE AS score FROM base UNION ALL SELECT r, label, score FROM blocks) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
 coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score FROM d LEFT JOIN bases USING (r) LEFT JOIN every USING (r)"""


def _clusters() -> str:
    k = centroids.DIMENSION
    whole = f"list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT))"
    apart = f"CAST(list_sum(list_transform(range(1, {k + 1}), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))) AS BIGINT)"
    out = f"""WITH vectors AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {whole} AS v FROM embeddings
 WHERE len(embedding) = {k} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY name, v) - 1 AS c, v FROM (
 SELECT sha256('{centroids.SEED}:' || vec_id) AS name, v FROM vectors ORDER BY 1 NULLS LAST, 2 LIMIT {centroids.CLUSTERS}))"""
    for i in range(centroids.ROUNDS + 1):
        out += f""",
a{i} AS MATERIALIZED (SELECT r, c, distance FROM (SELECT a.r, b.c, {apart} AS distance FROM vectors a, c{i} b)
 QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1)"""
        if i < centroids.ROUNDS:
            out += f""",
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
 SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM (
  SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range({k})) AS j FROM a{i} JOIN vectors USING (r)) GROUP BY 1, 2) GROUP BY 1) m USING (c))"""
    last = centroids.ROUNDS
    return out + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
 CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
FROM a{last} JOIN vectors USING (r) JOIN c{last} USING (c)"""


ORACLES = {
    "op6_jaccard_join": JACCARD,
    "op7_url_filter": _urls(),
    "op9_embeddings": EMBEDDINGS,
    "embeddings_noisy_copies": _noisy(),
    "op11_lexical_search": LEXICAL,
    "op12_license_scan": _licenses(),
    "op13_centroids": _clusters(),
}
