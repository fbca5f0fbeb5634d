"""Registered queries of the operators and, where SQL can say it, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import decontaminate as D
from meterlake.llm import language, mixing, neardup, negatives, neighbours, prefixes, quality, secrets, suffixes, tokens, urls, warc


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(s, d) -> DataFrame:
    hits = D.decontaminate(load(s, d, "documents"), load(s, d, "benchmark"))
    n = D.n_hit(F.col("spans"))
    return hits.select(
        "doc_id",
        "n_words",
        n.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n > 0).alias("contaminated"),
    )


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP1 = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
cut AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM cut),
hits AS (SELECT r, i, p.m, item_id FROM (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS words
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, lengths)) p JOIN cut USING (m, words)),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT r, i, m FROM hits)) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""


def op4_neardup(s, d) -> DataFrame:
    return neardup.near_duplicates(load(s, d, "documents"), width=3, percent=85)


_SHINGLED = rf"""
docs AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes s ON s.doc_id = p.a JOIN sizes t ON t.doc_id = p.b WHERE 100 * n_both >= 85 * (s.n + t.n - n_both))"""
_OP4 = f"""
WITH RECURSIVE {_SHINGLED},
reach(node, spot) AS (SELECT doc_id, doc_id FROM docs UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.spot)
SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, low AS component_id, docs.doc_id = low AS kept
FROM docs LEFT JOIN sizes ON sizes.doc_id = docs.doc_id JOIN (SELECT node, min(spot) AS low FROM reach GROUP BY node) r ON r.node = docs.doc_id"""


def op5_mixing(s, d) -> DataFrame:
    return mixing.mix(load(s, d, "documents")).drop("source")


# The water level follows from the order in which sources reach their limit: the first ones take twice their size.
_OP5 = r"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
sources AS (SELECT source, source_size, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
levels AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM sources WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
top AS (SELECT level FROM levels WHERE 2 * source_size >= level * w ORDER BY source_size / w, source NULLS LAST LIMIT 1),
targets AS (SELECT source, source_size, least(greatest(top.level, 0) * w, CAST(2 * source_size AS DOUBLE)) AS target FROM sources LEFT JOIN top ON true),
placed AS (SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS whole,
    coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
  (whole // source_size) * size + greatest(0, least(size, whole % source_size - before)) END AS BIGINT) AS taken FROM placed"""


def op6_repeats(s, d) -> DataFrame:
    return suffixes.remove_repeats(load(s, d, "documents")).drop("spans")


_OP6 = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (SELECT doc_id, c, substr(h, 2 * c + 1, 598) AS part FROM (SELECT doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 49), 250)) AS c FROM docs)),
strings AS (SELECT doc_id, c + i AS p, substr(part, 2 * i + 1, 100) AS s FROM (SELECT doc_id, c, part, unnest(range(0, len(part) // 2 - 49)) AS i FROM parts)),
firsts AS (SELECT s, min(doc_id) AS m FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true)::INT AS new FROM strings JOIN firsts USING (s) WHERE m < doc_id),
spans AS (SELECT doc_id, min(p) AS b, max(p) + 50 AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM hits) GROUP BY doc_id, g),
pieces AS (SELECT doc_id, b, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS a FROM spans
  UNION ALL SELECT doc_id, len(h) // 2, coalesce((SELECT max(e) FROM spans WHERE spans.doc_id = docs.doc_id), 0) FROM docs),
kept AS (SELECT doc_id, sha256(unhex(string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a))) AS kept_sha256 FROM pieces JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(k, 0)::BIGINT AS n_spans, kept_sha256
FROM docs JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, sum(e - b) AS n, count(*) AS k FROM spans GROUP BY doc_id) USING (doc_id)"""


def op7_secrets(s, d) -> DataFrame:
    found = secrets.scan(load(s, d, "documents"))
    base = F.filter("spans", lambda x: x["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op2_neighbours(s, d) -> DataFrame:
    return neighbours.nearest(load(s, d, "embeddings"), lambda i: i % 20 == 0)


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op3_urls(s, d) -> DataFrame:
    return urls.judge(load(s, d, "pages").select("page_id", "url"), RULES)


def _shrunk(level: str, parent: str, prior: str) -> str:
    """Posterior means of one level: group key, counts, prior strength from the spread of the level's groups."""
    return f"""
{level}_m AS (SELECT CASE WHEN g IS NULL OR g < 2 OR k = 0 OR k = n THEN 1000.0::DOUBLE ELSE (
    SELECT CASE WHEN rho > 0 THEN least(greatest(1 / rho - 1, 1.0::DOUBLE), 1000.0::DOUBLE) ELSE 1000.0::DOUBLE END FROM (
      SELECT CASE WHEN n - n2 / n - (g - 1) > 0 THEN ((kn - k * (k / n)) / ((k / n) * (1 - k / n)) - (g - 1)) / (n - n2 / n - (g - 1)) ELSE 0.0 END AS rho)) END AS m
  FROM (SELECT count(*) AS g, sum(n)::DOUBLE AS n, sum(k)::DOUBLE AS k, sum(n::DOUBLE * n) AS n2, sum(k::DOUBLE * k / n) AS kn FROM {level} WHERE n > 0)),
{level}_p AS (SELECT c.*, {prior} AS prior, m FROM {level} c CROSS JOIN {level}_m {parent})"""


_SECOND = ", ".join(f"'{x}'" for x in urls.SECOND_LEVEL)
_RULE_SQL = "CASE " + " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
    for r in sorted(RULES, key=len, reverse=True)
) + " END"
_VERDICT_SQL = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES.items()) + " END"
_OP3 = f"""
WITH parts AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}') AS host,
  coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, {_VERDICT_SQL} AS verdict FROM (SELECT *, {_RULE_SQL} AS rule FROM parts)),
labels_of AS (SELECT host, string_split(host, '.') AS l, count(verdict) AS n, count(*) FILTER (WHERE verdict = 'block') AS k FROM ruled WHERE host <> '' GROUP BY host),
hosts AS (SELECT host, n, k, array_to_string(l[greatest(len(l) - c + 1, 1):], '.') AS suffix, array_to_string(l[greatest(len(l) - c, 1):], '.') AS domain
  FROM (SELECT *, CASE WHEN array_to_string(l[greatest(len(l) - 1, 1):], '.') IN ({_SECOND}) THEN 2 ELSE 1 END AS c FROM labels_of)),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
{_shrunk("suffixes", "CROSS JOIN (SELECT (coalesce(sum(k), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2) AS p FROM suffixes) x", "x.p")},
suffix_means AS (SELECT suffix, (k + m * prior) / (n + m) AS p FROM suffixes_p),
{_shrunk("domains", "JOIN suffix_means x USING (suffix)", "x.p")},
domain_means AS (SELECT domain, (k + m * prior) / (n + m) AS p FROM domains_p),
{_shrunk("hosts", "JOIN domain_means x USING (domain)", "x.p")},
low AS (SELECT host, a / (a + b) - 1.645::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM (SELECT host, k + m * prior AS a, n - k + m * (1 - prior) AS b FROM hosts_p))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN low >= 0.5 THEN 'block' END, 'allow') AS verdict FROM ruled LEFT JOIN low USING (host)"""


def op8_warc(s, d) -> DataFrame:
    return warc.derive(warc.responses(load(s, d, "pages")))


_UUID = "'<urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '>'"


def _unescaped(text: str) -> str:
    codes = f"list_filter(list_distinct(regexp_extract_all({text}, '&#([0-9]{{1,7}});', 1)), lambda c: (c::INT > 0 AND c::INT < 55296) OR (c::INT > 57343 AND c::INT < 1114112))"
    out = f"list_reduce(list_prepend({text}, {codes}), lambda t, c: replace(t, '&#' || c || ';', chr(c::INT)))"
    for name, char in warc.ENTITIES.items():
        out = f"replace({out}, '&{name};', '{char.replace(chr(39), chr(39) * 2)}')"
    return out


def _squeezed(text: str) -> str:
    text = rf"regexp_replace(regexp_replace({text}, '[ \t\x0B\f\r]{{2,}}|[\t\x0B\f\r]', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g')"
    return f"trim({text}, ' ' || chr(10))"


_TAGLESS = f"regexp_replace(regexp_replace(regexp_replace(html, '{warc.DROPPED}', ' ', 'g'), '{warc.BREAK}', chr(10), 'g'), '<[^>]*>', '', 'g')"
_OP8 = rf"""
WITH src AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html FROM pages),
block AS (SELECT *, 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(html))
  || chr(13) || chr(10) || chr(13) || chr(10) || html AS b, md5('response' || chr(31) || coalesce(page_id::VARCHAR, '') || chr(31) || target_uri) AS h FROM src),
resp AS (SELECT target_uri, html, {_UUID} AS id, 'sha256:' || sha256(html) AS payload, 'sha256:' || sha256(b) AS digest FROM block),
text AS (SELECT *, {_TAGLESS} AS bare, regexp_extract(html, '{warc.TITLE}', 1) AS t, list_distinct(regexp_extract_all(html, '{warc.HREF}', 1)) AS links,
  regexp_extract_all(html, '{warc.HREF}', 1) AS all_links FROM resp),
made AS (SELECT target_uri, id, payload, 'conversion' AS record_type, 'text/plain; charset=utf-8' AS type, {_squeezed(_unescaped("bare"))} AS block FROM text
  UNION ALL SELECT target_uri, id, payload, 'metadata', 'application/warc-fields', replace(
    'source-WARC-Payload-Digest: ' || payload || chr(10) || 'source-Content-Type: application/http; msgtype=response' || chr(10) || 'source-block-digest: ' || digest || chr(10)
    || 'http-status: 200' || chr(10) || 'http-content-type: text/html; charset=utf-8' || chr(10) || 'title: ' || replace({_squeezed(_unescaped("t"))}, chr(10), ' ') || chr(10)
    || coalesce(array_to_string(list_transform(list_sort(list_transform(links, lambda u: [lpad(list_position(all_links, u)::VARCHAR, 9, '0'), u])), lambda p: 'outlink: ' || p[2] || chr(10)), ''), ''), chr(10), chr(13) || chr(10)) FROM text),
named AS (SELECT *, md5(record_type || chr(31) || id) AS h FROM made)
SELECT {_UUID} AS record_id, record_type, id AS refers_to, target_uri, '{warc.DATE}' AS date,
  'WARC-Source-Payload-Digest: ' || payload || chr(13) || chr(10) || 'Content-Type: ' || type AS headers, block, 'sha256:' || sha256(block) AS block_digest,
  octet_length(encode(block))::BIGINT AS content_length FROM named"""


def op9_language(s, d) -> DataFrame:
    docs = load(s, d, "documents")
    out = language.held_out("doc_id", 4, 2)
    model = language.train(docs.where(~out))
    return language.identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_quality(s, d) -> DataFrame:
    docs = load(s, d, "documents").select("doc_id", "text")
    out = language.held_out("doc_id", 5, 0)
    model = quality.train(docs, load(s, d, "labels").where(~out))
    scored = quality.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_negatives(s, d) -> DataFrame:
    relabel = lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(load(s, d, "embeddings"), lambda i: i % 50 == 0, relabel=relabel)


_OP11 = """
WITH used AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 3"""


def op12_prefixes(s, d) -> DataFrame:
    turns = prefixes.staged(prefixes.ordered_turns(load(s, d, "conversations")), "ordered")
    heads = turns.select("conv").distinct().selectExpr("conv", "conv - conv % 5 AS donor", "crc32(CAST(conv AS STRING)) % 9 AS h")
    rebuilt, lengths = prefixes.spliced(turns, heads, longest=8)
    return prefixes.trie(rebuilt, lengths)


# CRC-32 as its bits go: a byte is mixed in, then eight times the lowest bit decides.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda c: list_concat([ascii(c)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""
_OP12 = f"""
WITH rows_of AS (SELECT conv_id, turn, role_text, n_bytes, sha256(role_text) AS d FROM (SELECT conv_id, turn,
    length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS role_text, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos FROM rows_of),
heads AS (SELECT conv_id, conv_id - conv_id % 5 AS donor, ({_CRC}) % 9 AS h, n FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)),
plans AS (SELECT heads.*, least(h, coalesce(o.n, 0)) AS taken FROM heads LEFT JOIN (SELECT conv_id AS donor, n FROM heads) o USING (donor)),
rebuilt AS (SELECT p.conv_id, t.pos, t.d, t.n_bytes FROM plans p JOIN turns t ON t.conv_id = p.donor AND t.pos <= p.taken
  UNION ALL SELECT p.conv_id, t.pos - p.h + p.taken, t.d, t.n_bytes FROM plans p JOIN turns t ON t.conv_id = p.conv_id AND t.pos > p.h),
keyed AS (SELECT *, sha256(string_agg(d, ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS key FROM rebuilt),
chained AS (SELECT *, coalesce(lag(key) OVER (PARTITION BY conv_id ORDER BY pos), '') AS up FROM keyed
  UNION ALL SELECT conv_id, 0, NULL, 0, '', NULL FROM heads),
nodes AS (SELECT key, min(conv_id) AS conv_id, max(pos) AS depth, max(up) AS up, count(*) AS n_convs, (count(*) - 1) * max(n_bytes) AS worth FROM chained GROUP BY key),
children AS (SELECT up AS key, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
over AS (SELECT DISTINCT b.key AS key, a.key AS top FROM chained b JOIN chained a USING (conv_id) WHERE a.pos <= b.pos),
sums AS (SELECT top AS key, sum(worth) AS saved, count(*) FILTER (WHERE children.n IS NULL) AS leaves FROM over JOIN nodes USING (key) LEFT JOIN children USING (key) GROUP BY top),
last AS (SELECT conv_id, arg_max(key, pos) AS key FROM chained GROUP BY conv_id),
ends AS (SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM last GROUP BY key)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, parents.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children, leaves AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes LEFT JOIN nodes parents ON nodes.up = parents.key LEFT JOIN children ON children.key = nodes.key JOIN sums ON sums.key = nodes.key LEFT JOIN ends ON ends.key = nodes.key"""


TOKEN_LIMIT = 1024


def op13_tokens(s, d) -> DataFrame:
    counted = tokens.count_tokens(load(s, d, "documents"), TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), F.col("fit_chars").alias("chars_within_limit"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_neighbours": op2_neighbours,
    "op3_urls": op3_urls,
    "op4_neardup": op4_neardup,
    "op5_mixing": op5_mixing,
    "op6_repeats": op6_repeats,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_negatives": op11_negatives,
    "op12_prefixes": op12_prefixes,
    "op13_tokens": op13_tokens,
}
ORACLES = {"op1_decontaminate": _OP1, "op3_urls": _OP3, "op4_neardup": _OP4, "op5_mixing": _OP5, "op6_repeats": _OP6, "op8_warc": _OP8, "op11_negatives": _OP11, "op12_prefixes": _OP12}
