"""Registered queries of this package, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat_format, decontaminate, language_id, license_rules, license_scan, line_dedup, ranked_search, simhash, substring_dedup, token_counts, topk_search, url_filter, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query()
def op3_simhash_neardup(spark, sf):
    return simhash.near_duplicates(_table(spark, sf, "documents"))


LINES_SQL = """
WITH lines AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
each AS (SELECT DISTINCT doc_id, source, trim(unnest(ls), ' ' || chr(9) || chr(13)) AS line FROM lines),
totals AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
common AS (SELECT source, line FROM (SELECT source, line, count(*) AS k FROM each WHERE line <> '' GROUP BY source, line)
  JOIN totals USING (source) WHERE k >= 3 AND k > n * 0.02),
listed AS (SELECT source, list(line) AS drops FROM common GROUP BY source),
cut AS (SELECT doc_id, ls, list_filter(ls, lambda x: NOT list_contains(coalesce(drops, []), trim(x, ' ' || chr(9) || chr(13)))) AS stays
  FROM lines LEFT JOIN listed USING (source))
SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - len(stays))::BIGINT AS n_dropped,
       sha256(array_to_string(stays, chr(10))) AS kept_sha256 FROM cut"""


@_query(LINES_SQL)
def op8_line_dedup(spark, sf):
    out = line_dedup.drop_boilerplate(_table(spark, sf, "documents"))
    kept = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    return out.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
URLS_SQL = (
    """
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
parts AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
ruled AS (SELECT page_id, host, path, CASE """
    + " ".join(
        f"WHEN {_FITS.format(h=h, p=p)} THEN '{h}{p}'"
        for h, p, _ in sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    )
    + """ END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ("""
    + ", ".join(f"'{h}{p}'" for h, p, v in URL_RULES if v == "block")
    + """) THEN 'block' ELSE 'allow' END AS verdict FROM ruled"""
)


@_query(URLS_SQL)
def op9_url_rules(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, sf, "pages"), rules)


@_query(
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10"""
)
def op10_topk_search(spark, sf):
    return topk_search.top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@_query(
    """
WITH words AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents),
wins AS (SELECT doc_id, len(w) AS n, unnest(range(1, greatest(len(w) - 33, 1))) AS i, w FROM words),
keys AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS k FROM wins),
many AS (SELECT k FROM keys GROUP BY k HAVING count(*) > 1),
hits AS (SELECT doc_id, list(i) AS hit FROM keys JOIN many USING (k) GROUP BY doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list_transform(hit, lambda i: range(i, i + 35)))) AS g FROM hits),
cut AS (SELECT doc_id, w, list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(coalesce(g, []), j)) AS stay FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - len(stay))::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(stay, lambda j: w[j]), ' ')) AS kept_sha256 FROM cut"""
)
def op6_substring_dedup(spark, sf):
    out = substring_dedup.remove_repeats(_table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@_query()
def op4_language_id(spark, sf):
    docs = _table(spark, sf, "documents")
    told = language_id.predict(docs.select("doc_id", "text"), language_id.learn(docs))
    return told.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query()
def op5_byte_bpe(spark, sf):
    out = byte_bpe.encode(_table(spark, sf, "documents"), outputs=("n_tokens", "packed", "decoded"), keep=("doc_id",))
    return out.select("doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query()
def op7_token_counts(spark, sf):
    return token_counts.length_histogram(token_counts.lengths(_table(spark, sf, "documents")))


CHAT_SQL = """
WITH t AS (SELECT conv_id, turn // 256 AS part, turn, role, text FROM conversations),
p AS (SELECT DISTINCT conv_id, part, role AS perspective FROM t WHERE role <> 'system'),
r AS (SELECT t.*, perspective, '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
  ELSE 'user name=' || role END || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body FROM t JOIN p USING (conv_id, part)),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, part, perspective ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM r)
SELECT conv_id, part, perspective, count(*) AS n_turns, string_agg(head || body, '' ORDER BY turn, role, text) AS rendered,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY turn, role, text) FILTER (WHERE role = perspective), '') AS mask
FROM o GROUP BY conv_id, part, perspective"""


@_query(CHAT_SQL)
def op2_chat_format(spark, sf):
    out = chat_format.rotate_whole(_table(spark, sf, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat(s["start"], F.lit("-"), s["end"])), ",")
    return out.withColumn("mask", spans)


@_query()
def op1_decontaminate(spark, sf):
    return decontaminate.find_leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def _codes_sql(rounds: int, parts: int = 8, entries: int = 16) -> str:
    """The rounds as a chain of tables: entries, then the entry of each part, then the next entries."""
    width = f"(len(v) // {parts})"
    ctes = [
        """kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "cells AS MATERIALIZED (SELECT id, i // w AS p, i % w AS k, x FROM (SELECT id, unnest(range(len(v))) AS i, unnest(v) AS x, "
        + width + " AS w FROM kept))",
        f"firsts AS (SELECT id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT id, vec_id FROM kept ORDER BY vec_id LIMIT {entries}))",
        "c0 AS MATERIALIZED (SELECT p, e, k, x AS c FROM cells JOIN firsts USING (id))",
    ]
    for r in range(rounds + 1):
        ctes.append(
            f"""n{r} AS MATERIALIZED (SELECT id, p, min(d * {entries} + e)::BIGINT AS m FROM
  (SELECT id, p, e, sum((x - c) * (x - c))::BIGINT AS d FROM cells JOIN c{r} USING (p, k) GROUP BY id, p, e) GROUP BY id, p)"""
        )
        if r < rounds:
            ctes.append(
                f"""s{r} AS (SELECT p, m % {entries} AS e, k, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM cells JOIN n{r} USING (id, p) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT p, e, k, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c FROM c{r} LEFT JOIN s{r} USING (p, e, k))"""
            )
    return (
        "WITH " + ",\n".join(ctes) + f""",
coded AS (SELECT id, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error FROM n{rounds} GROUP BY id),
labelled AS (SELECT vec_id, label, code, error FROM coded JOIN kept USING (id))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, k)) FROM c{rounds}) AS codebooks_sha256 FROM labelled"""
    )


@_query(_codes_sql(vector_codes.ROUNDS))
def op11_vector_codes(spark, sf):
    out, books = vector_codes.compress(_table(spark, sf, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, vector_codes.components(books))).encode()).hexdigest()
    code = F.array_join(F.transform("code", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@_query(
    f"""
WITH words AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
sizes AS MATERIALIZED (SELECT doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM sizes),
asked AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_WORDS}) AS t FROM benchmark WHERE text IS NOT NULL),
tfs AS MATERIALIZED (SELECT doc_id, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(w) AS t FROM words) WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
weights AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*)::BIGINT AS df FROM tfs GROUP BY t), total),
impacts AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nt))) AS impact
  FROM tfs JOIN weights USING (t) JOIN sizes USING (doc_id), total),
scores AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (t) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10"""
)
def op12_ranked_search(spark, sf):
    return ranked_search.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


LICENSE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def _licenses_sql() -> str:
    own = [license_rules.Rule(label, tuple(dict.fromkeys(p.split())), p, license_rules.TEXT) for p, label in LICENSE_PHRASES.items()]
    rules = ",\n".join(
        f"({i}, '{r.label}', {list(r.keywords)}, '{r.regex}', {r.priority}, {license_rules.CONFIDENCE[r.priority]}::DOUBLE)"
        for i, r in enumerate([*own, *license_rules.signature_rules()])
    )
    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(n), lambda i: list_slice(ws, i + 1, i + {len(p.split())}) = {p.split()})) AS s FROM p"
        for p, label in LICENSE_PHRASES.items()
    )
    return rf"""
WITH rules(rank, label, kw, re, pri, conf) AS (VALUES {rules}),
w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
p AS MATERIALIZED (SELECT doc_id, ws, len(ws) AS n, ' ' || array_to_string(ws, '  ') || ' ' AS t FROM w),
hit AS (SELECT doc_id, rank, label, pri, conf, string_split_regex(regexp_replace(t, re, chr(1) || '\0' || chr(2), 'g'), '[\x01\x02]') AS pieces
  FROM p JOIN rules ON list_has_all(ws, kw) AND regexp_matches(t, re)),
cut AS (SELECT doc_id, rank, label, pri, conf, unnest(range(len(pieces))) AS i, unnest(pieces) AS x FROM hit),
sized AS (SELECT *, (length(x) - length(replace(x, ' ', ''))) // 2 AS k FROM cut),
placed AS (SELECT *, sum(k) OVER (PARTITION BY doc_id, rank ORDER BY i) AS e FROM sized),
spans AS MATERIALIZED (SELECT doc_id, rank, label, pri, conf, k, e - k AS s, e FROM placed WHERE i % 2 = 1),
alive AS (SELECT * FROM spans a WHERE NOT EXISTS (SELECT 1 FROM spans b WHERE a.doc_id = b.doc_id AND a.rank <> b.rank AND b.s <= a.s AND b.e >= a.e
  AND (b.pri > a.pri OR (b.pri = a.pri AND (b.k > a.k OR b.rank < a.rank))))),
base AS MATERIALIZED ({places}),
b AS (SELECT doc_id, count(*)::BIGINT AS n_base, min(s)::BIGINT AS first_word, max(s)::BIGINT AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
m AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(conf) AS score
  FROM (SELECT doc_id, label, conf FROM alive UNION ALL SELECT doc_id, label, 1.0 FROM base) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM p LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)"""


@_query(_licenses_sql())
def op13_license_scan(spark, sf):
    out = license_scan.scan(_table(spark, sf, "documents").select("doc_id", "text"), LICENSE_PHRASES)
    starts = F.transform("places", lambda x: x["start"].cast("long"))
    both = F.concat(F.transform("places", lambda x: x["label"]), F.transform("detections", lambda x: x["label"]))
    strongest = F.coalesce(F.array_max(F.transform("detections", lambda x: x["confidence"])), F.lit(0.0))
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        license_scan.joined(F.transform("places", lambda x: x["label"])).alias("base_labels"),
        license_scan.joined(both).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(strongest).alias("score"),
    )
