"""The registered queries of this subpackage, with DuckDB counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, language_id, licenses, mixing, near_vectors, packing, pii, quotes, simhash, url_filter, vector_codes, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BLANKS, _UPPER = "[ \\t-\\r]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _norm(text: str) -> str:
    return f"trim(regexp_replace(translate({text}, '{_UPPER}', '{_UPPER.lower()}'), '{_BLANKS}', ' ', 'g'))"


@_query(
    "op1_quote_links",
    rf"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS mid, conv_id, turn, role, text, string_split_regex(coalesce(text, ''), '\r\n|\r|\n') AS parts
  FROM conversations),
lines AS (
  SELECT mid, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM messages),
marked AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS marks,
         regexp_replace(line, '^(?:[ \t]*>)+ ?', '') AS body
  FROM lines),
told AS (
  SELECT * REPLACE (CASE WHEN marks = 0 AND coalesce(lead(marks) OVER (PARTITION BY mid ORDER BY place), 0) > 0
      AND regexp_matches(line, '(?i)^[ \t]*(?:on|le|am|el) .{{1,200}}(?:wrote|écrit|schrieb|escribió)[^:]{{0,80}}:[ \t]*$') THEN -1 ELSE marks END AS marks)
  FROM marked),
turned AS (
  SELECT *, CASE WHEN marks IS DISTINCT FROM lag(marks) OVER (PARTITION BY mid ORDER BY place) THEN 1 ELSE 0 END AS begins FROM told),
numbered AS (
  SELECT *, sum(begins) OVER (PARTITION BY mid ORDER BY place) AS run FROM turned),
runs AS (
  SELECT mid, run, any_value(marks) AS depth, string_agg(body, chr(10) ORDER BY place) AS whole FROM numbered GROUP BY mid, run),
texts AS (
  SELECT mid, run, depth, 0 AS level, whole AS t FROM runs
  UNION ALL SELECT mid, run, depth, 1, unnest(string_split_regex(whole, '\n[ \t]*\n')) FROM runs
  UNION ALL SELECT mid, run, marks, 2, body FROM numbered),
units AS (
  SELECT DISTINCT m.conv_id, m.turn, x.mid, x.run, x.depth, x.level, {_norm("x.t")} AS norm
  FROM texts x JOIN messages m USING (mid) WHERE m.conv_id IS NOT NULL AND m.turn IS NOT NULL),
found AS (
  SELECT q.mid, q.run, q.depth, q.level, q.norm, max({{'turn': o.turn, 'mid': o.mid}}) AS source
  FROM units q JOIN units o ON o.conv_id = q.conv_id AND o.norm = q.norm AND o.depth = 0 AND o.turn < q.turn
  WHERE q.depth > 0 AND q.norm <> '' GROUP BY ALL),
scored AS (
  SELECT mid, run, depth, level, source, sum(length(norm)) AS chars FROM found GROUP BY ALL),
linked AS (
  SELECT mid, run, depth, max({{'l': -level, 'chars': chars, 'source': source}}) AS best FROM scored GROUP BY mid, run, depth),
replies AS (
  SELECT mid, count(*) AS n_linked, max({{'d': -depth, 'chars': best.chars, 'source': best.source}}).source AS reply FROM linked GROUP BY mid),
chain(mid, turn, source) AS (
  SELECT mid, reply.turn, reply.mid FROM replies
  UNION ALL SELECT c.mid, r.reply.turn, r.reply.mid FROM chain c JOIN replies r ON r.mid = c.source),
roots AS (SELECT mid, min(turn) AS turn, arg_min(source, turn) AS source FROM chain GROUP BY mid),
placed AS (
  SELECT m.mid, coalesce(r.turn, m.turn) AS thread,
         row_number() OVER (PARTITION BY m.conv_id ORDER BY coalesce(r.turn, m.turn), coalesce(r.source, m.mid), m.turn, m.mid) AS position
  FROM messages m LEFT JOIN roots r USING (mid) WHERE m.conv_id IS NOT NULL AND m.turn IS NOT NULL),
own AS (
  SELECT mid, coalesce(string_agg(CASE WHEN marks = 0 THEN body END, chr(10) ORDER BY place), '') AS kept, bool_or(marks <> 0) AS quotes FROM told GROUP BY mid),
counts AS (
  SELECT mid, count(*) FILTER (depth > 0) AS n_quotes, greatest(max(depth), 0) AS max_depth FROM runs GROUP BY mid)
SELECT m.conv_id, m.turn, m.role,
       CASE WHEN o.quotes THEN regexp_replace(regexp_replace(o.kept, '^{_BLANKS}', ''), '{_BLANKS}$', '') ELSE m.text END AS text,
       c.n_quotes, c.max_depth, coalesce(r.n_linked, 0) AS n_linked, r.reply.turn AS reply_to, p.thread, p.position
FROM messages m JOIN own o USING (mid) JOIN counts c USING (mid) LEFT JOIN replies r USING (mid) LEFT JOIN placed p USING (mid)
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(_table(spark, sf_dir, "conversations"))


@_query("op2_near_vectors")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.mark_near_vectors(_table(spark, sf_dir, "embeddings"))


@_query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), with_rows=False)


@_query("op4_simhash_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.mark_near_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"), 4, 4)


@_query("op5_mix_sources")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


@_query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@_query("op7_warc_archives")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages"))).drop("url")


@_query("op8_personal_data")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@_query(
    "op9_exact_dedup",
    """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(_table(spark, sf_dir, "documents"))


#: The rules of the query on pages.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def _sql_terms() -> str:
    """Each term of the vocabulary that a URL holds."""
    edge = ("(^|[^a-z0-9])", "([^a-z0-9]|$)")
    each = (f"CASE WHEN regexp_matches(low, '{edge[0] * t.whole}{t.text}{edge[1] * t.whole}') THEN {{'term': '{t.text}', 'weight': {t.weight}::DOUBLE}} END" for t in url_filter.VOCABULARY)
    return "[" + ",\n    ".join(each) + "]"


@_query(
    "op10_url_filter",
    f"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule, host_end, start, action) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
judged AS (
  SELECT p.*,
         (SELECT max_by(struct_pack(rule := r.rule, action := r.action), length(r.rule)) FROM rules r
          WHERE (p.host = r.host_end OR ends_with(p.host, '.' || r.host_end)) AND starts_with(p.path, r.start)) AS best,
         list_filter({_sql_terms()}, lambda t: t IS NOT NULL) AS terms
  FROM parts p)
SELECT page_id, host, path, best.rule AS rule,
       array_to_string(list_sort(list_transform(list_filter(terms, lambda t: t.weight >= {url_filter.REJECTED}), lambda t: t.term)), ',') AS strict_terms,
       array_to_string(list_sort(list_transform(list_filter(terms, lambda t: t.weight < {url_filter.REJECTED}), lambda t: t.term)), ',') AS soft_terms,
       round(coalesce(list_sum(list_transform(terms, lambda t: t.weight)), 0), 6) AS weight,
       coalesce(best.action, CASE WHEN round(list_sum(list_transform(terms, lambda t: t.weight)), 6) >= {url_filter.REJECTED} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return out.withColumns({c: F.array_join(c, ",") for c in ("strict_terms", "soft_terms")} | {"weight": F.round("weight", 6)})


def _wording(items: list) -> str:
    """A parsed template as an expression over `` word  word `` (two blanks between words)."""
    out = ""
    for x in items:
        if isinstance(x, bytes):
            out += f" {x.decode()} "
        elif x[0] == "words":
            out += f"(?: [^ ]+ ){{{x[1]},{x[2]}}}"
        else:
            out += "(?:" + "|".join(map(_wording, x[1])) + ")"
    return out


def _sql_license_labels() -> str:
    each = (f"CASE WHEN regexp_matches(joined, '{_wording(licenses.parse(t.markup))}') THEN {{'label': '{t.label}', 'score': {t.score}::DOUBLE}} END" for t in licenses.TEMPLATES)
    return "[" + ",\n    ".join(each) + "]"


def _sql_base_places() -> str:
    each = []
    for t in licenses.TEMPLATES:
        if t.base:
            words = [w.decode() for w in licenses.words_of(t.markup.encode())]
            same = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
            each.append(f"list_transform(list_filter(range(len(w)), lambda i: {same}), lambda i: {{'start': i, 'label': '{t.label}'}})")
    return "list_concat(" + ", ".join(each) + ")"


@_query(
    "op11_license_scan",
    rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
joined AS (SELECT doc_id, w, ' ' || array_to_string(w, '  ') || ' ' AS joined FROM texts),
told AS (
  SELECT doc_id, len(w) AS n_words, {_sql_base_places()} AS base,
         list_filter({_sql_license_labels()}, lambda x: x IS NOT NULL) AS found
  FROM joined)
SELECT doc_id, n_words, len(base) AS n_base,
       list_min(list_transform(base, lambda b: b.start)) AS first_word, list_max(list_transform(base, lambda b: b.start)) AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(base, lambda b: b.label))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_transform(found, lambda f: f.label))), ',') AS labels,
       coalesce(list_max(list_transform(found, lambda f: f.score)), 0.0::DOUBLE) AS score
FROM told
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.find_licenses(_table(spark, sf_dir, "documents")))


def _sql_rounds() -> str:
    """Assignment and refinement, once per round, and the last assignment."""
    out = ""
    for k in range(vector_codes.ROUNDS + 1):
        out += f""",
assigned{k} AS (
  SELECT rid, part, any_value(x) AS x,
         min({{'away': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT, 'entry': entry}}) AS best
  FROM parts JOIN book{k} USING (part) GROUP BY rid, part)"""
        if k < vector_codes.ROUNDS:
            out += f""",
sums{k} AS (
  SELECT part, entry, place, floor(sum(value)::DOUBLE / count(*))::BIGINT AS c
  FROM (SELECT part, best.entry AS entry, unnest(x) AS value, generate_subscripts(x, 1) AS place FROM assigned{k}) GROUP BY ALL),
book{k + 1} AS (
  SELECT b.part, b.entry, coalesce(s.c, b.c) AS c
  FROM book{k} b LEFT JOIN (SELECT part, entry, list(c ORDER BY place) AS c FROM sums{k} GROUP BY ALL) s USING (part, entry))"""
    return out


_PARTS, _LAST = vector_codes.PARTS, vector_codes.ROUNDS


@_query(
    "op12_vector_codes",
    f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
         list_transform(embedding, lambda e: floor({vector_codes.SCALE} * e::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
parts AS (
  SELECT rid, vec_id, label, part, v[part * len(v) // {_PARTS} + 1 : (part + 1) * len(v) // {_PARTS}] AS x
  FROM kept, (SELECT unnest(range({_PARTS})) AS part)),
book0 AS (SELECT part, rid - 1 AS entry, x AS c FROM parts WHERE rid <= {vector_codes.ENTRIES}){_sql_rounds()},
codes AS (
  SELECT rid, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.away)::BIGINT AS error FROM assigned{_LAST} GROUP BY rid),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{_LAST})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (rid), digest
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    out = vector_codes.with_label_error(codes)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


@_query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    n, explained, error = (model.rows, model.explained.tolist(), model.error) if model else (0, [], None)
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), "place").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
