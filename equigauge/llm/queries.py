"""The registered queries of these operators, over their whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from equigauge.llm.collocations import collocations
from equigauge.llm.decontamination import contamination
from equigauge.llm.embedding_dedup import near_duplicates
from equigauge.llm.exact_dedup import exact_dedup
from equigauge.llm.mixing import mix
from equigauge.llm.ngram_join import jaccard_groups
from equigauge.llm.packing import pack
from equigauge.llm.pii import pii_report
from equigauge.llm.spelling import spelling_variants
from equigauge.llm.suffix_dedup import remove_repeats
from equigauge.llm.token_counts import count_tokens
from equigauge.llm.toxicity import score_toxicity
from equigauge.llm.warc import archive_round_trip
from equigauge.session import ship_package


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return operator(spark.read.parquet(f"{folder}/{table}.parquet"))
    return query


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return _over("documents", lambda docs: score_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")))(spark, folder)


def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    told = _over("documents", lambda docs: contamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet")))(spark, folder)
    return told.drop("spans", "items")


QUERIES = {
    "op1_pii": _over("documents", pii_report),
    "op2_suffix_dedup": _over("documents", lambda docs: remove_repeats(docs, texts=False)),
    "op3_token_counts": _over("documents", lambda docs: count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))),
    "op4_toxicity": _toxicity,
    "op5_mixing": _over("documents", mix),
    "op6_exact_dedup": _over("documents", exact_dedup),
    "op7_embedding_dedup": _over("embeddings", near_duplicates),
    "op8_warc": _over("pages", archive_round_trip),
    "op9_packing": _over("documents", lambda docs: pack(docs, tokenizer_path("word_bpe_49k.json"))),
    "op10_ngram_join": _over("documents", jaccard_groups),
    "op11_decontamination": _decontamination,
    "op12_collocations": _over("documents", collocations),
    "op13_spelling": _over("documents", spelling_variants),
}

_IP_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Pattern, condition on a find `m`, whether the score decides, score, context words. Plain patterns, same finds.
_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", None),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", rf"regexp_full_match(m, '{_IP_PART}(\.{_IP_PART}){{3}}')", None),
    "card": (r"[0-9]([\x20-]?[0-9])+", "length(digits(m)) BETWEEN 16 AND 19 AND luhn(digits(m))", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits(m)) BETWEEN 8 AND 15", None),
    "iban": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", "mod97(m)", None),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "NOT regexp_matches(m, '^(000|666|9)|-00-|-0000$')", "ssn|social security|tax id"),
}


def _pii_sql() -> str:
    digits = lambda x: f"regexp_replace({x}, '[^0-9]', '', 'g')"
    luhn = lambda d: (f"(list_sum(list_transform(range(1, length({d}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({d}), i, 1) AS INT) "  # noqa: E731
                      f"ELSE (2 * CAST(substr(reverse({d}), i, 1) AS INT)) // 10 + (2 * CAST(substr(reverse({d}), i, 1) AS INT)) % 10 END)) % 10 = 0)")
    mod97 = ("(list_reduce(list_prepend(0, list_transform(string_split(substr(m, 5) || substr(m, 1, 4), ''), lambda c: CASE WHEN c >= 'A' "
             "THEN 1000 + ascii(c) - 55 ELSE ascii(c) - 48 END)), lambda a, v: CASE WHEN v >= 1000 THEN (a * 100 + v - 1000) % 97 ELSE (a * 10 + v) % 97 END) = 1)")
    ctes, written = [], {}
    for kind, (pattern, test, words) in _KINDS.items():
        test = test.replace("luhn(digits(m))", luhn(digits("m"))).replace("digits(m)", digits("m")).replace("mod97(m)", mod97)
        near = f" AND regexp_matches(lower(right(b, 32)), '{words}')" if words else ""
        ctes.append(f"""{kind}_raw AS (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS bs FROM docs),
{kind}_rows AS (SELECT doc_id, unnest(ms) AS m, unnest(bs[:len(ms)]) AS b, unnest(range(len(ms))) AS k FROM {kind}_raw WHERE len(ms) > 0),
{kind}_at AS (SELECT doc_id, m, b, CAST(sum(length(b)) OVER w + coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
 FROM {kind}_rows WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{kind} AS (SELECT doc_id, count(*) AS n, string_agg('{kind}:' || s || ':' || (s + length(m)), ',' ORDER BY s) AS w FROM {kind}_at WHERE {test}{near} GROUP BY doc_id)""")
        written[kind] = f"{kind}.w"
    base = ["email", "ip", "card", "phone"]
    joins = " ".join(f"LEFT JOIN {k} ON docs.doc_id = {k}.doc_id" for k in _KINDS)
    return ("WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),\n" + ",\n".join(ctes) + "\nSELECT docs.doc_id, "
            + ", ".join(f"coalesce({k}.n, 0) AS n_{k}" for k in base)
            + f", sha256(concat_ws(',', {', '.join(written[k] for k in base)})) AS base_sha256"
            + f", concat_ws(',', {', '.join(written.values())}) AS spans FROM docs {joins}")


_MIXING_SQL = r"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS mark FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS most FROM sources),
levels AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
targets AS (SELECT source, source_size, least(most, coalesce((max(level) FILTER (level <= most / weight) OVER ()) * weight, most)) AS target FROM levels),
placed AS (SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.mark, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
  CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS times
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(times * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - times * source_size - start)) AS BIGINT) AS taken,
  source_of AS source, CAST(times + CASE WHEN start < CAST(round(target) AS BIGINT) - times * source_size THEN 1 ELSE 0 END AS BIGINT) AS repeats
FROM (SELECT p.*, d.source AS source_of FROM placed p JOIN documents d ON p.doc_id IS NOT DISTINCT FROM d.doc_id)
"""

_EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

_DECONTAMINATION_SQL = r"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS MATERIALIZED (SELECT DISTINCT item, list_slice(w, k, k + least(10, len(w)) - 1) AS p, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT row, n, k, list_slice(w, k, k + n - 1) AS p FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM texts, lengths WHERE len(w) >= n)),
finds AS MATERIALIZED (SELECT DISTINCT row, k, places.n AS n, item FROM places JOIN windows ON places.p = windows.p AND places.n = windows.n),
hits AS (SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(k, k + n)) AS word FROM finds) GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item FROM finds) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (row) LEFT JOIN found USING (row)
"""

_COLLOCATIONS_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, size, array_to_string(list_slice(w, k, k + size - 1), ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM split, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
cuts AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS cut FROM f WHERE size > 1),
scored AS (SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r, CAST((2000000::HUGEINT * c.a) // (x.n + y.n) AS BIGINT) AS score FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored),
inside AS (SELECT lang, n, array_to_string(list_slice(w, k, k + m - 1), ' ') AS phrase FROM (SELECT lang, n, w, m, unnest(range(1, size - m + 2)) AS k
  FROM (SELECT lang, n, size, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS m FROM f WHERE size > 2))),
longest AS (SELECT lang, phrase, max(n) AS most FROM inside GROUP BY ALL),
kept AS (SELECT lowest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN longest USING (lang, phrase) WHERE place = 1 AND (most IS NULL OR 100 * most < 80 * a))
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) WHERE rank <= 2000
"""

_SPELLING_SQL = r"""
WITH RECURSIVE table_of AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
  CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS steps),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS MATERIALIZED (SELECT id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL),
coded AS (SELECT run, times, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + (ord(c) >> 6), 128 + ord(c) % 64] END)) AS b FROM counted),
summed AS (SELECT run, times, xor(list_reduce(b, lambda c, x: xor(c >> 8, steps[1 + CAST(xor(c % 256, CAST(x AS BIGINT)) AS INT)]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS h FROM coded, table_of),
words AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS MATERIALIZED (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
near AS MATERIALIZED (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM near),
named AS MATERIALIZED (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * words.n THEN near END AS form, CASE WHEN near_n >= 10 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word AND place = 1),
walk AS (SELECT word, word AS at, form AS next FROM named UNION ALL SELECT walk.word, walk.next, named.form FROM walk JOIN named ON walk.next = named.word)
SELECT named.word, named.form, walk.at AS root, named.n, named.n_near, named.form_n FROM named JOIN walk ON named.word = walk.word AND walk.next IS NULL
"""

ORACLES = {"op1_pii": _pii_sql(), "op5_mixing": _MIXING_SQL, "op6_exact_dedup": _EXACT_SQL, "op11_decontamination": _DECONTAMINATION_SQL, "op12_collocations": _COLLOCATIONS_SQL,
           "op13_spelling": _SPELLING_SQL}
