"""The corpus operators as queries over the test tables, with the SQL that some of them can be checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardline.llm import (collocations, exact_topk, fim, gam, mixing, ngram_rules, packing, pq, simhash, suffix, surrogates,
                          toxicity, warc)
from wardline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_suffix(spark, sf):
    return suffix.remove_repeats(table(spark, sf, "documents"))


@query
def op2_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@query
def op3_pq(spark, sf):
    return pq.near_duplicates(table(spark, sf, "embeddings"))


@query
def op4_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@query
def op5_ngram_rules(spark, sf):
    docs = table(spark, sf, "documents")
    trusted = table(spark, sf, "labels").where("quality = 1")
    return ngram_rules.judge(docs, ngram_rules.log_ratios(docs, trusted))


@query
def op6_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op7_warc(spark, sf):
    return warc.round_trip(table(spark, sf, "pages"))


@query
def op8_gam(spark, sf):
    docs = table(spark, sf, "documents")
    return gam.score(docs, gam.fit(docs, table(spark, sf, "labels")))


@query
def op9_mixing(spark, sf):
    found = mixing.taken(mixing.mix(table(spark, sf, "documents")))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_surrogates(spark, sf):
    return surrogates.replace_entities(table(spark, sf, "documents").select("doc_id", "text"), count="n_replaced")


@query
def op11_fim(spark, sf):
    found = fim.fill_in_middle(table(spark, sf, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query
def op12_exact_topk(spark, sf):
    return exact_topk.top_k(table(spark, sf, "embeddings"), F.col("key") % 50 == 0)


@query
def op13_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


ORACLE_SQL["op7_warc"] = """
    WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
    kept AS (SELECT digest, max(page_id) AS kept_id FROM payloads WHERE n >= 1000 GROUP BY digest)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, payloads.digest AS payload_digest,
           CASE WHEN kept_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN kept_id <> page_id THEN kept_id END AS refers_to
    FROM payloads LEFT JOIN kept ON kept.digest = payloads.digest AND n >= 1000"""

_TOKENS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_DRAWS = ", ".join(f"CAST('0x' || substr(digits, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
ORACLE_SQL["op11_fim"] = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digits,
                          regexp_extract_all(coalesce(text, ''), '{_TOKENS}') AS tokens FROM documents),
    drawn AS (SELECT *, CAST(len(tokens) AS BIGINT) AS n, {_DRAWS} FROM texts),
    cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                        WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (SELECT *, array_to_string(tokens[1:a], '') AS p, array_to_string(tokens[a + 1:b], '') AS m,
                     array_to_string(tokens[b + 1:], '') AS s FROM cut)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts"""
ORACLE_SQL["op12_exact_topk"] = """
    WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
               FROM whole AS q JOIN whole AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
ORACLE_SQL["op13_collocations"] = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
    starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists),
    grams AS (SELECT lang, words[i:i + k - 1] AS gram, k FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(words)),
    counts AS (SELECT lang, gram, k, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
    totals AS (SELECT lang, CAST(count(*) AS HUGEINT) AS n FROM starts GROUP BY lang),
    candidates AS (SELECT lang, gram, k, f AS a FROM counts WHERE k >= 2),
    cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
    scored AS (
        SELECT cuts.lang, cuts.gram, cuts.cut, a, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
        FROM cuts JOIN totals USING (lang)
        JOIN counts AS x ON x.lang = cuts.lang AND x.gram = cuts.gram[1:cuts.cut]
        JOIN counts AS y ON y.lang = cuts.lang AND y.gram = cuts.gram[cuts.cut + 1:]),
    least_cut AS (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) AS place FROM scored),
    spans AS (SELECT lang, gram, a, m, unnest(range(1, k - m + 2)) AS i FROM candidates, (SELECT unnest(range(2, 5)) AS m) WHERE m < k),
    inside AS (SELECT lang, gram[i:i + m - 1] AS gram, max(a) AS longer FROM spans GROUP BY ALL),
    kept AS (SELECT s.*, array_to_string(s.gram, ' ') AS phrase FROM least_cut AS s LEFT JOIN inside USING (lang, gram)
             WHERE place = 1 AND (longer IS NULL OR 100 * longer < 100 * a)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
           CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked WHERE rank <= 2000"""
