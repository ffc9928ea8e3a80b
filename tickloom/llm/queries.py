"""The queries of the numbered operators, and their SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tickloom.llm import chosen_path, langid_crf, merkle, mil, mixing, packing, quality_rules, rans, recompression, sharding, spelling, toxicity, whitening

QUERIES = {}
ORACLES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op1_quality_rules"] = r"""
WITH t AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
), g AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS n
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM t)
), r AS (
    SELECT doc_id, sum(least(3, step)) AS n_repeat_words
    FROM (SELECT doc_id, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 3) AS step FROM g WHERE n > 1)
    GROUP BY doc_id
), c AS (
    SELECT t.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
           CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(regexp_extract_all(text, '\p{Lu}')) AS BIGINT) AS n_capitals,
           CAST(len(regexp_extract_all(text, '[!?]')) AS BIGINT) AS n_marks
    FROM t LEFT JOIN r USING (doc_id)
), v AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           [coalesce(n_symbols * 1000 // nullif(word_chars, 0), 0), coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0),
            coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0), coalesce(n_capitals * 1000 // nullif(word_chars, 0), 0),
            coalesce(n_marks * 1000 // nullif(word_chars, 0), 0), coalesce(word_chars * 100 // nullif(n_words, 0), 0)] AS vs
    FROM c
), p AS (
    SELECT lang, source, s, vs[s] AS x FROM (SELECT lang, source, vs, unnest(range(1, 7)) AS s FROM v WHERE NOT base_failed)
), h AS (
    SELECT lang, source, s, (x >> greatest(0, length(bin(x)) - 7)) << greatest(0, length(bin(x)) - 7) AS b, count(*) AS n
    FROM p GROUP BY ALL
), m AS (
    SELECT 1 AS level, lang, source, s, b, n FROM h
    UNION ALL SELECT 2, lang, NULL, s, b, sum(n) FROM h GROUP BY lang, s, b
    UNION ALL SELECT 3, NULL, NULL, s, b, sum(n) FROM h GROUP BY s, b
), u AS (
    SELECT *, sum(n) OVER (PARTITION BY level, lang, source, s ORDER BY b) AS upto,
           sum(n) OVER (PARTITION BY level, lang, source, s) AS docs FROM m
), q AS (
    SELECT level, lang, source, s, max(docs) AS docs, min(b) FILTER (4 * upto >= docs) AS q1, min(b) FILTER (4 * upto >= 3 * docs) AS q3
    FROM u GROUP BY level, lang, source, s
), y AS (
    SELECT l.lang, l.s, (l.docs * l.q1 + 100 * a.q1) // (l.docs + 100) AS q1, (l.docs * l.q3 + 100 * a.q3) // (l.docs + 100) AS q3
    FROM q l JOIN q a ON a.level = 3 AND a.s = l.s WHERE l.level = 2
), o AS (
    SELECT o.lang, o.source, o.s, (o.docs * o.q1 + 100 * y.q1) // (o.docs + 100) AS q1, (o.docs * o.q3 + 100 * y.q3) // (o.docs + 100) AS q3
    FROM q o JOIN y ON y.s = o.s AND y.lang IS NOT DISTINCT FROM o.lang WHERE o.level = 1
), k AS (
    SELECT lang, source, s, q1 - 3 * greatest(q3 - q1, ([20, 150, 100, 60, 20, 60])[s]) AS low,
           q3 + 3 * greatest(q3 - q1, ([20, 150, 100, 60, 20, 60])[s]) AS high
    FROM o
), bad AS (
    SELECT DISTINCT doc_id FROM (SELECT doc_id, lang, source, vs, unnest(range(1, 7)) AS s FROM v) d
    JOIN k ON k.s = d.s AND k.lang IS NOT DISTINCT FROM d.lang AND k.source IS NOT DISTINCT FROM d.source
    WHERE d.vs[d.s] > k.high OR (d.s = 6 AND d.vs[d.s] < k.low)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM v
"""


@query
def op2_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", mixing.taken().alias("taken"))


ORACLES["op2_mix_sources"] = r"""
WITH d AS (
    SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS k,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           ([3, 1, 2])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM d GROUP BY source
), o AS (
    SELECT *, sum(source_size) OVER () AS total,
           coalesce(sum(source_size) OVER (ORDER BY source_size * (6 // w), source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
           sum(w) OVER (ORDER BY source_size * (6 // w), source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
    FROM s
), p AS (
    SELECT *, (150 * total - 200 * stopped) * w >= 200 * source_size * ws AS stops FROM o
), c AS (
    SELECT source, source_size, CASE WHEN stops THEN CAST(2 * source_size AS DOUBLE)
           ELSE CAST((150 * total - 200 * min(stopped) FILTER (NOT stops) OVER ()) * w AS DOUBLE)
                / CAST(100 * max(ws) FILTER (NOT stops) OVER () AS DOUBLE) END AS target
    FROM p
), r AS (
    SELECT d.doc_id, d.size, c.source_size, c.target,
           CASE WHEN c.source_size > 0 THEN CAST(floor(c.target) AS BIGINT) // c.source_size ELSE 0 END AS epochs,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM r
"""


@query
def op3_fingerprints(spark, sf_dir):
    return merkle.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op3_fingerprints"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, lead(doc_id) OVER (ORDER BY doc_id) AS after, min(doc_id) OVER () AS first FROM documents
), e AS (
    SELECT d.doc_id, d.text, n.text AS next, length(d.text) AS n,
           substr(d.text, 1, length(d.text) - length(d.text) // 2) || substr(n.text, 1, length(d.text) // 2) AS edited
    FROM d JOIN d n ON n.doc_id = coalesce(d.after, d.first)
), x AS (
    SELECT DISTINCT text FROM (SELECT text FROM e UNION ALL SELECT edited FROM e)
), l AS (
    SELECT text, list_transform(string_split(text, chr(10)), lambda l: list_transform(
        regexp_extract_all(l, '[^,.;:!?\n]{1,64}[,.;:!?]*|[,.;:!?]+'), lambda p: md5(p))) AS lines
    FROM x
), p AS (
    SELECT text, list_transform(lines, lambda hs: {
        'node': sha256(coalesce(array_to_string(hs, ''), '')),
        'shown': coalesce(array_to_string(list_transform(hs, lambda h: substr(to_base64(unhex(h)), 1, 4)), ' '), '')}) AS ps
    FROM l
), s AS (
    SELECT text,
           string_split(regexp_replace(array_to_string(list_transform(ps, lambda p: p.node || CASE WHEN p.node < '2' THEN '|' ELSE ';' END), ''), '\|$', ''), '|') AS nodes,
           string_split(regexp_replace(array_to_string(list_transform(ps, lambda p: p.shown || CASE WHEN p.node < '2' THEN '|' ELSE ';' END), ''), '\|$', ''), '|') AS shown
    FROM p
), f AS (
    SELECT text, sha256(array_to_string(list_transform(nodes, lambda n: sha256(n)), '')) || ' ' || array_to_string(
        list_transform(range(1, len(nodes) + 1), lambda i: substr(sha256(nodes[i]), 1, 8) || ':' || shown[i]), '|') AS print
    FROM s
), g AS (
    SELECT text, print, list_filter(list_distinct(regexp_split_to_array(substr(print, 66), '[0-9a-f]{8}:|[ ;|]')), lambda c: c <> '') AS pieces FROM f
), r AS (
    SELECT e.doc_id, e.n, e.edited, a, b, c FROM e JOIN g a ON a.text = e.text JOIN g b ON b.text = e.edited JOIN g c ON c.text = e.next
)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, a.print AS fingerprint, b.print AS edited_fingerprint,
       CASE WHEN substr(a.print, 1, 64) = substr(b.print, 1, 64) THEN 1.0::DOUBLE WHEN len(a.pieces) + len(b.pieces) = 0 THEN 0.0::DOUBLE
            ELSE CAST(len(list_intersect(a.pieces, b.pieces)) AS DOUBLE) * 2 / CAST(len(a.pieces) + len(b.pieces) AS DOUBLE) END AS near_edited,
       CASE WHEN substr(a.print, 1, 64) = substr(c.print, 1, 64) THEN 1.0::DOUBLE WHEN len(a.pieces) + len(c.pieces) = 0 THEN 0.0::DOUBLE
            ELSE CAST(len(list_intersect(a.pieces, c.pieces)) AS DOUBLE) * 2 / CAST(len(a.pieces) + len(c.pieces) AS DOUBLE) END AS near_next
FROM r
"""


@query
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid_crf.train(docs.select("doc_id", "text", "lang"))
    found = langid_crf.identify(docs.select("doc_id", "text"), model)
    return found.withColumn("held_out", langid_crf.held_out())


@query
def op5_shards(spark, sf_dir):
    rows = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op6_near_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chosen_path.join(docs).select("doc_id", "class_id", "n_links", "n_text_links")


@query
def op7_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mil.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return mil.score(docs, model, ["doc_id"]).withColumn("held_out", mil.held_out())


@query
def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~toxicity.held_out())
    chain = toxicity.train(docs, labels)
    return toxicity.score(docs, chain, ["doc_id"]).withColumn("held_out", toxicity.held_out())


@query
def op9_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = rans.token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return rans.read(spark, folder).drop("ids")


@query
def op10_pack(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query
def op11_repeated_passages(spark, sf_dir):
    rows = recompression.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op11_repeated_passages"] = r"""
WITH t AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
    SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM t)
), f AS (
    SELECT h, min(doc_id) AS first FROM w GROUP BY h
), c AS (
    SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM w JOIN f USING (h) WHERE first < doc_id)
), p AS (
    SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM t
), k AS (
    SELECT p.doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM p ANTI JOIN c USING (doc_id, j) GROUP BY p.doc_id
)
SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce((SELECT count(*) FROM c WHERE c.doc_id = t.doc_id), 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)
"""


@query
def op12_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op12_spelling"] = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS t
    FROM range(256) r(i)
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents
), lowered AS (
    SELECT CAST(doc_id AS VARCHAR) AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
    FROM runs GROUP BY ALL
), hashed AS (
    SELECT run, times, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(1, CAST(length(hex(encode(id || ':' || run))) // 2 + 1 AS BIGINT)),
            lambda i: CAST('0x' || substr(hex(encode(id || ':' || run)), 2 * i - 1, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS h
    FROM lowered, crc
), damaged AS (
    SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), v AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), gaps AS (
    SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE substr(word, 1, i - 1) || substr(word, i + 1) END AS gap
    FROM (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM v)
), near AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b USING (gap)
    WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word
), forms AS (
    SELECT v.word, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN most >= 10 * v.n THEN most END AS form_n,
           CASE WHEN most >= 10 * v.n THEN (SELECT min(other) FROM near WHERE near.word = v.word AND other_n = most) END AS form
    FROM v LEFT JOIN best USING (word)
), paths AS (
    SELECT word, word AS root, form FROM forms
    UNION ALL SELECT p.word, f.word, f.form FROM paths p JOIN forms f ON f.word = p.form
)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n FROM forms f JOIN paths p ON p.word = f.word AND p.form IS NULL
"""


@query
def op13_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, whitening.fit(rows))
