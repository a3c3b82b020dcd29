"""The corpus operators over the driver's tables, with production parameters, and SQL that says the same where it can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, html_text, infill, langid, mixing, ngram_join, secrets, token_output, topk, toxicity, url_filter, vector_codes
from .common import table


def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")), spans=True)


def op2_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op3_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding"))).select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op5_language_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), words=4, similarity=(85, 100))


def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def probe_conversation(spark: SparkSession) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")


def op8_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe_conversation(spark))
    chats = chat_format.format_chats(turns.select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts")))
    read = chats.select("conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("t"), F.array_join(chat_format.read_loss(F.col("formatted"), F.col("mask")), "").alias("loss"), "attachments", "n_attachment_tokens")
    return read.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.size("attachments").cast("long").alias("n_attachments"), "n_attachment_tokens",
    )


def op9_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.read_tokens(token_output.write_tokens(table(spark, sf_dir, "documents")))


def op10_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_filtering_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(codes.coded).select("vec_id", "code", "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def op12_infill_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.infill(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_toxicity_crf, op2_url_redirects, op3_secret_novelty, op4_bit_sliced_topk, op5_language_pieces, op6_ngram_jaccard, op7_suffix_automaton, op8_chat_parts, op9_simple8b_tokens, op10_budget_mix, op11_filtering_codes, op12_infill_lines, op13_html_text, pipeline)}

_ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HOST, _PATH = _ASCII.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)"), "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

_LOWER_TEXT = _ASCII.format("coalesce(text, '')")
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"



def _codes_sql(rounds: int = 6) -> str:
    """Lloyd's rounds by brute force: every part against every entry, one pair of steps for each round."""
    near = """
        a{i} AS MATERIALIZED (SELECT r, p, min(d * 16 + e) AS m FROM (SELECT r, p, e, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v JOIN b{i} b USING (p)) GROUP BY r, p),"""
    mean = """
        b{n} AS MATERIALIZED (SELECT p, e, coalesce(y, b.x) AS x FROM b{i} b LEFT JOIN
          (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS y FROM
            (SELECT p, m % 16 AS e, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM a{i} JOIN v USING (r, p), (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM v))) AS j) GROUP BY ALL) GROUP BY p, e) USING (p, e)),"""
    steps = "".join(near.format(i=i) + mean.format(i=i, n=i + 1) for i in range(rounds)) + near.format(i=rounds)
    return f"""
        WITH w AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS x FROM embeddings
                   WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        v AS MATERIALIZED (SELECT r, p, x[p * len(x) // 8 + 1:(p + 1) * len(x) // 8] AS x FROM w, (SELECT unnest(range(8)) AS p)),
        b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM v WHERE r <= 16),{steps}
        c AS (SELECT r, string_agg(format('{{:02x}}', m % 16), '' ORDER BY p) AS code, sum(m // 16)::BIGINT AS error FROM a{rounds} GROUP BY r),
        h AS (SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM w JOIN c USING (r), h"""


ORACLE_SQL = {
    # no page of the tables names a redirect or canonical target, so the rules and the default decide there
    "op2_url_redirects": f"""
        WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
        r(verdict, h, q) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
        m AS (SELECT page_id, arg_max(h || q, length(h || q)) AS rule, arg_max(verdict, length(h || q)) AS verdict
              FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
        SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict, CASE WHEN verdict IS NULL THEN 'default' ELSE 'rule' END AS via
        FROM p LEFT JOIN m ON p.page_id = m.page_id""",
    "op4_bit_sliced_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(list_zip(q.x, r.x), lambda z: z[1] * z[2]))::BIGINT AS score
              FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    # links by counts of shared shingles; the least id that is reached spreads along them
    "op6_ngram_jaccard": f"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex({_LOWER_TEXT}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
                    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS g FROM d),
        n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
        l AS (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY ALL) JOIN n p ON p.r = a JOIN n q ON q.r = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
        c(r, m) AS (SELECT r, doc_id FROM d UNION SELECT l.b, c.m FROM c JOIN l ON l.a = c.r)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, t.m AS component_id FROM d LEFT JOIN n USING (r) JOIN (SELECT r, min(m) AS m FROM c GROUP BY r) t USING (r)""",
    "op7_suffix_automaton": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER_TEXT}, '{_WORD}') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER_TEXT}, '{_WORD}') AS w FROM benchmark),
        i AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: list_aggregate(w[k:k + n - 1], 'string_agg', ' '))) AS g FROM (SELECT *, least(len(w), 10) AS n FROM b) WHERE n > 0),
        t AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS k, w FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n),
        h AS (SELECT t.r, t.k, t.n, i.item_id FROM (SELECT r, k, n, list_aggregate(w[k:k + n - 1], 'string_agg', ' ') AS g FROM t) t JOIN i USING (n, g)),
        p AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS k FROM h) GROUP BY r),
        e AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN p USING (r) LEFT JOIN e USING (r)""",
    "op8_chat_parts": """
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e AS (SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')) + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'))
                        + length('<|turn|><|says|><|done|>') + 1 AS n FROM c),
        g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
                     coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(n)::BIGINT AS formatted_chars FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(t) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
               0::BIGINT AS n_attachments, 0::BIGINT AS n_attachment_tokens FROM g""",  # the table's texts are one text part each
    "op11_filtering_codes": _codes_sql(),
    "op12_infill_lines": """
        WITH h AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        k AS (SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS h1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS h2, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM h),
        c AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form,
                     array_to_string(u[1:least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS m, array_to_string(u[greatest(h1, h2) + 1:], '') AS s FROM k)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM c""",
    # the tables' articles are marked as such and hold headings, paragraphs, bold text and line breaks only
    "op13_html_text": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS h FROM pages),
        b AS (SELECT page_id, url, regexp_replace(regexp_replace(h, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
        c AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&amp;?', '&', 'g') AS t FROM b),
        d AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM c)
        SELECT page_id, url, text, length(text) AS n_chars FROM d""",
}
