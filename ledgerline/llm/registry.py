"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, score_toxicity, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import nearest

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, keep=["doc_id"]).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge_quality

    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import decode_pieces, encode_pieces

    encoded = encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    encoded = encoded.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "piece_ids")
    return decode_pieces(encoded).select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), F.xxhash64("piece_ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.sha2("decoded", 256) == F.col("text_sha256")).alias("lossless"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_reply_trees, linear_replies, read_loss, read_turns

    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = format_reply_trees(linear_replies(rows))
    out = out.withColumn("turns", read_turns(F.col("formatted"))).withColumn("loss", read_loss(F.col("formatted"), F.col("loss_spans")))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc"), "text")
    return jaccard_components(docs).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licences import licence_files

    # The tables have no file names: a document lies in the directory of its source and language.
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return licence_files(files)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import weighted_fair_mix

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return weighted_fair_mix(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .importance import importance_resample

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_resample(docs, table(spark, sf_dir, "benchmark").select("text"), keep=["doc_id"])


def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .personal import KINDS, find_personal_data, listed

    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), masked=False)
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    base = F.filter(spans, lambda s: s["plain"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_nearest": op2_nearest,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality": op4_quality,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_chat_format": op6_chat_format,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_licence_scan": op8_licence_scan,
    "op9_url_filter": op9_url_filter,
    "op10_mixing": op10_mixing,
    "op11_importance": op11_importance,
    "op12_personal": op12_personal,
    "op13_spelling": op13_spelling,
}

_WORDS = "list_filter(regexp_split_to_array(coalesce({}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 of a text's UTF-8 bytes: each byte goes in, then eight steps of one bit (-1).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(length(hex({0})) // 2),
            lambda i: [('0x' || substr(hex({0}), 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END))"""

ORACLE: dict[str, str] = {
    # a word goes if a window of 50 that covers it starts in a smaller document too
    "op3_substring_dedup": f"""
        WITH docs AS (SELECT doc_id, {_WORDS.format('text')} AS ws FROM documents),
        places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM docs WHERE len(ws) >= 50),
        wins AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS seq FROM places),
        holders AS (SELECT seq, min(doc_id) AS holder FROM wins GROUP BY seq),
        gone AS (SELECT DISTINCT doc_id, i + k AS i FROM wins JOIN holders USING (seq), range(50) AS t(k) WHERE holder < doc_id),
        words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM docs),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
                 FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    # a mark before and after the role, one after the text; each backslash, < and [ of a text takes one more character
    "op6_chat_format": r"""
        WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                      UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(12 + 10 + 11 + length(role || text) + length(regexp_replace(role || text, '[^\\<\[]', '', 'g'))) AS BIGINT) AS formatted_chars
        FROM said GROUP BY conv_id""",
    # links by counted common shingles, groups by following links
    "op7_jaccard_join": f"""
        WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
        places AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM docs WHERE len(ws) > 0),
        sets AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS shingle FROM places),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT a, y FROM reach JOIN links ON x = b)
        SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(b) AS component_id
        FROM docs d JOIN reach ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id""",
    # aliases by following links between the pages that urls lead to
    "op9_url_filter": r"""
        WITH RECURSIVE tags AS (
            SELECT url, unnest(list_concat(
                list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b')),
                               lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
                list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<meta\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
                               lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))) AS raw FROM pages),
        hrefs AS (SELECT url, replace(raw, '&amp;', '&') AS link, 'http://' || regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) AS root,
                         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS place FROM tags WHERE raw <> ''),
        links AS (SELECT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link WHEN starts_with(link, '//') THEN 'http:' || link
                         WHEN starts_with(link, '/') THEN root || link WHEN starts_with(link, '?') THEN root || place || link WHEN starts_with(link, '#') THEN url
                         ELSE root || regexp_extract(place, '^(.*/)?') || CASE WHEN contains(place, '/') THEN '' ELSE '/' END || link END AS target FROM hrefs),
        urls AS (SELECT url FROM pages UNION SELECT target FROM links),
        parts AS (SELECT url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
                         list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)', 1), '&'),
                                               lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[^=]*|fbclid|gclid|ref)(=|$)'))) AS query FROM urls),
        rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        fits AS (SELECT url, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
                 FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY url),
        judged AS (SELECT a.url, host, path, rule, verdict,
                          CASE WHEN regexp_replace(host, ':(80|443)?$', '') <> '' THEN regexp_replace(host, ':(80|443)?$', '') || rtrim(path, '/')
                               || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS node
                   FROM parts a LEFT JOIN fits f ON f.url = a.url),
        edges AS (SELECT DISTINCT a.node AS u, b.node AS v FROM links l JOIN judged a ON a.url = l.url JOIN judged b ON b.url = l.target WHERE a.node <> b.node),
        both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
        reach AS (SELECT DISTINCT node AS a, node AS b FROM judged WHERE node IS NOT NULL UNION SELECT a, v FROM reach JOIN both_ways ON u = b),
        alias AS (SELECT a, CASE WHEN bool_or(verdict = 'allow') THEN 'allow' WHEN bool_or(verdict = 'block') THEN 'block' END AS verdict
                  FROM reach JOIN judged ON node = b GROUP BY a)
        SELECT page_id, host, path, rule, coalesce(j.verdict, s.verdict, 'allow') AS verdict
        FROM pages p JOIN judged j ON j.url IS NOT DISTINCT FROM p.url LEFT JOIN alias s ON s.a = j.node""",
    # counts by bucket, gains by bucket, sums by document, then one ordered draw
    "op11_importance": f"""
        WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
        aims AS (SELECT unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
        places AS (SELECT doc_id, unnest(ws) AS w FROM docs),
        seen AS (SELECT w, sum(s) AS s, sum(t) AS t FROM (SELECT w, 1 AS s, 0 AS t FROM places UNION ALL SELECT w, 0, 1 FROM aims) GROUP BY w),
        coded AS (SELECT w, s, t, {_CRC.format("w")} % 10000 AS bucket FROM seen),
        counts AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM coded GROUP BY bucket),
        totals AS (SELECT sum(s) AS cs, sum(t) AS ct FROM counts),
        gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (cs + 10000)) / ((s + 1) * (ct + 10000))))::BIGINT AS gain FROM counts, totals),
        weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM places JOIN coded USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
        scores AS (SELECT d.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                          coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
                   FROM docs d LEFT JOIN weights g ON g.doc_id = d.doc_id),
        fit AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
        SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scores s LEFT JOIN fit f ON f.doc_id = s.doc_id""",
    # near words share what is left when a letter is deleted from one or both at the same place
    "op13_spelling": f"""
        WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
        per_doc AS (SELECT doc_id, run, count(*) AS n, doc_id || ':' || run AS key FROM runs WHERE length(run) >= 6 GROUP BY ALL),
        coded AS (SELECT run, n, {_CRC.format("key")} AS h FROM per_doc),
        said AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM coded),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM said WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        pairs AS (SELECT a.word AS w, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
                  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
                  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
        best AS (SELECT w, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS best FROM pairs GROUP BY w),
        found AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.less >= 5 * n THEN best.other END AS form,
                         CASE WHEN -best.less >= 5 * n THEN -best.less END::BIGINT AS form_n FROM words LEFT JOIN best ON w = word),
        ways AS (SELECT word, word AS root FROM found UNION ALL SELECT y.word, f.form FROM ways y JOIN found f ON f.word = y.root WHERE f.form IS NOT NULL),
        ends AS (SELECT y.word, y.root FROM ways y JOIN found f ON f.word = y.root WHERE f.form IS NULL)
        SELECT found.word, form, root, n, n_near, form_n FROM found JOIN ends ON ends.word = found.word""",
}
