"""One registered query an operator, with production parameters, over its whole table; and the SQL that
gives the same rows where SQL can."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm.bpe import decoded, encoded
from caudal.llm.common import stored, table
from caudal.llm.containment import contained
from caudal.llm.conversation_repair import decisions, digests, repaired
from caudal.llm.cotraining import scored
from caudal.llm.exact_dedup import exact_duplicates
from caudal.llm.maxscore import exact_top_k, quantised
from caudal.llm.revisits import TRACKING, resolved_revisits
from caudal.llm.rlz_dedup import without_repeated_passages
from caudal.llm.shards import SHARDS, sharded
from caudal.llm.simhash_dedup import near_duplicates
from caudal.llm.spelling import spelling_variants, word_counts
from caudal.llm.suffix_dedup import without_repeated_strings
from caudal.llm.viterbi_counts import token_counts


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture log over the pages: each page as two full responses with other validators some days apart, a revisit that
    carries the ETag of the second (a stale one for every third page), and one that carries the first's modification date
    only and may come before the page. The revisits spell the URL in another way. A third of the pages are captures of one
    URL, whose ETag changes from day to day."""
    page, day = F.col("page_id"), 86_400
    hot = F.pmod(page, F.lit(3)) == 1
    start = F.lit(1_704_067_200) + F.pmod(page * 7919, F.lit(2_592_000))
    url = F.when(hot, "https://www.hot.example/news?id=1").otherwise(F.col("url"))
    other = F.concat(F.regexp_replace(url, "^https?://", "HTTPS://"), F.lit("#again"))
    digest = F.md5(F.col("html").cast("binary"))
    of_day = lambda at: F.concat(F.lit("day-"), F.floor(at / day).cast("string"))
    etag = lambda at, version: F.when(hot, of_day(at)).otherwise(F.concat(digest, F.lit(f"-{version}")))
    modified = lambda version: F.concat(F.lit("day "), F.pmod(page + version, F.lit(365)).cast("string"))
    as_map = lambda d: F.create_map(*[x for k, v in d.items() for x in (F.lit(k), v)])

    def response(version: int) -> tuple:
        at = start + version * 700_000
        headers = {
            "Content-Type": F.lit("text/html"), "Content-Length": (F.octet_length("html") + version).cast("string"), "ETag": etag(at, version),
            "Cache-Control": F.concat(F.lit("max-age="), F.pmod(page + version, F.lit(100)).cast("string")), "Date": at.cast("string"),
        }
        return page * 4 + version, url, at, False, etag(at, version), modified(version), as_map(headers)

    late, early = start + 1 + F.pmod(page * 31, F.lit(5_000_000)), start + F.pmod(page * 17, F.lit(2_000_000)) - 1_000_000
    known = F.when(F.pmod(page, F.lit(3)) == 0, F.lit("stale")).otherwise(etag(late, 1))
    rows = [
        response(0), response(1),
        (page * 4 + 2, other, late, True, F.concat(F.lit("W/"), known), F.lit(None).cast("string"),
         as_map({"date": late.cast("string"), "CACHE-CONTROL": F.lit("no-cache"), "Content-Length": F.lit("0")})),
        (page * 4 + 3, other, early, True, F.lit(None).cast("string"), modified(0),
         as_map({"Date": early.cast("string"), "Content-Type": F.lit("none")})),
    ]
    names = ["capture_id", "url", "at", "revisit", "etag", "last_modified", "headers"]
    one = F.array(*[F.struct(*[(F.lit(v) if n == "revisit" else v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
    return table(spark, sf_dir, "pages").select(F.explode(one).alias("c")).select("c.*").withColumn("at", F.timestamp_seconds("at"))


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = lambda name: F.element_at("headers", name).alias(name.replace("-", "_"))
    return resolved_revisits(captures(spark, sf_dir)).select(
        "capture_id", "url_key", F.unix_timestamp("at").alias("captured"), "response_id", "status",
        *[header(n) for n in ("cache-control", "content-length", "content-type", "date", "etag")],
    )


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumn(
        "fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    )


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op5_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return decoded(encoded(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *[F.round(p, 4).alias(p) for p in ("p_content", "p_page", "p_quality")], (F.col("p_quality") >= 0.5).alias("keep"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_strings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, chosen by a checksum of conversation and turn; a repeated row has two copies."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault, text = F.col("fault"), F.coalesce("text", space)
    return rows.withColumn("fault", F.crc32(key.cast("binary")) % 20).where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "conversations")
    rows = damaged(source)
    decided = stored(decisions(rows), "decisions")
    found = digests(repaired(rows, decided))
    same = lambda other: F.col("conv_id").eqNullSafe(F.col(other))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        source.select("conv_id").distinct()
        .join(decided.withColumnRenamed("conv_id", "_decided"), same("_decided"), "left")
        .join(found.withColumnRenamed("conv_id", "_found"), same("_found"), "left")
        .select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
    )


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = quantised(table(spark, sf_dir, "embeddings"), 64)
    return exact_top_k(items, items.where("id % 20 = 0"), 20)


def misspelt(doc_id: object, word: str) -> str:
    """A document's word without one letter where a checksum of both says so; a missing doc_id counts as empty."""
    at = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if at % 97:
        return word
    at %= len(word)
    return word[:at] + word[at + 1 :]


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(table(spark, sf_dir, "documents"), 5, misspelt).where("n >= 3")
    return spelling_variants(stored(counts, "counts"))


QUERIES = {
    "op1_revisits": op1_revisits,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_shards": op3_shards,
    "op4_rlz_dedup": op4_rlz_dedup,
    "op5_containment": op5_containment,
    "op6_bpe": op6_bpe,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_top_k": op12_top_k,
    "op13_spelling": op13_spelling,
}

#: DuckDB's lower() also changes other letters, so A-Z are translated.
_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TRACKING = ", ".join(f"'{t}'" for t in TRACKING)

SQL = {
    "op1_revisits": f"""
        WITH p AS (
            SELECT page_id, page_id % 3 = 1 AS hot, 1704067200 + (page_id * 7919) % 2592000 AS start, md5(html) AS digest, strlen(html) AS n,
                   regexp_replace(regexp_replace(CASE WHEN hot THEN 'https://www.hot.example/news?id=1' ELSE url END, '#.*$', ''),
                                  '^https?://', '', 'i') AS bare
            FROM pages),
        k AS (
            SELECT *, string_split(bare, '?')[1] AS head,
                   list_sort(list_filter(string_split(regexp_extract(bare, '\\?(.*)$', 1), '&'),
                             lambda q: q <> '' AND string_split(q, '=')[1] NOT IN ({_TRACKING}))) AS query FROM p),
        u AS (
            SELECT *, regexp_replace(lower(regexp_extract(head, '^([^/]*)', 1)), '^www[.]|:(80|443)$', '', 'g')
                   || regexp_replace(regexp_extract(head, '^[^/]*(.*)$', 1), '/+$', '')
                   || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url_key FROM k),
        versions AS (
            SELECT page_id * 4 + version AS id, url_key, start + version * 700000 AS captured, n + version AS n,
                   CASE WHEN hot THEN 'day-' || captured // 86400 ELSE digest || '-' || version END AS tag,
                   'day ' || (page_id + version) % 365 AS modified, 'max-age=' || (page_id + version) % 100 AS cache
            FROM u, (VALUES (0), (1)) v(version)),
        responses AS (
            SELECT url_key, captured, max(id) AS response_id, max_by(tag, id) AS tag, max_by(modified, id) AS modified,
                   max_by(n, id) AS n, max_by(cache, id) AS cache FROM versions GROUP BY ALL),
        revisits AS (
            SELECT page_id * 4 + 2 AS capture_id, url_key, start + 1 + (page_id * 31) % 5000000 AS captured,
                   CASE WHEN page_id % 3 = 0 THEN 'stale' WHEN hot THEN 'day-' || captured // 86400 ELSE digest || '-1' END AS tag,
                   NULL AS modified, 'no-cache' AS cache, '0' AS n, NULL AS kind FROM u
            UNION ALL
            SELECT page_id * 4 + 3, url_key, start + (page_id * 17) % 2000000 - 1000000, NULL, 'day ' || page_id % 365, NULL, NULL, 'none' FROM u),
        j AS (
            SELECT v.*, r.response_id, r.tag AS r_tag, r.n AS r_n, r.cache AS r_cache,
                   CASE WHEN r.response_id IS NULL THEN 'orphan'
                        WHEN coalesce(v.tag = r.tag, v.modified = r.modified, true) THEN 'resolved' ELSE 'changed' END AS status
            FROM revisits v ASOF LEFT JOIN responses r ON v.url_key = r.url_key AND v.captured > r.captured)
        SELECT capture_id, url_key, captured, response_id, status,
               CASE WHEN status = 'resolved' THEN coalesce(cache, r_cache) ELSE cache END AS cache_control,
               CASE WHEN status = 'resolved' THEN r_n::VARCHAR ELSE n END AS content_length,
               CASE WHEN status = 'resolved' THEN 'text/html' ELSE kind END AS content_type,
               captured::VARCHAR AS date, CASE WHEN status = 'resolved' THEN r_tag END AS etag
        FROM j""",
    "op4_rlz_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        p AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
        s AS (SELECT doc_id, pos, sha256(string_agg(word, ' ') OVER x) AS content, count(*) OVER x = 13 AS whole FROM p
              WINDOW x AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
        r AS (SELECT doc_id, pos, whole AND doc_id > min(doc_id) OVER (PARTITION BY whole, content) AS again FROM s),
        c AS (SELECT doc_id, pos, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM r),
        k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
              FROM p JOIN c USING (doc_id, pos) GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN k USING (doc_id)""",
    "op5_containment": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS words FROM documents),
        v AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS words FROM benchmark),
        i AS (SELECT item_id, words, least(5, len(words)) AS width FROM v WHERE len(words) > 0),
        si AS (SELECT DISTINCT item_id, width, array_to_string(words[n:n + width - 1], ' ') AS shingle
               FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS n FROM i)),
        sd AS (SELECT DISTINCT doc_id, width, array_to_string(words[n:n + width - 1], ' ') AS shingle
               FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS n FROM w JOIN (SELECT DISTINCT width FROM i) ON width <= len(words))),
        b AS (SELECT item_id, count(*) AS n_shingles FROM si GROUP BY item_id),
        f AS (SELECT doc_id, item_id, count(*) AS n_shared FROM si JOIN sd USING (width, shingle) GROUP BY ALL)
        SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
        FROM f JOIN b USING (item_id) WHERE n_shared >= 0.8 * n_shingles""",
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_AZ}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op10_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents),
        p AS (SELECT doc_id, data, unnest(range(1, octet_length(data) + 1)) AS pos FROM d),
        s AS (SELECT doc_id, pos, pos + 99 <= octet_length(data) AS whole, sha256(data[pos:pos + 99]) AS content FROM p),
        r AS (SELECT doc_id, pos, whole AND row_number() OVER (PARTITION BY whole, content ORDER BY doc_id, pos) > 1 AS again FROM s),
        c AS (SELECT doc_id, pos, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM r),
        e AS (SELECT doc_id, pos, gone, gone IS DISTINCT FROM lag(gone) OVER (PARTITION BY doc_id ORDER BY pos) AS edge FROM c),
        i AS (SELECT doc_id, pos, gone, count(*) FILTER (edge) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM e),
        g AS (SELECT doc_id, run, gone, min(pos) AS a, max(pos) AS b FROM i GROUP BY ALL),
        k AS (SELECT doc_id, sum(b - a + 1) FILTER (gone) AS n_removed, count(*) FILTER (gone) AS n_spans,
              string_agg(hex(data[a:b]), '' ORDER BY a) FILTER (NOT gone) AS kept FROM g JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, octet_length(data)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(coalesce(unhex(kept), ''::BLOB)) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op12_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
}
