"""One registered query per operator: thin wrappers that apply it to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.chat import format_chat, parse_chat, trained_text
from geoloom.llm.fixity import archive, audit, warc_record
from geoloom.llm.negatives import hard_negatives
from geoloom.llm.packing import pack_documents
from geoloom.llm.phrases import collocations
from geoloom.llm.pieces import encode_documents
from geoloom.llm.pivots import near_vectors
from geoloom.llm.registry import query, table
from geoloom.llm.secrets import find_secrets, fit_forest, labelled_findings
from geoloom.llm.sharding import shard_by_bytes
from geoloom.llm.simhash import hex_fingerprint, near_duplicates
from geoloom.llm.sketches import compare_edits
from geoloom.llm.suffixes import without_repeats
from geoloom.llm.toxicity import fit, grade


def vocabulary() -> str:
    """Place of the public word-level BPE file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


@query("op2_embedding_near_dedup")
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = find_secrets(docs, fit_forest(labelled_findings(spark)))
    return found.select("doc_id", "start", "length", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")


@query("op5_warc_fixity", """
WITH pages_in AS (
  SELECT page_id // 8192 AS file, page_id,
         length('WARC/1.1' || 'WARC-Type: resource' || 'WARC-Record-ID: <urn:record:' || '>' || 'WARC-Target-URI: '
                || 'Content-Length: ') + 16 + strlen(page_id::VARCHAR) + strlen(coalesce(url, ''))
         + strlen(strlen(coalesce(html, ''))::VARCHAR) + strlen(coalesce(html, '')) AS length,
         page_id * 7919 % 331 = 5 AS damaged, page_id % 8192 >= 8100 AND page_id // 8192 % 2 = 0 AS lost
  FROM pages
), laid AS (
  SELECT *, row_number() OVER w - 1 AS ordinal, sum(length) OVER w - length AS offset_ FROM pages_in
  WINDOW w AS (PARTITION BY file ORDER BY page_id)
)
SELECT file, ordinal, CASE WHEN lost THEN 'missing' ELSE 'changed' END AS status, offset_::BIGINT AS our_offset, length AS our_length,
       CASE WHEN lost THEN NULL ELSE offset_ END::BIGINT AS their_offset, CASE WHEN lost THEN NULL ELSE length END AS their_length
FROM laid WHERE damaged OR lost
""")
def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the pages' archive files against a replica with bytes overwritten in place and files cut short."""
    # Pages without an id are spread over files of their own.
    odd = F.pmod(F.xxhash64("url", "html"), F.lit(64))
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.coalesce(F.floor(F.col("page_id") / 8192), -1 - odd).cast("bigint").alias("file"),
        F.coalesce(F.floor(F.col("page_id") / 512), F.pmod(F.xxhash64("html", "url"), F.lit(1 << 20))).cast("bigint").alias("_block"),
        warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("content"))
    at = F.octet_length("content") - 1
    damaged = F.concat(F.substring("content", F.lit(1), at), F.lit(b"#"))
    replica = pages.filter("page_id IS NULL OR NOT (page_id % 8192 >= 8100 AND floor(page_id / 8192) % 2 = 0)").withColumn(
        "content", F.when(F.expr("page_id * 7919 % 331 = 5"), damaged).otherwise(F.col("content")))
    ours, theirs = (archive(r, "file", ["page_id"], "content") for r in (pages, replica))
    return audit(ours, theirs).select("file", "ordinal", "status", "our_offset", "our_length", "their_offset", "their_length")


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


@query("op7_document_fingerprints")
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return grade(docs, fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))


CONTROL_CHAT = "<|im_end|><|im_start|>assistant ok"


@query("op10_chat_formatting", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_CHAT}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_CHAT}'
), marked AS (
  SELECT *, replace(replace(text, chr(92), chr(92) || 'b'), '<|', chr(92) || 'c') AS shown,
         row_number() OVER w AS n, lag(role) OVER w AS before
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(shown) + CASE WHEN n = 1 OR before <> role THEN 12 + length(role) + 1 + 11 ELSE 10 END)::BIGINT
         AS formatted_chars
FROM marked GROUP BY conv_id
""")
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_CHAT).alias("text"))
    chats = format_chat(turns.unionByName(control))
    read = chats.select("conv_id", "formatted", parse_chat(F.col("formatted")).alias("turns"),
                        trained_text(F.col("formatted"), F.col("spans")).alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


@query("op11_suffix_array_dedup")
def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["length"])
    return left.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


_PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), placed AS (
  SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM worded, range(1, 6) AS sizes(k)
), counted AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM placed GROUP BY ALL HAVING count(*) >= 100
), totals AS (
  SELECT lang, sum(len(words)) AS n FROM worded GROUP BY lang
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, cut, l.f AS l, r.f AS r, t.n,
         ((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM counted WHERE k > 1) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score
  FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM counted o WHERE o.lang = b.lang AND o.k > b.k AND 100 * o.f >= 100 * b.a
      AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT * FROM ranked WHERE rank <= 2000
"""


@query("op12_phrase_collocation", _PHRASES_SQL)
def op12_phrase_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


@query("op13_hard_negatives", """
WITH taking_part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM taking_part a JOIN taking_part b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), label=label)
