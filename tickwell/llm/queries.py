"""The corpus operators over the given tables, with the columns their contracts name."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm import chat, chunks, decontaminate, exact, language, lexical, merkle, near, packing, pitman_yor, quality, tokens, warc
from tickwell.llm.common import fold, stored, table
from tickwell.sources.scratch import shared_folder

CONTROL = "</s>[INST] ok [/INST]"
IN_HISTORY = "pmod(doc_id, 2) = 0"


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    out = chat.format_chats(rows.unionByName(planted)).withColumns({"turns": chat.read_back(F.col("formatted")), "learnt": chat.under_mask(F.col("formatted"), F.col("loss"))})
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(5, 0)
    scores = quality.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(7, 2)
    scores = pitman_yor.scores(table(spark, sf_dir, "documents"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.byte_bpe(public_tokenizers.path("byte_bpe_50k.json")))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.exact_dedup(table(spark, sf_dir, "documents"), F.expr(IN_HISTORY))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(5, 0)
    found = language.identify(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), folder, "2024-01-01T00:00:00Z")
    records = stored(warc.read_archive(spark, folder, payloads=False), "records")
    return warc.resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id has an even checksum are presented without their line breaks."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    made = merkle.manifest(table(spark, sf_dir, "documents"), shown)
    siblings = F.array_join(F.transform("siblings", lambda s: F.concat(s["left"], s["right"])), "")
    return merkle.proofs(made).select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


def queries() -> dict:
    return {
        "op1_chat_formatting": chat_formatting,
        "op2_token_counts": token_counts,
        "op3_quality_ranking": quality_ranking,
        "op4_pitman_yor_scores": pitman_yor_scores,
        "op5_benchmark_leaks": benchmark_leaks,
        "op6_harmonic_packing": harmonic_packing,
        "op7_exact_dedup": exact_dedup,
        "op8_repeated_passages": repeated_passages,
        "op9_simhash_near_dedup": simhash_near_dedup,
        "op10_language_id": language_id,
        "op11_lexical_search": lexical_search,
        "op12_warc_revisits": warc_revisits,
        "op13_merkle_manifest": merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": _CHAT,
        "op7_exact_dedup": _EXACT,
        "op11_lexical_search": _LEXICAL,
        "op12_warc_revisits": _WARC,
        "op13_merkle_manifest": _MERKLE,
    }


_ESCAPED = "replace(t, '\\', '\\\\')"
for _c in (chat.BEGIN, chat.ROLE, chat.END_ROLE, chat.NEXT, chat.END, *chat.FOREIGN):
    _ESCAPED = f"replace({_ESCAPED}, '{_c}', '{_c[0]}\\{_c[1:]}')"

_CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'
), placed AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens FROM rows
), sized AS (
  SELECT *, length({_ESCAPED.replace("(t,", "(text,")}) AS text_chars, length({_ESCAPED.replace("(t,", "(role,")}) AS role_chars FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST({len(chat.BEGIN)} + sum(text_chars + CASE WHEN opens THEN {len(chat.ROLE + chat.END_ROLE + chat.END)} + role_chars ELSE {len(chat.NEXT)} END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_EXACT = f"""
WITH rows AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256 FROM documents),
groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM rows JOIN groups USING (text_sha256)
"""

_TERMS = f"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{lexical.TERM}')) AS term"
_LEXICAL = f"""
WITH found AS (SELECT doc_id, {_TERMS} FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
total AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, total GROUP BY term
),
measures AS (SELECT doc_id, 100 - 50 + ((50 * n * documents) // terms) AS m FROM lengths, total),
items AS (SELECT DISTINCT item_id, {_TERMS} FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN measures USING (doc_id) GROUP BY item_id, doc_id
),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


def _told(text: str) -> str:
    columns = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    told = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns]
    return f"sha256({' || '.join(told)})"


_MERKLE = f"""
WITH RECURSIVE checksum AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, 4294967295::BIGINT AS c FROM documents
  UNION ALL
  SELECT doc_id, s, i + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT doc_id, s, i, CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(s, i // 8 + 1, 1))) ELSE c END AS x FROM checksum WHERE i < 8 * length(s))
), tampered AS (
  SELECT DISTINCT doc_id FROM checksum WHERE i = 8 * length(s) AND c & 1 = 1
), hashed AS (
  SELECT doc_id, source, {_told("text")} AS leaf,
    CASE WHEN doc_id IN (SELECT doc_id FROM tampered) THEN {_told("replace(text, chr(10), '')")} ELSE {_told("text")} END AS shown
  FROM documents
), sources AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)
), leaves AS (
  SELECT doc_id, tree, leaf, shown, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM hashed JOIN sources ON hashed.source IS NOT DISTINCT FROM sources.source
), below AS (
  SELECT tree, 0 AS level, pos AS idx, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM below WHERE n > 1 GROUP BY tree, level, idx // 3, n
), subroots AS (
  SELECT tree, level AS high, digest AS subroot FROM below WHERE n = 1
), upper AS (
  SELECT 0 AS level, tree AS idx, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, idx // 3, n
), top AS (
  SELECT level AS highest, digest AS root FROM upper WHERE n = 1
), path AS (
  SELECT tree, pos, idx, level, high, 0 AS up FROM (SELECT tree, pos, pos AS idx, 0 AS level, high FROM leaves JOIN subroots USING (tree))
  UNION ALL
  SELECT tree, pos, CASE WHEN up = 0 AND level = high THEN tree ELSE idx // 3 END, CASE WHEN up = 0 AND level = high THEN 0 ELSE level + 1 END,
    CASE WHEN up = 0 AND level = high THEN highest ELSE high END, CASE WHEN up = 0 AND level = high THEN 1 ELSE up END
  FROM path, top WHERE up = 0 OR level < high
), steps AS (
  SELECT path.tree, path.pos, path.up, path.level, string_agg(CASE WHEN s.idx < path.idx THEN s.digest ELSE '' END, '' ORDER BY s.idx) AS l,
    string_agg(CASE WHEN s.idx > path.idx THEN s.digest ELSE '' END, '' ORDER BY s.idx) AS r
  FROM path JOIN (SELECT 0 AS up, tree, level, idx, digest FROM below UNION ALL SELECT 1, -1, level, idx, digest FROM upper) s
    ON s.up = path.up AND s.tree = CASE WHEN path.up = 1 THEN -1 ELSE path.tree END AND s.level = path.level AND s.idx // 3 = path.idx // 3
  WHERE path.level < path.high GROUP BY path.tree, path.pos, path.up, path.level
), numbered AS (
  SELECT tree, pos, row_number() OVER (PARTITION BY tree, pos ORDER BY up, level) AS step, l, r FROM steps
), folded AS (
  SELECT tree, pos, 1 AS step, shown AS digest FROM leaves
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, sha256(l || digest || r) FROM folded f JOIN numbered s ON s.tree = f.tree AND s.pos = f.pos AND s.step = f.step
), ends AS (
  SELECT tree, pos, arg_max(digest, step) AS folded_root FROM folded GROUP BY tree, pos
), proved AS (
  SELECT tree, pos, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256 FROM numbered GROUP BY tree, pos
)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (tree, pos) LEFT JOIN proved USING (tree, pos), top
"""

#: Letter i of the base32 text is bits 5i to 5i + 4 of the digest; forty bits are ten hexadecimal digits.
_BASE32 = " || ".join(f"substr('{warc.BASE32}', 1 + ((('0x' || substr(sha1, {1 + 10 * (i // 8)}, 10))::BIGINT >> {35 - 5 * (i % 8)}) & 31)::INTEGER, 1)" for i in range(32))
_WARC = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha1 FROM pages),
firsts AS (SELECT payload, min(page_id) AS first_id FROM payloads GROUP BY payload)
SELECT page_id, strlen(payload) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN firsts USING (payload)
"""
