"""Registered queries of the training-data operators: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.llm import (
    bitsliced, chat, decontaminate, infill, line_dedup, merkle, near_dedup, packing, quality, sharding, substring_dedup,
    token_counts, warc,
)
from quaero.llm.common import table

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), percent=85)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer(PIECE_BPE))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", (quality.fold() == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    return done.select("doc_id", "n_lines", "removed_lines", F.sha2("text", 256).alias("text_sha256"))


ODD_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(ODD_TEXT).alias("text")
    )
    done = chat.format_paths(chat.linear_messages(rows.unionByName(odd)))
    turns = chat.read_turns(F.col("formatted"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    read = done.withColumn("turns", turns).withColumn(
        "learned", chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    )
    return read.select(
        F.when(F.col("tree") != "", F.col("tree").cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.fill_in_middle(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda total, s: total + s.end - s.begin)
    return done.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    done = merkle.manifest(table(spark, sf_dir, "documents"), tampered, chosen)
    return done.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


# Words end at the six ASCII blanks; only A-Z change case. Items of under five words are one sequence.
_SQL_WORDS = r"""[w FOR w IN string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> '']"""


def sql_shingles(source: str, key: str) -> str:
    return f"""
  SELECT {key}, CASE WHEN len(w) >= 5
    THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM (SELECT {key}, {_SQL_WORDS} AS w FROM {source})"""


SQL_DECONTAMINATE = f"""
WITH d AS ({sql_shingles('documents', 'doc_id')}), b AS ({sql_shingles('benchmark', 'item_id')}),
ds AS (SELECT doc_id, unnest(s) AS x FROM d), bs AS (SELECT item_id, len(s) AS n, unnest(s) AS x FROM b)
SELECT doc_id, item_id, max(n) AS item_shingles, count(*) AS shared_shingles
FROM ds JOIN bs USING (x) GROUP BY doc_id, item_id HAVING 10 * count(*) >= 8 * max(n)"""

SQL_BITSLICED_TOPK = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20"""

# base32 of the 20 bytes: eight groups of 20 bits, four letters each
SQL_WARC_SALVAGE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, payload_bytes, h, max(page_id) OVER (PARTITION BY h) AS top,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST((CAST('0x' || substr(h, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS INTEGER) + 1, 1)
      FOR k IN range(0, 32)], '') AS payload_digest FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM d"""

SQL_NEAR_DEDUP = f"""
WITH RECURSIVE d AS ({sql_shingles('documents', 'doc_id')}),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM d),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b USING (x) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 85 * (max(a.n) + max(b.n) - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS r FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.r),
c AS (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, len(d.s) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.doc_id = d.doc_id"""

SQL_CHAT_PATHS = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '<(/?turn)', '<\\\1', 'g') AS t,
         regexp_replace(replace(role, '\', '\\'), '<(/?turn)', '<\\\1', 'g') AS r FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(CAST(sum(length(text)) FILTER (role = 'assistant') AS BIGINT), 0) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(r) + length(t) + 25) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

SQL_FILL_IN_MIDDLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
u AS (
  SELECT doc_id, text, list_concat([x || chr(10) FOR x IN p[:-2]], [x FOR x IN p[-1:] IF x <> '']) AS lines,
    [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(0, 4)] AS h FROM t),
c AS (
  SELECT *, len(lines) AS n, least(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS a,
    greatest(h[1] % (len(lines) + 1), h[2] % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (
  SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
    array_to_string(lines[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM s"""

# bytes as pairs of hex digits, in blocks of 200 windows; a window is 400 digits
SQL_SUBSTRING_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (
  SELECT r, k, substr(x, 400 * k + 1, 798) AS y FROM (SELECT r, x, unnest(range(0, len(x) // 400 + 1)) AS k FROM d)),
w AS (
  SELECT r, 200 * k + j AS i, md5_number(substr(y, 2 * j + 1, 400)) AS m
  FROM (SELECT r, k, y, unnest(range(0, len(y) // 2 - 199)) AS j FROM b)),
twice AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
hit AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w SEMI JOIN twice USING (m)),
island AS (
  SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS k
  FROM hit),
span AS (SELECT r, k, min(i) AS a, max(i) + 200 AS b FROM island GROUP BY r, k),
cut AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM span),
kept AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
    string_agg(substr(d.x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head FROM cut JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def _sql_leaf(text):
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


# one step a bit, eight a character; the digits of an id are bytes
SQL_CRC = '''xor(list_reduce(list_concat([4294967295], flatten([[ascii(ch), 0, 0, 0, 0, 0, 0, 0] FOR ch IN string_split({0}, '')])),
  lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)'''

SQL_MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_sql_leaf('text')} AS leaf, {_sql_leaf("replace(text, chr(10), '')")} AS changed,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS m FROM leaves),
nodes AS (
  SELECT g, 0 AS level, pos, m, leaf AS digest FROM ranked
  UNION ALL
  SELECT g, level + 1, pos // 3, (any_value(m) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE m > 1 GROUP BY g, level, pos // 3),
subroots AS (SELECT g, digest FROM nodes WHERE m = 1),
tops AS (
  SELECT 0 AS level, g AS pos, count(*) OVER () AS m, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (any_value(m) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE m > 1 GROUP BY level, pos // 3),
every AS (SELECT g, level, pos, digest FROM nodes UNION ALL SELECT -1, level, pos, digest FROM tops),
steps AS (
  SELECT r.g AS g, r.pos AS leaf_pos, n.level AS step, n.g AS tree, n.level AS level, r.pos // CAST(pow(3, n.level) AS BIGINT) AS own
  FROM ranked r JOIN (SELECT DISTINCT g, level FROM nodes WHERE m > 1) n ON n.g = r.g
  UNION ALL
  SELECT r.g, r.pos, 100 + t.level, -1, t.level, r.g // CAST(pow(3, t.level) AS BIGINT)
  FROM ranked r, (SELECT DISTINCT level FROM tops WHERE m > 1) t),
sides AS (
  SELECT s.g, s.leaf_pos, s.step,
    coalesce(string_agg(e.digest, '' ORDER BY e.pos) FILTER (e.pos < s.own), '') AS l,
    coalesce(string_agg(e.digest, '' ORDER BY e.pos) FILTER (e.pos > s.own), '') AS r
  FROM steps s JOIN every e ON e.g = s.tree AND e.level = s.level AND e.pos // 3 = s.own // 3 GROUP BY ALL),
paths AS (
  SELECT g, leaf_pos, string_agg(l || r, '' ORDER BY step) AS proof, list(l ORDER BY step) AS ls, list(r ORDER BY step) AS rs
  FROM sides GROUP BY g, leaf_pos),
folded AS (
  SELECT a.g, a.pos, 1 AS step, CASE WHEN {SQL_CRC.format('CAST(a.doc_id AS VARCHAR)')} % 2 = 0 THEN a.changed ELSE a.leaf END AS digest,
    coalesce(p.ls, []) AS ls, coalesce(p.rs, []) AS rs FROM ranked a LEFT JOIN paths p ON p.g = a.g AND p.leaf_pos = a.pos
  UNION ALL
  SELECT g, pos, step + 1, sha256(ls[step] || digest || rs[step]), ls, rs FROM folded WHERE step <= len(ls))
SELECT a.doc_id, a.leaf, s.digest AS subroot, t.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
  f.digest AS folded_root, f.digest = t.digest AS verified
FROM ranked a JOIN subroots s USING (g) JOIN tops t ON t.m = 1
JOIN folded f ON f.g = a.g AND f.pos = a.pos AND f.step = len(f.ls) + 1
LEFT JOIN paths p ON p.g = a.g AND p.leaf_pos = a.pos"""

REGISTRY = {
    "op1_bitsliced_topk": (op1_bitsliced_topk, SQL_BITSLICED_TOPK),
    "op2_warc_salvage": (op2_warc_salvage, SQL_WARC_SALVAGE),
    "op3_near_dedup": (op3_near_dedup, SQL_NEAR_DEDUP),
    "op4_token_counts": (op4_token_counts, None),
    "op5_sharding": (op5_sharding, None),
    "op6_quality": (op6_quality, None),
    "op7_line_dedup": (op7_line_dedup, None),
    "op8_chat_paths": (op8_chat_paths, SQL_CHAT_PATHS),
    "op9_decontaminate": (op9_decontaminate, SQL_DECONTAMINATE),
    "op10_pack": (op10_pack, None),
    "op11_fill_in_middle": (op11_fill_in_middle, SQL_FILL_IN_MIDDLE),
    "op12_substring_dedup": (op12_substring_dedup, SQL_SUBSTRING_DEDUP),
    "op13_merkle_manifest": (op13_merkle_manifest, SQL_MERKLE_MANIFEST),
}
