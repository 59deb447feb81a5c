"""One registered query per operator, with production parameters, over whole
tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    conversations, decontaminate, html_text, langid, lines, lm, neardup, packing, repair, sharding, spotsigs, toxicity, whitening,
)
from candlewick.llm.common import crc_mod, stage, table
from candlewick.session import scratch_path


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all whole texts, an end id each, written as Re-Pair blocks by ascending doc_id and
    read back. Null texts count as empty: the end id alone."""
    path = scratch_path(spark, "token-file")
    repair.write(spark, table(spark, sf_dir, "documents"), path, tokenizer(), end_id=1)
    return repair.read(spark, path, {"ids_crc32": F.crc32("ids")})


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of 2048 tokens. Null and empty texts are the end id alone."""
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), tokenizer(), capacity=2048, end_id=0)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts, learnt from rows that aren't held out. Null and empty texts are one end."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod(F.col("doc_id"), 5) == 1)
    return lm.score(spark, docs, "held_out")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page. Null and empty pages give an empty text."""
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "html"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 8 shards of near equal bytes; equal texts stay together, null texts have size 1."""
    return sharding.shard(spark, table(spark, sf_dir, "documents"), shards=8).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def language_model(spark: SparkSession, docs: DataFrame) -> langid.Model:
    return langid.fit(spark, docs.filter(crc_mod(F.col("doc_id"), 3) != 1))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; null texts and those without a letter are ``und`` with score 0."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"))
    return langid.identify(spark, rows, language_model(spark, docs)).select("doc_id", "held_out", "lang_pred", "score")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document; null, empty and blank texts are alone."""
    return neardup.components(spark, table(spark, sf_dir, "documents")).drop("first", "text_hash")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document; null texts have no words and no hits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.find_hits(spark, docs, table(spark, sf_dir, "benchmark"), window=10))


def toxicity_model(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(spark, docs.filter(crc_mod(F.col("doc_id"), 5) != 0), labels)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; null and empty ones get the score of no evidence."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"))
    model = toxicity_model(spark, docs, table(spark, sf_dir, "labels"))
    return toxicity.rate(spark, rows, model).select("doc_id", "held_out", "score", "predicted")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprints of every text and of its edited text; null texts count as empty."""
    return spotsigs.fingerprints(spark, table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept of every document; null and empty texts are one empty line, which stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = lines.LineIndex(spark, scratch_path(spark, "line-index"), least=3, min_chars=20)
    index.insert(docs)
    return index.apply(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every vector; null vectors and those with null or non-finite entries go."""
    return whitening.report(spark, table(spark, sf_dir, "embeddings"), components=8)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations as op13 damages them, by crc32 of ``conv_id:turn`` modulo 20."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("__kind"))
        .filter("__kind <> 0")
        .withColumns({"text": text, "role": F.when(F.col("__kind") == 4, "user").otherwise(F.col("role"))})
        .withColumn("__copy", F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("__kind", "__copy")
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "conversations")
    rows = damaged(source)
    audits = stage(spark, conversations.audit(spark, rows), "conversation-audits")
    digests = conversations.digests(spark, conversations.repaired(spark, rows, audits))
    every = source.select("conv_id").distinct()
    found = every.join(audits.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    found = found.join(digests.withColumnRenamed("conv_id", "__id"), F.col("conv_id").eqNullSafe(F.col("__id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_repair_token_file": op1,
        "op2_best_fit_packing": op2,
        "op3_lm_scoring": op3,
        "op4_html_text": op4,
        "op5_sharding": op5,
        "op6_language_id": op6,
        "op7_near_duplicates": op7,
        "op8_decontamination": op8,
        "op9_toxicity": op9,
        "op10_spotsigs": op10,
        "op11_line_dedup": op11,
        "op12_whitening": op12,
        "op13_conversation_repair": op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_near_duplicates": OP7_SQL, "op8_decontamination": OP8_SQL, "op11_line_dedup": OP11_SQL,
        "op13_conversation_repair": OP13_SQL,
    }


#: All pairs that share a shingle, then everything reachable over the links.
OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS r,
         [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(ws[i : i + least(5, len(ws)) - 1], ' ') AS shingle
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
shared AS (
  SELECT x.r AS a, y.r AS b, count(*) AS m FROM s AS x JOIN s AS y ON x.shingle = y.shingle AND x.r < y.r GROUP BY x.r, y.r),
links AS (
  SELECT a, b FROM shared JOIN n AS na ON na.r = a JOIN n AS nb ON nb.r = b WHERE 100 * m >= 75 * (na.n + nb.n - m)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT r, r AS x FROM w
  UNION
  SELECT reach.r, sides.b FROM reach JOIN sides ON sides.a = reach.x),
low AS (SELECT reach.r, min(w.doc_id) AS component_id FROM reach JOIN w ON w.r = reach.x GROUP BY reach.r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM w LEFT JOIN n USING (r) JOIN low USING (r)
"""


#: Windows of both sides as strings, joined; words are lists.
OP8_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r,
         [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws
  FROM documents),
b AS (
  SELECT item_id,
         [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT r, i, k, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, ks WHERE len(ws) >= k)),
hit AS (SELECT r, i, dw.k, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.k = bw.k),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""


#: Documents are told apart by id; a null id is the least.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT r, doc_id, i, line, lower_ AS key, length(lower_) >= 20 AS keyed
  FROM (SELECT r, doc_id, i, parts[i] AS line,
               translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_
        FROM (SELECT r, doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
              FROM (SELECT r, doc_id, string_split(text, chr(10)) AS parts FROM d)))),
held AS (SELECT DISTINCT key, doc_id FROM l WHERE keyed),
repeated AS (SELECT key, max(doc_id) AS largest FROM held GROUP BY key HAVING count(*) >= 3),
judged AS (
  SELECT l.*, repeated.key IS NOT NULL AND l.doc_id IS DISTINCT FROM largest AS gone
  FROM l LEFT JOIN repeated ON keyed AND repeated.key = l.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""


#: Cheapest way on from each state of the grammar, from a conversation's last turn
#: back; letters are matched with turns afterwards. CRC-32 bit by bit.
OP13_SQL = r"""
WITH RECURSIVE table_ AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                          lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256)) AS i)),
source AS (
  SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
kinds AS (
  SELECT r, xor(list_reduce(list_prepend(4294967295, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(k, '')]),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM source, table_),
rows_ AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM source JOIN kinds USING (r), unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS c(copy)),
marked AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, unhex(md5(text))) AS p
  FROM rows_),
faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'd'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial AS pair
  FROM marked),
-- a state's way on: cost in six digits, then the audit; states: nothing yet, after s, after u, after a
back(conv_id, p, w0, ws, wu, wa) AS (
  SELECT conv_id, max(p) + 1, '000000', '000006II', '000003I', '000000' FROM faults GROUP BY conv_id
  UNION ALL
  SELECT conv_id, p,
    least(c0, printf('%06d', CAST(cu[:6] AS INT) + 3) || 'I' || cu[7:], printf('%06d', CAST(ca[:6] AS INT) + 6) || 'II' || ca[7:]),
    least(cs, printf('%06d', CAST(cu[:6] AS INT) + 3) || 'I' || cu[7:], printf('%06d', CAST(ca[:6] AS INT) + 6) || 'II' || ca[7:]),
    least(cu, printf('%06d', CAST(ca[:6] AS INT) + 3) || 'I' || ca[7:]),
    least(ca, printf('%06d', CAST(cu[:6] AS INT) + 3) || 'I' || cu[7:])
  FROM (
    SELECT b.conv_id, f.p,
      least(del0, CASE WHEN ok THEN least(
        CASE WHEN initial = 's' THEN printf('%06d', CAST(ws[:6] AS INT) + cut) || 'K' || ws[7:] ELSE '9' END, to_u) ELSE '9' END) AS c0,
      least(dels, CASE WHEN ok THEN to_u ELSE '9' END) AS cs,
      least(delu, CASE WHEN ok THEN to_a ELSE '9' END) AS cu,
      least(dela, CASE WHEN ok THEN to_u ELSE '9' END) AS ca
    FROM (
      SELECT conv_id, p, ws,
        printf('%06d', CAST(w0[:6] AS INT) + 4) || 'D' || w0[7:] AS del0, printf('%06d', CAST(ws[:6] AS INT) + 4) || 'D' || ws[7:] AS dels,
        printf('%06d', CAST(wu[:6] AS INT) + 4) || 'D' || wu[7:] AS delu, printf('%06d', CAST(wa[:6] AS INT) + 4) || 'D' || wa[7:] AS dela,
        wu, wa
      FROM back) AS b
    JOIN (SELECT conv_id, p, initial, fault NOT IN ('b', 'd') AS ok, CASE fault WHEN 't' THEN 3 ELSE 0 END AS cut FROM faults) AS f
      ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.p = b.p - 1,
    LATERAL (SELECT
      CASE WHEN initial = 'u' THEN printf('%06d', CAST(wu[:6] AS INT) + cut) || 'K' || wu[7:]
           ELSE printf('%06d', CAST(wu[:6] AS INT) + cut + 3) || 'R' || wu[7:] END AS to_u,
      CASE WHEN initial = 'a' THEN printf('%06d', CAST(wa[:6] AS INT) + cut) || 'K' || wa[7:]
           ELSE printf('%06d', CAST(wa[:6] AS INT) + cut + 3) || 'R' || wa[7:] END AS to_a))),
best AS (SELECT conv_id, CAST(w0[:6] AS BIGINT) AS cost, w0[7:] AS audit FROM back WHERE p = 1),
letters AS (
  SELECT conv_id, j, audit[j] AS edit FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS j FROM best)),
placed AS (
  SELECT l.conv_id, j, edit, f.role, f.text, f.initial,
         count(*) FILTER (edit <> 'D') OVER (PARTITION BY l.conv_id ORDER BY j) AS e
  FROM (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS p FROM letters) AS l
  LEFT JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.p = l.p),
heads AS (SELECT conv_id, bool_or(e = 1 AND edit = 'K' AND initial = 's') AS led FROM placed WHERE edit <> 'D' GROUP BY conv_id),
fixed AS (
  SELECT placed.conv_id, string_agg(
    CASE edit WHEN 'K' THEN role ELSE CASE WHEN (e - CAST(led AS INT)) % 2 = 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY e) AS repaired
  FROM placed JOIN heads ON heads.conv_id IS NOT DISTINCT FROM placed.conv_id WHERE edit <> 'D' GROUP BY placed.conv_id),
counts AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
