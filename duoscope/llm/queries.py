"""The registered queries of the corpus operators: {name: (function, DuckDB SQL or None)}."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from duoscope.llm import (bpe, chaining, conversations, decontaminate, langmix, linechunks, merkle, minhash, mixing, pagediff,
                          quality, surrogates, tokens)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Of the registered query only; a caller brings a key of their own.
PII_KEY = b"key of the registered query"


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = surrogates.replace_pii(_table(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities")


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langmix.languages(docs, langmix.train(docs))
    return out.select("doc_id", langmix.held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                      "score", "languages", "shares")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op4_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.extract(_table(spark, sf_dir, "pages"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linechunks.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return out.select("doc_id", "text", "n_lines", "n_removed")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.over_limit(tokens.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path()))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "distance2")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    out = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    ids = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                      F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    head, doc = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.col("doc_id").cast("string")
    leaf = merkle.leaf(*head, "text")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(doc) % 5 == 0, merkle.leaf(*head, lower)).otherwise(leaf)
    out = merkle.manifest(_table(spark, sf_dir, "documents"), leaf, F.col("source"), F.col("doc_id"),
                          doc_id=F.col("doc_id"), tampered=tampered)
    return (out.withColumn("proof_sha256", F.sha2(merkle.proof_text(F.col("path")), 256))
            .withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = _table(spark, sf_dir, "conversations")
    return conversations.report(convs, conversations.damaged(convs))


#: Windows of ten words of each item, and where they occur. The word pattern's ASCII part is
#: written out; DuckDB's regular expressions work on characters, as the operator's contract does.
OP3_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT DISTINCT CAST(item_id AS varchar) AS item_id, regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
spans AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT s.doc_id, s.i, s.n, item_id FROM spans s JOIN windows x ON s.n = x.n AND s.win = x.win),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, CAST(coalesce(n_hit, 0) AS bigint) AS n_hit,
       CAST(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

#: Two sets of chunks, which end where another binary digit of a line's rolling hash (this line's and 31 times
#: the line's before) is 0. Line by line: what stands in a repeat, or beside it and beside the first occurrence
#: alike, in two lines or more, goes.
OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, n, CAST('0x' || substr(md5(line), 1, 8) AS bigint) % 2147483648 AS h
  FROM (SELECT doc_id, len(l) AS n, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
rolled AS (
  SELECT *, h + coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * 31 % 2147483648 AS r FROM lines),
ends AS (
  SELECT doc_id, i, line, s, CAST(i = n OR (r // CAST(pow(2, s) AS bigint)) % 2 = 0 AS int) AS last
  FROM rolled, (SELECT unnest(range(2)) AS s)),
numbered AS (
  SELECT *, coalesce(sum(last) OVER (PARTITION BY doc_id, s ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM ends),
cut AS (
  SELECT doc_id, s, c, min(i) - 1 AS place, list(line ORDER BY i) AS own FROM numbered GROUP BY doc_id, s, c),
chunks AS (
  SELECT doc_id, place, own, coalesce(lag(own) OVER d, []) AS before, coalesce(lead(own) OVER d, []) AS after
  FROM cut WINDOW d AS (PARTITION BY doc_id, s ORDER BY c)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY own ORDER BY doc_id NULLS LAST, place, -len(before) - len(after),
    list_transform(before, lambda x: md5(x)), list_transform(after, lambda x: md5(x))) AS rank
  FROM chunks WHERE len(own) > 1 OR trim(own[1]) <> ''),
met AS (
  SELECT x.doc_id, x.place, x.place + len(x.own) AS stop, list_reverse(x.before) AS up, list_reverse(f.before) AS f_up,
         x.after AS down, f.after AS f_down
  FROM ranked x JOIN ranked f ON f.own = x.own AND f.rank = 1
  WHERE (x.doc_id, x.place) IS DISTINCT FROM (f.doc_id, f.place)),
agreed AS (
  SELECT doc_id, place, stop, list_transform(range(1, least(len(up), len(f_up)) + 1), lambda j: up[j] = f_up[j]) AS u,
         list_transform(range(1, least(len(down), len(f_down)) + 1), lambda j: down[j] = f_down[j]) AS d FROM met),
ranges AS (
  SELECT doc_id, place - CASE WHEN coalesce(list_position(u, false), 0) > 0 THEN list_position(u, false) - 1 ELSE len(u) END AS lo,
         stop + CASE WHEN coalesce(list_position(d, false), 0) > 0 THEN list_position(d, false) - 1 ELSE len(d) END AS hi FROM agreed),
gone AS (SELECT DISTINCT doc_id, unnest(range(lo + 1, hi + 1)) AS i FROM ranges WHERE hi - lo >= 2),
judged AS (SELECT l.*, g.i IS NOT NULL AS out FROM lines l LEFT JOIN gone g ON g.doc_id IS NOT DISTINCT FROM l.doc_id AND g.i = l.i)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT out), '') END AS text,
       CAST(count(i) AS bigint) AS n_lines, CAST(coalesce(sum(CAST(out AS int)), 0) AS bigint) AS n_removed
FROM documents d LEFT JOIN judged j ON d.doc_id IS NOT DISTINCT FROM j.doc_id GROUP BY d.doc_id, d.text"""


#: All pairs that share a shingle are counted; components by reachability.
OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, CAST(coalesce(n, 0) AS bigint) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id"""


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS bigint), list_transform(
             string_split({text}, ''), lambda c: CAST(ord(c) AS bigint))),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z:
             CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _op12_sql(depth: int = 7, groups_depth: int = 4) -> str:
    """Each level by its own window and aggregation; enough levels for 16**7 rows of 16**4 sources."""
    def tree(name: str, key: str, levels: int) -> str:
        out = ""
        for i in range(levels):
            run = f"(PARTITION BY {key}, place // 16 ORDER BY place ROWS BETWEEN"
            out += f""",
{name}_s{i} AS (
  SELECT {key}, place, coalesce(string_agg(hash, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{i} WHERE n > 1),
{name}{i + 1} AS (
  SELECT {key}, place // 16 AS place, (n + 15) // 16 AS n, sha256(string_agg(hash, '' ORDER BY place)) AS hash
  FROM {name}{i} WHERE n > 1 GROUP BY {key}, n, place // 16)"""
        tops = " UNION ALL ".join(f"SELECT {key}, hash FROM {name}{i} WHERE n = 1" for i in range(levels + 1))
        return out + f""",
{name}_top AS ({tops})"""

    def walk(first: str, name: str, key: str, at: str, levels: int, start: int) -> str:
        out, last = "", first
        for i in range(levels):
            out += f""",
f{start + i} AS (
  SELECT f.* EXCLUDE (fold, proof), proof || coalesce(l || r, '') AS proof,
         CASE WHEN l IS NULL THEN fold ELSE sha256(l || fold || r) END AS fold
  FROM {last} f LEFT JOIN {name}_s{i} s ON f.{key} IS NOT DISTINCT FROM s.{key} AND f.{at} // {16 ** i} = s.place)"""
            last = f"f{start + i}"
        return out

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS varchar)) || ':' || CAST({c} AS varchar) END"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH coded AS (
  SELECT doc_id, source, sha256({head} || {field("text")}) AS leaf, sha256({head} || {field(lower)}) AS lowered,
         {_crc32_sql("CAST(doc_id AS varchar)")} AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, leaf, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS fold,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n FROM coded),
t0 AS (SELECT source, place, n, leaf AS hash FROM leaves){tree("t", "source", depth)},
g0 AS (SELECT 0 AS one, source, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
              count(*) OVER () AS n FROM t_top){tree("g", "one", groups_depth)},
f0 AS (SELECT v.*, '' AS proof, g.place AS gplace, 0 AS one, g.hash AS subroot, g_top.hash AS root
       FROM leaves v JOIN g0 g ON v.source IS NOT DISTINCT FROM g.source, g_top){walk("f0", "t", "source", "place", depth, 1)}{walk(f"f{depth}", "g", "one", "gplace", groups_depth, depth + 1)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM f{depth + groups_depth}"""


OP12_SQL = _op12_sql()

#: Every state's cheapest edits, the least by ASCII of equal ones, row by row; whole strings are kept.
OP13_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32_sql("coalesce(CAST(conv_id AS varchar), ' ') || ':' || coalesce(CAST(turn AS varchar), ' ')")} % 20 AS k
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM damaged),
seen AS (
  SELECT *, last = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following
  FROM placed),
rows_ AS (
  SELECT *, again AND NOT blank AS dup, NOT blank AND NOT again AND last NOT IN ('.', '!', '?') AS cut,
         blank OR again AS gone, following IS NOT NULL AND left(role, 1) || following NOT IN ('su', 'ua', 'au') AS bad
  FROM seen),
fills(s, m, ins, lines) AS (VALUES
  (0, 0, '', ''), (0, 2, 'I', chr(10) || 'user:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, '', ''), (2, 3, 'I', chr(10) || 'assistant:'), (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:')),
moves(m, edit, need, t) AS (VALUES (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3),
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
  (0, 'R', '', 2), (1, 'R', '', 2), (3, 'R', '', 2), (2, 'R', '', 3)),
dp AS (
  SELECT DISTINCT conv_id, 0 AS i, 0 AS s, 0 AS cost, '' AS audit, '' AS out FROM damaged
  UNION ALL
  SELECT conv_id, i, s, cost, audit, out FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) AS best FROM (
      SELECT d.conv_id, d.i + 1 AS i, v.t AS s,
             d.cost + 3 * length(f.ins) + CASE v.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
               + CASE WHEN r.cut AND v.edit <> 'D' THEN 3 ELSE 0 END AS cost,
             d.audit || f.ins || v.edit AS audit,
             d.out || f.lines || CASE v.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
               ELSE chr(10) || CASE v.t WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text END AS out
      FROM dp d JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1
      JOIN fills f ON f.s = d.s
      JOIN moves v ON v.m = f.m AND (v.edit = 'D' OR NOT r.gone) AND (v.need = '' OR v.need = left(r.role, 1))))
  WHERE best = 1),
told AS (
  SELECT conv_id, count(*) AS n, sum(CAST(blank AS int)) AS blank, sum(CAST(dup AS int)) AS duplicate,
         sum(CAST(cut AS int)) AS truncated, sum(CAST(bad AS int)) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM rows_ GROUP BY conv_id),
ends AS (
  SELECT d.conv_id, cost + 3 * length(f.ins) AS cost, audit || f.ins AS audit, out || f.lines AS out,
         row_number() OVER (PARTITION BY d.conv_id ORDER BY cost + 3 * length(f.ins), audit || f.ins) AS best
  FROM dp d JOIN told t ON t.conv_id IS NOT DISTINCT FROM d.conv_id AND d.i = t.n
  JOIN fills f ON f.s = d.s AND (f.m = 3 OR f.m = 0))
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS bigint) AS gaps, CAST(coalesce(blank, 0) AS bigint) AS blank,
       CAST(coalesce(duplicate, 0) AS bigint) AS duplicate, CAST(coalesce(truncated, 0) AS bigint) AS truncated,
       CAST(coalesce(illegal, 0) AS bigint) AS illegal, CAST(coalesce(cost, 0) AS bigint) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(substr(out, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.best = 1"""

QUERIES = {
    "op1_pii_surrogates": (op1_pii_surrogates, None),
    "op2_language_mixture": (op2_language_mixture, None),
    "op3_decontaminate": (op3_decontaminate, OP3_SQL),
    "op4_page_differencing": (op4_page_differencing, None),
    "op5_mix_sources": (op5_mix_sources, None),
    "op6_repeated_passages": (op6_repeated_passages, None),
    "op7_line_chunks": (op7_line_chunks, OP7_SQL),
    "op8_near_duplicates": (op8_near_duplicates, OP8_SQL),
    "op9_token_counts": (op9_token_counts, None),
    "op10_quality_rules": (op10_quality_rules, None),
    "op11_byte_bpe": (op11_byte_bpe, None),
    "op12_merkle_manifest": (op12_merkle_manifest, OP12_SQL),
    "op13_conversation_repair": (op13_conversation_repair, OP13_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
