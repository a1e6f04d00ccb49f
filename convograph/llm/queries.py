"""The queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convograph.llm import bm25, bpe, conversations, jaccard, katz, langid, linededup, repeats, secretscan, simhash, toolcalls, variants, wumanber
from convograph.llm.common import ready, table
from convograph.sources.adapters import spread


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return secretscan.digests(secretscan.scan_whole(spark, spread(table(spark, sf, "documents"))))


def op2_simhash_classes(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return simhash.digests(simhash.classes(table(spark, sf, "documents")))


def op3_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return toolcalls.link(*toolcalls.from_turns(table(spark, sf, "conversations")), toolcalls.SCHEMAS)


def op4_repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return repeats.digests(repeats.deduplicate(table(spark, sf, "documents")))


def op5_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return bpe.digests(bpe.round_trip(spread(table(spark, sf, "documents")), tokenizer()))


def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return linededup.digests(linededup.deduplicate(table(spark, sf, "documents")))


def op7_katz_scores(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return katz.checked(katz.score(table(spark, sf, "documents")))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return wumanber.digests(wumanber.decontaminate(spread(table(spark, sf, "documents")), table(spark, sf, "benchmark")))


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    docs = spread(table(spark, sf, "documents"))
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", F.size("mixture").alias("n_langs"))


def op10_bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    docs = table(spark, sf, "documents")
    return bm25.search(docs, docs.where("doc_id % 50 = 0"))


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return variants.digests(variants.group(spread(table(spark, sf, "documents")), damage=199))


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    turns = table(spark, sf, "conversations")
    return conversations.digests(turns, *conversations.repair(conversations.damage(turns)))


def op13_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    ready(spark)
    return jaccard.digests(jaccard.classes(table(spark, sf, "documents")))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash_classes": op2_simhash_classes,
    "op3_tool_calls": op3_tool_calls,
    "op4_repeated_strings": op4_repeated_strings,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_line_dedup": op6_line_dedup,
    "op7_katz_scores": op7_katz_scores,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_bm25_topk": op10_bm25_topk,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_jaccard_join": op13_jaccard_join,
}

SQL: dict[str, str] = {
    "op3_tool_calls": """
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS words FROM conversations),
calls AS (SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, CASE role WHEN 'user' THEN 'answer' ELSE 'configure' END AS name, text, words, length(text) AS chars FROM t WHERE role IN ('user', 'system')),
res AS (SELECT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, text AS content FROM t WHERE role = 'assistant'),
one AS (SELECT call_id, count(*) AS n_results, min(struct_pack(a := turn, b := content, c := conv_id)) AS r FROM res GROUP BY call_id),
jump AS (SELECT conv_id, turn, CAST(coalesce(turn - lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) > 2, true) AS INT) AS new FROM (SELECT DISTINCT conv_id, turn FROM calls)),
chain AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS part FROM jump),
lev AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn) - 1 AS level FROM chain),
r AS (SELECT c.*, l.level, coalesce(o.n_results, 0) AS n_results, o.r.b AS content,
  list_filter(CASE name WHEN 'answer' THEN [CASE WHEN chars < 1 THEN 'chars: below 1' END, CASE WHEN chars > 800 THEN 'chars: above 800' END, CASE WHEN words < 3 THEN 'words: below 3' END]
    ELSE [CASE WHEN chars > 300 THEN 'chars: above 300' END, CASE WHEN words < 1 THEN 'words: below 1' END, CASE WHEN words > 40 THEN 'words: above 40' END] END, lambda e: e IS NOT NULL) AS errs
  FROM calls c LEFT JOIN lev l USING (conv_id, turn) LEFT JOIN one o USING (call_id)),
s AS (SELECT *, '{"arguments":{"chars":' || chars || ',"text":' || CAST(to_json(text) AS VARCHAR) || ',"words":' || words || '},"id":"' || call_id || '","name":"' || name || '","result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS canonical FROM r)
SELECT conv_id, turn, call_id, name, CAST(level AS BIGINT) AS level, CAST(row_number() OVER (PARTITION BY conv_id, level ORDER BY turn, canonical) - 1 AS BIGINT) AS position,
  CASE WHEN n_results > 0 THEN 'linked' ELSE 'unanswered' END AS status, CAST(n_results AS BIGINT) AS n_results, len(errs) = 0 AS valid, array_to_string(errs, '; ') AS errors, canonical FROM s
UNION ALL
SELECT r.c, r.a, call_id, NULL, NULL, NULL, 'orphan', CAST(n_results AS BIGINT), false, '', '{"arguments":null,"id":"' || call_id || '","name":null,"result":' || CAST(to_json(r.b) AS VARCHAR) || '}'
FROM one WHERE call_id NOT IN (SELECT call_id FROM calls)
""",
    "op8_decontamination": """
WITH dw AS (SELECT doc_id, coalesce(list_filter(string_split(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda x: x <> ''), []) AS w FROM documents),
bw AS (SELECT item_id, list_filter(string_split(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM bw WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM iw),
dg AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, ns WHERE len(w) >= n)),
hits AS (SELECT dg.doc_id, dg.n, dg.i, iw.item_id FROM dg JOIN iw ON dg.k = iw.k AND dg.n = iw.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op11_spelling_variants": r"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
once AS (SELECT run, count(*) AS k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes FROM runs GROUP BY doc_id, run),
-- CRC-32 bit by bit: the bytes are taken in one after the other, each divided by the reflected polynomial
crc AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, list_transform(range(CAST(len(bytes) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(bytes, 2 * i + 1, 2) AS BIGINT))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM once),
cnt AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM crc) GROUP BY word HAVING length(word) >= 6 AND sum(k) >= 5),
del AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS i FROM cnt)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM del a JOIN del b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM del a JOIN cnt b ON a.v = b.word UNION SELECT b.word, a.word, a.n FROM del a JOIN cnt b ON a.v = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
f AS (SELECT c.word, c.n, CASE WHEN near_n >= 5 * c.n THEN near END AS form, CASE WHEN near_n >= 5 * c.n THEN near_n END AS form_n, coalesce(n_near, 0) AS n_near FROM cnt c LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS last, 0 AS step FROM f UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN f ON w.last = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(last, step) AS root, f.n, f.n_near, f.form_n FROM f JOIN walk w ON w.word = f.word GROUP BY ALL
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE keys AS (SELECT DISTINCT conv_id, turn, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS bytes FROM conversations),
-- CRC-32 bit by bit
crc AS (SELECT conv_id, turn, xor(list_reduce(list_prepend(4294967295, list_transform(range(CAST(len(bytes) / 2 AS BIGINT)), lambda i: CAST('0x' || substr(bytes, 2 * i + 1, 2) AS BIGINT))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind FROM keys),
hurt AS (SELECT t.conv_id, t.turn, CASE kind WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM conversations t JOIN crc ON t.conv_id IS NOT DISTINCT FROM crc.conv_id AND t.turn IS NOT DISTINCT FROM crc.turn WHERE kind <> 0),
rowed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hurt),
t AS (SELECT conv_id, i, turn, role, text, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM rowed),
-- moves from the last role kept ('' before any) to the next: inserts between them
moves(was, is_, edits, between) AS (VALUES ('', 's', '', []::VARCHAR[]), ('', 'u', '', []), ('s', 'u', '', []), ('u', 'a', '', []), ('a', 'u', '', []),
  ('', 'a', 'I', ['user:']), ('s', 'a', 'I', ['user:']), ('u', 'u', 'I', ['assistant:']), ('a', 'a', 'I', ['user:'])),
ends(was, edits, between) AS (VALUES ('', '', []::VARCHAR[]), ('a', '', []), ('u', 'I', ['assistant:']), ('s', 'II', ['user:', 'assistant:'])),
best(conv_id, i, was, b) AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '', {'cost': CAST(0 AS BIGINT), 'audit': '', 'kept': []::VARCHAR[]} FROM t
  UNION ALL SELECT conv_id, i, was, min(b) FROM (
    SELECT b.conv_id, t.i, b.was, {'cost': b.b.cost + 3, 'audit': b.b.audit || 'D', 'kept': b.b.kept} AS b FROM best b JOIN t ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = b.i + 1
    UNION ALL
    SELECT b.conv_id, t.i, m.is_, {'cost': b.b.cost + 2 * length(m.edits) + CASE WHEN t.r = m.is_ THEN 0 ELSE 2 END + CASE fault WHEN 3 THEN 1 ELSE 0 END, 'audit': b.b.audit || m.edits || CASE WHEN t.r = m.is_ THEN 'K' ELSE 'R' END,
      'kept': b.b.kept || m.between || [CASE WHEN t.r = m.is_ THEN t.role WHEN m.is_ = 'u' THEN 'user' ELSE 'assistant' END || ':' || t.text]}
    FROM best b JOIN t ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = b.i + 1 JOIN moves m ON m.was = b.was WHERE fault NOT IN (1, 2) AND (t.r = m.is_ OR m.is_ <> 's')
  ) GROUP BY conv_id, i, was),
counted AS (SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
  count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM t GROUP BY conv_id),
done AS (SELECT c.conv_id, min({'cost': b.b.cost + 2 * length(e.edits), 'audit': b.b.audit || e.edits, 'kept': b.b.kept || e.between}) AS b FROM counted c JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = c.n JOIN ends e ON e.was = b.was GROUP BY c.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(d.b.cost, 0) AS BIGINT) AS cost, coalesce(d.b.audit, '') AS audit, sha256(coalesce(array_to_string(d.b.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
""",
    "op13_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> ''), []) AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i : i + 2], ' ') AS k FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.r < b.r GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, (SELECT min(o.doc_id) FROM reach JOIN w o ON o.r = reach.b WHERE reach.a = w.r)) AS component_id FROM w LEFT JOIN n USING (r)
""",
}
