"""Queries over the flow that stores an episode: its nodes, edges and their metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.functions import text as T
from convograph.operators import entities as E
from convograph.operators import storing as S
from convograph.plans.base import Book, n, r6, table
from convograph.plans.flow import parts
from convograph.sources.adapters import MENTIONS_SQL, SEGMENTS_SQL

book = Book()

#: Episodes, what they mention, quotes, insights and themes, as the store takes them.
STORE_SQL = MENTIONS_SQL + """, ep AS (SELECT episode_id, 'p' || episode_id % 5 AS podcast_id, count(*) AS turns, count(DISTINCT speaker) AS speakers FROM seg GROUP BY 1),
ee AS (SELECT episode_id, entity_id, min(name) AS name, min(pos) AS pos, count(*) AS k FROM men GROUP BY 1, 2),
qq AS (SELECT DISTINCT episode_id, text FROM seg WHERE word_count < 20),
ii AS (SELECT episode_id, segment_index FROM seg WHERE word_count >= 60),
th AS (SELECT episode_id, list(name ORDER BY k DESC, pos) AS concepts FROM ee GROUP BY 1)"""


def pieces(spark, sf):
    s, m = parts(spark, sf)
    ep = s.groupBy("episode_id").agg(F.count("*").alias("turns"), F.countDistinct("speaker").alias("speakers"))
    ep = ep.select("episode_id", F.concat(F.lit("p"), (F.col("episode_id") % 5).cast("string")).alias("podcast_id"), "turns", "speakers")
    ee = m.groupBy("episode_id", "entity_id").agg(F.min("name").alias("name"), F.min("pos").alias("pos"), F.count("*").alias("k"))
    return s, ep, ee


def flowing(ep):
    flow = F.when(F.col("turns") > 4, F.struct(F.when(F.col("speakers") > 2, "mixed").alias("pattern"), F.lit(None).cast("double").alias("quality"), F.col("turns").alias("transitions")))
    return ep.select(F.col("episode_id").alias("id"), "podcast_id", F.concat(F.lit("Conversation "), F.col("episode_id").cast("string")).alias("title"), F.lit(None).cast("string").alias("description"), flow.alias("flow"))


def as_entities(ee):
    k = F.col("k")
    flow = F.when(k > 1, F.struct((F.col("pos") + 1).alias("introduction"), (k * 10).alias("duration"), F.lit(None).cast("long").alias("peak"), F.when(k > 3, "answered").alias("resolution")))
    return ee.select("episode_id", F.col("entity_id").alias("id"), "name", F.lit("concept").alias("kind"), F.when(k != 2, F.least(F.lit(1.0), k / 4)).alias("confidence"), F.lit(None).cast("double").alias("importance"), flow.alias("flow"), "pos")


def themed(ee):
    return ee.groupBy("episode_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("k"), "pos", "name"))), lambda x: F.upper(x["name"])).alias("concepts")).select("episode_id", F.when(F.col("episode_id") % 2 == 0, F.lit("t0")).alias("theme"), F.lit("field").alias("field"), F.lit(None).cast("double").alias("emergence"), F.when(F.col("episode_id") % 3 == 0, 0.9).alias("confidence"), "concepts")


@book.add("SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey AS VARCHAR) ELSE s_name END AS name, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'supplies ' || s_nationkey END AS description, 'http://s/' || s_suppkey AS rss_url FROM supplier")
def stored_podcasts(spark, sf):
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(k.alias("id"), F.when(k % 3 != 0, F.col("s_name")).alias("name"), F.when(k % 2 != 0, F.concat(F.lit("supplies "), F.col("s_nationkey").cast("string"))).alias("description"), F.concat(F.lit("http://s/"), k.cast("string")).alias("rss_url"))
    return S.podcasts(rows).select("id", "name", F.element_at("props", "description").alias("description"), F.element_at("props", "rss_url").alias("rss_url"))


@book.add(f"WITH {STORE_SQL} SELECT CAST(episode_id AS VARCHAR) AS id, podcast_id AS podcast, CASE WHEN turns > 4 THEN CASE WHEN speakers > 2 THEN 'mixed' ELSE 'unknown' END END AS pattern, CASE WHEN turns > 4 THEN '0.5' END AS quality, CASE WHEN turns > 4 THEN CAST(turns AS VARCHAR) END AS transitions FROM ep")
def stored_episodes(spark, sf):
    nodes, edges = S.episodes(flowing(pieces(spark, sf)[1]))
    get = lambda k: F.try_element_at("props", F.lit(k))
    return nodes.join(edges.select(F.col("dst").alias("id"), F.col("src").alias("podcast")), "id").select("id", "podcast", get("discourse_flow_pattern").alias("pattern"), get("flow_quality").alias("quality"), get("key_transitions_count").alias("transitions"))


@book.add(f"WITH {STORE_SQL}, f AS (SELECT entity_id, arg_min(k, episode_id) AS k, arg_min(pos, episode_id) AS pos FROM ee GROUP BY 1), w AS (SELECT entity_id, sum(CASE WHEN k = 2 THEN 1.0 ELSE least(1.0, k / 4) END) AS w, count(*) AS c FROM ee GROUP BY 1) SELECT entity_id AS id, CASE WHEN k > 1 THEN CAST(pos + 1 AS VARCHAR) END AS introduction, CASE WHEN k > 1 THEN CAST(k * 10 AS VARCHAR) END AS duration, CASE WHEN k > 1 THEN '0' END AS peak, CASE WHEN k > 3 THEN 'answered' WHEN k > 1 THEN 'unknown' END AS resolution, CAST(c AS BIGINT) AS episodes, round(w::DOUBLE, 6) AS weight FROM f JOIN w USING (entity_id)")
def stored_entities(spark, sf):
    """Entities with their flow as properties, and how often and how surely episodes mention them."""
    nodes, edges = S.entities(as_entities(pieces(spark, sf)[2]))
    get = lambda k: F.try_element_at("props", F.lit(f"flow_{k}"))
    w = edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("episodes"), r6(F.sum("weight")).alias("weight"))
    return nodes.join(w, "id").select("id", get("introduction_point").alias("introduction"), get("development_duration").alias("duration"), get("peak_discussion").alias("peak"), get("resolution_status").alias("resolution"), "episodes", "weight")


@book.add(f"WITH {STORE_SQL}, t AS (SELECT episode_id, episode_id || '_theme_' || CASE WHEN episode_id % 2 = 0 THEN 't0' ELSE substr(sha256('field'), 1, 16) END AS id, concepts FROM th) SELECT id, 'HAS_EMERGENT_THEME' AS type, CAST(episode_id AS VARCHAR) AS other, CASE WHEN episode_id % 3 = 0 THEN 0.9 ELSE 0.5 END::DOUBLE AS weight FROM t UNION ALL SELECT id, 'COMPOSED_OF', e.entity_id, 1.0::DOUBLE FROM (SELECT id, episode_id, unnest(concepts[1:5]) AS name FROM t) x JOIN ee e ON e.episode_id = x.episode_id AND e.name = x.name")
def stored_themes(spark, sf):
    """Themes and what their key concepts, in capitals here, are linked to."""
    ee = pieces(spark, sf)[2]
    edges = S.themes(themed(ee), as_entities(ee))[1]
    theme = F.col("type") == "HAS_EMERGENT_THEME"
    return edges.select(F.when(theme, F.col("dst")).otherwise(F.col("src")).alias("id"), "type", F.when(theme, F.col("src")).otherwise(F.col("dst")).alias("other"), "weight")


@book.add(f"WITH {STORE_SQL} SELECT episode_id || '_quote_' || substr(sha256(text), 1, 16) AS id, substr(text, 1, 100) AS name, CAST(episode_id AS VARCHAR) AS episode FROM qq")
def stored_quotes(spark, sf):
    nodes, edges = S.quotes(pieces(spark, sf)[0].where("word_count < 20").select("episode_id", "text", F.lit(None).cast("string").alias("speaker")))
    return nodes.join(edges.select(F.col("src").alias("episode"), F.col("dst").alias("id")), "id").select("id", "name", "episode")


@book.add(f"""WITH {STORE_SQL} SELECT * FROM (VALUES ('Podcast', 'node'), ('Episode', 'node'), ('Entity', 'node'), ('Quote', 'node'), ('Insight', 'node'), ('EmergentTheme', 'node')) t(type, kind) JOIN (
 SELECT 'Podcast' AS type, count(DISTINCT podcast_id) AS n FROM ep UNION ALL SELECT 'Episode', count(*) FROM ep UNION ALL SELECT 'Entity', count(DISTINCT entity_id) FROM ee UNION ALL SELECT 'Quote', count(*) FROM qq UNION ALL SELECT 'Insight', count(*) FROM ii UNION ALL SELECT 'EmergentTheme', count(*) FROM th) USING (type) WHERE n > 0
UNION ALL SELECT * FROM (SELECT 'HAS_EPISODE' AS type, 'edge' AS kind, count(*) AS n FROM ep UNION ALL SELECT 'MENTIONS', 'edge', count(*) FROM ee UNION ALL SELECT 'CONTAINS_QUOTE', 'edge', count(*) FROM qq UNION ALL SELECT 'HAS_INSIGHT', 'edge', count(*) FROM ii UNION ALL SELECT 'HAS_EMERGENT_THEME', 'edge', count(*) FROM th UNION ALL SELECT 'COMPOSED_OF', 'edge', sum(least(5, len(concepts))) FROM th UNION ALL SELECT 'RELATED_TO', 'edge', count(*) FROM ee WHERE pos > 0) WHERE n > 0""")
def stored_episode_graph(spark, sf):
    """Everything an episode leads to, from one list of parts in the order of their dependencies."""
    s, ep, ee = pieces(spark, sf)
    some = as_entities(ee)
    ii = s.where("word_count >= 60").select("episode_id", F.concat_ws("-", F.lit("i"), F.col("episode_id").cast("string"), F.col("segment_index").cast("string")).alias("id"), F.substring("text", 1, 20).alias("title"), F.col("text").alias("description"), F.lit(0.8).alias("confidence"))
    rel = ee.where("pos > 0").select(F.col("entity_id").alias("source_id"), F.lit("e0").alias("target_id"), F.lit("related to").alias("type"), F.lit(None).cast("double").alias("weight"))
    podcasts = S.podcasts(ep.select(F.col("podcast_id").alias("id")).distinct().select("id", *[F.lit(None).cast("string").alias(c) for c in ("name", "description", "rss_url")]))
    quotes = s.where("word_count < 20").select("episode_id", "text", "speaker")
    nodes, edges = S.everything([(podcasts, None), S.episodes(flowing(ep)), S.insights(ii), S.entities(some), S.quotes(quotes), S.themes(themed(ee), some), (None, S.relationships(rel))])
    return nodes.groupBy("type").agg(F.count("*").alias("n")).select("type", F.lit("node").alias("kind"), "n").unionByName(edges.groupBy("type").agg(F.count("*").alias("n")).select("type", F.lit("edge").alias("kind"), "n"))


@book.add("SELECT 'Customer' AS kind, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'Order', (SELECT CAST(count(*) AS BIGINT) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))")
def broken_constraints(spark, sf):
    """Customers have keys of their own; orders are held to one a customer, which many break."""
    c = table(spark, sf, "customer").select(F.lit("Customer").alias("type"), F.col("c_custkey").alias("key"))
    o = table(spark, sf, "orders").select(F.lit("Order").alias("type"), F.col("o_custkey").alias("key"))
    return S.duplicated(c.unionByName(o), {"Customer": ["key"], "Order": ["key"]}).select(F.col("constraint").alias("kind"), "n")


@book.add(f"""WITH {STORE_SQL} SELECT m.episode_id, m.segment_index, m.entity_id, round(s.start_time, 6) AS start_time, round(s.word_count * 60 / 150.0::DOUBLE, 6) AS duration,
 CASE WHEN s.start_time >= 3600 THEN lpad(CAST(CAST(floor(s.start_time / 3600) AS INT) AS VARCHAR), 2, '0') || ':' ELSE '' END || lpad(CAST(CAST(floor(s.start_time % 3600 / 60) AS INT) AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(floor(s.start_time) AS INT) % 60 AS VARCHAR), 2, '0') AS clock,
 s.speaker AS mentioned_by, s.episode_id || '_segment_' || s.segment_index AS segment_id, CAST(s.word_count AS BIGINT) AS words, CASE WHEN m.episode_id % 2 = 0 THEN 'p' || m.episode_id % 5 END AS podcast_id, 'mentions' AS method FROM men m JOIN seg s USING (episode_id, segment_index)""")
def described_nodes(spark, sf):
    """Mentions with when, where and from what source; every second episode has no known source."""
    s, m = parts(spark, sf)
    sources = pieces(spark, sf)[1].where("episode_id % 2 = 0").select("episode_id", "podcast_id")
    d = S.described(m.select("episode_id", "segment_index", "entity_id"), s, sources, "mentions", "1.0.0")
    return d.select("episode_id", "segment_index", "entity_id", r6(F.col("start_time")).alias("start_time"), r6(F.col("duration")).alias("duration"), F.col("timestamp_formatted").alias("clock"), "mentioned_by", "segment_id", n(F.col("segment_word_count")).alias("words"), "podcast_id", F.col("extraction_method").alias("method"))


@book.add(f"WITH {STORE_SQL} SELECT m.episode_id, m.segment_index, m.entity_id, round(s.start_time, 6) AS mentioned_at, CASE WHEN m.pos = 0 THEN 0.9 ELSE 0.75 END::DOUBLE AS confidence FROM men m JOIN seg s USING (episode_id, segment_index)")
def described_relationships(spark, sf):
    s, m = parts(spark, sf)
    rel = m.select("episode_id", "segment_index", "entity_id", F.when(F.col("pos") == 0, 0.9).alias("confidence"))
    return S.described_relationships(rel, s).select("episode_id", "segment_index", "entity_id", r6(F.col("mentioned_at")).alias("mentioned_at"), "confidence")


@book.add("SELECT p_type AS text, CAST(count(*) AS BIGINT) AS nodes, 16 AS dimension FROM (SELECT p_type || CASE WHEN p_partkey % 2 = 0 THEN ' ' || p_brand ELSE '' END AS p_type FROM part) GROUP BY 1")
def embedded_nodes(spark, sf):
    """Nodes embedded once for each distinct text, and joined back."""
    p = table(spark, sf, "part").select(S.embedding_text(F.col("p_type"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand"))).alias("text"))
    return p.join(E.embedded_once(p, "text"), "text").groupBy("text").agg(F.count("*").alias("nodes"), F.max(F.size("embedding")).alias("dimension"))


@book.add("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'title' WHEN 1 THEN 'name' ELSE 'kind' END AS key, CASE WHEN event_id % 3 = 2 THEN 'kind' ELSE event_type END AS value FROM events")
def renamed_properties(spark, sf):
    i = F.col("event_id") % 3
    e = table(spark, sf, "events").select("event_id", F.create_map(F.when(i == 0, "name").when(i == 1, "title").otherwise("kind"), F.when(i == 2, "kind").otherwise(F.col("event_type"))).alias("p"))
    return e.select("event_id", F.explode(S.renamed(F.col("p"), {"name": "title"})).alias("key", "value"))


@book.add("SELECT event_id, key, value FROM (SELECT event_id, unnest(['active', 'importance', 'name', 'tags']) AS key, unnest([CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'maybe' END, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS DOUBLE)::VARCHAR ELSE 'high' END, 'Unknown', '[\"' || event_type || '\"]']) AS value FROM events)")
def coerced_properties(spark, sf):
    i = F.col("event_id")
    p = F.create_map(F.lit("active"), F.when(i % 3 == 0, "Yes").when(i % 3 == 1, "0").otherwise("maybe"), F.lit("importance"), F.when(i % 2 == 0, i.cast("string")).otherwise("high"), F.lit("tags"), F.col("event_type"))
    c = S.coerced(p, {"active": "boolean", "importance": "number", "tags": "array"}, {"name": "Unknown", "tags": "[]"})
    return table(spark, sf, "events").select("event_id", F.explode(c).alias("key", "value"))


@book.add("SELECT CAST(page_id AS VARCHAR) AS id, CASE WHEN page_id % 3 = 0 THEN 'Page ' || page_id WHEN page_id % 3 = 1 THEN url END AS title, CASE WHEN page_id % 2 = 0 THEN url ELSE '' END AS address FROM pages")
def migrated_podcasts(spark, sf):
    """Nodes of the old layout whose title may be called name and whose address may be called feed_url, or miss."""
    i = F.col("page_id")
    rows = S.nodes(table(spark, sf, "pages"), "Podcast", i, F.col("url"), title=F.when(i % 3 == 0, F.concat(F.lit("Page "), i.cast("string"))), name=F.when(i % 3 == 1, F.col("url")), feed_url=F.when(i % 2 == 0, F.col("url")))
    return S.fallbacks(rows, {"title": ["title", "name"], "address": ["rss_url", "feed_url"]}, {"address": ""})


@book.add("SELECT CAST(n_nationkey AS VARCHAR) AS id, 'Nation' AS type, n_name AS name, '' AS inner_type FROM nation UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'Node', n_name, 'Nation' FROM nation")
def dual_layouts(spark, sf):
    """Nodes in the typed and in the generic layout."""
    typed, generic = S.dual(S.nodes(table(spark, sf, "nation"), "Nation", F.col("n_nationkey"), F.col("n_name"), region=F.col("n_regionkey")), "Nation")
    return typed.unionByName(generic).select("id", "type", "name", F.coalesce(F.try_element_at("props", F.lit("_type")), F.lit("")).alias("inner_type"))


@book.add("SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'balance: null' END, 'c_nationkey: int, not string', 'email: missing'], lambda x: x IS NOT NULL), '; ') AS missing FROM customer")
def missing_fields(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"), "c_nationkey")
    return c.select("c_custkey", F.array_join(S.missing_fields(c, {"balance": "double", "c_nationkey": "string", "email": "string"}), "; ").alias("missing"))


@book.add(r"SELECT page_id, array_to_string(list_sort(list_distinct(['News', 'a' || page_id % 3, 'a' || page_id % 2])), ',') AS categories, array_to_string(list_sort(list_distinct(['x', 'k' || page_id % 4])), ',') AS keywords, CASE page_id % 3 WHEN 0 THEN 'http://i/h' WHEN 1 THEN 'http://i/u' ELSE '' END AS image FROM pages")
def feed_details(spark, sf):
    """Categories, keywords and images of feeds made of the pages."""
    from convograph.operators import feeds

    i, s = F.col("page_id"), lambda k: (F.col("page_id") % k).cast("string")
    image = F.when(i % 3 == 0, "<image href='http://i/h'><url>http://i/no</url></image>").when(i % 3 == 1, "<image><url>http://i/u</url></image>").otherwise("")
    xml = F.concat(F.lit("<channel><category>News</category><category>a"), s(3), F.lit("</category><itunes_category text='a"), s(2), F.lit("'/><keywords>x, k"), s(4), F.lit(" ,,x</keywords>"), image, F.lit("</channel>"))
    d = feeds.details(table(spark, sf, "pages").select("page_id", xml.alias("xml")), F.col("xml"))
    return d.select("page_id", F.array_join("categories", ",").alias("categories"), F.array_join("keywords", ",").alias("keywords"), "image")


@book.add("SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 5 = 0 THEN 'id: missing' WHEN event_id % 7 = 0 THEN 'id: not letters, digits, _ or -' END, CASE WHEN event_id % 3 = 0 THEN 'rss_url: missing' WHEN event_id % 3 = 1 THEN 'rss_url: not http' END], lambda x: x IS NOT NULL), '; ') AS errors FROM events")
def podcast_config_errors(spark, sf):
    from convograph.operators import feeds

    i = F.col("event_id")
    ident = F.when(i % 5 == 0, "").when(i % 7 == 0, F.concat(F.col("event_type"), F.lit(" !"))).otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", F.array_join(feeds.config_errors(ident, F.when(i % 3 == 1, "ftp://x").when(i % 3 == 2, "https://x")), "; ").alias("errors"))


@book.add("SELECT doc_id, trim(coalesce(text, ''), ' ') AS clean FROM documents")
def validated_texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.validated(F.col("text")).alias("clean"))


QUERIES, SQL = book.queries, book.sql
__all__ = ["QUERIES", "SEGMENTS_SQL", "SQL"]
