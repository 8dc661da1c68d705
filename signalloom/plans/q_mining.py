"""Queries over concept mining, the anchor graph and discovery, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalloom.functions import constants as C, text as X
from signalloom.functions.arrays import explode_rows
from signalloom.operators import concepts as N, discover as G, graph, quality as Q
from signalloom.plans import demo, stages
from signalloom.plans.demo import EV_SQL, EVC_SQL, evidence
from signalloom.plans.q_text import D03_SQL, ELIG_SQL, SLUG_SQL
from signalloom.session import cut_lineage

QUERIES, ORACLE = {}, {}
POLICY = stages.concept_policy()
CLUSTERS = stages.CLUSTERS


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


_q = demo._q
_FOLD = "replace(lower(%s), 'ß', 'ss')"
_TOK = f"regexp_extract_all(translate({_FOLD}, '-/', '  '), '{C.TOKEN_PATTERN}')"


def token_sql(items: str) -> str:
    """Tokens of each item: title, summary, tags and projects, whole."""
    return f"""sx AS (SELECT id, source_id, source_type, title, tags, projects, theme_ids, ts, trim(regexp_replace(array_to_string(list_concat([title, summary], tags, projects), ' '), '\\s+', ' ', 'g')) AS search FROM {items}),
tk AS (SELECT *, {_TOK % 'search'} AS w, len({_TOK % 'title'}) AS nt FROM sx),
gd AS (SELECT id, nt, list_transform(w, lambda x: CASE WHEN list_contains({_q(C.STOPWORDS)}, x) OR (length(x) < 3 AND NOT regexp_matches(x, '^[0-9]+$')) THEN NULL ELSE x END) AS g FROM tk),
gi AS (SELECT id, nt, g, unnest(range(1, len(g) + 1)) AS i FROM gd),
ng AS (SELECT id, nt, i, k, CASE k WHEN 2 THEN g[i] || ' ' || g[i+1] WHEN 3 THEN g[i] || ' ' || g[i+1] || ' ' || g[i+2] ELSE g[i] || ' ' || g[i+1] || ' ' || g[i+2] || ' ' || g[i+3] END AS phrase FROM gi, (VALUES (2), (3), (4)) kk(k)),
pc AS (SELECT id, phrase, k AS size, count(*) AS tf, bool_or(i - 1 + k <= nt) AS in_title FROM ng WHERE phrase IS NOT NULL AND NOT regexp_matches(phrase, '^[0-9 ]+$')
  AND NOT list_contains({_q(POLICY.blocked_phrases)}, phrase) AND len(list_filter(string_split(phrase, ' '), lambda t: NOT list_contains({_q(POLICY.generic_tokens)}, t))) > 0 GROUP BY 1, 2, 3),
pf AS (SELECT phrase, count(*) AS df FROM pc GROUP BY 1)"""


_ALIASES = sorted({N.plain(a) for e in POLICY.lexicon for a in e["aliases"]} - {""})
_LEX = ", ".join(f"({i}, {_q(e['id'])}, {_q(e['label'])}, {_q(e['kind'])}, {_q(N.plain(a))})" for i, e in enumerate(POLICY.lexicon) for a in e["aliases"] if N.plain(a))
_ACT = ", ".join(f"({i}, {_q(a)}, {_q(N.plain(f))})" for i, (a, fs) in enumerate(POLICY.actions.items()) for f in fs)
ITEMS_SQL = f"""{EVC_SQL}, {ELIG_SQL}, {D03_SQL}, items AS (SELECT el.* FROM el JOIN (SELECT id FROM walk WHERE id IS NOT NULL AND dup IS NULL) k ON k.id = el.id)"""
PICK_SQL = f"""cnt AS (SELECT count(*) AS n FROM items),
ps AS (SELECT id, phrase, size, df, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) * (1 + 0.12::DOUBLE * (size - 2)) * CASE WHEN in_title THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS score FROM pc JOIN pf USING (phrase), cnt
  WHERE df BETWEEN 2 AND greatest(2, floor(n * 0.35)) AND NOT list_contains({_q(_ALIASES)}, phrase)),
pr AS (SELECT id, phrase, df, row_number() OVER (PARTITION BY id ORDER BY score DESC, size DESC, phrase) AS rn FROM ps WHERE score >= 1.15),
pw AS (SELECT id, 0::BIGINT AS rn, []::VARCHAR[] AS kept, NULL::VARCHAR AS pick FROM items UNION ALL
  SELECT q.id, q.rn, CASE WHEN ok THEN list_append(kept, phrase) ELSE kept END, CASE WHEN ok THEN phrase END FROM (SELECT pr.id, pr.rn, pr.phrase, pw.kept,
    len(list_filter(pw.kept, lambda e: contains(' ' || e || ' ', ' ' || pr.phrase || ' ') OR contains(' ' || pr.phrase || ' ', ' ' || e || ' '))) = 0 AS ok FROM pw JOIN pr ON pr.id = pw.id AND pr.rn = pw.rn + 1 WHERE len(pw.kept) < 8) q),
pk AS (SELECT id, pick AS phrase FROM pw WHERE pick IS NOT NULL)"""
NODE_SQL = f"""lx(ord, nid, label, kind, norm) AS (VALUES {_LEX}), ax(ord, aid, norm) AS (VALUES {_ACT}),
pt AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS p FROM tk),
cn AS (SELECT DISTINCT id, source_id, ord, nid, label, kind FROM pt, lx WHERE contains(p, ' ' || norm || ' ')),
ac AS (SELECT DISTINCT id, ord, aid FROM pt, ax WHERE contains(p, ' ' || norm || ' ')),
en AS (SELECT DISTINCT id, source_id, nid, label, kind FROM (SELECT id, source_id, 'project:' || {SLUG_SQL % 'v'} AS nid, v AS label, 'project' AS kind FROM tk, unnest(projects) u(v)
   UNION ALL SELECT id, source_id, 'technology:' || {SLUG_SQL % 'v'}, v, 'technology' FROM tk, unnest(tags) u(v) WHERE length(v) >= 3 AND NOT list_contains({_q(POLICY.blocked_tags)}, lower(v)))),
nd AS (SELECT id, source_id, nid, label, kind FROM cn UNION ALL SELECT id, source_id, nid, label, kind FROM en UNION ALL SELECT id, tk.source_id, 'phrase:' || {SLUG_SQL % 'phrase'}, phrase, 'emergent-phrase' FROM pk JOIN tk USING (id))"""
REL_SQL = f"""se AS (SELECT id, generate_subscripts(l, 1) AS sno, unnest(l) AS raw FROM (SELECT id, string_split(regexp_replace(search, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)) AS l FROM tk)),
sn AS (SELECT id, sno, ' ' || array_to_string({_TOK % 'raw'}, ' ') || ' ' AS p FROM se),
en2 AS (SELECT id, nid, label, kind, 1000 + row_number() OVER (PARTITION BY id ORDER BY kind, {_FOLD % 'label'}) AS ord, array_to_string({_TOK % 'label'}, ' ') AS norm FROM en),
tn AS (SELECT sn.id, sno, ord, nid, strpos(p, ' ' || norm || ' ') - 2 AS pos FROM sn, lx UNION ALL SELECT sn.id, sno, ord, nid, strpos(p, ' ' || norm || ' ') - 2 FROM sn JOIN en2 USING (id)),
pn AS (SELECT id, sno, ord, nid, min(pos) AS pos FROM tn WHERE pos >= 0 GROUP BY 1, 2, 3, 4),
pa AS (SELECT sn.id, sno, ord, aid, min(strpos(p, ' ' || norm || ' ') - 2) AS pos FROM sn, ax WHERE strpos(p, ' ' || norm || ' ') - 2 >= 0 GROUP BY 1, 2, 3, 4),
pl AS (SELECT id, sno, list(nid ORDER BY pos, ord) AS l, count(*) AS n FROM pn GROUP BY 1, 2 HAVING count(*) > 1),
pz AS (SELECT pa.id, pa.sno, pa.ord, pa.aid, l, arg_max(nid, (pn.pos, pn.ord)) FILTER (WHERE pn.pos < pa.pos) AS b, arg_min(nid, (pn.pos, pn.ord)) FILTER (WHERE pn.pos > pa.pos) AS a FROM pa JOIN pl ON pl.id = pa.id AND pl.sno = pa.sno JOIN pn ON pn.id = pa.id AND pn.sno = pa.sno GROUP BY 1, 2, 3, 4, 5),
rt AS (SELECT id, CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN b ELSE l[1] END AS subject_id, aid AS predicate, CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN a ELSE l[2] END AS object_id, min((sno, ord)) AS place FROM pz GROUP BY 1, 2, 3, 4),
rl AS (SELECT id, subject_id, predicate, object_id FROM rt WHERE subject_id <> object_id QUALIFY row_number() OVER (PARTITION BY id ORDER BY place) <= 12)"""
MINE_SQL = f"{ITEMS_SQL}, {token_sql('items')}, {PICK_SQL}, {NODE_SQL}"


# ---- mining -----------------------------------------------------------------------------------

@query("t05_phrase_frequency", f"WITH {EVC_SQL}, {token_sql('cl')} SELECT phrase, count(*) AS df, sum(tf)::BIGINT AS tf, count_if(in_title) AS titles FROM pc GROUP BY 1 HAVING count(*) >= 2")
def t05(spark, sf):
    e = evidence(spark, sf).withColumn("theme_ids", F.array().cast("array<string>"))
    c = N.phrase_counts(N.prepared(e, POLICY), POLICY)
    return c.groupBy("phrase").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"), F.count_if("in_title").alias("titles")).filter("df >= 2")


@query("t04_controlled_terms", f"WITH {EVC_SQL}, {token_sql('cl')}, lx(ord, nid, label, kind, norm) AS (VALUES {_LEX}), pt AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS p FROM tk) SELECT id, nid AS concept_id, least(6, count(*)) AS terms FROM pt, lx WHERE contains(p, ' ' || norm || ' ') GROUP BY 1, 2")
def t04(spark, sf):
    e = evidence(spark, sf)
    b = explode_rows(N.prepared(e, POLICY).select("id", "controlled"), "c", "controlled")
    return b.select("id", F.col("c.id").alias("concept_id"), F.size("c.matched_terms").alias("terms"))


@query("t07_entities", f"WITH {EVC_SQL}, {token_sql('cl')}, en AS (SELECT id, 'project:' || {SLUG_SQL % 'v'} AS entity_id, v AS label FROM tk, unnest(projects) u(v) UNION SELECT id, 'technology:' || {SLUG_SQL % 'v'}, v FROM tk, unnest(tags) u(v) WHERE length(v) >= 3 AND NOT list_contains({_q(POLICY.blocked_tags)}, lower(v))) SELECT * FROM en")
def t07(spark, sf):
    return explode_rows(N.prepared(evidence(spark, sf), POLICY).select("id", "entities"), "e", "entities").select("id", F.col("e.id").alias("entity_id"), F.col("e.label").alias("label"))


@query("t08_actions", f"WITH {EVC_SQL}, {token_sql('cl')}, ax(ord, aid, norm) AS (VALUES {_ACT}), pt AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS p FROM tk) SELECT id, aid AS action_id, least(6, count(*)) AS terms FROM pt, ax WHERE contains(p, ' ' || norm || ' ') GROUP BY 1, 2")
def t08(spark, sf):
    b = explode_rows(N.prepared(evidence(spark, sf), POLICY).select("id", "actions"), "a", "actions")
    return b.select("id", F.col("a.id").alias("action_id"), F.size("a.matched_terms").alias("terms"))


@query("t06_emergent_phrases", f"WITH RECURSIVE {ITEMS_SQL}, {token_sql('items')}, {PICK_SQL} SELECT id, phrase FROM pk")
def t06(spark, sf):
    d = stages.concept_docs(spark, sf).select("evidence_id", F.explode("concepts").alias("c"))
    return d.filter("c.kind = 'emergent-phrase'").select(F.col("evidence_id").alias("id"), F.col("c.label").alias("phrase"))


@query("t09_relations", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL} SELECT id, subject_id, predicate, object_id FROM rl")
def t09(spark, sf):
    d = stages.concept_docs(spark, sf).select(F.col("evidence_id").alias("id"), F.explode("relationships").alias("r"))
    return d.select("id", "r.subject_id", "r.predicate", "r.object_id")


_DOC_SQL = """dc AS (SELECT items.id, items.source_id, array_to_string(list_sort(theme_ids), ',') AS theme_ids, (SELECT string_agg(DISTINCT nid, ',' ORDER BY nid) FROM nd WHERE nd.id = items.id AND kind IN ('theme','primitive','emergent-phrase')) AS concepts,
  (SELECT string_agg(nid || '=' || label, ',' ORDER BY nid) FROM en WHERE en.id = items.id) AS entities, (SELECT string_agg(DISTINCT aid, ',' ORDER BY aid) FROM ac WHERE ac.id = items.id) AS actions,
  (SELECT string_agg(subject_id || '>' || predicate || '>' || object_id, ',' ORDER BY subject_id || '>' || predicate || '>' || object_id) FROM rl WHERE rl.id = items.id) AS relationships,
  (SELECT string_agg(t, ',' ORDER BY t) FROM (SELECT nid || ':' || norm AS t FROM pt, lx WHERE pt.id = items.id AND contains(p, ' ' || norm || ' ') UNION SELECT aid || ':' || norm FROM pt, ax WHERE pt.id = items.id AND contains(p, ' ' || norm || ' '))) AS terms FROM items)"""


def document_lists(spark, sf):
    """The content of each concept document as text."""
    d = stages.concept_docs(spark, sf)
    joined = lambda items: F.nullif(F.array_join(F.array_sort(items), ","), F.lit(""))
    ids = lambda c: F.transform(c, lambda x: x["id"])
    matched = lambda c: F.flatten(F.transform(c, lambda x: F.transform(x["matched_terms"], lambda t: F.concat(x["id"], F.lit(":"), X.normalized_text(t)))))
    named = F.filter("concepts", lambda c: c["kind"].isin("theme", "primitive"))
    return d.select(
        F.col("evidence_id").alias("id"), "source_id", F.array_join("theme_ids", ",").alias("theme_ids"), joined(F.array_distinct(ids(F.col("concepts")))).alias("concepts"),
        joined(F.transform("entities", lambda x: F.concat(x["id"], F.lit("="), x["label"]))).alias("entities"), joined(ids(F.col("actions"))).alias("actions"),
        joined(F.transform("relationships", lambda r: F.concat_ws(">", r["subject_id"], r["predicate"], r["object_id"]))).alias("relationships"),
        joined(F.array_distinct(F.concat(matched(named), matched(F.col("actions"))))).alias("terms"), N.document_signature().alias("signature"))


@query("t10_concept_documents", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {_DOC_SQL} SELECT * FROM dc")
def t10(spark, sf):
    return document_lists(spark, sf).drop("signature")


@query("a24_concept_index", f"WITH RECURSIVE {MINE_SQL} SELECT nid AS id, max(label) AS label, max(kind) AS kind, count(DISTINCT id) AS document_count, count(DISTINCT source_id) AS source_count FROM nd GROUP BY 1".replace("SELECT nid AS id, max(label)", "SELECT nid AS id, max(label)").replace("count(DISTINCT id) AS document_count", "count(DISTINCT nd.id) AS document_count"))
def a24(spark, sf):
    return N.concept_index(stages.concept_docs(spark, sf))


@query("a25_relationship_index", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL} SELECT subject_id, predicate, object_id, count(*) AS document_count FROM rl GROUP BY 1, 2, 3")
def a25(spark, sf):
    return N.relationship_index(stages.concept_docs(spark, sf))


@query("n20_document_signatures", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {_DOC_SQL} SELECT id, min(id) OVER (PARTITION BY theme_ids, concepts, entities, actions, relationships, terms) AS first_alike, 64 AS hash_length FROM dc")
def n20(spark, sf):
    """Documents of equal content, and only these, have equal signatures."""
    d = document_lists(spark, sf).select("id", "signature")
    first = d.groupBy("signature").agg(F.min("id").alias("first_alike"))
    return d.join(first, "signature").select("id", "first_alike", F.length("signature").alias("hash_length"))


@query("t11_catalog_changes", f"""WITH RECURSIVE {ITEMS_SQL} SELECT CASE WHEN ts > {demo.AS_OF_SQL} - INTERVAL 7 DAY THEN 'added' WHEN CAST(substr(id, 5) AS BIGINT) IN (SELECT doc_id FROM labels) THEN 'changed' ELSE 'unchanged' END AS change, count(*) AS documents FROM items GROUP BY 1""")
def t11(spark, sf):
    return stages.catalog_changes(spark, sf).groupBy("change").agg(F.count("*").alias("documents"))


@query("t12_vocabulary_gaps", f"WITH {EVC_SQL}, wt AS (SELECT * FROM cl WHERE disposition = 'classification-review'), {token_sql('wt')} SELECT phrase, df FROM pf")
def t12(spark, sf):
    return N.vocabulary_gaps(stages.classified(spark, sf), POLICY)


# ---- anchor graph -----------------------------------------------------------------------------

ANCHOR_SQL = f"""po AS (SELECT DISTINCT nid AS anchor_id, label, kind, id, source_id FROM nd WHERE kind IN ('primitive','project','technology') OR (kind = 'emergent-phrase' AND NOT regexp_matches(label, '[0-9]'))
  UNION SELECT 'relation:' || subject_id || '|' || predicate || '|' || object_id, subject_id || ' ' || predicate || ' ' || object_id, 'relationship', rl.id, source_id FROM rl JOIN tk USING (id)),
an AS (SELECT anchor_id, count(DISTINCT id) AS document_count, count(DISTINCT source_id) AS source_count FROM po, cnt GROUP BY anchor_id, n HAVING count(DISTINCT id) BETWEEN 2 AND greatest(10, floor(n * 0.1)) AND count(DISTINCT source_id) >= 2),
kp AS (SELECT DISTINCT anchor_id, id, source_id FROM po JOIN an USING (anchor_id))"""
EDGE_SQL = """sh AS (SELECT x.anchor_id AS left_id, y.anchor_id AS right_id, count(*) AS shared FROM kp x JOIN kp y ON x.id = y.id AND x.anchor_id < y.anchor_id GROUP BY 1, 2 HAVING count(*) >= 2),
ed AS (SELECT left_id, right_id, shared FROM sh JOIN an a ON a.anchor_id = left_id JOIN an b ON b.anchor_id = right_id WHERE shared / (a.document_count + b.document_count - shared) >= 0.5 OR shared / least(a.document_count, b.document_count) >= 0.75)"""
COMP_SQL = """bo AS (SELECT left_id AS a, right_id AS b FROM ed UNION SELECT right_id, left_id FROM ed),
re AS (SELECT anchor_id AS a, anchor_id AS b FROM an UNION SELECT re.a, bo.b FROM re JOIN bo ON bo.a = re.b),
co AS (SELECT a AS id, min(b) AS component FROM re GROUP BY 1)"""


def graph_parts(spark, sf):
    index = stages.anchor_index(spark, sf)
    return stages.concept_docs(spark, sf), stages.postings(spark, sf).join(index.select("anchor_id"), "anchor_id", "left_semi"), index


@stages.shared("capped")
def capped_table(spark, sf):
    docs, kept, _ = graph_parts(spark, sf)
    return graph.cluster_documents(stages.components(spark, sf), kept, docs, demo.sources(spark), CLUSTERS)[1]


@query("g02_anchor_index", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {ANCHOR_SQL} SELECT * FROM an")
def g02(spark, sf):
    return graph_parts(spark, sf)[2].select("anchor_id", "document_count", "source_count")


@query("g03_overlap_edges", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {ANCHOR_SQL}, {EDGE_SQL} SELECT * FROM ed")
def g03(spark, sf):
    _, kept, index = graph_parts(spark, sf)
    return graph.overlap_edges(kept, index, CLUSTERS).select("left_id", "right_id", "shared")


@query("g04_components", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {ANCHOR_SQL}, {EDGE_SQL}, {COMP_SQL} SELECT id, component FROM co")
def g04(spark, sf):
    return stages.components(spark, sf)


@query("g04_supplier_components", """WITH RECURSIVE n AS (SELECT DISTINCT 's' || l_suppkey AS a, 'o' || l_orderkey AS b FROM lineitem WHERE l_suppkey % 7 = l_orderkey % 7 AND l_orderkey % 3 = 0),
bo AS (SELECT a AS x, b AS y FROM n UNION ALL SELECT b, a FROM n), re AS (SELECT DISTINCT x AS v, x AS r FROM bo UNION SELECT bo.y, re.r FROM re JOIN bo ON bo.x = re.v)
SELECT v AS id, min(r) AS component FROM re GROUP BY 1""")
def g04s(spark, sf):
    """Suppliers and orders as a sparse graph of many components: the component of every vertex."""
    li = demo.table(spark, sf, "lineitem").filter("l_suppkey % 7 = l_orderkey % 7 and l_orderkey % 3 = 0")
    e = li.select(F.concat(F.lit("s"), "l_suppkey").alias("left_id"), F.concat(F.lit("o"), "l_orderkey").alias("right_id")).distinct()
    v = e.select(F.col("left_id").alias("id")).unionByName(e.select(F.col("right_id").alias("id"))).distinct()
    return graph.connected_components(v, e)


CAP_SQL = f"""mb AS (SELECT DISTINCT component, kp.id FROM kp JOIN co ON co.id = kp.anchor_id), sz AS (SELECT component, count(*) AS raw FROM mb GROUP BY 1),
rk AS (SELECT component, raw, items.id, items.source_id, coalesce(s.publisher_id, items.source_id) AS pub, coalesce(nullif(list_position({_q(C.PREFERRED_CHANNELS)}, s.channel), 0), 15) AS cr, ts::DATE AS d FROM mb JOIN sz USING (component) JOIN items ON items.id = mb.id LEFT JOIN src s ON s.id = items.source_id),
k1 AS (SELECT * FROM rk QUALIFY row_number() OVER (PARTITION BY component, source_id ORDER BY cr, d DESC, id) <= 2), k2 AS (SELECT * FROM k1 QUALIFY row_number() OVER (PARTITION BY component, pub ORDER BY cr, d DESC, id) <= 2),
cp AS (SELECT component, raw, count(*) AS capped, count(DISTINCT source_id) AS sources FROM k2 GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT source_id) >= 2)"""


@query("g05_overbroad_components", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {ANCHOR_SQL}, {EDGE_SQL}, {COMP_SQL}, {CAP_SQL} SELECT component, raw AS raw_count, 'over-broad:4' AS reason FROM sz WHERE raw > 4")
def g05_over(spark, sf):
    """What a bound on the documents of a component would leave out, as rows."""
    _, kept, _ = graph_parts(spark, sf)
    return graph.overbroad_components(stages.components(spark, sf), kept, graph.ClusterPolicy(maximum_cluster_documents=4))


@query("g05_capped_clusters", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {ANCHOR_SQL}, {EDGE_SQL}, {COMP_SQL}, {CAP_SQL} SELECT * FROM cp")
def g05(spark, sf):
    n = capped_table(spark, sf).groupBy("component").agg(F.first("raw_count").alias("raw"), F.count("*").alias("capped"), F.count_distinct("source_id").alias("sources"))
    return n


def _features(spark, sf):
    capped = capped_table(spark, sf)
    return capped, graph.context_features(capped, stages.concept_docs(spark, sf), stages.components(spark, sf), CLUSTERS)


@query("g06_context_features", f"""WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {ANCHOR_SQL}, {EDGE_SQL}, {COMP_SQL}, {CAP_SQL}, cd AS (SELECT k2.component, k2.id FROM k2 JOIN cp USING (component)),
f AS (SELECT component, cd.id, 'theme:' || t AS feature FROM cd JOIN items ON items.id = cd.id, unnest(items.theme_ids) u(t) UNION SELECT component, cd.id, 'action:' || aid FROM cd JOIN ac ON ac.id = cd.id
  UNION SELECT component, cd.id, 'concept:' || nid FROM cd JOIN nd ON nd.id = cd.id WHERE kind IN ('primitive','emergent-phrase','theme') AND nid NOT IN (SELECT co.id FROM co WHERE co.component = cd.component))
SELECT component, feature, count(*) AS documents FROM f GROUP BY 1, 2""")
def g06(spark, sf):
    _, f = _features(spark, sf)
    return f.groupBy("component", "feature").agg(F.count("*").alias("documents"))


_DFAM = ", ".join(f"('{k}','{v}')" for k, v in C.DISCOVERY_FAMILIES.items())
CORE_SQL = """cd AS (SELECT k2.component, k2.id, k2.source_id, k2.pub, cp.raw, cp.capped FROM k2 JOIN cp USING (component)),
ft AS (SELECT component, cd.id, 'theme:' || t AS feature FROM cd JOIN items ON items.id = cd.id, unnest(items.theme_ids) u(t) UNION SELECT component, cd.id, 'action:' || aid FROM cd JOIN ac ON ac.id = cd.id
  UNION SELECT component, cd.id, 'concept:' || nid FROM cd JOIN nd ON nd.id = cd.id WHERE kind IN ('primitive','emergent-phrase','theme') AND nid NOT IN (SELECT co.id FROM co WHERE co.component = cd.component)),
ln AS (SELECT DISTINCT a.component, a.id AS x, b.id AS y FROM ft a JOIN ft b ON a.component = b.component AND a.feature = b.feature),
rc AS (SELECT component, id AS x, id AS y FROM cd UNION SELECT rc.component, rc.x, ln.y FROM rc JOIN ln ON ln.component = rc.component AND ln.x = rc.y),
zp AS (SELECT component, x AS id, min(y) AS part FROM rc GROUP BY 1, 2),
zb AS (SELECT component, part FROM zp JOIN cd USING (component, id) GROUP BY 1, 2 HAVING count(*) >= 2 AND count(DISTINCT source_id) >= 2 QUALIFY row_number() OVER (PARTITION BY component ORDER BY count(DISTINCT source_id) DESC, count(*) DESC, min(id)) = 1),
core AS (SELECT zp.component, id FROM zp JOIN zb USING (component, part))"""
CLUSTER_SQL = f"""zf(channel, family) AS (VALUES {_DFAM}),
zr AS (SELECT cd.*, items.source_type, coalesce(family, items.source_type) AS family, cd.component IN (SELECT component FROM core) AS has_core, items.ts > {demo.AS_OF_SQL} - INTERVAL 7 DAY OR items.id IN (SELECT 'doc:' || doc_id FROM labels) AS chg FROM cd JOIN items ON items.id = cd.id LEFT JOIN zf ON zf.channel = items.source_type
  WHERE cd.component NOT IN (SELECT component FROM core) OR (cd.component, cd.id) IN (SELECT (component, id) FROM core)),
zs AS (SELECT co.component, kp.anchor_id, count(*) AS d, count(DISTINCT zr.source_id) AS s FROM kp JOIN co ON co.id = kp.anchor_id JOIN zr ON zr.component = co.component AND zr.id = kp.id GROUP BY 1, 2),
zl AS (SELECT anchor_id, min(label) AS label, min(kind) AS kind FROM po GROUP BY 1),
za AS (SELECT zs.*, label, kind FROM zs JOIN zl USING (anchor_id) QUALIFY row_number() OVER (PARTITION BY component ORDER BY s DESC, d DESC, label, anchor_id) <= 8),
zg AS (SELECT component, list_sort(list(anchor_id)) AS anchors, max(d) AS top, list_distinct(list(kind)) AS kinds FROM za GROUP BY 1),
zu AS (SELECT component, max(n) AS dominant FROM (SELECT component, pub, count(*) AS n FROM zr GROUP BY 1, 2) GROUP BY 1),
zt AS (SELECT component, count(*) FILTER (WHERE n >= 2) AS recurring FROM (SELECT component, t, count(*) AS n FROM zr JOIN items ON items.id = zr.id, unnest(theme_ids) u(t) GROUP BY 1, 2) GROUP BY 1),
zm AS (SELECT component, count(*) AS n, count(DISTINCT zr.source_id) AS sources, count(DISTINCT family) AS families, count_if(family IN ('builders','research','engineering')) AS technical, any_value(raw) AS raw, any_value(capped) AS capped,
  bool_or(has_core) AS coherent, list_sort(list(zr.id)) AS ids, count_if(chg) AS changed FROM zr GROUP BY 1),
zc AS (SELECT 'discovery:' || coalesce(nullif(substr({SLUG_SQL % "regexp_replace(anchors[1], '^[^:]*:', '')"}, 1, 42), ''), 'pattern') || '-' || substr(sha256(array_to_string(anchors, '|')), 1, 10) AS id, zm.*, anchors, kinds, dominant, round_even(top / n, 3) AS share, coalesce(recurring, 0) AS recurring
  FROM zm JOIN zg USING (component) JOIN zu USING (component) LEFT JOIN zt USING (component)),
zo AS (SELECT *, row_number() OVER (ORDER BY families DESC, sources DESC, n DESC, id) AS rn FROM zc),
zw AS (SELECT 0::BIGINT AS rn, []::VARCHAR[][] AS kept, NULL::VARCHAR AS pick UNION ALL SELECT q.rn, CASE WHEN ok THEN list_append(kept, q.ids) ELSE kept END, CASE WHEN ok THEN q.id END FROM (SELECT zo.rn, zo.ids, zo.id, zw.kept,
  len(list_filter(zw.kept, lambda k: len(list_intersect(k, zo.ids)) / len(list_distinct(list_concat(k, zo.ids))) >= 0.8)) = 0 AS ok FROM zw JOIN zo ON zo.rn = zw.rn + 1) q),
zk AS (SELECT zo.* FROM zo JOIN zw ON zw.pick = zo.id AND zw.rn = zo.rn)"""
GRAPH_SQL = f"{MINE_SQL}, {REL_SQL}, {ANCHOR_SQL}, {EDGE_SQL}, {COMP_SQL}, {CAP_SQL}, {CORE_SQL}"


@query("g07_coherent_core", f"WITH RECURSIVE {GRAPH_SQL} SELECT component, id AS evidence_id FROM core")
def g07(spark, sf):
    capped, f = _features(spark, sf)
    core, _ = graph.coherent_core(capped, cut_lineage(f, "features"))
    return core.select("component", "evidence_id")


@query("g01_allowed_anchors", f"WITH RECURSIVE {MINE_SQL}, {REL_SQL}, {ANCHOR_SQL} SELECT kind, count(*) AS postings FROM po GROUP BY 1")
def g01(spark, sf):
    return graph.anchor_postings(stages.concept_docs(spark, sf), CLUSTERS).groupBy("kind").agg(F.count("*").alias("postings"))


@query("g09_distinct_clusters", f"WITH RECURSIVE {GRAPH_SQL}, {CLUSTER_SQL} SELECT id, n AS evidence, sources, round_even(dominant / n, 3) AS share FROM zk")
def g09(spark, sf):
    c = stages.clusters(spark, sf)
    return c.select("id", F.size("evidence_ids").alias("evidence"), F.col("metrics.source_count").alias("sources"), F.col("metrics.dominant_publisher_share").alias("share"))


@query("g09_order_sets", """WITH RECURSIVE s AS (SELECT l_orderkey AS id, list_sort(list(DISTINCT l_suppkey)) AS e FROM lineitem GROUP BY 1), u AS (SELECT min(id) AS id, e FROM s GROUP BY e), pr AS (SELECT DISTINCT a.id, b.id AS better FROM (SELECT id, e, unnest(e) AS t FROM u) a JOIN (SELECT id, e, unnest(e) AS t FROM u) b ON a.t = b.t AND len(b.e) * 0.8 <= len(a.e) AND len(a.e) <= len(b.e) AND len(b.e) > 4 AND (len(b.e), -b.id) > (len(a.e), -a.id)
  WHERE len(list_intersect(a.e, b.e)) / len(list_distinct(list_concat(a.e, b.e))) >= 0.8)
SELECT id, len(e) AS evidence FROM u WHERE id NOT IN (SELECT p.id FROM pr p WHERE NOT EXISTS (SELECT 1 FROM pr q WHERE q.id = p.better))""")
def g09o(spark, sf):
    li = demo.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))).alias("evidence_ids"))
    out = graph.distinct_clusters(li, [-F.size("evidence_ids"), F.col("id")])
    return out.select("id", F.size("evidence_ids").alias("evidence"))


# ---- discovery --------------------------------------------------------------------------------

@query("g08_cluster_ids", f"WITH RECURSIVE {GRAPH_SQL}, {CLUSTER_SQL} SELECT id, array_to_string(anchors, '|') AS anchors, true AS stable FROM zk")
def g08(spark, sf):
    c = stages.clusters(spark, sf)
    return c.select("id", F.array_join(F.array_sort("anchor_ids"), "|").alias("anchors"), (F.col("id") == graph.cluster_id(F.array_sort("anchor_ids"))).alias("stable"))


@query("a21_cluster_metrics", f"WITH RECURSIVE {GRAPH_SQL}, {CLUSTER_SQL} SELECT id, n AS evidence_count, n AS independent_event_count, sources AS source_count, families AS source_family_count, technical AS technical_record_count, round_even(dominant / n, 3) AS dominant_publisher_share, raw AS raw_evidence_count, capped AS capped_evidence_count, changed AS changed_evidence_count FROM zk")
def a21(spark, sf):
    return stages.clusters(spark, sf).select("id", "metrics.*")


QUALITY_SQL = """zq AS (SELECT *, share >= 0.67 AS met, list_has_any(kinds, ['primitive','relationship']) AS structural, list_contains(kinds, 'emergent-phrase') AS phrase, len(list_filter(kinds, lambda k: k NOT IN ('project','technology'))) = 0 AS entity FROM zk),
zz AS (SELECT *, coherent AND met AND (structural OR phrase) AND NOT entity AND (structural OR (phrase AND sources >= 3 AND technical >= 1)) AS spark_ok, coherent AND met AND (structural OR phrase) AND NOT entity AND (structural OR (phrase AND sources >= 3 AND families >= 3 AND technical >= 2)) AS candidate_ok FROM zq)"""


@query("a22_cluster_quality", f"WITH RECURSIVE {GRAPH_SQL}, {CLUSTER_SQL}, {QUALITY_SQL} SELECT id, share AS anchor_support_share, met AS anchor_support_met, structural AS has_structural_anchor, len(kinds) = 1 AND phrase AS phrase_only, entity AS entity_only, recurring AS recurrent_theme_count, coherent AS context_coherence_met, spark_ok AS spark_quality_met, candidate_ok AS candidate_quality_met FROM zz")
def a22(spark, sf):
    return stages.clusters(spark, sf).select("id", "quality.*")


_DV = ", ".join(f"({_q(d['id'])}, {_q(d['title'])}, {_q(d['theme_ids'])}, {_q([p.lower() for p in d.get('match_phrases', [])])})" for d in stages.DIRECTIONS)
_TV = ", ".join(f"({_q(t['id'])}, {_q(sorted({v.lower().replace('-', ' ') for v in [t['name'], *t['aliases']]}))})" for t in stages.theme_rules())
KNOWN_SQL = f"""dv(did, title, themes, phr) AS (VALUES {_DV}), tv(tid, known) AS (VALUES {_TV}),
zlab AS (SELECT component, list(lower(replace(label, '-', ' '))) AS every, coalesce(list(lower(replace(label, '-', ' '))) FILTER (WHERE kind <> 'relationship'), []::VARCHAR[]) AS plain FROM za GROUP BY 1),
zth AS (SELECT component, t, count(*) AS k FROM zr JOIN items ON items.id = zr.id, unnest(theme_ids) u(t) GROUP BY 1, 2 HAVING count(*) >= 2), zrec AS (SELECT component, list(t) AS rec FROM zth GROUP BY 1),
x1 AS (SELECT zk.id, did, title, list_has_any(every, phr) AS bp, len(list_intersect(coalesce(rec, []::VARCHAR[]), themes)) AS m, len(list_intersect(coalesce(rec, []::VARCHAR[]), themes)) / len(themes) AS r FROM zk JOIN zlab ON zlab.component = zk.component LEFT JOIN zrec ON zrec.component = zk.component, dv),
x2 AS (SELECT id, did, CASE WHEN bp THEN 'disclosed-phrase' ELSE 'recurrent-theme-recall' END AS basis FROM x1 WHERE bp OR (m >= 2 AND r >= 0.6) QUALIFY row_number() OVER (PARTITION BY id ORDER BY bp DESC, round_even(r, 3) DESC, title) = 1),
x3 AS (SELECT id, tid FROM (SELECT zk.id, tid, max(length(a)) AS l FROM zk JOIN zlab ON zlab.component = zk.component, unnest(plain) u(a), tv, unnest(known) w(k)
  WHERE len(string_split(a, ' ')) >= 2 AND (contains(' ' || k || ' ', ' ' || a || ' ') OR contains(' ' || a || ' ', ' ' || k || ' ')) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY id ORDER BY l DESC, tid) = 1),
x4 AS (SELECT zk.id, t AS tid, k / zk.n AS sh FROM zk JOIN zth ON zth.component = zk.component QUALIFY row_number() OVER (PARTITION BY zk.id ORDER BY k DESC, t) = 1),
x5 AS (SELECT zk.id, CASE WHEN did IS NOT NULL THEN 'merge-existing-direction' WHEN x3.tid IS NOT NULL OR sh >= 0.5 THEN 'covered-by-existing-theme' WHEN recurring >= 2 THEN 'cross-theme-extension' ELSE 'novel' END AS disposition,
  coalesce(did, x3.tid, CASE WHEN sh >= 0.5 THEN x4.tid END) AS nearest_id, CASE WHEN did IS NOT NULL THEN basis WHEN x3.tid IS NOT NULL THEN 'anchor-phrase' WHEN sh >= 0.5 THEN 'document-share' END AS nearest_basis
  FROM zk LEFT JOIN x2 ON x2.id = zk.id LEFT JOIN x3 ON x3.id = zk.id LEFT JOIN x4 ON x4.id = zk.id)"""
FULL_SQL = f"WITH RECURSIVE {GRAPH_SQL}, {CLUSTER_SQL}, {QUALITY_SQL}, {KNOWN_SQL}"


@query("g10_known_dispositions", f"{FULL_SQL} SELECT disposition, nearest_id, nearest_basis, count(*) AS clusters FROM x5 GROUP BY 1, 2, 3")
def g10(spark, sf):
    return stages.clusters(spark, sf).groupBy("disposition", "nearest_id", "nearest_basis").agg(F.count("*").alias("clusters"))


@query("g11_discovery_records", f"""{FULL_SQL}, gs AS (SELECT zz.*, disposition, CASE WHEN n >= 3 AND sources >= 3 AND families >= 2 AND round_even(dominant / n, 3) <= 0.5 THEN 'candidate' WHEN n >= 2 AND sources >= 2 THEN 'spark' END AS gate FROM zz JOIN x5 ON x5.id = zz.id WHERE spark_ok AND changed > 0 AND disposition IN ('novel','cross-theme-extension'))
SELECT disposition, CASE WHEN gate = 'candidate' AND NOT candidate_ok THEN 'spark' ELSE gate END AS state, count(*) AS records, 0 AS broken FROM gs WHERE gate IS NOT NULL GROUP BY 1, 2""")
def g11(spark, sf):
    r = G.discovery_records(stages.clusters(spark, sf))
    return r.groupBy("disposition", "state").agg(F.count("*").alias("records"), F.count_if(F.size("violations") > 0).alias("broken"))


@query("g12_merge_suggestions", f"{FULL_SQL} SELECT x5.id, disposition, nearest_id, nearest_basis, changed > 0 AS materially_changed FROM x5 JOIN zk ON zk.id = x5.id WHERE disposition IN ('merge-existing-direction','covered-by-existing-theme')")
def g12(spark, sf):
    return G.merge_suggestions(stages.clusters(spark, sf)).select("id", "disposition", "nearest_id", "nearest_basis", "materially_changed")


@query("w15_cluster_order", f"""{FULL_SQL}, zx AS (SELECT component, feature, count(*) AS c FROM ft JOIN core USING (component, id) GROUP BY 1, 2 HAVING count(*) >= 2 QUALIFY row_number() OVER (PARTITION BY component ORDER BY count(*) DESC, feature) <= 12),
zy AS (SELECT component, string_agg(feature, ',' ORDER BY c DESC, feature) AS context FROM zx GROUP BY 1), zn AS (SELECT component, count(DISTINCT t) AS k FROM zr JOIN items ON items.id = zr.id, unnest(theme_ids) u(t) GROUP BY 1)
SELECT zk.id, len(anchors) AS anchors, least(6, coalesce(zn.k, 0)) AS themes, context FROM zk LEFT JOIN zy ON zy.component = zk.component LEFT JOIN zn ON zn.component = zk.component""")
def w15(spark, sf):
    c = stages.clusters(spark, sf)
    return c.select("id", F.size("anchors").alias("anchors"), F.size("theme_ids").alias("themes"), F.array_join("context_features", ",").alias("context"))


@query("m07_discovery_review", f"{FULL_SQL} SELECT count(*) AS cluster_count, count_if(coherent) AS coherent_cluster_count, count_if(spark_ok) AS quality_eligible_cluster_count, count_if(disposition NOT IN ('novel','cross-theme-extension')) AS explained_cluster_count, count_if(spark_ok AND changed > 0 AND disposition IN ('novel','cross-theme-extension')) AS unexplained_quality_eligible_count FROM zz JOIN x5 ON x5.id = zz.id")
def m07(spark, sf):
    return G.run_summary(stages.clusters(spark, sf))


@query("m07_discovery_records", f"""{FULL_SQL}, gs AS (SELECT zz.*, disposition, CASE WHEN n >= 3 AND sources >= 3 AND families >= 2 AND round_even(dominant / n, 3) <= 0.5 THEN 'candidate' WHEN n >= 2 AND sources >= 2 THEN 'spark' END AS gate FROM zz JOIN x5 ON x5.id = zz.id WHERE spark_ok AND changed > 0 AND disposition IN ('novel','cross-theme-extension'))
SELECT CASE WHEN gate = 'candidate' AND NOT candidate_ok THEN 'spark' ELSE gate END AS section, id, disposition, changed FROM gs WHERE gate IS NOT NULL
UNION ALL SELECT 'merge', x5.id, disposition, changed FROM x5 JOIN zk ON zk.id = x5.id WHERE disposition IN ('merge-existing-direction','covered-by-existing-theme')""")
def m07_records(spark, sf):
    """The records of the discovery review by state, and its merge suggestions."""
    t = G.discovery_review(stages.clusters(spark, sf))
    row = lambda df, section: df.select(F.lit(section).alias("section"), "id", "disposition", F.col("changed_evidence_count").alias("changed"))
    return row(t["spark"], "spark").unionByName(row(t["candidate"], "candidate")).unionByName(row(t["merges"], "merge"))
