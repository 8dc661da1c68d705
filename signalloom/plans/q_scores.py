"""Queries over scores, lifecycle, ranking, change and gates, each with its DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from signalloom.functions import constants as C, dates as D
from signalloom.operators import change as H, classify as K, gates, lifecycle as L, publish, pulse as P, quality as Q, ranking as R, review
from signalloom.operators import resolve as V, scores as S
from signalloom.plans import demo, marts, stages
from signalloom.plans.demo import EV_SQL, EVC_SQL, EVD_SQL, evidence, table
from signalloom.session import cut_lineage, shared_dir
from signalloom.plans.q_text import ELIG_SQL, J4_SQL, J5_SQL, PROJ_SQL, VERIFICATION_RULES, classified, event_rules, projects

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


VOLUME_AS_OF = "1999-06-20T00:00:00Z"
V_SQL = "TIMESTAMP '1999-06-20 00:00:00'"
CH_SQL = demo._q(demo.CHANNELS)
FAM_SQL = "fam(channel, family) AS (VALUES " + ", ".join(f"('{k}','{v}')" for k, v in C.LIFECYCLE_FAMILIES.items()) + ")"
# Volume evidence: line items with the brand as theme and the supplier as publisher.
LI_SQL = f"""li AS (SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' || strftime(l_shipdate, '%Y%m%d') AS id, p_brand AS theme_id, 'pub' || l_suppkey AS publisher_id, 'sup' || l_suppkey AS source_id,
  {CH_SQL}[(l_suppkey % 14 + 1)::INT] AS channel, l_shipdate AS ts, strftime(l_shipdate, '%Y-%m') AS month, 1 AS support FROM lineitem JOIN part ON p_partkey = l_partkey)"""


def volume(spark, sf):
    li = demo.spread(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("theme_id"))
    ts = F.col("l_shipdate").cast("timestamp")
    return li.join(p, "l_partkey").select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")).alias("id"), "theme_id", F.concat(F.lit("pub"), "l_suppkey").alias("publisher_id"),
        F.concat(F.lit("sup"), "l_suppkey").alias("source_id"),
        F.element_at(F.array(*[F.lit(c) for c in demo.CHANNELS]), (F.col("l_suppkey") % 14 + 1).cast("int")).alias("channel"),
        ts.alias("ts"), F.date_format(ts, "yyyy-MM").alias("month"), F.lit(1).alias("support"))


def doc_rows(spark, sf):
    """Classified evidence, one row per theme, with publisher, support and month."""
    s = demo.sources(spark).select(F.col("id").alias("source_id"), F.col("publisher_id").alias("_p"))
    e = K.by_theme(classified(spark, sf)).join(s, "source_id", "left")
    return e.withColumn("publisher_id", F.coalesce("_p", F.col("source_id"))).withColumn("support", F.lit(1)).withColumn(
        "month", D.month_key(F.col("published_at")))


DR_SQL = """dr AS (SELECT cl.id, cl.source_id, cl.source_type, cl.published_at, cl.ts, coalesce(s.publisher_id, source_id) AS publisher_id, strftime(ts, '%Y-%m') AS month, 1 AS support, theme_id
  FROM cl LEFT JOIN src s ON s.id = source_id, unnest(theme_ids) u(theme_id))"""
MONTHS = D.last_months(demo.AS_OF)
VMONTHS = D.last_months(VOLUME_AS_OF)


def score_sql(rows: str, months: list[str]) -> str:
    m = ", ".join(f"sum(CASE WHEN month = '{x}' THEN support ELSE 0 END) AS m{i}" for i, x in enumerate(months))
    sums = ", ".join(f"sum(m{i}) AS m{i}" for i in range(6))
    act = " + ".join(f"(m{i} > 0)::INT" for i in range(6))
    return f"""pp AS (SELECT theme_id, publisher_id, sum(support) AS sup, count(*) AS obs, {m} FROM {rows} GROUP BY 1, 2),
tt AS (SELECT theme_id, sum(sup) AS support_units, sum(obs) AS evidence_count, count(*) AS source_count, sum(ln(1 + sup)) AS eff, max(sup) AS dom, {sums} FROM pp GROUP BY 1),
sc AS (SELECT theme_id, support_units, evidence_count, source_count, round_even(25 * eff / (max(eff) OVER ()), 1) AS recurrence,
  round_even(least(25, greatest(0, 12.5 + 10 * log2(((m4 + m5) / 2 + 1) / ((m2 + m3) / 2 + 1)))), 1) AS acceleration,
  round_even(25 * ({act}) / 6, 1) AS persistence, least(25.0, source_count * 5.0)::DOUBLE AS breadth, round_even(dom / support_units, 2) AS concentration FROM tt),
st AS (SELECT *, round_even(recurrence + acceleration + persistence + breadth, 1) AS total FROM sc),
sm AS (SELECT *, CASE WHEN source_count = 1 THEN 'source-specific' WHEN source_count = 2 THEN 'emerging' WHEN concentration >= 0.75 THEN 'corroborated-source-concentrated'
  WHEN source_count >= 4 AND total >= 70 THEN 'broadly-corroborated' ELSE 'corroborated' END AS maturity FROM st)"""


# ---- scores -----------------------------------------------------------------------------------

@query("w01_theme_ranking", f"""WITH {EVC_SQL}, {DR_SQL}, {score_sql('dr', MONTHS)}, {demo.THEME_SQL}
SELECT thm.id, name, coalesce(evidence_count, 0) AS evidence_count, coalesce(source_count, 0) AS source_count, recurrence, acceleration, persistence, breadth, concentration, total,
  coalesce(maturity, 'unobserved') AS maturity, row_number() OVER (ORDER BY total DESC NULLS LAST, name) AS rank FROM thm LEFT JOIN sm ON theme_id = thm.id""")
def w01(spark, sf):
    s = S.cross_source_scores(doc_rows(spark, sf), demo.AS_OF)
    t = S.with_unobserved(demo.themes(spark).select("id", "name"), s)
    r = R.global_rank(t, [F.desc_nulls_last("total"), F.col("name")])
    return r.select("id", "name", "evidence_count", "source_count", "recurrence", "acceleration", "persistence", "breadth", "concentration", "total", "maturity", "rank")


@query("a01_item_theme_score", f"""WITH {EVC_SQL}, {DR_SQL}, x AS (SELECT *, floor((epoch_us({demo.AS_OF_SQL}) - epoch_us(ts)) / 86400000000) AS age FROM dr),
g AS (SELECT theme_id, count(*) AS n, count_if(age BETWEEN 0 AND 30) AS r, count_if(age BETWEEN 31 AND 60) AS p, count(DISTINCT month) AS m, count(DISTINCT source_type) AS t FROM x GROUP BY 1)
SELECT theme_id, n AS item_count, least(25.0, n * 2.5)::DOUBLE AS recurrence, least(25, greatest(0, (r - p) * 4.0 + CASE WHEN r > 0 THEN 8 ELSE 0 END))::DOUBLE AS acceleration,
  least(25.0, m * 5.0)::DOUBLE AS persistence, least(25.0, t * 5.0)::DOUBLE AS breadth FROM g""")
def a01(spark, sf):
    return S.item_theme_scores(doc_rows(spark, sf), demo.AS_OF).drop("total")


@query("a02_theme_score", f"WITH {LI_SQL}, {score_sql('li', VMONTHS)} SELECT theme_id, evidence_count, support_units, source_count, recurrence, acceleration, persistence, breadth, concentration, total, maturity FROM sm")
def a02(spark, sf):
    return S.cross_source_scores(volume(spark, sf), VOLUME_AS_OF).drop("monthly_counts")


@query("a03_source_breakdown", f"WITH {LI_SQL} SELECT theme_id, publisher_id, count(*) AS observations, sum(support) AS support_units, string_agg(DISTINCT source_id, ',') AS source_ids FROM li GROUP BY 1, 2")
def a03(spark, sf):
    return S.source_breakdown(volume(spark, sf)).withColumn("source_ids", F.array_join("source_ids", ","))


@query("a05_month_spine", f"""WITH {LI_SQL}, sp AS (SELECT DISTINCT theme_id, m FROM li, (VALUES {', '.join(f"('{m}')" for m in VMONTHS)}) v(m))
SELECT sp.theme_id, m AS month, count(li.id) AS n FROM sp LEFT JOIN li ON li.theme_id = sp.theme_id AND li.month = m GROUP BY 1, 2""")
def a05(spark, sf):
    v = volume(spark, sf)
    brands = table(spark, sf, "part").select(F.col("p_brand").alias("id")).distinct()
    return S.month_spine(v, brands, VOLUME_AS_OF)


@query("a08_theme_summary", f"""WITH {EVC_SQL}, {DR_SQL} SELECT theme_id, count(*) AS evidence_count, count(DISTINCT source_id) AS source_count, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS source_ids
FROM dr WHERE source_type IN ('expert-social','operator-essay','investor-essay') GROUP BY 1""")
def a08(spark, sf):
    r = doc_rows(spark, sf).filter(F.col("source_type").isin("expert-social", "operator-essay", "investor-essay"))
    return S.theme_summary(r).withColumn("source_ids", F.array_join("source_ids", ","))


@query("a09_source_freshness", f"""WITH {EV_SQL}, g AS (SELECT source_id, count(*) AS n, max(ts) AS latest FROM ev WHERE ts <= {demo.AS_OF_SQL} - to_days((doc_id % 120)::INT) GROUP BY 1)
SELECT src.id, coalesce(n, 0) AS n, CASE WHEN n > 0 THEN 'active' ELSE 'configured' END AS status,
  CASE WHEN latest IS NULL THEN 'configured' WHEN greatest(0, floor(epoch({demo.AS_OF_SQL} - latest) / 86400)) <= 30 THEN 'recent' WHEN greatest(0, floor(epoch({demo.AS_OF_SQL} - latest) / 86400)) <= 90 THEN 'aging' ELSE 'historical' END AS freshness
FROM src LEFT JOIN g ON source_id = src.id""".replace(" WHERE ts <= " + demo.AS_OF_SQL + " - to_days((doc_id % 120)::INT)", ""))
def a09(spark, sf):
    return S.source_freshness(evidence(spark, sf), demo.sources(spark), demo.AS_OF).select("id", "n", "status", "freshness")


@query("a10_coverage", f"""WITH {EVC_SQL} SELECT CASE WHEN grouping(disposition) = 1 THEN 'total' WHEN grouping(rule_id) = 1 THEN 'disposition' ELSE 'rule' END AS level,
  coalesce(disposition, 'all') AS disposition, coalesce(rule_id, 'all') AS rule_id, count(*) AS records,
  CASE WHEN grouping(disposition) = 1 THEN round_even(count_if(disposition2 = 'classified') / (count_if(disposition2 <> 'out-of-scope')), 3) END AS in_scope_coverage,
  CASE WHEN grouping(disposition) = 1 THEN round_even(count_if(disposition2 = 'classified') / count(*), 3) END AS raw_coverage
FROM (SELECT *, disposition AS disposition2 FROM cl) GROUP BY GROUPING SETS ((disposition), (disposition, rule_id), ())""")
def a10(spark, sf):
    return S.coverage(classified(spark, sf).withColumn("_d", F.col("disposition")))


def directions_rows(spark, sf, read=classified):
    s = demo.sources(spark).select(F.col("id").alias("source_id"), F.col("publisher_id").alias("_p"), F.col("channel").alias("_c"))
    e = read(spark, sf).join(s, "source_id", "left")
    e = e.withColumn("publisher_id", F.coalesce("_p", F.col("source_id"))).withColumn("channel", F.coalesce("_c", F.col("source_type")))
    return e.drop("_p", "_c")


_LOW = "replace(lower(title || ' ' || summary), 'ß', 'ss')"


def _dir_case(d) -> str:
    ov = f"len(list_intersect(theme_ids, {demo._q(d['theme_ids'])})) >= {d.get('minimum_theme_overlap', 2)}"
    ph = d.get("match_phrases")
    if ph:
        ov += " AND (" + " OR ".join(f"contains({_LOW}, '{p}')" for p in ph) + ")"
    return f"CASE WHEN {ov} THEN '{d['id']}' END"


DI_SQL = f"""{FAM_SQL}, di AS (SELECT cl.id, source_id, title, published_at, ts, coalesce(s.publisher_id, source_id) AS publisher_id, coalesce(family, source_type) AS family, direction_id
  FROM cl LEFT JOIN src s ON s.id = source_id LEFT JOIN fam ON fam.channel = source_type,
  unnest([{', '.join(_dir_case(d) for d in stages.DIRECTIONS)}]) u(direction_id) WHERE direction_id IS NOT NULL)"""
_T = demo.AS_OF_SQL
SNAP_SQL = f"""gr AS (SELECT d AS direction_id, w AS weeks_ago, {_T} - to_days((7 * w)::INT) AS e FROM (VALUES {', '.join(f"('{d['id']}')" for d in stages.DIRECTIONS)}) v(d), range(8) r(w)),
sn AS (SELECT gr.direction_id, weeks_ago, count(di.id) AS dated, coalesce(count_if(ts > e - INTERVAL 90 DAY), 0) AS evidence_count, coalesce(count_if(ts > e - INTERVAL 30 DAY), 0) AS recent_count,
  count(DISTINCT CASE WHEN ts > e - INTERVAL 90 DAY THEN family END) AS family_count, count(DISTINCT CASE WHEN ts > e - INTERVAL 90 DAY THEN publisher_id END) AS source_count,
  count(DISTINCT CASE WHEN ts > e - INTERVAL 90 DAY AND family IN ('builders','research','engineering') THEN family END) AS tech,
  (count_if(ts > e - INTERVAL 30 DAY) > 0)::INT + (count_if(ts > e - INTERVAL 60 DAY AND ts <= e - INTERVAL 30 DAY) > 0)::INT + (count_if(ts > e - INTERVAL 90 DAY AND ts <= e - INTERVAL 60 DAY) > 0)::INT AS active_periods
  FROM gr LEFT JOIN di ON di.direction_id = gr.direction_id AND ts <= e GROUP BY 1, 2),
sg AS (SELECT *, CASE WHEN dated = 0 THEN 'unobserved' WHEN evidence_count = 0 OR recent_count = 0 THEN 'fading' WHEN family_count >= 5 AND source_count >= 6 AND tech >= 2 AND active_periods >= 2 THEN 'established'
  WHEN family_count >= 3 AND source_count >= 5 AND tech >= 2 THEN 'corroborating' WHEN family_count >= 2 AND source_count >= 2 AND tech >= 1 THEN 'emerging' ELSE 'weak-signal' END AS stage FROM sn)"""


@stages.shared("tagged")
def tagged(spark, sf):
    """Evidence per direction it supports, written once as the few columns that are read."""
    rows = V.qualify(directions_rows(spark, sf, stages.classified_once), stages.DIRECTIONS)
    return rows.select("direction_id", "id", "source_id", "publisher_id", L.family(F.col("channel")).alias("family"), "ts")


@query("j13_directions", f"WITH {EVC_SQL}, {DI_SQL} SELECT direction_id, id FROM di")
def j13(spark, sf):
    return tagged(spark, sf).select("direction_id", "id")


@query("a06_lifecycle_snapshot", f"WITH {EVC_SQL}, {DI_SQL}, {SNAP_SQL} SELECT direction_id, dated, evidence_count, recent_count, family_count, source_count, tech AS technical_family_count, active_periods, stage FROM sg WHERE weeks_ago = 0 AND dated > 0")
def a06(spark, sf):
    return L.snapshots(tagged(spark, sf), "direction_id", demo.AS_OF, [0]).drop("weeks_ago", "confidence")


@query("a06_volume_lifecycle", f"""WITH {LI_SQL}, {FAM_SQL}, x AS (SELECT theme_id, coalesce(family, li.channel) AS family, publisher_id, ts FROM li LEFT JOIN fam USING (channel) WHERE ts <= {V_SQL})
SELECT theme_id, count(*) AS dated, count_if(ts > {V_SQL} - INTERVAL 90 DAY) AS evidence_count, count(DISTINCT CASE WHEN ts > {V_SQL} - INTERVAL 90 DAY THEN publisher_id END) AS source_count,
  count(DISTINCT CASE WHEN ts > {V_SQL} - INTERVAL 90 DAY THEN family END) AS family_count FROM x GROUP BY 1""")
def a06v(spark, sf):
    v = volume(spark, sf).withColumn("family", L.family(F.col("channel")))
    return L.snapshots(v, "theme_id", VOLUME_AS_OF, [0]).select("theme_id", "dated", "evidence_count", "source_count", "family_count")


@query("a07_family_summary", f"WITH {EVC_SQL}, {DI_SQL} SELECT direction_id, family, count(DISTINCT publisher_id) AS source_count, count(*) AS evidence_count, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS source_ids FROM di WHERE ts > {_T} - INTERVAL 90 DAY AND ts <= {_T} GROUP BY 1, 2")
def a07(spark, sf):
    return L.family_summary(tagged(spark, sf), "direction_id", demo.AS_OF).withColumn("source_ids", F.array_join("source_ids", ","))


@query("w02_weekly_movement", f"""WITH {LI_SQL}, g AS (SELECT theme_id, count_if(ts > {V_SQL} - INTERVAL 7 DAY AND ts <= {V_SQL}) AS recent, count_if(ts > {V_SQL} - INTERVAL 14 DAY AND ts <= {V_SQL} - INTERVAL 7 DAY) AS prior FROM li GROUP BY 1)
SELECT theme_id, recent, prior, recent - prior AS delta, CASE WHEN prior = 0 THEN 'new' WHEN recent >= prior * 1.5 THEN 'rising' WHEN prior >= recent * 1.5 THEN 'falling' ELSE 'steady' END AS direction
FROM g WHERE recent + prior > 0 ORDER BY recent DESC, delta DESC, theme_id LIMIT 10""")
def w02(spark, sf):
    return L.weekly_movement(volume(spark, sf), VOLUME_AS_OF)


W3_SQL = f"""mv AS (SELECT direction_id, count_if(ts > {_T} - INTERVAL 14 DAY) AS c, count_if(ts > {_T} - INTERVAL 28 DAY AND ts <= {_T} - INTERVAL 14 DAY) AS p, min(ts) AS f, arg_min(id, (ts, id)) AS origin_id, arg_max(id, (ts, id)) AS last_id FROM di WHERE ts <= {_T} GROUP BY 1),
mm AS (SELECT mv.*, stage, family_count, source_count, CASE WHEN stage = 'fading' THEN 'fading' WHEN f > {_T} - INTERVAL 14 DAY THEN 'new' WHEN c - p >= 2 AND c >= greatest(2, ceil(p * 1.5)) THEN 'accelerating' WHEN c > 0 AND p = 0 THEN 'resurfacing'
  WHEN c - p <= -2 AND p >= greatest(2, ceil(c * 1.5)) THEN 'cooling' ELSE 'steady' END AS movement FROM mv JOIN sg ON sg.direction_id = mv.direction_id AND weeks_ago = 0)"""


@query("w03_signal_movement", f"WITH {EVC_SQL}, {DI_SQL}, {SNAP_SQL}, {W3_SQL} SELECT direction_id, stage, c AS current_count, p AS previous_count, c - p AS change, origin_id, strftime(f, '%Y-%m-%d') AS first_observed, movement FROM mm")
def w03(spark, sf):
    t = tagged(spark, sf)
    m = L.signal_movement(t, L.snapshots(t, "direction_id", demo.AS_OF, [0]), "direction_id", demo.AS_OF)
    return m.drop("last_observed").withColumn("first_observed", F.date_format("first_observed", "yyyy-MM-dd"))


@query("w04_lifecycle_history", f"WITH {EVC_SQL}, {DI_SQL}, {SNAP_SQL} SELECT direction_id, weeks_ago, stage, evidence_count, source_count, family_count, lag(stage, 2) OVER (PARTITION BY direction_id ORDER BY weeks_ago DESC) AS previous_stage FROM sg")
def w04(spark, sf):
    weeks = list(range(8))
    from signalloom.session import small_table
    keys = small_table(spark, [(d["id"],) for d in stages.DIRECTIONS], "direction_id string")
    h = L.history(L.snapshots(tagged(spark, sf), "direction_id", demo.AS_OF, weeks), keys, "direction_id", weeks)
    return h.select("direction_id", "weeks_ago", "stage", "evidence_count", "source_count", "family_count", "previous_stage")


@query("w05_first_last", f"WITH {LI_SQL} SELECT theme_id, arg_min(id, (ts, id)) AS first_id, arg_max(id, (ts, id)) AS last_id FROM li GROUP BY 1")
def w05(spark, sf):
    r = F.struct("ts", "id")
    g = volume(spark, sf).groupBy("theme_id").agg(F.min(r).alias("f"), F.max(r).alias("l"))
    return g.select("theme_id", F.col("f.id").alias("first_id"), F.col("l.id").alias("last_id"))


@query("w06_diverse_citations", f"""WITH {LI_SQL}, {FAM_SQL}, x AS (SELECT theme_id, id, coalesce(family, li.channel) AS family, publisher_id, strftime(ts, '%Y-%m-%d') AS d FROM li LEFT JOIN fam USING (channel) WHERE ts > {V_SQL} - INTERVAL 90 DAY AND ts <= {V_SQL}),
y AS (SELECT *, row_number() OVER (PARTITION BY theme_id, family ORDER BY d DESC, id DESC) AS rf, row_number() OVER (PARTITION BY theme_id, publisher_id ORDER BY d DESC, id DESC) AS rp FROM x)
SELECT theme_id, id, row_number() OVER (PARTITION BY theme_id ORDER BY (rf > 1 AND rp > 1), d DESC, id DESC) AS pick FROM y QUALIFY pick <= 8""")
def w06(spark, sf):
    v = volume(spark, sf).withColumn("family", L.family(F.col("channel"))).withColumn("published_at", F.date_format("ts", "yyyy-MM-dd"))
    return L.citations(v, "theme_id", VOLUME_AS_OF).select("theme_id", "id", "pick")


@query("w07_one_per_source", f"""WITH {LI_SQL}, y AS (SELECT *, row_number() OVER (PARTITION BY theme_id, source_id ORDER BY ts DESC, id DESC) AS rs FROM li)
SELECT theme_id, id, row_number() OVER (PARTITION BY theme_id ORDER BY rs > 1, ts DESC, id DESC) AS pick FROM y QUALIFY pick <= 5""")
def w07(spark, sf):
    return R.diverse_pick(volume(spark, sf), ["theme_id"], ["source_id"], [F.desc("ts"), F.desc("id")], 5).select("theme_id", "id", "pick")


W8_SQL = f"""x AS (SELECT li.*, 'org' || (substr(source_id, 4)::INT // 2) AS org FROM li),
a AS (SELECT *, row_number() OVER (PARTITION BY theme_id, source_id ORDER BY ts DESC, id) AS rs FROM x), k AS (SELECT *, row_number() OVER (PARTITION BY theme_id, org ORDER BY ts DESC, id) AS rp FROM a WHERE rs <= 2),
kept AS (SELECT * FROM k WHERE rp <= 2)"""


@query("w08_contribution_caps", f"""WITH {LI_SQL}, {W8_SQL}, e AS (SELECT a.id, count_if(kept.source_id = a.source_id) AS s, count(kept.id) AS p FROM a LEFT JOIN kept ON kept.theme_id = a.theme_id AND kept.org = a.org AND (kept.ts > a.ts OR (kept.ts = a.ts AND kept.id < a.id))
   WHERE a.id NOT IN (SELECT id FROM kept) GROUP BY a.id)
SELECT CASE WHEN s >= 2 AND p >= 2 THEN 'source-cap,publisher-cap' WHEN s >= 2 THEN 'source-cap' WHEN p >= 2 THEN 'publisher-cap' END AS reasons, count(*) AS records, min(id) AS first_id FROM e GROUP BY 1
UNION ALL SELECT 'kept', count(*), min(id) FROM kept""")
def w08(spark, sf):
    v = volume(spark, sf).select("id", "theme_id", "source_id", F.concat(F.lit("org"), F.expr("cast(substring(source_id, 4) as int) div 2")).alias("org"), "ts")
    kept = cut_lineage(R.contribution_caps(v, ["theme_id"], "source_id", "org", [F.desc("ts"), F.col("id")]), "kept")
    rank = F.struct((-F.unix_micros("ts")).alias("t"), F.col("id").alias("i"))
    out = R.cap_exclusions(v, kept, ["theme_id"], "source_id", "org", "id", rank)
    rows = out.select("id", F.array_join("reason_codes", ",").alias("reasons")).unionByName(kept.select("id", F.lit("kept").alias("reasons")))
    return rows.groupBy("reasons").agg(F.count("*").alias("records"), F.min("id").alias("first_id"))


REPO_SQL = f"""nm AS (SELECT DISTINCT name, ev.id FROM proj, ev WHERE official = curl OR contains(ftitle, lower(name)) OR contains(array_to_string(projects, ' '), lower(name))),
rp AS (SELECT cl.id, coalesce(projects[1], title) AS name, theme_ids, ts, source_id, cl.curl FROM cl WHERE source_type = 'repository' AND id NOT IN (SELECT id FROM nm)),
rr AS (SELECT rp.id, count(DISTINCT c.source_id) AS ns FROM rp JOIN ev c ON c.id = rp.id OR c.curl = rp.curl OR list_contains(c.projects, rp.name) GROUP BY 1),
fd AS (SELECT name, theme_ids, ts, ns > 1 AS cross_source, least(100, 20 * len(theme_ids) + CASE WHEN ns > 1 THEN 25 ELSE 0 END + CASE WHEN age <= 30 THEN 20 WHEN age <= 90 THEN 10 ELSE 0 END) AS review_priority
  FROM (SELECT rp.*, ns, floor(epoch({_T} - ts) / 86400) AS age, row_number() OVER (PARTITION BY name ORDER BY ts DESC, rp.id) AS rn FROM rp JOIN rr USING (id)) WHERE rn = 1)"""


def reviewed(spark, sf):
    return projects(spark, sf).withColumn("opportunity_score", F.length("name") * 7)


def catalog(spark, sf):
    return marts.project_catalog(classified(spark, sf), reviewed(spark, sf), demo.AS_OF)


@query("m03_project_catalog", f"""WITH {EVC_SQL}, {PROJ_SQL}, {REPO_SQL}, th AS (SELECT name, string_agg(DISTINCT t, ',' ORDER BY t) AS theme_ids FROM nm JOIN cl USING (id), unnest(theme_ids) u(t) GROUP BY 1),
rc AS (SELECT name, count(*) AS related_count FROM nm GROUP BY 1)
SELECT name, 'reviewed' AS review_status, coalesce(theme_ids, '') AS theme_ids, coalesce(related_count, 0) AS related_count, length(name) * 7 AS review_priority FROM proj LEFT JOIN th USING (name) LEFT JOIN rc USING (name)
UNION ALL SELECT name, 'discovered', array_to_string(theme_ids, ','), NULL, review_priority FROM fd""")
def m03(spark, sf):
    return catalog(spark, sf).select("name", "review_status", F.array_join("theme_ids", ",").alias("theme_ids"),
                                     F.when(F.col("review_status") == "reviewed", F.col("related_count")).alias("related_count"), "review_priority")


W9_SQL = """rk AS (SELECT name, array_to_string(theme_ids, ',') AS sig, review_priority, ts FROM fd WHERE len(theme_ids) > 0),
rs AS (SELECT *, row_number() OVER (PARTITION BY sig ORDER BY review_priority DESC, ts DESC, name) AS rn FROM rk),
q1 AS (SELECT name, 0 AS late, review_priority, ts FROM rs WHERE rn <= 3 ORDER BY review_priority DESC, ts DESC, name LIMIT 25),
q AS (SELECT name, row_number() OVER (ORDER BY late, review_priority DESC, ts DESC, name) AS queue_rank FROM (SELECT * FROM q1 UNION ALL SELECT name, 1, review_priority, ts FROM rk WHERE name NOT IN (SELECT name FROM q1)) QUALIFY queue_rank <= 25)"""


@query("w09_review_queue", f"WITH {EVC_SQL}, {PROJ_SQL}, {REPO_SQL}, {W9_SQL} SELECT name, queue_rank FROM q")
def w09(spark, sf):
    return marts.review_queue(catalog(spark, sf)).filter("queue_rank is not null").select("name", "queue_rank")


@query("f17_project_search", f"WITH {EVC_SQL}, {PROJ_SQL}, {REPO_SQL} SELECT name, review_priority FROM fd WHERE contains(lower(name), 'th') AND cross_source")
def f17(spark, sf):
    return marts.search_projects(catalog(spark, sf), "TH", status="discovered", cross_source=True).select("name", "review_priority")


@query("a11_engineering_concepts", f"""WITH {EVC_SQL}, {PROJ_SQL}, {REPO_SQL}, {W9_SQL}, th AS (SELECT name, list(DISTINCT t) AS theme_ids FROM nm JOIN cl USING (id), unnest(theme_ids) u(t) GROUP BY 1),
al AS (SELECT name, theme_ids, 0 AS st, length(name) * 7 AS pr FROM proj JOIN th USING (name) UNION ALL SELECT fd.name, theme_ids, CASE WHEN q.name IS NOT NULL THEN 1 ELSE 2 END, review_priority FROM fd LEFT JOIN q ON q.name = fd.name),
ex AS (SELECT t AS theme_id, name, st, pr, row_number() OVER (PARTITION BY t ORDER BY st, pr DESC NULLS LAST, name) AS rn FROM al, unnest(theme_ids) u(t))
SELECT theme_id, count(*) AS project_count, count_if(st = 0) AS reviewed_project_count, count_if(st = 1) AS queued_project_count, string_agg(name, ',' ORDER BY rn) FILTER (WHERE rn <= 8) AS project_names FROM ex GROUP BY 1""")
def a11(spark, sf):
    return marts.engineering_concepts(marts.review_queue(catalog(spark, sf))).withColumn("project_names", F.array_join("project_names", ","))


@query("w14_project_order", """SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_name, p_partkey) AS rank FROM part""")
def w14(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return R.global_rank(p, [F.desc("p_retailprice"), F.col("p_name"), F.col("p_partkey")]).select("p_partkey", "rank")


@query("a14_checkpoints", f"""WITH {EV_SQL}, {EVD_SQL}, {J4_SQL}, {J5_SQL},
r AS (SELECT ev2.id, event_id, source_id, ts, CASE WHEN len(arts) > 0 THEN arts[1] ELSE curl END AS key, CASE WHEN source_type IN ('event-paper','repository') THEN 4 WHEN len(arts) > 0 THEN 2 ELSE 0 END AS strength FROM e2 ev2, unnest(event_ids) u(event_id)),
w AS (SELECT evd.id AS event_id, e AS fin, source_ids AS official, d AS days, e + to_days(d) AS due FROM evd, unnest(wins) u(d)),
l AS (SELECT w.event_id, days, key, arg_max(source_id, (strength, r.id)) AS source_id FROM r JOIN w USING (event_id) WHERE ts > fin AND ts <= due AND NOT list_contains(official, source_id)
   AND NOT EXISTS (SELECT 1 FROM r b WHERE b.event_id = r.event_id AND b.key = r.key AND b.ts <= fin) GROUP BY 1, 2, 3),
n AS (SELECT event_id, days, count(*) AS n, count(DISTINCT source_id) AS s FROM l GROUP BY 1, 2), it AS (SELECT event_id, count(*) AS items FROM r GROUP BY 1)
SELECT w.event_id, w.days, strftime(due, '%Y-%m-%d') AS due_at, CASE WHEN items IS NULL OR {_T} < due THEN 0 ELSE coalesce(n, 0) END AS evidence_count, CASE WHEN items IS NULL OR {_T} < due THEN 0 ELSE coalesce(s, 0) END AS source_count,
  CASE WHEN items IS NULL THEN 'not-assessed' WHEN {_T} < due THEN 'pending' WHEN coalesce(n, 0) = 0 THEN 'not-observed' WHEN n >= 3 AND s >= 2 THEN 'confirmed' ELSE 'limited' END AS status
FROM w LEFT JOIN it USING (event_id) LEFT JOIN n USING (event_id, days)""")
def a14(spark, sf):
    return P.checkpoints(pulse_rows(spark, sf), demo.events_dim(spark), demo.AS_OF)


def linked_evidence(spark, sf):
    return V.attach_by_artifact(V.attach_events(classified(spark, sf), event_rules()), event_rules())


def pulse_rows(spark, sf):
    return P.linked(linked_evidence(spark, sf), demo.sources(spark))


PULSE_SQL = f"""r0 AS (SELECT e2.id, event_id, e2.source_id, e2.source_type, ts, CASE WHEN len(arts) > 0 THEN arts[1] ELSE curl END AS key, len(arts) > 0 OR source_type = 'repository' AS art,
  CASE WHEN source_type = 'repository' THEN 4 WHEN len(arts) > 0 THEN 2 ELSE 0 END AS st, CASE WHEN source_type = 'repository' THEN 1.0 WHEN len(arts) > 0 THEN 0.35 ELSE 0 END AS aw,
  CASE WHEN source_type = 'repository' THEN 1.0 WHEN source_type IN ('paper','paper-curation','first-party-lab') THEN 0.75 ELSE 0 END AS tw FROM e2, unnest(event_ids) u(event_id)),
ob AS (SELECT * FROM r0 QUALIFY row_number() OVER (PARTITION BY event_id, key ORDER BY st DESC, id DESC) = 1),
ar AS (SELECT * FROM r0 WHERE art QUALIFY row_number() OVER (PARTITION BY event_id, key ORDER BY st DESC, id DESC) = 1)"""


@query("a12_event_attention", f"""WITH {EV_SQL}, {EVD_SQL}, {J4_SQL}, {J5_SQL}, {PULSE_SQL},
w AS (SELECT event_id, count(*) AS n, count(DISTINCT source_id) AS s FROM r0 GROUP BY 1), o AS (SELECT event_id, count(*) AS k, count(DISTINCT source_id) AS os, count(DISTINCT source_type) AS fs, count_if(tw > 0) AS t, avg(tw) AS ts FROM ob GROUP BY 1),
a AS (SELECT event_id, count(*) AS c, sum(aw) AS aw FROM ar GROUP BY 1)
SELECT evd.id AS event_id, CASE WHEN n > 0 THEN 'active' ELSE 'configured' END AS analysis_status, coalesce(n, 0) AS evidence_count, coalesce(w.s, 0) AS source_count, coalesce(k, 0) AS independent_observation_count, coalesce(n - k, 0) AS echo_records_collapsed,
  coalesce(c, 0) AS artifact_count, round_even(coalesce(aw, 0)::DOUBLE, 1) AS weighted_artifact_count, coalesce(t, 0) AS technical_record_count, coalesce(k - t, 0) AS narrative_record_count, coalesce(os, 0) AS independent_source_count, coalesce(fs, 0) AS source_family_count
FROM evd LEFT JOIN w ON w.event_id = evd.id LEFT JOIN o ON o.event_id = evd.id LEFT JOIN a ON a.event_id = evd.id""")
def a12(spark, sf):
    d = marts.event_pulse(linked_evidence(spark, sf), demo.sources(spark), demo.events_dim(spark), demo.AS_OF)
    return d.select("event_id", "analysis_status", "evidence_count", "source_count", "independent_observation_count", "echo_records_collapsed", "artifact_count",
                    "weighted_artifact_count", "technical_record_count", "narrative_record_count", "independent_source_count", "source_family_count")


@query("m04_event_pulse", f"""WITH {EV_SQL}, {EVD_SQL}, {J4_SQL}, {J5_SQL}, {PULSE_SQL},
fo AS (SELECT w.id AS event_id, d AS days, count(DISTINCT key) AS n FROM r0 JOIN evd w ON w.id = event_id, unnest(wins) u(d) WHERE ts > e AND ts <= e + to_days(d) AND {_T} >= e + to_days(d) AND NOT list_contains(w.source_ids, r0.source_id)
  AND NOT EXISTS (SELECT 1 FROM r0 b WHERE b.event_id = r0.event_id AND b.key = r0.key AND b.ts <= e) GROUP BY 1, 2),
f AS (SELECT event_id, max(n) AS f FROM fo GROUP BY 1), o AS (SELECT event_id, count(*) AS k, count(DISTINCT source_id) AS os, count(DISTINCT source_type) AS fs, avg(tw) AS ts FROM ob GROUP BY 1),
a AS (SELECT event_id, sum(aw) AS aw, count(DISTINCT CASE WHEN source_type = 'repository' THEN 'r' ELSE 'l' END) AS ks FROM ar GROUP BY 1),
z AS (SELECT evd.id, name, CASE WHEN k > 0 THEN least(35, round_even(12 * ln(1 + k), 0)) + least(25, os * 8) + least(20, fs * 5) + least(20, coalesce(f, 0) * 5) END AS attention,
  CASE WHEN k > 0 THEN least(35, round_even(12 * ln(1 + coalesce(aw, 0)), 0)) + round_even(25 * ts, 0) + least(20, coalesce(ks, 0) * 10) + least(20, coalesce(f, 0) * 5) END AS substance FROM evd LEFT JOIN o ON o.event_id = evd.id LEFT JOIN a ON a.event_id = evd.id LEFT JOIN f ON f.event_id = evd.id)
SELECT id AS event_id, attention::BIGINT AS attention, substance::BIGINT AS substance, CASE WHEN attention IS NULL THEN 'not-assessed' WHEN attention >= 80 THEN 'very-high' WHEN attention >= 60 THEN 'high' WHEN attention >= 40 THEN 'moderate' ELSE 'limited' END AS attention_label,
  row_number() OVER (ORDER BY attention IS NULL, coalesce(attention, -1) DESC, name) AS rank FROM z""")
def m04(spark, sf):
    d = marts.event_pulse(linked_evidence(spark, sf), demo.sources(spark), demo.events_dim(spark), demo.AS_OF)
    out = R.global_rank(d, P.dossier_order())
    return out.select("event_id", F.col("attention").cast("long").alias("attention"), F.col("substance").cast("long").alias("substance"), "attention_label", "rank")


@query("w13_event_top_themes", f"""WITH {EVC_SQL}, {EVD_SQL}, {J4_SQL}, {J5_SQL}, {PULSE_SQL}
SELECT event_id, theme_id, count(*) AS evidence_count, row_number() OVER (PARTITION BY event_id ORDER BY count(*) DESC, theme_id) AS rn FROM ob JOIN cl USING (id), unnest(theme_ids) u(theme_id) GROUP BY 1, 2 QUALIFY rn <= 8""")
def w13(spark, sf):
    return P.top_themes(pulse_rows(spark, sf))


@query("a16_candidate_metrics", f"""SELECT o_custkey AS candidate_id, count(*) AS evidence_count, count(DISTINCT o_orderpriority) AS source_count, count_if(o_orderdate > {V_SQL} - INTERVAL 7 DAY AND o_orderdate <= {V_SQL}) AS recent_evidence_count, count_if(o_orderstatus = 'F') AS technical_record_count
FROM orders GROUP BY 1""")
def a16(spark, sf):
    o = table(spark, sf, "orders")
    e = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("source_id"), F.col("o_orderstatus").alias("source_type"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    links = o.select(F.col("o_custkey").alias("candidate_id"), F.col("o_orderkey").alias("id"))
    return S.candidate_metrics(links, e, VOLUME_AS_OF, ["F"]).drop("source_types")


@query("a17_priority", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 22 WHEN 'O' THEN 8 ELSE 8 END + least(25, (o_custkey % 9) * 3 + (o_custkey % 4) * 2) + least(20, (o_custkey % 11) * 3) + least(20, (o_custkey % 7) * 4) + CASE WHEN o_custkey % 2 = 0 THEN 10 ELSE 0 END AS priority FROM orders""")
def a17(spark, sf):
    o = table(spark, sf, "orders")
    mv = F.when(F.col("o_orderstatus") == "F", "rising").when(F.col("o_orderstatus") == "O", "steady").otherwise("other")
    k = F.col("o_custkey")
    return o.select("o_orderkey", S.priority(S.lookup(C.MOVEMENT_POINTS, mv, 8), k % 9, k % 4, k % 11, k % 7, k % 2 == 0).alias("priority"))


@query("a18_review_priority", f"""SELECT o_orderkey, least(100, 20 * (o_custkey % 5) + CASE WHEN o_custkey % 3 = 0 THEN 25 ELSE 0 END + CASE WHEN a <= 30 THEN 20 WHEN a <= 90 THEN 10 ELSE 0 END) AS priority FROM (SELECT *, floor(epoch({V_SQL} - o_orderdate) / 86400) AS a FROM orders)""")
def a18(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", S.review_priority(F.col("o_custkey") % 5, F.col("o_custkey") % 3 == 0, F.col("o_orderdate").cast("timestamp"), VOLUME_AS_OF).alias("priority"))


TRENDS = {"rings": r"\bring\b", "widgets": r"\bwidget\b", "bolts": r"bolt|gear", "reds": "^red"}
_MF = ", ".join(f"count_if(month = '{m}') AS m{i}" for i, m in enumerate(VMONTHS))


@query("a19_corpus_trends", rf"""WITH x AS (SELECT p_name AS s, strftime(l_shipdate, '%Y-%m') AS month, 'p' || p_brand AS e FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R'),
h AS (SELECT name, month, e FROM x, unnest([{', '.join(f"CASE WHEN regexp_matches(s, '(?i){p}') THEN '{n}' END" for n, p in TRENDS.items())}]) u(name) WHERE name IS NOT NULL),
g AS (SELECT name, count(*) AS m, count(DISTINCT e) AS b, {_MF} FROM h GROUP BY 1),
c AS (SELECT name, m AS mentions, b AS breadth_count, floor(25 * ln(1 + m) / ln(1 + max(m) OVER ()) + 0.5) AS r, floor(least(25, greatest(0, 12.5 + 10 * log2(((m4 + m5) / 2 + 1) / ((m0 + m1 + m2 + m3) / 4 + 1)))) + 0.5) AS a,
  floor(25 * ((m0>0)::INT + (m1>0)::INT + (m2>0)::INT + (m3>0)::INT + (m4>0)::INT + (m5>0)::INT) / 6 + 0.5) AS p, floor(25 * ln(1 + b) / ln(1 + max(b) OVER ()) + 0.5) AS w FROM g)
SELECT name, mentions, breadth_count, (r + a + p + w)::BIGINT AS total, CASE WHEN r + a + p + w >= 80 THEN 'Structural' WHEN r + a + p + w >= 65 THEN 'Strong' WHEN r + a + p + w >= 50 THEN 'Emerging' ELSE 'Niche / uncertain' END AS tier FROM c""")
def a19(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = li.select(F.col("p_name").alias("statement"), F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.concat(F.lit("p"), "p_brand").alias("entity"), (F.col("l_returnflag") == "R").alias("sponsored"))
    return S.corpus_trends(rows, TRENDS, VMONTHS).select("name", "mentions", "breadth_count", "total", "tier")


@query("a20_opportunity", """WITH x AS (SELECT p_partkey, [p_partkey % 5 + 1, p_size % 5 + 1, (p_partkey // 5) % 5 + 1, (p_size // 5) % 5 + 1, (p_partkey // 25) % 5 + 1, p_partkey % 3 + 1] AS r FROM part),
s AS (SELECT p_partkey, floor((r[1] * 25 + r[2] * 15 + r[3] * 20 + r[4] * 15 + r[5] * 15 + r[6] * 10) / 5 + 0.5)::BIGINT AS score FROM x)
SELECT p_partkey, score, CASE WHEN score >= 85 THEN 'Test now' WHEN score >= 75 THEN 'Pilot / watch' WHEN score >= 65 THEN 'Selective' ELSE 'Research only' END AS action FROM s""")
def a20(spark, sf):
    p = table(spark, sf, "part")
    r = F.array(*[F.expr(x).cast("double") for x in ("p_partkey % 5 + 1", "p_size % 5 + 1", "(p_partkey div 5) % 5 + 1", "(p_size div 5) % 5 + 1", "(p_partkey div 25) % 5 + 1", "p_partkey % 3 + 1")])
    s = p.select("p_partkey", S.opportunity(r).alias("score"))
    return s.withColumn("action", S.opportunity_action(F.col("score")))


FAMILIES = ["public-collection", "events", "verification"]


def receipts(spark, sf):
    """Receipts per day and family from the event stream: a source with an error event failed that day."""
    e = table(spark, sf, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    fam = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), (F.col("user_id") % 3 + 1).cast("int"))
    per = e.groupBy(day.alias("snapshot"), fam.alias("family"), F.concat(F.lit("u"), "user_id").alias("source_id")).agg(
        F.count("*").cast("int").alias("items"), F.max(F.col("event_type") == "error").alias("bad"))
    c = F.struct("source_id", F.when(F.col("bad"), "failed").otherwise("healthy").alias("status"), "items", F.when(F.col("bad"), "boom: it broke").alias("error"))
    err = F.when(F.col("bad"), F.concat(F.col("source_id"), F.lit(": boom: it broke")))
    new = per.filter("family <> 'verification'").groupBy("family", "snapshot").agg(F.collect_list(c).alias("collectors"))
    old = per.filter("family = 'verification'").groupBy("family", "snapshot").agg(F.collect_list(err).alias("errors"))
    kind = "array<struct<source_id:string,status:string,items:int,error:string>>"
    new = new.select("family", "snapshot", F.col("collectors").cast(kind).alias("collectors"), F.array().cast("array<string>").alias("errors"))
    old = old.select("family", "snapshot", F.lit(None).cast(kind).alias("collectors"), "errors")
    return new.unionByName(old).withColumn("collected_at", F.concat("snapshot", F.lit("T06:00:00Z"))), per


def health_parts(spark, sf):
    rec, per = receipts(spark, sf)
    latest = S.newest_receipts(rec)
    counts = per.join(latest.select("family", "snapshot"), ["family", "snapshot"], "left_semi").select("family", "source_id", F.col("items").alias("n"))
    return latest, S.receipt_states(latest, counts)


HEALTH_SQL = f"""p AS (SELECT strftime(ts, '%Y-%m-%d') AS snapshot, {demo._q(FAMILIES)}[(user_id % 3 + 1)::INT] AS family, 'u' || user_id AS source_id, count(*) AS items, bool_or(event_type = 'error') AS bad FROM events GROUP BY 1, 2, 3),
l AS (SELECT family, max(snapshot) AS snapshot FROM p GROUP BY 1), s AS (SELECT p.* FROM p JOIN l USING (family, snapshot))"""


@query("a23_run_health", f"""WITH {HEALTH_SQL} SELECT family, snapshot || 'T06:00:00Z' AS collected_at, count(*) AS source_count, count_if(bad) AS failed_source_count, coalesce(string_agg(source_id, ',' ORDER BY source_id) FILTER (WHERE bad), '') AS failed_source_ids,
  CASE WHEN count_if(bad) > 0 THEN 'degraded' ELSE 'healthy' END AS status FROM s GROUP BY 1, 2""")
def a23(spark, sf):
    latest, states = health_parts(spark, sf)
    return S.run_health(latest, states).withColumn("failed_source_ids", F.array_join("failed_source_ids", ","))


@query("a23_failed_sources", f"WITH {HEALTH_SQL} SELECT family, source_id, 'boom: it broke' AS error FROM s WHERE bad")
def a23_failed(spark, sf):
    return S.failed_sources(health_parts(spark, sf)[1])


@query("j12_source_health", f"""WITH {HEALTH_SQL}, cf AS (SELECT 'u' || n AS id, CASE WHEN n % 5 = 4 THEN 'manual' ELSE 'feed' END AS collection FROM (SELECT DISTINCT user_id AS n FROM events) UNION ALL SELECT 'x' || c_custkey, CASE WHEN c_nationkey = 1 THEN 'manual' END FROM customer)
SELECT cf.id AS source_id, CASE WHEN s.source_id IS NOT NULL THEN CASE WHEN bad THEN 'failed' ELSE 'healthy' END WHEN collection IS NULL OR collection = 'manual' THEN 'not-automated' ELSE 'no-run-receipt' END AS status, coalesce(items, 0) AS items, CASE WHEN bad THEN 'boom: it broke' END AS error, family AS run_id
FROM cf LEFT JOIN s ON s.source_id = cf.id""")
def j12(spark, sf):
    _, states = health_parts(spark, sf)
    users = table(spark, sf, "events").select("user_id").distinct().select(F.concat(F.lit("u"), "user_id").alias("id"), F.when(F.col("user_id") % 5 == 4, "manual").otherwise("feed").alias("collection"))
    cust = table(spark, sf, "customer").select(F.concat(F.lit("x"), "c_custkey").alias("id"), F.when(F.col("c_nationkey") == 1, "manual").alias("collection"))
    return S.source_health(states, users.unionByName(cust), FAMILIES).drop("collected_at")


PREV_SQL = "TIMESTAMP '2024-05-01 00:00:00'"


@query("a26_verification_coverage", f"""WITH {EV_SQL}, m AS (SELECT ev.id, source_id, published_at, ts, unnest(list_filter([CASE WHEN source_type IN ('company-directory') THEN 'formation' END,
  CASE WHEN source_type IN ('first-party-lab','practitioner-blog') AND (contains({_LOW},'theaeati') OR contains({_LOW},'oument')) THEN 'architecture' END, CASE WHEN source_id IN ('src1','src15') AND source_type = 'repository' THEN 'adoption' END], lambda x: x IS NOT NULL)) AS family FROM ev)
SELECT family, 'active' AS status, count(*) AS record_count, count(DISTINCT source_id) AS source_count, count_if(ts > {PREV_SQL}) AS new_record_count, (list(id ORDER BY published_at DESC, id DESC))[1] AS newest FROM m GROUP BY 1""")
def a26(spark, sf):
    e = classified(spark, sf)
    prev = marts.verification_hits(e.filter(F.col("ts") <= F.lit("2024-05-01T00:00:00Z").cast("timestamp")), VERIFICATION_RULES).select("family", "id")
    c = marts.verification_coverage(e, VERIFICATION_RULES, prev)
    return c.select("family", "status", "record_count", "source_count", "new_record_count", F.get("sample_ids", F.lit(0)).alias("newest"))


@query("a27_source_inventory", f"""WITH {EV_SQL} SELECT channel, count(DISTINCT src.id) AS sources, count(ev.id) AS records, list_position({CH_SQL}, channel) AS position FROM src LEFT JOIN ev ON ev.source_id = src.id GROUP BY 1""")
def a27(spark, sf):
    n = evidence(spark, sf).groupBy("source_id").agg(F.count("*").alias("n"))
    s = demo.sources(spark).join(n, F.col("id") == F.col("source_id"), "left").fillna({"n": 0})
    out = s.groupBy("channel").agg(F.count_distinct("id").alias("sources"), F.sum("n").alias("records"))
    return out.withColumn("position", F.array_position(F.array(*[F.lit(c) for c in demo.CHANNELS]), F.col("channel")))


@query("a28_state_counts", f"WITH {LI_SQL}, {score_sql('li', VMONTHS)} SELECT maturity, count(*) AS themes FROM sm GROUP BY 1")
def a28(spark, sf):
    return S.cross_source_scores(volume(spark, sf), VOLUME_AS_OF).groupBy("maturity").agg(F.count("*").alias("themes"))


@query("a29_audit_sample", f"""WITH {EVC_SQL}, b AS (SELECT id, source_id FROM cl WHERE disposition = 'classification-review'), n AS (SELECT source_id, count(*) AS n FROM b GROUP BY 1),
q AS (SELECT source_id, 1 + floor(greatest(0, 120 - count(*) OVER ()) * n / sum(n) OVER ()) AS quota FROM n)
SELECT id, b.source_id FROM b JOIN q USING (source_id) QUALIFY row_number() OVER (PARTITION BY b.source_id ORDER BY sha256(id), id) <= quota""")
def a29(spark, sf):
    waiting = classified(spark, sf).filter(F.col("disposition") == "classification-review").select("id", "source_id")
    return S.audit_sample(waiting, 120).select("id", "source_id")


BACKLOG = {"anea": ["anea", "ther"], "ment": ["ment", "que"], "erin": ["erin"], "heit": ["heit", "keit", "und"], "none": ["zzqx"], "the": ["the"]}
_WAIT_SQL = f"""w AS (SELECT cl.id, coalesce(s.publisher_id, cl.source_id) AS pub, cl.source_type AS fam, ts, unnest(list_filter([{",".join(f"CASE WHEN regexp_matches(hay, '{demo.term_sql(t)}') THEN '{k}' END" for k, t in BACKLOG.items())}],
  lambda x: x IS NOT NULL)) AS c FROM cl LEFT JOIN src s ON s.id = cl.source_id WHERE disposition = 'classification-review')"""


def backlog(spark, sf):
    rows = classified(spark, sf).filter(F.col("disposition") == "classification-review")
    dim = demo.sources(spark).select(F.col("id").alias("source_id"), "publisher_id")
    rows = rows.withColumn("hay", K.haystack(rows)).join(dim, "source_id", "left")
    rows = rows.select("id", F.coalesce("publisher_id", "source_id").alias("publisher_id"), F.col("source_type").alias("family"), "hay", "ts")
    return S.ranked_backlog(rows, BACKLOG, demo.AS_OF, 25, 12)


@query("a29_ranked_backlog", f"""WITH {EVC_SQL}, {_WAIT_SQL} SELECT c AS cluster_id, count(*) AS observed_records, least(count(*), 25) AS capped_frequency, count(DISTINCT pub) AS publisher_count, count(DISTINCT fam) AS family_count,
  count_if(ts > {_T} - INTERVAL 7 DAY AND ts <= {_T}) AS recent_records, row_number() OVER (ORDER BY least(count(*), 25) DESC, count(DISTINCT pub) DESC, count(DISTINCT fam) DESC, count_if(ts > {_T} - INTERVAL 7 DAY AND ts <= {_T}) DESC, c) AS rank FROM w GROUP BY 1""")
def a29_ranked(spark, sf):
    return backlog(spark, sf)[0]


@query("a29_inspection_picks", f"""WITH {EVC_SQL}, {_WAIT_SQL}, n AS (SELECT c, pub, count(*) AS n FROM w GROUP BY 1, 2), lv AS (SELECT c, max(l) AS level FROM (SELECT c, l FROM n, range(0, 13) r(l) GROUP BY c, l HAVING sum(least(n, l)) <= 12) GROUP BY 1),
d AS (SELECT n.c, pub, least(n, level) AS take, n > level AS more, 12 - sum(least(n, level)) OVER (PARTITION BY n.c) AS spare FROM n JOIN lv ON lv.c = n.c),
t AS (SELECT c, pub, take + CASE WHEN more AND row_number() OVER (PARTITION BY c, more ORDER BY sha256(pub), pub) <= spare THEN 1 ELSE 0 END AS take FROM d),
p AS (SELECT c, pub, id, row_number() OVER (PARTITION BY c, pub ORDER BY ts DESC, id) AS rn FROM w)
SELECT p.c AS cluster_id, p.pub AS publisher_id, id FROM p JOIN t ON t.c = p.c AND t.pub = p.pub WHERE rn <= take""")
def a29_picks(spark, sf):
    return backlog(spark, sf)[1]


# ---- directions mart --------------------------------------------------------------------------

@query("m05_early_signals", f"""WITH {EVC_SQL}, {DI_SQL}, {SNAP_SQL}, {W3_SQL} SELECT sg.direction_id, sg.stage, sg.evidence_count, sg.source_count, sg.family_count, coalesce(movement, 'steady') AS movement, origin_id,
  (SELECT string_agg(h.stage, ',' ORDER BY h.weeks_ago DESC) FROM sg h WHERE h.direction_id = sg.direction_id) AS lifecycle FROM sg LEFT JOIN mm ON mm.direction_id = sg.direction_id WHERE weeks_ago = 0""")
def m05(spark, sf):
    m = marts.early_signals(directions_rows(spark, sf), stages.DIRECTIONS, demo.AS_OF)
    return m.select("direction_id", "stage", "evidence_count", "source_count", "family_count", "movement", "origin_id", F.array_join("lifecycle", ",").alias("lifecycle"))


@query("w17_direction_order", f"""WITH {EVC_SQL}, {DI_SQL}, {SNAP_SQL}, {W3_SQL}, tt(direction_id, title) AS (VALUES {', '.join(f"('{d['id']}','{d['title']}')" for d in stages.DIRECTIONS)})
SELECT sg.direction_id, row_number() OVER (ORDER BY list_position({demo._q(C.MOVEMENT_ORDER)}, coalesce(movement, 'steady')), list_position({demo._q(C.STAGE_ORDER)}, sg.stage) DESC, sg.family_count DESC, sg.source_count DESC, title) AS rank
FROM sg LEFT JOIN mm ON mm.direction_id = sg.direction_id JOIN tt ON tt.direction_id = sg.direction_id WHERE weeks_ago = 0""")
def w17(spark, sf):
    m = marts.early_signals(directions_rows(spark, sf), stages.DIRECTIONS, demo.AS_OF)
    return R.global_rank(m, L.direction_order(m)).select("direction_id", "rank")


# ---- change -----------------------------------------------------------------------------------

X_NOW, X_BEFORE = f"ts > {_T} - INTERVAL 35 DAY AND ts <= {_T}", f"ts > {_T} - INTERVAL 42 DAY AND ts <= {_T} - INTERVAL 7 DAY"


def two_runs(spark, sf):
    """This week's and last week's 35-day window; labelled records had another summary last week."""
    e = classified(spark, sf).drop("doc_id")
    lab = table(spark, sf, "labels").select(F.concat(F.lit("doc:"), "doc_id").alias("id"), F.lit(True).alias("lab")).distinct()
    now = e.filter(D.in_trailing(F.col("ts"), demo.AS_OF, 35))
    before = e.filter(D.in_trailing(F.col("ts"), demo.AS_OF, 42, 7)).join(lab, "id", "left").withColumn(
        "summary", F.when(F.col("lab"), F.concat(F.lit("old "), "summary")).otherwise(F.col("summary"))).drop("lab")
    return now.withColumn("fingerprint", Q.fingerprint()), before.withColumn("fingerprint", Q.fingerprint())


XR_SQL = f"""n AS (SELECT id FROM ev WHERE {X_NOW}), b AS (SELECT id, doc_id IN (SELECT doc_id FROM labels) AS lab FROM ev WHERE {X_BEFORE})"""


@query("x01_change_types", f"""WITH {EV_SQL}, {XR_SQL} SELECT coalesce(n.id, b.id) AS id, CASE WHEN n.id IS NULL THEN 'removed' WHEN b.id IS NULL THEN 'new-record' WHEN lab THEN 'materially-changed' ELSE 'unchanged' END AS change_type FROM n FULL JOIN b ON n.id = b.id""")
def x01(spark, sf):
    return H.changes(*two_runs(spark, sf))


@query("x03_new_since_previous", f"WITH {EV_SQL}, {XR_SQL} SELECT id FROM n WHERE id NOT IN (SELECT id FROM b)")
def x03(spark, sf):
    now, before = two_runs(spark, sf)
    return H.new_ids(now, before, ["id"]).select("id")


@query("x11_policy_reset", f"""WITH {EV_SQL}, {XR_SQL} SELECT CASE WHEN n.id IS NULL THEN 'removed' WHEN b.id IS NULL THEN 'new-record' ELSE 'materially-changed' END AS change_type, count(*) AS records FROM n FULL JOIN b ON n.id = b.id GROUP BY 1""")
def x11(spark, sf):
    return H.changes(*two_runs(spark, sf), force=True).groupBy("change_type").agg(F.count("*").alias("records"))


@query("f07_with_previous", f"""WITH {EVC_SQL}, {ELIG_SQL}, p AS (SELECT id, doc_id IN (SELECT doc_id FROM labels) AS lab FROM ev WHERE {X_BEFORE})
SELECT CASE WHEN reason IS NOT NULL THEN reason WHEN p.id IS NOT NULL AND NOT lab THEN 'unchanged' WHEN p.id IS NOT NULL THEN 'materially-changed' ELSE 'new-record' END AS outcome, count(*) AS records FROM el LEFT JOIN p ON p.id = el.id GROUP BY 1""")
def f07p(spark, sf):
    _, before = two_runs(spark, sf)
    e = Q.eligibility(classified(spark, sf).drop("doc_id", "ts"), demo.sources(spark), demo.AS_OF, previous=before)
    return e.groupBy(F.coalesce("reason", F.col("change_type")).alias("outcome")).agg(F.count("*").alias("records"))


@query("f07_duplicate_records", f"""WITH {EVC_SQL}, {ELIG_SQL} SELECT coalesce(reason, 'eligible') AS reason, count(*) AS records FROM el GROUP BY 1 UNION ALL SELECT 'duplicate-record', count(*) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)""")
def f07d(spark, sf):
    e = classified(spark, sf).drop("ts").withColumn("seen", F.lit(0))
    again = e.join(table(spark, sf, "labels").select("doc_id"), "doc_id").withColumn("seen", F.lit(1)).select(*e.columns)
    judged = Q.eligibility(e.unionByName(again).drop("doc_id"), demo.sources(spark), demo.AS_OF, order=[F.col("seen")])
    return judged.groupBy(F.coalesce("reason", F.lit("eligible")).alias("reason")).agg(F.count("*").alias("records"))


def _req(cond: str, col: str) -> str:
    return f"SELECT o_custkey AS id, {demo._q(C.MATURITY_ORDER)}[(1 + least(4, count(*) // 4))::INT] AS maturity, count(*) AS n FROM orders WHERE {cond} GROUP BY 1"


def requirements(spark, sf, until):
    o = table(spark, sf, "orders").filter(F.col("o_orderdate") <= F.lit(until).cast("timestamp_ntz"))
    g = o.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("evidence_count"))
    level = F.element_at(F.array(*[F.lit(m) for m in C.MATURITY_ORDER]), (1 + F.least(F.lit(4), F.expr("evidence_count div 4"))).cast("int"))
    return g.withColumn("maturity", level)


@query("x04_requirement_changes", f"""WITH c AS ({_req("o_orderdate <= TIMESTAMP '2001-01-01'", 'n')}), p AS ({_req("o_orderdate <= TIMESTAMP '1999-01-01'", 'n')}),
j AS (SELECT c.id, c.maturity AS cm, p.maturity AS pm, c.n AS cn, p.n AS pn, list_position({demo._q(C.MATURITY_ORDER)}, c.maturity) AS cr, list_position({demo._q(C.MATURITY_ORDER)}, p.maturity) AS pr FROM c LEFT JOIN p ON c.id = p.id)
SELECT id, CASE WHEN pm IS NULL THEN 'added' WHEN cr > pr THEN 'promoted' WHEN cr < pr THEN 'demoted' WHEN cn <> pn THEN 'evidence-updated' ELSE 'unchanged' END AS change_type, pm AS previous_maturity, cm AS current_maturity FROM j""")
def x04(spark, sf):
    return H.requirement_changes(requirements(spark, sf, "2001-01-01"), requirements(spark, sf, "1999-01-01"))


def _cand(v: str) -> str:
    return f"""SELECT o_custkey AS id, count(*) AS ec, count(DISTINCT o_orderpriority) AS sc, count_if(o_orderdate > {v} - INTERVAL 90 DAY) AS rc, max(o_orderstatus) AS stage,
  CASE WHEN count_if(o_orderdate > {v} - INTERVAL 90 DAY) > 0 THEN 'rising' ELSE 'steady' END AS movement FROM orders WHERE o_orderdate <= {v} GROUP BY 1"""


C_NOW, C_BEFORE = "TIMESTAMP '2001-01-01'", "TIMESTAMP '2000-06-01'"


def candidates(spark, sf, until):
    o = table(spark, sf, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp")).filter(F.col("ts") <= F.lit(until).cast("timestamp"))
    recent = F.count_if(D.in_trailing(F.col("ts"), until, 90))
    g = o.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("evidence_count"), F.count_distinct("o_orderpriority").alias("source_count"), recent.alias("recent_count"), F.max("o_orderstatus").alias("stage"))
    return g.withColumn("movement", F.when(F.col("recent_count") > 0, "rising").otherwise("steady")).withColumn("strength", F.lit(None).cast("string"))


def judged_candidates(spark, sf):
    now, before = candidates(spark, sf, "2001-01-01T00:00:00Z"), candidates(spark, sf, "2000-06-01T00:00:00Z")
    p = before.select(*[F.col(c).alias(f"p_{c}") for c in before.columns])
    r = before.filter(F.col("id") % 2 == 0).select(*[F.col(c).alias(f"r_{c}") for c in before.columns])
    j = now.join(p, F.col("id") == F.col("p_id"), "left").join(r, F.col("id") == F.col("r_id"), "left")
    j = j.withColumn("change_reasons", H.material_reasons()).withColumn("adjudication", H.adjudication_status())
    j = j.withColumn("origin", F.element_at(F.array(*[F.lit(o) for o in ("early-signal", "expert-finding", "operator-narrative", "cross-source-theme")]), (F.col("id") % 4 + 1).cast("int")))
    pr = S.priority(S.lookup(C.MOVEMENT_POINTS, F.col("movement"), 8), F.col("source_count"), F.lit(1), F.col("evidence_count"), F.col("recent_count"), F.col("id") % 211 == 0)
    return j.withColumn("priority", pr).withColumn("linked", F.col("id") % 211 == 0).withColumn("title", F.lpad(F.col("id").cast("string"), 9, "0"))


XC_SQL = f"""now AS ({_cand(C_NOW)}), pre AS ({_cand(C_BEFORE)}),
jc AS (SELECT now.*, pre.id AS pid, pre.ec AS pec, pre.sc AS psc, pre.rc AS prc, pre.stage AS pst, pre.movement AS pmv FROM now LEFT JOIN pre ON pre.id = now.id),
rr AS (SELECT *, CASE WHEN pid IS NULL THEN ['new'] ELSE list_filter([CASE WHEN stage <> pst THEN 'stage' END, CASE WHEN movement <> pmv AND movement = 'rising' THEN 'movement' END, CASE WHEN ec - pec >= 2 THEN 'evidence' END,
  CASE WHEN sc - psc >= 1 THEN 'sources' END, CASE WHEN rc - prc > 0 THEN 'recent' END], lambda x: x IS NOT NULL) END AS reasons,
  CASE WHEN pid IS NOT NULL AND pid % 2 = 0 THEN CASE WHEN stage = pst AND ec - pec < 2 AND sc - psc < 1 THEN 'current' ELSE 'revisit-required' END END AS adj,
  ['early-signal','expert-finding','operator-narrative','cross-source-theme'][(id % 4 + 1)::INT] AS origin, id % 211 = 0 AS linked,
  CASE WHEN movement = 'rising' THEN 22 ELSE 8 END + least(25, sc * 3 + 2) + least(20, ec * 3) + least(20, rc * 4) + CASE WHEN id % 211 = 0 THEN 10 ELSE 0 END AS priority FROM jc)"""


@query("x05_material_reasons", f"WITH {XC_SQL} SELECT id, array_to_string(reasons, ',') AS reasons FROM rr")
def x05(spark, sf):
    return judged_candidates(spark, sf).select("id", F.array_join("change_reasons", ",").alias("reasons"))


@query("x06_adjudications", f"WITH {XC_SQL} SELECT id, adj AS adjudication FROM rr WHERE adj IS NOT NULL")
def x06(spark, sf):
    return judged_candidates(spark, sf).filter("adjudication is not null").select("id", "adjudication")


W10_SQL = """ok AS (SELECT *, lpad(id::VARCHAR, 9, '0') AS title FROM rr WHERE len(reasons) > 0 AND coalesce(adj, '') <> 'current' AND (priority >= 45 OR linked)),
lk AS (SELECT origin, count(*) AS used FROM ok WHERE linked GROUP BY 1),
fr AS (SELECT ok.*, row_number() OVER (PARTITION BY ok.origin ORDER BY priority DESC, title) + coalesce(used, 0) AS pos FROM ok LEFT JOIN lk ON lk.origin = ok.origin WHERE NOT linked),
qu AS (SELECT id, row_number() OVER (ORDER BY late, priority DESC, title) AS queue_rank FROM (SELECT id, priority, title, 0 AS late FROM ok WHERE linked UNION ALL SELECT id, priority, title, 1 FROM fr WHERE pos <= 4) QUALIFY queue_rank <= 10)"""


@query("w10_assessment_queue", f"WITH {XC_SQL}, {W10_SQL} SELECT id, queue_rank FROM qu")
def w10(spark, sf):
    return H.assessment_queue(judged_candidates(spark, sf)).select("id", "queue_rank")


@query("x07_carry_over", f"""WITH {XC_SQL}, {W10_SQL}, pq AS (SELECT id, row_number() OVER (ORDER BY priority DESC, id) AS r FROM rr WHERE id % 3 = 0 QUALIFY r <= 6),
h AS (SELECT pq.id, r, 0 AS late FROM pq JOIN rr USING (id) WHERE coalesce(adj, '') <> 'current'), a AS (SELECT * FROM h UNION ALL SELECT id, queue_rank, 1 FROM qu WHERE id NOT IN (SELECT id FROM h))
SELECT id, late = 0 AS carried, row_number() OVER (ORDER BY late, r, id) AS queue_rank FROM a QUALIFY queue_rank <= 10""")
def x07(spark, sf):
    c = judged_candidates(spark, sf)
    prev = R.numbered_top(c.filter(F.col("id") % 3 == 0), [F.desc("priority"), F.col("id")], 6, "queue_rank")
    return H.carry_over(prev, c, H.assessment_queue(c))


@query("x08_regeneration", f"""WITH {EVC_SQL}, a AS (SELECT disposition || '/' || rule_id AS key, count(*) AS n, count(*) FILTER (WHERE source_id <> 'src3') AS m FROM cl GROUP BY 1),
b AS (SELECT t AS key, count(*) AS n, count(*) FILTER (WHERE source_id <> 'src3') AS m FROM cl, unnest(theme_ids) u(t) GROUP BY 1),
s AS (SELECT 'coverage' AS name, bool_or(n <> m) AS moved, count(*) AS n, count(*) FILTER (WHERE m > 0) AS m FROM a UNION ALL SELECT 'themes', bool_or(n <> m), count(*), count(*) FILTER (WHERE m > 0) FROM b UNION ALL SELECT 'sources', false, count(*), count(*) FROM src)
SELECT run, name, CASE WHEN run < 3 OR NOT moved THEN '2024-06-20' ELSE '2024-07-04' END AS generated_at, run = 1 OR (run = 3 AND moved) AS changed, CASE WHEN run < 3 THEN n ELSE m END AS records, CASE WHEN run < 3 THEN 1 ELSE 2 END AS version
FROM s, range(1, 4) r(run)""")
def x08(spark, sf):
    """The same inputs twice, the second time in another order and with other partitions, then an input without one source."""
    root = f"{shared_dir(spark)}/x08-{uuid.uuid4().hex}"
    out = None
    for run, stamp in enumerate(("2024-06-20", "2024-06-27", "2024-07-04"), 1):
        rows = classified(spark, sf)
        rows = rows.repartition(5, "title") if run == 2 else rows.filter("source_id <> 'src3'") if run == 3 else rows
        mart = {"coverage": rows.groupBy(F.concat_ws("/", "disposition", "rule_id").alias("key")).agg(F.count("*").alias("n")),
                "themes": K.by_theme(rows).groupBy(F.col("theme_id").alias("key")).agg(F.count("*").alias("n")), "sources": demo.sources(spark)}
        done = publish.publish(mart, root, stamp)
        part = done.select(F.lit(run).alias("run"), "name", "generated_at", "changed", "records", F.lit(publish.manifest(spark, root)[0]).alias("version"))
        out = part if out is None else out.unionByName(part)
    return out


@query("x08_published_rows", f"""WITH {EVC_SQL} SELECT disposition || '/' || rule_id AS key, count(*) AS n FROM cl GROUP BY 1""")
def x08_rows(spark, sf):
    """What readers find after two runs."""
    root = f"{shared_dir(spark)}/x08-{uuid.uuid4().hex}"
    for rows in (classified(spark, sf).filter("source_id <> 'src3'"), classified(spark, sf)):
        publish.publish({"coverage": rows.groupBy(F.concat_ws("/", "disposition", "rule_id").alias("key")).agg(F.count("*").alias("n"))}, root, "2024-06-20")
    return publish.read_published(spark, root, "coverage")


@query("x09_union_sources", """SELECT kind, count(*) AS records, count(url) AS with_url FROM (SELECT 'doc' AS kind, NULL AS url FROM documents UNION ALL SELECT 'page', url FROM pages UNION ALL SELECT 'talk', NULL FROM conversations) GROUP BY 1""")
def x09(spark, sf):
    d = table(spark, sf, "documents").select(F.lit("doc").alias("kind"), "text")
    p = table(spark, sf, "pages").select(F.lit("page").alias("kind"), "url")
    c = table(spark, sf, "conversations").select(F.lit("talk").alias("kind"), "text")
    u = d.unionByName(p, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)
    return u.groupBy("kind").agg(F.count("*").alias("records"), F.count("url").alias("with_url"))


@query("x10_array_sets", f"""WITH {EVC_SQL} SELECT id, array_to_string(list_sort(list_intersect(theme_ids, ['bonding','harbor','tidal'])), ',') AS both_sets, len(list_filter(theme_ids, lambda t: NOT list_contains(['bonding','harbor','tidal'], t))) AS rest FROM cl""")
def x10(spark, sf):
    mine = F.array(*[F.lit(t) for t in ("bonding", "harbor", "tidal")])
    return classified(spark, sf).select("id", F.array_join(F.array_sort(F.array_intersect("theme_ids", mine)), ",").alias("both_sets"), F.size(F.array_except("theme_ids", mine)).alias("rest"))


# ---- gates ------------------------------------------------------------------------------------

def cases(spark, sf):
    """A case per part. Line items are dealt out by part once; counts of different values mark the first row of each.

    Four rows per line item for distinct counts, grouped before and after the shuffle, spill at larger sizes.
    """
    li = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", F.year("l_shipdate").alias("year"), "l_returnflag").repartition("l_partkey")
    for c in ("year", "l_suppkey", "l_orderkey"):
        li = li.withColumn(f"_{c}", F.col(c).isNotNull() & (F.row_number().over(Window.partitionBy("l_partkey", c).orderBy(c)) == 1))
    per_r = li.groupBy("l_partkey").agg(
        F.count_if("_l_orderkey").alias("ev"), F.count_if(F.col("l_returnflag") == "A").alias("tech"), F.count_if("_l_suppkey").alias("org"),
        F.count_if("_year").alias("cyc"), F.max(F.col("l_returnflag") == "R").alias("counter"))
    lv = F.array(*[F.lit(x) for x in C.LEVELS])
    at = lambda c, m: F.element_at(lv, (F.col(c) % m + 1).cast("int"))
    i = lambda c: F.col(c).cast("int")
    return per_r.select(
        F.col("l_partkey").alias("id"), at("tech", 4).alias("technical_reality"), at("org", 4).alias("operational_adoption"), at("ev", 4).alias("evidence_independence"),
        i("ev").alias("qualifying_events"), i("tech").alias("technical_artifacts"), i("org").alias("independent_organizations"), i("cyc").alias("persistence_cycles"),
        F.col("counter").alias("counterevidence_reviewed"), (F.col("cyc") > 3).alias("cost_of_absence_evidenced"), (F.col("org") > 4).alias("practical_minimum_available"),
        F.when(F.col("tech") > 2, "experimental").otherwise("narrative").alias("expected_maturity"), F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("title"))


GATE_SQL = f"""g AS (SELECT l_partkey AS id, count(DISTINCT l_orderkey) AS ev, count_if(l_returnflag = 'A') AS tech, count(DISTINCT l_suppkey) AS org, count(DISTINCT year(l_shipdate)) AS cyc, bool_or(l_returnflag = 'R') AS cr FROM lineitem GROUP BY 1),
p1 AS (SELECT *, tech % 4 AS tr, org % 4 AS oa, ev % 4 AS ei, ev >= 1 AS a FROM g), p2 AS (SELECT *, a AND tr >= 2 AND tech >= 1 AS b FROM p1), p3 AS (SELECT *, b AND tr >= 2 AND oa >= 2 AND ei >= 2 AND org >= 2 AND cr AS c FROM p2),
p4 AS (SELECT *, c AND tr >= 3 AND oa >= 3 AND ei >= 3 AND org >= 3 AND cyc >= 2 AND cr AS d FROM p3), p5 AS (SELECT *, d AND cyc > 3 AND org > 4 AS e FROM p4),
gm AS (SELECT *, CASE WHEN e THEN 'baseline' WHEN d THEN 'established' WHEN c THEN 'emerging' WHEN b THEN 'experimental' ELSE 'narrative' END AS maturity, CASE WHEN NOT a THEN 'narrative' WHEN NOT b THEN 'experimental' WHEN NOT c THEN 'emerging' WHEN NOT d THEN 'established' WHEN NOT e THEN 'baseline' END AS next_gate FROM p5)"""


@query("r01_maturity_gates", f"WITH {GATE_SQL} SELECT id, maturity, next_gate FROM gm")
def r01(spark, sf):
    return gates.gate_results(cases(spark, sf)).select("id", "maturity", F.col("next_gate.gate").alias("next_gate"))


@query("r02_calibration", f"WITH {GATE_SQL} SELECT maturity, CASE WHEN tech > 2 THEN 'experimental' ELSE 'narrative' END AS expected_maturity, count(*) AS cases FROM gm GROUP BY 1, 2")
def r02(spark, sf):
    return gates.calibration(gates.gate_results(cases(spark, sf))).groupBy("maturity", "expected_maturity").agg(F.count("*").alias("cases"))


@query("r03_operating_model", f"WITH {GATE_SQL}, n AS (SELECT l_partkey AS id, count(*) AS n, min(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' || strftime(l_shipdate, '%Y%m%d')) AS first_id FROM lineitem GROUP BY 1) SELECT gm.id, maturity, n AS linked, first_id FROM gm JOIN n USING (id)")
def r03(spark, sf):
    li = table(spark, sf, "lineitem").select(F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")).alias("id"), "l_partkey", "l_suppkey", "l_orderkey", "l_shipdate")
    links = li.select(F.col("l_partkey").alias("case_id"), F.col("id").alias("evidence_id"), F.col("l_orderkey").alias("event_id"), F.lit("direct-support").alias("relationship"), F.col("id").alias("pos"))
    e = li.select("id", F.lit("t").alias("title"), F.concat(F.lit("sup"), "l_suppkey").alias("source_id"), F.col("l_shipdate").alias("published_at"))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("sup"), "s_suppkey").alias("id"), F.col("s_name").alias("name"))
    reqs, linked = gates.operating_model(gates.gate_results(cases(spark, sf)), links, e, s)
    n = linked.groupBy(F.col("case_id").alias("id")).agg(F.count("*").alias("linked"), F.min("evidence_id").alias("first_id"))
    return reqs.join(n, "id").select("id", "maturity", "linked", "first_id")


_STATES = list(C.STATE_TRANSITIONS)


@query("r04_state_moves", f"""WITH m AS (SELECT {demo._q(_STATES)}[(event_id % 6 + 1)::INT] AS f, {demo._q(_STATES)}[(user_id % 6 + 1)::INT] AS t FROM events)
SELECT f AS from_state, t AS to_state, count(*) AS moves FROM m WHERE NOT CASE f WHEN 'spark' THEN t IN ('candidate','dormant','merged','rejected') WHEN 'candidate' THEN t IN ('spark','approved','dormant','merged','rejected') WHEN 'dormant' THEN t IN ('spark','candidate','rejected') ELSE false END GROUP BY 1, 2""")
def r04(spark, sf):
    states = F.array(*[F.lit(s) for s in _STATES])
    log = table(spark, sf, "events").select(F.element_at(states, (F.col("event_id") % 6 + 1).cast("int")).alias("from_state"),
                                            F.element_at(states, (F.col("user_id") % 6 + 1).cast("int")).alias("to_state"))
    return Q.illegal_moves(log).groupBy("from_state", "to_state").agg(F.count("*").alias("moves"))


FINDINGS = {"weave": ["bonding", "harbor"], "north": ["quarry", "summit"], "south": ["tidal"], "none": ["unseen"]}


@query("r05_findings", f"""WITH {EVC_SQL}, h AS (SELECT source_id, unnest(list_filter([{', '.join(f"CASE WHEN list_has_any(theme_ids, {demo._q(v)}) THEN '{k}' END" for k, v in FINDINGS.items())}], lambda x: x IS NOT NULL)) AS finding_id FROM cl WHERE source_type IN ('expert-social','operator-essay','investor-essay'))
SELECT finding_id, count(*) AS posts, count(DISTINCT source_id) AS publishers, CASE WHEN count(DISTINCT source_id) >= 3 THEN 'strong' WHEN count(DISTINCT source_id) = 2 THEN 'emerging' ELSE 'watch' END AS strength, count(DISTINCT source_id) >= 5 AS complete FROM h GROUP BY 1""")
def r05(spark, sf):
    return gates.findings(classified(spark, sf).filter(F.col("source_type").isin("expert-social", "operator-essay", "investor-essay")), FINDINGS)


# ---- marts ------------------------------------------------------------------------------------

@query("m01_dashboard", f"""WITH {EVC_SQL}, {DR_SQL}, {demo.THEME_SQL}, n AS (SELECT theme_id, count(*) AS c FROM dr GROUP BY 1), l AS (SELECT id FROM cl ORDER BY published_at DESC, id DESC LIMIT 250)
SELECT 'theme' AS kind, thm.id AS key, coalesce(c, 0) AS n FROM thm LEFT JOIN n ON theme_id = thm.id UNION ALL SELECT 'latest', id, 1 FROM l""")
def m01(spark, sf):
    cards, latest = marts.dashboard(classified(spark, sf), demo.themes(spark).select("id", "name"), demo.AS_OF)
    return cards.select(F.lit("theme").alias("kind"), F.col("id").alias("key"), F.col("item_count").alias("n")).unionByName(
        latest.select(F.lit("latest").alias("kind"), F.col("id").alias("key"), F.lit(1).cast("long").alias("n")))


@query("m02_research_sections", f"""WITH {EVC_SQL}, {DR_SQL}, {score_sql('dr', MONTHS)}, {demo.THEME_SQL}, g AS (SELECT source_id, count(*) AS n FROM cl GROUP BY 1)
SELECT 'theme' AS section, thm.id AS key, coalesce(maturity, 'unobserved') AS state, coalesce(evidence_count, 0) AS n FROM thm LEFT JOIN sm ON theme_id = thm.id
UNION ALL SELECT 'source', src.id, CASE WHEN n > 0 THEN 'active' ELSE 'configured' END, coalesce(n, 0) FROM src LEFT JOIN g ON source_id = src.id
UNION ALL SELECT 'verdict', disposition, rule_id, count(*) FROM cl GROUP BY 2, 3 UNION ALL SELECT 'evidence', source_type, max(published_at), count(*) FROM cl GROUP BY 2""")
def m02(spark, sf):
    m = marts.research(classified(spark, sf), demo.themes(spark).select("id", "name"), demo.sources(spark), {t[0]: [t[4], t[5]] for t in demo.THEMES}, demo.AS_OF)
    row = lambda df, section, key, state, n: df.select(F.lit(section).alias("section"), F.col(key).alias("key"), F.col(state).alias("state"), F.col(n).cast("long").alias("n"))
    types = m["evidence"].groupBy("source_type").agg(F.max("published_at").alias("latest"), F.count("*").alias("n"))
    return (row(m["themes"], "theme", "id", "maturity", "evidence_count").unionByName(row(m["sources"], "source", "id", "status", "n"))
            .unionByName(row(m["verdicts"], "verdict", "disposition", "rule_id", "evidence_count")).unionByName(row(types, "evidence", "source_type", "latest", "n")))


@query("m02_research_projects", f"""WITH {EVC_SQL}, {PROJ_SQL}, {REPO_SQL}, {W9_SQL}, th AS (SELECT name, list(DISTINCT t) AS theme_ids FROM nm JOIN cl USING (id), unnest(theme_ids) u(t) GROUP BY 1),
al AS (SELECT name, theme_ids, 0 AS st, length(name) * 7 AS pr FROM proj LEFT JOIN th USING (name) UNION ALL SELECT fd.name, theme_ids, CASE WHEN q.name IS NOT NULL THEN 1 ELSE 2 END, review_priority FROM fd LEFT JOIN q ON q.name = fd.name)
SELECT 'project' AS section, name AS key, ['reviewed','queued','discovered'][st + 1] AS state, pr AS n FROM al UNION ALL SELECT 'concept', t, 'projects', count(*) FROM al, unnest(theme_ids) u(t) GROUP BY 2
UNION ALL SELECT 'concept', t, 'queued', count_if(st = 1) FROM al, unnest(theme_ids) u(t) GROUP BY 2""")
def m02_projects(spark, sf):
    """The project and concept tables of the research mart."""
    m = marts.research(classified(spark, sf), demo.themes(spark).select("id", "name"), demo.sources(spark), {t[0]: [t[4], t[5]] for t in demo.THEMES}, demo.AS_OF, catalog(spark, sf))
    p = m["projects"].select(F.lit("project").alias("section"), F.col("name").alias("key"), F.col("review_status").alias("state"), F.col("review_priority").cast("long").alias("n"))
    c = cut_lineage(m["concepts"], "concepts")
    row = lambda state, n: c.select(F.lit("concept").alias("section"), F.col("theme_id").alias("key"), F.lit(state).alias("state"), F.col(n).cast("long").alias("n"))
    return p.unionByName(row("projects", "project_count")).unionByName(row("queued", "queued_project_count"))


M6_SQL = f"""cand AS (SELECT theme_id AS id, CASE WHEN count_if(ts > {_T} - INTERVAL 7 DAY AND ts <= {_T}) > 0 THEN 'new' ELSE 'steady' END AS movement, count(*) AS ec, count(DISTINCT source_id) AS sc, count(DISTINCT source_type) AS fc,
  count_if(ts > {_T} - INTERVAL 7 DAY AND ts <= {_T}) AS rc, count_if(source_type IN ('paper','repository','first-party-lab','practitioner-blog')) AS tc FROM dr GROUP BY 1)"""


@query("m06_theme_metrics", f"""WITH {EVC_SQL}, {DR_SQL}, {M6_SQL} SELECT id, ec AS evidence_count, sc AS source_count, rc AS recent_evidence_count, tc AS technical_record_count,
  CASE WHEN movement = 'new' THEN 25 ELSE 8 END + least(25, sc * 3 + fc * 2) + least(20, tc * 3) + least(20, rc * 4) + CASE WHEN id IN ('bonding','tidal') THEN 10 ELSE 0 END AS priority FROM cand""")
def m06_themes(spark, sf):
    rows = doc_rows(spark, sf)
    c = rows.groupBy(F.col("theme_id").alias("id")).agg(F.max(D.in_trailing(F.col("ts"), demo.AS_OF, 7)).alias("live"))
    c = c.select("id", F.lit("cross-source-theme").alias("origin"), F.col("id").alias("title"), F.lit(None).cast("string").alias("stage"), F.lit(None).cast("string").alias("strength"),
                 F.when(F.col("live"), "new").otherwise("steady").alias("movement"), F.col("id").isin("bonding", "tidal").alias("linked"))
    prev = spark.createDataFrame([], "id string, stage string, strength string, movement string, evidence_count long, source_count long, recent_count long")
    adj = spark.createDataFrame([], "candidate_id string, stage string, evidence_count long, source_count long")
    links = rows.select(F.col("theme_id").alias("candidate_id"), "id")
    pool = marts.candidate_pool(c, links, classified(spark, sf), prev, adj, demo.AS_OF)
    return pool.select("id", "evidence_count", "source_count", "recent_evidence_count", "technical_record_count", "priority")


_BEFORE = C_BEFORE.replace("2000-06-01", "2000-06-01 00:00:00")
_PTS = "CASE movement " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in C.MOVEMENT_POINTS.items()) + " ELSE 8 END"


def _review_side(v: str) -> str:
    """Candidates of all origins at a time, in SQL."""
    return f"""SELECT k, ['early-signal','expert-finding','operator-narrative','cross-source-theme'][(k % 4 + 1)::INT] AS origin, ['early:','expert-finding:','operator-narrative:','theme:'][(k % 4 + 1)::INT] || k AS id,
  CASE WHEN k % 4 IN (0, 3) THEN st END AS stage, CASE WHEN k % 4 IN (1, 2) THEN st END AS strength, rc, tc, ec0, sc0,
  CASE WHEN k % 4 = 0 THEN CASE WHEN live THEN 'rising' ELSE 'steady' END WHEN k % 4 = 3 THEN CASE WHEN live THEN 'accelerating' ELSE 'steady' END WHEN rc > 0 THEN 'new' ELSE 'steady' END AS movement,
  CASE WHEN k % 4 = 3 THEN ec0 + 1 ELSE ec0 END AS ec, CASE WHEN k % 4 = 0 THEN sc0 + 1 ELSE sc0 END AS sc, CASE WHEN k % 4 = 0 THEN 2 ELSE fc0 END AS fc
  FROM (SELECT o_custkey AS k, count(*) AS ec0, count(DISTINCT o_orderpriority) AS sc0, count(DISTINCT o_orderstatus) AS fc0, count_if(o_orderdate > {v} - INTERVAL 7 DAY) AS rc, count_if(o_orderstatus = 'F') AS tc, max(o_orderstatus) AS st,
    count_if(o_orderdate > {v} - INTERVAL 90 DAY) > 0 AS live FROM orders WHERE o_orderdate <= {v} GROUP BY 1)"""


def _requirements(side: str, cond: str) -> str:
    level = "[" + ",".join(f"'{m}'" for m in C.MATURITY_ORDER) + "]"
    return f"SELECT 'req-' || k AS id, ['early-signal-tracker/','expert-pulse/','operator-narratives/','themes/'][(k % 4 + 1)::INT] || k AS analysis, {level}[(1 + least(4, ec0 // 4))::INT] AS maturity, ec0 AS n FROM {side} WHERE {cond}"


M06_SQL = f"""now AS ({_review_side(C_NOW)}), pre AS ({_review_side(_BEFORE)}), rq AS ({_requirements('now', 'k % 211 = 0')}), rp AS ({_requirements('pre', 'k % 211 = 0 AND k % 422 <> 0')}),
ad AS (SELECT id, stage, ec0, sc0, CASE WHEN k % 12 = 0 THEN 'req-' || (k // 211 * 211) ELSE 'req-none' END AS rid FROM pre WHERE k % 6 = 0),
jc AS (SELECT now.*, pre.id AS pid, pre.stage AS pst, pre.strength AS psg, pre.movement AS pmv, pre.ec0 AS pec, pre.sc0 AS psc, pre.rc AS prc, ad.id AS aid, ad.stage AS ast, ad.ec0 AS aec, ad.sc0 AS asc_,
  list_distinct(list_filter([r1.id, r2.id], lambda x: x IS NOT NULL)) AS linked_ids, r1.id AS own, r2.id AS named FROM now LEFT JOIN pre ON pre.id = now.id LEFT JOIN ad ON ad.id = now.id LEFT JOIN rq r1 ON r1.id = 'req-' || now.k LEFT JOIN rq r2 ON r2.id = ad.rid),
rr AS (SELECT *, len(linked_ids) > 0 AS linked, lpad(k::VARCHAR, 9, '0') AS title, CASE WHEN pid IS NULL THEN ['new'] ELSE list_filter([CASE WHEN stage <> pst THEN 'stage' END, CASE WHEN strength <> psg THEN 'strength' END,
  CASE WHEN movement <> pmv AND movement IN ('new','accelerating','rising','resurfacing') THEN 'movement' END, CASE WHEN ec - pec >= 2 THEN 'evidence' END, CASE WHEN sc - psc >= 1 THEN 'sources' END, CASE WHEN rc - prc > 0 THEN 'recent' END], lambda x: x IS NOT NULL) END AS reasons,
  CASE WHEN aid IS NOT NULL THEN CASE WHEN stage IS NOT DISTINCT FROM ast AND ec - aec < 2 AND sc - asc_ < 1 THEN 'current' ELSE 'revisit-required' END END AS adj,
  {_PTS} + least(25, sc * 3 + fc * 2) + least(20, tc * 3) + least(20, rc * 4) + CASE WHEN len(linked_ids) > 0 THEN 10 ELSE 0 END AS priority FROM jc),
ch AS (SELECT rq.id, CASE WHEN rp.id IS NULL THEN 'added' WHEN list_position({demo._q(C.MATURITY_ORDER)}, rq.maturity) > list_position({demo._q(C.MATURITY_ORDER)}, rp.maturity) THEN 'promoted' WHEN rq.maturity <> rp.maturity THEN 'demoted'
  WHEN rq.n <> rp.n THEN 'evidence-updated' ELSE 'unchanged' END AS kind FROM rq LEFT JOIN rp ON rp.id = rq.id),
ok AS (SELECT * FROM rr WHERE len(reasons) > 0 AND coalesce(adj, '') <> 'current' AND (priority >= 45 OR linked)), lk AS (SELECT origin, count(*) AS used FROM (SELECT origin FROM ok WHERE linked ORDER BY priority DESC, title LIMIT 10) GROUP BY 1),
fr AS (SELECT ok.*, row_number() OVER (PARTITION BY ok.origin ORDER BY priority DESC, title) + coalesce(used, 0) AS pos FROM ok LEFT JOIN lk ON lk.origin = ok.origin WHERE NOT linked),
qu AS (SELECT id, row_number() OVER (ORDER BY late, priority DESC, title) AS queue_rank FROM (SELECT id, priority, title, 0 AS late FROM ok WHERE linked UNION ALL SELECT id, priority, title, 1 FROM fr WHERE pos <= 4) QUALIFY queue_rank <= 10),
pq AS (SELECT id, row_number() OVER (ORDER BY ec0 DESC, id) AS r FROM pre WHERE k % 3 = 0 QUALIFY r <= 6), h AS (SELECT pq.id, r, 0 AS late FROM pq JOIN rr USING (id) WHERE coalesce(adj, '') <> 'current'),
cq AS (SELECT id, late = 0 AS carried, row_number() OVER (ORDER BY late, r, id) AS place FROM (SELECT * FROM h UNION ALL SELECT id, queue_rank, 1 FROM qu WHERE id NOT IN (SELECT id FROM h)) QUALIFY place <= 10),
fq AS (SELECT id, carried, row_number() OVER (ORDER BY place) AS queue_rank FROM cq WHERE id NOT IN (SELECT rr.id FROM rr, unnest(linked_ids) u(x) JOIN ch ON ch.id = x AND kind = 'added'))"""
M06_ROWS = """SELECT 'candidate' AS section, id AS key, priority AS n, concat_ws('|', movement, array_to_string(reasons, ','), coalesce(adj, ''), CASE WHEN adj = 'current' THEN 'keep' WHEN linked THEN 'review-existing-requirement' ELSE 'assess-new-requirement' END,
  array_to_string(list_filter([CASE WHEN own IS NOT NULL THEN own || ':analysis' END, CASE WHEN named IS NOT NULL AND named IS DISTINCT FROM own THEN named || ':adjudication' END], lambda x: x IS NOT NULL), ',')) AS detail FROM rr
UNION ALL SELECT 'change', id, 0, kind FROM ch"""


def review_side(spark, sf, until):
    """Candidates of all origins at a time: what each origin states itself, and the cited orders."""
    o = table(spark, sf, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp")).filter(F.col("ts") <= F.lit(until).cast("timestamp"))
    g = o.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("ec0"), F.count_distinct("o_orderpriority").alias("sc0"), F.max("o_orderstatus").alias("st"),
                                                     (F.count_if(D.in_trailing(F.col("ts"), until, 90)) > 0).alias("live"), F.count_if(D.in_trailing(F.col("ts"), until, 7)).alias("rc"))
    g = g.withColumn("title", F.lpad(F.col("k").cast("string"), 9, "0")).withColumn("id", F.col("k").cast("string"))
    side = lambda i: g.filter(F.col("k") % 4 == i)
    items = {"early": side(0).select("id", "title", F.col("st").alias("stage"), F.when(F.col("live"), "rising").otherwise("steady").alias("movement"), (F.col("sc0") + 1).alias("source_count"), F.lit(2).alias("family_count")),
             "experts": side(1).select("id", "title", F.col("st").alias("strength")), "narratives": side(2).select("id", "title", F.col("st").alias("strength")),
             "themes": side(3).select("id", "title", F.col("st").alias("stage"), F.when(F.col("live"), "accelerating").alias("movement"), (F.col("ec0") + 1).alias("evidence_count"))}
    cited = o.select(F.col("o_custkey").cast("string").alias("item"), F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 4).alias("i"))
    links = {name: cited.filter(F.col("i") == i).drop("i") for i, name in enumerate(items)}
    return review.candidate_union(items), review.candidate_links(links), g


def weekly(spark, sf, now, same=False):
    """One run of the review with the state of 2000-06-01 before it; with `same` the run before had these very inputs."""
    before = "2000-06-01T00:00:00Z"
    cand, links, g = review_side(spark, sf, now)
    old, old_links, og = review_side(spark, sf, now if same else before)
    o = table(spark, sf, "orders")
    e = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("source_id"), F.col("o_orderstatus").alias("source_type"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    level = F.element_at(F.array(*[F.lit(m) for m in C.MATURITY_ORDER]), (1 + F.least(F.lit(4), F.expr("ec0 div 4"))).cast("int"))
    prefix = F.element_at(F.array(*[F.lit(x[2]) for x in review.ORIGINS.values()]), (F.col("k") % 4 + 1).cast("int"))
    name = F.element_at(F.array(*[F.lit(x[1]) for x in review.ORIGINS.values()]), (F.col("k") % 4 + 1).cast("int"))
    req = lambda x, cond: x.filter(cond).select(F.concat(F.lit("req-"), "k").alias("id"), F.concat(prefix, F.col("k")).alias("source_analysis"), level.alias("maturity"), F.col("ec0").alias("evidence_count"))
    # the run before kept what it counted, without the counts that origins state themselves
    none = spark.createDataFrame([], "candidate_id string, outcome string, requirement_ids array<string>, stage string, evidence_count long, source_count long")
    no_req = spark.createDataFrame([], "id string, source_analysis string, maturity string")
    no_prev = spark.createDataFrame([], "id string, stage string, strength string, movement string, evidence_count long, source_count long, recent_count long")
    bare = old if same else old.withColumns({f"own_{c}": F.lit(None).cast("bigint") for c in review.OWN})
    prev = cut_lineage(review.candidate_pool(bare, old_links, e, no_req, no_prev, none, now if same else before, ["F"]), "previous")
    judged = og.filter(F.col("k") % 6 == 0).select(
        F.concat(name, F.col("k")).alias("candidate_id"), F.lit("keep").alias("outcome"), F.array(F.when(F.col("k") % 12 == 0, F.concat(F.lit("req-"), F.expr("k div 211 * 211"))).otherwise("req-none")).alias("requirement_ids"),
        F.when((F.col("k") % 4).isin(0, 3), F.col("st")).alias("stage"), F.col("ec0").alias("evidence_count"), F.col("sc0").alias("source_count"))
    cur = req(g, F.col("k") % 211 == 0)
    old_req = cur if same else req(og, (F.col("k") % 211 == 0) & (F.col("k") % 422 != 0))
    pool = review.candidate_pool(cand, links, e, cur, prev, judged, now, ["F"])
    queue = R.numbered_top(og.filter(F.col("k") % 3 == 0).select(F.concat(name, F.col("k")).alias("id"), "ec0"), [F.desc("ec0"), F.col("id")], 6, "queue_rank")
    rows = classified(spark, sf)
    hits = rows if same else rows.filter(F.col("ts") <= F.lit("2024-05-01T00:00:00Z").cast("timestamp"))
    seen = marts.verification_hits(hits, VERIFICATION_RULES).select("family", "id")
    checks = marts.verification_coverage(rows, VERIFICATION_RULES, seen)
    before_tables = {"queue": queue, "requirement_changes": cur.limit(0).select("id", F.lit("kept").alias("change_type")), "verification": checks.filter("family = 'formation'")}
    return review.weekly_review(pool, cur, old_req, checks, before_tables, True)


@query("m06_weekly_review", f"""WITH {EV_SQL}, {M06_SQL}, m AS (SELECT ts, source_id, unnest(list_filter([CASE WHEN source_type IN ('company-directory') THEN 'formation' END,
  CASE WHEN source_type IN ('first-party-lab','practitioner-blog') AND (contains({_LOW},'theaeati') OR contains({_LOW},'oument')) THEN 'architecture' END, CASE WHEN source_id IN ('src1','src15') AND source_type = 'repository' THEN 'adoption' END], lambda x: x IS NOT NULL)) AS family FROM ev)
{M06_ROWS} UNION ALL SELECT 'queue', id, queue_rank, carried::VARCHAR FROM fq UNION ALL SELECT 'verification', family, count(*), 'active/' || count_if(ts > {PREV_SQL}) FROM m GROUP BY 2
UNION ALL SELECT 'meta', 'candidates', count(*), '' FROM rr UNION ALL SELECT 'meta', 'changed', count_if(len(reasons) > 0), '' FROM rr UNION ALL SELECT 'meta', 'adjudications', count(adj), '' FROM rr
UNION ALL SELECT 'meta', 'queue', count(*), '' FROM fq UNION ALL SELECT 'meta', 'carried', count_if(carried), '' FROM fq UNION ALL SELECT 'meta', 'requirement_changes', count_if(kind <> 'unchanged'), '' FROM ch
UNION ALL SELECT 'meta', 'baseline', 0, '' UNION ALL SELECT 'meta', 'idempotent', 0, ''""")
def m06(spark, sf):
    t = weekly(spark, sf, "2001-01-01T00:00:00Z")
    row = lambda df, section, key, n, detail: df.select(F.lit(section).alias("section"), key.alias("key"), n.cast("long").alias("n"), detail.alias("detail"))
    linked = F.array_join(F.transform("linked_requirements", lambda x: F.concat_ws(":", x["id"], x["kind"])), ",")
    detail = F.concat_ws("|", "movement", F.array_join("change_reasons", ","), F.coalesce("adjudication", F.lit("")), "review_action", linked)
    return (row(t["candidates"], "candidate", F.col("id"), F.col("priority"), detail).unionByName(row(t["requirement_changes"], "change", F.col("id"), F.lit(0), F.col("change_type")))
            .unionByName(row(t["queue"], "queue", F.col("id"), F.col("queue_rank"), F.col("carried").cast("string")))
            .unionByName(row(t["verification"], "verification", F.col("family"), F.col("record_count"), F.concat_ws("/", "status", F.col("new_record_count").cast("string"))))
            .unionByName(row(t["meta"], "meta", F.col("metric"), F.col("value"), F.lit(""))))


@query("m06_same_inputs", f"""WITH {M06_SQL}, z AS (SELECT count(*) AS n FROM rr)
SELECT 'candidates' AS key, n FROM z UNION ALL SELECT 'changed', 0 UNION ALL SELECT 'requirement_changes', 0 UNION ALL SELECT 'baseline', 0 UNION ALL SELECT 'idempotent', 1
UNION ALL SELECT 'verification rows', 1 UNION ALL SELECT 'change rows', 0""")
def m06_same(spark, sf):
    """A second run of the same cycle over the same inputs keeps what the first one published."""
    t = weekly(spark, sf, "2001-01-01T00:00:00Z", same=True)
    meta = t["meta"].filter(~F.col("metric").isin("queue", "carried", "adjudications")).select(F.col("metric").alias("key"), F.col("value").alias("n"))
    return meta.unionByName(t["verification"].agg(F.lit("verification rows").alias("key"), F.count("*").alias("n"))).unionByName(
        t["requirement_changes"].agg(F.lit("change rows").alias("key"), F.count("*").alias("n")))


@query("m08_live_section", f"""WITH {EVC_SQL}, m AS (SELECT * FROM cl WHERE source_id = 'src4') SELECT 'records' AS key, count(*) AS n FROM m UNION ALL SELECT 'classified', count_if(len(theme_ids) > 0) FROM m
UNION ALL (SELECT t, count(*) AS n FROM m, unnest(theme_ids) u(t) GROUP BY 1 ORDER BY n DESC, t LIMIT 8) UNION ALL (SELECT id, row_number() OVER (ORDER BY published_at DESC, id DESC) AS n FROM m QUALIFY n <= 8)""")
def m08(spark, sf):
    head, lead, newest = marts.live_section(classified(spark, sf), "src4")
    h = head.select(F.explode(F.array(F.struct(F.lit("records").alias("key"), F.col("record_count").alias("n")), F.struct(F.lit("classified").alias("key"), F.col("classified_record_count").alias("n")))).alias("r")).select("r.*")
    latest = newest.select(F.col("id").alias("key"), F.row_number().over(Window.orderBy(F.desc("published_at"), F.desc("id"))).cast("long").alias("n"))
    return h.unionByName(lead.select(F.col("theme_id").alias("key"), F.col("evidence_count").alias("n"))).unionByName(latest)
