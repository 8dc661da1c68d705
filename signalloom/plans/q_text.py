"""Queries over text, filters, classification, de-duplication and linking, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalloom.functions import constants as C, dates as D, text as X
from signalloom.functions.arrays import explode_rows
from signalloom.operators import classify as K, dedup, quality as Q, ranking as R, resolve as V
from signalloom.plans import demo, stages
from signalloom.plans.demo import CL_SQL, EV_SQL, EVC_SQL, EVD_SQL, SRC_SQL, evidence, table

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def classified(spark, sf):
    return stages.classified(spark, sf)


# ---- scalar functions -------------------------------------------------------------------------

ACC_SQL = f"translate(lower(%s), '{C.ACCENTED}', '{C.UNACCENTED}')"
SLUG_SQL = "regexp_replace(regexp_replace(regexp_replace(" + ACC_SQL + r", '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query("n01_text_normalization", f"""WITH {EV_SQL}
SELECT id, md5(title) AS title_hash, md5(summary) AS summary_hash, md5({SLUG_SQL % 'title'}) AS slug_hash, curl AS canonical_url,
  length(title) + length(summary) AS n_chars FROM ev""")
def n01(spark, sf):
    e = evidence(spark, sf)
    return e.select("id", F.md5("title").alias("title_hash"), F.md5("summary").alias("summary_hash"),
                    F.md5(X.slug(F.col("title"))).alias("slug_hash"), X.canonical_url(F.col("url")).alias("canonical_url"),
                    (F.length("title") + F.length("summary")).cast("long").alias("n_chars"))


@query("n04_strip_html", r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(html, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '),
  '&middot;', '·'), '&copy;', '©'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS text_hash FROM pages""")
def n04(spark, sf):
    return demo.spread(table(spark, sf, "pages")).select("page_id", F.md5(X.strip_tags(F.col("html"))).alias("text_hash"))


@query("n05_lenient_dates", """WITH f AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 6 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k IN (0,1,2,3) THEN strftime(d, '%Y-%m-%d %H:%M:%S') END AS parsed,
  CASE WHEN k IN (0,1) THEN strftime(d, '%Y-%m') WHEN k IN (2,3) AND k <> 3 THEN strftime(d, '%Y-%m') ELSE '' END AS month FROM f""")
def n05(spark, sf):
    o = table(spark, sf, "orders")
    d, k = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey") % 6
    raw = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format(d, "yyyy-MM-dd"))
           .when(k == 2, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 3, F.date_format(d, "E, d MMM yyyy HH:mm:ss '+0000'"))
           .when(k == 4, F.date_format(d, "yyyy")).otherwise("not a date"))
    rows = o.select("o_orderkey", raw.alias("raw"))
    stamp = D.parse_timestamp(F.col("raw"))
    return rows.select("o_orderkey", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                       F.when(F.col("raw").rlike(r"^\d{4}-"), D.month_key(F.col("raw"))).otherwise(F.lit("")).alias("month"))


@query("n06_public_links", r"""WITH u AS (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN
   'https://go.example.net/r?url=' || replace(replace(replace(replace(replace(url, ':', '%3A'), '/', '%2F'), '?', '%3F'), '=', '%3D'), '&', '%26') || '&utm_source=x'
   ELSE url || CASE WHEN contains(url, '#') THEN '' WHEN contains(url, '?') THEN '&utm_medium=mail&keep=1' ELSE '?uid=7&keep=1' END END AS raw FROM pages),
t AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE raw END AS target FROM u),
b AS (SELECT page_id, split_part(target, '#', 1) AS bare FROM t),
q AS (SELECT page_id, split_part(bare, '?', 1) AS base, CASE WHEN contains(bare, '?') THEN regexp_replace(bare, '^[^?]*\?', '') ELSE '' END AS query FROM b),
k AS (SELECT page_id, base, array_to_string(list_filter(string_split(query, '&'), lambda p: length(regexp_replace(p, '^[^=]*=?', '')) > 0
   AND lower(split_part(p, '=', 1)) NOT IN ('campaign','cid','email','mc_cid','mc_eid','recipient','ref','trk','uid','user','utm_campaign','utm_content','utm_medium','utm_source','utm_term')
   AND NOT starts_with(lower(split_part(p, '=', 1)), 'utm_')), '&') AS rest FROM q)
SELECT page_id, CASE WHEN rest <> '' THEN base || '?' || rest ELSE base END AS link FROM k""")
def n06(spark, sf):
    p = table(spark, sf, "pages")
    wrapped = F.concat(F.lit("https://go.example.net/r?url="), F.url_encode("url"), F.lit("&utm_source=x"))
    tail = F.when(F.contains("url", F.lit("#")), "").when(F.contains("url", F.lit("?")), "&utm_medium=mail&keep=1").otherwise("?uid=7&keep=1")
    raw = F.when(F.col("page_id") % 2 == 0, wrapped).otherwise(F.concat("url", tail))
    return p.select("page_id", X.public_link(raw).alias("link"))


@query("n07_issue_url", r"""WITH l AS (SELECT page_id, 'http://m.example.net/v?x=1&amp;cid=' || lpad(page_id::VARCHAR, CASE WHEN page_id % 3 = 0 THEN 4 ELSE 9 END, '0') AS link FROM pages)
SELECT page_id, CASE WHEN page_id % 3 <> 0 OR length(page_id::VARCHAR) > 7 THEN 'https://issues.example.org/email/' || lpad(page_id::VARCHAR, 9, '0')
  ELSE 'https://issues.example.org/archive' END AS issue_url FROM l""")
def n07(spark, sf):
    p = table(spark, sf, "pages")
    cid = F.lpad(F.col("page_id").cast("string"), F.when(F.col("page_id") % 3 == 0, 4).otherwise(9), F.lit("0"))
    link = F.concat(F.lit('<a href="http://m.example.net/v?x=1&amp;cid='), cid, F.lit('">issue</a>'))
    return p.select("page_id", X.issue_url(F.concat("html", link), "https://issues.example.org/email/",
                                           "https://issues.example.org/archive").alias("issue_url"))


@query("n08_stable_ids", f"""WITH {EV_SQL}
SELECT id, source_id || ':' || substr(sha256(source_id || '|' || substr(published_at, 1, 10) || '|' || ftitle), 1, 20) AS stable_id FROM ev""")
def n08(spark, sf):
    e = evidence(spark, sf)
    return e.select("id", X.stable_id(F.col("source_id"), F.col("source_id"), F.substring("published_at", 1, 10),
                                      X.folded_title(F.col("title"))).alias("stable_id"))


_BARE = r"""list_transform(list_filter(string_split(t, ' '), lambda x: x <> ''), lambda x: regexp_replace(x, '^[.,:;!?&''"\-]+|[.,:;!?&''"\-]+$', '', 'g'))"""
_CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(%s, '\s+', ' ', 'g')), '^[ \-|•]+|[ \-|•]+$', '', 'g'), '\s+([,.;:!?])', '\1', 'g'), '([\(\[\{])\s+', '\1', 'g')"""
_MARK = r"""regexp_replace(text, '^(?:[▸▶→•]\s*)?(?:\d+[.)]\s*)?', '')"""
_IGN = C.IGNORED_LINK_TEXT.replace("'", "''")
_GIGN = C.GENERIC_IGNORED_LINK_TEXT.replace("'", "''")
_GENERIC = r"""regexp_replace(trim(regexp_replace(%s, '\s+', ' ', 'g')), '^[ \-|•]+|[ \-|•]+$', '', 'g')"""


@query("f04_title_quality", f"""WITH c AS (SELECT conv_id, turn, {_CLEAN % _MARK} AS t, {_GENERIC % _MARK} AS g FROM conversations),
s AS (SELECT *, len(list_filter(string_split(t, ' '), lambda x: x <> '')) AS n, len(list_filter({_BARE}, lambda x: length(x) = 1)) AS singles,
  len(list_filter(string_split(g, ' '), lambda x: x <> '')) AS gn FROM c)
SELECT conv_id, turn, NOT ((n >= 8 AND singles >= n * 0.6) OR length(t) < 32 OR n < 5 OR regexp_matches(t, '{_IGN}')) AS editorial,
  NOT (length(g) < 14 OR gn < 3 OR regexp_matches(g, '{_GIGN}')) AS generic, md5(t) AS title_hash FROM s""")
def f04(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", X.editorial_title(F.col("text")).isNotNull().alias("editorial"),
                    X.generic_title(F.col("text")).isNotNull().alias("generic"),
                    F.md5(X.clean_title(X.drop_leading_marker(F.col("text")))).alias("title_hash"))


@query("n10_title_from_url", r"""WITH w AS (SELECT page_id, trim(regexp_replace(regexp_replace(
  regexp_extract(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1), '[-_]+', ' ', 'g'), '\s+', ' ', 'g')) AS s FROM pages)
SELECT page_id, array_to_string(list_transform(string_split(s, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS title FROM w""")
def s10(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.title_from_url(F.col("url")).alias("title"))


@query("n12_tokens", r"""WITH t AS (SELECT doc_id, regexp_extract_all(translate(replace(lower(text), 'ß', 'ss'), '-/', '  '), '[a-z0-9]+(?:[.+#][a-z0-9]+)*') AS w FROM documents)
SELECT doc_id, len(w) AS tokens, md5(array_to_string(w, ' ')) AS text_hash, contains(' ' || array_to_string(w, ' ') || ' ', ' the and ') AS has_phrase FROM t""")
def n12(spark, sf):
    d = demo.spread(table(spark, sf, "documents")).withColumn("w", X.normalized_tokens(F.col("text")))
    joined = F.array_join("w", " ")
    return d.select("doc_id", F.size("w").cast("long").alias("tokens"), F.md5(joined).alias("text_hash"),
                    X.contains_phrase(joined, F.lit("the and")).alias("has_phrase"))


@query("n15_stack_layers", f"""WITH {EVC_SQL}, {demo.THEME_SQL},
x AS (SELECT id, unnest(theme_ids) AS t, generate_subscripts(theme_ids, 1) AS i FROM cl),
l AS (SELECT x.id, i * 2 AS o, primary_layer AS layer FROM x JOIN thm ON thm.id = t UNION ALL SELECT x.id, i * 2 + 1, secondary_layer FROM x JOIN thm ON thm.id = t),
f AS (SELECT id, layer, min(o) AS o FROM l WHERE layer <> '' GROUP BY id, layer)
SELECT cl.id, coalesce(string_agg(layer, ',' ORDER BY o), '') AS layers FROM cl LEFT JOIN f USING (id) GROUP BY cl.id""")
def n15(spark, sf):
    layers = {t[0]: [t[4], t[5]] for t in demo.THEMES}
    return classified(spark, sf).select("id", F.array_join(K.stack_layers(F.col("theme_ids"), layers), ",").alias("layers"))


@query("n16_normalized_evidence", f"""WITH {EVC_SQL}
SELECT id, coalesce(s.publisher_id, source_id) AS publisher_id, disposition, CASE WHEN f THEN '' ELSE published_at END AS published_at,
  CASE WHEN f THEN published_at ELSE '' END AS observed_at, CASE WHEN f THEN 0 ELSE 1 END AS months, 1 AS support_count
FROM (SELECT *, source_type = 'company-directory' AS f FROM cl) LEFT JOIN src s ON s.id = source_id""".replace(
    "SELECT id, coalesce", "SELECT cle.id, coalesce").replace("AS f FROM cl)", "AS f FROM cl) cle"))
def n16(spark, sf):
    from signalloom.plans.marts import normalized_evidence
    e = classified(spark, sf).withColumn("metadata", F.when(
        F.col("source_type") == "company-directory", F.map_concat("metadata", F.create_map(F.lit("date_basis"), F.lit("first-observed"))))
        .otherwise(F.col("metadata")))
    n = normalized_evidence(e, demo.sources(spark), {t[0]: [t[4], t[5]] for t in demo.THEMES})
    return n.select("id", "publisher_id", "disposition", "published_at", "observed_at",
                    F.size("monthly_counts").alias("months"), "support_count")


@query("n17_aggregate_evidence", """SELECT 'trend:' || p_brand AS id, count(*) AS support_count, count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS months,
  p_brand IN ('Brand#1','Brand#2','Brand#3') AS classified FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_brand""")
def n17(spark, sf):
    from signalloom.plans.marts import aggregate_evidence
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = li.select(F.col("p_brand").alias("name"), F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    mapping = {"Brand#1": ["bonding"], "Brand#2": ["harbor", "tidal"], "Brand#3": ["lattice"]}
    out = aggregate_evidence(rows, mapping, "digest", demo.AS_OF)
    return out.select("id", "support_count", F.size("monthly_counts").cast("long").alias("months"),
                      (F.col("disposition") == "classified").alias("classified"))


@query("n18_public_rows", f"""WITH {EV_SQL}
SELECT id, sponsor_status, CASE source_type WHEN 'repository' THEN 'stars=' || length(summary) WHEN 'company-directory' THEN 'batch=' || lang
  WHEN 'job-posting' THEN 'batch=' || lang ELSE '' END AS verification FROM ev""")
def n18(spark, sf):
    e = evidence(spark, sf).withColumn("metadata", F.create_map(
        F.lit("stars"), F.length("summary").cast("string"), F.lit("batch"), F.get("tags", F.lit(0)), F.lit("raw_note"), F.lit("x")))
    out = Q.public_rows(e)
    return out.select("id", "sponsor_status", F.array_join(F.transform(
        F.map_entries("verification"), lambda m: F.concat(m["key"], F.lit("="), m["value"])), ",").alias("verification"))


@query("n19_fingerprints", """SELECT count(*) AS records, count(DISTINCT source || chr(1) || text || chr(1) || lang || doc_id) AS fingerprints FROM documents""")
def n19(spark, sf):
    e = evidence(spark, sf).withColumn("theme_ids", F.array().cast("array<string>"))
    return e.select(Q.fingerprint().alias("f")).agg(F.count("*").alias("records"), F.count_distinct("f").alias("fingerprints"))


_VERBS = "|".join(C.RELEASE_VERBS)
_LEAD_SQL = r"""trim(regexp_replace(lower(CASE WHEN v <> '' THEN v ELSE array_to_string(list_filter(string_split(trim(regexp_replace(c, '\s+', ' ', 'g')), ' '), lambda x: x <> '')[1:4], ' ') END), '[^a-z0-9]+', ' ', 'g'))"""


@query("n21_lead_entity", rf"""WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '* ' || o_orderpriority || ' Team ships order ' || o_orderkey ELSE o_orderpriority || ' has no verb ' || o_orderkey END AS s FROM orders),
c AS (SELECT o_orderkey, trim(regexp_replace(s, '^[^A-Za-z0-9]+', '')) AS c FROM b),
v AS (SELECT o_orderkey, c, regexp_extract(c, '(?i)^(.{{2,55}}?)\s+(?:{_VERBS})\b', 1) AS v FROM c)
SELECT o_orderkey, {_LEAD_SQL} AS entity FROM v""")
def n21(spark, sf):
    o = table(spark, sf, "orders")
    s = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("* "), "o_orderpriority", F.lit(" Team ships order "), "o_orderkey")).otherwise(
        F.concat("o_orderpriority", F.lit(" has no verb "), "o_orderkey"))
    return o.select("o_orderkey", X.lead_entity(s).alias("entity"))


@query("n22_ladders", """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity * 2 >= 80 THEN 'very-high' WHEN l_quantity * 2 >= 60 THEN 'high' WHEN l_quantity * 2 >= 40 THEN 'moderate' ELSE 'limited' END AS label,
  CASE WHEN l_quantity * 2 >= 85 THEN 'Test now' WHEN l_quantity * 2 >= 75 THEN 'Pilot / watch' WHEN l_quantity * 2 >= 65 THEN 'Selective' ELSE 'Research only' END AS action FROM lineitem""")
def n22(spark, sf):
    from signalloom.operators.pulse import score_label
    from signalloom.operators.scores import opportunity_action
    li = table(spark, sf, "lineitem")
    v = F.col("l_quantity") * 2
    return li.select("l_orderkey", "l_linenumber", score_label(v).alias("label"), opportunity_action(v).alias("action"))


@query("n23_echo_keys", f"""WITH {EV_SQL}
SELECT id, CASE WHEN len(arts) > 0 THEN 'url:' || arts[1] ELSE 'url:' || curl END AS echo_key FROM ev""")
def n23(spark, sf):
    return evidence(spark, sf).select("id", V.echo_key().alias("echo_key"))


@query("n24_evidence_weights", f"""WITH {EV_SQL}
SELECT id, CASE WHEN source_type IN ('event-paper','repository') THEN 4 WHEN len(arts) > 0 THEN 2 ELSE 0 END AS strength,
  CASE WHEN source_type = 'repository' THEN 1.0 WHEN len(arts) > 0 THEN 0.35 ELSE 0.0 END::DOUBLE AS artifact_weight,
  CASE WHEN source_type = 'repository' THEN 1.0 WHEN source_type IN ('paper','paper-curation','first-party-lab') THEN 0.75 ELSE 0.0 END::DOUBLE AS technical_weight FROM ev""")
def n24(spark, sf):
    from signalloom.operators import pulse as P
    return evidence(spark, sf).select("id", P.strength().alias("strength"), P.artifact_weight().alias("artifact_weight"),
                                      P.technical_weight(F.col("source_type")).alias("technical_weight"))


@query("n25_source_families", f"""WITH {EV_SQL}, fam(channel, family) AS (VALUES {", ".join(f"('{k}','{v}')" for k, v in C.LIFECYCLE_FAMILIES.items())})
SELECT coalesce(family, source_type) AS family, count(*) AS records FROM ev LEFT JOIN fam ON channel = source_type GROUP BY 1""")
def n25(spark, sf):
    from signalloom.operators.lifecycle import family
    return evidence(spark, sf).groupBy(family(F.col("source_type")).alias("family")).agg(F.count("*").alias("records"))


@query("n28_source_rewrite", f"""WITH {EV_SQL} SELECT id, source_type, CASE WHEN source_type IN ('expert-social','repository') AND source_id = 'src1' THEN 'src-one'
  WHEN source_type IN ('expert-social','repository') AND source_id = 'src5' THEN 'src-five' ELSE source_id END AS source_id FROM ev""")
def n28(spark, sf):
    moved = {"src1": "src-one", "src5": "src-five", "src2": "src-two"}  # src2 is of another type and stays
    return V.rewrite_sources(evidence(spark, sf), moved, ["expert-social", "repository"]).select("id", "source_type", "source_id")


# ---- filters ----------------------------------------------------------------------------------

@query("f03_url_scope", r"""SELECT page_id, url FROM pages WHERE (starts_with(url, 'http://') OR starts_with(url, 'https://m.'))
  AND regexp_replace(url, '/+$', '') NOT IN ('http:', 'https://m.') AND regexp_matches(url, '/en/|/fr/\d+')""")
def f03(spark, sf):
    p = table(spark, sf, "pages")
    return p.filter(K.url_in_scope(F.col("url"), ["http://", "https://m."], [r"/en/", r"/fr/\d+"])).select("page_id", "url")


@query("f05_topic_relevance", r"""SELECT doc_id FROM documents WHERE regexp_matches(replace(lower(text),'ß','ss'), '(^|[^\p{L}\p{N}_])(?:thd|ea)($|[^\p{L}\p{N}_])')
  OR contains(replace(lower(text),'ß','ss'), 'queque') OR source = 'src7'""")
def f05(spark, sf):
    d = table(spark, sf, "documents")
    link = F.concat(F.lit("https://"), "source", F.lit(".labs.example.org/x"))
    return d.filter(K.topic_relevant(F.col("text"), link, ["thd", "ea", "queque"], ["src7.labs.example.org"])).select("doc_id")


_MAIL = "CASE WHEN c_custkey % 3 = 0 THEN 'Desk <Desk' || c_nationkey || '@mail.example.org>' WHEN c_custkey % 3 = 1 THEN 'a@' || 'n' || c_nationkey || '.example.net' ELSE 'nobody' END"


@query("f06_sender_routing", f"""WITH m AS (SELECT c_custkey, {_MAIL} AS f, c_nationkey AS n FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND n = 3 THEN 'desk-three' WHEN c_custkey % 3 = 0 THEN 'mail-org' WHEN c_custkey % 3 = 1 AND n = 5 THEN 'net-five' END AS route,
  CASE WHEN c_custkey % 3 = 0 THEN 'mail.example.org' WHEN c_custkey % 3 = 1 THEN 'n' || n || '.example.net' ELSE '' END AS domain FROM m""")
def f06(spark, sf):
    c = table(spark, sf, "customer")
    k, n = F.col("c_custkey") % 3, F.col("c_nationkey")
    frm = (F.when(k == 0, F.concat(F.lit("Desk <Desk"), n, F.lit("@mail.example.org>")))
           .when(k == 1, F.concat(F.lit("a@n"), n, F.lit(".example.net"))).otherwise("nobody"))
    defs = [{"source_id": "desk-three", "sender_addresses": ["desk3@mail.example.org"]},
            {"source_id": "mail-org", "sender_domains": ["example.org"]},
            {"source_id": "net-five", "sender_domains": ["n5.example.net"]}]
    m = K.sender_routes(c.select("c_custkey", frm.alias("from")), defs)
    return m.select("c_custkey", "route", X.sender_domain(F.col("from")).alias("domain"))


_MAILRE = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
_UNSAFE = f"regexp_matches(title || ' ' || summary, '{_MAILRE}')"
ELIG_SQL = f"""el AS (SELECT cl.*, s.enabled, coalesce(s.publisher_id, source_id) AS publisher_id, CASE
  WHEN title = '' AND summary = '' THEN 'missing-content' WHEN s.id IS NULL THEN 'unknown-source' WHEN NOT s.enabled THEN 'disabled-source'
  WHEN {_UNSAFE} THEN 'not-public-safe' WHEN ts > {demo.AS_OF_SQL} + INTERVAL 1 DAY THEN 'future-dated'
  WHEN ts <= {demo.AS_OF_SQL} - INTERVAL 35 DAY THEN 'outside-window' END AS reason
  FROM cl LEFT JOIN src s ON s.id = source_id)"""


@query("f07_eligibility", f"""WITH {EVC_SQL}, {ELIG_SQL} SELECT coalesce(reason, 'eligible') AS reason, count(*) AS records, min(id) AS first_id FROM el GROUP BY 1""")
def f07(spark, sf):
    e = Q.eligibility(classified(spark, sf).drop("doc_id", "ts"), demo.sources(spark), demo.AS_OF)
    return e.groupBy(F.coalesce("reason", F.lit("eligible")).alias("reason")).agg(F.count("*").alias("records"), F.min("id").alias("first_id"))


@query("f08_privacy_scan", rf"""SELECT doc_id, 'email-address' AS violation FROM documents WHERE regexp_matches(text, '{_MAILRE}')
UNION ALL SELECT doc_id, 'bearer-token' FROM documents WHERE regexp_matches(text, '(?i)\bBearer\s+[A-Za-z0-9._~+/=-]{{16,}}')
UNION ALL SELECT doc_id, 'private-key' FROM documents WHERE regexp_matches(text, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----')
UNION ALL SELECT doc_id, 'mailbox-link' FROM documents WHERE regexp_matches(text, '(?i)mail\.google\.com/.*(?:authuser|#all/)')""")
def f08(spark, sf):
    d = demo.spread(table(spark, sf, "documents"))
    return Q.privacy_violations(d, "doc_id", Q.text_columns(d.select("text")))


@query("f09_link_contract", r"""WITH l AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'LinkedIn' WHEN 1 THEN 'x' WHEN 2 THEN 'other' ELSE 'x' END AS platform,
  CASE WHEN o_orderkey % 4 = 3 THEN 'https://linkedin.com/p/' ELSE 'https://www.linkedin.com/p/' END || o_orderkey AS url,
  o_orderstatus AS s, length(repeat(o_orderpriority, (o_orderkey % 90)::INT)) AS n FROM orders),
v AS (SELECT o_orderkey, unnest(list_filter([CASE WHEN n = 0 THEN 'missing-field' END, CASE WHEN platform = 'other' THEN 'unsupported-platform' END,
  CASE WHEN s = 'P' THEN 'unknown-event' END, CASE WHEN platform = 'x' OR platform = 'other' THEN 'host-mismatch' END,
  CASE WHEN n > 700 THEN 'observation-too-long' END], lambda x: x IS NOT NULL)) AS violation FROM l)
SELECT violation, count(*) AS records FROM v GROUP BY 1""")
def f09(spark, sf):
    o = demo.spread(table(spark, sf, "orders"))
    k = F.col("o_orderkey") % 4
    links = o.select(
        F.concat(F.lit("l:"), "o_orderkey").alias("id"),
        F.when(k == 0, "LinkedIn").when(k == 2, "other").otherwise("x").alias("platform"),
        F.concat(F.when(k == 3, "https://linkedin.com/p/").otherwise("https://www.linkedin.com/p/"), "o_orderkey").alias("post_url"),
        F.lit("someone").alias("author_name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published_at"),
        F.array(F.concat(F.lit("event-"), "o_orderstatus")).alias("event_ids"),
        F.expr("repeat(o_orderpriority, cast(o_orderkey % 90 as int))").alias("observation"),
        F.lit(None).cast("string").alias("raw_post_text"))
    out = Q.link_contract(links, ["event-F", "event-O"], ["raw_post_text"])
    return explode_rows(out.select("violations"), "violation", "violations").groupBy("violation").agg(F.count("*").alias("records"))


@query("f10_record_contract", """WITH g AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_suppkey) AS s, count(DISTINCT l_returnflag) AS f, count(DISTINCT l_linenumber || ':' || l_partkey) AS u,
  count_if(l_linestatus = 'O') AS t FROM lineitem GROUP BY 1),
m AS (SELECT g.*, x.d FROM g JOIN (SELECT l_orderkey, max(c) AS d FROM (SELECT l_orderkey, l_suppkey, count(*) AS c FROM lineitem GROUP BY 1, 2) GROUP BY 1) x USING (l_orderkey)),
v AS (SELECT unnest(list_filter([CASE WHEN u < n THEN 'repeated-list-value' END, CASE WHEN NOT (n >= 3 AND s >= 3 AND f >= 2 AND d::DOUBLE / n <= 0.5) THEN 'candidate-gate-not-met' END], lambda x: x IS NOT NULL)) AS violation FROM m)
SELECT violation, count(*) AS records FROM v GROUP BY 1""")
def f10(spark, sf):
    li = table(spark, sf, "lineitem")
    per = li.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("c")).groupBy("l_orderkey").agg(F.max("c").alias("d"))
    g = li.groupBy("l_orderkey").agg(
        F.collect_list(F.concat_ws(":", "l_linenumber", "l_partkey")).alias("evidence_ids"), F.collect_set(F.col("l_suppkey").cast("string")).alias("source_ids"),
        F.collect_set("l_returnflag").alias("source_family_ids"), F.count_if(F.col("l_linestatus") == "O").alias("t"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_seen"), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_seen"))
    r = g.join(per, "l_orderkey").select(
        F.col("l_orderkey").cast("string").alias("id"), F.lit("t").alias("title"), F.lit("p").alias("observed_pattern"), F.lit("h").alias("hypothesis"),
        F.lit("w").alias("why_now"), F.lit("n").alias("novelty"), "evidence_ids", "source_ids", "source_family_ids",
        F.array().cast("array<string>").alias("theme_ids"), F.array(F.lit("c")).alias("concepts"), "first_seen", "last_seen",
        F.lit("candidate").alias("state"), F.lit(False).alias("novelty_reviewed"), F.lit("pending").alias("review_status"), F.lit(None).cast("string").alias("review_action"),
        F.struct(F.size("evidence_ids").alias("evidence_count"), F.size("evidence_ids").alias("independent_event_count"), F.size("source_ids").alias("source_count"),
                 F.size("source_family_ids").alias("source_family_count"), F.col("t").cast("int").alias("technical_record_count"),
                 (F.col("d") / F.size("evidence_ids")).alias("dominant_publisher_share")).alias("metrics"))
    out = Q.record_contract(r)
    return explode_rows(out.select("violations"), "violation", "violations").groupBy("violation").agg(F.count("*").alias("records"))


@query("f11_value_rules", """SELECT o_orderkey, 'enum:o_orderstatus' AS violation FROM orders WHERE o_orderstatus NOT IN ('F','O')
UNION ALL SELECT o_orderkey, 'minimum:o_totalprice' FROM orders WHERE o_totalprice < 20000
UNION ALL SELECT o_orderkey, 'null:o_orderdate' FROM orders WHERE o_orderdate IS NULL""")
def f11(spark, sf):
    o = table(spark, sf, "orders")
    assert not Q.schema_gaps(o, {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"})
    return Q.value_gaps(o, "o_orderkey", ["o_orderdate"], {"o_orderstatus": ["F", "O"]}, {"o_totalprice": 20000.0})


@query("f13_case_links", """WITH l AS (SELECT l_suppkey AS case_id, l_partkey AS e, l_returnflag AS r, l_orderkey AS ev FROM lineitem),
d AS (SELECT DISTINCT case_id, 'repeated-evidence' AS violation FROM (SELECT case_id, e FROM l GROUP BY 1, 2 HAVING count(*) > 1)),
k AS (SELECT case_id, count(DISTINCT CASE WHEN r = 'A' THEN ev END) AS n, count_if(r = 'N') AS c FROM l GROUP BY 1),
m AS (SELECT case_id, 'events-mismatch' AS violation FROM k WHERE n <> 100),
x AS (SELECT case_id, 'artifacts-mismatch' AS violation FROM k WHERE n <> 100),
z AS (SELECT DISTINCT case_id, 'exclusion-without-reason' AS violation FROM l WHERE r = 'R')
SELECT violation, count(*) AS cases FROM (SELECT * FROM d UNION ALL SELECT * FROM m UNION ALL SELECT * FROM x UNION ALL SELECT * FROM z) GROUP BY 1""")
def f13(spark, sf):
    li = table(spark, sf, "lineitem")
    rel = F.when(F.col("l_returnflag") == "A", "direct-support").when(F.col("l_returnflag") == "N", "counterevidence").otherwise("excluded")
    links = li.select(F.col("l_suppkey").alias("case_id"), F.col("l_partkey").alias("evidence_id"), F.col("l_orderkey").alias("event_id"),
                      rel.alias("relationship"), F.array(F.lit("technical_reality")).alias("dimensions"), F.lit("").alias("exclusion_reason"))
    ok = {**{d: "moderate" for d in C.DIMENSIONS}, "confidence": "moderate", "concentration": "low"}
    cases = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("case_id"), F.create_map(*[F.lit(x) for kv in ok.items() for x in kv]).alias("assessments"),
        F.lit(True).alias("counterevidence_reviewed"), F.lit(100).alias("qualifying_events"), F.lit(100).alias("technical_artifacts"))
    out = Q.case_link_checks(cases, links, table(spark, sf, "part").select(F.col("p_partkey").alias("id")))
    return out.groupBy("violation").agg(F.count("*").alias("cases"))


@query("f15_evidence_search", f"""WITH {EVC_SQL} SELECT id FROM cl WHERE contains(lower(title || ' ' || summary || ' ' || array_to_string(projects, ' ')), 'thea')
  AND list_contains(theme_ids, 'bonding') AND disposition = 'classified' AND source_id = 'src2' ORDER BY published_at DESC, id DESC LIMIT 100""")
def f15(spark, sf):
    from signalloom.plans.marts import search_evidence
    return search_evidence(classified(spark, sf), "THEA", source="src2", theme="bonding", disposition="classified").select("id")


@query("f16_theme_search", f"""WITH {demo.THEME_SQL}, {EVC_SQL}, n AS (SELECT t, count(*) AS c FROM (SELECT unnest(theme_ids) AS t FROM cl) GROUP BY 1)
SELECT thm.id, coalesce(c, 0) AS records FROM thm LEFT JOIN n ON t = thm.id WHERE contains(lower(name || ' ' || array_to_string(aliases, ' ')), 'que') OR contains(lower(name || ' ' || array_to_string(aliases, ' ')), 'ing')""")
def f16(spark, sf):
    from signalloom.plans.marts import search_themes
    counts = K.by_theme(classified(spark, sf)).groupBy("theme_id").agg(F.count("*").alias("records"))
    t = demo.themes(spark).join(counts, F.col("id") == F.col("theme_id"), "left").fillna({"records": 0})
    found = search_themes(t, "que").unionByName(search_themes(t, "ing")).dropDuplicates(["id"])
    return found.select("id", "records")


@query("f18_filter_options", f"""WITH {EV_SQL} SELECT source_type, count(DISTINCT source_id) AS sources, coalesce(list_position({demo._q(demo.CHANNELS)}, source_type), 999) AS position FROM ev GROUP BY 1""")
def f18(spark, sf):
    from signalloom.plans.marts import option_list
    return option_list(evidence(spark, sf), "source_type", demo.CHANNELS)


@query("f19_verification_families", f"""WITH {EV_SQL}, m AS (SELECT id, unnest(list_filter([
  CASE WHEN source_type IN ('company-directory') THEN 'formation' END,
  CASE WHEN source_type IN ('first-party-lab','practitioner-blog') AND (contains(replace(lower(title||' '||summary),'ß','ss'),'theaeati') OR contains(replace(lower(title||' '||summary),'ß','ss'),'oument')) THEN 'architecture' END,
  CASE WHEN source_id IN ('src1','src15') AND source_type = 'repository' THEN 'adoption' END], lambda x: x IS NOT NULL)) AS family FROM ev)
SELECT family, count(*) AS records, count(DISTINCT source_id) AS sources FROM m JOIN ev USING (id) GROUP BY 1""")
def f19(spark, sf):
    from signalloom.plans.marts import verification_hits
    return verification_hits(evidence(spark, sf), VERIFICATION_RULES).groupBy("family").agg(
        F.count("*").alias("records"), F.count_distinct("source_id").alias("sources"))


VERIFICATION_RULES = [
    {"id": "formation", "source_types": ["company-directory"]},
    {"id": "architecture", "source_types": ["first-party-lab", "practitioner-blog"], "terms": ["theaeati", "oument"]},
    {"id": "adoption", "source_ids": ["src1", "src15"], "source_types": ["repository"]},
]


# ---- classification ---------------------------------------------------------------------------

@query("t01_theme_classifier", f"""WITH {EV_SQL}, {demo.TM_SQL} SELECT id, array_to_string(theme_ids, ',') AS theme_ids FROM tm""")
def t01(spark, sf):
    e = evidence(spark, sf)
    return e.select("id", F.array_join(K.theme_ids(K.haystack(e), demo.keyword_rules()), ",").alias("theme_ids"))


@query("t02_dispositions", f"""WITH {EVC_SQL} SELECT id, array_to_string(theme_ids, ',') AS theme_ids, disposition, rule_id FROM cl""")
def t02(spark, sf):
    return stages.classify(spark, sf).select("id", F.array_join("theme_ids", ",").alias("theme_ids"), "disposition", "rule_id")


# ---- de-duplication ---------------------------------------------------------------------------

@query("d01_keep_first", f"""WITH {EV_SQL} SELECT id FROM ev QUALIFY row_number() OVER (PARTITION BY curl, ftitle ORDER BY doc_id) = 1""")
def d01(spark, sf):
    return dedup.keep_first(evidence(spark, sf), [F.col("doc_id")]).select("id")


@query("d02_field_merge", """SELECT doc_id, CASE WHEN quality IS NOT NULL THEN 'reviewed ' || lang ELSE md5(text) END AS title,
  CASE WHEN quality IS NOT NULL THEN 'kind=doc,quality=' || quality ELSE 'kind=doc' END AS metadata FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)""")
def d02(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("doc_id").alias("id"), "lang", F.md5("text").alias("title"), F.create_map(F.lit("kind"), F.lit("doc")).alias("metadata"))
    lab = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    rev = lab.join(d.select("doc_id", "lang"), "doc_id").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("reviewed "), "lang").alias("title"),
        F.create_map(F.lit("kind"), F.lit("label"), F.lit("quality"), F.col("q").cast("string")).alias("metadata"))
    out = dedup.merge_fields(d, rev, ["title"])
    return out.select("doc_id", "title", F.array_join(F.transform(F.map_entries("metadata"), lambda m: F.concat_ws("=", m["key"], m["value"])), ",").alias("metadata"))


D03_SQL = f"""ranked AS (SELECT el.id, event_key, curl, md5(ftitle) AS tk, ts, row_number() OVER (ORDER BY
   coalesce(nullif(list_position({demo._q(C.PREFERRED_CHANNELS)}, s.channel), 0), 15), ts::DATE DESC, el.id) AS n FROM el JOIN src s ON s.id = source_id WHERE reason IS NULL),
walk AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS ids, []::VARCHAR[] AS evs, []::VARCHAR[] AS urls, []::VARCHAR[] AS tks, []::TIMESTAMP[] AS tss, NULL::VARCHAR AS id, NULL::VARCHAR AS dup
  UNION ALL SELECT r.n,
   CASE WHEN d IS NULL THEN list_append(ids, r.id) ELSE ids END, CASE WHEN d IS NULL THEN list_append(evs, r.event_key) ELSE evs END,
   CASE WHEN d IS NULL THEN list_append(urls, r.curl) ELSE urls END, CASE WHEN d IS NULL THEN list_append(tks, r.tk) ELSE tks END,
   CASE WHEN d IS NULL THEN list_append(tss, r.ts) ELSE tss END, r.id, d
  FROM (SELECT w.ids, w.evs, w.urls, w.tks, w.tss, r, list_filter(range(1, len(w.ids) + 1), lambda i: w.evs[i] = r.event_key OR w.urls[i] = r.curl
      OR (w.tks[i] = r.tk AND abs(epoch(w.tss[i]) - epoch(r.ts)) <= 7 * 86400))[1] AS k, w.ids[k] AS d
    FROM walk w JOIN ranked r ON r.n = w.n + 1) q)"""


@query("d03_event_duplicates", f"""WITH RECURSIVE {EVC_SQL}, {ELIG_SQL}, {D03_SQL}
SELECT id, coalesce(dup, '') AS duplicate_of FROM walk WHERE id IS NOT NULL""")
def d03(spark, sf):
    from signalloom.session import cut_lineage
    e = Q.eligibility(classified(spark, sf).drop("doc_id", "ts"), demo.sources(spark), demo.AS_OF).filter("reason is null")
    kept, dropped = Q.duplicate_events(cut_lineage(e, "eligible"))
    return kept.select("id", F.lit("").alias("duplicate_of")).unionByName(dropped)


@query("d04_echo_collapse", f"""WITH {EV_SQL}, k AS (SELECT id, lang, CASE WHEN len(arts) > 0 THEN arts[1] ELSE curl END AS key,
  CASE WHEN source_type = 'repository' THEN 4 WHEN len(arts) > 0 THEN 2 ELSE 0 END AS st FROM ev)
SELECT lang, key, arg_max(id, (st, id)) AS id, count(*) > 1 AS collapsed FROM k GROUP BY 1, 2""".replace("count(*) > 1 AS collapsed", "true AS kept"))
def d04(spark, sf):
    from signalloom.operators.pulse import strength
    e = evidence(spark, sf).select("*", V.echo_key().alias("key"), F.get("tags", F.lit(0)).alias("lang"), strength().alias("st"))
    out = dedup.keep_strongest(e, ["lang", "key"], F.col("st"))
    return out.select("lang", F.expr("substring(key, 5)").alias("key"), "id", F.lit(True).alias("kept"))


@query("d05_message_titles", r"""WITH t AS (SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS title, role = 'system' AS sponsored FROM conversations)
SELECT conv_id, md5(replace(lower(title), 'ß', 'ss')) AS key, md5(arg_min(title, turn)) AS title_hash, bool_or(sponsored) AS sponsored FROM t GROUP BY 1, 2""")
def d05(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", X.compact(F.col("text")).alias("title"), (F.col("role") == "system").alias("sponsored"))
    return c.groupBy("conv_id", F.md5(X.folded_title(F.col("title"))).alias("key")).agg(
        F.md5(F.min_by("title", "turn")).alias("title_hash"), F.bool_or("sponsored").alias("sponsored"))


@query("d09_last_and_first", """SELECT user_id, arg_max(event_type, event_id) AS last_type, arg_min(event_type, event_id) AS first_type FROM events GROUP BY 1""")
def d09(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_type"), F.min_by("event_type", "event_id").alias("first_type"))


# ---- joins ------------------------------------------------------------------------------------

@query("j01_source_lookup", f"""WITH {EV_SQL} SELECT coalesce(publisher_id, source_id) AS publisher_id, s.id IS NULL AS unknown, count(*) AS records FROM ev LEFT JOIN src s ON s.id = source_id GROUP BY 1, 2""")
def j01(spark, sf):
    s = demo.sources(spark).select(F.col("id").alias("source_id"), "publisher_id", F.lit(True).alias("known"))
    e = evidence(spark, sf).join(s, "source_id", "left")
    return e.groupBy(F.coalesce("publisher_id", F.col("source_id")).alias("publisher_id"), F.col("known").isNull().alias("unknown")).agg(F.count("*").alias("records"))


@query("j02_theme_explode", f"""WITH {EVC_SQL} SELECT id, unnest(theme_ids) AS theme_id FROM cl""")
def j02(spark, sf):
    return K.by_theme(classified(spark, sf)).select("id", "theme_id")


J4_SQL = """em AS (SELECT ev.id, evd.id AS event_id FROM ev, evd WHERE list_contains(evd.source_ids, ev.source_id) OR curl = evd.official_url
  OR (ts BETWEEN s - INTERVAL 45 DAY AND e + to_days(list_max(wins)) AND len(list_filter(aliases, lambda a: length(a) >= 6 AND contains(hay, a))) > 0)),
e1 AS (SELECT ev.*, coalesce(x.event_ids, []::VARCHAR[]) AS event_ids FROM ev LEFT JOIN (SELECT id, list_sort(list(DISTINCT event_id)) AS event_ids FROM em GROUP BY 1) x USING (id))"""
J5_SQL = """ak AS (SELECT DISTINCT key, event_id FROM (
   SELECT unnest(list_concat(['u:' || curl], list_transform(arts, lambda a: 'u:' || a), list_transform(projects, lambda p: 'p:' || p),
     CASE WHEN source_type = 'repository' AND length(ftitle) >= 6 THEN ['t:' || ftitle] ELSE []::VARCHAR[] END)) AS key, event_ids FROM e1 WHERE len(event_ids) > 0), unnest(event_ids) u(event_id)),
pk AS (SELECT id, ts, unnest(list_concat(['u:' || curl], list_transform(projects, lambda p: 'p:' || p), CASE WHEN length(ftitle) >= 6 THEN ['t:' || ftitle] ELSE []::VARCHAR[] END)) AS key FROM e1),
h AS (SELECT DISTINCT pk.id, ak.event_id FROM pk JOIN ak USING (key) JOIN evd ON evd.id = ak.event_id WHERE ts BETWEEN s AND e + to_days(list_max(wins))),
e2 AS (SELECT e1.* EXCLUDE (event_ids), list_sort(list_distinct(list_concat(e1.event_ids, coalesce(x.l, []::VARCHAR[])))) AS event_ids FROM e1 LEFT JOIN (SELECT id, list(event_id) AS l FROM h GROUP BY 1) x USING (id))"""


def event_rules() -> list[dict]:
    names = demo.EVENT_SCHEMA.replace(",", "").split()[::2]
    return [dict(zip(names, e)) for e in demo.EVENTS]


@query("j04_event_alias_join", f"""WITH {EV_SQL}, {EVD_SQL}, {J4_SQL} SELECT id, array_to_string(event_ids, ',') AS event_ids FROM e1""")
def j04(spark, sf):
    return V.attach_events(evidence(spark, sf), event_rules()).select("id", F.array_join("event_ids", ",").alias("event_ids"))


@query("j05_event_artifacts", f"""WITH {EV_SQL}, {EVD_SQL}, {J4_SQL}, {J5_SQL} SELECT id, array_to_string(event_ids, ',') AS event_ids FROM e2""")
def j05(spark, sf):
    first = V.attach_events(evidence(spark, sf), event_rules())
    return V.attach_by_artifact(first, event_rules()).select("id", F.array_join("event_ids", ",").alias("event_ids"))


PROJ_SQL = """proj AS (SELECT DISTINCT p_name AS name, 'https://example.org/none/' || p_name AS official FROM part
  UNION SELECT DISTINCT named, max(curl) FROM (SELECT projects[1] AS named, curl FROM ev WHERE len(projects) > 0 AND source_type = 'paper') GROUP BY named)"""


def projects(spark, sf):
    e = evidence(spark, sf)
    parts = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.concat(F.lit("https://example.org/none/"), "p_name").alias("official_url")).distinct()
    named = e.filter((F.size("projects") > 0) & (F.col("source_type") == "paper")).groupBy(F.get("projects", F.lit(0)).alias("name")).agg(
        F.max(X.canonical_url(F.col("url"))).alias("official_url"))
    return parts.unionByName(named)


@query("j06_project_match", f"""WITH {EV_SQL}, {PROJ_SQL} SELECT DISTINCT name, ev.id FROM proj, ev WHERE official = curl OR contains(ftitle, lower(name)) OR contains(array_to_string(projects, ' '), lower(name))""")
def j06(spark, sf):
    return V.match_projects(projects(spark, sf), evidence(spark, sf)).select("name", "id")


@query("j07_related_repositories", f"""WITH {EV_SQL}, r AS (SELECT id, coalesce(projects[1], title) AS pn, curl, source_id FROM ev WHERE source_type = 'repository')
SELECT r.id, count(*) AS related_count, string_agg(DISTINCT c.source_id, ',' ORDER BY c.source_id) AS source_ids FROM r JOIN ev c ON c.id = r.id OR c.curl = r.curl OR list_contains(c.projects, r.pn) GROUP BY 1""")
def j07(spark, sf):
    e = evidence(spark, sf)
    none = e.select("id").filter(F.lit(False))
    return V.related_repositories(e, none).select("id", "related_count", F.array_join("source_ids", ",").alias("source_ids"))


@query("j14_shared_anchor_pairs", """WITH a AS (SELECT DISTINCT l_orderkey AS d, l_suppkey AS a FROM lineitem)
SELECT x.a AS left_id, y.a AS right_id, count(*) AS shared FROM a x JOIN a y ON x.d = y.d AND x.a < y.a GROUP BY 1, 2 HAVING count(*) >= 20""".replace(">= 20", ">= 2"))
def j14(spark, sf):
    return shared_pairs(table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey"))


def shared_pairs(li, rows_a_task: int = 131072):
    """Pairs of suppliers of one order that two orders share. The tasks grow in number with the rows, on both sides of the
    pairs, so what one of them holds does not; shuffles of small rows would be coalesced into few tasks of many pairs."""
    tasks = max(li.sparkSession.sparkContext.defaultParallelism, -(-li.count() // rows_a_task))
    li = li.repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("a"))
    left = li.select("a", F.posexplode("a").alias("i", "left_id"))
    pairs = left.select("left_id", F.explode(F.slice("a", F.col("i") + 2, F.size("a"))).alias("right_id"))
    return pairs.repartition(tasks, "left_id", "right_id").groupBy("left_id", "right_id").agg(F.count("*").alias("shared")).filter("shared >= 2")


@query("j16_grouped_lookup", """SELECT l_partkey AS target_id, count(*) AS proposals, count(DISTINCT l_suppkey) AS evidence FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def j16(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey")), "l_partkey")
    return li.groupBy(F.col("l_partkey").alias("target_id")).agg(F.count("*").alias("proposals"), F.count_distinct("l_suppkey").alias("evidence"))
