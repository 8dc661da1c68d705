"""Driver tables seen as evidence, with small rule tables, in Spark and in DuckDB SQL.

Evidence comes from `documents`: the title is the first line, the summary the whole rest of the text.
Every row and every character takes part. The rule tables below are parameters of the demonstration;
the operators take any others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalloom.functions import text as X
from signalloom.session import small_table

AS_OF = "2024-06-20T00:00:00Z"
AS_OF_SQL = "TIMESTAMP '2024-06-20 00:00:00'"

CHANNELS = [
    "paper", "repository", "first-party-lab", "community", "newsletter", "expert-social", "practitioner-blog",
    "operator-essay", "investor-essay", "company-directory", "job-posting", "paper-curation",
    "curated-newsletter", "expert-newsletter",
]
SOURCES = [
    # id, name, channel, publisher, enabled, collection; one source of the data has no row here
    (f"src{i}", f"Source {i:02d}", CHANNELS[i % 14], f"pub{i // 2}", i % 7 != 0 or i == 0,
     "manual" if i % 5 == 4 else "feed")
    for i in range(19)
]
SOURCE_SCHEMA = "id string, name string, channel string, publisher_id string, enabled boolean, collection string"

THEMES = [
    # id, name, aliases, terms, primary layer, secondary layer
    ("bonding", "Bonding tion", ["ndtion weave", "nttion"], ["ndtion", "nttion", "thintion"], "core", "tools"),
    ("harbor", "Harbor ings", ["inging"], ["inging", "thshing"], "edge", "core"),
    ("lattice", "Lattice eati", ["onbleea"], ["onbleea", "theaeati", "ouea"], "core", ""),
    ("meridian", "Meridian que", ["queque"], ["queque", "queeau", "eaueau"], "edge", "market"),
    ("orchard", "Orchard ment", ["lement"], ["lement", "aiment", "oument"], "market", "tools"),
    ("quarry", "Quarry lich", ["enlich"], ["enlich", "einlich", "erlich"], "tools", "edge"),
    ("summit", "Summit heit", ["enheit"], ["enheit", "enkeit", "erkeit"], "market", ""),
    ("tidal", "Tidal mente", ["nmente"], ["nmente", "osci", "esci"], "edge", "tools"),
    ("unseen", "Unseen theme", ["zzqx"], ["zzqx term"], "core", ""),
]
THEME_SCHEMA = (
    "id string, name string, aliases array<string>, terms array<string>, primary_layer string, secondary_layer string"
)
SCOPE_TERMS = ["that", "elle", "sich", "para"]
RULES = [
    {"id": "sponsored-placement", "source_ids": ["src3", "src4", "src5"], "sponsor_statuses": ["sponsored"],
     "precedence": "before-theme", "reason": "Sponsored placement."},
    {"id": "verification-only", "source_types": ["company-directory", "job-posting"], "reason": "Verification only."},
    {"id": "community-no-scope", "source_types": ["community"], "requires_no_scope_term": True,
     "reason": "No scope term."},
    {"id": "housekeeping", "source_types": ["newsletter", "first-party-lab", "paper"],
     "title_patterns": [r"^the and\b", r"\bthanea\.$", r"^theand [^\n]{0,20}\breing"], "reason": "Housekeeping."},
]
EVENTS = [
    # id, name, start, end, official url, aliases (six characters or more), sources, review windows
    ("winter-forum", "Winter Forum", "2024-01-20", "2024-01-25", "https://example.org/en/winter",
     ["thintion", "onbleea", "inn"], [], [30, 90]),
    ("spring-jam", "Spring Jam", "2024-04-10", "2024-04-12", "https://example.org/fr/spring",
     ["aiment", "oument"], ["src11"], [30, 90]),
    ("summer-meet", "Summer Meet", "2024-06-10", "2024-06-14", "https://example.org/de/summer",
     ["enlich", "erkeit"], ["src12"], [30, 90]),
    ("quiet-camp", "Quiet Camp", "2024-05-01", "2024-05-02", "https://example.org/es/quiet",
     ["zzqx camp"], [], [30]),
]
EVENT_SCHEMA = (
    "id string, name string, start_date string, end_date string, official_url string, aliases array<string>, "
    "source_ids array<string>, review_windows_days array<int>"
)


def prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when a table arrives in fewer splits than there are; large tables pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sources(spark: SparkSession) -> DataFrame:
    return small_table(spark, SOURCES, SOURCE_SCHEMA)


def themes(spark: SparkSession) -> DataFrame:
    return small_table(spark, THEMES, THEME_SCHEMA)


def events_dim(spark: SparkSession) -> DataFrame:
    return small_table(spark, EVENTS, EVENT_SCHEMA)


def keyword_rules() -> dict[str, list[str]]:
    return {t[0]: t[3] for t in THEMES}


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents"))
    first = F.substring_index("text", "\n", 1)
    channel = F.create_map(*[F.lit(v) for s in SOURCES for v in (s[0], s[2])])
    stamp = F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") * 1299709) % 15552000)
    named = F.regexp_extract(F.lower(first), "[a-z]{6,}", 0)
    base = d.select(
        "doc_id", "lang", F.col("source").alias("source_id"),
        F.coalesce(F.try_element_at(channel, F.col("source")), F.lit("unlisted")).alias("source_type"),
        X.compact(first).alias("title"),
        X.compact(F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)")).alias("summary"),
        "text", stamp.alias("ts"), named.alias("named"),
    )
    return base.select(
        F.concat(F.lit("doc:"), F.col("doc_id")).alias("id"), "doc_id", "source_id", "source_type",
        "title", "summary",
        F.concat(F.lit("https://example.org/"), F.col("lang"), F.lit("/"), F.md5(F.lower("title")), F.lit("/#"),
                 F.col("doc_id")).alias("url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"), "ts",
        F.array(F.col("lang"), F.concat(F.lit("desk-"), F.col("source_id"))).alias("tags"),
        F.when(F.col("named") != "", F.array("named")).otherwise(F.array().cast("array<string>")).alias("projects"),
        F.when(F.col("doc_id") % 13 == 0, "sponsored").when(F.col("doc_id") % 13 <= 2, "editorial")
        .otherwise("unknown").alias("sponsor_status"),
        F.create_map(F.lit("event_id"), F.md5("text")).alias("metadata"),
        F.when(F.col("source_type").isin("paper", "repository") & (F.col("named") != ""),
               F.array(F.concat(F.lit("https://art.example.org/"), F.col("named"), F.lit("/"))))
        .otherwise(F.array().cast("array<string>")).alias("artifact_urls"),
    )


def _q(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (list, tuple)):
        return "([" + ",".join(_q(x) for x in v) + "]::VARCHAR[])"
    if isinstance(v, int):
        return str(v)
    return "'" + v.replace("'", "''") + "'"


def values_sql(rows, columns: str) -> str:
    return f"(SELECT * FROM (VALUES {', '.join('(' + ','.join(_q(v) for v in r) + ')' for r in rows)}) v({columns}))"


SRC_SQL = f"src AS {values_sql(SOURCES, 'id,name,channel,publisher_id,enabled,collection')}"
THEME_SQL = f"thm AS {values_sql([t for t in THEMES], 'id,name,aliases,terms,primary_layer,secondary_layer')}"
EVD_SQL = (
    "evd AS (SELECT id, name, start_date::DATE::TIMESTAMP AS s, end_date::DATE::TIMESTAMP AS e, official_url, "
    "aliases, source_ids, wins FROM (VALUES "
    + ", ".join(
        f"({_q(r[0])},{_q(r[1])},{_q(r[2])},{_q(r[3])},{_q(r[4])},{_q(r[5])},{_q(r[6])},"
        + "[" + ",".join(map(str, r[7])) + "]::INT[])" for r in EVENTS
    )
    + ") v(id,name,start_date,end_date,official_url,aliases,source_ids,wins))"
)
# Evidence in SQL; the same columns as evidence().
EV_SQL = SRC_SQL + r""",
ev0 AS (SELECT doc_id, lang, source AS source_id, text, coalesce(s.channel,'unlisted') AS source_type,
  trim(regexp_replace(split_part(text, chr(10), 1), '\s+', ' ', 'g')) AS title,
  trim(regexp_replace(substr(text, length(split_part(text, chr(10), 1)) + 2), '\s+', ' ', 'g')) AS summary,
  TIMESTAMP '2024-01-01' + to_seconds((doc_id * 1299709) % 15552000) AS ts,
  regexp_extract(lower(split_part(text, chr(10), 1)), '[a-z]{6,}', 0) AS named
  FROM documents LEFT JOIN src s ON s.id = source),
ev AS (SELECT 'doc:' || doc_id AS id, doc_id, source_id, source_type, title, summary, lang,
  'https://example.org/' || lang || '/' || md5(lower(title)) || '/#' || doc_id AS url,
  'https://example.org/' || lang || '/' || md5(lower(title)) AS curl,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at, ts, [lang, 'desk-' || source_id] AS tags,
  CASE WHEN named <> '' THEN [named] ELSE []::VARCHAR[] END AS projects,
  CASE WHEN doc_id % 13 = 0 THEN 'sponsored' WHEN doc_id % 13 <= 2 THEN 'editorial' ELSE 'unknown' END AS sponsor_status,
  md5(text) AS event_key,
  CASE WHEN source_type IN ('paper','repository') AND named <> '' THEN ['https://art.example.org/' || named] ELSE []::VARCHAR[] END AS arts,
  replace(lower(title), 'ß', 'ss') AS ftitle,
  replace(lower(title || ' ' || summary || ' ' || lang || ' desk-' || source_id), 'ß', 'ss') AS hay
  FROM ev0)"""


def term_sql(terms) -> str:
    return "(^|[^a-z0-9])(" + "|".join(terms) + ")($|[^a-z0-9])"


# Theme matches per document in SQL: (id, theme_ids sorted).
TM_SQL = "tm AS (SELECT id, list_sort(list_filter([" + ",".join(
    f"CASE WHEN regexp_matches(hay, '{term_sql(t[3])}') THEN '{t[0]}' END" for t in THEMES
) + "], lambda x: x IS NOT NULL)) AS theme_ids FROM ev)"
_HOUSE = "|".join(RULES[3]["title_patterns"])
CL_SQL = TM_SQL + f""",
cl AS (SELECT ev.*, CASE WHEN pre THEN []::VARCHAR[] ELSE theme_ids END AS theme_ids,
  CASE WHEN pre THEN 'out-of-scope' WHEN len(theme_ids) > 0 THEN 'classified'
    WHEN source_type IN ('company-directory','job-posting') OR comm OR house THEN 'out-of-scope'
    ELSE 'classification-review' END AS disposition,
  CASE WHEN pre THEN 'sponsored-placement' WHEN len(theme_ids) > 0 THEN 'canonical-theme-match'
    WHEN source_type IN ('company-directory','job-posting') THEN 'verification-only'
    WHEN comm THEN 'community-no-scope' WHEN house THEN 'housekeeping' ELSE 'unresolved-review' END AS rule_id
  FROM (SELECT ev.id AS eid, theme_ids,
    ev.source_id IN ('src3','src4','src5') AND sponsor_status = 'sponsored' AS pre,
    source_type = 'community' AND NOT regexp_matches(hay, '{term_sql(SCOPE_TERMS)}') AS comm,
    source_type IN ('newsletter','first-party-lab','paper') AND regexp_matches(title, '(?i){_HOUSE}') AS house
    FROM ev JOIN tm USING (id)) f JOIN ev ON ev.id = f.eid)"""
EVC_SQL = EV_SQL + ",\n" + CL_SQL
