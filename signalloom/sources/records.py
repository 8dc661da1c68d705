"""JSON payloads of repositories, forums, papers, companies, jobs, programs and social feeds."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import constants as C, dates as D, text as X
from signalloom.operators.classify import topic_relevant
from signalloom.operators.ranking import first_per_group, numbered_top, top_per_group
from signalloom.sources.feeds import first
from signalloom.sources.rows import evidence_rows, filled

REPOSITORIES = (
    "items array<struct<id:bigint,full_name:string,html_url:string,description:string,created_at:string,pushed_at:string,"
    "stargazers_count:bigint,forks_count:bigint,topics:array<string>,owner:struct<login:string>,license:struct<spdx_id:string>>>")
POSTS = "id bigint, deleted boolean, dead boolean, url string, title string, text string, by string, time bigint, score bigint, descendants bigint"
PAPER = (
    "id string, paperId string, arxivId string, title string, publishedAt string, published_at string, summary string, abstract string, "
    "authors array<string>, upvotes bigint")
COMPANIES = (
    "props struct<companies:array<struct<id:bigint,slug:string,name:string,batch_name:string,one_liner:string,long_description:string,"
    "tags:array<string>,ycdc_status:string,team_size:bigint,location:string,github_url:string>>>")
JOBS = (
    "props struct<jobPostings:array<struct<id:bigint,title:string,role:string,prettyRole:string,roleSpecificType:string,companyOneLiner:string,"
    "companyName:string,companyBatchName:string,location:string,url:string,createdAt:string,skills:array<string>>>>")
SESSIONS = "sessions array<struct<title:string,description:string,track:string,type:string,day:string,time:string,speakers:array<string>>>"
FEED = (
    "feed array<struct<reason:struct<`$type`:string>,post:struct<uri:string,indexedAt:string,author:struct<did:string>,"
    "record:struct<text:string,createdAt:string,reply:string,embed:struct<external:struct<uri:string>>>,"
    "embed:struct<external:struct<uri:string>,media:struct<external:struct<uri:string>>,record:struct<value:struct<text:string>,record:struct<value:struct<text:string>>>>>>>")
REPOST = "app.bsky.feed.defs#reasonRepost"   # fixed value of the feed format


def _text(c) -> Column:
    return F.coalesce(c, F.lit(""))


def repositories(df: DataFrame, payload: str, source_id: str = "repositories", query_id: str | None = None) -> DataFrame:
    """Repository search results (S11) as evidence, with stars, forks and license beside."""
    r = df.select(F.explode(F.from_json(payload, REPOSITORIES)["items"]).alias("r")).select("r.*")
    r = r.withColumns({"stars": F.coalesce("stargazers_count", F.lit(0)), "forks": F.coalesce("forks_count", F.lit(0)), "license": F.col("license.spdx_id")})
    key = F.coalesce(F.col("id").cast("string"), F.substring(F.sha2("html_url", 256), 1, 16))
    given = {"id": F.concat(F.lit("repo:"), key), "source_id": F.lit(source_id), "source_type": F.lit("repository"), "title": F.col("full_name"), "url": F.col("html_url"),
             "published_at": F.col("created_at"), "summary": F.col("description"), "authors": F.array("owner.login"), "tags": F.col("topics"), "projects": F.array("full_name")}
    return evidence_rows(r, given, {"stars": F.col("stars"), "forks": F.col("forks"), "pushed_at": F.col("pushed_at"), "license": F.col("license"),
                                    "query_id": F.lit(query_id)}, ["stars", "forks", "license"])


def forum_posts(df: DataFrame, payload: str, feed_order: str, site: str) -> DataFrame:
    """Forum posts: distinct ids over the feeds, without deleted or dead ones."""
    r = df.select(F.col(feed_order).alias("_o"), F.from_json(payload, POSTS).alias("r")).select("_o", "r.*")
    r = first_per_group(r, ["id"], [F.col("_o")]).filter(~F.coalesce("deleted", F.lit(False)) & ~F.coalesce("dead", F.lit(False)))
    url = F.when(_text(F.col("url")) != "", F.col("url")).otherwise(F.concat(F.lit(f"{site}?id="), F.col("id")))
    stamp = F.date_format(F.timestamp_seconds(F.coalesce("time", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    title = X.compact(F.when(_text(F.col("title")) != "", F.col("title")).otherwise("Forum discussion"))
    return r.select(F.concat(F.lit("post:"), "id").alias("id"), F.lit("community").alias("source_type"), title.alias("title"), url.alias("url"),
                    stamp.alias("published_at"), X.compact(F.col("text")).alias("summary"), F.coalesce("score", F.lit(0)).alias("score"))


def papers(df: DataFrame, payload: str, site: str) -> DataFrame:
    """Curated papers; id, date and abstract come from alternate keys."""
    r = df.select(F.from_json(payload, PAPER).alias("r")).select("r.*")
    pick = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit("")) for x in c], F.lit(""))
    key = pick("id", "paperId", "arxivId")
    return r.withColumn("_k", key).filter("_k <> ''").select(
        F.concat(F.lit("paper:"), "_k").alias("id"), F.lit("paper-curation").alias("source_type"), F.coalesce("title", F.lit("Untitled paper")).alias("title"),
        F.concat(F.lit(site), "_k").alias("url"), pick("publishedAt", "published_at").alias("published_at"), pick("summary", "abstract").alias("summary"),
        F.filter(F.coalesce("authors", F.array().cast("array<string>")), lambda a: _text(a) != "").alias("authors"))


def companies(df: DataFrame, page_json: Column, today: str, site: str, limit: int | None = None, source_id: str = "companies") -> DataFrame:
    """Company directory page (S14); the date is the day first seen."""
    r = df.select(F.explode(first(F.from_json(page_json, COMPANIES)["props"]["companies"], limit)).alias("c")).select("c.*")
    r = r.filter(F.col("id").isNotNull() & (F.col("id") != 0) & (_text(F.col("slug")) != ""))
    name, batch = X.compact(F.col("name")), F.upper(X.compact(F.col("batch_name")))
    summary = F.regexp_replace(F.concat(X.compact(F.col("one_liner")), F.lit(". "), X.compact(F.col("long_description"))), r"^[ .]+|[ .]+$", "")
    tags = filled(F.transform(F.coalesce("tags", F.array().cast("array<string>")), X.compact))
    r = r.withColumn("date_basis", F.lit("first-observed"))
    given = {"id": F.concat(F.lit("company:"), "id"), "source_id": F.lit(source_id), "source_type": F.lit("company-directory"),
             "title": F.when(batch != "", F.concat(name, F.lit(" ("), batch, F.lit(")"))).otherwise(name), "url": F.concat(F.lit(site), "slug"), "published_at": F.lit(today),
             "summary": summary, "tags": F.when(batch != "", F.array_append(tags, F.concat(F.lit("batch:"), F.lower(batch)))).otherwise(tags), "projects": F.array(name),
             "sponsor_status": F.lit("first-party-directory")}
    return evidence_rows(r, given, {"batch": batch, "status": F.col("ycdc_status"), "team_size": F.col("team_size"), "location": F.col("location"),
                                    "github_url": F.col("github_url"), "date_basis": F.col("date_basis")}, ["date_basis"])


def jobs(df: DataFrame, page_json: Column, terms: list[str], today: str, site: str, limit: int | None = None, source_id: str = "jobs") -> DataFrame:
    """Job postings with a whole-word term in one of five fields (S15); a `limit` counts those that match."""
    r = df.select(F.explode(F.from_json(page_json, JOBS)["props"]["jobPostings"]).alias("j")).select("j.*")
    skills = F.coalesce("skills", F.array().cast("array<string>"))
    hay = F.concat_ws(" ", _text(F.col("title")), _text(F.col("role")), _text(F.col("roleSpecificType")), _text(F.col("companyOneLiner")), F.array_join(skills, " "))
    r = r.filter(hay.rlike(r"(?i)\b(?:" + "|".join(map(re.escape, terms)) + r")\b") & F.col("id").isNotNull() & (F.col("id") != 0))
    if limit is not None:
        r = r.orderBy("id").limit(limit)
    company, title, role = X.compact(F.col("companyName")), X.compact(F.col("title")), X.compact(F.coalesce(F.nullif("prettyRole", F.lit("")), "role"))
    place = X.compact(F.col("location"))
    url = F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit(f"{site}/jobs/"), "id"))
    told = filled(F.array(F.concat_ws(": ", F.nullif(company, F.lit("")), title), X.compact(F.col("companyOneLiner")), role, place, F.array_join(skills, ", ")))
    given = {"id": F.concat(F.lit("job:"), "id"), "source_id": F.lit(source_id), "source_type": F.lit("job-posting"),
             "title": F.when(company != "", F.concat(company, F.lit(": "), title)).otherwise(title), "url": F.when(url.startswith("/"), F.concat(F.lit(site), url)).otherwise(url),
             "published_at": D.relative_date(F.col("createdAt"), today), "summary": F.array_join(told, ". "),
             "tags": F.concat(F.array(F.lit("job-posting"), role), F.transform(skills, X.compact)), "projects": F.array(company), "sponsor_status": F.lit("first-party-job-board")}
    out = r.withColumn("_role", role)
    rows = evidence_rows(out, given, {"company": company, "batch": F.col("companyBatchName"), "role": role, "location": place, "created_at": F.col("createdAt"),
                                      "date_basis": F.lit("approximate-public-age")}, ["_role"])
    return rows.withColumnRenamed("_role", "role")


def program_sessions(df: DataFrame, payload: str, source_id: str, event_id: str, types: list[str], tracks: list[str], per_track: int | None = None, limit: int | None = None,
                     url: str = "", published_at: str = "") -> DataFrame:
    """Conference program (S16, W12): type and track lists; with caps, at most `per_track` per track, then `limit`.

    Caps run before the distinct on title and day. The track cap is a grouped top-k, the total a bounded top-n.
    """
    s = df.select(F.explode(F.from_json(payload, SESSIONS)["sessions"]).alias("s")).select("s.*")
    if types:
        s = s.filter(F.col("type").isin(*types))
    at = F.array_position(F.array(*[F.lit(t) for t in tracks]).cast("array<string>"), F.col("track"))
    if tracks:
        s = s.filter(at > 0)
    order = [at, _text(F.col("day")), _text(F.col("time")), _text(F.col("title"))]
    s = s.withColumn("track", F.coalesce("track", F.lit("Unassigned"))) if not tracks else s
    kept = s if per_track is None else top_per_group(s, ["track"], order, per_track).drop("rn")
    kept = kept.withColumn("_n", F.struct(*order)) if limit is None else numbered_top(kept, order, limit, "_n")
    title, day = X.compact(F.col("title")), X.compact(F.col("day"))
    kept = kept.withColumn("title", title).withColumn("day", day).filter("title <> ''")
    kept = first_per_group(kept.withColumn("_k", X.fold(F.col("title"))).withColumn("_d", X.fold(F.col("day"))), ["_k", "_d"], [F.col("_n")])
    track = X.compact(F.col("track"))
    given = {"id": X.stable_id(F.lit(source_id), F.lit(event_id), F.col("title"), F.col("day"), X.compact(F.col("time"))), "source_id": F.lit(source_id), "source_type": F.lit("event-session"),
             "title": F.col("title"), "url": F.lit(url), "published_at": F.lit(published_at), "summary": X.compact(F.col("description")),
             "authors": F.transform("speakers", X.compact), "tags": F.array(F.lit("event-program"), track, F.col("type")),
             "sponsor_status": F.when(F.col("type") == "sponsor", "sponsored-session").otherwise("organizer-program"), "event_ids": F.array(F.lit(event_id))}
    return evidence_rows(kept, given, {"event_id": F.lit(event_id), "event_record_type": F.lit("session"), "event_track": track, "event_day": F.col("day")}, ["track", "day"])


def social_posts(df: DataFrame, payload: str, terms: list[str], domains: list[str]) -> DataFrame:
    """Posts of an account feed (S20): own, not a repost or reply, without e-mail, on topic.

    Needs the columns did, handle and source_id of the account.
    """
    r = df.select("did", "handle", "source_id", F.explode(F.from_json(payload, FEED)["feed"]).alias("e"))
    p = r.select("did", "handle", "source_id", F.col("e.reason.`$type`").alias("reason"), F.col("e.post").alias("p"))
    p = p.filter((F.coalesce("reason", F.lit("")) != REPOST) & (F.col("p.author.did") == F.col("did")) & (_text(F.col("p.record.reply")) == ""))
    key = F.substring_index(F.col("p.uri"), "/", -1)
    quote = X.compact(F.coalesce(F.col("p.embed.record.record.value.text"), F.col("p.embed.record.value.text")))
    given = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit("")) for x in c], F.lit(""))
    link = given("p.embed.external.uri", "p.embed.media.external.uri", "p.record.embed.external.uri")
    p = p.select("did", "handle", "source_id", key.alias("key"), F.col("p.uri").alias("uri"), X.compact(F.col("p.record.text")).alias("text"), quote.alias("quote"),
                 link.alias("link"), given("p.record.createdAt", "p.indexedAt").alias("published_at"))
    p = p.withColumn("hay", X.compact(F.concat_ws(" ", "text", "quote"))).filter(
        (F.col("key") != "") & (F.col("key") != F.col("uri")) & (F.col("hay") != "") & ~F.col("hay").rlike(C.SENSITIVE_PATTERNS["email-address"]))
    p = p.filter(topic_relevant(F.col("hay"), F.col("link"), terms, domains))
    title = F.when(F.col("text") != "", F.col("text")).otherwise(F.col("quote"))
    summary = F.when((F.col("text") != "") & (F.col("quote") != ""), F.col("quote")).otherwise(F.lit(""))
    return p.select(
        F.concat(F.lit("social:"), F.substring(F.sha2("did", 256), 1, 12), F.lit(":"), "key").alias("id"), "source_id", F.lit("expert-social").alias("source_type"),
        X.clip(title, 200).alias("title"), F.concat(F.lit("https://bsky.app/profile/"), "handle", F.lit("/post/"), "key").alias("url"), "published_at",
        X.clip(summary, 160).alias("summary"))
