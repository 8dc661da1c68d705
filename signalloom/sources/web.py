"""HTML pages: links, metadata, galleries, proceedings, forms and newsletters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import constants as C, text as X
from signalloom.operators.ranking import first_per_group
from signalloom.sources.rows import evidence_rows

ANCHOR = r"(?is)<a\b[^>]*>.*?</a>"


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute inside the opening tag, entities resolved; empty when absent."""
    head = F.regexp_extract(tag, r"(?s)^<[^>]*>", 0)
    return X.unescape(F.coalesce(
        F.nullif(F.regexp_extract(head, rf'(?is)\s{name}\s*=\s*"([^"]*)"', 1), F.lit("")),
        F.nullif(F.regexp_extract(head, rf"(?is)\s{name}\s*=\s*'([^']*)'", 1), F.lit("")), F.lit("")))


def join_url(base: Column, href: Column) -> Column:
    """Absolute form of a link; `.` and `..` segments are resolved."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.when(F.contains(path, F.lit("/")), F.regexp_extract(path, r"^(.*/)[^/]*$", 1)).otherwise(F.lit("/"))
    bare_base = F.substring_index(base, "#", 1)
    full = (F.when(href == "", bare_base)
            .when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, href))
            .when(href.startswith("/"), F.concat(origin, href))
            .when(href.startswith("#"), F.concat(bare_base, href))
            .when(href.startswith("?"), F.concat(origin, path, href))
            .otherwise(F.concat(origin, folder, href)))
    return F.regexp_replace(F.regexp_replace(full, r"/(?:\./)+", "/"), r"/[^/]+/\.\./", "/")


def index_links(pages: DataFrame, html: str, url: str, key: str) -> DataFrame:
    """Links of each page with label or text (S8): per target the first non-empty title, else empty.

    Extraction and choice stay inside the page row: links of one page are folded by array functions,
    so a page with very many links needs no shuffle of its own.
    """
    anchors = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0))

    def link(a: Column, i: Column) -> Column:
        label = F.coalesce(F.nullif(attribute(a, "aria-label"), F.lit("")), F.nullif(attribute(a, "title"), F.lit("")))
        text = F.coalesce(label, X.unescape(F.regexp_replace(a, "(?s)<[^>]*>", " ")))
        return F.struct(attribute(a, "href").alias("href"), X.compact(text).alias("title"), i.alias("pos"))

    rows = pages.select(key, F.col(url).alias("base"), F.explode(F.transform(anchors, link)).alias("l")).select(key, "base", "l.*").filter("href <> ''")
    rows = rows.withColumn("url", F.substring_index(join_url(F.col("base"), F.col("href")), "#", 1))
    best = F.min(F.struct((F.col("title") == "").alias("e"), "pos", "title"))
    return rows.groupBy(key, "url").agg(F.min("pos").alias("pos"), best["title"].alias("title"))


def _meta(html: Column, name: str, *keys: str) -> Column:
    """Content of the matching meta tags, in page order."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))

    def wanted(t: Column) -> Column:
        k = F.lower(F.coalesce(F.nullif(attribute(t, "property"), F.lit("")), attribute(t, "name")))
        return k.isin(*keys) & (attribute(t, "content") != "")
    return F.transform(F.filter(tags, wanted), lambda t: X.compact(attribute(t, "content")))


def page_metadata(html: Column, references: dict[str, str] | None = None) -> Column:
    """Struct of title, description and published_at.

    Title: last og:title, else the title element, else the JSON-LD headline. Description: first
    description tag, else JSON-LD. Date: last date meta tag, else the first time element, else JSON-LD.
    All character references of the title element are decoded, or the given `references` alone.
    """
    ld = F.regexp_extract(html, r"""(?is)<script\b[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>""", 1)
    field = lambda f: X.compact(F.coalesce(F.get_json_object(ld, f"$.{f}"), F.get_json_object(ld, f"$[0].{f}")))
    times = F.regexp_extract_all(html, F.lit(r"(?is)<time\b[^>]*>"), F.lit(0))
    stamps = F.filter(F.transform(times, lambda t: X.compact(attribute(t, "datetime"))), lambda v: v != "")
    named = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1)
    decoded = X.unescape(named) if references is None else reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), references.items(), named)
    element = X.compact(decoded)
    pick = lambda *c: F.coalesce(*[F.when(F.coalesce(x, F.lit("")) != "", x) for x in c], F.lit(""))
    return F.struct(
        pick(F.try_element_at(_meta(html, "t", "og:title"), F.lit(-1)), element, field("headline")).alias("title"),
        pick(F.get(_meta(html, "d", "description", "og:description"), F.lit(0)), field("description")).alias("description"),
        pick(F.try_element_at(_meta(html, "p", "article:published_time", "date", "datepublished"), F.lit(-1)), F.get(stamps, F.lit(0)),
             field("datePublished")).alias("published_at"))


def page_items(pages: DataFrame, html: str, url: str, source_id: str, source_type: str) -> DataFrame:
    """Pages as evidence rows, the title falling back to the URL."""
    m = pages.withColumn("m", page_metadata(F.col(html)))
    return m.select(
        F.concat(F.lit(f"{source_id}:"), F.substring(F.sha2(url, 256), 1, 20)).alias("id"), F.lit(source_id).alias("source_id"),
        F.lit(source_type).alias("source_type"), F.when(F.col("m.title") != "", F.col("m.title")).otherwise(X.title_from_url(F.col(url))).alias("title"),
        F.col(url).alias("url"), F.col("m.published_at").alias("published_at"), F.col("m.description").alias("summary"))


def data_page(html: Column) -> Column:
    """First non-empty data-page attribute, entities resolved."""
    return X.unescape(F.regexp_extract(html, r'(?is)\sdata-page\s*=\s*"([^"]+)"', 1))


def proceedings(pages: DataFrame, html: str, terms: list[str], limit: int | None = None, source_id: str = "proceedings", event_id: str = "", base_url: str = "",
                published_at: str = "") -> DataFrame:
    """Paper links whose title holds any term (S17) as evidence with `href` beside: all, or with a `limit` the first by title."""
    anchors = F.filter(F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0)), lambda a: F.lower(attribute(a, "title")) == "paper title")
    rows = pages.select(F.explode(anchors).alias("a")).select(
        attribute(F.col("a"), "href").alias("href"), X.compact(X.unescape(F.regexp_replace("a", "(?s)<[^>]*>", " "))).alias("title"))
    rows = rows.filter((F.col("title") != "") & (F.col("href") != ""))
    if terms:
        hit = F.lit(False)
        for t in terms:
            hit = hit | F.contains(X.fold(F.col("title")), F.lit(t.lower()))
        rows = rows.filter(hit)
    rows = rows.orderBy(X.fold(F.col("title")), "href")
    rows = rows if limit is None else rows.limit(limit)
    url = join_url(F.lit(base_url), F.col("href"))
    given = {"id": X.stable_id(F.lit(source_id), F.lit(event_id), F.col("href")), "source_id": F.lit(source_id), "source_type": F.lit("event-paper"), "title": F.col("title"), "url": url,
             "published_at": F.lit(published_at), "tags": F.array(F.lit("event-paper"), F.lit("conference-proceedings")), "artifact_urls": F.array(url),
             "sponsor_status": F.lit("not-applicable"), "event_ids": F.array(F.lit(event_id))}
    return evidence_rows(rows, given, {"event_id": F.lit(event_id), "event_record_type": F.lit("paper"), "artifact_url": url}, ["href"])


def gallery(pages: DataFrame, html: str, page_no: str, limit: int | None = None, source_id: str = "gallery", event_id: str = "", published_at: str = "") -> DataFrame:
    """Gallery projects as evidence with `winner` beside: the last record of a URL wins (S18); with a `limit` winners first, then by title."""
    cards = F.filter(F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0)), lambda a: F.array_contains(
        F.split(F.regexp_replace(attribute(a, "class"), r"\s+", " "), " "), "link-to-software"))
    part = lambda tag: X.compact(X.unescape(F.regexp_replace(F.regexp_extract(F.col("a"), tag, 1), "(?s)<[^>]*>", " ")))
    rows = pages.select(F.col(page_no).alias("page"), F.posexplode(cards).alias("pos", "a")).select(
        "page", "pos", attribute(F.col("a"), "href").alias("url"), part(r"(?is)<h5\b[^>]*>(.*?)</h5>").alias("title"),
        part(r"""(?is)<p\b[^>]*class\s*=\s*["'][^"']*\btagline\b[^"']*["'][^>]*>(.*?)</p>""").alias("tagline"),
        F.col("a").rlike(r"""(?is)<img\b[^>]*alt\s*=\s*["']winner["']""").alias("winner"))
    last = rows.filter("title <> '' and url <> ''").groupBy("url").agg(F.max_by(F.struct("title", "tagline", "winner"), F.struct("page", "pos")).alias("r"))
    last = last.select("url", "r.*").orderBy(F.desc("winner"), X.fold(F.col("title")), "url")
    last = last if limit is None else last.limit(limit)
    given = {"id": X.stable_id(F.lit(source_id), F.lit(event_id), F.col("url")), "source_id": F.lit(source_id), "source_type": F.lit("hackathon-project"), "title": F.col("title"),
             "url": F.col("url"), "published_at": F.lit(published_at), "summary": F.col("tagline"), "tags": F.array(F.lit("hackathon-project"), F.when(F.col("winner"), "event-winner")),
             "projects": F.array("title"), "artifact_urls": F.array("url"), "sponsor_status": F.lit("hackathon-submission"), "event_ids": F.array(F.lit(event_id))}
    return evidence_rows(last, given, {"event_id": F.lit(event_id), "event_record_type": F.lit("project"), "winner": F.col("winner"), "artifact_url": F.col("url")}, ["winner"])


def form_fields(body: Column) -> Column:
    """Map of folded heading to value of a form written with `###` headings."""
    parts = F.filter(F.split(F.coalesce(body, F.lit("")), r"(?m)^###\s+"), lambda p: F.contains(p, F.lit("\n")))
    pairs = F.transform(parts, lambda p: F.struct(
        X.fold(F.trim(F.substring_index(p, "\n", 1))).alias("key"),
        X.compact(F.replace(F.regexp_replace(p, r"(?s)^[^\n]*\n", ""), F.lit("_No response_"), F.lit(""))).alias("value")))
    # a repeated heading overrides the earlier one
    return F.aggregate(pairs, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, x: F.map_concat(
        F.map_filter(m, lambda k, v: k != x["key"]), F.map_from_arrays(F.array(x["key"]), F.array(x["value"]))))


def form_links(issues: DataFrame, body: str, number: str) -> DataFrame:
    """Submitted social links from form issues, ready for the link contract."""
    f = issues.withColumn("f", form_fields(F.col(body)))
    value = lambda k: F.coalesce(F.try_element_at("f", F.lit(k)), F.lit(""))
    return f.select(
        F.concat(F.lit("social-link:issue-"), F.col(number)).alias("id"), X.fold(value("platform")).alias("platform"), value("public post url").alias("post_url"),
        value("author name").alias("author_name"), value("published date").alias("published_at"),
        F.when(value("event id") != "", F.array(value("event id"))).otherwise(F.array().cast("array<string>")).alias("event_ids"),
        value("original observation").alias("observation"),
        F.regexp_extract_all(value("linked public artifacts"), F.lit(r"https://[^\s,]+"), F.lit(0)).alias("linked_urls"))


TOKEN = "array<struct<text:string,href:string>>"


def link_tokens(html: Column) -> Column:
    """Text and link tokens of a message in order."""
    pieces = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*>.*?</a>|<[^>]+>|[^<]+"), F.lit(0))
    tokens = F.transform(pieces, lambda p: F.when(p.rlike(r"(?i)^<a\b"), F.struct(
        X.compact(X.unescape(F.regexp_replace(p, "(?s)<[^>]*>", " "))).alias("text"), attribute(p, "href").alias("href")))
        .when(~p.startswith("<"), F.struct(X.compact(X.unescape(p)).alias("text"), F.lit("").alias("href"))))
    return F.filter(tokens, lambda t: t.isNotNull() & (t["text"] != ""))


def sponsor_hrefs(tokens: Column) -> Column:
    """Links used more than once with a sponsor marker within two tokens before or one after.

    `tokens` must be a column of the frame, not an expression: it is read once per token.
    """
    spots = F.transform(tokens, lambda t, i: F.struct(t["href"].alias("href"), F.array_join(F.transform(
        F.slice(tokens, F.greatest(i - 1, F.lit(1)), F.least(i + 2, F.lit(4))), lambda x: x["text"]), " ").alias("near")))
    marked = F.filter(spots, lambda s: (s["href"] != "") & s["near"].rlike(C.SPONSOR_CONTEXT))
    return F.array_distinct(F.transform(F.filter(
        marked, lambda s: F.size(F.filter(tokens, lambda t: t["href"] == s["href"])) > 1), lambda s: s["href"]))


def editorial_items(messages: DataFrame, html: str, key: str, day: str, source_id: str, domain: str, collapse: bool = False) -> DataFrame:
    """Editorial newsletter titles (S22): own links only, good titles, distinct by folded title.

    With `collapse` a title contained in a longer one of its message goes to it (D6), which then counts it in
    `duplicate_count` and is sponsored if either is.
    """
    m = messages.withColumn("_t", link_tokens(F.col(html)))
    m = m.select(key, day, F.col("_t"), sponsor_hrefs(F.col("_t")).alias("_s"))
    rows = m.select(key, day, "_s", F.posexplode("_t").alias("pos", "t")).filter("t.href <> ''")
    rows = rows.filter(X.url_host(F.replace(F.col("t.href"), F.lit("&amp;"), F.lit("&"))).endswith(domain))
    rows = rows.withColumn("title", X.editorial_title(F.col("t.text"))).filter("title is not null")
    out = rows.groupBy(key, day, X.folded_title(F.col("title")).alias("_k")).agg(
        F.min_by("title", "pos").alias("title"), F.bool_or(F.array_contains("_s", F.col("t.href"))).alias("sponsored"))
    out = out.select(F.lit(source_id).alias("source_id"), key, day, "title", "sponsored")
    if not collapse:
        return out
    from signalloom.operators.dedup import collapse_titles
    kept = collapse_titles(out, ["source_id", key, day])
    return kept.select("source_id", key, day, "title", F.col("sponsor_seen").alias("sponsored"), "duplicate_count")


def issue_items(messages: DataFrame, html: str, key: str, subject: str, day: str, source_id: str, homepage: str) -> DataFrame:
    """Public links of a newsletter, one per distinct title; the issue itself where there is none."""
    rows = messages.select(key, subject, day, F.posexplode_outer(link_tokens(F.col(html))).alias("pos", "t"))
    title = F.when(F.coalesce(F.col("t.href"), F.lit("")) != "", X.generic_title(F.col("t.text")))
    rows = rows.withColumn("title", title).withColumn("url", F.when(F.col("title").isNotNull(), X.public_link(F.col("t.href"))))
    good = rows.filter("title is not null and url is not null")
    picked = first_per_group(good.withColumn("_k", X.folded_title(F.col("title"))), [key, "_k"], [F.col("pos")]).select(
        key, "title", "url", F.col(day).alias("published_at"), F.lit("public-link").alias("extraction"))
    whole = messages.join(good.select(key).distinct(), key, "left_anti").select(
        key, X.compact(F.coalesce(subject, F.lit("Untitled newsletter issue"))).alias("title"), F.lit(homepage).alias("url"),
        F.col(day).alias("published_at"), F.lit("issue-metadata").alias("extraction"))
    both = picked.unionByName(whole)
    return both.withColumn("id", X.stable_id(F.lit(source_id), F.lit(source_id), F.substring("published_at", 1, 10), X.folded_title(F.col("title"))))
