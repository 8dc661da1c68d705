"""XML feeds and sitemaps (S5-S7). Each payload is one row; parsing never leaves the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import dates as D, text as X
from signalloom.operators.classify import url_in_scope
from signalloom.session import cut_lineage

RSS_ITEM = "title string, link string, guid string, pubDate string, description string, `dc:creator` string, author string"
ATOM_ENTRY = (
    "id string, title string, link array<struct<_href:string,_rel:string>>, published string, updated string, summary string, "
    "content string, author array<struct<name:string>>, category array<struct<_term:string>>")


def elements(payload: Column, tag: str) -> Column:
    """Source text of every `tag` element."""
    return F.regexp_extract_all(payload, F.lit(rf"(?s)<{tag}[\s>].*?</{tag}>"), F.lit(0))


def bare(col: Column) -> Column:
    """Element text with CDATA marks removed."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")


def _first(*cols: Column) -> Column:
    return F.coalesce(*[F.when(F.coalesce(c, F.lit("")) != "", c) for c in cols], F.lit(""))


def plain_attributes(xml: Column, *tags: str) -> Column:
    """Drop the attributes of simple elements so that they read as text."""
    out = xml
    for tag in tags:
        out = F.regexp_replace(out, rf"<{tag}\s[^>]*>", f"<{tag}>")
    return out


def first(items: Column, limit: int | None) -> Column:
    """The first items of a list, all of them where no limit is given."""
    return items if limit is None else F.slice(items, 1, limit)


def rss_items(df: DataFrame, payload: str, limit: int | None = None) -> DataFrame:
    """RSS items of each feed payload (S5): needs source_id, source_type and the payload column; `limit` counts per payload."""
    rows = df.select("source_id", "source_type", F.explode(first(elements(F.col(payload), "item"), limit)).alias("x"))
    xml = plain_attributes(F.col("x"), "item", "guid", "description", "title", "dc:creator")
    r = rows.select("source_id", "source_type", F.from_xml(xml, RSS_ITEM).alias("r")).select("source_id", "source_type", "r.*")
    url = X.compact(F.col("link"))
    stamp = D.parse_timestamp(F.col("pubDate"))
    author = X.compact(_first(F.col("`dc:creator`"), F.col("author")))
    return _items(r, X.compact(F.col("title")), url, F.coalesce(
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.col("pubDate"), F.lit("")), F.col("description"), author, _first(F.col("guid"), url))


def atom_items(df: DataFrame, payload: str, limit: int | None = None) -> DataFrame:
    """Atom entries of each feed payload."""
    r = _entries(df, payload, limit)
    url = F.trim(F.coalesce(F.get("link", F.lit(0))["_href"], F.lit("")))
    author = X.compact(F.get("author", F.lit(0))["name"])
    return _items(r, X.compact(F.col("title")), url, _first(F.col("published"), F.col("updated")),
                  _first(F.col("summary"), F.col("content")), author, _first(F.col("id"), url))


def _entries(df: DataFrame, payload: str, limit: int | None) -> DataFrame:
    rows = df.select("source_id", "source_type", F.explode(first(elements(F.col(payload), "entry"), limit)).alias("x"))
    xml = plain_attributes(F.col("x"), "entry", "title", "summary", "content")
    return rows.select("source_id", "source_type", F.from_xml(xml, ATOM_ENTRY).alias("r")).select("source_id", "source_type", "r.*")


def _items(r: DataFrame, title: Column, url: Column, published: Column, summary: Column, author: Column, key: Column) -> DataFrame:
    out = r.select(
        F.concat("source_id", F.lit(":"), F.substring(F.sha2(key, 256), 1, 20)).alias("id"), "source_id", "source_type", title.alias("title"),
        url.alias("url"), published.alias("published_at"), X.strip_tags(summary).alias("summary"),
        F.when(author != "", F.array(author)).otherwise(F.array().cast("array<string>")).alias("authors"))
    return out.filter((F.col("title") != "") & (F.col("url") != ""))


def paper_entries(df: DataFrame, payload: str, limit: int | None = None) -> DataFrame:
    """Paper-API entries with author and category lists."""
    r = _entries(df, payload, limit)
    url = X.compact(F.col("id"))
    key = F.when(F.substring_index(url, "/", -1) != "", F.substring_index(url, "/", -1)).otherwise(F.substring(F.sha2(url, 256), 1, 16))
    none = F.array().cast("array<string>")
    return r.select(
        F.concat("source_id", F.lit(":"), key).alias("id"), "source_id", F.lit("paper").alias("source_type"), X.compact(F.col("title")).alias("title"),
        url.alias("url"), X.compact(F.col("published")).alias("published_at"), X.compact(F.col("summary")).alias("summary"),
        F.coalesce(F.transform("author", lambda a: X.compact(a["name"])), none).alias("authors"),
        F.coalesce(F.transform("category", lambda c: c["_term"]), none).alias("tags"))


def sitemap_urls(df: DataFrame, payload: str, keep: list[str] | None = None) -> DataFrame:
    """(loc, lastmod, child) of url elements beside the kept columns; child sitemaps are marked."""
    loc = X.compact(X.unescape(F.regexp_extract("x", r"(?s)<loc>(.*?)</loc>", 1)))
    mod = X.compact(F.regexp_extract("x", r"(?s)<lastmod>(.*?)</lastmod>", 1))
    one = lambda tag: df.select(*(keep or []), F.explode(elements(F.col(payload), tag)).alias("x"))
    urls = one("url").select(*(keep or []), loc.alias("loc"), mod.alias("lastmod"), F.lit(False).alias("child"))
    maps = one("sitemap").select(*(keep or []), loc.alias("loc"), F.lit("").alias("lastmod"), F.lit(True).alias("child"))
    return urls.unionByName(maps).filter("loc <> ''")


def expand_sitemaps(files: DataFrame, roots: DataFrame, depth: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages below each root sitemap, through indexes of indexes, and the sitemaps that gave none.

    files: url, payload of every landed sitemap; roots: url. Pages: (root, sitemap, loc, lastmod); unread:
    (root, sitemap, reason), reason `missing` where no file landed and `too-deep` below `depth` levels of
    children. Files are parsed once; a step joins the sitemaps just found with the parsed links, so there are
    as many steps as the tree is deep. A sitemap counts once per root, so an index that leads back to itself
    ends there.
    """
    links = cut_lineage(sitemap_urls(files.select("url", "payload"), "payload", ["url"]), "sitemaps")
    landed = files.select(F.col("url").alias("sitemap")).distinct()
    children = links.filter("child").select(F.col("url").alias("parent"), F.col("loc").alias("sitemap")).distinct()
    found = cut_lineage(roots.select(F.col("url").alias("root"), F.col("url").alias("sitemap"), F.lit(0).alias("level")).distinct(), "frontier")
    seen, level = found, 0
    while not found.isEmpty():
        level += 1
        below = found.select("root", F.col("sitemap").alias("parent")).join(children, "parent").select("root", "sitemap").distinct()
        found = cut_lineage(below.join(seen, ["root", "sitemap"], "left_anti").withColumn("level", F.lit(level)), "frontier")
        seen = seen.unionByName(found)
        if depth is not None and level > depth:
            break
    near = F.lit(True) if depth is None else F.col("level") <= depth
    pages = seen.filter(near).join(links.filter("not child").withColumnRenamed("url", "sitemap"), "sitemap").select("root", "sitemap", "loc", "lastmod")
    gone = seen.filter(near).join(landed, "sitemap", "left_anti").select("root", "sitemap", F.lit("missing").alias("reason"))
    deep = seen.filter(~near).select("root", "sitemap", F.lit("too-deep").alias("reason"))
    return pages, gone.unionByName(deep)


def newest_urls(urls: DataFrame, prefixes: list[str], patterns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Pages in scope (S7, F3) of sitemap_urls or of expand_sitemaps: all, or with a `limit` the newest."""
    live = urls.filter("not child") if "child" in urls.columns else urls
    live = live.filter(url_in_scope(F.col("loc"), prefixes, patterns)).select("loc", "lastmod")
    live = live.orderBy(F.desc("lastmod"), F.desc("loc"))
    return live if limit is None else live.limit(limit)
