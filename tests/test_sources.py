"""Parsers on inline payloads, landed files and streams."""

from pyspark.sql import Row, functions as F

from signalloom.sources import feeds, landing, records, web
from signalloom.streaming import jobs


def payload(spark, text, **more):
    cols = [F.lit(v).alias(k) for k, v in {"source_id": "s", "source_type": "blog", **more}.items()]
    return spark.range(1).select(F.lit(text).alias("x"), *cols)


def test_rss(spark):
    xml = """<rss><channel><item><title>A  title</title><link>https://a.example/1</link><guid isPermaLink="false">g1</guid>
      <pubDate>Mon, 21 Sep 2026 10:00:00 +0000</pubDate><dc:creator>Ann</dc:creator><description><![CDATA[<p>Hi &amp; <b>bye</b></p>]]></description></item>
      <item><title></title><link>https://a.example/2</link></item></channel></rss>"""
    r = feeds.rss_items(payload(spark, xml), "x").collect()
    assert len(r) == 1 and (r[0].title, r[0].published_at, r[0].summary, r[0].authors) == ("A title", "2026-09-21T10:00:00+00:00", "Hi & bye", ["Ann"])


def test_sitemap(spark):
    xml = "<urlset><url><loc>https://a.example/blog/</loc></url><url><loc>https://a.example/blog/x-y</loc><lastmod>2026-01-02</lastmod></url></urlset><sitemapindex><sitemap><loc>https://a.example/s2.xml</loc></sitemap></sitemapindex>"
    urls = feeds.sitemap_urls(payload(spark, xml), "x")
    assert [r["loc"] for r in urls.filter("child").collect()] == ["https://a.example/s2.xml"]
    assert [r["loc"] for r in feeds.newest_urls(urls, ["https://a.example/blog/"]).collect()] == ["https://a.example/blog/x-y"]


def test_links_and_metadata(spark):
    html = """<a href="/p/one#x"> </a><a href='https://b.example/two' aria-label="Two">zzz</a><a href="/p/one">One <b>bold</b></a><a href="three?q=1">3</a>"""
    rows = web.index_links(payload(spark, html, url="https://a.example/dir/index.html", k="1"), "x", "url", "k").collect()
    assert {r.url: r.title for r in rows} == {"https://a.example/p/one": "One bold", "https://b.example/two": "Two", "https://a.example/dir/three?q=1": "3"}
    page = """<title>Plain</title><meta property="og:title" content="Open &amp; true"><meta name="description" content="D"><time datetime="2026-01-01"></time>"""
    m = payload(spark, page).select(web.page_metadata(F.col("x")).alias("m")).first().m
    assert (m.title, m.description, m.published_at) == ("Open & true", "D", "2026-01-01")
    item = web.page_items(payload(spark, "<p>x</p>", url="https://a.example/my_first-post/"), "x", "url", "s", "blog").first()
    assert item.title == "My First Post"


def test_program_cap(spark):
    js = """{"sessions":[{"title":"Eval one","track":"Evals","type":"talk","day":"1","time":"09"},{"title":"Eval two","track":"Evals","type":"talk","day":"1","time":"10"},
      {"title":"Route models","track":"Routing","type":"talk","day":"1","time":"11"},{"title":"Lunch","track":"Food","type":"talk"}]}"""
    r = records.program_sessions(payload(spark, js), "x", "c", "e", ["talk"], ["Evals", "Routing"], 1)
    assert sorted(x.title for x in r.collect()) == ["Eval one", "Route models"]


def test_social_feed(spark):
    js = """{"feed":[{"post":{"uri":"at://x/app/1","author":{"did":"d"},"record":{"text":"An LLM note","createdAt":"2026-01-01"}}},
      {"reason":{"$type":"app.bsky.feed.defs#reasonRepost"},"post":{"uri":"at://x/app/2","author":{"did":"d"},"record":{"text":"llm"}}},
      {"post":{"uri":"at://x/app/3","author":{"did":"d"},"record":{"text":"llm reply","reply":{"a":1}}}},{"post":{"uri":"at://x/app/4","author":{"did":"o"},"record":{"text":"llm"}}},
      {"post":{"uri":"at://x/app/5","author":{"did":"d"},"record":{"text":"llm mail a@b.org"}}},{"post":{"uri":"at://x/app/6","author":{"did":"d"},"record":{"text":"gardening"}}},
      {"post":{"uri":"at://x/app/7","author":{"did":"d"},"record":{"text":"look"},"embed":{"external":{"uri":"https://me.github.io/x"}}}}]}"""
    r = records.social_posts(payload(spark, js, did="d", handle="h"), "x", ["llm"], ["github.io"])
    assert sorted(x.id.rsplit(":", 1)[1] for x in r.collect()) == ["1", "7"]


def test_newsletter(spark):
    html = """<p>Presented by</p><a href="https://go.news.example/a">Sponsored headline that is long enough to count</a><p>Text</p>
      <a href="https://go.news.example/a">Sponsored headline that is long enough to count</a><p>More</p><p>text</p><p>here</p><a href="https://go.news.example/b">Editorial headline that is long enough too</a>"""
    r = {x.title: x.sponsored for x in web.editorial_items(payload(spark, html, m="1", day="2026-01-01"), "x", "m", "day", "n", "news.example").collect()}
    assert r == {"Sponsored headline that is long enough to count": True, "Editorial headline that is long enough too": False}
    out = web.issue_items(payload(spark, "<p>no links</p>", m="1", day="2026-01-01", subject="Issue 7"), "x", "m", "subject", "day", "n", "https://home.example").first()
    assert (out.title, out.url, out.extraction) == ("Issue 7", "https://home.example", "issue-metadata")


def test_form(spark):
    body = "### Platform\n\nLinkedIn\n\n### Event ID\n\nconf\n\n### Linked public artifacts\n\nhttps://a.example/1, https://a.example/2\n\n### Notes\n\n_No response_\n"
    f = payload(spark, body).select(web.form_fields(F.col("x")).alias("f")).first().f
    assert f["platform"] == "LinkedIn" and f["notes"] == ""


def test_landed_files(spark, tmp_path):
    assert landing.read_jsonl(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "a.jsonl").write_text('{"id":"1","title":"x"}\n\n{"id":"2"}\n')
    assert landing.read_jsonl(spark, str(tmp_path / "a.jsonl")).count() == 2
    day = tmp_path / "2026-09-21"
    day.mkdir()
    (day / "status.json").write_text('{"collected_at":"t","items":1,"errors":[],"collectors":[{"source_id":"a","status":"healthy","items":1}]}')
    r = landing.read_receipts(spark, str(tmp_path), {"public": "status.json", "other": "none.json"}).collect()
    assert [(x.family, x.snapshot, x.collectors[0].source_id) for x in r] == [("public", "2026-09-21", "a")]
    clean, bad = landing.sanitized_import(payload(spark, '{"id":"1","body":"x"}').unionByName(payload(spark, '{"id":"2"}')), "x")
    assert [x.id for x in clean.collect()] == ["2"] and bad.count() == 1
    rows = landing.reviewed_rows(spark, [{"id": "m1", "title": "By hand", "tags": ["a"]}])
    assert rows.first().tags == ["a"]


def test_stream_states(spark, tmp_path):
    """A direction fades and goes dormant without records of its own, and comes back."""
    schema = "ts timestamp, k string"
    days = {"1": [("2026-01-01", "a")], "2": [("2026-02-15", "b")], "3": [("2026-04-20", "b")], "4": [("2026-04-21", "a"), ("2026-04-22", "b")], "5": [("2026-04-25", "b")]}
    src = str(tmp_path / "in")
    for run, (name, rows) in enumerate(days.items()):
        spark.createDataFrame(rows, "t string, k string").select(F.to_timestamp("t").alias("ts"), "k").coalesce(1).write.mode("append").parquet(src)
        s = jobs.activity_changes(spark.readStream.schema(schema).parquet(src), "k")
        q = s.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = [(r.before, r.after) for r in spark.read.parquet(str(tmp_path / "out")).filter("key = 'a'").orderBy("at").collect()]
    assert got[:3] == [("", "active"), ("active", "fading"), ("fading", "dormant")] and ("dormant", "reactivated") in got


class CountedHandle:
    """A bucket's list state and timers, with the calls that were made."""

    def __init__(self):
        self.rows, self.timers, self.calls = [], [], 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def put(self, rows):
        self.calls, self.rows = self.calls + 1, rows

    def registerTimer(self, at):
        self.calls, self.timers = self.calls + 1, [*self.timers, at]

    def deleteTimer(self, at):
        self.calls, self.timers = self.calls + 1, [t for t in self.timers if t != at]


def test_state_calls_of_a_bucket():
    """The calls to the state store do not grow with the keys of a bucket (ST5)."""
    day = 86400000
    handle, p = CountedHandle(), jobs.LifecycleProcessor()
    p.init(handle)
    batch = lambda at: [Row(key=f"k{i}", day=at, first=at * day + i, newest=at * day + i, n=2) for i in range(200)]
    out = list(p.handleInputRows((0,), iter(batch(1)), None))
    assert len(out) == 200 and {r["after"] for r in out} == {"active"} and handle.calls == 3 and handle.timers == [31 * day]
    assert list(p.handleInputRows((0,), iter(batch(2)), None)) == [] and handle.calls == 7 and handle.timers == [32 * day]

    class Values:
        def getCurrentWatermarkInMs(self):
            return 32 * day + 99
    out = list(p.handleExpiredTimer((0,), Values(), None))
    assert [(r["key"], r["before"], r["after"], r["records"]) for r in out] == [(f"k{i}", "active", "fading", 4) for i in range(100)]
    assert handle.calls == 10 and handle.timers[-1] == 32 * day + 100 and len(handle.rows) == 200


def test_keys_of_one_bucket(spark, tmp_path):
    """Keys that share a bucket change each at its own time, by records and by timers (ST5)."""
    own = jobs.timer_session(spark)
    days = [[("2026-01-01", "a"), ("2026-01-03", "b")], [("2026-02-02", "c")], [("2026-04-20", "b"), ("2026-04-21", "c")], [("2027-01-01", None)]]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in days:
        own.createDataFrame(rows, "t string, k string").select(F.to_timestamp("t").alias("ts"), "k").coalesce(1).write.mode("append").parquet(src)
        s = jobs.lifecycle_changes(own.readStream.schema("ts timestamp, k string").parquet(src), "k", buckets=1)
        s.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    got = own.read.parquet(out).filter("key is not null").withColumn("at", F.date_format("at", "yyyy-MM-dd")).orderBy("key", "at").collect()
    assert [tuple(r) for r in got] == [
        ("a", "", "active", "2026-01-01", 1), ("a", "active", "fading", "2026-01-31", 1), ("a", "fading", "dormant", "2026-04-01", 1),
        ("b", "", "active", "2026-01-03", 1), ("b", "active", "fading", "2026-02-02", 1), ("b", "fading", "dormant", "2026-04-03", 1),
        ("b", "dormant", "reactivated", "2026-04-20", 2), ("b", "reactivated", "fading", "2026-05-20", 2), ("b", "fading", "dormant", "2026-07-19", 2),
        ("c", "", "active", "2026-02-02", 1), ("c", "active", "fading", "2026-03-04", 1),
        ("c", "fading", "reactivated", "2026-04-21", 2), ("c", "reactivated", "fading", "2026-05-21", 2), ("c", "fading", "dormant", "2026-07-20", 2)]


def test_references_in_the_title_element(spark):
    """All references are decoded (S9); given ones alone where a caller states them, as the SQL of s09_page_metadata does."""
    html = spark.createDataFrame([("<title>A &quot;b&quot; &amp; c&amp</title>",)], "html string")
    title = lambda **kw: html.select(web.page_metadata(F.col("html"), **kw)["title"]).first()[0]
    assert title() == 'A "b" & c&' and title(references={"&amp;": "&"}) == "A &quot;b&quot; & c&amp"
