"""Publication, sitemap trees, landed files, reviews, quotas, keyed tables and the activity machine."""

import random

from pyspark.sql import functions as F

from signalloom.functions import text as X
from signalloom.operators import concepts, dedup, graph, publish, quality as Q, resolve, review, scores
from signalloom.plans import q_scores, q_text
from signalloom.session import small_table
from signalloom.sources import feeds, landing
from signalloom.streaming import jobs, upserts


def test_publication_keeps_what_did_not_change(spark, tmp_path):
    root = str(tmp_path / "mart")
    a = spark.createDataFrame([(1, "x", {"k": 1.5}), (2, None, None), (2, None, None)], "id long, t string, m map<string,double>")
    b = spark.createDataFrame([(1,)], "id long")
    first = {r.name: r for r in publish.publish({"a": a, "b": b}, root, "day 1").collect()}
    again = {r.name: r for r in publish.publish({"a": a.repartition(3, "t"), "b": b}, root, "day 2").collect()}
    assert all(r.changed for r in first.values()) and not any(r.changed for r in again.values())
    assert {n: (r.path, r.generated_at) for n, r in again.items()} == {n: (r.path, "day 1") for n, r in first.items()}
    assert publish.manifest(spark, root)[0] == 1
    third = {r.name: r for r in publish.publish({"a": a.dropDuplicates(["id"]), "b": b}, root, "day 3").collect()}  # repeated rows count
    assert third["a"].changed and third["a"].generated_at == "day 3" and third["b"].generated_at == "day 1"
    assert publish.manifest(spark, root)[0] == 2 and publish.read_published(spark, root, "a").count() == 2
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "mart" / "data").iterdir()) == ["a", "a", "b"]  # the copies of day 2 are gone
    publish.publish({"b": b}, root, "day 4")
    assert [r.name for r in publish.manifest(spark, root)[1].collect()] == ["b"]


def test_sitemap_tree(spark):
    index = lambda *urls: "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in urls) + "</sitemapindex>"
    leaf = lambda *urls: "<urlset>" + "".join(f"<url><loc>{u}</loc></url>" for u in urls) + "</urlset>"
    files = spark.createDataFrame([("r", index("a", "b", "gone")), ("a", index("c", "r")), ("b", leaf("https://x/b1")), ("c", leaf("https://x/c1", "https://x/c2")), ("lost", leaf("https://x/lost"))], "url string, payload string")
    pages, unread = feeds.expand_sitemaps(files, spark.createDataFrame([("r",), ("b",)], "url string"))
    assert sorted((p.root, p.sitemap, p["loc"]) for p in pages.collect()) == [("b", "b", "https://x/b1"), ("r", "b", "https://x/b1"), ("r", "c", "https://x/c1"), ("r", "c", "https://x/c2")]
    assert [tuple(u) for u in unread.collect()] == [("r", "gone", "missing")]
    pages, unread = feeds.expand_sitemaps(files, spark.createDataFrame([("r",)], "url string"), depth=1)
    assert [p["loc"] for p in pages.collect()] == ["https://x/b1"] and sorted(tuple(u) for u in unread.collect()) == [("r", "c", "too-deep"), ("r", "gone", "missing")]
    none = feeds.expand_sitemaps(files.limit(0), files.select("url").limit(0))
    assert none[0].count() == none[1].count() == 0


def test_newest_files_only_are_opened(spark, tmp_path):
    for day, family, text in (("2026-01-01", "items", "{not json"), ("2026-01-02", "items", '{"id":"n"}'), ("2026-01-01", "links", '{"id":"l"}')):
        (tmp_path / day / family).mkdir(parents=True, exist_ok=True)
        (tmp_path / day / family / "part-1.json").write_text(text + "\n")
    pattern = r"/(?P<snapshot>\d{4}-\d\d-\d\d)/(?P<family>[a-z]+)/"
    got = landing.read_newest(spark, str(tmp_path), pattern, "id string").collect()
    assert sorted((r.family, r.snapshot, r.id) for r in got) == [("items", "2026-01-02", "n"), ("links", "2026-01-01", "l")]
    assert landing.read_newest(spark, str(tmp_path / "none"), pattern, "id string").count() == 0


def test_match_by_keys(spark):
    asked = spark.createDataFrame([("a", [("x", "1"), ("y", "2"), ("y", "3")]), ("b", [("x", None), ("y", "9")]), ("c", [("x", "2")])], "id string, keys array<struct<kind:string,key:string>>")
    known = spark.createDataFrame([("x", "1", "t1"), ("y", "2", "t1"), ("y", "3", "t3"), ("x", "2", "t2"), ("x", None, "t0")], "kind string, key string, target string")
    got = sorted(tuple(r) for r in review.match_by_keys(asked, known).collect())
    assert got == [("a", "t1", "x", 0), ("a", "t3", "y", 2), ("c", "t2", "x", 0)]


def test_water_fill_against_dealing_one_by_one(spark):
    rng = random.Random(3)
    counts = [(g, f"s{k}", rng.choice([1, 1, 2, 5, 40])) for g in range(8) for k in range(rng.randint(1, 9))]
    for quota in (1, 7, 30, 1000):
        got = {(r.g, r.s): r["take"] for r in scores.water_fill(spark.createDataFrame(counts, "g int, s string, n long"), ["g"], "s", quota).collect()}
        assert set(got) == {(g, s) for g, s, _ in counts}
        for g in range(8):
            mine = {s: n for x, s, n in counts if x == g}
            left, plain = quota, dict.fromkeys(mine, 0)
            while left and any(plain[s] < n for s, n in mine.items()):
                low = min(plain[s] for s, n in mine.items() if plain[s] < n)
                open_ = [s for s, n in mine.items() if plain[s] < n and plain[s] == low]
                plain[open_[0]] += 1
                left -= 1
            assert sorted(got[g, s] for s in mine) == sorted(plain.values()) and all(got[g, s] <= n for s, n in mine.items())


def test_keyed_table(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k string, v long, ts long"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    make = lambda: upserts.KeyedTable(spark, root, "k", "ts", schema, 4)
    assert make().read().count() == 0
    assert make().merge(rows(("a", 1, 1), ("a", 2, 5), ("b", 3, 1)), 0)
    assert not make().merge(rows(("a", 99, 99)), 0)  # a replay of a committed batch
    assert make().merge(rows(("b", 4, 1), ("c", 5, 2), ("a", 6, 4)), 1)  # equal order keeps the stored row, older rows lose
    assert sorted(tuple(r) for r in make().read().collect()) == [("a", 2, 5), ("b", 3, 1), ("c", 5, 2)]
    assert make().commits().select("batch").distinct().count() == 2


def test_activity_does_not_depend_on_batches():
    rng = random.Random(5)
    for _ in range(200):
        day, days = 0, []
        for _ in range(rng.randint(1, 12)):
            day += rng.choice([1, 2, 29, 30, 31, 89, 90, 91, 200])
            days.append((day * 86400000, day * 86400000 + rng.choice([0, 3600000]), rng.randint(1, 3)))
        whole = jobs.walk(0, "", 0, days)
        last, stage, n, out = 0, "", 0, []
        for d in days:  # one batch per day, timers before it where time has passed
            for at, before, after in jobs.quiet(last, stage, d[0] - 86400000) if stage else []:
                out.append((at, before, after, n))
                stage = after
            last, stage, n, more = jobs.walk(last, stage, n, [d])
            out += more
        assert (last, stage, n, out) == whole


def test_source_rewrite_tests_the_type(spark):
    df = spark.createDataFrame([("a", "expert-social"), ("a", "paper"), ("b", "expert-social"), (None, "expert-social"), ("a", None)], "source_id string, source_type string")
    got = [r.source_id for r in resolve.rewrite_sources(df, {"a": "z"}, ["expert-social"]).collect()]
    assert got == ["z", "a", "b", None, "a"] and [r.source_id for r in resolve.rewrite_sources(df, {"a": "z"}).collect()] == ["z", "z", "b", None, "z"]
    assert resolve.rewrite_sources(df, {}).collect() == df.collect()


def test_many_references_in_one_text(spark):
    text = "word &amp; caf&eacute; &#8217;s " * 4_000
    got = spark.createDataFrame([(text,)], "t string").select(X.unescape(F.col("t")).alias("u")).first().u
    assert got == "word & café ’s " * 4_000


def test_similar_sets_meet_by_all_they_must_share(spark):
    """Small sets over few members share rare ones all the time (G9); only those that reach the bound may be paired."""
    rnd = random.Random(4)
    sets = sorted({tuple(sorted(rnd.sample(range(14), rnd.randrange(3, 8)))) for _ in range(150)})
    rows = [(f"s{i:03d}", [f"m{x:02d}" for x in s]) for i, s in enumerate(sets)]
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0]
            and len(set(a[1]) & set(b[1])) / len(set(a[1]) | set(b[1])) >= 0.8}
    got = graph.opening_pairs(small_table(spark, rows, "id string, evidence_ids array<string>"), 0.8)
    assert {tuple(r) for r in got.collect()} == want
    long = [(f"l{i}", [f"m{x:03d}" for x in range(60) if x % 20 not in (i, i + 3)]) for i in range(6)]
    met = graph.opening_pairs(small_table(spark, long, "id string, evidence_ids array<string>"), 0.8)
    assert met.count() == 15   # 48 or more of 60 members shared: all reach the bound


def test_phrase_counting_takes_more_tasks_with_more_records(spark):
    """A task counts the phrases of so many records at most (T5), whatever shuffles are coalesced to; results as counted by hand."""
    items = spark.range(40).select(F.col("id").cast("string").alias("id"), F.array(*[F.lit(t) for t in (
        "12", "34", "thre", "thre", "alpha", "beta", "alpha", "beta")]).alias("tokens"), F.lit(6).alias("title_tokens"))
    counts = concepts.phrase_counts(items, concepts.ConceptPolicy(generic_tokens=["thre"], blocked_phrases=["thre alpha"]), records_a_task=2)
    assert counts.rdd.getNumPartitions() >= 20
    got = {r.phrase: (r.tf, r.in_title) for r in counts.filter("id = '7' and size = 2").collect()}
    assert got == {"34 thre": (1, True), "alpha beta": (2, True), "beta alpha": (1, False)}
    assert counts.filter("id = '7' and size > 2").count() == 11


def test_a_sentence_is_read_once_for_its_relations(spark):
    """Sentences and terms are normalized once each (T9): not again in filters, nor for each term that is looked up."""
    term = F.array(F.struct(F.lit("n").alias("id"), F.array(F.lit("alpha"), F.lit("beta")).alias("matched_terms")))
    base = spark.range(2).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("See alpha 1. Now beta "), "id").alias("search"),
                                 term.alias("controlled"), term.alias("entities"), term.alias("actions"))
    plan = concepts.relations(base, concepts.ConceptPolicy())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 3   # terms of nodes, of actions, and sentences


def test_only_rows_in_reach_are_classified_for_eligibility(spark):
    """Source and date leave out rows before any text is read; the eligible rows stay the same."""
    rows = [(f"r{i}", s, "paper", "A title", "Its text", at) for i, (s, at) in enumerate([
        ("on", "2024-06-10T00:00:00Z"), ("on", "2024-05-16T00:00:00Z"), ("on", "2024-05-16T00:00:01Z"), ("on", "2024-06-21T00:00:00Z"), ("on", "2024-06-21T00:00:01Z"),
        ("off", "2024-06-10T00:00:00Z"), ("lost", "2024-06-10T00:00:00Z"), (None, "2024-06-10T00:00:00Z"), ("on", None), ("on", "soon"), ("on", "Mon, 10 Jun 2024 08:00:00 GMT")])]
    df = small_table(spark, rows, "id string, source_id string, source_type string, title string, summary string, published_at string").select(
        "*", *[F.array().cast("array<string>").alias(c) for c in ("tags", "projects", "theme_ids")], F.lit("https://x/").alias("url"))
    sources = small_table(spark, [("on", True, "c", "p"), ("off", False, "c", "p")], "id string, enabled boolean, channel string, publisher_id string")
    ids = lambda d: sorted(r.id for r in Q.eligibility(d, sources, "2024-06-20T00:00:00Z").filter("reason is null").collect())
    near = Q.in_reach(df, sources, "2024-06-20T00:00:00Z")
    assert ids(near) == ids(df) == ["r0", "r10", "r2", "r3"] and near.count() == 4


def test_tokens_need_no_pass_over_separators(spark):
    """Hyphen, slash and any white space separate tokens by themselves (N12): the text is not rewritten for them first."""
    df = spark.createDataFrame([("Node.js/C++ a-.b  GPT-4.1\n\nStraße+x- -",), (None,), ("",)], "t string").select(X.normalized_tokens(F.col("t")).alias("w"))
    assert [r.w for r in df.collect()] == [["node.js", "c", "a", "b", "gpt", "4.1", "strasse+x"], [], []]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and "regexp_replace(" not in plan


def test_title_starts_travel_as_numbers(spark):
    """Titles stand in joins as 16 bytes and their starts as numbers (D6), not as hexadecimal digits; a group without a name still pairs nothing."""
    long = "the quick brown fox jumps over the lazy dog"
    titles = spark.createDataFrame([("a", long), ("a", long[4:]), ("a", long[:20]), ("b", long[4:]), (None, long), (None, long[4:]), ("c", "abcd"), ("c", "bcd")], "g string, t string")
    out = dedup.contained_titles(titles, ["g"])
    assert sorted(tuple(r) for r in out.collect()) == [("a", long[4:], long), ("c", "bcd", "abcd")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2(") == plan.count("unhex(sha2(") > 0
    assert titles.select(F.length(dedup.text_key(["g"], F.col("t"))).alias("n")).distinct().collect() == [(16,)]


def test_shared_pairs_take_more_tasks_with_more_rows(spark):
    """A task holds the pairs of so many rows at most (J14), whatever shuffles are coalesced to."""
    li = spark.range(40).select((F.col("id") / 2).cast("long").alias("l_orderkey"), (F.col("id") % 4).alias("l_suppkey"))
    out = q_text.shared_pairs(li, rows_a_task=2)
    assert out.rdd.getNumPartitions() >= 20
    assert sorted(tuple(r) for r in out.collect()) == [(0, 1, 10), (2, 3, 10)]


def test_cases_shuffle_a_line_item_once(spark, tmp_path):
    """Counts of different values per part ignore nulls and repeats, and no row is copied for them."""
    rows = [(1, 10, 5, "1994-01-02", "A"), (1, 10, 6, "1994-03-02", "R"), (1, 11, None, None, "A"), (1, None, 5, "1995-01-02", None), (2, None, None, None, "N"), (None, 1, 1, "1994-01-02", "A")]
    li = spark.createDataFrame(rows, "l_partkey long, l_orderkey long, l_suppkey long, d string, l_returnflag string").withColumn("l_shipdate", F.col("d").cast("timestamp"))
    li.drop("d").write.parquet(str(tmp_path / "lineitem.parquet"))
    out = q_scores.cases(spark, str(tmp_path))
    got = {r.id: (r.qualifying_events, r.independent_organizations, r.persistence_cycles, r.technical_artifacts, r.counterevidence_reviewed) for r in out.collect()}
    assert got == {1: (2, 2, 2, 2, True), 2: (0, 0, 0, 0, False), None: (1, 1, 1, 1, False)}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" not in plan
