"""Operators on literal rows."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from signalloom.functions import constants as C, dates as D, text as X
from signalloom.operators import change as H, classify as K, concepts as N, dedup, discover as G, gates, graph, lifecycle as L
from signalloom.operators import pulse as P, quality as Q, ranking as R, resolve as V, scores as S
from signalloom.plans import marts
from signalloom.session import cut_lineage, small_table

AS_OF = "2026-09-21T00:00:00Z"
NOW = datetime(2026, 9, 21, tzinfo=timezone.utc)
EVIDENCE = (
    "id string, source_id string, source_type string, title string, summary string, url string, published_at string, ts timestamp, "
    "tags array<string>, projects array<string>, theme_ids array<string>, artifact_urls array<string>, sponsor_status string, "
    "metadata map<string,string>, event_ids array<string>")


def ago(days):
    return NOW - timedelta(days=days)


def item(id, source="s", type="paper", title="t", summary="", url="", days=1.0, **kw):
    when = kw.pop("at", None) or ago(days)
    row = dict(id=id, source_id=source, source_type=type, title=title, summary=summary, url=url, published_at=when.isoformat(), ts=when,
               tags=[], projects=[], theme_ids=[], artifact_urls=[], sponsor_status="unknown", metadata={}, event_ids=[])
    return {**row, **kw}


def frame(spark, rows, schema=EVIDENCE):
    return small_table(spark, rows, schema)


def one(spark, column, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*cols).select(column.alias("x")).first()[0]


# ---- text ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("raw, want", [
    ("  a  b\n c ", "a b c"), ("", ""), (None, "")])
def test_compact(spark, raw, want):
    assert one(spark, X.compact(F.col("v")), v=raw) == want


def test_slug_and_fold(spark):
    assert one(spark, X.slug(F.col("v")), v="Éclair & Straße 2!") == "eclair-strae-2"
    assert one(spark, X.fold(F.col("v")), v="Straße") == "strasse"


def test_tracked_link_is_cleaned(spark):
    raw = "https://click.example.net/r?u=https%3A%2F%2Fnews.example.org%2Fa%3Futm_source%3Dx%26id%3D3%23top&amp;uid=9"
    assert one(spark, X.public_link(F.col("v")), v=raw) == "https://news.example.org/a?id=3"
    assert one(spark, X.public_link(F.col("v")), v="https://news.example.org/a?utm_medium=mail&ref=b") == "https://news.example.org/a"
    assert one(spark, X.public_link(F.col("v")), v="mailto:someone") is None


def test_titles(spark):
    assert one(spark, X.editorial_title(F.col("v")), v="▸ 1. Long enough headline with several words inside , really") == \
        "Long enough headline with several words inside, really"
    assert one(spark, X.editorial_title(F.col("v")), v="a b c d e f g h i j k l m n o p q r s t u v") is None
    assert one(spark, X.generic_title(F.col("v")), v="Unsubscribe from this list") is None


def test_dates(spark):
    stamp = lambda v: one(spark, F.date_format(D.parse_timestamp(F.col("v")), "yyyy-MM-dd HH:mm"), v=v)
    assert stamp("2026-09-21T10:00:00+02:00") == "2026-09-21 08:00"
    assert stamp("Mon, 21 Sep 2026 10:00:00 GMT") == "2026-09-21 10:00"
    assert stamp("2026") is None and stamp("soon") is None
    assert D.last_months("2026-02-10") == ["2025-09", "2025-10", "2025-11", "2025-12", "2026-01", "2026-02"]
    assert one(spark, D.relative_date(F.col("v"), "2026-09-21"), v="about 2 months") == "2026-07-23"


def test_phrase_position_ignores_the_start(spark):
    assert one(spark, X.phrase_position(F.col("v"), F.lit("a b")), v="a b c") == -1
    assert one(spark, X.phrase_position(F.col("v"), F.lit("b c")), v="a b c") == 1


# ---- classification -----------------------------------------------------------------------------

def test_whole_terms(spark):
    hit = lambda text, term: one(spark, K.matches_any_term(X.fold(F.col("v")), [term]), v=text)
    assert hit("An MCP server", "MCP") and not hit("compliance mcps", "MCP")
    assert not hit("a novel argument", "VLA")


def test_themes_take_one_scan_for_words(spark):
    terms = {"t1": ["ab", "abc"], "t2": ["abc", "x y"], "t3": ["c++", "b"], "t4": [], "t5": ["Abß", "a1"]}
    rng = random.Random(5)
    texts = ["", "abc", "x  y", "x y", "abß", "ABSS", "c++", "c++b", "-ab-", "abcd", "éab", None] + [
        "".join(rng.choice("aabbc1x y.+ß-") for _ in range(rng.randrange(40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string").withColumn("v", X.fold(F.col("v")))
    every = F.array_compact(F.array(*[F.when(K.matches_any_term(F.col("v"), terms[t]), F.lit(t)) for t in sorted(terms)]))
    got = df.select(K.theme_ids(F.col("v"), terms).alias("a"), every.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert any(len(r.a) > 1 for r in got)
    plan = df.select(K.theme_ids(F.col("v"), {f"t{i}": [f"word{i}"] for i in range(9)}).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "Contains" not in plan
    assert one(spark, F.size(K.theme_ids(F.repeat(F.lit("abcd "), 300_000), terms)), v="") == 0


def test_direction_rows_write_no_texts(spark, tmp_path):
    from signalloom.plans import q_scores, stages
    os.symlink("/root/testdata/sf0.001", tmp_path / "sf")
    rows = q_scores.tagged(spark, str(tmp_path / "sf"))
    assert not {"title", "summary"} & set(rows.columns)
    assert {k[2] for k in stages._written if k[1] == str(tmp_path / "sf")} == {"tagged"}
    whole = stages.classified(spark, str(tmp_path / "sf"))
    again = stages.classified_once(spark, str(tmp_path / "sf"))
    assert again.inputFiles() == whole.inputFiles()


def test_project_pieces_are_thinned_before_the_shuffle(spark, monkeypatch):
    names = ["ab", "river stone", "\U0001f600 long name", "nowhere at all", "stone"]
    long = "x" * 4090 + "River Stone" + "y\n" * 3000 + "\U0001f600\U0001f600 LONG name"
    titles = [long, "ab", "a", "", "River\nStone", "stones", "nowhere at al", "\U0001f600 long nam"]
    projects = frame(spark, [{"name": n, "official_url": ""} for n in names], "name string, official_url string")
    evidence = frame(spark, [item(f"e{i}", title=t) for i, t in enumerate(titles)])
    plans = {}

    def cut(df, label="stage"):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return cut_lineage(df, label)
    monkeypatch.setattr(V, "cut_lineage", cut)
    got = {(r.name, r.id) for r in V.match_projects(projects, evidence).collect()}
    assert got == {(n, f"e{i}") for n in names for i, t in enumerate(titles) if n in t.lower()}
    assert "BroadcastHashJoin" in plans["pieces"] and plans["pieces"].count("regexp_extract_all") == len({min(len(n), 6) for n in names})


def test_rule_order(spark):
    rules = [{"id": "paid", "sponsor_statuses": ["sponsored"], "precedence": "before-theme", "reason": "paid"},
             {"id": "quiet", "source_types": ["community"], "requires_no_scope_term": True, "reason": "no scope"}]
    rows = [item("a", title="robot arms", sponsor_status="sponsored"), item("b", title="robot arms"), item("c", type="community", title="gardening"),
            item("d", type="community", title="an llm garden"), item("e", title="other")]
    got = {r.id: (r.disposition, r.rule_id) for r in K.classify(frame(spark, rows), {"robots": ["robot arms"]}, rules, ["llm"]).collect()}
    assert got == {"a": ("out-of-scope", "paid"), "b": ("classified", "canonical-theme-match"), "c": ("out-of-scope", "quiet"),
                   "d": ("classification-review", "unresolved-review"), "e": ("classification-review", "unresolved-review")}


# ---- lifecycle ----------------------------------------------------------------------------------

LIFE = "k string, id string, source_id string, publisher_id string, family string, ts timestamp"


def test_established_and_fading(spark):
    fams = ["builders", "research", "engineering", "experts", "attention", "attention"]
    rows = [("x", str(i), f"s{i}", f"p{i}", f, ago(5 if i % 2 else 40)) for i, f in enumerate(fams)] + [("old", "9", "s", "p", "research", ago(45))]
    got = {r.k: r for r in L.snapshots(frame(spark, rows, LIFE), "k", AS_OF, [0]).collect()}
    assert (got["x"].stage, got["x"].family_count, got["x"].source_count, got["x"].active_periods) == ("established", 5, 6, 2)
    assert got["old"].stage == "fading"


def test_movement_accelerates(spark):
    rows = frame(spark, [("x", str(d), "s", f"p{d}", "research", ago(d)) for d in (40, 20, 8, 6, 4)], LIFE)
    m = L.signal_movement(rows, L.snapshots(rows, "k", AS_OF, [0]), "k", AS_OF).first()
    assert (m.movement, m.current_count, m.previous_count, m.change) == ("accelerating", 3, 1, 2)


# ---- eligibility and duplicates -----------------------------------------------------------------

SOURCES = [("paper", "Papers", "paper", "lab", True, "feed"), ("news", "News", "newsletter", "news", True, "feed"), ("off", "Off", "paper", "off", False, "feed")]
SRC = "id string, name string, channel string, publisher_id string, enabled boolean, collection string"


def test_eligibility_reasons(spark):
    rows = [item("ok", "paper", url="https://e.example/1"), item("mail", "paper", summary="write to a.b@example.org"), item("old", "paper", days=40),
            item("future", "paper", days=-3), item("off", "off"), item("who", "nobody"), item("blank", "paper", title=" "),
            item("bad", "paper", published_at="soon"), item("none", "paper", published_at="")]
    got = {r.id: r.reason for r in Q.eligibility(frame(spark, rows).drop("ts"), frame(spark, SOURCES, SRC), AS_OF).collect()}
    assert got == {"ok": None, "mail": "not-public-safe", "old": "outside-window", "future": "future-dated", "off": "disabled-source",
                   "who": "unknown-source", "blank": "missing-content", "bad": "invalid-date", "none": "missing-required-field"}


def test_unchanged_and_changed(spark):
    df = frame(spark, [item("same", "paper"), item("moved", "paper"), item("fresh", "paper")]).drop("ts")
    prev = df.filter("id <> 'fresh'").select("id", F.when(F.col("id") == "moved", "x").otherwise(Q.fingerprint()).alias("fingerprint"))
    got = {r.id: (r.reason, r.change_type) for r in Q.eligibility(df, frame(spark, SOURCES, SRC), AS_OF, previous=prev).collect()}
    assert got["same"][0] == "unchanged" and got["moved"] == (None, "materially-changed") and got["fresh"] == (None, "new-record")


def test_contribution_caps(spark):
    rows = [("c", "repo-1", "gh", "eng", 1), ("c", "repo-2", "gh", "eng", 2), ("c", "repo-3", "gh", "eng", 3), ("c", "repo-4", "gh2", "eng", 4), ("c", "paper-1", "px", "lab", 5)]
    df = frame(spark, rows, "g string, id string, s string, p string, n int")
    kept = R.contribution_caps(df, ["g"], "s", "p", [F.col("n")])
    assert {r.id for r in kept.collect()} == {"repo-1", "repo-2", "paper-1"}
    out = {r.id: r.reason_codes for r in R.cap_exclusions(df, kept, ["g"], "s", "p", "id", F.struct("n")).collect()}
    assert out == {"repo-3": ["source-cap", "publisher-cap"], "repo-4": ["publisher-cap"]}



def test_exclusions_meet_kept_rows_once(spark):
    """One join decides both what was kept and which cap was full; without a publisher or group nothing meets but the row itself."""
    rows = [("c", "a", "s", None, 1), ("c", "b", "s", None, 2), ("c", "d", "s", None, 3), ("c", "e", None, "p", 1), ("c", "f", None, "p", 2), ("c", "g", None, "p", 3), (None, "h", "s", "p", 1)]
    df = frame(spark, rows, "g string, id string, s string, p string, n int")
    kept = cut_lineage(R.contribution_caps(df, ["g"], "s", "p", [F.col("n")]))
    out = R.cap_exclusions(df, kept, ["g"], "s", "p", "id", F.struct("n"))
    assert {r.id: r.reason_codes for r in out.collect()} == {"d": [], "g": ["publisher-cap"], "h": []} and out.columns == [*df.columns, "reason_codes"]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1

def test_privacy(spark):
    rows = [("a", '{"x":"me@example.org"}'), ("b", '{"deep":{"raw_body":1}}'), ("c", '{"x":"fine"}'), ("d", '{"x":"https://mail.google.com/mail/u/0/#all/1"}')]
    got = {(r.id, r.violation) for r in Q.privacy_violations(frame(spark, rows, "id string, j string"), "id", F.col("j")).collect()}
    assert got == {("a", "email-address"), ("b", "key:raw_body"), ("d", "mailbox-link")}


# ---- events -------------------------------------------------------------------------------------

EVENT = dict(id="conf", name="Conf", start_date="2026-06-01", end_date="2026-06-03", official_url="https://conf.example", aliases=["BigConf 2026", "short"],
             source_ids=["conf-feed"], review_windows_days=[30, 90])
EV = "id string, name string, start_date string, end_date string, official_url string, aliases array<string>, source_ids array<string>, review_windows_days array<int>"


def at(y, m, d):
    return datetime(y, m, d, 12, tzinfo=timezone.utc)


def test_alias_needs_the_date_window(spark):
    rows = [item("in", title="Notes from BigConf 2026", at=at(2026, 6, 10)), item("out", title="Notes from BigConf 2026", at=at(2027, 6, 10)),
            item("short", title="short", at=at(2026, 6, 10)), item("feed", "conf-feed", at=at(2020, 1, 1)), item("url", url="https://conf.example/#x", at=at(2020, 1, 1))]
    got = {r.id: r.event_ids for r in V.attach_events(frame(spark, rows), [EVENT]).collect()}
    assert got == {"in": ["conf"], "out": [], "short": [], "feed": ["conf"], "url": ["conf"]}


def test_later_repository_joins_by_project(spark):
    rows = [item("first", "conf-feed", "event-session", projects=["Tool X"], at=at(2026, 6, 2)), item("repo", "gh", "repository", projects=["tool  x"], at=at(2026, 7, 1)),
            item("late", "gh", "repository", projects=["Tool X"], at=at(2027, 7, 1))]
    got = {r.id: r.event_ids for r in V.attach_by_artifact(V.attach_events(frame(spark, rows), [EVENT]), [EVENT]).collect()}
    assert got == {"first": ["conf"], "repo": ["conf"], "late": []}


def pulse(spark, rows, as_of="2026-09-21T00:00:00Z"):
    src = frame(spark, [("conf-feed", "f", "event-program", "p", True, "feed"), ("dev", "d", "hackathon-gallery", "p", True, "feed")], SRC)
    linked = P.linked(frame(spark, rows), src)
    ev = frame(spark, [EVENT], EV)
    checks = P.checkpoints(linked, ev, as_of)
    return P.dossiers(linked, ev, checks).first(), {c.days: c for c in checks.collect()}


def test_echo_collapses_session_and_post(spark):
    d, c = pulse(spark, [item("a", "conf-feed", "event-session", "Same talk", at=at(2026, 6, 2), event_ids=["conf"]),
                         item("b", "x", "curated-social", "Same  talk", at=at(2026, 6, 20), event_ids=["conf"])])
    assert (d.independent_observation_count, d.echo_records_collapsed, d.artifact_count) == (1, 1, 0)
    assert c[90].status == "not-observed"


def test_later_repost_is_not_persistence(spark):
    _, c = pulse(spark, [item("a", "conf-feed", "event-session", "Talk", at=at(2026, 6, 2), event_ids=["conf"], artifact_urls=["https://r.example/x"]),
                         item("b", "x", "repository", "Repo", at=at(2026, 6, 20), event_ids=["conf"], artifact_urls=["https://r.example/x/"])])
    assert c[30].status == "not-observed"


def test_thirty_pages_are_partial_artifacts(spark):
    d, _ = pulse(spark, [item(f"p{i}", "dev", "hackathon-project", f"Project {i}", at=at(2026, 6, 2), event_ids=["conf"], artifact_urls=[f"https://d.example/{i}"]) for i in range(30)])
    assert (d.artifact_count, d.weighted_artifact_count) == (30, 15.0) and d.substance < 60


def test_silent_event_is_not_assessed(spark):
    d, c = pulse(spark, [item("x", at=at(2026, 6, 2))])
    assert c[30].status == "not-assessed" and d.attention is None and d.attention_label == "not-assessed"


def test_pending_until_due(spark):
    _, c = pulse(spark, [item("a", "conf-feed", at=at(2026, 6, 2), event_ids=["conf"])], "2026-06-20T00:00:00Z")
    assert c[30].status == "pending"


# ---- newsletters --------------------------------------------------------------------------------

def test_history_cleaning(spark):
    schema = "id string, title string, published_at string, sponsor_status string, sponsor_basis string"
    rows = [("1", "A very useful headline about model routing today", "2026-06-01T01:00:00Z", "sponsored", None),
            ("2", "A very useful headline about model routing", "2026-06-01T02:00:00Z", "unknown", None),
            ("3", "Another headline that stands quite alone here", "2026-06-01T03:00:00Z", "sponsored", None),
            ("4", "s p a c e d o u t t e x t", "2026-06-01T04:00:00Z", "unknown", None)]
    out = dedup.clean_history(frame(spark, rows, schema), "news")
    got = {r.title: (r.sponsor_status, r.sponsor_basis) for r in out.collect()}
    assert got == {rows[0][1]: ("sponsored", "duplicate-link-title"), rows[2][1]: ("unknown", "legacy-proximity-uncertain")}
    again = dedup.clean_history(out, "news")
    assert {r.id for r in again.collect()} == {r.id for r in out.collect()}


def test_history_is_read_once(spark, tmp_path):
    """Titles are parsed and shuffled once (D7): what is kept of a title's first row comes with it, not from the input again."""
    rows = [("1", "One headline about model routing", "2026-06-01T05:00:00Z", "editorial", "b"), ("2", "One headline about model routing", "2026-06-01T02:00:00Z", "unknown", "z"),
            ("3", "one headline about model routing", "2026-06-01T01:00:00Z", "editorial", "a"), ("4", "One headline about model routing", None, "editorial", "a")]
    frame(spark, rows, "id string, title string, published_at string, sponsor_status string, sponsor_basis string").write.parquet(str(tmp_path / "rows"))
    out = dedup.clean_history(spark.read.parquet(str(tmp_path / "rows")), "news")
    assert [tuple(r)[1:] for r in out.collect()] == [("One headline about model routing", "2026-06-01T02:00:00Z", "unknown", "z")]
    assert not [f for f in out.inputFiles() if str(tmp_path) in f]


def test_a_title_offers_few_rows(spark):
    """A title is looked for by few of its pieces (D6), not by all its starts."""
    titles = spark.range(200).select(F.lit("g").alias("g"), F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(i))) for i in range(3)]).alias("t"))
    out = dedup.contained_titles(titles.unionByName(titles.withColumn("t", F.expr("substring(t, 5)"))), ["g"])
    assert len(out.collect()) == 200
    rows, nodes = [], [out._jdf.queryExecution().executedPlan()]
    while nodes:
        n = nodes.pop()
        name = n.getClass().getSimpleName()
        if name == "GenerateExec":
            rows.append(n.metrics().apply("numOutputRows").value())
        if name == "AdaptiveSparkPlanExec":
            nodes.append(n.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(n.plan())
        else:
            nodes += [n.children().apply(k) for k in range(n.children().size())]
    assert 0 < sum(rows) < 400 * 8


# ---- health, gates, review ----------------------------------------------------------------------

def test_legacy_receipt(spark):
    kind = "family string, snapshot string, collected_at string, errors array<string>, collectors array<struct<source_id:string,status:string,items:int,error:string>>"
    rec = frame(spark, [("public", "2026-09-20", "2026-09-20T06:00:00Z", [], None), ("public", "2026-09-21", "2026-09-21T06:00:00Z", ["arxiv: HTTP 500: broken"], None)], kind)
    latest = S.newest_receipts(rec)
    states = S.receipt_states(latest, frame(spark, [("public", "github", 3)], "family string, source_id string, n int"))
    run = S.run_health(latest, states).first()
    assert (run.status, run.failed_source_ids) == ("degraded", ["arxiv"])
    conf = frame(spark, [("arxiv", "", "", "", True, "feed"), ("github", "", "", "", True, "feed"), ("hand", "", "", "", True, "manual"), ("new", "", "", "", True, "feed")], SRC)
    got = {r.source_id: (r.status, r.error) for r in S.source_health(states, conf, ["public"]).collect()}
    assert got == {"arxiv": ("failed", "HTTP 500: broken"), "github": ("healthy", None), "hand": ("not-automated", None), "new": ("no-run-receipt", None)}


def test_gates(spark):
    schema = ("id string, technical_reality string, operational_adoption string, evidence_independence string, qualifying_events int, technical_artifacts int, "
              "independent_organizations int, persistence_cycles int, counterevidence_reviewed boolean, cost_of_absence_evidenced boolean, "
              "practical_minimum_available boolean, expected_maturity string")
    rows = [("n", "low", "low", "low", 1, 0, 0, 0, False, False, False, "narrative"), ("x", "strong", "low", "low", 3, 3, 1, 0, True, False, False, "experimental"),
            ("e", "strong", "moderate", "moderate", 4, 3, 2, 0, True, True, True, "emerging"), ("b", "strong", "strong", "strong", 9, 5, 4, 2, True, True, True, "baseline")]
    out = gates.gate_results(frame(spark, rows, schema))
    assert all(r.matches_expected for r in gates.calibration(out).collect())
    e = out.filter("id = 'e'").first()
    assert e.next_gate.gate == "established" and "level:operational_adoption:moderate<strong" in e.next_gate.failures
    assert out.filter("id = 'b'").first().next_gate is None


def test_slower_movement_is_not_material(spark):
    schema = ", ".join(f"{p}{c} {t}" for p in ("", "p_", "r_") for c, t in (
        ("id", "string"), ("stage", "string"), ("strength", "string"), ("movement", "string"), ("evidence_count", "int"), ("source_count", "int"), ("recent_count", "int")))
    now, before = ["a", "emerging", None, "cooling", 5, 3, 1], ["a", "emerging", None, "steady", 5, 3, 4]
    rows = [tuple(now + before + before), tuple(["b", "emerging", None, "steady", 8, 3, 4] + ["b"] + before[1:] + ["b"] + before[1:]), tuple(["c"] + now[1:] + [None] * 14)]
    got = {r.id: (r.why, r.adj) for r in frame(spark, rows, schema).select("id", H.material_reasons().alias("why"), H.adjudication_status().alias("adj")).collect()}
    assert got == {"a": ([], "current"), "b": (["evidence"], "revisit-required"), "c": (["new"], None)}


def test_state_moves(spark):
    log = frame(spark, [("spark", "candidate"), ("approved", "spark"), ("dormant", "spark"), ("spark", "approved")], "from_state string, to_state string")
    assert {(r.from_state, r.to_state) for r in Q.illegal_moves(log).collect()} == {("approved", "spark"), ("spark", "approved")}


def test_unobserved_is_null_not_zero(spark):
    themes = frame(spark, [("a", "A"), ("b", "B")], "id string, name string")
    rows = frame(spark, [("a", "p", "s", 1, "2026-09")], "theme_id string, publisher_id string, source_id string, support int, month string")
    got = {r.id: r for r in S.with_unobserved(themes, S.cross_source_scores(rows, AS_OF)).collect()}
    assert got["b"].total is None and got["b"].maturity == "unobserved" and got["b"].evidence_count == 0
    assert got["a"].maturity == "source-specific"


def test_upsert_keeps_first_directory_date(spark):
    old = frame(spark, [("a", "company-directory", "2026-01-01", 1), ("b", "paper", "2026-01-01", 1), ("z", "paper", "2026-01-03", 1)], "id string, source_type string, published_at string, ingest_ts int")
    new = frame(spark, [("a", "company-directory", "2026-02-01", 2), ("b", "paper", "2026-02-01", 2), ("b", "paper", "2026-02-02", 3), ("c", "paper", "2026-02-01", 2)], "id string, source_type string, published_at string, ingest_ts int")
    got = {r.id: r.published_at for r in H.upsert(old, new).collect()}
    assert got == {"a": "2026-01-01", "b": "2026-02-02", "c": "2026-02-01", "z": "2026-01-03"}


def test_merge_fields(spark):
    schema = "id string, title string, metadata map<string,string>"
    out = dedup.merge_fields(frame(spark, [("a", "old", {"k": "mine"})], schema), frame(spark, [("a", "new", {"k": "theirs", "x": "y"})], schema), ["title"]).first()
    assert out.title == "new" and out.metadata == {"k": "mine", "x": "y"}


def test_global_rank(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"))
    got = R.global_rank(df, [F.desc("v")]).collect()
    assert {r.v: r["rank"] for r in got} == {v: 5000 - v for v in range(5000)}


# ---- mining -------------------------------------------------------------------------------------

POLICY = N.ConceptPolicy(
    lexicon=N.lexicon([{"id": "routing", "name": "Model routing", "aliases": ["model router"]}], [{"id": "sovereignty", "label": "Data sovereignty", "aliases": ["data sovereignty"]}]),
    actions={"route": ["route", "routes"], "govern": ["governs"]}, blocked_tags=["ai"])


def mined(spark, rows):
    return N.concept_documents(frame(spark, rows), POLICY)


def test_concepts(spark):
    rows = [item("a", title="Policy firewall routes requests", summary="The policy firewall governs model routing for data sovereignty.", projects=["Acme Gate"], tags=["AI", "wasm", "cs.AI"]),
            item("b", title="A policy firewall again", summary="Nothing else here"), item("c", title="Unrelated", summary="words only")]
    got = {r.evidence_id: r for r in mined(spark, rows).collect()}
    a = got["a"]
    assert {c.id for c in a.concepts} == {"theme:routing", "primitive:sovereignty", "phrase:policy-firewall"}
    assert {e.id for e in a.entities} == {"project:acme-gate", "technology:wasm"}
    assert {x.id for x in a.actions} == {"route", "govern"}
    assert ("theme:routing", "govern", "primitive:sovereignty") in {(r.subject_id, r.predicate, r.object_id) for r in a.relationships}
    assert [c.id for c in got["b"].concepts] == ["phrase:policy-firewall"] and got["c"].concepts == []


def test_catalog_changes(spark):
    rows = [item("a", title="Policy firewall one"), item("b", title="Policy firewall two")]
    docs = mined(spark, rows)
    prints = frame(spark, rows).select("id", Q.fingerprint().alias("fingerprint"))
    none = spark.createDataFrame([], "id string, fingerprint string, signature string")
    first = N.catalog_changes(docs, prints, none)
    assert {r.change for r in first.collect()} == {"added"}
    base = first.select("id", "fingerprint", "signature")
    assert {r.change for r in N.catalog_changes(docs, prints, base).collect()} == {"unchanged"}
    more = rows + [item("z", title="Something else entirely")]
    got = {r.id: r.change for r in N.catalog_changes(mined(spark, more), frame(spark, more).select("id", Q.fingerprint().alias("fingerprint")), base).collect()}
    assert got == {"a": "unchanged", "b": "unchanged", "z": "added"}


def cluster_docs(spark, groups):
    """Three documents of three sources for every (concept, themes) group."""
    node = "array<struct<id:string,label:string,kind:string,matched_terms:array<string>>>"
    schema = (f"evidence_id string, source_id string, source_type string, published_at string, theme_ids array<string>, concepts {node}, entities {node}, "
              "actions array<struct<id:string,label:string,matched_terms:array<string>>>, relationships array<struct<subject_id:string,predicate:string,object_id:string,basis:string>>")
    rows, types = [], ["paper", "repository", "practitioner-blog"]
    for g, (concept, themes, action) in enumerate(groups):
        for i in range(3):
            rows.append((f"{g}-{i}", f"s{i}", types[i], f"2026-09-{10 + i}", themes, [dict(**concept, matched_terms=[])], [],
                         [dict(id=action, label=action, matched_terms=[])] if action else [], []))
    return frame(spark, rows, schema)


def test_discovery_states(spark):
    ph = lambda label: dict(id="phrase:" + label.replace(" ", "-"), label=label, kind="emergent-phrase")
    pr = lambda id, label: dict(id=f"primitive:{id}", label=label, kind="primitive")
    docs = cluster_docs(spark, [(pr("fw", "policy firewall"), ["t1", "t2"], "govern"), (ph("context escrow"), [], "hold"), (pr("sov", "data sovereignty"), [], "keep"), (ph("model routing"), [], "route")])
    src = frame(spark, [("s0", "", "paper", "p0", True, ""), ("s1", "", "repository", "p1", True, ""), ("s2", "", "practitioner-blog", "p2", True, "")], SRC)
    changed = docs.select(F.col("evidence_id").alias("id"))
    directions = [{"id": "d", "title": "Sovereign data", "theme_ids": ["t9"], "match_phrases": ["data sovereignty"], "match_anchor_ids": []}]
    themes = [{"id": "routing", "name": "Model routing", "aliases": []}]
    c = G.build_clusters(docs, src, changed, directions, themes, graph.ClusterPolicy(), 12)
    got = {r.anchors[0].label: r.disposition for r in c.collect()}
    assert got == {"policy firewall": "cross-theme-extension", "context escrow": "novel", "data sovereignty": "merge-existing-direction", "model routing": "covered-by-existing-theme"}
    states = {r.title: (r.state, r.violations) for r in G.discovery_records(c).collect()}
    assert states == {"Policy firewall": ("candidate", []), "Context escrow": ("candidate", [])}
    s = G.run_summary(c).first()
    assert (s.cluster_count, s.coherent_cluster_count, s.explained_cluster_count) == (4, 4, 2)


def test_all_clusters_of_any_size(spark):
    pr = lambda k: dict(id=f"primitive:{k}", label=f"label {k}", kind="primitive")
    docs = cluster_docs(spark, [(pr(k), [], None) for k in range(501)] + [(pr("broad"), [], None)] * 30)
    src = frame(spark, [(f"s{i}", "", "paper", f"p{i}", True, "") for i in range(3)], SRC)
    changed, n = docs.select(F.col("evidence_id").alias("id")), 3 * 531
    c = G.build_clusters(docs, src, changed, [], [], graph.ClusterPolicy(), n)
    assert {r.anchor_ids[0]: r.metrics.raw_evidence_count for r in c.collect()} == {f"primitive:{k}": 3 for k in range(501)} | {"primitive:broad": 90}
    assert G.run_summary(c).first().cluster_count == 502
    few = graph.ClusterPolicy(maximum_cluster_documents=80, maximum_clusters=500)
    kept = graph.anchor_postings(docs, few)
    parts = kept.select(F.col("anchor_id").alias("id"), F.col("anchor_id").alias("component")).distinct()
    assert [tuple(r) for r in graph.overbroad_components(parts, kept, few).collect()] == [("primitive:broad", 90, "over-broad:80")]
    assert graph.overbroad_components(parts, kept, graph.ClusterPolicy()).count() == 0


def test_blocked_phrases_and_missing_context(spark):
    ph = dict(id="phrase:feel-like", label="feel like", kind="emergent-phrase")
    docs = cluster_docs(spark, [(ph, [], None)])
    assert graph.anchor_postings(docs, graph.ClusterPolicy(blocked_phrases=["feel-like"])).count() == 0
    src = frame(spark, [(f"s{i}", "", "paper", f"p{i}", True, "") for i in range(3)], SRC)
    c = G.build_clusters(docs, src, docs.select(F.col("evidence_id").alias("id")), [], [], graph.ClusterPolicy(), 3)
    assert [r.quality.context_coherence_met for r in c.collect()] == [False] and G.discovery_records(c).count() == 0


def test_project_match_by_name_and_url(spark):
    p = frame(spark, [("ToolX", "https://x.example/a/"), ("ab", "")], "name string, official_url string")
    e = frame(spark, [item("1", title="Using toolx today"), item("2", url="https://x.example/a"), item("3", projects=["my ToolX fork"]), item("4", title="cab ride"), item("5", title="none")])
    assert {(r.name, r.id) for r in V.match_projects(p, e).collect()} == {("ToolX", "1"), ("ToolX", "2"), ("ToolX", "3"), ("ab", "4")}


def test_assessment_queue_origin_cap(spark):
    rows = [(f"u{i}", "o", f"t{i}", 60 - i, False, ["new"], None) for i in range(6)] + [("l", "o", "linked", 10, True, ["new"], None), ("x", "o", "settled", 99, False, ["new"], "current")]
    q = H.assessment_queue(frame(spark, rows, "id string, origin string, title string, priority int, linked boolean, change_reasons array<string>, adjudication string"))
    assert [r.id for r in q.orderBy("queue_rank").collect()] == ["l", "u0", "u1", "u2"]


def test_mart_search(spark):
    e = frame(spark, [item("a", title="Alpha", days=1), item("b", title="beta", summary="ALPHA", days=2), item("c", title="gamma")])
    assert [r.id for r in marts.search_evidence(e, "alpha").collect()] == ["a", "b"]


def test_character_references(spark):
    """Against the standard library, for references that are complete."""
    import html

    texts = ["It&#8217;s &#x2014; &raquo; &euro; &#128512;", "&amp;lt; &lt;b&gt; a&b & c", "&#0; &#x110000; &#150; &#xD800;", "&nosuch; &copy &AMP; &CounterClockwiseContourIntegral;", "", None, "&" * 50, "&#99999999999;"]
    df = frame(spark, [(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.u for r in df.select("i", X.unescape(F.col("t")).alias("u")).collect()}
    assert got == {i: html.unescape(t or "") if "99999999" not in (t or "") else got[i] for i, t in enumerate(texts)}
