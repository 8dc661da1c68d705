"""Eligibility, privacy and contract checks as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from signalloom.functions import constants as C, dates as D, text as X
from signalloom.functions.arrays import explode_rows
from signalloom.operators.dedup import greedy_event_duplicates, source_rank
from signalloom.operators.ranking import first_per_group


def blank(col: Column) -> Column:
    return F.coalesce(X.compact(col), F.lit("")) == ""


def text_columns(df: DataFrame) -> Column:
    """All string content of a row as one JSON text, for pattern scans."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def sensitive_kinds(text: Column) -> Column:
    """Names of the sensitive patterns found in `text`, in fixed order."""
    # a plain search first: most texts hold no at sign and skip the costly pattern
    may = {"email-address": F.contains(text, F.lit("@"))}
    return F.array_compact(F.array(*[
        F.when(may.get(k, F.lit(True)) & text.rlike(p), F.lit(k)) for k, p in C.SENSITIVE_PATTERNS.items()]))


def blocked_keys(json_text: Column) -> Column:
    """Blocked keys at any depth of a JSON text."""
    return F.array_compact(F.array(*[
        F.when(json_text.rlike(rf'"{k}"\s*:'), F.lit(k)) for k in C.BLOCKED_KEYS]))


def privacy_violations(df: DataFrame, key: str, json_text: Column) -> DataFrame:
    """One row per record and violation (F8); an empty result means safe to publish."""
    kinds = F.concat(sensitive_kinds(json_text),
                     F.transform(blocked_keys(json_text), lambda k: F.concat(F.lit("key:"), k)))
    return explode_rows(df.select(key, kinds.alias("_v")), "violation", "_v").drop("_v")


def fingerprint(fields: list[str] = C.FINGERPRINT_FIELDS) -> Column:
    """Stable content hash; nulls are kept so that absent and empty differ."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def eligibility(df: DataFrame, sources: DataFrame, as_of: str, lookback_days: int = 35, future_days: int = 1,
                previous: DataFrame | None = None, order: list[Column] | None = None) -> DataFrame:
    """Add reason (null when eligible), channel, publisher_id, ts, fingerprint and change_type.

    The first failing check names the reason. With an `order`, later rows of an id are duplicate
    records, whatever became of its first row; without one ids are taken as unique.
    """
    dim = sources.select(F.col("id").alias("source_id"), F.col("enabled").alias("_enabled"), "channel", "publisher_id")
    seen = F.lit(1) if order is None else F.row_number().over(Window.partitionBy("id").orderBy(*order))
    joined = df.withColumn("_occurrence", seen).join(dim, "source_id", "left").withColumn("ts", D.parse_timestamp(F.col("published_at")))
    required = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit("")) == "" for c in
                                           ("id", "source_id", "source_type", "published_at")])
    content = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    unsafe = (F.size(sensitive_kinds(content)) > 0) | (F.size(blocked_keys(content)) > 0)
    reason = (
        F.when((F.col("_occurrence") > 1) & (F.coalesce(F.col("id"), F.lit("")) != ""), "duplicate-record")
        .when(required, "missing-required-field")
        .when(blank(F.col("title")) & blank(F.col("summary")), "missing-content")
        .when(F.col("_enabled").isNull(), "unknown-source")
        .when(~F.col("_enabled"), "disabled-source")
        .when(unsafe, "not-public-safe")
        .when(F.col("ts").isNull(), "invalid-date")
        .when(F.col("ts") > D.days_before(as_of, -future_days), "future-dated")
        .when(F.col("ts") <= D.days_before(as_of, lookback_days), "outside-window")
    )
    out = joined.withColumn("reason", reason).withColumn("fingerprint", fingerprint())
    if previous is not None:
        prior = previous.select("id", F.col("fingerprint").alias("_prior"))
        out = out.join(prior, "id", "left")
        out = out.withColumn("reason", F.coalesce("reason", F.when(F.col("_prior") == F.col("fingerprint"), "unchanged")))
        out = out.withColumn("change_type", F.when(F.col("_prior").isNull(), "new-record").otherwise("materially-changed"))
        out = out.drop("_prior")
    else:
        out = out.withColumn("change_type", F.lit("new-record"))
    return out.drop("_enabled", "_occurrence")


def in_reach(df: DataFrame, sources: DataFrame, as_of: str, lookback_days: int = 35, future_days: int = 1) -> DataFrame:
    """Rows of enabled sources whose date lies in the window: no other row of unique ids can be eligible.

    Two of the checks of `eligibility` that read no text. Where only eligible rows are wanted, they come before
    everything that does; what is left still needs the other checks.
    """
    enabled = sources.filter("enabled").select(F.col("id").alias("source_id"))
    at = D.parse_timestamp(F.col("published_at"))
    return df.filter((at <= D.days_before(as_of, -future_days)) & (at > D.days_before(as_of, lookback_days))).join(enabled, "source_id", "left_semi")


def repeated_ids(df: DataFrame, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """First row of every id, and how many later rows each id had (duplicate-record)."""
    first = first_per_group(df, ["id"], order)
    extra = df.groupBy("id").count().filter("count > 1").select("id", (F.col("count") - 1).alias("repeats"))
    return first, extra


def duplicate_events(eligible: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Collapse reports of one event among eligible rows (D3)."""
    def present(c: Column) -> Column:
        return F.when(c != "", c)
    title = X.folded_title(F.col("title"))
    rows = eligible.select(
        "id", "ts",
        F.struct(source_rank(F.col("channel"), C.PREFERRED_CHANNELS).alias("c"),
                 (-F.datediff("ts", F.lit("1970-01-01").cast("date"))).alias("d"), F.col("id").alias("i")).alias("rank"),
        present(F.try_element_at("metadata", F.lit("event_id"))).alias("event_key"),
        present(X.canonical_url(F.col("url"))).alias("url_key"),
        F.when(title != "", F.md5(title)).alias("title_key"),
    )
    return greedy_event_duplicates(rows)


def verification(metadata: Column, source_type: Column) -> Column:
    """Metadata entries the source type may publish, nulls dropped."""
    allowed = F.create_map(*[x for k, v in C.VERIFICATION_FIELDS.items()
                             for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))])
    mine = F.coalesce(F.try_element_at(allowed, source_type), F.array().cast("array<string>"))
    return F.map_filter(metadata, lambda k, v: F.array_contains(mine, k) & v.isNotNull())


def public_rows(df: DataFrame) -> DataFrame:
    out = df.withColumn("verification", verification(F.col("metadata"), F.col("source_type")))
    return out.select(*[c for c in C.PUBLIC_FIELDS if c in out.columns])


def failed(tests: dict[str, Column]) -> Column:
    """Codes of the tests that hold (a test is a violation)."""
    return F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]))


def link_contract(df: DataFrame, event_ids: list[str], prohibited: list[str]) -> DataFrame:
    """Violations of submitted social links (F9); rows with none are accepted.

    Repeated ids are judged outside, by repeated_ids.
    """
    host = X.url_host(F.col("post_url"))
    wanted = F.when(F.lower("platform") == "linkedin", "linkedin.com").when(F.lower("platform") == "x", "x.com")
    known = F.array(*[F.lit(e) for e in event_ids])
    tests = {
        "prohibited-field": reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in prohibited if c in df.columns],
                                   F.lit(False)),
        "missing-field": reduce(lambda a, b: a | b, [blank(F.col(c)) for c in (
            "id", "platform", "post_url", "author_name", "published_at", "observation")])
        | (F.size(F.coalesce("event_ids", F.array())) == 0),
        "unsupported-platform": wanted.isNull(),
        "unknown-event": F.size(F.array_except(F.coalesce("event_ids", F.array()), known)) > 0,
        "host-mismatch": ~F.coalesce((host == wanted) | F.endswith(host, F.concat(F.lit("."), wanted)), F.lit(False)),
        "observation-too-long": F.length(X.compact(F.col("observation"))) > 700,
    }
    return df.withColumn("violations", failed(tests))


def gate_state(evidence: Column, events: Column, sources: Column, families: Column, share: Column, technical: Column,
               novelty_reviewed: Column) -> Column:
    """Highest mechanical state of a discovery record; never approved."""
    candidate = (evidence >= 3) & (events >= 3) & (sources >= 3) & (families >= 2) & (share <= 0.5)
    spark = ((evidence >= 2) & (sources >= 2)) | ((evidence >= 1) & (technical >= 1) & novelty_reviewed)
    return F.when(candidate, "candidate").when(spark, "spark")


def record_contract(df: DataFrame) -> DataFrame:
    """Violations of discovery records."""
    m = lambda c: F.col(f"metrics.{c}")
    texts = ["id", "title", "observed_pattern", "hypothesis", "why_now", "novelty"]
    lists = ["evidence_ids", "source_ids", "source_family_ids", "theme_ids", "concepts"]
    counts = ["evidence_count", "independent_event_count", "source_count", "source_family_count",
              "technical_record_count"]
    state = gate_state(m("evidence_count"), m("independent_event_count"), m("source_count"), m("source_family_count"),
                       m("dominant_publisher_share"), m("technical_record_count"), F.col("novelty_reviewed"))
    needed = F.create_map(*[F.lit(x) for kv in C.TERMINAL_ACTIONS.items() for x in kv])
    expected = F.try_element_at(needed, F.col("state"))
    any_of = lambda cols: reduce(lambda a, b: a | b, cols)
    tests = {
        "unknown-state": ~F.col("state").isin(*C.STATE_TRANSITIONS),
        "empty-text": any_of([blank(F.col(c)) for c in texts]),
        "repeated-list-value": any_of([F.size(F.array_distinct(c)) != F.size(c) for c in lists]),
        "empty-list": any_of([F.size(c) < 1 for c in lists if c != "theme_ids"]),
        "dates-out-of-order": F.coalesce(
            D.parse_timestamp(F.col("first_seen")) > D.parse_timestamp(F.col("last_seen")), F.lit(True)),
        "negative-count": any_of([m(c) < 0 for c in counts]),
        "share-out-of-range": ~m("dominant_publisher_share").between(0, 1),
        "evidence-count-mismatch": m("evidence_count") != F.size("evidence_ids"),
        "source-count-mismatch": m("source_count") != F.size("source_ids"),
        "family-count-mismatch": m("source_family_count") != F.size("source_family_ids"),
        "events-exceed-evidence": m("independent_event_count") > m("evidence_count"),
        "technical-exceeds-evidence": m("technical_record_count") > m("evidence_count"),
        "candidate-gate-not-met": F.col("state").isin("candidate", "approved") & (F.coalesce(state, F.lit("")) != "candidate"),
        "spark-gate-not-met": (F.col("state") == "spark") & state.isNull(),
        "review-action": expected.isNotNull() & ((F.col("review_status") != "decided")
                                                | (F.coalesce("review_action", F.lit("")) != expected)),
        "unknown-action": F.col("review_action").isNotNull() & ~F.col("review_action").isin(*C.REVIEW_ACTIONS),
    }
    return df.withColumn("violations", failed(tests))


def illegal_moves(log: DataFrame) -> DataFrame:
    """State changes the transition table does not allow."""
    table = F.create_map(*[x for k, v in C.STATE_TRANSITIONS.items()
                           for x in (F.lit(k), F.array(*[F.lit(i) for i in v]).cast("array<string>"))])
    allowed = F.coalesce(F.try_element_at(table, F.col("from_state")), F.array().cast("array<string>"))
    return log.filter(~F.array_contains(allowed, F.col("to_state")))


def schema_gaps(df: DataFrame, required: dict[str, str]) -> list[str]:
    """Columns missing from `df` or of another type than the contract states (F11, structural part)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, ddl in required.items():
        want = T._parse_datatype_string(ddl)
        if name not in have:
            out.append(f"missing:{name}")
        elif have[name].simpleString() != want.simpleString():
            out.append(f"type:{name}")
    return out


def value_gaps(df: DataFrame, key: str, not_null: list[str], enums: dict[str, list[str]],
               minima: dict[str, float]) -> DataFrame:
    """Rows breaking null, enumeration or minimum rules, one row per violation (F11, value part)."""
    tests = {f"null:{c}": F.col(c).isNull() for c in not_null}
    tests |= {f"enum:{c}": ~F.coalesce(F.col(c).isin(*v), F.lit(True)) for c, v in enums.items()}
    tests |= {f"minimum:{c}": F.coalesce(F.col(c) < v, F.lit(False)) for c, v in minima.items()}
    return explode_rows(df.select(key, failed(tests).alias("_v")), "violation", "_v").drop("_v")


def case_link_checks(cases: DataFrame, links: DataFrame, evidence: DataFrame) -> DataFrame:
    """Violations of case evidence links, one row per case and code.

    links: case_id, evidence_id, event_id, relationship, dimensions, exclusion_reason.
    """
    relations = ["direct-support", "supporting-context", "counterevidence", "discovery-only", "excluded"]
    unknown = (links.join(evidence.select(F.col("id").alias("evidence_id")), "evidence_id", "left_anti")
               .select("case_id", F.lit("unknown-evidence").alias("violation")))
    repeated = (links.groupBy("case_id", "evidence_id").count().filter("count > 1")
                .select("case_id", F.lit("repeated-evidence").alias("violation")))
    allowed = F.array(*[F.lit(d) for d in C.DIMENSIONS])
    per_link = explode_rows(links.select("case_id", failed({
        "unknown-relationship": ~F.col("relationship").isin(*relations),
        "unknown-dimension": F.size(F.array_except("dimensions", allowed)) > 0,
        "exclusion-without-reason": (F.col("relationship") == "excluded") & blank(F.col("exclusion_reason")),
    }).alias("_v")), "violation", "_v").drop("_v")
    direct = F.col("relationship") == "direct-support"
    technical = direct & F.array_contains("dimensions", "technical_reality")
    sums = links.groupBy("case_id").agg(
        F.count_distinct(F.when(direct, F.col("event_id"))).alias("events"),
        F.count_distinct(F.when(technical, F.col("event_id"))).alias("artifacts"),
        F.max(F.col("relationship") == "counterevidence").alias("has_counter"))
    c = cases.join(sums, "case_id", "left").fillna({"events": 0, "artifacts": 0, "has_counter": False})
    level = lambda name: F.try_element_at("assessments", F.lit(name))
    three = ["low", "moderate", "high"]
    per_case = explode_rows(c.select("case_id", failed({
        "invalid-level": reduce(lambda a, b: a | b, [
            ~F.coalesce(level(d).isin(*C.LEVELS), F.lit(False)) for d in C.DIMENSIONS]),
        "invalid-confidence": ~F.coalesce(level("confidence").isin(*three), F.lit(False)),
        "invalid-concentration": ~F.coalesce(level("concentration").isin(*three), F.lit(False)),
        "counterevidence-missing": F.col("counterevidence_reviewed") & ~F.col("has_counter"),
        "concentration-caps-independence": (level("concentration") == "high") & (level("evidence_independence") != "low"),
        "concentration-caps-confidence": (level("concentration") == "high") & (level("confidence") == "high"),
        "review-caps-confidence": ~F.col("counterevidence_reviewed") & (level("confidence") == "high"),
        "events-mismatch": F.col("qualifying_events") != F.col("events"),
        "artifacts-mismatch": F.col("technical_artifacts") != F.col("artifacts"),
    }).alias("_v")), "violation", "_v").drop("_v")
    return unknown.unionByName(repeated).unionByName(per_link).unionByName(per_case).distinct()
