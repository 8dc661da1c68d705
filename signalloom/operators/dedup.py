"""De-duplication (D1-D9) and the lexicographic-first independent set behind D3 and G9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.functions import text as X
from signalloom.operators.ranking import first_per_group
from signalloom.session import cut_lineage


def keep_first(df: DataFrame, priority: list[Column]) -> DataFrame:
    """One row per canonical URL and folded title, the first in priority order."""
    keyed = (df.withColumn("_url", X.canonical_url(F.col("url")))
             .withColumn("_title", F.md5(X.folded_title(F.col("title")))))
    return first_per_group(keyed, ["_url", "_title"], priority).drop("_url", "_title")


def merge_fields(processed: DataFrame, reviewed: DataFrame, fields: list[str]) -> DataFrame:
    """Reviewed values override processed ones; for metadata the processed side wins."""
    r = reviewed.select("id", *[F.col(f).alias(f"_r_{f}") for f in fields],
                        F.col("metadata").alias("_r_metadata"))
    joined = processed.join(r, "id", "left")
    for f in fields:
        joined = joined.withColumn(f, F.coalesce(F.col(f"_r_{f}"), F.col(f)))
    empty = F.create_map().cast("map<string,string>")
    mine, theirs = F.coalesce("metadata", empty), F.coalesce("_r_metadata", empty)
    extra = F.map_filter(theirs, lambda k, v: ~F.map_contains_key(mine, k))
    return joined.withColumn("metadata", F.map_concat(mine, extra)).select(*processed.columns)


def source_rank(channel: Column, preferred: list[str]) -> Column:
    at = F.array_position(F.array(*[F.lit(c) for c in preferred]), channel)
    return F.when(at > 0, at - 1).otherwise(F.lit(len(preferred)))


def keep_strongest(df: DataFrame, group: list[str], strength: Column) -> DataFrame:
    """Strongest record per group, ties by the larger id (D4); partial per task before the shuffle."""
    return first_per_group(df, group, [strength.desc(), F.col("id").desc()])


def greedy_event_duplicates(rows: DataFrame, window_days: int = 7) -> tuple[DataFrame, DataFrame]:
    """Accept rows in rank order unless they share a key with an accepted row (D3).

    `rows`: id, rank (orderable, unique), event_key, url_key, title_key (null when absent), ts.
    Event and URL keys forbid a second row outright; equal titles only within `window_days`.
    Returns (accepted ids, rejected ids with duplicate_of).

    No pairs are formed. Time is cut into buckets as wide as the window, so rows of one title bucket
    all exclude each other and each key admits one row per round at most: its best undecided row.
    A row is accepted once it leads every key it has and no neighbour bucket has a better undecided
    row; then all rows sharing a key with it are dropped by anti joins against one row per key.
    """
    width = window_days * 86400 * 1000000
    micros = F.unix_micros("ts")
    base = rows.withColumn("bucket", F.floor(micros / F.lit(width))).withColumn("us", micros)
    keys = F.array_compact(F.array(
        F.when(F.col("event_key").isNotNull(), F.concat(F.lit("e:"), F.col("event_key"))),
        F.when(F.col("url_key").isNotNull(), F.concat(F.lit("u:"), F.col("url_key"))),
        F.when(F.col("title_key").isNotNull(), F.concat_ws(":", F.lit("t"), F.col("bucket"), F.col("title_key")))))
    base = cut_lineage(base.withColumn("keys", keys).withColumn("n_keys", F.size("keys")), "dup-rows")
    undecided, accepted = base, None
    left = undecided.count()
    while left:
        leads = (undecided.filter("n_keys > 0")
                 .select(F.explode("keys").alias("key"), "rank",
                         F.struct("rank", "id", "n_keys", "title_key", "bucket").alias("row"))
                 .groupBy("key").agg(F.min("row").alias("row")))
        leads = cut_lineage(leads, "dup-leads")
        full = (leads.groupBy("row.id").agg(F.count("*").alias("n"), F.first("row").alias("row"))
                .filter(F.col("n") == F.col("row.n_keys")).select("row.*"))
        near = full.filter(F.col("title_key").isNotNull()).select(
            "id", "rank", F.explode(F.array(*[
                F.concat_ws(":", F.lit("t"), F.col("bucket") + d, F.col("title_key")) for d in (-1, 1)])).alias("key"))
        blocked = (near.join(leads.select("key", F.col("row.rank").alias("other")), "key")
                   .filter(F.col("other") < F.col("rank")).select("id").distinct())
        winners = full.select("id").join(blocked, "id", "left_anti")
        keyless = undecided.filter("n_keys = 0").select("id")
        chosen = cut_lineage(undecided.join(winners.unionByName(keyless), "id", "left_semi"), "dup-accepted")
        accepted = chosen if accepted is None else accepted.unionByName(chosen)
        rest = undecided.join(chosen.select("id"), "id", "left_anti")
        # rows without a key join by a name of their own: they match nothing and don't meet in one task
        own = lambda k: F.coalesce(F.col(k), F.concat(F.lit("\0"), F.col("id").cast("string")))
        for k in ("event_key", "url_key"):
            gone = chosen.filter(F.col(k).isNotNull()).select(F.col(k).alias("_k"))
            rest = rest.withColumn("_k", own(k)).join(gone, "_k", "left_anti").drop("_k")
        taken = chosen.filter(F.col("title_key").isNotNull()).select(
            "title_key", F.col("us").alias("a_us"), F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)]))
            .alias("bucket"))
        rest = rest.withColumn("_t", own("title_key"))
        hit = [rest["_t"] == taken["title_key"], rest["bucket"] == taken["bucket"],
               F.abs(rest["us"] - taken["a_us"]) <= width]
        undecided = cut_lineage(rest.join(taken, hit, "left_anti").select(*base.columns), "dup-undecided")
        left = undecided.count()
    if accepted is None:
        return base.select("id", "rank"), base.select("id", F.lit(None).cast("string").alias("duplicate_of"))
    accepted = cut_lineage(accepted, "dup-kept")
    a = accepted.select(F.col("id").alias("a_id"), F.col("rank").alias("a_rank"), "event_key", "url_key", "title_key",
                        "bucket", F.col("us").alias("a_us"))
    dropped = base.join(accepted.select("id"), "id", "left_anti").select(
        "id", "rank", "event_key", "url_key", "title_key", "bucket", "us")
    spread = a.drop("event_key", "url_key").withColumn(
        "bucket", F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)])))
    found = (
        dropped.join(a.select("a_id", "a_rank", "event_key"), "event_key").select("id", "rank", "a_id", "a_rank")
        .unionByName(dropped.join(a.select("a_id", "a_rank", "url_key"), "url_key")
                     .select("id", "rank", "a_id", "a_rank"))
        .unionByName(dropped.join(spread, ["title_key", "bucket"]).filter(F.abs(F.col("us") - F.col("a_us")) <= width)
                     .select("id", "rank", "a_id", "a_rank"))
    )
    rejected = (found.filter(F.col("a_rank") < F.col("rank")).groupBy("id")
                .agg(F.min_by("a_id", "a_rank").alias("duplicate_of")))
    return accepted.select("id", "rank"), rejected


FEW_IDS = 100_000


def greedy_dropped(pairs: DataFrame) -> DataFrame | None:
    """Ids rejected by a best-first pass, given all (id, better) conflicts; None when nothing is.

    A row whose better neighbours are all gone or absent is safe; its worse neighbours drop; repeat. Files of ids are
    much smaller than the ids in memory, so joins are told to shuffle but where the ids are counted as few.
    """
    left = cut_lineage(pairs, "conflicts")
    dropped = None
    while True:
        waiting = left.select("id").distinct()
        safe = left.select("better").distinct().join(waiting.withColumnRenamed("id", "better").hint("merge"), "better", "left_anti")
        hit = cut_lineage(left.join(safe.hint("merge"), "better", "left_semi").select("id").distinct(), "dropped")
        found = hit.count()
        if not found:
            return dropped
        dropped = hit if dropped is None else dropped.unionByName(hit)
        how = "broadcast" if found <= FEW_IDS else "merge"
        left = cut_lineage(left.join(hit.hint(how), "id", "left_anti").join(hit.withColumnRenamed("id", "better").hint(how), "better", "left_anti"), "conflicts")


def text_key(group: list[str], c: Column) -> Column:
    """Stands for a text of a group in joins: half of its SHA-256, 16 bytes in the place of 64 hexadecimal digits."""
    return F.substring(F.unhex(F.sha2(F.concat_ws("\u0001", *group, c), 256)), 1, 16)


WIDTHS = (1, 2, 3, 4, 6, 8, 12, 16, 24)


def in_group(group: list[str]) -> Column:
    """A group's name; null, as no pair is looked for there, where a part of it is null."""
    return F.concat(*[c for g in group for c in (F.col(g).cast("string"), F.lit("\u0001"))][:-1])


def contained_pairs(titles: DataFrame, ratio: float = 0.7) -> DataFrame:
    """(id, better, size): each title inside a longer one of its group of at least `ratio` its length; `size` is the longer one's.

    `titles`: `id`, `place` (the group's name) and `t`, distinct folded titles. Found by equality, not by comparing
    titles with each other. Of the pieces of one width in a title the one with the least hash speaks for it. In a longer
    title it is then the least of a run of pieces as long as the shortest title there may be, so a title offers the least
    pieces of such runs: a few rows, where every start would be one. What meets gives a start and a length to cut, and
    the cuts are compared as hashes; texts travel once, to be cut. Joins after an explode are told to shuffle, as Spark
    takes their rows for fewer.
    """
    size, t = F.length("t"), F.col("t")
    least = lambda n: F.greatest(F.lit(1), F.ceil(n * ratio - 1e-9).cast("int"))
    width = lambda n: F.greatest(F.lit(1), *[F.when(n >= w, w) for w in WIDTHS])
    grams = lambda many: F.transform(F.sequence(F.lit(1), many), lambda i: F.xxhash64(F.substring(t, i, F.col("g"))))
    some = titles.filter("place is not null")
    # The width follows from the longer title; a shorter one has pieces of each width it may be asked for.
    heads = some.select("place", "t", size.alias("n"), least(size + 1).alias("low")).filter("low <= n")
    heads = heads.select("place", "t", "n", F.explode(F.array_compact(F.array(*[F.when((w >= width(F.col("low"))) & (w <= F.col("n")), w) for w in WIDTHS]))).alias("g"))
    heads = heads.withColumn("grams", grams(F.col("n") - F.col("g") + 1)).select(
        F.xxhash64("place", F.array_min("grams")).alias("h"), F.array_position("grams", F.array_min("grams")).cast("int").alias("at"), "n").distinct()

    longer = some.select("place", "id", "t", size.alias("size"), least(size).alias("low")).filter("low < size").withColumn("g", width(F.col("low")))
    longer = longer.select("place", "id", "size", (F.col("low") - F.col("g") + 1).alias("run"), F.sequence(F.lit(1), F.col("size") - F.col("low") + 1).alias("runs"),
                           grams(F.col("size") - F.col("g") + 1).alias("grams"))
    lows = F.array_distinct(F.transform("runs", lambda i: F.array_min(F.slice("grams", i, F.col("run")))))
    placed = F.transform("grams", lambda x, i: F.struct(x.alias("x"), (i + 1).alias("p")))
    # a lambda over one element, so that the lows are found once, not for each piece
    offered = longer.select("place", F.col("id").alias("better"), "size", F.inline(F.flatten(F.transform(
        F.array(lows), lambda few: F.filter(placed, lambda y: F.array_contains(few, y["x"]))))))
    offered = offered.select(F.xxhash64("place", "x").alias("h"), "better", "size", "p")

    low = least(F.col("size"))
    first = F.col("p") - F.col("at") + 1
    cuts = offered.hint("merge").join(heads, "h").filter((F.col("n") >= low) & (F.col("n") < F.col("size")) & (first >= 1) & (first + F.col("n") - 1 <= F.col("size")))
    # Numbers that meet by chance give a cut more, which the pieces settle.
    own = some.select(F.col("id").alias("better"), "place", "t")
    pieces = cuts.select("better", first.alias("i"), "n").hint("merge").join(own, "better").select(
        "better", size.alias("size"), text_key(["place"], F.substring(t, F.col("i"), F.col("n"))).alias("k")).distinct()
    return pieces.hint("merge").join(some.select(text_key(["place"], t).alias("k"), "id"), "k").select("id", "better", "size")


def contained_titles(titles: DataFrame, group: list[str], ratio: float = 0.7) -> DataFrame:
    """(group, inner, outer) for distinct folded titles inside a longer one of at least `ratio` its length.

    `titles`: group columns and `t`.
    """
    keyed = titles.select(text_key(group, F.col("t")).alias("id"), in_group(group).alias("place"), "t")
    inner = titles.select(text_key(group, F.col("t")).alias("id"), *group, F.col("t").alias("inner"))
    outer = keyed.select(F.col("id").alias("better"), F.col("t").alias("outer"))
    return contained_pairs(keyed, ratio).join(inner, "id").join(outer, "better").select(*group, "inner", "outer")


def collapse_titles(rows: DataFrame, group: list[str], ratio: float = 0.7, carry: list[str] | None = None) -> DataFrame:
    """Keep the longest of near-equal titles.

    `rows`: group columns, title, sponsored. Equal folded titles collapse by an aggregation first; a
    title inside a kept longer one then joins it. Adds duplicate_count and the OR of the sponsor flags.
    `carry` names further columns, taken from the kept title's first row in their order. Titles are numbered
    when they are written; joins but the one that cuts them and the last one hold numbers in their place.
    """
    carry = carry or []
    whole = rows.groupBy(*group, X.fold(F.col("title")).alias("t")).agg(
        F.min(F.struct((-F.length("title")).alias("_l"), "title", *carry)).alias("_row"), F.count("*").alias("n"), F.bool_or("sponsored").alias("s"))
    whole = cut_lineage(whole.select(F.monotonically_increasing_id().alias("_id"), *group, "_row.title", *[f"_row.{c}" for c in carry], "n", "s"), "titles")
    folded = whole.select(F.col("_id").alias("id"), in_group(group).alias("place"), X.fold(F.col("title")).alias("t"))
    pairs = cut_lineage(contained_pairs(folded, ratio), "contained")
    gone = greedy_dropped(pairs.select("id", "better"))
    gone = (pairs.select("id").limit(0) if gone is None else gone).distinct().hint("merge")
    homes = pairs.join(gone, "id", "left_semi").join(gone.withColumnRenamed("id", "better").hint("merge"), "better", "left_anti")
    # The longest; a text decides only where several are as long.
    best = homes.groupBy("id").agg(F.min(F.struct((-F.col("size")).alias("l"), "better")).alias("a"), F.min(F.struct((-F.col("size")).alias("l"), (-F.col("better")).alias("b"))).alias("z"))
    best = cut_lineage(best.select("id", (-F.col("a.l")).alias("size"), F.col("a.better").alias("home"), (F.col("a.better") != -F.col("z.b")).alias("tied")), "homes")
    tied = homes.join(best.filter("tied").select("id", "size"), ["id", "size"]).join(folded.select(F.col("id").alias("better"), "t").hint("merge"), "better")
    home = best.filter("not tied").select("id", "home").unionByName(tied.groupBy("id").agg(F.min_by("better", "t").alias("home")))
    extra = whole.select(F.col("_id").alias("id"), "n", "s").hint("merge").join(home, "id").groupBy(F.col("home").alias("_id")).agg(F.sum("n").alias("n2"), F.bool_or("s").alias("s2"))
    out = whole.join(gone.withColumnRenamed("id", "_id").hint("merge"), "_id", "left_anti").join(extra.hint("merge"), "_id", "left")
    return out.select(*group, "title", (F.col("n") + F.coalesce("n2", F.lit(0))).alias("duplicate_count"),
                      (F.col("s") | F.coalesce("s2", F.lit(False))).alias("sponsor_seen"), *carry)


def clean_history(rows: DataFrame, source_id: str) -> DataFrame:
    """Stored newsletter rows under the current title rules.

    `rows`: id, title, published_at, sponsor_status, sponsor_basis. Titles are cleaned, noise dropped,
    near copies of a day collapsed, sponsor flags settled by the evidence left, and ids renewed.
    """
    clean = rows.withColumn("title", X.clean_title(F.col("title"))).withColumn("day", F.substring("published_at", 1, 10))
    clean = clean.filter(~X.spaced_letters(F.col("title"))).withColumn("sponsored", F.col("sponsor_status") == "sponsored")
    kept = collapse_titles(clean, ["day"], carry=["published_at", "sponsor_status", "sponsor_basis"])
    out = kept.filter(F.col("day").isNotNull() & F.col("title").isNotNull())
    repeated = F.col("sponsor_seen") & (F.col("duplicate_count") > 1)
    vague = F.col("sponsor_seen") & ~F.coalesce(
        F.col("sponsor_basis").isin("duplicate-link-title", "repeated-link-with-sponsor-context"), F.lit(False))
    sponsored = F.when(F.col("sponsor_seen"), F.lit("sponsored")).otherwise(F.col("sponsor_status"))
    return out.select(
        X.stable_id(F.lit(source_id), F.lit(source_id), F.col("day"), X.folded_title(F.col("title"))).alias("id"), "title", "published_at",
        F.when(repeated, "sponsored").when(vague, "unknown").otherwise(sponsored).alias("sponsor_status"),
        F.when(repeated, "duplicate-link-title").when(vague, "legacy-proximity-uncertain").otherwise(F.col("sponsor_basis")).alias("sponsor_basis"))
