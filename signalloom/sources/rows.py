"""Evidence rows as every parser returns them: one shape, whatever the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LISTS = ["authors", "tags", "projects", "event_ids", "artifact_urls"]
TEXTS = ["id", "source_id", "source_type", "title", "url", "published_at", "summary", "sponsor_status"]
ORDER = ["id", "source_id", "source_type", "title", "url", "published_at", "summary", *LISTS, "sponsor_status", "metadata"]


def filled(items: Column) -> Column:
    """The entries of a list that are neither null nor empty."""
    return F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda v: F.coalesce(v, F.lit("")) != "")


def evidence_rows(df: DataFrame, given: dict[str, Column], metadata: dict[str, Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rows of the evidence schema: `given` columns, empty texts and lists for the rest, metadata without nulls.

    `keep` names columns of `df` that follow, where a caller reads them by themselves.
    """
    out = []
    for name in TEXTS + LISTS:
        col = given.get(name)
        if name in LISTS:
            col = F.array().cast("array<string>") if col is None else filled(col)
        else:
            col = F.lit("unknown" if name == "sponsor_status" else "") if col is None else F.coalesce(col.cast("string"), F.lit(""))
        out.append(col.alias(name))
    pairs = [x for k, v in (metadata or {}).items() for x in (F.lit(k), v.cast("string"))]
    every = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    out.append(F.map_filter(every, lambda k, v: v.isNotNull()).alias("metadata"))
    return df.select(*out, *(keep or [])).select(*ORDER, *(keep or []))
