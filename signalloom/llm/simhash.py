"""Document fingerprints by SimHash with permuted block tables (operator 3, native).

The terms of a text are its pairs of neighbouring words, weighted by their letters (1 to 8) and their number.
Each term's two 64-bit hashes vote with its weight on 128 signed bits. Votes are 64 sums in one code-generated
aggregation: a sum adds the bits i and i + 32 of a hash at once, in two lanes of 32 bits; a text that fits Spark
(2^31 bytes) can't overflow a lane. A bit is set where its ones outweigh half of the total.

Fingerprints within a Hamming radius are found in permuted block tables: 128 bits are 8 blocks; within a
radius of 6 two blocks at least are equal, so the 28 tables keyed by two blocks hold every pair. Equal
fingerprints are one row there, and a pair is made only in the first table that holds it. Spark sizes such a table
like the rows before they are copied, so it is told how to join: the queries are broadcast where they stand in at most
`BROADCAST_ROWS` rows (counted), else both sides are shuffled. Tables of a row per document are never broadcast.

The edited texts need a document's successor: ranks are made on ids alone, and texts are shuffled once by id
(one exchange, used twice) plus the part of the successor that is needed.

Defined results: null texts count as empty; a text without words has itself as its one term; equal texts have
equal fingerprints; null ids come first in the order; rows of equal id are ordered by a hash of their text, and rows equal in
both are one document; the successor of the last is the first; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from signalloom.llm.decontam import WORD
from signalloom.operators.ranking import global_rank
from signalloom.session import cut_lineage

BITS, BLOCKS, BLOCK_BITS, EQUAL_BLOCKS = 128, 8, 16, 2
RADIUS = BLOCKS - EQUAL_BLOCKS
LANES = (1 << 32) + 1
HALF = (1 << 32) - 1
BROADCAST_ROWS = 1 << 20


def fingerprints(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, fp_a, fp_b): the 128 bits of each row's text; rows equal in all keys must have equal texts."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    d = df.select(*keys, text, words.alias("_w"))
    d = d.select(*keys, F.when(F.size("_w") > 0, F.col("_w")).otherwise(F.array(text)).alias("_w"))
    d = d.select(*keys, "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - 1)).alias("_i"))
    d = d.select(*keys, F.get("_w", F.col("_i")).alias("_x"), F.get("_w", F.col("_i") + 1).alias("_y"))
    letters = F.length("_x") + F.coalesce(F.length("_y"), F.lit(0))
    weight = F.greatest(F.lit(1), F.least(F.lit(8), F.floor(letters / 3))).cast("long")
    d = d.select(*keys, F.xxhash64("_x", "_y").alias("_a"), F.xxhash64(F.lit(1), "_x", "_y").alias("_b"), weight.alias("_weight"))
    lane = lambda h, i: F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(LANES)) * F.col("_weight"))
    sums = [lane(h, i).alias(f"{h}{i}") for h in ("_a", "_b") for i in range(32)]
    voted = d.groupBy(*keys).agg(F.sum("_weight").alias("_total"), *sums)

    def bits(h: str) -> Column:
        each = []
        for i in range(32):
            s = F.col(f"{h}{i}")
            for ones, place in ((s.bitwiseAND(F.lit(HALF)), i), (F.shiftrightunsigned(s, 32), i + 32)):
                each.append(F.when(ones * 2 > F.col("_total"), F.shiftleft(F.lit(1).cast("long"), place)).otherwise(F.lit(0).cast("long")))
        return reduce(lambda x, y: x.bitwiseOR(y), each)

    return voted.select(*keys, bits("_a").alias("fp_a"), bits("_b").alias("fp_b"))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return sum(F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """The cosine of the weighted terms that the distance stands for, 0 for an obtuse angle."""
    return F.greatest(F.lit(0.0), F.cos(distance(a, b) * math.pi / BITS))


def hexed(a: Column, b: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in (a, b)]))


def blocks(prefix: str = "") -> list[Column]:
    return [F.shiftrightunsigned(f"{prefix}{c}", k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for c in ("fp_a", "fp_b") for k in range(64 // BLOCK_BITS)]


def within_radius(queries: DataFrame, points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(q_a, q_b, fp_a, fp_b, dist): every pair of a query and a point (fp_a, fp_b) at most `radius` bits apart.

    Both sides are made distinct first. Each row stands in 28 tables; its key in a table is the table's two blocks' places
    and bits.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the tables hold every pair only up to a radius of {RADIUS}")
    places = list(combinations(range(BLOCKS), EQUAL_BLOCKS))

    def tables(df: DataFrame) -> DataFrame:
        b = blocks()
        keys = [F.lit(i << 35 | j << 32).bitwiseOR(F.shiftleft(b[i], BLOCK_BITS)).bitwiseOR(b[j]) for i, j in places]
        return df.select("fp_a", "fp_b", F.explode(F.array(*keys)).alias("key"))

    asked = cut_lineage(queries.select("fp_a", "fp_b").distinct(), "asked")
    how = "broadcast" if asked.count() * len(places) <= BROADCAST_ROWS else "merge"
    q = tables(asked).withColumnsRenamed({"fp_a": "q_a", "fp_b": "q_b"})
    p = tables(points.select("fp_a", "fp_b").distinct())
    d = distance((F.col("q_a"), F.col("q_b")), (F.col("fp_a"), F.col("fp_b")))
    equal = [(x.bitwiseXOR(y) == 0).cast("int") for x, y in zip([F.shiftrightunsigned(c, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for c in ("q_a", "q_b") for k in range(4)], blocks())]
    mask = reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(e, k) for k, e in enumerate(equal)])
    i, j = F.shiftright("key", 35).cast("int"), F.shiftright("key", 32).bitwiseAND(F.lit(7)).cast("int")
    first = mask.bitwiseAND(F.call_function("shiftleft", F.lit(1), j) - 1) == F.call_function("shiftleft", F.lit(1), i)
    both = p.join(q.hint(how), "key")
    return both.filter(d <= radius).filter(first).select("q_a", "q_b", "fp_a", "fp_b", d.alias("dist"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near.

    n_near, for ids divisible by 100 and else null: how many other documents lie within RADIUS of the fingerprint.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    id_ = F.col("doc_id").cast("long")
    base = docs.select(F.coalesce(id_, F.lit(0)).alias("k"), F.xxhash64(text, id_.isNull()).alias("th"), text.alias("text"))
    narrow = docs.select(id_.alias("doc_id"), F.coalesce(id_, F.lit(0)).alias("k"), F.xxhash64(text, id_.isNull()).alias("th"), F.length(text).cast("long").alias("n"))
    every = cut_lineage(narrow, "ids")
    once = every.distinct()
    order = [F.col("doc_id").asc_nulls_first(), F.col("th")]
    ranked = cut_lineage(global_rank(once, order), "ranked")
    total = ranked.count()
    if total < every.count():
        base = base.groupBy("k", "th").agg(F.first("text").alias("text"))
    after = F.when(F.col("rank") == total, 1).otherwise(F.col("rank") + 1)
    pairs = ranked.select("doc_id", "k", "th", "n", after.alias("after")).hint("merge").join(ranked.select(F.col("rank").alias("after"), F.col("k").alias("next_k"), F.col("th").alias("next_th")), "after")
    pairs = cut_lineage(pairs.drop("after"), "pairs")

    half = F.floor(F.col("n") / 2).cast("int")
    ask = pairs.select(F.col("k").alias("own_k"), F.col("th").alias("own_th"), "n", F.col("next_k").alias("k"), F.col("next_th").alias("th"))
    piece = base.join(ask.hint("merge"), ["k", "th"]).select(F.col("own_k").alias("k"), F.col("own_th").alias("th"), "n", F.substring("text", F.lit(1), half).alias("piece"))
    joined = base.join(piece.hint("merge"), ["k", "th"])
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n") - half).cast("int")), F.col("piece"))
    both = joined.select("k", "th", "text", edited.alias("edited"))
    digest = F.sha2("edited", 256)
    parts = [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long").alias(f"e{i}") for i in range(4)]  # the digest as numbers: text would take the aggregation out of its fast path
    both = both.select("k", "th", *parts, F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col("text").alias("t")), F.struct(F.lit(1).alias("v"), F.col("edited").alias("t")))).alias("x"))
    prints = fingerprints(both.select("k", "th", "e0", "e1", "e2", "e3", F.col("x.v").alias("v"), F.col("x.t").alias("t")), ["k", "th", "e0", "e1", "e2", "e3", "v"], "t")
    own = lambda c, v: F.max(F.when(F.col("v") == v, F.col(c)))
    prints = prints.groupBy("k", "th", "e0", "e1", "e2", "e3").agg(own("fp_a", 0).alias("fp_a"), own("fp_b", 0).alias("fp_b"), own("fp_a", 1).alias("ed_a"), own("fp_b", 1).alias("ed_b"))
    prints = cut_lineage(prints, "prints")

    following = prints.select(F.col("k").alias("next_k"), F.col("th").alias("next_th"), F.col("fp_a").alias("nx_a"), F.col("fp_b").alias("nx_b"))
    rows = prints.join(pairs.hint("merge"), ["k", "th"]).join(following.hint("merge"), ["next_k", "next_th"])
    asked = pairs.filter(F.col("doc_id") % 100 == 0).select("k", "th").hint("merge").join(prints, ["k", "th"]).select("fp_a", "fp_b")
    held = prints.groupBy("fp_a", "fp_b").agg(F.count("*").alias("docs"))
    near = within_radius(asked, held).join(held.hint("merge"), ["fp_a", "fp_b"]).groupBy(F.col("q_a").alias("fp_a"), F.col("q_b").alias("fp_b")).agg((F.sum("docs") - 1).alias("n_near"))
    rows = rows.join(near, ["fp_a", "fp_b"], "left")
    pair = lambda x: (F.col(f"{x}_a"), F.col(f"{x}_b"))
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"e{i}"), 16, "0") for i in range(4)]))
    return rows.select("doc_id", F.col("n").alias("n_chars"), sha.alias("edited_sha256"), hexed(*pair("fp")).alias("fingerprint"), hexed(*pair("ed")).alias("edited_fingerprint"),
                       likeness(pair("fp"), pair("ed")).alias("near_edited"), likeness(pair("fp"), pair("nx")).alias("near_next"), F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near"))
