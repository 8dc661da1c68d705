"""Personal data: patterns propose, checksums confirm, context words weigh (operator 8, native).

Per row and on the scan, without a shuffle: patterns run in the JVM, and only on texts that hold the
character a kind needs. Positions come from the lengths of the gaps between matches. Base kinds (e-mail,
IP address, card with Luhn, phone) are kept as soon as their rule holds. Two more kinds are added by score: account numbers (IBAN, mod 97)
and phone numbers without a plus sign; near context words raise a score, near counter words lower it,
and spans below `KEEP` or overlapping a base span go.

Defined results: null counts as an empty text, without spans; one row comes out for each row that goes in,
repeated ids and rows included; overlapping spans of different kinds are all listed, by start, then kind;
other columns pass through the redaction and are ignored by the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEEP = 0.5
NEAR = 40
KINDS = ["email", "ip", "card", "phone", "iban", "local_phone"]
# Fixed values. The patterns match what the plain forms in the comments match, from the left and without overlap, in linear time.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ where it has 14 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # the first four characters; the group is the longest run from there that ends at a word's end, of which `account` keeps the part that holds
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9]))[A-Z]{2}[0-9]{2}",
    "local_phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}  # characters of an account number by its country code
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
CONTEXT = {
    "email": r"(?i)\b(mail|e-?mail|contact|write)\b", "ip": r"(?i)\b(ip|host|server|address)\b", "card": r"(?i)\b(card|visa|credit|payment)\b",
    "phone": r"(?i)\b(call|phone|tel|mobile|fax)\b", "iban": r"(?i)\b(iban|account|bank)\b", "local_phone": r"(?i)\b(call|phone|tel|telephone|mobile|fax)\b",
}
COUNTER = {"ip": r"(?i)\b(version|release|section)\b", "card": r"(?i)\b(order|serial|isbn)\b", "local_phone": r"(?i)\b(order|serial|isbn|id)\b"}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.3}


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn's check of a string of digits."""
    each = F.transform(F.regexp_extract_all(F.reverse(number), F.lit("[0-9]"), F.lit(0)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2))
    return F.aggregate(each, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def mod97(account: Column) -> Column:
    """ISO 7064 check of an account number: its first four characters to the end, letters as 10 to 35."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    code = lambda c: F.ascii(c) - F.when(F.ascii(c) >= 65, 55).otherwise(48)
    rest = F.aggregate(F.regexp_extract_all(turned, F.lit("[A-Z0-9]"), F.lit(0)), F.lit(0), lambda a, c: (a * F.when(F.ascii(c) >= 65, 100).otherwise(10) + code(c)) % 97)
    return F.length(plain).between(15, 34) & (rest == 1)


def account(run: Column) -> Column:
    """The part of a run, from its start to the end of a word, that is an account number, or null.

    The part of the length fixed for its country goes before others, then the longest.
    """
    words = F.split(run, " ")
    parts = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))
    good = F.filter(parts, mod97)
    fixed = F.coalesce(*[F.when(F.substring(run, 1, 2).isin(codes.split()), n) for n, codes in LENGTHS.items()])
    usual = F.filter(good, lambda p: F.length(F.regexp_replace(p, " ", "")) == fixed)
    return F.coalesce(F.get(usual, F.lit(0)), F.get(good, F.lit(0)))


def from_left(spans: Column) -> Column:
    """Of spans in order of start those that begin after the last one kept."""
    last = lambda out: F.coalesce(F.get(out, F.size(out) - 1)["end"], F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.aggregate(spans, none, lambda out, s: F.when(s["start"] >= last(out), F.concat(out, F.array(s))).otherwise(out))


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+", "")) < 4  # noqa: E731  longer ones are above 255 and may not fit a number
        return F.forall(F.split(value, r"\."), lambda p: F.when(part(p), p.cast("decimal(38,0)") <= 255).otherwise(False))
    if kind == "card":
        return luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def found(kind: str, text: Column) -> Column:
    """Array of (start, rank, kind, end, score): the matches of one kind that pass its rule, code points, end exclusive."""
    p = PATTERNS[kind]
    values, gaps = F.regexp_extract_all(text, F.lit(p), F.lit(1 if kind == "iban" else 0)), F.split(text, p)
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["gap"])
        end = start + F.length(m["value"])
        span = F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value"))
        return F.struct((start + 4 if kind == "iban" else end).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.greatest(F.lit(0), F.size(gaps) - 1)), values, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    placed = F.aggregate(pairs, begin, step, lambda acc: acc["out"])
    if kind == "iban":
        part = F.transform(placed, lambda s: F.struct(s["start"].alias("start"), account(s["value"]).alias("value")))
        held = F.filter(part, lambda s: s["value"].isNotNull())
        placed = from_left(F.transform(held, lambda s: F.struct(s["start"].alias("start"), (s["start"] + F.length(s["value"])).alias("end"), s["value"].alias("value"))))
    else:
        placed = F.filter(placed, lambda s: valid(kind, s["value"]))

    def scored(s: Column) -> Column:
        near = F.concat(text.substr(F.greatest(F.lit(1), s["start"] - NEAR + 1), F.least(s["start"], F.lit(NEAR))), F.lit(" \x00 "), text.substr(s["end"] + 1, F.lit(NEAR)))
        score = F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), 0.3).otherwise(0.0)
        if kind in COUNTER:
            score = score - F.when(near.rlike(COUNTER[kind]), 0.2).otherwise(0.0)
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"), F.least(F.lit(1.0), score).alias("score"))

    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,score:double>>")
    spans = F.transform(placed, scored)
    may = text.contains(NEEDS[kind]) if kind in NEEDS else text.rlike(p)
    return F.coalesce(F.when(may, spans), none)


def with_spans(df: DataFrame, text: str = "text", base: str = "_base", every: str = "_spans") -> DataFrame:
    """Adds the base spans and all spans, sorted, as arrays of (start, rank, kind, end, score)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = df.withColumn(base, F.array_sort(F.concat(*[found(k, t) for k in KINDS[:4]])))
    more = F.concat(*[found(k, t) for k in KINDS[4:]])
    apart = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    more = F.filter(more, lambda s: (s["score"] >= KEEP) & apart(s))
    return df.withColumn(every, F.array_sort(F.concat(base, more)))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    d = with_spans(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return d.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
                    listed(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each span, overlapping ones together, replaced by [KIND] of its first span; a null text stays null."""
    d = with_spans(docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")))
    t = F.col("text")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], t.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], piece).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("_spans", begin, step, lambda acc: F.concat(acc["out"], t.substr(acc["at"] + 1, F.length(t))))
    return d.withColumn("row", F.col("row").withField("text", F.when(F.size("_spans") > 0, clean).otherwise(t))).select("row.*")
