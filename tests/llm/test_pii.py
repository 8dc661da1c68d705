import hashlib
import random
import re

from helpers import ODD, documents

from signalloom.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    s = sum(int(c) for c in d[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])
    return s % 10 == 0


def base(t):
    out = []
    for rank, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def expected(i, t):
    b = base(t)
    n = [sum(s[2] == k for s in b) for k in PLAIN]
    return (i, *n, hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in b).encode()).hexdigest())


def random_texts():
    rng = random.Random(5)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559", "79927398713", "a.b@c.d", "x@y.z_w@v.u", "+1 (203) 555-7713", "+49 30 1234567", "10.0.0.255", "999.1.2.3", "1.2.3.4.5.6.7.8", "0001.2.3.4",
             "12345678901234567890", " ", " ", "é", "🙂", "@", "+", ".", "-", "1", "22", "a", "(", ")", "\n", "a@b", "@c.de", "%", "9" * 45 + ".1.1.1", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "--"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(800)]


def test_base_spans_like_brute_force(spark):
    rows = list(enumerate(random_texts())) + [(5000, "1 " * 20_000), (5001, "a" * 30_000 + "@"), (5002, "+1" * 5000)]
    got = {tuple(r)[:6] for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {expected(i, t) for i, t in rows}


def test_spans_hold_the_base(spark):
    rows = list(enumerate(random_texts()))
    for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        own = [f"{k}:{s}:{e}" for s, _, k, e in base(rows[r.doc_id][1])]
        listed = r.spans.split(",") if r.spans else []
        assert [x for x in listed if x.split(":")[0] in PLAIN] == own


def test_more_kinds_by_checksum_and_context(spark):
    rows = [(1, "iban GB82 WEST 1234 5698 7654 32 ok"), (2, "GB82 WEST 1234 5698 7654 33"), (3, "call (203) 555-7713 now"), (4, "part (203) 555-7713 now"), (5, "phone +1 (203) 555-7713")]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "iban:5:32", 2: "", 3: "local_phone:5:19", 4: "", 5: "phone:6:23"}


def test_account_numbers_before_upper_case_words(spark):
    german, british, belgian = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "BE68 5390 0754 7034"
    texts = [f"IBAN {german} BIC COBADEFFXXX.", "DE89370400440532013000 BIC X", f"{british} A new day", f"{german} {british} {belgian}", "DE89370400440532013000 GB82WEST12345698765432",
             f"{belgian} AND 12 MORE", f"{german}X", "DE89 3704 0044 0532 0130 01 BIC COBADEFFXXX", "AB12 " + german, f"{german}\n{british} OK", f"{german} {'A1' * 40}"]
    got = {r.doc_id: [t for t in (r.spans or "").split(",") if t] for r in pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = {0: [(5, 32)], 1: [(0, 22)], 2: [(0, 27)], 3: [(0, 27), (28, 55), (56, 75)], 4: [(0, 22), (23, 45)], 5: [(0, 19)], 6: [], 7: [], 8: [(5, 32)], 9: [(0, 27), (28, 55)], 10: [(0, 27)]}
    assert got == {i: [f"iban:{a}:{b}" for a, b in spans] for i, spans in want.items()}
    out = pii.redact(spark.createDataFrame([(1, texts[0])], "doc_id long, text string")).first()
    assert out.text == "IBAN [IBAN] BIC COBADEFFXXX."


def test_odd_rows_and_redaction(spark):
    docs = documents(spark, ODD + [(20, "🙂 mail a.b@c.de or 10.0.0.1!")])
    got = pii.report(docs).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((expected(i, t) for i, t in ODD + [(20, "🙂 mail a.b@c.de or 10.0.0.1!")]), key=str)
    out = pii.redact(docs)
    assert out.columns == docs.columns
    text = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert text == sorted(ODD + [(20, "🙂 mail [EMAIL] or [IP]!")], key=str)
    assert pii.redact(documents(spark, [])).count() == 0
