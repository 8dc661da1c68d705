import hashlib
import os
import random
from collections import Counter

import pytest
import sentencepiece
from helpers import BIG, ODD, documents, plain
from tokenizers import Tokenizer

from signalloom.llm import alignment, bpe
from signalloom.llm.queries import PIECES, TOKENIZER

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SF = "/root/testdata/sf0.001"
MORE = [(20, "<|endoftext|> and <s> or <unk></s>"), (21, "a▁b"), (22, " two  blanks \t\n"), (23, "café กำ \U0001f9d1‍\U0001f680"), (24, "\x00\x01"), (30, "a\n \nb c \n d\t e"), (31, " "), (32, "x  "), (33, "one\u00a0two \u2003three\x1cfour  five"),
        (34, "it's we've 're 'LL !!! ?x 12ab"), (35, "tail▁ x ▁ y"), (36, "\ufeffbom \u200b zero"),
        (25, "The rain in Spain, the rain."), (26, "THE RAIN the rain 12345 don't"), (BIG, "The rain in Spain, the rain."), (None, "the rain")]


def brute(rows):
    """With the two libraries, one text after the other."""
    a_model = Tokenizer.from_file(TOKENIZER)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = {c: b for b, c in bpe.byte_letters().items()}
    raw_a = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in a_model.get_vocab().items()}

    def raw_b(i):
        p = b_model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc_id, text in rows:
        want = f" {text}".encode()
        a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        if not text or b"".join(raw_a[i] for i in a) != want or b"".join(map(raw_b, b)) != want:
            docs.append((doc_id, 0, 0, [], ""))
            continue
        groups, links, left, right, at, to, j = [], [], [], [], 0, 0, 0
        for i in a:
            left.append(i)
            at += len(raw_a[i])
            while to < at:
                right.append(b[j])
                to += len(raw_b(b[j]))
                j += 1
            if to == at:
                groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                links.append((left[-1], right[-1]))
                left, right = [], []
        counts.update(links)
        docs.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return plain([dict(zip(COLUMNS, (i, a, b, len(k), len(k), sum(counts[p] == best[p[1]] for p in k), sum(counts[p] for p in k), d))) for i, a, b, k, d in docs], *COLUMNS)


def test_against_the_libraries(spark):
    rows = [*ODD, *MORE] * 2
    want = brute(rows)
    for frequent in (alignment.FREQUENT, 20, 1):  # most pairs broadcast; most joined; all joined
        assert plain(alignment.align(documents(spark, rows).repartition(5), TOKENIZER, PIECES, frequent).collect(), *COLUMNS) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert plain(alignment.align(docs, TOKENIZER, PIECES).collect(), *COLUMNS) == want
    assert plain(alignment.align(docs, TOKENIZER, PIECES, 300).collect(), *COLUMNS) == want


def test_empty_table(spark):
    assert alignment.align(documents(spark, []), TOKENIZER, PIECES).count() == 0
    assert plain(alignment.align(documents(spark, [(1, None), (2, "")]), TOKENIZER, PIECES).collect(), *COLUMNS) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_random_texts_of_blanks_and_marks(spark):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice(["a", "bc", "The", "é", "日", " ", " ", " ", "  ", "\n", "\t", "\u00a0", ".", "'s", "▁", "7", "🙂"]) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    assert plain(alignment.align(documents(spark, rows), TOKENIZER, PIECES).collect(), *COLUMNS) == brute(rows)


def test_forgetting_units_changes_nothing(monkeypatch):
    aligner = alignment.Aligner(open(TOKENIZER, encoding="utf-8").read(), open(PIECES, "rb").read())
    texts = [f"some words {i} and {i * 7919} more" for i in range(300)] + ["", "▁"]
    want = [tuple(map(str, x)) for x in aligner.links(texts)]
    monkeypatch.setattr(alignment, "UNITS", 10)
    assert [tuple(map(str, x)) for t in texts for x in aligner.links([t])] == want
