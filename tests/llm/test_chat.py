import random
import re
from functools import lru_cache

import pytest
from helpers import BIG

from signalloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, pos long, c long, b long, state int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], SCHEMA)


def cheapest(roles):
    """The least cost by trying every move."""
    @lru_cache(None)
    def rest(k, state):
        if k == len(roles):
            return chat.ENDING[state]
        return min(cost + rest(k + 1, t) for cost, t, _ in chat.moves(state, roles[k]))

    return rest(0, chat.START)


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "user", "assistant", "human", "tool", None]), f"m{c}.{t}"))
    return rows


def legal(text):
    turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
    assert "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns) == text
    roles = [r for r, _ in turns]
    roles = roles[1:] if roles[0] == "system" else roles
    return roles == ["user", "assistant"] * (len(roles) // 2) and len(roles) > 0


@pytest.mark.parametrize("block", [chat.BLOCK, 3])
def test_least_cost_and_legal(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = conversations(1, 30, 40)
    random.Random(2).shuffle(rows)
    got = chat.repair(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.pos)):
        by.setdefault(r.conv_id, []).append(r)
    for c, some in by.items():
        given = [x for x in sorted(rows, key=lambda x: x[1]) if x[0] == c]
        assert [r.turn for r in some] == [x[1] for x in given]
        assert sum(r.cost for r in some) == cheapest(tuple(chat.role_of(x[2]) for x in given))
        text = "".join(r.piece for r in some)
        assert legal(text) and all(x[3] in text for x in given)


def test_blocks_change_nothing(spark, monkeypatch):
    rows = conversations(4, 3, 300)
    whole = sorted(map(tuple, chat.repair(frame(spark, rows)).collect()), key=str)
    monkeypatch.setattr(chat, "BLOCK", 5)  # 300 messages: blocks of blocks of blocks
    assert sorted(map(tuple, chat.repair(frame(spark, rows)).collect()), key=str) == whole


def test_choices(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "x"), (3, 0, "system", "s"), (3, 1, "user", "<|im_end|>")]
    got = {(r.conv_id, r.turn): (r.new_role, r.action, r.inserted, r.cost) for r in chat.repair(frame(spark, rows)).collect()}
    assert got == {(1, 0): ("user", "keep", 0, 0), (1, 1): ("user", "merge", 0, 1), (1, 2): ("assistant", "keep", 0, 0), (2, 0): ("assistant", "keep", 1, 2),
                   (3, 0): ("system", "keep", 0, 0), (3, 1): ("user", "keep", 1, 2)}
    text = [r.piece for r in chat.repair(frame(spark, rows)).collect() if r.conv_id == 3 and r.turn == 1]
    assert text == ["<|im_end|>\n<|im_start|>user\n<\\|im_end|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"]


def test_conversations_with_close_ids_stay_apart(spark):
    rows = [(BIG, 0, "user", "a"), (BIG, 1, "assistant", "b"), (BIG + 2, 0, "user", "c"), (None, 0, "user", "d")]
    got = sorted((str(r.conv_id), r.pos, r.turn, r.role, r.action) for r in chat.repair(frame(spark, rows)).collect())
    assert got == sorted([(str(BIG), 0, 0, "user", "keep"), (str(BIG), 1, 1, "assistant", "keep"), (str(BIG + 2), 0, 0, "user", "keep"), ("None", 0, 0, "user", "keep")])


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 0, "user", ""), (BIG, 5, "user", "x" * 50_000), (7, 1, "user", "same"), (7, 1, "user", "same"), (7, 1, "assistant", "same"), (7, None, "assistant", "late")]
    got = sorted(chat.repair(frame(spark, rows)).collect(), key=lambda r: (str(r.conv_id), r.pos))
    assert [(r.conv_id, r.turn, r.role) for r in got] == [(BIG, 5, "user"), (7, 1, "assistant"), (7, 1, "user"), (7, 1, "user"), (7, None, "assistant"), (None, 0, "user"), (None, None, None)]
    assert chat.repair(frame(spark, [])).count() == 0
