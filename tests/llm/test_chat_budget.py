"""Chat windows keep their budget of tokens."""

import math
import random

import pytest

from siftframe.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def sizes(formatted):
    """Tokens of each turn of a window."""
    parts = formatted.split(chat.START)[1:]
    return [math.ceil(len(chat.START + p) / 4) for p in parts]


@pytest.mark.parametrize("budget", [chat.Budget(200, 60, 40), chat.Budget(64, 0, 8), chat.Budget(30, 30, 100)])
def test_no_window_passes_the_budget(spark, budget):
    rng = random.Random(budget.new)
    rows = []
    for conv in range(6):
        system = "word " * rng.choice([2, 20, 100])
        rows.append((conv, 0, "system", system))
        for i in range(1, 120):
            n = rng.choice([1, 5, 20, 60, 400 if rng.random() < 0.1 else 3])
            rows.append((conv, i, "user" if i % 2 else "assistant", "word " * n))
    windows = chat.windows(spark.createDataFrame(rows, TURNS), budget).collect()
    alone = 0
    for w in windows:
        each = sizes(w["formatted"])
        assert len(each) == w["n_context"] + w["n_turns"]
        new, context = each[w["n_context"] :], each[: w["n_context"]]
        if sum(new) > budget.new:
            assert len(new) == 1
            alone += 1
        else:
            assert sum(each) <= budget.total
        assert sum(context) <= budget.history + budget.system
    assert alone > 0 and len(windows) > 20
    for conv in range(6):
        mine = sorted((w for w in windows if w["conv_id"] == conv), key=lambda w: w["window"])
        assert sum(w["n_turns"] for w in mine) == 120
        opening = sizes(mine[0]["formatted"])[0]
        repeated = {w["formatted"].startswith(chat.START + "system\n") for w in mine[1:]}
        assert repeated == {opening <= budget.system}


def test_history_is_what_came_just_before(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"text {i:03d}") for i in range(60)]
    windows = sorted(chat.windows(spark.createDataFrame(rows, TURNS), chat.Budget(50, 25, 0)).collect(), key=lambda w: w["window"])
    seen = 0
    for w in windows:
        numbers = [int(p.split("text ")[1][:3]) for p in w["formatted"].split(chat.START)[1:]]
        assert numbers == list(range(seen - w["n_context"], seen + w["n_turns"]))
        assert len(w["loss"]) == sum(1 for n in numbers[w["n_context"] :] if n % 2 == 0)
        seen += w["n_turns"]
    assert seen == 60 and all(w["n_context"] > 0 for w in windows[1:])
