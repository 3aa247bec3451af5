"""Windows of chat formatting against a plain greedy cut, and against the
tokens that a byte-level tokenizer really makes."""

import random

import pytest
from pyspark.sql import functions as F

from bookshift.llm import chat_format, packing
from bookshift.llm.common import table


def greedy(costs, system, budget, history):
    """Turn numbers (own, repeated) of every window; ``costs`` without the system turn."""
    room = max(budget - system, 2)
    spare = min(history, room // 2)
    own, used = [[]], 0
    for k, cost in enumerate(costs):
        if own[-1] and used + cost > room - (spare if len(own) > 1 else 0):
            own.append([])
            used = 0
        own[-1].append(k)
        used += cost
    out = []
    for k, turns in enumerate(own):
        left = min(history, room - sum(costs[i] for i in turns))
        carried = []
        for i in reversed(own[k - 1] if k else []):
            if sum(costs[j] for j in [i, *carried]) > left:
                break
            carried.insert(0, i)
        out.append((carried, turns))
    return out


@pytest.mark.parametrize("budget, history", [(400, 100), (250, 300), (90, 0)])
def test_windows_against_plain_greedy(spark, budget, history):
    rng = random.Random(5)
    talks, rows = {}, []
    for conv in range(60):
        has_system = conv % 3 == 0
        texts = ["\u00e9" * rng.choice((0, 3, 20, 60, 150, 500)) + f"{k}" for k in range(rng.randrange(1, 40))]
        roles = ["system" if has_system and k == 0 else rng.choice(("user", "assistant")) for k in range(len(texts))]
        rows += [(conv if conv else None, k, roles[k], texts[k], "extra") for k in range(len(texts))]
        pieces = [f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in zip(roles, texts)]
        talks[conv if conv else None] = (pieces, has_system)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    got = {}
    for r in chat_format.format_windows(df, budget, history).collect():
        got.setdefault(r["conv_id"], {})[r["window"]] = r
    for conv, (pieces, has_system) in talks.items():
        head, rest = (pieces[0], pieces[1:]) if has_system else ("", pieces)
        costs = [len(p.encode()) for p in rest]
        want = greedy(costs, len(head.encode()), budget, history)
        assert len(got[conv]) == len(want)
        for k, (carried, own) in enumerate(want):
            w = got[conv][k]
            assert w["formatted"] == head + "".join(rest[i] for i in carried + own)
            assert w["n_tokens"] == len(w["formatted"].encode()) and w["over_budget"] == (w["n_tokens"] > budget)
            assert not w["over_budget"] or len(own) == 1 and not carried or len(head.encode()) >= budget


def test_turns_that_fit_never_overflow(spark):
    talk = spark.createDataFrame([(1, k, "user", "x" * n) for k, n in enumerate((450, 870, 2))],
                                 "conv_id long, turn long, role string, text string")
    assert [r["over_budget"] for r in chat_format.format_windows(talk, 1024).collect()] == [False] * 3


def test_budget_holds_in_real_tokens(spark):
    windows = chat_format.format_windows(table(spark, "/root/testdata/sf0.001", "conversations")).select(
        "formatted", "own_turns", "over_budget", "n_tokens").collect()
    for w in windows:
        real = len(packing.token_ids(w["formatted"], packing.vocabulary_file())) - 1
        assert real <= w["n_tokens"]
        assert real <= chat_format.BUDGET or w["own_turns"] == 1


def test_any_token_count_can_be_given(spark):
    """Counts of ten a turn: as many turns a window as there are tens."""
    talk = spark.createDataFrame([(1, k, "user", "x" * k) for k in range(50)], "conv_id long, turn long, role string, text string")
    out = chat_format.format_windows(talk, 100, 0, tokens=lambda piece: F.lit(10).cast("long"))
    assert sorted((r["window"], r["own_turns"]) for r in out.collect()) == [(k, 10) for k in range(5)]
