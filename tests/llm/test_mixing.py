"""Operator 1: weights, budgets and permutations."""

import math
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs_frame, odd_rows, save, words  # noqa: E402

from tessera.llm import mixing  # noqa: E402


def test_exponent_meets_the_entropy():
    p = [0.7, 0.2, 0.05, 0.05, 0.0]
    for goal in (1.4, 1.7, 1.99):
        a = mixing.solve(p, ("entropy", goal))
        assert 0 < a < 1 and abs(mixing.entropy(mixing.tempered(p, a)) - goal) < 1e-6
    assert mixing.solve(p, ("entropy", 5)) == 0.0  # out of reach: uniform
    assert mixing.solve(p, ("entropy", 0.1)) == 1.0  # as found


def test_exponent_keeps_the_repetition_limit():
    p = [0.7, 0.2, 0.07, 0.03]
    for share in (None, 1.0, 0.5, 2.0):
        for limit in (0.9, 1.5, 3.0):
            a = mixing.solve(p, ("epochs", limit), share)
            worst = max(mixing.epochs(p, mixing.tempered(p, a), share))
            least = max(mixing.epochs(p, mixing.tempered(p, 1.0), share))
            assert worst <= max(limit, least) + 1e-6
            if 0 < a < 1:
                assert worst > limit - 1e-6  # the flattest mixture that keeps it
    with pytest.raises(ValueError):
        mixing.solve(p, ("nothing", 1))


def rows():
    rnd = random.Random(3)
    out = odd_rows(rnd)
    for i in range(400):
        source = rnd.choices(["big", "mid", "low", None], [60, 25, 10, 5])[0]
        out.append((100 + i, words(rnd, rnd.randint(1, 80)), "xx", source))
    return out


def tokens(text):
    return len((text or "").split())


@pytest.mark.parametrize("target, budget", [(("epochs", 1.25), None), (("epochs", 2.5), 1.0), (("entropy", 2.0), 0.4)])
def test_budgets_are_met(spark, target, budget):
    data = rows()
    totals = {}
    for r in data:
        totals[r[3]] = totals.get(r[3], 0) + tokens(r[1])
    budget = None if budget is None else budget * sum(totals.values())
    plan = mixing.plan(totals, target, budget)
    docs = docs_frame(spark, data, extra=True).drop("draw")
    got = mixing.mix(docs, target, budget, blocks=16).collect()
    assert abs(sum(w for w, _, _ in plan.values()) - 1) < 1e-9
    longest = max(tokens(r[1]) for r in data)
    drawn = {}
    for r in got:
        drawn.setdefault(r.source, []).append(r)
    for source, (weight, want, epochs) in plan.items():
        mine = drawn.get(source, [])
        have = sum(r.draw.n_tokens for r in mine)
        assert have <= want + 1e-6
        assert want - have <= min(longest, max((tokens(r[1]) for r in data if r[3] == source), default=0)) * 2
        assert all(abs(r.draw.weight - weight) < 1e-12 for r in mine)
        # whole epochs hold every row once
        for e in range(math.floor(epochs + 1e-9)):
            assert sorted((r.doc_id, r.text) for r in mine if r.draw.epoch == e and r.doc_id is not None) == sorted(
                (r[0], r[1]) for r in data if r[3] == source and r[0] is not None)
        ranks = {}
        for r in mine:
            ranks.setdefault((r.draw.epoch, r.draw.block), set()).add(r.draw.block_rank)
        assert all(len(v) == 1 for v in ranks.values())
    # another order of the blocks in another epoch
    assert all(r.draw.n_tokens == tokens(r.text) for r in got)


def test_epochs_are_permuted_anew(spark):
    data = [(i, "a b c d", "xx", "s") for i in range(300)]
    got = mixing.mix(docs_frame(spark, data), ("epochs", 9), budget=3 * 1200, blocks=32).collect()
    order = {e: [b for _, b in sorted({(r.draw.block_rank, r.draw.block) for r in got if r.draw.epoch == e})] for e in range(3)}
    assert order[0] != order[1] != order[2] and sorted(order[0]) == sorted(order[1])
    again = mixing.mix(docs_frame(spark, data).repartition(7), ("epochs", 9), budget=3 * 1200, blocks=32).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_broadcast_and_shuffle_agree(spark, monkeypatch):
    docs = docs_frame(spark, rows())
    one = sorted(map(repr, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_TURNS", 0)
    assert sorted(map(repr, mixing.mix(docs).collect())) == one


def test_empty_table_and_no_tokens(spark, tmp_path):
    assert mixing.op1_mixing(spark, save(docs_frame(spark, []), tmp_path, "documents")).count() == 0
    got = mixing.mix(docs_frame(spark, [(1, "", "xx", "s"), (2, None, "xx", None)])).collect()
    assert sorted(r.doc_id for r in got) == [1, 2]
