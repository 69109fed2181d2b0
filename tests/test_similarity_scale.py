"""The pairing step on its own rows: many tasks whatever the bytes, both joins exact, sets of several words."""

import random

import pytest

from marketscope.operators import similarity
from tests.test_similarity import brute_force, frames, run


def wide_market(seed=3, universe=150):
    """Companies with codes from three words' range; some codes no prospect holds."""
    rnd = random.Random(seed)
    clients, prospects = [f"r{i:03d}" for i in range(60)], [f"p{i:03d}" for i in range(40)]
    names = [f"k{i:03d}" for i in range(universe)]
    codes = [(c, k) for c in clients for k in rnd.sample(names, rnd.randint(0, 12))]
    codes += [(p, k) for p in prospects for k in rnd.sample(names[:-20], rnd.randint(0, 40))]
    return codes + [(c, "k000") for c in clients[::2] + prospects[::2]], clients, prospects


def pairs_of(codes, clients, prospects):
    """(prospect, customer) -> (shared, codes of the customer), for the smallest id of every set."""
    sets = {}
    for c, code in codes:
        sets.setdefault(c, set()).add(code)
    sides = [[min(same) for same in by.values()] for by in (
        {frozenset(sets[c]): [d for d in side if sets.get(d) == sets[c]] for c in side if c in sets} for side in (prospects, clients))]
    return {(p, c): (len(sets[p] & sets[c]), len(sets[c])) for p in sides[0] for c in sides[1] if sets[p] & sets[c]}


@pytest.mark.parametrize("broadcast", [similarity.BROADCAST_ROWS, -1])
def test_exact_with_broadcast_and_with_dealt_prospects(spark, monkeypatch, broadcast):
    monkeypatch.setattr(similarity, "BROADCAST_ROWS", broadcast)
    codes, clients, prospects = wide_market()
    assert run(spark, codes, clients, prospects) == brute_force(codes, clients, prospects)
    got = similarity.similarity_pairs(*frames(spark, codes, clients, prospects)).collect()
    want = pairs_of(codes, clients, prospects)
    assert len(got) == len(want) and {(r.cnpj, r.cliente): (r.intersecao, r.n_cliente) for r in got} == want


def test_pairs_are_formed_by_many_tasks(spark):
    market = frames(spark, *wide_market())
    tasks = 2 * spark.sparkContext.defaultParallelism
    assert similarity.similarity_pairs(*market).rdd.getNumPartitions() >= tasks
    sets = similarity._code_sets(*market)
    p, c = similarity._sides(sets)
    width = similarity.width_of(sets)
    assert width == 3 and similarity.candidates(p, similarity.client_index(c, p), width).rdd.getNumPartitions() >= tasks
