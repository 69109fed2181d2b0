import random

from marketscope.operators import similarity


def brute_force(codes, clients, prospects):
    sets = {}
    for c, code in codes:
        sets.setdefault(c, set()).add(code)
    out = {}
    for p in prospects:
        sp = sets.get(p, set())
        best, best_sim = None, 0.0
        for r in sorted(clients):          # ascending id: strict '>' keeps the smallest on ties
            sr = sets.get(r, set())
            if not sp or not sr:
                continue
            sim = len(sp & sr) / len(sr)
            if sim > best_sim:
                best, best_sim = r, sim
        out[p] = (best, best_sim)
    return out


def frames(spark, codes, clients, prospects):
    return (spark.createDataFrame(codes, "cnpj string, code string"),
            spark.createDataFrame([(c,) for c in clients], "cnpj string"),
            spark.createDataFrame([(p,) for p in prospects], "cnpj string"))


def run(spark, codes, clients, prospects):
    res = similarity.most_similar(*frames(spark, codes, clients, prospects)).collect()
    assert len(res) == len({r.cnpj for r in res}) == len(set(prospects))
    return {r.cnpj: (r.cnpj_mais_similar, r.similaridade) for r in res}


def random_market(seed):
    """One random market; its companies and codes carry the seed, so markets never meet."""
    rnd = random.Random(seed)
    universe = [f"s{seed}c{i}" for i in range(rnd.choice([1, 3, 6, 12, 30]))]
    clients = [f"s{seed}r{i:02d}" for i in range(rnd.randint(0, 14))]
    prospects = [f"s{seed}p{i:02d}" for i in range(rnd.randint(1, 20))]
    widest = rnd.choice([1, 4, 30])
    codes = []
    for comp in clients + prospects:
        for code in rnd.sample(universe, rnd.randint(0, min(widest, len(universe)))):
            codes += [(comp, code)] * rnd.choice([1, 1, 2])
        if rnd.random() < 0.3:                       # a code that many companies share
            codes.append((comp, universe[0]))
    return codes, clients, prospects


def test_edge_cases(spark):
    codes = [("p1", "a"), ("p1", "b"), ("r2", "a"), ("r1", "a"),      # tie r1/r2 -> r1
             ("p2", "z"),                                              # no overlap
             ("p3", "c"), ("r3", "c"), ("r3", "d"),                    # 1/2
             ("r4", None)]
    got = run(spark, codes, ["r1", "r2", "r3", "r4"], ["p1", "p2", "p3", "p4"])
    assert got == {"p1": ("r1", 1.0), "p2": (None, 0.0), "p3": ("r3", 0.5), "p4": (None, 0.0)}


def test_no_customers_or_no_codes(spark):
    assert run(spark, [("p", "a")], [], ["p"]) == {"p": (None, 0.0)}
    assert run(spark, [], ["r"], ["p"]) == {"p": (None, 0.0)}


def test_secondary_equal_to_primary_counted_once(spark):
    fact = spark.createDataFrame([("p", "a", 0), ("r", "a", 1)], "cnpj string, cnae_fiscal string, atual_cliente int")
    sec = spark.createDataFrame([("p", "a"), ("r", "a"), ("r", "b")], "cnpj string, cnae_fiscal_secundaria string")
    codes = similarity.company_codes(fact, sec)
    assert codes.count() == 3   # p: {a}; r: {a, b}
    res = similarity.most_similar(codes, fact.where("atual_cliente = 1"), fact.where("atual_cliente = 0")).first()
    assert (res.cnpj_mais_similar, res.similaridade) == ("r", 0.5)


def test_matches_brute_force_on_100_markets(spark):
    codes, clients, prospects, want = [], [], [], {}
    for seed in range(100):
        c, r, p = random_market(seed)
        want |= brute_force(c, r, p)
        codes, clients, prospects = codes + c, clients + r, prospects + p
    assert run(spark, codes, clients, prospects) == want


def test_independent_of_shuffle_partitions(spark):
    rnd = random.Random(7)
    clients = [f"r{i}" for i in range(10)]
    prospects = [f"p{i}" for i in range(40)]
    codes = [(c, f"k{rnd.randint(0, 5)}") for c in clients + prospects for _ in range(3)]
    base = run(spark, codes, clients, prospects)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert run(spark, list(reversed(codes)), clients, prospects) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_code_and_set_shared_by_most_companies(spark):
    rnd = random.Random(11)
    clients = [f"r{i:03d}" for i in range(40)]
    prospects = [f"p{i:03d}" for i in range(300)]
    codes = [(c, "hot") for c in clients + prospects]
    for c in clients:
        codes += [(c, f"k{j}") for j in rnd.sample(range(8), rnd.randint(0, 3))]
    for i, p in enumerate(prospects):
        if i % 3:           # two thirds share the set {hot, k1}
            codes.append((p, "k1"))
        else:
            codes += [(p, f"k{j}") for j in rnd.sample(range(8), rnd.randint(0, 3))]
    assert run(spark, codes, clients, prospects) == brute_force(codes, clients, prospects)


def test_bound_forms_few_pairs(spark):
    """Every prospect holds the frequent codes and one rare code: only customers of that code stay candidates."""
    frequent = [f"k{j}" for j in range(10)]
    clients, prospects = [f"r{i:03d}" for i in range(100)], [f"p{i:03d}" for i in range(50)]
    codes = [(c, f"rare{i % 50}") for i, c in enumerate(clients)] + [(p, f"rare{i}") for i, p in enumerate(prospects)]
    codes += [(c, k) for i, c in enumerate(clients) for k in frequent[i % 7:]] + [(p, k) for p in prospects for k in frequent]
    sets = similarity._code_sets(*frames(spark, codes, clients, prospects))
    p, c = similarity._sides(sets)
    pairs = similarity.candidates(p, similarity.client_index(c, p), similarity.width_of(sets)).collect()
    assert len(pairs) <= 2 * len(prospects) and len({(r.rep, r.cliente) for r in pairs}) == len(pairs)
    assert run(spark, codes, clients, prospects) == brute_force(codes, clients, prospects)


def test_pairs_of_representatives(spark):
    codes = [("p1", "a"), ("p2", "a"), ("p2", "a"), ("r1", "a"), ("r1", "b"), ("r2", "b"), ("r2", "a"), ("r3", "z")]
    got = similarity.similarity_pairs(*frames(spark, codes, ["r1", "r2", "r3"], ["p1", "p2"])).collect()
    assert [tuple(r) for r in got] == [("p1", "r1", 1, 2, 0.5)]


def test_plan_has_no_cartesian_or_python(spark):
    plan = similarity.most_similar(*frames(spark, [("p", "a"), ("r", "a")], ["r"], ["p"]))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
