"""Operators 1, 3, 4 and 6 against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from marketscope.llm import exact_dedup as exact
from marketscope.llm import line_dedup as lines
from marketscope.llm import simhash_dedup as sim
from marketscope.llm import substring_dedup as sub
from marketscope.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, fp string, tag string, n string"


def table(spark, rows):
    """Documents with further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z", "w") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def sentence(n):
        return " ".join(rng.choice(vocab) for _ in range(n))

    shared = sentence(70)
    base = [sentence(rng.randint(1, 120)) + "\n" + sentence(rng.randint(5, 60)) for _ in range(40)]
    out = list(enumerate(base))
    out += [(100 + i, base[i].replace(" ", "  ")) for i in range(8)]                   # copies but for white space
    out += [(200 + i, base[i] + " " + sentence(2)) for i in range(8)]                  # near copies
    out += [(300 + i, sentence(30) + "\n" + shared + "\n" + sentence(30)) for i in range(6)]
    out += [(400, None), (401, ""), (402, " \t\n"), (None, base[3]), (None, "only null id " + sentence(20)), (5, base[5]), (5, base[5]),
            (500, "a" * 20000), (501, "a" * 20000), (502, sentence(3)), (503, "x\n" * 50), (504, shared.upper()), (6, "same id, other text")]
    return out


def test_exact_dedup_matches_brute_force(spark, rows):
    got = sorted(map(tuple, exact.exact_dedup(table(spark, rows)).collect()), key=str)
    norm = [(i, t or "", "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")) for i, t in rows]
    groups = {}
    for i, t, k in norm:
        groups.setdefault(k, []).append((-len(t), i is None, i or 0, i))
    want = []
    for i, _, k in norm:
        keep = min(groups[k])[3]
        want.append((i, keep, len(groups[k]), i == keep, hashlib.sha256(k.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_exact_dedup_splits_colliding_fingerprints(spark, rows):
    """Tiny moduli make different texts collide; the chunkwise comparison keeps them apart."""
    short = [(i, "".join(random.Random(i).choice("ab") for _ in range(9))) for i in range(200)]
    want = {}
    for i, t in short:
        want.setdefault(t, []).append(i)
    got = exact.exact_dedup(table(spark, short), primes=(5, 3), chunk_bytes=4).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, min(v), len(v)) for v in want.values() for i in v}


def test_polynomial_hash_is_composable():
    data = np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8).tobytes()
    poly = exact.PolyHash(chunk_bytes=1000)
    whole = poly.of_chunks(exact.chunks_of(data, 1000))
    for size in (1, 7, 640, 999):
        assert poly.of_chunks(exact.chunks_of(data, size)) == whole
    left, right = poly.of_chunks([data[:900]]), poly.of_chunks(exact.chunks_of(data[900:], 1000))
    assert poly.combine(left, right, 4100) == whole


@pytest.mark.parametrize("op", [exact.exact_dedup, sub.substring_dedup, sim.near_dedup, lines.line_dedup])
def test_empty_table(spark, op):
    assert op(table(spark, [])).count() == 0


def order(i):
    return -(1 << 63) if i is None else i


def text_keys(spark, rows):
    """text -> its hashes, which order texts of one id."""
    from pyspark.sql import functions as F

    from marketscope.llm.common import text_hashes
    found = spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", *text_hashes(F.col("t"))).collect()
    return {r[0]: (r[1], r[2]) for r in found}


def test_substring_dedup_matches_brute_force(spark, rows):
    hashes = text_keys(spark, rows)
    first, spans = {}, {}
    docs = sorted({(order(i), hashes[t or ""], t or "") for i, t in rows})
    for i, h, t in docs:
        raw, at = t.encode(), 0
        for end in sub.cuts(np.frombuffer(raw, dtype=np.uint8)).tolist():
            if first.setdefault(raw[at:end], (i, h, at)) != (i, h, at):
                spans.setdefault((i, t), []).append((at, end))
            at = end
    want = []
    for i, t in rows:
        raw, s = (t or "").encode(), spans.get((order(i), t or ""), [])
        kept = b"".join(raw[a:b] for a, b in zip([0] + [e for _, e in s], [a for a, _ in s] + [len(raw)]))
        want.append((i, kept.decode(), sum(e - a for a, e in s), len(s), bool(s)))
    got = sub.substring_dedup(table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    changed = {r.doc_id for r in got if r.changed}
    assert {301, 302, 303, 304, 305, 501} <= changed and 300 not in changed


def test_cuts_resist_insertions():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 20000, dtype=np.uint8)
    moved = np.concatenate([data[:5000], rng.integers(97, 123, 13, dtype=np.uint8), data[5000:]])

    def chunks(d):
        ends = sub.cuts(d).tolist()
        return [d[a:b].tobytes() for a, b in zip([0] + ends, ends)]

    a, b = chunks(data), chunks(moved)
    assert b"".join(a) == data.tobytes() and len(set(a) - set(b)) <= 4
    assert all(len(c) > sub.REACH for c in a[:-1])


def reference_simhash(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_dedup_matches_brute_force(spark, rows):
    fps = [(order(i), reference_simhash(t, 4)) for i, t in rows]
    root = roots({f for _, f in fps}, lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for i, f in fps:
        smallest[root[f]] = min(i, smallest.get(root[f], i))
    want = [(None if i == order(None) else i, f"{f:016x}", None if smallest[root[f]] == order(None) else smallest[root[f]])
            for i, f in fps]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in sim.near_dedup(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("max_bits,segments", [(4, 3), (3, 3), (5, 2)])
def test_near_links_keep_components_of_dense_groups(spark, max_bits, segments):
    rng = random.Random(max_bits)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            f = centre
            for _ in range(rng.randint(0, 9)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    links = sim.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits, segments)
    assert all(((r.a ^ r.b) & ((1 << 64) - 1)).bit_count() <= max_bits for r in links.collect())
    got = {r.node: r.root for r in components(links).collect()}
    want = roots(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits)
    assert {f: got.get(f, f) for f in signed} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {1000 + i: 1000 for i in range(200)}


def test_keep_one_keeps_the_columns(spark, rows):
    docs = table(spark, rows)
    assert sim.keep_one(docs).schema == docs.schema


def test_keep_one_keeps_a_row_of_every_root(spark, rows):
    """One survivor per fingerprint root, also where components share an id or have none."""
    words = [" ".join(f"w{random.Random(i).randrange(10**6)}x{j}" for j in range(30)) for i in range(6)]
    more = rows + [(None, w) for w in words[:4]] + [(None, words[0]), (700, words[4]), (700, words[5]), (701, words[4])]
    fps = [reference_simhash(t, 4) for _, t in more]
    root = roots(set(fps), lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for (i, _), f in zip(more, fps):
        smallest[root[f]] = min(order(i), smallest.get(root[f], order(i)))
    kept = sim.keep_one(table(spark, more)).collect()
    assert {(r.doc_id, r.text) for r in kept} <= set(more)
    got = [(root[reference_simhash(r.text, 4)], order(r.doc_id)) for r in kept]
    assert sorted(got) == sorted(smallest.items())


def joined_plans(monkeypatch, result):
    """The plans of what ``result()`` writes in simhash_dedup, by name, and of what it returns."""
    plans, write = {}, sim.written

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(sim, "written", noted)
    plans["result"] = result()._jdf.queryExecution().executedPlan().toString()
    return plans


def test_lookups_of_fingerprints_are_not_broadcast(spark, monkeypatch):
    """Spark sizes the 46 lookups of each fingerprint as one row; broadcast, they exceeded a driver of 1 GB at 0.6 GB of documents."""
    rng = random.Random(7)
    fps = sim.written(spark.createDataFrame([(rng.getrandbits(63),) for _ in range(300)], "fp long"), "test-prints")
    plans = joined_plans(monkeypatch, lambda: sim.near_links(fps, 4))
    for name in ("star-links", "result"):
        assert "SortMergeJoin" in plans[name] and "BroadcastExchange" not in plans[name]


def test_keep_one_broadcasts_no_table_of_components(spark, monkeypatch, rows):
    plans = joined_plans(monkeypatch, lambda: sim.keep_one(table(spark, rows)))
    assert "SortMergeJoin" in plans["result"] and "BroadcastExchange" not in plans["result"]


def test_simhash_dedup_broadcasts_no_table_of_documents(spark, monkeypatch, rows):
    plans = joined_plans(monkeypatch, lambda: sim.near_dedup(table(spark, rows)))
    assert "SortMergeJoin" in plans["result"] and "BroadcastExchange" not in plans["result"]


def worded(text):
    return [" ".join(x.split()) for x in (text or "").split("\n") if x.split()]


def repeated_runs(spark, rows, min_words):
    """(order key, text) -> lines with a word that lie in a run of ``min_words`` words or more that occurred earlier, with no winnowing."""
    hashes = text_keys(spark, rows)
    first, out = {}, {}
    for i, h, t in sorted({(order(i), hashes[t or ""], t or "") for i, t in rows}):
        ls, gone = worded(t), set()
        for a in range(len(ls)):
            for b in range(a + 1, len(ls) + 1):
                if sum(len(x.split()) for x in ls[a:b]) >= min_words and first.setdefault(tuple(ls[a:b]), (i, h, a)) != (i, h, a):
                    gone.update(range(a, b))
        out[i, t] = gone
    return out


def brute_lines(spark, rows, min_words):
    """The contract of the operator in plain Python: places by (line) and by (line among its neighbours), first ones, extended matches."""
    hashes, first, found = text_keys(spark, rows), {}, []
    docs = sorted({(order(i), hashes[t or ""], t or "") for i, t in rows})
    for i, h, t in docs:
        ls = worded(t)
        words = [len(x.split()) for x in ls]
        digest = [xxhash.xxh3_128_digest(x) for x in ls]
        places = set()
        for a in range(len(ls)):
            b = next((b for b in range(a + 1, len(ls) + 1) if sum(words[a:b]) >= min_words), None)
            if b:
                places.add(min(range(a, b), key=lambda x: (digest[x], x)))
        for p in sorted(places):
            lo = min(a for a in range(p + 1) if sum(words[a:p]) < min_words)
            hi = max(b for b in range(p + 1, len(ls) + 1) if sum(words[p + 1:b]) < min_words)
            for key in [("alone", ls[p])] + [("among", p - lo, *ls[lo:hi])] * (hi - lo > 1):
                f = first.setdefault(key, (i, h, p, ls, lo, hi))
                if f[:3] != (i, h, p):
                    found.append((i, t, p, ls, lo, hi, f))
    gone = {}
    for i, t, p, ls, lo, hi, (_, _, q, fs, flo, fhi) in found:
        a, b = 0, 1
        while p - a > lo and q - a > flo and ls[p - a - 1] == fs[q - a - 1]:
            a += 1
        while p + b < hi and q + b < fhi and ls[p + b] == fs[q + b]:
            b += 1
        if sum(len(x.split()) for x in ls[p - a:p + b]) >= min_words:
            gone.setdefault((i, t), set()).update(range(p - a, p + b))
    return {(i, t): gone.get((i, t), set()) for i, _, t in docs}


def deleted_lines(row, text):
    """Numbers, among the lines with a word, of those the operator deleted."""
    lines = (text or "").split("\n")
    out = {n for r in row.runs or () for n in range(r.start, r.stop)}
    assert row.removed_lines == len(out)
    assert row.text == (text if not out else "\n".join(x for n, x in enumerate(lines) if n not in out))
    return {k for k, n in enumerate(n for n, x in enumerate(lines) if x.split()) if n in out}


@pytest.mark.parametrize("min_words", [2, 3, 10, 50])
def test_line_dedup_matches_brute_force(spark, rows, min_words):
    rng = random.Random(min_words)
    pool = ["p q", "r s t", "u", "", "v w x y z", "p  q ", "a b c d e f g h i j k l"]
    more = rows + [(600 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(40)]
    run = " ".join(f"w{i}" for i in range(12)) + "\nx1 x2 x3\nx4 x5 x6 x7 x8"
    more += [(700, f"start\n{run}\nend one"), (701, f"begin\n{run}\nend two")]
    want, runs = brute_lines(spark, more, min_words), repeated_runs(spark, more, min_words)
    texts = {}
    for i, t in more:
        texts.setdefault(order(i), set()).add(t or "")
    got = lines.line_dedup(table(spark, more), min_words).collect()
    assert len(got) == len(more)
    for row in got:
        mine = texts[order(row.doc_id)]
        if len(mine) > 1:
            continue                                  # which text it was cannot be told from an edited row
        text, = mine
        out = deleted_lines(row, text if row.text is not None else None)
        assert out == want[order(row.doc_id), text]
        assert out <= runs[order(row.doc_id), text]                         # nothing but repeated runs goes
        long = {k for k, x in enumerate(worded(text)) if len(x.split()) >= min_words}
        assert long & runs[order(row.doc_id), text] <= out                  # and of lines long enough, all of them
    assert {r.doc_id: r.text for r in got}[701] == ("begin\nend two" if min_words <= 20 else f"begin\n{run}\nend two")


def test_line_dedup_needs_its_fingerprints(spark, monkeypatch):
    """Places are the selected ones only: a run of short lines has fewer fingerprints than lines, and goes as a whole."""
    menu = "Home\nAbout us\nNews\nContact\nTerms\nImprint"
    rows = [(i, f"text {i} {i}\n{menu}\nlast {i} {i}") for i in range(4)]
    made = lines.fingerprint_rows(table(spark, rows[:1])).where("kind = 0").count()
    assert made < len(worded(rows[0][1]))
    got = {r.doc_id: r.text for r in lines.line_dedup(table(spark, rows)).collect()}
    assert got[0] == rows[0][1] and [got[i] for i in (1, 2, 3)] == [f"text {i} {i}\nlast {i} {i}" for i in (1, 2, 3)]


@pytest.mark.parametrize("op", [sub.substring_dedup, lines.line_dedup])
def test_texts_of_equal_32_bit_hash_stay_apart(spark, op):
    """Null ids: a text's spans are never applied to another text, whatever Spark's hash() says."""
    from pyspark.sql import functions as F
    tail = "the same closing line stands in many of these texts and is long enough to be a chunk of its own " * 3
    body = spark.range(400_000).select(F.concat(F.lit("unique "), F.hex(F.xxhash64("id")), F.lit("\n" + tail)).alias("t"))
    twice = body.groupBy(F.hash("t")).agg(F.collect_list("t").alias("t")).where("size(t) > 1").first()
    pair = twice["t"][:2]
    got = op(table(spark, [(None, pair[0]), (None, pair[1]), (1, tail)])).collect()
    assert sum("unique" in r.text for r in got) == 2


def test_line_dedup_deletes_short_boilerplate_lines(spark):
    rows = [(i, f"first text number {i} stands alone\nall rights reserved\nlast text number {i} stands alone too") for i in range(5)]
    got = {r.doc_id: r for r in lines.line_dedup(table(spark, rows)).collect()}
    assert [got[i].removed_lines for i in range(5)] == [0, 1, 1, 1, 1]


def test_line_dedup_stage_keeps_columns(spark, rows):
    docs = table(spark, rows)
    out = lines.without_repeats(docs)
    assert out.schema == docs.schema and out.count() == len(rows)
    assert all(r.n_chars == len(r.text or "") for r in out.collect())
