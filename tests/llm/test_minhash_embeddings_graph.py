from __future__ import annotations

import random

import numpy as np
import pytest

from provgraph.llm import minhash
from provgraph.llm.common import Scratch
from provgraph.llm.embedding_dedup import near_duplicate_vectors
from provgraph.llm.graph import connected_components
from provgraph.llm.minhash import drop_near_duplicates, near_duplicates

from .helpers import clashing_frame, docs_frame, rows, words


def _components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_random_graphs_chains_and_hubs(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 640)] + [(900, i) for i in range(901, 1200)]
    got = connected_components(Scratch(spark, "t"), spark.createDataFrame(links, "a long, b long")).collect()
    ids = {x for p in links if p[0] != p[1] for x in p}
    assert {r.id: r.component for r in got} == _components(ids, links)
    assert len(got) == len(ids)
    assert connected_components(Scratch(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


def _shingles(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    return {tuple(low[i : i + 5]) for i in range(len(low) - 4)} if len(low) >= 5 else ({tuple(low)} if low else set())


def _corpus():
    rng = random.Random(5)
    out = [(0, None), (1, ""), (2, " \n\t"), (3, "One two"), (4, "one  two"), (5, "one two three")]
    passage = words(rng, 60)
    for g in range(12):
        base = words(rng, rng.choice([20, 60, 200, 600]))
        for _ in range(rng.choice([1, 3, 30])):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            out.append((len(out), " ".join(w).upper() if g % 2 else "\n".join(w)))
    for _ in range(60):  # a passage that many unrelated texts share
        out.append((len(out), " ".join(words(rng, 25) + passage)))
    w = words(rng, 100)
    for i in range(40):  # a drifting chain: neighbours are near, ends are not
        w = list(w)
        w[(i * 7) % 100] = f"c{i}"
        out.append((len(out), " ".join(w)))
    out.append((len(out), " ".join(words(rng, 30_000))))
    return out


@pytest.mark.parametrize("rounds", [0, 4])
def test_near_duplicates_match_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    data = _corpus()
    sets = {i: _shingles(t) for i, t in data}
    links = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
        and 100 * (n := len(sets[a] & sets[b])) >= 85 * (len(sets[a]) + len(sets[b]) - n)
    ]
    want = _components(sets, links)
    got = near_duplicates(clashing_frame(spark, data).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert len(got) == len(data)


def test_open_lists_make_no_row_for_each_pair(spark, monkeypatch):
    """One list of texts that are all near each other: its links grow with its members, not with their pairs."""
    monkeypatch.setattr(minhash, "ROUNDS", 0)
    seen, inner = [], connected_components
    monkeypatch.setattr(minhash, "connected_components", lambda scratch, edges, *a: (seen.append(edges.count()), inner(scratch, edges, *a))[1])
    rng = random.Random(8)
    base, n = words(rng, 400), 60
    data = []
    for i in range(n):
        w = list(base)
        w[rng.randrange(400)] = f"own{i}"
        data.append((i, " ".join(w)))
    got = near_duplicates(docs_frame(spark, data)).collect()
    assert {r.component_id for r in got} == {0} and len(got) == n
    assert seen[0] < n * (n - 1) / 2 / 2


def test_pairs_of_open_lists_by_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    sig = rng.integers(0, 2, (90, 16)).astype(np.int8)
    members = [(t, r, r if r % 5 else 0) for t in range(6) for r in range(t * 7, min(90, t * 7 + (1, 2, 3, 20, 40, 55)[t]))]
    of = {}
    for t, r, f in members:
        of.setdefault(t, []).append((r, f))
    links = [(a, b) for held in of.values() for a, fa in held for b, fb in held if a < b and fa != fb and (sig[a] == sig[b]).sum() >= 12]
    ids = sorted({x for p in links for x in p})
    want = _components(ids, links)
    frame = spark.createDataFrame(members, "token long, rep long, f long").repartition(3)
    sigs = spark.createDataFrame([(i, [int(x) for x in s]) for i, s in enumerate(sig)], "rep long, sig array<tinyint>")
    for block in (4, 256):
        monkeypatch.setattr(minhash, "BLOCK_POSTS", block)
        got = minhash._open_pairs(frame, sigs, 12).collect()
        assert _components(ids, [(r.a, r.b) for r in got]) == want
        assert {(r.a, r.b) for r in got} and all(r.a in want and r.b in want for r in got)
    assert len(got) < len(set(links))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert _components(ids, [(r.a, r.b) for r in minhash._open_pairs(frame, sigs, 12).collect()]) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_collisions_follow_the_threshold():
    for percent in range(1, 101):
        n, m = minhash.collisions(percent)
        assert 1 <= m <= n and minhash.miss(percent, n, m) <= minhash.MISS
    # The fewest collisions that keep the pairs at the threshold, and far more than other pairs have.
    for percent in (80, 85):
        n, m = minhash.collisions(percent)
        assert n == 128 and minhash.miss(percent, n, m + 1) > minhash.MISS
        assert 1 - minhash.miss(42, n, m) < 1e-4
    with pytest.raises(ValueError, match="percent"):
        minhash.collisions(0)


@pytest.mark.parametrize("n", [200, 800])
def test_texts_of_one_template_form_no_families(spark, n):
    """300 words that all texts share and 200 of their own: a similarity of 0.42, and no work that grows with their pairs."""
    from pyspark.sql import functions as F

    from provgraph.llm.common import Scratch

    rng = random.Random(n)
    shared = words(rng, 300)
    data = [(i, " ".join(shared + words(rng, 200, 10**6))) for i in range(n)]
    scratch, (coordinates, matches) = Scratch(spark, "t"), minhash.collisions(85)
    texts = docs_frame(spark, data).select(F.col("doc_id").alias("_id"), F.col("text").cast("binary").alias("_text"))
    classes = scratch.save(texts.mapInArrow(minhash._sign(5, coordinates), minhash._SIGNED).select(F.col("_id").alias("rep"), "sig"))
    assert minhash._prefixes(scratch, classes, matches).count() < n / 2
    assert minhash._families(scratch, classes, matches).count() == 0


@pytest.mark.parametrize("percent", [10, 50])
def test_pairs_at_a_low_threshold_are_linked(spark, percent):
    rng = random.Random(percent)
    data = []
    for k in range(60):  # pairs just above the threshold
        both, own = [f"k{k}w{i}" for i in range(200)], 100 * (100 - percent) // percent - 2
        for side in "ab":
            data.append((len(data), " ".join(rng.sample(both, 200) + [f"{side}{k}w{i}" for i in range(own)])))
    sets = {i: {(w,) for w in t.split()} for i, t in data}
    assert all(percent <= 100 * len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) < percent + 2 for i in range(0, 120, 2))
    got = near_duplicates(docs_frame(spark, data), width=1, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i in sets}


def test_near_duplicates_edge_cases(spark):
    data = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (7, "A b c d e f"), (8, "z")]
    got = rows(near_duplicates(docs_frame(spark, data)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (7, 2, 1, False), (8, 1, 8, True)], key=str)
    assert near_duplicates(docs_frame(spark, [])).count() == 0
    kept = drop_near_duplicates(clashing_frame(spark, data))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "8", "None"]


def _vectors(rng):
    out = []
    for label in (0, 1, 2):
        for _ in range(40):
            base = rng.normal(size=16)
            for _ in range(int(rng.integers(1, 6))):
                out.append(((base + rng.normal(size=16) * rng.choice([0.0, 0.03, 0.12])).astype(np.float32).tolist(), label))
    tight = rng.normal(size=16)
    out += [((tight + rng.normal(size=16) * 0.02).astype(np.float32).tolist(), 1) for _ in range(150)]  # more than a window
    out += [([1.0] * 16, 2)] * 200  # one common vector
    out += [(None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1), ([float("inf")] * 16, 1), ([1.0] * 16, None), ([1.0] * 8, 2)]
    return [(i, v, label) for i, (v, label) in enumerate(out)]


def test_embedding_links_match_brute_force(spark):
    data = _vectors(np.random.default_rng(2))
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<float>, label int, rep string").repartition(3)
    ok = {i: np.array(v, float) for i, v, label in data if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: x for i, _, x in data}
    links = [(a, b) for a in ok for b in ok if a < b and label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= 0.98]
    n = {i: 0 for i in label}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    want = _components(label, links)
    got = near_duplicate_vectors(df, window=16, block=64).collect()
    assert len(got) == len(data)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (n[i], want[i], want[i] == i) for i in label}
    assert near_duplicate_vectors(df.limit(0)).count() == 0
