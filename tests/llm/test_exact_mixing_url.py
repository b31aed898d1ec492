from __future__ import annotations

import hashlib

import pytest

from provgraph.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from provgraph.llm.mixing import mix, mixed_documents
from provgraph.llm.url_filter import Rule, filter_urls

from .helpers import CLASHING, clashing_frame, docs_frame, rows

TEXTS = [(1, "Hello World"), (2, "hello world"), (3, "hello  world"), (4, None), (5, ""), (6, "ÄBC"), (7, "äbc"), (8, "x" * 200_000), (9, "X" * 200_000), (None, "lone"), (9, "X" * 200_000)]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_duplicates_match_brute_force(spark, keep):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups: dict[str, list] = {}
    for i, t in TEXTS:
        groups.setdefault((t or "").translate(low), []).append(i)
    want = []
    for i, t in TEXTS:
        n = (t or "").translate(low)
        real = [x for x in groups[n] if x is not None]
        k = (min(real) if keep == "smallest" else max(real)) if real else None
        want.append((i, k, len(groups[n]), i == k, hashlib.sha256(n.encode()).hexdigest()))
    got = rows(exact_duplicates(clashing_frame(spark, TEXTS), keep=keep), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted(want, key=str)


def test_exact_dedup_of_a_hot_group_and_of_nothing(spark):
    many = docs_frame(spark, [(i, "Same text") for i in range(3000)] + [(i, f"t{i}") for i in range(3000, 3300)])
    kept = drop_exact_duplicates(many, keep="largest")
    assert kept.columns == many.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2999, *range(3000, 3300)]
    assert exact_duplicates(docs_frame(spark, [])).count() == 0
    assert drop_exact_duplicates(clashing_frame(spark, TEXTS)).columns == [f.name for f in CLASHING]


def test_split_lets_no_partner_through_as_missing(spark):
    from pyspark.sql import functions as F

    from provgraph.llm.common import split

    left = spark.range(5000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("bits")).union(spark.sql("select cast(null as int), 'n'"))
    keys = spark.range(0, 5000, 7).select((F.col("id")).alias("bucket")).union(spark.sql("select cast(null as bigint)"))
    some, rest = split(left, "k", keys, "bucket")
    assert some.columns == rest.columns == ["k", "bits"]
    some, rest = [r.k for r in some.collect()], [r.k for r in rest.collect()]
    assert sorted(map(str, some + rest)) == sorted(map(str, [None, *range(5000)]))
    assert None in some and set(range(0, 5000, 7)) <= set(some) and len(some) < 800
    empty, all_ = split(left, "k", keys.where("false"), "bucket")
    assert (empty.count(), all_.count()) == (0, 5001)


def test_exact_dedup_shuffles_only_texts_that_share_a_hash(spark):
    """The fetch of texts reads a bit map, and rows that stay by their id meet no exchange."""
    data = [(i, f"text {i // 2 if i < 40 else i}") for i in range(2000)]
    kept = drop_exact_duplicates(clashing_frame(spark, data), keep="largest")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(1, 40, 2), *range(40, 2000)]
    nulls = [(None, "a"), (None, "A"), (3, "a"), (4, None), (5, "")]
    assert sorted(str(r.doc_id) for r in drop_exact_duplicates(clashing_frame(spark, nulls)).collect()) == ["3", "4"]
    assert drop_exact_duplicates(docs_frame(spark, [])).count() == 0


def _targets(sizes, weights=(3, 1, 2), total=1.5, cap=2):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held: set = set()
    while True:
        left = total * sum(sizes.values()) - sum(cap * sizes[s] for s in held)
        free = [s for s in order if s not in held]
        target = {s: cap * sizes[s] for s in held} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return target
        held |= set(over)


def test_mix_meets_targets(spark):
    data = [(i, " ".join(["w"] * (1 + i % 37)), ["b", "a", None, "é", "z", "Z"][(i * i) % 6]) for i in range(2400)]
    got = mix(docs_frame(spark, data)).collect()
    sizes: dict = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = _targets(sizes)
    taken: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.01 * t + 40
    again = mix(docs_frame(spark, data[::-1]).repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mixed_documents_keep_columns_and_repeat_rows(spark):
    docs = clashing_frame(spark, [(i, "a b c", "s" if i % 2 else None) for i in range(50)] + [(60, None, "empty"), (None, "a", "s")])
    marks = {r.doc_id: r.copies for r in mix(docs).collect()}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    count = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert count == {i: n for i, n in marks.items() if n}
    assert mixed_documents(docs_frame(spark, [])).count() == 0


RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def _pages(spark, data):
    return spark.createDataFrame([(*r, "x", "y") for r in data], "page_id long, url string, html string, host string, _key string")


def test_url_rules_without_links(spark):
    data = [
        (1, "http://A.Example.NET/en/x?q=1#f", ""), (2, "http://example.net/EN/", ""), (3, "http://xnet/", ""), (4, "http://net", ""),
        (5, "http://x.example.com/de/", None), (6, "http://example.com/dex", ""), (7, "https://a.org/fr/a", ""), (8, None, "<p>"),
        (9, "no scheme", ""), (10, "http://a.net?x=/y", ""), (11, "http://A.net/b://c/d#e", ""), (11, "http://A.net/b://c/d#e", ""),
    ]
    got = rows(filter_urls(_pages(spark, data), RULES), "page_id", "host", "path", "rule", "verdict")
    want = [
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.net", "/EN/", "net/", "block"), (3, "xnet", "/", None, "allow"),
        (4, "net", "", None, "allow"), (5, "x.example.com", "/de/", "example.com/de/", "block"), (6, "example.com", "/dex", None, "allow"),
        (7, "a.org", "/fr/a", "org/fr/", "allow"), (8, "", "", None, "allow"), (9, "", "", None, "allow"), (10, "a.net", "", None, "allow"),
        (11, "a.net", "/b://c/d", "net/", "block"), (11, "a.net", "/b://c/d", "net/", "block"),
    ]
    assert got == sorted(want, key=str)
    assert filter_urls(_pages(spark, []), RULES).count() == 0


def test_blocks_travel_over_links_and_explicit_allow_wins(spark):
    link = '<head><link rel="alternate" href="http://b.net/"><link href="{}" rel="Canonical"></head>'
    data = [
        (1, "http://one.com/a", link.format("https://bad.net/x")),  # alias of a blocked URL without a page
        (2, "http://two.com/a/b", link.format("/a/c")), (3, "https://two.com/a/c#top", "<META http-equiv='refresh' content='0; URL=http://one.com/a'>"),
        (4, "http://good.org/fr/x", link.format("http://one.com/a")),  # explicitly allowed
        (5, "http://free.com/", link.format("http://free.com/y?a=1&amp;b=2")), (6, "http://free.com/y?a=1&b=2", None),
        (7, "http://mail.com/", link.format("mailto:x@y.net")),
    ]
    got = {r.page_id: r for r in filter_urls(_pages(spark, data), RULES).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow"}
    assert len({got[i].component for i in (1, 2, 3, 4)}) == 1 and got[5].component == got[6].component != got[1].component
    extra = spark.createDataFrame([("http://free.com/", "http://z.net/")], "source string, target string")
    assert {r.page_id: r.verdict for r in filter_urls(_pages(spark, data), RULES, redirects=extra).collect()}[6] == "block"
