"""Near-duplicate documents: MinHash signatures, an inverted join over their coordinates, exact checks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch, hash_words, row_groups, split, words_of
from provgraph.llm.graph import connected_components

#: Coordinates of a signature, doubled where a low threshold needs more.  As many
#: must collide as a pair at the threshold has but for a probability of ``MISS``.
#: Of 128 these are 87 at 0.85 and 79 at 0.8: a pair at 0.42, as two texts of one
#: template are, passes with 3e-9 or 6e-6, so that templates make no families.
COORDINATES = 128
MISS = 1e-6
#: Documents and shingles of a block of a family, about.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 100_000
#: Members of a block of a posting list, about.
BLOCK_POSTS = 256
#: Rounds in which a posting list compares one hub before its open pairs are listed.
ROUNDS = 2

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 2**64, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**64, COORDINATES, dtype=np.uint64)


def miss(percent: int, coordinates: int, matches: int) -> float:
    """The probability that a pair at the threshold has fewer than ``matches`` equal coordinates."""
    if percent == 100:
        return float(matches > coordinates)
    yes, no, log = math.log(percent / 100), math.log(1 - percent / 100), math.lgamma
    ways = lambda k: log(coordinates + 1) - log(k + 1) - log(coordinates - k + 1)
    return math.fsum(math.exp(ways(k) + k * yes + (coordinates - k) * no) for k in range(matches))


def collisions(percent: int) -> tuple[int, int]:
    """(coordinates, matches) for a threshold: the most matches whose miss probability is ``MISS`` or less."""
    if not 1 <= percent <= 100:
        raise ValueError("percent is from 1 to 100")
    n = COORDINATES
    while miss(percent, n, 1) > MISS:
        n *= 2
    m = 1
    while m < n and miss(percent, n, m + 1) <= MISS:
        m += 1
    return n, m


@cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The factors and terms of ``n`` hash functions."""
    rng = np.random.default_rng(20240301)
    a, b = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
    return np.append(_A, a | np.uint64(1))[:n], np.append(_B, b)[:n]


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; a shorter text is one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = hash_words(words)
    if n < width:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=n)], np.uint64)
    acc = h[: n - width + 1].copy()
    for j in range(1, width):
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc += h[j : n - width + 1 + j]
    acc ^= acc >> np.uint64(31)
    acc *= np.uint64(0xD6E8FEB86659FD93)
    acc ^= acc >> np.uint64(32)
    return np.unique(acc)


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The low 32 bits of the least hash under each coordinate's function."""
    a, b = _functions(coordinates)
    low = np.full(coordinates, np.uint64(2**64 - 1))
    # Blocks of 64 KB at 128 coordinates: larger ones are mapped and unmapped each time.
    for i in range(0, len(shingles), 64):
        np.minimum(low, (shingles[i : i + 64, None] * a + b).min(axis=0), out=low)
    return low.astype(np.uint32).view(np.int32)


_SIGNED = "_id long, n_shingles long, fp binary, sig array<int>"


def _sign(width: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, fp, sig, off = [], [], [], [0]
            for text in b.column("_text"):
                s = shingle_set(words_of(text.as_py()), width)
                n.append(len(s))
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s):
                    sig.append(signature(s, coordinates))
                off.append(len(sig) * coordinates)
            values = np.concatenate(sig) if sig else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), lists], ["_id", "n_shingles", "fp", "sig"])

    return run


def shared_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all intersections, exactly.

    A shingle that few sets hold adds one for each of its pairs; those that
    many hold are the columns of 0/1 matrices, multiplied a slice at a time.
    """
    n = len(sets)
    both = np.zeros((n, n), np.int32)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    count = np.diff(np.append(start, len(values)))
    for c in range(2, 9):
        at = start[count == c]
        who = owner[at[:, None] + np.arange(c)]
        for i in range(c):
            for j in range(i + 1, c):
                np.add.at(both, (who[:, i], who[:, j]), 1)
    many = np.flatnonzero(count > 8)
    for k in range(0, len(many), 4096):
        part = many[k : k + 4096]
        m = np.zeros((n, len(part)), np.float32)
        m[np.concatenate([owner[start[x] : start[x] + count[x]] for x in part]), np.repeat(np.arange(len(part)), count[part])] = 1
        both += np.triu(m @ m.T, 1).astype(np.int32)
    return both + both.T


def _link(width: int, percent: int):
    """Rows sorted by family and pair of blocks: links that connect what all links of the pair connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), g in row_groups(batches, ["family", "i", "j"]):
            rep, mine = g["rep"].to_numpy(), g["mine"].to_numpy()
            sets = [shingle_set(words_of(t.as_py()), width) for t in g["_text"]]
            size = np.array([len(s) for s in sets])
            both = shared_shingles(sets).astype(np.int64)
            near = 100 * both >= percent * (size[:, None] + size - both)
            if i != j:
                near &= mine[:, None] != mine
            # The smallest neighbour's label, until no label changes.
            label = np.arange(len(rep))
            while True:
                low = np.minimum(label, np.where(near, label, len(rep)).min(axis=1))
                low = np.minimum(low, low[low])
                if (low == label).all():
                    break
                label = low
            tied = label != np.arange(len(rep))
            yield pa.RecordBatch.from_arrays([pa.array(rep[tied], pa.int64()), pa.array(rep[label[tied]], pa.int64())], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``.

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of
    their sets of ``width``-word shingles (words split at ASCII white space,
    A-Z lower-cased, whole texts); a component is what links connect, named by
    its smallest id.

    A pair at the threshold is missed with a probability of ``MISS`` at most; the
    numbers of coordinates and matches follow from ``percent`` (``collisions``).

    1. Texts with equal sets form a class, stood for by its smallest id.
    2. Each class has a MinHash signature of so many coordinates and is
       posted under every (coordinate, value) that another class shares.
       Ordered from the rarest posting, two classes with enough
       collisions must meet within the first coordinates - matches + 1, so
       only that prefix is joined: frequent postings, as shared passages make
       them, are skipped unless a class has little else.
    3. A posting list compares its members with a hub, not with each other:
       the collisions of the two signatures are counted, and pairs with
       too few dropped.  What the others connect is a family.  Members of
       one family need no comparison; after some rounds with other hubs the
       remaining pairs of a list, those between families, are all counted,
       block against block, without a row for each.
       Families then hold every pair with enough collisions.
    4. The families' texts are fetched once.  Each family is cut into bounded
       blocks, and every pair of blocks compares the full shingle sets of its
       documents, all with all, passing on only the links that connect them.
       No list, partner or candidate is capped.

    Null and empty texts have no shingle, link with nothing and are kept; very
    long ones are compared whole, a text above ``BLOCK_SHINGLES`` with one block
    at a time.  Rows of one id count as one document (the largest text stands for it in
    checks); a null id links with nothing and has component_id null.  Empty
    tables give an empty result; extra columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    coordinates, matches = collisions(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    signed = scratch.save(texts.mapInArrow(_sign(width, coordinates), _SIGNED))
    classes = scratch.save(
        signed.where("n_shingles > 0 and _id is not null").groupBy("fp")
        .agg(F.min("_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    )
    comp = connected_components(scratch, _links(scratch, texts, classes, _families(scratch, classes, matches), width, percent))
    rep = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    rep = scratch.save(rep)
    out = signed.select("_id", "n_shingles", "fp").join(rep, "fp", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id"))
    return out.select(F.col("_id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))


def _prefixes(scratch: Scratch, classes: DataFrame, matches: int) -> DataFrame:
    """(token, rep): the shared postings among each class's rarest coordinates - matches + 1."""
    spread = classes.select("rep", F.posexplode("sig").alias("at", "value"))
    token = (F.shiftleft(F.col("at").cast("long"), 32) + (F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))).alias("token")
    tokens = spread.select("rep", token)
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    own = tokens.join(shared, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("own"))
    # The postings that nobody shares are the rarest and take their part of the prefix.
    own = own.where(F.size("own") >= matches).select("rep", F.explode(F.slice("own", F.lit(1), F.size("own") - (matches - 1))).alias("t"))
    return scratch.save(own.select(F.col("t.token").alias("token"), "rep"))


def _families(scratch: Scratch, classes: DataFrame, matches: int) -> DataFrame:
    """(rep, family) such that any two classes with enough collisions are of one family; lone classes are left out."""
    # Seven bits a coordinate tell a pair with enough collisions; others pass a little more often.
    sigs = scratch.save(classes.select("rep", F.transform("sig", lambda x: x.bitwiseAND(F.lit(127)).cast("tinyint")).alias("sig")))
    post = _prefixes(scratch, classes, matches)
    pairs = scratch.save(post.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0))
    families = pairs.select(F.col("a").alias("rep"), F.col("b").alias("family"))
    for step in range(ROUNDS + 1):
        members = scratch.save(post.join(families, "rep", "left").select("token", "rep", F.coalesce("family", "rep").alias("f")))
        hubs = members.groupBy("token").agg(F.min("f").alias("low"), F.max("f").alias("high")).where("low < high")
        members = members.join(hubs, "token")
        if step < ROUNDS:
            # The hub is first the smallest family's first member, then the largest's.
            hub = members.where(F.col("f") == F.col("high" if step % 2 else "low")).groupBy("token").agg(F.min("rep").alias("a"))
            found = members.join(hub, "token").where("rep != a").select("a", F.col("rep").alias("b"), "f", "low", "high")
            found = found.where(F.col("f") != F.col("high" if step % 2 else "low")).select("a", "b").distinct()
            sa, sb = sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
            equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
            # Both lists grow with the corpus, so neither is broadcast at any size.
            found = found.hint("merge").join(sa, "a").hint("merge").join(sb, "b").where(equal >= matches).select("a", "b")
        else:
            found = _open_pairs(members.select("token", "rep", "f"), sigs, matches)
        pairs = scratch.save(pairs.union(found))
        families = connected_components(scratch, pairs).select(F.col("id").alias("rep"), F.col("component").alias("family"))
        pairs = families.select(F.col("rep").alias("a"), F.col("family").alias("b"))
    return families


def _open_pairs(members: DataFrame, sigs: DataFrame, matches: int) -> DataFrame:
    """(a, b) that connect the members of a list which have enough collisions, whatever the length of the list.

    A list is cut into blocks of ``BLOCK_POSTS`` members and every pair of
    blocks compared whole, with the signatures at hand: a member becomes one
    row for each block of its list and no pair becomes a row.
    """
    size = members.groupBy("token").agg(F.ceil(F.count("*") / BLOCK_POSTS).cast("int").alias("blocks"))
    cut = members.join(size, "token").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # Both lists grow with the corpus, so neither is broadcast at any size.
    held = cut.hint("merge").join(sigs, "rep")
    sides = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("mine", o).alias("i"), F.greatest("mine", o).alias("j")))
    dealt = held.select("token", "rep", "f", "mine", "sig", F.explode(sides).alias("p")).select("token", "p.i", "p.j", "rep", "f", "mine", "sig")
    dealt = dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "rep")
    return dealt.mapInArrow(_collide(matches), "a long, b long").distinct()


def _collide(matches: int):
    """Rows sorted by list and pair of blocks: pairs that connect what all pairs with enough collisions connect."""

    def compare(t: pa.Table, change: np.ndarray) -> pa.RecordBatch:
        rep, f, mine = (t.column(c).to_numpy() for c in ("rep", "f", "mine"))
        sig = t.column("sig").combine_chunks()
        sig = (sig.chunk(0) if isinstance(sig, pa.ChunkedArray) else sig).flatten().to_numpy().reshape(t.num_rows, -1)
        crossed = t.column("i").to_numpy() != t.column("j").to_numpy()
        # The first row after each row's group.
        end = np.repeat(np.append(change[1:], t.num_rows), np.diff(np.append(change, t.num_rows)))
        label = np.arange(t.num_rows)
        at, step = label, 1
        while len(at := at[at + step < end[at]]):
            x, y = at, at + step
            # Members of a family need no comparison; blocks are compared with themselves once.
            use = (f[x] != f[y]) & (~crossed[x] | (mine[x] != mine[y]))
            x, y = x[use], y[use]
            for k in range(0, len(x), 4096):
                near = np.count_nonzero(sig[x[k : k + 4096]] == sig[y[k : k + 4096]], axis=1) >= matches
                for u, v in zip(x[k : k + 4096][near].tolist(), y[k : k + 4096][near].tolist(), strict=True):
                    while label[u] != u:
                        u = label[u]
                    while label[v] != v:
                        v = label[v]
                    label[max(u, v)] = min(u, v)
            step += 1
        tied = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(rep[label[tied]], pa.int64()), pa.array(rep[tied], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            change = _starts(t)
            if len(change):
                # The last group may go on in the next batch.
                if change[-1]:
                    yield compare(t.slice(0, change[-1]).combine_chunks(), change[:-1])
                held = t.slice(change[-1])
        if held is not None and held.num_rows:
            yield compare(held.combine_chunks(), np.array([0]))

    return run


def _starts(t: pa.Table) -> np.ndarray:
    """First rows of the runs of one list and pair of blocks."""
    if not t.num_rows:
        return np.empty(0, np.int64)
    cols = [t.column(c).to_numpy() for c in ("token", "i", "j")]
    return np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in cols], axis=0)))


def _links(scratch: Scratch, texts: DataFrame, classes: DataFrame, families: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) between class representatives: checked links that connect what all links connect."""
    of = scratch.save(families.join(classes.select("rep", "n"), "rep"))
    size = of.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    cut = of.join(size, "family").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # The id list grows with the corpus, so it is not broadcast at any size.
    texts, _ = split(texts, "_id", of, "rep")
    held = texts.hint("merge").join(cut.select(F.col("rep").alias("_id"), "family", "mine", "blocks"), "_id")
    held = held.groupBy("_id", "family", "mine", "blocks").agg(F.max("_text").alias("_text"))
    sides = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("mine", o).alias("i"), F.greatest("mine", o).alias("j")))
    dealt = held.select("family", "mine", F.col("_id").alias("rep"), "_text", F.explode(sides).alias("p")).select("family", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "mine", "rep", "_text")
    dealt = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "rep")
    return scratch.save(dealt.mapInArrow(_link(width, percent), "a long, b long"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that name their component, one document of each, all columns kept.

    Rows without words or id stay, an empty table stays empty, rows that repeat
    the staying id all stay, and extra columns may have any names.  Rows
    whose id is not among those that go are not shuffled.
    """
    gone = near_duplicates(docs, id_col, text_col, width, percent).where("not kept").select(F.col(id_col).alias("_gone")).distinct()
    gone = Scratch(docs.sparkSession, "minhash-gone").save(gone)
    some, stay = split(docs, id_col, gone, "_gone")
    return stay.union(some.join(gone, some[id_col] == gone["_gone"], "left_anti"))
