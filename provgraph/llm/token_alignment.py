"""Alignment of two tokenizers' tokens over the same texts, with corpus-wide counts of the linked id pairs."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch
from provgraph.llm.packing import _byte_of, encoder

#: Stretches that a task remembers; beyond it, it writes its counts and starts anew.
STRETCHES = 1 << 19
#: Most pairs whose counts are broadcast; the others are joined by a shuffle.
HOT_PAIRS = 1 << 20
#: A pair of ids as one number.
_SHIFT = 32
#: Over a space after visible text no token of either side goes on; the last space of a text has nothing to begin.
_CUT, _CROSSED = re.compile(r"(?<=\S) (?!\Z)"), re.compile(r"\S ")


@dataclass(frozen=True)
class Vocabulary:
    """``encode`` gives the ids of texts that a space goes before, one list after the other, and how many each has; ``token_bytes`` is empty
    for ids that stand for no bytes."""

    encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    token_bytes: list[bytes]

    def crosses(self) -> bool:
        """Whether some token holds a space after visible text, so that texts cannot be cut there."""
        return any(_CROSSED.search(b.decode("utf-8", "replace")) for b in self.token_bytes)


_vocabularies: dict[str, Vocabulary] = {}


def _flat(lists: Iterable) -> tuple[np.ndarray, np.ndarray]:
    held = [np.asarray(x, np.int64) for x in lists]
    return np.concatenate([np.empty(0, np.int64), *held]), np.fromiter(map(len, held), np.int64, len(held))


def _byte_level(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = _byte_of()
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    table = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        if all(c in byte_of for c in token):
            table[i] = bytes(byte_of[c] for c in token)
    one, lengths = encoder(path), np.fromiter(map(len, table), np.int64, len(table))

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if all(t and not t[-1].isspace() for t in texts):
            # Nothing goes on over the spaces between them, so that all are encoded as one text and told apart by their bytes.
            ids = one("".join([" " + t for t in texts])).astype(np.int64)
            ends = np.cumsum([len(t.encode()) + 1 for t in texts])
            reached = np.cumsum(lengths[ids])
            last = np.searchsorted(reached, ends)
            if len(last) and last[-1] == len(ids) - 1 and (reached[last] == ends).all():
                return ids, np.diff(last, prepend=-1)
        return _flat(one(" " + t) for t in texts)

    return Vocabulary(encode, table)


def _pieces(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    table = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        table.append(b"" if sp.is_control(i) or sp.is_unknown(i) else bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = sp.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int64, sizes.sum()), sizes

    return Vocabulary(encode, table)


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per worker: a sentencepiece model, or byte-level BPE as JSON."""
    if path not in _vocabularies:
        _vocabularies[path] = _pieces(path) if path.endswith(".model") else _byte_level(path)
    return _vocabularies[path]


class Aligner:
    """Aligns the tokens of two vocabularies over a batch of texts."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.sides = (a, b)
        self.lengths = [np.fromiter(map(len, v.token_bytes), np.int64, len(v.token_bytes)) for v in self.sides]
        n_a, n_b = (len(v.token_bytes) for v in self.sides)
        # Each id as text, with what goes before it: nothing, a new group or the group's next token; the other side, or its next token.
        self.listed = [before + str(i) for before in ("", ";", ",") for i in range(n_a)] + [before + str(i) for before in ("|", ",") for i in range(n_b)]

    def _encoded(self, side: int, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, the text of each, and which texts the bytes of their tokens give again."""
        ids, sizes = self.sides[side].encode(texts)
        wanted = [(" " + t).encode() for t in texts]
        owner = np.repeat(np.arange(len(texts)), sizes)
        given = np.bincount(owner, self.lengths[side][ids], len(texts)).astype(np.int64)
        table = self.sides[side].token_bytes
        good = given == np.fromiter(map(len, wanted), np.int64, len(wanted))
        if not good.all() or b"".join(map(table.__getitem__, ids.tolist())) != b"".join(wanted):
            ends = np.cumsum(sizes)
            for i, (x, y) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True)):
                good[i] = b"".join(map(table.__getitem__, ids[x:y].tolist())) == wanted[i]
        return ids, owner, good

    def align(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """For each text whether its tokens' bytes are its own, and n_a, n_b, n_groups and n_links; the linked pairs of all texts; their groups."""
        size = len(texts)
        (ids_a, own_a, good_a), (ids_b, own_b, good_b) = (self._encoded(side, texts) for side in (0, 1))
        good = good_a & good_b
        ids_a, own_a, ids_b, own_b = ids_a[good[own_a]], own_a[good[own_a]], ids_b[good[own_b]], own_b[good[own_b]]
        # Both sides cover the same bytes, so that one running count places the tokens of all texts in order.
        end_a, end_b = np.cumsum(self.lengths[0][ids_a]), np.cumsum(self.lengths[1][ids_b])
        token_a = pd.DataFrame({"start": end_a - self.lengths[0][ids_a], "document": own_a, "a": np.arange(len(ids_a))})
        token_b = pd.DataFrame({"start": end_b - self.lengths[1][ids_b], "document": own_b, "b": np.arange(len(ids_b))})
        # For each token start of one side the token of the other that covers it; both directions give some links twice.
        overlaps = pd.concat([pd.merge_asof(token_a, token_b, on="start", by="document"), pd.merge_asof(token_b, token_a, on="start", by="document")])
        links = np.sort(overlaps["a"].to_numpy() * max(len(ids_b), 1) + overlaps["b"].to_numpy(), kind="stable")
        link_a, link_b = np.divmod(links[np.diff(links, prepend=-1) > 0], max(len(ids_b), 1))
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        count = lambda owner: np.bincount(owner, minlength=size)
        sizes = np.stack([count(own_a), count(own_b), count(own_a[np.searchsorted(end_a, cuts)]), count(own_a[link_a])])
        # A group's A tokens come before its B tokens.
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        first_a, first_b = np.diff(group_a, prepend=-1) > 0, np.diff(group_b, prepend=-1) > 0
        begins = np.diff(own_a, prepend=-1) > 0
        n_a, n_b = (len(v.token_bytes) for v in self.sides)
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=len(cuts)))]).astype(np.int64)
        upto_a = np.cumsum(np.bincount(group_a, minlength=len(cuts)))
        codes[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + n_a * np.where(begins, 0, np.where(first_a, 1, 2))
        codes[np.arange(len(ids_b)) + upto_a[group_b]] = ids_b + 3 * n_a + n_b * np.where(first_b, 0, 1)
        parts, ends = list(map(self.listed.__getitem__, codes.tolist())), np.cumsum(sizes[0] + sizes[1]).tolist()
        groups = ["".join(parts[x:y]).encode() for x, y in pairwise([0, *ends])]
        return good, sizes, (ids_a[link_a] << _SHIFT) | ids_b[link_b], groups


class Stretches:
    """The alignments of all stretches of text that a task has met, each made once.

    Where no token of either vocabulary goes on over a space after visible text, a document is a row of stretches that start there, and
    its alignment is theirs one after the other.  Otherwise a document is one stretch.
    """

    def __init__(self, path_a: str, path_b: str):
        a, b = vocabulary(path_a), vocabulary(path_b)
        self.aligner, self.whole = Aligner(a, b), a.crosses() or b.crosses()
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.good = np.empty(0, bool)
        self.groups: list[bytes] = []
        #: n_a, n_b, n_groups and n_links of each stretch.
        self.sizes = np.empty((4, 0), np.int64)
        #: The linked pairs of all stretches, one stretch after the other.
        self.pairs = np.empty(0, np.int64)

    def learn(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all texts' stretches, one text after the other, with the start and end of each text's;
        a text some of whose token bytes are not its own has none."""
        documents = [([t] if self.whole else _CUT.split(t)) if t else [] for t in texts]
        new = list({s: None for d in documents for s in d if s not in self.place})
        ending = [[s for s in new if not s or s[-1].isspace()], [s for s in new if s and not s[-1].isspace()]]
        for part in (part[i : i + (1 << 16)] for part in ending for i in range(0, len(part), 1 << 16)):
            good, sizes, pairs, groups = self.aligner.align(part)
            self.place.update(zip(part, range(len(self.place), len(self.place) + len(part)), strict=True))
            self.groups += groups
            self.good, self.pairs = np.concatenate([self.good, good]), np.concatenate([self.pairs, pairs])
            self.sizes = np.concatenate([self.sizes, sizes], 1)
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        places = np.fromiter(map(self.place.__getitem__, chain.from_iterable(documents)), np.int64, sizes.sum())
        bad = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~self.good[places]], minlength=len(sizes)) > 0
        places = places[~np.repeat(bad, sizes)]
        ends = np.cumsum(np.where(bad, 0, sizes))
        return places, np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)], ends

    def full(self) -> bool:
        return len(self.place) > STRETCHES


def _documents(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts, about a million bytes of text at a time; bytes that are not UTF-8 count as an empty text."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = t.as_py() or b""
            try:
                texts.append(raw.decode())
            except UnicodeDecodeError:
                texts.append("")
            ids.append(i)
            held += len(raw)
            if held > most:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _summed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of each row of ``values`` from each start to its end; the ranges follow one another."""
    out = np.zeros((len(values), len(starts)), np.int64)
    filled = ends > starts
    if filled.any():
        out[:, filled] = np.add.reduceat(values, starts[filled], axis=1)
    return out


_ALIGNED = [
    ("doc_id", pa.int64(), "long"), ("n_a", pa.int64(), "long"), ("n_b", pa.int64(), "long"), ("n_groups", pa.int64(), "long"),
    ("n_links", pa.int64(), "long"), ("groups_sha256", pa.string(), "string"), ("pairs", pa.list_(pa.int64()), "array<long>"),
    ("groups", pa.string(), "string"),
]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _align(path_a: str, path_b: str, fields: list) -> Callable:
    """Tasks that align their documents; ``pairs`` lists the linked pair of each link of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, with_groups = Stretches(path_a, path_b), len(fields) == len(_ALIGNED)
        for ids, texts in _documents(batches):
            places, starts, ends = known.learn(texts)
            totals = _summed(known.sizes[:, places], starts, ends)
            links = known.sizes[3]
            pairs = known.pairs[_ranges((np.cumsum(links) - links)[places], links[places])]
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(totals[3])]), pa.int32()), pa.array(pairs, pa.int64()))
            digests, groups = [], []
            for x, y in zip(starts.tolist(), ends.tolist(), strict=True):
                joined = b";".join(map(known.groups.__getitem__, places[x:y].tolist()))
                digests.append(hashlib.sha256(joined).hexdigest() if y > x else "")
                if with_groups:
                    groups.append(joined.decode())
            columns = [ids, *totals, digests, listed, groups]
            yield pa.RecordBatch.from_arrays(
                [c if c is listed else pa.array(c, t) for c, (_, t, _) in zip(columns, fields, strict=False)], names=[f for f, _, _ in fields]
            )
            if known.full():
                known.clear()

    return run


def pair_counts(aligned: DataFrame, scratch: Scratch) -> DataFrame:
    """All linked id pairs of the corpus as a written table: ``pair``, ``n`` links and ``best`` (1 if no pair of its B id has more)."""
    plain = scratch.save(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    b = F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    # One row for each entry of the vocabulary at most.
    highest = plain.groupBy(b.alias("_b")).agg(F.max("n").alias("_most"))
    marked = plain.join(F.broadcast(highest), b == F.col("_b")).select("pair", "n", (F.col("n") == F.col("_most")).cast("long").alias("best"))
    out = scratch.save(marked)
    scratch.drop(plain)
    return out


def _hot(pairs: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of at least so many links, the least power of two that leaves ``most`` pairs, and the others."""
    bits = F.length(F.bin("n"))
    sizes = {r["bits"]: r["count"] for r in pairs.groupBy(bits.alias("bits")).count().collect()}
    least, held = 64, 0
    while least > 1 and held + sizes.get(least - 1, 0) <= most:
        least -= 1
        held += sizes.get(least, 0)
    return pairs.filter(bits >= least), pairs.filter(bits < least)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, *, hot_pairs: int = HOT_PAIRS, with_groups: bool = False) -> DataFrame:
    """Align the tokens of two vocabulary files over each text of ``docs`` (doc_id, text), as bytes of a space and the text.

    Returns per document doc_id, n_a, n_b, n_groups (stretches between byte offsets where tokens of both sides end), n_links (pairs of tokens
    that overlap), n_best (links whose id pair is linked most often in the corpus among the pairs of its B id, ties included), count_sum
    (corpus-wide links of each link's id pair, summed), groups_sha256 and, ``with_groups``, the groups as ``a1,a2|b1;a3|b2,b3``.

    In a task, ``pandas.merge_asof`` finds for each token start the other side's token that covers it, keyed by the stretch of document that
    both tokens lie in; the union of both directions are the links, and equal ends cut the groups.  A stretch that comes again takes
    the result it had.  The texts are aligned once and the pair of each link is written (8 bytes before compression); Spark counts the
    links of each pair and sums those counts for each document: the pairs of at least a power of two of links, at most ``hot_pairs`` of
    them, are broadcast, and links of other pairs are joined with the written counts.  No joined key has more links than that power, so
    that no key is hot.

    A text that is null, empty or not UTF-8, and one whose joined token bytes are not those of a space and the text, has no tokens: zeros
    and an empty string, and it counts for no pair.  Repeated rows count and return each time, null ids stay null.  Very long texts are aligned
    whole, 65,536 stretches at a time; one without spaces is a single stretch.  Columns beside doc_id and text are not read; an empty table
    gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "align")
    fields = _ALIGNED if with_groups else _ALIGNED[:-1]
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    aligned = scratch.save(
        texts.mapInArrow(_align(path_a, path_b, fields), ", ".join(f"{f} {t}" for f, _, t in fields))
        .withColumn("row", F.monotonically_increasing_id())
    )
    hot, cold = _hot(pair_counts(aligned, scratch), hot_pairs)
    links = aligned.select("row", F.explode("pairs").alias("pair"))
    found = links.join(F.broadcast(hot), "pair")
    if not cold.isEmpty():
        found = found.unionByName(links.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(cold, "pair"))
    sums = found.groupBy("row").agg(F.sum("best").alias("_best"), F.sum("n").alias("_sum"))
    scored = scratch.save(aligned.drop("pairs").join(sums, "row", "left"))
    scratch.drop(aligned)
    return scored.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("_best", F.lit(0)).alias("n_best"), F.coalesce("_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
        *(["groups"] if with_groups else []),
    )
