"""Hierarchical packing of tokenised documents into windows of several context sizes."""

from __future__ import annotations

import bisect
import heapq
import json
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import ship

#: Id that ends every document.
END_ID = 1
#: Tokens that one packing batch holds at most, but for its last document.
BATCH_TOKENS = 1 << 20
Encode = Callable[[str], np.ndarray]
_encoders: dict[str, tuple[Encode, Encode]] = {}


def _byte_of() -> dict[str, int]:
    """The byte for which each character stands in byte-level vocabularies: itself if it is visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _from_file(path: str) -> tuple[Encode, Encode]:
    """text -> ids, for text between added tokens and for any text.  A file of byte-level BPE whose merges stand in the order of their ids is
    encoded by tiktoken from the file's own vocabulary, which is several times faster; any other by tokenizers."""
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, byte_of = spec["model"], _byte_of()
    vocab, merges = model.get("vocab") or {}, model.get("merges") or []
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    ids = [vocab.get(a + b) for a, b in pairs] if model["type"] == "BPE" else [None]
    split = spec.get("pre_tokenizer") or {}
    byte_level = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    added = {t["content"]: t for t in spec.get("added_tokens", [])}
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added.values())
    if byte_level and plain and not spec.get("normalizer") and None not in ids and all(x < y for x, y in pairwise(ids)):
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if all(c in byte_of for c in t)}
        import tiktoken

        ranks = {t: i for t, i in ranks.items() if t.decode("latin-1") not in added}
        encode = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        between = lambda text: np.array(encode(text), np.uint32)
        if not added:
            return between, between
        # Of several added tokens at one place the longest is taken.
        cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

        def whole(text: str) -> np.ndarray:
            parts = cut.split(text)
            if len(parts) == 1:
                return between(text)
            # Every second part is an added token.
            return np.concatenate([np.array([added[p]["id"]], np.uint32) if i % 2 else between(p) for i, p in enumerate(parts)])

        return between, whole
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    by_library = lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)
    return by_library, by_library


def encoder(path: str, added_tokens: bool = False) -> Encode:
    """The file's encoder, read once per worker; with ``added_tokens`` it knows the file's added tokens in text, as tokenizers does."""
    if path not in _encoders:
        _encoders[path] = _from_file(path)
    return _encoders[path][added_tokens]


def pack_lengths(lengths: Sequence[int], tiers: Sequence[int], groups: int) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """Windows (tier, step group, [(document, start, length)]) that hold every token once.

    1. Documents longer than the longest context fill whole windows of it;
       the rest of each is routed to the smallest tier that holds it.
    2. Each tier, the longest first, opens a window with its longest piece,
       then takes the longest piece that still fits, from its own tier or a
       shorter one; when none fits, one is cut to fill the gap exactly.
    3. What is left once no tier can fill a window, less than the shortest
       tier, goes to windows of falling powers of two, without padding.
    4. Windows are dealt to step groups, each to the group of fewest tokens.
    """
    top = tiers[-1]
    windows: list[tuple[int, list[tuple[int, int, int]]]] = []
    pools: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # (length, document, start), sorted

    def put(doc: int, start: int, length: int) -> None:
        if length:
            bisect.insort(pools[bisect.bisect_left(tiers, length)], (length, doc, start))

    for doc, n in enumerate(lengths):
        start = 0
        while n - start > top:
            windows.append((top, [(doc, start, top)]))
            start += top
        if n > start:
            pools[bisect.bisect_left(tiers, n - start)].append((n - start, doc, start))
    for pool in pools:
        pool.sort()

    def take(space: int) -> tuple[int, int, int] | None:
        """The longest piece of at most ``space``, out of its pool."""
        for t in range(bisect.bisect_left(tiers, space), -1, -1) if space <= top else ():
            k = bisect.bisect_right(pools[t], (space, 1 << 62, 0))
            if k:
                return pools[t].pop(k - 1)
        return None

    def cut(space: int) -> tuple[int, int, int] | None:
        """``space`` tokens off the shortest longer piece, whose rest is routed anew."""
        for t in range(bisect.bisect_left(tiers, space), len(tiers)) if space <= top else ():
            k = bisect.bisect_right(pools[t], (space, 1 << 62, 0))
            if k < len(pools[t]):
                n, doc, start = pools[t].pop(k)
                put(doc, start + space, n - space)
                return space, doc, start
        return None

    def fill(size: int) -> None:
        pieces, space = [], size
        while space:
            n, doc, start = take(space) or cut(space)
            pieces.append((doc, start, n))
            space -= n
        windows.append((size, pieces))

    left = sum(n for pool in pools for n, _, _ in pool)
    for t in range(len(tiers) - 1, -1, -1):
        # A window opens for the tier's own pieces; shorter tiers fill its gaps.
        while pools[t] and left >= tiers[t]:
            fill(tiers[t])
            left -= tiers[t]
    while left:
        size = min(top, 1 << (left.bit_length() - 1))
        fill(size)
        left -= size
    load = [(0, g) for g in range(groups)]
    out = []
    for size, pieces in sorted(windows, key=lambda w: -w[0]):
        total, g = heapq.heappop(load)
        heapq.heappush(load, (total + size, g))
        out.append((size, g, pieces))
    return out


_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    tiers: Sequence[int] = (256, 512, 1024, 2048), step_groups: int = 8, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group[, ids]).

    A document is its token ids and then ``END_ID``; the file's added tokens
    are known in text, as ``tokenizers`` does.  Null text is empty and has the
    end alone.  Each id lies in one piece, pieces of a sequence follow
    each other without gaps, and every sequence is exactly as long as a
    power of two (``tier``), so that nothing is padded.  ``step_group`` deals
    the sequences of a batch to groups of nearly equal tokens.

    Every partition packs its own documents in batches of ``BATCH_TOKENS``;
    nothing is shuffled, memory is bounded by the batch and the longest
    document, and a lost task repeats its partition alone.  A sequence id is
    made of partition and window number.  Repeated rows are packed as
    documents of their own; a null id stays null; empty tables give an empty
    result; extra columns are not read.
    """
    ship(docs.sparkSession)
    sizes = sorted(tiers)
    if any(t & (t - 1) for t in sizes):
        raise ValueError("tiers are powers of two")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer_path, added_tokens=True)
        base, opened = TaskContext.get().partitionId() << 40, 0
        held_ids: list = []
        held: list[np.ndarray] = []
        total = 0

        def flush(type_) -> pa.RecordBatch:
            nonlocal opened, total
            rows: list[list] = [[] for _ in range(len(_COLUMNS) + 2)]
            for tier, group, pieces in pack_lengths([len(x) for x in held], sizes, step_groups):
                at = 0
                for doc, start, n in pieces:
                    ids = held[doc][start : start + n]
                    row = (held_ids[doc], start, n, zlib.crc32(ids.astype("<u4").tobytes()), len(held[doc]), base + opened, at, tier, group)
                    for col, v in zip(rows, row, strict=False):
                        col.append(v)
                    if with_ids:
                        rows[-1].append(ids)
                    at += n
                opened += 1
            held_ids.clear()
            held.clear()
            total = 0
            arrays = [pa.array(rows[0], type_), *(pa.array(c, pa.int64()) for c in rows[1:-1])]
            names = [id_col, *_COLUMNS]
            if with_ids:
                ends = np.cumsum([0, *map(len, rows[-1])], dtype=np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows[-1]).astype(np.int32))))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        type_ = pa.int64()
        for b in batches:
            type_ = b.column(id_col).type
            for i, text in zip(b.column(id_col), b.column("_text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END_ID)).astype(np.uint32)
                held_ids.append(i.as_py())
                held.append(ids)
                total += len(ids)
                if total >= BATCH_TOKENS:
                    yield flush(type_)
        if held:
            yield flush(type_)

    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{c} long" for c in _COLUMNS) + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)
