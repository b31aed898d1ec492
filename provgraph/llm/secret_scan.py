"""Secrets in documents: a trigram index proposes candidates for each rule, regular expressions verify them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import LOWER_TABLE, Scratch


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` finds leftmost non-overlapping matches; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in _compiled(self.pattern).finditer(text) if len(m[self.group]) >= self.least]


_patterns: dict[str, re.Pattern] = {}


def _compiled(pattern: str) -> re.Pattern:
    if pattern not in _patterns:
        _patterns[pattern] = re.compile(pattern)
    return _patterns[pattern]


#: The base kinds, in the order in which ties between their spans are listed.
BASE_RULES = (
    SecretRule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 16),
    SecretRule("hex", r"[0-9a-f]+", 0, 32),
)
#: Further public token formats: key blocks, signed tokens, hosting, chat, payment and map service keys.
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    SecretRule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("hosting_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("payment_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    SecretRule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
)

#: Most strings that are followed through a pattern before its trigrams are taken.
_MOST = 64
#: Trigrams of a conjunction that are asked for; more would only narrow the candidates further.
_BITS = 60
_ANY = None  # a query that every text meets

# A query is a frozenset of conjunctions (their disjunction); a conjunction is a frozenset of trigrams.


def _both(a, b):
    if a is _ANY or b is _ANY:
        return b if a is _ANY else a
    return frozenset(x | y for x in a for y in b) if len(a) * len(b) <= _MOST else min(a, b, key=len)


def _either(a, b):
    return _ANY if a is _ANY or b is _ANY else a | b


def _grams(strings: frozenset[str]):
    """Every string's trigrams, of one of them; a string of under three characters demands nothing."""
    if any(len(s) < 3 for s in strings):
        return _ANY
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _walk(items) -> tuple[frozenset[str] | None, object]:
    """(all strings that the items match, if few, else None; the trigram query), letters lower-cased."""
    exact: frozenset[str] | None = frozenset([""])  # of the run of items with few strings that ends here
    whole, query = True, _ANY
    for op, arg in items:
        strings, inner = _one(op, arg)
        if strings is not None and exact is not None and len(exact) * len(strings) <= _MOST:
            exact = frozenset(a + b for a in exact for b in strings)
            continue
        query = _both(query, _grams(exact))
        whole = False
        query = _both(query, inner if strings is None else _ANY)
        exact = frozenset([""]) if strings is None else strings
    return (exact if whole else None), _both(query, _grams(exact)) if not whole else _grams(exact)


def _one(op, arg) -> tuple[frozenset[str] | None, object]:
    if op is C.LITERAL:
        return frozenset([chr(arg).translate(_FOLD)]), _ANY
    if op is C.IN and all(o is C.LITERAL for o, _ in arg):
        return frozenset(chr(a).translate(_FOLD) for _, a in arg), _ANY
    if op is C.SUBPATTERN:
        return _walk(arg[3])
    if op is C.AT:
        return frozenset([""]), _ANY
    if op is C.BRANCH:
        parts = [_walk(x) for x in arg[1]]
        query = parts[0][1]
        for _, q in parts[1:]:
            query = _either(query, q)
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= _MOST:
            return frozenset().union(*(s for s, _ in parts)), query
        return None, query
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, what = arg
        strings, query = _walk(what)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, _ANY
        return None, query if low else _ANY
    return None, _ANY


_FOLD = {i: i + 32 for i in range(65, 91)}


def trigram_query(pattern: str):
    """A Boolean trigram query that every text with a match of ``pattern`` meets.

    An iterable of conjunctions, one of which must hold: all its trigrams
    occur in the text, A-Z lower-cased.  None when the pattern demands no
    trigram, so that only a full scan finds its matches.
    """
    return _walk(_parser.parse(pattern))[1]


def find_secrets(docs: DataFrame, rules: Sequence[SecretRule] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>), one row per row of ``docs``, spans by start, then rule.

    1. Each rule's pattern yields a Boolean trigram query.
    2. The inverted index posts every document under the trigrams, of those
       that some query names, that it holds.
    3. Postings are intersected: a conjunction proposes the documents that
       are posted under all its trigrams, a rule the union of its
       conjunctions' documents.
    4. Rules verify their candidates' whole texts; rules whose query demands
       nothing scan all texts, in the same pass that posts the trigrams.

    Start and end are code points, end exclusive.  Null text is empty and has
    no spans.  A row is known by its id (also a null one) and its text, so that
    repeated rows get the same spans.  Empty tables give an empty result; extra columns are not read.

    The postings of one document are at most as many as the queries'
    trigrams, and they are intersected per document, so a trigram that most
    documents hold makes no hot key.  Only candidates are fetched again: the
    semi join is broadcast under Spark's size check, else a run-time Bloom
    filter prunes the scan.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "secrets")
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    scanned = [r for r in rules if queries[r.kind] is _ANY]
    indexed = [r for r in rules if queries[r.kind] is not _ANY]
    grams = sorted({g for r in indexed for clause in queries[r.kind] for g in clause})
    number = {g.encode(): i for i, g in enumerate(grams)}
    place = {r.kind: i for i, r in enumerate(rules)}
    id_type = docs.schema[id_col].dataType.simpleString()
    span = "array<struct<start:int,kind:int,end:int>>"
    item = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_h"))

    def spans_of(text: str, chosen: Sequence[SecretRule]) -> list[dict]:
        return [{"start": a, "kind": place[r.kind], "end": b} for r in chosen for a, b in r.spans(text)]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            posted, found = [], []
            for t in b.column("_text"):
                text = t.as_py()
                low = text.encode().translate(LOWER_TABLE)
                posted.append([number[g] for g in number if g in low])
                found.append(spans_of(text, scanned))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_h"), pa.array(posted, pa.list_(pa.int32())), pa.array(found, pa.list_(item))], ["_id", "_h", "grams", "found"])

    base = scratch.save(texts.mapInArrow(index, f"_id {id_type}, _h long, grams array<int>, found {span}"))
    clauses = [
        (place[r.kind], n, number[g.encode()], 1 << bit, (1 << len(clause[:_BITS])) - 1)
        for r in indexed for n, clause in enumerate(sorted(map(sorted, queries[r.kind]))) for bit, g in enumerate(clause[:_BITS])
    ]
    postings = base.select(F.explode("grams").alias("gram"), "_id", "_h")
    # One row for each trigram of each conjunction of the given rules.
    asked = F.broadcast(spark.createDataFrame(clauses, "kind int, clause int, gram int, bit long, all long"))
    met = postings.join(asked, "gram").groupBy("_id", "_h", "kind", "clause", "all").agg(F.bit_or("bit").alias("bits")).where("bits = all")
    candidates = scratch.save(met.groupBy("_id", "_h").agg(F.collect_set("kind").alias("kinds")))
    by_kind = {place[r.kind]: r for r in indexed}

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [spans_of(t.as_py(), [by_kind[k] for k in sorted(ks.as_py())]) for t, ks in zip(b.column("_text"), b.column("kinds"), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_h"), pa.array(found, pa.list_(item))], ["_id", "_h", "more"])

    def by_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.withColumnRenamed("_id", "_id2").withColumnRenamed("_h", "_h2")
        return left.join(right, (F.col("_h") == F.col("_h2")) & F.col("_id").eqNullSafe(F.col("_id2")), how).drop("_id2", "_h2")

    more = by_row(texts, candidates, "inner").select("_id", "_h", "_text", "kinds").mapInArrow(verify, f"_id {id_type}, _h long, more {span}")
    more = scratch.save(more.where(F.size("more") > 0).dropDuplicates(["_id", "_h"]))
    base = by_row(base, more, "left")
    spans = F.array_sort(F.concat("found", F.coalesce("more", F.array().cast(span))))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    named = F.transform(spans, lambda s: F.struct(kinds[s["kind"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return base.select(F.col("_id").alias(id_col), named.alias("spans"))
