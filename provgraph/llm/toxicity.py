"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from provgraph.llm.common import LOWER_TABLE, Scratch, crc_mod, ship
from provgraph.llm.minhash import near_duplicates

_EDGE = b".,;:!?\"'()[]{}<>*_-"
#: Lengths in bytes of the word beginnings that stand in for rare words.
_STEMS = (6, 5, 4)
#: Words whose log-odds a worker remembers; some 100 bytes each.
KNOWN = 50_000
#: Texts whose word counts a worker holds at a time.
COUNTED = 1_000


@dataclass(frozen=True)
class ToxicitySettings:
    """``sample``: labelled rows, by hash, that the model is fitted on at most; ``features``: of them kept at most, by |z|.

    ``prior``: strength of the Dirichlet prior, as a share of all training tokens.  ``least_z``,
    ``least_odds`` (absolute log-odds) and ``least_count``: what a feature needs.  ``cost``: taken off for a token
    without evidence.  ``calibrate``: one of so many sample rows of each class is kept from
    the log-odds for the extreme-value fit and the final weights.
    ``threshold``: least score of a toxic document.
    """

    sample: int = 50_000
    features: int = 100_000
    prior: float = 0.05
    least_z: float = 2.33
    least_odds: float = 1.5
    least_count: int = 3
    cost: float = 0.08
    calibrate: int = 4
    threshold: float = 0.7


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words at ASCII white space, A-Z lower-cased, punctuation at their edges off; empty ones go."""
    return [t for t in (w.strip(_EDGE) for w in text.translate(LOWER_TABLE).split()) if t] if text else []


def _keys(word: bytes) -> list[int]:
    """The word's own feature, then those of its beginnings, the longest first; signed 64 bits."""
    parts = [b"w" + word] + [b"%d" % n + word[:n] for n in _STEMS if len(word) > n]
    return [xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in parts]


@dataclass
class ToxicityModel:
    weight: dict[int, float] = field(default_factory=dict)
    cost: float = 0.08
    lam: float = 1.0
    logk: float = 0.0
    coef: tuple[float, ...] = (-6.0, 1.0, 0.0)
    threshold: float = 0.7

    def __post_init__(self):
        self._known: dict[bytes, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def of(self, word: bytes) -> float:
        """The log-odds of the most specific feature with evidence, 0 without any."""
        w = self._known.get(word)
        if w is None:
            w = next((self.weight[k] for k in _keys(word) if k in self.weight), 0.0)
            if len(self._known) >= KNOWN:
                self._known.clear()
            self._known[word] = w
        return w

    def segments(self, words: list[bytes]) -> list[tuple[float, int, int]]:
        """All maximal-scoring segments (score, first token, end), in linear time.

        A token without evidence costs ``cost``.  Segments are kept with the sums
        of scores before and after them; a new one is merged backwards with the
        nearest one that starts lower, as long as that raises the score.
        """
        found: list[list] = []  # [sum before, sum after, first, end, index of the nearest earlier segment that starts lower]
        total, last = 0.0, -1
        for i, word in enumerate(words):
            w = self.of(word)
            if not w:
                continue
            total -= self.cost * (i - last - 1)
            last = i
            if w <= 0:
                total += w
                continue
            new = [total, total + w, i, i + 1, -1]
            total += w
            while True:
                j = len(found) - 1
                while j >= 0 and found[j][0] >= new[0]:
                    j = found[j][4]
                if j < 0 or found[j][1] >= new[1]:
                    new[4] = j
                    found.append(new)
                    break
                new = [found[j][0], new[1], found[j][2], new[3], -1]
                del found[j:]
        return [(s[1] - s[0], s[2], s[3]) for s in found]

    def evidence(self, words: list[bytes]) -> tuple[float, float, float]:
        """(best, all, passages): nats by which segments exceed what chance brings in a text of this length.

        Chance is the extreme-value law of Karlin and Altschul: in n tokens,
        K n exp(-lambda s) segments reach score s.
        """
        chance = self.logk + math.log(max(len(words), 1))
        over = [x for x in (self.lam * s - chance for s, _, _ in self.segments(words)) if x > 0]
        return (max(over, default=0.0), sum(over), float(len(over)))

    def passages(self, words: list[bytes], p: float = 0.01) -> list[tuple[int, int, float]]:
        """(first token, end, log-odds) of each significant segment: expected less than ``p`` times by chance."""
        chance = self.logk + math.log(max(len(words), 1)) - math.log(p)
        return [(a, b, s) for s, a, b in self.segments(words) if self.lam * s > chance]

    def score(self, words: list[bytes]) -> float:
        best, all_, _ = self.evidence(words)
        z = self.coef[0] + self.coef[1] * math.log1p(best) + self.coef[2] * math.log1p(all_)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        # Counts of a part of the batch at a time; what it yields is summed in the same task.
        for at in range(0, whole.num_rows, COUNTED):
            b = whole.slice(at, COUNTED)
            per = (Counter(), Counter())
            for text, toxic in zip(b.column("_text"), b.column("toxic"), strict=True):
                per[toxic.as_py()].update(tokens_of(text.as_py()))
            out: dict[int, list[int]] = {}
            for side, counts in enumerate(per):
                for word, n in counts.items():
                    for k in _keys(word):
                        out.setdefault(k, [0, 0])[side] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int64()), *(pa.array([c[i] for c in out.values()], pa.int64()) for i in (0, 1))], ["k", "clean", "toxic"]
            )


def fit(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings | None = None, id_col: str = "doc_id", text_col: str = "text", mod: int = 3, held: int = 1) -> ToxicityModel:
    """Learn the model from labelled rows whose crc32 of the id (as text) modulo ``mod`` is not ``held``.

    At most ``settings.sample`` labels are used, chosen by a hash of the id:
    that bounds the id table sent to the scan and the rows that the last
    step, a logistic fit of two numbers a document, gets to the driver.
    Token counts are summed over the cluster.  A document labelled more than
    once is toxic if any label says so; null labels and ids are left out.
    One row in ``settings.calibrate`` of each class is kept for calibration; if
    a class has too few, all rows of the sample calibrate.  With one class
    only, no document is scored toxic.
    """
    s = settings or ToxicitySettings()
    scratch = Scratch(docs.sparkSession, "toxicity")
    usable = labels.where((crc_mod(id_col, mod) != held) & F.col("toxic").isNotNull())
    chosen = usable.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = scratch.save(chosen.orderBy(F.xxhash64("_id"), "_id").limit(s.sample))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    # At most ``sample`` rows.
    rows = scratch.save(_split(_distinct(scratch, texts.join(F.broadcast(chosen), "_id").select("_id", "_text", "toxic")), s.calibrate))
    counts = scratch.save(rows.where("fit").select("_text", "toxic").mapInArrow(_counted, "k long, clean long, toxic long").groupBy("k").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    # Every token counts once as a word and again for each beginning; the totals of words suffice for the odds.
    tot = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).first()
    model = ToxicityModel(cost=s.cost, threshold=s.threshold, coef=(-20.0, 0.0, 0.0))
    if not tot["clean"] or not tot["toxic"]:
        return model
    y1, y0, n1, n0 = F.col("toxic"), F.col("clean"), float(tot["toxic"]), float(tot["clean"])
    a, a0 = s.prior * (y1 + y0), s.prior * (n1 + n0)
    odds = F.log((y1 + a) / (n1 + a0 - y1 - a)) - F.log((y0 + a) / (n0 + a0 - y0 - a))
    z = odds / F.sqrt(1 / (y1 + a) + 1 / (y0 + a))
    strong = counts.select("*", odds.alias("w"), z.alias("z"), (y0 / n0).alias("p")).where((y1 + y0 >= s.least_count) & (F.abs("z") >= s.least_z) & (F.abs("w") >= s.least_odds))
    top = strong.orderBy(F.abs("z").desc(), "k").limit(s.features).toArrow().to_pydict()
    model.weight = dict(zip(top["k"], top["w"], strict=True))
    model.lam = _lambda(np.array(top["w"]), np.array(top["p"]), s.cost)
    rest = rows.where("not fit")
    if rest.select("toxic").distinct().count() < 2:
        rest = rows
    rest = rest.select("_text", "toxic")
    seen = _measured(rest, model, lambda m, w: (max((x for x, _, _ in m.segments(w)), default=0.0), float(len(w))))
    clean = seen[0] == 0
    if clean.any() and not clean.all():
        # Mean of the Gumbel law of the best score: (ln(K n) + Euler's constant) / lambda.
        model.logk = float(np.mean(model.lam * seen[1][clean] - np.log(np.maximum(seen[2][clean], 1))) - 0.5772)
        toxic, best, all_ = _measured(rest, model, lambda m, w: m.evidence(w)[:2])
        model.coef = _logistic(np.column_stack((np.ones(len(toxic)), np.log1p(best), np.log1p(all_))), toxic)
    scratch.drop(rows, counts, chosen)
    return model


def _distinct(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """The sample without copies and near copies, whose words would pass for words of their label.

    Copies are rows of one label that ``near_duplicates`` connects by 80 % of
    their three-word shingles, checked on the full sets; a shared passage does
    not make a copy.  The one with the least hash of its id stays.
    """
    rows = scratch.save(rows.withColumn("h", F.xxhash64("_id")))
    near = near_duplicates(rows, "h", "_text", width=3, percent=80).select("h", "component_id").distinct()
    of = scratch.save(near.join(rows.select("h", "toxic").distinct(), "h"))
    first = of.groupBy("component_id", "toxic").agg(F.min("h").alias("first"))
    copies = of.join(first, ["component_id", "toxic"]).where("h != first").select("h").distinct()
    return rows.join(copies, "h", "left_anti").select("h", "_text", "toxic")


def _split(rows: DataFrame, calibrate: int) -> DataFrame:
    """(_text, toxic, fit): of the rows of each label, in the order of a hash, one in ``calibrate`` is not for the fit.

    The window runs over ids and labels of the bounded sample.
    """
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("h", F.lit("part")), "h")
    ids = rows.select("h", "toxic").distinct()
    part = ids.select("h", (F.row_number().over(order) % calibrate != 0).alias("fit"))
    return rows.join(part, "h").select("_text", "toxic", "fit")


def _measured(rows: DataFrame, model: ToxicityModel, of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The label and two numbers of each row of the bounded sample."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [of(shared.value, tokens_of(t.as_py())) for t in b.column("_text")]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), *(pa.array([g[i] for g in got], pa.float64()) for i in (0, 1))], ["toxic", "a", "b"])

    t = rows.mapInArrow(run, "toxic int, a double, b double").toArrow()
    return tuple(t[c].to_numpy() for c in ("toxic", "a", "b"))


def _lambda(w: np.ndarray, p: np.ndarray, cost: float) -> float:
    """The positive root of E[exp(lambda s)] = 1 for tokens of clean text.

    Beginnings overlap the words they stand for; their mass is scaled so that
    all features together are at most half of the text.
    """
    if not (w > 0).any() or not p.sum():
        return 1.0
    p = p * min(1.0, 0.5 / p.sum())
    rest = 1 - p.sum()
    f = lambda x: float(np.sum(p * np.exp(np.minimum(x * w, 500))) + rest * math.exp(-x * cost)) - 1
    low, high = 1e-3, 1e-3
    if f(low) >= 0:
        return 1.0
    while f(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return min(low, 5.0)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Weights of a logistic fit by Newton's method, both evidence weights kept from falling below 0."""
    free = [True] * x.shape[1]
    for _ in range(x.shape[1]):
        cols = [i for i, f in enumerate(free) if f]
        b = np.zeros(len(cols))
        xs = x[:, cols]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(xs @ b, -30, 30)))
            g = xs.T @ (y - p) - ridge * b
            h = (xs * (p * (1 - p))[:, None]).T @ xs + ridge * np.eye(len(cols))
            step = np.linalg.solve(h, g)
            b += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        full = np.zeros(x.shape[1])
        full[cols] = b
        below = [i for i in cols if i and full[i] < 0]
        if not below:
            break
        free[below[0]] = False
    return tuple(float(v) for v in full)


def scores_of(model: ToxicityModel, texts: pa.Array) -> list[float]:
    """A score for each text; only one text's words are held, those of a whole batch take several times its texts."""
    return [model.score(tokens_of(t.as_py())) for t in texts]


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """(id, score, predicted[, passages]), one row per row of ``docs``, from its whole text.

    ``score`` rises with the evidence of the text's toxic segments, beyond what
    chance brings in a text of its length; ``predicted`` is 1 from the
    model's threshold on.  ``passages`` lists (first token, end, log-odds) of
    every significant segment.  Null and empty texts have no evidence.
    Repeated rows score alike; empty tables give an empty result; extra
    columns are not read.  A scan without shuffle; the model is bounded by
    its settings.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            scores = scores_of(m, b.column("_text"))
            arrays = [b.column("_id"), pa.array(scores, pa.float64()), pa.array([int(x >= m.threshold) for x in scores], pa.int32())]
            names = [id_col, "score", "predicted"]
            if passages:
                item = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("log_odds", pa.float64())])
                found = [[dict(zip(("first", "end", "log_odds"), p, strict=True)) for p in m.passages(tokens_of(t.as_py()))] for t in b.column("_text")]
                arrays.append(pa.array(found, pa.list_(item)))
                names.append("passages")
            yield pa.RecordBatch.from_arrays(arrays, names)

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, score double, predicted int" + (", passages array<struct<first:bigint,end:bigint,log_odds:double>>" if passages else "")
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text")).mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the model's threshold, all columns kept; no shuffle."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.score(tokens_of(t)) < m.threshold for t in texts], dtype=bool)

    return docs.where(clean(F.col(text_col).cast("binary")))
