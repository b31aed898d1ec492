"""Near-duplicate embeddings: sorted projection passes with bounded neighbour windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch, numbered, row_groups
from provgraph.llm.graph import connected_components

#: Passes, random hyperplanes of a pass's key, neighbours that a vector is compared with on each side, rows of a block.
PASSES, PLANES, WINDOW, BLOCK = 24, 62, 48, 1024


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) for each length of vector."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(size))


def near_duplicate_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.98,
    passes: int = PASSES, window: int = WINDOW, block: int = BLOCK, seed: int = 7,
) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``vectors``.

    Two vectors are linked when their labels are equal and not null and their
    cosine in double precision is at least ``threshold``.

    1. Vectors with equal label and components form a class, stood for by
       its smallest id.
    2. Each pass gives a class the concatenated signs of its projections on
       ``PLANES`` random directions, sorts classes by pass, label and key,
       and numbers them.  Blocks of consecutive rows, overlapping by
       ``window``, compare each row with the ``window`` rows after it.
    3. Pairs found in any pass are united into components.
    4. A component is then compared with itself completely, block against
       block, so that ``n_links`` misses no link inside it, however many
       neighbours beyond the window a vector has.

    What may be missed is a link between two components that no pass brought
    within a window; none is reported below the threshold.  ``n_links``
    counts vectors: all others of the class, and all of a linked class.

    Vectors that are null, empty, zero or hold null or non-finite components,
    or have a null label or id, link with nothing; vectors of different
    lengths do not link.  Rows of one id count as one vector each.  Empty
    tables give an empty result; extra columns are not read.

    No group is gathered whole: blocks are bounded, their numbers come from a
    distributed sort.  Copies, however many, are folded on the map side.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    v = F.col("_v")
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).cast("array<double>").alias("_v"), F.col(label_col).alias("label"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.col("label").isNotNull() & F.col("_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    # -0.0 and 0.0 are the same component.
    rows = scratch.save(rows.select("_id", "label", F.when(F.coalesce(whole, F.lit(False)), F.transform(v, lambda x: x + F.lit(0.0))).alias("_v")))
    valid = rows.where("_v is not null")
    classes = scratch.save(valid.groupBy("label", "_v").agg(F.min("_id").alias("rep"), F.count("*").alias("copies")))
    found = scratch.save(_window_pairs(scratch, classes, threshold, passes, window, block, seed).distinct())
    comp = scratch.save(connected_components(scratch, found))
    inside = _links_inside(scratch, classes.join(comp.withColumnRenamed("id", "rep"), "rep"), threshold, block)
    per = classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").join(inside, "rep", "left").select(
        "label", "_v", F.coalesce("component", "rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    out = rows.join(scratch.save(per), ["label", "_v"], "left")
    component = F.coalesce("component_id", "_id")
    return out.select(
        F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def _window_pairs(scratch: Scratch, classes: DataFrame, threshold: float, passes: int, window: int, block: int, seed: int) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = np.int64(1) << np.arange(PLANES - 1, -1, -1, dtype=np.int64)
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            out = np.empty((b.num_rows, passes), np.int64)
            for at, x in _by_length(b.column("_v")):
                size = x.shape[1]
                if size not in planes:
                    planes[size] = np.random.default_rng((seed, size)).standard_normal((size, passes * PLANES))
                out[at] = (x @ planes[size] >= 0).reshape(len(at), passes, PLANES) @ powers
            yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("label"), pa.array(out.tolist(), pa.list_(pa.int64()))], ["rep", "label", "keys"])

    label = classes.schema["label"].dataType.simpleString()
    keyed = classes.select("rep", "label", "_v").mapInArrow(keys, f"rep long, label {label}, keys array<long>")
    sorted_ = numbered(scratch, keyed.select("rep", "label", F.posexplode("keys").alias("pass", "key")), ["pass", "label", "key", "rep"])
    # A row belongs to its block and, among the first ``window`` of it, also to the end of the one before.
    at = F.floor(F.col("pos") / block).cast("long")
    both = F.when((F.col("pos") % block < window) & (at > 0), F.array(at, at - 1)).otherwise(F.array(at))
    placed = sorted_.select("rep", "pass", "label", "pos", F.explode(both).alias("block"))
    placed = placed.join(classes.select("rep", "_v"), "rep")
    placed = placed.repartition("block").sortWithinPartitions("block", "pos")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (blk,), g in row_groups(batches, ["block"]):
            a_out, b_out = [], []
            for at, x in _by_length(g["_v"]):
                x = _unit(x)
                rep, pos, turn, label_ = (g[c].to_numpy()[at] for c in ("rep", "pos", "pass", "label"))
                for d in range(1, min(window, len(at) - 1) + 1):
                    near = (np.einsum("ij,ij->i", x[:-d], x[d:]) >= threshold) & (turn[:-d] == turn[d:]) & (label_[:-d] == label_[d:])
                    near &= (pos[d:] - pos[:-d] <= window) & (pos[:-d] // block == blk)
                    a_out += rep[:-d][near].tolist()
                    b_out += rep[d:][near].tolist()
            ab = sorted({(min(p), max(p)) for p in zip(a_out, b_out, strict=True) if p[0] != p[1]})
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in ab], pa.int64()) for i in (0, 1)], ["a", "b"])

    return placed.mapInArrow(compare, "a long, b long")


def _links_inside(scratch: Scratch, members: DataFrame, threshold: float, block: int) -> DataFrame:
    """(rep, others): for each class how many vectors of other classes of its component it is linked with.

    Components are cut into blocks by hash; a row goes to every pair of blocks
    that its own takes part in, and a task multiplies one pair at a time.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut = members.join(sizes, "component").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    side = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("mine", o).alias("i"), F.greatest("mine", o).alias("j")))
    dealt = cut.select("component", "rep", "_v", "copies", "mine", F.explode(side).alias("p")).select("component", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "mine", "rep", "_v", "copies")
    dealt = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "mine", "rep")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), g in row_groups(batches, ["component", "i", "j"]):
            mine, rep, copies = (g[c].to_numpy() for c in ("mine", "rep", "copies"))
            count = np.zeros(len(rep), np.int64)
            for at, x in _by_length(g["_v"]):
                x = _unit(x)
                left, right = np.flatnonzero(mine[at] == i), np.flatnonzero(mine[at] == j)
                for k in left:
                    # Row by row, as the passes compute it, so that both agree at the threshold.
                    near = np.einsum("ij,ij->i", np.broadcast_to(x[k], (len(right), x.shape[1])), x[right]) >= threshold
                    near &= rep[at[right]] != rep[at[k]]
                    count[at[k]] += copies[at[right[near]]].sum()
                    if i != j:
                        count[at[right[near]]] += copies[at[k]]
            yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(count, pa.int64())], ["rep", "others"])

    return dealt.mapInArrow(multiply, "rep long, others long").groupBy("rep").agg(F.sum("others").alias("others"))
