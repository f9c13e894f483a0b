"""Exact search by inner product: vectors by descending length, partial sums in a rotated basis, bounds on the rest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybuy.llm.common import id_key, reuse_freed_memory
from tallybuy.operators.joins import lookup
from tallybuy.session import write_out

#: Vectors in a block and queries that meet it at once, about.
_BLOCK_ROWS, _QUERY_ROWS = 1 << 14, 1 << 13
#: Vectors of a block that are looked at between two updates of the thresholds.
_STEP = 1 << 10
_NONE = np.iinfo(np.int64).min
#: Bands of length in a doubling; zero length and none at all.
_BANDS, _LOWEST, _HIGHEST = 8, -1, 1 << 30


def _vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``row, vec_id, did, v``: vectors without null or non-finite components, as whole numbers."""
    return rows.select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).alias("_vector"), F.monotonically_increasing_id().alias("row")
    ).where(F.col("_vector").isNotNull()).select(
        "row",
        "vec_id",
        id_key("vec_id").alias("did"),
        F.when(
            F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))),
            F.transform("_vector", lambda x: F.floor(x.cast("double") * scale).cast("bigint")),
        ).alias("v"),
    ).where("v IS NOT NULL").withColumn(
        "length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix; short ones end in zeros."""
    out = np.zeros((len(lists), width), np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Basis of right singular vectors of all vectors, the most energetic first."""

    def moments(batches):
        total = np.zeros((width, width))
        for batch in batches:
            v = _matrix(batch["v"], width).astype(float)
            total += v.T @ v
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["line", "sums"]
        )

    def add(key, table):
        total = np.sum([np.frombuffer(x) for x in table["sums"].to_pylist()], axis=0)
        return pa.table({"line": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    lines = (
        vectors.select("v").mapInArrow(moments, "line int, sums binary").groupBy("line").applyInArrow(add, "line int, sums binary")
    )
    moment = np.zeros((width, width))
    for r in lines.collect():  # one row for each component
        moment[r["line"]] = np.frombuffer(r["sums"])
    return np.linalg.eigh((moment + moment.T) / 2)[1][:, ::-1].copy()


def _pack_blocks(vectors: DataFrame, rows: int, width: int) -> DataFrame:
    """Blocks of vectors by descending length: ``block, longest, ids, rows, body``."""

    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables).combine_chunks()
        lengths = table["length"].to_numpy()
        order = np.argsort(-lengths, kind="stable")
        body = _matrix(table["v"].chunk(0), width)[order]
        small = body.astype(np.int16)
        wide = not np.array_equal(small, body)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId()], pa.int32()),
                pa.array([float(lengths.max())]),
                pa.array([table["did"].to_numpy()[order].tobytes()], pa.binary()),
                pa.array([table["row"].to_numpy()[order].tobytes()], pa.binary()),
                pa.array([(body if wide else small).tobytes()], pa.binary()),
            ],
            names=["block", "longest", "ids", "rows", "body"],
        )

    count = max(1, -(-rows // _BLOCK_ROWS))
    # Equal lengths are told apart by the row, so a vector that many rows hold fills many blocks.
    ranged = vectors.repartitionByRange(count, F.col("length").desc(), F.col("row")).select("did", "row", "v", "length")
    return ranged.mapInArrow(run, "block int, longest double, ids binary, rows binary, body binary")


class _Best:
    """The k best (score, id, row) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), _NONE)
        self.ids = np.zeros((queries, k), np.int64)
        self.rows = np.full((queries, k), -1)

    def take(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """More candidates for some queries; of equal scores the smaller id is better."""
        k = self.scores.shape[1]
        scores = np.concatenate([self.scores[who], scores], axis=1)
        ids = np.concatenate([self.ids[who], ids], axis=1)
        rows = np.concatenate([self.rows[who], rows], axis=1)
        # Bitwise complement turns the order around without overflow.
        order = np.lexsort((rows, ids, ~scores), axis=-1)[:, :k]
        for name, value in (("scores", scores), ("ids", ids), ("rows", rows)):
            getattr(self, name)[who] = np.take_along_axis(value, order, 1)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers: in floating point where every sum is exact."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2.0**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def search_block(queries: dict, block: dict, basis: np.ndarray, k: int, head: int) -> _Best:
    """The k best vectors of a block for each query.

    The block's vectors come by descending length. A query leaves once its length
    times the longest vector that is left is under its threshold, the k-th best
    score known so far. For others the first ``head`` rotated components are
    multiplied, and the lengths of what remains bound the rest (Cauchy-Schwarz);
    only vectors that may reach the threshold get exact scores.
    """
    q, v = queries["v"], block["v"]
    best = _Best(len(q), k)
    threshold = queries["threshold"].copy()  # floats; -inf where there is none
    rotated_q, rotated_v = q @ basis, v @ basis
    rest_q = np.sqrt((rotated_q[:, head:] ** 2).sum(1))
    rest_v = np.sqrt((rotated_v[:, head:] ** 2).sum(1))
    long_q, long_v = np.sqrt((rotated_q**2).sum(1)), np.sqrt((rotated_v**2).sum(1))
    for at in range(0, len(v), _STEP):
        part = np.arange(at, min(at + _STEP, len(v)))
        part = part[np.argsort(block["ids"][part], kind="stable")]
        longest = long_v[part].max()
        slack = 1e-9 * long_q * longest + 1e-6  # what rounding may have taken
        who = np.flatnonzero(long_q * longest + slack >= threshold)
        if not len(who):
            break
        bound = rotated_q[who, :head] @ rotated_v[part, :head].T
        bound += rest_q[who, None] * rest_v[part]
        may = bound + slack[who, None] >= threshold[who, None]
        who, columns = who[may.any(1)], part[may.any(0)]
        if not len(who):
            continue
        scores = _dot(q[who], v[columns])
        scores[queries["rows"][who, None] == block["rows"][columns]] = _NONE
        few = min(k, len(columns))
        if len(columns) > 4 * k and np.abs(scores[scores != _NONE]).max(initial=0) < 2**50:
            # Columns come by id: the place breaks ties, and keys are distinct.
            n = len(columns)
            keys = np.where(scores == _NONE, -(2**61), scores * n) + np.arange(n)[::-1]
            top = np.argpartition(-keys, few - 1, axis=1)[:, :few]
        else:
            top = np.argsort(~scores, axis=1, kind="stable")[:, :few]
        best.take(who, np.take_along_axis(scores, top, 1), block["ids"][columns][top], block["rows"][columns][top])
        kth = best.scores[who, k - 1]
        threshold[who] = np.where(kth == _NONE, threshold[who], np.maximum(threshold[who], kth.astype(float) * (1 - 1e-15)))
    return best


_COPY = ["block", "part", "ids", "rows", "body"]
_FOUND = "query_row bigint, did bigint, row bigint, score bigint"


def _meet(sent: DataFrame, copies: DataFrame, basis: np.ndarray, k: int) -> DataFrame:
    """Best vectors of each block for the queries sent to it, by ``block`` and ``part``, the group of queries."""
    width = len(basis)
    head = max(1, width // 4)

    def run(key, query_rows, block_rows):
        reuse_freed_memory()
        out = {"query_row": [], "did": [], "row": [], "score": []}
        if query_rows.num_rows and block_rows.num_rows:
            table = query_rows.combine_chunks()
            body = block_rows["body"][0].as_py()
            ids = np.frombuffer(block_rows["ids"][0].as_py(), np.int64)
            kind = np.int16 if len(body) == 2 * width * len(ids) else np.int64
            block = {
                "ids": ids,
                "rows": np.frombuffer(block_rows["rows"][0].as_py(), np.int64),
                "v": np.frombuffer(body, kind).reshape(-1, width).astype(np.int64),
            }
            asked = {
                "v": _matrix(table["v"].chunk(0), width),
                "rows": table["row"].to_numpy(),
                "threshold": np.nan_to_num(table["threshold"].to_numpy().astype(float), nan=-np.inf),
            }
            best = search_block(asked, block, basis, k, head)
            i, j = np.nonzero(best.scores != _NONE)
            out = {
                "query_row": asked["rows"][i],
                "did": best.ids[i, j],
                "row": best.rows[i, j],
                "score": best.scores[i, j],
            }
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    return (
        sent.groupBy("block", "part")
        .cogroup(copies.select(*_COPY).toDF(*_COPY).groupBy("block", "part"))
        .applyInArrow(run, _FOUND)
    )


def _band(length: Column) -> Column:
    """Bands of length, eight for each doubling; the length of whole numbers is zero or at least 1."""
    return F.when(length > 0, F.floor(F.log2(length) * _BANDS)).otherwise(_LOWEST).cast("int")


def _sent(queries: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each query with every block (block, longest) whose longest vector may reach its threshold.

    They meet by bands of length. The driver sees the bands only, some 8,000 at most
    whatever the number of blocks, as lengths are doubles.
    """
    banded = blocks.withColumn("band", _band(F.col("longest")))
    bands = banded.agg(F.sort_array(F.collect_set("band"))).first()[0]
    # One band further down makes up for rounding; the exact condition follows.
    needed = _band((F.col("threshold") - 1e-6) / (F.col("length") * (1 + 1e-9))) - 1
    least = (
        F.when(F.col("threshold").isNull() | (F.col("threshold") <= 1e-6), _LOWEST)
        .when(F.col("length") > 0, needed)
        .otherwise(_HIGHEST)
    )
    all_bands = F.array(*[F.lit(b) for b in bands]).cast("array<int>")
    asked = queries.withColumn("least", least).withColumn("band", F.explode(F.filter(all_bands, lambda b: b >= F.col("least"))))
    reach = F.col("longest") * F.col("length") * (1 + 1e-9) + 1e-6 >= F.col("threshold")
    return lookup(asked, banded, ["band"], "inner").where(F.col("threshold").isNull() | reach)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "did", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    rows: DataFrame, is_query, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256
) -> DataFrame:
    """The ``k`` vectors with the largest inner product for each query: ``query_id, rank, vec_id, score``.

    Components are taken as ``floor(scale * x)``. ``is_query`` is a condition on
    ``vec_id``; every row but the query's own is a candidate, equal vectors and
    rows of the same id too. Ties go to the smaller id, null ids are last (a null
    id is no query unless the condition says so). Vectors that are null or hold a
    null or non-finite component take no part; shorter ones are filled up with
    zeros, and empty ones are zero. Scores have to fit a long. A query with fewer
    candidates than ``k`` has fewer rows; an empty table gives none.

    Vectors are dealt into blocks by descending length. Queries first meet the
    block of the longest, which gives each a threshold; a query is sent to another
    block only if its length times that block's longest reaches it. What meets is
    one block with some thousand queries, so nothing grows with the table.
    """
    vectors = write_out(_vectors(rows, id_column, vector_column, scale), "vectors")
    stats = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count(F.when(is_query, 1)).alias("queries")).first()
    if not stats["queries"]:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("bigint").alias("score")).limit(0)
    width = max(1, stats["width"])
    basis = _rotation(vectors, width)
    blocks = write_out(_pack_blocks(vectors, stats["n"], width), "vector-blocks")
    top = blocks.select("block", "longest").orderBy(F.desc("longest"), "block").first()["block"]
    groups = max(1, -(-stats["queries"] // _QUERY_ROWS))
    part = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("part")
    queries = vectors.where(is_query).select("row", "v", "length", part)
    start = queries.withColumn("threshold", F.lit(None).cast("double")).withColumn("block", F.lit(top))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    first = write_out(_meet(start, blocks.where(F.col("block") == top).withColumn("part", everywhere), basis, k), "first-block")
    kth = _ranked(first, k).where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("threshold"))
    rest = blocks.where(F.col("block") != top)
    sent = _sent(queries.join(kth, "row", "left"), rest.select("block", "longest"))
    # Other blocks are copied only to the groups that reach them.
    copies = lookup(sent.select("block", "part").distinct(), rest, ["block"], "inner")
    found = first.unionByName(_meet(sent.select("row", "v", "threshold", "block", "part"), copies, basis, k))
    names = vectors.select("row", "vec_id")
    return (
        _ranked(found, k)
        .join(names.withColumnsRenamed({"row": "query_row", "vec_id": "query_id"}), "query_row")
        .join(names, "row")
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
