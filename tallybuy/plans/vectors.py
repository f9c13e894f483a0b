"""Embedding tables as features, feature dictionaries, rotation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybuy.operators.keys import dense_ids
from tallybuy.operators.scaling import plane_angles, rotate_vectors
from tallybuy.plans.catalogue import query
from tallybuy.plans.sql import over
from tallybuy.session import workspace
from tallybuy.sources import vectors
from tallybuy.sources.files import rounded_matrix, suffix_columns
from tallybuy.sources.tables import downcast_doubles

_WIDTH = 64


def _spread_sql(vector: str, prefix: str, suffix: str = "", width: int = _WIDTH, as_double: bool = True) -> str:
    cell = "CAST({v}[{i}] AS DOUBLE)" if as_double else "{v}[{i}]"
    return ", ".join(
        f'round({cell.format(v=vector, i=i + 1)}, 4) AS "{prefix}{i}{suffix}"' for i in range(width)
    )


def _bundle(fx, entity: str):
    return fx.table("embeddings").select(
        F.lit(entity).alias("entity"), F.col("vec_id").alias("id"), "embedding"
    )


@query("embedding_columns", f"SELECT vec_id AS seller_id, {_spread_sql('embedding', 'DHNE')} FROM embeddings")
def _embedding_columns(fx):
    wide = vectors.entity_columns(_bundle(fx, "seller_id"), "seller_id", _WIDTH)
    return rounded_matrix(wide, ["seller_id"])


@query(
    "embedding_lines",
    "SELECT vec_id AS id, "
    + ", ".join(f"embedding[{i + 1}] AS v{i}" for i in range(_WIDTH))
    + " FROM embeddings",
)
def _embedding_lines(fx):
    # As floats again: the shortest text of a float gives back the same float.
    path = f"{workspace(fx.spark)}/vector-lines-{uuid.uuid4().hex}.txt"
    fx.vector_lines().write.text(path)
    parsed = vectors.read_vector_text(fx.spark, path)
    return downcast_doubles(vectors.spread_vector(parsed, "id", "vector", _WIDTH, "v"))


@query(
    "attribute_embedding",
    over(
        "profile",
        body=f"""SELECT user_id, age_range, gender,
            {_spread_sql('u.embedding', 'DHNE_id', width=_WIDTH)},
            {_spread_sql('a.embedding', 'DHNE_age', width=_WIDTH)},
            {_spread_sql('g.embedding', 'DHNE_gender', width=_WIDTH)}
            FROM profile p LEFT JOIN embeddings u ON u.vec_id = user_id
            LEFT JOIN embeddings a ON a.vec_id = age_range AND a.vec_id < 9
            LEFT JOIN embeddings g ON g.vec_id = gender AND g.vec_id < 3""",
    ),
)
def _attribute_embedding(fx):
    table = fx.table("embeddings")
    parts = [("user_id", F.lit(True)), ("age_range", F.col("vec_id") < 9), ("gender", F.col("vec_id") < 3)]
    bundle = None
    for entity, rows in parts:
        part = table.where(rows).select(
            F.lit(entity).alias("entity"), F.col("vec_id").alias("id"), "embedding"
        )
        bundle = part if bundle is None else bundle.unionByName(part)
    joined = vectors.attribute_columns(fx.user_info(), bundle, _WIDTH)
    return rounded_matrix(joined, ["user_id", "age_range", "gender"])


@query("dictionary_columns", f"SELECT vec_id AS seller_id, {_spread_sql('embedding', '', '_dic')} FROM embeddings")
def _dictionary_columns(fx):
    wide = vectors.dictionary_columns(fx.seller_vectors(), "seller_id", _WIDTH)
    return rounded_matrix(wide, ["seller_id"])


@query(
    "resolved_vectors",
    over(
        "acts",
        ids="""SELECT brand_id, row_number() OVER (ORDER BY brand_id) - 1 AS dense_id
               FROM (SELECT DISTINCT brand_id FROM acts)""",
        body=f"""SELECT CAST(brand_id AS BIGINT) AS brand_id, {_spread_sql('embedding', 'v')}
                 FROM ids JOIN embeddings ON dense_id = vec_id""",
    ),
)
def _resolved_vectors(fx):
    mapping = dense_ids(fx.log(), "brand_id")
    table = fx.table("embeddings").select(
        F.col("vec_id").alias("dense_id"), F.col("embedding").alias("vector")
    )
    wide = vectors.spread_vector(
        vectors.resolve_vectors(mapping, table, "brand_id"), "brand_id", "vector", _WIDTH, "v"
    )
    return rounded_matrix(wide, ["brand_id"])


@query(
    "suffixed_columns",
    over(
        "acts",
        body="""SELECT seller_id, count(*) AS n_seller_stats, count(DISTINCT user_id) AS users_seller_stats
                FROM acts GROUP BY seller_id""",
    ),
)
def _suffixed_columns(fx):
    met = fx.log().groupBy("seller_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    stats = met.groupBy("seller_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("users"))
    return suffix_columns(stats, ["seller_id"], "_seller_stats")


_ANGLES = plane_angles(_WIDTH, seed=0)


def _rotation_sql() -> str:
    """The rounds of plane rotations on single columns, position by position."""
    cells = [f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(_WIDTH)]
    ctes = ["r0 AS (SELECT vec_id AS seller_id, " + ", ".join(f"{c} AS c{i}" for i, c in enumerate(cells)) + " FROM embeddings)"]
    for k, planes in enumerate(_ANGLES):
        half, turned = len(planes), []
        for i in range(_WIDTH):
            if i < half:
                turned.append(f"c{i} * cos({planes[i]!r}) - c{i + half} * sin({planes[i]!r})")
            elif i < 2 * half:
                turned.append(f"c{i - half} * sin({planes[i - half]!r}) + c{i} * cos({planes[i - half]!r})")
            else:
                turned.append(f"c{i}")
        moved = turned[1:] + turned[:1]
        ctes.append(f"r{k + 1} AS (SELECT seller_id, " + ", ".join(f"{c} AS c{i}" for i, c in enumerate(moved)) + f" FROM r{k})")
    last = ", ".join(f"round(c{i}, 6) AS c{i}" for i in range(_WIDTH))
    norm = " + ".join(f"c{i} * c{i}" for i in range(_WIDTH))
    return f"WITH {', '.join(ctes)} SELECT seller_id, {last}, round(sqrt({norm}), 4) AS norm FROM r{len(_ANGLES)}"


@query("rotated_embeddings", _rotation_sql())
def _rotated_embeddings(fx):
    rotated = rotate_vectors(fx.seller_vectors(), "vector", _ANGLES)
    # The norm of the input: rotations keep it.
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    norms = fx.seller_vectors().select("seller_id", F.round(norm, 4).alias("norm"))
    cells = [F.round(F.get("vector", F.lit(i)), 6).alias(f"c{i}") for i in range(_WIDTH)]
    return rotated.select("seller_id", *cells).join(norms, "seller_id")
