"""Clustering around integer centroids, in DataFrame functions only.

Vectors become integer arrays. The centroids, k arrays of bounded length, stand in the plan as literals: ``zip_with`` and
``aggregate`` give a vector's squared distance to each, ``array_min`` of (distance, number) structs chooses one, and one sum
a component, by cluster, gives the next centroids. Sums combine before the shuffle, so a round moves k rows a task and
brings k rows to the driver, whatever the size of the table or of a cluster.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.llm.common import id_text, materialise

SIZE, SCALE, K, ROUNDS, SEED = 64, 256, 40, 5, 2
#: Components are held within these bounds, so that a squared distance of 64 of them fits a long.
BOUND = 1 << 27


def quantised(df: DataFrame, size: int = SIZE, scale: int = SCALE, vec: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec, x): floor(scale * component) as longs of the vectors with exactly ``size`` components, none null or non-finite.

    Components beyond 2^27 either way count as 2^27: no exact distance to them fits a long.
    """
    e = F.col(embedding)
    sound = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    whole = lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(BOUND))), F.lit(float(-BOUND)))).cast("long")
    return df.where(F.coalesce((F.size(e) == size) & sound, F.lit(False))).select(F.col(vec).alias("vec"), F.transform(e, whole).alias("x"))


def seeds(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``seed:id``, in that order; equal hashes go by components. Fewer if there are fewer."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), id_text("vec")).cast("binary"), 256)
    return [list(r["x"]) for r in vectors.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()]


def nearest(x: Column, centroids: list[list[int]]) -> Column:
    """struct(distance long, cluster int) of the nearest centroid, the smaller number among equals."""
    array = lambda c: F.split(F.lit(",".join(map(str, c))), ",").cast("array<bigint>")  # noqa: E731  folded into one literal
    literal = F.array(*[F.struct(array(c).alias("at"), F.lit(k).alias("k")) for k, c in enumerate(centroids)])
    far = lambda at: F.aggregate(F.zip_with(x, at, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, d: s + d)
    return F.array_min(F.transform(literal, lambda c: F.struct(far(c["at"]).alias("distance"), c["k"].alias("cluster"))))


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: floors of the exact means, componentwise; a cluster without vectors keeps its own."""
    size = len(centroids[0])
    own = vectors.select(nearest(F.col("x"), centroids)["cluster"].alias("cluster"), *[F.col("x")[k].alias(f"x{k}") for k in range(size)])
    sums = own.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"x{k}").alias(f"x{k}") for k in range(size)])
    out = list(centroids)
    for r in sums.collect():  # k rows at most
        out[r["cluster"]] = [r[f"x{k}"] // r["n"] for k in range(size)]
    return out


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """Centroids of (vec, x) after ``rounds`` rounds; [] for an empty table. A round that moves nothing ends it early."""
    centroids = seeds(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, moved(vectors, centroids)
        if before == centroids:
            break
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec, cluster, distance) by the nearest centroid; no row without a centroid."""
    if not centroids:
        return vectors.select("vec", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")).where(F.lit(False))
    return vectors.select("vec", nearest(F.col("x"), centroids).alias("near")).select("vec", "near.cluster", "near.distance")


def cluster(df: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, size: int = SIZE, scale: int = SCALE) -> tuple[list[list[int]], DataFrame]:
    """(centroids, (vec, cluster, distance, cluster_inertia, inertia)). Inertias beyond a long are the largest long.

    The integer vectors are written once and read by every round; so are the assignments, narrow rows, since their sums
    stand beside each of them.
    """
    vectors = materialise(quantised(df, size, scale), "cluster-vectors")
    centroids = fit(vectors, k, rounds, seed)
    found = materialise(assign(vectors, centroids), "cluster-assigned")
    most = (1 << 63) - 1
    own = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    sums = F.array(*[F.lit(min(own.get(c, 0), most)).cast("long") for c in range(len(centroids))]) if centroids else F.array(F.lit(0).cast("long"))
    return centroids, found.withColumns({"cluster_inertia": F.element_at(sums, F.col("cluster") + 1), "inertia": F.lit(min(sum(own.values()), most)).cast("long")})


def op11(df: DataFrame) -> DataFrame:
    """One row per kept vector, with its cluster's figures and the digest of its final centroid.

    Null vectors and those with another number of components, nulls or non-finite components are left out; repeated rows
    count each; ties of distance go to the smaller number; a null id counts as the empty text in the hash; with fewer than
    40 vectors there are fewer centroids; an empty table gives an empty one; extra columns are not read.
    """
    centroids, out = cluster(df)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids] or [""]
    return out.select(F.col("vec").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1).alias("centroid_sha256"))


def _sql() -> str:
    near = "(SELECT r, k, d FROM (SELECT v.r, c.k, CAST(list_sum(list_transform(range(1, 65), lambda j: (v.x[j] - c.x[j]) * (v.x[j] - c.x[j]))) AS BIGINT) AS d, row_number() OVER (PARTITION BY v.r ORDER BY d, c.k) AS o FROM v, c{0} c) WHERE o = 1)"
    parts = [
        f"""WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {SIZE}),
h AS (SELECT x, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS k FROM v), c0 AS (SELECT k, x FROM h WHERE k < {K})"""
    ]
    for n in range(ROUNDS):
        parts.append(f"a{n} AS {near.format(n)}")
        parts.append(f"u{n} AS (SELECT k, j, CAST((sum(x[j]) - ((sum(x[j]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM (SELECT a.k, v.x, unnest(range(1, 65)) AS j FROM a{n} a JOIN v USING (r)) GROUP BY k, j)")
        parts.append(f"c{n + 1} AS (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (SELECT k, list(m ORDER BY j) AS x FROM u{n} GROUP BY k) m USING (k))")
    parts.append(f"f AS {near.format(ROUNDS)}")
    return ",\n".join(parts) + f"""
SELECT v.vec_id, CAST(f.k AS INTEGER) AS cluster, f.d AS distance, CAST(sum(f.d) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.x, lambda e: CAST(e AS VARCHAR)), ',')) AS centroid_sha256 FROM f JOIN v USING (r) JOIN c{ROUNDS} c ON f.k = c.k"""


SQL = _sql()
