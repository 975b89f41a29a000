"""A vector table in cells, kept on disk: searched by reading few cells, refreshed by rewriting the changed ones.

Vectors of length one are dealt to the nearest of at most ``CELLS`` centres, which are fitted on the ``SAMPLE`` vectors of
smallest hash; every vector is stored. A cell knows the largest angle between its centre and its vectors. Angles obey the
triangle inequality, so no vector of a cell is nearer to a query than the centre's angle less the cell's: a search reads the
nearest cells first, then the others that this bound doesn't rule out, and is exact; or it stops after the first and is
approximate. Cells are folders, so that what isn't asked for isn't read. Vectors that are null, hold a null or are of length
zero are stored in cell -1 and take no part in searches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.operators import retrieval
from talkloom.sources.artifacts import checkpointed, exists

#: Centres at most, vectors that they are fitted on at most, rounds of the fit, cells that a search reads first.
CELLS, SAMPLE, FIT, PROBES = 4096, 8192, 4, 4
#: What angles may be off by.
OFF = 1e-6
#: Columns that the index adds to those of its rows.
OWN = ("made", "content", "angle", "cell")
CENTRES = "cell int, centre array<double>, radius double"


def _units(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    places, rows = retrieval._unit(vectors)
    some = np.flatnonzero(np.einsum("ij,ij->i", rows, rows) > 0.5) if len(places) else places
    return places[some], rows[some]


def _fit(rows: DataFrame, vector: str, cells: int | None) -> np.ndarray:
    """The centres: some of the sampled vectors, moved to the middle of those nearest to them."""
    n = rows.count()
    wanted = cells or min(CELLS, max(1, math.isqrt(n)))
    sample = rows.where(F.col(vector).isNotNull()).select(vector).orderBy(F.xxhash64(vector), vector).limit(SAMPLE).collect()
    _, units = _units(pa.array([list(r[0]) for r in sample], pa.list_(pa.float64())))
    if not len(units):
        return np.zeros((0, 1))
    units = np.unique(units, axis=0)
    centres = units[np.unique(np.linspace(0, len(units) - 1, wanted).astype(int))]
    for _ in range(FIT):
        at = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, units)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def _placed(rows: DataFrame, centres: np.ndarray, vector: str) -> DataFrame:
    """Add each row's cell and its angle to the cell's centre."""
    at = rows.columns.index(vector)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, angle = np.full(batch.num_rows, -1, np.int32), np.zeros(batch.num_rows)
            places, units = _units(batch.column(at))
            if len(places):
                near = units @ centres.T
                cell[places] = near.argmax(axis=1)
                angle[places] = np.arccos(np.clip(near.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(angle), pa.array(cell)], names=[*batch.schema.names, "angle", "cell"])

    return rows.mapInArrow(each, T.StructType([*rows.schema.fields, T.StructField("angle", T.DoubleType()), T.StructField("cell", T.IntegerType())]))


def _content(rows: DataFrame) -> DataFrame:
    return rows.withColumn("content", F.md5(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})))


def _write(rows: DataFrame, path: str, kinds: Sequence[str], mode: str) -> None:
    writer = rows.hint("rebalance", *kinds, "cell").write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*kinds, "cell").parquet(path)


def _write_cells(spark: SparkSession, centres: np.ndarray, radii: dict[int, float], path: str) -> None:
    rows = [(i, [float(x) for x in c], float(radii.get(i, 0.0))) for i, c in enumerate(centres)]
    spark.createDataFrame(rows, CENTRES).coalesce(1).write.mode("overwrite").parquet(f"{path}/_cells")


def _cells(spark: SparkSession, path: str) -> tuple[np.ndarray, dict[int, float]]:
    """Centres and radii: a row for each of at most CELLS cells."""
    there = exists(spark, f"{path}/_cells")
    rows = spark.read.schema(CENTRES).parquet(f"{path}/_cells").orderBy("cell").collect() if there else []
    return np.array([r["centre"] for r in rows]) if rows else np.zeros((0, 1)), {r["cell"]: r["radius"] for r in rows}


def load(spark: SparkSession, path: str) -> DataFrame:
    """The index's rows."""
    return spark.read.parquet(path).where("made is not null")


def refresh(
    rows: DataFrame,
    path: str,
    embed: Callable[[DataFrame], DataFrame],
    kinds: Sequence[str] = (),
    id_col: str = "id",
    vector: str = "embedding",
    cells: int | None = None,
) -> dict[str, int]:
    """Bring the index at ``path`` up to the rows (with an id each, without vectors), and tell what was done.

    Where there is none it is built. Else rows of the same content keep their vectors; new and changed ones are embedded
    (``embed`` adds the vector) and placed by the same centres; cells that gain, change or lose a row are rewritten, the others
    aren't touched. Ids come once; rows with a null id are left out; of rows of one id the first by content is taken. Radii
    are widened before vectors are written, so that a search after a crash is exact for what is there, and running
    again mends the rest. An index that a table without a usable vector has left is built anew.
    """
    spark = rows.sparkSession
    first = F.min_by(F.struct(*[c for c in rows.columns if c != id_col], "content"), "content").alias("__row")
    wanted = _content(rows.where(F.col(id_col).isNotNull())).groupBy(id_col).agg(first).select(id_col, "__row.*").select(*rows.columns, "content")
    centres, radii = _cells(spark, path)
    if not len(centres):
        new = checkpointed(embed(wanted).withColumn("made", F.lit(1).cast("long")))
        centres = _fit(new, vector, cells)
        placed = checkpointed(_placed(new, centres, vector))
        _write(placed, path, kinds, "static")
        _write_cells(spark, centres, {r["cell"]: r["r"] for r in placed.groupBy("cell").agg(F.max("angle").alias("r")).collect()}, path)
        return {"kept": 0, "embedded": placed.count(), "gone": 0}
    # Read as it was written: kinds may look like numbers.
    held = spark.read.schema(_stored(spark, path, rows, vector)).parquet(path).where("made is not null")
    wanted = checkpointed(wanted)
    was = checkpointed(held.select(F.col(id_col), F.col("content").alias("__was"), F.col("cell").alias("__cell"), *(F.col(k).alias(f"__{k}") for k in kinds)))
    new = wanted.join(was, id_col, "left").where(~F.col("content").eqNullSafe(F.col("__was"))).select(wanted.columns)
    made = (held.agg(F.max("made")).first()[0] or 0) + 1
    placed = checkpointed(_placed(embed(new).withColumn("made", F.lit(made).cast("long")), centres, vector))
    left = was.join(wanted.select(id_col, F.col("content").alias("__was")), [id_col, "__was"], "left_anti")  # changed or gone
    folders = [*kinds, "cell"]
    touched = left.select(*(F.col(f"__{c}").alias(c) for c in folders)).unionByName(placed.select(*folders)).distinct()
    touched = checkpointed(touched)
    radii_now = {r["cell"]: r["r"] for r in placed.groupBy("cell").agg(F.max("angle").alias("r")).collect()}
    _write_cells(spark, centres, {c: max(radii.get(c, 0.0), radii_now.get(c, 0.0)) for c in {*radii, *radii_now}}, path)
    # Which rows stay is told without texts and vectors, by folder; the rows themselves go by their ids, so that a cell of very
    # many rows is no task's alone.
    null_safe = [F.col(f"__{c}").eqNullSafe(F.col(f"t_{c}")) for c in folders]
    same = was.join(touched.toDF(*(f"t_{c}" for c in folders)), null_safe, "left_semi").join(left.select(id_col), id_col, "left_anti")
    same = same.select(F.col(id_col).alias("__id"), *(f"__{c}" for c in folders))
    stay = held.join(same, [F.col(id_col) == F.col("__id"), *(F.col(c).eqNullSafe(F.col(f"__{c}")) for c in folders)], "left_semi")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in folders else F.col(f.name) for f in placed.schema.fields]
    # A folder that loses all of its rows is overwritten by one row that is none.
    now = checkpointed(stay.select(placed.columns).unionByName(placed).unionByName(touched.select(*empty)))
    if not touched.isEmpty():
        _write(now, path, kinds, "dynamic")
    kept, embedded = wanted.count() - placed.count(), placed.count()
    return {"kept": kept, "embedded": embedded, "gone": left.join(wanted.select(id_col), id_col, "left_anti").count()}


def _stored(spark: SparkSession, path: str, rows: DataFrame, vector: str) -> T.StructType:
    """The schema of the index's files, with the kinds as the rows have them."""
    own = {f.name: f.dataType for f in rows.schema.fields}
    return T.StructType([T.StructField(f.name, own.get(f.name, f.dataType)) for f in spark.read.parquet(path).schema.fields])


def bounds(centres: np.ndarray, radii: dict[int, float], query: Sequence[float]) -> list[tuple[float, int]]:
    """(least angle of a vector in the cell to the query, cell), nearest first."""
    q = np.asarray(query, float)
    q = q / (np.linalg.norm(q) or 1.0)
    angles = np.arccos(np.clip(centres @ q, -1, 1)) if len(centres) else np.zeros(0)
    return sorted((max(0.0, float(a) - radii.get(i, 0.0)), i) for i, a in enumerate(angles))


def search(
    spark: SparkSession,
    path: str,
    query: Sequence[float],
    k: int = 15,
    where: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    probes: int = PROBES,
    exact: bool = True,
    id_col: str = "id",
    vector: str = "embedding",
    digits: int | None = None,
) -> DataFrame:
    """The k rows of least cosine distance among those that ``where`` lets through, ties by id.

    Not ``exact``: of the nearest ``probes`` cells alone.
    """
    rows, (centres, radii) = where(load(spark, path)), _cells(spark, path)
    order = bounds(centres, radii, query)
    near = [c for _, c in order[:probes]]
    best = retrieval.nearest(rows.where(F.col("cell").isin(near)), query, k, vector, id_col, digits)
    if not exact or len(order) <= probes:
        return best
    best = checkpointed(best)
    last = best.agg(F.count("*").alias("n"), F.max("distance").alias("d")).first()
    far = math.pi
    if last["n"] >= k:
        far = math.acos(max(-1.0, min(1.0, 1 - last["d"] - (10.0**-digits if digits is not None else 0.0)))) + OFF
    more = [c for bound, c in order[probes:] if bound <= far]
    if not more:
        return best
    rest = retrieval.nearest(rows.where(F.col("cell").isin(more)), query, k, vector, id_col, digits)
    return best.unionByName(rest).orderBy("distance", id_col).limit(k)
