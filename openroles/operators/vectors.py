"""Embedding and exact cosine top-k.

Every profile has to meet every vector once; what must not happen is that the
pairs become rows. Profiles are matrices: one small enough to send to the tasks
(its size is checked), or blocks in the shared folder. Each Arrow batch of
vectors is one matrix product per block, for those rows that an exact bound
leaves, and only the best ``k`` per profile leave the task. Vectors are never
shuffled.
"""

from __future__ import annotations

from functools import partial, reduce
from hashlib import md5
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from openroles import fixed_values as fixed
from openroles.session import rows_up_to, scratch_path

HIT_SCHEMA = "resume_id bigint, job_id bigint, similarity double"
BLOCK_ROWS = 2048
#: Blocks a task holds at once; more of them take another scan. Directions that profiles are sorted by.
SCAN_BLOCKS, REFERENCES = 64, 16


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of an Arrow list column as one array, without a Python object per row."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        len(column), -1)


def _lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix * matrix).sum(axis=1))


def _sound(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a direction, and those rows with length 1."""
    norms = _lengths(vectors)
    sound = (norms > 0) & np.isfinite(norms)
    return sound, vectors[sound] / norms[sound][:, None]


class _Block:
    """Profiles of one matrix and the best ``k`` jobs of each so far.

    The entries are flat, at most ``k`` a profile; ``floor`` is what a similarity
    must reach to be among them. ``center`` is the direction of the profiles'
    mean and ``radius`` the largest angle between it and one of them: a vector at
    an angle ``a`` to the center is at least ``a - radius`` away from every
    profile, so one that even then stays below all floors is left out.
    """

    def __init__(self, ids: np.ndarray, unit: np.ndarray, k: int, threshold: float, digits: int) -> None:
        self.ids, self.unit, self.k, self.threshold, self.digits = ids, unit, k, threshold, digits
        self.profile = np.zeros(0, np.int64)
        self.job = np.zeros(0, np.int64)
        self.sim = np.zeros(0)
        self.floor = np.full(len(ids), -np.inf)
        mean = unit.sum(0)
        length = float(_lengths(mean[None])[0])
        self.center = mean / length if length > 1e-9 else None
        if self.center is not None:
            self.radius = float(np.arccos(np.clip(unit @ self.center, -1, 1)).max())

    def reachable(self, vectors: np.ndarray) -> np.ndarray:
        """Rows that can enter a profile's best, by the bound alone."""
        if self.center is None:
            return np.arange(len(vectors))
        away = np.arccos(np.clip(vectors @ self.center, -1, 1)) - self.radius
        needed = max(self.threshold, float(self.floor.min()))
        return np.flatnonzero(np.cos(np.maximum(away, 0)) >= needed - 1e-6 - 10.0 ** -self.digits)

    def add(self, jobs: np.ndarray, vectors: np.ndarray) -> None:
        some = self.reachable(vectors)
        if not len(some):
            return
        sims, jobs, k = vectors[some] @ self.unit.T, jobs[some], self.k
        if len(sims) > k:
            self.floor = np.maximum(self.floor, np.partition(sims, len(sims) - k, axis=0)[len(sims) - k])
        rows, columns = np.nonzero((sims >= self.floor - 10.0 ** -self.digits) & (sims > self.threshold))
        profile = np.concatenate([self.profile, columns])
        job = np.concatenate([self.job, jobs[rows]])
        sim = np.concatenate([self.sim, np.round(sims[rows, columns], self.digits)])
        order = np.lexsort((job, -sim, profile))
        profile, job, sim = profile[order], job[order], sim[order]
        place = np.arange(len(profile)) - np.searchsorted(profile, profile)
        kept, last = place < k, place == k - 1
        self.floor[profile[last]] = np.maximum(self.floor[profile[last]], sim[last])
        self.profile, self.job, self.sim = profile[kept], job[kept], sim[kept]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[self.profile]), pa.array(self.job.astype(np.int64)), pa.array(self.sim)],
            names=["resume_id", "job_id", "similarity"])


def _read_block(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of one file of profiles, by whatever file system its URI names."""
    from pyarrow import fs, parquet

    system, where = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if "://" in path or ":/" in path else f"file://{path}")
    rows = parquet.read_table(where, filesystem=system)
    return rows.column("resume_id").to_numpy().astype(np.int64), _matrix(rows.column("embedding").combine_chunks())


def _scan(load: Callable[[], list[tuple[np.ndarray, np.ndarray]]], k: int, threshold: float, digits: int) -> Callable:
    """mapInArrow function: best ``k`` per profile over all batches of a task, block by block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if blocks is None:
                blocks = [_Block(ids, unit, k, threshold, digits) for ids, unit in load()]
            sound, unit = _sound(_matrix(batch.column("embedding")))
            jobs = batch.column("job_id").to_numpy(zero_copy_only=False)[sound]
            if len(unit):
                for block in blocks:
                    block.add(jobs, unit)
        for block in blocks or ():
            if len(block.profile):
                yield block.batch()

    return scan


def _one_matrix(queries: DataFrame) -> Callable[[], list] | None:
    """A loader of profiles that travel with the job; ``None`` if none has a direction."""
    rows = queries.toArrow()
    if rows.num_rows == 0:
        return None
    sound, unit = _sound(_matrix(rows.column("embedding").combine_chunks()))
    ids = rows.column("resume_id").to_numpy().astype(np.int64)[sound]
    return (lambda: [(ids, unit)]) if len(ids) else None


def _stored_matrices(queries: DataFrame, blocks: int) -> list[str]:
    """Files of unit profiles in the shared folder, some ``BLOCK_ROWS`` in each, near directions together.

    Profiles are dealt by the nearest of a few reference directions, so that the
    angles within a file are small and its bound tells more. References are
    random but fixed: only the speed depends on them.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            sound, unit = _sound(_matrix(batch.column("embedding")))
            if not len(unit):
                continue
            references = np.random.default_rng(0).standard_normal((REFERENCES, unit.shape[1]))
            near = (unit @ references.T).argmax(1).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(unit) + 1, dtype=np.int32) * unit.shape[1]),
                                             pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("resume_id").filter(pa.array(sound)).cast(pa.int64()), lists, pa.array(near)],
                ["resume_id", "embedding", "near"])

    path = scratch_path(queries.sparkSession, "profiles")
    unit = queries.mapInArrow(place, "resume_id bigint, embedding array<double>, near int")
    # Range parts are of about equal size, whatever direction most profiles have.
    unit.repartitionByRange(blocks, "near", "resume_id").drop("near").write.parquet(path)
    return sorted(queries.sparkSession.read.parquet(path).inputFiles())


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int = fixed.MATCH_LIMIT,
                threshold: float = fixed.MATCH_THRESHOLD, digits: int = 9,
                block_rows: int = BLOCK_ROWS, profiles: int | None = None) -> DataFrame:
    """Best ``k`` jobs per profile with a similarity above the threshold, ranked.

    ``queries(resume_id, embedding)``, ``vectors(job_id, embedding)``. Vectors
    without a finite length above 0 have no direction and are left out. Equal similarities (to
    ``digits`` decimals) rank by job id. ``profiles`` is their number if known.

    Up to ``block_rows`` profiles travel with the job. More are written to the
    shared folder in blocks that tasks read themselves and go through for each
    batch of vectors, so vectors are read once for ``SCAN_BLOCKS`` blocks.
    """
    queries = queries.select("resume_id", "embedding").filter("embedding is not null")
    vectors = vectors.select("job_id", "embedding").filter("embedding is not null")
    if profiles is None:
        profiles = rows_up_to(queries, block_rows)
    if profiles is not None and profiles <= block_rows:
        loads = [_one_matrix(queries)]
    else:
        files = _stored_matrices(queries, -(-queries.count() // block_rows))
        loads = [partial(lambda some: [_read_block(f) for f in some], files[i:i + SCAN_BLOCKS])
                 for i in range(0, len(files), SCAN_BLOCKS)]
    scans = [vectors.mapInArrow(_scan(load, k, threshold, digits), HIT_SCHEMA) for load in loads if load]
    if not scans:
        return queries.sparkSession.createDataFrame([], HIT_SCHEMA + ", rank int")
    hits = reduce(DataFrame.unionByName, scans)
    order = Window.partitionBy("resume_id").orderBy(F.desc("similarity"), "job_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class MatchJobs:
    """Table function: the jobs of a table nearest to one vector.

    ``match_jobs(TABLE(vectors), query, threshold, count)`` reads ``job_id`` and
    ``embedding`` of the table where its rows are and gives the best ``count`` of
    each task with a similarity above the threshold; the statement around it
    orders and limits them. A null query, threshold or count gives no row.
    """

    def __init__(self) -> None:
        self.block = None

    def eval(self, rows: pa.RecordBatch, query: pa.Array, threshold: pa.Array, count: pa.Array) -> Iterator[pa.Table]:
        given = [x[0].as_py() for x in (query, threshold, count)] if rows.num_rows else [None]
        if None not in given:
            if self.block is None:
                _, unit = _sound(np.array([given[0]], np.float64))
                self.block = _Block(np.zeros(len(unit), np.int64), unit, given[2], given[1], 9)
            known = rows.filter(rows.column("embedding").is_valid())
            if len(self.block.ids) and known.num_rows and given[2] > 0:
                sound, unit = _sound(_matrix(known.column("embedding")))
                self.block.add(known.column("job_id").to_numpy(zero_copy_only=False)[sound], unit)
        return iter(())

    def terminate(self) -> Iterator[pa.Table]:
        if self.block is not None:
            yield pa.Table.from_batches([self.block.batch()]).select(["job_id", "similarity"])


def register_functions(spark: SparkSession) -> None:
    """Makes ``match_jobs`` known to the session's SQL."""
    spark.udtf.register("match_jobs", F.arrow_udtf(MatchJobs, returnType="job_id bigint, similarity double"))


def hashed_vectors(texts: list[str], dimension: int) -> list[np.ndarray]:
    """Unit vectors of signed hashed words: a stand-in encoder that needs no model.

    Words are runs without white space, lower-cased (A-Z). The first 32 bits of a
    word's MD5 give its place (remainder) and sign (leading bit set: plus).
    """
    words = [t.encode().lower().split() for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    at, distinct = pd.factorize(np.array([w for ws in words for w in ws], object))
    codes = np.array([int.from_bytes(md5(w).digest()[:4]) for w in distinct], np.int64)[at]
    vectors = np.zeros((len(texts), dimension))
    np.add.at(vectors, (rows, codes % dimension), np.where(codes >> 31, 1.0, -1.0))
    norms = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return list((vectors / np.where(norms > 0, norms, 1)).astype(np.float32))


def hashing_encoder(dimension: int = 384) -> Callable[[], Callable]:
    """Default encoder factory. A model is used by passing a factory of its own."""
    return lambda: lambda texts: hashed_vectors(texts, dimension)


def embedder(load: Callable[[], Callable] | None = None,
             batch_size: int = 32) -> Callable[[Column], Column]:
    """Column function text -> vector. ``load`` runs once per Python worker."""
    load = load or hashing_encoder()

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            texts = batch.fillna("").tolist()
            vectors: list = []
            for start in range(0, len(texts), batch_size):
                vectors.extend(model(texts[start:start + batch_size]))
            yield pd.Series(vectors)

    return encode
