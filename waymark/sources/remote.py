"""Remote sources as a Python data source: planned jobs are partitions, pages are read until a short one, failures are rows."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Rows a page, and sitelink bands of the class and attention extracts.
PAGE = 5000
CLASS_BANDS = ((0, 4), (4, 15), (15, None))
ATTENTION_BANDS = ((15, 25), (25, 40), (40, 70), (70, 120), (120, None))
NODE_KINDS = ("airport", "station", "port")


class Throttled(Exception):
    """The source asks to wait; ``after`` in seconds, if it says how long."""

    def __init__(self, after: float | None = None):
        super().__init__(after)
        self.after = after


@dataclass(frozen=True)
class Job:
    country: str
    family: str
    parameters: tuple = ()
    slices: tuple = ()

    @property
    def name(self) -> str:
        return "/".join([self.country, self.family, *[f"{k}={v}" for k, v in self.parameters]])


def plan_jobs(countries: Sequence[str], classes: Sequence[str], splits: dict | None = None) -> list[Job]:
    """Jobs of every country: each class by sitelink band, all populated places, attention by band, institutions, nodes by kind.

    ``splits`` maps (country, family, band) to finer bands that are read into one job, for bands too large for the source.
    """
    splits = splits or {}
    out: list[Job] = []
    band = lambda b: (("low", b[0]), ("high", b[1]))
    for c in countries:
        out += [Job(c, "class", (("class", k), *band(b)), tuple(splits.get((c, "class", b), ()))) for k in classes for b in CLASS_BANDS]
        out.append(Job(c, "popall"))
        out += [Job(c, "attention", band(b), tuple(splits.get((c, "attention", b), ()))) for b in ATTENTION_BANDS]
        out.append(Job(c, "institutional"))
        out += [Job(c, "node", (("kind", k),)) for k in NODE_KINDS]
    return out


def call(fetch: Callable, *args, retries: int = 4, pause: Callable[[float], None] = time.sleep):
    """``fetch(*args)``, tried again when throttled: after the time the source names, else after 1, 2, 4 … seconds."""
    for turn in range(retries + 1):
        try:
            return fetch(*args)
        except Throttled as e:
            if turn == retries:
                raise
            pause(e.after if e.after is not None else float(2**turn))


def read_job(job: Job, fetch: Callable, page: int = PAGE, retries: int = 4, pause: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """Rows of a job: each slice by offset until a short page; of rows with one ``qid`` the first counts."""
    seen: set = set()
    for part in job.slices or (None,):
        offset = 0
        while True:
            rows = call(fetch, job, part, offset, page, retries=retries, pause=pause)
            for r in rows:
                if r.get("qid") is None or r["qid"] not in seen:
                    seen.add(r.get("qid"))
                    yield r
            if len(rows) < page:
                break
            offset += page


@dataclass
class JobPartition(InputPartition):
    job: Job = field(default=None)

    def __init__(self, job: Job):
        super().__init__(job.name)
        self.job = job


def remote_source(name: str, jobs: Sequence[Job], fetch: Callable, page: int = PAGE, retries: int = 4) -> type[DataSource]:
    """A data source of ``(job, row, error)``: rows as JSON text, and one row with the error for a job that fails.

    ``fetch(job, slice, offset, page)`` returns a list of dicts and is called on the executors, one partition a job; a failing
    job does not end the read, so what came in can be kept and the rest read again.
    """

    class Reader(DataSourceReader):
        def partitions(self):
            return [JobPartition(j) for j in jobs]

        def read(self, partition):
            job, rows = partition.job, []
            try:
                rows = [json.dumps(r, ensure_ascii=False, sort_keys=True) for r in read_job(job, fetch, page, retries)]
            except Exception as e:
                yield (job.name, None, f"{type(e).__name__}: {e}")
                return
            for r in rows:
                yield (job.name, r, None)
            yield (job.name, None, None)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "job string, row string, error string"

        def reader(self, schema):
            return Reader()

    return Source


def read_remote(spark: SparkSession, name: str, jobs: Sequence[Job], fetch: Callable, done: DataFrame | None = None, **options) -> DataFrame:
    """The rows of all jobs that ``done`` (job) does not list. A row with neither row nor error marks a job as complete."""
    if done is not None:
        have = {r["job"] for r in done.select("job").distinct().collect()}
        jobs = [j for j in jobs if j.name not in have]
    spark.dataSource.register(remote_source(name, jobs, fetch, **options))
    return spark.read.format(name).load()


def completed(rows: DataFrame) -> DataFrame:
    return rows.where("row is null and error is null").select("job")


def preflight(expected: DataFrame, found: DataFrame) -> DataFrame:
    """``(id, expected, label)`` where a country's id does not carry the expected label."""
    j = expected.join(found, "id", "left")
    return j.where(~F.col("expected").eqNullSafe(F.col("label"))).select("id", "expected", "label")


def fetch_in_batches(ids: DataFrame, key: str, fetch: Callable, schema: str, batch: int = 50, retries: int = 3) -> DataFrame:
    """Rows of ``fetch(list of ids)`` for all ids, ``batch`` a call; ``schema`` must have an ``error`` column for batches that fail."""
    import pandas as pd

    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            wanted = frame[key].tolist()
            for i in range(0, len(wanted), batch):
                part = wanted[i : i + batch]
                try:
                    rows = call(fetch, part, retries=retries)
                except Exception as e:
                    rows = [{key: q, "error": f"{type(e).__name__}: {e}"} for q in part]
                yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names)

    return ids.select(key).where(F.col(key).isNotNull()).distinct().mapInPandas(run, schema)
