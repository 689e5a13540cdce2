"""Published tables of quarterly runs, and the journal that says which count.

A run writes its tables beside those of others, under
``<out>/<table>/as_of=<date>/run=<run>/``, and notes each in the journal
``<out>/journal`` when it is complete.  Nobody reads them yet: a quarter's
tables are those of the run that the journal accepted last.  That one row,
written after all checks of the staged tables, is the commit point.  So a
rejected or interrupted run leaves the accepted quarter as it was, with the
rejected run's tables and checks beside it as evidence.

A run is known by a fingerprint of its configuration and its input files
(names, sizes, times; their rows are not read).  A run that ended without a
verdict is taken up by the next one with the same fingerprint: tables that
the journal has are read, not computed.

The journal has a folder of its own for each row, so rows are there or not,
and runs that write at the same time do not meet.  Two runs of one quarter are
not coordinated beyond that: the verdict written last wins.
"""
from __future__ import annotations

import hashlib
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runoff.config import EclConfig, MobGrid, MobList, Window

JOURNAL = "run string, fingerprint string, config string, event string, table_name string, rows long, at long"
WRITTEN, ACCEPTED, REJECTED = "written", "accepted", "rejected"


# ------------------------------------------------------------------ fingerprint
def config_text(cfg: EclConfig) -> str:
    return json.dumps(asdict(cfg), default=str, sort_keys=True)


def config_from_text(text: str) -> EclConfig:
    raw = json.loads(text)
    for name in ("as_of", "start"):
        raw[name] = date.fromisoformat(raw[name])
    for name in ("extract_grid", "triangle_grid"):
        raw[name] = MobList(tuple(raw[name]["mobs"])) if "mobs" in raw[name] else MobGrid(**raw[name])
    raw["windows"] = tuple(Window(**w) for w in raw["windows"])
    return EclConfig(**{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})


def input_state(spark: SparkSession, *sources: DataFrame) -> str | None:
    """A digest of the input files' names, sizes and times; None if a source
    has no files (a warehouse), so that its state cannot be seen."""
    files = [df.inputFiles() for df in sources]
    if not all(files):
        return None
    paths = sorted({unquote(p) for found in files for p in found})
    # without its content column this source only lists files
    listed = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    seen = listed.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
    return f"{seen['n']}:{seen['h']}"


def fingerprint(cfg: EclConfig, state: str | None) -> str:
    """The same for runs that must give the same tables; an unknown input is like no other."""
    state = uuid.uuid4().hex if state is None else state
    return hashlib.sha256(f"{config_text(cfg)}\n{state}".encode()).hexdigest()


# ------------------------------------------------------------------ one table
def write_table(df: DataFrame, path: str) -> int:
    """Writes a run's rows to its own folder and returns how many they
    were.  Written again after an interruption, they replace what was left."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S3: a run's rows, by their known schema; nothing beside its folder is listed."""
    return spark.read.schema(schema).parquet(path)


# ------------------------------------------------------------------ journal
@dataclass(frozen=True)
class Run:
    """A run as the journal has it; ``tables`` are the complete ones and their rows."""

    name: str
    fingerprint: str
    config: str
    tables: dict[str, int]
    verdict: str | None


class Store:
    def __init__(self, spark: SparkSession, out: str, cfg_or_as_of: EclConfig | date):
        self.spark, self.out = spark, out.rstrip("/")
        as_of = cfg_or_as_of.as_of if isinstance(cfg_or_as_of, EclConfig) else cfg_or_as_of
        self.as_of = as_of.isoformat()

    def path(self, table: str, run: str) -> str:
        return f"{self.out}/{table}/as_of={self.as_of}/run={run}"

    def journal(self) -> DataFrame:
        """This quarter's rows of the journal."""
        schema = T.StructType.fromDDL(JOURNAL)
        try:
            return (self.spark.read.schema(schema).option("recursiveFileLookup", True)
                    .parquet(f"{self.out}/journal/as_of={self.as_of}"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def runs(self) -> list[Run]:
        """This quarter's runs, the one with the latest entry last (a few rows each)."""
        found: dict[str, list] = {}
        rows = sorted(self.journal().collect(), key=lambda r: r["at"])
        for r in rows:
            found.setdefault(r["run"], []).append(r)
        ordered = sorted(found.values(), key=lambda own: own[-1]["at"])
        return [Run(own[0]["run"], own[0]["fingerprint"], own[0]["config"],
                    {r["table_name"]: r["rows"] for r in own if r["event"] == WRITTEN},
                    next((r["event"] for r in own[::-1] if r["event"] != WRITTEN), None)) for own in ordered]

    def accepted(self) -> Run:
        """The run whose tables are the quarter's."""
        found = [r for r in self.runs() if r.verdict == ACCEPTED]
        if not found:
            raise LookupError(f"no accepted run of {self.as_of} under {self.out}")
        return found[-1]

    def take_up(self, cfg: EclConfig, state: str | None) -> Run:
        """The unfinished run with this configuration and input, or a new one."""
        own = fingerprint(cfg, state)
        for run in self.runs()[::-1]:
            if run.fingerprint == own and run.verdict is None:
                return run
        return Run(uuid.uuid4().hex, own, config_text(cfg), {}, None)

    def note(self, run: Run, event: str, table: str | None = None, rows: int | None = None) -> None:
        row = (run.name, run.fingerprint, run.config, event, table, rows, time.time_ns())
        (self.spark.createDataFrame([row], JOURNAL).coalesce(1)
         .write.parquet(f"{self.out}/journal/as_of={self.as_of}/{uuid.uuid4().hex}"))

    def read(self, table: str, schema: T.StructType, run: Run) -> DataFrame:
        return read_table(self.spark, self.path(table, run.name), schema)

    def stage(self, run: Run, tables: dict[str, DataFrame], threads: int = 4) -> dict[str, int]:
        """Writes the tables that the run does not have yet, some at a time
        (each is a small job of its own), and notes each when it is complete.
        Returns the rows written of all of them."""
        def write(name: str) -> int:
            n = write_table(tables[name], self.path(name, run.name))
            self.note(run, WRITTEN, name, n)
            return n

        with ThreadPoolExecutor(threads) as pool:
            jobs = {name: pool.submit(write, name) for name in tables if name not in run.tables}
            return {name: jobs[name].result() if name in jobs else run.tables[name] for name in tables}
