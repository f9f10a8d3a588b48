"""Where the inputs and the layers live, and how a run reports its steps."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake.sources.landing import NoLandingFiles, landing_glob, read_landing, read_stamped

log = logging.getLogger("marketlake")


@dataclass(frozen=True)
class Lake:
    """Landing folders, layer databases and the report folder.

    ``stamped`` selects the folder layout that Spark itself writes for landing snapshots
    (``run_day=.../run_time=...``, ticker in the file's own column). ``writes_tree`` states that the dated tree of a lake
    that is not ``stamped`` is filled from here and not by a provider.
    """

    reports: str
    ohlcv: str = ""
    company: str = ""
    fx: str = ""
    macro: str = ""
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    tables_root: str | None = None
    stamped: bool = False
    writes_tree: bool = False

    @property
    def databases(self) -> tuple[str, str, str]:
        return self.bronze, self.silver, self.gold

    def landing(
        self, spark: SparkSession, root: str, schema: T.StructType, run_day: dt.date, by_ticker: bool = False
    ) -> DataFrame:
        """Newest snapshot per leaf of ``run_day``; ``NoLandingFiles`` without any."""
        if self.stamped:
            return read_stamped(spark, root, schema, run_day=run_day, required=True)
        return read_landing(spark, root, schema, run_day, by_ticker, required=True)

    def folders(self, root: str, by_ticker: bool = False) -> str:
        """Glob of all leaf folders below ``root``."""
        if self.stamped:
            return f"{root.rstrip('/')}/run_day=*/run_time=*"
        return landing_glob(root, by_ticker=by_ticker).rsplit("/", 1)[0]


@dataclass
class Run:
    """Runs named steps; a failed step is recorded and the next one still runs, but for those that need it.

    A step without landing files is skipped, as are the steps that need it, so stored tables stay as they are.
    """

    fail_fast: bool = False
    steps: dict[str, str] = field(default_factory=dict)

    def step(self, name: str, action: Callable[[], object], needs: Sequence[str] = ()) -> None:
        missing = [n for n in needs if self.steps.get(n) != "ok"]
        if missing:
            self.steps[name] = f"skipped: needs {', '.join(missing)}"
            return
        try:
            action()
            self.steps[name] = "ok"
        except NoLandingFiles as absent:
            log.warning("step %s skipped: %s", name, absent)
            self.steps[name] = f"skipped: {absent}"
        except Exception as error:
            if self.fail_fast:
                raise
            log.exception("step %s failed", name)
            self.steps[name] = f"failed: {error}"

    def together(self, *chains: Callable[[Run], object]) -> None:
        """Chains of steps that need nothing of each other, side by side: each takes a run of its own that knows the
        steps so far. With ``fail_fast`` the first failure is raised once all chains have ended."""
        runs = [Run(self.fail_fast, dict(self.steps)) for _ in chains]
        with ThreadPoolExecutor(len(chains)) as pool:
            ended = [pool.submit(inheritable_thread_target(chain), run) for chain, run in zip(chains, runs)]
        for run in runs:
            self.steps.update(run.steps)
        for chain in ended:
            chain.result()
