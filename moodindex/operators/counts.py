"""Row counts as a by-product of the plan that writes.

A stage of a plan is marked with :meth:`Counts.stage`; when the plan runs, its tasks count the rows that
pass, and the counts come back with the job.  Nothing is read a second time.  A filter isn't
pushed below a marked stage, since it would change the count.

Counts are added up as tasks end.  A task of the last stage of a job counts once, however
often it is tried; a task *before* a shuffle that runs again because an executor was lost with its output can
count twice.  Mark stages of a plan that writes what it scans; where a shuffle lies between, counts are
a report, and :func:`checked` says whether they fit the table that was written.

Defined results: an empty input counts 0; a plan that was not run yet has no counts (an error, not a wait).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counts:
    """Counts of one run of one plan."""

    def __init__(self) -> None:
        self._stages: dict[str, tuple[Observation, list[str]]] = {}
        self._ran = False

    def stage(self, df: DataFrame, name: str, **parts: Column) -> DataFrame:
        """Count the rows of ``df`` as ``name``, and those that meet a condition as the part's name."""
        names = [name, *parts]
        taken = {n for _, held in self._stages.values() for n in held}
        if self._ran or taken & set(names):
            raise ValueError(f"{names}: a name is counted once, before the plan runs")
        seen = Observation()
        self._stages[name] = seen, names
        return df.observe(seen, F.count(F.lit(1)).alias(name),
                          *[F.count(F.when(c, 1)).alias(n) for n, c in parts.items()])

    def ran(self) -> None:
        """To be called after the action that ran the plan."""
        self._ran = True

    def get(self) -> dict[str, int]:
        if not self._ran:
            raise ValueError("the plan was not run yet")
        out = {}
        for seen, names in self._stages.values():
            got = seen.get  # a stage that was optimised away because its input is empty has no values
            out.update({n: int(got.get(n) or 0) for n in names})
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """``stage, n``: one row a count."""
        return spark.createDataFrame(list(self.get().items()), "stage string, n long")


def checked(counts: Counts, name: str, written: DataFrame) -> bool:
    """Whether the count of ``name`` is the number of rows written (answered from file footers)."""
    return counts.get()[name] == written.count()
