"""Line accounts of a running stream: used plus rejected lines are the input lines, per trigger, in the same pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from skytally.operators import REASONS, classify

NAME = "line_accounts"


def accounted(lines: DataFrame, job: str, name: str = NAME) -> DataFrame:
    """``lines``, with Spark's observed metrics on the way: lines, used, and one number per reason against them.

    The numbers are sums over the trigger's rows as they pass, so nothing is read again. A stream's progress
    has them (``Accounts``); a batch can pass a ``pyspark.sql.Observation`` as ``name``.
    """
    found = classify(lines, job)
    numbers = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS[job]]
    return found.observe(name, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason") == "ok").alias("used"), *numbers).select("line")


class Accounts(StreamingQueryListener):
    """Collects the line accounts of all triggers: ``(batch id, {lines, used, reason: n, ..})``; ``show`` prints them."""

    def __init__(self, show: bool = False, name: str = NAME):
        self.triggers: list[tuple[int, dict[str, int]]] = []
        self.show, self.name = show, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def add(self, progress) -> None:
        """Take one trigger's progress report."""
        found = progress.observedMetrics.get(self.name)
        if found is not None and progress.numInputRows:
            row = found.asDict()
            self.triggers.append((progress.batchId, row))
            if self.show:
                rejected = {k: v for k, v in row.items() if k not in ("lines", "used") and v}
                print(f"Batch {progress.batchId}: {row['lines']} lines, {row['used']} used, rejected {rejected or 0}", flush=True)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, spark: SparkSession) -> DataFrame:
        """``reason, n`` over all triggers (``ok`` for the used lines): a row per reason that was met."""
        n: dict[str, int] = {}
        for _, row in self.triggers:
            for k, v in row.items():
                if k != "lines":
                    n[k] = n.get(k, 0) + v
        rows = [("ok" if k == "used" else k, v) for k, v in n.items() if v]
        return spark.createDataFrame(rows, "reason string, n long")
