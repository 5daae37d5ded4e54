"""A committed log of the steps of an iterative clustering, from which a run is taken up again."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "step int, k int, changed bigint, n bigint, cid int, m array<double>"


@dataclass
class Step:
    """Centres after a step, and how many of ``n`` points changed their centre in it; step 0 holds the seeds."""

    step: int
    changed: int
    n: int
    centres: np.ndarray


class StepLog:
    """One folder below ``folder`` for each step, one row for each centre.

    Every row tells how many rows its step has, so a step counts once all are
    there: what a lost driver left half written is not read and is overwritten
    by the run that follows. This needs no rename and no listing order, so it
    holds on object stores as well.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, step: Step) -> None:
        k = len(step.centres)
        rows = [(step.step, k, step.changed, step.n, cid, m) for cid, m in enumerate(step.centres.tolist())]
        path = f"{self.folder}/{step.step:08d}"
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    def rows(self) -> DataFrame | None:
        """All rows; none if the log has not been begun."""
        try:
            return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def read(self) -> tuple[list[tuple[int, int, int]], list[Step]]:
        """``(step, changed, n)`` of the whole steps from 1 on, and the seeds and the last two whole steps with their centres.

        Steps after a missing or half-written one do not count.
        """
        table = self.rows()
        if table is None:
            return [], []
        found = table.groupBy("step").agg(
            F.count(F.lit(1)).alias("rows"), F.min("k").alias("k"), F.max("k").alias("most"), F.min("changed").alias("changed"),
            F.min("n").alias("n"),
        ).orderBy("step").collect()
        whole = []
        for at, row in enumerate(found):
            if row["step"] != at or not row["rows"] == row["k"] == row["most"]:
                break
            whole.append(row)
        last = []
        for row in [*whole[:1], *whole[-2:]]:
            centres = sorted(table.filter(F.col("step") == row["step"]).select("cid", "m").collect())
            last.append(Step(row["step"], row["changed"], row["n"], np.array([m for _, m in centres], dtype=np.float64)))
        return [(r["step"], r["changed"], r["n"]) for r in whole[1:]], last
