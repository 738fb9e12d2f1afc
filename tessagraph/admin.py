"""Housekeeping: graphs in the catalogue, variables, running jobs, metrics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tessagraph import __version__
from tessagraph.errors import NotFoundError
from tessagraph.graph import PropertyGraph


@dataclass
class GraphSession:
    """Named graphs of one Spark catalogue database, with variables, jobs and metrics."""

    spark: SparkSession
    database: str = "default"
    _variables: dict[str, object] = field(default_factory=dict)

    def graphs(self) -> list[str]:
        names = {t.name for t in self.spark.catalog.listTables(self.database)}
        return sorted(n[: -len("_vertices")] for n in names if n.endswith("_vertices") and f"{n[: -len('_vertices')]}_edges" in names)

    def save(self, name: str, g: PropertyGraph) -> None:
        g.vertices.write.mode("overwrite").saveAsTable(f"{self.database}.{name}_vertices")
        g.edges.write.mode("overwrite").saveAsTable(f"{self.database}.{name}_edges")

    def graph(self, name: str) -> PropertyGraph:
        if name not in self.graphs():
            raise NotFoundError(name)
        return PropertyGraph(self.spark.table(f"{self.database}.{name}_vertices"), self.spark.table(f"{self.database}.{name}_edges"))

    def drop(self, name: str) -> None:
        for part in ("vertices", "edges"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{name}_{part}")

    def info(self, name: str) -> DataFrame:
        return self.graph(name).summary()

    def version(self) -> dict[str, str]:
        return {"engine": __version__, "spark": self.spark.version}

    def set_variable(self, key: str, value) -> None:
        self._variables[key] = value

    def variable(self, key: str):
        if key not in self._variables:
            raise NotFoundError(key)
        return self._variables[key]

    def remove_variable(self, key: str) -> None:
        self._variables.pop(key, None)

    def variables(self) -> dict[str, object]:
        return dict(self._variables)

    def tasks(self, group: str | None = None) -> list[dict]:
        """Jobs of a job group, or all active ones, with their state."""
        tracker = self.spark.sparkContext.statusTracker()
        ids = tracker.getJobIdsForGroup(group) if group else tracker.getActiveJobsIds()
        infos = [(i, tracker.getJobInfo(i)) for i in ids]
        return [{"id": i, "status": x.status, "stages": list(x.stageIds)} for i, x in infos if x]

    def conf(self) -> dict[str, str]:
        """The session's SQL settings that differ from their defaults."""
        return {r.key: r.value for r in self.spark.sql("SET").collect()}

    def task(self, job: int) -> dict:
        x = self.spark.sparkContext.statusTracker().getJobInfo(job)
        if x is None:
            raise NotFoundError(str(job))
        return {"id": job, "status": x.status, "stages": list(x.stageIds)}

    def cancel(self, group: str) -> None:
        self.spark.sparkContext.cancelJobGroup(group)

    def metrics(self) -> dict[str, object]:
        sc = self.spark.sparkContext
        return {"parallelism": sc.defaultParallelism, "application": sc.applicationId, "active_jobs": len(sc.statusTracker().getActiveJobsIds()), "memory": {str(k): (int(v._1()), int(v._2())) for k, v in sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().getExecutorMemoryStatus()).items()}}
