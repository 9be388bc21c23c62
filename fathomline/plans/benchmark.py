"""Benchmark: a registry of parameterised queries, warm-up, repetition, results as rows."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from fathomline.plans.warehouse import retried

REGISTRY: dict[str, type[Benchmark]] = {}
ITERATIONS, RETRIES, WARM_UPS = 10, 5, 3


def benchmark(name: str) -> Callable[[type], type]:
    """Register a benchmark class under a name."""

    def register(kind: type) -> type:
        REGISTRY[name] = kind
        return kind

    return register


@dataclass
class Benchmark:
    """Configurations (name to parameters), a query of parameters, warm-up queries of a random generator."""

    configurations: dict[str, dict[str, Any]]
    query: Callable[..., DataFrame]
    warm_up: list[Callable[[random.Random], DataFrame]] = field(default_factory=list)
    seed: int = 0

    def run(self, iterations: int = ITERATIONS) -> list[dict[str, Any]]:
        """A row per configuration and iteration: milliseconds to the no-op sink and the plan. A configuration whose tries all
        fail is left out, with a row that says so."""
        rng, rows = random.Random(self.seed), []
        for name, how in self.configurations.items():
            for i in range(iterations):
                for _ in range(WARM_UPS):
                    order = self.warm_up[:]
                    rng.shuffle(order)
                    for q in order:
                        q(rng).write.format("noop").mode("overwrite").save()
                try:
                    rows.append({"configuration": name, "iteration": i} | retried(lambda how=how: self._once(how), RETRIES))
                except Exception as e:  # noqa: BLE001
                    rows.append({"configuration": name, "iteration": i, "ms": None, "plan": None, "error": str(e)[:500]})
                    break
        return rows

    def _once(self, how: dict[str, Any]) -> dict[str, Any]:
        df = self.query(**how)
        began = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        ms = (time.perf_counter() - began) * 1000
        return {"ms": ms, "plan": df._jdf.queryExecution().toString(), "error": None}


def save(spark: SparkSession, rows: list[dict[str, Any]], suite: str, path: str) -> None:
    data = [(suite, r["configuration"], r["iteration"], r["ms"], r["plan"], r["error"]) for r in rows]
    spark.createDataFrame(data, "suite string, configuration string, iteration int, ms double, plan string, error string").write.mode("append").parquet(path)
