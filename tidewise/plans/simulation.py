"""Monte-Carlo policy simulation (survey M18): each seed is one row, so runs spread over the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def simulate(spark: SparkSession, runs: int, posts: int = 50, hours: int = 48, budget: int = 20) -> DataFrame:
    """seed, gained, waste: visits of the hottest posts under a budget against log-normal decay rates with bursts and stalls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for seed in batch["id"]:
                r = np.random.default_rng(seed)
                rate, lam = r.lognormal(0, 1, posts), r.lognormal(-2, 0.5, posts)
                pending, heat, gained, empty = np.zeros(posts), np.ones(posts), 0.0, 0
                for _ in range(hours):
                    burst = np.where(r.random(posts) < 0.02, 5.0, 1.0) * (r.random(posts) > 0.05)
                    pending += r.poisson(rate * burst)
                    rate *= np.exp(-lam)
                    visit = np.argsort(-heat, kind="stable")[:budget]
                    gained += pending[visit].sum()
                    empty += int((pending[visit] == 0).sum())
                    heat[visit] = 0.5 * heat[visit] + pending[visit]
                    pending[visit] = 0
                    heat += 0.05
                out.append((int(seed), float(gained), empty / (hours * budget)))
            yield pd.DataFrame(out, columns=["seed", "gained", "waste"])

    return spark.range(runs).mapInPandas(run, "seed long, gained double, waste double")
