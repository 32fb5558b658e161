"""Model weights: numpy in the program, a table at rest."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

WEIGHTS_SCHEMA = "layer int, slot string, name string, matrix array<array<double>>, bias array<double>"

# One named weight: (layer, slot, name) -> (matrix, bias or None). ``slot`` is a node type or
# an edge type name, or empty for a head.
Weights = dict[tuple[int, str, str], tuple[np.ndarray, np.ndarray | None]]


def formula_matrix(rows: int, cols: int, slot: int = 0) -> np.ndarray:
    """Closed-form test weights ``sin(7 row + 13 col + 3 slot) / 8``."""
    r, c = np.arange(rows)[:, None], np.arange(cols)[None, :]
    return np.sin(7.0 * r + 13.0 * c + 3.0 * slot) / 8


def formula_bias(rows: int, slot: int = 0) -> np.ndarray:
    """Closed-form test bias ``sin(5 row + 3 slot) / 8``."""
    return np.sin(5.0 * np.arange(rows) + 3.0 * slot) / 8


def formula_linear(rows: int, cols: int, slot: int = 0):
    return formula_matrix(rows, cols, slot), formula_bias(rows, slot)


def random_linear(rng: np.random.Generator, rows: int, cols: int):
    """Uniform in ±1/sqrt(cols), the usual start for a linear layer."""
    bound = 1.0 / np.sqrt(cols)
    return rng.uniform(-bound, bound, (rows, cols)), rng.uniform(-bound, bound, rows)


def weights_to_table(spark: SparkSession, weights: Weights) -> DataFrame:
    rows = [
        (layer, slot, name, np.asarray(w).tolist(), None if b is None else np.asarray(b).tolist())
        for (layer, slot, name), (w, b) in weights.items()
    ]
    return spark.createDataFrame(rows, WEIGHTS_SCHEMA)


def weights_from_table(table: DataFrame) -> Weights:
    """Weights are as large as the model, whatever the graph, so they come to the driver."""
    return {
        (r["layer"], r["slot"], r["name"]): (
            np.array(r["matrix"], "float64"),
            None if r["bias"] is None else np.array(r["bias"], "float64"),
        )
        for r in table.collect()
    }
