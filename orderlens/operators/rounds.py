"""A fitted ensemble of boosted trees, round by round: margins after each tree, and what they are worth.

The trees are read from the stored model as a table of nodes, which is bounded by the model. Rows are scored where they
are: a task keeps one running margin a row and adds up a handful of counts a round, so all prefixes of an
ensemble are judged in one pass and only these sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.dataset import LABEL
from orderlens.session import scratch_path

TINY = 1e-15  # probabilities are kept this far from 0 and 1


@dataclass(frozen=True)
class Tree:
    """Nodes by number; a leaf has no left child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: float

    def predict(self, features: np.ndarray) -> np.ndarray:
        at = np.zeros(len(features), dtype=np.int64)
        rows = np.arange(len(features))
        while len(rows := rows[self.left[at[rows]] >= 0]):
            node = at[rows]
            lower = features[rows, self.feature[node]] <= self.threshold[node]
            at[rows] = np.where(lower, self.left[node], self.right[node])
        return self.value[at]


def forest(model: PipelineModel, spark) -> list[Tree]:
    """The trees of a fitted pipeline in the order of their rounds."""
    path = scratch_path(spark, "forest")
    model.stages[-1].write().save(path)
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    by_tree: dict[int, list] = {}
    for node in nodes:
        by_tree.setdefault(node.treeID, []).append(node)
    trees = []
    for number in sorted(by_tree):
        own = sorted(by_tree[number], key=lambda n: n.id)
        if any(n.split.numCategories != -1 for n in own):
            raise ValueError("trees split by categories are not read here")
        trees.append(
            Tree(
                np.array([max(n.split.featureIndex, 0) for n in own]),
                np.array([n.split.leftCategoriesOrThreshold[0] if n.leftChild >= 0 else 0.0 for n in own]),
                np.array([n.leftChild for n in own]),
                np.array([n.rightChild for n in own]),
                np.array([n.prediction for n in own]),
                weights[number],
            )
        )
    return trees


SUMS = ("n_rows", "loss", "wrong", "tp", "fp", "fn", "tn")


def by_round(
    model: PipelineModel, rows: DataFrame, by: Sequence[str] = ("is_train",), at: Sequence[int] | None = None
) -> DataFrame:
    """``by``, ``round``, ``n_rows``, ``logloss``, ``error`` and the confusion counts of labelled rows after each round (or
    after those of ``at``), the cut-off being one half. The last round is the fitted model."""
    trees = forest(model, rows.sparkSession)
    wanted = sorted(set(at or range(1, len(trees) + 1)))
    if wanted[-1] > len(trees):
        raise ValueError(f"the model has {len(trees)} rounds")
    names = model.stages[0].getInputCols()
    by = list(by)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        kinds = None
        for batch in batches:
            kinds = kinds or [batch.schema.field(i).type for i in range(len(by))]
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(by))])) or [()] * batch.num_rows
            groups = {key: n for n, key in enumerate(dict.fromkeys(keys))}
            group = np.array([groups[key] for key in keys], dtype=np.int64)
            label = batch.column(len(by)).to_numpy()
            features = np.stack([batch.column(len(by) + 1 + i).to_numpy() for i in range(len(names))], axis=1)
            margin = np.zeros(len(label))
            for number, tree in enumerate(trees[: wanted[-1]], 1):
                margin += tree.weight * tree.predict(features)
                if number not in wanted:
                    continue
                p = np.clip(1 / (1 + np.exp(-2 * margin)), TINY, 1 - TINY)
                loss = -np.where(label == 1, np.log(p), np.log(1 - p))
                up, late = p >= 0.5, label == 1
                parts = (np.ones(len(p)), loss, up != late, up & late, up & ~late, ~up & late, ~up & ~late)
                for key, n in groups.items():
                    own = group == n
                    held = sums.setdefault((*key, number), np.zeros(len(SUMS)))
                    held += [part[own].sum() for part in parts]
        if sums:
            columns = list(zip(*sums))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [*kinds, pa.int32()])]
                + [pa.array([s[i] for s in sums.values()]) for i in range(len(SUMS))],
                [*by, "round", *SUMS],
            )

    plain = rows.select(*by, F.col(LABEL).cast("int"), *[F.col(n).cast("double").alias(n) for n in names])
    keys = "".join(f"`{n}` {plain.schema[n].dataType.simpleString()}, " for n in by)
    found = plain.mapInArrow(work, keys + "round int, " + ", ".join(f"{n} double" for n in SUMS))
    added = found.groupBy(*by, "round").agg(*[F.sum(n).alias(n) for n in SUMS])
    n = F.col("n_rows")
    return added.select(
        *by,
        "round",
        n.cast("bigint").alias("n_rows"),
        (F.col("loss") / n).alias("logloss"),
        (F.col("wrong") / n).alias("error"),
        *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")],
    )
