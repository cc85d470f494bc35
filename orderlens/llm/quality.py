"""Quality classifier by compression.

Two zstandard dictionaries are built from texts labelled good and bad. A text is compressed with
either, block by block; the normalised difference of the two sizes, with the compression ratios,
goes through a logistic calibration and comes out as the probability of a good label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from orderlens.llm.common import crc_of, one_in, whole


@dataclass(frozen=True)
class QualityParams:
    """``rows_per_class`` bounds the labelled rows read to fit, ``fit_bytes`` the length of a text
    used to fit; a text to be scored has no bound."""

    rows_per_class: int = 2000
    fit_bytes: int = 1 << 18
    dictionary_bytes: int = 112_640
    block_bytes: int = 1024
    level: int = 3
    threshold: float = 0.3
    ridge: float = 1e-3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries and calibration; a few hundred KB whatever the corpus. ``prior`` is the score
    where the labels had one class only, or none (0.5)."""

    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float | None
    params: QualityParams


class _Sizes:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes, params: QualityParams):
        self.block = params.block_bytes
        self.coders = []
        for content in (good, bad):
            table = zstandard.ZstdCompressionDict(content)
            table.precompute_compress(level=params.level)
            self.coders.append(
                zstandard.ZstdCompressor(
                    level=params.level,
                    dict_data=table,
                    write_checksum=False,
                    write_content_size=False,
                    write_dict_id=False,
                )
            )

    def features(self, text: str) -> tuple[float, float, float, float]:
        raw = text.encode("utf-8", "replace")
        good = bad = 0
        by_good, by_bad = self.coders
        for start in range(0, len(raw), self.block):
            part = raw[start : start + self.block]
            good += len(by_good.compress(part))
            bad += len(by_bad.compress(part))
        length = max(1, len(raw))
        return (bad - good) / max(1, bad + good), good / length, bad / length, 1 / (1 + length / 200)


def _dictionary(texts: list[str], params: QualityParams) -> bytes:
    blocks = [
        raw[start : start + params.block_bytes]
        for raw in (text.encode("utf-8", "replace") for text in texts)
        for start in range(0, len(raw), params.block_bytes)
    ]
    size = params.dictionary_bytes
    while size >= 256:
        try:
            return zstandard.train_dictionary(size, blocks).as_bytes()
        except zstandard.ZstdError:
            size //= 4  # too few labelled bytes for a dictionary of this size
    return b"".join(blocks)[: params.dictionary_bytes] or b"\n" * 8


def _logistic(features: np.ndarray, target: np.ndarray, ridge: float):
    centre, scale = features.mean(0), features.std(0) + 1e-9
    design = np.c_[np.ones(len(features)), (features - centre) / scale]
    weights = np.zeros(design.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -35, 35)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(weights))
        step = np.linalg.solve(hessian, design.T @ (target - p) - ridge * weights)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return centre, scale, weights


def labelled_sample(
    docs: DataFrame, labels: DataFrame, params: QualityParams, fit_on: Column | None = None
) -> tuple[list, dict[int, int]]:
    """Bounded sample of labelled texts, chosen by a hash of the id, and how many labels either class has.

    Several labels of one id: the lowest counts. Null labels, and labels without a document, are
    left out. ``fit_on`` (over ``doc_id``) restricts the labels that may be learnt from.
    """
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    if fit_on is not None:
        marks = marks.where(fit_on)
    marks = marks.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("mark"))
    there = docs.where(F.octet_length(whole("text")).between(1, params.fit_bytes)).select("doc_id")
    usable = marks.join(there, "doc_id", "left_semi").withColumn("turn", F.xxhash64("doc_id"))
    shares = {row["mark"]: row["n"] for row in usable.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for mark in (0, 1):
        divisor = one_in(shares.get(mark, 0), 3 * params.rows_per_class)
        some = usable.where((F.col("mark") == mark) & (F.pmod("turn", F.lit(divisor)) == 0))
        part = some.orderBy("turn", "doc_id").limit(params.rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = {row["doc_id"]: row["mark"] for row in chosen.select("doc_id", "mark").collect()}
    if not ids:
        return [], shares
    found = (
        docs.where(F.col("doc_id").isin(list(ids)))
        .where(F.octet_length(whole("text")).between(1, params.fit_bytes))
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .select("doc_id", F.xxhash64("doc_id").alias("turn"), "text")
        .collect()
    )
    ordered = sorted(found, key=lambda row: (row["turn"], row["doc_id"]))
    return [(row["text"], ids[row["doc_id"]]) for row in ordered], shares


def fit(
    docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), fit_on: Column | None = None
) -> QualityModel:
    """Dictionaries from half of the sample, calibration on the other half.

    Labels of a single class give a model whose score is that class for every text; no usable
    label at all gives 0.5.
    """
    sample, shares = labelled_sample(docs, labels, params, fit_on)
    target = np.array([mark for _, mark in sample], dtype=float)
    if len(set(target.tolist())) < 2:
        return QualityModel(b"", b"", (), (), (), float(target[0]) if len(target) else 0.5, params)
    seen = {0: 0, 1: 0}
    build: dict[int, list[str]] = {0: [], 1: []}
    calibrate: list[tuple[str, int]] = []
    for text, mark in sample:
        seen[mark] += 1
        if seen[mark] % 2:
            build[mark].append(text)
        else:
            calibrate.append((text, mark))
    if len({mark for _, mark in calibrate}) < 2:
        calibrate = sample
    good, bad = _dictionary(build[1], params), _dictionary(build[0], params)
    sizes = _Sizes(good, bad, params)
    features = np.array([sizes.features(text) for text, _ in calibrate])
    marks = np.array([mark for _, mark in calibrate], dtype=float)
    centre, scale, weights = _logistic(features, marks, params.ridge)
    # The sample may take one class more densely than the other: move the odds back to the labels' own.
    weights[0] += np.log(shares[1] / shares[0]) - np.log(marks.sum() / (len(marks) - marks.sum()))
    return QualityModel(
        good, bad, tuple(centre.tolist()), tuple(scale.tolist()), tuple(weights.tolist()), None, params
    )


def score_texts(model: QualityModel, texts: list[str | None]) -> list[float]:
    if model.prior is not None:
        return [model.prior] * len(texts)
    sizes = _Sizes(model.good, model.bad, model.params)
    return _scored(model, sizes, texts)


def _scored(model: QualityModel, sizes: _Sizes, texts) -> list[float]:
    if not len(texts):
        return []
    features = np.array([sizes.features(text or "") for text in texts])
    centred = (features - np.array(model.centre)) / np.array(model.scale)
    weights = np.array(model.weights)
    odds = np.clip(weights[0] + centred @ weights[1:], -35, 35)
    return (1 / (1 + np.exp(-odds))).tolist()


def scorer(model: QualityModel):
    """Pandas UDF from a text column to its score; compressors are made once per task."""
    if model.prior is not None:
        constant = model.prior
        return lambda text: F.lit(constant).cast("double")

    @F.pandas_udf("double")
    def quality_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes = _Sizes(model.good, model.bad, model.params)
        for batch in batches:
            yield pd.Series(_scored(model, sizes, batch), dtype="float64")

    return quality_score


def with_score(docs: DataFrame, model: QualityModel, name: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the probability that each whole text is good (null and empty texts too).

    A column of that name is replaced; repeated rows, ties and extra columns stay as they are.
    """
    return docs.withColumn(name, scorer(model)(whole(text)))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, with their columns unchanged."""
    return docs.where(scorer(model)(whole(text)) >= F.lit(model.params.threshold))


def quality_report(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Score of every document by a model that saw no label of the held-out ids (crc32 mod 5 = 0)."""
    model = fit(docs, labels, params, fit_on=crc_of("doc_id") % 5 != 0)
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (crc_of("doc_id") % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= F.lit(params.threshold)).cast("int").alias("predicted"),
    )
