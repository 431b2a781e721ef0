"""Softmax regression fitted by full passes over a table.

Executors compute loss and gradient sums; the driver holds one parameter matrix and its optimizer
state, whose size is classes times features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators.vectors import to_matrix
from glyphmill.schemas import STATE, TRACE
from glyphmill.session import local_table
from glyphmill.sources import state


# Classes a model may have: its parameters are held by the driver and every task.
MAX_CLASSES = 100_000


@dataclass(frozen=True)
class Settings:
    steps: int
    max_rate: float = 0.1
    min_rate: float = 0.01
    warmup: int = 2
    cycle: int = 20
    betas: tuple[float, float] = (0.9, 0.999)
    eps: float = 1e-8
    weight_decay: float = 0.01
    max_norm: float = 1.0
    save_every: int = 0


@dataclass
class Model:
    """Parameters ``w`` (classes x features), optimizer moments ``m`` and ``v``, and the loss trace."""

    w: np.ndarray
    m: np.ndarray
    v: np.ndarray
    step: int = 0
    trace: list[tuple[int, float, float, float]] = field(default_factory=list)

    @classmethod
    def zeros(cls, n_classes: int, n_features: int) -> "Model":
        return cls(*(np.zeros((n_classes, n_features)) for _ in range(3)))


def rate_at(step: int, s: Settings) -> float:
    if step < s.warmup:
        return s.max_rate * step / s.warmup
    if step > s.cycle:
        return s.min_rate
    done = (step - s.warmup) / max(s.cycle - s.warmup, 1)
    return s.min_rate + 0.5 * (1 + math.cos(math.pi * done)) * (s.max_rate - s.min_rate)


def adamw_update(model: Model, grad: np.ndarray, rate: float, s: Settings) -> None:
    """One step with decoupled weight decay, the decay applied first."""
    model.step += 1
    model.w *= 1 - rate * s.weight_decay
    model.m += (1 - s.betas[0]) * (grad - model.m)
    model.v += (1 - s.betas[1]) * (grad * grad - model.v)
    m_hat = model.m / (1 - s.betas[0] ** model.step)
    v_hat = model.v / (1 - s.betas[1] ** model.step)
    model.w -= rate * m_hat / (np.sqrt(v_hat) + s.eps)


def gradient_sums(rows: DataFrame, features: str, label: str, w: Broadcast) -> DataFrame:
    """``(idx, total)``: loss sum at -2, row count at -1, and the gradient sum of each parameter.

    Each task sends one row per parameter.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = w.value
        loss, n, grad = 0.0, 0, np.zeros_like(weights)
        for batch in parts:
            if not len(batch):
                continue
            x = to_matrix(batch.column("x"))
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            if y.min() < 0 or y.max() >= len(weights):
                raise ValueError("label is not a class of the model")
            logits = x @ weights.T
            logits -= logits.max(axis=1, keepdims=True)
            norm = np.log(np.exp(logits).sum(axis=1, keepdims=True))
            here = np.arange(len(y))
            loss += float((norm[:, 0] - logits[here, y]).sum())
            n += len(y)
            p = np.exp(logits - norm)
            p[here, y] -= 1.0
            grad += p.T @ x
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(-2, grad.size), pa.int32()),
                    pa.array(np.concatenate([[loss, n], grad.ravel()])),
                ],
                names=["idx", "total"],
            )

    sums = rows.select(F.col(features).alias("x"), F.col(label).alias("y")).mapInArrow(
        batches, "idx int, total double"
    )
    return sums.groupBy("idx").agg(F.sum("total").alias("total"))


def fit_softmax_regression(
    rows: DataFrame,
    features: str,
    label: str,
    n_classes: int,
    settings: Settings,
    run_dir: str | None = None,
) -> Model:
    """Fit by full-batch AdamW with clipped gradients and a warm-up and cosine rate.

    With ``run_dir`` the model is committed there every ``save_every`` steps, and a later call with
    the same folder goes on from the last commit; rows or settings other than its own are refused.
    """
    spark = rows.sparkSession
    rows = rows.select(features, label).filter(f"{features} is not null and {label} is not null").persist()
    if not 0 < n_classes <= MAX_CLASSES:
        raise ValueError(f"a model has between one and {MAX_CLASSES} classes")
    committed = state.latest_step(spark, run_dir) if run_dir else None
    same = {k: v for k, v in settings.__dict__.items() if k not in ("steps", "save_every")}
    mark = state.fingerprint(rows, n_classes, sorted(same.items())) if run_dir else ""
    if committed is None:
        n_features = rows.select(F.max(F.size(features))).first()[0]
        if n_features is None:
            raise ValueError("no rows to fit")
        model = Model.zeros(n_classes, n_features)
    else:
        model = load_model(spark, run_dir, committed, mark)
    while model.step < settings.steps:
        w = spark.sparkContext.broadcast(model.w)
        totals = {r["idx"]: r["total"] for r in gradient_sums(rows, features, label, w).collect()}
        w.unpersist()
        n = totals[-1]
        grad = np.array([totals[i] for i in range(model.w.size)]).reshape(model.w.shape) / n
        norm = float(np.sqrt((grad * grad).sum()))
        grad *= min(1.0, settings.max_norm / (norm + 1e-6))
        step = model.step
        rate = rate_at(step, settings)
        adamw_update(model, grad, rate, settings)
        model.trace.append((step, rate, totals[-2] / n, norm))
        if run_dir and settings.save_every and model.step % settings.save_every == 0:
            save_model(spark, run_dir, model, mark)
    rows.unpersist()
    return model


def save_model(spark: SparkSession, run_dir: str, model: Model, mark: str = "") -> None:
    values = [
        (name, i, float(v))
        for name in ("w", "m", "v")
        for i, v in enumerate(getattr(model, name).ravel())
    ]
    values += [("shape", i, float(v)) for i, v in enumerate(model.w.shape)]
    state.save_step(
        spark,
        run_dir,
        model.step,
        mark,
        state=local_table(spark, values, STATE),
        trace=trace_table(spark, model),
    )


def load_model(spark: SparkSession, run_dir: str, step: int | None = None, mark: str | None = None) -> Model:
    """Model of a committed step, by default the last one."""
    step = state.latest_step(spark, run_dir) if step is None else step
    tables = state.load_step(spark, run_dir, step, mark)
    values: dict[str, dict[int, float]] = {}
    for row in tables["state"].collect():
        values.setdefault(row["name"], {})[row["idx"]] = row["value"]
    shape = tuple(int(values["shape"][i]) for i in range(2))
    arrays = [
        np.array([values[name][i] for i in range(len(values[name]))]).reshape(shape) for name in ("w", "m", "v")
    ]
    trace = sorted(tuple(r) for r in tables["trace"].collect())
    return Model(*arrays, step=step, trace=trace)


def trace_table(spark: SparkSession, model: Model) -> DataFrame:
    """``(step, rate, loss, grad_norm)``, the loss before each step."""
    return local_table(spark, model.trace, TRACE)
