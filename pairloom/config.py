"""Hyper-parameters and model description."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

REGRESSION = 0
CLASSIFICATION = 1
OPTIMIZERS = ("sgd", "adam", "rmsprop")

# Optimizer-state slots kept beside each parameter (all start at zero).
STATE_SLOTS = {"sgd": (), "adam": ("m", "s"), "rmsprop": ("s",)}

META_SCHEMA = (
    "task int, k0 boolean, k1 boolean, k2 int, n_features int, "
    "label_min double, label_max double"
)


@dataclass(frozen=True)
class FMConfig:
    """Training settings of a second-order factorization machine.

    ``num_shards`` is part of the model, not a Spark tuning knob: every shard
    runs one sequential local epoch from the same start and the results are
    averaged, so another shard count gives other parameters. ``slots`` is how
    many tasks carry the shards; it changes nothing in the result.
    """

    task: int = CLASSIFICATION
    optimizer: str = "sgd"
    step_size: float = 0.1
    epochs: int = 50
    k0: bool = True
    k1: bool = True
    k2: int = 8
    reg: tuple[float, float, float] = (0.0, 1e-3, 1e-4)
    init_std: float = 0.1
    num_shards: int = 256
    # How ids become shards: "modulo", or "hash" for ids with a pattern. Part of the model.
    shard_method: str = "modulo"
    seed: int = 42
    # "cross_entropy": dLoss/dz = p - y for every optimizer.
    # "label_weighted": Adam and RMSProp use -y * (1 - sigmoid(y * p)), with
    # which rows of label 0 give no gradient beyond the L2 terms.
    residual: str = "cross_entropy"
    # "first_step": Adam's correction stays that of its first step. "standard": it follows the rows a shard has seen, so
    # the step counter is part of the optimizer's state, one per shard.
    bias_correction: str = "first_step"
    eval_every: int = 1
    slots: int | None = None
    # Tasks that evaluate the sets after an epoch; if they are more than the slots, rows get a second placement.
    score_tasks: int | None = None
    # Parameters are broadcast only when their estimated size is below this.
    broadcast_limit_bytes: int = 64 << 20
    # What a task may hold of its shards' parameters; training has as many slots as that takes. Beyond a small part of it the
    # parameters lie in files of the task, and shards that use more than these may take are walked in several runs of rows.
    task_bytes: int = 512 << 20

    def __post_init__(self) -> None:
        object.__setattr__(self, "optimizer", str(self.optimizer).lower())
        object.__setattr__(self, "reg", tuple(float(r) for r in self.reg))
        if self.task not in (REGRESSION, CLASSIFICATION):
            raise ValueError(f"task must be 0 or 1, got {self.task!r}")
        if self.optimizer not in OPTIMIZERS:
            raise ValueError(f"optimizer must be one of {OPTIMIZERS}, got {self.optimizer!r}")
        if self.k2 <= 0:
            raise ValueError("k2, the embedding width, must be positive")
        if len(self.reg) != 3:
            raise ValueError("reg needs three values: bias, linear, pairwise")
        if self.epochs < 0:
            raise ValueError("epochs must not be negative")
        if self.num_shards <= 0:
            raise ValueError("num_shards must be positive")
        if self.shard_method not in ("modulo", "hash"):
            raise ValueError(f"unknown shard method {self.shard_method!r}")
        if self.residual not in ("cross_entropy", "label_weighted"):
            raise ValueError(f"unknown residual {self.residual!r}")
        if self.bias_correction not in ("first_step", "standard"):
            raise ValueError(f"unknown bias correction {self.bias_correction!r}")
        if self.eval_every <= 0:
            raise ValueError("eval_every must be positive")
        if self.task_bytes <= 0:
            raise ValueError("task_bytes must be positive")

    def with_(self, **changes) -> FMConfig:
        return replace(self, **changes)

    @property
    def state_slots(self) -> tuple[str, ...]:
        return STATE_SLOTS[self.optimizer]

    @property
    def counts_steps(self) -> bool:
        return self.optimizer == "adam" and self.bias_correction == "standard"


@dataclass(frozen=True)
class ModelMeta:
    """What scoring needs to know about a model beside its parameters."""

    task: int
    k0: bool
    k1: bool
    k2: int
    n_features: int
    label_min: float | None = None
    label_max: float | None = None

    def __post_init__(self) -> None:
        if self.task not in (REGRESSION, CLASSIFICATION):
            raise ValueError(f"task must be 0 or 1, got {self.task!r}")
        if self.n_features <= 0 or self.k2 <= 0:
            raise ValueError("n_features and k2 must be positive")

    @classmethod
    def of(cls, cfg: FMConfig, n_features: int, label_min=None, label_max=None) -> ModelMeta:
        return cls(cfg.task, cfg.k0, cfg.k1, cfg.k2, n_features, label_min, label_max)

    def frame(self, spark: SparkSession) -> DataFrame:
        row = (self.task, self.k0, self.k1, self.k2, self.n_features, self.label_min, self.label_max)
        return spark.createDataFrame([row], META_SCHEMA)

    @classmethod
    def from_frame(cls, df: DataFrame) -> ModelMeta:
        return cls(**df.first().asDict())
