"""The registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.config import FMConfig, ModelMeta
from pairloom.operators import describe, evaluation, scoring
from pairloom.operators.examples import (
    assign_shard, binarise_label, default_slots, from_vectors, number_steps, preview, shard_weights, split_examples, to_long,
)
from pairloom.operators.gradient import gradient
from pairloom.operators.local_epoch import local_epoch, needed_features, plan_runs, row_bytes_in_task, walk_slots
from pairloom.operators.params import (
    add_state, bias, factors, init_params, linear_weights, param_edges, param_health,
)
from pairloom.plans import datasets
from pairloom.plans.fit import fit
from pairloom.plans.scratch import new_run_dir, write_table
from pairloom.plans.session import settings
from pairloom.sources.history import read_history, write_history
from pairloom.sources.libsvm import libsvm_lines, read_libsvm, write_libsvm
from pairloom.sources.model_text import export_lines, read_params_text, write_params_text

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
INIT_STD = 0.1
START_BIAS = 0.1
NUM_SHARDS = 256
SCORE = FMConfig(k2=8, seed=SEED, init_std=INIT_STD, reg=(0.001, 0.002, 0.003), num_shards=NUM_SHARDS)
LOCAL = SCORE.with_(k2=4, step_size=0.05)
HISTORY = LOCAL.with_(epochs=2)
REGRESSION = HISTORY.with_(task=0, optimizer="rmsprop", step_size=0.01)
TERMS_OFF = HISTORY.with_(k0=False, k1=False, optimizer="adam", step_size=0.01)
DOCUMENTS = FMConfig(
    k2=4, seed=SEED, init_std=0.05, reg=(0.0, 0.0, 0.001), optimizer="adam", step_size=0.02, epochs=3, num_shards=4
)


def rounded(column: str | Column, digits: int = 6) -> Column:
    """A double as the checks compare it; the sum with zero removes -0."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, digits) + F.lit(0.0)


_stored: dict[tuple, DataFrame] = {}


def start_params(spark: SparkSession, n_features: int, cfg: FMConfig) -> DataFrame:
    """Random start, stored as a table once per session.

    The bias is not zero, so that it shows in every result.
    """
    key = (spark.sparkContext.applicationId, n_features, cfg.k0, cfg.k1, cfg.k2, cfg.init_std, cfg.seed)
    if key not in _stored:
        w = F.when(F.col("j") == 0, F.lit(START_BIAS)).otherwise(F.col("w"))
        params = init_params(spark, n_features, cfg).withColumn("w", w)
        _stored[key] = write_table(params, new_run_dir(spark, "start"))
    return _stored[key]


def _orders(spark, sf_dir, cfg: FMConfig = SCORE):
    data = datasets.order_examples(spark, sf_dir)
    return data.examples, start_params(spark, data.n_features, cfg), ModelMeta.of(cfg, data.n_features)


def _flat(params: DataFrame, k2: int, names=(("w", "v"),), digits: int = 6) -> DataFrame:
    columns = []
    for w, v in names:
        columns.append(rounded(w, digits).alias(w))
        columns += [rounded(F.get(v, F.lit(f)), digits).alias(f"{v}_{f}") for f in range(k2)]
    return params.select("j", *columns)


# Examples, sources, sinks


def fm_examples_long(spark, sf_dir):
    return to_long(datasets.order_examples(spark, sf_dir).examples)


def document_words_long(spark, sf_dir):
    return to_long(datasets.document_counts(spark, sf_dir).examples)


def label_binarise(spark, sf_dir):
    examples = datasets.order_examples(spark, sf_dir, regression=True).examples
    centred = examples.withColumn("label", F.col("label") - F.lit(1.5))
    return binarise_label(centred).select("example_id", "label")


def libsvm_encode(spark, sf_dir):
    return libsvm_lines(datasets.document_counts(spark, sf_dir).examples)


def libsvm_scan(spark, sf_dir):
    path = new_run_dir(spark, "libsvm")
    write_libsvm(datasets.document_counts(spark, sf_dir).examples, path)
    read = binarise_label(read_libsvm(spark, path))
    pairs = F.zip_with("indices", "values", lambda j, x: F.concat_ws(":", j, x.cast("long")))
    return read.select("label", F.size("indices").alias("n_nonzero"), F.concat_ws(" ", pairs).alias("features"))


def vector_scan(spark, sf_dir):
    """Documents as sparse vectors, by Spark's own reader, and back."""
    data = datasets.document_counts(spark, sf_dir)
    path = new_run_dir(spark, "libsvm")
    write_libsvm(data.examples, path)
    vectors = spark.read.format("libsvm").option("numFeatures", data.n_features).load(path)
    read = binarise_label(from_vectors(vectors))
    pairs = F.zip_with("indices", "values", lambda j, x: F.concat_ws(":", j, x.cast("long")))
    return read.select("label", F.size("indices").alias("n_nonzero"), F.concat_ws(" ", pairs).alias("features"))


def shard_profile(spark, sf_dir):
    return describe.shard_profile(assign_shard(datasets.order_examples(spark, sf_dir).examples, NUM_SHARDS))


def sample_preview(spark, sf_dir):
    examples = split_examples(datasets.order_examples(spark, sf_dir).examples)
    first = [preview(examples.where(F.col("split") == s)) for s in ("train", "valid")]
    text = F.concat_ws(" ", "indices").alias("features")
    return first[0].unionByName(first[1]).select("split", "example_id", "label", text)


def score_preview(spark, sf_dir):
    scored = preview(scoring.score(*_orders(spark, sf_dir)), 10)
    return scored.select("example_id", "label", rounded("score").alias("score"))


# Description and checks


def dataset_stats(spark, sf_dir):
    return describe.describe(split_examples(datasets.order_examples(spark, sf_dir).examples))


def document_stats(spark, sf_dir):
    return describe.describe(split_examples(datasets.document_counts(spark, sf_dir).examples))


def label_range(spark, sf_dir):
    found = describe.label_range(datasets.order_examples(spark, sf_dir, regression=True).examples)
    return found.select(rounded("label_min").alias("label_min"), rounded("label_max").alias("label_max"))


def value_guard(spark, sf_dir):
    return describe.not_one_hot(datasets.document_counts(spark, sf_dir).examples)


def _document_split(spark, sf_dir):
    examples = split_examples(datasets.document_counts(spark, sf_dir).examples)
    return examples.where(F.col("split") == "train"), examples.where(F.col("split") == "valid")


def unseen_features(spark, sf_dir):
    train, valid = _document_split(spark, sf_dir)
    seen = train.select(F.explode("indices").alias("j")).distinct()
    return describe.unseen_features(valid, seen)


def dimension_guard(spark, sf_dir):
    """Documents in other languages that are wider than a model of the English ones."""
    english = datasets.table(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").alias("example_id"))
    examples = datasets.document_counts(spark, sf_dir).examples
    model = examples.join(english, "example_id", "left_semi")
    return describe.beyond_dimension(examples.join(english, "example_id", "left_anti"), describe.feature_dim(model))


# Parameters


def fm_init(spark, sf_dir):
    n = datasets.order_examples(spark, sf_dir).n_features
    return _flat(init_params(spark, n, SCORE), SCORE.k2, digits=9)


def model_meta(spark, sf_dir):
    """Description of a regression model of the order prices: dimension and label range come from the table."""
    data = datasets.order_examples(spark, sf_dir, regression=True)
    low, high = describe.label_range(data.examples).first()
    meta = ModelMeta.of(SCORE.with_(task=0), describe.feature_dim(data.examples), low, high).frame(spark)
    return meta.withColumns({c: rounded(c) for c in ("label_min", "label_max")})


def model_parts(spark, sf_dir):
    _, params, meta = _orders(spark, sf_dir)
    w0 = bias(params).select(F.lit("w0").alias("part"), F.lit(0).alias("j"), F.col("w0").alias("value"))
    w = linear_weights(params).select(F.lit("w").alias("part"), "j", F.col("w").alias("value"))
    v = factors(params, meta.k2).unpivot("j", [f"v_{f}" for f in range(meta.k2)], "part", "value").select("part", "j", "value")
    return w0.unionByName(w).unionByName(v).withColumn("value", rounded("value"))


def health(spark, sf_dir):
    _, params, _ = _orders(spark, sf_dir)
    return param_health(params).select(
        "n_values", "n_nan", rounded("min_value").alias("min_value"), rounded("max_value").alias("max_value")
    )


def edges(spark, sf_dir):
    _, params, meta = _orders(spark, sf_dir)
    return param_edges(params, meta.n_features, SCORE).select("place", rounded("value").alias("value"))


# Scoring


def _scored_columns(df):
    return df.select("example_id", "label", rounded("raw").alias("raw"), rounded("score").alias("score"))


def fm_score_linear(spark, sf_dir):
    out = scoring.linear_term(*_orders(spark, sf_dir))
    return out.select("example_id", "label", rounded("linear").alias("linear"))


def fm_score_factors(spark, sf_dir):
    out = scoring.pairwise_term(*_orders(spark, sf_dir))
    sums = [rounded(f"s_{f}").alias(f"s_{f}") for f in range(SCORE.k2)]
    return out.select("example_id", rounded("pairwise").alias("pairwise"), *sums)


def fm_predict(spark, sf_dir):
    return _scored_columns(scoring.score(*_orders(spark, sf_dir)))


def fm_predict_sharded(spark, sf_dir):
    """The path for parameters too large to broadcast: copies travel to the shards."""
    examples, params, meta = _orders(spark, sf_dir)
    n = default_slots(spark, NUM_SHARDS)
    sharded = assign_shard(examples, NUM_SHARDS, n)
    # The setting holds while this is planned and written, and not for what the session runs later.
    with settings(spark):
        scored = write_table(scoring.score(sharded, params, meta, limit_bytes=0, slots=n), new_run_dir(spark, "scored"))
    return _scored_columns(scored)


def fm_predict_documents(spark, sf_dir):
    data = datasets.document_counts(spark, sf_dir)
    params = start_params(spark, data.n_features, LOCAL)
    return _scored_columns(scoring.score(data.examples, params, ModelMeta.of(LOCAL, data.n_features)))


def fm_predict_unseen(spark, sf_dir):
    """Validation documents scored by a model that only has the features of the others."""
    data = datasets.document_counts(spark, sf_dir)
    train, valid = _document_split(spark, sf_dir)
    seen = train.select(F.explode("indices").alias("j")).distinct()
    params = start_params(spark, data.n_features, LOCAL)
    kept = params.join(seen, "j", "left_semi").unionByName(params.where(F.col("j") == 0))
    return _scored_columns(scoring.score(valid, kept, ModelMeta.of(LOCAL, data.n_features), unseen="ignore"))


def fm_predict_terms_off(spark, sf_dir):
    """Neither bias nor linear term: the pairwise term alone."""
    data = datasets.order_examples(spark, sf_dir)
    cfg = SCORE.with_(k0=False, k1=False)
    params = start_params(spark, data.n_features, cfg)
    return _scored_columns(scoring.score(data.examples, params, ModelMeta.of(cfg, data.n_features)))


def _price_scores(spark, sf_dir):
    """Scores far enough apart that both ends of the label range clip some."""
    data = datasets.order_examples(spark, sf_dir, regression=True)
    cfg = SCORE.with_(task=0, init_std=1.0)
    low, high = describe.label_range(data.examples).first()
    params = start_params(spark, data.n_features, cfg)
    return scoring.score(data.examples, params, ModelMeta.of(cfg, data.n_features, low, high))


def fm_predict_regression(spark, sf_dir):
    return _scored_columns(_price_scores(spark, sf_dir))


# Training


def fm_gradient(spark, sf_dir):
    examples, params, meta = _orders(spark, sf_dir)
    n = default_slots(spark, NUM_SHARDS)
    grad = gradient(assign_shard(examples, NUM_SHARDS, n), params, meta, SCORE, slots=n)
    return _flat(grad, SCORE.k2, (("gw", "gv"),))


def _local_epoch(optimizer: str, residual: str = "cross_entropy", runs: int = 1, epochs: int = 1, **settings) -> Query:
    cfg = LOCAL.with_(optimizer=optimizer, residual=residual, **settings)
    names = (("w", "v"), *((f"{s}_w", f"{s}_v") for s in cfg.state_slots))

    def query(spark, sf_dir):
        examples, params, meta = _orders(spark, sf_dir, cfg)
        n = walk_slots(examples, cfg)
        weights = shard_weights(examples, NUM_SHARDS)
        sharded = assign_shard(examples, NUM_SHARDS, n, weights=weights)
        # Tasks that may hold the parameters of about a `runs`-th of their non-zeros.
        limit = cfg.task_bytes if runs == 1 else row_bytes_in_task(cfg) * (1 + sum(weights) // (n * runs))
        limited = cfg.with_(task_bytes=limit)
        # Placed, sorted and numbered once: the epochs and the plan of their runs read the same rows.
        stepped = number_steps(sharded).persist(StorageLevel.MEMORY_AND_DISK)
        needed = needed_features(stepped, cfg).persist(StorageLevel.MEMORY_AND_DISK)
        held = [stepped, needed]
        try:
            planned = plan_runs(stepped, needed, limited)
            if planned[1] > 1:
                held.append(planned[0].persist(StorageLevel.MEMORY_AND_DISK))
            after = add_state(params, cfg)
            for epoch in range(1, epochs + 1):
                updated = local_epoch(stepped, after, meta, limited, slots=n, needed=needed, runs=planned, epoch=epoch)
                after = write_table(updated, new_run_dir(spark, "epoch"))
        finally:
            for df in held:
                df.unpersist()
        return _flat(after, cfg.k2, names)

    return query


def _history(data, cfg: FMConfig, params: DataFrame | None = None) -> DataFrame:
    examples = split_examples(data.examples)
    train, valid = (examples.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    history = fit(train, valid, cfg, params=params, n_features=data.n_features).history
    kept = [c for c in history.columns if c not in ("epoch", "minutes", "finished_at")]
    return history.select("epoch", *[rounded(c).alias(c) for c in kept])


def fm_train_history(spark, sf_dir):
    data = datasets.order_examples(spark, sf_dir)
    return _history(data, HISTORY, start_params(spark, data.n_features, HISTORY))


def fm_train_documents(spark, sf_dir):
    return _history(datasets.document_examples(spark, sf_dir), DOCUMENTS)


def fm_train_health(spark, sf_dir):
    """Number, NaNs, least and greatest of all parameters, before training and after each epoch."""
    data = datasets.order_examples(spark, sf_dir)
    examples = split_examples(data.examples)
    train, valid = (examples.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    params = start_params(spark, data.n_features, HISTORY)
    health = fit(train, valid, HISTORY, params=params, n_features=data.n_features).health
    return health.withColumns({c: rounded(c) for c in ("min_value", "max_value")})


def fm_train_regression(spark, sf_dir):
    """Parameters of a regression on order prices after two epochs."""
    data = datasets.order_examples(spark, sf_dir, regression=True)
    examples = split_examples(data.examples)
    train, valid = (examples.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    params = start_params(spark, data.n_features, REGRESSION)
    return _flat(fit(train, valid, REGRESSION, params=params, n_features=data.n_features).params, REGRESSION.k2)


def fm_train_terms_off(spark, sf_dir):
    """Parameters of a model without bias and linear term after two epochs."""
    data = datasets.order_examples(spark, sf_dir)
    examples = split_examples(data.examples)
    train, valid = (examples.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    params = start_params(spark, data.n_features, TERMS_OFF)
    model = fit(train, valid, TERMS_OFF, params=params, n_features=data.n_features)
    return _flat(model.params, TERMS_OFF.k2).drop("w")


def history_sink(spark, sf_dir):
    """A history written epoch by epoch, written once more as a whole, and another run's, read back for one run."""
    data = datasets.document_examples(spark, sf_dir)
    examples = split_examples(data.examples)
    train, valid = (examples.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    path = new_run_dir(spark, "history")
    model = fit(train, valid, DOCUMENTS, n_features=data.n_features, history_path=path, run="2024-01-01")
    write_history(model.history, path, "2024-01-01")
    write_history(model.history.where("epoch < 2"), path, "2024-01-02")
    read = read_history(spark, path, run="2024-01-01")
    kept = [c for c in read.columns if c not in ("run", "epoch", "minutes", "finished_at")]
    return read.select("epoch", *[rounded(c).alias(c) for c in kept])


def libsvm_train(spark, sf_dir):
    """Orders written as libsvm text in order of their keys, read back and trained: an example is its line."""
    data = datasets.order_examples(spark, sf_dir)
    path = new_run_dir(spark, "libsvm")
    write_libsvm(data.examples.orderBy("example_id"), path)
    examples = split_examples(read_libsvm(spark, path))
    train, valid = (examples.where(F.col("split") == s).drop("split") for s in ("train", "valid"))
    params = start_params(spark, data.n_features, HISTORY)
    model = fit(train, valid, HISTORY, params=params, n_features=data.n_features)
    return _flat(model.params, HISTORY.k2)


# Evaluation


def _scored_split(spark, sf_dir):
    examples, params, meta = _orders(spark, sf_dir)
    return scoring.score(split_examples(examples), params, meta)


def _rounded_metrics(df):
    return df.select(*[rounded(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def fm_log_loss(spark, sf_dir):
    return _rounded_metrics(evaluation.log_loss(_scored_split(spark, sf_dir)))


def fm_auc(spark, sf_dir):
    return _rounded_metrics(evaluation.auc(_scored_split(spark, sf_dir)))


def fm_class_means(spark, sf_dir):
    return _rounded_metrics(evaluation.class_means(_scored_split(spark, sf_dir)))


def fm_evaluate(spark, sf_dir):
    return _rounded_metrics(evaluation.evaluate(_scored_split(spark, sf_dir)))


def fm_evaluate_lines(spark, sf_dir):
    found = evaluation.evaluate(_scored_split(spark, sf_dir))
    numbers = [F.format_string("%.5f", rounded(c)) for c in ("log_loss", "auc", "pos_mean", "neg_mean")]
    return found.select(F.concat_ws("  ", "split", *numbers).alias("line"))


def fm_regression_metrics(spark, sf_dir):
    return _rounded_metrics(evaluation.regression_metrics(split_examples(_price_scores(spark, sf_dir))))


# Export


def fm_export_lines(spark, sf_dir):
    _, params, _ = _orders(spark, sf_dir)
    return export_lines(params, digits=6).select("value")


def fm_export_read(spark, sf_dir):
    _, params, _ = _orders(spark, sf_dir)
    path = new_run_dir(spark, "export")
    write_params_text(params, path)
    return _flat(read_params_text(spark, path), SCORE.k2, digits=9)


def export_twice(spark, sf_dir):
    """The second export takes the place of the first."""
    _, params, _ = _orders(spark, sf_dir)
    path = new_run_dir(spark, "export")
    write_params_text(params.where("j < 3"), path)
    write_params_text(params, path)
    return _flat(read_params_text(spark, path), SCORE.k2, digits=9)


QUERIES: dict[str, Query] = {
    "fm_examples_long": fm_examples_long,
    "document_words_long": document_words_long,
    "label_binarise": label_binarise,
    "libsvm_encode": libsvm_encode,
    "libsvm_scan": libsvm_scan,
    "vector_scan": vector_scan,
    "shard_profile": shard_profile,
    "sample_preview": sample_preview,
    "score_preview": score_preview,
    "dataset_stats": dataset_stats,
    "document_stats": document_stats,
    "label_range": label_range,
    "value_guard": value_guard,
    "unseen_features": unseen_features,
    "dimension_guard": dimension_guard,
    "fm_init": fm_init,
    "model_meta": model_meta,
    "model_parts": model_parts,
    "param_health": health,
    "param_edges": edges,
    "fm_score_linear": fm_score_linear,
    "fm_score_factors": fm_score_factors,
    "fm_predict": fm_predict,
    "fm_predict_sharded": fm_predict_sharded,
    "fm_predict_documents": fm_predict_documents,
    "fm_predict_unseen": fm_predict_unseen,
    "fm_predict_terms_off": fm_predict_terms_off,
    "fm_predict_regression": fm_predict_regression,
    "fm_gradient": fm_gradient,
    "sgd_local_epoch": _local_epoch("sgd"),
    "adam_local_epoch": _local_epoch("adam"),
    "rmsprop_local_epoch": _local_epoch("rmsprop"),
    # Tasks that may hold only some of their shards' parameters.
    "rmsprop_two_epochs": _local_epoch("rmsprop", epochs=2),
    "adam_local_epoch_standard": _local_epoch("adam", bias_correction="standard"),
    "adam_two_epochs_standard": _local_epoch("adam", epochs=2, bias_correction="standard"),
    "adam_local_epoch_runs": _local_epoch("adam", runs=3),
    "adam_local_epoch_weighted": _local_epoch("adam", "label_weighted"),
    "rmsprop_local_epoch_weighted": _local_epoch("rmsprop", "label_weighted"),
    "fm_log_loss": fm_log_loss,
    "fm_auc": fm_auc,
    "fm_class_means": fm_class_means,
    "fm_evaluate": fm_evaluate,
    "fm_evaluate_lines": fm_evaluate_lines,
    "fm_regression_metrics": fm_regression_metrics,
    "fm_train_history": fm_train_history,
    "fm_train_documents": fm_train_documents,
    "libsvm_train": libsvm_train,
    "fm_train_health": fm_train_health,
    "fm_train_regression": fm_train_regression,
    "fm_train_terms_off": fm_train_terms_off,
    "history_sink": history_sink,
    "export_twice": export_twice,
    "fm_export_lines": fm_export_lines,
    "fm_export_read": fm_export_read,
}
