"""The same results in plain SQL over the given tables, for checking.

Each statement starts from the tables, not from anything the Spark side wrote.
The sequential local epochs are recursive queries: step t + 1 of every shard is
computed from the state after step t, for all rows of all shards.
"""

from __future__ import annotations

from pairloom.config import FMConfig
from pairloom.plans import queries as q

_ORDERS = """
tokens AS (
  SELECT o_orderkey AS example_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
         o_totalprice / 100000.0::DOUBLE AS price, 1.0::DOUBLE AS x,
         unnest(['cust=' || c_custkey, 'nation=' || c_nationkey, 'seg=' || c_mktsegment,
                 'status=' || o_orderstatus]) AS token
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

# Orders whose label is their price.
_PRICES = _ORDERS.replace(
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0.0 END::DOUBLE AS label",
    "o_totalprice / 100000.0::DOUBLE AS label",
)
# Orders known by their position in order of keys.
_LINES = _ORDERS.replace("o_orderkey AS example_id", "line AS example_id").replace(
    "FROM orders JOIN customer ON o_custkey = c_custkey",
    "FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS line FROM orders JOIN customer ON o_custkey = c_custkey)",
)

_DOCUMENTS = """
found AS (
  SELECT doc_id AS example_id, quality::DOUBLE AS label,
         unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f]+')) AS token
  FROM documents JOIN labels USING (doc_id)),
tokens AS (
  SELECT example_id, label, token, count(*)::DOUBLE AS x FROM found WHERE token <> '' GROUP BY ALL)"""

_INDEXED = """,
vocab AS (
  SELECT token, row_number() OVER (ORDER BY token)::INTEGER AS j FROM (SELECT DISTINCT token FROM tokens)),
ex AS (SELECT tokens.* EXCLUDE (token), j FROM tokens JOIN vocab USING (token))"""


def _base(tokens: str = _ORDERS, recursive: bool = False) -> str:
    rows = {
        _ORDERS: ",\nrow_labels AS (SELECT DISTINCT example_id, label, price FROM tokens)",
        _PRICES: ",\nrow_labels AS (SELECT DISTINCT example_id, label, price FROM tokens)",
        _LINES: ",\nrow_labels AS (SELECT DISTINCT example_id, label, price FROM tokens)",
        _DOCUMENTS: ",\nrow_labels AS (SELECT doc_id AS example_id, quality::DOUBLE AS label "
        "FROM documents JOIN labels USING (doc_id))",
    }[tokens]
    return ("WITH RECURSIVE " if recursive else "WITH ") + tokens + _INDEXED + rows


def _gauss(seed: int, name: str) -> str:
    h = f"md5(concat_ws('|', '{seed}', j::VARCHAR, '{name}'))"
    u1 = f"('0x' || substr({h}, 1, 8))::BIGINT::DOUBLE"
    u2 = f"('0x' || substr({h}, 9, 8))::BIGINT::DOUBLE"
    return (
        f"sqrt(-2.0::DOUBLE * ln(({u1} + 1.0::DOUBLE) / 4294967297.0::DOUBLE))"
        f" * cos(2.0::DOUBLE * pi() * {u2} / 4294967296.0::DOUBLE)"
    )


def _fs(k: int) -> range:
    return range(k)


def _params(cfg: FMConfig, w0: float | None = q.START_BIAS, k1: bool = True) -> str:
    """CTE ``p(j, w, v_0 ..)``; factors of the bias are NULL."""
    std = f"{cfg.init_std}::DOUBLE"
    w = f"{_gauss(cfg.seed, 'w')} * {std}" if k1 else "NULL::DOUBLE"
    vs = ", ".join(f"{_gauss(cfg.seed, f'v{f}')} * {std} AS v_{f}" for f in _fs(cfg.k2))
    bias = ""
    if w0 is not None:
        nulls = ", ".join("NULL::DOUBLE" for _ in _fs(cfg.k2))
        bias = f" UNION ALL SELECT 0, {w0}::DOUBLE, {nulls}"
    return f",\np AS (SELECT j, {w} AS w, {vs} FROM vocab{bias})"


def _scored(
    k: int, params: str = "p", name: str = "scored", k0: bool = True, clip: tuple[str, str] | None = None,
    label: str = "label",
) -> str:
    """CTEs up to ``scored(example_id, label, linear, s_0 .., sum_sqr, raw, score)``."""
    s = ", ".join(f"coalesce(sum(v_{f} * x), 0.0) AS s_{f}" for f in _fs(k))
    norm = " + ".join(f"v_{f} * v_{f}" for f in _fs(k))
    square = " + ".join(f"s_{f} * s_{f}" for f in _fs(k))
    w0 = f"(SELECT w FROM {params} WHERE j = 0)" if k0 else "0.0::DOUBLE"
    link = f"greatest(least(raw, {clip[1]}), {clip[0]})" if clip else "1.0::DOUBLE / (1.0::DOUBLE + exp(-raw))"
    return f""",
{name}_sums AS (
  SELECT r.example_id, r.{label} AS label, {w0} + coalesce(sum(w * x), 0.0) AS linear, {s},
         coalesce(sum(({norm}) * x * x), 0.0) AS sum_sqr
  FROM row_labels r LEFT JOIN ex e ON e.example_id = r.example_id LEFT JOIN {params} m ON m.j = e.j
  GROUP BY r.example_id, r.{label}),
{name}_raw AS (SELECT *, linear + 0.5::DOUBLE * ({square} - sum_sqr) AS raw FROM {name}_sums),
{name} AS (SELECT *, {link} AS score FROM {name}_raw)"""


def _r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {name}"


_SPLIT = "CASE WHEN example_id % 5 = 0 THEN 'valid' ELSE 'train' END"
_SCORED_OUT = f" SELECT example_id, label, {_r('raw', 'raw')}, {_r('score', 'score')} FROM scored"


def _flat_columns(k: int, names=(("w", "v"),), digits: int = 6) -> str:
    out = []
    for w, v in names:
        out.append(_r(w, w, digits))
        out += [_r(f"{v}_{f}", f"{v}_{f}", digits) for f in _fs(k)]
    return ", ".join(out)


def _stats(tokens: str) -> str:
    # Halves round up; whole-number division keeps that exact.
    return _base(tokens) + f""",
per_row AS (
  SELECT r.example_id, r.label, count(e.j) AS nnz, coalesce(max(e.j), 0) AS top
  FROM row_labels r LEFT JOIN ex e USING (example_id) GROUP BY r.example_id, r.label),
g AS (
  SELECT {_SPLIT} AS split, count(*) AS n_total, count(*) FILTER (label > 0) AS n_pos,
         max(top)::INTEGER AS n_features, sum(nnz)::BIGINT AS n_nonzero,
         min(label) AS label_min, max(label) AS label_max
  FROM per_row GROUP BY 1)
SELECT split, n_total, n_pos, n_features, n_nonzero,
       ((20000 * n_pos + n_total) // (2 * n_total))::DOUBLE / 100.0::DOUBLE AS pos_percent,
       ((20 * (n_total - n_pos) + n_pos) // nullif(2 * n_pos, 0))::DOUBLE / 10.0::DOUBLE AS neg_per_pos,
       label_min, label_max
FROM g"""


def _metrics(scored: str, name: str) -> str:
    """CTE ``name(split, n_pos, n_neg, log_loss, auc, pos_mean, neg_mean)``.

    Equal scores are ties. Sums of equal rows may differ here in the last bit,
    so ties are found on the raw score to 9 places: the score itself is too
    dense near 1 to be rounded. From 36.7368 on its double is exactly 1.
    """
    p = "greatest(least(score, 1.0::DOUBLE - 1e-15::DOUBLE), 1e-15::DOUBLE)"
    return f""",
{name}_s AS (
  SELECT {_SPLIT} AS split, label, score, least(round(raw, 9), 36.7368::DOUBLE) AS place, {p} AS p FROM {scored}),
{name}_g AS (
  SELECT split, place, count(*) FILTER (label > 0) AS pos, count(*) FILTER (label <= 0) AS neg
  FROM {name}_s GROUP BY split, place),
{name}_c AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY place
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below
  FROM {name}_g),
{name}_a AS (
  SELECT split, sum(pos * (below + 0.5::DOUBLE * neg)) / nullif(sum(pos)::DOUBLE * sum(neg)::DOUBLE, 0) AS auc
  FROM {name}_c GROUP BY split),
{name} AS (
  SELECT split, count(*) FILTER (label > 0) AS n_pos, count(*) FILTER (label <= 0) AS n_neg,
         avg(-ln(CASE WHEN label > 0 THEN p ELSE 1.0::DOUBLE - p END)) AS log_loss, any_value(auc) AS auc,
         avg(score) FILTER (label > 0) AS pos_mean, avg(score) FILTER (label <= 0) AS neg_mean
  FROM {name}_s JOIN {name}_a USING (split) GROUP BY split)"""


def _slots(cfg: FMConfig) -> list[str]:
    return ["", *(f"{slot}_" for slot in cfg.state_slots)]


def _rule(cfg: FMConfig, theta: str, g: str, t: str) -> dict[str, str]:
    """New value of a parameter (key ``""``) and of its state; ``t`` counts the shard's steps from 1."""
    eta = f"{cfg.step_size}::DOUBLE"
    if cfg.optimizer == "sgd":
        moved = f"{theta} - {eta} * {g} / sqrt({g} * {g} + 1.0::DOUBLE)"
        return {"": f"greatest(-20.0::DOUBLE, least(20.0::DOUBLE, {moved}))"}
    if cfg.optimizer == "adam":
        m = f"(0.9::DOUBLE * m_{theta} + (1.0::DOUBLE - 0.9::DOUBLE) * {g})"
        s = f"(0.999::DOUBLE * s_{theta} + (1.0::DOUBLE - 0.999::DOUBLE) * {g} * {g})"
        t = t if cfg.counts_steps else "1"
        m_left, s_left = (f"(1.0::DOUBLE - pow({rho}::DOUBLE, {t}))" for rho in ("0.9", "0.999"))
        move = f"({m} / {m_left}) / (sqrt({s} / {s_left}) + 1e-8::DOUBLE)"
        return {"": f"{theta} - {eta} * {move}", "m_": m, "s_": s}
    s = f"(0.99::DOUBLE * s_{theta} + (1.0::DOUBLE - 0.99::DOUBLE) * {g} * {g})"
    return {"": f"{theta} - {eta} * {g} / sqrt({s} + 1e-8::DOUBLE)", "s_": s}


def _shards(cfg: FMConfig, where: str = "true") -> str:
    """CTEs ``act`` (active parameters per shard and step), ``needed`` and ``shard_rows``."""
    bias = "UNION ALL SELECT shard, step, label, 0, 1.0::DOUBLE FROM ordered" if cfg.k0 else ""
    return f""",
ordered AS (
  SELECT example_id, label, example_id % {cfg.num_shards} AS shard,
         row_number() OVER (PARTITION BY example_id % {cfg.num_shards} ORDER BY example_id) AS step
  FROM row_labels WHERE {where}),
act AS (
  SELECT shard, step, label AS y, j, x FROM ordered JOIN ex USING (example_id, label)
  {bias}),
shard_rows AS (SELECT shard, count(*) AS n_steps FROM ordered GROUP BY shard),
needed AS (SELECT DISTINCT shard, j, n_steps FROM act JOIN shard_rows USING (shard))"""


def _epoch(cfg: FMConfig, start: str, end: str, epoch: int = 1) -> str:
    """CTEs from parameters ``start`` to ``end``: one local epoch of every shard and the average."""
    k, slots = cfg.k2, _slots(cfg)
    names = ["w", *(f"v_{f}" for f in _fs(k))]
    stored = [f"{slot}{name}" for slot in slots for name in names]
    r0, r1, r2 = (f"{r}::DOUBLE" for r in cfg.reg)
    first = ", ".join(f"coalesce({c}, 0.0) AS {c}" if c in names else f"{c}" for c in stored)
    s = ", ".join(f"sum(v_{f} * x) OVER shard_now AS sum_{f}" for f in _fs(k))
    norm = " + ".join(f"v_{f} * v_{f}" for f in _fs(k))
    square = " + ".join(f"sum_{f} * sum_{f}" for f in _fs(k))
    prob = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-z)))"
    residual = f"{prob} - y_now"
    if cfg.task == 0:
        residual = "greatest(least(z, (SELECT max(label) FROM ordered)), (SELECT min(label) FROM ordered)) - y_now"
    if cfg.residual == "label_weighted" and cfg.optimizer != "sgd":
        residual = f"-y_now * (1.0::DOUBLE - 1.0::DOUBLE / (1.0::DOUBLE + exp(-y_now * {prob})))"
    grads = [f"CASE WHEN j = 0 THEN res + {r0} * w ELSE x * res + {r1} * w END AS g_w"]
    grads += [
        f"CASE WHEN j = 0 THEN 0.0::DOUBLE ELSE (sum_{f} * x - v_{f} * x * x) * res + {r2} * v_{f} END AS g_v_{f}"
        for f in _fs(k)
    ]
    if not cfg.k1:
        grads[0] = "0.0::DOUBLE AS g_w"
    new = {}
    for name in names:
        for slot, expr in _rule(cfg, name, f"g_{name}", f"(step + 1 + {epoch - 1} * n_steps)").items():
            new[f"{slot}{name}"] = f"CASE WHEN x IS NULL THEN {slot}{name} ELSE {expr} END"
    changes = ", ".join(f"sum(d.{c} - coalesce(s.{c}, 0.0)) / {float(cfg.num_shards)}::DOUBLE AS {c}" for c in stored)
    moved = ", ".join(f"s.{c} + coalesce(d.{c}, 0.0) AS {c}" for c in stored)
    return f""",
{end}_walk AS (
  SELECT shard, 0::BIGINT AS step, n_steps, j, {first} FROM needed JOIN {start} USING (j)
  UNION ALL
  SELECT shard, step + 1, n_steps, j, {', '.join(new[c] for c in stored)}
  FROM (
    SELECT *, {', '.join(grads)}
    FROM (
      SELECT *, {residual} AS res
      FROM (
        SELECT *, lin + 0.5::DOUBLE * ({square} - sqr) AS z
        FROM (
          SELECT h.*, a.x, max(a.y) OVER shard_now AS y_now, sum(w * x) OVER shard_now AS lin, {s},
                 sum(({norm}) * x * x) OVER shard_now AS sqr
          FROM {end}_walk h
          LEFT JOIN act a ON a.shard = h.shard AND a.step = h.step + 1 AND a.j = h.j
          WHERE h.step < h.n_steps
          WINDOW shard_now AS (PARTITION BY h.shard))))) steps),
{end}_change AS (
  SELECT d.j, {changes} FROM {end}_walk d JOIN {start} s ON s.j = d.j WHERE d.step = d.n_steps GROUP BY d.j),
{end} AS (SELECT s.j, {moved} FROM {start} s LEFT JOIN {end}_change d ON d.j = s.j)"""


def _with_state(cfg: FMConfig) -> str:
    zeros = ", ".join(f"0.0::DOUBLE AS {slot}{n}" for slot in _slots(cfg)[1:] for n in ["w", *(f"v_{f}" for f in _fs(cfg.k2))])
    return f",\np0 AS (SELECT *{', ' + zeros if zeros else ''} FROM p)"


def _local_epoch(optimizer: str, residual: str = "cross_entropy", epochs: int = 1, **settings) -> str:
    cfg = q.LOCAL.with_(optimizer=optimizer, residual=residual, **settings)
    names = [(f"{slot}w", f"{slot}v") for slot in _slots(cfg)]
    # The bias has no factors: NULL in both results.
    columns = []
    for w, v in names:
        columns.append(_r(w, w))
        columns += [_r(f"CASE WHEN j > 0 THEN {v}_{f} END", f"{v}_{f}") for f in _fs(cfg.k2)]
    return (
        _base(recursive=True) + _params(cfg) + _with_state(cfg) + _shards(cfg)
        + "".join(_epoch(cfg, f"p{e - 1}", f"p{e}", e) for e in range(1, epochs + 1))
        + f" SELECT j, {', '.join(columns)} FROM p{epochs}"
    )


def _history(cfg: FMConfig, tokens: str = _ORDERS, w0: float = q.START_BIAS) -> str:
    base = _base(tokens, recursive=True).replace(
        "SELECT tokens.* EXCLUDE (token), j", "SELECT tokens.* EXCLUDE (token, x), 1.0::DOUBLE AS x, j"
    )
    sql = base + _params(cfg, w0) + _with_state(cfg) + _shards(cfg, "example_id % 5 <> 0")
    for epoch in range(1, cfg.epochs + 1):
        sql += _epoch(cfg, f"p{epoch - 1}", f"p{epoch}")
    parts = []
    for epoch in range(cfg.epochs + 1):
        sql += _scored(cfg.k2, f"p{epoch}", f"scored{epoch}") + _metrics(f"scored{epoch}", f"m{epoch}")
        columns = ", ".join(
            _r(f"max({metric}) FILTER (split = '{split}')", f"{split}_{metric}")
            for split, metric in [
                ("train", "log_loss"), ("valid", "log_loss"), ("train", "auc"), ("valid", "auc"),
                ("train", "pos_mean"), ("train", "neg_mean"), ("valid", "pos_mean"), ("valid", "neg_mean"),
            ]
        )
        parts.append(f"SELECT {epoch}::INTEGER AS epoch, {columns} FROM m{epoch}")
    return sql + " " + " UNION ALL ".join(parts)


def _epochs(cfg: FMConfig, tokens: str = _ORDERS) -> str:
    """CTEs up to ``p0``, ``p1`` .. of all epochs over the training rows."""
    start = _params(cfg, q.START_BIAS if cfg.k0 else None, k1=cfg.k1)
    sql = _base(tokens, recursive=True) + start + _with_state(cfg) + _shards(cfg, "example_id % 5 <> 0")
    return sql + "".join(_epoch(cfg, f"p{e - 1}", f"p{e}", e) for e in range(1, cfg.epochs + 1))


def _health() -> str:
    cfg = q.HISTORY
    names = ["w", *(f"v_{f}" for f in _fs(cfg.k2))]
    parts = []
    for epoch in range(cfg.epochs + 1):
        values = " UNION ALL ".join(f"SELECT {c} AS value FROM p{epoch}{'' if c == 'w' else ' WHERE j > 0'}" for c in names)
        parts.append(
            f"SELECT {epoch}::INTEGER AS epoch, count(*) AS n_values, count(*) FILTER (isnan(value)) AS n_nan, "
            f"{_r('min(value)', 'min_value')}, {_r('max(value)', 'max_value')} FROM ({values})")
    return _epochs(cfg) + " " + " UNION ALL ".join(parts)


def _trained(cfg: FMConfig, tokens: str) -> str:
    """Parameters after the last epoch."""
    sql = _epochs(cfg, tokens)
    columns = ", ".join([*([_r("w", "w")] if cfg.k1 else []), *(_r(f"CASE WHEN j > 0 THEN v_{f} END", f"v_{f}") for f in _fs(cfg.k2))])
    return f"{sql} SELECT j, {columns} FROM p{cfg.epochs}"


def _gradient() -> str:
    cfg = q.SCORE
    k = cfg.k2
    r0, r1, r2 = (f"{r}::DOUBLE" for r in cfg.reg)
    s = ", ".join(f"s_{f}" for f in _fs(k))
    gv = ", ".join(
        f"sum((s_{f} * x - v_{f} * x * x) * res + {r2} * v_{f}) AS gv_{f}" for f in _fs(k)
    )
    return (
        _base() + _params(cfg) + _scored(k)
        + f""",
active AS (
  SELECT example_id, j, x FROM ex UNION ALL SELECT example_id, 0, 1.0::DOUBLE FROM row_labels),
terms AS (
  SELECT a.j, a.x, score - label AS res, {s}, m.* EXCLUDE (j)
  FROM active a JOIN scored USING (example_id) JOIN p m ON m.j = a.j),
g AS (
  SELECT j, sum(x * res + CASE WHEN j = 0 THEN {r0} ELSE {r1} END * w) AS gw, {gv} FROM terms GROUP BY j)
SELECT j, {_flat_columns(k, (("gw", "gv"),))} FROM g"""
    )


def _known() -> str:
    """CTE ``known``: the parameters of features that a training document holds, and the bias."""
    return ",\nknown AS (SELECT * FROM p WHERE j = 0 OR j IN (SELECT j FROM ex WHERE example_id % 5 <> 0))"


def _price_scores() -> str:
    cfg = q.SCORE.with_(init_std=1.0)
    bounds = ("(SELECT min(price) FROM row_labels)", "(SELECT max(price) FROM row_labels)")
    return _base() + _params(cfg) + _scored(cfg.k2, clip=bounds, label="price")


def oracle_sql() -> dict[str, str]:
    k = q.SCORE.k2
    orders, documents = _base(), _base(_DOCUMENTS)
    scored = orders + _params(q.SCORE) + _scored(k)
    evaluated = scored + _metrics("scored", "m")
    wide = ", ".join(f"v_{f}" for f in _fs(k))
    lines = "string_agg({item}, ' ' ORDER BY j)"
    pair = "j || ':' || x::BIGINT"
    values = " UNION ALL ".join(
        ["SELECT w AS value FROM p", *(f"SELECT v_{f} FROM p WHERE j > 0" for f in _fs(k))]
    )
    flat = " UNION ALL ".join(
        [
            f"SELECT CASE WHEN j > 0 THEN n * {k} + j - 1 ELSE n * {k} + n END AS place, w AS value FROM p, size",
            *(f"SELECT (j - 1) * {k} + {f}, v_{f} FROM p WHERE j > 0" for f in _fs(k)),
        ]
    )
    exported = "printf('%.6f', {0})"
    preview = ", ".join(
        f"{s} AS (SELECT * FROM listed WHERE split = '{s}' ORDER BY example_id LIMIT 3)" for s in ("train", "valid")
    )
    return {
        "fm_examples_long": orders + " SELECT example_id, label, j, x FROM ex",
        "document_words_long": documents + " SELECT example_id, label, j, x FROM ex",
        "label_binarise": "SELECT o_orderkey AS example_id, CASE WHEN o_totalprice / 100000.0::DOUBLE - 1.5::DOUBLE > 0 "
        "THEN 1.0 ELSE 0.0 END::DOUBLE AS label FROM orders JOIN customer ON o_custkey = c_custkey",
        "libsvm_encode": documents + f"""
SELECT example_id, concat_ws(' ', label::BIGINT, {lines.format(item=pair)} FILTER (j IS NOT NULL)) AS value
FROM row_labels LEFT JOIN ex USING (example_id, label) GROUP BY example_id, label""",
        "libsvm_scan": documents + f"""
SELECT label, count(j)::INTEGER AS n_nonzero,
       coalesce({lines.format(item=pair)} FILTER (j IS NOT NULL), '') AS features
FROM row_labels LEFT JOIN ex USING (example_id, label) GROUP BY example_id, label""",
        "vector_scan": documents + f"""
SELECT label, count(j)::INTEGER AS n_nonzero,
       coalesce({lines.format(item=pair)} FILTER (j IS NOT NULL), '') AS features
FROM row_labels LEFT JOIN ex USING (example_id, label) GROUP BY example_id, label""",
        "shard_profile": orders + f"""
SELECT (example_id % {q.NUM_SHARDS})::INTEGER AS shard, count(DISTINCT example_id) AS n_rows, count(*) AS n_nonzero,
       count(DISTINCT example_id) FILTER (label > 0) AS n_pos, count(DISTINCT j) AS n_distinct
FROM ex GROUP BY 1""",
        "sample_preview": orders + f""",
listed AS (
  SELECT {_SPLIT} AS split, example_id, label, {lines.format(item='j::VARCHAR')} AS features
  FROM ex GROUP BY example_id, label),
{preview}
SELECT * FROM train UNION ALL SELECT * FROM valid""",
        "score_preview": scored + f" SELECT example_id, label, {_r('score', 'score')} FROM scored ORDER BY example_id LIMIT 10",
        "dataset_stats": _stats(_ORDERS),
        "document_stats": _stats(_DOCUMENTS),
        "label_range": f"""SELECT {_r('min(o_totalprice / 100000.0::DOUBLE)', 'label_min')},
{_r('max(o_totalprice / 100000.0::DOUBLE)', 'label_max')} FROM orders JOIN customer ON o_custkey = c_custkey""",
        "value_guard": documents + """
SELECT example_id, count(*)::INTEGER AS n_bad FROM ex WHERE x <> 1.0 GROUP BY example_id""",
        "unseen_features": documents + """
SELECT j, count(*) AS n_rows FROM ex WHERE example_id % 5 = 0
AND j NOT IN (SELECT j FROM ex WHERE example_id % 5 <> 0) GROUP BY j""",
        "dimension_guard": documents + """,
english AS (SELECT doc_id FROM documents WHERE lang = 'en')
SELECT example_id, max(j) AS max_index FROM ex WHERE example_id NOT IN (FROM english) GROUP BY example_id
HAVING max(j) > (SELECT max(j) FROM ex WHERE example_id IN (FROM english))""",
        "fm_init": orders + _params(q.SCORE, 0.0) + f" SELECT j, {_flat_columns(k, digits=9)} FROM p",
        "model_meta": orders + f"""
SELECT 0::INTEGER AS task, true AS k0, true AS k1, {k}::INTEGER AS k2, (SELECT max(j) FROM vocab)::INTEGER AS n_features,
       {_r('min(price)', 'label_min')}, {_r('max(price)', 'label_max')} FROM row_labels""",
        "model_parts": orders + _params(q.SCORE) + f"""
SELECT 'w0' AS part, j, {_r('w', 'value')} FROM p WHERE j = 0
UNION ALL SELECT 'w', j, {_r('w', 'value')} FROM p WHERE j > 0
""" + " ".join(f"UNION ALL SELECT 'v_{f}', j, {_r(f'v_{f}', 'value')} FROM p WHERE j > 0" for f in _fs(k)),
        "param_health": orders + _params(q.SCORE) + f"""
SELECT count(*) AS n_values, count(*) FILTER (isnan(value)) AS n_nan, {_r('min(value)', 'min_value')},
       {_r('max(value)', 'max_value')} FROM ({values})""",
        "param_edges": orders + _params(q.SCORE) + f""",
size AS (SELECT max(j)::BIGINT AS n FROM vocab), flat AS ({flat})
SELECT place::BIGINT AS place, {_r('value', 'value')} FROM flat, size
WHERE place < 20 OR (place >= n * {k + 1} - 20 AND place < n * {k + 1})""",
        "fm_score_linear": scored + f" SELECT example_id, label, {_r('linear', 'linear')} FROM scored",
        "fm_score_factors": scored + f" SELECT example_id, {_r('raw - linear', 'pairwise')}, "
        + ", ".join(_r(f"s_{f}", f"s_{f}") for f in _fs(k)) + " FROM scored",
        "fm_predict": scored + _SCORED_OUT,
        "fm_predict_sharded": scored + _SCORED_OUT,
        "fm_predict_documents": documents + _params(q.LOCAL) + _scored(q.LOCAL.k2) + _SCORED_OUT,
        "fm_predict_unseen": documents + _params(q.LOCAL) + _known() + _scored(q.LOCAL.k2, "known") + _SCORED_OUT + " WHERE example_id % 5 = 0",
        "fm_predict_terms_off": orders + _params(q.SCORE, None, k1=False) + _scored(k, k0=False) + _SCORED_OUT,
        "fm_predict_regression": _price_scores() + _SCORED_OUT,
        "fm_gradient": _gradient(),
        "sgd_local_epoch": _local_epoch("sgd"),
        "adam_local_epoch": _local_epoch("adam"),
        "rmsprop_local_epoch": _local_epoch("rmsprop"),
        "adam_local_epoch_runs": _local_epoch("adam"),
        "adam_local_epoch_weighted": _local_epoch("adam", "label_weighted"),
        "rmsprop_local_epoch_weighted": _local_epoch("rmsprop", "label_weighted"),
        "fm_log_loss": evaluated + f" SELECT split, n_pos + n_neg AS n_rows, {_r('log_loss', 'log_loss')} FROM m",
        "fm_auc": evaluated + f" SELECT split, n_pos, n_neg, {_r('auc', 'auc')} FROM m",
        "fm_class_means": evaluated
        + f" SELECT split, n_pos, n_neg, {_r('pos_mean', 'pos_mean')}, {_r('neg_mean', 'neg_mean')} FROM m",
        "fm_evaluate": evaluated + " SELECT split, n_pos, n_neg, "
        + ", ".join(_r(c, c) for c in ("log_loss", "auc", "pos_mean", "neg_mean")) + " FROM m",
        "fm_evaluate_lines": evaluated + " SELECT concat_ws('  ', split, "
        + ", ".join(f"printf('%.5f', round({c}, 6))" for c in ("log_loss", "auc", "pos_mean", "neg_mean"))
        + ") AS line FROM m",
        "fm_regression_metrics": _price_scores() + f"""
SELECT {_SPLIT} AS split, count(*) AS n_rows, {_r('sqrt(avg((score - label) * (score - label)))', 'rmse')},
       {_r('avg(abs(score - label))', 'mae')} FROM scored GROUP BY 1""",
        "fm_train_history": _history(q.HISTORY),
        "fm_train_documents": _history(q.DOCUMENTS, _DOCUMENTS, 0.0),
        "fm_train_health": _health(),
        "fm_train_regression": _trained(q.REGRESSION, _PRICES),
        "fm_train_terms_off": _trained(q.TERMS_OFF, _ORDERS),
        "history_sink": _history(q.DOCUMENTS, _DOCUMENTS, 0.0),
        "export_twice": orders + _params(q.SCORE) + f" SELECT j, {_flat_columns(k, digits=9)} FROM p",
        "rmsprop_two_epochs": _local_epoch("rmsprop", epochs=2),
        "adam_local_epoch_standard": _local_epoch("adam", bias_correction="standard"),
        "adam_two_epochs_standard": _local_epoch("adam", epochs=2, bias_correction="standard"),
        "libsvm_train": _trained(q.HISTORY, _LINES),
        "fm_export_lines": orders + _params(q.SCORE) + f"""
SELECT 'w_' || j || ' ' || {exported.format('w')} AS value FROM p
UNION ALL
SELECT 'v_' || j || ' ' || concat_ws(' ', {', '.join(exported.format(f'v_{f}') for f in _fs(k))}) FROM p WHERE j > 0""",
        "fm_export_read": orders + _params(q.SCORE) + f" SELECT j, {_flat_columns(k, digits=9)} FROM p",
    }
