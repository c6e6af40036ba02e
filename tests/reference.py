"""A plain, row-by-row restatement of the formulas, used to check the Spark results."""

import numpy as np


def score_raw(theta, row, k0, k1):
    """theta: {j: (w, v)}; row: [(j, x)]."""
    z = theta[0][0] if k0 else 0.0
    z += sum(theta[j][0] * x for j, x in row) if k1 else 0.0
    known = [(theta[j][1], x) for j, x in row]
    for a in range(len(known)):
        for b in range(a + 1, len(known)):
            z += float(known[a][0] @ known[b][0]) * known[a][1] * known[b][1]
    return z


def local_epoch(params, rows, cfg, label_range=None):
    """params: {j: [w, v...]} arrays; rows: [(id, y, [(j, x)])]. Mean over all shards."""
    slots = {"sgd": 0, "adam": 2, "rmsprop": 1}[cfg.optimizer]
    start = {j: [np.array(a, float)] + [np.zeros(1 + cfg.k2) for _ in range(slots)] for j, a in params.items()}
    total = {j: [part * 0.0 for part in parts] for j, parts in start.items()}
    for shard in range(cfg.num_shards):
        own = {j: [part.copy() for part in parts] for j, parts in start.items()}
        for _, y, row in sorted(r for r in rows if r[0] % cfg.num_shards == shard):
            z = score_raw({j: (p[0][0], p[0][1:]) for j, p in own.items()}, row, cfg.k0, cfg.k1)
            if cfg.task == 1:
                p = 1.0 / (1.0 + np.exp(-z))
                m = p - y
                if cfg.residual == "label_weighted" and cfg.optimizer != "sgd":
                    m = -y * (1.0 - 1.0 / (1.0 + np.exp(-y * p)))
            else:
                m = min(max(z, label_range[0]), label_range[1]) - y
            s = sum((own[j][0][1:] * x for j, x in row), np.zeros(cfg.k2))
            grads = {}
            if cfg.k0:
                grads[0] = np.r_[m + cfg.reg[0] * own[0][0][0], np.zeros(cfg.k2)]
            for j, x in row:
                w, v = own[j][0][0], own[j][0][1:]
                gw = x * m + cfg.reg[1] * w if cfg.k1 else 0.0
                grads[j] = np.r_[gw, (s * x - v * x * x) * m + cfg.reg[2] * v]
            for j, g in grads.items():
                a = own[j]
                if cfg.optimizer == "sgd":
                    a[0] = np.clip(a[0] - cfg.step_size * g / np.sqrt(g * g + 1), -20, 20)
                elif cfg.optimizer == "adam":
                    a[1] = 0.9 * a[1] + 0.1 * g
                    a[2] = 0.999 * a[2] + 0.001 * g * g
                    a[0] = a[0] - cfg.step_size * (a[1] / 0.1) / (np.sqrt(a[2] / 0.001) + 1e-8)
                else:
                    a[1] = 0.99 * a[1] + 0.01 * g * g
                    a[0] = a[0] - cfg.step_size * g / np.sqrt(a[1] + 1e-8)
        for j, parts in own.items():
            for t, part in zip(total[j], parts):
                t += part / cfg.num_shards
    return total
