"""Plain sequential versions of the clustering operators, to check against on small inputs."""

from __future__ import annotations

import numpy as np


def distances(x):
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


def dbscan(x, eps, min_samples):
    """Rows in key order; clusters numbered by their first core row, borders to the lowest cluster."""
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= min_samples
    label = np.full(len(x), -1)
    number = 0
    for i in range(len(x)):
        if not core[i] or label[i] != -1:
            continue
        stack, label[i] = [i], number
        while stack:
            for j in np.flatnonzero(near[stack.pop()] & core & (label == -1)):
                label[j] = number
                stack.append(j)
        number += 1
    for i in np.flatnonzero(~core):
        reached = label[near[i] & core]
        if len(reached):
            label[i] = reached.min()
    return label


def silhouette(x, labels):
    d, out = distances(x), []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def davies_bouldin(x, labels):
    names = sorted(set(labels))
    centres = [x[labels == n].mean(axis=0) for n in names]
    spread = [np.sqrt(((x[labels == n] - c) ** 2).sum(axis=1)).mean() for n, c in zip(names, centres)]
    worst = [
        max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(len(names)) if j != i)
        for i in range(len(names))
    ]
    return float(np.mean(worst))
