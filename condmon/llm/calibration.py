"""Small logistic models, fitted with numpy on bounded samples."""

from __future__ import annotations


def fit_platt(x, y, weight, ridge: float = 1e-3, rounds: int = 50):
    """Weighted logistic regression by Newton steps on standardised inputs;
    returns (mean, scale, coefficients with the intercept last)."""
    import numpy as np

    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-12
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    # soft targets keep a separable sample finite
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    beta = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (weight * (t - p)) - ridge * beta
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(z.shape[1])
        step = np.linalg.solve(hess, grad)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return mean, scale, beta


def apply_platt(model, x):
    """Probabilities; a NaN input counts as the mean of its column."""
    import numpy as np

    mean, scale, beta = model
    z = np.nan_to_num((x - mean) / scale) @ beta[:-1] + beta[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
