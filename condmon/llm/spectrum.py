"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

``below`` counts the eigenvalues under a shift from the signs of the pivots of
an LDLᵀ factorisation of the shifted matrix (Sylvester's law of inertia), with
1x1 and 2x2 pivots, so a zero on the diagonal does no harm.  ``leading`` cuts
the line with such counts until the i-th largest eigenvalue is alone in its
slice, or the slice is as narrow as rounding allows (equal eigenvalues).  In
the slice, one step of inverse iteration and then Rayleigh quotient iteration
find the pair; the quotient converges cubically.  If it leaves the slice the
slice is cut further.  Two counts beside the result certify its number.

The matrix has one row per dimension; a count takes time cubic in it.
"""

from __future__ import annotations

_ALPHA = (1 + 17**0.5) / 8


def below(a, shift: float) -> int:
    """Number of eigenvalues of ``a`` less than ``shift``."""
    import numpy as np

    n = len(a)
    m = a - shift * np.eye(n)
    negative = k = 0
    while k < n:
        if k == n - 1:
            return negative + int(m[k, k] < 0)
        column = np.abs(m[k + 1 :, k])
        r = k + 1 + int(column.argmax())
        most, own = column[r - k - 1], abs(m[k, k])
        single, swap = True, None
        if most == 0:  # nothing to eliminate
            negative += int(m[k, k] < 0)
            k += 1
            continue
        if own < _ALPHA * most:
            row = np.abs(m[r, k:])
            row[r - k] = 0
            far = row.max()
            if own * far < _ALPHA * most * most:
                if abs(m[r, r]) >= _ALPHA * far:
                    swap = k
                else:
                    swap, single = k + 1, False
        if swap is not None and swap != r:
            m[[swap, r], k:] = m[[r, swap], k:]
            m[k:, [swap, r]] = m[k:, [r, swap]]
        if single:
            v = m[k + 1 :, k].copy()
            negative += int(m[k, k] < 0)
            m[k + 1 :, k + 1 :] -= np.outer(v, v / m[k, k])
            k += 1
        else:  # such a block has one negative and one positive eigenvalue
            c = m[k + 2 :, k : k + 2].copy()
            m[k + 2 :, k + 2 :] -= c @ np.linalg.solve(m[k : k + 2, k : k + 2], c.T)
            negative += 1
            k += 2
    return negative


def _solve(a, shift: float, v, nudge: float):
    import numpy as np

    eye = np.eye(len(a))
    for _ in range(8):
        try:
            x = np.linalg.solve(a - shift * eye, v)
            if np.isfinite(x).all():
                return x / np.linalg.norm(x)
        except np.linalg.LinAlgError:
            pass
        shift += nudge  # exactly singular: the shift is an eigenvalue already
    raise ArithmeticError("no shift near the eigenvalue could be solved")


def leading(a, count: int, floor: float = 0.0):
    """Up to ``count`` largest eigenvalues above ``floor`` (a share of the
    largest) in falling order, and their unit vectors as columns."""
    import numpy as np

    n = len(a)
    size = float(np.abs(a).sum(axis=1).max()) if n else 0.0
    if size == 0.0:
        return np.zeros(0), np.zeros((n, 0))
    fine = 8 * n * np.finfo(float).eps * size
    known: dict[float, int] = {}

    def above(x: float) -> int:
        if x not in known:
            known[x] = n - below(a, x)
        return known[x]

    known[size + fine], known[-size - fine] = 0, n
    rng = np.random.default_rng(0)
    values, vectors = [], np.zeros((n, 0))
    for i in range(1, min(count, n) + 1):
        pair = _nth(a, i, above, known, vectors, fine, rng)
        if pair[0] <= max(floor * (values[0] if values else size), fine):
            break
        values.append(pair[0])
        vectors = np.column_stack([vectors, pair[1]])
    order = np.argsort([-v for v in values], kind="stable")
    return np.array(values)[order], vectors[:, order]


def _nth(a, i, above, known, found, fine, rng):
    """The i-th largest eigenvalue and a vector orthogonal to ``found``."""
    import numpy as np

    low = max(x for x, c in known.items() if c >= i)
    high = min(x for x, c in known.items() if c < i)
    while not (above(low) == i and above(high) == i - 1) and high - low > fine:
        mid = (low + high) / 2
        low, high = (mid, high) if above(mid) >= i else (low, mid)
    while True:
        mid = (low + high) / 2
        v = rng.standard_normal(len(a))
        for _ in range(2):
            v = _apart(_solve(a, mid, _apart(v, found), fine), found)
        value = v @ a @ v
        for _ in range(12):
            rest = np.linalg.norm(a @ v - value * v)
            if rest <= fine / 4 or not low - fine <= value <= high + fine:
                break
            v = _apart(_solve(a, value, v, fine), found)
            value = v @ a @ v
        slack = max(4 * rest, fine)
        if rest <= fine and above(value - slack) >= i and above(value + slack) < i:
            v = _apart(_solve(a, value + fine / 64, v, fine), found)
            return float(v @ a @ v), v
        if high - low <= fine / 16:
            raise ArithmeticError(f"eigenvalue {i} could not be certified")
        low, high = (mid, high) if above(mid) >= i else (low, mid)


def _apart(v, found):
    """``v`` of length one and without its parts along ``found``."""
    import numpy as np

    for _ in range(2):
        v = v - found @ (found.T @ v)
        v = v / np.linalg.norm(v)
    return v
