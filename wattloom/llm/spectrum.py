"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The signs of D in P(A - sI)P' = LDL' say how many eigenvalues lie above the shift s (Sylvester's law of inertia).
Counts at shifts isolate the k-th largest eigenvalue, Rayleigh quotient iteration then converges cubically from
inside the interval, and counts on both sides of the result certify that it is the k-th. The matrix is one of
dimensions, never of rows, so this runs wherever it fits.
"""

from __future__ import annotations

import numpy as np

# Bound on the growth of pivots: 2 x 2 blocks are taken below this share of the largest entry of a column.
_ALPHA = (1 + 17**0.5) / 8


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: the positive ones in D of LDL' with diagonal pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(a):
        sizes = np.abs(a)
        diagonal = sizes.diagonal().copy()
        np.fill_diagonal(sizes, 0.0)
        top, far = int(diagonal.argmax()), int(sizes.argmax())
        if diagonal[top] >= _ALPHA * sizes.flat[far]:
            if diagonal[top] == 0.0:
                return positive  # what is left is zero
            chosen = [top]
        else:
            chosen = list(np.unravel_index(far, sizes.shape))
        rest = np.delete(np.arange(len(a)), chosen)
        pivot, side = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        # A 2 x 2 block that is taken has a negative determinant: one eigenvalue of each sign.
        positive += int(pivot[0, 0] > 0) if len(chosen) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
    return positive


def _refined(matrix: np.ndarray, low: float, high: float, found: list[np.ndarray], draw: np.random.Generator) -> tuple[float, np.ndarray]:
    """An eigenpair by Rayleigh quotient iteration, orthogonal to those found, from the middle of an interval."""
    size, scale = len(matrix), max(abs(low), abs(high), float(np.abs(matrix).max()))

    def clear(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in found:
                v = v - (other @ v) * other
        return v / np.linalg.norm(v)

    vector, shift = clear(draw.standard_normal(size)), (low + high) / 2
    best = np.inf, vector, shift
    for step in range(40):
        solved = None
        for nudge in (0.0, 2.0**-50, 2.0**-44):
            try:
                solved = np.linalg.solve(matrix - (shift + nudge * scale) * np.eye(size), vector)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(solved).all() and np.linalg.norm(solved) > 0:
                break
        if solved is None:
            break
        vector = clear(solved / np.abs(solved).max())
        quotient = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - quotient * vector))
        if residual >= best[0] and residual <= 2.0**-40 * scale:
            break  # as exact as it gets
        if residual < best[0]:
            best = residual, vector, quotient
        # The first steps hold the shift, so that the vector settles on the interval's eigenvalue.
        shift = quotient if step >= 2 and low <= quotient <= high else shift
    return best[2], best[1]


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors, a row each.

    Eigenvalues that are not positive within rounding are left out. Of a multiple eigenvalue the vectors are an
    orthonormal basis. The largest entry of a vector is positive. Raises if the counts don't certify a number.
    """
    matrix = (matrix + matrix.T) / 2
    size, trace = len(matrix), float(np.trace(matrix))
    tiny = size * 2.0**-50 * max(trace, 0.0)
    # Gershgorin: no eigenvalue is above this.
    roof = float(np.abs(matrix).sum(axis=1).max()) * (1 + 2.0**-40) if size else 0.0
    counted = {roof: 0}

    def above(shift: float) -> int:
        if shift not in counted:
            counted[shift] = count_above(matrix, shift)
        return counted[shift]

    values, vectors, draw = [], [], np.random.default_rng(12)
    positive = above(tiny) if trace > 0 else 0
    for number in range(1, min(k, positive) + 1):
        # Counts that were taken for earlier ones bound this one too.
        low = max(s for s, n in counted.items() if n >= number)
        high = min(s for s, n in counted.items() if n < number)
        slack = 2.0**-36 * roof
        while True:
            # Slice until the interval has the wanted eigenvalue alone, or one that is multiple within rounding.
            while high - low > slack:
                if above(low) == number and above(high) == number - 1 and high - low < 0.05 * high:
                    break
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= number else (low, middle)
            value, vector = _refined(matrix, low, high, vectors, draw)
            edge = 2.0**-40 * roof + tiny
            if above(value + edge) < number <= above(value - edge):
                break
            if high - low <= slack:
                raise ArithmeticError(f"eigenvalue {number} was not certified")
            slack = 0.0 if slack <= 2.0**-50 * roof else slack * 2.0**-8
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        values.append(value)
        vectors.append(vector * (1 if vector[np.abs(vector).argmax()] > 0 else -1))
    return np.array(values), np.array(vectors).reshape(len(vectors), size)
