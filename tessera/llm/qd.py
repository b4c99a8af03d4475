"""Singular values and right singular vectors of a small square matrix by quotient-difference
steps: Householder bidiagonalisation, dqds for the values, twisted factorisations for the
vectors.  The size of the matrix is the number of dimensions, never the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny / EPS
#: Eigenvalues closer than this, relative to their size, get a representation of their own.
GAP = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, v): ``r = u B v.T`` with B upper bidiagonal, diagonal a and superdiagonal b.
    The left factor is not needed for directions and not kept."""
    r, n = np.array(r, float), len(r)
    v = np.eye(n)

    def mirror(x: np.ndarray) -> tuple[np.ndarray, float]:
        """(w, beta) with (I - beta w w') x along the first axis."""
        w, rest = x.copy(), float(np.dot(x[1:], x[1:]))
        if rest == 0.0:
            return w, 0.0
        w[0] += np.copysign(np.sqrt(x[0] * x[0] + rest), x[0])
        return w, 2.0 / float(np.dot(w, w))

    for k in range(n):
        w, beta = mirror(r[k:, k])
        r[k:, k:] -= beta * np.outer(w, w @ r[k:, k:])
        if k < n - 2:
            w, beta = mirror(r[k, k + 1:])
            r[k:, k + 1:] -= beta * np.outer(r[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= beta * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(r).copy(), np.diag(r, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential step: the squares of the bidiagonal factor after ``shift`` is taken
    from all eigenvalues, and the differences d; it ends at the first negative d, which means
    that the shift was too large."""
    d = q[0] - shift
    ds, qn, en = [d], [], []
    for i in range(len(e)):
        if d < 0.0:
            return qn, en, ds
        p = (d + e[i]) or TINY
        t = q[i + 1] / p
        qn.append(p)
        en.append(e[i] * t)
        d = d * t - shift
        ds.append(d)
    qn.append(d)
    return qn, en, ds


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, each to high relative
    accuracy: only products, quotients and sums of positive numbers touch them."""
    out = []
    work = [(list(map(float, a * a)), list(map(float, b * b)), 0.0)]
    tol = (10 * EPS) ** 2
    while work:
        q, e, sigma = work.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e)) if e[i] <= tol * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None and cut < len(e) - 1:  # two matrices of their own
                work.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if e[-1] <= tol * (sigma + q[-1]):
                out.append(sigma + q.pop())
                e.pop()
                continue
            if q[0] < q[-1] * 0.5:  # small values leave at the end
                q.reverse()
                e.reverse()
            # smaller eigenvalue of the last two rows, as a first guess
            x, y, z = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            mid, half = (x + y) / 2, np.hypot((x - y) / 2, np.sqrt(z))
            least = q[-2] * q[-1] + (e[-2] * (q[-1] + e[-1]) if len(e) > 1 else 0.0)
            shift = min(least / (mid + half), q[-1], q[-2]) * (1 - 1e-8) if mid + half > 0 else 0.0
            for attempt in range(4):
                shift = 0.0 if attempt == 3 else shift
                qn, en, ds = _dqds(q, e, shift)
                if shift == 0.0 or ds[-1] >= 0.0:
                    break
                late = len(ds) == len(q)  # only the last one is negative: it says by how much
                shift = max(0.0, (shift + ds[-1]) * (1 - 4 * EPS)) if late and attempt == 0 else shift / 4
            if shift == 0.0:
                qn[-1] = max(qn[-1], 0.0)
            q, e, sigma = qn, en, sigma + shift
        out.extend(sigma + x for x in q)
    return np.sort(np.array(out))[::-1]


def _stationary(d: np.ndarray, l: np.ndarray, x: float):
    """L D L' - x = L+ D+ L+': (d+, l+, s), s being what each pivot has beyond d."""
    n = len(d)
    dp, lp, s = np.empty(n), np.empty(n - 1), np.empty(n)
    s[0] = -x
    for i in range(n - 1):
        dp[i] = s[i] + d[i] or TINY
        lp[i] = d[i] * l[i] / dp[i]
        s[i + 1] = lp[i] * l[i] * s[i] - x
        if not np.isfinite(s[i + 1]):
            s[i + 1] = d[i] * l[i] * l[i] - x
    dp[-1] = s[-1] + d[-1] or TINY
    return dp, lp, s


def _progressive(d: np.ndarray, l: np.ndarray, x: float):
    """L D L' - x = U- D- U-': (u-, p)."""
    n = len(d)
    um, p = np.empty(n - 1), np.empty(n)
    p[-1] = d[-1] - x
    for i in range(n - 2, -1, -1):
        dm = d[i] * l[i] * l[i] + p[i + 1] or TINY
        t = d[i] / dm
        um[i] = l[i] * t
        p[i] = p[i + 1] * t - x
        if not np.isfinite(p[i]):
            p[i] = d[i] - x
    return um, p


def _count_below(d: np.ndarray, l: np.ndarray, x: float) -> int:
    """Number of eigenvalues of L D L' below ``x``."""
    return int(np.sum(_stationary(d, l, x)[0] < 0))


def _refine(d: np.ndarray, l: np.ndarray, rank: int, guess: float, width: float) -> float:
    """The eigenvalue with ``rank`` smaller ones, by bisection to full relative accuracy."""
    lo, hi = guess - width, guess + width
    while _count_below(d, l, lo) > rank:
        lo -= width
        width *= 2
    while _count_below(d, l, hi) <= rank:
        hi += width
        width *= 2
    while hi - lo > 4 * EPS * max(abs(lo), abs(hi)) + TINY:
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (lo, mid) if _count_below(d, l, mid) > rank else (mid, hi)
    return (lo + hi) / 2


def _twisted(d: np.ndarray, l: np.ndarray, x: float) -> tuple[np.ndarray, float]:
    """Unit vector of the eigenvalue next to ``x`` and that eigenvalue: both factorisations meet
    in the row where the remaining pivot is smallest."""
    n = len(d)
    for _ in range(4):
        _, lp, s = _stationary(d, l, x)
        um, p = _progressive(d, l, x)
        gamma = s + p + x
        r = int(np.argmin(np.abs(gamma)))
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -lp[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -um[i] * z[i]
        size = float(np.dot(z, z))
        step = gamma[r] / size
        if abs(step) <= 4 * EPS * abs(x):
            break
        x += step
    return z / np.sqrt(size), x


def _vectors(d: np.ndarray, l: np.ndarray, values: np.ndarray, ranks: np.ndarray, depth: int) -> np.ndarray:
    """Columns: unit vectors of the eigenvalues (falling) of L D L'.  Values that are close to
    each other are moved next to zero, where their differences are large against their size."""
    out = np.empty((len(d), len(values)))
    at = 0
    while at < len(values):
        end = at + 1
        while end < len(values) and abs(values[end - 1] - values[end]) <= GAP * max(abs(values[end - 1]), abs(values[end])):
            end += 1
        if end - at == 1 or depth == 8:
            for k in range(at, end):
                out[:, k] = _twisted(d, l, values[k])[0]
        else:
            group, spread = values[at:end], values[at] - values[end - 1]
            margin = max(spread * 0.5, 16 * EPS * abs(values[at]))
            # the factorisation that grows least, with all of the group on one side of zero
            _, dp, lp, shift = min(((np.max(np.abs(f[0])), f[0], f[1], x) for x in
                                    (values[at] + margin, values[end - 1] - margin)
                                    for f in [_stationary(d, l, x)]), key=lambda c: c[0])
            moved = np.array([_refine(dp, lp, rank, v - shift, margin + TINY)
                              for v, rank in zip(group, ranks[at:end])])
            out[:, at:end] = _vectors(dp, lp, moved, ranks[at:end], depth + 1)
        at = end
    return out


def right_singular(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(squares of all singular values, falling; the first ``count`` right singular vectors as
    columns)."""
    n = len(r)
    a, b, v = bidiagonalise(r)
    scale = max(np.max(np.abs(a), initial=0.0), np.max(np.abs(b), initial=0.0))
    if n == 0 or scale == 0.0:
        return np.zeros(n), np.eye(n)[:, :count]
    a, b = a / scale, b / scale
    # a diagonal entry below this stands for an exact zero of the rank
    a = np.where(np.abs(a) < EPS * EPS, EPS * EPS, a)
    cuts = [0, *(i + 1 for i in range(n - 1) if abs(b[i]) <= EPS * EPS * min(abs(a[i]), abs(a[i + 1]))), n]
    found = []
    for lo, hi in zip(cuts, cuts[1:]):
        values = squared_singular_values(a[lo:hi], b[lo:hi - 1])
        found.extend((value, lo, hi, k) for k, value in enumerate(values))
    found.sort(key=lambda f: -f[0])
    take = min(count, n)
    # the group of the last one is completed, so that its members are told apart together
    while take < n and found[take - 1][0] - found[take][0] <= GAP * found[take - 1][0]:
        take += 1
    z = np.zeros((n, take))
    for lo, hi in {(f[1], f[2]) for f in found[:take]}:
        mine = [(i, f) for i, f in enumerate(found[:take]) if (f[1], f[2]) == (lo, hi)]
        d, l = a[lo:hi] ** 2, b[lo:hi - 1] / a[lo:hi - 1]
        values = np.array([f[0] for _, f in mine])
        ranks = np.array([hi - lo - 1 - f[3] for _, f in mine])
        z[lo:hi, [i for i, _ in mine]] = _vectors(d, l, values, ranks, 0)
    return np.array([f[0] for f in found]) * scale * scale, (v @ z)[:, :count]
