"""A gated recurrent layer in numpy: forward, back-propagation, and Adam."""

from __future__ import annotations

import numpy as np

F32 = np.float32
CHUNK = 1 << 13


def sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * np.tanh(F32(0.5) * x) + F32(0.5)


def forward(gates: np.ndarray, u: np.ndarray, h: np.ndarray, fresh: np.ndarray | None = None, keep: bool = False):
    """States of ``gates`` (time, lane, 3 * width: update, reset, candidate)
    from state ``h``.  Where ``fresh`` (time, lane) is true the state is reset
    first.  With ``keep`` also what ``backward`` needs.

    Inside, each gate of a step is one block, a step writes into arrays made
    once, and the half that ``sigmoid`` takes of its input is taken for the
    whole window: a power of two, so every bit is as if taken step by step.
    """
    steps, lanes, _ = gates.shape
    width = u.shape[0]
    parts = np.array(gates.reshape(steps, lanes, 3, width).transpose(0, 2, 1, 3), order="C")
    parts[:, :2] *= F32(0.5)
    u = u.copy()
    u[:, :2 * width] *= F32(0.5)
    states, first = np.empty((steps, lanes, width), F32), h
    held = steps if keep else 1
    a, zr, n = np.empty((held, lanes, 3 * width), F32), np.empty((held, 2, lanes, width), F32), np.empty((held, lanes, width), F32)
    by_gate = a.reshape(held, lanes, 3, width).transpose(0, 2, 1, 3)
    begins = np.zeros(steps, bool) if fresh is None else fresh.any(axis=1)
    for t, begin in enumerate(begins.tolist()):
        at = t if keep else 0
        zr_t, n_t, out = zr[at], n[at], states[t]
        if begin:
            h = np.where(fresh[t][:, None], F32(0), h)
        np.matmul(h, u, out=a[at])
        np.add(parts[t, :2], by_gate[at, :2], out=zr_t)
        np.tanh(zr_t, out=zr_t)
        zr_t *= F32(0.5)
        zr_t += F32(0.5)
        np.multiply(zr_t[1], by_gate[at, 2], out=n_t)
        n_t += parts[t, 2]
        np.tanh(n_t, out=n_t)
        np.subtract(n_t, h, out=out)
        out *= zr_t[0]
        out += h
        h = out
    if not keep:
        return states
    before = np.concatenate((first[None], states[:-1]))
    if fresh is not None:
        before[fresh] = 0
    return states, (before, zr[:, 0], zr[:, 1], n, by_gate[:, 2])


def backward(d_states: np.ndarray, kept: tuple, u: np.ndarray, fresh: np.ndarray | None = None):
    """Gradients of the gates' inputs and of ``u``; truncated at the first step.

    All factors of a step's own state are taken for the whole window at once;
    the loop only carries the state's gradient back.
    """
    steps, lanes, width = d_states.shape
    h, z, r, n, a_n = kept
    stay = 1 - z
    of_n = z * (1 - n * n)
    factors = np.empty((steps, lanes, 3, width), F32)      # of d_a: update, reset, candidate
    factors[:, :, 0], candidate = (n - h) * z * stay, of_n * r
    factors[:, :, 2] = candidate
    factors[:, :, 1] = candidate * a_n * (1 - r)
    begins = (np.zeros(steps, bool) if fresh is None else fresh.any(axis=1)).tolist()
    d_a, d_h, back = factors, np.empty((steps, lanes, width), F32), np.ascontiguousarray(u.T)    # factors become gradients
    dh, more = np.zeros((lanes, width), F32), np.empty((lanes, width), F32)
    for t in range(steps - 1, -1, -1):
        at, own = d_h[t], d_a[t]
        np.add(dh, d_states[t], out=at)
        own *= at[:, None]
        np.matmul(own.reshape(lanes, 3 * width), back, out=more)
        np.multiply(at, stay[t], out=dh)
        dh += more
        if begins[t]:
            dh[fresh[t]] = 0
    d_u = h.reshape(-1, width).T @ d_a.reshape(-1, 3 * width)
    np.multiply(d_h, of_n, out=d_a[:, :, 2])
    return d_a.reshape(steps, lanes, 3 * width), d_u


def scatter_sum(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``rows`` by ``index`` into ``n`` rows."""
    out = np.zeros((n, rows.shape[1]), F32)
    if len(index):
        if n <= np.iinfo(np.int16).max:                    # sorted by counting
            index = index.astype(np.int16)
        order = np.argsort(index, kind="stable")
        at = index[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        out[at[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Adam:
    """Adam with clipped gradients, a few thousand numbers at a time: they stay in the cache."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        clip = F32(min(1.0, 5.0 / (norm + 1e-9)))
        for k, of_all in grads.items():
            rows = max(1, CHUNK * len(of_all) // max(1, of_all.size))
            for lo in range(0, len(of_all), rows):
                at = slice(lo, lo + rows)
                g, m, v = of_all[at] * clip, self.m[k][at], self.v[k][at]
                step = g - m
                step *= F32(0.1)
                m += step
                np.multiply(g, g, out=step)
                step -= v
                step *= F32(0.001)
                v += step
                np.sqrt(v, out=step)
                step += F32(1e-8)
                np.divide(m, step, out=step)
                step *= F32(scale)
                self.params[k][at] -= step
