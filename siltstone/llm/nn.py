"""A small numpy toolbox: bidirectional LSTM with masks, linear-chain CRF, Adam. Arrays are (time, batch, features)."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]
#: Rows that ``emissions`` adds or drops together.
AT_ONCE = 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm_params(g: np.random.Generator, size: int, hidden: int, name: str) -> Params:
    b = np.zeros(4 * hidden, np.float32)
    b[hidden : 2 * hidden] = 1  # forget gates start open
    return {
        f"{name}x": (g.standard_normal((size, 4 * hidden)) / np.sqrt(size)).astype(np.float32),
        f"{name}h": (g.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32),
        f"{name}b": b,
    }


def bilstm(x: np.ndarray, mask: np.ndarray, p: Params, keep: bool = True):
    """States of both directions at every step, and what the backward pass needs; masked steps pass the state on.

    The directions run side by side on axis 1, the second from the end, so that a step is one call for both.
    """
    x = np.stack([x, x[::-1]], 1)
    mask = np.stack([mask, mask[::-1]], 1)[..., None]
    w, hidden, bias = (np.stack([p[f"f{k}"], p[f"r{k}"]]) for k in "xhb")
    z_in = x @ w + bias[:, None]
    steps, _, n, _ = z_in.shape
    hid = hidden.shape[1]
    h, c = np.zeros((2, n, hid), z_in.dtype), np.zeros((2, n, hid), z_in.dtype)
    out = np.zeros((steps, 2, n, hid), z_in.dtype)
    whole = mask.all((1, 2, 3))
    tape = []
    for t in range(steps):
        z = z_in[t] + h @ hidden
        gates = sigmoid(z[..., : 3 * hid])
        i, f, o = gates[..., :hid], gates[..., hid : 2 * hid], gates[..., 2 * hid :]
        g = np.tanh(z[..., 3 * hid :])
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        if keep:
            tape.append((h, c, i, f, o, g, tc))
        if whole[t]:
            c, h = c_new, o * tc
        else:
            m = mask[t]
            c, h = m * c_new + (1 - m) * c, m * (o * tc) + (1 - m) * h
        out[t] = h
    return np.concatenate([out[:, 0], out[::-1, 1]], 2), (x, mask, whole, tape)


def bilstm_back(d: np.ndarray, kept, p: Params) -> tuple[np.ndarray, Params]:
    x, mask, whole, tape = kept
    hid = d.shape[2] // 2
    d_out = np.stack([d[:, :, :hid], d[::-1, :, hid:]], 1)
    w, hidden = (np.stack([p[f"f{k}"], p[f"r{k}"]]) for k in "xh")
    back = hidden.transpose(0, 2, 1)
    steps, _, n, _ = d_out.shape
    dz = np.zeros((steps, 2, n, 4 * hid), d_out.dtype)
    dh, dc = np.zeros((2, n, hid), d_out.dtype), np.zeros((2, n, hid), d_out.dtype)
    for t in range(steps - 1, -1, -1):
        _, c, i, f, o, g, tc = tape[t]
        dh = dh + d_out[t]
        own, stay = (dh, None) if whole[t] else (dh * mask[t], 1 - mask[t])
        dct = (dc if whole[t] else dc * mask[t]) + own * o * (1 - tc * tc)
        z = dz[t]
        z[..., :hid] = dct * g * i * (1 - i)
        z[..., hid : 2 * hid] = dct * c * f * (1 - f)
        z[..., 2 * hid : 3 * hid] = own * tc * o * (1 - o)
        z[..., 3 * hid :] = dct * i * (1 - g * g)
        dc = dct * f if stay is None else dct * f + dc * stay
        dh = z @ back if stay is None else z @ back + dh * stay
    before = np.stack([step[0] for step in tape])
    grads = {}
    for k, name in enumerate("fr"):
        flat = dz[:, k].reshape(-1, 4 * hid)
        grads[f"{name}x"] = x[:, k].reshape(-1, x.shape[3]).T @ flat
        grads[f"{name}h"] = before[:, k].reshape(-1, hid).T @ flat
        grads[f"{name}b"] = flat.sum(0)
    dx = dz @ w.transpose(0, 2, 1)
    return dx[:, 0] + dx[::-1, 1], grads


def crf(e: np.ndarray, tags: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of tag paths, and its gradients; steps are masked only at the end.

    Forward and backward sums are kept as shares of each step's sum, whose logarithms make up the total.
    """
    steps, n, k = e.shape
    top, most = e.max(2), trans.max()
    x, way = np.exp(e - top[:, :, None]), np.exp(trans - most)
    alpha, scale = np.empty((steps, n, k)), np.ones((steps, n))
    scale[0] = x[0].sum(1)
    alpha[0] = x[0] / scale[0][:, None]
    live = mask > 0
    whole = live.all(1)
    for t in range(1, steps):
        new = (alpha[t - 1] @ way) * x[t]
        scale[t] = new.sum(1)
        new /= scale[t][:, None]
        alpha[t] = new if whole[t] else np.where(live[t][:, None], new, alpha[t - 1])
    beta = np.ones((steps, n, k))
    ahead = np.zeros((steps, n, k))
    for t in range(steps - 1, 0, -1):
        ahead[t] = x[t] * beta[t] / scale[t][:, None]
        new = ahead[t] @ way.T
        beta[t - 1] = new if whole[t] else np.where(live[t][:, None], new, beta[t])
    total = np.log(scale[0]) + top[0] + ((np.log(scale[1:]) + top[1:] + most) * live[1:]).sum(0)
    step, rows = np.arange(steps)[:, None], np.arange(n)[None]
    gold = e[0][rows[0], tags[0]] + ((e[step, rows, tags][1:] + trans[tags[:-1], tags[1:]]) * mask[1:]).sum(0)
    d_trans = way * (alpha[:-1].reshape(-1, k).T @ (ahead[1:] * live[1:, :, None]).reshape(-1, k))
    np.subtract.at(d_trans, (tags[:-1], tags[1:]), mask[1:])
    d_e = alpha * beta * mask[:, :, None]
    d_e[step, rows, tags] -= mask
    return float((total - gold).mean()), (d_e / n).astype(np.float32), (d_trans / n).astype(np.float32)


def viterbi(e: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> np.ndarray:
    steps, n, k = e.shape
    score, back = e[0], np.zeros((steps, n, k), np.int8)
    same = np.broadcast_to(np.arange(k, dtype=np.int8), (n, k))
    for t in range(1, steps):
        cand = score[:, :, None] + trans[None]
        m = mask[t][:, None] > 0
        back[t] = np.where(m, cand.argmax(1), same)
        score = np.where(m, cand.max(1) + e[t], score)
    out = np.zeros((steps, n), np.int8)
    out[-1] = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][np.arange(n), out[t]]
    return out


def states(ids: np.ndarray, mask: np.ndarray, table: np.ndarray, hidden: np.ndarray) -> np.ndarray:
    """The states of one direction without what training needs: ``table`` has each symbol's input terms, masked steps lie at one end.

    The batch lies along the last axis in memory, and steps work in place; the result is a view with the usual axes.
    """
    steps, n = ids.shape
    hid = hidden.shape[0]
    scale = np.full((4 * hid, 1), -1, np.float32)  # sigmoid(x) is 1 / (1 + exp(-x)), tanh(x) is 2 sigmoid(2 x) - 1
    scale[3 * hid :] = -2
    table, hidden = np.ascontiguousarray(table.T * scale), np.ascontiguousarray(hidden.T * scale)
    h, c = np.zeros((hid, n), np.float32), np.zeros((hid, n), np.float32)
    out = np.empty((steps, hid, n), np.float32)
    z, x = np.empty((4 * hid, n), np.float32), np.empty((4 * hid, n), np.float32)
    i, f, o, g = z[:hid], z[hid : 2 * hid], z[2 * hid : 3 * hid], z[3 * hid :]
    whole = mask.all(1)
    with np.errstate(over="ignore"):  # an infinite exponential is a closed gate
        for t in range(steps):
            np.take(table, ids[t], axis=1, out=x, mode="clip")
            np.matmul(hidden, h, out=z)
            z += x
            np.exp(z, out=z)
            z += 1
            np.reciprocal(z, out=z)
            g *= 2
            g -= 1
            g *= i
            c *= f
            c += g
            h = out[t]
            np.multiply(c, -2, out=h)
            np.exp(h, out=h)
            h += 1
            np.divide(2, h, out=h)
            h -= 1
            h *= o
            if not whole[t]:
                c *= mask[t]
                h *= mask[t]
    return out.transpose(0, 2, 1)


def emissions(ids: np.ndarray, lengths: np.ndarray, p: Params) -> np.ndarray:
    """Scores (steps, tags, rows) of a bidirectional network over symbols; rows are sorted by length, and what lies behind an end is undefined.

    A step takes states, symbols and bias through one product, which also gives the scores of the step before. It works on the
    rows that are not over yet, rounded up to ``AT_ONCE``, so that padding costs next to nothing. The batch lies along the last axis,
    and cells are held times -2, as their tanh needs them.
    """
    steps, n = ids.shape
    (hid, wide), dim, k = p["fh"].shape, p["e"].shape[1], p["o"].shape[1]
    out = np.empty((steps, k, n), np.float32)
    out[:] = p["c"][:, None]
    scale = np.full(wide, -1, np.float32)  # sigmoid(x) is 1 / (1 + exp(-x)), tanh(x) is 2 sigmoid(2 x) - 1
    scale[3 * hid :] = -2
    signs = np.ascontiguousarray(p["e"].T)
    over = np.searchsorted(lengths, np.arange(steps), "right")  # rows that ended before a step
    with np.errstate(over="ignore"):  # an infinite exponential is a closed gate
        for name, at, order in (("f", p["o"][:hid], range(steps)), ("r", p["o"][hid:], range(steps - 1, -1, -1))):
            w = np.zeros((wide + k, hid + dim + 1), np.float32)
            w[:wide] = (np.concatenate([p[f"{name}h"], p[f"{name}x"], p[f"{name}b"][None]]) * scale).T
            w[wide:, :hid] = at.T
            first, last = n, None  # the first row in work, and the step whose scores are still to come
            x, c = np.empty((hid + dim + 1, 0), np.float32), np.empty((hid, 0), np.float32)
            for t in order:
                live = over[t] // AT_ONCE * AT_ONCE
                if live != first:
                    if last is not None:
                        out[last, :, first:] += w[wide:, :hid] @ x[:hid]
                        last = None
                    held, kept = x, c
                    x, c = np.zeros((hid + dim + 1, n - live), np.float32), np.zeros((hid, n - live), np.float32)
                    x[-1] = 1
                    both = min(n - live, n - first)
                    if both:
                        x[:hid, -both:], c[:, -both:] = held[:hid, -both:], kept[:, -both:]
                    first = live
                    z = np.empty((wide + k, n - live), np.float32)
                    gates, sigmoids, (i, f, o, g), scores = z[:wide], z[: 3 * hid], z[:wide].reshape(4, hid, n - live), z[wide:]
                    h, symbol = x[:hid], x[hid:-1]
                np.take(signs, ids[t, first:], axis=1, out=symbol, mode="clip")
                np.matmul(w, x, out=z)
                if last is not None:
                    out[last, :, first:] += scores
                last = t
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(sigmoids, out=sigmoids)
                np.divide(-4, g, out=g)
                g += 2
                g *= i
                c *= f
                c += g
                np.exp(c, out=h)
                h += 1
                np.divide(2, h, out=h)
                h -= 1
                h *= o
                if over[t] > first:  # the second direction starts a row from its end
                    c[:, : over[t] - first] = 0
                    h[:, : over[t] - first] = 0
            if last is not None:
                out[last, :, first:] += w[wide:, :hid] @ x[:hid]
    return out


def tagged(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Rows of scores (steps, tags, rows) whose best path may have a tag other than 0: a bound, exact for the rest.

    A run of tags gains at most its scores over those of tag 0, the best transition into it and out of it (none at an end of the row)
    and the best inner one at each of its other steps. Where no run can gain, the path of zeros is best.
    """
    steps, _, n = e.shape
    into, leave, inner = (float(x.max() - trans[0, 0]) for x in (trans[0, 1:], trans[1:, 0], trans[1:, 1:]))
    least = inner - into - leave - 0.01  # room for rounding
    last = np.asarray(lengths) - 1
    gain = e[:, 1:].max(1)
    gain -= e[:, 0]
    gain += inner
    gain[0] -= into
    best = np.zeros(n, np.float32)
    for t in range(steps):
        np.maximum(best, 0, out=best)
        best += gain[t]
        gain[t] = best
    live = np.arange(steps)[:, None] <= last
    return (gain[last, np.arange(n)] >= least + leave) | ((gain >= least) & live).any(0)


def best_paths(e: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """``viterbi`` with the batch as the last axis, for many rows and few tags."""
    steps, n, k = e.shape
    e = np.ascontiguousarray(e.transpose(0, 2, 1))
    score, back = e[0], np.zeros((steps, k, n), np.int8)
    whole, same = mask.all(1), np.arange(k, dtype=np.int8)[:, None]
    for t in range(1, steps):
        best, arg = score[0] + trans[0][:, None], back[t]
        for j in range(1, k):
            cand = score[j] + trans[j][:, None]
            np.copyto(arg, j, where=cand > best)
            np.maximum(best, cand, out=best)
        best += e[t]
        if not whole[t]:
            m = mask[t] > 0
            back[t] = np.where(m, arg, same)
            best = np.where(m, best, score)
        score = best
    out = np.zeros((steps, n), np.int8)
    out[-1] = score.argmax(0)
    rows = np.arange(n)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][out[t], rows]
    return out


class Adam:
    def __init__(self, p: Params, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, grads: Params, clip: float = 5.0) -> None:
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, clip / max(norm, 1e-12))
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            g = g * scale
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.p[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)).astype(self.p[k].dtype)
