"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Used by ``pii``: training by Adam on the CRF likelihood, and Viterbi decoding of batches of windows.
Windows have one length; shorter texts are filled with ``PAD`` and masked by the caller.
"""

from __future__ import annotations

import numpy as np

#: Character ids: ASCII as it is, then other letters, other characters and the filling.
OTHER_LETTER, OTHER, PAD, VOCABULARY = 128, 129, 130, 131


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    def __init__(self, tags: int, forbidden: np.ndarray, width: int = 16, hidden: int = 24, seed: int = 11):
        rng = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.tags, self.hidden, self.forbidden = tags, hidden, forbidden
        self.p = {"embed": some(VOCABULARY, width), "out": some(2 * hidden, tags), "out_b": np.zeros(tags, np.float32),
                  "move": np.zeros((tags, tags), np.float32), "first": np.zeros(tags, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": some(width, 4 * hidden), f"h{d}": some(hidden, 4 * hidden),
                       f"b{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"b{d}"][hidden:2 * hidden] = 1.0  # remember at first

    # -------------------------------------------------------------- the network

    def _run(self, d: str, ids: np.ndarray, keep: bool):
        n, steps, H = *ids.shape, self.hidden
        gate_in = (self.p["embed"] @ self.p[f"x{d}"] + self.p[f"b{d}"])[ids]
        h, c = np.zeros((n, H), np.float32), np.zeros((n, H), np.float32)
        out, memory = np.zeros((n, steps, H), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gate_in[:, t] + h @ self.p[f"h{d}"]
            gates = _sigmoid(z[:, :3 * H])
            i, f, o, g = gates[:, :H], gates[:, H:2 * H], gates[:, 2 * H:], np.tanh(z[:, 3 * H:])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep:
                memory.append((t, i, f, o, g, tc, before, h_before))
        return out, memory

    def emissions(self, ids: np.ndarray, keep: bool = False):
        forward, mf = self._run("f", ids, keep)
        backward, mb = self._run("b", ids, keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["out"] + self.p["out_b"], (both, mf, mb)

    def _moves(self) -> np.ndarray:
        return self.p["move"] + self.forbidden

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tags, how sure each tag is) of every window by Viterbi."""
        e, _ = self.emissions(ids)
        n, steps, _ = e.shape
        moves = self._moves()
        score, back = self.p["first"] + e[:, 0], np.zeros(e.shape, np.int8)
        for t in range(1, steps):
            total = score[:, :, None] + moves[None]
            back[:, t] = total.argmax(1)
            score = total.max(1) + e[:, t]
        tags = np.zeros((n, steps), np.int8)
        tags[:, -1] = score.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        sure = np.exp(e - e.max(2, keepdims=True))
        sure /= sure.sum(2, keepdims=True)
        return tags, np.take_along_axis(sure, tags[:, :, None].astype(np.int64), 2)[:, :, 0]

    # -------------------------------------------------------------- training

    def gradients(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the gold tags, and its gradients."""
        e, (both, mf, mb) = self.emissions(ids, keep=True)
        n, steps, K = e.shape
        moves = self._moves()

        def lse(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))

        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = self.p["first"] + e[:, 0]
        for t in range(1, steps):
            alpha[:, t] = lse(alpha[:, t - 1, :, None] + moves[None], 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            beta[:, t] = lse(moves[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = lse(alpha[:, -1], 1)
        rows = np.arange(n)[:, None]
        gold_score = self.p["first"][gold[:, 0]] + e[rows, np.arange(steps)[None], gold].sum(1)
        gold_score = gold_score + moves[gold[:, :-1], gold[:, 1:]].sum(1)
        de = np.exp(alpha + beta - z[:, None, None])
        g = {"first": de[:, 0].sum(0)}
        np.subtract.at(g["first"], gold[:, 0], 1.0)
        move = np.zeros((K, K))
        for t in range(1, steps):
            pair = alpha[:, t - 1, :, None] + moves[None] + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
            move += np.exp(pair).sum(0)
        np.subtract.at(move, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1.0)
        g["move"] = np.where(self.forbidden < 0, 0.0, move)
        de[rows, np.arange(steps)[None], gold] -= 1.0
        g["out"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, K)
        g["out_b"] = de.sum((0, 1))
        dh_all = de @ self.p["out"].T
        g["embed"] = np.zeros_like(self.p["embed"])
        H = self.hidden
        embedded = self.p["embed"][ids]
        seen = (ids.reshape(-1, 1) == np.arange(VOCABULARY)).astype(np.float32)
        for d, memory, part in (("f", mf, dh_all[:, :, :H]), ("b", mb, dh_all[:, :, H:])):
            wh = self.p[f"h{d}"]
            g[f"h{d}"] = np.zeros_like(wh)
            dz_all = np.zeros((n, steps, 4 * H), np.float32)
            dh, dc = np.zeros((n, H), np.float32), np.zeros((n, H), np.float32)
            for t, i, f, o, gg, tc, before, h_before in reversed(memory):
                dh = dh + part[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - gg * gg)], axis=1)
                dz_all[:, t] = dz
                g[f"h{d}"] += h_before.T @ dz
                dh, dc = dz @ wh.T, dc * f
            g[f"b{d}"] = dz_all.sum((0, 1))
            g[f"x{d}"] = embedded.reshape(-1, embedded.shape[2]).T @ dz_all.reshape(-1, 4 * H)
            g["embed"] += seen.T @ (dz_all @ self.p[f"x{d}"].T).reshape(-1, embedded.shape[2])
        return float((z - gold_score).mean()), {k: v / n for k, v in g.items()}

    def fit(self, ids: np.ndarray, gold: np.ndarray, steps: int, batch: int = 64, rate: float = 0.02,
            seed: int = 5) -> float:
        """Adam over ``steps`` batches, in passes over the windows in random order."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, loss = 0, 0.0
        while step < steps:
            order = rng.permutation(len(ids))
            for at in range(0, min(len(ids), (steps - step) * batch), batch):
                rows = order[at:at + batch]
                loss, g = self.gradients(ids[rows], gold[rows])
                step += 1
                size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                shrink = min(1.0, 5.0 / max(size, 1e-9))
                now = rate * (1 - 0.95 * step / steps)
                for k, v in g.items():
                    v = (v * shrink).astype(np.float32)
                    m[k] += 0.1 * (v - m[k])
                    s[k] += 0.001 * (v * v - s[k])
                    self.p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        return loss
