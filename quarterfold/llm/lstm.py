"""A bidirectional LSTM in numpy that labels every step of a sequence, trained with Adam on padded batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """w, u, b: for either direction the weights of input, state and the bias of the gates (in, forget, out, cell); v, c: output."""

    p: dict[str, np.ndarray]
    hidden: int

    @staticmethod
    def new(inputs: int, hidden: int, seed: int = 7) -> Labeller:
        r = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"w{d}"] = r.normal(0, 1 / np.sqrt(inputs), (inputs, 4 * hidden))
            p[f"u{d}"] = r.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            p[f"b{d}"] = np.zeros(4 * hidden)
            p[f"b{d}"][hidden : 2 * hidden] = 1
        p["v"], p["c"] = r.normal(0, 1 / np.sqrt(2 * hidden), 2 * hidden), np.zeros(1)
        return Labeller(p, hidden)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool = True):
        """x: (pages, steps, inputs). States after each step, and all that the gradients need of them if they are kept;
        padding leaves the state as it is."""
        n, steps, k = x.shape[0], x.shape[1], self.hidden
        h, c = np.zeros((n, k)), np.zeros((n, k))
        pre = x @ self.p[f"w{d}"] + self.p[f"b{d}"]
        out, kept = np.zeros((n, steps, k)), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + h @ self.p[f"u{d}"]
            i, f, o = (_sigmoid(z[:, j * k : (j + 1) * k]) for j in range(3))
            g = np.tanh(z[:, 3 * k :])
            m = mask[:, t : t + 1]
            c2 = f * c + i * g
            th = np.tanh(c2)
            if keep:
                kept.append((t, h, c, i, f, o, g, th))
            h, c = m * o * th + (1 - m) * h, m * c2 + (1 - m) * c
            out[:, t] = h
        return out, kept

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, d, keep=False)[0] for d in "fb"], axis=2)
        return both @ self.p["v"] + self.p["c"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        k, runs = self.hidden, {d: self._run(x, mask, d) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        z = both @ self.p["v"] + self.p["c"]
        q, total = _sigmoid(z), mask.sum()
        loss = -(mask * (y * np.log(q + 1e-9) + (1 - y) * np.log(1 - q + 1e-9))).sum() / total
        dz = mask * (q - y) / total
        grad = {"v": np.einsum("nt,ntk->k", dz, both), "c": np.array([dz.sum()])}
        for d, part in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
            dout = dz[:, :, None] * self.p["v"][part]
            u = self.p[f"u{d}"]
            dpre, du = np.zeros((*x.shape[:2], 4 * k)), np.zeros_like(u)
            dh, dc = np.zeros((len(x), k)), np.zeros((len(x), k))
            for t, h0, c0, i, f, o, g, th in reversed(runs[d][1]):
                m = mask[:, t : t + 1]
                dh = dh + dout[:, t]
                dc2 = m * (dc + dh * o * (1 - th**2))
                gates = np.concatenate([dc2 * g * i * (1 - i), dc2 * c0 * f * (1 - f), m * dh * th * o * (1 - o), dc2 * i * (1 - g**2)], axis=1)
                dpre[:, t] = gates
                du += h0.T @ gates
                dh, dc = gates @ u.T + (1 - m) * dh, dc2 * f + (1 - m) * dc
            grad[f"w{d}"] = np.einsum("nti,ntk->ik", x, dpre)
            grad[f"u{d}"], grad[f"b{d}"] = du, dpre.sum((0, 1))
        return loss, grad


def padded(pages: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, width)), np.zeros((len(pages), steps))
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, 1
    return x, mask


def fit(pages: list[np.ndarray], labels: list[np.ndarray], hidden: int = 16, epochs: int = 16, batch: int = 32, rate: float = 0.01) -> Labeller:
    """Pages of like length are trained together."""
    model = Labeller.new(pages[0].shape[1] if pages else 1, hidden)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    order = np.argsort([len(p) for p in pages], kind="stable")
    groups = [order[i : i + batch] for i in range(0, len(order), batch)]
    shuffled, step = np.random.default_rng(11), 0
    for _ in range(epochs):
        for g in shuffled.permutation(len(groups)):
            x, mask = padded([pages[i] for i in groups[g]], pages[0].shape[1])
            y = padded([labels[i][:, None] for i in groups[g]], 1)[0][:, :, 0]
            step += 1
            for k, d in model.gradients(x, mask, y)[1].items():
                d = np.clip(d, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                model.p[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model
