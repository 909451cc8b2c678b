"""Forward and gradient formulas of the forecasting networks, on one batch of windows.

Each network gives sums over the rows of a batch, so partial results of any batches add up to the full result:
``grad`` and ``grad_penalty`` (sums of gradients of the row losses and of the graph penalty), and ``stats`` =
(squared error, entropy, penalty, rows).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

# Hidden size and loss weights of the regime network.
HIDDEN = 64
ENTROPY_WEIGHT, RHO, MULTIPLIER, TAU = 0.01, 1.0, 0.0, 1.0
LOG_FLOOR = 1e-10


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def matrix_exp(m: np.ndarray) -> np.ndarray:
    """exp of a stack of matrices, by a Taylor series on a halved argument, squared back."""
    norm = np.abs(m).sum(axis=-1).max() if m.size else 0.0
    halvings = max(0, int(np.ceil(np.log2(max(norm, 1e-30)))) + 2)
    small = m / 2.0**halvings
    total = term = np.broadcast_to(np.eye(m.shape[-1]), m.shape)
    for step in range(1, 15):
        term = term @ small / step
        total = total + term
    for _ in range(halvings):
        total = total @ total
    return total


@dataclass
class Network:
    """Named parameter arrays kept in one flat vector."""

    shapes: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes.values())

    def unflatten(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def flatten(self, arrays: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([np.asarray(arrays[name], dtype=float).ravel() for name in self.shapes])

    def predict(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def sums(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray, want_grad: bool = True) -> dict[str, np.ndarray]:
        raise NotImplementedError

    def initial(self, seed: int) -> np.ndarray:
        raise NotImplementedError


def _glorot(rng: np.random.Generator, shape: tuple[int, int]) -> np.ndarray:
    limit = np.sqrt(6.0 / sum(shape))
    return rng.uniform(-limit, limit, shape)


class FeedForward(Network):
    """Flattened window -> sigmoid layer as wide as the window -> linear output.

    With ``output`` = (weights, bias) the output layer is frozen, for instance at the coefficients of a fitted VAR.
    """

    def __init__(self, p: int, k: int, output: tuple[np.ndarray, np.ndarray] | None = None):
        width = p * k
        super().__init__({"w1": (width, width), "b1": (width,)})
        self.p, self.k, self.output = p, k, output
        if output is None:
            self.shapes.update({"w2": (width, k), "b2": (k,)})

    def initial(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return self.flatten({n: _glorot(rng, s) if len(s) == 2 else np.zeros(s) for n, s in self.shapes.items()})

    def _layers(self, flat: np.ndarray, x: np.ndarray):
        a = self.unflatten(flat)
        hidden = sigmoid(x.reshape(len(x), -1) @ a["w1"] + a["b1"])
        w2, b2 = self.output if self.output is not None else (a["w2"], a["b2"])
        return hidden, w2, hidden @ w2 + b2

    def predict(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self._layers(flat, x)[2]

    def sums(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray, want_grad: bool = True) -> dict[str, np.ndarray]:
        hidden, w2, out = self._layers(flat, x)
        gap = out - y
        result = {"stats": np.array([(gap**2).mean(axis=1).sum(), 0.0, 0.0, len(x)])}
        if want_grad:
            d_out = 2.0 * gap / self.k
            d_hidden = (d_out @ w2.T) * hidden * (1.0 - hidden)
            grads = {"w1": x.reshape(len(x), -1).T @ d_hidden, "b1": d_hidden.sum(axis=0)}
            if self.output is None:
                grads.update({"w2": hidden.T @ d_out, "b2": d_out.sum(axis=0)})
            result["grad"] = self.flatten(grads)
            result["grad_penalty"] = np.zeros(self.size())
        return result


class RegimeNetwork(Network):
    """Recurrent encoder -> soft choice among state vectors -> per-state mixing of the last row.

    The last hidden vector u is compared with ``states``; their softmax-weighted mean h gives a matrix A and a diagonal D,
    and the forecast is A x + D (W x) for the last row x of the window.
    """

    def __init__(self, k: int, states: int, hidden: int = HIDDEN, tau: float = TAU):
        super().__init__(
            {
                "wx": (k, 4 * hidden), "wh": (hidden, 4 * hidden), "b": (4 * hidden,),
                "states": (states, hidden),
                "wa": (hidden, k * k), "ba": (k * k,), "wd": (hidden, k), "bd": (k,),
                "mix": (k, k),
            }
        )
        self.k, self.hidden, self.tau = k, hidden, tau

    def initial(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        limit = 1.0 / np.sqrt(self.hidden)
        normal = {"states", "mix"}
        return self.flatten(
            {n: rng.standard_normal(s) if n in normal else rng.uniform(-limit, limit, s) for n, s in self.shapes.items()}
        )

    def _forward(self, a: dict[str, np.ndarray], x: np.ndarray) -> dict:
        n, steps, _ = x.shape
        h = c = np.zeros((n, self.hidden))
        trace = []
        for t in range(steps):
            gates = x[:, t] @ a["wx"] + h @ a["wh"] + a["b"]
            i, f, g, o = np.split(gates, 4, axis=1)
            i, f, g, o = sigmoid(i), sigmoid(f), np.tanh(g), sigmoid(o)
            c_next = f * c + i * g
            h_next = o * np.tanh(c_next)
            trace.append((x[:, t], h, c, i, f, g, o, c_next))
            h, c = h_next, c_next
        score = h @ a["states"].T / self.tau
        score = np.exp(score - score.max(axis=1, keepdims=True))
        alpha = score / score.sum(axis=1, keepdims=True)
        mixed = alpha @ a["states"]
        graph = (mixed @ a["wa"] + a["ba"]).reshape(n, self.k, self.k)
        diagonal = mixed @ a["wd"] + a["bd"]
        last = x[:, -1]
        mixed_last = last @ a["mix"].T
        out = np.einsum("nij,nj->ni", graph, last) + diagonal * mixed_last
        return {"trace": trace, "u": h, "alpha": alpha, "mixed": mixed, "graph": graph, "diagonal": diagonal,
                "last": last, "mixed_last": mixed_last, "out": out}

    def predict(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self._forward(self.unflatten(flat), x)["out"]

    def states_of(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self._forward(self.unflatten(flat), x)["alpha"]

    def sums(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray, want_grad: bool = True) -> dict[str, np.ndarray]:
        a = self.unflatten(flat)
        s = self._forward(a, x)
        gap = s["out"] - y
        log_alpha = np.log(s["alpha"] + LOG_FLOOR)
        entropy = -(s["alpha"] * log_alpha).sum(axis=1)
        grown = matrix_exp(s["graph"] ** 2)
        penalty = np.trace(grown, axis1=1, axis2=2) - self.k
        result = {"stats": np.array([(gap**2).mean(axis=1).sum(), entropy.sum(), penalty.sum(), len(x)])}
        if want_grad:
            d_out = 2.0 * gap / self.k
            d_graph = np.einsum("ni,nj->nij", d_out, s["last"])
            d_diagonal = d_out * s["mixed_last"]
            d_entropy = -ENTROPY_WEIGHT * (log_alpha + s["alpha"] / (s["alpha"] + LOG_FLOOR))
            main = self._backward(a, s, d_graph, d_diagonal, d_entropy)
            main["mix"] = (d_out * s["diagonal"]).T @ s["last"]
            d_penalty = 2.0 * s["graph"] * np.transpose(grown, (0, 2, 1))
            side = self._backward(a, s, d_penalty, np.zeros_like(d_diagonal), np.zeros_like(s["alpha"]))
            side["mix"] = np.zeros_like(a["mix"])
            result["grad"], result["grad_penalty"] = self.flatten(main), self.flatten(side)
        return result

    def _backward(self, a, s, d_graph, d_diagonal, d_alpha) -> dict[str, np.ndarray]:
        flat_graph = d_graph.reshape(len(d_graph), -1)
        grads = {
            "wa": s["mixed"].T @ flat_graph, "ba": flat_graph.sum(axis=0),
            "wd": s["mixed"].T @ d_diagonal, "bd": d_diagonal.sum(axis=0),
        }
        d_mixed = flat_graph @ a["wa"].T + d_diagonal @ a["wd"].T
        d_alpha = d_alpha + d_mixed @ a["states"].T
        d_score = s["alpha"] * (d_alpha - (d_alpha * s["alpha"]).sum(axis=1, keepdims=True)) / self.tau
        grads["states"] = s["alpha"].T @ d_mixed + d_score.T @ s["u"]
        d_h = d_score @ a["states"]
        d_c = np.zeros_like(d_h)
        grads.update({"wx": np.zeros_like(a["wx"]), "wh": np.zeros_like(a["wh"]), "b": np.zeros_like(a["b"])})
        for x_t, h_was, c_was, i, f, g, o, c_now in reversed(s["trace"]):
            squashed = np.tanh(c_now)
            d_c = d_c + d_h * o * (1.0 - squashed**2)
            d_gates = np.hstack(
                [d_c * g * i * (1 - i), d_c * c_was * f * (1 - f), d_c * i * (1 - g**2), d_h * squashed * o * (1 - o)]
            )
            grads["wx"] += x_t.T @ d_gates
            grads["wh"] += h_was.T @ d_gates
            grads["b"] += d_gates.sum(axis=0)
            d_h, d_c = d_gates @ a["wh"].T, d_c * f
        return grads
