"""A gated recurrent language model in numpy: truncated backpropagation, a class-factored softmax, state carried across
windows. Nothing here knows Spark; a task calls it on the token numbers of its documents."""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

Arrays = dict[str, np.ndarray]


@dataclass(frozen=True)
class Shape:
    """What the network's layers are made of.

    Words 0 to words - 1 have vectors of their own; they are numbered by falling frequency, 0 being the end of a text.
    Each belongs to one of the classes, which are runs of that order: word w is in class k if
    starts[k] <= w < starts[k + 1]. Inputs words to words + tails - 1 and classes after the last stand for the tail
    classes, whose words share a vector and have fixed chances within the class.
    """

    words: int
    tails: int
    starts: tuple[int, ...]
    size: int = 32

    @property
    def classes(self) -> int:
        return len(self.starts) - 1


def class_starts(counts: np.ndarray, classes: int) -> tuple[int, ...]:
    """Runs of the frequency order of about equal shares of the square roots of the counts."""
    share = np.cumsum(np.sqrt(counts + 1.0))
    cuts = np.searchsorted(share, share[-1] * np.arange(1, classes) / classes)
    return (0, *sorted({int(c) for c in cuts if 0 < c < len(counts)}), len(counts))


def initial(shape: Shape, counts: np.ndarray, tail_mass: np.ndarray, seed: int = 0) -> Arrays:
    """Weights whose first predictions are the unigram chances."""
    rng = np.random.default_rng(seed)
    s, mass = shape.size, counts + 1.0
    per_class = np.add.reduceat(mass, shape.starts[:-1])
    of_class = np.r_[per_class, tail_mass + 1.0]
    label = np.repeat(np.arange(shape.classes), np.diff(shape.starts))

    def draws(*dims: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(dims) * scale).astype(np.float32)

    return {
        "input": draws(shape.words + shape.tails, s, scale=0.3),
        "gates": draws(s, 3 * s, scale=s**-0.5),
        "gates_bias": np.zeros(3 * s, np.float32),
        "state": draws(s, 3 * s, scale=s**-0.5),
        "class": np.zeros((s, len(of_class)), np.float32),
        "class_bias": np.log(of_class / of_class.sum()).astype(np.float32),
        "word": np.zeros((shape.words, s), np.float32),
        "word_bias": np.log(mass / per_class[label]).astype(np.float32),
    }


def _logistic(x: np.ndarray, times: float = 1.0) -> np.ndarray:
    """1 / (1 + exp(-times * x)), in place; numpy has no faster hyperbolic tangent than one made of it."""
    np.multiply(x, -times, out=x)
    np.clip(x, -np.inf, 60.0, out=x)  # np.minimum is several times slower
    np.exp(x, out=x)
    x += 1.0
    return np.reciprocal(x, out=x)


def _tanh(x: np.ndarray) -> np.ndarray:
    _logistic(x, 2.0)
    x *= 2.0
    x -= 1.0
    return x


#: Rows of logits at a time where nothing is summed over rows, so that they stay in the processor's cache.
BLOCK_ROWS = 1024
#: Logits above this are taken for it, so that no exponential overflows.
MOST_LOGIT = 40.0


def _rows(states: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """The states (size x steps x lanes) of the valid places, one a row."""
    flat = states.reshape(len(states), -1)
    return np.ascontiguousarray(flat.T if valid.all() else flat[:, np.flatnonzero(valid)].T)


class Lanes:
    """Documents, none of them empty, laid end to end in lanes, the longest lane first, and read in windows of a few steps.

    A document stays in one lane, so the state it ends a window with is the state it begins the next with; where a
    document begins, the state is cleared.
    """

    def __init__(self, documents: list[np.ndarray], lanes: int):
        sizes = np.array([len(d) for d in documents], np.int64)
        order = np.argsort(-sizes, kind="stable").tolist()
        held: list[list[int]] = [[] for _ in range(min(lanes, len(documents)))]
        heap = [(0, k) for k in range(len(held))]
        for i in order:
            n, k = heap[0]
            held[k].append(i)
            heapq.heapreplace(heap, (n + int(sizes[i]), k))
        held.sort(key=lambda lane: -int(sizes[lane].sum()))
        laid = [i for lane in held for i in lane]
        self.lengths = np.array([sizes[lane].sum() for lane in held], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.token = np.concatenate([documents[i] for i in laid])
        self.owner = np.repeat(laid, sizes[laid])
        begins = np.cumsum(sizes[laid]) - sizes[laid]
        self.keep = np.ones(len(self.token), bool)
        self.keep[begins] = False
        self.before = np.r_[0, self.token[:-1]]
        self.before[begins] = 0

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(before, token, keep, valid, owner), each steps x lanes: the token before each (0 at a beginning), the token,
        whether the state goes on, whether there is a token, and the document it is of."""
        within = np.arange(steps)[:, None]
        for start in range(0, int(self.lengths.max(initial=0)), steps):
            lanes = int((self.lengths > start).sum())
            valid = start + within < self.lengths[:lanes]
            at = np.minimum(self.offsets[:lanes] + start + within, len(self.token) - 1)
            yield self.before[at], self.token[at], self.keep[at], valid, self.owner[at]


class Network:
    """The model over one set of weights. Tokens are given as inputs: words, then words + tail class."""

    def __init__(self, shape: Shape, weights: Arrays):
        self.shape, self.w = shape, weights
        label = np.repeat(np.arange(shape.classes, dtype=np.int16), np.diff(shape.starts))
        self.label = np.r_[label, shape.classes + np.arange(shape.tails, dtype=np.int16)]

    def gate_sums(self, before: np.ndarray) -> np.ndarray:
        """What each token's predecessor adds to the gates: 3 size x steps x lanes, as all states and gates are laid out,
        so that a gate of a step is a run of lanes for numpy, not one number of each lane."""
        table = self.w["input"] @ self.w["gates"] + self.w["gates_bias"]
        return np.take(np.ascontiguousarray(table.T), before, axis=1)

    def run(self, sums: np.ndarray, keep: np.ndarray, h: np.ndarray, tape: Arrays | None = None) -> np.ndarray:
        """The states after each step, from every step's gate sums, which are used up; `tape` keeps what the way back
        needs: the state before each step, both gates, the candidate and the share of it that came from the state."""
        s, state = self.shape.size, np.ascontiguousarray(self.w["state"].T)
        out = np.empty((s, *sums.shape[1:]), np.float32)
        whole = keep.all(axis=1)
        for t in range(sums.shape[1]):
            if not whole[t]:
                h = h * keep[t]
            g = state @ h
            gates, new, part = sums[: 2 * s, t], sums[2 * s :, t], g[2 * s :]
            gates += g[: 2 * s]
            _logistic(gates)
            if tape is not None:
                tape["before"][:, t], tape["part"][:, t] = h, part
            part *= gates[s:]
            new += part
            _tanh(new)
            h = h - new
            h *= gates[:s]
            h += new
            out[:, t] = h
        return out

    def chances(self, states: np.ndarray, tokens: np.ndarray, back: Arrays | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """(ln p of the token's class and, for a word, of the word in it; the states' gradient if `back` is given)."""
        w, starts = self.w, self.shape.starts
        label = self.label[tokens]
        order = np.argsort(label, kind="stable")
        states, tokens, label = states[order], tokens[order], label[order]
        rows = np.arange(len(tokens))

        def softmax(e: np.ndarray, chosen: np.ndarray) -> np.ndarray:
            np.clip(e, -np.inf, MOST_LOGIT, out=e)
            at = rows[: len(e)]
            found = e[at, chosen]
            np.exp(e, out=e)
            total = e @ np.ones(e.shape[1], np.float32)
            if back is not None:
                e /= total[:, None]
                e[at, chosen] -= 1
            return found - np.log(total)

        block, grad = len(states) if back is not None else BLOCK_ROWS, None
        found = np.empty(len(states), np.float32)
        for a in range(0, len(states), max(1, block)):
            e = states[a : a + block] @ w["class"]
            e += w["class_bias"]
            found[a : a + block] = softmax(e, label[a : a + block])
        if back is not None:
            back["class"] = states.T @ e
            back["class_bias"] = np.ones(len(e), np.float32) @ e
            grad = e @ w["class"].T
        ends = np.searchsorted(label, np.arange(self.shape.classes + 1))
        for k in np.flatnonzero(np.diff(ends)).tolist():
            lo, hi, a, b = starts[k], starts[k + 1], ends[k], ends[k + 1]
            if hi - lo == 1:
                continue
            mine = states[a:b]
            e = mine @ w["word"][lo:hi].T
            e += w["word_bias"][lo:hi]
            found[a:b] += softmax(e, tokens[a:b] - lo)
            if back is not None:
                back["word"][lo:hi] = e.T @ mine
                back["word_bias"][lo:hi] = np.ones(len(e), np.float32) @ e
                grad[a:b] += e @ w["word"][lo:hi]
        in_place = np.empty_like(order)
        in_place[order] = rows
        return found[in_place], None if grad is None else grad[in_place]

    def score(self, documents: list[np.ndarray], lanes: int = 512, steps: int = 32) -> np.ndarray:
        """ln p of each document's tokens, each whole document read with one running state."""
        table = np.ascontiguousarray((self.w["input"] @ self.w["gates"] + self.w["gates_bias"]).T)
        sums = np.zeros(len(documents))
        h, held, waiting = None, [], 0

        def settle() -> None:
            nonlocal sums
            states, tokens, owners = (np.concatenate(parts) for parts in zip(*held, strict=True))
            found, _ = self.chances(states, tokens)
            sums += np.bincount(owners, weights=found, minlength=len(documents))
            held.clear()

        for before, token, keep, valid, owner in Lanes(documents, lanes).windows(steps):
            h = np.zeros((self.shape.size, before.shape[1]), np.float32) if h is None else h[:, : before.shape[1]]
            states = self.run(np.take(table, before, axis=1), keep, h)
            h = states[:, -1]
            held.append((_rows(states, valid), token[valid], owner[valid]))
            waiting += len(held[-1][1])
            if waiting >= lanes * steps:
                settle()
                waiting = 0
        if held:
            settle()
        return sums

    def gradients(self, before: np.ndarray, token: np.ndarray, keep: np.ndarray, valid: np.ndarray, h: np.ndarray) -> tuple[Arrays, np.ndarray, float]:
        """(gradients of -ln p within the window, the last state, ln p); the state is not followed before the window."""
        s, w = self.shape.size, self.w
        back = {"word": np.zeros_like(w["word"]), "word_bias": np.zeros_like(w["word_bias"])}
        sums, h = self.gate_sums(before), np.ascontiguousarray(h.T)
        tape = {k: np.empty((s, *before.shape), np.float32) for k in ("before", "part")}
        states = self.run(sums, keep, h, tape)
        found, grad = self.chances(_rows(states, valid), token[valid], back)
        at = np.flatnonzero(valid)
        if len(at) < valid.size:
            grad, of_valid = np.zeros((valid.size, s), np.float32), grad
            grad[at] = of_valid
        from_out = np.ascontiguousarray(grad.T).reshape(states.shape)
        z, r, new = sums[:s], sums[s : 2 * s], sums[2 * s :]
        by_z = (tape["before"] - new) * z * (1 - z)
        by_new = (1 - z) * (1 - new * new)
        by_r = tape["part"] * r * (1 - r)
        d_sums, d_state = np.empty_like(sums), np.empty_like(sums)
        dh, whole = np.zeros_like(h), keep.all(axis=1)
        for t in range(len(before) - 1, -1, -1):
            dh += from_out[:, t]
            d, dg = d_sums[:, t], d_state[:, t]
            d_new = np.multiply(dh, by_new[:, t], out=d[2 * s :])
            np.multiply(dh, by_z[:, t], out=d[:s])
            np.multiply(d_new, by_r[:, t], out=d[s : 2 * s])
            dg[: 2 * s] = d[: 2 * s]
            np.multiply(d_new, r[:, t], out=dg[2 * s :])
            dh *= z[:, t]
            dh += w["state"] @ dg
            if not whole[t]:
                dh *= keep[t]
        flat = d_sums.reshape(3 * s, -1)
        back["state"] = tape["before"].reshape(s, -1) @ d_state.reshape(3 * s, -1).T
        back["gates_bias"] = flat @ np.ones(flat.shape[1], np.float32)
        names = before.ravel()
        order = np.argsort(names, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(names[order]) > 0])
        rows = names[order][at]
        by_row = np.add.reduceat(np.take(flat, order, axis=1), at, axis=1)
        back["gates"] = (by_row @ w["input"][rows]).T
        back["input"] = by_row.T @ w["gates"].T
        back["input_rows"] = rows
        return back, states[:, -1].T, float(found.sum())


class Trainer:
    """Adagrad over windows of several documents at once."""

    def __init__(self, network: Network, rate: float = 0.1, lanes: int = 512, steps: int = 16):
        self.net, self.rate, self.lanes, self.steps = network, rate, lanes, steps
        self.seen = {k: np.full_like(v, 1e-6) for k, v in network.w.items()}

    def learn(self, documents: list[np.ndarray]) -> float:
        """One pass over the documents; ln p of their tokens as met."""
        h, total = None, 0.0
        for before, token, keep, valid, _ in Lanes(documents, self.lanes).windows(self.steps):
            h = np.zeros((before.shape[1], self.net.shape.size), np.float32) if h is None else h[: before.shape[1]]
            back, h, found = self.net.gradients(before, token, keep, valid, h)
            total += found
            self._step(back, 1.0 / (self.lanes * self.steps))
        return total

    def _step(self, back: Arrays, scale: float) -> None:
        rows = back.pop("input_rows")
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in back.values())) * scale
        scale *= min(1.0, 5.0 / norm) if norm > 0 else 1.0
        for name, g in back.items():
            g *= scale
            if name == "input":
                self.seen[name][rows] += g * g
                self.net.w[name][rows] -= self.rate * g / np.sqrt(self.seen[name][rows])
            else:
                self.seen[name] += g * g
                g *= self.rate
                g /= np.sqrt(self.seen[name])
                self.net.w[name] -= g
