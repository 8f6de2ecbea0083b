"""A gated recurrent language model over a small vocabulary, with classes in its output layer, in numpy."""

from __future__ import annotations

import heapq
import math
import numpy as np

END, WINDOW = 0, 32
EMBEDDED, HIDDEN, CLASSES, CLASS_SIZE = 16, 24, 24, 48
SIDE = 192  # streams that are scored side by side
SEGMENT = 2048  # symbols of a text that are trained on in one piece


class Model:
    """Symbol 0 is the end of a text; the symbols of a class stand side by side.

    P(symbol | before) = P(class | state) P(symbol | class, state).
    """

    def __init__(self, bounds: np.ndarray, weights: dict[str, np.ndarray]):
        self.bounds, self.weights = bounds, weights
        self.class_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)).astype(np.int32)

    @classmethod
    def new(cls, counts: np.ndarray, seed: int = 3) -> Model:
        """A model that starts as the unigram distribution of ``counts``."""
        # Classes of nearly equal sums of square roots, and of bounded size, keep both softmaxes short.
        bounds, held, most = [0], 0.0, np.sqrt(counts + 1.0).sum() / CLASSES
        for n, root in enumerate(np.sqrt(counts + 1.0)):
            if n > bounds[-1] and (held + root > most or n - bounds[-1] == CLASS_SIZE):
                bounds.append(n)
                held = 0.0
            held += root
        bounds = np.array([*bounds, len(counts)])
        rng = np.random.default_rng(seed)
        shape = {"embed": (len(counts), EMBEDDED), "input": (EMBEDDED, 3 * HIDDEN), "state": (HIDDEN, 3 * HIDDEN),
                 "to_class": (HIDDEN, len(bounds) - 1), "to_symbol": (len(counts), HIDDEN)}
        scale = {"embed": 0.3, "input": EMBEDDED ** -0.5, "state": HIDDEN ** -0.5, "to_class": 0.01, "to_symbol": 0.01}
        weights = {n: rng.normal(0, scale[n], s).astype(np.float32) for n, s in shape.items()}
        weights["bias"] = np.zeros(3 * HIDDEN, np.float32)
        logs = np.log((counts + 1.0) / (counts + 1.0).sum())
        weights["symbol_bias"] = logs.astype(np.float32)
        weights["class_bias"] = np.log(np.add.reduceat(np.exp(logs), bounds[:-1])).astype(np.float32)
        return cls(bounds, weights)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[n].ravel() for n in sorted(self.weights)])

    def with_flat(self, values: np.ndarray) -> Model:
        weights, at = {}, 0
        for n in sorted(self.weights):
            w = self.weights[n]
            weights[n] = values[at:at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
        return Model(self.bounds, weights)

    # -- states

    def step(self, given: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step from the gates' inputs: update, reset, candidate, its recurrent part, new state."""
        n = HIDDEN
        recurrent = h @ self.weights["state"]
        gates = _sigmoid(given[:, :2 * n] + recurrent[:, :2 * n])
        update, reset = gates[:, :n], gates[:, n:]
        candidate = reset * recurrent[:, 2 * n:]
        candidate += given[:, 2 * n:]
        np.tanh(candidate, out=candidate)
        new = h - candidate
        new *= update
        new += candidate
        return update, reset, candidate, recurrent[:, 2 * n:], new

    # -- output

    def log10(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after its state."""
        w = self.weights
        order = np.argsort(self.class_of[symbols].astype(np.int16), kind="stable")
        s, sorted_symbols = states.take(order, axis=0), symbols[order]
        wanted = self.class_of[sorted_symbols]
        found = _log_softmax(s @ w["to_class"] + w["class_bias"], wanted)
        edges = np.searchsorted(wanted, np.arange(len(self.bounds)))
        for c in np.flatnonzero((np.diff(edges) > 0) & (np.diff(self.bounds) > 1)).tolist():
            (a, b), rows = self.bounds[c:c + 2], slice(edges[c], edges[c + 1])
            found[rows] += _log_softmax(s[rows] @ w["to_symbol"][a:b].T + w["symbol_bias"][a:b], sorted_symbols[rows] - a)
        out = np.empty(len(symbols))
        out[order] = found
        return out / np.log(10)

    def score(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """log10 probability of each text. ``tokens``: all texts' symbols, each text with its end; ``lengths``: theirs.

        The state is carried through the whole text, from window to window. Texts run in streams side by side, one behind
        the other; the end of a text empties the state.
        """
        out = np.zeros(len(lengths))
        if not len(lengths):
            return out
        table = self.weights["embed"] @ self.weights["input"] + self.weights["bias"]
        order, starts, loads = _streams(lengths, SIDE)
        firsts = (np.cumsum(lengths) - lengths)[order]
        # Each stream's symbols stand together, and so do those of its texts.
        spread = np.repeat(firsts - (np.cumsum(lengths[order]) - lengths[order]), lengths[order]) + np.arange(len(tokens))
        tokens, owner = tokens[spread], np.repeat(order, lengths[order])
        h, last = np.zeros((len(loads), HIDDEN), np.float32), np.full(len(loads), END, np.int32)
        for at in range(0, int(loads[0]), WINDOW):
            steps = np.arange(at, min(at + WINDOW, int(loads[0])))
            lives = np.searchsorted(-loads, -steps, "left")
            width = int(lives[0])
            places = np.minimum(starts[:width] + steps[:, None], len(tokens) - 1)
            symbols = tokens[places]
            before = np.concatenate([last[None, :width], symbols[:-1]])
            given, keep = table.take(before, axis=0), (before != END).astype(np.float32)[:, :, None]
            states = np.empty((len(steps), width, HIDDEN), np.float32)
            for t, live in enumerate(lives.tolist()):
                h = states[t, :live] = self.step(given[t, :live], h[:live] * keep[t, :live])[-1]
            last = symbols[-1]
            if lives[-1] == width:
                states, symbols, places = states.reshape(-1, HIDDEN), symbols.ravel(), places.ravel()
            else:
                on = np.arange(width) < lives[:, None]
                states, symbols, places = states[on], symbols[on], places[on]
            out += np.bincount(owner[places], self.log10(states, symbols), len(out))
        return out

    # -- training

    def gradients(self, before: np.ndarray, symbols: np.ndarray, mask: np.ndarray, h: np.ndarray,
                  fresh: np.ndarray | None = None):
        """Gradients over one window (time, stream), back to its start only; the last state; the summed loss.

        ``fresh``: where a stream goes on with another text, whose state starts empty.
        """
        w, n, (steps, width) = self.weights, HIDDEN, symbols.shape
        given = (w["embed"] @ w["input"] + w["bias"]).take(before, axis=0)
        given[~mask, :n] = np.inf  # the update gate of a text that has ended is 1, which hands its state on
        kept = np.empty((4, steps, width, n), given.dtype)
        states, entered = np.empty((2, steps, width, n), given.dtype)
        keeps = [None if fresh is None or not fresh[t].any() else ~fresh[t][:, None] for t in range(steps)]
        for t in range(steps):
            entered[t] = h if keeps[t] is None else h * keeps[t]
            *kept[:, t], states[t] = self.step(given[t], entered[t])
            h = states[t]
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        live = np.flatnonzero(mask.ravel())
        after, loss = np.zeros((steps * width, n), given.dtype), 0.0
        if len(live):
            wanted = symbols.ravel()[live]
            order = np.argsort(self.class_of[wanted].astype(np.int16), kind="stable")
            live, wanted = live[order], wanted[order]  # a class's rows stand side by side
            s, classes = states.reshape(-1, n).take(live, axis=0), self.class_of[wanted]
            wrong, loss = _softmax_error(s @ w["to_class"] + w["class_bias"], classes)
            wrong /= len(live)
            grads["to_class"], grads["class_bias"] = s.T @ wrong, wrong.sum(0)
            back = wrong @ w["to_class"].T
            edges = np.searchsorted(classes, np.arange(len(self.bounds)))
            for c in np.flatnonzero((np.diff(edges) > 0) & (np.diff(self.bounds) > 1)).tolist():
                (a, b), rows = self.bounds[c:c + 2], slice(edges[c], edges[c + 1])
                out = w["to_symbol"][a:b]
                wrong, part = _softmax_error(s[rows] @ out.T + w["symbol_bias"][a:b], wanted[rows] - a)
                wrong /= len(live)
                loss += part
                grads["to_symbol"][a:b], grads["symbol_bias"][a:b] = wrong.T @ s[rows], wrong.sum(0)
                back[rows] += wrong @ out
            after[live] = back
        after = after.reshape(steps, width, n)
        update, reset, candidate, recurrent = kept
        to_candidate = (1 - update) * (1 - candidate ** 2)
        to_update = (entered - candidate) * update * (1 - update)
        to_reset = recurrent * reset * (1 - reset)
        through, given_grad = np.empty((2, steps, width, 3 * n), given.dtype)
        later, back_state = np.zeros((width, n), given.dtype), np.ascontiguousarray(w["state"].T)
        for t in range(steps - 1, -1, -1):
            d = later + after[t]
            g = given_grad[t]
            np.multiply(d, to_update[t], out=g[:, :n])
            np.multiply(d, to_candidate[t], out=g[:, 2 * n:])
            np.multiply(g[:, 2 * n:], to_reset[t], out=g[:, n:2 * n])
            through[t, :, :2 * n] = g[:, :2 * n]
            np.multiply(g[:, 2 * n:], reset[t], out=through[t, :, 2 * n:])
            later = d * update[t] + through[t] @ back_state
            if keeps[t] is not None:
                later *= keeps[t]
        grads["state"] = entered.reshape(-1, n).T @ through.reshape(-1, 3 * n)
        # Every input is one of the symbols: their gradients are added up before the products.
        order = np.argsort(before.ravel(), kind="stable")
        met = before.ravel()[order]
        firsts = np.flatnonzero(np.append(True, np.diff(met) > 0))
        # Differences of running sums: quicker than a sum for each stretch.
        upto = np.cumsum(given_grad.reshape(-1, 3 * n).take(order, axis=0), axis=0, dtype=np.float64)
        sums = np.diff(upto[np.append(firsts[1:], len(met)) - 1], axis=0, prepend=0.0).astype(given.dtype)
        grads["bias"] = sums.sum(0)
        grads["input"] = w["embed"][met[firsts]].T @ sums
        grads["embed"][met[firsts]] = sums @ w["input"].T
        return grads, states[-1], loss

    def train(self, texts: list[np.ndarray], batch: int = 64) -> tuple[Model, int]:
        """One pass over whole texts (each with its end); the trained model and the symbols seen."""
        trainer = Trainer(self)
        seen = trainer.feed(texts, batch)
        return trainer.model, seen


class Trainer:
    """A model in training: its weights and the moments of their gradients, which last from feed to feed."""

    def __init__(self, model: Model, rate: float = 0.01, clip: float = 1.0):
        self.rate, self.clip, self.updates = rate, clip, 0
        self.values = model.flat().astype(np.float32)
        self.model = Model(model.bounds, _views(model.weights, self.values))
        self.first, self.second, self.spare = (np.zeros_like(self.values) for _ in range(3))
        self.grads = np.zeros_like(self.values)
        self.parts = _views(model.weights, self.grads)

    def feed(self, texts: list[np.ndarray], batch: int = 64) -> int:
        """Truncated backpropagation through time over whole texts, each once; symbols seen.

        Texts run in ``batch`` streams side by side, one behind the other, so that windows are full; each window goes back
        to its own start and hands its state on. A text of more than ``SEGMENT`` symbols runs in parts, whose states start
        empty, so that it does not run on alone.
        """
        if not texts:
            return 0
        parts, befores = [], []
        for text in texts:
            before = np.append(np.int32(END), text[:-1])
            for at in range(0, len(text), SEGMENT):
                parts.append(text[at:at + SEGMENT])
                befores.append(before[at:at + SEGMENT])
        lengths = np.array([len(p) for p in parts])
        order, starts, loads = _streams(lengths, batch, np.random.default_rng(len(parts)))
        symbols, before = (np.concatenate([held[i] for i in order]) for held in (parts, befores))
        fresh = np.zeros(len(symbols), bool)
        fresh[np.cumsum(lengths[order]) - lengths[order]] = True
        h = np.zeros((len(loads), HIDDEN), np.float32)
        for at in range(0, int(loads[0]), WINDOW):
            live = int(np.searchsorted(-loads, -at, "left"))
            steps = np.arange(at, min(at + WINDOW, int(loads[0])))[:, None]
            on = steps < loads[:live]
            places = np.where(on, starts[:live] + steps, 0)
            grads, h, _ = self.model.gradients(before[places], symbols[places], on, h[:live], fresh[places] & on)
            self.update(grads, min(1.0, int(on.sum()) / (batch * WINDOW / 4)))
        return len(symbols)

    def update(self, grads: dict[str, np.ndarray], share: float) -> None:
        for k, g in grads.items():
            self.parts[k][...] = g
        g, first, second, spare = self.grads, self.first, self.second, self.spare
        self.updates += 1
        g *= min(1.0, self.clip / max(math.sqrt(float(np.vdot(g, g))), 1e-9))
        first *= 0.9
        np.multiply(g, 0.1, out=spare)
        first += spare
        g *= g
        g *= 0.001
        second *= 0.999
        second += g
        np.sqrt(second, out=spare)
        spare += 1e-8
        np.divide(first, spare, out=spare)
        spare *= self.rate * math.sqrt(1 - 0.999 ** self.updates) / (1 - 0.9 ** self.updates) * share
        self.values -= spare


def _streams(lengths: np.ndarray, most: int, rng: np.random.Generator | None = None) -> tuple[np.ndarray, ...]:
    """Deals texts into at most ``most`` streams of nearly equal length, the longest stream first: the texts in the
    streams' order (in each drawn by ``rng``), where each stream starts, and its length."""
    held = [(0, n, []) for n in range(min(most, len(lengths)))]
    for i in np.argsort(-lengths, kind="stable").tolist():  # the next longest goes where least is
        load, n, members = held[0]
        members.append(i)
        heapq.heapreplace(held, (load + int(lengths[i]), n, members))
    held.sort(key=lambda x: (-x[0], x[1]))
    order = np.array([i for _, _, members in held for i in (rng.permutation(members) if rng else members)])
    loads = np.array([load for load, _, _ in held])
    return order, np.cumsum(loads) - loads, loads


def _views(like: dict[str, np.ndarray], flat: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of the shapes of ``like`` that lie in ``flat``, in the order of ``Model.flat``."""
    views, at = {}, 0
    for n in sorted(like):
        views[n] = flat[at:at + like[n].size].reshape(like[n].shape)
        at += like[n].size
    return views


def _softmax_error(scores: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, float]:
    """Probabilities less 1 at the wanted ones, in the place of ``scores``, and the summed loss."""
    rows = np.arange(len(wanted))
    picked, sums = _exponentials(scores, rows, wanted)
    loss = float(np.log(sums).sum() - picked.sum())
    scores /= sums[:, None]
    scores[rows, wanted] -= 1
    return scores, loss


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = 0.5 * x
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _log_softmax(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Logarithms of the wanted ones' probabilities; ``scores`` are used up."""
    picked, sums = _exponentials(scores, np.arange(len(wanted)), wanted)
    return picked - np.log(sums)


def _exponentials(scores: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The wanted scores and each row's sum of exponentials, which take the place of ``scores``; both less a shift."""
    top = scores.max()
    # One shift for all rows is quick, and safe while no row can vanish under it.
    scores -= top if top - scores.min() < 60 else scores.max(1, keepdims=True)
    picked = scores[rows, wanted]
    np.exp(scores, out=scores)
    return picked, scores @ np.ones(scores.shape[1], scores.dtype)
