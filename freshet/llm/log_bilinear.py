"""A log-bilinear language model in numpy, trained by noise-contrastive estimation.

The two symbols before a position are mapped to vectors, each by a matrix of its place; their sum is the predicted vector, and a symbol's
score its product with the symbol's own vector plus a bias. Training contrasts observed symbols with draws from
the unigram distribution, without normalising; for scoring, all contexts' scores come from one matrix product and are normalised.

``train`` is that for a small dense cube of counts. ``Vocabulary`` and ``Weights`` are the same model for vocabularies that grow with the
corpus: symbols go by falling count and are cut into classes of about 1 / sqrt(frequency) symbols, a symbol's probability is that of
its class times its own within the class, and both are trained by contrast with noise and normalised exactly in blocks of matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

DIMENSIONS, NOISE, STEPS, BATCH, RATE = 16, 10, 1000, 2048, 0.08


def train(counts: np.ndarray, begin: int, steps: int = STEPS, seed: int = 3) -> np.ndarray:
    """counts[second last, last, symbol] -> natural logarithms of the normalised probabilities, same shape."""
    n = counts.shape[0]
    rng = np.random.default_rng(seed)
    context, output = rng.normal(0, 0.1, (n, DIMENSIONS)), rng.normal(0, 0.1, (n, DIMENSIONS))
    places = [np.eye(DIMENSIONS) * 0.5, np.eye(DIMENSIONS) * 0.5]
    noise = counts.sum(axis=(0, 1)) + 1.0
    noise[begin] = 1e-9
    noise /= noise.sum()
    bias = np.log(noise)
    at = np.flatnonzero(counts)
    if len(at):
        drawn, drawn_noise = np.cumsum(counts.ravel()[at] / counts.sum()), np.cumsum(noise)
        params = [context, output, *places, bias]
        squares = [np.full_like(p, 1e-6) for p in params]
        rows, handicap = np.arange(BATCH)[:, None], np.log(NOISE * noise)
        for _ in range(steps):
            codes = at[np.minimum(np.searchsorted(drawn, rng.random(BATCH)), len(at) - 1)]
            before = [codes // (n * n), codes // n % n]
            noisy = np.minimum(np.searchsorted(drawn_noise, rng.random((BATCH, NOISE))), n - 1)
            symbols = np.hstack([(codes % n)[:, None], noisy])
            vectors = [context[b] for b in before]
            predicted = sum(v @ m for v, m in zip(vectors, places, strict=True))
            score = (predicted @ output.T)[rows, symbols] + bias[symbols] - handicap[symbols]
            error = -1 / (1 + np.exp(-np.clip(score, -30, 30)))
            error[:, 0] += 1
            spread = np.bincount((rows * n + symbols).ravel(), error.ravel(), BATCH * n).reshape(BATCH, n)
            back = spread @ output
            d_context = np.zeros_like(context)
            for b, m in zip(before, places, strict=True):
                d_context += np.eye(n)[b].T @ (back @ m.T)
            steps_up = [d_context, spread.T @ predicted, *(v.T @ back for v in vectors), spread.sum(axis=0)]
            for p, q, g in zip(params, squares, steps_up, strict=True):
                g = g / BATCH
                q += g * g
                p += RATE * g / np.sqrt(q)
    predicted = ((context @ places[0])[:, None, :] + (context @ places[1])[None, :, :]).reshape(n * n, DIMENSIONS)
    score = predicted @ output.T + bias
    score[:, begin] = -np.inf
    score -= score.max(axis=1, keepdims=True)
    return (score - np.log(np.exp(score).sum(axis=1, keepdims=True))).reshape(n, n, n)


#: Noise classes a batch, tokens of a class that share noise symbols, and how many, tokens a batch, learning rate, rows of a block of products.
CLASS_NOISE, SHARERS, OWN_NOISE, TOKENS, STEP, BLOCK = 128, 8, 4, 4096, 0.05, 4096
#: Entries of a block of products.
CACHED = 1 << 17


@dataclass
class Vocabulary:
    """counts: training occurrences by symbol, falling. The number after the last symbol stands for the beginning, which is never predicted."""

    counts: np.ndarray

    def __post_init__(self):
        share = (self.counts + 1.0) / (self.counts + 1.0).sum()
        number = np.floor(np.cumsum(np.sqrt(share)) - np.sqrt(share) / 2).astype(np.int64)
        self.of = np.unique(number, return_inverse=True)[1]
        self.bounds = np.searchsorted(self.of, np.arange(self.of[-1] + 2))
        self.cumulated = np.concatenate(([0.0], np.cumsum(share)))
        self.class_share = np.diff(self.cumulated[self.bounds])
        self.own_share = share / self.class_share[self.of]


class Weights:
    """context: a row a symbol; own: a row each of vector and bias; classes: a row each of vector and bias; places: two matrices."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 3):
        rng, n, c = np.random.default_rng(seed), len(vocabulary.counts), len(vocabulary.class_share)
        self.context = rng.normal(0, 0.1, (n + 1, DIMENSIONS)).astype(np.float32)
        self.own = rng.normal(0, 0.1, (n + 1, DIMENSIONS + 1)).astype(np.float32)
        self.own[:n, -1], self.own[n, -1] = np.log(vocabulary.own_share), 0
        self.classes = rng.normal(0, 0.1, (c, DIMENSIONS + 1)).astype(np.float32)
        self.classes[:, -1] = np.log(vocabulary.class_share)
        self.places = np.stack([np.eye(DIMENSIONS, dtype=np.float32) * 0.5] * 2)

    def predicted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.context.take(x, 0) @ self.places[0] + self.context.take(y, 0) @ self.places[1]

    def log_probabilities(self, vocabulary: Vocabulary, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Natural logarithms of the normalised probabilities of the symbols z after x and y."""
        order = np.argsort(z.astype(np.int32))  # by symbol, and so by class
        x, y, z = (v.take(order) for v in (x, y, z))
        of, out, predicted = vocabulary.of.take(z), np.empty(len(z)), np.empty((len(z), DIMENSIONS), np.float32)
        for a in range(0, len(z), BLOCK):
            predicted[a : a + BLOCK] = self.predicted(x[a : a + BLOCK], y[a : a + BLOCK])
        step = _lines(len(self.classes))
        for a in range(0, len(z), step):
            s = slice(a, a + step)
            out[s] = _log_share(predicted[s], self.classes, of[s])
        starts = _starts(of).tolist() if len(z) else []
        for a, b in zip(starts, [*starts[1:], len(z)], strict=False):  # none without tokens
            low, high = vocabulary.bounds[of[a]], vocabulary.bounds[of[a] + 1]
            rows, step = self.own[low:high], _lines(high - low)
            for s in (slice(i, min(b, i + step)) for i in range(a, b, step)) if high - low > 1 else ():
                out[s] += _log_share(predicted[s], rows, z[s] - low)
        whole = np.empty(len(z))
        whole[order] = out
        return whole


def _lines(width: int) -> int:
    """Rows of a block of products that stays in the processor's cache."""
    return max(16, CACHED // int(width))


def _log_share(predicted: np.ndarray, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Normalised logarithms; the last column of the rows is their bias."""
    vectors, bias = rows[:, :-1], rows[:, -1]
    score = predicted @ vectors.T
    mine = score[np.arange(len(own)), own] + bias.take(own)
    with np.errstate(over="ignore", invalid="ignore"):
        total = np.exp(score, out=score) @ np.exp(bias)
    if not np.isfinite(total).all() or not total.all():  # scores that are out of range without scaling
        score = predicted @ vectors.T + bias
        top = score.max(axis=1)
        return mine - top - np.log(np.exp(score - top[:, None]).sum(axis=1))
    return mine - np.log(total)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _starts(x: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1]))


def _sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows. Most runs are short: their second, third .. rows are added in rounds, what is left of long ones in one call."""
    ends = np.append(starts[1:], len(rows))
    out, live, done = rows.take(starts, 0), np.flatnonzero(ends - starts > 1), 1
    while len(live) > 64 and done < 8:
        out[live] += rows.take(starts.take(live) + done, 0)
        done += 1
        live = live[(ends - starts).take(live) > done]
    if len(live):
        bounds = np.column_stack([starts[live] + done, ends[live]]).ravel()
        out[live] += np.add.reduceat(rows, bounds[:-1] if bounds[-1] == len(rows) else bounds, axis=0)[::2]
    return out


def _rise(rows: np.ndarray, squares: np.ndarray, at: np.ndarray, up: np.ndarray) -> None:
    """Adds the steps ``up`` to the rows ``at``, which may repeat, scaled by what each row has seen."""
    order = np.argsort(at)
    sorted_ = at.take(order)
    first = _starts(sorted_)
    own, total = sorted_.take(first), _sums(up.take(order, 0), first)
    seen = squares.take(own) + np.einsum("ij,ij->i", total, total) / total.shape[1]
    squares[own] = seen
    total *= (STEP / np.sqrt(seen + 1e-6))[:, None]
    rows[own] = rows.take(own, 0) + total


class Trainer:
    """Noise-contrastive steps over all tokens that it is fed, each once."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 3):
        self.vocabulary, self.weights, self.rng, self.seen = vocabulary, Weights(vocabulary), np.random.default_rng(seed), 0
        n, c = len(vocabulary.counts), len(vocabulary.class_share)
        self.context, self.own, self.classes, self.places = np.zeros(n + 1, np.float32), np.zeros(n + 1, np.float32), np.zeros(c, np.float32), np.full((2, DIMENSIONS, DIMENSIONS), 1e-6, np.float32)
        self.of, self.class_sums = vocabulary.of.astype(np.int32), np.cumsum(vocabulary.class_share)
        self.class_handicap = np.log(CLASS_NOISE * vocabulary.class_share).astype(np.float32)
        self.own_handicap = np.log(OWN_NOISE * vocabulary.own_share).astype(np.float32)

    def feed(self, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> None:
        """Trains on all these tokens in random order."""
        order = self.rng.permutation(len(z))
        x, y, z = (v.astype(np.int32).take(order) for v in (x, y, z))
        for a in range(0, len(z), TOKENS):
            b = a + TOKENS
            by_symbol = np.argsort(z[a:b])  # and so by class
            self._step(*(v[a:b].take(by_symbol) for v in (x, y, z)))
        self.seen += len(z)

    def _step(self, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> None:
        """A step on tokens in the order of their symbols."""
        v, w, d = self.vocabulary, self.weights, DIMENSIONS
        kind, words = self.of.take(z), _starts(z)
        context = [w.context.take(i, 0) for i in (x, y)]
        # a class's tokens fill groups of SHARERS; empty places are zero and add nothing
        first = _starts(kind)
        kinds, sizes = kind.take(first), np.diff(np.append(first, len(kind)))
        groups = -(-sizes // SHARERS)
        place = np.arange(len(z)) + np.repeat(SHARERS * (np.cumsum(groups) - groups) - first, sizes)
        n = int(groups.sum())
        all_ = np.zeros((n * SHARERS, d + 1), np.float32)
        predicted = np.ones((len(z), d + 1), np.float32)
        predicted[:, :d] = context[0] @ w.places[0] + context[1] @ w.places[1]
        all_[place] = predicted
        # classes: the same noise for all tokens of the batch
        drawn = np.minimum(np.searchsorted(self.class_sums, self.rng.random(CLASS_NOISE)), len(self.class_sums) - 1)
        rows, noise = w.classes.take(kind, 0), w.classes.take(drawn, 0)
        right = 1 - _sigmoid(np.einsum("ij,ij->i", predicted, rows) - self.class_handicap.take(kind))
        lowered, half = noise.copy(), noise[:, :d] / 2
        lowered[:, d] -= self.class_handicap.take(drawn)
        lowered /= 2
        back, noise_up = rows[:, :d] * right[:, None] - half.sum(axis=0), np.tile(predicted.sum(axis=0), (CLASS_NOISE, 1))
        for a in range(0, len(z), CACHED // CLASS_NOISE):
            s = slice(a, a + CACHED // CLASS_NOISE)
            wrong = predicted[s] @ lowered.T  # a sigmoid is (1 + tanh of the half) / 2
            np.tanh(wrong, out=wrong)
            back[s] -= wrong @ half
            noise_up += wrong.T @ predicted[s]
        class_up = np.zeros_like(w.classes)
        class_up[kinds] = np.add.reduceat(predicted * right[:, None], first, axis=0)
        np.subtract.at(class_up, drawn, noise_up / 2)
        # symbols: noise from the group's class
        rows = w.own.take(z, 0)
        error = 1 - _sigmoid(np.einsum("ij,ij->i", predicted, rows) - self.own_handicap.take(z))
        back += rows[:, :d] * error[:, None]
        low, high = np.repeat(v.bounds.take(kinds), groups)[:, None], np.repeat(v.bounds.take(kinds + 1), groups)[:, None]
        under, over = v.cumulated.take(low), v.cumulated.take(high)
        noisy = np.searchsorted(v.cumulated, under + self.rng.random((n, OWN_NOISE)) * (over - under), "right") - 1
        noisy = np.clip(noisy, low, high - 1).astype(np.int32)
        noise = w.own.take(noisy, 0)
        lowered = noise.copy()
        lowered[:, :, d] -= self.own_handicap.take(noisy)
        grouped = all_.reshape(n, SHARERS, d + 1)
        wrong = _sigmoid(grouped @ lowered.transpose(0, 2, 1))
        back -= (wrong @ noise).reshape(-1, d + 1).take(place, 0)[:, :d]
        own_up = np.concatenate([_sums(predicted * error[:, None], words), -(wrong.transpose(0, 2, 1) @ grouped).reshape(-1, d + 1)])
        context_up = np.concatenate([back @ p.T for p in w.places])
        self.classes += np.einsum("ij,ij->i", class_up, class_up) / (d + 1)
        w.classes += STEP * class_up / np.sqrt(self.classes + 1e-6)[:, None]
        _rise(w.own, self.own, np.concatenate([z.take(words), noisy.ravel()]), own_up)
        _rise(w.context, self.context, np.concatenate([x, y]), context_up)
        g = np.stack([c.T @ back for c in context])
        self.places += g * g
        w.places += STEP * g / np.sqrt(self.places)

    def parts(self, rows: int = 4096) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number, changes and their weights of the classes and places (-1) and of each block of symbols; an untouched vector has no weight."""
        if not self.seen:
            return
        first, w = Weights(self.vocabulary), self.weights
        small = np.concatenate([(w.classes - first.classes).ravel(), (w.places - first.places).ravel()])
        yield -1, small, np.full(1, self.seen, np.float32)
        for b, a in enumerate(range(0, len(w.own), rows)):
            s = slice(a, a + rows)
            yield b, np.hstack([w.context[s] - first.context[s], w.own[s] - first.own[s]]).ravel(), np.stack([self.context[s] > 0, self.own[s] > 0], axis=1).astype(np.float32).ravel()


def spread(weights: np.ndarray) -> np.ndarray:
    """A number a vector -> a number a parameter."""
    return weights if len(weights) == 1 else np.repeat(weights.reshape(-1, 2), [DIMENSIONS, DIMENSIONS + 1], axis=1).ravel()


def averaged(vocabulary: Vocabulary, parts: list[tuple[int, np.ndarray]], rows: int = 4096) -> Weights:
    """The first weights with averaged changes."""
    w = Weights(vocabulary)
    for b, change in parts:
        if b < 0:
            n = w.classes.size
            w.classes += change[:n].reshape(w.classes.shape)
            w.places += change[n:].reshape(w.places.shape)
        else:
            change, s = change.reshape(-1, 2 * DIMENSIONS + 1), slice(b * rows, (b + 1) * rows)
            w.context[s] += change[:, :DIMENSIONS]
            w.own[s] += change[:, DIMENSIONS:]
    return w
