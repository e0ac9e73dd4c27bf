"""A causal self-attention model of subword classes in numpy.

The next id's class follows from attention over the ids before it, added to what the
corpus-wide counts of neighbouring classes say; the id follows from its class by the
corpus-wide counts of ids.  The frequent ids have classes of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CLASSES, OWN_CLASSES = 128, 96
INPUTS, BEFORE = 2048, 512
WIDTH = 16
STEP, WINDOW = 32, 48
NO_TOKEN = -1
CLASS_STRENGTH, ID_STRENGTH = 16.0, 4.0
MOST_SCORE, MOST_OUTPUT = 30.0, 4.0
BLOCK, ROWS = 32, 256

Arrays = dict[str, np.ndarray]


@dataclass
class Counts:
    """What corpus-wide counts of ids and of neighbouring ids decide.

    Every id has a class and an input row; the last row stands for all infrequent ids.
    The ``before`` first rows, the last of them for all others, tell the id before.
    """

    of_id: np.ndarray
    input_of: np.ndarray
    in_class: np.ndarray
    n_classes: int
    n_inputs: int
    n_before: int
    next_class: np.ndarray | None = None
    next_id: np.ndarray | None = None
    room: np.ndarray | None = None

    @classmethod
    def of_ids(cls, counts: np.ndarray, classes: int = CLASSES, own: int = OWN_CLASSES, inputs: int = INPUTS, before: int = BEFORE) -> Counts:
        """The most frequent ids have a class of their own; the others share classes of
        about equal mass.  An id that was never counted has the mass 1, as others 1 more."""
        order = np.lexsort((np.arange(len(counts)), -counts))
        mass = counts + 1.0
        of_id = np.empty(len(counts), np.int64)
        of_id[order[:own]] = np.arange(min(own, len(counts)))
        rest = order[own:]
        earlier = np.cumsum(mass[rest]) - mass[rest]
        of_id[rest] = own + np.floor(earlier / max(1.0, mass[rest].sum()) * (classes - own)).astype(np.int64)
        per_class = np.bincount(of_id, mass, classes)
        input_of = np.full(len(counts), inputs - 1, np.int64)
        input_of[order[: inputs - 1]] = np.arange(min(inputs - 1, len(counts)))
        return cls(of_id, input_of, mass / per_class[of_id], classes, inputs, before)

    def before_of(self, ids: np.ndarray) -> np.ndarray:
        return np.minimum(self.input_of[ids], self.n_before - 1)

    def neighbours(self, before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Dense counts of (row of the id before, class) and of (row of the id before, input row)."""
        row = self.before_of(before)
        classes = np.bincount(row * self.n_classes + self.of_id[ids], minlength=self.n_before * self.n_classes)
        inputs = np.bincount(row * self.n_inputs + self.input_of[ids], minlength=self.n_before * self.n_inputs)
        return classes, inputs

    def with_neighbours(self, classes: np.ndarray, inputs: np.ndarray) -> Counts:
        """Add P(class | id before), and what P(id | class, id before) follows from."""
        classes = classes.reshape(self.n_before, self.n_classes)
        share = classes.sum(axis=0) + 1.0
        share /= share.sum()
        self.next_class = ((classes + CLASS_STRENGTH * share) / (classes.sum(axis=1, keepdims=True) + CLASS_STRENGTH)).astype(np.float32)
        self.next_id = inputs.reshape(self.n_before, self.n_inputs).astype(np.float32)
        self.next_id[:, -1] = 0
        class_of_input = np.zeros(self.n_inputs, np.int64)
        class_of_input[self.input_of] = self.of_id
        self.room = np.zeros((self.n_before, self.n_classes), np.float32)
        np.add.at(self.room.T, class_of_input, self.next_id.T)
        self.room += np.float32(ID_STRENGTH)
        return self

    def inside(self, row: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """P(id | its class, row of the id before), which sum to 1 over the class."""
        held = self.next_id[row, self.input_of[ids]].astype(np.float64) + ID_STRENGTH * self.in_class[ids]
        return held / self.room[row, self.of_id[ids]]


def first_parameters(seed: int = 3, inputs: int = INPUTS, width: int = WIDTH, classes: int = CLASSES, window: int = WINDOW) -> Arrays:
    """The output layer starts at 0: an untrained model says what the counts say."""
    rng = np.random.default_rng(seed)
    normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    return {
        "embed": normal(0.5, inputs + 1, width),
        "direct": normal(0.1, inputs + 1, width),
        "query": normal(width**-0.5, width, width),
        "key": normal(width**-0.5, width, width),
        "value": normal(width**-0.5, width, width),
        "distance": np.zeros(window, np.float32),
        "output": np.zeros((width, classes), np.float32),
    }


def flat(parameters: Arrays) -> np.ndarray:
    return np.concatenate([parameters[k].ravel() for k in sorted(parameters)])


def shaped(values: np.ndarray, like: Arrays) -> Arrays:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32, copy=False)
        at += like[k].size
    return out


def windows(ids: np.ndarray, sizes: np.ndarray, start_id: int, step: int = STEP, window: int = WINDOW, chosen: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """(context, target) of all ids of several documents, one row for each ``step`` targets,
    or of the ``chosen`` rows.

    A row's ``window`` context ids end with the one before its last target; the rows of
    a document overlap by ``window - step`` ids, and each id is a target once.  A
    document starts with ``start_id``; places outside of it hold NO_TOKEN.
    """
    n_rows = -(-sizes // step)
    row_doc = np.repeat(np.arange(len(sizes)), n_rows)
    first = ((np.arange(len(row_doc)) - np.repeat(np.cumsum(n_rows) - n_rows, n_rows)) * step)[chosen]
    row_doc = row_doc[chosen]
    start, size = (np.cumsum(sizes) - sizes)[row_doc], sizes[row_doc]
    last = max(0, len(ids) - 1)
    place = first[:, None] + np.arange(step)
    target = ids[np.minimum(start[:, None] + place, last)]
    target[place >= size[:, None]] = NO_TOKEN
    # Context place p holds the id before target p: the start for the first target.
    place = first[:, None] + np.arange(step - window, step) - 1
    context = ids[np.clip(start[:, None] + place, 0, last)]
    context[place == -1] = start_id
    context[(place < -1) | (place >= size[:, None])] = NO_TOKEN
    return context, target


class Attention:
    """The model: parameters of the attention, and the counts it starts from."""

    def __init__(self, parameters: Arrays, counts: Counts):
        self.p, self.counts = parameters, counts
        self.window = len(parameters["distance"])
        # A place that holds no id has an input row of its own, which no query may see.
        self.nothing = len(parameters["embed"]) - 1

    def _distances(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """How far each query of a window is from each place, and which places it may see."""
        distance = np.arange(self.window - step, self.window)[:, None] - np.arange(self.window)[None, :]
        return np.maximum(distance, 0), (distance >= 0).astype(np.float32)

    def _tables(self) -> Arrays:
        """What places give and queries take by their input rows: (key, value, 1) and (query,
        direct).  The place that holds no id has no value and counts 0."""
        p, width = self.p, self.p["embed"].shape[1]
        seen = np.empty((len(p["embed"]), 2 * width + 1), p["embed"].dtype)
        np.matmul(p["embed"], np.concatenate([p["key"], p["value"]], axis=1), out=seen[:, : 2 * width])
        seen[:, 2 * width] = 1
        seen[self.nothing, width:] = 0
        return {"seen": seen, "asked": np.concatenate([p["embed"] @ (p["query"] * seen.dtype.type(width**-0.5)), p["direct"]], axis=1)}

    def _inputs(self, context: np.ndarray) -> np.ndarray:
        return np.where(context == NO_TOKEN, self.nothing, self.counts.input_of.take(context))

    def _buffers(self, step: int) -> Arrays:
        """Arrays that the blocks of windows share, so that they stay in a core's cache."""
        kind, classes = self.p["embed"].dtype, self.counts.n_classes
        distance, causal = self._distances(step)
        made = {c: np.empty((BLOCK, step, self.window), kind) for c in ("a", "d_a")}
        made |= {"e": np.empty((ROWS, classes), kind), "next": np.empty((ROWS, classes), self.counts.next_class.dtype)}
        return made | {"bias": self.p["distance"][distance], "causal": causal, "ones": np.ones(classes, kind)}

    def _forward(self, x: np.ndarray, tables: Arrays, buffers: Arrays) -> Arrays:
        """Up to ``BLOCK`` windows; ``a`` is not divided by its sums."""
        step, width = buffers["a"].shape[1], self.p["embed"].shape[1]
        mine = x[:, -step:]
        seen, asked = tables["seen"].take(x, axis=0), tables["asked"].take(mine, axis=0)
        turned = np.ascontiguousarray(seen.transpose(0, 2, 1))
        a = np.matmul(asked[:, :, :width], turned[:, :width], out=buffers["a"][: len(x)])
        a += buffers["bias"]
        np.clip(a, -MOST_SCORE, MOST_SCORE, out=a)
        np.exp(a, out=a)
        a *= buffers["causal"]
        mixed = a @ seen[:, :, width:]
        # A query outside of its document sees nothing, and is not a target.
        part = 1 / np.maximum(mixed[:, :, width:], a.dtype.type(1e-20))
        mixed = mixed[:, :, :width] * part
        h = mixed + asked[:, :, width:]
        slope = 1 / (np.abs(h) + a.dtype.type(1))
        h *= slope
        return {"seen": seen, "asked": asked, "turned": turned, "a": a, "part": part, "mixed": mixed, "h": h.reshape(-1, width), "slope": slope, "row": np.minimum(mine, self.counts.n_before - 1).ravel()}

    def _classes(self, f: Arrays, buffers: Arrays) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For some queries at a time: which, their classes' shares before they are divided
        by their sum, and the sum."""
        for at in range(0, len(f["h"]), ROWS):
            some = slice(at, min(at + ROWS, len(f["h"])))
            e = np.matmul(f["h"][some], self.p["output"], out=buffers["e"][: some.stop - at])
            np.exp(e, out=e)
            e *= self.counts.next_class.take(f["row"][some], axis=0, out=buffers["next"][: some.stop - at], mode="clip")
            yield some, e, e @ buffers["ones"]

    def log_probabilities(self, context: np.ndarray, target: np.ndarray, rows: int = BLOCK) -> np.ndarray:
        """ln P of each target after its context, 0 where there is none."""
        out, step = np.zeros(target.shape), target.shape[1]
        tables, buffers, x = self._tables(), self._buffers(step), self._inputs(context)
        for at in range(0, len(target), min(rows, BLOCK)):
            wanted = target[at : at + min(rows, BLOCK)]
            f = self._forward(x[at : at + min(rows, BLOCK)], tables, buffers)
            ids = np.maximum(wanted, 0).ravel()
            goal = self.counts.of_id.take(ids)
            found = np.concatenate([e[np.arange(len(e)), goal[some]].astype(np.float64) / total for some, e, total in self._classes(f, buffers)])
            p = np.log(found * self.counts.inside(f["row"], ids))
            out[at : at + len(wanted)] = np.where(wanted != NO_TOKEN, p.reshape(wanted.shape), 0.0)
        return out

    def documents(self, ids: np.ndarray, sizes: np.ndarray, start_id: int, rows: int = 1 << 13) -> np.ndarray:
        """ln P of each of several documents, whose ids follow each other."""
        n_rows = -(-sizes // STEP)
        row_doc = np.repeat(np.arange(len(sizes)), n_rows)
        total = np.zeros(len(sizes))
        for at in range(0, len(row_doc), rows):
            context, target = windows(ids, sizes, start_id, window=self.window, chosen=slice(at, at + rows))
            own = row_doc[at : at + rows]
            total += np.bincount(own, self.log_probabilities(context, target).sum(axis=1), len(sizes))
        return total

    def gradient(self, context: np.ndarray, target: np.ndarray) -> tuple[float, Arrays]:
        """The mean loss of the targets' classes, and its gradient."""
        wanted = np.where(target == NO_TOKEN, NO_TOKEN, self.counts.of_id.take(np.maximum(target, 0)))
        shares, gradient = self._gradient(self._inputs(context), wanted, self._buffers(target.shape[1]))
        return float(-np.log(shares[wanted.ravel() != NO_TOKEN]).mean(dtype=np.float64)), gradient

    def _gradient(self, x: np.ndarray, wanted: np.ndarray, buffers: Arrays) -> tuple[np.ndarray, Arrays]:
        """The wanted classes' probabilities, and the gradient of the mean loss, from input
        rows and classes.  What is added to the tables is summed by input rows before it goes
        on to the layers."""
        p, step = self.p, wanted.shape[1]
        width, kind = p["embed"].shape[1], p["embed"].dtype
        tables = self._tables()
        buffers["bias"] = p["distance"][self._distances(step)[0]]
        valid = wanted != NO_TOKEN
        n_valid, shares = valid.sum(), np.empty(wanted.size, kind)
        d_seen, d_asked = np.empty((*x.shape, 2 * width), kind), np.empty((len(x), step, 2 * width), kind)
        d_output, d_distance = np.zeros_like(p["output"]), np.zeros((step, self.window), kind)
        back = np.ascontiguousarray(p["output"].T)
        for at in range(0, len(x), BLOCK):
            f = self._forward(x[at : at + BLOCK], tables, buffers)
            a, n = f["a"], len(f["a"])
            own, goal = valid[at : at + BLOCK].ravel(), np.maximum(wanted[at : at + BLOCK].ravel(), 0)
            d_sum = np.empty_like(f["h"])
            for some, e, total in self._classes(f, buffers):
                place = np.arange(len(e)), goal[some]
                found = e[place]
                np.divide(found, total, out=shares[at * step :][some])
                e[place] = found - total
                weight = (own[some] / (n_valid * total)).astype(kind)[:, None]
                d_output += (f["h"][some] * weight).T @ e
                np.multiply(e @ back, weight, out=d_sum[some])
            d_sum = d_sum.reshape(f["mixed"].shape) * np.square(f["slope"])
            # The mean over the places is taken off by the 1 that each of them counts.
            d_mixed = np.empty((n, step, width + 1), kind)
            shared = np.multiply(d_sum, f["part"], out=d_mixed[:, :, :width])
            np.negative(np.einsum("ijk,ijk->ij", shared, f["mixed"]), out=d_mixed[:, :, width])
            d_a = np.matmul(d_mixed, f["turned"][:, width:], out=buffers["d_a"][:n])
            d_a *= a
            block = slice(at, at + n)
            d_asked[block, :, :width] = d_a @ f["seen"][:, :, :width]
            d_asked[block, :, width:] = d_sum
            d_seen[block, :, :width] = d_a.transpose(0, 2, 1) @ f["asked"][:, :, :width]
            d_seen[block, :, width:] = a.transpose(0, 2, 1) @ shared
            d_distance += d_a.sum(axis=0)
        seen, asked = _rows_added(x, d_seen, len(p["embed"])), _rows_added(x[:, -step:], d_asked, len(p["embed"]))
        seen[self.nothing] = 0
        summed = np.concatenate([seen, asked[:, :width] * kind.type(width**-0.5)], axis=1)
        layers = np.concatenate([p["key"], p["value"], p["query"]], axis=1)
        d_key, d_value, d_query = np.split(p["embed"].T @ summed, 3, axis=1)
        gradient = {"output": d_output, "direct": asked[:, width:], "embed": summed @ layers.T, "query": d_query, "key": d_key, "value": d_value}
        gradient["distance"] = np.bincount(self._distances(step)[0].ravel(), d_distance.ravel(), self.window).astype(kind)
        return shares, gradient

    def learn(self, context: np.ndarray, target: np.ndarray, rng: np.random.Generator, rate: float, batch: int = 128) -> None:
        """One pass over the windows in random order, by Adam."""
        # The parameters are parts of one array, which a step changes at once.
        values = flat(self.p)
        self.p = shaped(values, self.p)
        first, second, change = np.zeros_like(values), np.zeros_like(values), np.empty_like(values)
        x, buffers = self._inputs(context), self._buffers(target.shape[1])
        wanted = np.where(target == NO_TOKEN, NO_TOKEN, self.counts.of_id.take(np.maximum(target, 0)))
        order, done = rng.permutation(len(context)), 0
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            _, gradient = self._gradient(x[rows], wanted[rows], buffers)
            g = flat(gradient)
            done += 1
            first += np.multiply(np.subtract(g, first, out=change), 0.1, out=change)
            np.multiply(g, g, out=g)
            second += np.multiply(np.subtract(g, second, out=change), 0.01, out=change)
            np.sqrt(np.divide(second, 1 - 0.99**done, out=change), out=change)
            change += 1e-6
            np.divide(first, change, out=change)
            change *= rate / (1 - 0.9**done)
            values -= change
            np.clip(self.p["output"], -MOST_OUTPUT, MOST_OUTPUT, out=self.p["output"])


def _rows_added(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows that belong to each index."""
    at, out = at.ravel(), np.empty((n, rows.shape[-1]), rows.dtype)
    for k, column in enumerate(np.ascontiguousarray(rows.reshape(len(at), -1).T)):
        out[:, k] = np.bincount(at, column, n)
    return out
