"""A gated recurrent language model in numpy, without Spark.

The output is factored: a softmax over classes of the most frequent words, then
one over the words of the class. The last of these words stands for all others,
which are the leaves of binary trees (``Tail``): each has its own vector when
it is read, and its own probability given the state when it is predicted (a
softmax over the trees, then the turns), at a cost that grows with the
logarithm of their number. Texts of a batch are packed into lanes that are worked off
side by side; a lane's state is carried from window to window and set back
where a new text starts. Training truncates backpropagation at the window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: Words of the softmax, the last one for those of the tail (ids from it on are leaves); classes; units of the state; lanes; steps of a window.
WORDS, CLASSES, UNITS, LANES, WINDOW = 1024, 32, 12, 256, 32
IN_CLASS = WORDS // CLASSES
#: Step size and decay of the running squares (Adam without momentum), largest norm of a gradient.
RATE, DECAY, CLIP = 0.02, 0.99, 5.0
#: Bound of an output's logit; its exponential and their sums stay finite.
FAR = 60.0

#: Columns of a row of the tail: a node's weights and bias, or a leaf's vector. Step size and first sum of squares there (Adagrad).
TAIL_WIDTH, TAIL_RATE, TAIL_START = UNITS + 1, 0.1, 1.0
#: Columns kept for a row: its own, then its sum of squared gradients (their mean) and how often it was moved.
ROW, SQUARES, MOVES = 16, 13, 14
#: Trees of the tail. Longest run of a row's gradients that is summed place by place.
BINS, SHORT = 64, 8

Parameters = dict[str, np.ndarray]
SHAPES = {
    "inputs": (WORDS, 3 * UNITS),
    "gates": (UNITS, 2 * UNITS),
    "fresh": (UNITS, UNITS),
    "class_out": (UNITS, CLASSES),
    "class_bias": (CLASSES,),
    "word_out": (WORDS, UNITS),
    "word_bias": (WORDS,),
    "tail_in": (TAIL_WIDTH, 3 * UNITS),
    "bin_out": (UNITS, BINS),
    "bin_bias": (BINS,),
}


def first_parameters(counts: np.ndarray, seed: int = 1, tree: Tree | None = None) -> Parameters:
    """Small random numbers; the biases start at the frequencies of the words and bins."""
    random = np.random.default_rng(seed)
    made = {k: random.normal(0, 0.1, shape).astype(np.float32) for k, shape in SHAPES.items()}
    share = (counts + 0.5) / (counts + 0.5).sum()
    by_class = share.reshape(CLASSES, IN_CLASS)
    made["class_bias"] = np.log(by_class.sum(axis=1)).astype(np.float32)
    made["word_bias"] = np.log(by_class / by_class.sum(axis=1, keepdims=True)).reshape(-1).astype(np.float32)
    if tree is not None:
        made["bin_bias"] = tree.bin_bias.copy()
    return made


@dataclass(frozen=True)
class Tree:
    """Leaves in a given order, cut into bins of about one weight, each a binary search tree balanced by weight; a node is the first leaf to its right."""

    starts: np.ndarray
    roots: np.ndarray
    children: np.ndarray
    bias: np.ndarray
    bin_bias: np.ndarray

    @property
    def leaves(self) -> int:
        return len(self.bias)

    @cached_property
    def paths(self) -> np.ndarray:
        """Of each leaf, the nodes from its root down, filled up with zeros."""
        every, levels = np.arange(self.leaves), []
        nodes = self.roots.take(np.searchsorted(self.starts, every, "right") - 1)
        while nodes.any():
            levels.append(nodes)
            # a leaf stays at zero where its way has ended
            nodes = np.where(nodes > 0, self.children.take(2 * nodes + (every >= nodes)), 0).astype(np.int32)
        return np.stack(levels, axis=1) if levels else np.zeros((self.leaves, 0), np.int32)


def tree_of(weights: np.ndarray) -> Tree:
    """The tree of at least one leaf with positive weights; by the biases alone, leaves are as likely as their weights."""
    size = len(weights)
    sums = np.concatenate([[0.0], np.cumsum(weights, dtype=np.float64)])
    edges = np.unique(np.append(np.searchsorted(sums, sums[-1] * np.arange(BINS) / BINS), size))
    low, high = edges[:-1], edges[1:]
    bin_bias = np.full(BINS, -FAR, np.float32)
    bin_bias[: len(low)] = np.log((sums[high] - sums[low]) / sums[-1])
    roots, children, bias = np.zeros(len(low), np.int32), np.zeros(2 * size, np.int32), np.zeros(size, np.float32)
    starts, parent, side = low, None, None
    inner = np.flatnonzero(high - low > 1)
    while len(inner):
        low, high = low[inner], high[inner]
        half = (sums[low] + sums[high]) / 2
        middle = np.searchsorted(sums, half)
        # the nearer of the leaves' edges around half the weight
        middle -= half - sums[middle - 1] < sums[middle] - half
        node = np.clip(middle, low + 1, high - 1)
        bias[node] = np.log((sums[high] - sums[node]) / (sums[node] - sums[low]))
        if parent is None:
            roots[inner] = node
        else:
            children[2 * parent[inner] + side[inner]] = node
        low, high = np.concatenate([low, node]), np.concatenate([node, high])
        parent, side = np.concatenate([node, node]), np.repeat([0, 1], len(node))
        inner = np.flatnonzero(high - low > 1)
    return Tree(starts, roots, children, bias, bin_bias)


def first_tail(tree: Tree, seed: int = 2) -> np.ndarray:
    """Rows of nodes, then of leaves."""
    table = np.zeros((2 * tree.leaves, TAIL_WIDTH), np.float32)
    table[: tree.leaves, -1] = tree.bias
    table[tree.leaves :] = np.random.default_rng(seed).normal(0, 0.1, (tree.leaves, TAIL_WIDTH))
    return table


class Tail:
    """Words outside the softmax: the tree, its rows, and beside each row its sum of squares and times moved, in one line of memory."""

    def __init__(self, tree: Tree, table: np.ndarray):
        self.tree = tree
        self.rows = np.zeros((len(table), ROW), table.dtype)
        self.rows[:, SQUARES] = TAIL_START
        self.table = self.rows[:, :TAIL_WIDTH]
        self.table[:] = table

    @property
    def moves(self) -> np.ndarray:
        return self.rows[:, MOVES]

    def vectors(self, leaves: np.ndarray) -> np.ndarray:
        return self.rows.take(self.tree.leaves + leaves, 0)[:, :TAIL_WIDTH]

    def output(self, p: Parameters, hidden: np.ndarray, leaves: np.ndarray, gradients: Parameters | None, moved: list | None):
        """Natural log-probabilities of the rising leaves; with ``moved``, the states' gradient, and the rows' are added there."""
        bins = np.searchsorted(self.tree.starts, leaves, "right") - 1
        result, odds, sums = _softmax(hidden, p["bin_out"], p["bin_bias"], bins)
        back = None
        if moved is not None:
            back = _wrong(odds, sums, bins) @ p["bin_out"].T
            gradients["bin_out"] = hidden.T @ odds
            gradients["bin_bias"] = odds.sum(axis=0)
        # by level, filled up with row 0, which is no node's; as the leaves rise, those below one node are next to each other
        nodes = np.ascontiguousarray(self.tree.paths.take(leaves, 0).T)
        if not nodes.any():
            return result, back
        first, counts = _runs(nodes.reshape(-1))
        rows = np.ascontiguousarray(self.rows.take(nodes.reshape(-1).take(first), 0).T[:TAIL_WIDTH])
        rows = rows.take(np.repeat(np.arange(len(first)), counts), axis=1).reshape(TAIL_WIDTH, *nodes.shape)
        states = np.ascontiguousarray(hidden.T)
        logits = np.einsum("kln,kn->ln", rows[:-1], states)
        logits += rows[-1]
        # 1 to the left of a node, -1 to its right, 0 past the path's end
        side = ((leaves < nodes).astype(np.int8) * 2 - 1) * (nodes > 0)
        logits *= side
        np.clip(logits, -FAR, FAR, out=logits)
        odds = np.exp(logits, out=logits)
        odds += 1
        # at a path's end this is log 2 for each level that is filled up
        result -= np.log(odds).sum(axis=0) - np.log(2) * (nodes == 0).sum(axis=0)
        if moved is not None:
            wrong = np.subtract(1, np.reciprocal(odds, out=odds), out=odds)
            wrong *= side
            back += np.einsum("kln,ln->nk", rows[:-1], wrong)
            np.multiply(states[:, None], wrong, out=rows[:-1])
            rows[-1] = wrong
            self.collect(nodes.reshape(-1), rows.reshape(TAIL_WIDTH, -1), moved)
        return result, back

    def collect(self, rows: np.ndarray, gradients: np.ndarray, moved: list) -> None:
        """Adds the rows with the sums of their columns of ``gradients`` to ``moved``; equal rows are next to each other, row 0 is left out."""
        first, counts = _runs(rows)
        order = np.argsort(-counts, kind="stable")
        order = order[rows.take(first.take(order)) > 0]
        first, counts = first.take(order), counts.take(order)
        sums = gradients.take(first, axis=1)
        # short runs place by place; the few long ones come first
        for place in range(1, SHORT):
            more = int(np.searchsorted(-counts, -place))
            sums[:, :more] += gradients.take(first[:more] + place, axis=1)
        long = int(np.searchsorted(-counts, -SHORT))
        if long:
            order = np.argsort(first[:long])
            edges = np.stack([first[:long], first[:long] + counts[:long]], axis=1)[order].reshape(-1)
            sums[:, order] = np.add.reduceat(gradients[:, : edges[-1]], edges[:-1], axis=1)[:, ::2]
        step = np.zeros((ROW, len(first)), gradients.dtype)
        step[:TAIL_WIDTH], step[MOVES] = sums, counts
        moved.append((rows.take(first), step.T))

    def update(self, moved: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """A step along gradients of rows, which are distinct within an entry; only rows that occur are touched."""
        for rows, step in moved:
            gradients = step.T[:TAIL_WIDTH]
            step.T[SQUARES] = np.einsum("ij,ij->j", gradients, gradients) / TAIL_WIDTH
            gradients *= -TAIL_RATE / np.sqrt(self.rows[rows, SQUARES] + step.T[SQUARES])
            self.rows[rows] = self.rows.take(rows, 0) + step


def _runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal rows start, and their lengths."""
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    return first, np.diff(first, append=len(rows))


def flat(parameters: Parameters) -> np.ndarray:
    return np.concatenate([parameters[k].reshape(-1) for k in SHAPES])


def shaped(values: np.ndarray) -> Parameters:
    made, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        made[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return made


def _lanes(texts: list[np.ndarray], lanes: int) -> list[list[int]]:
    """Texts dealt to lanes, long ones first, each to the shortest lane; the longest lane comes first."""
    heap = [(0, i, []) for i in range(min(lanes, len(texts)))]
    for text in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        size, i, mine = heapq.heappop(heap)
        mine.append(text)
        heapq.heappush(heap, (size + len(texts[text]), i, mine))
    return [mine for _, _, mine in sorted(heap, key=lambda x: (-x[0], x[1]))]


def _windows(texts: list[np.ndarray], lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, starts, owner) of shape (steps, active lanes); the first steps of a lane that begins inside are -1.

    All lanes end together, so that the few longest texts come first and do not have the last word in training. While
    few lanes have begun, windows have more steps, so that all windows have about the same number of tokens.
    """
    dealt = _lanes(texts, lanes)
    order = [i for mine in dealt for i in mine]
    words = np.concatenate([texts[i] for i in order])
    owners = np.repeat(order, [len(texts[i]) for i in order])
    opens = np.zeros(len(words), bool)
    opens[np.cumsum([0, *[len(texts[i]) for i in order[:-1]]])] = True
    lengths = np.array([sum(len(texts[i]) for i in mine) for mine in dealt])
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    left, spans = 0, []
    while left < lengths[0]:
        active = int((lengths > left).sum())
        spans.append((left, min(left + WINDOW * len(dealt) // active, int(lengths[0])), active))
        left = spans[-1][1]
    for end, start, active in reversed(spans):
        steps = lengths[None, :active] - np.arange(start, end, -1)[:, None]
        real = steps >= 0
        place = first[None, :active] + np.maximum(steps, 0)
        yield np.where(real, words[place], -1), real & opens[place], np.where(real, owners[place], -1)


def _softmax(hidden: np.ndarray, weights: np.ndarray, bias: np.ndarray, choices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Natural log-probabilities of the choices, and all odds with their sums."""
    logits = hidden @ weights
    logits += bias
    # a state's units are between -1 and 1
    if (np.abs(weights).sum(axis=0) + np.abs(bias)).max() > FAR:
        np.clip(logits, -FAR, FAR, out=logits)
    result = logits.reshape(-1).take(_places(logits, choices))
    odds = np.exp(logits, out=logits)
    sums = odds @ np.ones(odds.shape[1], odds.dtype)
    result -= np.log(sums)
    return result, odds, sums


def _wrong(odds: np.ndarray, sums: np.ndarray, choices: np.ndarray) -> np.ndarray:
    """The odds turned, in place, into the gradient of the logits."""
    odds *= np.reciprocal(sums)[:, None]
    odds.reshape(-1)[_places(odds, choices)] -= 1
    return odds


def _places(table: np.ndarray, columns: np.ndarray) -> np.ndarray:
    return np.arange(0, table.size, table.shape[1]) + columns


def _rising(ids: np.ndarray) -> np.ndarray:
    """Places of the words of a window, by rising words."""
    ids = ids.reshape(-1)
    return np.argsort(ids)[np.count_nonzero(ids < 0) :]


class Model:
    def __init__(self, parameters: Parameters, tail: Tail | None = None):
        self.p, self.tail = parameters, tail
        #: Share of the fullest window's tokens that this window has; a step goes by it, so that one long text alone does not take the weights along.
        self.share = 1.0

    def _forward(self, ids: np.ndarray, starts: np.ndarray, state: np.ndarray):
        """States before each step and after the last, and the gates and fresh states; all are (units, steps, lanes). Lanes past those of ``state`` begin."""
        p, units = self.p, UNITS
        steps, lanes = ids.shape
        words = ids.reshape(-1)
        begun = state.shape[1]
        places, table = np.clip(words, 0, WORDS - 1), p["inputs"].T
        if self.tail is not None:
            outside = np.flatnonzero(words >= WORDS - 1)
            places[outside] = WORDS + np.arange(len(outside))
            vectors = self.tail.vectors(words[outside] - (WORDS - 1))
            table = np.concatenate([table, table[:, -1:] + p["tail_in"].T @ vectors.T], axis=1)
        # the gates' part is negated, as its sigmoid needs it
        table = table * np.repeat(np.float32([-1, 1]), [2 * units, units])[:, None]
        found = table.astype(np.float32, copy=False).take(places, axis=1).reshape(-1, steps, lanes)
        before = np.empty((units, steps + 1, lanes), np.float32)
        before[:, 0, :begun], before[:, 0, begun:] = state, 0
        gates, fresh = (np.ascontiguousarray(x.T, np.float32) for x in (-p["gates"], p["fresh"]))
        product, inner = np.empty((2 * units, lanes), np.float32), np.empty((units, lanes), np.float32)
        opens = starts.any(axis=1).tolist()
        for t in range(steps):
            state, step = before[:, t], found[:, t]
            if opens[t]:
                state *= ~starts[t]
            gate, g = step[: 2 * units], step[2 * units :]
            gate += np.matmul(gates, state, out=product)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.multiply(gate[units:], state, out=inner)
            g += np.matmul(fresh, inner, out=product[:units])
            np.tanh(g, out=g)
            np.subtract(g, state, out=inner)
            inner *= gate[:units]
            np.add(state, inner, out=before[:, t + 1])
        return before, found

    def _output(self, hidden: np.ndarray, ids: np.ndarray, gradients: Parameters | None, moved: list | None = None):
        """Natural log-probabilities of the rising words, and the gradient of the states if ``gradients`` (and the tail's, ``moved``) are to be filled."""
        p = self.p
        words = np.minimum(ids, WORDS - 1)
        classes, inside = np.divmod(words, IN_CLASS)
        result, odds, sums = _softmax(hidden, p["class_out"], p["class_bias"], classes)
        back = None
        if gradients is not None:
            back = _wrong(odds, sums, classes) @ p["class_out"].T
            gradients["class_out"] = hidden.T @ odds
            gradients["class_bias"] = odds.sum(axis=0)
            gradients["word_out"] = np.zeros_like(p["word_out"])
            gradients["word_bias"] = np.zeros_like(p["word_bias"])
        bounds = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
        for c in range(CLASSES):
            mine = slice(bounds[c], bounds[c + 1])
            if mine.start == mine.stop:
                continue
            span = slice(c * IN_CLASS, (c + 1) * IN_CLASS)
            found, odds, sums = _softmax(hidden[mine], p["word_out"][span].T, p["word_bias"][span], inside[mine])
            result[mine] += found
            if gradients is not None:
                _wrong(odds, sums, inside[mine])
                np.matmul(odds.T, hidden[mine], out=gradients["word_out"][span])
                gradients["word_bias"][span] = odds.sum(axis=0)
                back[mine] += odds @ p["word_out"][span]
        if self.tail is not None:
            outside = slice(int(np.searchsorted(ids, WORDS - 1)), None)
            more, more_back = self.tail.output(p, hidden[outside], ids[outside] - (WORDS - 1), gradients, moved)
            result[outside] += more
            if moved is not None:
                back[outside] += more_back
        return result, back

    def log_probabilities(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each whole text; an empty one has 0."""
        total = np.zeros(len(texts))
        filled = [i for i, t in enumerate(texts) if len(t)]
        if not filled:
            return total
        state = np.zeros((UNITS, 0), np.float32)
        sums = np.zeros(len(filled))
        for ids, starts, owner in _windows([texts[i] for i in filled], LANES):
            before, _ = self._forward(ids, starts, state)
            state = before[:, -1]
            order = _rising(ids)
            found = self._output(before.reshape(UNITS, -1).take(order, axis=1).T, ids.reshape(-1).take(order), None)[0]
            sums += np.bincount(owner.reshape(-1).take(order), weights=found, minlength=len(filled))
        total[filled] = sums
        return total

    def train(self, texts: list[np.ndarray], squares: Parameters) -> None:
        """One pass over the texts; ``squares`` are the running squares of the gradients."""
        texts = [t for t in texts if len(t)]
        if not texts:
            return
        state, windows = np.zeros((UNITS, 0), np.float32), list(_windows(texts, LANES))
        fullest = max(np.count_nonzero(ids >= 0) for ids, *_ in windows)
        for ids, starts, _ in windows:
            before, found = self._forward(ids, starts, state)
            gradients: Parameters = {}
            moved = None if self.tail is None else []
            order = _rising(ids)
            words = ids.reshape(-1).take(order)
            tokens = len(words)
            _, back = self._output(before.reshape(UNITS, -1).take(order, axis=1).T, words, gradients, moved)
            # steps past a lane's end take the column of zeros
            places = np.full(ids.size, tokens)
            places[order] = np.arange(tokens)
            outer = np.concatenate([back.T, np.zeros((UNITS, 1), back.dtype)], axis=1).take(places, axis=1)
            self._backward(order, words, starts, before[:, :-1], found, outer.reshape(UNITS, *ids.shape), gradients, moved)
            self.share = tokens / fullest
            self._update(gradients, squares, tokens)
            if moved is not None:
                self.tail.update(moved)
            state = before[:, -1]

    def _backward(self, order, words, starts, before, found, outer, gradients: Parameters, moved_tail: list | None = None) -> None:
        """``order``: places by rising words."""
        p, units = self.p, UNITS
        _, steps, lanes = before.shape
        z, r, g = found.reshape(3, units, steps, lanes)
        # what a state's gradient is multiplied by, for the whole window
        stay = 1 - z
        at_z, at_r, at_g = (g - before) * (z * stay), before * (r * (1 - r)), z * (1 - g * g)
        moved = np.empty((3 * units, steps, lanes), np.float32)
        coming, product = np.zeros((units, lanes), np.float32), np.empty((units, lanes), np.float32)
        gates, fresh = (np.ascontiguousarray(p[k], np.float32) for k in ("gates", "fresh"))
        opens = starts.any(axis=1).tolist()
        for t in range(steps - 1, -1, -1):
            step = moved[:, t]
            through = np.matmul(fresh, np.multiply(coming, at_g[:, t], out=step[2 * units :]), out=product)
            np.multiply(coming, at_z[:, t], out=step[:units])
            np.multiply(through, at_r[:, t], out=step[units : 2 * units])
            coming *= stay[:, t]
            through *= r[:, t]
            coming += through
            coming += np.matmul(gates, step[: 2 * units], out=product)
            coming += outer[:, t]
            if opens[t]:
                coming *= ~starts[t]
        moved = moved.reshape(3 * units, -1)
        gradients["gates"] = before.reshape(units, -1) @ moved[: 2 * units].T
        gradients["fresh"] = (r * before).reshape(units, -1) @ moved[2 * units :].T
        moved = moved.take(order, axis=1)
        if moved_tail is not None:
            outside = int(np.searchsorted(words, WORDS - 1))
            leaves = words[outside:] - (WORDS - 1)
            gradients["tail_in"] = self.tail.vectors(leaves).T @ moved[:, outside:].T
            self.tail.collect(leaves + self.tail.tree.leaves, p["tail_in"] @ moved[:, outside:], moved_tail)
        words = np.minimum(words, WORDS - 1)
        first = np.flatnonzero(np.diff(words, prepend=-1))
        gradients["inputs"] = np.zeros_like(p["inputs"])
        gradients["inputs"][words[first]] = np.add.reduceat(moved, first, axis=1).T

    def _update(self, gradients: Parameters, squares: Parameters, tokens: int) -> None:
        for name, gradient in gradients.items():
            gradient = gradient / np.float32(max(tokens, 1))
            norm = float(np.sqrt((gradient * gradient).sum()))
            if norm > CLIP:
                gradient *= CLIP / norm
            squares[name] = DECAY * squares[name] + (1 - DECAY) * gradient * gradient
            self.p[name] -= RATE * self.share * gradient / (np.sqrt(squares[name]) + 1e-4)
