"""A small causal self-attention model in numpy: forward, backward, Adam and window scoring.

Subword ids are grouped into classes: the most frequent ids have a class of
their own, the others share the rest. The model predicts the class of the next
token from the ids before it (embedding and position, one masked attention
layer with a residual path, softmax over classes), then, where ids share the
class, the id inside it: the ids of a class are the leaves of a Huffman tree
over their corpus counts, and every inner node decides for one side from the
same context by its own weights (hierarchical softmax). Every id that shares
a class also has an input embedding of its own beside that of its class. So
every id is told apart before and after the attention, and the probabilities
of all ids sum to one. Before learning, an id has its smoothed corpus share
inside its class.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

CLASSES, OWN = 64, 48
WIDTH = 8
LENGTH, STRIDE = 48, 24
START = CLASSES  # input class before the first token
_MASK = np.triu(np.full((LENGTH, LENGTH), -1e9, np.float32), 1)
#: Beyond this size rows are lowered by their maximum before exp.
_SAFE = 60
_SEEN = np.tril(np.ones((LENGTH, LENGTH), np.float32))
SHAPES = {"embed": (CLASSES + 1, WIDTH), "place": (LENGTH, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH),
          "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

Parameters = dict[str, np.ndarray]


class Tree:
    """Huffman trees over the ids of the classes that more than one id has.

    ``parent`` and ``side`` (1 or -1) hold first the ids, then the inner nodes; -1 is the parent of a root and of an id
    without a tree. ``odds`` are the inner nodes' log odds of side 1 by the weights.
    """

    def __init__(self, weights: np.ndarray, of: np.ndarray) -> None:
        many = len(weights)
        parent, side, odds = [-1] * many, [0] * many, []
        order = np.argsort(weights, kind="stable")
        order = order[np.argsort(of[order], kind="stable")]  # by class, then weight
        for members in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            # Inner nodes come in the order of their weights, so two queues take the place of a heap.
            leaf, heavy = members.tolist(), weights[members].tolist()
            node, mass, i, j = [], [], 0, 0
            for _ in range(len(leaf) - 1):
                pair = []
                for sign in (1, -1):
                    if j >= len(node) or (i < len(leaf) and heavy[i] <= mass[j]):
                        at, weight, i = leaf[i], heavy[i], i + 1
                    else:
                        at, weight, j = node[j], mass[j], j + 1
                    parent[at], side[at] = many + len(odds), sign
                    pair.append(weight)
                node.append(many + len(odds))
                mass.append(pair[0] + pair[1])
                parent.append(-1)
                side.append(0)
                odds.append(np.log(pair[0] / pair[1]))
        self.many, self.parent, self.side, self.odds = many, np.array(parent, np.int32), np.array(side, np.int8), np.array(odds, np.float32)
        self.mark = many, hashlib.sha256(self.parent.tobytes() + self.side.tobytes()).hexdigest()

    def paths(self) -> tuple[np.ndarray, ...]:
        """Begin and length of every id's path, then inner nodes and sides of all paths, one after the other."""
        own = at = np.flatnonzero(self.parent[:self.many] >= 0)
        level = []
        while len(at):
            up = self.parent[at]
            level.append((own, up - self.many, self.side[at]))
            keep = self.parent[up] >= 0
            own, at = own[keep], up[keep]
        size = np.zeros(self.many + 2, np.int64)  # the start of a text and padding have no path
        for own, _, _ in level:
            size[own] += 1
        begin = np.cumsum(size) - size
        node, side = np.zeros(size.sum(), np.uint16 if len(self.odds) < 1 << 16 else np.int64), np.zeros(size.sum(), np.float32)
        for nth, (own, up, sign) in enumerate(level):
            node[begin[own] + nth], side[begin[own] + nth] = up, sign
        return begin, size, node, side


#: Paths of the last tree by its mark; a worker keeps them from one task to the next.
_PATHS: dict[tuple, tuple[np.ndarray, ...]] = {}


class Rows:
    """A table whose rows are learnt by Adagrad, only those that a step touches; ``seen`` counts the tokens behind each."""

    def __init__(self, table: np.ndarray, rate: float = 0.05) -> None:
        self.table, self.rate = np.array(table, np.float32), rate
        self.power, self.seen = np.full(self.table.shape, 1e-6, np.float32), np.zeros(len(self.table), np.int64)

    def learn(self, rows: np.ndarray, g: np.ndarray, seen: np.ndarray) -> None:
        power = self.power.take(rows, axis=0)
        power += g * g
        self.power[rows] = power
        np.sqrt(power, out=power)
        np.divide(g, power, out=power)
        power *= -self.rate
        power += self.table.take(rows, axis=0)
        self.table[rows] = power
        self.seen[rows] += seen


class Ids:
    """What the ids that share classes have for themselves: input embeddings (a row for every id, then for the start of
    a text and for padding) and the inner nodes of the trees (weights and a bias)."""

    def __init__(self, tree: Tree, inputs: np.ndarray | None = None, nodes: np.ndarray | None = None) -> None:
        if tree.mark not in _PATHS:
            _PATHS.clear()
            _PATHS[tree.mark] = tree.paths()
        self.begin, self.size, self.node, self.side = _PATHS[tree.mark]
        self.many = self.size > 0
        if inputs is None:
            inputs = np.zeros((len(self.size), WIDTH), np.float32)
            nodes = np.hstack([np.zeros((len(tree.odds), WIDTH), np.float32), tree.odds[:, None]])
        self.inputs, self.nodes = Rows(inputs), Rows(nodes)

    def visits(self, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of ids that have a path: where each one's visits begin, the id of each visit by number, node and side."""
        length = self.size[ids]
        end = np.cumsum(length)
        at = np.repeat(self.begin[ids] - (end - length), length)
        at += np.arange(len(at))
        return end - length, np.repeat(np.arange(len(ids)), length), self.node[at], self.side[at]

    def log_shares(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Log probability of every id, each with a path, in its class after the context h (with a last column of ones)."""
        begin, of, node, side = self.visits(ids)
        if not len(of):
            return np.zeros(len(ids), np.float32)
        s = np.einsum("ij,ij->i", h.take(of, axis=0), self.nodes.table.take(node, axis=0))
        s *= side
        return np.add.reduceat(np.minimum(s, 0) - np.log1p(np.exp(-np.abs(s))), begin)

    def gradient(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """Gradient of the summed negative ``log_shares`` by h, and by the nodes: rows, gradients, tokens."""
        begin, of, node, side = self.visits(ids)
        if not len(of):
            return np.zeros_like(h), (np.zeros(0, np.int64), np.zeros((0, h.shape[1]), h.dtype), np.zeros(0, np.int64))
        h, weights = h.take(of, axis=0), self.nodes.table.take(node, axis=0)
        s = np.einsum("ij,ij->i", h, weights)
        s *= side
        with np.errstate(over="ignore"):
            pull = -side / (1 + np.exp(s))
        weights = weights * pull[:, None]
        h *= pull[:, None]
        return np.add.reduceat(weights, begin), by_row(node, h)


def by_row(rows: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different rows, sorted, the sum of g and the number of places of each."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    total = np.add.reduceat(g.take(order, axis=0), begin) if len(rows) else g[:0]
    return rows[begin].astype(np.int64), total, np.diff(np.append(begin, len(rows)))


def unpack(flat: np.ndarray) -> Parameters:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = np.asarray(flat[at:at + n], np.float32).reshape(shape)
        at += n
    return out


def pack(p: Parameters) -> np.ndarray:
    return np.concatenate([p[name].ravel() for name in SHAPES]).astype(np.float64)


def initial(class_counts: np.ndarray, seed: int = 8) -> np.ndarray:
    """Small random weights; the output bias starts at the classes' log shares."""
    rng = np.random.default_rng(seed)
    p = {name: rng.normal(0, 0.3, shape).astype(np.float32) for name, shape in SHAPES.items()}
    p["bias"] = np.log((class_counts + 1) / (class_counts.sum() + len(class_counts))).astype(np.float32)
    return pack(p)


@lru_cache(4)
def _room(b: int, n: int, kind: np.dtype) -> tuple[np.ndarray, ...]:
    """The large arrays of a step, used again by the next one: attention, its gradient, and logits."""
    return np.empty((b, n, n), kind), np.empty((b, n, n), kind), np.empty((b * n, CLASSES), kind)


def _most(x: np.ndarray) -> float:
    return max(x.max(initial=0), -x.min(initial=0))


def _beyond(x: np.ndarray, left: np.ndarray, right: np.ndarray, more: float = 0.0) -> bool:
    """Whether x passes _SAFE: sums of WIDTH products of left and right, and of one more term. x is read only where
    these allow it."""
    return WIDTH * _most(left) * _most(right) + more > _SAFE and _most(x) > _SAFE


def loss_and_gradient(p: Parameters, x: np.ndarray, y: np.ndarray, own: Ids | None = None, ids: np.ndarray | None = None,
                      ) -> tuple[float, Parameters]:
    """Mean negative log likelihood of next classes y after inputs x (both batch x length), and its gradient.

    A y below 0 is padding: it is neither predicted nor learnt from, and what
    follows a padded input is padding too. Exponentials stay undivided; a
    column of ones gives their sums, and each row is divided by its sum where
    it is narrow. With ``own``, ``ids`` (batch x length + 1) are the ids behind
    x and the last y; the gradients "inputs" and "nodes" are (rows, their
    gradients, tokens), and the loss is that of the classes.
    """
    b, n = x.shape
    kind = p["embed"].dtype
    real = (y >= 0).ravel()
    x, y, many = np.where(x < 0, START, x).ravel(), np.where(y < 0, 0, y).ravel(), max(int(real.sum()), 1)
    root = 1 / np.sqrt(np.float32(WIDTH))
    into = np.hstack([p["q"] * root, p["k"], p["v"]])
    h0 = p["embed"].take(x, axis=0)
    h0.reshape(b, n * WIDTH)[:] += p["place"][:n].ravel()
    if own is not None:
        given, asked = ids[:, :-1].ravel(), ids[:, 1:].ravel()
        h0 += own.inputs.table.take(given, axis=0)
    qkv = np.ones((b * n, 3 * WIDTH + 1), kind)
    np.matmul(h0, into, out=qkv[:, :-1])
    qkv = qkv.reshape(b, n, -1)
    q, k, v = qkv[:, :, :WIDTH], qkv[:, :, WIDTH:2 * WIDTH], qkv[:, :, 2 * WIDTH:]
    e, ds, z = _room(b, n, kind)
    np.matmul(q, k.transpose(0, 2, 1), out=e)
    if _beyond(e, q, k):
        e += _MASK[:n, :n]
        e -= e.max(axis=-1, keepdims=True)
    np.exp(e, out=e)
    e *= _SEEN[:n, :n]
    m = (e @ v).reshape(b * n, -1)
    whole = m[:, WIDTH:]
    m = m[:, :WIDTH] / whole
    h = np.ones((b * n, WIDTH + 1), kind)
    np.matmul(m, p["o"], out=h[:, :-1])
    h[:, :-1] += h0
    np.matmul(h, np.vstack([p["out"], p["bias"]]), out=z)
    if _beyond(z, h, p["out"], _most(p["bias"])):
        z -= z.max(axis=-1, keepdims=True)
    logits, cell = z.ravel(), np.arange(0, b * n * CLASSES, CLASSES) + y
    reached = logits[cell]
    np.exp(z, out=z)
    total = z @ np.ones(CLASSES, kind)
    loss = float(((np.log(total) - reached) * real).sum() / many)
    logits[cell] -= total
    scale = (real / (total * many)).astype(kind)[:, None]
    g = {}
    if own is not None:
        inside = np.flatnonzero(own.many[asked])
        pull, (rows, down, seen) = own.gradient(h.take(inside, axis=0), asked[inside])
        g["nodes"] = rows, down / many, seen
    h *= scale
    out = h.T @ z
    g["out"], g["bias"] = out[:-1], out[-1]
    dh = z @ p["out"].T
    dh *= scale
    if own is not None:
        dh[inside] += pull[:, :-1] / many
    g["o"] = m.T @ dh
    # Gradient by m and, last, what the softmax takes from every weight of its row.
    part = np.empty((b * n, WIDTH + 1), kind)
    dm = np.matmul(dh, p["o"].T, out=part[:, :-1])
    m *= dm
    np.matmul(m, np.full(WIDTH, -1, kind), out=part[:, -1])
    part /= whole
    part = part.reshape(b, n, -1)
    back = np.empty((b, n, 3 * WIDTH), kind)
    np.matmul(e.transpose(0, 2, 1), part[:, :, :-1], out=back[:, :, 2 * WIDTH:])
    np.matmul(part, v.transpose(0, 2, 1), out=ds)
    ds *= e
    np.matmul(ds, k, out=back[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=back[:, :, WIDTH:2 * WIDTH])
    back = back.reshape(b * n, -1)
    by = h0.T @ back
    g["q"], g["k"], g["v"] = by[:, :WIDTH] * root, by[:, WIDTH:2 * WIDTH], by[:, 2 * WIDTH:]
    dh += back @ into.T
    g["place"] = np.zeros_like(p["place"])
    g["place"][:n] = dh.reshape(b, n, WIDTH).sum(axis=0)
    rows, down, _ = by_row(x.astype(np.uint8), dh)
    g["embed"] = np.zeros_like(p["embed"])
    g["embed"][rows] = down
    if own is not None:
        inside = np.flatnonzero(own.many[given])
        g["inputs"] = by_row(given[inside].astype(own.node.dtype), dh.take(inside, axis=0))
    return loss, g


class Learner:
    """Adam that goes on from one set of windows to the next."""

    def __init__(self, flat: np.ndarray, rate: float = 0.01, batch: int = 64, seed: int = 8, own: Ids | None = None) -> None:
        self.own = own
        self.flat = np.array(flat, np.float32)
        self.p = unpack(self.flat)  # views
        self.first, self.second = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.rate, self.batch, self.step, self.rng = rate, batch, 0, np.random.default_rng(seed)

    def learn(self, windows: np.ndarray, ids: np.ndarray | None = None) -> None:
        """One pass over (n, LENGTH + 1) class windows in random order; the first column is input only,
        -1 fills the end of short ones. ``ids`` are the ids behind the classes."""
        for at in np.array_split(self.rng.permutation(len(windows)), max(1, -(-len(windows) // self.batch))):
            rows = windows[at]
            _, g = loss_and_gradient(self.p, rows[:, :-1], rows[:, 1:], self.own, None if ids is None else ids[at])
            if self.own is not None:
                self.own.inputs.learn(*g["inputs"])
                self.own.nodes.learn(*g["nodes"])
            g = np.concatenate([g[name].ravel() for name in SHAPES])
            self.step += 1
            self.first += 0.1 * (g - self.first)
            self.second += 0.01 * (g * g - self.second)
            self.flat -= (self.rate / (1 - 0.9 ** self.step)) * self.first / (np.sqrt(self.second / (1 - 0.99 ** self.step)) + 1e-8)


def train(flat: np.ndarray, windows: np.ndarray, epochs: int, rate: float = 0.01, batch: int = 64, seed: int = 8) -> np.ndarray:
    learner = Learner(flat, rate, batch, seed)
    for _ in range(epochs):
        learner.learn(windows)
    return pack(learner.p)


def look_up(p: Parameters, own: Ids | None = None, of: np.ndarray | None = None) -> tuple:
    """What a token gives before attention: key, value and a one, then query and residual. These are sums of rows by place
    and rows by class, or with ``own`` by id (``of`` is the class of each). Last a bound of the products of keys and queries."""
    root, none = np.float32(1 / np.sqrt(WIDTH)), np.zeros((LENGTH, 1), np.float32)
    token = p["embed"] if own is None else np.append(p["embed"][of], [p["embed"][START], p["embed"][START]], axis=0) + own.inputs.table
    tables = [np.hstack(t).astype(np.float32) for h, one in ((p["place"], none), (token, np.ones((len(token), 1))))
              for t in ([h @ p["k"], h @ p["v"] @ p["o"], one], [h @ p["q"] * root, h])]
    keys, queries = (sum(_most(t[:, :WIDTH]) for t in tables[i::2]) for i in (0, 1))
    return *tables, WIDTH * keys * queries


def _log_shares(p: Parameters, tables: tuple, x: np.ndarray, y: np.ndarray, tail: int, own: Ids | None = None,
                asked: np.ndarray | None = None) -> np.ndarray:
    """Log probabilities of the last ``tail`` next classes y of each window after the classes x, or with ``own`` of the
    ids ``asked`` of these classes after the ids x.

    Everything before attention is looked up; sums along rows are matrix
    products with ones.
    """
    n, (first, second, early, late, most) = len(x), tables
    early = early.take(x, axis=0)
    early += first
    late = late.take(x[:, -tail:], axis=0)
    late += second[-tail:]
    s = late[:, :, :WIDTH] @ early[:, :, :WIDTH].transpose(0, 2, 1)
    if most > _SAFE and _most(s) > _SAFE:
        s += _MASK[-tail:]
        s -= s.max(axis=-1, keepdims=True)
    np.exp(s, out=s)
    s *= _SEEN[-tail:]
    m = s @ early[:, :, WIDTH:]
    h = np.ones((n, tail, WIDTH + 1), np.float32)
    np.divide(m[:, :, :WIDTH], m[:, :, WIDTH:], out=h[:, :, :WIDTH])
    h[:, :, :WIDTH] += late[:, :, WIDTH:]
    h = h.reshape(n * tail, -1)
    z = h @ np.vstack([p["out"], p["bias"]])
    if _beyond(z, h, p["out"], _most(p["bias"])):
        z -= z.max(axis=-1, keepdims=True)
    reached = z.ravel()[np.arange(0, z.size, CLASSES) + y.ravel()]
    total = np.exp(z, out=z) @ np.ones(CLASSES, np.float32)
    out = reached - np.log(total)
    if own is not None:
        asked = asked.ravel()
        inside = np.flatnonzero(own.many[asked])
        out[inside] += own.log_shares(h.take(inside, axis=0), asked[inside])
    return out.reshape(n, tail)


def score(p: Parameters, classes: np.ndarray, first: np.ndarray, batch: int = 128, own: Ids | None = None,
          ids: np.ndarray | None = None, tables: tuple | None = None) -> np.ndarray:
    """Log probability of the class of every token, or with ``own`` and its ``tables`` (``look_up``) of its id (``ids``); text i
    holds the tokens first[i]:first[i + 1].

    Windows of LENGTH tokens start every STRIDE tokens; the first of a text
    scores all its tokens, each later one the last STRIDE, so every token is
    scored once with at least LENGTH - STRIDE tokens of context where there
    are that many.
    """
    out = np.zeros(len(classes), np.float64)
    size = np.diff(first)
    start = START if own is None else len(own.size) - 2
    inputs = np.full(len(classes) + 1, start, np.int64)
    inputs[1:] = classes if own is None else ids
    tables, asked = tables or look_up(p), None
    for later in (False, True):
        many = np.maximum(-(-(size - LENGTH) // STRIDE), 0) if later else (size > 0).astype(np.int64)
        text = np.repeat(np.arange(len(size)), many)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many) + int(later)
        begin, end = first[text] + nth * STRIDE, first[text + 1]
        tail = STRIDE if later else LENGTH
        for at in range(0, len(text), batch):
            token = begin[at:at + batch, None] + np.arange(LENGTH)
            inside = token < end[at:at + batch, None]
            token = np.where(inside, token, 0)
            x = inputs[token]
            if not later:
                x[:, 0] = start
            token, keep = token[:, -tail:], inside[:, -tail:]
            if own is not None:
                asked = inputs[token + 1]
            logs = _log_shares(p, tables, x, classes[token], tail, own, asked)
            out[token[keep]] = logs[keep]
    return out
