"""A gated recurrent language model over head words, in NumPy, for use inside tasks.

Words are numbered by class, a class being a stretch of numbers; the probability of a word is that of
its class times that of the word within the class.  Texts are laid one after another into lanes, which
advance together a window at a time: the state of a lane is carried from window to window, and set to
zero where a text begins.  Training goes back through one window only.
"""

from __future__ import annotations

import numpy as np

#: Order in which weights are laid out in one vector.
NAMES = ("embed", "input", "state", "bias", "class_weight", "class_bias", "word_weight", "word_bias")
#: Tokens whose classes are scored at a time: small products are the fastest.
BLOCK = 512
#: Rows of a key from which they are added up by a product of their own.
OFTEN = 16


def start(class_of: np.ndarray, counts: np.ndarray, width: int, seed: int = 0) -> dict[str, np.ndarray]:
    """Weights of an untrained model: the counts' own distribution, whatever the state."""
    rng = np.random.default_rng(seed)
    n, classes = len(class_of), int(class_of[-1]) + 1
    share = np.maximum(counts, 0.5)
    mass = np.bincount(class_of, share, classes)
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    return {
        "embed": rng.normal(0, 0.5, (n, width)).astype(np.float32),
        "input": draw(width, 3 * width), "state": draw(width, 3 * width), "bias": np.zeros(3 * width, np.float32),
        "class_weight": np.zeros((width, classes), np.float32),
        "class_bias": np.log(mass / mass.sum()).astype(np.float32),
        "word_weight": np.zeros((n, width), np.float32),
        "word_bias": np.log(share / mass[class_of]).astype(np.float32),
    }


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in NAMES])


def shaped(vector: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The weights of a vector, as views of it."""
    out, at = {}, 0
    for k in NAMES:
        out[k] = vector[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def lanes(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Texts by lane: the longest first, each to the lane that is shortest so far; longest lane first."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    k = min(most, len(order))
    upto, held = np.zeros(k, np.int64), [[] for _ in range(k)]
    for i in order:
        at = int(np.argmin(upto))
        held[at].append(i)
        upto[at] += lengths[i]
    return [np.array(held[i]) for i in np.argsort(-upto, kind="stable")]


def windows(tokens: np.ndarray, lengths: np.ndarray, most: int, steps: int, ahead: np.ndarray):
    """Windows of the lanes: (before, token, text, fresh), a row a step, of the lanes not yet at their end.

    ``before`` is the token that precedes each one, the text's of ``ahead`` where a text begins, which
    ``fresh`` marks; ``text`` is -1 beyond a lane's end.  Memory is that of the tokens, however unequal the texts are.
    """
    dealt = lanes(lengths, most)
    if not dealt:
        return
    order = np.concatenate(dealt)
    upto, ends = np.cumsum(lengths), np.cumsum(lengths[order])
    text_of = np.repeat(order.astype(np.int32), lengths[order])
    flat_token = np.concatenate([tokens[a:b] for a, b in zip((upto - lengths)[order].tolist(), upto[order].tolist())])
    begins = np.zeros(len(text_of), bool)
    begins[ends - lengths[order]] = True
    flat_before = np.roll(flat_token, 1)
    flat_before[ends - lengths[order]] = ahead[order]
    n = np.array([lengths[d].sum() for d in dealt], np.int64)
    first = np.cumsum(n) - n
    for at in range(0, int(n[0]), steps):
        live = int((n > at).sum())
        step = at + np.arange(min(steps, int(n[0]) - at))[:, None]
        inside = step < n[:live]
        place = first[:live] + np.minimum(step, n[:live] - 1)
        yield flat_before[place], flat_token[place], np.where(inside, text_of[place], -1), begins[place]


def _thirds(x: np.ndarray) -> np.ndarray:
    """Columns of the update gate, the reset gate and the candidate, one after another."""
    return np.ascontiguousarray(x.reshape(len(x), 3, -1).transpose(1, 0, 2))


def _sigmoid_of_half(x: np.ndarray) -> None:
    """In place, of twice the values given."""
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5


def halved(weights: dict, gates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the state, and the input's part of the gates for each word, as ``forward`` uses them."""
    half = np.repeat(np.array([0.5, 0.5, 1], gates.dtype), gates.shape[1] // 3)
    return _thirds(weights["state"] * half), _thirds(gates * half)


def forward(weights: dict, gates: np.ndarray, before: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool, ready: tuple | None = None):
    """States after each step; ``gates`` are the input's part of the gates for each word, ``ready`` what
    ``halved`` makes of them.

    With ``keep`` also what going back needs: states before each step; update gate, reset gate and
    candidate; and the state's part of the candidate.
    """
    shape, width = before.shape, state.shape[1]
    recurrent, of_word = ready or halved(weights, gates)
    out = np.empty((*shape, width), gates.dtype)
    held = shape[0] if keep else 1
    x, a = np.empty((held, 3, shape[1], width), gates.dtype), np.empty((2, shape[1], width), gates.dtype)
    start, an = np.empty_like(out) if keep else None, np.empty((held, shape[1], width), gates.dtype)
    begins = fresh.any(axis=1).tolist()
    for t in range(len(before)):
        h = state
        if begins[t]:
            h = state.copy()
            h[fresh[t]] = 0
        xt, at = x[t % held], an[t % held]
        np.take(of_word, before[t], axis=1, out=xt, mode="clip")
        np.matmul(h, recurrent[2], out=at)
        zr, (zt, rt, ct) = xt[:2], xt
        zr += np.matmul(h, recurrent[:2], out=a)
        _sigmoid_of_half(zr)
        ct += np.multiply(rt, at, out=a[0])
        np.tanh(ct, out=ct)
        state = np.subtract(h, ct, out=out[t])
        state *= zt
        state += ct
        if keep:
            start[t] = h
    return out, state, (start, x, an)


def _bounded(weight: np.ndarray, bias: np.ndarray) -> bool:
    """Whether the exponentials of all scores, of states within -1 and 1, are within the range of a float."""
    most = np.sqrt(weight.shape[1] * np.einsum("ij,ij->i", weight, weight)) + np.abs(bias)
    return bool(most.max() < 80)


def _lifts(weight: np.ndarray, bias: np.ndarray) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether scores need no shift, and what is left out of them, with its exponentials: the biases then, else nothing."""
    plain = _bounded(weight, bias)
    lift = bias if plain else np.zeros_like(bias)
    return plain, lift, np.exp(lift)


def _shift(x: np.ndarray, bias: np.ndarray) -> None:
    """In place: scores with their biases, less the greatest of a row."""
    x += bias
    x -= x.max(axis=1)[:, None]


def _in_order(numbers: np.ndarray, most: int) -> np.ndarray:
    return np.argsort(numbers.astype(np.uint16) if most <= 1 << 16 else numbers, kind="stable")


def outputs(weights: dict, class_of: np.ndarray, bounds: np.ndarray, states: np.ndarray, token: np.ndarray, back: dict | None = None, share: float = 1.0):
    """Natural log probability of each token after its state; with ``back`` also the gradients of the
    negative log probability, each token's times ``share``, and that of the states.

    Tokens are put in order, so that those of a class lie side by side.  Classes are scored for ``BLOCK``
    tokens at a time, and the words of all classes in one array.  Biases are not added to scores, but weigh
    their exponentials, where these are within the range of a float.
    """
    n, width = states.shape
    found, d = np.zeros(n, np.float64), None if back is None else np.empty_like(states)
    if not n:
        return found, d
    order = _in_order(token, len(class_of))
    word = token[order]
    wanted = class_of[word]
    rows, sizes = np.arange(n), np.diff(bounds)
    classes = len(sizes)
    h, ones = np.take(states, order, axis=0), np.ones(n, states.dtype)

    of_class, bias = weights["class_weight"], weights["class_bias"]
    plain, lift, up = _lifts(of_class.T, bias)
    turned, down = np.ascontiguousarray((of_class * up).T), share / up[wanted]
    logs, total = np.empty(n, h.dtype), np.empty(n, h.dtype)
    slope, slope_bias = np.zeros_like(of_class), np.zeros_like(bias)
    for at in range(0, n, BLOCK):
        mine = slice(at, at + BLOCK)
        hb = h[mine]
        x = hb @ of_class
        if not plain:
            _shift(x, bias)
        each, place = x.reshape(-1), rows[: len(hb)] * classes + wanted[mine]
        logs[mine] = each[place]
        np.exp(x, out=x)
        np.matmul(x, up, out=total[mine])
        if back is not None:
            x *= (share / total[mine])[:, None]
            each[place] -= down[mine]
            slope += hb.T @ x
            slope_bias += ones[: len(hb)] @ x
            np.matmul(x, turned, out=d[mine])
    logs += lift[wanted]
    logs -= np.log(total)
    if back is not None:
        back["class_weight"] += slope * up
        back["class_bias"] += slope_bias * up

    of_word, bias = weights["word_weight"], weights["word_bias"]
    plain, lift, up = _lifts(of_word, bias)
    cuts = np.searchsorted(wanted, np.arange(len(bounds)))
    choice = np.flatnonzero((np.diff(cuts) > 0) & (sizes > 1))  # one word is no choice
    # scores of the words of these classes: where each class begins, and where each token's own word is
    held = np.diff(cuts)[choice] * sizes[choice]
    begin = np.zeros(classes, np.int64)
    begin[choice] = np.cumsum(held) - held
    real = np.flatnonzero((sizes > 1)[wanted])
    c, own = wanted[real], word[real]
    place = begin[c] + (real - cuts[c]) * sizes[c] + own - bounds[c]
    scores, total = np.empty(int(held.sum()), h.dtype), np.ones(n, h.dtype)
    parts, ends = [], (begin + np.diff(cuts) * sizes).tolist()
    begin, cuts, edges, sizes = begin.tolist(), cuts.tolist(), bounds.tolist(), sizes.tolist()
    for i in choice.tolist():
        mine, words = slice(cuts[i], cuts[i + 1]), slice(edges[i], edges[i + 1])
        x = scores[begin[i] : ends[i]].reshape(-1, sizes[i])
        np.matmul(h[mine], of_word[words].T, out=x)
        if not plain:
            _shift(x, bias[words])
        parts.append((mine, words, x))
    logs[real] += scores[place] + lift[own]
    np.exp(scores, out=scores)
    for mine, words, x in parts:
        np.matmul(x, up[words], out=total[mine])
    logs -= np.log(total)
    found[order] = logs
    if back is not None:
        scores[place] -= total[real] / up[own]
        factor, turned = (share / total)[:, None], up[:, None] * of_word
        slope, slope_bias = np.zeros_like(of_word), np.zeros_like(bias)
        for mine, words, x in parts:
            x *= factor[mine]
            np.matmul(x.T, h[mine], out=slope[words])
            np.matmul(ones[mine], x, out=slope_bias[words])
            d[mine] += x @ turned[words]
        slope *= up[:, None]
        back["word_weight"] += slope
        back["word_bias"] += slope_bias * up
        place = np.empty_like(order)
        place[order] = rows
        d = np.take(d, place, axis=0)
    return found, d


def sums_by(rows: np.ndarray, key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys that occur, all below ``most``, and for each of several arrays the sum of a key's rows."""
    order = _in_order(key, most)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    n = np.diff(np.append(first, len(key)))
    often = np.argsort(-n, kind="stable")
    first, n = first[often], n[often]
    rows, ones = np.take(rows, order, axis=1), np.ones(len(key), rows.dtype)
    sums = np.empty((len(rows), len(n), rows.shape[2]), rows.dtype)
    # frequent keys one by one, the others by the first row of each, the second, and so on
    many = int((n > OFTEN).sum())
    for i, (at, m) in enumerate(zip(first[:many].tolist(), n[:many].tolist())):
        np.matmul(ones[:m], rows[:, at : at + m], out=sums[:, i])
    rest = np.take(rows, first[many:], axis=1)
    for j in range(1, int(n[many]) if many < len(n) else 0):
        live = int((n[many:] > j).sum())
        rest[:, :live] += np.take(rows, first[many : many + live] + j, axis=1)
    sums[:, many:] = rest
    return key[first], sums


def backward(weights: dict, before: np.ndarray, fresh: np.ndarray, kept: tuple, d_out: np.ndarray, back: dict) -> None:
    """Gradients of one window from those of its states."""
    steps, n, width = d_out.shape
    h, x, an = kept
    # slopes of the state's part of the candidate, the update gate, the reset gate and the candidate
    d = np.empty((4, steps, n, width), np.float32)
    turned = np.ascontiguousarray(_thirds(weights["state"])[[2, 0, 1]].transpose(0, 2, 1))
    begins = fresh.any(axis=1).tolist()
    carried, rest, of_state = np.zeros_like(d_out[0]), np.empty_like(d_out[0]), np.zeros_like(turned)
    for t in range(steps - 1, -1, -1):
        zt, rt, ct = x[t]
        da, dz, dr, dc = d[:, t]
        carried += d_out[t]
        np.subtract(1, zt, out=rest)
        rest *= carried
        np.subtract(h[t], ct, out=dz)
        dz *= zt
        dz *= rest
        np.multiply(ct, ct, out=dc)
        dc *= rest
        np.subtract(rest, dc, out=dc)
        np.multiply(dc, rt, out=da)
        np.subtract(1, rt, out=dr)
        dr *= da
        dr *= an[t]
        carried *= zt
        of_state += np.matmul(h[t].T, d[:3, t])
        for slope in np.matmul(d[:3, t], turned):
            carried += slope
        if begins[t]:
            carried[fresh[t]] = 0

    def beside(parts: np.ndarray) -> np.ndarray:
        return parts.transpose(1, 0, 2).reshape(width, 3 * width)

    back["state"] += beside(of_state[[1, 2, 0]])
    word, sums = sums_by(d[1:].reshape(3, -1, width), before.ravel(), len(weights["embed"]))
    back["input"] += beside(np.matmul(weights["embed"][word].T, sums))
    back["bias"] += sums.sum(axis=1).ravel()
    back["embed"][word] += np.matmul(sums, _thirds(weights["input"]).transpose(0, 2, 1)).sum(axis=0)


class Adam:
    """Steps of fixed decay rates; gradients are cut to a norm first.  ``m`` and ``v`` are 10 and 200 times the means."""

    def __init__(self, size: int, rate: float, norm: float = 5.0):
        self.m, self.v, self.n = np.zeros(size, np.float32), np.zeros(size, np.float32), 0
        self.rate, self.norm = rate, norm

    def step(self, gradient: np.ndarray) -> np.ndarray:
        """What to take off the weights; the gradient is used up."""
        size = float(np.sqrt(np.dot(gradient, gradient)))
        if size > self.norm:
            gradient *= self.norm / size
        self.n += 1
        self.m *= 0.9
        self.m += gradient
        gradient *= gradient
        self.v *= 0.995
        self.v += gradient
        scale = (0.005 / (1 - 0.995**self.n)) ** 0.5
        np.sqrt(self.v, out=gradient)
        gradient += 1e-6 / scale
        np.divide(self.m, gradient, out=gradient)
        gradient *= self.rate * 0.1 / (1 - 0.9**self.n) / scale
        return gradient


def pieces(tokens: np.ndarray, lengths: np.ndarray, most: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut into pieces: their lengths, and the token ahead of each, the end at the start of a text."""
    n = -(-lengths // most)
    first = np.cumsum(n) - n
    length = np.full(int(n.sum()), most)
    length[first + n - 1] = lengths - (n - 1) * most
    starts = np.cumsum(length) - length
    ahead = tokens[np.maximum(starts - 1, 0)]
    ahead[first] = end
    return length, ahead


class Trainer:
    """A local model that learns from slices of texts, in pieces so that no lane runs on alone."""

    def __init__(self, weights: dict, class_of: np.ndarray, end: int, rate: float, lanes: int, steps: int, piece: int):
        self.vector = flat(weights)
        self.weights, self.class_of, self.end = shaped(self.vector, weights), class_of, end
        self.bounds = np.searchsorted(class_of, np.arange(class_of[-1] + 2))
        self.adam = Adam(len(self.vector), rate)
        self.lanes, self.steps, self.piece, self.seen = lanes, steps, piece, 0

    def learn(self, tokens: np.ndarray, lengths: np.ndarray) -> None:
        w = self.weights
        width = w["state"].shape[0]
        length, ahead = pieces(tokens, lengths, self.piece, self.end)
        state = np.zeros((min(self.lanes, len(length)), width), np.float32)
        for before, token, text, fresh in windows(tokens, length, self.lanes, self.steps, ahead):
            gradient = np.zeros_like(self.vector)
            back = shaped(gradient, w)
            gates = w["embed"] @ w["input"] + w["bias"]
            out, state, kept = forward(w, gates, before, fresh, state[: before.shape[1]], True)
            live = (text >= 0).ravel()
            # a window that is not full weighs less
            share = 1 / (self.lanes * self.steps)
            if live.all():
                _, d_out = outputs(w, self.class_of, self.bounds, out.reshape(-1, width), token.ravel(), back, share)
            else:
                d_out = np.zeros((out.shape[0] * out.shape[1], width), np.float32)
                _, d_out[live] = outputs(w, self.class_of, self.bounds, out.reshape(-1, width)[live], token.ravel()[live], back, share)
            backward(w, before, fresh, kept, d_out.reshape(out.shape), back)
            self.vector -= self.adam.step(gradient)
            self.seen += int(live.sum())


class Scorer:
    """Log probabilities of whole texts, many side by side."""

    def __init__(self, weights: dict, class_of: np.ndarray, end: int, lanes: int = 512, steps: int = 32):
        self.weights, self.class_of, self.end = weights, class_of, end
        self.bounds = np.searchsorted(class_of, np.arange(class_of[-1] + 2))
        self.gates = weights["embed"] @ weights["input"] + weights["bias"]
        self.ready = halved(weights, self.gates)
        self.lanes, self.steps = lanes, steps

    def score(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural log probability of each text."""
        width = self.weights["state"].shape[0]
        total = np.zeros(len(lengths), np.float64)
        state = np.zeros((min(self.lanes, len(lengths)), width), np.float32)
        ahead = np.full(len(lengths), self.end)
        for before, token, text, fresh in windows(tokens, lengths, self.lanes, self.steps, ahead):
            out, state, _ = forward(self.weights, self.gates, before, fresh, state[: before.shape[1]], False, self.ready)
            live = (text >= 0).ravel()
            states, token, text = out.reshape(-1, width), token.ravel(), text.ravel()
            if not live.all():
                states, token, text = states[live], token[live], text[live]
            found, _ = outputs(self.weights, self.class_of, self.bounds, states, token)
            total += np.bincount(text, found, len(lengths))
        return total
