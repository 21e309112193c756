"""A small causal self-attention language model in numpy.

Tokens are subword ids. One attention layer with a learnt bias by distance and one hidden layer predict
the class of the next id; within a class an id has its smoothed share. Classes are clusters of ids by
what stands beside them. A text is laid out after ``PAD`` start symbols and cut into windows of
``CONTEXT`` inputs that overlap by ``PAD``: a window predicts after its last ``CONTEXT - PAD`` inputs, so
that each token is scored once, with ``PAD`` to ``CONTEXT - 1`` inputs before it in view.

Counts of ids and of their neighbours come from outside (``scoring`` takes them over a whole corpus), and
so do windows: a ``Trainer`` steps through them wherever they are, on the driver or in a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CONTEXT, PAD, DIM, HIDDEN, CLASSES, BESIDE = 32, 8, 8, 16, 64, 32
START = END = 50256
VOCABULARY = 50257
STEP = CONTEXT - PAD
LOG10 = np.log(10)


def n_windows(n_ids: int | np.ndarray) -> int | np.ndarray:
    """How many windows a text of so many ids, its end not counted, is cut into."""
    return n_ids // STEP + 1


def windows(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of texts with so many ``ids`` each: the laid out line, where in it each window's ``CONTEXT`` inputs begin, targets (windows x STEP), which of
    them are tokens, and the text of each window."""
    many = n_windows(sizes)
    of = np.repeat(np.arange(len(sizes)), many)
    first = np.cumsum(many) - many  # a text's first window
    block = first * STEP + np.arange(len(sizes)) * PAD
    line = np.full(len(of) * STEP + len(sizes) * PAD + CONTEXT, START, np.int32)  # long enough to have a window without texts too
    at = np.arange(PAD + 1, PAD + 1 + len(ids))
    at += np.repeat(block - (np.cumsum(sizes) - sizes), sizes)
    line[at] = ids
    begin = np.arange(len(of)) * STEP + of * PAD
    left = (sizes[of] - (np.arange(len(of)) - first[of]) * STEP).astype(np.int32)
    # what follows a text in the line is the start of the next, the same symbol as its end
    return line, begin, _runs(line, begin + PAD + 1, STEP), np.arange(STEP, dtype=np.int32)[None, :] <= left[:, None], of


def _runs(line: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(line, size)[begin]


def inputs_at(line: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return _runs(line, begin, CONTEXT)


def neighbours(ids: np.ndarray, sizes: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Cells (id * 2 * BESIDE + slot) of texts with so many ``ids`` each: an id with a frequent id before it (slots from 0) or after it (from BESIDE)."""
    place = np.full(VOCABULARY, -1, np.int32)
    place[top] = np.arange(len(top))
    many = sizes + 2  # with the start and the end
    line = np.full(int(many.sum()), START, np.int32)
    ends = np.cumsum(many) - 1
    inner = np.ones(len(line), bool)
    inner[ends] = inner[ends - sizes - 1] = False
    line[inner] = ids
    line[ends] = END
    slot = place[line]
    after, before = slot[1:] >= 0, slot[:-1] >= 0
    after[ends[:-1]] = before[ends[:-1]] = False  # from one text to the next
    after, before = np.flatnonzero(after), np.flatnonzero(before)
    width = 2 * BESIDE
    return np.concatenate([line[before + 1] * width + slot[before], line[after] * width + BESIDE + slot[after + 1]])


def cluster(count: np.ndarray, feature: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """A class for each id: k-means on the ids' neighbours among frequent ids; ids never seen share the last class."""
    seen = np.flatnonzero(count)
    of = np.full(VOCABULARY, classes - 1, np.int64)
    if not len(seen):
        return of
    weight = count[seen].astype(np.float32)
    own = np.sqrt(feature[seen] / weight[:, None])
    k = min(classes - 1, len(seen))
    centre = own[np.argsort(-weight, kind="stable")[:k]].copy()
    near = np.zeros(len(seen), np.int64)
    for _ in range(8):
        near = (-2 * own @ centre.T + (centre**2).sum(axis=1)).argmin(axis=1)
        total = np.bincount(near, weights=weight, minlength=k)
        for d in range(own.shape[1]):
            centre[:, d] = np.where(total > 0, np.bincount(near, weights=own[:, d] * weight, minlength=k) / np.maximum(total, 1e-9), centre[:, d])
    of[seen] = near
    return of


# scores of keys and of classes are held within these bounds: in single precision no sum of their powers overflows or vanishes
KEY_BOUND, CLASS_BOUND = np.float32(30), np.float32(60)
_GAP = np.arange(STEP)[:, None] + PAD - np.arange(CONTEXT)[None, :]
_CAP = np.where(_GAP >= 0, KEY_BOUND, np.float32(-1e9))  # a key after its query has no weight
_FLOOR = np.full(_GAP.shape, -KEY_BOUND)
_GAP = np.maximum(_GAP, 0)
# windows that go through the model at a time: their arrays stay in a core's cache, and small enough that the C library uses their memory again (``common.lean``)
LOT = 40


@dataclass
class Joined:
    """Weights as the passes over a lot take them, side by side."""

    qkv: np.ndarray  # and a column for ones beside the values
    hidden: np.ndarray  # with biases, as is the next
    classes: np.ndarray
    distance: np.ndarray
    longest: float  # among what the classes are told by
    bias: float


@dataclass
class Model:
    p: dict[str, np.ndarray]
    class_of: np.ndarray  # class of each id
    share: np.ndarray  # log of an id's share of its class

    def joined(self) -> Joined:
        p = self.p
        qkv = np.concatenate([p["q"], p["k"], p["v"], np.zeros((DIM, 1), np.float32)], axis=1)
        hidden, classes = (np.concatenate([p[w], p[b][None]]).T.copy() for w, b in (("w1", "b1"), ("out", "bias")))
        return Joined(qkv, hidden, classes, p["distance"][_GAP], np.sqrt((p["out"] ** 2).sum(axis=0).max()), np.abs(p["bias"]).max())

    def forward(self, inputs: np.ndarray, j: Joined) -> dict[str, np.ndarray]:
        """Masked attention over a lot of windows; keeps what the backward pass needs.

        Outside the products by window, tokens are the last axis: whole rows are added and scaled. A one beside values and layers carries sums and biases.
        """
        p = self.p
        x = np.take(p["embed"], inputs.ravel(), axis=0)
        qkv = (x @ j.qkv).reshape(-1, CONTEXT, 3 * DIM + 1)
        qkv[..., -1] = 1
        across = np.ascontiguousarray(qkv[..., DIM:].transpose(0, 2, 1))
        e = qkv[:, PAD:, :DIM] @ across[:, :DIM]
        e += j.distance
        np.maximum(e, _FLOOR, out=e)
        np.minimum(e, _CAP, out=e)
        np.exp(e, out=e)
        o = np.ascontiguousarray((e @ qkv[..., 2 * DIM :]).reshape(-1, DIM + 1).T)
        part = 1 / o[DIM]
        o = o[:DIM] * part
        y, z = np.empty((2, DIM + 1, len(part)), np.float32)
        y[DIM], z[DIM] = 1, 1
        np.add(p["o"].T @ o, x.reshape(-1, CONTEXT, DIM)[:, PAD:].reshape(-1, DIM).T, out=y[:DIM])
        h = j.hidden @ y
        np.maximum(h, np.zeros(len(part), np.float32), out=h)
        np.add(p["w2"].T @ h, y[:DIM], out=z[:DIM])
        logits = j.classes @ z
        if not np.sqrt(np.square(z[:DIM]).sum(axis=0).max(initial=0)) * j.longest + j.bias <= CLASS_BOUND:
            np.clip(logits, -CLASS_BOUND, CLASS_BOUND, out=logits)
        return {"x": x, "qkv": qkv, "across": across, "e": e, "part": part, "att": o, "y": y, "h": h, "z": z, "logits": logits}

    def log10(self, inputs: np.ndarray, targets: np.ndarray, joined: Joined | None = None) -> np.ndarray:
        """log10 probability of each target (windows x STEP)."""
        logits, flat = self.forward(inputs, joined or self.joined())["logits"], targets.ravel()
        own = logits.ravel()[_cells(self.class_of[flat])] + self.share[flat]
        total = np.exp(logits, out=logits).sum(axis=0)
        return ((own - np.log(total)) / np.float32(LOG10)).reshape(targets.shape)


def _cells(classes: np.ndarray) -> np.ndarray:
    """Where the logits of the tokens' classes are, among all logits."""
    return classes * len(classes) + np.arange(len(classes))


def start(count: np.ndarray, feature: np.ndarray, seed: int = 11) -> Model:
    """An untrained model: classes, shares and the classes' prior from the counts, random weights."""
    rng = np.random.default_rng(seed)
    class_of = cluster(count, feature)
    smooth = count + 0.5
    by_class = np.bincount(class_of, weights=smooth, minlength=CLASSES)
    share = np.log(smooth / by_class[class_of]).astype(np.float32)
    normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    p = {"q": normal(DIM, DIM), "k": normal(DIM, DIM), "v": normal(DIM, DIM), "o": normal(DIM, DIM), "w1": normal(DIM, HIDDEN), "w2": normal(HIDDEN, DIM) * 0.1, "out": normal(DIM, CLASSES)}
    prior = by_class + 1.0
    p |= {"b1": np.zeros(HIDDEN, np.float32), "bias": np.log(prior / prior.sum()).astype(np.float32), "distance": np.zeros(CONTEXT, np.float32)}
    p["embed"] = (rng.normal(0, 1, (CLASSES, DIM))[class_of] + rng.normal(0, 0.1, (VOCABULARY, DIM))).astype(np.float32)
    return Model(p, class_of, share)


class Trainer:
    """Adam on the model's weights; gradients by hand."""

    def __init__(self, model: Model) -> None:
        dense = {n: w for n, w in model.p.items() if n != "embed"}
        self.dense, at = np.concatenate([w.ravel() for w in dense.values()]).astype(np.float32), np.cumsum([0, *(w.size for w in dense.values())])
        cut = {n: self.dense[i:j].reshape(w.shape) for (n, w), i, j in zip(dense.items(), at[:-1], at[1:], strict=True)}  # one update for all of them
        self.model = Model({n: cut[n] if n in cut else w.copy() for n, w in model.p.items()}, model.class_of, model.share)
        self.moments = [tuple(np.zeros_like(w) for _ in range(2)) for w in (self.dense, model.p["embed"])]
        self.place = np.zeros(VOCABULARY, np.int64)
        self.t = 0

    def gradient(self, x_ids: np.ndarray, classes: np.ndarray, ok: np.ndarray, j: Joined) -> tuple[list[np.ndarray], np.ndarray]:
        """Of a lot of windows: what targets with these weights ask of the weights (as ``_named`` takes them), and of each input.

        Powers are never divided by their sums: the few rows they are multiplied with are.
        """
        p, f = self.model.p, self.model.forward(x_ids, j)
        e = np.exp(f["logits"], out=f["logits"])
        total = e.sum(axis=0)
        e.ravel()[_cells(classes)] -= total
        scale = ok / total
        out = (f["z"] * scale) @ e.T
        dz = p["out"] @ e
        dz *= scale
        dh = p["w2"] @ dz
        dh *= f["h"] > 0
        dy = p["w1"] @ dh
        dy += dz
        do = np.empty((DIM + 1, len(scale)), np.float32)
        np.multiply(p["o"] @ dy, f["part"], out=do[:DIM])
        np.negative((do[:DIM] * f["att"]).sum(axis=0), out=do[DIM])
        do = np.ascontiguousarray(do.T).reshape(-1, STEP, DIM + 1)
        ds = do @ f["across"][:, DIM:]
        ds *= f["e"]
        dqkv = np.zeros((len(x_ids), CONTEXT, 3 * DIM), np.float32)
        np.matmul(ds, f["qkv"][..., DIM : 2 * DIM], out=dqkv[:, PAD:, :DIM])
        np.matmul(ds.transpose(0, 2, 1), f["qkv"][:, PAD:, :DIM], out=dqkv[..., DIM : 2 * DIM])
        np.matmul(f["e"].transpose(0, 2, 1), do[..., :DIM], out=dqkv[..., 2 * DIM :])
        dqkv = dqkv.reshape(-1, 3 * DIM)
        dx = j.qkv[:, :-1] @ dqkv.T
        dx.reshape(DIM, -1, CONTEXT)[..., PAD:] += dy.reshape(DIM, -1, STEP)
        return [f["x"].T @ dqkv, f["att"] @ dy.T, f["y"] @ dh.T, f["h"] @ dz.T, out, ds.sum(axis=0)], dx

    def step(self, x_ids: np.ndarray, y_ids: np.ndarray, ok: np.ndarray, rate: float) -> None:
        model, j = self.model, self.model.joined()
        weight, classes = np.divide(ok, max(np.count_nonzero(ok), 1), dtype=np.float32), model.class_of[y_ids]
        lots = -(-len(x_ids) // LOT)
        cuts = [slice(len(x_ids) * i // lots, len(x_ids) * (i + 1) // lots) for i in range(lots)]
        own, dx = zip(*(self.gradient(x_ids[c], classes[c].ravel(), weight[c].ravel(), j) for c in cuts), strict=True)
        g = _named([sum(x[1:], start=x[0]) for x in zip(*own, strict=True)])
        flat = x_ids.ravel()
        ids = np.sort(flat)
        ids = ids[np.append(True, ids[1:] != ids[:-1])]
        self.place[ids] = np.arange(len(ids))
        inverse, embed = self.place[flat], np.empty((len(ids), DIM), np.float32)
        for d, row in enumerate(np.concatenate(dx, axis=1)):
            embed[:, d] = np.bincount(inverse, weights=row, minlength=len(ids))
        self.t += 1
        self.dense -= self._moved(np.concatenate([g[n].ravel() for n in model.p if n != "embed"]), self.moments[0], rate)
        own = [np.take(m, ids, axis=0) for m in self.moments[1]]
        rows = np.take(model.p["embed"], ids, axis=0)
        rows -= self._moved(embed, own, rate)
        for all_rows, some in zip((model.p["embed"], *self.moments[1]), (rows, *own), strict=True):
            all_rows[ids] = some

    def _moved(self, g: np.ndarray, moments: tuple[np.ndarray, np.ndarray], rate: float) -> np.ndarray:
        """Adam's step by a gradient; its moments are brought up to date."""
        first, second = moments
        root = (1 - 0.98**self.t) ** 0.5
        first += 0.1 * (g - first)
        second += 0.02 * (g * g - second)
        below = np.sqrt(second)
        below += 1e-8 * root
        return np.divide(first, below, out=below) * (rate * root / (1 - 0.9**self.t))


def _named(g: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Gradients by the weights' names."""
    qkv, o, hidden, w2, classes, gaps = g
    distance = np.bincount(_GAP.ravel(), weights=gaps.ravel(), minlength=CONTEXT).astype(np.float32)
    q, k, v = qkv[:, :DIM], qkv[:, DIM : 2 * DIM], qkv[:, 2 * DIM :]
    return {"q": q, "k": k, "v": v, "o": o, "w1": hidden[:DIM], "b1": hidden[DIM], "w2": w2, "out": classes[:DIM], "bias": classes[DIM], "distance": distance}


def train(model: Model, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray, steps: int = 1000, batch: int = 128, rate: float = 0.01, seed: int = 11) -> Model:
    """Steps on random windows at a falling rate."""
    trainer, rng = Trainer(model), np.random.default_rng(seed)
    for t in range(1, steps + 1 if len(inputs) else 1):
        pick = rng.integers(0, len(inputs), batch)
        trainer.step(inputs[pick], targets[pick], real[pick], rate * min(1.0, t / 20) * (1 - t / (steps + 1)))
    return trainer.model
