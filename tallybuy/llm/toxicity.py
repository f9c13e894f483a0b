"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word comes in as the embedding of the word and of its character strings; the
network reads overlapping windows of words in both directions, attention pools
each window, and the highest window decides for the text.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybuy.llm.common import reuse_freed_memory, text_of

#: Windows overlap by half, so every passage of up to 16 words lies whole in one.
_WINDOW, _STRIDE = 32, 16
_WIDTH, _HIDDEN = 8, 8
#: Cells of the hashed embeddings, of words and of character strings.
_WORD_CELLS, _CHAR_CELLS = 1 << 15, 1 << 17
#: Lengths of the character strings; a word has a mark at each end.
_LENGTHS = (3, 4, 5, 6)
_GROUP_WORDS = 1 << 16
#: Words whose cells are found, and documents whose cells are counted, at once.
_CHUNK, _CHUNK_DOCS = 1 << 14, 64


# --- words --------------------------------------------------------------------------------


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _mixed(h: np.ndarray, cells: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return (h & np.uint64(cells - 1)).astype(np.int64)


@dataclass
class _Words:
    """Cells of distinct words: one of the word itself, and those of its character strings in a flat list."""

    word: np.ndarray
    chars: np.ndarray
    begin: np.ndarray
    count: np.ndarray


def _cells(words: list[str]) -> _Words:
    """Cells of any number of words, some at a time."""
    parts = [_some_cells(words[at : at + _CHUNK]) for at in range(0, len(words), _CHUNK)]
    word, chars, count = (np.concatenate(x) if parts else np.empty(0, np.int32) for x in (zip(*parts) if parts else ((), (), ())))
    return _Words(word, chars, np.cumsum(count, dtype=np.int64) - count, count)


def _some_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    marked = "".join(f"\x02{w}\x03" for w in words)
    points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    end_of = np.repeat(ends, sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points))
    whole = np.zeros(len(points) + 1, np.uint64)
    scrambled = (points + np.uint64(1)) * (place - (end_of - sizes[owner]) + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    scrambled ^= scrambled >> np.uint64(29)
    np.cumsum(scrambled * np.uint64(0xBF58476D1CE4E5B9), out=whole[1:])
    word = _mixed(whole[ends] - whole[ends - sizes], _WORD_CELLS)
    owners, cells = [], []
    h = points.copy()
    for n in range(2, max(_LENGTHS) + 1):
        h = h[:-1] * np.uint64(0x100000001B3) + points[n - 1 :] if len(points) >= n else h[:0]
        if n in _LENGTHS:
            fits = place[: len(h)] + n <= end_of[: len(h)]
            owners.append(owner[: len(h)][fits])
            cells.append(_mixed(h[fits] * np.uint64(2 * n + 1), _CHAR_CELLS))
    owners, cells = np.concatenate(owners), np.concatenate(cells)
    order = np.argsort(owners, kind="stable")
    count = np.bincount(owners, minlength=len(words))
    return word.astype(np.int32), cells[order].astype(np.int32), count


def _chosen(words: _Words, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word cells, character cells and owners (by place in k) of some words."""
    count = words.count[k]
    owner = np.repeat(np.arange(len(k)), count)
    at = np.repeat(words.begin[k] - (np.cumsum(count) - count), count) + np.arange(len(owner))
    return words.word[k], words.chars[at], owner


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and text of each overlapping window over joined texts of some words each."""
    number = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - _WINDOW) // _STRIDE)), 0)
    text = np.repeat(np.arange(len(sizes)), number)
    step = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    begins = np.cumsum(sizes) - sizes
    first = step * _STRIDE
    return begins[text] + first, np.minimum(_WINDOW, sizes[text] - first), text


# --- the network --------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, np.float32(0.5), out=x)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


class Network:
    """Parameters by name, and the passes forward and back."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        h, d = _HIDDEN, 2 * _WIDTH

        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "words": draw(_WORD_CELLS, _WIDTH, scale=0.1),
            "chars": draw(_CHAR_CELLS, _WIDTH, scale=0.1),
            "inward": draw(d, 6 * h, scale=d**-0.5),
            "bias": np.zeros(6 * h, np.float32),
            "ahead": draw(h, 3 * h, scale=h**-0.5),
            "back": draw(h, 3 * h, scale=h**-0.5),
            "attend": draw(2 * h, scale=(2 * h) ** -0.5),
            "out": draw(2 * h, scale=(2 * h) ** -0.5),
            "shift": np.zeros(1, np.float32),
        }

    def inputs(self, word: np.ndarray, chars: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vector of each word, and the weight of its character strings."""
        count = np.bincount(owner, minlength=len(word))
        weight = (1 / np.sqrt(np.maximum(count, 1))).astype(np.float32)
        x = np.zeros((len(word), 2 * _WIDTH), np.float32)
        x[:, :_WIDTH] = self.p["words"][word]
        if len(chars):
            full = count > 0
            start = (np.cumsum(count) - count)[full]
            x[full, _WIDTH:] = np.add.reduceat(self.p["chars"][chars], start, axis=0) * weight[full, None]
        return x, weight

    def _steps(self, gates: np.ndarray, codes: np.ndarray, sizes: np.ndarray, side: str, keep: list | None):
        """States after each word of the windows, read from one side."""
        h, k = _HIDDEN, (0 if side == "ahead" else 3 * _HIDDEN)
        table = np.ascontiguousarray(gates[:, k : k + 3 * h])
        u = self.p[side]
        state = np.zeros((len(codes), h), np.float32)
        states = np.empty((codes.shape[1], len(codes), h), np.float32)
        times = range(codes.shape[1]) if side == "ahead" else range(codes.shape[1] - 1, -1, -1)
        for t in times:
            a = table[codes[:, t]]
            r = state @ u
            zr = _sigmoid(a[:, : 2 * h] + r[:, : 2 * h])
            n = np.tanh(a[:, 2 * h :] + zr[:, h:] * r[:, 2 * h :])
            fresh = n + zr[:, :h] * (state - n)
            live = t < sizes
            if keep is not None:
                keep.append((t, state, zr, n, r[:, 2 * h :], live))
            state = fresh if live.all() else np.where(live[:, None], fresh, state)
            states[t] = state
        return states

    def forward(self, gates: np.ndarray, codes: np.ndarray, sizes: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Logit of each window; ``codes`` (windows, words) are rows of ``gates``."""
        ahead = self._steps(gates, codes, sizes, "ahead", kept and kept["ahead"] if kept else None)
        back = self._steps(gates, codes, sizes, "back", kept and kept["back"] if kept else None)
        h = _HIDDEN
        score = ahead @ self.p["attend"][:h] + back @ self.p["attend"][h:]
        score[np.arange(codes.shape[1])[:, None] >= sizes] = -np.inf
        score -= score.max(0)
        weight = np.exp(score)
        weight /= weight.sum(0)
        value = ahead @ self.p["out"][:h] + back @ self.p["out"][h:]
        if kept is not None:
            kept |= {"states": (ahead, back), "weight": weight, "value": value}
        return (weight * value).sum(0) + self.p["shift"][0]

    def backward(self, gates, codes, sizes, kept: dict, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the dense parameters, and of ``gates``."""
        h = _HIDDEN
        ahead, back = kept["states"]
        weight, value = kept["weight"], kept["value"]
        d_value = weight * d_logit
        d_score = weight * (value - (weight * value).sum(0)) * d_logit
        grads = {
            "shift": np.array([d_logit.sum()], np.float32),
            "attend": np.concatenate([np.einsum("tb,tbh->h", d_score, s) for s in (ahead, back)]),
            "out": np.concatenate([np.einsum("tb,tbh->h", d_value, s) for s in (ahead, back)]),
        }
        d_gates = np.zeros_like(gates)
        for side, k in (("ahead", 0), ("back", h)):
            d_states = d_score[:, :, None] * self.p["attend"][k : k + h] + d_value[:, :, None] * self.p["out"][k : k + h]
            u, d_u = self.p[side], np.zeros_like(self.p[side])
            d_state = np.zeros((len(codes), h), np.float32)
            for t, state, zr, n, r_n, live in reversed(kept[side]):
                d = (d_state + d_states[t]) * live[:, None]
                z, r = zr[:, :h], zr[:, h:]
                d_n = d * (1 - z) * (1 - n * n)
                d_z = d * (state - n) * z * (1 - z)
                d_r = d_n * r_n * r * (1 - r)
                through = np.concatenate([d_z, d_r, d_n * r], 1)
                d_u += state.T @ through
                own = np.concatenate([d_z, d_r, d_n], 1)
                np.add.at(d_gates[:, 3 * k : 3 * k + 3 * h], codes[:, t], own)
                d_state = np.where(live[:, None], d * z + through @ u.T, d_state + d_states[t] * 0)
            grads[side] = d_u
        return grads, d_gates

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()


# --- training -----------------------------------------------------------------------------


def _evidence(cells_of, docs: np.ndarray, labels: np.ndarray, n: int) -> np.ndarray:
    """Log-odds of n cells, by the documents of either label that hold them; ``cells_of`` a few documents."""
    held = {0: np.zeros(n), 1: np.zeros(n)}
    for at in range(0, len(docs), _CHUNK_DOCS):
        part = docs[at : at + _CHUNK_DOCS]
        which, cells = cells_of(part)
        pairs = np.unique(which.astype(np.int64) * n + cells)
        for label, count in held.items():
            mine = labels[part][pairs // n] == label
            count += np.bincount(pairs[mine] % n, minlength=n)
    ones = labels[docs].sum()
    ratio = np.log((held[1] + 1) / (ones + 2)) - np.log((held[0] + 1) / (len(docs) - ones + 2))
    return np.clip(ratio, -3, 3).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, share: float, epochs: int = 5, batch: int = 64, rate: float = 0.01) -> tuple[Network, float, float]:
    """Network, and slope and shift that turn its logits into calibrated ones.

    A text's logit is that of its highest window, which also takes the gradient.
    Before training, one component of each embedding is set to the log-odds of
    its cell. A fifth of the texts only calibrates: a logistic fit of labels on
    logits, weighed so that a ``share`` of texts is toxic, as in all labels.
    """
    place: dict[str, int] = {}
    coded = [np.array([place.setdefault(w, len(place)) for w in words_of(t)], np.int32) for t in texts]
    sizes = np.array([len(c) for c in coded], np.int64)
    codes = np.concatenate(coded) if coded else np.empty(0, np.int32)
    del coded
    words = _cells(list(place))
    del place
    starts = np.cumsum(sizes) - sizes
    usable = np.flatnonzero(sizes > 0)
    rng = np.random.default_rng(1)
    rng.shuffle(usable)
    held, fit = usable[: len(usable) // 5], usable[len(usable) // 5 :]
    net = Network()

    def word_cells(docs):
        which = np.repeat(np.arange(len(docs)), sizes[docs])
        return which, words.word[np.concatenate([codes[starts[d] : starts[d] + sizes[d]] for d in docs])]

    def char_cells(docs):
        which = np.repeat(np.arange(len(docs)), sizes[docs])
        used = np.concatenate([codes[starts[d] : starts[d] + sizes[d]] for d in docs])
        pairs = np.unique(which * np.int64(len(words.count)) + used)
        _, chars, owner = _chosen(words, pairs % len(words.count))
        return (pairs // len(words.count))[owner], chars

    net.p["words"][:, 0] = _evidence(word_cells, fit, labels, _WORD_CELLS)
    net.p["chars"][:, 0] = _evidence(char_cells, fit, labels, _CHAR_CELLS)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    steps = 0

    def logits_of(docs: np.ndarray):
        """Windows of some texts with their logits, and what is needed to go on with them."""
        first, size, text = _windows(sizes[docs])
        begin = starts[docs][text] + first - (np.cumsum(sizes[docs]) - sizes[docs])[text]
        at = begin[:, None] + np.minimum(np.arange(_WINDOW), size[:, None] - 1)
        used, local = np.unique(codes[at], return_inverse=True)
        parts = _chosen(words, used)
        x, weight = net.inputs(*parts)
        gates = x @ net.p["inward"] + net.p["bias"]
        local = local.reshape(at.shape)
        return net.forward(gates, local, size), local, size, text, used

    for epoch in range(epochs):
        for at in range(0, len(fit), batch):
            docs = fit[at : at + batch]
            logit, local, size, text, used = logits_of(docs)
            order = np.lexsort((-logit, text))
            top = order[np.concatenate([[True], text[order][1:] != text[order][:-1]])]
            rows, codes_top = np.unique(local[top], return_inverse=True)
            codes_top = codes_top.reshape(len(top), -1)
            word, chars, owner = _chosen(words, used[rows])
            x, weight = net.inputs(word, chars, owner)
            gates = x @ net.p["inward"] + net.p["bias"]
            kept = {"ahead": [], "back": []}
            z = net.forward(gates, codes_top, size[top], kept)
            d = ((1 / (1 + np.exp(-z)) - labels[docs[text[top]]]) / len(top)).astype(np.float32)
            grads, d_gates = net.backward(gates, codes_top, size[top], kept, d)
            grads["inward"], grads["bias"] = x.T @ d_gates, d_gates.sum(0)
            d_x = d_gates @ net.p["inward"].T
            steps += 1
            pace = rate * min(1.0, 3 * (1 - (epoch * len(fit) + at) / (epochs * len(fit))))
            for name, g in grads.items():
                _adam(net.p[name], g, moments[name], steps, pace)
            spread = d_x[:, _WIDTH:] * weight[:, None]
            _adam_rows(net.p["words"], word, d_x[:, :_WIDTH], moments["words"], pace)
            _adam_rows(net.p["chars"], chars, spread[owner], moments["chars"], pace)
        rng.shuffle(fit)
    highest = np.full(len(texts), -np.inf)
    for at in range(0, len(held), 256):
        docs = held[at : at + 256]
        logit, _, _, text, _ = logits_of(docs)
        np.maximum.at(highest, docs[text], logit)
    slope, shift = _calibrate(highest[held], labels[held], share)
    return net, slope, shift


def _adam(p, g, moments, steps, rate):
    m, v = moments
    m += 0.1 * (g - m)
    v += 0.01 * (g * g - v)
    p -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-7)


def _adam_rows(p, rows, g, moments, rate):
    """Adagrad on the rows that have gradients."""
    if not len(rows):
        return
    used, inverse = np.unique(rows, return_inverse=True)
    total = np.zeros((len(used), p.shape[1]), np.float32)
    np.add.at(total, inverse, g)
    moments[1][used] += total * total
    p[used] -= rate * total / (np.sqrt(moments[1][used]) + 1e-7)


def _calibrate(logit: np.ndarray, label: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic fit of labels on logits, with weights that make a share of them 1, by Newton steps."""
    if len(logit) < 10 or label.min() == label.max():
        return 1.0, 0.0
    weight = np.where(label == 1, share / label.mean(), (1 - share) / (1 - label.mean()))
    x = np.stack([logit, np.ones(len(logit))], 1)
    theta = np.array([1.0, np.log(share / (1 - share))])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (weight * (q - label)) + 0.01 * (theta - [1, 0])
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        theta -= np.clip(step, -2, 2)
    return float(max(theta[0], 1e-3)), float(theta[1])


# --- Spark --------------------------------------------------------------------------------


@dataclass(frozen=True)
class ToxicityModel:
    """``network`` is None where nothing could be learned: then every score is ``share``."""

    network: bytes | None
    slope: float
    shift: float
    share: float


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> ToxicityModel:
    """Train on about ``per_class`` labelled documents of each class.

    ``labels`` has ``doc_id`` and ``toxic`` (0 or 1; others and null ids don't
    count). Rows are chosen by a hash of the id. The sample goes to one task,
    which trains; the driver only sees the parameters.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return ToxicityModel(None, 1.0, 0.0, share)
    part = F.when(F.col("toxic") == 1, min(1.0, per_class / counts[1])).otherwise(min(1.0, per_class / counts[0]))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < part * 1_000_000).dropDuplicates(["doc_id"])
    # About 2 per_class rows of two numbers, whatever the table's size.
    sample = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches):
        reuse_freed_memory()
        rows = sorted(r for b in batches for r in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["toxic"].to_pylist()))
        label = np.array([r[2] for r in rows], np.float64)
        if len(rows) < 20 or label.min() == label.max():
            return
        net, slope, shift = train([r[1] for r in rows], label, share)
        yield pa.RecordBatch.from_arrays(
            [pa.array([net.dump()], pa.binary()), pa.array([slope]), pa.array([shift])], names=["network", "slope", "shift"]
        )

    found = sample.repartition(1).mapInArrow(run, "network binary, slope double, shift double").first()
    return ToxicityModel(bytes(found["network"]), found["slope"], found["shift"], share) if found else ToxicityModel(None, 1.0, 0.0, share)


class _Scorer:
    def __init__(self, dumped: bytes):
        self.net = Network()
        self.net.p = dict(np.load(io.BytesIO(dumped)))

    def logits(self, texts: list[str]) -> np.ndarray:
        """Highest window logit of each text; -inf without words."""
        out = np.full(len(texts), -np.inf)
        group, held, size = [], [], 0
        for k, text in enumerate(texts):
            words = words_of(text)
            group.append(words)
            held.append(k)
            size += len(words)
            if size >= _GROUP_WORDS or k == len(texts) - 1:
                self._group(group, held, out)
                group, held, size = [], [], 0
        return out

    def _group(self, group: list[list[str]], held: list[int], out: np.ndarray) -> None:
        sizes = np.array([len(w) for w in group], np.int64)
        if not sizes.sum():
            return
        codes, distinct = pd.factorize(np.array([w for ws in group for w in ws], object))
        words = _cells(list(distinct))
        x, _ = self.net.inputs(words.word, words.chars, np.repeat(np.arange(len(words.count)), words.count))
        gates = x @ self.net.p["inward"] + self.net.p["bias"]
        first, size, text = _windows(sizes)
        for at in range(0, len(first), 4096):  # a long text has many windows
            part = slice(at, at + 4096)
            place = first[part, None] + np.minimum(np.arange(_WINDOW), size[part, None] - 1)
            logit = self.net.forward(gates, codes[place], size[part])
            np.maximum.at(out, np.array(held)[text[part]], logit)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of each row of ``docs``, from its whole text alone.

    ``score`` is the calibrated probability that the label is 1, from the highest
    of all overlapping windows; ``predicted`` is 1 from ``threshold`` on. Null,
    empty and blank texts, which have no window, score 0. Equal texts score
    alike; other columns aren't read.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    if model.network is None:
        scored = rows.select("doc_id", F.when(F.trim("text") == "", 0.0).otherwise(model.share).alias("score"))
    else:
        held = docs.sparkSession.sparkContext.broadcast(model.network)
        slope, shift = model.slope, model.shift

        def run(batches):
            reuse_freed_memory()
            scorer = _Scorer(held.value)
            for batch in batches:
                logit = slope * scorer.logits(batch["text"].to_pylist()) + shift
                score = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(np.where(np.isneginf(logit), 0.0, score))], names=["doc_id", "score"]
                )

        scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
