"""Language-model scoring: a gated recurrent network in numpy over counts of the whole corpus.

Counts: every word of every training document is counted (partly summed in its task before the shuffle).

Model: the previous token drives a gated recurrent unit, whose state predicts the next token's class and then, for
frequent words, the word in its class (class-factored softmax). Rarer words are classed by their last two bytes; in
such a class a word's share is that of its count, (c + 0.5) / (n + 0.5 (v + 1)) for the class's n tokens and v words,
so every word has a probability, met or not.

Training: truncated back-propagation through time on every training document, each in one of the rounds. In a round
every task trains on its own documents from common weights, and the tasks' weights are averaged by tokens, in the
tasks' order, so that the same input gives the same weights whatever fails and is run again. Scoring: documents stream through lanes of one batch, window by window, with the state carried from window to
window until a document ends, so a document of any length is scored whole.

Only the `known` most frequent words (a fixed number) are sent to tasks with their counts; all other words of a
document meet their counts in a join.

Defined cases: a null text is one end token; rows that share an id are scored each; without training documents all
counts are zero and the network keeps its first weights; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

import copy
import heapq
import math
import zlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartulary.llm.common import materialize, record_batch

END = ""  # no word is empty
TAIL_CLASSES = 16
#: Bytes of texts that are split into words at a time.
SLICE_BYTES = 4 << 20
LEAST_HEAD = 1024
#: Documents that wait for a lane at most (and one batch more), so that long ones can go first.
WAITING = 1024


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts, one after another, how many each has): runs without \\x20 and \\x09-\\x0D, A-Z in lower case."""
    fresh = texts.take(pa.array(np.arange(len(texts))))  # ascii_lower goes wrong on slices whose bytes don't begin their buffer
    lists = pc.ascii_split_whitespace(pc.ascii_lower(fresh.cast(pa.large_string()).fill_null("")))
    words, sizes = lists.flatten(), lists.value_lengths().to_numpy().astype(np.int64)
    filled = pc.greater(pc.binary_length(words), 0)
    if not pc.all(filled).as_py():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=filled.to_numpy(zero_copy_only=False), minlength=len(sizes)).astype(np.int64)
        words = words.filter(filled)
    return words, sizes


def text_slices(batches, column: str):
    """Batches cut into runs of rows whose texts have SLICE_BYTES at most, or one row."""
    for batch in batches:
        size = np.append(0, np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


@cache
def _tail_tables() -> tuple[np.ndarray, np.ndarray]:
    """Tail classes by the only byte, and by the last two."""
    return np.array([tail_class(bytes([a])) for a in range(256)], np.int32), np.array([tail_class(bytes([a, b])) for a in range(256) for b in range(256)], np.int32)


def tail_classes(words: pa.Array) -> np.ndarray:
    """Of large strings, none of them empty."""
    if not len(words):
        return np.zeros(0, np.int32)
    one, two = _tail_tables()
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)
    last, before = data[ends[1:] - 1], data[np.maximum(ends[1:] - 2, 0)]
    return np.where(np.diff(ends) > 1, two[before.astype(np.int64) * 256 + last], one[last])


def word_counts(docs: DataFrame, *, text_col: str = "text", flush: int = 2_000_000) -> DataFrame:
    """(word, c) over all texts, the end of each counted as the word ''. A task sums every `flush` words."""

    def run(batches):
        held, n_held, ends = [], 0, 0

        def out():
            counts = pa.concat_arrays(held).value_counts()
            return pa.RecordBatch.from_arrays([pa.concat_arrays([counts.field("values").cast(pa.string()), pa.array([END])]), pa.concat_arrays([counts.field("counts"), pa.array([ends], pa.int64())])], names=["word", "n"])

        for b in text_slices(batches, text_col):
            words, sizes = split_words(b.column(text_col))
            held.append(words)
            n_held, ends = n_held + len(words), ends + len(sizes)
            if n_held >= flush:
                yield out()
                held, n_held, ends = [], 0, 0
        if ends:
            yield out()

    return docs.select(text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def tail_class_of(word: Column) -> Column:
    return F.pmod(F.crc32(F.substring(word.cast("binary"), -2, 2)), F.lit(TAIL_CLASSES)).cast("int")


@dataclass
class Vocabulary:
    """words: the known ones, most frequent first, the first `head` of them predicted one by one; tokens are these,
    then the tail classes. classes: of each token; members: the head words of each class."""

    words: list[bytes]
    counts: np.ndarray
    head: int
    classes: np.ndarray
    members: list[np.ndarray]
    tail_n: np.ndarray
    tail_v: np.ndarray
    total: int
    distinct: int

    @classmethod
    def build(cls, known: list[tuple[str, int]], tails: dict[int, tuple[int, int]], total: int, distinct: int, head: int, n_classes: int) -> Vocabulary:
        known = sorted(known, key=lambda x: (-x[1], x[0]))
        words, counts = [w.encode("utf-8") for w, _ in known], np.array([c for _, c in known], dtype=np.int64)
        head = min(head, len(words))
        if END.encode() not in words[:head]:  # the end is always a token of its own
            head = min(head, max(len(words) - 1, 0))
            at = words.index(b"") if b"" in words else None
            c = counts[at] if at is not None else 0
            if at is not None:
                del words[at]
                counts = np.delete(counts, at)
            words.insert(0, b"")
            counts = np.insert(counts, 0, c)
            head = max(1, min(head + 1, len(words)))
        mass = np.cumsum(np.sqrt(counts[:head] + 0.5))
        classes = np.minimum((mass / mass[-1] * n_classes).astype(int), n_classes - 1)
        _, classes = np.unique(classes, return_inverse=True)
        n = int(classes.max()) + 1
        tail_n, tail_v = (np.array([tails.get(k, (0, 0))[i] for k in range(TAIL_CLASSES)], dtype=np.int64) for i in (0, 1))
        for w, c in zip(words[:head], counts[:head].tolist(), strict=True):
            if c:
                tail_n[tail_class(w)] -= c
                tail_v[tail_class(w)] -= 1
        return cls(words, counts, head, np.concatenate([classes, np.arange(n, n + TAIL_CLASSES)]), [np.flatnonzero(classes == k) for k in range(n)], tail_n, tail_v, total, distinct)

    @property
    def n_classes(self) -> int:
        return len(self.members) + TAIL_CLASSES


class Reader:
    """Turns texts into tokens."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.known = pa.array([w.decode("utf-8") for w in v.words], pa.large_string())
        self.end = v.words.index(b"")
        self.end_unmet = int(v.counts[self.end] == 0)
        self.log_tail = np.log10(v.tail_n + 0.5 * (v.tail_v + 1))
        token = np.array([i if i < v.head else v.head + tail_class(w) for i, w in enumerate(v.words)], dtype=np.int32)
        logs = np.log10(v.counts + 0.5)
        parts = np.where(token >= v.head, logs - self.log_tail[np.maximum(token - v.head, 0)], 0.0)
        # The last place of each table is for words that aren't known.
        self.token, self.log_count, self.part = np.append(token, 0).astype(np.int32), np.append(logs, 0.0), np.append(parts, 0.0)

    def _tokens(self, texts: pa.Array):
        words, sizes = split_words(texts)
        at = pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy(zero_copy_only=False)
        tokens = self.token.take(at, mode="wrap")
        new = np.flatnonzero(at < 0)
        unknown = words.take(pa.array(new))
        tails = tail_classes(unknown)
        tokens[new] = self.v.head + tails
        ends = np.cumsum(sizes)
        return at, tokens, new, unknown, tails, ends - sizes, ends

    def sequences(self, texts: pa.Array) -> list[np.ndarray]:
        """The tokens of each text, and its end."""
        _, tokens, _, _, _, starts, ends = self._tokens(texts)
        last = np.array([self.end], np.int32)
        return [np.concatenate([tokens[a:b], last]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def read(self, texts: pa.Array) -> list[tuple[np.ndarray, float, float, int, pa.Array]]:
        """For each text: tokens with the end, the sum of log10 counts of known words, the part of those that are predicted
        by class and count, less the classes' log10 sizes, known tokens, and the words that aren't known."""
        at, tokens, new, unknown, tails, starts, ends = self._tokens(texts)
        part = self.part.take(at, mode="wrap")
        part[new] -= self.log_tail[tails]
        logs, parts, known = (np.append(0, np.cumsum(x)) for x in (self.log_count.take(at, mode="wrap"), part, at >= 0))
        logs, parts, known = logs[ends] - logs[starts] + self.log_count[self.end], parts[ends] - parts[starts], known[ends] - known[starts] + 1 - self.end_unmet
        first, last = np.searchsorted(new, starts), np.searchsorted(new, ends)
        final = np.array([self.end], np.int32)
        return [(np.concatenate([tokens[a:b], final]), float(x), float(y), int(k), unknown.slice(i, j - i)) for a, b, x, y, k, i, j in zip(*(z.tolist() for z in (starts, ends, logs, parts, known, first, last)), strict=True)]


class Network:
    """A gated recurrent unit of `size` numbers and its output layers; weights are float32 arrays by name."""

    def __init__(self, v: Vocabulary, size: int, seed: int = 5):
        self.v, self.size = v, size
        rng = np.random.default_rng(seed)
        n = v.head + TAIL_CLASSES
        mass = np.zeros(v.n_classes)
        np.add.at(mass, v.classes, np.concatenate([v.counts[: v.head] + 0.5, np.maximum(v.tail_n, 0) + 0.5]))
        self.w = {
            "x": rng.normal(0, 0.1, (n, 3 * size)),
            "u": rng.normal(0, 1 / np.sqrt(size), (size, 3 * size)),
            "b": np.concatenate([np.ones(size), np.zeros(2 * size)]),
            "c": rng.normal(0, 0.1, (size, v.n_classes)),
            "cb": np.log(mass / mass.sum()),
            "o": rng.normal(0, 0.1, (v.head, size)),
            "ob": np.log(v.counts[: v.head] + 0.5),
        }
        self.w = {k: a.astype(np.float32) for k, a in self.w.items()}

    def copy(self) -> Network:
        """The same with weights of its own."""
        other = copy.copy(self)
        other.w = {k: a.copy() for k, a in self.w.items()}
        return other

    def run(self, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool = False):
        """States (steps x lanes x size), the last, and on request what back-propagation needs; fresh marks steps that
        begin a document."""
        s = self.size
        # Gates are kept as the negatives that the logistic function takes; all arrays are contiguous by step.
        x = self.w["x"] + self.w["b"]
        gates, n = (-x[:, : 2 * s]).take(inputs, axis=0), x[:, 2 * s :].take(inputs, axis=0)
        to_gates, to_n = np.ascontiguousarray(-self.w["u"][:, : 2 * s]), np.ascontiguousarray(self.w["u"][:, 2 * s :])
        out = np.empty(n.shape, n.dtype)
        before, recur = (np.empty(n.shape, n.dtype) for _ in range(2)) if keep else (None, None)
        g, pull = np.empty(n.shape[1:], n.dtype), np.empty(gates.shape[1:], n.dtype)
        begins = fresh.any(axis=1).tolist()
        for t in range(len(inputs)):
            if begins[t]:
                h = np.where(fresh[t][:, None], h.dtype.type(0), h)
            zr = gates[t]
            zr += np.matmul(h, to_gates, out=pull)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.matmul(h, to_n, out=g)
            if keep:
                before[t], recur[t] = h, g
            g *= zr[:, s:]
            n[t] += g
            np.tanh(n[t], out=n[t])
            h = np.subtract(h, n[t], out=out[t])
            h *= zr[:, :s]
            h += n[t]
        return out, h.copy(), (before, gates, recur, n) if keep else None

    def log_probs(self, states: np.ndarray, targets: np.ndarray, cells: np.ndarray, grads: dict | None = None):
        """Natural log of P(class) and, for head words, P(word | class), at the given cells of a window (states: cells x
        size); with grads, also adds the gradients of minus their sum and returns those of all states."""
        w, kind = self.w, states.dtype
        ones = np.ones(max(self.v.n_classes, self.v.head), kind)
        # Class by class: once sorted, a class's rows lie side by side, and so do its words.
        cls = self.v.classes[targets[cells]].astype(np.int16)
        order = np.argsort(cls, kind="stable")
        cls, at = cls[order], cells[order]
        near, word = states[at], targets[at]
        bounds = np.searchsorted(cls, np.arange(len(self.v.members) + 1)).tolist()

        def softmax(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Natural log of the share of column `at` of each row; the logits become the gradient of minus its sum."""
            np.minimum(logits, 80, out=logits)  # float32 holds exp of these, so no row's greatest is needed
            np.maximum(logits, -80, out=logits)
            flat = np.arange(0, logits.size, logits.shape[1])
            flat += at
            out = logits.reshape(-1).take(flat)
            np.exp(logits, out=logits)
            total = logits @ ones[: logits.shape[1]]
            out -= np.log(total)
            if grads is not None:
                logits *= (1 / total)[:, None]
                logits.reshape(-1)[flat] -= 1
            return out

        e = near @ w["c"]
        e += w["cb"]
        found = softmax(e, cls)
        if grads is not None:
            grads["c"] += near.T @ e
            grads["cb"] += np.ones(len(e), kind) @ e
            pull = e @ w["c"].T
        for members, a, b in zip(self.v.members, bounds, bounds[1:], strict=False):
            if len(members) < 2 or a == b:
                continue
            lo, hi = int(members[0]), int(members[-1]) + 1
            own, here = w["o"][lo:hi], near[a:b]
            inner = here @ own.T
            inner += w["ob"][lo:hi]
            found[a:b] += softmax(inner, word[a:b] - lo)
            if grads is not None:
                grads["o"][lo:hi] += inner.T @ here
                grads["ob"][lo:hi] += np.ones(b - a, kind) @ inner
                pull[a:b] += inner @ own
        out = np.empty_like(found)
        out[order] = found
        if grads is None:
            return out, None
        back = np.zeros_like(states)
        back[at] = pull
        return out, back

    def gradients(self, inputs, targets, fresh, live, h):
        """Of the mean loss over the live cells of a window, and the state after it."""
        s = self.size
        grads = {k: np.zeros_like(a) for k, a in self.w.items()}
        states, last, (before, gates, recur, n) = self.run(inputs, fresh, h, keep=True)
        cells = np.flatnonzero(live)
        _, back = self.log_probs(states.reshape(-1, s), targets.ravel(), cells, grads)
        back = back.reshape(states.shape)
        dg = np.empty((*inputs.shape, 3 * s), states.dtype)  # of h @ u
        dn = np.empty(states.shape, states.dtype)  # of the candidate's own input
        carry = np.zeros_like(h)
        back_u = np.ascontiguousarray(self.w["u"].T)
        begins = fresh.any(axis=1).tolist()
        for t in range(len(inputs) - 1, -1, -1):
            z, r, own, d, g = gates[t, :, :s], gates[t, :, s:], n[t], back[t], dg[t]
            d += carry
            through = d * z
            rest = d - through
            np.multiply(own, own, out=dn[t])
            np.subtract(1, dn[t], out=dn[t])
            dn[t] *= rest
            gate = before[t] - own
            gate *= rest
            np.multiply(gate, z, out=g[:, :s])
            pulled = dn[t] * r
            g[:, 2 * s :] = pulled
            pulled *= recur[t]
            pulled *= 1 - r
            g[:, s : 2 * s] = pulled
            carry = g @ back_u
            carry += through
            if begins[t]:
                carry[fresh[t]] = 0
        grads["u"] += before.reshape(-1, s).T @ dg.reshape(-1, 3 * s)
        dg[:, :, 2 * s :] = dn
        drive = dg.reshape(-1, 3 * s)
        grads["b"] += drive.sum(axis=0)
        order = np.argsort(inputs.ravel(), kind="stable")
        tokens, firsts = np.unique(inputs.ravel()[order], return_index=True)
        grads["x"][tokens] += np.add.reduceat(drive[order], firsts, axis=0)
        count = max(1, len(cells))
        for g in grads.values():
            g /= count
        return grads, last


class Lanes:
    """Windows of (inputs, targets, fresh, live, document) over documents that stream through lanes."""

    def __init__(self, lanes: int, steps: int, end: int):
        self.shape, self.end = (steps, lanes), end
        self.now: list[tuple[np.ndarray, int, int] | None] = [None] * lanes
        self.queue: list[tuple[int, int, np.ndarray]] = []  # a heap: the longest first, so that none is left over alone

    def add(self, tokens: np.ndarray, number: int) -> None:
        heapq.heappush(self.queue, (-len(tokens), number, tokens))

    def busy(self) -> bool:
        return bool(self.queue) or any(x is not None for x in self.now)

    def narrow(self, h: np.ndarray) -> np.ndarray:
        """Drops lanes that no document will use any more, and their states."""
        if self.queue or None not in self.now:
            return h
        kept = [i for i, x in enumerate(self.now) if x is not None]
        self.now = [self.now[i] for i in kept]
        self.shape = (self.shape[0], len(kept))
        return h[kept]

    def window(self):
        steps, lanes = self.shape
        inputs = np.full((lanes, steps), self.end, np.int32)
        targets = np.full((lanes, steps), self.end, np.int32)
        fresh, live, doc = np.zeros((lanes, steps), bool), np.zeros((lanes, steps), bool), np.zeros((lanes, steps), np.int64)
        for i in range(lanes):
            t = 0
            while t < steps:
                if self.now[i] is None:
                    if not self.queue:
                        break
                    _, number, tokens = heapq.heappop(self.queue)
                    self.now[i] = (tokens, number, 0)
                tokens, number, at = self.now[i]
                n = min(steps - t, len(tokens) - at)
                targets[i, t : t + n] = tokens[at : at + n]
                if at:
                    inputs[i, t : t + n] = tokens[at - 1 : at + n - 1]
                else:
                    fresh[i, t] = True
                    inputs[i, t + 1 : t + n] = tokens[: n - 1]
                live[i, t : t + n], doc[i, t : t + n] = True, number
                t += n
                self.now[i] = None if at + n == len(tokens) else (tokens, number, at + n)
        return inputs.T, targets.T, np.ascontiguousarray(fresh.T), np.ascontiguousarray(live.T), doc.T


def train_round(docs: DataFrame, net: Network, *, text_col: str, rate: float, lanes: int = 256, steps: int = 32, partials: int = 16) -> dict | None:
    """One round of training on docs from the weights of net: the tasks' weights, averaged by their tokens."""
    sent = docs.sparkSession.sparkContext.broadcast(net)  # head, known and size bound it

    def local(batches):
        net = sent.value.copy()  # a worker keeps the object for its next task
        reader = Reader(net.v)
        flow = Lanes(lanes, steps, reader.end)
        h = np.zeros((lanes, net.size), np.float32)
        moments = {k: (np.zeros_like(a), np.zeros_like(a)) for k, a in net.w.items()}
        n = step = n_read = 0

        def learn():
            nonlocal h, n, step
            h = flow.narrow(h)
            inputs, targets, fresh, live, _ = flow.window()
            grads, h = net.gradients(inputs, targets, fresh, live, h)
            n += int(live.sum())
            step += 1
            scale = min(1.0, 1.0 / max(np.sqrt(sum(float((g * g).sum()) for g in grads.values())), 1e-9))
            for k, g in grads.items():
                g *= scale
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.w[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

        for b in text_slices(batches, text_col):
            for tokens in reader.sequences(b.column(text_col)):
                flow.add(tokens, n_read)
                n_read += 1
            while len(flow.queue) >= WAITING:
                learn()
        while flow.busy():
            learn()
        if n:
            flat = np.concatenate([a.ravel() for a in net.w.values()]).astype(np.float32)
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], names=["task", "n", "weights"])

    def mean(batches):
        total, n, task = None, 0, 0
        for b in batches:
            for row in b.to_pylist():
                part = np.frombuffer(row["weights"], np.float32).astype(np.float64) * row["n"]
                total, n, task = part if total is None else total + part, n + row["n"], row["task"]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([n], pa.int64()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())], names=["task", "n", "weights"])

    kind = "task long, n long, weights binary"
    dealt = docs.select(text_col).mapInArrow(local, kind).repartition(partials, "task").sortWithinPartitions("task")  # sums in one order, whatever arrives first
    rows = sorted(dealt.mapInArrow(mean, kind).collect(), key=lambda r: r["task"])  # `partials` rows at most
    if not rows:
        return None
    flat = sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * r["n"] for r in rows) / sum(r["n"] for r in rows)
    out, at = {}, 0
    for k, a in net.w.items():
        out[k] = flat[at : at + a.size].reshape(a.shape).astype(np.float32)
        at += a.size
    return out


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", head: int | None = None, known: int = 100_000, size: int = 16, rounds: int = 2, rate: float = 0.03, lanes: int = 256) -> tuple[Network, DataFrame]:
    """(network, table of counts), from all training documents: each is counted, and each is learnt from in one of the
    rounds. Where `head` isn't given, the head words grow with the counts (`head_size`), and classes with the head."""
    counts = materialize(word_counts(docs, text_col=text_col), "lm-counts")
    bin_of = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    bins = sorted(((r["b"], r["v"], r["n"]) for r in counts.groupBy(bin_of.alias("b")).agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect()), reverse=True)  # a row for each eighth of a doubling
    least, taken = None, 0
    for b, v, _ in bins:
        if taken + v > known:
            break
        least, taken = b, taken + v
    top = [(r["word"], r["c"]) for r in counts.where((bin_of >= least) | (F.col("word") == END)).collect()] if least is not None else [(r["word"], r["c"]) for r in counts.where(F.col("word") == END).collect()]
    tails = {r["k"]: (r["n"], r["v"]) for r in counts.groupBy(tail_class_of(F.col("word")).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    total = sum(n for _, _, n in bins)
    head = head or head_size(total)
    v = Vocabulary.build(top or [(END, 0)], tails, total, sum(v for _, v, _ in bins), head, math.isqrt(head))
    net = Network(v, size)
    part = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("lm")), F.lit(rounds))
    for i in range(rounds):
        net.w = train_round(docs.where(part == i), net, text_col=text_col, rate=rate / (i + 1), lanes=lanes) or net.w
    return net, counts


def head_size(tokens: int) -> int:
    """Words that are predicted one by one: twice the cube root of the training tokens, and LEAST_HEAD at least."""
    return max(LEAST_HEAD, math.ceil(2 * tokens ** (1 / 3)))


def score(docs: DataFrame, net: Network, counts: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lanes: int = 256, steps: int = 64) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score): log10 probabilities of whole texts, by counts and by the network."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    schema = T.StructType(
        [T.StructField("rid", T.LongType()), docs.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("logs", T.DoubleType()), T.StructField("model", T.DoubleType())]
        + [T.StructField("words", T.ArrayType(T.StringType()))]
    )

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, net = to_arrow_schema(schema), sent.value
        reader = Reader(net.v)
        flow = Lanes(lanes, steps, reader.end)
        h = np.zeros((lanes, net.size), np.float32)
        held: dict[int, dict] = {}
        number = 0

        def window():
            nonlocal h
            h = flow.narrow(h)
            inputs, targets, fresh, live, doc = flow.window()
            states, h, _ = net.run(inputs, fresh, h)
            cells = np.flatnonzero(live)
            got, _ = net.log_probs(states.reshape(-1, net.size), targets.ravel(), cells)
            place = doc.ravel()[cells]
            first = int(place.min())
            sums, left = (np.bincount(place - first, weights=x) for x in (got.astype(np.float64), None))
            docs_here = np.flatnonzero(left)
            for d, s, k in zip(docs_here.tolist(), sums[docs_here].tolist(), left[docs_here].tolist(), strict=True):
                row = held[d + first]
                row["model"] += s / np.log(10)
                row["left"] -= k

        def done():
            rows = [held.pop(d) for d in [d for d, r in held.items() if not r["left"]]]
            words = [r["words"] for r in rows]
            ends = np.append(0, np.cumsum([len(w) for w in words])).astype(np.int32)
            flat = pa.concat_arrays([w.cast(pa.string()) for w in words]) if words else pa.array([], pa.string())
            return record_batch(arrow, {f.name: [r[f.name] for r in rows] for f in schema if f.name != "words"} | {"words": pa.ListArray.from_arrays(pa.array(ends), flat)})

        for b in text_slices(batches, text_col):
            for rid, doc_id, (tokens, logs, parts, n_known, unknown) in zip(b.column("rid").to_pylist(), b.column(id_col).to_pylist(), reader.read(b.column(text_col)), strict=True):
                held[number] = {"rid": rid, id_col: doc_id, "n_tokens": len(tokens), "known": n_known, "logs": logs, "model": parts, "words": unknown, "left": len(tokens)}
                flow.add(tokens, number)
                number += 1
            while len(flow.queue) >= WAITING:
                window()
            yield done()
        while flow.busy():
            window()
        yield done()

    rows = materialize(docs.select(F.monotonically_increasing_id().alias("rid"), id_col, text_col).mapInArrow(run, schema), "lm-rows")
    rare = rows.select("rid", F.explode("words").alias("word"))
    met = rare.join(counts, "word", "left").groupBy("rid").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_logs"), F.count_if(F.col("c") > 0).alias("rare_known"))
    both = rows.drop("words").join(met, "rid", "left")
    logs = F.coalesce("rare_logs", F.lit(0.0))
    size = float(np.log10(net.v.total + 0.5 * (net.v.distinct + 1)))
    return both.select(
        id_col,
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + logs - F.col("n_tokens") * size).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
