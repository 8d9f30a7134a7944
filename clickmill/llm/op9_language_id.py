"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word (up to STEPS bytes; a longer one in pieces) from both sides, labels
every byte position with a distribution over languages, and a document's probabilities are
the mean over all letter positions of its whole text. It is trained in numpy by
backpropagation through time. As states begin anew at white space, equal words get equal
labels, so a task runs the network once for each distinct word of a record batch.

Training reads a bounded sample: of labelled documents outside the held-out fold, about
DOCUMENTS for each language, drawn by hash. Tasks draw DRAWN words of each from all places of
its whole text (all words, if it has fewer); only these reach the driver.
The fold of a document is crc32(doc_id as text) mod 3; remainder 1 is held out.

 - A text that is missing or has no letter is `und` with score 0; so is everything if no
   labelled document exists. Only the text decides a prediction.
 - Rows are judged one by one; repeated ids keep a row each. A missing doc_id counts as the
   empty text for the fold. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, texts
from .op10_jaccard_join import LOWER
from .windows import SLICE_BYTES, mix, slices, word_bounds

HIDDEN, STEPS = 16, 20
DOCUMENTS, DRAWN = 400, 500
WORDS, BATCH, ROUNDS, RATE = 20_000, 512, 400, 0.01
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")

#: Bytes that are part of a letter: a-z, and those beyond ASCII.
LETTER = np.zeros(256, np.float32)
LETTER[97:123] = LETTER[128:] = 1


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, 30, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Direction:
    """A gated recurrent layer; words come longest first, so those still running are a prefix."""

    def __init__(self, rng: np.random.Generator):
        self.inputs = rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32)
        self.states = (rng.normal(0, 1, (HIDDEN, 3 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)

    def forward(self, data: np.ndarray, running: list[int], keep: list | None = None) -> list[np.ndarray]:
        state, out = np.zeros((running[0] if running else 0, HIDDEN), np.float32), []
        for t, n in enumerate(running):
            before = state[:n]
            given, own = self.inputs[data[:n, t]], before @ self.states
            gates = _sigmoid(given[:, :2 * HIDDEN] + own[:, :2 * HIDDEN])
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            proposal = np.tanh(given[:, 2 * HIDDEN:] + reset * own[:, 2 * HIDDEN:])
            state = before + update * (proposal - before)
            out.append(state)
            if keep is not None:
                keep.append((data[:n, t], before, update, reset, proposal, own[:, 2 * HIDDEN:]))
        return out

    def backward(self, kept: list, errors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the weights by backpropagation through time."""
        d_inputs, d_states = np.zeros_like(self.inputs), np.zeros_like(self.states)
        carried = np.zeros((0, HIDDEN), np.float32)
        for (data, before, update, reset, proposal, own), error in zip(reversed(kept), reversed(errors)):
            error = error.copy()
            error[:len(carried)] += carried
            d_proposal = error * update * (1 - proposal**2)
            d_reset = d_proposal * own * reset * (1 - reset)
            d_update = error * (proposal - before) * update * (1 - update)
            outer = np.concatenate([d_update, d_reset, d_proposal], 1)
            inner = np.concatenate([d_update, d_reset, d_proposal * reset], 1)
            np.add.at(d_inputs, data, outer)
            d_states += before.T @ inner
            carried = error * (1 - update) + inner @ self.states.T
        return d_inputs, d_states


class Network:
    """Both directions and the layer that labels each position."""

    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Direction(rng), Direction(rng)
        self.labels = rng.normal(0, 0.2, (2 * HIDDEN, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _read(self, data, mirror, sizes, keep=None):
        running = [int((sizes > t).sum()) for t in range(int(sizes[0]) if len(sizes) else 0)]
        kept = ([], []) if keep is not None else (None, None)
        ahead, back = self.ahead.forward(data, running, kept[0]), self.back.forward(mirror, running, kept[1])
        places = []
        for t, n in enumerate(running):
            # The state from the right at byte t of a word of `size` bytes is that of step size - 1 - t.
            step = sizes[:n] - 1 - t
            right = np.empty((n, HIDDEN), np.float32)
            for s in np.unique(step):
                rows = np.flatnonzero(step == s)
                right[rows] = back[s][rows]
            both = np.concatenate([ahead[t], right], 1)
            places.append((both, step, both @ self.labels + self.bias))
        if keep is not None:
            keep += kept
        return running, places

    def pooled(self, data: np.ndarray, mirror: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum over each word's letter positions of its label probabilities; words come longest first."""
        total = np.zeros((len(sizes), len(self.languages)), np.float32)
        running, places = self._read(data, mirror, sizes)
        for t, n in enumerate(running):
            p = np.exp(places[t][2] - places[t][2].max(1, keepdims=True))
            total[:n] += p / p.sum(1, keepdims=True) * LETTER[data[:n, t]][:, None]
        return total

    def fit(self, data: np.ndarray, sizes: np.ndarray, language: np.ndarray, rounds: int = ROUNDS, seed: int = 5) -> None:
        """Adam on the cross-entropy of every letter position."""
        rng = np.random.default_rng(seed)
        weights = [self.ahead.inputs, self.ahead.states, self.back.inputs, self.back.states, self.labels, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, rounds + 1):
            pick = rng.integers(0, len(sizes), BATCH)
            pick = pick[np.argsort(-sizes[pick], kind="stable")]
            x, size, truth = data[pick], sizes[pick], language[pick]
            keep: list = []
            running, places = self._read(x, mirrored(x, size), size, keep)
            errors_a, errors_b = [], [np.zeros((n, HIDDEN), np.float32) for n in running]
            d_labels, d_bias = np.zeros_like(self.labels), np.zeros_like(self.bias)
            count = max(1.0, float(sum(LETTER[x[:n, t]].sum() for t, n in enumerate(running))))
            for t, n in enumerate(running):
                both, place, scores = places[t]
                p = np.exp(scores - scores.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(n), truth[:n]] -= 1
                p *= LETTER[x[:n, t]][:, None] / count
                d_labels += both.T @ p
                d_bias += p.sum(0)
                d_both = p @ self.labels.T
                errors_a.append(d_both[:, :HIDDEN])
                for s in np.unique(place):
                    rows = np.flatnonzero(place == s)
                    errors_b[s][rows] += d_both[rows, HIDDEN:]
            slopes = [*self.ahead.backward(keep[0], errors_a), *self.back.backward(keep[1], errors_b), d_labels, d_bias]
            rate = RATE * (1 - step / (rounds + 1))
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def mirrored(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each row's first `size` bytes back to front."""
    at = sizes[:, None] - 1 - np.arange(data.shape[1])
    return np.where(at >= 0, np.take_along_axis(data, np.maximum(at, 0), 1), 0)


def word_rows(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of words of up to STEPS bytes as padded rows, and their sizes."""
    sizes = np.minimum(end - begin, STEPS)
    at = begin[:, None] + np.arange(STEPS)
    data = LOWER[buf[np.minimum(at, max(0, len(buf) - 1))]] if len(buf) else np.zeros((0, STEPS), np.uint8)
    return np.where(np.arange(STEPS) < sizes[:, None], data, 0).astype(np.uint8), sizes


def pieces(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of over STEPS bytes cut into pieces of STEPS."""
    n = -(-(end - begin) // STEPS)
    if (n <= 1).all():
        return begin, end
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(begin, n) + step * STEPS
    return start, np.minimum(start + STEPS, np.repeat(end, n))


def document_probabilities(network: Network, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label probabilities over the letter positions of each document; zeros where there is none."""
    data, sizes, keys, docs = [], [], [], []
    for i, j in slices(buf, offsets, SLICE_BYTES // 2):
        part = offsets[i:j + 1]
        own = buf[part[0]:part[-1]]
        begin, end = word_bounds(own, part - part[0])
        begin, end = pieces(begin, end)
        rows, size = word_rows(own, begin, end)
        key = np.concatenate([rows, size[:, None].astype(np.uint8), np.zeros((len(rows), 3), np.uint8)], 1).view(np.uint64)
        key = mix(key + np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)).sum(1)
        uniq, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        keys.append((uniq, inverse))
        data.append(rows[first])
        sizes.append(size[first])
        docs.append(i + np.searchsorted(part - part[0], begin, "right") - 1)
    total = np.zeros((len(offsets) - 1, len(network.languages)))
    letters = np.zeros(len(offsets) - 1)
    if not data:
        return total
    whole, first, where = np.unique(np.concatenate([k for k, _ in keys]), return_index=True, return_inverse=True)
    rows, size = np.concatenate(data)[first], np.concatenate(sizes)[first]
    order = np.argsort(-size, kind="stable")
    found = np.zeros((len(whole), len(network.languages)), np.float32)
    for at in range(0, len(order), 16_384):
        pick = order[at:at + 16_384]
        wide = int(size[pick[0]])
        x = rows[pick][:, :wide]
        found[pick] = network.pooled(x, mirrored(x, size[pick]), size[pick])
    count = (LETTER[rows]).sum(1)
    at = 0
    for (uniq, inverse), doc in zip(keys, docs):
        word = where[at:at + len(uniq)][inverse]
        at += len(uniq)
        letters += np.bincount(doc, count[word], len(letters))
        for c in range(total.shape[1]):
            total[:, c] += np.bincount(doc, found[word, c], len(letters))
    return total / np.maximum(letters, 1)[:, None]


def _fold():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3


def _drawn_words(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """DRAWN words of each text from all its places, in order; always the same ones of a text."""
    for batch in incoming:
        buf, offsets = texts(batch.column("text"))
        drawn = []
        for a, b in zip(offsets[:-1], offsets[1:]):
            begin, end = word_bounds(buf[a:b], np.array([0, b - a]))
            if len(begin) > DRAWN:
                pick = np.sort(np.random.default_rng(int(b - a)).choice(len(begin), DRAWN, replace=False))
                begin, end = begin[pick], end[pick]
            drawn.append(b" ".join(buf[a + x:a + y].tobytes() for x, y in zip(begin, end)).decode())
        yield pa.RecordBatch.from_arrays([batch.column("lang").cast(pa.string()), pa.array(drawn, pa.string())], ["lang", "text"])


def train(docs: DataFrame, fold: bool = True) -> Network | None:
    """A network from a bounded sample of labelled documents, without the held-out fold."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if fold:
        known = known.where(_fold() != 1)
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return None
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, DOCUMENTS / counts[lang]))])
    drawn = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000
    sample = known.where(drawn).select("lang", F.col("text").cast("string").alias("text")).mapInArrow(_drawn_words, "lang string, text string").collect()
    rng = np.random.default_rng(3)
    rows, sizes, truth = [], [], []
    for number, lang in enumerate(languages):
        text = "\n".join(sorted(r["text"] for r in sample if r["lang"] == lang)).encode()
        buf = np.frombuffer(text, np.uint8)
        begin, end = word_bounds(buf, np.array([0, len(buf)]))
        begin, end = pieces(begin, end)
        if len(begin):
            pick = rng.integers(0, len(begin), WORDS)
            data, size = word_rows(buf, begin[pick], end[pick])
            rows.append(data)
            sizes.append(size)
            truth.append(np.full(WORDS, number))
    network = Network(languages)
    if rows:
        network.fit(np.concatenate(rows), np.concatenate(sizes), np.concatenate(truth))
    return network


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """docs with lang_pred and score, which replace columns of these names."""
    docs = docs.drop("lang_pred", "score")
    held = docs.sparkSession.sparkContext.broadcast(network)

    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in incoming:
            lang, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if model is not None:
                buf, offsets = texts(batch.column("text"))
                p = document_probabilities(model, buf, offsets)
                best = p.argmax(1)
                for i in range(batch.num_rows):
                    part = buf[offsets[i]:offsets[i + 1]]
                    if p[i, best[i]] > 0 and (LETTER[LOWER[part[:4096]]] * (part[:4096] < 128)).any() or (
                            p[i, best[i]] > 0 and _LETTER.search(part.tobytes().decode())):
                        lang[i], score[i] = model.languages[best[i]], min(1.0, float(p[i, best[i]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{types}, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    network = train(docs)
    found = predict(docs.select("doc_id", F.col("text").cast("string").alias("text")), network)
    return found.select("doc_id", (_fold() == 1).alias("held_out"), "lang_pred", "score")


def keep_languages(docs: DataFrame, languages: list[str] | None = None, least: float = 0.3) -> DataFrame:
    """Documents in one of the languages (any learned one if None) whose score is `least` or more."""
    network = train(docs)
    found = predict(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text")), network)
    good = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
    if languages is not None:
        good &= F.col("lang_pred").isin(languages)
    return found.where(good).select("row.*")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
