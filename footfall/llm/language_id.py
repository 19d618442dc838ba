"""Language of a text by a bidirectional gated recurrent network over its bytes.

A text is cut into windows of bytes. Two recurrent layers read each window, one forwards, one backwards; at every byte their
states together give a probability for each language. The probabilities of all bytes of a document are pooled.
The network is small and trained here, in numpy, by backpropagation through time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HIDDEN = 8
WINDOW = 96
UNDETERMINED = "und"
#: The network is fitted to at most so many documents of each language, and so many windows from each.
SAMPLE_PER_LANGUAGE = 400
WINDOWS_PER_DOCUMENT = 4
EPOCHS = 6
BATCH = 256
RATE = 0.02
#: Windows read side by side; bounds a task's memory.
AT_ONCE = 4096

#: What may be a letter; fractions, circled digits and the like are none and are told apart by their category.
_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place: a logistic curve by way of tanh."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


@dataclass
class Layer:
    """One direction: per byte the inputs of both gates and of the candidate, and what the state adds."""

    inputs: np.ndarray  # (257, 3h); row 256 is padding
    gates: np.ndarray  # (h, 2h)
    candidate: np.ndarray  # (h, h)

    @classmethod
    def fresh(cls, hidden: int, random: np.random.Generator) -> Layer:
        scale = 1 / np.sqrt(hidden)
        draw = lambda *shape: random.uniform(-scale, scale, shape).astype(np.float32)
        return cls(draw(257, 3 * hidden), draw(hidden, 2 * hidden), draw(hidden, hidden))

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.gates, self.candidate]

    def read(self, steps: np.ndarray) -> np.ndarray:
        """States (time, windows, h) after each byte of `steps` (time, windows)."""
        hidden = len(self.candidate)
        two = 2 * hidden
        states = np.zeros((len(steps) + 1, steps.shape[1], hidden), np.float32)
        given = np.empty((steps.shape[1], 3 * hidden), np.float32)
        for t, column in enumerate(steps):
            state, after = states[t], states[t + 1]
            np.take(self.inputs, column, axis=0, out=given, mode="clip")
            gate = given[:, :two]
            gate += state @ self.gates
            gate = _sigmoid(np.ascontiguousarray(gate))
            new = (gate[:, :hidden] * state) @ self.candidate
            new += given[:, two:]
            np.tanh(new, out=new)
            np.subtract(state, new, out=after)
            after *= gate[:, hidden:]
            after += new
        return states[1:]

    def back(self, steps: np.ndarray, states: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """Gradients of the arrays; `wanted` is the gradient by the states."""
        hidden = len(self.candidate)
        two = 2 * hidden
        slopes = [np.zeros_like(a) for a in self.arrays()]
        later = np.zeros_like(states[0])
        none = np.zeros_like(states[0])
        for t in range(len(steps) - 1, -1, -1):
            state = states[t - 1] if t else none
            given = self.inputs[steps[t]]
            gate = _sigmoid(given[:, :two] + state @ self.gates)
            reset, keep = gate[:, :hidden], gate[:, hidden:]
            lowered = reset * state
            new = np.tanh(given[:, two:] + lowered @ self.candidate)
            slope = wanted[t] + later
            by_new = slope * (1 - keep) * (1 - new * new)
            by_keep = slope * (state - new) * keep * (1 - keep)
            by_lowered = by_new @ self.candidate.T
            by_reset = by_lowered * state * reset * (1 - reset)
            by_gate = np.concatenate([by_reset, by_keep], axis=1)
            later = slope * keep + by_lowered * reset + by_gate @ self.gates.T
            np.add.at(slopes[0], steps[t], np.concatenate([by_gate, by_new], axis=1))
            slopes[1] += state.T @ by_gate
            slopes[2] += lowered.T @ by_new
        return slopes


@dataclass
class Model:
    """Both layers, what turns their states into languages, and the languages."""

    languages: list[str]
    forward: Layer
    backward: Layer
    out: np.ndarray  # (2h + 1, languages); the last row is the bias

    def arrays(self) -> list[np.ndarray]:
        return [*self.forward.arrays(), *self.backward.arrays(), self.out]

    def states(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = np.ascontiguousarray(windows.T)
        return self.forward.read(steps), self.backward.read(steps[::-1])[::-1]

    def positions(self, windows: np.ndarray) -> np.ndarray:
        """Probability of each language at each byte: (time, windows, languages)."""
        ahead, behind = self.states(windows)
        hidden = ahead.shape[2]
        scores = ahead @ self.out[:hidden]
        scores += behind @ self.out[hidden:-1]
        scores += self.out[-1]
        np.exp(np.clip(scores, -30, 30, out=scores), out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        return scores


def windows_of(data: bytes) -> np.ndarray:
    """The bytes as rows of WINDOW, padded with 256 at the end."""
    rows = -(-len(data) // WINDOW)
    padded = np.full(rows * WINDOW, 256, np.int64)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return padded.reshape(rows, WINDOW)


def train(texts: list[tuple[str, str]], seed: int = 7) -> Model:
    """A model of the languages in `texts` (language, text), the same for the same texts in the same order."""
    random = np.random.default_rng(seed)
    languages = sorted({language for language, _ in texts})
    hidden = HIDDEN
    model = Model(
        languages,
        Layer.fresh(hidden, random),
        Layer.fresh(hidden, random),
        random.uniform(-0.1, 0.1, (2 * hidden + 1, len(languages))).astype(np.float32),
    )
    rows, wanted = [], []
    for language, text in texts:
        rows_of = windows_of(text.encode())
        if len(rows_of) > WINDOWS_PER_DOCUMENT:
            rows_of = rows_of[random.choice(len(rows_of), WINDOWS_PER_DOCUMENT, replace=False)]
        rows.append(rows_of)
        wanted += [languages.index(language)] * len(rows_of)
    if not wanted:
        return model
    windows, targets = np.concatenate(rows), np.array(wanted)
    # Each language weighs the same, whatever its share of the sample.
    weights = (len(targets) / len(languages) / np.bincount(targets, minlength=len(languages)))[targets].astype(np.float32)
    means = [np.zeros_like(a) for a in model.arrays()]
    squares = [np.zeros_like(a) for a in model.arrays()]
    step = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            slopes = _slopes(model, windows[batch], targets[batch], weights[batch])
            step += 1
            size = np.sqrt(sum(float((s * s).sum()) for s in slopes))
            for array, slope, mean, square in zip(model.arrays(), slopes, means, squares, strict=True):
                slope *= min(1.0, 1 / (size + 1e-9))
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                rate = RATE * 0.5 ** (epoch // 2)
                array -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return model


def _slopes(model: Model, windows: np.ndarray, targets: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy over all bytes of the windows."""
    steps = np.ascontiguousarray(windows.T)
    ahead, behind = model.states(windows)
    hidden = ahead.shape[2]
    both = np.concatenate([ahead, behind, np.ones((*steps.shape, 1), np.float32)], axis=2)
    scores = both @ model.out
    scores -= scores.max(axis=2, keepdims=True)
    chances = np.exp(scores)
    chances /= chances.sum(axis=2, keepdims=True)
    real = (steps < 256) * weights
    error = chances
    error[:, np.arange(len(targets)), targets] -= 1
    error *= (real / max(1.0, float(real.sum())))[:, :, None]
    error = error.astype(np.float32)
    by_out = np.tensordot(both, error, axes=([0, 1], [0, 1]))
    by_both = error @ model.out.T
    by_forward = model.forward.back(steps, ahead, by_both[:, :, :hidden])
    by_backward = model.backward.back(steps[::-1], behind[::-1], by_both[::-1, :, hidden:-1])
    return [*by_forward, *by_backward, by_out]


def has_letter(text: str | None) -> bool:
    """Whether any character is of the Unicode category of letters."""
    return any(found[0].isalpha() for found in _LETTER.finditer(text or ""))


def pooled(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the mean probability over all its bytes."""
    languages = len(model.languages)
    data = [(text or "").encode("utf-8", "replace") for text in texts]
    sums = np.zeros((len(data), languages))
    pending: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if held:
            windows, owner = np.concatenate(pending), np.concatenate(owners)
            for at in range(0, len(windows), AT_ONCE):
                part = windows[at : at + AT_ONCE]
                real = (part < 256).T[:, :, None]
                np.add.at(sums, owner[at : at + AT_ONCE], np.where(real, model.positions(part), 0).sum(axis=0))
        pending.clear()
        owners.clear()
        held = 0

    for i, each in enumerate(data):
        rows = windows_of(each)
        pending.append(rows)
        owners.append(np.full(len(rows), i))
        held += len(rows)
        if held >= AT_ONCE:
            flush()
    flush()
    lengths = np.array([max(1, len(each)) for each in data])
    chances = sums / lengths[:, None]
    known = [languages > 0 and has_letter(text) for text in texts]
    best = chances.argmax(axis=1) if languages else np.zeros(len(data), int)
    labels = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
    scores = np.where(known, chances[np.arange(len(data)), best], 0.0) if languages else np.zeros(len(data))
    return labels, np.clip(scores, 0.0, 1.0)


def sampled(labelled: DataFrame) -> list[tuple[str, str]]:
    """A bounded sample of (lang, text), the same however the rows are spread: per language those of least hash.

    Of a text only WINDOWS_PER_DOCUMENT stretches, spread over its whole length, are brought to the driver.
    """
    step = F.greatest(F.lit(WINDOW), F.floor(F.length("text") / WINDOWS_PER_DOCUMENT)).cast("int")
    stretches = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOCUMENT - 1)), lambda i: F.substring("text", i * step + 1, F.lit(WINDOW)))
    # Only the stretches are moved, and of each task's rows only those that may be among the least.
    cut = labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("by_id"), F.xxhash64("text").alias("by_text"), stretches.alias("stretches"))
    order = Window.partitionBy("lang").orderBy("by_id", "doc_id", "by_text")
    chosen = cut.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= SAMPLE_PER_LANGUAGE)
    rows = chosen.select("lang", "n", F.explode("stretches").alias("text")).filter("text <> ''").orderBy("lang", "n", "text").collect()
    return [(row["lang"], row["text"]) for row in rows]


def predicted(
    rows: DataFrame,
    training: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    labelled: DataFrame | None = None,
) -> DataFrame:
    """Per row: doc_id, lang_pred, score (0 to 1), and whether the text has a letter.

    The model is fitted to a bounded sample of rows of `labelled` (default: `rows`) that meet `training` and have a language and a
    text. Only the text is an input of a prediction; all of it is read. Texts that are null or hold no letter are `und`,
    score 0, and so is every text where nothing can be learned. Ties go to the language first by name.
    """
    columns = [F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")]
    source = rows if labelled is None else labelled
    known = source if training is None else source.filter(training)
    known = known.select(*columns, F.col(language_column).cast("string").alias("lang")).filter("lang IS NOT NULL AND text <> ''")
    model = train(sampled(known))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                labels, scores = pooled(model, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(labels, pa.string()), pa.array(scores), pa.array(map(has_letter, part.column(1).to_pylist()), pa.bool_())],
                    names=["doc_id", "lang_pred", "score", "letters"],
                )

    return rows.select(*columns).mapInArrow(predict, "doc_id long, lang_pred string, score double, letters boolean")
