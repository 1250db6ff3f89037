"""Language identification with a byte convolutional network (operator 1).

Texts become windows of WINDOW bytes of UTF-8, A-Z in lower case, the last one padded with zero bytes. Each byte
has a small vector; filters of widths 2 to 5 run over them, the largest response of each filter in a window is
kept, and a softmax layer turns these into probabilities. A text's probabilities are the means over all its
windows, weighted by their bytes, so every byte of a text counts. The network is trained in numpy on windows of
a bounded sample: at most `docs_per_language` documents of each of the MAX_LANGUAGES most frequent labels, and
WINDOWS_PER_DOC windows of each. The sample is chosen by a hash of doc_id, so a rerun learns the same weights.

Null text and text without a letter get `und` with score 0. Rows with null language or doc_id are not learned
from. Repeated rows are predicted each. Without any labelled text every row is `und`. An empty table gives an
empty result. Equal probabilities go to the language that is first in alphabetical order.

The network spreads its probabilities over the labels it knows, whatever it reads, so its score cannot tell a text
in none of them. keep_identified therefore asks of each window for a lead of the best label, and that its three-byte
sequences are those of the labelled sample; how many must be follows from the sample itself. Neither depends on the
number of labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, schema_with, slices, table
from videonet.llm.registry import query

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
BYTE_DIM = 8
DOCS_PER_LANGUAGE = 1000
WINDOWS_PER_DOC = 2
MAX_LANGUAGES = 256
EPOCHS = 5
BATCH_BYTES = 4 << 20
WINDOWS_AT_ONCE = 128
#: A window is told if its language leads all others together by a fifth (0.6 to 0.4), and if it looks like the sample.
LEAST_SURE = 0.6
#: A window looks like the sample if it has this part of what all but LEAST_ALIKE of the sample's own windows have.
LEAST_ALIKE = 0.01
PART_ALIKE = 0.85
#: Share of a text's bytes in windows that are told.
MIN_TOLD = 0.5
_REACH = max(WIDTHS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class ByteNet:
    languages: list[str]
    bytes_: np.ndarray  # 256 x BYTE_DIM
    filters: np.ndarray  # (_REACH * BYTE_DIM) x filters, zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray  # filters x languages
    out_bias: np.ndarray
    sequences: np.ndarray  # three-byte sequences of the sample, sorted
    least_known: float  # share of them that a window like the sample's has

    def known_shares(self, windows: np.ndarray) -> np.ndarray:
        """Share of each window's three-byte sequences that the sample has; zero for a window without any."""
        codes, used = _sequences(windows)
        places = np.minimum(np.searchsorted(self.sequences, codes), len(self.sequences) - 1)
        return ((self.sequences[places] == codes) & used).sum(axis=1) / np.maximum(1, used.sum(axis=1))

    def told(self, windows: np.ndarray, probabilities: np.ndarray) -> np.ndarray:
        """Whether the language of each window can be told."""
        return (probabilities.max(axis=1) >= LEAST_SURE) & (self.known_shares(windows) >= self.least_known)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each window, and the patches of byte vectors."""
        n = len(windows)
        vectors = self.bytes_[windows].reshape(n, -1)
        step = vectors.strides[1]
        patches = np.lib.stride_tricks.as_strided(
            vectors, (n, WINDOW, _REACH * BYTE_DIM), (vectors.strides[0], BYTE_DIM * step, step)
        )
        responses = patches.reshape(n * WINDOW, -1) @ self.filters
        return responses.reshape(n, WINDOW, -1), patches

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        found = []
        for first in range(0, len(windows), WINDOWS_AT_ONCE):
            responses, _ = self.pooled(windows[first:first + WINDOWS_AT_ONCE])
            found.append(_softmax(np.maximum(responses.max(axis=1) + self.bias, 0) @ self.out + self.out_bias))
        return np.concatenate(found)


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _sequences(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three-byte sequences of windows as numbers, and which of them have neither padding nor a digit."""
    data = windows[:, :WINDOW].astype(np.int32)
    plain = (data != 0) & ((data < 48) | (data > 57))
    codes = (data[:, :-2] << 16) | (data[:, 1:-1] << 8) | data[:, 2:]
    return codes, plain[:, :-2] & plain[:, 1:-1] & plain[:, 2:]


def _look(windows: np.ndarray) -> tuple[np.ndarray, float]:
    """Sequences that two windows have, and the share of them that windows like these have at least."""
    parts = [windows[first:first + 4096] for first in range(0, len(windows), 4096)]
    counts = np.zeros(1 << 24, np.int32)
    for part in parts:
        codes, used = _sequences(part)
        owners = np.broadcast_to(np.arange(len(codes))[:, None], codes.shape)
        pairs = np.unique(owners[used].astype(np.int64) << 24 | codes[used])
        found, many = np.unique(pairs & 0xFFFFFF, return_counts=True)
        counts[found] += many.astype(np.int32)
    shares = []
    for part in parts:
        codes, used = _sequences(part)
        # Each window is held against the others, as a new text is: two of them must have a sequence.
        held, many = ((counts[codes] > 2) & used).sum(axis=1), used.sum(axis=1)
        shares.append(held[many > 0] / many[many > 0])
    shares = np.concatenate(shares)
    if not len(shares):
        return np.zeros(1, np.int32), 1.0
    kept = np.flatnonzero(counts > 1) if (counts > 1).any() else np.flatnonzero(counts)
    return kept.astype(np.int32), PART_ALIKE * float(np.quantile(shares, LEAST_ALIKE))


def as_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, zero bytes after each, and the number of windows of each text."""
    counts = np.array([-(-len(text) // WINDOW) for text in texts], np.int64)
    flat = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    at = 0
    for text, count in zip(texts, counts.tolist()):
        flat[at:at + len(text)] = np.frombuffer(text, np.uint8)
        at += count * WINDOW
    windows = np.zeros((int(counts.sum()), WINDOW + _REACH - 1), np.uint8)
    windows[:, :WINDOW] = _LOWER[flat].reshape(-1, WINDOW)
    return windows, counts


def train(samples: list[bytes], labels: list[str], epochs: int = EPOCHS, seed: int = 0) -> ByteNet:
    """Fit the network by Adam on single windows; a third of them are shortened, as short texts are."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    target = np.array([languages.index(label) for label in labels])
    cut = [s[: rng.integers(8, WINDOW)] if rng.random() < 1 / 3 else s[:WINDOW] for s in samples]
    windows, _ = as_windows([s or b" " for s in cut])
    many = len(WIDTHS) * FILTERS
    mask = np.zeros((_REACH * BYTE_DIM, many), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * BYTE_DIM, i * FILTERS:(i + 1) * FILTERS] = 1
    net = ByteNet(
        languages,
        rng.normal(0, 0.5, (256, BYTE_DIM)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(many, np.float32),
        rng.normal(0, 0.1, (many, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
        *_look(as_windows([s[:WINDOW] or b" " for s in samples])[0]),
    )
    weights = [net.bytes_, net.filters, net.bias, net.out, net.out_bias]
    means = [np.zeros_like(w) for w in weights]
    squares = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for first in range(0, len(order), WINDOWS_AT_ONCE):
            chosen = order[first:first + WINDOWS_AT_ONCE]
            x, n = windows[chosen], len(chosen)
            responses, patches = net.pooled(x)
            places = responses.argmax(axis=1)
            raw = np.take_along_axis(responses, places[:, None, :], axis=1)[:, 0] + net.bias
            hidden = np.maximum(raw, 0)
            error = _softmax(hidden @ net.out + net.out_bias)
            error[np.arange(n), target[chosen]] -= 1
            error /= n
            back = (error @ net.out.T) * (raw > 0)
            best = patches[np.arange(n)[:, None], places]
            grad_filters = np.einsum("nfk,nf->kf", best, back) * mask
            grad_patches = (back[:, :, None] * net.filters.T[None]).reshape(-1, BYTE_DIM)
            seen = x[np.arange(n)[:, None, None], places[:, :, None] + np.arange(_REACH)].ravel()
            grad_bytes = np.zeros_like(net.bytes_)
            for d in range(BYTE_DIM):
                grad_bytes[:, d] = np.bincount(seen, grad_patches[:, d], 256)
            grads = [grad_bytes, grad_filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for weight, grad, mean, square in zip(weights, grads, means, squares):
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                weight -= (rate * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> ByteNet | None:
    """Train on the sample described above; rows whose crc32(doc_id) leaves 2 modulo 4 are never used."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & ~held_out() & F.col("doc_id").isNotNull()
    )
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not sizes:
        return None
    million = 1_000_000
    # A fifth more than wanted on average, so that chance leaves few languages short; the limit is firm.
    share = F.create_map(*[
        F.lit(part) for row in sizes
        for part in (row["lang"], min(million, docs_per_language * million * 6 // (5 * row["count"]) + 1))
    ])
    place = F.xxhash64("doc_id", F.lit(1))
    utf8 = F.encode("text", "UTF-8")
    size = F.octet_length("text")
    pieces = F.array(*[
        F.substring(utf8, F.pmod(F.xxhash64("doc_id", F.lit(k + 2)), F.greatest(size - WINDOW + 1, F.lit(1)))
                    .cast("int") + 1, F.lit(WINDOW))
        for k in range(WINDOWS_PER_DOC)
    ])
    sample = (
        known.filter(F.pmod(place, F.lit(million)) < F.element_at(share, F.col("lang")))
        .select(place.alias("place"), "doc_id", "lang", pieces.alias("pieces"))
        .orderBy("place", "doc_id", "lang")
        .limit(len(sizes) * docs_per_language * 3 // 2)
        .collect()
    )
    pairs = [(bytes(piece), row["lang"]) for row in sample for piece in row["pieces"]]
    return train([p for p, _ in pairs], [lang for _, lang in pairs])


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def predict(docs: DataFrame, net: ByteNet | None, text: str = "text",
            names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The rows of `docs` with the predicted language and its probability; columns of these names are replaced.

    A third name adds the share of the text's bytes that lie in windows whose language can be told.
    """
    rest = docs.drop(*names)
    lettered = rest.withColumn("__lettered", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    schema = schema_with(rest, (names[0], "string"), *((name, "double") for name in names[1:]))

    def work(batches):
        for batch in slices(batches, text, BATCH_BYTES):
            at = batch.schema.get_field_index(text)
            use = batch.column(batch.num_columns - 1).to_pylist()
            texts = [t.encode() if ok else b"" for t, ok in zip(batch.column(at).to_pylist(), use)]
            langs, scores, told = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            windows, counts = as_windows(texts)
            if net is not None and len(windows):
                sizes = np.full(len(windows), WINDOW, np.float64)
                ends = np.cumsum(counts)
                rows = np.flatnonzero(counts)
                sizes[ends[rows] - 1] = [(len(texts[r]) - 1) % WINDOW + 1 for r in rows]
                found = net.probabilities(windows).astype(np.float64)
                sums = np.add.reduceat(found * sizes[:, None], (ends - counts)[rows], axis=0)
                if len(names) > 2:
                    for first in range(0, len(windows), WINDOWS_AT_ONCE):
                        part = slice(first, first + WINDOWS_AT_ONCE)
                        sizes[part] *= net.told(windows[part], found[part])
                    for row, total in zip(rows.tolist(), np.add.reduceat(sizes, (ends - counts)[rows])):
                        told[row] = float(total / len(texts[row]))
                for row, total in zip(rows.tolist(), sums):
                    best = int(total.argmax())
                    langs[row] = net.languages[best]
                    scores[row] = float(min(1.0, total[best] / len(texts[row])))
            more = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(told, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *more[:len(names)]],
                names=[*batch.schema.names[:-1], *names],
            )

    return arrow_map(lettered, work, schema)


def keep_identified(docs: DataFrame, min_told: float = MIN_TOLD) -> DataFrame:
    """The documents of which the network, trained on their own labels, can tell the language of `min_told` or more."""
    found = predict(docs, fit(docs), names=("__lang_pred", "__score", "__told"))
    return found.filter((F.col("__lang_pred") != "und") & (F.col("__told") >= min_told)).select(
        *[F.col(f"`{name}`") for name in docs.columns]
    )


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
