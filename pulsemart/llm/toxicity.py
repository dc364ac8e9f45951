"""Toxicity scores of whole texts by a bidirectional gated recurrent network over overlapping windows.

The network (:mod:`pulsemart.llm.gated`) is trained in one task on a bounded sample of labelled documents.  Labels are of
documents, not windows: in each round, the network as it is picks the windows that speak most for each document, and is
trained on these; clean documents also give a window at random.  The first round picks by the words' own weight of
evidence, which is also where their vectors start.  A text's score is the highest of all its windows.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import stage, text_of
from pulsemart.llm.gated import CHARACTERS, WORD_DIM, Adam, Network, Params, new_params, squash
from pulsemart.llm.words import parts

#: Words of a window and between the starts of two; letters of a word (longer runs of letters are several words).
WINDOW, STRIDE, LETTERS = 32, 16, 24
#: The training sample: documents of each label at most, and characters that a sampled document has at most.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 3000, 50_000
#: Words with a vector of their own, at most; documents of the sample that such a word is in, at least.
VOCABULARY, WORD_DOCUMENTS = 20_000, 2
#: Training: rounds of choosing windows, steps of a round, windows of a step, and empty windows added to each.
ROUNDS, STEPS, BATCH, BLANKS = 3, 100, 128, 4
SLICE_BYTES, WINDOWS_AT_ONCE, WORDS_AT_ONCE = 2_000_000, 1024, 2048


class Tokens:
    """Words of texts: runs of letters, lower-cased; all else separates them.

    ``distinct`` words, their numbers ``codes`` in all texts in a row, and where each text's ``starts``, with the end.
    """

    def __init__(self, texts: pa.Array) -> None:
        small = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), r"[^\pL\pM]+", " ")
        coded, self.starts = self._split(small)
        if len(coded.dictionary) and pc.max(pc.utf8_length(coded.dictionary)).as_py() > LETTERS:
            coded, self.starts = self._split(pc.replace_substring_regex(small, rf"([\pL\pM]{{{LETTERS}}})", r"\1 "))
        self.distinct = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    @staticmethod
    def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        split = pc.split_pattern(pc.utf8_trim(texts, " "), " ")
        flat = split.flatten()
        starts = np.asarray(split.offsets).astype(np.int64) - split.offsets[0].as_py()
        real = np.asarray(pc.binary_length(flat)) > 0
        if not real.all():  # texts without words, and cuts at the end of a run
            starts = np.concatenate([[0], np.cumsum(real)])[starts]
            flat = flat.filter(pa.array(real))
        return flat.dictionary_encode(), starts

    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each distinct word's letters (a row per word), and how many."""
        sizes = np.asarray(pc.utf8_length(self.distinct)).astype(np.int64)
        letters = np.frombuffer("".join(self.distinct.to_pylist()).encode("utf-32-le"), "<u4") % CHARACTERS
        grid = np.zeros((len(sizes), LETTERS), np.int64)
        grid[np.arange(LETTERS)[None, :] < sizes[:, None]] = letters
        return grid, sizes

    def known(self, vocabulary: pa.Array) -> np.ndarray:
        """Each distinct word's row among the vectors; 0 for unknown ones."""
        found = pc.index_in(self.distinct, value_set=vocabulary)
        return np.asarray(pc.add(found, 1).fill_null(0)).astype(np.int64)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word and size of all windows, which overlap and cover every word; a text without words has none."""
        counts = np.diff(self.starts)
        per = np.where(counts > 0, np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + 1, 0)
        text = np.repeat(np.arange(len(counts)), per)
        number = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
        first = self.starts[text] + STRIDE * number
        return text, first, np.minimum(self.starts[text + 1] - first, WINDOW)

    def rows(self, first: np.ndarray) -> np.ndarray:
        """The word numbers of windows; places beyond a window's size hold anything."""
        at = first[:, None] + np.arange(WINDOW)[None, :]
        return self.codes[np.minimum(at, len(self.codes) - 1)]


def window_scores(network: Network, vocabulary: pa.Array, tokens: Tokens, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Probabilities of windows; words and windows pass in bounded groups, words of similar length together."""
    if not len(first):
        return np.zeros(0, np.float32)
    spelled, letters = tokens.spelled()
    known = tokens.known(vocabulary)
    order = np.argsort(letters, kind="stable")
    gates = None
    for at in range(0, len(order), WORDS_AT_ONCE):
        own = order[at:at + WORDS_AT_ONCE]
        found = network.word_gates(spelled[own, :letters[own].max()], letters[own], known[own])
        gates = np.empty((2, len(order), found.shape[2]), np.float32) if gates is None else gates
        gates[:, own] = found
    out = np.empty(len(first), np.float32)
    for at in range(0, len(first), WINDOWS_AT_ONCE):
        part = slice(at, at + WINDOWS_AT_ONCE)
        out[part] = network.windows(gates, tokens.rows(first[part]), sizes[part])
    return out


def _evidence(tokens: Tokens, labels: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words that several documents have, and the logarithm of how much likelier toxic ones have them."""
    counts = np.diff(tokens.starts)
    seen = np.unique(np.repeat(np.arange(len(counts)), counts) * len(tokens.distinct) + tokens.codes)
    text, word = np.divmod(seen, max(1, len(tokens.distinct)))
    toxic = np.bincount(word[labels[text] == 1], minlength=len(tokens.distinct))
    clean = np.bincount(word[labels[text] == 0], minlength=len(tokens.distinct))
    kept = np.flatnonzero(toxic + clean >= WORD_DOCUMENTS)
    weight = np.log((toxic[kept] + 0.5) / (labels.sum() + 1)) - np.log((clean[kept] + 0.5) / ((1 - labels).sum() + 1))
    # words that tell most, weighed by how often they can
    best = np.sort(np.argsort(-np.abs(weight) * np.sqrt(toxic[kept] + clean[kept]), kind="stable")[:VOCABULARY])
    return tokens.distinct.take(pa.array(kept[best])), weight[best].astype(np.float32)


def train(texts: pa.Array, labels: np.ndarray, steps: int = STEPS, seed: int = 0) -> tuple[Params, pa.Array]:
    """Network and vocabulary from whole labelled texts (label 0 or 1)."""
    rng = np.random.default_rng(seed)
    tokens = Tokens(texts)
    vocabulary, evidence = _evidence(tokens, labels)
    vectors = rng.normal(0, 0.1, (len(vocabulary) + 1, WORD_DIM))
    vectors[0] = 0
    vectors[1:, 0] = np.clip(evidence, -4, 6) / 3
    network = Network(new_params(vectors, seed))
    adam = Adam(network.params)
    text, first, sizes = tokens.windows()
    if not len(text):
        return network.params, vocabulary
    spelled, letters = tokens.spelled()
    known = tokens.known(vocabulary)
    weights = np.concatenate([[0], evidence])[known][tokens.codes]
    spread = np.concatenate([[0], np.cumsum(np.maximum(weights, 0))])
    scores = spread[first + sizes] - spread[first]
    for k in range(ROUNDS):
        chosen = _chosen(text, scores, labels, rng, k)
        for _ in range(steps):
            own = rng.choice(chosen, min(BATCH, len(chosen)), replace=False)
            # windows without words are clean: what texts without letters get
            codes = np.concatenate([tokens.rows(first[own]), np.zeros((BLANKS, WINDOW), np.int64)])
            used, codes = np.unique(codes, return_inverse=True)
            grads = network.learn(
                spelled[used, :letters[used].max()], letters[used], known[used], codes.reshape(-1, WINDOW),
                np.append(sizes[own], np.zeros(BLANKS, np.int64)), np.append(labels[text[own]], np.zeros(BLANKS, np.int64)),
            )
            grads["words"][0] = 0  # unknown words are told by their letters
            adam.step(grads)
        adam.rate *= 0.5
        if k + 1 < ROUNDS:
            scores = window_scores(network, vocabulary, tokens, first, sizes)
    return network.params, vocabulary


def _chosen(text: np.ndarray, scores: np.ndarray, labels: np.ndarray, rng: np.random.Generator, number: int) -> np.ndarray:
    """Windows to learn from: each document's highest, more of a toxic one's that are found already, one more of each clean one."""
    order = np.lexsort((-scores, text))
    rank = np.arange(len(order)) - np.searchsorted(text, text[order])
    toxic = labels[text[order]] == 1
    sure = (scores[order] > 0.5) & (number > 0)
    top = order[(rank == 0) | (toxic & sure & (rank < 3))]
    drawn = rng.permutation(np.flatnonzero(labels[text] == 0))
    drawn = drawn[np.unique(text[drawn], return_index=True)[1]]
    return np.union1d(top, drawn)


def _saved(params: Params, vocabulary: pa.Array) -> bytes:
    out = io.BytesIO()
    np.savez(out, vocabulary=np.frombuffer("\n".join(vocabulary.to_pylist()).encode(), np.uint8), **params)
    return out.getvalue()


def _loaded(model: bytes) -> tuple[Network, pa.Array]:
    held = dict(np.load(io.BytesIO(model)))
    words = held.pop("vocabulary").tobytes().decode()
    return Network(held), pa.array(words.split("\n") if words else [], pa.large_string())


def fit(docs: DataFrame, labels: DataFrame, steps: int = STEPS) -> bytes:
    """A trained model from labelled documents (``doc_id, text`` and ``doc_id, toxic``).

    The sample has at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents of at most ``SAMPLE_CHARS`` characters, chosen
    by a hash of their id; of rows with one id, one text, and toxic if any label says so.  Missing ids, labels and texts
    are left out.  Without a label of each kind the model gives the share of toxic ones (0.5 without any) to all texts.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic")
    )
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(f"length(text) between 1 and {SAMPLE_CHARS}")
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = marked.where("toxic = 1").orderBy(*by_hash).limit(SAMPLE_TOXIC).unionByName(
        marked.where("toxic = 0").orderBy(*by_hash).limit(SAMPLE_CLEAN)
    )
    sample = stage(own.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), pa.schema([("toxic", pa.int32()), ("text", pa.string())])).combine_chunks()
        marks = rows["toxic"].to_numpy().astype(np.int64)
        if 0 < marks.sum() < len(marks):
            model = _saved(*train(rows["text"].combine_chunks(), marks, steps))
        else:
            model = _constant((marks.sum() + 0.5) / (len(marks) + 1))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    one = sample.orderBy(*by_hash).coalesce(1).select("toxic", "text")
    found = one.mapInArrow(run, "model binary").first()
    return bytes(found[0]) if found else _constant(0.5)


def _constant(share: float) -> bytes:
    """A model that gives the same score to all texts."""
    params = new_params(np.zeros((1, WORD_DIM)))
    params["out"][:] = 0
    params["out_bias"][:] = np.log(share / (1 - share))
    return _saved(params, pa.array([], pa.large_string()))


def score(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, score, predicted`` of whole texts.

    A text without letters (missing, empty, only marks) has the score of an empty window.  Rows with equal ids are texts
    of their own; equal texts have equal scores up to rounding; other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, vocabulary = _loaded(model)
        blank = float(squash(network.params["out_bias"])[0])
        for batch in batches:
            for part in parts(batch, "text", SLICE_BYTES):
                tokens = Tokens(part.column(1))
                text, first, sizes = tokens.windows()
                best = np.full(part.num_rows, -1.0)
                np.maximum.at(best, text, window_scores(network, vocabulary, tokens, first, sizes))
                best = np.where(best < 0, blank, best)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(best), pa.array((best >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, score double, predicted int"
    )
