"""Language ID by segmentation-marginalised unigrams (operator 4).

Each language has a probability per piece of a fixed public vocabulary. A word's
likelihood is the sum over all its segmentations into pieces, by the forward
algorithm; a text's is the product over its words, as no piece spans a space. The
score is the posterior of the best language under equal priors.

The probabilities are fitted by expectation maximisation: each round runs forward
and backward over the word counts of the training sample, in Spark tasks, and sums
expected piece counts per language. The sample is bounded: about ``per_language``
whole texts of each language, chosen by a hash of the id.

Defined results: null texts and texts without a letter are ``und`` with score 0, as
is everything if nothing could be learned. Ties go to the first language by name.
Characters outside the vocabulary count as their UTF-8 byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tracewright.llm.common import chunks, fold, hold, id_and_text, record_batch, share
from tracewright.llm.pieces import MODEL, SPACE, Vocabulary
from tracewright.session import map_in_arrow

UNDETERMINED = "und"
ROUNDS = 3
PER_LANGUAGE = 300
#: Added to each expected piece count.
SMOOTHING = 0.05
#: Words whose likelihoods a worker keeps at most.
KEPT = 300_000
#: Words in one lattice.
TOGETHER = 20_000
#: Longer words are summed with rescaling, as their likelihood underflows.
PLAIN = 30
_LETTER = regex.compile(r"\p{L}")
#: Bytes that divide words; `str.split` would also divide at no-break spaces.
_SPACES = " \t\n\v\f\r"


class Trie:
    """The pieces of a vocabulary by their characters, as arrays for numpy."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        children: dict[int, int] = {}
        piece_at = [-1]
        for piece, number in vocabulary.ids.items():
            node = 0
            for character in piece:
                key = node << 21 | ord(character)
                if key not in children:
                    children[key] = len(piece_at)
                    piece_at.append(-1)
                node = children[key]
            piece_at[node] = number
        self.pieces = np.array(piece_at, np.int32)
        keys = np.fromiter(children, np.int64, len(children))
        self.mask = (1 << (4 * len(keys)).bit_length()) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.nodes = np.zeros(self.mask + 1, np.int32)
        self.probes = 0
        targets = np.fromiter(children.values(), np.int64, len(children))
        while len(keys):
            slots = self._slots(keys, self.probes)
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several for one slot the last stays
            stored = self.keys[slots] == keys
            self.nodes[slots[stored]] = targets[stored]
            keys, targets = keys[~stored], targets[~stored]
            self.probes += 1
        self.byte_ids = np.array(vocabulary.byte_ids)
        self.longest = max(map(len, vocabulary.ids))

    def _slots(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(36)).astype(np.int64) + probe) & self.mask

    def child(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node after ``codes``, or -1."""
        keys = nodes.astype(np.int64) << 21 | codes
        found = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            slots = self._slots(keys[open_], probe)
            held = self.keys[slots]
            hit = held == keys[open_]
            found[open_[hit]] = self.nodes[slots[hit]]
            open_ = open_[~hit & (held != -1)]
            if not len(open_):
                break
        return found


class Lattice:
    """All pieces inside each of some words, with their weights.

    A word is read as ``SPACE + word``; its states, one more than its characters,
    follow those of the word before. An edge is a piece between two states. A
    character that is no piece gets one edge with the weight of its byte pieces.
    """

    def __init__(self, trie: Trie, words: list[str]) -> None:
        text = "".join(SPACE + w for w in words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes)
        self.first = ends - sizes + np.arange(len(words))
        self.last = self.first + sizes
        self.states = len(codes) + len(words)
        word = np.repeat(np.arange(len(words)), sizes)
        within = np.arange(len(codes)) - np.repeat(ends - sizes, sizes)
        end = np.repeat(ends, sizes)
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int32)
        found, reach = [], 0
        while len(at):
            inside = at + reach < end[at]
            at, node = at[inside], node[inside]
            node = trie.child(node, codes[at + reach])
            on = node >= 0
            at, node = at[on], node[on]
            reach += 1
            piece = trie.pieces[node]
            hit = piece >= 0
            found.append((at[hit], np.full(hit.sum(), reach), piece[hit]))
        single = np.zeros(len(codes), bool)
        if found:
            single[found[0][0]] = True
        self.unknown = np.flatnonzero(~single)
        raws = [text[n].encode("utf-8", "surrogatepass") for n in self.unknown.tolist()]
        self.unknown_bytes = [trie.byte_ids[list(raw)] for raw in raws]
        found.append((self.unknown, np.ones(len(raws), np.int64), -1 - np.arange(len(raws))))
        at, size, self.piece = (np.concatenate(c) for c in zip(*found))
        step = within[at] * (trie.longest + 1) + size
        order = np.argsort(step, kind="stable")
        self.piece, self.word = self.piece[order], word[at[order]]
        self.source = at[order] + word[at[order]]
        self.target = self.source + size[order]
        step = step[order]
        # In one step all edges leave the same place in their word, over one length.
        cuts = np.flatnonzero(np.diff(step)) + 1
        self.steps = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(step)])) if len(step) else []

    def weights(self, table: np.ndarray, language: np.ndarray | None = None) -> np.ndarray:
        """Of each edge: a row of ``table``, or its cell in the word's language."""
        known = np.maximum(self.piece, 0)
        column = None if language is None else language[self.word]
        found = table[known] if column is None else table[known, column]
        for edge in np.flatnonzero(self.piece < 0).tolist():
            product = table[self.unknown_bytes[-1 - self.piece[edge]]].prod(0)
            found[edge] = product if column is None else product[column[edge]]
        return found

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Summed weight of all ways from a word's first state to each state."""
        sums = np.zeros((self.states, *weights.shape[1:]))
        sums[self.first] = 1.0
        for low, high in self.steps:
            sums[self.target[low:high]] += sums[self.source[low:high]] * weights[low:high]
        return sums

    def backward(self, weights: np.ndarray) -> np.ndarray:
        sums = np.zeros((self.states, *weights.shape[1:]))
        sums[self.last] = 1.0
        for low, high in reversed(self.steps):
            sums[self.source[low:high]] += sums[self.target[low:high]] * weights[low:high]
        return sums

    def log_likelihood(self, table: np.ndarray) -> np.ndarray:
        """Per word and language, the log of the summed weight of all segmentations."""
        with np.errstate(divide="ignore"):
            return np.log(self.forward(self.weights(table))[self.last])

    def expected(self, table: np.ndarray, language: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """Expected uses of each piece and language; words have one language each."""
        weights = self.weights(table, language)
        forward, backward = self.forward(weights), self.backward(weights)
        total = forward[self.last][self.word]
        share = forward[self.source] * weights * backward[self.target] * uses[self.word] / total
        sums = np.zeros(table.shape)
        known = self.piece >= 0
        np.add.at(sums, (self.piece[known], language[self.word[known]]), share[known])
        for edge in np.flatnonzero(~known).tolist():
            for byte in self.unknown_bytes[-1 - self.piece[edge]]:
                sums[byte, language[self.word[edge]]] += share[edge]
        return sums


def long_log_likelihood(trie: Trie, word: str, table: np.ndarray) -> np.ndarray:
    """As ``Lattice.log_likelihood``, for a word of any length: every state is
    divided by its own sum before its edges leave, so nothing underflows."""
    lattice = Lattice(trie, [word])
    weights = np.maximum(lattice.weights(table), 1e-200)
    reach = trie.longest
    sums = np.zeros((lattice.states + reach + 1, table.shape[1]))
    scale = np.zeros(table.shape[1])
    sums[0] = 1.0
    by_source = np.argsort(lattice.source, kind="stable")
    starts = np.searchsorted(lattice.source[by_source], np.arange(lattice.states + 1))
    for state in range(lattice.states - 1):
        size = sums[state].copy()
        scale += np.log(size)
        sums[state + 1 : state + reach] /= size
        edges = by_source[starts[state] : starts[state + 1]]
        sums[lattice.target[edges]] += weights[edges]
    return scale + np.log(sums[lattice.states - 1])


class Model:
    """Languages in order of name, and their piece probabilities."""

    def __init__(self, trie: Trie, languages: list[str], weights: np.ndarray) -> None:
        self.trie, self.languages, self.weights = trie, languages, weights


def training_sample(
    docs: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str
) -> DataFrame:
    """``lang, text`` of about ``per_language`` rows of each language."""
    rows = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang")
    ).where("lang is not null and text is not null")
    counts = rows.groupBy("lang").count()
    # Written first: its known size lets Spark broadcast it and leave the texts in place.
    rates = hold(counts.select("lang", (F.lit(float(per_language)) / F.col("count")).alias("rate")))
    return rows.join(rates, "lang").where(share(F.col("doc_id")) < F.col("rate")).select("lang", "text")


def fit(
    docs: DataFrame,
    model: str = MODEL,
    per_language: int = PER_LANGUAGE,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Piece probabilities per language from the rows of ``docs``."""
    vocabulary = Vocabulary(model)
    trie = Trie(vocabulary)
    words = F.filter(F.split("text", f"[{_SPACES}]+"), lambda w: (w != "") & (F.length(w) <= PLAIN))
    counts = hold(
        training_sample(docs, per_language, id_col, text_col, lang_col)
        .select("lang", F.explode(words).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").cast("double").alias("uses"))
    )
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    pieces = len(vocabulary.bytes)
    weights = np.full((pieces, len(languages)), 1.0 / pieces)
    for _ in range(rounds if languages else 0):
        expected = _expected(counts, trie, languages, weights)
        found = expected.groupBy("language", "piece").agg(F.sum("uses").alias("uses")).toArrow()
        weights = np.full((pieces, len(languages)), SMOOTHING)
        place = found["piece"].to_numpy(), found["language"].to_numpy()
        weights[place] += found["uses"].to_numpy()
        weights /= weights.sum(0)
    return Model(trie, languages, weights)


def _expected(
    counts: DataFrame, trie: Trie, languages: list[str], weights: np.ndarray
) -> DataFrame:
    """``language, piece, uses``: partial sums of expected counts, per task."""
    schema = pa.schema([("language", pa.int32()), ("piece", pa.int32()), ("uses", pa.float64())])
    number = {name: n for n, name in enumerate(languages)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(weights.shape)
        for batch in batches:
            language = np.array([number[lang] for lang in batch.column(0).to_pylist()], np.int64)
            lattice = Lattice(trie, batch.column(1).to_pylist())
            sums += lattice.expected(weights, language, batch.column(2).to_numpy())
        piece, language = np.nonzero(sums)
        yield record_batch(schema, [language, piece, sums[piece, language]])

    return map_in_arrow(
        counts.select("lang", "word", "uses"), task, "language int, piece int, uses double"
    )


_PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


def _predictions(known: _Likelihoods, texts: list[str | None]) -> tuple[list[str], list[float]]:
    model = known.model
    rows = []
    for text in texts:
        plain = text is not None and model.languages and _LETTER.search(text)
        words = text.translate(_TO_SPACE).split(" ") if plain else []
        rows.append(list(map(known.__getitem__, words)))
    known.complete()
    langs, scores = [], []
    for row in rows:
        lang, score = UNDETERMINED, 0.0
        if row:
            sums = known.values[row].sum(0)
            best = int(sums.argmax())
            lang = model.languages[best]
            score = float(1.0 / np.exp(sums - sums[best]).sum())
        langs.append(lang)
        scores.append(score)
    return langs, scores


def _scorer(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Likelihoods(model)
        for keys, texts in chunks(batches):
            if len(known) > KEPT:
                known = _Likelihoods(model)
            yield record_batch(_PREDICTED, [keys, *_predictions(known, texts)])

    return task


_TO_SPACE = str.maketrans(dict.fromkeys(_SPACES, " "))


class _Likelihoods(dict):
    """Row of ``values`` for each word asked for; rows are filled by ``complete``."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.values = np.zeros((1, len(model.languages)))
        self[""] = 0  # adds nothing

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        return row

    def complete(self) -> None:
        fresh = list(islice(self, len(self.values), None))
        trie, weights = self.model.trie, self.model.weights
        parts = [self.values]
        for start in range(0, len(fresh), TOGETHER):
            words = fresh[start : start + TOGETHER]
            found = Lattice(trie, [w if len(w) <= PLAIN else "" for w in words]).log_likelihood(weights)
            for n, word in enumerate(words):
                if len(word) > PLAIN or not np.isfinite(found[n]).all():
                    found[n] = long_log_likelihood(trie, word, weights)
            parts.append(found)
        self.values = np.concatenate(parts)


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred string, score double`` of every row of ``docs``."""
    return map_in_arrow(
        id_and_text(docs, id_col, text_col),
        _scorer(model),
        "doc_id long, lang_pred string, score double",
    )


def identified(
    docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with a score of
    ``least`` or more."""
    place = docs.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Likelihoods(model)
        for batch in batches:
            kept: list[bool] = []
            texts = batch.column(place)
            for start in range(0, len(texts), 1000):
                if len(known) > KEPT:
                    known = _Likelihoods(model)
                found = _predictions(known, texts.slice(start, 1000).to_pylist())
                kept += [lang != UNDETERMINED and score >= least for lang, score in zip(*found)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_in_arrow(docs, task, docs.schema)


def with_held_out(predicted: DataFrame, folds: int, held: int) -> DataFrame:
    """``held_out boolean`` after ``doc_id``: the fold that was not learned from."""
    rest = [c for c in predicted.columns if c != "doc_id"]
    held_out = F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out")
    return predicted.select("doc_id", held_out, *rest)
