"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is
the sum over all ways to segment it into pieces, which a forward pass over the word computes; a text is
scored by its words, runs of letters in lower case. The piece probabilities are learnt by expectation
maximisation over the same segmentations, from the word counts of a bounded sample of labelled texts.

Words of one length go through forward and backward passes together, as matrices; each task remembers
the scores of words it has met. Scoring is one scan without a shuffle. Expected counts are summed as whole numbers, so
the model does not depend on the order of rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from .common import frugal, slices, stage

UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"
#: Longer runs of letters are read in parts of this length, which keeps products of probabilities in range.
_LONGEST = 40
_UNIT = 1 << 20


def words_of(text: str) -> list[str]:
    found = _LETTERS.findall(text.lower())
    if not all(map(str.isalpha, found)):  # the pattern also takes numbers that are no digits, such as fractions
        found = "".join(c if c.isalpha() else " " for c in " ".join(found)).split()
    if any(len(w) > _LONGEST for w in found):
        found = [w[i:i + _LONGEST] for w in found for i in range(0, len(w), _LONGEST)]
    return found


class Pieces:
    """The pieces of a vocabulary that lower-case words can hold, as a trie in a matrix.

    Piece 0 stands for any character that is no piece itself. The trie, of the pieces of two characters or
    more, is built where it is first used, in the tasks.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        usable = lambda p: (b := p.removeprefix(_START)) == b.lower() and (p == _START or _LETTERS.fullmatch(b))
        self.names = [p for p in map(model.id_to_piece, range(model.get_piece_size())) if usable(p)]
        self.size = len(self.names) + 1
        self.longest = max(map(len, self.names), default=1)

    @cached_property
    def code(self) -> dict[str, int]:
        """Numbers of characters from 1, first those that the trie knows, then those that are pieces alone."""
        joined = sorted({c for p in self.names if len(p) > 1 for c in p})
        alone = sorted({p for p in self.names if len(p) == 1} - set(joined))
        return {c: i for i, c in enumerate(joined + alone, 1)}

    @cached_property
    def single(self) -> np.ndarray:
        """The piece that a character is alone, by its number."""
        found = np.zeros(len(self.code) + 1, np.int32)
        for number, name in enumerate(self.names, 1):
            if len(name) == 1:
                found[self.code[name]] = number
        return found

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray]:
        """The next state by state and character (state 1 is the start, 0 the end), and each state's piece."""
        children: list[dict[int, int]] = [{}, {}]
        piece = [0, 0]
        for number, name in enumerate(self.names, 1):
            state = 1
            for c in name if len(name) > 1 else ():
                after = children[state].setdefault(self.code[c], len(children))
                if after == len(children):
                    children.append({})
                    piece.append(0)
                state = after
            if state > 1:
                piece[state] = number
        width = max((c for known in children for c in known), default=0) + 1
        step = np.zeros((len(children), width), np.int32)
        for state, known in enumerate(children):
            for c, after in known.items():
                step[state, c] = after
        return step, np.array(piece, np.int32)

    def lattices(self, words: list[str], most: int = 8192) -> Iterator[tuple[np.ndarray, int, list]]:
        """Words of one length at a time: their places in ``words``, the length, and the edges.

        An edge list is, for a span from i to j, the rows whose span is a piece, and the pieces.
        """
        lengths = np.fromiter(map(len, words), np.int32, len(words))
        order = np.argsort(lengths, kind="stable")
        for block in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            for at in range(0, len(block), most):
                rows = block[at:at + most]
                if not len(rows):
                    continue
                n = int(lengths[rows[0]]) + 1
                text = "".join(_START + words[r] for r in rows)
                get = self.code.get
                codes = np.fromiter((get(c, 0) for c in text), np.int32, len(text)).reshape(len(rows), n)
                yield rows, n, self._edges(codes, n)

    def _edges(self, codes: np.ndarray, n: int) -> list:
        (step, piece), single = self.trie, self.single[codes]
        known = np.where(codes < step.shape[1], codes, 0)
        edges = []
        for i in range(n):
            everyone = np.arange(len(codes))
            edges.append((i, i + 1, everyone, single[:, i]))  # one character is always a piece, at worst the unknown one
            alive, state = everyone, np.ones(len(codes), np.int32)
            for j in range(i, min(n, i + self.longest)):
                state = step[state, known[alive, j]]
                going = state > 0
                alive, state = alive[going], state[going]
                if not len(alive):
                    break
                ends = piece[state] > 0
                if ends.any():
                    edges.append((i, j + 1, alive[ends], piece[state[ends]]))
        return edges


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def _forward(n: int, edges: list, rows: int, probability: np.ndarray) -> np.ndarray:
    """For each row, place and language the probability of all segmentations up to the place."""
    ahead = np.zeros((n + 1, rows, probability.shape[1]))
    ahead[0] = 1
    for i, j, some, piece in edges:
        ahead[j, some] += ahead[i, some] * probability[piece]
    return ahead


def log_likelihoods(pieces: Pieces, probability: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word in each language, over all its segmentations."""
    found = np.empty((len(words), probability.shape[1]))
    for rows, n, edges in pieces.lattices(words):
        found[rows] = np.log(_forward(n, edges, len(rows), probability)[n])
    return found


def expected_counts(pieces: Pieces, probability: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """How often each piece is expected in words that come ``counts`` times in each language."""
    total = np.zeros(probability.shape)
    for rows, n, edges in pieces.lattices(words):
        ahead = _forward(n, edges, len(rows), probability)
        back = np.zeros_like(ahead)
        back[n] = counts[rows] / ahead[n]
        for i, j, some, piece in reversed(edges):
            back[i, some] += back[j, some] * probability[piece]
        for i, j, some, piece in edges:
            share = ahead[i, some] * probability[piece] * back[j, some]
            for k in range(total.shape[1]):
                total[:, k] += np.bincount(piece, share[:, k], len(total))
    return total


@dataclass(frozen=True)
class LanguageModel:
    vocabulary: str
    languages: tuple[str, ...]
    probability: np.ndarray

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Scores texts; remembers the words of about the last ``most`` distinct ones."""

    def __init__(self, model: LanguageModel, most: int = 250_000):
        self.model, self.pieces, self.most = model, pieces_of(model.vocabulary), most
        self._forget()

    def _forget(self) -> None:
        from collections import defaultdict

        self.place = defaultdict()
        self.place.default_factory = self.place.__len__
        self.scores = np.zeros((0, len(self.model.languages)))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.place) > self.most:
            self._forget()
        place, at, lengths = self.place, [], []
        for text in texts:
            found = words_of(text) if text else []
            at.extend([place[w] for w in found])
            lengths.append(len(found))
        if not self.model.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        if len(place) > len(self.scores):
            fresh = list(place)[len(self.scores):]
            self.scores = np.concatenate([self.scores, log_likelihoods(self.pieces, self.model.probability, fresh)])
        counts, at = np.array(lengths), np.array(at, np.int64)
        some = np.flatnonzero(counts)
        answers = [(UNDETERMINED, 0.0)] * len(texts)
        if len(some):
            starts = np.concatenate([[0], np.cumsum(counts)])[some]
            sums = np.add.reduceat(self.scores[at], starts)
            best = sums.argmax(axis=1)
            score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
            for r, b, s in zip(some.tolist(), best.tolist(), score.tolist()):
                answers[r] = (self.model.languages[b], s)
        return answers


def held_out(row_id: Column, folds: int = 5) -> Column:
    """Whether the row is kept from learning; not if it has no id."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn_languages(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    sample: int = 2000, rounds: int = 3, folds: int = 5, smoothing: float = 0.1) -> LanguageModel:
    """Learn from about ``sample`` texts a language, chosen by a hash of their ids outside the held-out fold.

    ``sample`` bounds the work of learning at any size. Rows without id, text or language are not used.
    """
    text, lang = F.col(text_col), F.col(lang_col)
    usable = docs.filter(text.isNotNull() & lang.isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col), folds))
    sizes = dict(usable.groupBy(lang.alias("lang")).count().collect())
    languages = tuple(sorted(sizes))
    number = {name: i for i, name in enumerate(languages)}
    pieces = pieces_of(vocabulary)
    probability = np.full((pieces.size, len(languages)), 1 / pieces.size)
    if not languages:
        return LanguageModel(vocabulary, (), probability)
    share = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, sample / n))))
    place = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = usable.filter(place < share[lang]).select(lang.alias("lang"), text.alias("text"))

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen.update((number[lang], w) for w in words_of(text))
            keys = list(seen)
            yield pa.RecordBatch.from_pydict({
                "k": pa.array([k for k, _ in keys], pa.int32()), "word": pa.array([w for _, w in keys], pa.string()),
                "n": pa.array([seen[x] for x in keys], pa.int64())})

    seen = chosen.mapInArrow(count, "k int, word string, n bigint")
    sums = [F.coalesce(F.sum(F.when(F.col("k") == i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in range(len(languages))]
    words = stage(seen.groupBy("word").agg(*sums), "language-words")

    for _ in range(rounds):
        current = probability

        @frugal
        def expect(frames: Iterator[pd.DataFrame], current=current) -> Iterator[pd.DataFrame]:
            pieces = pieces_of(vocabulary)
            total = np.zeros(current.shape)
            for frame in frames:
                total += expected_counts(pieces, current, frame["word"].tolist(), frame.drop(columns="word").to_numpy(float))
            piece, k = np.nonzero(total)
            yield pd.DataFrame({"piece": piece.astype("int32"), "k": k.astype("int32"), "n": np.rint(total[piece, k] * _UNIT).astype("int64")})

        found = words.mapInPandas(expect, "piece int, k int, n bigint").groupBy("piece", "k").agg(F.sum("n").alias("n")).toPandas()
        total = np.full(probability.shape, smoothing)  # a number per piece and language
        total[found["piece"], found["k"]] += found["n"] / _UNIT
        probability = total / total.sum(axis=0)
    return LanguageModel(vocabulary, languages, probability)


def identify_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
                       batch_bytes: int = 2 << 20) -> DataFrame:
    """``id_col, held_out, lang_pred, score`` of every row of ``docs``, from its whole text alone.

    ``score`` is the probability of ``lang_pred`` among the learnt languages. A text that is NULL or has no
    letters is ``und`` with score 0, as is every text if no language was learnt. Of equally likely languages the first by name
    is given. Rows are judged one by one, repeated ones too.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    @frugal
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            texts = batch.column(2)
            sizes = [s or 0 for s in pa.compute.binary_length(texts).to_pylist()]
            for start, end in slices(sizes, batch_bytes):
                found = score(texts.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start),
                     pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                    [id_col, "held_out", "lang_pred", "score"])

    return docs.select(id_col, held_out(F.col(id_col), folds).alias("held_out"), text_col).mapInArrow(
        judge, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def keep_languages(docs: DataFrame, model: LanguageModel, least: float = 0.0, languages: tuple[str, ...] | None = None,
                   text_col: str = "text", batch_bytes: int = 2 << 20) -> DataFrame:
    """The rows of ``docs`` whose text is in one of ``languages`` (any learnt one) with a score of ``least`` or more.

    Texts without letters and NULL ones go. Short texts score low, however clean they are; without ``least`` they stay. Columns, whatever their names, stay as they are; nothing is shuffled.
    """
    accepted = set(model.languages if languages is None else languages)
    at = docs.columns.index(text_col)

    @frugal
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            texts = batch.column(at)
            sizes = [s or 0 for s in pa.compute.binary_length(texts).to_pylist()]
            for start, end in slices(sizes, batch_bytes):
                found = score(texts.slice(start, end - start).to_pylist())
                yield batch.slice(start, end - start).filter(pa.array([x in accepted and s >= least for x, s in found]))

    return docs.mapInArrow(keep, docs.schema)
