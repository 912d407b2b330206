"""Token counts of whole texts, from the pieces of their pre-tokens.

A byte-level tokenizer first splits a text into pre-tokens and never merges across them, so a text has
as many tokens as its pre-tokens have pieces. Most pre-tokens repeat. Each task therefore keeps the
distinct pre-tokens of its rows with their number of pieces, joins that to every document's pre-token
frequencies, and sums; token ids are never built for a document. The work is one scan without a shuffle.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from .common import frugal, slices

#: Fixed value: the splitting pattern of the byte-level tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer pre-tokens are counted, but not remembered.
_REMEMBERED = 48


class PieceCounter:
    """Counts tokens with one tokenizer file; remembers at most ``most`` distinct pre-tokens."""

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all there is
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(PATTERN).findall
        marks = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = regex.compile("|".join(map(regex.escape, sorted(marks, key=len, reverse=True)))) if marks else None
        self.most, self.known, self.plain = most, {}, set()

    def _unassigned(self, text: str) -> bool:
        """Whether a character is younger than our Unicode tables; splitters may then disagree."""
        if text.isascii():
            return False
        fresh = set(text) - self.plain
        if any(unicodedata.category(c) == "Cn" for c in fresh):
            return True
        self.plain |= fresh
        return False

    def _pre_tokens(self, text: str) -> list[str]:
        """As the library itself splits: slower, but of one mind with it about every character."""
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _frequencies(self, text: str) -> tuple[Counter, int]:
        """How often each pre-token comes, and the number of special strings, a token each."""
        find = self._pre_tokens if self._unassigned(text) else self.find
        if self.marks is None or not (n := len(self.marks.findall(text))):
            return Counter(find(text)), 0
        counts: Counter = Counter()
        for part in self.marks.split(text):
            counts.update(find(part))
        return counts, n

    def counts(self, texts: Iterable[str | None]) -> list[int]:
        if len(self.known) > self.most:
            self.known = {}
        found, fresh = [], set()
        for text in texts:
            if not text:
                found.append(0)
            else:
                found.append(self._frequencies(text))
                fresh.update(p for p in found[-1][0] if p not in self.known)
        fresh = list(fresh)
        pieces = {p: len(e.ids) for p, e in zip(fresh, self.tokenizer.encode_batch(fresh, add_special_tokens=False))}
        self.known.update((p, n) for p, n in pieces.items() if len(p) <= _REMEMBERED)
        pieces.update((p, self.known[p]) for f in found if not isinstance(f, int) for p in f[0] if p not in pieces)
        return [f if isinstance(f, int) else f[1] + sum(n * pieces[p] for p, n in f[0].items()) for f in found]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                 batch_bytes: int = 4 << 20) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    ``tokenizer`` is the path of a byte-level ``tokenizers`` file, the same on every machine. Counts are
    those of the library without begin, end or padding tokens and without truncation; special strings
    within a text are one token each, as by its default. NULL and empty texts have no bytes and no tokens.
    Repeated rows and ids are counted row by row; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer)
        for batch in batches:
            texts = batch.column(1)
            sizes = [0 if s is None else s for s in pa.compute.binary_length(texts).to_pylist()]
            for start, end in slices(sizes, batch_bytes):
                n = counter.counts(texts.slice(start, end - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(sizes[start:end], pa.int64()),
                     pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    [id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(
        count, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
