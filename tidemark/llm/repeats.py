"""Exact removal of repeated substrings across documents, with suffix arrays of the places that can repeat.

A string of ``least`` bytes can only repeat where its anchor does: the smallest hash among its 16-byte strings, which its
content alone decides. So

1. the texts are written once, in block files; equal texts are represented by the smallest id;
2. each block tells which anchors it has, each bucket of anchors which of them more than one text has;
3. around those the blocks send the bytes of all strings with that anchor, equal ones once, to the anchor's bucket;
4. a bucket sorts what follows the anchors with a suffix array (:func:`suffixes.suffix_array`), whose common
   prefixes, with the bytes before the anchor, give the strings that are equal and the smallest id that has each;
5. each block marks the strings that a smaller id has and cuts them out.

Texts move between machines only as files, and what is shuffled are arrays, a row per block and bucket. An
anchor that very many texts have is dealt out by the strings' own middle bytes as well, so no bucket must take all.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from .common import frugal, slices, stage, stage_path
from .shingles import mix
from .suffixes import suffix_array
from .warc import _created, _store

_GRAM = 16
#: Ids that are NULL come after all others.
_LAST = (1 << 63) - 1
_EMPTY = hashlib.sha256(b"").hexdigest()
#: Bytes of a symbol of the suffix array, and how many lengths to the left of a frequent anchor are dealt out together.
_SYMBOL = 13
_LEFTS = 5


def _anchors(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """The anchors of all strings of ``least`` bytes in some texts: the text, the first and last start of
    the strings that have the anchor, its place and its hash, in order of the starts."""
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    span = least - _GRAM + 1
    if len(data) < least:
        return empty
    gram, size = data.astype(np.uint64) + np.uint64(1), 1
    while size < _GRAM:
        gram = mix(gram[:-size] + gram[size:] * np.uint64(0x9E3779B97F4A7C15 + 2 * size))
        size *= 2
    low = ((gram >> np.uint64(28)) << np.uint64(28)) | np.arange(len(gram), dtype=np.uint64)  # ties: the first
    width = 1
    while width * 2 <= span:
        low, width = np.minimum(low[:-width], low[width:]), width * 2
    if width < span:
        low = np.minimum(low[:width - span], low[span - width:])
    place = (low & np.uint64((1 << 28) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(place)]
    inside = np.arange(len(place)) + least <= offsets[text + 1]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return empty
    place, text = place[starts], text[starts]
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])))
    last = starts[np.append(new[1:], len(starts)) - 1]
    return text[new], starts[new], last, place[new], gram[place[new]]


def _numbered(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each kind of equal rows, and the number of every row's kind, by first appearance."""
    data, width = table.tobytes(), table.shape[1]
    number: dict[bytes, int] = {}
    kind = np.fromiter((number.setdefault(data[i:i + width], len(number)) for i in range(0, len(data), width)), np.int64, len(table))
    first = np.empty(len(number), np.int64)
    first[kind[::-1]] = np.arange(len(table))[::-1]
    return first, kind


class _Block:
    """A file of texts; what is derived from it is the same each time."""

    def __init__(self, path: str, rows: list[int]):
        store, at = _store(path)
        with store.open_input_file(at) as file:
            read = pq.read_table(file).take(pa.array(sorted(rows), pa.int64())).combine_chunks()
        self.ids = np.array(read.column("id").to_pylist(), np.int64)
        texts = read.column("text").chunk(0) if read.num_rows else pa.array([], pa.binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        self.data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]

    def anchors(self, least: int, most: int = 1 << 17) -> tuple[np.ndarray, ...]:
        found = [_anchors(self.data[:0], self.offsets[:1], least)]
        for a, b in slices(np.diff(self.offsets).tolist(), most):
            low, high = int(self.offsets[a]), int(self.offsets[b])
            for base in range(low, high, high - low if b > a + 1 else most):  # a long text by its strings' starts
                some = self.offsets[a:b + 1] - base if b > a + 1 else np.array([0, min(high, base + most + least - 1) - base])
                text, first, last, place, gram = _anchors(self.data[base:base + int(some[-1])], some, least)
                found.append((text + a, first + base, last + base, place + base, gram))
        return tuple(map(np.concatenate, zip(*found)))

    def pieces(self, shared: np.ndarray, least: int) -> dict[str, np.ndarray]:
        """Where the strings with a shared anchor stand, as pieces: the bytes of adjacent strings with one anchor.

        Equal pieces have one number ``q``; those arrays that describe a piece are ordered by it, those
        that begin with ``at_`` describe every place.
        """
        text, first, last, place, gram = self.anchors(least)
        known = np.isin(gram, shared)
        text, first, last, place, gram = (x[known] for x in (text, first, last, place, gram))
        size, left = last + least - first, place - first
        width = 2 * least
        table = self.data[np.minimum(first[:, None] + np.arange(width), max(len(self.data) - 1, 0))] if len(first) else np.zeros((0, width), np.uint8)
        table[np.arange(width) >= size[:, None]] = 0
        label = np.column_stack([gram[:, None].view(np.uint8).reshape(-1, 8), size.astype(np.uint8), left.astype(np.uint8), table])
        one, q = _numbered(label)
        ids = self.ids[text]
        low, high = np.full(len(one), _LAST), np.full(len(one), -_LAST - 1)
        np.minimum.at(low, q, ids)
        np.maximum.at(high, q, ids)
        return {"at_text": text, "at_place": place, "at_q": q, "gram": gram[one], "size": size[one], "left": left[one],
                "fewest": (place - last)[one], "bytes": table[one], "low": low, "high": high}


def _write_blocks(docs: DataFrame, folder: str, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """``path, row, key, id, n_bytes, digest`` of every row; ``key`` is the id with NULL last."""
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("key"),
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    @frugal
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            some = pa.Table.from_batches(held).combine_chunks()
            path = f"{folder}/{uuid.uuid4().hex}.parquet"
            with _created(path) as out:
                pq.write_table(pa.table({"id": some.column("key"), "text": some.column("text")}), out, compression="zstd", compression_level=1, use_dictionary=False)
            texts = some.column("text").to_pylist()
            return pa.RecordBatch.from_arrays(
                [pa.array([path] * len(texts)), pa.array(range(len(texts)), pa.int32()), some.column("key").chunk(0), some.column("id").chunk(0),
                 pa.array(map(len, texts), pa.int64()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["path", "row", "key", "id", "n_bytes", "digest"])

        for batch in batches:
            for start, end in slices([n or 0 for n in pa.compute.binary_length(batch.column(2)).to_pylist()], block_bytes // 4):
                held.append(batch.slice(start, end - start))
                size += held[-1].nbytes
                if size >= block_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    # names are of one attempt, and only those of the attempt that is written here are ever read
    return stage(chosen.mapInArrow(write, f"path string, row int, key bigint, id {kind}, n_bytes bigint, digest binary"), "repeat-rows")


def _bytes(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def _by(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places that are in it."""
    order = np.argsort(bucket, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(some):
            yield int(bucket[some[0]]), some


def _ranked(rows: np.ndarray) -> np.ndarray:
    """The rank of each row of up to 16 bytes among the different ones in lexicographic order."""
    wide = np.zeros((len(rows), 16), np.uint8)
    wide[:, :rows.shape[1]] = rows
    high, low = wide.view(">u8").astype(np.uint64).T
    order = np.lexsort((low, high))
    new = np.append(False, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1]))[:len(rows)]
    ranks = np.empty(len(rows), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _smallest_ids(pieces: dict[str, np.ndarray], least: int) -> np.ndarray:
    """For each piece and number of bytes before the anchor the smallest id that has this string.

    Pieces are aligned at their anchors. What follows an anchor, ``least`` bytes, is cut into symbols; the
    suffix array of all of them, one after the other with ends between, sorts them, and neighbours' common bytes tell
    which agree in the first ``least - k``, for any number k of bytes before the anchor.
    """
    size, left, fewest, low = (pieces[k].astype(np.int64) for k in ("size", "left", "fewest", "low"))
    n, reach = len(size), least - _GRAM + 1
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    data = np.append(pieces["data"], np.zeros(1, np.uint8))
    width = -(-least // _SYMBOL) * _SYMBOL
    right = np.arange(width)
    after = np.where((right < (size - left)[:, None]) & (right < least), data[np.minimum((begin + left)[:, None] + right, len(data) - 1)], 0).astype(np.uint8)
    before = np.where(np.arange(1, reach) <= left[:, None], data[np.maximum((begin + left)[:, None] - np.arange(1, reach), 0)], 0)

    one, of = _numbered(after)
    strings = after[one]
    per = width // _SYMBOL
    text = np.zeros((len(strings), per + 1), np.int64)
    text[:, :per] = _ranked(strings.reshape(-1, _SYMBOL)).reshape(-1, per) + 1
    suffixes = suffix_array(text.ravel())
    order = suffixes[suffixes % (per + 1) == 0] // (per + 1)
    differ = strings[order[1:]] != strings[order[:-1]]
    common = np.append(0, np.where(differ.any(axis=1), differ.argmax(axis=1), width)) if len(order) else np.zeros(0, np.int64)

    smallest = np.full((n, reach), _LAST)
    class_before = np.zeros(n, np.int64)
    rank = np.empty(len(order), np.int64)
    for k in range(reach):
        if k:  # the last k bytes before the anchor: agree in k - 1 and in one more
            _, class_before = np.unique(class_before * 256 + before[:, k - 1], return_inverse=True)
        some = np.flatnonzero((fewest <= k) & (k <= left))
        if not len(some):
            continue
        rank[order] = np.cumsum(common < least - k)
        kind = rank[of[some]] * n + class_before[some]
        by = np.argsort(kind, kind="stable")
        new = np.flatnonzero(np.diff(kind[by], prepend=-1))
        lows = np.minimum.reduceat(low[some][by], new)
        smallest[some[by], k] = np.repeat(lows, np.diff(np.append(new, len(by))))
    return smallest


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Touching or overlapping spans made one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return start[new], reach[np.append(new[1:], len(start)) - 1]


def remove_repeats(docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 10 << 20,
                   frequent: int = 20_000) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row of ``docs``.

    Removed is each byte inside a string of ``least`` bytes (33 to 120) that also stands in a text with a smaller id, as
    the texts are given. ``spans`` lists the maximal removed runs, as starts and ends in bytes. A NULL text is empty. Ids are
    whole numbers; rows with the same id do not remove from each other, and those with a NULL id come after all others and do
    not either. Rows with equal texts, repeated ones too, are compared once. ``frequent`` is the number of texts from which an
    anchor is dealt out further; it changes no result.
    """
    spark = docs.sparkSession
    folder = stage_path(spark, "repeat-blocks")
    rows = _write_blocks(docs, folder, id_col, text_col, block_bytes)
    firsts = rows.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # read anew, with the rows on the left, so that Spark can split the partition of a frequent text
    rows = rows.join(stage(firsts, "repeat-copies"), "digest", "left")
    rows = stage(rows.withColumn("copy", F.coalesce(F.col("key") > F.col("first"), F.lit(False))), "repeat-firsts")
    chosen = rows.filter(~F.col("copy") & (F.col("n_bytes") >= least))
    work = stage(chosen.groupBy("path").agg(F.collect_list("row").alias("rows"), F.sum("n_bytes").alias("bytes")), "repeat-work")
    blocks, total = work.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    spread = max(blocks, 1)
    buckets = max(1, -(-(total or 0) // (4 << 20)))
    work = work.select("path", "rows")

    @frugal
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            text, _, _, _, gram = _Block(row["path"], row["rows"]).anchors(least)
            order = np.lexsort((text, gram))
            text, gram = text[order], gram[order]
            once = np.append(True, (gram[1:] != gram[:-1]) | (text[1:] != text[:-1]))[:len(gram)]
            grams, texts = np.unique(gram[once], return_counts=True)
            found = [(k, row["path"], *_bytes(grams[some], texts[some].astype(np.uint32))) for k, some in _by((grams % np.uint64(buckets)).astype(np.int64))]
            yield pa.RecordBatch.from_pylist([dict(zip(("bucket", "path", "grams", "texts"), x)) for x in found], schema=told)

    def share(key: tuple, told: pd.DataFrame) -> pd.DataFrame:
        grams = [np.frombuffer(x, np.uint64) for x in told["grams"]]
        of = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        grams, texts = np.concatenate(grams), np.concatenate([np.frombuffer(x, np.uint32) for x in told["texts"]])
        _, which = np.unique(grams, return_inverse=True)
        total = np.bincount(which, texts)[which]
        grams, of, total = grams[total > 1], of[total > 1], total[total > 1]
        found = [(told["path"].iloc[k], *_bytes(grams[some], total[some] >= frequent), len(some)) for k, some in _by(of)]
        return pd.DataFrame(found, columns=["path", "grams", "often", "n"]) if found else pd.DataFrame()

    told = pa.schema([("bucket", pa.int32()), ("path", pa.string()), ("grams", pa.binary()), ("texts", pa.binary())])
    anchors = work.repartition(spread).mapInArrow(tell, "bucket int, path string, grams binary, texts binary")
    shared = stage(anchors.groupBy("bucket").applyInPandas(share, "path string, grams binary, often binary, n bigint"), "repeat-shared")
    found = shared.agg(F.sum("n")).first()[0] or 0
    buckets_2 = max(1, -(-found // 40_000))
    flags = shared.groupBy("path").agg(F.collect_list(F.struct("grams", "often")).alias("shared"))  # bounded by the block
    flagged = stage(work.join(flags, "path"), "repeat-flagged")

    def opened(row: dict) -> tuple[_Block, dict, np.ndarray]:
        block = _Block(row["path"], row["rows"])
        grams = np.concatenate([np.frombuffer(s["grams"], np.uint64) for s in row["shared"]])
        often = np.concatenate([np.frombuffer(s["often"], bool) for s in row["shared"]])
        return block, block.pieces(grams, least), grams[often]

    @frugal
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            _, pieces, often = opened(row)
            q = np.arange(len(pieces["gram"]))
            hot = np.isin(pieces["gram"], often)
            out = {k: [pieces[k][~hot]] for k in ("gram", "size", "left", "fewest", "low", "high")} | {"q": [q[~hot]], "start": [np.zeros((~hot).sum(), np.int64)]}
            for fewest in range(0, least - _GRAM + 1, _LEFTS) if hot.any() else ():
                most = min(fewest + _LEFTS - 1, least - _GRAM)
                some = np.flatnonzero(hot & (pieces["left"] >= fewest) & (pieces["fewest"] <= most))
                left, few = np.minimum(pieces["left"][some], most), np.maximum(pieces["fewest"][some], fewest)
                start = pieces["left"][some] - left
                middle = np.arange(least - most + fewest) + (pieces["left"][some] - fewest)[:, None]  # bytes of every string dealt out here
                core = np.take_along_axis(pieces["bytes"][some], middle, axis=1).astype(np.uint64)
                spice = mix(np.arange(core.shape[1], dtype=np.uint64) + np.uint64(1000 * fewest + 1)) | np.uint64(1)
                out["gram"].append(mix(pieces["gram"][some] + mix((core + np.uint64(1)) * spice).sum(axis=1, dtype=np.uint64)))
                for k, v in (("size", left + least - few), ("left", left), ("fewest", few), ("low", pieces["low"][some]), ("high", pieces["high"][some]), ("q", q[some]), ("start", start)):
                    out[k].append(v)
            out = {k: np.concatenate(v) for k, v in out.items()}
            columns = np.arange(pieces["bytes"].shape[1])
            made = []
            for bucket, some in _by((mix(out["gram"]) % np.uint64(buckets_2)).astype(np.int64)):
                start, size = out["start"][some, None], out["size"][some, None]
                data = pieces["bytes"][out["q"][some]][(columns >= start) & (columns < start + size)]
                made.append(dict(zip(names, (bucket, row["path"], *_bytes(
                    out["q"][some].astype(np.uint32), out["gram"][some], out["low"][some], out["high"][some],
                    np.column_stack([out[k][some] for k in ("size", "left", "fewest")]).astype(np.uint8), data)))))
                if len(made) == 64:
                    yield pa.RecordBatch.from_pylist(made, schema=sent)
                    made = []
            yield pa.RecordBatch.from_pylist(made, schema=sent)

    names = ["bucket", "path", "q", "gram", "low", "high", "shape", "data"]
    sent = pa.schema([("bucket", pa.int32()), ("path", pa.string())] + [(k, pa.binary()) for k in names[2:]])

    def settle(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        read = lambda k, t: np.concatenate([np.frombuffer(x, t) for x in some[k]])
        q, gram, low, high, data = read("q", np.uint32), read("gram", np.uint64), read("low", np.int64), read("high", np.int64), read("data", np.uint8)
        shape = read("shape", np.uint8).reshape(-1, 3).astype(np.int64)
        of = np.repeat(np.arange(len(some)), [len(x) // 4 for x in some["q"]])
        begin = np.concatenate([[0], np.cumsum(shape[:, 0])]).tolist()
        raw, number = data.tobytes(), {}
        kind = np.array([number.setdefault((g, a, b, raw[i:j]), len(number)) for g, a, b, i, j in zip(
            gram.tolist(), shape[:, 1].tolist(), shape[:, 2].tolist(), begin, begin[1:])])
        least_id, one = np.full(len(number), _LAST), np.empty(len(number), np.int64)
        np.minimum.at(least_id, kind, low)
        one[kind] = np.arange(len(kind))
        # an anchor with the same surroundings everywhere needs no sorting
        _, group, times = np.unique(gram[one], return_inverse=True, return_counts=True)
        column = np.arange(least - _GRAM + 1)
        known = np.where((column >= shape[one, 2][:, None]) & (column <= shape[one, 1][:, None]), least_id[:, None], _LAST)
        some_kinds = np.flatnonzero(times[group] > 1)
        if len(some_kinds):
            size = shape[one[some_kinds], 0]
            take = np.repeat(np.array(begin)[one[some_kinds]] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
            known[some_kinds] = _smallest_ids({"size": size, "left": shape[one[some_kinds], 1], "fewest": shape[one[some_kinds], 2],
                                               "low": least_id[some_kinds], "data": data[take]}, least)
        smallest, found = known[kind], []
        lower = smallest < high[:, None]  # else nothing is to be removed there
        change = lower & np.append(np.ones((len(q), 1), bool), (smallest[:, 1:] != smallest[:, :-1]) | ~lower[:, :-1], axis=1)
        row, first = np.nonzero(change)
        stop = np.append(lower[:, :-1] & ((smallest[:, 1:] != smallest[:, :-1]) | ~lower[:, 1:]), lower[:, -1:], axis=1)
        last = np.nonzero(stop)[1]
        for k, at in _by(of[row]):
            found.append((some["path"].iloc[k], *_bytes(q[row[at]], np.column_stack([first[at], last[at]]).astype(np.uint8), smallest[row[at], first[at]])))
        return pd.DataFrame(found, columns=["path", "q", "lefts", "ids"]) if found else pd.DataFrame()

    pieces = flagged.repartition(spread).mapInArrow(send, "bucket int, path string, " + ", ".join(f"{k} binary" for k in names[2:]))
    settled = pieces.groupBy("bucket").applyInPandas(settle, "path string, q binary, lefts binary, ids binary")
    answers = stage(settled.groupBy("path").agg(F.collect_list(F.struct("q", "lefts", "ids")).alias("answers")), "repeat-answers")

    @frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            block, pieces, _ = opened(row)
            q = np.concatenate([np.frombuffer(a["q"], np.uint32) for a in row["answers"]]).astype(np.int64)
            lefts = np.concatenate([np.frombuffer(a["lefts"], np.uint8).reshape(-1, 2) for a in row["answers"]]).astype(np.int64)
            ids = np.concatenate([np.frombuffer(a["ids"], np.int64) for a in row["answers"]])
            by = np.argsort(q, kind="stable")
            q, lefts, ids = q[by], lefts[by], ids[by]
            begin, end = np.searchsorted(q, pieces["at_q"]), np.searchsorted(q, pieces["at_q"], "right")
            at = np.repeat(np.arange(len(begin)), end - begin)
            which = np.arange(len(at)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + begin[at]
            hit = ids[which] < block.ids[pieces["at_text"][at]]
            at, which = at[hit], which[hit]
            if not len(at):
                continue
            apart = pieces["at_text"][at]  # added to places, so that spans of adjacent texts do not touch
            place = pieces["at_place"][at] + apart
            start, stop = _merged(place - lefts[which, 1], place - lefts[which, 0] + least)
            begins = block.offsets + np.arange(len(block.offsets))
            found = []
            for t, some in _by(np.searchsorted(begins, start, "right") - 1):
                low, high = block.offsets[t], block.offsets[t + 1]
                mine = [(int(a - begins[t]), int(b - begins[t])) for a, b in zip(start[some], stop[some])]
                whole, kept, done = block.data[low:high].tobytes(), hashlib.sha256(), 0
                for a, b in mine:
                    kept.update(whole[done:a])
                    done = b
                kept.update(whole[done:])
                found.append({"digest": hashlib.sha256(whole).digest(), "n_removed": sum(b - a for a, b in mine), "kept_sha256": kept.hexdigest(),
                              "spans": [{"start": a, "end": b} for a, b in mine]})
            yield pa.RecordBatch.from_pylist(found, schema=cuts)

    cuts = pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                      ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
    removed = flagged.join(answers, "path").repartition(spread).mapInArrow(
        cut, "digest binary, n_removed bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>")
    removed = removed.dropDuplicates(["digest"])  # rows that repeat an id and a text
    gone = F.col("copy") & (F.col("n_bytes") >= least)
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    all_ = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))
    spans = F.when(gone, all_).when(F.col("copy"), none).otherwise(F.coalesce("spans", none))
    return rows.join(removed, "digest", "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.when(gone, F.col("n_bytes")).when(F.col("copy"), 0).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.size(spans).cast("bigint").alias("n_spans"),
        F.when(gone, F.lit(_EMPTY)).when(F.col("copy"), F.lower(F.hex("digest"))).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        spans.alias("spans"))
