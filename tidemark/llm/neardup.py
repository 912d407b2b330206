"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, then verified.

1. One scan counts the documents of each hashed shingle feature; the frequent ones (a fixed-size table) give the
   inverse document frequencies.
2. A second scan draws every text's weighted samples and hashes them in bands. Equal texts are then
   represented by the smallest id.
3. Within the texts that share a band, a byte of each sample tells how similar two are likely to be. Texts that are very
   likely similar to the first one are paired with it; each of the others is paired with those most like itself.
   So a group gives a few pairs a text, however large it is.
4. Pairs are verified by the weighted Jaccard similarity of their whole shingle sets, and make connected components.
5. In a group that is not one component then, texts outside the largest one meet all others of the group, block by block, with
   their whole shingle sets. A task compares within its blocks and gives only as many links as join their components, fewer than it has
   texts: no link between two texts that share a band is left out of its class, and no list of pairs is made.

Texts are told apart by id and digest, so that rows that share an id are judged by what they say.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from .common import frugal, slices, stage, text_digest
from .components import components
from .shingles import Idf, WeightedSampler, mix, shingles, weighted_jaccard

_SEGMENT = 1 << 10
#: Of 64 samples: from so many equal ones a pair at 0.8 is not missed (all but 1 in 10^5), and from so many it is hardly below 0.8.
_LIKELY, _SURE, _SAMPLES = 36, 58, 64
#: A text that is not surely like another is first paired with so many of each group, the likeliest.
_PARTNERS = 3
#: Larger groups are dealt to blocks of about so many texts.
_GROUP = 4096
#: When a group is looked at again, a block has about so many texts, or bytes of text.
_BLOCK, _BLOCK_BYTES = 512, 8 << 20
#: Pairs of places of a shingle that are compared at once.
_AT_ONCE = 1 << 21


def _parts(texts: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    sizes = [n or 0 for n in pa.compute.binary_length(texts).to_pylist()]
    for start, end in slices(sizes, most):
        yield start, texts.slice(start, end - start)


def document_frequencies(docs: DataFrame, text_col: str = "text", words: int = 5, rare: float = 0.01, batch_bytes: int = 1 << 20) -> Idf:
    """Count over all documents; features in less than ``rare`` of them are not told apart."""

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << Idf.BITS, np.uint32)
        for batch in batches:
            for _, texts in _parts(batch.column(0), batch_bytes):
                total += np.bincount(Idf.feature(shingles(texts, words)[1]), minlength=len(total)).astype(np.uint32)
        parts = total.reshape(-1, _SEGMENT)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_pydict({"segment": pa.array(some, pa.int32()), "counts": pa.array([parts[i].tobytes() for i in some], pa.binary())})

    @frugal
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:  # however many tasks have counted, memory holds a number per feature
            for segment, counts in zip(*(c.to_pylist() for c in batch.columns)):
                total[segment] = total.get(segment, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        for segment, counts in total.items():
            often = np.flatnonzero(counts >= least)
            yield pa.RecordBatch.from_pydict({"feature": pa.array(segment * _SEGMENT + often, pa.int32()), "n": pa.array(counts[often], pa.int64())})

    documents = docs.count()
    least = max(1, rare * documents)
    counts = docs.select(text_col).mapInArrow(count, "segment int, counts binary")
    often = counts.repartition("segment").mapInArrow(add, "feature int, n bigint")
    return Idf(dict(often.collect()), max(1, documents), rare)  # at most 2^20 numbers at any size


def _bands(docs: DataFrame, idf: Idf, id_col: str, text_col: str, words: int, bands: int, rows: int, batch_bytes: int) -> DataFrame:
    """``id, digest, bands, signature`` of every row; texts without words have no bands. The signature is a byte a sample."""
    kind = docs.schema[id_col].dataType.simpleString()

    @frugal
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = WeightedSampler(bands * rows)
        factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            for start, texts in _parts(batch.column(2), batch_bytes):
                of, hashes, tf = shingles(texts, words)
                keys: list = [None] * len(texts)
                signatures: list = [None] * len(texts)
                if len(of):
                    starts = np.flatnonzero(np.diff(of, prepend=-1))
                    drawn = sampler.samples(hashes, tf * idf.weight[idf.levels(hashes)], starts)
                    band = mix((drawn * factors).reshape(len(starts), bands, rows).sum(axis=2)).view(np.int64)
                    signature = (mix(drawn) >> np.uint64(56)).astype(np.uint8)
                    for at, row, bytes_ in zip(of[starts].tolist(), band, signature):
                        keys[at], signatures[at] = row, bytes_.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), batch.column(1).slice(start, len(texts)), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(signatures, pa.binary())], ["id", "digest", "bands", "signature"])

    return docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"), text_col).mapInArrow(
        sample, f"id {kind}, digest binary, bands array<bigint>, signature binary")


def _compare(pairs: DataFrame, texts: DataFrame, idf: Idf, words: int, similarity: float, batch_bytes: int) -> DataFrame:
    """The pairs that are similar enough. A frequent ``center`` is on the side that Spark splits."""
    members = texts.select(F.col("id").alias("member"), F.col("text").alias("b"))
    centers = texts.select(F.col("id").alias("center"), F.col("text").alias("a"))
    kind = pairs.schema["center"].dataType.simpleString()

    @frugal
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [(x or 0) + (y or 0) for x, y in zip(*(pa.compute.binary_length(batch.column(i)).to_pylist() for i in (2, 3)))]
            for start, end in slices(sizes, batch_bytes):
                part = batch.slice(start, end - start)
                found = weighted_jaccard(shingles(part.column(2), words), shingles(part.column(3), words), idf, len(part))
                passed = pa.array(found >= similarity)
                yield pa.RecordBatch.from_arrays([part.column(i).filter(passed) for i in (0, 1)], ["center", "member"])

    both = pairs.join(members.hint("merge"), "member").join(centers.hint("merge"), "center").select("center", "member", "a", "b")
    return both.mapInArrow(compare, f"center {kind}, member {kind}").distinct()


def _matrix(signatures: pa.Array, samples: int) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint8).reshape(-1, samples)


def _pairs_within(group: np.ndarray, signature: np.ndarray, likely: int, sure: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of places worth comparing, and a place of each group that has further ones, for rows ordered by group.

    In each round the first open row of every group looks at the whole group: open rows that are surely like it are paired with it
    and closed; if that leaves it without any, it is paired with the likeliest rows, open or closed. What is then not paired are
    likely rows after those, and two closed rows.
    """
    rows = np.arange(len(group))
    open_, more = np.ones(len(group), bool), np.zeros(len(group), bool)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(rows):
        new = np.flatnonzero(np.diff(group[rows], prepend=-1))
        sizes = np.diff(np.append(new, len(rows)))
        first = np.minimum.reduceat(np.where(open_[rows], rows, len(group)), new)
        leader = np.repeat(first, sizes)
        alike = np.empty(len(rows), np.int64)
        for at in range(0, len(rows), 1 << 16):
            alike[at:at + (1 << 16)] = (signature[rows[at:at + (1 << 16)]] == signature[leader[at:at + (1 << 16)]]).sum(axis=1)
        other = rows != leader
        closed = open_[rows] & other & (alike >= sure)
        found.append((leader[closed], rows[closed]))
        some = np.flatnonzero(other & (alike >= likely))
        some = some[np.lexsort((-alike[some], leader[some]))]
        rank = np.arange(len(some)) - np.searchsorted(leader[some], leader[some])
        best = some[rank < _PARTNERS]
        more[leader[some[rank >= _PARTNERS]]] = True
        found.append((leader[best], rows[best]))
        open_[rows[closed]] = False
        open_[first] = False
        still = np.add.reduceat(open_[rows], new) > 0
        rows = rows[np.repeat(still, sizes)]
    shut = np.concatenate([x for _, x in found[::2]]) if found else rows
    shut = shut[np.argsort(group[shut], kind="stable")]
    more[shut[1:][group[shut[1:]] == group[shut[:-1]]]] = True
    left, right = (np.concatenate(x) for x in zip(*found)) if found else (rows, rows)
    return left, right, np.flatnonzero(more)


def _settled(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 8 * _GROUP) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows ordered by ``keys``, many whole groups at a time, each with the number of its group."""
    held: list[pa.RecordBatch] = []

    def cut(rows: pa.Table) -> np.ndarray:
        new = np.zeros(len(rows), bool)
        for key in keys:
            values = rows.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return new

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:  # up to the last group, which may go on
            rows = pa.Table.from_batches(held)
            new = cut(rows)
            if new.any():
                last = int(np.flatnonzero(new)[-1])
                yield rows.slice(0, last).combine_chunks(), np.cumsum(new[:last])
                held = rows.slice(last).to_batches()
    if held and sum(b.num_rows for b in held):
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, np.cumsum(cut(rows))


def _ordered(pairs: DataFrame) -> DataFrame:
    """``center, member``, the smaller id first."""
    return pairs.filter("a <> b").select(F.least("a", "b").alias("center"), F.greatest("a", "b").alias("member")).distinct()


def _blocks(rows: Column, of: int) -> Column:
    return F.ceil(rows / of).cast("int")


def _candidates(members: DataFrame, likely: int, sure: int, samples: int) -> DataFrame:
    """``band, key, a, b`` from ``band, key, id, signature`` and the ``n`` texts and ``first`` id of the group.

    The pairs are ``a, b``; a row without them says that the group has further ones. A group of more than ``_GROUP`` texts is dealt to blocks, each of which also gets the group's first text.
    """
    kind = members.schema["id"].dataType.simpleString()

    @frugal
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in _settled(batches, ["band", "key", "block"]):
            left, right, more = _pairs_within(group, _matrix(rows.column("signature"), samples), likely, sure)
            ids = rows.column("id").chunk(0)
            more = more[np.diff(group[more], prepend=-1) > 0]
            a, b = (pa.concat_arrays([ids.take(pa.array(x)), pa.nulls(len(more), ids.type)]) for x in (left, right))
            same = [rows.column(c).chunk(0).take(pa.array(np.append(left, more))) for c in ("band", "key")]
            yield pa.RecordBatch.from_arrays([*same, a, b], ["band", "key", "a", "b"])

    n = _blocks(F.col("n"), _GROUP)
    block = F.when(n == 1, F.array(F.lit(0))).when(F.xxhash64("id") == F.col("first"), F.sequence(F.lit(0), n - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("id"), n).cast("int")))
    dealt = members.select("band", "key", F.explode(block).alias("block"), "id", "signature")
    ordered = dealt.repartition("band", "key", "block").sortWithinPartitions("band", "key", "block", "id")
    return ordered.mapInArrow(pair, f"band int, key bigint, a {kind}, b {kind}")


def _joining(of: np.ndarray, hashes: np.ndarray, weights: np.ndarray, component: np.ndarray, seeks: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links that join the components of some texts: every link between a seeking text and any other is within a component then.

    The texts' shingles are given ordered by text. Places of equal shingles are met a few seeking texts at a time.
    """
    component = component.copy()
    order = np.argsort(hashes, kind="stable")
    sorted_, total = hashes[order], np.bincount(of, weights, len(component))
    begin = np.searchsorted(of, np.arange(len(component) + 1))
    low, high = np.searchsorted(sorted_, hashes, "left"), np.searchsorted(sorted_, hashes, "right")
    work = np.concatenate([[0], np.cumsum(high - low)])
    found, seeking, at = [], np.flatnonzero(seeks), 0
    while at < len(seeking):
        end, most = at + 1, max(_AT_ONCE, len(component))
        spent = work[begin[seeking[at] + 1]] - work[begin[seeking[at]]]
        while end < len(seeking) and end - at < most // len(component):
            spent += work[begin[seeking[end] + 1]] - work[begin[seeking[end]]]
            if spent > _AT_ONCE:
                break
            end += 1
        mine = seeking[at:end]
        both = np.zeros((len(mine), len(component)))
        for row, text in enumerate(mine.tolist()):
            place = begin[text]
            while place < begin[text + 1]:
                last = np.searchsorted(work, work[place] + _AT_ONCE, "right") - 1
                part = slice(place, min(max(last, place + 1), begin[text + 1]))
                n = high[part] - low[part]
                other = order[np.repeat(low[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                both[row] += np.bincount(of[other], np.minimum(np.repeat(weights[part], n), weights[other]), len(component))
                place = part.stop
        union = total[mine][:, None] + total - both
        alike = np.divide(both, union, out=np.zeros_like(both), where=union > 0) >= similarity
        for row, text in enumerate(mine.tolist()):
            partners = np.flatnonzero(alike[row] & (component != component[text]))
            while len(partners):
                found.append((text, int(partners[0])))
                component[component == component[partners[0]]] = component[text]
                partners = partners[component[partners] != component[text]]
        at = end
    return found


def _further(members: DataFrame, labels: DataFrame, texts: DataFrame, idf: Idf, words: int, similarity: float) -> DataFrame:
    """``center, member``: links that join whatever components share a group (``band, key``) and have a link there.

    Every text that is not in the largest component of its group looks at all others of the group. Texts that look and
    texts looked at are dealt to blocks, and a task has one block of each, so that a group of any size is split.
    """
    kind = members.schema["id"].dataType.simpleString()
    unit = ["band", "key", "seeking", "sought"]

    @frugal
    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in _settled(batches, unit, _BLOCK):
            seeks = rows.column("seeks").to_numpy()
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
                part = rows.slice(start, end - start)
                number: dict = {}
                component = np.array([number.setdefault(tuple(c.values()), len(number)) for c in part.column("component").to_pylist()])
                if len(number) < 2:
                    continue
                of, hashes, n = shingles(part.column("text").combine_chunks(), words)
                links = _joining(of, hashes, n * idf.weight[idf.levels(hashes)], component, seeks[start:end], similarity)
                if links:
                    ids = part.column("id").combine_chunks()
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(side)) for side in zip(*links)], ["a", "b"])

    known = members.join(labels, F.col("id") == F.col("node"), "left").select("band", "key", "id", F.coalesce("component", "id").alias("component"))
    known = stage(known, "near-known")
    bytes_ = texts.select("id", F.octet_length("text").cast("bigint").alias("bytes"))
    sizes = known.join(bytes_, "id").groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    sizes = sizes.groupBy("band", "key").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "bytes", "component")).alias("most"))
    sizes = stage(sizes.filter(F.col("n") > F.col("most.n")), "near-apart")
    needed = lambda n, b: F.greatest(_blocks(n, _BLOCK), _blocks(b, _BLOCK_BYTES))
    of = needed(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes"))
    to = needed(F.col("n"), F.col("bytes"))
    place = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    unit_of = lambda seeking, sought, seeks: F.struct(seeking.alias("seeking"), sought.alias("sought"), F.lit(seeks).alias("seeks"))
    sought = F.transform(F.sequence(F.lit(0), of - 1), lambda x: unit_of(x, place(to), False))
    # one that looks is looked at in its own block already
    seeking = F.transform(F.filter(F.sequence(F.lit(0), to - 1), lambda x: x != place(to)), lambda x: unit_of(place(of), x, True))
    own = F.transform(sought, lambda u: F.struct(u["seeking"].alias("seeking"), u["sought"].alias("sought"), (u["seeking"] == place(of)).alias("seeks")))
    units = F.when(F.col("component") == F.col("most.component"), sought).otherwise(F.concat(own, seeking))
    # the members are on the left, where Spark splits the partition of a large group
    dealt = known.join(sizes, ["band", "key"]).select("band", "key", "id", "component", F.explode(units).alias("unit"))
    dealt = dealt.select("band", "key", "unit.*", "id", "component").join(texts.hint("merge"), "id")
    dealt = dealt.select(*unit, "seeks", "id", "component", "text").repartition(*unit).sortWithinPartitions(*unit, "id")
    return _ordered(dealt.mapInArrow(seek, f"a {kind}, b {kind}"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, words: int = 5,
                    bands: int = 16, rows: int = 4, batch_bytes: int = 1 << 20) -> DataFrame:
    """``id_col, class_id, kept`` of every row of ``docs``.

    A class is a connected set of texts that are equal, or share a band and have a weighted Jaccard similarity of at least
    ``similarity``; ``class_id`` is its smallest id and ``kept`` marks the rows of one text that has it. With 16 bands of 4
    a pair at 0.8 shares a band with probability 0.9998. NULL texts are alike to nothing, texts without
    words only to equal ones. A row without an id takes the class of an equal text, or NULL, and is always kept.
    Rows that share an id are judged by their texts: equal texts are one, different ones each have their own class and stay unless
    they are alike or like others.
    """
    found = _classes(docs, id_col, text_col, similarity, words, bands, rows, batch_bytes)
    return found.select(F.col("id").alias(id_col), "class_id", "kept")


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, words: int, bands: int, rows: int, batch_bytes: int) -> DataFrame:
    """``id, digest, class_id, kept`` of every row. A text is named by its smallest id and its digest."""
    samples = bands * rows
    likely, sure = round(_LIKELY / _SAMPLES * samples), round(_SURE / _SAMPLES * samples)
    idf = document_frequencies(docs, text_col, words)
    marked = stage(_bands(docs, idf, id_col, text_col, words, bands, rows, batch_bytes), "near-bands")
    copies = marked.filter("id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = stage(copies.filter("n > 1").drop("n"), "near-copies")  # read anew, so that Spark can split a frequent text's rows
    first = F.coalesce("first", "id")
    named = marked.join(copies, "digest", "left").withColumn("node", F.when(first.isNotNull(), F.struct(first.alias("id"), "digest")))
    marked = stage(named.select("id", "digest", "node", F.when(F.col("id") == first, F.col("bands")).alias("bands"), "signature"), "near-nodes")
    nodes = marked.filter("bands IS NOT NULL").select(F.col("node").alias("id"), "bands", "signature")
    banded = nodes.select("id", F.posexplode("bands").alias("band", "key"))
    groups = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("id")).alias("first"))
    groups = stage(groups.filter("n > 1"), "near-groups")
    members = banded.join(groups, ["band", "key"]).distinct().join(nodes.select("id", "signature"), "id").select("band", "key", "id", "signature", "n", "first")
    members = stage(members.dropDuplicates(["band", "key", "id"]), "near-members")
    found = stage(_candidates(members, likely, sure, samples), "near-found")
    pairs = stage(_ordered(found), "near-pairs")
    large = members.filter(F.col("n") > _GROUP)
    left = found.filter("b IS NULL").select("band", "key").union(large.select("band", "key")).distinct()
    again = members.join(left, ["band", "key"], "left_semi")
    # texts asked for grow with the documents: they are met by sorting at any size
    asked = pairs.select(F.col("center").alias("id")).union(pairs.select("member")).union(large.select("id")).distinct()
    own = docs.select(F.struct(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")).alias("id"), F.col(text_col).alias("text"))
    texts = stage(own.join(asked.hint("merge"), "id", "left_semi").dropDuplicates(["id"]), "near-texts")
    links = stage(_compare(pairs, texts, idf, words, similarity, batch_bytes), "near-links")
    labels = components(links, "center", "member")
    more = stage(_further(again, labels, texts, idf, words, similarity), "near-further")
    if not more.isEmpty():
        labels = components(links.union(more), "center", "member")
    found = marked.join(labels.withColumnRenamed("component", "found"), "node", "left")
    chosen = F.coalesce("found", "node")
    kept = F.col("id").isNull() | F.col("digest").isNull() | F.coalesce((chosen["id"] == F.col("id")) & (chosen["digest"] == F.col("digest")), F.lit(True))
    return found.select("id", "digest", F.coalesce(chosen["id"], F.col("id")).alias("class_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, words: int = 5,
                         bands: int = 16, rows: int = 4, batch_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with one row of each class, and all rows without an id or a text; columns, whatever their names, stay as they are.

    The row is that of the smallest id. Rows that share an id and a text are one document, of which one row stays.
    """
    gone = _classes(docs, id_col, text_col, similarity, words, bands, rows, batch_bytes).filter("NOT kept").select("id", "digest").distinct()
    own = F.when(F.col(id_col).isNull() | F.col(text_col).isNull(), F.monotonically_increasing_id())
    held = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"), own.alias("own"))
    left = held.join(gone.hint("merge"), ["id", "digest"], "left_anti").dropDuplicates(["id", "digest", "own"])
    return left.select("row.*")
