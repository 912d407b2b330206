"""Conversations as training text, by Spark expressions only: one template, reversible, with the spans to learn from.

A block is ``### role: text</turn>`` and a newline; adjacent turns of the same role share a block, with ``<part>`` between
their texts. Inside texts and roles a backslash is put before every backslash and into every control string
(``##\\#``, ``<\\/turn>``, ``<\\part>``, and ``:\\ `` in roles), so that none occurs there, and taking the backslashes out gives the text back.

A conversation is formatted in segments of at most 1024 turns, so that no row or task must hold a longer one: the sorted turns are cut
into runs of neighbours, and only the first and last role of each segment are compared with its neighbours'. The segments of a conversation,
one after the other, are the formatted conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import frugal, stage

#: The control strings of the template.
HEADER, AFTER_ROLE, PART, END = "### ", ": ", "<part>", "</turn>\n"
_TEXT_ESCAPES = r"\\|(?<=##)#|(?<=<)/(?=turn>)|(?<=<)p(?=art>)"
_ROLE_ESCAPES = _TEXT_ESCAPES + r"|(?<=:) "
#: Turns of a segment, as a power of two.
_SEGMENT_BITS = 10
#: Characters of roles and texts that the cuts between tasks look at.
_PREFIX = 64


def escape(text: Column, inside: str = _TEXT_ESCAPES) -> Column:
    return F.regexp_replace(text, inside, r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def in_order(turns: DataFrame, *order: str) -> DataFrame:
    """``turns`` dealt out and sorted by ``conv, turn, role, text`` (NULL first); a frequent conversation goes to many tasks."""
    keys = [F.col("conv"), F.col("turn"), F.left("role", F.lit(_PREFIX)), F.left("text", F.lit(_PREFIX))]
    return turns.repartitionByRange(*keys).sortWithinPartitions(*keys, "role", "text", *order)


def _segments(turns: DataFrame) -> DataFrame:
    """``conv, segment, turns, continues, goes_on``: ordered ``(role, text)``, and whether a block began before or goes on after."""
    ordered = in_order(turns).withColumn("at", F.monotonically_increasing_id())
    held = ordered.groupBy("conv", F.shiftright("at", _SEGMENT_BITS).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    held = stage(held, "chat-turns")
    first, last = F.element_at("turns", 1)["role"], F.element_at("turns", -1)["role"]
    along = Window.partitionBy("conv").orderBy("run")
    ends = held.select("conv", "run", first.alias("first"), last.alias("last")).select(
        "conv", "run", (F.row_number().over(along) - 1).alias("segment"),
        F.coalesce(F.lag("last").over(along) == F.col("first"), F.lit(False)).alias("continues"),
        F.coalesce(F.lead("first").over(along) == F.col("last"), F.lit(False)).alias("goes_on"))
    cut = ends.filter("segment > 0 OR goes_on").select(F.col("conv").alias("c"), F.col("run").alias("r"), "segment", "continues", "goes_on")
    no = F.lit(False)
    return held.join(cut, F.col("conv").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")), "left").select(
        "conv", F.coalesce("segment", F.lit(0)).alias("segment"), "turns", F.coalesce("continues", no).alias("continues"), F.coalesce("goes_on", no).alias("goes_on"))


def format_conversations(turns: DataFrame, learn: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_col, segment, continues, formatted, loss``: the formatted text of each conversation, in segments from 0.

    Turns are ordered by ``turn_col`` (NULL first), then role and text; all rows count, also equal ones and those with a NULL
    conversation, which are one conversation. NULL roles and texts are empty. ``loss`` has the spans (``start``, ``end`` in
    characters of ``formatted``) of the texts whose role is ``learn``, a span each. A conversation of up to 1024 turns has one segment, or two
    where it lies on a cut between tasks; ``continues`` is the role of a block that began in the segment before, else NULL.
    An empty table has no conversations. Other columns are not looked at.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    t, at = F.col("turns"), F.sequence(F.lit(0), F.size("turns") - 1)
    no_places, opens = F.array().cast("array<int>"), F.get(F.col("turns"), F.lit(0))["role"]
    # where a block begins: adjacent turns of a role are merged by one pass over the array
    starts = F.aggregate(at, no_places, lambda found, i: F.when(
        (i > 0) & (F.get(t, i)["role"] == F.get(t, i - 1)["role"]), found).otherwise(F.concat(found, F.array(i))))
    s = F.col("starts")
    blocks = F.transform(s, lambda i, n: F.struct(
        F.get(t, i)["role"].alias("role"),
        F.transform(F.slice(t, i + 1, F.coalesce(F.get(s, n + 1), F.size(t)) - i), lambda x: escape(x["text"])).alias("texts"),
        ((n > 0) | ~F.col("continues")).alias("opens"),
        ((n < F.size(s) - 1) | ~F.col("goes_on")).alias("closes")))
    # a piece for each turn: what comes before its text, the text, what comes after
    before = lambda b, n: F.when(n > 0, F.lit(PART)).when(
        b["opens"], F.concat(F.lit(HEADER), escape(b["role"], _ROLE_ESCAPES), F.lit(AFTER_ROLE))).otherwise(F.lit(PART))
    after = lambda b, n: F.when((n == F.size(b["texts"]) - 1) & b["closes"], F.lit(END)).otherwise(F.lit(""))
    pieces = F.flatten(F.transform(F.col("blocks"), lambda b: F.transform(b["texts"], lambda x, n: F.struct(
        before(b, n).alias("before"), x.alias("text"), after(b, n).alias("after"), (b["role"] == F.lit(learn)).alias("learn")))))
    p = F.col("pieces")
    formatted = F.array_join(F.transform(p, lambda x: F.concat(x["before"], x["text"], x["after"])), "")
    span_type = "array<struct<start:bigint,end:bigint>>"
    nothing = F.struct(F.lit(0).cast("bigint").alias("length"), F.array().cast(span_type).alias("spans"))

    def add(total: Column, x: Column) -> Column:
        start = total["length"] + F.char_length(x["before"])
        end = start + F.char_length(x["text"])
        span = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct((end + F.char_length(x["after"])).cast("bigint").alias("length"),
                        F.when(x["learn"], F.concat(total["spans"], span)).otherwise(total["spans"]).alias("spans"))

    segments = _segments(rows).withColumn("starts", starts).withColumn("blocks", blocks).withColumn("pieces", pieces)
    return segments.select(
        F.col("conv").alias(conv_col), "segment", F.when(F.col("continues"), opens).alias("continues"), formatted.alias("formatted"),
        F.aggregate(p, nothing, add, lambda total: total["spans"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (``role``, ``text``), found in its text alone, and ``learnt``, what lies under the spans, unescaped."""
    # the last block has an end, which leaves an empty string, or goes on in the next segment
    blocks = F.filter(F.split("formatted", END), lambda b: b != "")
    carried = lambda n: (n == 0) & F.col("continues").isNotNull()

    def read(block: Column, n: Column) -> Column:
        body = F.substr(block, F.lit(len(HEADER) + 1))
        until = F.instr(body, AFTER_ROLE)
        role = F.when(carried(n), F.col("continues")).otherwise(unescape(F.substr(body, F.lit(1), until - 1)))
        texts = F.when(carried(n), F.substr(block, F.lit(len(PART) + 1))).otherwise(F.substr(body, until + len(AFTER_ROLE)))
        return F.transform(F.split(texts, PART), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    under = lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return formatted.withColumns({"turns": F.flatten(F.transform(blocks, read)), "learnt": F.transform("loss", under)})


def conversation_digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``conv_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation, read back from its text.

    A task takes one segment after the other into its hashes, so that its memory does not grow with the conversation.
    """
    kind = formatted.schema[conv_col].dataType.simpleString()
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    segments = read_back(formatted).select(
        F.col(conv_col).alias("conv"), "segment", F.size("turns").alias("n"), said.alias("said"), F.array_join("learnt", "").alias("learnt"),
        F.char_length("formatted").alias("chars"))

    @frugal
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        current, open_ = None, []

        def done() -> list:
            conv, n, turns, loss, learnt, chars = open_
            return [conv, n, turns.hexdigest(), loss, learnt.hexdigest(), chars]

        for batch in batches:
            found = []
            for i, (conv, n, chars) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv", "n", "chars")))):
                if not open_ or conv != current:
                    if open_:
                        found.append(done())
                    current, open_ = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                learnt = batch.column("learnt")[i].as_py()
                open_[1] += n
                open_[2].update(batch.column("said")[i].as_buffer())
                open_[3] += len(learnt)
                open_[4].update(learnt.encode())
                open_[5] += chars
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found), types)], names)
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(done(), types)], names)

    id_type = to_arrow_type(formatted.schema[conv_col].dataType)
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ordered = segments.repartition("conv").sortWithinPartitions("conv", "segment")
    found = ordered.mapInArrow(digest, f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return found.withColumnRenamed("conv", conv_col)
