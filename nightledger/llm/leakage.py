"""Evaluation texts leaking into training text, by one automaton over all items.

Texts and items are cut into words alike, and words of items get numbers. Any ``passage_words`` words in a row
of an item hold one of its anchors, a few words at every so manyth place; an Aho-Corasick automaton over the
numbers holds all anchors, and all words of shorter items. Where a text hits an anchor, the words around it are
compared with the item's as far as they agree, so every run long enough is found, whole, and counted once. A
text is read once, whatever the number of items, and runs are mapped back to where they stand in it.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.session import ship_package

PASSAGE_WORDS = 12
#: Words in an anchor.
ANCHOR_WORDS = 4
#: Text of items one automaton takes at most, about 150 MB in a worker; more items go to further automata, which
#: a worker holds one after the other, so none is left out.
MAX_ITEM_CHARS = 8_000_000
#: Text that a worker keeps while it goes through several automata.
_CHUNK_CHARS = 16_000_000
# Characters that are no part of a text's words and don't part them either.
IGNORED = "\u00ad\u200b\u200c\u200d\ufeff"
_DROP = {ord(c): None for c in IGNORED}
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits after NFC, without the ignored characters, in lower case."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).translate(_DROP)
    return _WORD.findall(text.lower())


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where each of ``words(text)`` stands in the text as given: start and end, in characters."""
    chars: list[str] = []
    extent: list[tuple[int, int]] = []
    i = 0
    while i < len(text):
        j = i + 1
        # NFC joins a piece with what stands before it only if that isn't a fresh start
        while j < len(text) and not _starts_afresh(text[i:j], text[j]):
            j += 1
        for c in unicodedata.normalize("NFC", text[i:j]).translate(_DROP).lower():
            chars.append(c)
            extent.append((i, j))
        i = j
    return [(extent[m.start()][0], extent[m.end() - 1][1]) for m in _WORD.finditer("".join(chars))]


def _starts_afresh(before: str, c: str) -> bool:
    if ord(c) < 0x300:
        return True
    if unicodedata.combining(c):
        return False
    return unicodedata.normalize("NFC", before + c) == unicodedata.normalize("NFC", before) + unicodedata.normalize("NFC", c)


@dataclass
class Block:
    """Items as numbers of words: what reaches the tasks."""

    words: list[str] = field(default_factory=list)
    ids: list = field(default_factory=list)
    flat: array = field(default_factory=lambda: array("I"))
    ends: array = field(default_factory=lambda: array("Q", [0]))


class Index:
    """The automaton over a block's items and what it takes to compare words around a hit."""

    def __init__(self, block: Block, size: int):
        import ahocorasick

        self.size, self.ids, self.flat, self.ends = size, block.ids, block.flat, block.ends
        self.numbers = {w: k for k, w in enumerate(block.words, 1)}
        self.anchor = min(ANCHOR_WORDS, size)
        places: dict[tuple[int, ...], list[int]] = {}  # where in flat each anchor stands
        short: dict[tuple[int, ...], list[int]] = {}  # items that are all of a pattern
        for k in range(len(block.ids)):
            a, b = block.ends[k], block.ends[k + 1]
            if b - a < size:
                short.setdefault(tuple(block.flat[a:b]), []).append(k)
            else:
                for p in range(a, b - self.anchor + 1, size - self.anchor + 1):
                    places.setdefault(tuple(block.flat[p : p + self.anchor]), []).append(p)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern in {*places, *short}:
            at, who = places.get(pattern), short.get(pattern)
            self.machine.add_word(pattern, (len(pattern), array("Q", at) if at else (), tuple(who) if who else ()))
        if len(self.machine):
            self.machine.make_automaton()

    def runs(self, text_words: Sequence[str]) -> dict[int, list[tuple[int, int]]]:
        """Of each item the runs of words of the text, first and last, that its passages cover; touching ones are one."""
        from bisect import bisect_right

        get = self.numbers.get
        seq = tuple([get(w, 0) for w in text_words])
        if not any(seq) or not len(self.machine):
            return {}
        flat, ends = self.flat, self.ends
        found: dict[int, list[tuple[int, int]]] = {}
        reached: dict[tuple[int, int], int] = {}  # item and offset: up to where they were compared
        for end, (length, at, who) in self.machine.iter(seq):
            for item in who:
                found.setdefault(item, []).append((end - length + 1, end))
            start = end - length + 1
            for p in at:
                item = bisect_right(ends, p) - 1
                key = (item, start - p)
                if reached.get(key, -1) >= end:
                    continue
                first, last = ends[item], ends[item + 1]
                i, j = start, p
                while i > 0 and j > first and seq[i - 1] == flat[j - 1]:
                    i, j = i - 1, j - 1
                m, n = end, p + length - 1
                while m + 1 < len(seq) and n + 1 < last and seq[m + 1] == flat[n + 1]:
                    m, n = m + 1, n + 1
                reached[key] = m
                if m - i + 1 >= self.size:
                    found.setdefault(item, []).append((i, m))
        out = {}
        for item, parts in found.items():
            parts.sort()
            merged = [parts[0]]
            for a, b in parts[1:]:
                if a <= merged[-1][1] + 1:
                    merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
                else:
                    merged.append((a, b))
            out[item] = merged
        return out


_held: dict[str, Index] = {}


def _index(name: str, shared, size: int) -> Index:
    """Workers are used again: one automaton at a time each."""
    if name not in _held:
        _held.clear()
        _held[name] = Index(shared.value, size)
    return _held[name]


def _blocks(items: DataFrame) -> Iterator[Block]:
    """Items in blocks of at most ``MAX_ITEM_CHARS``, or one item; the driver holds one block at a time."""
    block, room, numbers = Block(), MAX_ITEM_CHARS, {}
    for r in items.toLocalIterator():
        ws = words(r["t"])
        if not ws:
            continue
        if block.ids and room < len(r["t"]):
            yield block
            block, room, numbers = Block(), MAX_ITEM_CHARS, {}
        for w in ws:
            k = numbers.setdefault(w, len(numbers) + 1)
            if k > len(block.words):
                block.words.append(w)
            block.flat.append(k)
        block.ids.append(r["i"])
        block.ends.append(len(block.flat))
        room -= len(r["t"])
    if block.ids:
        yield block


def leaks(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """Each run of a document's words that is covered by passages of an item: one row a run.

    A passage is ``passage_words`` consecutive words of the item, or all of an item with fewer. Items are
    an evaluation set, far smaller than the corpus: their words reach every task, in blocks of at most
    ``MAX_ITEM_CHARS``. The corpus is read once for all blocks.

    Defined results: null texts and those without words hold nothing; items without words don't count;
    items that share a passage are all reported; a document's id given twice gives rows for each.
    Columns: ``doc_id``, ``item_id``, ``words``, ``start``, ``stop`` (the run's begin and end in the text
    as given, in characters).
    """
    import uuid

    from pyspark.sql.pandas.types import to_arrow_type

    spark = documents.sparkSession
    ship_package(spark)
    known = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    shared = [(uuid.uuid4().hex, spark.sparkContext.broadcast(b)) for b in _blocks(known)]
    kinds_of_ids = [f.dataType for f in (documents.schema[doc_id], items.schema[item_id])]
    schema = f"doc_id {kinds_of_ids[0].simpleString()}, item_id {kinds_of_ids[1].simpleString()}, words int, start long, stop long"
    if not shared:
        return spark.createDataFrame([], schema)
    arrow_ids = [to_arrow_type(k) for k in kinds_of_ids]

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [*arrow_ids, pa.int32(), pa.int64(), pa.int64()]
        names = ["doc_id", "item_id", "words", "start", "stop"]

        def rows_of(chunk: list) -> Iterator:
            for name, block in shared:
                index = _index(name, block, passage_words)
                rows: list[tuple] = []
                for doc, raw in chunk:
                    runs = index.runs(words(raw))
                    if runs:
                        spans = word_spans(raw)
                        rows += [(doc, index.ids[k], b - a + 1, spans[a][0], spans[b][1]) for k, parts in runs.items() for a, b in parts]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], names=names)

        chunk, size = [], 0
        for batch in batches:
            for doc, value in zip(batch.column(0), batch.column(1)):
                raw = value.as_py()
                chunk.append((doc.as_py(), raw))
                size += len(raw)
                if size >= (_CHUNK_CHARS if len(shared) > 1 else _CHUNK_CHARS // 8):
                    yield from rows_of(chunk)
                    chunk, size = [], 0
        yield from rows_of(chunk)

    d = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    return d.mapInArrow(scan, schema)
