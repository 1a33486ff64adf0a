"""Encoding of texts with a public byte-level BPE vocabulary, through a transducer of frequent words.

The corpus' most frequent words (pieces of the vocabulary's splitting pattern) are encoded once and
compiled into a minimal acyclic transducer: a shared-suffix automaton whose arcs add up to a word's number,
and that number's ids. It lies in one file that every worker maps into memory. Words that it doesn't hold
are merged by the vocabulary's ranks, with the same result.
"""

from __future__ import annotations

import base64
import heapq
import mmap
import struct
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.session import ship_file, ship_package

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public vocabulary's splitting pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words in the transducer; with about 12 bytes a word it stays under a few MB.
LEXICON_WORDS = 65_536
#: Characters of a word in it; longer ones are merged in place, as all that it doesn't hold.
LEXICON_LENGTH = 64
#: Words a worker remembers besides, and distinct words it counts before it hands the counts on.
_REMEMBERED, _COUNTED = 50_000, 200_000
#: Texts encoded at once, so that a worker holds few of them as ids.
_SLICE = 500


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from lines of base64 and number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: of all neighbours the pair of least rank merges first, leftmost first among equals.

    Pairs wait in a heap, and pieces form a linked list, so a word of n bytes takes n log n steps.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    piece: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            pair = piece[i] + piece[j]
            rank = ranks.get(pair)
            if rank is not None:
                heapq.heappush(heap, (rank, i, len(pair)))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if piece[i] is not None else n
        if j >= n or len(piece[i]) + len(piece[j]) != size:
            continue  # a neighbour merged since
        piece[i], piece[j] = piece[i] + piece[j], None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[p] for p in piece if p is not None]


class Transducer:
    """Word bytes to ids. Read from a file by ``open``; written by ``build``.

    File: five numbers (states, arcs, words, ids, root), then int32 arrays: first arc of each state, final
    flags, arc targets, arc outputs, first id of each word, ids; then the arcs' labels, one byte each.
    """

    _HEAD = struct.Struct("<5q")

    @classmethod
    def build(cls, words: Iterable[bytes], encode) -> bytes:
        """Compile sorted distinct words: states with equal futures are one state, found as soon as they close."""
        words = sorted(set(words))
        register: dict[tuple, int] = {}
        states: list[tuple[bool, list[tuple[int, int]]]] = []

        def close(final: bool, arcs: list[tuple[int, int]]) -> int:
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append((final, arcs))
            return register[key]

        # the open path: one [final, arcs, label that led here] for each byte of the last word
        path: list[list] = [[False, [], 0]]

        def fold(depth: int) -> None:
            while len(path) > depth:
                final, arcs, label = path.pop()
                path[-1][1].append((label, close(final, arcs)))

        last = b""
        for w in words:
            common = 0
            while common < min(len(w), len(last)) and w[common] == last[common]:
                common += 1
            fold(common + 1)
            path += [[False, [], b] for b in w[common:]]
            path[-1][0] = True
            last = w
        fold(1)
        root = close(path[0][0], path[0][1])
        counts = [0] * len(states)  # words from each state on; targets close before their sources
        for s, (final, arcs) in enumerate(states):
            counts[s] = int(final) + sum(counts[t] for _, t in arcs)
        first, finals, targets, outputs, labels = [0], [], [], [], bytearray()
        for final, arcs in states:
            number = int(final)
            for label, t in arcs:
                labels.append(label)
                targets.append(t)
                outputs.append(number)
                number += counts[t]
            first.append(len(targets))
            finals.append(int(final))
        starts, ids = [0], []
        for w in words:
            ids += encode(w)
            starts.append(len(ids))
        pack = lambda xs: struct.pack(f"<{len(xs)}i", *xs)
        head = cls._HEAD.pack(len(states), len(targets), len(words), len(ids), root)
        return head + b"".join(map(pack, (first, finals, targets, outputs, starts, ids))) + bytes(labels)

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        states, arcs, words, ids, self._root = self._HEAD.unpack_from(self._map)
        at = self._HEAD.size
        view, arrays = memoryview(self._map), []
        for n in (states + 1, states, arcs, arcs, words + 1, ids):
            arrays.append(view[at : at + 4 * n].cast("i"))
            at += 4 * n
        self._first, self._final, self._target, self._output, self._starts, self._ids = arrays
        self._labels = at

    def ids(self, word: bytes) -> list[int] | None:
        """The word's ids, or None if the lexicon doesn't hold it."""
        s, number, base, find, first = self._root, 0, self._labels, self._map.find, self._first
        for k in range(len(word)):
            arc = find(word[k : k + 1], base + first[s], base + first[s + 1]) - base
            if arc < 0:
                return None
            number += self._output[arc]
            s = self._target[arc]
        return list(self._ids[self._starts[number] : self._starts[number + 1]]) if self._final[s] else None


def word_counts(texts: DataFrame, column: str, pattern: str = PATTERN) -> DataFrame:
    """How often each word stands in all texts: counted within tasks, then summed. Columns ``word``, ``n``."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        split = regex.compile(pattern).findall
        seen: Counter = Counter()
        out = lambda: pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
        for batch in batches:
            for text in batch.column(0):
                seen.update(split(text.as_py()))
                if len(seen) >= _COUNTED:
                    yield out()
                    seen = Counter()
        yield out()

    found = texts.where(F.col(column).isNotNull()).select(column).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def encode_column(texts: DataFrame, key: str, column: str, vocabulary: str = DEFAULT_VOCABULARY, pattern: str = PATTERN, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(key, ids) of every row: the ids of its text in the vocabulary, without special tokens.

    Whole texts are encoded, whatever their length. Null and empty texts have no ids: an empty list.
    Strings that look like special tokens are ordinary text. Rows of one key stay rows of their own.
    The vocabulary file must lie on the driver; it and the lexicon are handed to the executors as files.
    """
    spark = texts.sparkSession
    ship_package(spark)
    ranks = load_ranks(vocabulary)
    # at most lexicon_words rows, none longer than LEXICON_LENGTH; the least word wins a tie, so the lexicon is always the same
    frequent = word_counts(texts, column, pattern).where(F.length("word") <= LEXICON_LENGTH).orderBy(F.desc("n"), "word").limit(lexicon_words)
    blob = Transducer.build([r["word"].encode() for r in frequent.collect()], lambda w: merge(w, ranks))
    name = ship_file(spark, "lexicon.bin", blob)
    copy = ship_file(spark, "ranks.tiktoken", Path(vocabulary).read_bytes())

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        split = regex.compile(pattern).findall
        lexicon, known = Transducer(SparkFiles.get(name)), load_ranks(SparkFiles.get(copy))
        memory: dict[str, list[int]] = {}
        for batch in (b.slice(k, _SLICE) for b in batches for k in range(0, b.num_rows, _SLICE)):
            ids: list[int] = []
            ends = [0]
            for text in batch.column(1):
                for word in split(text.as_py() or ""):
                    got = memory.get(word)
                    if got is None:
                        raw = word.encode()
                        got = lexicon.ids(raw)
                        if got is None:
                            got = merge(raw, known)
                        if len(memory) >= _REMEMBERED:
                            memory.clear()
                        memory[word] = got
                    ids += got
                ends.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["key", "ids"])

    kind = texts.schema[key].dataType.simpleString()
    d = texts.select(F.col(key).alias("key"), F.col(column).alias("text"))
    return d.mapInArrow(encode, f"key {kind}, ids array<int>").withColumnRenamed("key", key)
