"""Best-fit packing of tokenised documents into sequences, with a bounded number of open bins."""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lexloom.llm.common import pieces, saved

#: Tokens of a sequence.
ROOM = 2048
#: Bins that may be open at once in a task.
OPEN_BINS = 2048
#: Partitions whose unfinished bins are packed again together.
FAN_IN = 16
END = 0
#: The faster library fails on runs of white space about ten times as long.
SAFE_RUN = 100_000
_LONG_RUN = re.compile(r"(?<!\s)\s{%d}" % SAFE_RUN)

_ENCODERS: dict[str, object] = {}
_TOKENIZERS: dict[tuple[str, bool], object] = {}


def encoder(ranks: str):
    """The byte-level BPE of a file of ranks, loaded once per worker."""
    if ranks not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _ENCODERS[ranks] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODERS[ranks]


def tokenizer(ranks: str, added: bool):
    """The tokenizer itself, from the json beside the ranks; without `added`, strings of added tokens are ordinary text."""
    if (ranks, added) not in _TOKENIZERS:
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(os.path.splitext(ranks)[0] + ".json")
        found.encode_special_tokens = not added
        _TOKENIZERS[ranks, added] = found
    return _TOKENIZERS[ranks, added]


def token_ids(ranks: str, added: bool):
    """text -> ids, by the faster library where it gives what the tokenizer gives, else by the tokenizer."""
    bpe = encoder(ranks)
    special = [t.content for t in tokenizer(ranks, added).get_added_tokens_decoder().values()] if added else []

    def ids(text: str) -> list[int]:
        if any(t in text for t in special) or (len(text) >= SAFE_RUN and _LONG_RUN.search(text)):
            return tokenizer(ranks, added).encode(text, add_special_tokens=False).ids
        return bpe.encode_ordinary(text)

    return ids


def cuts(n: int, room: int = ROOM) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all but the first are full."""
    if n <= room:
        return [(0, n)]
    first = n - room * ((n - 1) // room)
    return [(0, first)] + [(s, room) for s in range(first, n, room)]


class Bins:
    """Open bins keyed by free space in a bitset; finished bins are handed to `close`."""

    def __init__(self, room: int, most: int, number: Iterator[int]):
        self.room, self.most, self.number = room, most, number
        self.free = 0  # bit f is set if a bin with f free tokens is open
        self.bins: list[list] = [[] for _ in range(room + 1)]
        self.count = 0
        self.closed: list[tuple[int, list]] = []

    def _take(self, f: int):
        found = self.bins[f].pop()
        if not self.bins[f]:
            self.free ^= 1 << f
        self.count -= 1
        return found

    def add(self, length: int, row: tuple) -> None:
        """Put a piece where it leaves the least room; open a bin if it fits nowhere."""
        fits = self.free >> length
        if fits and length:
            f = length + (fits & -fits).bit_length() - 1
            name, rows = self._take(f)
        else:
            f, name, rows = self.room, next(self.number), []
        rows.append((*row, name, self.room - f))
        f -= length
        if not f:
            self.closed.append((name, rows))
            return
        self.bins[f].append((name, rows))
        self.free |= 1 << f
        self.count += 1
        if self.count > self.most:
            fullest = (self.free & -self.free).bit_length() - 1
            self.closed.append(self._take(fullest))

    def done(self) -> list:
        out, self.closed = self.closed, []
        return [r for _, rows in out for r in rows]

    def rest(self) -> list:
        out = self.done() + [r for same in self.bins for _, rows in same for r in rows]
        self.__init__(self.room, self.most, self.number)
        return out


def _numbers(round_: int) -> Iterator[int]:
    """Sequence ids that no other task of any round gives."""
    n = (round_ << 60) | (TaskContext.get().partitionId() << 34)
    while True:
        yield n
        n += 1


def pack(
    docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", room: int = ROOM, most: int = OPEN_BINS,
    with_ids: bool = False, added: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    `ranks` is the path of a byte-level BPE vocabulary as ranks, with the tokenizer's json
    beside it. With `added`, strings of its added tokens give their ids, as the tokenizer has
    it; otherwise they are ordinary text. A document's ids end with id 0; null and empty texts are that id
    alone. A document of more than `room` ids is cut into pieces, all full but the first.
    Each task packs the pieces it reads as they come, at most `most` bins open; what bins
    unfinished at its end hold is packed again, longest pieces first, with that of about
    FAN_IN - 1 other tasks and their number of bins. Repeated
    rows and null keys are packed each; other columns are not read. `with_ids` adds the
    ids of each piece.
    """
    kind = docs.schema[key].dataType.simpleString()
    extra = ", ids array<int>" if with_ids else ""
    names = ["key", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset"]
    # Keys travel as text: pandas would turn whole numbers with nulls into floats.
    schema = f"key string, piece int, start long, length long, ids_crc32 long{extra}, sequence_id long, offset long, open boolean"

    def frame(rows: list, unfinished: bool) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        out["open"] = unfinished
        if unfinished and len(out):
            free = room - out.groupby("sequence_id")["length"].transform("sum")
            out["open"] = free > 0
        order = [c for c in names if c != "ids"]
        return out[[*order[:5], *["ids"] * with_ids, *order[5:], "open"]]

    def read(batches):
        bins = Bins(room, most, _numbers(0))
        encode = token_ids(ranks, added)
        for b in pieces(batches, "text"):
            for k, t in zip(b["key"], b["text"]):
                ids = np.array([*encode(t), END] if t else [END], "<u4")
                for p, (start, length) in enumerate(cuts(len(ids), room)):
                    part = ids[start : start + length]
                    row = (k, p, start, length, zlib.crc32(part.tobytes()))
                    bins.add(length, (*row, part.astype(np.int32)) if with_ids else row)
            yield frame(bins.done(), False)
        yield frame(bins.rest(), True)

    def again(batches):
        bins = Bins(room, FAN_IN * most, _numbers(1))
        for b in batches:
            for row in b[[n for n in names if n not in ("sequence_id", "offset")]].itertuples(index=False, name=None):
                bins.add(row[3], row)
            yield frame(bins.done(), False)
        yield frame(bins.rest(), False)

    source = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    first = saved(source.mapInPandas(read, schema), "packed")
    rest = first.where("open")
    tasks = first.select(F.shiftright("sequence_id", 34).alias("t")).distinct().count()
    groups = max(1, -(-tasks // FAN_IN))
    rest = rest.repartition(groups, "sequence_id")
    rest = rest.sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    second = rest.mapInPandas(again, schema)
    out = first.where(~F.col("open")).union(second).drop("open")
    return out.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
