"""Packing documents into sequences by best-fit decreasing.

Documents are tokenised where they lie; only piece descriptions move. A document is first cut into
full windows, each a sequence of its own. The remainders, each shorter than a window, are dealt into groups of about
`group_pieces` by a running number, so that no document, source or repeated row makes a group
large; in each group, from the longest down, a piece goes to the open sequence with the
least room that still holds it, found in a segment tree over remaining room.

A null or empty text is a document of one token, the end id. Repeated rows are packed like any others.
The ids are those of the `tokenizers` file named; where the same vocabulary lies beside it as byte
ranks, the quicker encoder reads those, with the same ids.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, written

#: A run without a space of more characters than this is left to the slower encoder, which is linear in its length.
LONG_RUN = 20_000
_ENCODERS: dict[str, object] = {}


class Encoder:
    """encode(text) gives the ids of tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.plain, self.quick = Tokenizer.from_file(path), None
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
            special = {t.content: i for i, t in self.plain.get_added_tokens_decoder().items() if t.special}
            self.special = set(special)
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)

    def encode(self, text: str, *, ordinary: bool = False) -> list[int]:
        """ordinary: a special token that the text spells out is text like any other, so its id never comes up."""
        if self.quick is None or len(text) > LONG_RUN and max(map(len, text.split(" "))) > LONG_RUN:
            self.plain.encode_special_tokens = ordinary
            return self.plain.encode(text, add_special_tokens=False).ids
        if not ordinary and any(s in text for s in self.special):
            return self.quick.encode(text, allowed_special="all")
        return self.quick.encode_ordinary(text)


def encoder(path: str) -> Encoder:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def best_fit_decreasing(sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For pieces of 1..window tokens: the sequence of each, and its offset there. Ties go in the order given.

    Leaf r of the segment tree counts open sequences with r tokens of room; the search for the least
    r >= size walks up from the leaf and down again.
    """
    leaves = 1 << int(window).bit_length()
    tree = [0] * (2 * leaves)
    open_: list[list[int]] = [[] for _ in range(window + 1)]  # sequences by room

    def count(room: int, by: int) -> None:
        at = leaves + room
        while at:
            tree[at] += by
            at >>= 1

    sequence, offset, used = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        at = leaves + size
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            at = at + 1 if at > 1 else 0
            while at and at < leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        if at:
            room = at - leaves
            s = open_[room].pop()
            count(room, -1)
        else:
            s, room = len(used), window
            used.append(0)
        sequence[i], offset[i] = s, used[s]
        used[s] += size
        if room > size:
            open_[room - size].append(s)
            count(room - size, 1)
    return sequence, offset


def _pieces(path: str, window: int, end: int, keep: int, with_ids: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            row, start, length, crc, total, raw = [], [], [], [], [], []
            for i, text in enumerate(batch.column(keep).to_pylist()):
                ids = np.array([*(encode(text) if text else ()), end], dtype="<u4")
                for at in range(0, len(ids), window):
                    piece = ids[at : at + window].tobytes()
                    row.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids))
                    if with_ids:
                        raw.append(piece)
            at = pa.array(row, pa.int64())
            made = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays([*(batch.column(j).take(at) for j in range(keep)), *made, *([pa.array(raw, pa.binary())] if with_ids else [])], names=[*batch.schema.names[:keep], *MADE[:4], *(["ids"] if with_ids else [])])

    return work


MADE = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _pack_group(window: int):
    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_n", "ascending")])
        sequence, offset = best_fit_decreasing(table.column("length").to_numpy(), window)
        group = table.column("_group").to_numpy()[0] if len(table) else 0
        at = [table.schema.get_field_index(c) for c in ("sequence_id", "offset")]
        table = table.set_column(at[0], "sequence_id", pa.array(((np.int64(group) << np.int64(32)) + sequence) * 2 + 1))  # odd; full windows have even ones
        return table.set_column(at[1], "offset", pa.array(offset))

    return work


def pack(docs: DataFrame, tokenizer: str, *, text: str = "text", window: int = 2048, end: int = 1, keep: list[str] | None = None, with_ids: bool = False, group_pieces: int = 4000) -> DataFrame:
    """One row per piece: the columns `keep` of its document (all but the text, by default), start, length, ids_crc32,
    doc_tokens, sequence_id and offset, and with_ids the ids as little-endian unsigned 32-bit integers.

    tokenizer: the path of a tokenizers file that every executor can read. Input columns with these names are replaced.
    """
    made = [*MADE, *(["ids"] if with_ids else [])]
    names = attach([c for c in docs.columns if c != text] if keep is None else keep, made)
    typed = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*names).schema)
    schema = typed + "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + (", ids binary" if with_ids else "")
    pieces = docs.select(*names, F.col(text).alias("_text")).mapInArrow(_pieces(tokenizer, window, end, len(names), with_ids), schema)
    pieces = written(pieces.withColumn("_n", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.filter(F.col("length") < window).count() // group_pieces))
    full = pieces.filter(F.col("length") == window).withColumns({"sequence_id": F.col("_n") * 2, "offset": F.lit(0).cast("bigint")})
    rest = pieces.filter(F.col("length") < window).withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint"), "_group": F.pmod(F.xxhash64("_n"), F.lit(groups)).cast("bigint")})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    packed = rest.groupBy("_group").applyInArrow(_pack_group(window), schema)
    return packed.select(*names, *made).unionByName(full.select(*names, *made))
