"""Packing token sequences by vector bin packing with the dot-product heuristic.

An example is a vector of demands: tokens, one segment, and loss-bearing
tokens. A sequence is a bin with a limit in each dimension. A bin is filled
by taking, of the open examples that fit, the one whose demand has the largest
dot product with the bin's free capacity, both measured against the limits;
that favours examples which use up what the bin has most of (Panigrahy et al.,
"Heuristics for vector bin packing", 2011).

Every task packs the rows it has read, so nothing is shuffled and no task
needs the whole. If examples may be cut, the last example of a bin is cut to
fill it, and a bin that can't be filled is cut back to a power of two, so
padding only remains where a segment or loss limit leaves odd examples over.
The examples a task chooses from are bounded by ``POOL``; they are refilled from
the input while a bin is open, so only its limits close it. Where every token
bears loss and the loss limit is that of tokens, as for documents, those two are
one limit, and segments bind where texts are short.

Defined results: a null text is empty and still has its end-of-text id;
repeated rows are examples of their own; an empty table gives an empty result;
columns not named are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Open examples of a task; only what a bin gives back comes on top.
POOL = 256
#: Parts and words in a worker's cache (twice as many at most), and the longest kept in it.
CACHE, CACHED_LENGTH = 120_000, 64
#: What the vocabularies of this kind take apart in lower-case Latin-1: runs of letters, endings after an apostrophe, single digits, runs of other signs.
PART = re.compile(r"[a-zªµºß-öø-ÿ]+|'(?:[stmd]|re|ve|ll)|[0-9²³¹¼½¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
#: The same by bytes of Latin-1: lower case, and white space, letters, digits and other signs as 0 to 3.
LOWER = bytes(ord(chr(b).lower()) for b in range(256))
KIND = bytes(0 if chr(b).isspace() else 1 if chr(b).isalpha() else 2 if chr(b).isnumeric() else 3 for b in range(256))
#: Characters of texts that are taken apart at once.
TOGETHER = 1 << 22
#: To see whether a vocabulary is of this kind.
PROBES = ["the", "Example.", "ZÉBRÉ,", "straße!?", "niño...", "won.$$$", "Internationalisation", "a1", "ª²", "7.5%", "x_y-z@w.de", "µ(ß)", "I'LL", "don't!", "'re've'm", "'said", "!'s", "it''s'"]

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long, ids binary"


class Words(dict):
    """Ids of parts and words as bytes. One that isn't known is encoded and kept; what isn't used for long is forgotten."""

    def __init__(self, tokenizer: object) -> None:
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.older: dict[str, bytes] = {}
        # Byte-level vocabularies name each byte by a character: visible ones of Latin-1 as they are, the rest from U+0100 on.
        named = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
        self.of_byte = "".join(chr(256 + named.index(b)) if b in named else chr(b) for b in range(256))
        self.of_id = [struct.pack("<I", i) for i in range(max(tokenizer.get_vocab().values(), default=-1) + 1)]
        self.in_parts = True
        self.in_parts = all(self[w] == self.encode(w) for w in PROBES)
        self.clear()

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of_letters(self, word: str) -> bytes:
        """Ids of a lower-case word of Latin letters."""
        of_id = self.of_id
        return b"".join([of_id[t.id] for t in self.model.tokenize(charmap_decode(word.encode(), "strict", self.of_byte)[0])])

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if not self.in_parts or not is_latin(word):
                ids = self.encode(word)
            elif word.isalpha() and word.islower():
                ids = self.of_letters(word)
            else:
                parts = PART.findall(word.lower())
                ids = b"".join([self[x] for x in parts]) if parts != [word] else self.encode(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def is_latin(text: str) -> bool:
    """Whether it has no character beyond Latin-1."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, as the tokenizer gives them without adding special ones.

    The vocabulary never joins what white space separates, so a text's ids are
    those of its words in turn, and in Latin-1 those of its words' parts in
    lower case, which are far fewer: "Word", "word," and "word" share theirs.
    Parts, and the words of other texts, are looked up in a bounded cache. Texts that name a special token, or hold white space of which Python and
    the tokenizer think differently, are encoded whole.
    """

    #: Python splits at these; the tokenizer does not count them as white space.
    ODD = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.apart = [*self.ODD, *(t.content for t in tokenizer.get_added_tokens_decoder().values())]
        self.words = Words(tokenizer)

    def __call__(self, text: str) -> bytes:
        if any(x in text for x in self.apart):
            return self.words.encode(text)
        parts = PART.findall(text.lower()) if self.words.in_parts and is_latin(text) else text.split()
        return b"".join(map(self.words.__getitem__, parts))


    def many(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text in turn, where a part is looked up once for all texts at hand."""
        held, own, size = [], {}, 0
        for text in chain(texts, [None]):
            if text is None or size >= TOGETHER:
                yield from (own.get(i, ids) for i, ids in enumerate(self.together(held)))
                held, own, size = [], {}, 0
            if text is None:
                return
            size += len(text) + 1
            if not self.words.in_parts or len(text) > TOGETHER or not is_latin(text) or any(x in text for x in self.apart):
                own[len(held)], text = self(text), ""
            held.append(text)

    def together(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of texts of Latin-1."""
        raw = "".join([t + " " for t in texts]).encode("latin-1").translate(LOWER)
        byte, kind = np.frombuffer(raw + b"  ", np.uint8), np.frombuffer(raw.translate(KIND) + b"\0\0", np.uint8)
        first = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == 2))
        at = np.flatnonzero(first & (byte == ord("'")))
        short = np.isin(byte[at + 1], list(b"stmd"))
        long = np.isin(byte[at + 1].astype(int) * 256 + byte[at + 2], [x[0] * 256 + x[1] for x in (b"re", b"ve", b"ll")])
        first[at[short | long] + 1] = False
        first[np.append(at[short] + 2, at[long] + 3)] = True
        inside = kind > 0
        starts = np.flatnonzero(first & inside)
        offsets = np.append(np.cumsum(inside)[starts] - 1, inside.sum()).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(byte[inside])]).dictionary_encode()
        known = [self.words[x.decode("latin-1")] for x in parts.dictionary.to_pylist()]
        which, size = parts.indices.to_numpy(), np.array([len(x) // 4 for x in known], int)
        n = size[which]
        upto = np.append(0, np.cumsum(n))
        ids = np.frombuffer(b"".join(known), "<u4")[np.arange(upto[-1]) + np.repeat((np.cumsum(size) - size)[which] - upto[:-1], n)]
        begin = 0
        for end in upto[np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))].tolist():
            yield ids[begin:end].tobytes()
            begin = end


@cache
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker process."""
    return Encoder(path)


class Packer:
    """Fills the sequences of one task. ``add`` an example, ``drain`` at the end; both yield placed pieces."""

    def __init__(self, tokens: int, segments: int, loss: int, cut: bool, first_sequence: int) -> None:
        if min(tokens, segments, loss) < 1:
            raise ValueError("every limit has to be at least 1")
        self.limit = np.array([tokens, segments, loss], float)
        self.tokens, self.cut, self.sequence = tokens, cut, first_sequence
        #: Demands of the open examples; a free slot demands too much.
        self.demand = np.full((POOL, 3), np.inf)
        self.items: list = [None] * POOL
        self.free = list(range(POOL))[::-1]
        #: The open bin: what is left of its limits, and what it has.
        self.left, self.own = self.limit.copy(), []

    def n_open(self) -> int:
        return len(self.items) - len(self.free)

    def loss_of(self, item: tuple) -> int:
        _, mask, start, length = item
        return length if mask is None else int(mask[start : start + length].sum())

    def hold(self, item: tuple) -> None:
        if not self.free:
            self.free = list(range(len(self.items), len(self.items) + POOL))[::-1]
            self.demand = np.vstack((self.demand, np.full((POOL, 3), np.inf)))
            self.items += [None] * POOL
        at = self.free.pop()
        self.items[at], self.demand[at] = item, (item[3], 1, self.loss_of(item))

    def take(self, at: int) -> tuple:
        item, self.items[at] = self.items[at], None
        self.demand[at] = np.inf
        self.free.append(at)
        return item

    def add(self, example: object, mask: np.ndarray | None, n: int) -> Iterator[tuple]:
        start, step = 0, self.tokens
        while n - start > step and (mask is None and self.limit[2] >= step):  # whole sequences of one piece
            yield from self.close([(example, mask, start, step)])
            start += step
        while start < n:
            length = min(step, n - start)
            if mask is not None or self.limit[2] < step:  # a piece alone must meet the loss limit
                length = max(1, self.loss_cut((example, mask, start, length), int(self.limit[2])))
            while self.n_open() > POOL - 4:
                yield from self.fill()
            self.hold((example, mask, start, length))
            start += length

    def loss_cut(self, item: tuple, most: int) -> int:
        """The longest start of an item that bears at most so much loss."""
        _, mask, start, length = item
        if mask is None:
            return min(length, most)
        return int(np.searchsorted(np.cumsum(mask[start : start + length], dtype=np.int64), most, side="right"))

    def fill(self) -> Iterator[tuple]:
        """Puts the best example into the open bin, or closes it if it is full or none fits."""
        left = self.left
        value = (np.where(np.isinf(self.demand), 0, self.demand) / self.limit) @ (left / self.limit)
        value[(self.demand > left).any(axis=1)] = -1
        at = int(value.argmax())
        if value[at] >= 0:
            item = self.take(at)
            self.own.append(item)
            left -= (item[3], 1, self.loss_of(item))
            if left[0] > 0:
                return
        left, own = self.left, self.own
        self.left, self.own = self.limit.copy(), []
        cut_at = -1
        if self.cut and left[0] > 0 and left[1] >= 1 and self.n_open():
            at = int(np.where(np.isinf(self.demand[:, 0]), -1, self.demand[:, 0]).argmax())
            example, mask, start, length = self.items[at]
            n = self.loss_cut((example, mask, start, min(length, int(left[0]))), int(left[2]))
            if 0 < n < length:
                own.append((example, mask, start, n))
                self.items[at] = (example, mask, start + n, length - n)
                self.demand[at] = (length - n, 1, self.loss_of(self.items[at]))
                cut_at = at
        total = sum(x[3] for x in own)
        if self.cut and total < self.tokens:
            keep = 1 << (total.bit_length() - 1)
            while total > keep:
                example, mask, start, length = own.pop()
                back = min(length, total - keep)
                if length > back:
                    own.append((example, mask, start, length - back))
                total -= back
                rest = self.take(cut_at)[3] if cut_at >= 0 else 0  # what was cut off goes on where this piece ends
                self.hold((example, mask, start + length - back, back + rest))
                cut_at = -1
        yield from self.close(own)

    def close(self, own: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for item in own:
            yield item, self.sequence, offset, self.loss_of(item)
            offset += item[3]
        self.sequence += 1

    def drain(self) -> Iterator[tuple]:
        while self.n_open() or self.own:
            yield from self.fill()


def pack_examples(
    df: DataFrame, keys: list[str], read: Callable[[], Callable[[pa.RecordBatch], Iterator[tuple[int, bytes, np.ndarray | None]]]], tokens: int = 2048, segments: int = 512, loss: int | None = None, cut: bool = True, with_ids: bool = False
) -> DataFrame:
    """Pieces of the examples of ``df``: ``keys`` and the columns of ``PIECES``.

    ``read()`` is called once in each task and returns a function from a batch
    to (row, ids, mask of loss-bearing tokens, or None for all).
    """
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", " + PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(tokens, segments, loss or tokens, cut, TaskContext.get().partitionId() << 40)
        examples, rows = read(), []

        def made(all_rows: bool) -> Iterator[pa.RecordBatch]:
            if rows and (all_rows or len(rows) >= 4096):
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(c, types[i]) for i, c in enumerate(columns)]
                rows.clear()
                yield pa.RecordBatch.from_arrays(arrays, names)

        def put(placed: Iterator[tuple]) -> None:
            for ((key, ids), _, start, length), sequence, offset, n in placed:
                own = ids[4 * start : 4 * (start + length)]
                rows.append((*key, start, length, zlib.crc32(own), len(ids) // 4, sequence, offset, n, own if with_ids else None))

        names, types = [], []
        for batch in batches:
            if not names:
                names = [*keys, *(x.split()[0] for x in PIECES.split(", "))]
                types = [*(batch.schema.field(k).type for k in keys), *[pa.int64()] * 7, pa.binary()]
            of_keys = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            for i, ids, mask in examples(batch):
                put(packer.add((tuple(c[i].as_py() for c in of_keys), ids), mask, len(ids) // 4))
                yield from made(False)
        put(packer.drain())
        yield from made(True)

    return df.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Packs whole documents, each ended by ``end_id``; every token bears loss."""
    end = np.array([end_id], "<u4").tobytes()

    def read() -> Callable:
        encode = encoder(tokenizer)

        def examples(batch: pa.RecordBatch) -> Iterator[tuple]:
            for i, ids in enumerate(encode.many(text.as_py() or "" for text in batch.column(1))):
                yield i, ids + end, None

        return examples

    return pack_examples(docs.select(id_col, text_col), [id_col], read, **limits)


def pack_conversations(turns: DataFrame, tokenizer: str, end_id: int = 1, tokens: int = 2048, segments: int = 64, loss: int = 1536) -> DataFrame:
    """Packs conversations uncut where they fit; only what the assistant says bears loss.

    ``turns`` has columns conv_id, turn, role and text. A conversation is put
    together in the order of its turns; one that is longer than a sequence is
    cut into sequences.
    """
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    whole = turns.groupBy("conv_id").agg(F.transform(said, lambda x: x["role"]).alias("roles"), F.transform(said, lambda x: x["text"]).alias("texts"))
    end = np.array([end_id], "<u4").tobytes()

    def read() -> Callable:
        encode = encoder(tokenizer)

        def examples(batch: pa.RecordBatch) -> Iterator[tuple]:
            for i, (roles, texts) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                parts = [encode(t or "") + end for t in texts]
                mask = np.repeat([r == "assistant" for r in roles], [len(p) // 4 for p in parts]).astype(np.uint8)
                yield i, b"".join(parts), mask

        return examples

    return pack_examples(whole, ["conv_id"], read, tokens, segments, loss, cut=False)
