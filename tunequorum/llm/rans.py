"""Token ids as files coded with static range asymmetric numeral systems (rANS).

Texts are tokenized in ascending order of their ids and grouped into segments of about SEGMENT_IDS token ids, cut
between documents. A segment is one row of a Parquet table: a self-contained binary payload with

* a frequency table, scaled to 2**SCALE_BITS, that all blocks of the segment share;
* the documents' ids and lengths;
* blocks of BLOCK_IDS token ids, each coded on its own by LANES interleaved coders (coder k takes the ids k, k + LANES,
  ...). The directory holds for every block a checkpoint (the coders' states and the place of its words), a CRC-32 of
  its words and one of its ids, so any block can be decoded alone and all of them side by side.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tunequorum.llm.bpe import byte_characters
from tunequorum.llm.pieces import ArrayEncoder, Memory, joined, worker_values

if TYPE_CHECKING:
    from tokenizers import Tokenizer

SCALE_BITS = 20
BLOCK_IDS = 1 << 16
LANES = 128
SEGMENT_IDS = 1 << 21

#: Pieces given to the tokenizer at a time, whose results are large objects.
CALL_PIECES = 4096
#: Words given to its model at a time.
CALL_WORDS = 64
#: Letters below this have long been letters in every version of Unicode.
LATIN_END = "\u0250"

_HEADER = "<4sIIQQ"  # magic, symbols, blocks, documents, ids
_MAGIC = b"RANS"
_LOW = np.uint64(1 << 31)
_SHIFT = np.uint64(SCALE_BITS)
_WORD = np.uint64(32)


@dataclass
class FrequencyTable:
    symbols: np.ndarray
    frequencies: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray) -> FrequencyTable:
        """Every symbol gets one slot and its share of the others; the most frequent one also gets the rest."""
        if len(ids) and ids.max() < 1 << SCALE_BITS:
            every = np.bincount(ids)
            symbols = np.flatnonzero(every)
            counts = every[symbols]
        else:
            symbols, counts = np.unique(ids, return_counts=True)
        if len(symbols) > 1 << SCALE_BITS:
            raise ValueError("more symbols than slots")
        spare = (1 << SCALE_BITS) - len(symbols)
        frequencies = 1 + counts.astype(np.int64) * spare // max(1, len(ids))
        if len(symbols):
            frequencies[np.argmax(counts)] += (1 << SCALE_BITS) - frequencies.sum()
        return cls(symbols.astype(np.uint32), frequencies.astype(np.uint32))

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The place of each id, all of which are symbols, among the symbols."""
        if not len(ids) or self.symbols[-1] >= 1 << SCALE_BITS:
            return np.searchsorted(self.symbols, ids)
        place = np.zeros(int(self.symbols[-1]) + 1, np.int64)
        place[self.symbols] = np.arange(len(self.symbols))
        return place[ids]

    def starts(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.frequencies.astype(np.uint64))[:-1]].astype(np.uint64)


def _grid(n: int) -> tuple[int, np.ndarray]:
    """Steps of a block, and for every step, block and lane whether there is an id."""
    blocks = -(-n // BLOCK_IDS)
    steps = -(-min(n, BLOCK_IDS) // LANES)
    sizes = np.minimum(BLOCK_IDS, n - BLOCK_IDS * np.arange(blocks))
    place = np.arange(steps)[:, None] * LANES + np.arange(LANES)
    return steps, place[:, None, :] < sizes[None, :, None]


def encode_blocks(ids: np.ndarray, table: FrequencyTable) -> tuple[np.ndarray, list[np.ndarray]]:
    """States (blocks x LANES) after the last step and the words of each block, in the order a decoder reads them."""
    n = len(ids)
    steps, there = _grid(n)
    blocks = there.shape[1]
    index = np.zeros(blocks * steps * LANES, np.int64) if blocks < 2 else np.zeros(blocks * BLOCK_IDS, np.int64)
    index[:n] = table.places(ids)
    index = index.reshape(blocks, steps, LANES)
    frequency, start = table.frequencies.astype(np.uint64), table.starts()
    state = np.full((blocks, LANES), _LOW, np.uint64)
    words, owners = [], []
    owner = np.repeat(np.arange(blocks), LANES).reshape(blocks, LANES)
    for step in range(steps - 1, -1, -1):
        on = there[step]
        f, c = frequency[index[:, step]], start[index[:, step]]
        full = on & (state >= f << np.uint64(63 - SCALE_BITS))
        # a decoder reads forward, so what is written last comes first: the whole list is turned around below
        words.append((state[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)[::-1])
        owners.append(owner[full][::-1])
        state = np.where(full, state >> _WORD, state)
        high, low = np.divmod(state, f)
        state = np.where(on, (high << _SHIFT) + low + c, state)
    every = np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)
    owned = np.concatenate(owners)[::-1] if owners else np.zeros(0, np.int64)
    order = np.argsort(owned, kind="stable")
    edges = np.searchsorted(owned[order], np.arange(blocks + 1))
    every = every[order]
    return state, [every[a:b] for a, b in zip(edges, edges[1:])]


def decode_blocks(sizes: np.ndarray, states: np.ndarray, words: list[np.ndarray], table: FrequencyTable) -> list[np.ndarray]:
    """The ids of the given blocks, all decoded in step."""
    if not len(sizes):
        return []
    slots = np.repeat(np.arange(len(table.symbols)), table.frequencies)
    frequency, start = table.frequencies.astype(np.uint64), table.starts()
    stream = np.concatenate([*words, np.zeros(1, np.uint32)]).astype(np.uint64)
    at = np.r_[0, np.cumsum([len(w) for w in words])[:-1]].astype(np.int64)
    steps = -(-int(max(sizes)) // LANES)
    state = states.astype(np.uint64).copy()
    out = np.zeros((len(sizes), steps, LANES), np.uint32)
    mask = np.uint64((1 << SCALE_BITS) - 1)
    for step in range(steps):
        on = step * LANES + np.arange(LANES)[None, :] < sizes[:, None]
        slot = state & mask
        which = slots[slot.astype(np.int64)]
        out[:, step] = table.symbols[which]
        after = frequency[which] * (state >> _SHIFT) + slot - start[which]
        empty = on & (after < _LOW)
        taken = np.cumsum(empty, axis=1)
        place = np.where(empty, at[:, None] + taken - 1, len(stream) - 1)
        state = np.where(on, np.where(empty, (after << _WORD) | stream[place], after), state)
        at = at + taken[:, -1]
    return [block.reshape(-1)[:size] for block, size in zip(out, sizes)]


def _crc(data: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(data, "<u4").tobytes())


def pack_segment(doc_ids: list[int | None], lengths: list[int] | np.ndarray, ids: np.ndarray) -> bytes:
    table = FrequencyTable.of(ids)
    state, words = encode_blocks(ids, table)
    head = struct.pack(_HEADER, _MAGIC, len(table.symbols), len(words), len(doc_ids), len(ids))
    blocks = np.array([(len(w), _crc(w), _crc(ids[k * BLOCK_IDS : (k + 1) * BLOCK_IDS])) for k, w in enumerate(words)], "<u4")
    body = [
        table.symbols.astype("<u4"), table.frequencies.astype("<u4"),
        np.array([d is None for d in doc_ids], np.uint8), np.array([d or 0 for d in doc_ids], "<i8"),
        np.array(lengths, "<u8"), blocks, state.astype("<u8"), *[w.astype("<u4") for w in words],
    ]
    return head + b"".join(part.tobytes() for part in body)


@dataclass
class Segment:
    """A payload whose directory is read; blocks are decoded on demand."""

    doc_ids: list[int | None]
    lengths: np.ndarray
    n_ids: int
    table: FrequencyTable
    directory: np.ndarray
    states: np.ndarray
    words: np.ndarray

    @classmethod
    def read(cls, payload: bytes) -> Segment:
        magic, n_symbols, n_blocks, n_docs, n_ids = struct.unpack_from(_HEADER, payload)
        if magic != _MAGIC:
            raise ValueError("not a token segment")
        at = struct.calcsize(_HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(payload, kind, n, at)
            at += found.nbytes
            return found

        table = FrequencyTable(take("<u4", n_symbols), take("<u4", n_symbols))
        null, doc_ids, lengths = take("u1", n_docs), take("<i8", n_docs), take("<u8", n_docs).astype(np.int64)
        directory = take("<u4", 3 * n_blocks).reshape(n_blocks, 3)
        states = take("<u8", LANES * n_blocks).reshape(n_blocks, LANES)
        words = take("<u4", int(directory[:, 0].sum()))
        return cls([None if z else int(d) for z, d in zip(null, doc_ids)], lengths, n_ids, table, directory, states, words)

    def ids(self, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
        """Token ids of some blocks (all by default), from their checkpoints; fails where a checksum differs."""
        last = len(self.directory) if last_block is None else last_block
        edges = np.r_[0, np.cumsum(self.directory[:, 0].astype(np.int64))]
        words = [self.words[edges[k] : edges[k + 1]] for k in range(first_block, last)]
        sizes = np.minimum(BLOCK_IDS, self.n_ids - BLOCK_IDS * np.arange(first_block, last))
        for k, w in enumerate(words, first_block):
            if _crc(w) != self.directory[k, 1]:
                raise ValueError(f"block {k} is damaged")
        decoded = decode_blocks(sizes, self.states[first_block:last], words, self.table)
        for k, found in enumerate(decoded, first_block):
            if _crc(found) != self.directory[k, 2]:
                raise ValueError(f"block {k} decodes to other ids")
        return np.concatenate(decoded) if decoded else np.zeros(0, np.uint32)


def token_bytes(tokenizer) -> np.ndarray:
    """Bytes of text that each id of a byte-level tokenizer stands for: one for each character of its name, or those of an
    added token's own string."""
    widths = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for name, i in tokenizer.get_vocab(with_added_tokens=False).items():
        widths[i] = len(name)
    for i, added in tokenizer.get_added_tokens_decoder().items():
        widths[i] = len(added.content.encode())
    return widths


def words_apart(tokenizer: Tokenizer) -> bool:
    """Whether the model alone encodes words of letters behind spaces as the whole tokenizer does, however many together:
    nothing but the byte-level split comes before it, no token goes on from a letter over a space, and no added token is
    made of letters."""
    settings = json.loads(tokenizer.to_str())
    before, model = settings["pre_tokenizer"] or {}, settings["model"]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not plain or settings["normalizer"] or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return False
    if any(model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        return False
    added = [t["content"].strip() for t in settings["added_tokens"]]
    if any(a.isalpha() or not a for a in added):
        return False
    chars = byte_characters()
    space = next(c for c, b in chars.items() if b == 0x20)
    for name in model["vocab"]:
        for at in range(1, len(name) if space in name[1:] and all(c in chars for c in name) else 0):
            if name[at] == space != name[at - 1]:  # no word of letters may end like what stands before that space
                last = bytes(chars[c] for c in name[:at]).decode("utf-8", "ignore")[-1:]
                if not last or last.isalpha():
                    return False
    return True


def write_tokens(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Tokenize every text, add ``end_id`` to each, and write (part, segment, n_ids, payload) to ``path``.

    Order: ascending id, null first; rows of equal id by a hash of their text. Null texts count as empty and still get
    the end id. An empty table writes an empty one. Other columns are not read.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())  # the vocabulary's own size
    byte_names = "".join(sorted(byte_characters(), key=byte_characters().get))
    order = F.xxhash64("text")
    ordered = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).repartitionByRange("id", order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        key = hashlib.sha256(vocabulary.value.encode()).hexdigest()
        kept = worker_values()
        if ("tokenizer", key) not in kept:
            made = Tokenizer.from_str(vocabulary.value)
            made.no_truncation()
            made.no_padding()
            kept["tokenizer", key] = made, token_bytes(made), words_apart(made)
        tokenizer, widths, apart = kept["tokenizer", key]

        def split(ids: list[int], lengths: list[int]) -> list[bytes]:
            """The ids of pieces that were encoded together; the bytes of the tokens say where each piece ends."""
            ids = np.array(ids, "<u4")
            edges = (4 * np.r_[0, np.searchsorted(np.cumsum(widths[ids]), np.cumsum(lengths)) + 1]).tolist()
            packed = ids.tobytes()
            return [packed[a:b] for a, b in zip(edges, edges[1:])]

        def encode_joined(parts: list[str]) -> list[bytes]:
            ids = tokenizer.encode_batch_fast(["".join(parts)], add_special_tokens=False)[0].ids
            return split(ids, [len(p.encode("utf-8")) for p in parts])

        def encode_words(parts: list[str]) -> list[bytes]:
            """Pieces that are one word each: they need the tokenizer's model only."""
            packed = "".join(parts).encode("utf-8").decode("latin-1").translate(byte_names)
            return split([t.id for t in tokenizer.model.tokenize(packed)], [len(p.encode("utf-8")) for p in parts])

        def encode_new(new: list[str]) -> list[bytes]:
            out: list[bytes] = [b""] * len(new)

            def take(places: list[int], size: int, encode: Callable[[list[str]], list[bytes]], before: str = "") -> None:
                for at in range(0, len(places), size):
                    part = places[at : at + size]
                    for k, ids in zip(part, encode([before + new[k] for k in part])):
                        out[k] = ids[4 * len(before) :]

            words = [k for k, p in enumerate(new) if p[:1] == " " and p[1:].isalpha() and (p.isascii() or max(p) < LATIN_END)] if apart else []
            take(words, CALL_WORDS, encode_words)
            rest = sorted(set(range(len(new))).difference(words))
            groups, others = joined([new[k] for k in rest], CALL_PIECES)
            for group in groups:
                take([rest[k] for k in group], CALL_PIECES, encode_joined)
            others = [rest[k] for k in others]
            # pieces without white space at an end may stand behind line feeds, which are one token each
            bare = [k for k in others if new[k] and not new[k][0].isspace() and not new[k][-1].isspace()]
            take(bare, CALL_PIECES, encode_joined, "\n")
            take(sorted(set(others).difference(bare)), CALL_PIECES, lambda parts: [
                np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False)
            ])
            return out

        encoder = ArrayEncoder(encode_new, kept.setdefault(("memory", key), Memory()), end_id)
        part, segment = TaskContext.get().partitionId(), 0
        doc_ids, stops, coded, size = [], [], [], 0  # of the segment in work

        def flush() -> pa.RecordBatch:
            lengths = np.diff(np.concatenate([[0], *stops]))
            payload = pack_segment(doc_ids[: len(lengths)], lengths, np.concatenate(coded))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([segment], pa.int64()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                ["part", "segment", "n_ids", "payload"],
            )

        for batch in batches:
            doc_ids += batch.column("id").to_pylist()
            for ids, ends in encoder(batch.column("text")):
                while len(ends) and size + ends[-1] >= SEGMENT_IDS:  # a segment ends with the first document that fills it
                    k = int(np.searchsorted(ends, SEGMENT_IDS - size)) + 1
                    stops.append(size + ends[:k])
                    coded.append(ids[: ends[k - 1]])
                    ids, ends, size = ids[ends[k - 1] :], ends[k:] - ends[k - 1], size + int(ends[k - 1])
                    yield flush()
                    doc_ids = doc_ids[sum(map(len, stops)) :]
                    segment, stops, coded, size = segment + 1, [], [], 0
                stops.append(size + ends)
                coded.append(ids)
                size += len(ids)
        if doc_ids:
            yield flush()

    ordered.sortWithinPartitions("id", order).mapInArrow(
        encode, "part long, segment long, n_ids long, payload binary"
    ).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of every document in the files; checksums of all blocks are checked.

    ``start`` counts the ids of all documents before it.
    """
    files = spark.read.parquet(path)
    by_part = files.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each task that wrote
    before = by_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids")
    offsets = files.select("part", "segment", "n_ids").withColumn("inside", inside).join(before, "part").select(
        "part", "segment", (F.col("before") + F.col("inside")).alias("offset")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, payload in zip(*(batch.column(c) for c in ("part", "segment", "payload"))):
                found = Segment.read(payload.as_buffer())
                ids = np.ascontiguousarray(found.ids(), "<u4")
                stops = np.cumsum(found.lengths)
                starts = stops - found.lengths
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, stops)]
                n = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int64()), pa.array([segment.as_py()] * n, pa.int64()),
                     pa.array(found.doc_ids, pa.int64()), pa.array(starts), pa.array(found.lengths), pa.array(crcs, pa.int64())],
                    ["part", "segment", "id", "at", "n_tokens", "ids_crc32"],
                )

    decoded = files.select("part", "segment", "payload").mapInArrow(
        decode, "part long, segment long, id long, at long, n_tokens long, ids_crc32 long"
    )
    return decoded.join(offsets, ["part", "segment"]).select(
        F.col("id").alias(id_col), (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
