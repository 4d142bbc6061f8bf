"""Byte-level BPE through a lexicon of the corpus's frequent words; other words are merged exactly."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from tunequorum.llm.lexicon import Lexicon, build
from tunequorum.llm.pieces import CHUNK_CHARS, PieceEncoder, worker_memory
from tunequorum.runtime import durable

#: Fixed value: how a byte-level tokenizer of this family splits text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The lexicon holds at most so many words (the most frequent) of at most so many bytes.
LEXICON_WORDS = 1 << 16
WORD_BYTES = 40
#: Length up to which merging scans all pairs.
SCAN = 48
_NONE = 1 << 63


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """What encoding needs of a byte-level BPE file in the tokenizers library's JSON format."""

    def __init__(self, content: str):
        data = json.loads(content)
        model, before = data["model"], data["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if model["type"] != "BPE" or not plain or data["normalizer"] or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE without normalizer and prefix space is supported")
        chars = byte_characters()
        ids = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items()}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.bytes_of = {i: token for token, i in ids.items()}
        self.merges: dict[tuple[int, int], int] = {}  # rank above the joined id in one number
        for rank, pair in enumerate(model["merges"]):
            left, right = (bytes(chars[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges[ids[left], ids[right]] = rank << 32 | ids[left + right]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or " " in t["content"] for t in data["added_tokens"]):
            raise ValueError("only plain added tokens without spaces are supported")
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}

    def byte_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all ids one behind the other, where each id's bytes start, how many they are)."""
        names = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        widths = np.array([len(n) for n in names], np.int64)
        return np.frombuffer(b"".join(names), np.uint8), np.cumsum(widths) - widths, widths

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the pair of the lowest rank, the leftmost first, is joined until none is left."""
        ids = [self.byte_ids[b] for b in word]
        return self._scan(ids) if len(ids) <= SCAN else self._queue(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        ranks = [get(pair, _NONE) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < _NONE:
            k = ranks.index(best)
            ids[k : k + 2] = [best & 0xFFFFFFFF]
            del ranks[k]
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), _NONE)
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), _NONE)
        return ids

    def _queue(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs over a linked list, for long words."""
        n, merges = len(ids), self.merges
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] >= 0 and (found := merges.get((ids[k], ids[after[k]]))):
                heapq.heappush(heap, (found, k, ids[k], ids[after[k]]))

        for k in range(n - 1):
            offer(k)
        while heap:
            found, k, left, right = heapq.heappop(heap)
            other = after[k]
            if ids[k] != left or other < 0 or ids[other] != right:
                continue  # one of the two has changed since
            ids[k], ids[other] = found & 0xFFFFFFFF, -1
            after[k] = after[other]
            if after[k] >= 0:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [i for i in ids if i >= 0]


def _special_pattern(special: dict[str, int]) -> regex.Pattern | None:
    return regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None


def split_words(text: str, word: regex.Pattern, special: regex.Pattern | None) -> list[str]:
    """Words of a piece; a special token is a word of its own."""
    if special is None or not special.search(text):
        return word.findall(text)
    parts = special.split(text)
    return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else word.findall(part))]


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word: binary, n) over all texts, for words of at most WORD_BYTES bytes.

    Texts are cut at single spaces and equal pieces counted first, so that each different piece is split into words once
    for all its places.
    """
    cut = F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), " ", -1)).alias("at", "piece")
    each = docs.select(cut).select(F.when(F.col("at") > 0, F.concat(F.lit(" "), F.col("piece"))).otherwise(F.col("piece")).alias("piece"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = regex.compile(WORD)
        for batch in batches:
            words: Counter = Counter()
            for piece, n in zip(batch.column("piece").to_pylist(), batch.column("n").to_pylist()):
                for w in word.findall(piece):
                    words[w] += n
            short = [(b, n) for w, n in words.items() if len(b := w.encode("utf-8", "surrogatepass")) <= WORD_BYTES]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in short], pa.binary()), pa.array([n for _, n in short], pa.int64())], ["word", "n"]
            )

    counted = each.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).mapInArrow(split, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int) -> list[bytes]:
    """The most frequent words, at most ``limit``: all whose count reaches the least power-of-two-like bound that few
    enough reach, so no sort of all words is needed."""
    step = F.floor(8 * F.log2("n")).cast("long")
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()  # 8 rows a doubling
    total, bound = 0, None
    for row in sorted(steps, key=lambda r: -r.step):
        total += row.words
        if total > limit:
            break
        bound = row.step
    return [] if bound is None else [bytes(r.word) for r in counts.where(step >= bound).select("word").collect()]


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", limit: int = LEXICON_WORDS) -> bytes:
    words = frequent_words(durable(word_counts(docs, text_col)), limit)
    return build((w, vocabulary.merge(w)) for w in words)


def _distributed(spark: SparkSession, data: bytes) -> str:
    """Name of a file that every executor gets once and each of its workers can map."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(os.path.realpath(tempfile.gettempdir()), name)
    with open(path, "wb") as f:
        f.write(data)
    spark.sparkContext.addFile(path)
    return name


def _rows(doc_ids: list, coded: list[bytes], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(coded, pa.binary()), pa.array(texts, pa.string())], ["id", "ids", "decoded"]
    )


def encode_decode(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LEXICON_WORDS
) -> DataFrame:
    """(id_col, ids: binary of little-endian unsigned 32-bit token ids, decoded): one row for each row of ``docs``.

    The ids are those of the tokenizers library without added special tokens; a special token's own string in a text
    gets its id. Null and empty texts have no ids. The lexicon is learned from all texts of ``docs``; it has no effect
    on the ids.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # the vocabulary's own size
    lexicon_file = _distributed(spark, build_lexicon(docs, Vocabulary(shared.value), text_col, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, lexicon = Vocabulary(shared.value), Lexicon(SparkFiles.get(lexicon_file))
        word, special = regex.compile(WORD), _special_pattern(vocabulary.special)

        def encode_new(new: list[str]) -> list[bytes]:
            split = [split_words(p, word, special) for p in new]
            distinct = list(set().union(*split))
            packed = {}
            for w, n in zip(distinct, lexicon.numbers([w.encode("utf-8") for w in distinct]).tolist()):
                if w in vocabulary.special:
                    packed[w] = np.array([vocabulary.special[w]], "<u4").tobytes()
                else:
                    packed[w] = lexicon.packed_ids(n) if n >= 0 else np.array(vocabulary.merge(w.encode("utf-8")), "<u4").tobytes()
            return [b"".join(map(packed.__getitem__, words)) for words in split]

        encoder = PieceEncoder(encode_new, worker_memory("merged " + hashlib.sha256(shared.value.encode()).hexdigest()))
        table, starts, widths = vocabulary.byte_table()
        for batch in batches:
            doc_ids, coded, texts, size = [], [], [], 0
            for doc_id, ids in zip(batch.column("id").to_pylist(), encoder(t.as_py() for t in batch.column("text"))):
                found = np.frombuffer(ids, "<u4")
                size_of = widths[found]
                stops = np.cumsum(size_of)
                # every id's bytes, gathered from one table
                decoded = table[np.repeat(starts[found] - stops + size_of, size_of) + np.arange(stops[-1] if len(stops) else 0)].tobytes()
                doc_ids.append(doc_id)
                coded.append(ids)
                texts.append(decoded.decode("utf-8", "replace"))
                size += len(decoded)
                if size >= CHUNK_CHARS:
                    yield _rows(doc_ids, coded, texts)
                    doc_ids, coded, texts, size = [], [], [], 0
            yield _rows(doc_ids, coded, texts)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, ids binary, decoded string"
    ).withColumnRenamed("id", id_col)
