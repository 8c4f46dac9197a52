"""BPE encoding and decoding through a table of distinct words.

A first pass splits all texts into the tokenizer's words and counts them: the distinct-word table. Each word of its
head is encoded once and the head is broadcast; the second pass splits the texts again and joins ids to words by
position: a document's ids are its words' ids, in order. The head is bounded (see wordtable). A word outside it is
encoded by the task that meets it, once a task as far as the memo goes: to fetch its ids from the table instead, the
documents' ids would have to be written and shuffled once more (README has the figures of that attempt).
Decoding joins ids to the vocabulary's pieces, a table of (id, piece) that is broadcast, as the vocabulary bounds it.

Written for tokenizer files of one kind (EXPECTED); any other file is refused.

Edge cases: null text is the empty text, with no ids; a null doc_id is kept; repeated rows each get their own
result; strings of special tokens in a text become those tokens, as the tokenizers library has it.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from driftfold.llm.common import column, discard, materialize, once, slices, small_batches, texts_of
from driftfold.llm.wordtable import count_words, head_of

# The vocabulary's word pattern for lower-case Latin-1 text, with its classes written out.
_LETTER, _NUMBER, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", "\\x09-\\x0d\\x20\\x85\\xa0"
LATIN_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: What the tokenizer's file must say, beside its vocabulary and special tokens.
EXPECTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "decoder": None,
}
#: Words a worker remembers: without a head, and beside one.
MEMO, TAIL_MEMO = 400_000, 50_000
#: Bytes of text that are encoded before their ids and pieces are passed on.
SLICE = 1_000_000


@cache
def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it is one, else the next from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    rest = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)]


def refuse_others(spec: str) -> None:
    """An error for a tokenizer that is not of the kind EXPECTED."""
    said = json.loads(spec)
    if {k: said.get(k) for k in EXPECTED} != EXPECTED or said["model"]["type"] != "BPE" or said["model"].get("dropout"):
        raise ValueError("this tokenizer splits, encodes or decodes words in another way than this operator does")


class Head:
    """The head of the table as bytes, sorted by the words' hashes: an object a word would take five times the memory in every worker."""

    def __init__(self, packed: bytes):
        with pa.ipc.open_stream(packed) as stream:
            table = stream.read_all()
        hashes = np.fromiter((hash(w) for batch in table.to_batches() for w in column(batch, "word").to_pylist()), np.int64, table.num_rows)
        order = np.argsort(hashes)
        self.hashes = array("q", hashes[order].tobytes())
        (self.words, self.word_at), (self.ids, self.ids_at) = (joined(table.column(c).cast(pa.large_binary()).take(order)) for c in ("word", "ids"))

    def ids_of(self, word: str) -> bytes | None:
        """The word's ids, or None for a word that is not in the head."""
        at, wanted = bisect_left(self.hashes, key := hash(word)), None
        while at < len(self.hashes) and self.hashes[at] == key:
            wanted = wanted or word.encode()
            if self.words[self.word_at[at] : self.word_at[at + 1]] == wanted:
                return self.ids[self.ids_at[at] : self.ids_at[at + 1]]
            at += 1
        return None


def joined(values: pa.ChunkedArray) -> tuple[bytes, array]:
    """All values as one, and where each begins, with the end."""
    ends = np.cumsum(np.fromiter(chain.from_iterable(pc.binary_length(c).to_numpy(zero_copy_only=False) for c in values.chunks), np.int64, len(values)))
    sink = io.BytesIO()
    for start in range(0, len(values), 10_000):
        sink.write(b"".join(values.slice(start, 10_000).to_pylist()))
    return sink.getvalue(), array("q", np.concatenate([[0], ends]).astype(np.int64).tobytes())


class WordCoder(dict):
    """Maps a word to its ids as little-endian unsigned 32-bit integers; unknown words are encoded and remembered."""

    def __init__(self, spec: str, head: Head | None = None):
        from tokenizers import Tokenizer

        super().__init__()
        refuse_others(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        self.head, self.limit = head, MEMO if head is None else TAIL_MEMO

    @property
    def pieces(self) -> list[str]:
        return [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]

    def ids_of(self, word: str) -> bytes:
        """A word's ids, neither looked up nor remembered."""
        if word in self.special:
            ids = [self.special[word]]
        else:
            ids = [t.id for t in self.tokenizer.model.tokenize("".join([self.letters[b] for b in word.encode()]))]
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        out = self.head.ids_of(word) if self.head else None
        if out is None:
            out = self.ids_of(word)
        if len(self) < self.limit:
            self[word] = out
        return out

    def words(self, text: str) -> list[str]:
        """The text's words after normalisation; Latin-1 text needs no library call."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any_words(text)
        return self.any_words(text) if "<|" in text else LATIN_WORD.findall(text.lower())

    def any_words(self, text: str) -> list[str]:
        out = []
        for part in self.special_split.split(text) if self.special_split else [text]:
            if part in self.special:
                out.append(part)
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                out += [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.words(text)))


def coder(spec: str) -> WordCoder:
    """One a worker process and vocabulary, without a head."""
    return once(hashlib.md5(spec.encode()).hexdigest(), lambda: WordCoder(spec))


def packed(head: pa.Table) -> bytes:
    """The head as a compressed Arrow stream in small batches: workers keep what was broadcast beside what they make of it."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, head.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(head, max_chunksize=10_000)
    return sink.getvalue().to_pybytes()


def headed_coder(key: str, spec: Broadcast, head: Broadcast) -> WordCoder:
    """One a worker process for each head, which the key names."""

    def make() -> WordCoder:
        return WordCoder(spec.value, Head(head.value))

    return once(key, make)


def read_spec(path: str) -> str:
    """The tokenizer's file, read on the driver and sent with the job: workers need no copy of it."""
    return Path(path).read_text()


def distinct_words(docs: DataFrame, spec: Broadcast) -> DataFrame:
    """(word, n): the words of all texts."""

    def splitter() -> Callable[[str], list[str]]:
        return coder(spec.value).words

    return count_words(docs, splitter).select("word", "n")


def encoded_head(docs: DataFrame, spec: Broadcast) -> Broadcast:
    """The head of the distinct-word table, each word encoded once, as a packed table (word, ids)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(spec.value)
        for batch in batches:
            ids = pa.array([code.ids_of(w) for w in column(batch, "word").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([column(batch, "word"), ids], names=["word", "ids"])

    counted = materialize(distinct_words(docs, spec), "distinct")
    head = head_of(counted).select("word").mapInArrow(encode, "word string, ids binary").toArrow()
    discard(counted)
    return docs.sparkSession.sparkContext.broadcast(packed(head))


def piece_table(spark: SparkSession, spec: str) -> DataFrame:
    """(id, piece): what each id decodes to; as many rows as the vocabulary has."""
    return spark.createDataFrame(pa.table({"id": pa.array(range(len(pieces := coder(spec).pieces)), pa.int64()), "piece": pieces}))


def joined_ids(docs: DataFrame, path: str, text: str, finish: Callable[[pa.RecordBatch, list[bytes], list[str]], pa.RecordBatch], made: StructType) -> DataFrame:
    """What finish(batch, ids, decoded texts) makes of docs; `made` is its schema."""
    docs = small_batches(docs)
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(path))
    head = encoded_head(docs.select(F.col(f"`{text}`").alias("text")), spec)
    pieces = spark.sparkContext.broadcast(piece_table(spark, spec.value).orderBy("id").select("piece").toArrow())
    key = uuid.uuid4().hex

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = headed_coder(key, spec, head)
        piece_of = once(key + "pieces", lambda: pieces.value.column("piece").to_pylist()).__getitem__
        for batch in slices(batches, text, SLICE):
            ids = [code.encode(x) for x in texts_of(batch, text)]
            yield finish(batch, ids, [" ".join(map(piece_of, np.frombuffer(x, "<u4").tolist())) for x in ids])

    return docs.mapInArrow(join, made)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with ids (binary, little-endian unsigned 32-bit) and decoded; columns of those names are replaced."""
    docs = docs.drop("ids", "decoded")

    def finish(batch: pa.RecordBatch, ids: list[bytes], decoded: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], names=[*batch.schema.names, "ids", "decoded"])

    return joined_ids(docs, path, text, finish, StructType([*docs.schema.fields, StructField("ids", BinaryType()), StructField("decoded", StringType())]))


def bpe_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text, hashed where they are made so that neither leaves the task."""

    def finish(batch: pa.RecordBatch, ids: list[bytes], decoded: list[str]) -> pa.RecordBatch:
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        shas = [pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string()) for xs in (ids, map(str.encode, decoded))]
        return pa.RecordBatch.from_arrays([column(batch, "doc_id"), counts, *shas], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    made = StructType([docs.schema["doc_id"], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    return joined_ids(docs.select("doc_id", "text"), path, "text", finish, made)
