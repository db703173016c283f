"""BPE encoding and decoding of whole texts with a lexicon of frequent words.

The lexicon is a minimal acyclic transducer: words share prefixes and suffixes as paths of one automaton, and the
numbers on a word's arcs add up to its place in a table of ids. It is written once to the shared folder, handed to the
executors as a file and memory-mapped there, so that all Python workers of an executor share one copy. Words that it
lacks are merged exactly (``bpe.py``), so the ids never depend on what the lexicon holds.

A null or empty text has no ids: its strings are empty. Repeated rows and extra columns pass through; columns named like
an output are replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.base import kept_tool, map_batches, scratch, slices, write_bytes
from lakewarden.llm.bpe import word_bpe

#: A word is frequent if it makes up this share of the words of some slice of a few MB, so that a slice names few words.
FREQUENT = 1 / 20_000
#: Words in the lexicon at most: the most frequent ones. This bounds the file, a few MB.
LEXICON_WORDS = 65_536

OUTPUTS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def frequent_words(docs: DataFrame, text: str = "text", share: float = FREQUENT, most: int = LEXICON_WORDS) -> list[bytes]:
    """The words for a lexicon, counted over all texts.

    A word that holds ``share`` of all words holds it in some slice too. So each slice names only such words, at most
    ``1 / share`` of them, and their counts are summed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, text):
            words = Counter()
            for t in texts:
                words.update(t.split())
            least = sum(words.values()) * share
            named = [(w, n) for w, n in words.items() if n >= max(2, least)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in named], pa.binary()), pa.array([n for _, n in named], pa.int64())],
                names=["word", "n"],
            )

    counts = map_batches(docs.select(text), count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r.word) for r in counts.orderBy(F.desc("n"), "word").limit(most).collect()]


class Automaton:
    """A minimal acyclic transducer over bytes, as arrays."""

    names = ("keys", "targets", "adds", "final", "starts", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        for name in self.names:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, entries: dict[bytes, bytes]) -> Automaton:
        """From words and their ids (little-endian, 32 bits each)."""
        words = sorted(w for w in entries if w)
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

        def settle(node: list) -> int:
            """The number of the state equal to this node: equal ends are stored once."""
            key = (node[0], tuple(node[1]))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            return known[key]

        path, last = [[False, []]], b""
        for word in [*words, None]:
            shared = 0
            if word is not None:
                while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                    shared += 1
            while len(path) > shared + 1:
                done = settle(path.pop())
                path[-1][1].append((last[len(path) - 1], done))
            if word is None:
                break
            path += [[False, []] for _ in range(len(word) - shared)]
            path[-1][0] = True
            last = word
        root = settle(path[0])
        words_below = [0] * len(states)
        arcs = []
        for number, (final, out) in enumerate(states):  # an arc's target always comes before its source
            below = int(final)
            for byte, target in out:
                arcs.append((number << 8 | byte, target, below))
                below += words_below[target]
            words_below[number] = below
        arcs.sort()
        columns = list(zip(*arcs, strict=True)) if arcs else [(), (), ()]
        ids = [entries[w] for w in words]
        return cls(
            {
                "keys": np.array(columns[0], np.int64),
                "targets": np.array(columns[1], np.int32),
                "adds": np.array(columns[2], np.int32),
                "final": np.array([f for f, _ in states] + [root], np.int32),
                "starts": np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32),
                "ids": np.frombuffer(b"".join(ids), "<u4"),
            }
        )

    def find(self, words: list[bytes]) -> np.ndarray:
        """The words' places in the table of ids, -1 for a word that is not accepted; all words walk in step."""
        place = np.full(len(words), -1, np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        rows = np.flatnonzero((lengths > 0) & (lengths <= 64))
        if not len(self.keys) or not len(rows):
            return place
        width = int(lengths[rows].max())
        raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
        state = np.full(len(rows), int(self.final[-1]), np.int64)
        total = np.zeros(len(rows), np.int64)
        alive = np.arange(len(rows))
        for step in range(width):
            ended = lengths[rows[alive]] == step
            accepted = alive[ended & (self.final[state[alive]] == 1)]
            place[rows[accepted]] = total[accepted]
            alive = alive[~ended]
            keys = state[alive] << 8 | raw[alive, step]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            there = self.keys[at] == keys
            alive, at = alive[there], at[there]
            state[alive] = self.targets[at]
            total[alive] += self.adds[at]
        accepted = alive[self.final[state[alive]] == 1]
        place[rows[accepted]] = total[accepted]
        return place

    def output(self, place: int) -> bytes:
        return self.ids[self.starts[place] : self.starts[place + 1]].tobytes()

    def to_bytes(self) -> bytes:
        head = json.dumps([[n, str(self.arrays[n].dtype), len(self.arrays[n])] for n in self.names]).encode()
        parts = [len(head).to_bytes(8, "little"), head.ljust(-(-len(head) // 8) * 8)]
        for name in self.names:
            data = self.arrays[name].tobytes()
            parts.append(data.ljust(-(-len(data) // 8) * 8, b"\0"))
        return b"".join(parts)

    @classmethod
    def mapped(cls, path: str) -> Automaton:
        """Read by memory-mapping: only the pages in use are loaded, once for all processes."""
        data = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(data[:8].tobytes(), "little")
        fields, at, arrays = json.loads(data[8 : 8 + size].tobytes()), 8 + -(-size // 8) * 8, {}
        for name, dtype, count in fields:
            length = count * np.dtype(dtype).itemsize
            arrays[name] = data[at : at + length].view(dtype)
            at += -(-length // 8) * 8
        return cls(arrays)


def mapped_automaton(name: str) -> Automaton:
    return Automaton.mapped(SparkFiles.get(name))


def publish(spark, automaton: Automaton) -> str:
    """Write the automaton to the shared folder and hand it to the executors; returns the file's name there."""
    folder = scratch(spark)
    name = f"lexicon-{folder.rpartition('/')[2]}.bin"
    write_bytes(spark, f"{folder}/{name}", automaton.to_bytes())
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


class Encoder:
    """Ids of words from the mapped lexicon first, then by exact merging."""

    def __init__(self, tokenizer: str, lexicon: str):
        self.bpe, self.lexicon = word_bpe(tokenizer), kept_tool(mapped_automaton, lexicon)
        vocabulary = self.bpe.library.get_vocab_size(with_added_tokens=True)
        self.numbers = [str(i) for i in range(vocabulary)]
        self.tokens = [self.bpe.library.id_to_token(i) or "" for i in range(vocabulary)]

    def encode_new(self, words: list[bytes]) -> list[bytes]:
        places = self.lexicon.find(words)
        out = [self.lexicon.output(p) if p >= 0 else None for p in places.tolist()]
        unseen = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(unseen, self.bpe.encode_new([words[i] for i in unseen]), strict=True):
            out[i] = ids
        return out

    def ids(self, texts: list[bytes]) -> list[list[int]]:
        cut = [t.split() for t in texts]
        table = self.bpe.table({w for words in cut for w in words}, self.encode_new)
        return [np.frombuffer(b"".join(map(table.__getitem__, words)), "<u4").tolist() for words in cut]

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: tokens with a space between."""
        return " ".join(map(self.tokens.__getitem__, ids))


def encode_texts(
    docs: DataFrame, tokenizer: str, outputs: list[str], keep: list[str], text: str = "text", words: list[bytes] | None = None
) -> DataFrame:
    """Encode every whole text, and decode it again where an output asks for that.

    ``tokenizer`` is the vocabulary's file, ``outputs`` are names of ``OUTPUTS``, ``keep`` the columns to keep.
    ``words`` are those of the lexicon; by default the frequent words of ``docs``.
    """
    found = frequent_words(docs, text) if words is None else words
    bpe = word_bpe(tokenizer)
    lexicon = publish(docs.sparkSession, Automaton.build(dict(zip(found, bpe.encode_new(found), strict=True))))
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("__text"))
    fields = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*fields, *[T.StructField(f"o{i}", OUTPUTS[o]) for i, o in enumerate(outputs)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept_tool(Encoder, tokenizer, lexicon)
        make = {
            "n_tokens": len,
            "ids": lambda ids: ids,
            "decoded": coder.decode,
            "ids_sha256": lambda ids: hashlib.sha256(" ".join(map(coder.numbers.__getitem__, ids)).encode()).hexdigest(),
            "decoded_sha256": lambda ids: hashlib.sha256(coder.decode(ids).encode()).hexdigest(),
        }
        kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
        for part, texts in slices(batches, "__text"):
            encoded = coder.ids(texts)
            made = [pa.array([make[o](ids) for ids in encoded], kinds.get(o, pa.string())) for o in outputs]
            arrays = [part.column(i) for i in range(len(keep))] + made
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_batches(source, run, schema).toDF(*keep, *outputs)


def decode_ids(df: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text of a column of ids; null ids give null."""
    schema = T.StructType([*[f for f in df.schema if f.name != decoded], T.StructField(decoded, T.StringType())])
    columns = [f.name for f in schema][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = word_bpe(tokenizer).library
        for batch in batches:
            texts = [
                None if x is None else library.decode(x, skip_special_tokens=False)
                for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()
            ]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], names=schema.names)

    return map_batches(df.select(*columns), run, schema)
