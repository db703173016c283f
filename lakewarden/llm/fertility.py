"""Quality rules on how public tokenisers cope with a text.

Each word is tokenised by public vocabularies. Per document this gives characters per token, the share of byte-fallback
tokens (one vocabulary writes characters it lacks as bytes) and the entropy of the document's tokens, as a share of the
highest entropy a text of that many tokens can have. For every language the quartiles of each measure over all
documents set a band; a document outside a band of its language is rejected. Bands are wide (``SPREAD`` quartile
distances, and never narrower than a share of the median), so they hold what a language's prose ever shows. Documents
that fail the plain rules take no part in the bands. The quartiles are approximate with a rank error of 1 / 2000; beyond
2,000 documents of a language they depend on the order in which tasks' sketches are merged, within that error.

Null language is a language of its own. A null text has no words and fails the plain rule on words. An empty table
gives an empty result; repeated rows are judged alike and all count in the quartiles; very long texts are measured whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.base import HASHES, kept_tool, map_batches, settled, slices, window_hashes

SYMBOLS = b"#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_piece", "chars_per_byte_token", "byte_share", "token_entropy")
#: Half-widths of a band: quartile distances from the median, and the least share of the median.
SPREAD, LEAST = 6.0, {"chars_per_piece": 0.2, "chars_per_byte_token": 0.2, "token_entropy": 0.15}
#: Columns of the result and of the bands; those of the same name in the input are replaced.
MADE = {*BASE, *MEASURES, "base_failed", "kept", "band_of", *(f"{m}_{side}" for m in MEASURES for side in ("low", "high"))}
#: Byte-fallback share above the language's upper quartile that is always allowed.
BYTE_MARGIN = 0.05


class Fertility:
    """Token counts of words, by a vocabulary with byte fallback and by a byte-level one."""

    def __init__(self, pieces: str, ranks: str, remember: int = 120_000):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.remember = remember
        self.known: dict[bytes, tuple[bytes, int]] = {}

    def table(self, words: set[bytes]) -> dict[bytes, tuple[bytes, int]]:
        """For each word its piece ids and its number of byte-level tokens."""
        new = list(words - self.known.keys())
        texts = [w.decode() for w in new]
        ids = self.pieces.encode(texts, num_threads=1)
        counts = map(len, map(self.bytes.encode_ordinary, texts))
        made = dict(zip(new, ((np.array(i, "<u4").tobytes(), n) for i, n in zip(ids, counts, strict=True)), strict=True))
        if len(self.known) + len(made) > self.remember:
            return self.known | made if made else self.known
        self.known.update(made)
        return self.known


def base_measures(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """The five plain counts of one text."""
    joined = b"".join(words)
    chars = len(joined) - sum(map(joined.count, CONTINUATION)) if not joined.isascii() else len(joined)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    repeated = 0
    if len(words) > 3:
        windows = window_hashes(HASHES.of(words), 3)
        _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
        often = np.flatnonzero(count[place] > 1)
        if len(often):
            covered = np.zeros(len(words), bool)
            for i in range(3):
                covered[often + i] = True
            repeated = int(covered.sum())
    return len(words), chars, sum(text.count(s) for s in SYMBOLS), len(lines) - len(set(lines)), repeated


#: Bytes of UTF-8 that continue a character.
CONTINUATION = [bytes([b]) for b in range(0x80, 0xC0)]


def measure(docs: DataFrame, pieces: str, ranks: str, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs``, with the plain counts and the token measures (null for a text without words), and the text on demand."""
    keep = [c for c in docs.columns if c != text and c not in MADE]
    schema = T.StructType(
        [
            *[docs.schema[c] for c in keep],
            *[T.StructField(c, T.LongType()) for c in BASE],
            *[T.StructField(c, T.DoubleType()) for c in MEASURES],
            *([docs.schema[text]] if keep_text else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = kept_tool(Fertility, pieces, ranks)
        for part, texts in slices(batches, "__text"):
            cut = [t.split() for t in texts]
            table = tool.table({w for words in cut for w in words})
            plain, rates = [], []
            for t, words in zip(texts, cut, strict=True):
                counts = base_measures(t, words)
                plain.append(counts)
                if not words:
                    rates.append((None,) * 4)
                    continue
                both = list(map(table.__getitem__, words))
                ids = np.frombuffer(b"".join([b[0] for b in both]), "<u4")
                tokens = np.bincount(ids)
                tokens = tokens[tokens > 0]
                n = len(ids)
                entropy = float(np.log2(n) - (tokens * np.log2(tokens)).sum() / n)
                rates.append((counts[1] / n, counts[1] / max(1, sum([b[1] for b in both])), float(tool.is_byte[ids].mean()), entropy / max(1.0, float(np.log2(n)))))
            arrays = [part.column(i) for i in range(len(keep))]
            arrays += [pa.array(c, pa.int64()) for c in zip(*plain, strict=True)]
            arrays += [pa.array(c, pa.float64()) for c in zip(*rates, strict=True)]
            arrays += [part.column(len(keep))] if keep_text else []
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_batches(docs.select(*keep, F.col(text).alias("__text")), run, schema)


def bands(measured: DataFrame, language: str = "lang") -> DataFrame:
    """One row per language with the lowest and highest allowed value of each measure."""
    quartiles = measured.filter("not base_failed").groupBy(F.col(language).alias("band_of")).agg(
        *[F.percentile_approx(m, [0.25, 0.5, 0.75], 2000).alias(m) for m in MEASURES]
    )
    out = [F.col("band_of")]
    for m in MEASURES:
        low, mid, high = (F.col(m)[i] for i in range(3))
        if m == "byte_share":
            out += [F.lit(0.0).alias(f"{m}_low"), (high + F.greatest(F.lit(BYTE_MARGIN), SPREAD * (high - low))).alias(f"{m}_high")]
        else:
            wide = F.greatest(SPREAD * (high - low), LEAST[m] * mid)
            out += [(mid - wide).alias(f"{m}_low"), (mid + wide).alias(f"{m}_high")]
    return quartiles.select(*out)


def judge(docs: DataFrame, pieces: str, ranks: str, text: str = "text", language: str = "lang", keep_text: bool = False) -> DataFrame:
    """``docs``, with the text on demand only, with counts, measures, base_failed and kept.

    base_failed: fewer than 50 words, or more than half of the words in repeated three-word windows.
    """
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    measured = settled(measure(docs, pieces, ranks, text, keep_text).withColumn("base_failed", failed))
    limits = bands(measured, language)
    # One row per language; Spark measures it and decides how to join.
    joined = measured.join(limits, measured[language].eqNullSafe(limits["band_of"]), "left")
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return joined.select(*measured.columns, kept.alias("kept"))
