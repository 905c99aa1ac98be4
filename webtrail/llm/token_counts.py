"""Token counts of whole texts by a public tokenizer, lengths only.

Texts are encoded by an Arrow function that returns one number for each: ids never leave the
worker's batch. Work is cut by bytes, not by rows: parts of texts are gathered until they have
``BATCH_BYTES`` and encoded in one call. A text of more than ``PART_BYTES`` characters is split
where the tokenizer cannot merge across, so its count is the sum of its parts' counts.

*Safe boundaries.* A byte-pair tokenizer only ever joins two neighbours into a piece of its
vocabulary, so no join crosses a place between two characters that stand side by side in no piece
(``Boundaries`` holds all pairs that do). Every encoded text gets a blank before it: where a part
would begin with a blank, that one is left out for it; elsewhere the blank must be a token of its
own, and is taken off the count. A long text without any safe place is encoded as it stands.

A null or empty text has no tokens. Ids may be null or repeat, repeated rows each have their
count, an empty table gives no rows, and other columns pass through whatever their names are; a
column of the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
BATCH_BYTES = 1 << 20
PART_BYTES = 1 << 14
#: How the tokenizer writes a blank.
BLANK = "▁"


def tokenizer_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Boundaries:
    """Where a text can be split, from the pieces of a vocabulary."""

    def __init__(self, pieces):
        self.pairs = {a + b for p in pieces for a, b in zip(p, p[1:])}

    def joined(self, a: str, b: str) -> bool:
        a, b = (BLANK if c == " " else c for c in (a, b))
        return a + b in self.pairs

    def cut(self, text: str, most: int) -> Iterator[tuple[str, int]]:
        """(part, tokens to take off its count); parts have about ``most`` characters."""
        at, off, n = 0, 0, len(text)
        while n - at > most:
            for k in range(at + most, n - 1):
                a, b = text[k - 1], text[k]
                if self.joined(a, b):
                    continue
                if b == " ":
                    yield text[at:k], off
                    at, off = k + 1, 0
                    break
                if not self.joined(BLANK, b):
                    yield text[at:k], off
                    at, off = k, 1
                    break
            else:
                break
        yield text[at:], off


class Counter:
    """Counts the tokens of texts with a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.boundaries = Boundaries(self.model.id_to_piece(i) for i in range(self.model.vocab_size()))

    def __call__(self, texts: pa.Array, most: int = PART_BYTES, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
        counts = np.zeros(len(texts), np.int64)
        parts, rows, size = [], [], 0

        def encode():
            found = self.model.encode(parts, num_threads=1)
            np.add.at(counts, rows, np.fromiter(map(len, found), np.int64, len(found)))

        for row, text in enumerate(texts):
            text = text.as_py()
            if not text:
                continue
            for part, off in self.boundaries.cut(text, most) if len(text) > most else ((text, 0),):
                parts.append(part)
                rows.append(row)
                counts[row] -= off
                size += len(part)
                if size >= batch_bytes:
                    encode()
                    parts, rows, size = [], [], 0
        if parts:
            encode()
        return counts


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """Loaded once in each worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def n_tokens(text: Column, path: str | None = None) -> Column:
    """Number of tokens of a text; 0 for null."""
    path = path or tokenizer_path()

    @F.arrow_udf("long")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(counter(path)(batch), pa.int64())

    return count(text)


def with_token_counts(
    docs: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    whole = F.coalesce(docs[text], F.lit(""))
    made = docs.withColumns(
        {"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": n_tokens(whole, path)}
    )
    return made.withColumn("over_limit", made["n_tokens"] > limit)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_token_counts(docs).drop("text")
