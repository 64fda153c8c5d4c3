"""Token counts: whole texts encoded in Arrow batches, of which only the lengths come back.

Batches for the encoder are balanced by bytes. Texts beyond a batch are cut at safe boundaries, where the
byte-level pre-tokenizer always starts a new piece, whatever stands before and behind:

* before white space that follows a character other than white space;
* before full-width punctuation that follows a Chinese or Japanese character or a Korean syllable, as runs of
  letters end where punctuation starts.

Merges never cross pieces, so the counts of the parts add up to the count of the whole text. Both rules hold for the
byte-level pattern without a normalizer, and for special strings without such a boundary inside that take no white
space behind them along. This is looked up in the tokenizer's file; with another tokenizer texts are never cut.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import map_batches, texts

BATCH_BYTES = 1 << 18
# Both classes of letters and the punctuation are what every version of Unicode calls so.
SAFE = re.compile(
    r"(?<=\S)[ \t\n\r]|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f]"
)


@lru_cache(maxsize=2)
def load_tokenizer(path: str):
    """The tokenizer of a file, once a process; it encodes on the task's own thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=2)
def can_cut(path: str) -> bool:
    """Whether the safe boundaries are safe with the tokenizer of a file."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    first = found.get("pre_tokenizer") or {}
    plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
    special = found.get("added_tokens") or []
    whole = not any(SAFE.search(token["content"]) or token.get("rstrip") for token in special)
    return bool(plain and whole and not found.get("normalizer"))


def n_bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def safe_parts(text: str, most: int = BATCH_BYTES) -> Iterator[str]:
    """Parts of ``text`` of about ``most`` bytes, cut at safe boundaries.

    A stretch without any such boundary stays whole, whatever its length.
    """
    start, total = 0, n_bytes(text)
    step = max(1, most * len(text) // max(total, 1))  # characters that have about so many bytes
    while len(text) - start > step:
        cut = SAFE.search(text, start + step)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _balanced(parts: Iterator[tuple[int, str]], most: int) -> Iterator[list[tuple[int, str]]]:
    group, size = [], 0
    for row, part in parts:
        group.append((row, part))
        size += n_bytes(part)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row.

    Null and empty texts have no bytes and no tokens. Special strings inside texts count as the
    tokenizer's default has it; nothing is added, cut or padded. Repeated rows are counted each;
    a null doc_id is carried. Columns other than doc_id and text are not looked at.
    """

    def work(batch: pa.RecordBatch):
        tokenizer = load_tokenizer(tokenizer_path)
        cut = can_cut(tokenizer_path)
        counts = np.zeros(batch.num_rows, dtype=np.int64)
        sizes = np.zeros(batch.num_rows, dtype=np.int64)

        def parts():
            for row, value in enumerate(batch.column("text")):
                text = value.as_py()
                if text:
                    sizes[row] = value.as_buffer().size
                    for part in safe_parts(text, batch_bytes) if cut else [text]:
                        yield row, part

        for group in _balanced(parts(), batch_bytes):
            encoded = tokenizer.encode_batch_fast([part for _, part in group], add_special_tokens=False)
            for (row, _), tokens in zip(group, encoded, strict=True):
                counts[row] += len(tokens)
        yield {"doc_id": batch.column("doc_id"), "n_bytes": sizes, "n_tokens": counts}

    counted = map_batches(texts(docs), "doc_id long, n_bytes long, n_tokens long", work)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
