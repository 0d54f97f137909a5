"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary of the public byte-level BPE tokenizer lies; a parameter of every operator.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

#: Texts are encoded in pieces of at most about this many characters, cut before white space, so
#: that one very long text needs no more memory than many short ones.
PIECE = 1 << 16

_loaded: dict[str, object] = {}


def _tokenizer(path: str):
    """The tokenizer, once per Python worker; the tasks are parallel already, so it starts no threads."""
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        own.encode_special_tokens = True
        _loaded[path] = own
    return _loaded[path]


def _pieces(text: str) -> list[str]:
    """The text cut before single blanks that follow a letter and precede one, where no token spans the cut."""
    out, start = [], 0
    while len(text) - start > PIECE:
        end = start + PIECE
        while end > start and not (text[end] == " " and text[end - 1].isalpha() and text[end + 1 : end + 2].isalpha()):
            end -= 1
        if end == start:  # no such place: the rest of the text in one piece
            break
        out.append(text[start:end])
        start = end
    return [*out, text[start:]]


def count_tokens(docs: DataFrame, text: str, size: str = "tokens", path: str = TOKENIZER) -> DataFrame:
    """``docs`` with the number of tokens of ``text`` in place of the text; null and empty texts have 0.

    Arrow batches of whole texts go through the tokenizer in the tasks. The byte-level tokenizer
    splits before a blank and a letter anyway, so that counting long texts piece by piece is exact.
    """
    keep = [c for c in docs.columns if c != text]
    schema = docs.select(*keep).withColumn(size, F.lit(0)).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _tokenizer(path)
        for pdf in batches:
            sizes = []
            for start in range(0, len(pdf), 64):
                parts = [(_pieces(t) if isinstance(t, str) else []) for t in pdf[text].iloc[start : start + 64]]
                flat = own.encode_batch_fast([p for ps in parts for p in ps], add_special_tokens=False)
                lengths = iter([len(e) for e in flat])
                sizes += [sum(next(lengths) for _ in ps) for ps in parts]
            out = pdf[keep].copy()
            out[size] = pd.array(sizes, dtype="int32")
            yield out

    return docs.select(*keep, text).mapInPandas(run, schema)
