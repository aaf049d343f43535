"""Token counts under a public tokenizer, whose vocabulary file is a parameter and stays where it is."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files on every executor, and the file to use.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how text is split before merges by the vocabularies that are lists of ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def counter(path: str) -> Callable[[str], int]:
    """Counts the tokens of a text; lists of ranks (.tiktoken), tokenizer files (.json) and models (.model)."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        t = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda s: len(t.encode_ordinary(s))
    if path.endswith(".model"):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda s: len(m.encode(s, num_threads=1))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on each core already
    from tokenizers import Tokenizer

    j = Tokenizer.from_file(path)
    j.encode_special_tokens = True
    return lambda s: len(j.encode(s, add_special_tokens=False).ids)


def with_tokens(df: DataFrame, keep: list[str], text: str = "text", path: str = f"{FOLDER}/{VOCABULARY}") -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` of each row's whole text; null and empty texts have 0."""
    cols = df.select(*keep, F.col(text).alias("_text"))
    names = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for b in batches:
            out = b[names].copy()
            out["n_tokens"] = [count(x) if isinstance(x, str) and x else 0 for x in b["_text"]]
            yield out

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens long"
    return cols.mapInPandas(run, schema)
