"""Token counts under a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pattern that splits text before the merges of the rank file
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer(vocabulary: str, pattern: str = PATTERN):
    """A byte-level BPE from a rank file ("base64 rank" lines), made once per task."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str = "text", out: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """`df` with its text column replaced by the number of tokens of the whole text (bigint). A
    null text has no tokens, as an empty one. The vocabulary file must be readable by the
    executors."""
    rest = [c for c in df.columns if c != text]
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c != text) + f", `{out}` long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(vocabulary).encode_ordinary
        for b in batches:
            at = b.schema.get_field_index(text)
            n = [0 if t is None else len(encode(t)) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in rest], pa.array(n, pa.int64())], names=[*rest, out])

    return df.select(*rest, F.col(text)).mapInArrow(run, schema)
