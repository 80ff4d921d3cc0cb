"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts are gathered into batches of about equal bytes, so a task's memory does
not follow the number of rows a batch happens to hold. A long text is split
where a run of white space follows another character: the pre-tokeniser of a
byte-level vocabulary always starts a new token there, and no special string
holds white space, so the counts of the parts add up to the count of the whole.

Edge cases: a null text counts as empty (0 tokens, 0 bytes); a text without any
safe boundary is encoded in one piece; repeated rows give repeated results;
columns other than the key and the text are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Bytes of text that are encoded at once, and the length in characters from which a text is split.
BATCH_BYTES, LONG_CHARS = 1 << 20, 1 << 16
_SAFE = re.compile(r"(?<=\S)(?=\s)")


def safe_parts(text: str, most: int = LONG_CHARS) -> Iterator[str]:
    """text in parts of ``most`` characters or, where no safe boundary comes sooner, more."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def splits_safely(path: str) -> bool:
    """Whether the vocabulary's own description lets texts be split by safe_parts(): byte-level pre-tokens by the usual
    pattern, nothing normalised or put before a text, and no added string that holds or swallows white space."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    cut = whole.get("pre_tokenizer") or {}
    own = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
    added = whole.get("added_tokens") or []
    return own and not whole.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)


@cache
def _counter(path: str):
    """The function that gives the lengths of encoded texts, and whether long texts may be split; one for each worker process."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), False
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return (lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]), splits_safely(path)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 512, split_long: bool | None = None) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of docs; over_limit where n_tokens > limit.

    split_long: whether the vocabulary allows safe_parts(); by default its file
    tells, as splits_safely() reads it.
    """

    def lengths(batches):
        count, splits = _counter(path)
        splits = splits if split_long is None else split_long
        for b in batches:
            texts, sizes = b.column(1).to_pylist(), b.column(2).to_pylist()
            total, part_of, parts, size = [0] * len(texts), [], [], 0

            def flush():
                for i, n in zip(part_of, count(parts), strict=True):
                    total[i] += n
                part_of.clear()
                parts.clear()

            for i, t in enumerate(texts):
                whole = not splits or len(t) <= LONG_CHARS
                for part in (t,) if whole else safe_parts(t):
                    parts.append(part)
                    part_of.append(i)
                    size += sizes[i] if whole else len(part.encode())
                    if size >= BATCH_BYTES:
                        flush()
                        size = 0
            flush()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(total, type=pa.int64())], names=["k", "n_bytes", "n_tokens"])

    rows = text_of(docs, key, text=text)
    kind = rows.schema[key].dataType.simpleString()
    counted = rows.withColumn("n_bytes", F.octet_length(text).cast("long")).mapInArrow(lengths, f"k {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
