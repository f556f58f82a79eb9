"""Token counts: an exact histogram of encoded lengths and its suffix sums.

Documents are encoded once and counted by length; the histogram alone then gives
totals, quantiles and, for every context limit, the tokens left after truncation.
Each task counts its own documents first, so the shuffle carries one row for each
length and task.

Defined results: a null or empty text has 0 tokens and is counted as such; special
tokens' strings are ordinary text; texts of any length are encoded whole, runs of white
space of any length included; rows that repeat are counted as often as they come; ids
are not looked at but passed on, null ones too; other columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ._store import Workspace
from ._text import pieces, utf8

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: how the byte-level vocabulary cuts texts before merging (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: what \s takes in that pattern (fixed values)
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: a run of white space from this length on is cut from its text; the encoder's matcher can't take very long ones
RUN = 1024
_LONG_RUN = re.compile(f"[{WHITE}]{{{RUN},}}")
#: lengths of a bucket of the two-level suffix sums
BUCKET = 1024


def cut_at_runs(text: str) -> Iterator[tuple[str, bool]]:
    """Parts of a text that encode one by one as they do together, and whether a part is one piece.

    The pattern makes one piece of a run of white space: the whole run where the text
    ends with it, else all of it but the last character, which goes to what follows.
    """
    at = 0
    for run in _LONG_RUN.finditer(text):
        to = run.end() if run.end() == len(text) else run.end() - 1
        yield text[at:run.start()], False
        yield text[run.start():to], True
        at = to
    yield text[at:], False


def bpe_lengths(path: str = TOKENIZER, pattern: str = PATTERN) -> Callable[[list[str]], list[int]]:
    """Encoded lengths under a byte-level vocabulary, loaded where it is called."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    piece = tiktoken.Encoding("piece", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    whole = lambda t: len(encoding.encode_ordinary(t))
    if pattern != PATTERN:  # another pattern may cut white space otherwise
        return lambda texts: list(map(whole, texts))

    def length(text: str) -> int:
        if len(text) < RUN or not _LONG_RUN.search(text):
            return whole(text)
        return sum(len(piece.encode_ordinary(part)) if one else whole(part) for part, one in cut_at_runs(text) if part)

    return lambda texts: list(map(length, texts))


def document_lengths(docs: DataFrame, id_col: str, text_col: str, encoder: Callable = bpe_lengths) -> DataFrame:
    """(id, n_tokens) of each document; ``encoder()`` is called once a task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = None
        for b in batches:
            lengths = lengths or encoder()
            for ids, texts in pieces(b.columns, 1):
                yield pa.RecordBatch.from_arrays([ids, pa.array(lengths(utf8(texts).to_pylist()), pa.int64())], names=["id", "n_tokens"])

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(encode, "id long, n_tokens long")


def length_histogram(docs: DataFrame, text_col: str = "text", encoder: Callable = bpe_lengths) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, seen = None, Counter()
        for b in batches:
            lengths = lengths or encoder()
            for (texts,) in pieces(b.columns, 0):
                seen.update(lengths(utf8(texts).to_pylist()))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["n_tokens", "n_docs"])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(count, "n_tokens long, n_docs long").groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(spark: SparkSession, histogram: DataFrame) -> DataFrame:
    """For each length: documents and tokens from it on, the total at that limit, and its quantile.

    Sums are taken within buckets of lengths and over the buckets, so no task
    orders more than the lengths of one bucket or one row for each bucket.
    """
    ws = Workspace(spark, "token-counts")
    h = ws.put(histogram.withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET)), "histogram")
    tokens = F.col("n_docs") * F.col("n_tokens")
    buckets = h.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    over = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    after = buckets.select("bucket", F.coalesce(F.sum("d").over(over), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t_after"))
    total = buckets.agg(F.sum("d"), F.sum("t")).first()
    inside = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = h.join(after, "bucket").select(
        "n_tokens", "n_docs",
        (F.sum("n_docs").over(inside) + F.col("d_after")).alias("docs_from"),
        (F.sum(tokens).over(inside) + F.col("t_after")).alias("tokens_from"),
    )
    docs, all_tokens = F.lit(total[0] or 0).cast("long"), F.lit(total[1] or 0).cast("long")
    return out.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from",
        (all_tokens - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_total"),
        (docs - F.col("docs_from") + F.col("n_docs")).alias("docs_upto"),
        docs.alias("docs_total"), all_tokens.alias("tokens_total"),
    )


def truncated_total(sums: DataFrame, limit: int) -> int:
    """Tokens of all documents when each is cut at ``limit``, for any limit."""
    row = sums.filter(F.col("n_tokens") >= limit).orderBy("n_tokens").select("docs_from", "tokens_from", "tokens_total").first()
    if row is None:
        found = sums.select("tokens_total").first()
        return found[0] if found else 0
    return row["tokens_total"] - row["tokens_from"] + limit * row["docs_from"]


def quantile(sums: DataFrame, q: float) -> int | None:
    """The smallest length that at least a share q of documents don't exceed."""
    row = sums.filter(F.col("docs_upto") >= F.ceil(F.lit(float(np.clip(q, 0, 1))) * F.col("docs_total"))).agg(F.min("n_tokens")).first()
    return row[0]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix sums over the lengths of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return suffix_sums(spark, length_histogram(docs))


SQL = None
