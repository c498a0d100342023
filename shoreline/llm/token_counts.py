"""Exact token-length histogram with suffix sums.

Texts are encoded in the tasks that read them and only their lengths go on.  Documents
are aggregated by length (map side first), and suffix sums over the lengths answer, for
every context limit L, how many documents and tokens are at least that long and how
many tokens remain when each document is cut to L.  The sums run in two steps: within
ranges of ``width`` lengths in parallel, then over one total per range, so no task
sees more than ``width`` lengths or one row per range.

Defined cases: a null text counts as empty and has length 0; repeated rows count each;
an empty table gives no rows; columns other than the text are ignored.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialise, worker_cache
from .tokens import ChunkEncoder, tokenizer_path

WIDTH = 4096


def token_lengths(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(n_tokens) of every row, in no order."""
    with open(vocabulary or tokenizer_path(), encoding="utf-8") as f:
        vocab = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encoder = worker_cache(("encoder", zlib.crc32(vocab.value.encode())), lambda: ChunkEncoder(vocab.value))
        for b in batches:
            n = [len(c) // 4 for c in encoder.encode_many(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col)).mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """(n_tokens) -> one row per length: n_tokens, n_docs, docs_at_least,
    tokens_at_least, docs_total, tokens_total, tokens_within (what is left of all
    documents when each is cut to n_tokens), share_at_most (of the documents)."""
    hist = materialise(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
                       .withColumn("range", F.expr(f"n_tokens div {width}")), "lengths")
    tokens = F.col("n_docs") * F.col("n_tokens")
    ranges = hist.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    after = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    ranges = ranges.select("range",
                           F.coalesce(F.sum("d").over(after), zero).alias("d_after"),
                           F.coalesce(F.sum("t").over(after), zero).alias("t_after"),
                           F.sum("d").over(every).alias("docs_total"),
                           F.sum("t").over(every).alias("tokens_total"))
    inner = (Window.partitionBy("range").orderBy(F.col("n_tokens").desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = hist.join(ranges, "range").select(
        "n_tokens", "n_docs", "docs_total", "tokens_total",
        (F.sum("n_docs").over(inner) + F.col("d_after")).alias("docs_at_least"),
        (F.sum(tokens).over(inner) + F.col("t_after")).alias("tokens_at_least"))
    longer = F.col("docs_at_least") - F.col("n_docs")
    return out.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "docs_total", "tokens_total",
        (F.col("tokens_total") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("n_tokens"))
        .alias("tokens_within"),
        ((F.col("docs_total") - longer) / F.col("docs_total")).alias("share_at_most"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Documents longer than each limit and tokens left when cut to it, from the
    histogram alone (limits need not occur as lengths)."""
    cuts = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
    return (hist.select(cuts.alias("context"), "n_tokens", "n_docs").groupBy("context")
            .agg(F.sum(F.when(F.col("n_tokens") > F.col("context"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
                 F.sum(F.col("n_docs") * F.least("n_tokens", "context")).alias("tokens_within")))


def quantile(hist: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least the share ``q`` of documents does not exceed."""
    return hist.where(F.col("share_at_most") >= q).agg(F.min("n_tokens").alias("n_tokens"))
