"""Token counts: the exact length histogram of a corpus, and what it answers."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.store import written
from churnlens.llm.text import slices

BLOCK = 256  # lengths of a block: sums run over blocks first, then inside them


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_lengths(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens of every whole text; NULL and empty texts have 0 tokens.

    ``path`` is a rank file (base64 token, rank) that every executor can read. One row
    per input row; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _encoding(path, pattern).encode_ordinary
        for part in slices(batches):
            n = [len(count(t)) if t else 0 for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct n_tokens, with suffix sums over the longer documents.

    docs, tokens: of this length; docs_longer, tokens_longer: of greater lengths;
    truncated_tokens: what remains of the corpus when every document is cut to this
    length; docs_share: share of documents of at most this length (the quantile's
    level).  Between two lengths L < L' a limit c keeps truncated_tokens(L) +
    (c - L) * docs_longer(L), so the rows answer every limit.  An empty table gives no row.

    Documents are counted per length before the shuffle, so a length of a third of
    all documents is one row per task; the counts are written, so the texts are encoded
    once.  The unpartitioned window sees one row per 256 lengths.
    """
    counts = written(lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))
                     .withColumn("tokens", F.col("n_tokens") * F.col("docs"))
                     .withColumn("block", F.floor(F.col("n_tokens") / BLOCK)), "lengths")
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = (counts.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
              .select("block", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
                      F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
                      F.sum("d").over(everything).alias("all_docs"), F.sum("t").over(everything).alias("all_tokens")))
    longer = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    docs_longer = F.col("docs_above") + F.coalesce(F.sum("docs").over(longer), F.lit(0))
    tokens_longer = F.col("tokens_above") + F.coalesce(F.sum("tokens").over(longer), F.lit(0))
    return (counts.join(blocks, "block")
            .withColumn("docs_longer", docs_longer).withColumn("tokens_longer", tokens_longer)
            .select("n_tokens", "docs", "tokens", "docs_longer", "tokens_longer",
                    (F.col("all_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer"))
                    .alias("truncated_tokens"),
                    F.round(1 - F.col("docs_longer") / F.col("all_docs"), 9).alias("docs_share")))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_cut, tokens_kept, tokens_lost for any context limits, in one pass over the histogram."""
    each = histogram.select("n_tokens", "docs", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
                            .alias("limit"))
    kept = F.least("n_tokens", "limit") * F.col("docs")
    return each.groupBy("limit").agg(
        F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("docs")).otherwise(0)).alias("docs_cut"),
        F.sum(kept).alias("tokens_kept"), F.sum(F.col("n_tokens") * F.col("docs") - kept).alias("tokens_lost"))


def quantiles(histogram: DataFrame, levels: list[float]) -> DataFrame:
    """level, n_tokens: the smallest length that at least this share of the documents does not exceed."""
    each = histogram.select("n_tokens", "docs_share", F.explode(F.array(*[F.lit(float(x)) for x in levels])).alias("level"))
    return each.where("docs_share >= level - 1e-9").groupBy("level").agg(F.min("n_tokens").alias("n_tokens"))
