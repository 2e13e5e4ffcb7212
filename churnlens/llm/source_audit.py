"""Which terms set a source apart from its language, and how far sources of a language diverge."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.salted import SALTS, salted_join
from churnlens.llm.store import written
from churnlens.llm.text import slices, words

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
OTHER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what separates terms
HELD_COUNTS = 500_000   # distinct (group, term) counts a task holds before it hands them on
BLOCK_ROWS = 50_000    # kept counts of a block of the pair sums
BLOCK_CELLS = 1_000_000  # cells of a (terms, sources) table in memory
DOMINANCE_ROWS = 256    # terms compared at once

COUNTS = "lang string, source string, term string, n long, docs long"


def _slice_counts(part: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of every (lang, source, term) of some whole texts."""
    found = words(pc.replace_substring_regex(part.column("text"), OTHER, " "), lower=True)
    groups = pa.Table.from_batches([part.select(["lang", "source"])]).combine_chunks()
    keys = groups.group_by(["lang", "source"]).aggregate([])
    at = {key: i for i, key in enumerate(zip(keys["lang"].to_pylist(), keys["source"].to_pylist()))}
    group = np.array([at[k] for k in zip(groups["lang"].to_pylist(), groups["source"].to_pylist())], np.int64)
    size = max(len(found.vocab), 1)
    in_doc, n = np.unique(found.doc_of * size + found.codes, return_counts=True)
    in_group, place = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
    return pa.table({
        "lang": keys["lang"].take(pa.array(in_group // size)),
        "source": keys["source"].take(pa.array(in_group // size)),
        "term": found.vocab.take(pa.array(in_group % size)),
        "n": np.bincount(place, weights=n, minlength=len(in_group)).astype(np.int64),
        "docs": np.bincount(place, minlength=len(in_group)).astype(np.int64)})


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term counts of whole texts, added up per group in the task."""
    held: list[pa.Table] = []

    def added_up() -> pa.Table:
        both = pa.concat_tables(held).group_by(["lang", "source", "term"], use_threads=False)
        return both.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["lang", "source", "term", "n", "docs"])

    for part in slices(batches):
        held.append(_slice_counts(part))
        if sum(t.num_rows for t in held) >= HELD_COUNTS:
            held = [added_up()]
            if held[0].num_rows * 2 > HELD_COUNTS:   # hardly any repeats: the shuffle adds them up
                yield from held.pop().to_batches()
    if held:
        yield from added_up().to_batches()


def _probability(count: str, total: str, terms: str) -> F.Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), exact."""
    return F.expr(f"1 + (cast({SCALE} as decimal(18,0)) * cast({count} + 2 as decimal(19,0)))"
                  f" div ({total} + 2 * {terms})")


def kept_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(counts, groups) of ``documents``.

    counts: lang, source, term, n, lang_n of the terms in at least MIN_DOCS documents of their language.
    groups: every occurring lang, source with total (its n over kept terms), lang_total and terms (the
    language's number of kept terms); 0 where there are none.
    """
    clean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # one exchange by (lang, term) serves the group counts and the sums over a term's groups
    counts = (clean.mapInArrow(_term_counts, COUNTS).repartition("lang", "term")
              .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    term = Window.partitionBy("lang", "term")
    kept = written(counts.withColumn("lang_docs", F.sum("docs").over(term))
                   .withColumn("lang_n", F.sum("n").over(term)).where(f"lang_docs >= {MIN_DOCS}")
                   .select("lang", "source", "term", "n", "lang_n"), "kept-terms")
    # a term's language row is carried by the first of its sources
    sources = clean.select("lang", "source").distinct().withColumnRenamed("source", "own_source")
    totals = kept.groupBy("lang", F.col("source").alias("own_source")).agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("terms"))
    groups = (sources.join(totals, ["lang", "own_source"], "left").join(langs, "lang", "left")
              .select("lang", F.col("own_source").alias("source"),
                      *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "terms")]))
    return kept, written(groups, "groups")


def skyband(n: np.ndarray, lang_n: np.ndarray, rank: np.ndarray, k: int = TOP) -> np.ndarray:
    """Indexes of the points that fewer than ``k`` others dominate: with no lower n, no higher lang_n and a
    lower rank.

    Points come in an order that puts dominators first.  Blocks of them are compared with what earlier blocks
    retained and with each other: a point of k dominators has k retained or neighbouring ones.
    """
    order = np.lexsort((rank, lang_n, -n))
    held = np.empty(0, np.int64)
    for begin in range(0, len(order), DOMINANCE_ROWS):
        block = order[begin:begin + DOMINANCE_ROWS]
        dominators = np.zeros(len(block), np.int64)
        for start in range(0, len(held), 65536):
            before = held[start:start + 65536]
            dominators += ((lang_n[before] <= lang_n[block][:, None])
                           & (rank[before] < rank[block][:, None])).sum(axis=1)
        inside = ((lang_n[block] <= lang_n[block][:, None]) & (rank[block] < rank[block][:, None])
                  & (n[block] >= n[block][:, None]))
        held = np.concatenate((held, block[dominators + inside.sum(axis=1) < k]))
    return held


def _retained(table: pa.Table) -> pa.Table:
    """The rows of every (lang, source) group's skyband; terms rank by their UTF-8 bytes."""
    order = pc.sort_indices(table, [("lang", "ascending"), ("source", "ascending"), ("term", "ascending")])
    table = table.take(order)
    lang, source = (table.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "source"))
    n, lang_n = (table.column(c).to_numpy() for c in ("n", "lang_n"))
    edges = np.flatnonzero((np.diff(lang) != 0) | (np.diff(source) != 0)) + 1
    keep = []
    for begin, end in zip((0, *edges), (*edges, len(n))):
        keep.append(begin + skyband(n[begin:end], lang_n[begin:end], np.arange(end - begin)))
    return table.take(np.sort(np.concatenate(keep)))


def _local_skybands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's groups shrink to their skybands, then what is held so far does."""
    held: pa.Table | None = None
    for batch in batches:
        if batch.num_rows:
            new = _retained(pa.Table.from_batches([batch]))
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows >= 2 * HELD_COUNTS:
                smaller = _retained(held)
                if smaller.num_rows * 2 > held.num_rows:   # hardly dominated: hand on, the merge sees to the rest
                    yield from smaller.to_batches()
                    smaller = None
                held = smaller
    if held is not None:
        yield from _retained(held).to_batches()


def telling_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, term, value, rank: each group's TOP terms that are likelier there than in their language.

    A partition keeps, per group, the terms that fewer than TOP others dominate in group count, language count
    and UTF-8 order (a dominator is never ranked behind).  These skybands merge by salted group, then by group, and
    only the survivors are ranked by exact value.
    """
    totals = groups.select("lang", "source", "total", "lang_total", "terms")
    scored = (salted_join(kept, totals, ["lang", "source"], ["term"], "inner")
              .withColumn("p", _probability("n", "total", "terms"))
              .withColumn("q", _probability("lang_n", "lang_total", "terms")).where("p > q")
              .select("lang", "source", "term", "n", "lang_n", "p", "q"))
    schema = scored.schema
    local = scored.mapInArrow(_local_skybands, schema)
    salted = (local.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
              .mapInArrow(_local_skybands, schema))
    merged = salted.repartition("lang", "source").mapInArrow(_local_skybands, schema)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return (merged.withColumn("value", F.expr("((p - q) * (p - q)) div (p + q)"))
            .withColumn("rank", F.row_number().over(best)).where(f"rank <= {TOP}")
            .select("lang", "source", F.col("term").alias("item"), "value", "rank"))


def _pair_sums(key, kept: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of f over one block's terms for all ordered pairs of the language's sources.

    A term's probabilities in all sources are a row of a dense table, filled with each source's probability of
    count 0; blocks of rows keep that table small.
    """
    lang, block = (k.as_py() for k in key)
    groups = groups.sort_by("source")
    sources = groups.column("source").combine_chunks()
    size = len(sources)
    sums = np.zeros((size, size), np.int64)
    if kept.num_rows:
        absent = groups.column("absent").to_numpy()
        at_term = kept.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        at_source = pc.index_in(kept.column("source").combine_chunks(), value_set=sources).to_numpy()
        p = kept.column("p").to_numpy()
        order = np.argsort(at_term, kind="stable")
        at_term, at_source, p = at_term[order], at_source[order], p[order]
        step = max(1, BLOCK_CELLS // size)
        for begin in range(0, int(at_term[-1]) + 1, step):
            lo, hi = np.searchsorted(at_term, (begin, begin + step))
            table = np.tile(absent, (min(step, int(at_term[-1]) + 1 - begin), 1))
            table[at_term[lo:hi] - begin, at_source[lo:hi]] = p[lo:hi]
            for s in range(size - 1):
                own, other = table[:, s:s + 1], table[:, s + 1:]
                gap = own - other
                sums[s, s + 1:] += (gap * gap // (own + other)).sum(axis=0)
    sums += sums.T
    one, two = np.nonzero(~np.eye(size, dtype=bool) & ((sums > 0) | (block == 0)))
    return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "source": sources.take(pa.array(one)),
                     "item": sources.take(pa.array(two)), "value": pa.array(sums[one, two])})


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language by its summed divergence.

    Kept terms are dealt into blocks by hash; a block holds all sources' counts of its terms and the list of
    the language's sources, so its size does not grow with the language's vocabulary.
    """
    blocks = kept.count() // BLOCK_ROWS + 1
    absent = _probability("0", "total", "terms")
    p = salted_join(kept, groups.select("lang", "source", "total", "terms"), ["lang", "source"], ["term"], "inner")
    left = p.select("lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "source", "term",
                    _probability("n", "total", "terms").alias("p"))
    right = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
                          .alias("block"), "source",
                          F.when(F.col("terms") > 0, absent).otherwise(0).alias("absent"))
    sums = (left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block"))
            .applyInArrow(_pair_sums, "lang string, source string, item string, value long"))
    nearest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(nearest)).select("lang", "source", "item", "value", "rank"))


def source_audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank of ``documents`` (text, lang, source; other columns are ignored).

    Terms are maximal runs of ASCII letters and characters from U+0080 on, A-Z lower-cased; a language keeps those in
    at least 10 of its documents.  Every occurring group gives each kept term the probability p, in billionths,
    of its count there plus 2.  Part ``pair``: all other sources of the language by the sum of (p - q)^2 / (p + q).
    Part ``term``: the group's 10 terms furthest above the language's q.  Ties rank by UTF-8 order.

    NULL text, lang and source count as ''.  Repeated rows count again.  A language without kept terms has
    pair values of 0 and no term rows; one of a single source has neither.  An empty table gives an empty result.
    Texts are read whole; a task holds a bounded number of counts and hands them on.
    """
    kept, groups = kept_counts(docs)
    pairs = source_pairs(kept, groups).withColumn("part", F.lit("pair"))
    terms = telling_terms(kept, groups).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionAll(terms.select(columns))
