"""TF-IDF vectors, exact cosine candidates above a threshold or without one, and tiers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alinea.functions.text import round_at, tokens
from alinea.workspace import materialize


def term_counts(docs: DataFrame, doc_id: str, text: str, block: str | None = None) -> DataFrame:
    """(block, doc_id, term, n): words and pairs of neighbouring words of each text."""
    words = docs.select((F.col(block) if block else F.lit("all")).alias("block"), F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("w"))
    # Neighbours are paired array against array, so that the words are worked out once per text.
    left, right = F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0)))
    pairs = F.zip_with(left, right, lambda a, b: F.concat_ws(" ", a, b))
    return words.select("block", "doc_id", F.explode(F.concat("w", pairs)).alias("term")).groupBy("block", "doc_id", "term").agg(F.count("*").alias("n"))


def tfidf(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, block, doc_id, term, df, weight) of two corpora in one vocabulary, each text of length 1.

    tf = 1 + ln(count), idf = ln((1 + texts) / (1 + texts with the term)) + 1, both corpora together.
    Texts without words have no vector.
    """
    both = materialize(left.withColumn("side", F.lit("l")).unionByName(right.withColumn("side", F.lit("r"))), "terms")
    total = both.select("side", "doc_id").distinct().count()
    df = both.select("side", "doc_id", "term").distinct().groupBy("term").agg(F.count("*").alias("df"))
    idf = materialize(df.withColumn("idf", F.log(F.lit(1.0 + total) / (1.0 + F.col("df"))) + 1.0), "idf")
    if idf.count() <= 200_000:  # else the texts' terms are shuffled once more
        idf = F.broadcast(idf)
    raw = both.join(idf, "term").withColumn("raw", (1.0 + F.log(F.col("n").cast("double"))) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("side", "block", "doc_id")))
    return raw.select("side", "block", "doc_id", "term", "df", (F.col("raw") / norm).alias("weight"))


def _prefix(vectors: DataFrame, least: float, name: str) -> DataFrame:
    """The rarest terms of each text, until what is left has a length below half of ``least``.

    ``tail`` is the length of that rest, ``last`` the place in the common order where the prefix ends.
    """
    w = Window.partitionBy("block", "doc_id").orderBy("df", "term")
    from_here = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(w.rowsBetween(0, Window.unboundedFollowing)))
    v = vectors.withColumn("from_here", from_here).withColumn("kept", F.col("from_here") >= least / 2)
    whole = Window.partitionBy("block", "doc_id")
    tail = F.coalesce(F.max(F.when(~F.col("kept"), F.col("from_here"))).over(whole), F.lit(0.0))
    last = F.max(F.when(F.col("kept"), F.struct("df", "term"))).over(whole)
    v = v.withColumn("tail", tail).withColumn("last", last).filter("kept")
    return v.select("block", "term", F.col("doc_id").alias(f"{name}_id"), F.col("weight").alias(f"{name}_weight"), F.col("tail").alias(f"{name}_tail"), F.col("last").alias(f"{name}_last"))


def cosine_top(vectors: DataFrame, k: int, least: float) -> DataFrame:
    """(left_id, right_id, similarity, place): up to ``k`` right texts per left text from ``least`` on.

    Exact, without joining frequent words: terms go in a common order by rarity, and only each text's
    prefix of rare terms is joined. Common terms up to the earlier end of both prefixes are in both,
    so a pair's sum over joined terms plus the length of that side's rest bounds its similarity;
    pairs whose bound reaches ``least`` are scored on whole vectors. Similarities are rounded to 6
    places; ties go by right_id.
    """
    v = materialize(vectors, "vectors")
    l, r = v.filter("side = 'l'"), v.filter("side = 'r'")
    joined = _prefix(l, least, "left").join(_prefix(r, least, "right"), ["block", "term"])
    rest = F.when(F.col("left_last") <= F.col("right_last"), F.col("left_tail")).otherwise(F.col("right_tail"))
    sums = joined.groupBy("block", "left_id", "right_id").agg(F.sum(F.col("left_weight") * F.col("right_weight")).alias("seen"), F.first(rest).alias("rest"))
    pairs = materialize(sums.filter(F.col("seen") + F.col("rest") >= least - 1e-6).select("block", "left_id", "right_id"), "candidates")
    as_map = F.map_from_entries(F.collect_list(F.struct("term", "weight")))  # one entry per term of the text
    left = l.groupBy("block", F.col("doc_id").alias("left_id")).agg(as_map.alias("x"))
    right = r.groupBy("block", F.col("doc_id").alias("right_id")).agg(as_map.alias("y"))
    both = pairs.join(left, ["block", "left_id"]).join(right, ["block", "right_id"])
    dot = F.aggregate(F.map_entries("x"), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(F.col("y"), e["key"]), F.lit(0.0)))
    scored = both.select("left_id", "right_id", round_at(dot, 6).alias("similarity")).filter(F.col("similarity") >= least)
    w = Window.partitionBy("left_id").orderBy(F.desc("similarity"), "right_id")
    return scored.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def _texts(vectors: DataFrame) -> DataFrame:
    """(side, block, doc_id, text_id, terms, weights): one row per document; equal vectors have equal text_id."""
    entries = F.array_sort(F.collect_list(F.struct(F.xxhash64("term").alias("term"), "weight")))  # one entry per term of the text
    docs = vectors.groupBy("side", "block", "doc_id").agg(entries.alias("e"))
    # Norms of equal texts may differ in the last bit, as their terms are summed in any order.
    text_id = F.unhex(F.md5(F.array_join(F.transform("e", lambda e: F.concat_ws(":", e["term"].cast("string"), F.floor(e["weight"] * 1e9 + 0.5).cast("string"))), " ")))
    return docs.select("side", "block", "doc_id", text_id.alias("text_id"), F.col("e.term").alias("terms"), F.col("e.weight").alias("weights"))


def _nearest(k: int, cells: int = 1 << 23, batch: int = 64) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ``k`` nearest of some right texts for each of some left texts, by similarity, then first id.

    All similarities are worked out in single precision: the most frequent terms as a product of
    matrices of at most ``cells`` cells, the others by their lists of right texts. What may be among
    the first ``k`` by the largest error of these is worked out again on whole vectors.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        def flat(t: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
            a = t.column(name).combine_chunks()
            a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
            return a.offsets.to_numpy() - a.offsets[0].as_py(), a.flatten().to_numpy()

        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("block", pa.string()), ("left_text", pa.binary()), ("right_text", pa.binary()), ("first_id", pa.string()), ("similarity", pa.float64()))})
        right = right.sort_by("first_id")
        ends, hashes = flat(right, "terms")
        weights = flat(right, "weights")[1]
        sizes = np.diff(ends)
        order = np.argsort(hashes, kind="stable")
        begins = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
        known, starts = hashes[order][begins], np.concatenate([begins, [len(order)]])
        often = np.diff(starts)
        terms = np.empty(len(order), dtype=np.int64)
        terms[order] = np.repeat(np.arange(len(known)), often)
        rows, values = np.repeat(np.arange(len(sizes)), sizes)[order], weights[order].astype(np.float32)
        # Terms of at least every 32nd text have a column, the most frequent ones first.
        wide = np.argsort(-often, kind="stable")[: min(cells // len(sizes), int((often * 32 >= len(sizes)).sum()))]
        column = np.full(len(known), -1)
        column[wide] = np.arange(len(wide))
        dense = np.zeros((len(wide), len(sizes)), dtype=np.float32)
        for c, t in enumerate(wide):
            dense[c, rows[starts[t] : starts[t + 1]]] = values[starts[t] : starts[t + 1]]
        longest = np.sqrt(np.add.reduceat(weights * weights, ends[:-1]).max())
        l_ends, l_terms = flat(left, "terms")
        l_weights = flat(left, "weights")[1]
        place = np.minimum(np.searchsorted(known, l_terms), len(known) - 1)
        hit = known[place] == l_terms
        mine = np.zeros(len(known))
        groups = np.arange(0, len(sizes), max(1, len(sizes) // max(4 * k, 256)))
        found, of, similar = [], [], []
        for i in range(left.num_rows):
            if i % batch == 0:
                some = slice(l_ends[i], l_ends[min(i + batch, left.num_rows)])
                own = np.repeat(np.arange(min(batch, left.num_rows - i)), np.diff(l_ends[i : i + batch + 1]))
                at = hit[some] & (column[place[some]] >= 0)
                x = np.zeros((min(batch, left.num_rows - i), len(wide)), dtype=np.float32)
                x[own[at], column[place[some][at]]] = l_weights[some][at]
                several = x @ dense
            at = slice(l_ends[i], l_ends[i + 1])
            t, x_i = place[at][hit[at]], l_weights[at][hit[at]]
            sums = several[i % batch]
            for j in np.flatnonzero(column[t] < 0):
                p = slice(starts[t[j]], starts[t[j] + 1])
                sums[rows[p]] += np.float32(x_i[j]) * values[p]
            # The k-th of the largest sums of groups of texts is no more than the k-th largest sum.
            # Similarities are compared when rounded to 6 places; each product and sum is off by 6e-8 at most.
            slack = 2e-6 + 4e-7 * (len(t) + 2) * longest * np.sqrt(x_i @ x_i)
            most = np.maximum.reduceat(sums, groups)
            floor = np.partition(most, len(most) - k)[len(most) - k] - slack if len(most) >= k else 0.0
            few = np.flatnonzero(sums >= floor) if floor > 0 else np.flatnonzero(sums)
            exact = np.empty(0)
            if len(few):
                mine[t] = x_i
                n = sizes[few]
                first = np.concatenate([[0], np.cumsum(n)[:-1]])
                inner = np.arange(n.sum()) + np.repeat(ends[few] - first, n)
                exact = np.add.reduceat(weights[inner] * mine[terms[inner]], first)
                mine[t] = 0.0
                exact = np.floor(exact * 1e6 + 0.5) / 1e6
            if len(few) < k or floor <= 0:  # texts without a common term have similarity 0
                more = np.setdiff1d(np.arange(min(len(sizes), k + len(few))), few)[:k]
                few, exact = np.concatenate([few, more]), np.concatenate([exact, np.zeros(len(more))])
            best = np.lexsort((few, -exact))[:k]
            found.append(few[best])
            of.append(np.full(len(best), i))
            similar.append(exact[best])
        a, b = pa.array(np.concatenate(of)), pa.array(np.concatenate(found))
        return pa.table({"block": left.column("block").take(a), "left_text": left.column("text_id").take(a), "right_text": right.column("text_id").take(b), "first_id": right.column("first_id").take(b), "similarity": pa.array(np.concatenate(similar))})

    return run


def cosine_nearest(vectors: DataFrame, k: int, left_shard: int = 1 << 15, right_shard: int = 1 << 16) -> DataFrame:
    """(left_id, right_id, similarity, place): the ``k`` nearest right texts of every left text, without a floor.

    Equal texts are compared once. Every shard of left texts meets every shard of right texts of its
    block in a task of bounded size, which gives the nearest of that shard; the nearest of all follow
    from these. Lists are shorter than ``k`` only where the block has fewer right texts. Terms are
    compared by 64-bit hashes. Similarities are rounded to 6 places; ties go by right_id.
    """
    texts = materialize(_texts(vectors), "texts")
    l, r = (texts.filter(F.col("side") == side).drop("side") for side in "lr")
    left = materialize(l.groupBy("block", "text_id").agg(F.first(F.struct("terms", "weights")).alias("e")).select("block", "text_id", "e.*"), "left_texts")
    right = materialize(r.groupBy("block", "text_id").agg(F.first(F.struct("terms", "weights")).alias("e"), F.min("doc_id").alias("first_id")).select("block", "text_id", "first_id", "e.*"), "right_texts")
    # Every block is cut for its own size, so that its texts are copied no more often than need be.
    count = lambda df, n: df.groupBy("block").agg(F.count("*").alias(n))
    sizes = materialize(count(left, "n").join(count(right, "m"), "block").withColumn("rights", F.ceil(F.col("m") / right_shard)), "sizes")
    work = sizes.agg(F.sum(F.col("n") * F.col("m").cast("double"))).first()[0] or 1.0
    wanted = F.ceil(F.lit(2.0 * texts.sparkSession.sparkContext.defaultParallelism / work) * F.col("n") * F.col("m") / F.col("rights"))
    sizes = sizes.withColumn("lefts", F.greatest(F.ceil(F.col("n") / left_shard), F.least(F.floor(F.col("n") / 1024), wanted))).select("block", "lefts", "rights")
    parts = 4 * (sizes.agg(F.sum(F.col("lefts") * F.col("rights"))).first()[0] or 1)  # spare ones, since a hash deals unevenly
    shard = lambda of: F.pmod(F.xxhash64("text_id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), (F.col(of) - 1).cast("int")))
    keys = ["block", "ls", "rs"]
    left = left.join(sizes, "block").withColumn("ls", shard("lefts")).withColumn("rs", every("rights")).drop("lefts", "rights").repartition(parts, *keys)
    right = right.join(sizes, "block").withColumn("rs", shard("rights")).withColumn("ls", every("lefts")).drop("lefts", "rights").repartition(parts, *keys)
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_nearest(k), "block string, left_text binary, right_text binary, first_id string, similarity double")
    near = materialize(near, "near")
    best = Window.partitionBy("block", "left_text").orderBy(F.desc("similarity"), "first_id")
    near = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k).drop("place", "first_id")
    # Of equal right texts no more than the first k can be in a list.
    ids = r.select("block", F.col("text_id").alias("right_text"), F.col("doc_id").alias("right_id"))
    ids = ids.withColumn("place", F.row_number().over(Window.partitionBy("block", "right_text").orderBy("right_id"))).filter(F.col("place") <= k).drop("place")
    by_row = Window.partitionBy("block", "left_text").orderBy(F.desc("similarity"), "right_id")
    lists = near.join(ids, ["block", "right_text"]).withColumn("place", F.row_number().over(by_row)).filter(F.col("place") <= k)
    of = l.select("block", F.col("text_id").alias("left_text"), F.col("doc_id").alias("left_id"))
    return of.join(materialize(lists, "lists"), ["block", "left_text"]).select("left_id", "right_id", "similarity", "place")


def auto_tier(similarity: Column, merge: float = 0.92, regional: float = 0.75, link: float = 0.5) -> Column:
    """Tier by similarity alone: the deterministic stand-in for a model's judgement below ``merge``."""
    return F.when(similarity >= merge, "merge").when(similarity >= regional, "link_regional").when(similarity >= link, "link").otherwise("none")


def vector_top(left: DataFrame, right: DataFrame, block: str, vec_id: str, vector: str, k: int) -> DataFrame:
    """Up to ``k`` nearest right vectors by cosine for each left vector of its block.

    ``left`` is a stated set of queries against all rows of their block in ``right``; a vector isn't
    its own neighbour. Null, empty and zero vectors have no neighbours.
    """
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = lambda df, i, v: df.select(F.col(block).alias("block"), F.col(vec_id).alias(i), F.col(vector).alias(v), norm(F.col(vector)).alias(v + "_norm")).filter(F.col(v + "_norm") > 0)
    a, b = unit(left, "left_id", "x"), unit(right, "right_id", "y")
    dot = F.aggregate(F.zip_with("x", "y", lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, z: s + z)
    scored = a.join(b, "block").filter("left_id <> right_id").select("left_id", "right_id", round_at(dot / (F.col("x_norm") * F.col("y_norm")), 6).alias("similarity"))
    w = Window.partitionBy("left_id").orderBy(F.desc("similarity"), "right_id")
    return scored.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)
