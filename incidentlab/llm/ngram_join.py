"""N-gram Jaccard self-join with a prefix tree.

Documents link when the Jaccard similarity of their sets of word n-grams
reaches ``percent`` / 100.  All steps are exact for every pair of sets:

1. Equal sets collapse to one representative (smallest id), so a group of
   copies costs one set however large it is.
2. A count-min sketch over the representatives' n-grams (``sketch.py``) gives
   every n-gram a count that is never too small.  An n-gram that one set alone
   holds cannot be in any intersection: sets with more of those than the
   threshold allows drop out, the others keep only their shared n-grams,
   ordered globally by (count, hash), rarest first.
3. Two linked sets share an n-gram of their prefixes and have similar sizes.
   Each (prefix n-gram, size band) contributes one edge per member to its
   smallest member, never member pairs; the components of those edges are the
   candidate families.
4. The sets of a family go into a compressed prefix tree, most frequent
   n-grams first, so near copies share long paths.  Each set traverses it once:
   overlaps of shared paths are counted once, subtrees are pruned by the
   lengths that remain in the path and in the probe, and subtrees that already
   belong to the probe's component are skipped.  A family larger than
   ``block_ngrams`` is cut into blocks and every pair of blocks is joined, so
   memory stays bounded and no pair is left out.
5. The links are joined into components.

N-grams are compared by 64-bit hashes.  Defined results: texts without words
(null, empty) have an empty set and link with nothing; fewer than ``n`` words
form one n-gram; null ids lose to any id as component id; equal rows are
separate documents with the same component.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.llm.components import connected_components
from incidentlab.llm.sketch import (
    ANSWER_SCHEMA,
    PART_SCHEMA,
    empty_parts,
    estimates,
    merge_sketches,
    n_shards,
    partial_sketches,
)
from incidentlab.llm.textops import Words, fresh, in_chunks, mix64, numbered, window_hashes
from incidentlab.session import scratch_path

REP_LEVEL = -1


def ngram_sets(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text: (text number, hash), sorted, and the set sizes."""
    words = Words(texts, lower=True)
    k = len(words.hash)
    docs, grams = [], []
    if k >= n:
        h = window_hashes(words.hash, n)
        inside = words.doc[: len(h)] == words.doc[n - 1 :]
        docs.append(words.doc[: len(h)][inside])
        grams.append(h[inside])
    first = np.cumsum(words.count) - words.count
    for short in range(1, n):  # the whole text is one n-gram
        own = np.flatnonzero(words.count == short)
        if len(own):
            h = words.hash[first[own]]
            for j in range(1, short):
                h = window_hashes(np.stack([h, words.hash[first[own] + j]], 1).ravel(), 2)[::2]
            docs.append(own)
            grams.append(mix64(h, 1000 + short))
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    doc, gram = np.concatenate(docs), np.concatenate(grams)
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
    doc, gram = doc[new], gram[new]
    return doc, gram, np.bincount(doc, minlength=len(texts)).astype(np.int64)


def _digests(doc: np.ndarray, gram: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over mixed n-grams per text."""
    out = []
    for seed in (41, 43):
        total = np.zeros(len(gram) + 1, np.uint64)
        np.cumsum(mix64(gram, seed), out=total[1:])
        ends = np.cumsum(sizes)
        out.append((total[ends] - total[ends - sizes]).view(np.int64))
    return out[0], out[1]


class _Node:
    __slots__ = ("path", "kids", "sets", "low", "high", "deep", "rep", "same")

    def __init__(self, path, size, deep, rep):
        self.path, self.kids, self.sets = path, {}, []
        self.low = self.high = size  # set sizes below
        self.deep = deep  # most n-grams on a path from this node's path on
        self.rep, self.same = rep, True  # a set below; all below in its component


class PrefixTree:
    """Compressed trie of ordered n-gram sets with component-aware probing."""

    def __init__(self, sizes: list[int], grams: list[np.ndarray], percent: int):
        self.sizes, self.grams, self.percent = sizes, grams, percent
        vocabulary = int(max((int(g.max()) for g in grams if len(g)), default=-1)) + 1
        self.pos = np.zeros(vocabulary, np.int32)
        self.root = None
        self.parent = list(range(len(sizes)))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def insert(self, i: int) -> None:
        path, size = self.grams[i], self.sizes[i]
        if self.root is None:
            self.root = _Node(path[:0], size, len(path), i)
        node, at = self.root, 0
        while True:
            node.low, node.high = min(node.low, size), max(node.high, size)
            node.deep = max(node.deep, len(path) - at)
            node.same = node.same and self.find(node.rep) == self.find(i)
            at += len(node.path)
            if at == len(path):
                node.sets.append(i)
                return
            key = int(path[at])
            kid = node.kids.get(key)
            if kid is None:
                node.kids[key] = leaf = _Node(path[at:], size, len(path) - at, i)
                leaf.sets.append(i)
                return
            m = min(len(kid.path), len(path) - at)
            differ = np.flatnonzero(kid.path[:m] != path[at : at + m])
            m = int(differ[0]) if len(differ) else m
            if m < len(kid.path):  # split the kid's path
                upper = _Node(kid.path[:m], size, kid.deep, kid.rep)
                upper.low, upper.high, upper.same = kid.low, kid.high, kid.same
                kid.path, kid.deep = kid.path[m:], kid.deep - m
                upper.kids[int(kid.path[0])] = kid
                node.kids[key] = kid = upper
            node = kid

    def probe(self, i: int) -> None:
        """Links set ``i`` to every component that holds a linked set."""
        if self.root is None:
            return
        own, size, p, pos = self.grams[i], self.sizes[i], self.percent, self.pos
        pos[own] = np.arange(1, len(own) + 1, dtype=np.int32)
        stack = [(self.root, 0, 0, False)]
        while stack:
            node, overlap, last, done = stack.pop()
            if done:  # all kids seen: one component below?
                if not node.same:
                    r = self.find(node.rep)
                    node.same = all(self.find(s) == r for s in node.sets) and all(
                        k.same and self.find(k.rep) == r for k in node.kids.values()
                    )
                continue
            if node.same and self.find(node.rep) == self.find(i):
                continue
            if 100 * node.high < p * size or p * node.low > 100 * size:
                continue
            need = -(-p * (size + max(node.low, -(-p * size // 100))) // (100 + p))
            if overlap + min(node.deep, len(own) - last) < need:
                continue
            if len(node.path):
                at = pos[node.path]
                overlap += int(np.count_nonzero(at))
                last = max(last, int(at.max()))
            for s in node.sets:
                if 100 * overlap >= p * (size + self.sizes[s] - overlap):
                    a, b = self.find(i), self.find(s)
                    if a != b:
                        self.parent[max(a, b)] = min(a, b)
            if node.kids:
                stack.append((node, 0, 0, True))
                stack.extend((k, overlap, last, False) for k in node.kids.values())
        pos[own] = 0


def _join_family(pdf: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Members and the smallest member of their component, of one family, one of
    its blocks, or a block (``probes`` false) and sets that probe it.  Members
    that share a ``settled`` component are not compared."""
    grams = [np.asarray(g, np.int64)[::-1] for g in pdf["grams"]]
    flat, where = np.unique(np.concatenate(grams), return_inverse=True)
    ends = np.cumsum([len(g) for g in grams])
    grams = [where[e - len(g) : e] for g, e in zip(grams, ends)]
    tree = PrefixTree(pdf["n"].tolist(), grams, percent)
    if "probes" not in pdf:
        for i in range(len(grams)):
            tree.probe(i)
            tree.insert(i)
    else:
        first: dict[int, int] = {}
        for i, c in enumerate(pdf["settled"].tolist()):
            tree.parent[i] = first.setdefault(c, i)
        probes = pdf["probes"].to_numpy()
        for i in np.flatnonzero(~probes):
            tree.insert(int(i))
        for i in np.flatnonzero(probes):
            tree.probe(int(i))
    rid = pdf["rid"].tolist()
    return [(rid[i], rid[root]) for i in range(len(rid)) if (root := tree.find(i)) != i]


def _set_table(docs: DataFrame, id_type, n: int, percent: int, chunk_bytes: int) -> DataFrame:
    """One row per document: ``gid, rid, doc_id, n, d1, d2``, ``rep`` (it is the
    representative of its set), and ``grams`` (shared n-grams, rarest first) for
    the representatives that may link."""
    chunks, n_bytes = in_chunks(docs, "text", chunk_bytes)
    chunks = chunks.select("gid", "rid", "doc_id", "text")
    shards = n_shards(n_bytes // 5)
    base = "gid int, rid long, doc_id string, n long, d1 long, d2 long"

    def describe(pdf: pd.DataFrame):
        doc, gram, sizes = ngram_sets(pdf["text"].tolist(), n)
        d1, d2 = _digests(doc, gram, sizes)
        out = pdf[["gid", "rid", "doc_id"]].assign(n=sizes, d1=d1, d2=d2)
        return doc, gram, sizes, out

    def digest_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        return describe(pdf)[3]

    def only_reps(pdf: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
        return pdf["rid"].isin(others.loc[others["level"] == REP_LEVEL, "rid"]).to_numpy()

    def sketch_chunk(key: tuple, pdf: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        reps = pdf[only_reps(pdf, others)]
        if not len(reps):
            return empty_parts()
        return partial_sketches(key[0], ngram_sets(reps["text"].tolist(), n)[1], shards)

    def share_chunk(pdf: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        doc, gram, sizes, out = describe(pdf)
        rep = only_reps(pdf, others)
        of_rep = rep[doc]
        doc, gram = doc[of_rep], gram[of_rep]
        grams = [None] * len(pdf)
        if len(gram):
            count = estimates(gram, others, shards)
            shared = count >= 2
            doc, gram, count = doc[shared], gram[shared], count[shared]
            n_shared = np.bincount(doc, minlength=len(pdf))
            may = (n_shared > 0) & (100 * n_shared >= percent * sizes)
            own = may[doc]
            doc, gram, count = doc[own], gram[own], count[own]
            order = np.lexsort((gram, count, doc))
            gram = gram[order].view(np.int64)
            ends = np.cumsum(np.where(may, n_shared, 0))
            for i in np.flatnonzero(may):
                grams[i] = gram[ends[i] - n_shared[i] : ends[i]]
        return out.assign(rep=rep, grams=grams)

    described = chunks.groupBy("gid").applyInPandas(digest_chunk, base)
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast(id_type), "rid", "gid")).alias("m")
    reps = described.filter("n > 0").groupBy("n", "d1", "d2").agg(rep).select("m.gid", "m.rid")
    reps = reps.select(
        "gid", F.lit(0).alias("shard"), F.lit(REP_LEVEL).alias("level"), F.lit(None).cast("binary").alias("counts"), "rid"
    )
    parts = chunks.groupBy("gid").cogroup(reps.groupBy("gid")).applyInPandas(sketch_chunk, PART_SCHEMA)
    merged = parts.groupBy("shard", "level").applyInPandas(merge_sketches, ANSWER_SCHEMA)
    others = reps.unionByName(merged.withColumn("rid", F.lit(None).cast("long")))
    return (
        chunks.groupBy("gid").cogroup(others.groupBy("gid")).applyInPandas(share_chunk, base + ", rep boolean, grams array<long>")
    )


def _family_edges(sets: DataFrame, percent: int) -> DataFrame:
    """One edge per member of a (prefix n-gram, size band) to its smallest member."""
    # Linked sizes differ by a factor of at least percent / 100; the slightly
    # wider band keeps them in the same or neighbouring bands under rounding.
    width = math.log(100 / (percent - 1))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("grams"))
    posting = sets.filter(prefix > 0).select(
        "rid",
        F.explode(F.slice("grams", F.lit(1), prefix.cast("int"))).alias("gram"),
        F.floor(F.log("n") / width).cast("int").alias("band"),
    )
    posting = posting.select("rid", "gram", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    least = posting.groupBy("gram", "band").agg(F.min("rid").alias("least"), F.max("rid").alias("most"))
    return (
        posting.join(least.filter("least < most"), ["gram", "band"])
        .filter("rid <> least")
        .select("rid", "least")
    )


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _join(groups: DataFrame, by: list[str], percent: int) -> DataFrame:
    """Links (a, b) of every group, family by family."""

    def join_bin(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [x for _, own in pdf.sort_values("rid").groupby("family") for x in _join_family(own, percent)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return groups.groupBy(*by).applyInPandas(join_bin, "a long, b long")


def _large_family_links(members: DataFrame, sizes: DataFrame, percent: int, block_ngrams: int, path: str) -> DataFrame:
    """Links of families that are cut into blocks (step 5)."""
    blocks = F.ceil(F.col("total") / block_ngrams).cast("int")
    sizes = sizes.select("family", blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    placed = _write(members.join(sizes, "family").withColumn("block", block), f"{path}-placed")
    inside = _write(_join(placed, ["family", "block"], percent), f"{path}-inside")

    # Components of the blocks, and the largest of each with its smallest set.
    label = F.coalesce("component", F.col("rid")).alias("component")
    found = connected_components(inside, "a", "b").withColumnRenamed("node", "rid")
    own = _write(placed.select("rid", "family", "block").join(found, "rid", "left").select("rid", "family", "block", label), f"{path}-own")
    counts = own.groupBy("family", "block", "component").agg(F.count("*").alias("k"))
    tops = counts.groupBy("family", "block").agg(F.max_by("component", F.struct("k", "component")).alias("rid"))
    between = _write(_join(placed.drop("block").join(tops.drop("block"), ["family", "rid"]), ["family"], percent), f"{path}-between")

    # The family's largest component so far; the others probe all blocks.
    so_far = connected_components(inside.unionByName(between), "a", "b").withColumnRenamed("node", "rid")
    own = _write(own.drop("component").join(so_far, "rid", "left").select("rid", "family", "block", label), f"{path}-so-far")
    counts = own.groupBy("family", "component").agg(F.count("*").alias("k"))
    core = counts.groupBy("family").agg(F.max_by("component", F.struct("k", "component")).alias("core"))
    settled = placed.join(own.select("rid", F.col("component").alias("settled")), "rid").join(core, "family")
    settled = _write(settled, f"{path}-settled")
    rest = settled.filter("settled <> core")
    parts = rest.groupBy("family").agg(F.ceil(F.sum(F.size("grams")) / block_ngrams).cast("int").alias("parts"))
    names = ["family", "block", "part", "rid", "n", "grams", "settled", "probes"]
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    standing = settled.join(parts, "family").withColumn("probes", F.lit(False))
    standing = standing.select(*[c for c in names if c != "part"], every_part).select(*names)
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to")
    part = F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int").alias("part")
    probing = rest.join(parts, "family").withColumn("probes", F.lit(True))
    probing = probing.select("*", every_block, part).filter("to <> block").drop("block").withColumnRenamed("to", "block").select(*names)
    across = _join(standing.unionByName(probing), ["family", "block", "part"], percent)
    return inside.unionByName(between).unionByName(across)


def _links(sets: DataFrame, families: DataFrame, percent: int, block_ngrams: int, path: str) -> DataFrame:
    members = sets.join(families.select(F.col("node").alias("rid"), F.col("component").alias("family")), "rid")
    members = _write(members, f"{path}-members")
    sizes = members.groupBy("family").agg(F.sum(F.size("grams")).alias("total"))
    total, most = sizes.agg(F.sum("total"), F.max("total")).first()
    large = F.col("total") > block_ngrams
    bins = -(-(total or 1) // block_ngrams)
    if (most or 0) <= block_ngrams:
        small = members
    else:
        sizes = _write(sizes.filter(large), f"{path}-sizes")
        small = members.join(sizes, "family", "left_anti")
    links = _join(small.withColumn("bin", F.pmod(F.xxhash64("family"), F.lit(bins))), ["bin"], percent)
    if (most or 0) > block_ngrams:
        links = links.unionByName(_large_family_links(members, sizes, percent, block_ngrams, path))
    return links


def ngram_jaccard_join(
    docs: DataFrame,
    n: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = 4 << 20,
    block_ngrams: int = 1 << 20,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id`` (smallest
    id reachable by links), ``kept`` (true for one row of each component, that
    with the smallest id) and ``rid``, the row number: the column ``row_col`` of
    ``docs`` if given, else that of ``textops.numbered``."""
    spark = docs.sparkSession
    if row_col is None:
        row_col = fresh("__row", docs.columns)
        docs = numbered(docs, row_col)
    rows = docs.select(
        F.col(row_col).alias("rid"), F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    path = scratch_path(spark, "ngram")
    id_type = docs.schema[id_col].dataType
    table = _set_table(rows, id_type, n, percent, chunk_bytes)
    table = _write(table.withColumn("doc_id", F.col("doc_id").cast(id_type)), f"{path}-sets")
    sets = table.filter("grams IS NOT NULL").select("rid", "n", "grams")
    families = connected_components(_family_edges(sets, percent), "rid", "least")
    links = connected_components(_links(sets, families, percent, block_ngrams, path), "a", "b")

    # The row with the smallest id per set (its representative), then per component.
    key = ["n", "d1", "d2"]
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid").alias("m")
    reps = table.filter("rep").select(*key, own, "rid")
    linked = links.withColumnRenamed("node", "rid").join(reps.select("rid", "m"), "rid")
    first = linked.groupBy("component").agg(F.min("m").alias("first"))
    linked = _write(linked.join(first, "component").select("rid", "first"), f"{path}-first")
    per_set = reps.join(linked, "rid", "left").select(*key, F.coalesce("first", "m").alias("first"))
    # A set held by very many documents meets its result once per chunk.
    per_chunk = table.select("gid", *key).distinct().join(per_set, key)
    empty = F.col("n") == 0
    return table.join(per_chunk, ["gid", *key], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (empty | (F.col("rid") == F.col("first.rid"))).alias("kept"),
        "rid",
    )
