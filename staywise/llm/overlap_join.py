"""N-gram Jaccard join by T-occurrence search, and the components of its links.

Two documents link if their sets of word shingles have a Jaccard similarity of ``percent`` or more. A set of n shingles
then shares at least T = ceil(n x percent / 100) of them with any partner.

1. Each document's ``sample`` per cent smallest shingle hashes (more than n - T of them) are counted over all documents.
   Of the shingles that two sets share, the smallest lie in the counted parts of both; documents with fewer repeated
   ones than the least number of these over all sizes of a partner are out.
2. For the rest, one row per different set, all shingles are counted. Those that occur once can be in no overlap:
   what remains is each set's inverted lists, in order of length, and sets with fewer than T of them are out.
3. Of T lists, at least one of a set's n_shared - T + 1 shortest holds each partner. Every short list has a leader;
   verified links with leaders merge most groups of copies, so that no pairs within a group are made.
4. Short lists that still hold several merged groups connect sets into candidate groups. A group is cut into blocks,
   and each pair of blocks is searched in one task: the short lists of a set are merged and counted, candidates that
   can still reach T probe the long lists (DivideSkip), and sets known to be connected are passed over.
5. Components of all links found.

Shingles are held as 64-bit hashes of their words; overlaps are counted on these. All tables between the steps are
written to the shared folder. Rows of hot shingles are summed up before the shuffle, or joined as plain tables that
adaptive execution can split.

Inputs without a result of their own: an empty table gives no rows; a null text or one without words has an empty set
and links with nothing; every row has a result, rows of one doc_id each by its own text; a row with a null id takes part and
names no component that holds another id; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.llm import prefilter, words
from staywise.llm.graph import components
from staywise.session import materialize

#: Production parameters.
SHINGLE = 5
PERCENT = 75
SAMPLE = 35
BLOCK = 256
#: DivideSkip's weight of a probe against a merge step.
PROBE = 0.0085


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _at_least(n, percent: int):
    return -(-n * percent // 100)


def _lead(n, percent: int, sample: int):
    """How many of the smallest hashes of a set of ``n`` are counted first."""
    return np.minimum(n, np.maximum(n - _at_least(n, percent) + 1, _at_least(n, sample)))


@lru_cache(maxsize=1 << 14)
def _need(n: int, percent: int, sample: int) -> int:
    """How many hashes of the lead of a set of ``n`` are in the lead of any partner too, at the least.

    The i-th smallest common hash is at most the (i + size - common)-th of a set, so as many are in both leads as the
    smaller of lead - (size - common) tells.
    """
    sizes = np.arange(_at_least(n, percent), n * 100 // percent + 1)
    common = -(-(n + sizes) * percent // (100 + percent))
    sizes, common = sizes[common <= np.minimum(n, sizes)], common[common <= np.minimum(n, sizes)]
    both = np.minimum(_lead(n, percent, sample) - (n - common), _lead(sizes, percent, sample) - (sizes - common))
    return max(1, int(both.min(initial=n)))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    sizes = np.array([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(flat.view(np.int64)))


def _set_rows(percent: int, sample: int, shingle: int):
    """(doc_id, n, digest, need, lead): the smallest hashes of each set, and how many must be repeated."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                found = words.split_words(*words.utf8(part.column("text")), words.VISIBLE)
                n, need, digests, lead = [], [], [], []
                for tokens in words.shingle_sets(found, shingle):
                    n.append(len(tokens))
                    need.append(_need(len(tokens), percent, sample))
                    digests.append(_digest(tokens))
                    lead.append(tokens[: int(_lead(len(tokens), percent, sample))])
                columns = [
                    part.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(need, pa.int32()),
                    _lists(lead),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "need", "lead"])

    return rows


def _whole_sets(shingle: int):
    """(digest, tokens): every shingle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                found = words.split_words(*words.utf8(part.column("text")), words.VISIBLE)
                sets = list(words.shingle_sets(found, shingle))
                digests = pa.array(map(_digest, sets), pa.binary())
                yield pa.RecordBatch.from_arrays([digests, _lists(sets)], ["digest", "tokens"])

    return rows


def set_classes(docs: DataFrame, percent: int = PERCENT, sample: int = SAMPLE, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, classes and sets.

    One row per document (doc_id, n, digest), whatever its id; per class of equal sets (digest, n, first, rows), where ``first`` is
    its smallest id; and per class that may have a partner (doc_id, digest, tokens), where doc_id is a number of its own.
    """
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, digest binary, need int, lead array<long>"
    sets = materialize(texts.transform(words.map_texts, _set_rows(percent, sample, shingle), schema), "shingles")
    classes = sets.where("n > 0").groupBy("digest")
    classes = classes.agg(F.first("n").alias("n"), F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    classes = materialize(classes, "classes")

    rows = sets.select("digest", "need", F.explode("lead").alias("token"))
    repeated = rows.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    repeated = materialize(repeated, "repeated")
    hits = rows.join(repeated, "token").groupBy("digest", "need").agg(F.count("*").alias("hits"))
    able = hits.where("hits >= need").select("digest").join(classes.select("digest", "n", F.col("first").alias("doc_id")), "digest")
    able = materialize(able.select(F.monotonically_increasing_id().alias("number"), "*"), "candidates")

    # a class of nulls alone is looked for among all rows without an id
    again = prefilter.likely(texts, able, "doc_id").select("text")
    whole = again.transform(words.map_texts, _whole_sets(shingle), "digest binary, tokens array<long>")
    whole = whole.join(able.select("digest", "number", "n"), "digest").dropDuplicates(["number"])
    whole = materialize(whole.select(F.col("number").alias("doc_id"), "digest", "n", "tokens"), "sets")
    return sets.select("doc_id", "n", "digest"), classes, whole


def inverted_sets(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, own): each set's shingles that others hold too, rarest first, where they can reach T."""
    rows = sets.select("doc_id", "n", F.explode("tokens").alias("token"))
    shared = materialize(rows.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "shared")
    own = F.sort_array(F.collect_list(F.struct("held", "token")))["token"]  # no longer than the document
    sets = rows.join(shared, "token").groupBy("doc_id", "n").agg(own.alias("own"))
    return materialize(sets.where(F.size("own") * 100 >= F.col("n") * percent), "members")


def short_lists(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, doc_id, n): the lists of which at least one holds any partner."""
    least = F.ceil(F.col("n") * percent / F.lit(100)).cast("int")
    short = F.slice("own", F.lit(1), F.size("own") - least + 1)
    return materialize(members.select(F.explode(short).alias("token"), "doc_id", "n"), "lists")


def leader_links(lists: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): verified links of the lists' documents with the lists' leaders."""
    first = F.min(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", "n")).alias("first")
    leaders = lists.groupBy("token").agg(first, F.count("*").alias("held")).where("held > 1")
    leaders = materialize(leaders.select("token", F.col("first.doc_id").alias("leader"), F.col("first.n").alias("size")), "leaders")
    alike = F.least("n", "size") * 100 >= F.greatest("n", "size") * percent
    pairs = lists.join(leaders, "token").where((F.col("doc_id") != F.col("leader")) & alike)
    pairs = materialize(pairs.select("doc_id", "leader").distinct(), "leader-pairs")
    left = members.select("doc_id", "n", F.col("own").alias("x"))
    right = members.select(F.col("doc_id").alias("leader"), F.col("n").alias("size"), F.col("own").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "doc_id").join(right, "leader").withColumn("both", common)
    linked = both.where(F.col("both") * 100 >= (F.col("n") + F.col("size") - F.col("both")) * percent)
    return materialize(linked.select(F.col("doc_id").alias("a"), F.col("leader").alias("b")), "leader-links")


def open_groups(lists: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, label, group): documents whose short lists hold documents not yet known to be connected.

    A label is shared only by documents that links connect: a document's smallest leader, or that one's.
    """
    to = links.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("to"))
    to = materialize(to, "leads")
    far = to.select(F.col("doc_id").alias("mid"), F.col("to").alias("far"))
    label = F.coalesce("far", "to", "doc_id").alias("label")
    # a leader without a leader keeps itself; following the hop only once keeps labels right, if not smallest
    named = lists.join(to, "doc_id", "left").join(far, F.col("to") == F.col("mid"), "left").select("token", "doc_id", label)
    named = materialize(named, "named")
    ends = named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("doc_id").alias("first"))
    still = materialize(ends.where("lo < hi").select("token", "first"), "open-lists")
    stars = named.join(still, "token").select("doc_id", "label", "first")
    stars = materialize(stars.distinct(), "stars")
    group = components(stars, "doc_id", "first").withColumnRenamed("id", "doc_id")
    return stars.select("doc_id", "label").distinct().join(group.withColumnRenamed("component", "group"), "doc_id")


def block_pairs(groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(x, y, doc_id, label, side): documents of each group dealt to the pairs of its blocks that must be searched.

    A label with a block's worth of documents has blocks of its own, and no two of them need be searched.
    """
    sizes = materialize(groups.groupBy("group", "label").agg(F.count("*").alias("rows")), "labels")
    rest = sizes.where(F.col("rows") < block).groupBy("group").agg(F.sum("rows").alias("rest"))
    sizes = sizes.join(materialize(rest, "rests"), "group", "left")
    big = F.col("rows") >= block
    own = F.xxhash64("group", "label", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("rows") / block)))
    other = F.xxhash64("group", F.pmod(F.xxhash64("label"), F.ceil(F.col("rest") / block)))
    dealt = groups.join(sizes, ["group", "label"]).select(
        "group", "doc_id", "label", F.when(big, own).otherwise(other).alias("block"), F.when(big, F.col("label")).alias("pure")
    )
    dealt = materialize(dealt, "blocks")
    blocks = dealt.select("group", "block", "pure").distinct()
    other = blocks.toDF("group", "block2", "pure2")
    needed = (F.col("block") <= F.col("block2")) & ~F.coalesce(F.col("pure") == F.col("pure2"), F.lit(False))
    pairs = blocks.join(other, "group").where(needed).select("group", F.col("block").alias("x"), F.col("block2").alias("y"))
    pairs = materialize(pairs, "block-pairs")
    rows = dealt.select("group", "doc_id", "label", "block")
    left = rows.join(pairs, (rows["block"] == pairs["x"]) & (rows["group"] == pairs["group"]))
    right = rows.join(pairs.where("x <> y"), (rows["block"] == F.col("y")) & (rows["group"] == pairs["group"]))
    columns = ["x", "y", "doc_id", "label"]
    return left.select(*columns, F.lit(0).alias("side")).unionByName(right.select(*columns, F.lit(1).alias("side")))


def _search(percent: int):
    """Links that connect documents of a pair of blocks which their labels don't connect; a spanning set of them."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "n", "doc_id"], kind="stable").reset_index(drop=True)
        ids, sizes, side = rows["doc_id"].to_numpy(), rows["n"].to_numpy(), rows["side"].to_numpy()
        two = side.max() > side.min()
        own = [np.asarray(x, dtype=np.int64) for x in rows["own"]]
        lengths = np.array([len(x) for x in own])
        tokens, at = np.unique(np.concatenate(own), return_inverse=True)
        holder = np.repeat(np.arange(len(own)), lengths)
        order = np.argsort(at, kind="stable")
        lists, counts = holder[order], np.bincount(at)
        start = np.concatenate([[0], np.cumsum(counts)])
        limits = np.concatenate([[0], np.cumsum(lengths)])

        _, root = np.unique(rows["label"].to_numpy(), return_inverse=True)
        found = []
        for i in range(len(own)):
            if two and side[i] == 0:
                continue
            mine = at[limits[i] : limits[i + 1]]
            least = _at_least(int(sizes[i]), percent)
            mine = mine[np.argsort(counts[mine], kind="stable")]
            if len(mine) < least:
                continue
            n_long = min(least - 1, int(least / (PROBE * np.log2(counts[mine[-1]] + 1) + 1)))
            short, long = mine[: len(mine) - n_long], mine[len(mine) - n_long :]
            merged = np.sort(np.concatenate([lists[start[t] : start[t + 1]] for t in short]), kind="stable")
            new = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
            candidates, hits = merged[new], np.diff(np.concatenate([new, [len(merged)]]))
            size = sizes[candidates]
            keep = (hits >= least - n_long) & (root[candidates] != root[i])
            keep &= (side[candidates] == 0) if two else (candidates < i)
            keep &= np.minimum(size, sizes[i]) * 100 >= np.maximum(size, sizes[i]) * percent
            candidates, hits = candidates[keep], hits[keep]
            for k, t in enumerate(long):
                if not len(candidates):
                    break
                held = lists[start[t] : start[t + 1]]
                place = np.minimum(np.searchsorted(held, candidates), len(held) - 1)
                hits = hits + (held[place] == candidates)
                if k % 32 == 31:
                    can = hits + len(long) - k - 1 >= least
                    candidates, hits = candidates[can], hits[can]
            linked = hits * 100 >= (sizes[candidates] + sizes[i] - hits) * percent
            for j in candidates[linked]:
                if root[j] != root[i]:
                    found.append((ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return search


def links(sets: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between sets (doc_id, n, tokens) that connect all that links connect."""
    members = inverted_sets(sets, percent)
    lists = short_lists(members, percent)
    led = leader_links(lists, members, percent)
    dealt = block_pairs(open_groups(lists, led), block).join(members, "doc_id")
    return led.unionByName(dealt.groupBy("x", "y").applyInPandas(_search(percent), "a long, b long"))


def _judged(
    docs: DataFrame, percent: int = PERCENT, sample: int = SAMPLE, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """Per row: doc_id, n, digest, component_id, and the set ``keeper`` of the component's first row; both null without copy or link."""
    rows, classes, sets = set_classes(docs, percent, sample, shingle)
    component = components(links(sets, percent, block))
    linked = sets.select("digest", "doc_id").join(component, F.col("doc_id") == F.col("id")).select("digest", "component")
    named = materialize(classes.join(linked, "digest", "left").where("rows > 1 OR component IS NOT NULL"), "named")
    order = F.struct(F.col("first").isNull().alias("no_id"), F.col("first").alias("component_id"), F.col("digest").alias("keeper"))
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("least"))
    named = named.join(least, "component", "left").select(
        "digest",
        F.when(F.col("least").isNull(), F.col("first")).otherwise(F.col("least.component_id")).alias("component_id"),
        F.coalesce("least.keeper", "digest").alias("keeper"),
    )
    return rows.join(named, "digest", "left")


def near_duplicate_components(docs: DataFrame, **parameters: int) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included)."""
    return _judged(docs, **parameters).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _with_digests(shingle: int, names: tuple[str, str]):
    """All columns of a batch, the size of each text's set, and its digest."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.blocks(batch, "text"):
                found = words.split_words(*words.utf8(part.column("text")), words.VISIBLE)
                sets = list(words.shingle_sets(found, shingle))
                columns = [pa.array(map(len, sets), pa.int64()), pa.array(map(_digest, sets), pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])

    return rows


def keep_first(docs: DataFrame, shingle: int = SHINGLE, **parameters: int) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component one row with its smallest doc_id stays.

    Rows go by their id where all rows of that id go. Where an id has several rows of which some stay, or is null, its
    rows are told apart by their sets.
    """
    judged = materialize(_judged(docs, shingle=shingle, **parameters), "judged")
    stays = F.col("keeper").isNull() | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("digest") == F.col("keeper")))
    judged = judged.select("doc_id", "digest", stays.alias("stays"))
    ids = judged.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_if("stays").alias("kept"))
    ids = materialize(ids.where("kept < rows OR rows > 1 OR doc_id IS NULL"), "copies")
    known = docs.where("doc_id IS NOT NULL")
    rest = prefilter.without(known, ids.where("doc_id IS NOT NULL").select("doc_id"), "doc_id")
    mixed = ids.where("kept > 0 AND (rows > 1 OR doc_id IS NULL)").select(F.col("doc_id").alias("mixed_id"))
    if mixed.isEmpty():
        return rest
    longest = "_" * max(map(len, docs.columns))  # no column has such a name
    size, digest = f"size{longest}", f"digest{longest}"
    schema = T.StructType([*docs.schema.fields, T.StructField(size, T.LongType()), T.StructField(digest, T.BinaryType())])
    told = docs.join(mixed, docs["doc_id"].eqNullSafe(F.col("mixed_id")), "left_semi")
    told = told.transform(words.map_texts, _with_digests(shingle, (size, digest)), schema)
    staying = judged.where("stays").select(F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest")).distinct()
    told = told.join(staying, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col(digest) == F.col("kept_digest")), "left_semi")
    once = told.where(F.col(size) > 0).dropDuplicates(["doc_id", digest]).unionByName(told.where(F.col(size) == 0))
    return rest.unionByName(once.select(*[F.col(f"`{c}`") for c in docs.columns]))
