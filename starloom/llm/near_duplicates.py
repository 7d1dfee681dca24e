"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Texts count by their words (runs of letters and digits, lower case).  Order MinHash (``SKETCHES`` hash functions): each
takes the ``TAKEN`` least k-mers of five words, labelled by their occurrence so that a repeated k-mer counts as often
as it stands there, and keeps them in the order of the text.  Two texts that share an entry are candidates; unlike a
plain MinHash, texts of the same k-mers in another order rarely do.  A candidate pair is a link if its edit distance in
words is at most 1 - ``THRESHOLD`` of the longer text.  Classes are the connected components of the links, with equal
texts collapsed before and attached after.

For texts whose five-word shingles have a Jaccard similarity of 0.8 the chance to share no entry is below 10^-20; by
edit similarity alone it is some 1 in 10^4 at 0.9 and grows below that, as few five-word k-mers survive there.

Entries are sorted by (entry, length, text) into ranges, so the rows of a frequent entry lie in many tasks, and each
row is paired with the ``NEIGHBOURS`` before it, across the borders of the ranges too.  Rows of an entry are thus linked
in chains whose number grows with the rows, whatever the size of a group; a group's chains differ from entry to entry.
What the chains leave apart is then compared exactly (see :func:`apart`): all pairs that share an entry and lie in
different components, so classes are those of all links, and a link that is not looked at joins texts of one class.

Defined cases: null and empty texts are equal and form one class; texts without words are compared as they are; a row
of a null id joins the class of its text but is never its name; classes that share a name (null or a repeated id) differ
in ``class_key``; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.alignment import distances
from starloom.llm.common import arrow_batches, content_key, filter_rows, gathered, staged
from starloom.llm.components import components
from starloom.llm.neighbours import neighbours
from starloom.llm.words import SHINGLE, WordHashes, mixed, shingles, words_of
from starloom.operators.skew import split_left_join

THRESHOLD = 0.8
SKETCHES, TAKEN, NEIGHBOURS = 48, 2, 2
#: Share of the rows from which a text or a class is dealt over many tasks.
HOT_SHARE = 0.005
#: Bins of hashed words by which pairs that cannot be links are told, and texts that a task compares with the rest of an entry at once.
BINS, BLOCK = 128, 256
#: Bins of hashed pairs of words in a row, for the pairs of texts that the words leave.
PAIR_BINS = 512
_ODD = np.random.default_rng(8).integers(1, 1 << 63, size=(2, SKETCHES), dtype=np.uint64) | np.uint64(1)


def order_sketch(hashes: np.ndarray) -> np.ndarray:
    """One number per hash function: the least occurrence-labelled k-mers, in text order."""
    own = shingles(hashes, min(SHINGLE, len(hashes)))
    labelled = own
    values, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
    if len(values) < len(own):
        order = np.argsort(inverse, kind="stable")
        begins = np.repeat(np.cumsum(counts) - counts, counts)
        occurrence = np.empty(len(own), np.uint64)
        occurrence[order] = (np.arange(len(own)) - begins).astype(np.uint64)
        labelled = mixed(own + occurrence * _ODD[0, 0])
    if len(own) == 1:
        picked = np.broadcast_to(own, (1, SKETCHES))
    else:
        places = [_least(labelled, part) for part in np.array_split(np.arange(SKETCHES), max(1, len(own) * SKETCHES >> 20))]
        picked = own[np.sort(np.concatenate(places, axis=1), axis=0)]
    entry = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    for hashes_in_order in picked:
        entry = entry * _ODD[0, 1] + hashes_in_order
    return mixed(entry)


def _least(labelled: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """Places of the TAKEN = 2 least values under each hash function."""
    ranks = mixed(labelled)[None, :] * _ODD[0, functions, None] + _ODD[1, functions, None]
    first = ranks.argmin(axis=1)
    ranks[np.arange(len(functions)), first] = np.iinfo(np.uint64).max
    return np.stack([first, ranks.argmin(axis=1)])


def bins_of(hashes: np.ndarray) -> bytes:
    """Words per bin, then pairs of words in a row per bin."""
    parts = []
    for values, many in ((hashes, BINS), (shingles(hashes, 2), PAIR_BINS)):
        counts = np.bincount((values & np.uint64(many - 1)).astype(np.int64), minlength=many)
        parts.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
    return b"".join(parts)


def sketches(docs: DataFrame) -> DataFrame:
    """(content, n_words, entries, words, bins) for each distinct text with words; ``words`` are their packed 32-bit
    numbers, ``bins`` counts the words, and the pairs of words in a row, per bin (up to 255).

    Copies are collapsed in the tasks before anything moves, and from here on no text is read again.
    """
    rows = docs.select(content_key().alias("content"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        with np.errstate(over="ignore"):
            for batch in batches:
                ids, sizes, entries, packed, bins = [], [], [], [], []
                for content, text in zip(batch.column("content").to_pylist(), batch.column("text").to_pylist()):
                    if content in seen:
                        continue
                    if len(seen) < 100_000:  # saves work on copies; what it doesn't see the aggregate below does
                        seen.add(content)
                    own = hashes.of(words_of(text))
                    if len(own):
                        ids.append(content)
                        sizes.append(len(own))
                        entries.append(order_sketch(own))
                        packed.append(own.astype(np.uint32).tobytes())
                        bins.append(bins_of(own))
                flat = np.concatenate(entries).view(np.int64) if entries else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * SKETCHES), pa.array(flat))
                columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), lists, pa.array(packed, pa.binary()), pa.array(bins, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["content", "n_words", "entries", "words", "bins"])

    found = rows.mapInArrow(sketch, "content long, n_words int, entries array<long>, words binary, bins binary")
    return found.groupBy("content").agg(*[F.first(c).alias(c) for c in ("n_words", "entries", "words", "bins")])


def candidates(sketched: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of texts next to each other under some entry."""
    rows = sketched.select(F.explode("entries").alias("entry"), F.col("n_words").alias("value"), F.col("content").alias("node"))
    return neighbours(rows, ("entry", "value", "node"), NEIGHBOURS, THRESHOLD).select("a", "b").distinct()


def _may_link(x: dict[str, np.ndarray], y: dict[str, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the ``wanted`` pairs in different components that neither lengths nor bins rule out as links.

    An edit distance is at least the surplus of words of either side, in bins too, and half the surplus of pairs of words
    in a row, as an edit takes part in two of them on either side.
    """
    n, m = x["n_words"][:, None], y["n_words"][None, :]
    i, j = np.nonzero(wanted & (x["root"][:, None] != y["root"][None, :]) & (np.minimum(n, m) >= THRESHOLD * np.maximum(n, m)))
    kept = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 13):
        left = np.arange(at, min(at + (1 << 13), len(i)))
        for bins, share in ((slice(0, BINS), 1), (slice(BINS, None), 2)):
            own, other = i[left], j[left]
            gap = x["bins"][own, bins] - y["bins"][other, bins]
            positive, total = np.maximum(gap, 0).sum(axis=1, dtype=np.int64), gap.sum(axis=1, dtype=np.int64)
            limit = share * np.floor((1 - THRESHOLD) * np.maximum(x["n_words"][own], y["n_words"][other]) + 1e-9)
            left = left[np.maximum(positive, positive - total) <= limit]
        kept[left] = True
    return i[kept], j[kept]


def _close(x: dict[str, np.ndarray], y: dict[str, np.ndarray], entry: int, wanted: np.ndarray) -> list[tuple[int, int, int]]:
    """Links (a, b, distance) among the ``wanted`` pairs of an entry, if it is the first entry that the two texts share."""
    found = []
    i, j = _may_link(x, y, wanted)
    for at in range(0, len(i), 1 << 12):
        own, other = i[at : at + (1 << 12)], j[at : at + (1 << 12)]
        same = x["entries"][own] == y["entries"][other]
        first = x["entries"][own, same.argmax(axis=1)] == entry
        own, other = own[first], other[first]
        pairs = [(np.frombuffer(x["words"][a], np.uint32), np.frombuffer(y["words"][b], np.uint32)) for a, b in zip(own, other)]
        near = distances(pairs, [int((1 - THRESHOLD) * max(len(a), len(b)) + 1e-9) for a, b in pairs])
        for a, b, d in zip(x["node"][own].tolist(), y["node"][other].tolist(), near):
            if d is not None:
                found.append((min(a, b), max(a, b), d))
    return found


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by block, its own texts (part 0) first; those are held, the others pass by."""
    names, block, own = ("root", "part", "node", "n_words", "bins", "entries", "words"), None, None
    take = lambda rows, which: {k: v[which] for k, v in rows.items()}
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("entry", "slice", "root", "part", "node", "n_words", "words")}
        whole["entries"] = np.asarray(batch.column("entries").flatten()).reshape(batch.num_rows, -1)
        whole["bins"] = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, BINS + PAIR_BINS).astype(np.int16)
        changed = (whole["entry"][1:] != whole["entry"][:-1]) | (whole["slice"][1:] != whole["slice"][:-1])
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        found: list[tuple[int, int, int]] = []
        for low, high in zip(edges, edges[1:]):
            if low == high:
                continue
            key, rows = (whole["entry"][low], whole["slice"][low]), {k: whole[k][low:high] for k in names}
            if key != block:
                block, own = key, take(rows, slice(0, 0))
            fresh, others = take(rows, rows["part"] == 0), take(rows, rows["part"] > 0)
            old = len(own["node"])
            own = {k: np.concatenate([own[k], fresh[k]]) for k in names}
            # Each pair once: of two texts that are both some block's own, by the one of the lesser number.
            later = np.arange(len(own["node"]))[:, None] < old + np.arange(len(fresh["node"]))[None, :]
            for side, wanted in ((fresh, later), (others, (others["part"] == 2)[None, :] | (own["node"][:, None] < others["node"][None, :]))):
                found += _close(own, side, key[0], wanted)
        columns = [pa.array([r[c] for r in found], pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "distance"])


def apart(sketched: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b, distance), a < b, of texts that share an entry and lie in different components of ``labels`` (node, root).

    Entries whose rows are of one component have none, and up to ``NEIGHBOURS`` + 1 rows are all neighbours.  The rest
    of an entry is compared block by block: the texts outside its largest component, ``BLOCK`` at a time, with all its
    rows, which pass by in batches.  So memory is bounded, and the work on an entry is its rows times those outside.
    Pairs are aligned where they meet and never leave the task, each under the first entry that the two share: if that
    one has too few rows to be here, they were neighbours.
    """
    near = labels.select(F.col("node").alias("__node"), "root")
    texts = sketched.select("content", "n_words", "entries").join(near, F.col("content") == F.col("__node"), "left")
    rows = texts.select(F.explode("entries").alias("entry"), F.col("content").alias("node"), "n_words", F.coalesce("root", "content").alias("root"))
    ends = rows.groupBy("entry").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    mixed = staged(ends.where((F.col("low") < F.col("high")) & (F.col("n") > NEIGHBOURS + 1)).select("entry"), "entries")
    rows = staged(rows.join(mixed, "entry", "left_semi"), "apart")
    by_root = rows.groupBy("entry", "root").agg(F.count("*").alias("n"))
    largest = by_root.groupBy("entry").agg(F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("outside"))
    slices = F.ceil(F.col("outside") / BLOCK)
    outside = F.col("root") != F.col("main")
    blocks = (
        rows.join(largest, "entry").join(sketched.select(F.col("content").alias("node"), "bins", "entries", "words"), "node")
        .withColumn("home", F.pmod(F.xxhash64("node"), slices))
        .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)))
        .withColumn("part", F.when(~outside, 2).otherwise((F.col("home") != F.col("slice")).cast("int")))
    )
    ordered = blocks.select("entry", "slice", "part", "root", "node", "n_words", "bins", "entries", "words").repartition("entry", "slice").sortWithinPartitions("entry", "slice", "part")
    return ordered.mapInArrow(_across, "a long, b long, distance long")


def verified(sketched: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose alignment is close enough: (a, b, distance)."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("content")).distinct()
    # One row per text on either side, so the joins know no hot key; the plan is the same at every size.
    numbers = staged(sketched.select("content", "words").join(wanted.hint("merge"), "content", "left_semi"), "words")
    both = pairs
    for side in ("a", "b"):
        both = both.join(numbers.select(F.col("content").alias(side), F.col("words").alias(f"words_{side}")).hint("merge"), side)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in gathered(batches, ("words_a", "words_b")):
            sides = [[np.frombuffer(x, np.uint32) for x in some.column(f"words_{s}").to_pylist()] for s in "ab"]
            pairs = list(zip(*sides))
            limits = [int((1 - THRESHOLD) * max(len(a), len(b)) + 1e-9) for a, b in pairs]
            found = distances(pairs, limits)
            ok = pa.array([i for i, d in enumerate(found) if d is not None], pa.int64())
            yield pa.RecordBatch.from_arrays([some.column(c).combine_chunks().take(ok) for c in "ab"] + [pa.array([d for d in found if d is not None], pa.int64())], names=["a", "b", "distance"])

    return both.select("a", "b", "words_a", "words_b").mapInArrow(align, "a long, b long, distance long")


def links(docs: DataFrame) -> DataFrame:
    """Verified links between distinct texts, by their content keys: (a, b, distance)."""
    arrow_batches(docs.sparkSession)
    return linked(staged(sketches(docs), "sketches"))


def linked(sketched: DataFrame) -> DataFrame:
    """The links between neighbours, and then those between the components that these leave apart."""
    found = staged(verified(sketched, staged(candidates(sketched), "pairs")), "verified")
    return staged(found.unionByName(apart(sketched, components(found))), "verified")


def _hot(counts: DataFrame, key: str, total: int) -> list[int]:
    """Keys of (key, n) that hold at least ``HOT_SHARE`` of all rows: at most 1 / ``HOT_SHARE`` of them."""
    return [r[0] for r in counts.where(F.col("n") >= max(2, HOT_SHARE * total)).select(key).collect()]


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, content, class_id (the least id of its class), class_key (tells classes apart, whatever their
    ids: null where no row of a class has an id, and the same where an id is repeated), n_links (of its text to
    different texts)."""
    found = links(docs)
    degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    rooted = staged(components(found).join(degree, "node"), "labels")
    # The place deals copies without an id.
    rows = docs.select("doc_id", content_key().alias("content"), F.spark_partition_id().alias("place"))
    texts = rows.groupBy("content").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    texts = texts.join(rooted, F.col("content") == F.col("node"), "left")
    texts = staged(texts.select("content", "least", "n", F.coalesce("root", "content").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "texts")
    names = staged(texts.groupBy("root").agg(F.min("least").alias("class_id"), F.count("*").alias("n")), "names")
    many = texts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Frequent copies and classes of many texts are dealt over the tasks of both joins.
    named = split_left_join(texts.drop("n"), names.drop("n"), "root", _hot(names, "root", many[1]), ["content"])
    named = named.select("content", "class_id", F.col("root").alias("class_key"), "n_links")
    joined = split_left_join(rows, named, "content", _hot(texts, "content", many[0]), ["doc_id", "place"])
    return joined.select("doc_id", "content", "class_id", "class_key", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, the one with the least id (null ids last), with the columns it came with."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "content")).alias("first")
    one = classes(docs).groupBy("class_key").agg(least).select("first.doc_id", "first.content")
    names = docs.columns
    # A content has one class, so rows that are left of one content repeat each other.
    kept = filter_rows(docs, one, keep=True).withColumn("__key", content_key()).dropDuplicates(["__key"])
    return kept.select(*[F.col(f"`{n}`") for n in names])
