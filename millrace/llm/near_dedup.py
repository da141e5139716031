"""Near-duplicate texts by Order MinHash, verified by banded alignment.

The k-mers of a text are its runs of five words, labelled by how often each
occurred before. A sketch takes the k-mers of the least hashes under its own
hash function and keeps them in text order, so texts meet in a sketch as their
edit similarity, not just their set similarity, is high. Texts that meet are
compared by signatures of 128 bins, then k-mer by k-mer, then aligned; a link
needs aligned k-mers over all k-mers of 0.8 or more. Links join texts to
classes.

Within a bucket of equal sketches a leader is compared with the other members.
Half of the buckets take their leader from the other end, so that members linked to
different leaders meet again. These links make classes; texts of one class need
not be compared. A bucket in which classes differ after that holds texts with a
common passage, not copies: links between its classes are sought among the rarest
k-mers that classes share, an exact filter, and parities of all k-mers rule out
most pairs that meet there, exactly, too. Where many pairs meet even there,
leaders go first, until every text is a leader or linked to one. Exact copies
are one text throughout.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import CHUNK_BYTES, bytes_list, cuts, discard, fresh, materialize, rows_of
from millrace.llm.hashing import U, Prefix, mix, words_of

SHINGLE, THRESHOLD = 5, 0.8
#: (sketches, k-mers in each, least k-mers of a text, most k-mers of a text and one): two texts of similarity 0.8
#: are both in one of the two kinds. Large ones meet in no sketch with a chance of about (1 - 0.8**4)**32 = 5e-8;
#: small ones of at least 5 k-mers with (1 - 0.6)**16 = 4e-7 at most. Fewer k-mers reach 0.8 by equality only.
LARGE, SMALL = (32, 4, 16, 1 << 62), (16, 2, 1, 20)
#: Bins of a signature: each keeps a byte of the least hash of its k-mers. Texts of similarity 0.8 agree in
#: 0.8 of the filled bins; pairs DEVIATIONS standard deviations below are not compared further (less than 2e-6 of links).
BINS, DEVIATIONS = 128, 5.0
#: Rounds in which a bucket of equal sketches has one leader: each compares fewer pairs than buckets have members.
LEADERS = 2
#: Up to so many pairs of different classes a member of the buckets of rare k-mers are asked at once, without rounds of leaders.
MEETINGS = 256
#: Bits of a text's parities: one costs 128 bytes a row of the buckets of rare k-mers.
BITS = 1024


def bounds(n: np.ndarray, k: int) -> np.ndarray:
    """For texts of ``n`` random numbers, values that about 4k of them are below."""
    share = np.where(n > 4 * k, 4.0 * k / n, 1.0)
    return np.where(share < 1, share * 2.0**64, 2.0**64 - 2048).astype(U)


def least_places(value: np.ndarray, bound: np.ndarray, n: np.ndarray, owner: np.ndarray, k: int) -> np.ndarray:
    """(texts, k): in text order the places of the ``k`` least values of each text; every text has so many.

    Values up to ``bound`` are looked at; a text with fewer than k there is sorted whole.
    """
    at = np.flatnonzero(value <= bound)
    few = np.bincount(owner[at], minlength=len(n)) < k
    if few.any():
        at = np.flatnonzero((value <= bound) | few[owner])
    at = at[np.argsort((owner[at].astype(U) << U(40)) | (value[at] >> U(24)), kind="stable")]
    head = np.searchsorted(owner[at], np.arange(len(n)))
    return np.sort(at[head[:, None] + np.arange(k)[None, :]], axis=1)


def sketches(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(k-mers of each text, bucket hashes of each text, (texts, BINS) of signature bytes, 0 for an empty bin)."""
    hashes, _, _, first = words_of(texts)
    sizes = np.maximum(0, np.diff(first) - SHINGLE + 1)
    buckets: list[np.ndarray] = [np.zeros(0, U)] * len(texts)
    signature = np.zeros((len(texts), BINS), np.uint8)
    some = np.flatnonzero(sizes)
    if not len(some):
        return sizes, buckets, signature
    n = sizes[some]
    begin = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(n)), n)
    kmer = mix(Prefix(hashes[0]).grams(SHINGLE))[np.arange(begin[-1]) - begin[owner] + first[:-1][some][owner]]
    # The occurrence label: the place among equal k-mers of the text.
    apart = mix(kmer + owner.astype(U) * U(0xA24BAED4963EE407))
    by = np.argsort(apart, kind="stable")
    same = np.concatenate([[False], apart[by[1:]] == apart[by[:-1]]])
    place = np.arange(len(by))
    label = np.empty(len(by), U)
    label[by] = place - np.maximum.accumulate(np.where(same, 0, place))
    kmer = mix(kmer + label * U(0x9FB21C651E98DF25))

    least = np.full(len(n) * BINS, 0xFFFFFFFF, np.uint32)
    np.minimum.at(least, owner * BINS + (kmer % U(BINS)).astype(np.int64), (kmer >> U(32)).astype(np.uint32))
    signature[some] = np.where(least == 0xFFFFFFFF, 0, 1 + least % 255).astype(np.uint8).reshape(-1, BINS)

    found: list[list[np.ndarray]] = [[] for _ in n]
    for kind, (count, minima, low, high) in enumerate((LARGE, SMALL)):
        mine = np.flatnonzero((n >= max(low, minima)) & (n < high))
        if len(mine):
            inside = np.isin(owner, mine)
            m, own, k = n[mine], np.searchsorted(mine, owner[inside]), kmer[inside]
            bound = bounds(m, minima)[own]
            out = np.empty((len(mine), count), U)
            for j in range(count):
                seed = mix(np.full(1, (kind * 64 + j + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF, U))[0]
                at = least_places(mix(k ^ seed), bound, m, own, minima)  # products with related numbers would be related ranks
                sketch = np.full(len(mine), seed, U)
                for i in range(minima):
                    sketch = mix(sketch * U(0x9E3779B97F4A7C15) + k[at[:, i]])
                out[:, j] = sketch
            for i, row in zip(mine, out, strict=True):
                found[i].append(row)
    for i in np.flatnonzero(n < SMALL[1]):  # too few k-mers for a sketch: all of them
        found[i].append(mix(Prefix(kmer[begin[i] : begin[i + 1]]).stretches(np.array([0]), n[i : i + 1])))
    for i, rows in zip(some, found, strict=True):
        buckets[i] = np.concatenate(rows)
    return sizes, buckets, signature


def aligned(a: list[int], b: list[int], band: int) -> int:
    """Most k-mers that an alignment matches in order, none further than ``band`` off the diagonal.

    Rows of the dynamic programme are the bits of one integer (bit-parallel
    longest common subsequence); matches outside the band are masked.
    """
    lead = 0
    while lead < min(len(a), len(b)) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[lead : len(a) - tail], b[lead : len(b) - tail]
    if not a or not b:
        return lead + tail
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    every = (1 << len(a)) - 1
    v = every
    for j, x in enumerate(b):
        if x in where:
            m = 0
            for i in where[x]:
                if -band <= i - j <= band:
                    m |= 1 << i
            u = v & m
            v = ((v + u) | (v - u)) & every
    return lead + tail + len(a) - v.bit_count()


def similarity(a: list[int], b: list[int], threshold: float = THRESHOLD) -> float:
    """Aligned k-mers over all k-mers; 0 where it can't reach the threshold."""
    total = len(a) + len(b)
    least = int(np.ceil(threshold / (1 + threshold) * total - 1e-9))  # matches that the threshold takes
    if not total or min(len(a), len(b)) < least:
        return 0.0
    if a != b and (Counter(a) & Counter(b)).total() < least:  # in any order
        return 0.0
    got = aligned(a, b, total - 2 * least)  # an alignment with so many matches strays no further
    return got / (total - got)


def signatures(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) to doc_id, tkey, n_kmers, buckets, signature; null texts are empty and have no k-mers."""
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tkey", F.unhex(F.md5("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, "text", CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                n, buckets, signature = sketches(bytes_list(part.column("text")))
                ends = np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(buckets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tkey"), pa.array(n, pa.int32()), lists, pa.array([s.tobytes() for s in signature], pa.binary())], ["doc_id", "tkey", "n_kmers", "buckets", "signature"])

    return keyed.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tkey binary, n_kmers int, buckets array<long>, signature binary")


def parities(kmers: np.ndarray) -> np.ndarray:
    """BITS bits as longs: whether an odd number of the labelled k-mers falls on each. Two texts differ in as many k-mers as bits, or more."""
    return np.packbits(np.bincount((kmers % U(BITS)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).view(np.int64)


def least_shared(threshold: float) -> Column:
    """K-mers that a member and ``l`` must share for a link."""
    return F.ceil(threshold / (1 + threshold) * (F.col("n") + F.col("l.n")) - 1e-9)


def parities_allow(threshold: float) -> Column:
    """Whether the parities of a member and ``l`` leave room for a link: exact, they never rule one out."""
    differ = reduce(add, (F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("l.bits")[i])) for i in range(BITS // 64)))
    return differ <= F.col("n") + F.col("l.n") - 2 * least_shared(threshold)


def kmers_of(texts: list[bytes]) -> list[np.ndarray]:
    hashes, _, _, first = words_of(texts)
    grams = mix(Prefix(hashes[0]).grams(SHINGLE))
    return [grams[a : max(a, b - SHINGLE + 1)] for a, b in zip(first[:-1], first[1:], strict=True)]


def with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """pairs (a, b) with ``column`` of both as x and y."""
    side = lambda key, name: table.select(F.col("tkey").alias(key), F.col(column).alias(name))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")


def likely(pairs: DataFrame, sigs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) with ok: their signatures don't rule out a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("x", "y"))
                filled = ((x > 0) | (y > 0)).sum(axis=1)
                agreed = ((x == y) & (x > 0)).sum(axis=1)
                ok = agreed >= threshold * filled - DEVIATIONS * np.sqrt(threshold * (1 - threshold) * filled)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok)], ["a", "b", "ok"])

    return with_both(pairs, sigs, "signature").mapInArrow(run, "a binary, b binary, ok boolean")


def verified(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, threshold: float) -> list[DataFrame]:
    """Tables of the pairs (a, b) with ``linked``: those that texts decided, and those that signatures did; none for no pairs."""
    asked = materialize(likely(pairs, sigs, threshold), "near-likely")
    both = with_both(asked.filter("ok").select("a", "b"), texts, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, "x", CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                p, q = ([k.tolist() for k in kmers_of(bytes_list(part.column(c)))] for c in ("x", "y"))
                linked = [similarity(i, j, threshold) >= threshold for i, j in zip(p, q, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    # A row that is stated twice brings its pairs twice.
    out = materialize(both.mapInArrow(run, "a binary, b binary, linked boolean").groupBy("a", "b").agg(F.max("linked").alias("linked")), "near-pairs")
    refused = asked.filter("not ok").select("a", "b", F.lit(False).alias("linked"))
    refused.folder = asked.folder
    return [out, refused]


def components(edges: DataFrame) -> DataFrame:
    """A table (node, comp) for edges (a, b): least reachable node, by rounds of neighbours' minima and jumps; no rows for no edges."""
    both = materialize(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-links")
    first = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp"), F.lit(None).cast("binary").alias("old"))
    table = materialize(first, "near-labels")
    while True:
        labels = table.select("node", "comp")
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        # A node's label, its neighbours' labels, and the label of the label.
        jumped = labels.join(labels.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp").join(near.withColumnRenamed("a", "node"), "node")
        new = materialize(jumped.select("node", F.least("root", "near").alias("comp"), F.col("comp").alias("old")), "near-labels")
        discard(table)
        table = new
        if not new.filter(F.col("comp") != F.col("old")).limit(1).count():
            discard(both)
            return table


def union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, tables)


def parity_columns(state: DataFrame) -> list[str]:
    return ["bits"] if "bits" in state.columns else []


def live(state: DataFrame) -> DataFrame:
    """Members of the buckets in which something is left to ask: the last one of a bucket has met all others, and without an open one nobody asks."""
    bucket = Window.partitionBy("bucket")
    counted = state.withColumn("c", F.count(F.lit(1)).over(bucket)).withColumn("any", F.max("open").over(bucket))
    return counted.filter("any and c > 1").select("bucket", "tkey", "n", "rest", "order", "open", *parity_columns(state))


def leader_rounds(state: DataFrame, sigs: DataFrame, texts: DataFrame, known: list[DataFrame], threshold: float, leaders: tuple[int, ...] | None) -> tuple[list[DataFrame], DataFrame | None]:
    """Rounds of leaders in buckets (bucket, tkey, n, rest, order, open): pairs asked so far, and what is left open, as tables.

    Buckets are ``live``. Open means neither a leader yet nor linked to one. In every round the
    first members of a bucket, more of them each time, are asked against
    all members that have not led. ``rest`` bounds the k-mers that a member can
    share in this bucket; pairs that the bounds, or parities (``bits``, if there), rule out are not asked.

    With ``leaders``, the numbers of the rounds, they are open members. Without,
    rounds go on, buckets have members in order of size and leaders are whoever
    comes first, so all that are left are no smaller than the last leader, and
    a member whose bound rules out partners of that size is no longer open.
    """
    last = Window.partitionBy("bucket").orderBy("order")
    bits = parity_columns(state)
    done, table = 0, None  # the table that the state is read from, if it is one of ours

    def least(n1: str, n2: str) -> Column:
        return F.ceil(threshold / (1 + threshold) * (F.col(n1) + F.col(n2)) - 1e-9)

    while leaders is None or done < len(leaders):
        count = 4**done if leaders is None else leaders[done]
        who = state.filter("open") if leaders is not None else state
        first = who.withColumn("place", F.row_number().over(last)).filter(F.col("place") <= count).select("bucket", F.struct("tkey", "n", "rest", "open", *bits).alias("l"))
        leads = F.col("tkey") == F.col("l.tkey")
        fits = (F.col("open") | F.col("l.open")) & (least("n", "l.n") <= F.least("rest", "l.rest"))
        fits = fits & parities_allow(threshold) if bits else fits
        met = state.join(first, "bucket").filter(leads | fits)
        met = materialize(met.select("bucket", "tkey", F.least("tkey", "l.tkey").alias("a"), F.greatest("tkey", "l.tkey").alias("b"), leads.alias("leads"), F.col("l.n").alias("size")), "near-meetings")
        asked = met.filter("not leads").select("a", "b").distinct()
        asked = asked.join(union(known), ["a", "b"], "left_anti") if known else asked
        # Pairs that signatures rule out are remembered, too: no later round asks them again.
        known = [*known, *verified(asked, sigs, texts, threshold)]
        linked = union(known).filter("linked").select("a", "b", F.lit(True).alias("is_linked"))
        told = met.join(linked, ["a", "b"], "left").groupBy("bucket", "tkey").agg(F.max("leads").alias("led"), F.max(F.coalesce("is_linked", F.lit(False))).alias("joined"))
        sizes = met.filter("leads").groupBy("bucket").agg(F.max("size").alias("size"))
        left = state.join(sizes, "bucket").join(told, ["bucket", "tkey"], "left").filter("not coalesce(led, false)")
        open_ = F.col("open") & ~F.coalesce("joined", F.lit(False))
        if leaders is None:
            open_ &= least("n", "size") <= F.col("rest")
        state = materialize(live(left.withColumn("open", open_)), "near-state")
        discard(met, table)
        table = state
        done += 1
        if not state.limit(1).count():
            discard(state)
            return known, None
    return known, state


def followers(members: DataFrame, classed: DataFrame) -> DataFrame:
    """A table of the members of buckets in which classes still differ, without the leader, with ``comp`` and the next leader ``l``.

    A bucket's leader has met all others and has nobody left to ask; others of one
    class are joined, whether or not they were compared.
    """
    comps, bucket = classed.select(F.col("node").alias("tkey"), "comp"), Window.partitionBy("bucket")
    others = members.filter(F.col("tkey") != F.col("l.tkey")).select("bucket", "tkey", "n", "order").join(comps, "tkey", "left").withColumn("comp", F.coalesce("comp", "tkey"))
    led = others.withColumn("c1", F.min("comp").over(bucket)).withColumn("c2", F.max("comp").over(bucket)).withColumn("l", F.min(F.struct("order", "tkey", "n", "comp")).over(bucket))
    return materialize(led.filter("c1 < c2").drop("c1", "c2"), "near-followers")


def rare_buckets(who: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Buckets of rare k-mers for texts (tkey, n, order, comp) that may have links to other classes: the prefix filter.

    Two texts of the threshold's similarity share one of each text's
    n - ceil(t*n) + 1 rarest k-mers, whatever order rarity has, as long as it
    is one order for all. K-mers that no other class has stand first in it: they
    are shared by no pair that is asked for.
    """

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, "text", CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                kmers, bits = [], []
                for x in kmers_of(bytes_list(part.column("text"))):
                    x = np.sort(x)
                    place = np.arange(len(x))
                    start = np.concatenate([[True], x[1:] != x[:-1]])
                    x = mix(x + (place - np.maximum.accumulate(np.where(start, place, 0))).astype(U) * U(0x9FB21C651E98DF25))
                    kmers.append(x.view(np.int64))
                    bits.append(parities(x))
                yield pa.RecordBatch.from_arrays([part.column("tkey"), pa.array(kmers, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], ["tkey", "kmers", "bits"])

    ours = texts.join(who.select("tkey"), "tkey", "left_semi").groupBy("tkey").agg(F.first("text").alias("text"))
    lists = materialize(ours.select("tkey", "text").mapInArrow(labelled, "tkey binary, kmers array<long>, bits array<long>").join(who, "tkey"), "near-left-kmers")
    kmers = lists.select("tkey", "n", "order", "comp", F.explode("kmers").alias("kmer"))
    common = kmers.groupBy("kmer").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("c1"), F.max("comp").alias("c2")).filter("c1 < c2").select("kmer", "df")
    met = kmers.join(common, "kmer")
    own = Window.partitionBy("tkey")  # bounded by the length of a text
    met = met.withColumn("m", F.count(F.lit(1)).over(own)).withColumn("rn", F.row_number().over(own.orderBy("df", "kmer")))
    met = met.filter(F.col("rn") <= F.col("m") - F.ceil(threshold * F.col("n") - 1e-9) + 1)
    met = met.withColumn("rest", F.col("m") - F.col("rn") + 1)  # what two texts share, their first shared k-mer and later ones
    met = met.join(lists.select("tkey", "bits"), "tkey")
    met = materialize(met.select(F.col("kmer").alias("bucket"), "tkey", "n", "rest", F.struct("n", "order").alias("order"), F.lit(True).alias("open"), "comp", "bits"), "near-rare")
    discard(lists)
    return met


def class_pairs(who: DataFrame, known: list[DataFrame], threshold: float) -> DataFrame:
    """Pairs (a, b) of rare buckets (bucket, tkey, n, rest, comp) whose ends lie in different classes and that weren't asked.

    One end of each lies outside the bucket's largest class, so that class never meets
    itself. Parities (``bits``, if there) rule out most of what meets.
    """
    sizes = who.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.max(F.struct("c", "comp")).alias("most"))
    who = who.join(sizes.filter("classes > 1").select("bucket", F.col("most.comp").alias("most")), "bucket")
    ours = who.filter("comp <> most").select("bucket", F.struct("tkey", "n", "rest", "comp", *parity_columns(who)).alias("l"))
    fits = ((F.col("comp") == F.col("most")) | (F.col("tkey") < F.col("l.tkey"))) & (F.col("comp") != F.col("l.comp")) & (least_shared(threshold) <= F.least("rest", "l.rest"))
    met = who.join(ours, "bucket").filter(fits & parities_allow(threshold) if parity_columns(who) else fits)
    met = met.select(F.least("tkey", "l.tkey").alias("a"), F.greatest("tkey", "l.tkey").alias("b")).distinct()
    return met.join(union(known).select("a", "b"), ["a", "b"], "left_anti")


def across_classes(state: DataFrame, sigs: DataFrame, texts: DataFrame, known: list[DataFrame], threshold: float) -> list[DataFrame]:
    """``known`` plus the pairs of rare buckets whose ends lie in different classes after leaders' rounds and that weren't asked.

    A text without any link stays open until it leads, so all its pairs were
    asked; what leaders can miss are links between texts that both have links.
    """
    classed = components(union(known).filter("linked").select("a", "b"))
    comps = classed.select(F.col("node").alias("tkey"), "comp")
    who = materialize(state.select("bucket", "tkey", "n", "rest", *parity_columns(state)).join(comps, "tkey"), "near-classed")
    found = verified(class_pairs(who, known, threshold), sigs, texts, threshold)
    discard(classed, who)
    return [*known, *found]


def between_classes(rare: DataFrame, sigs: DataFrame, texts: DataFrame, known: list[DataFrame], threshold: float) -> list[DataFrame]:
    """Tables of asked pairs beside ``known`` that leave no link between different classes of rare buckets unfound.

    Where few pairs meet, all of them are asked. Else leaders go first: members of
    groups that ``known`` doesn't join are linked to a few and need not all meet.
    """
    per = rare.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("same"))
    rows, meetings = per.agg(F.sum("c"), F.sum((F.col("c") * F.col("c") - F.col("same")) / 2)).first()
    if (meetings or 0) <= MEETINGS * (rows or 0):
        return verified(class_pairs(rare, known, threshold), sigs, texts, threshold)
    met, _ = leader_rounds(live(rare), sigs, texts, known, threshold, None)
    return across_classes(rare, sigs, texts, met, threshold)[len(known) :]


def joined_classes(classed: DataFrame, found: list[DataFrame]) -> DataFrame:
    """``classed`` (node, comp) with the classes joined that the links among ``found`` join; the table replaces ``classed``."""
    new = union(found).filter("linked").select("a", "b") if found else None
    if new is None or not new.limit(1).count():
        return classed
    for end in ("a", "b"):
        new = new.join(classed.select(F.col("node").alias(end), F.col("comp").alias(f"{end}c")), end, "left").withColumn(end, F.coalesce(f"{end}c", end)).drop(f"{end}c")
    joins = components(new.filter("a <> b"))
    roots = joins.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    moved = classed.select("node", "comp").join(roots, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
    alone = joins.select("node", "comp").join(classed.select("node"), "node", "left_anti")  # texts that had no link before
    out = materialize(moved.unionAll(alone), "near-joined")
    discard(classed, joins)
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (least doc_id of its class), n_verified_links, keys of text and class, of each row.

    ``n_verified_links`` counts the other texts whose link to this one was verified on
    the way to the classes, those to leaders mostly. It is no degree: links inside a
    class are not all sought, and which ones are follows from hashes.

    A null text counts as empty; empty texts are copies of each other. Texts
    under five words have no k-mers and only exact copies. Rows with equal ids
    and texts are copies too. A class with null ids only has a null class_id.
    """
    docs = rows_of(df, id_col, text_col)
    keyed = materialize(signatures(docs), "near-signatures")
    sigs = materialize(keyed.groupBy("tkey").agg(F.min("doc_id").alias("rep"), F.first("n_kmers").alias("n"), F.first("buckets").alias("buckets"), F.first("signature").alias("signature")), "near-texts")
    order = F.xxhash64("tkey", F.lit(7))
    rows = sigs.select("tkey", "n", order.alias("order"), F.explode("buckets").alias("bucket"))
    rows = rows.select("bucket", "tkey", "n", F.when(F.col("bucket") % 2 == 0, F.col("order")).otherwise(-F.col("order") - 1).alias("order"))
    bucket = Window.partitionBy("bucket")
    led = rows.withColumn("c", F.count(F.lit(1)).over(bucket)).withColumn("l", F.min(F.struct("order", "tkey", "n")).over(bucket)).filter("c > 1")
    members = materialize(led.drop("c"), "near-buckets")
    needed = members.select("tkey").distinct().join(sigs.select("tkey", "rep"), "tkey").select(F.col("tkey").alias("t"), F.col("rep").alias("r"))
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tkey", F.unhex(F.md5("text")))
    texts = materialize(texts.join(needed, F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("tkey") == F.col("t"))).select("tkey", "text"), "near-members")
    # Every member of a bucket with its leader, and the next ones; then, between the classes that this leaves, by rare k-mers.
    fits = F.ceil(threshold / (1 + threshold) * (F.col("n") + F.col("l.n")) - 1e-9) <= F.least("n", "l.n")
    known, found, classed = [], [], None
    for _ in range(LEADERS):
        apart = members.filter((F.col("tkey") != F.col("l.tkey")) & fits & (F.lit(True) if classed is None else F.col("comp") != F.col("l.comp")))
        asked = apart.select(F.least("tkey", "l.tkey").alias("a"), F.greatest("tkey", "l.tkey").alias("b")).distinct()
        found = verified(asked.join(union(known).select("a", "b"), ["a", "b"], "left_anti") if known else asked, sigs, texts, threshold)
        classed = components(found[0].filter("linked").select("a", "b")) if classed is None else joined_classes(classed, found)
        known, before = [*known, *found], members
        members = followers(before, classed)
        discard(before)
        if not members.limit(1).count():
            break
    else:
        rare = rare_buckets(members.groupBy("tkey", "n", "comp").agg(F.min("order").alias("order")), texts, threshold)
        found = between_classes(rare, sigs, texts, known, threshold)
        discard(rare)
        classed, known = joined_classes(classed, found), [*known, *found]
    comps = classed
    links = materialize(union(known).filter("linked").select("a", "b"), "near-linked")
    discard(*known)
    degree = links.select(F.col("a").alias("node")).unionAll(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count(F.lit(1)).alias("n_verified_links"))
    classes = sigs.select("tkey", "rep").join(comps.select(F.col("node").alias("tkey"), "comp"), "tkey", "left").join(degree.withColumnRenamed("node", "tkey"), "tkey", "left")
    classes = classes.select("tkey", "rep", F.coalesce("comp", "tkey").alias("comp"), F.coalesce("n_verified_links", F.lit(0)).alias("n_verified_links"))
    made = materialize(classes, "near-classes")
    least = materialize(made.groupBy("comp").agg(F.min("rep").alias("class_id")), "near-least")
    classes = made.join(least, "comp").select("tkey", "rep", "class_id", "n_verified_links", "comp")
    rows = materialize(keyed.select("doc_id", "tkey").join(classes, "tkey").select("doc_id", "class_id", "n_verified_links", "tkey", "rep", F.hex("comp").alias("class_key")), "near-rows")
    discard(keyed, sigs, members, texts, links, comps, made, least)
    return rows


def deduplicate(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` (with doc_id, text) with one row of each class: the one of the least doc_id, null last.

    Of equal rows one stays. Null and empty texts are copies of each other.
    Any further columns may have any names; an empty table stays empty.
    """
    key, best, place = fresh(df, "tkey", "best", "place")
    classes = near_duplicates(df, threshold=threshold)
    least = classes.groupBy("class_key").agg(F.min_by(F.struct("tkey", "doc_id"), F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias(best)).select(best)
    named = df.withColumn(key, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    named = named.join(least, (F.col(key) == F.col(best)["tkey"]) & F.col("doc_id").eqNullSafe(F.col(best)["doc_id"]))
    first = Window.partitionBy(key, "doc_id").orderBy(*[F.col(f"`{c}`") for c in df.columns if c not in ("doc_id", "text")] or [F.lit(1)])
    return named.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
