"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

**SuperMinHash.** Each shingle draws a random permutation of the signature's places, one place per rank, and proposes
``rank + uniform`` there; a place keeps the least value proposed. Ranks are worked through for all shingles of a slice
together: values of a later rank are larger, so a place that is filled stays as it is, and a document stops as soon as
all its places are filled, which is after a few ranks unless it is short.

**Banding.** Documents whose signatures agree in all rows of a band are candidates. With 24 bands of 4 rows a pair of
similarity 0.8 is missed with a chance of 3e-6, more alike pairs with less.

**Grouping without pairs.** Documents with equal shingle sets are one class from the start. In a bucket, all classes
are compared with its hub and not with each other. The hub is the class that shares its buckets with most others, as the
text does that the others were copied from. Verified links are united at once. Buckets that still hold classes of
different components go on without the hubs done: there, hubs are taken from all but the bucket's largest component, one
from each of ``h`` salts with ``h`` growing sixteenfold, and are compared with the classes of other components. So a
group of copies costs about one comparison per class, and no bucket is cut short: the rounds end when in each bucket
all classes left are in one component.

Classes are told apart by their sets and numbered, so ids may be of any type that can be ordered, and rows may share one.
Joins on a bucket start from written tables, so a bucket that holds many classes is split as a skewed join.

**Verification.** Before a pair is formed, its sizes and 512-bit parity maps must allow the similarity; both bounds
are exact, so they lose no link. Similarity is computed on the full sets of 52-bit shingle hashes: ``percent * union <= 100 *
intersection``. Chance collisions inside one pair are below 1e-7 even for sets of 20,000 shingles.

Defined cases: null texts and texts without words have no shingles, link with nothing and are kept; texts of fewer
words than a shingle are one shingle; rows that repeat a ``doc_id`` are one document if their sets are equal, otherwise
each links by itself under that id; a null id never becomes a representative, its row has a null component unless its
class has an id, and is kept; an empty table gives an empty result. Only the id and the text column are read.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.llm import bloom
from lotbook.llm.components import components
from lotbook.llm.text_arrays import LOWER, Texts, distinct, mix, multipliers, per_text, sums, windows
from lotbook.sources.scratch import save, save_counted

WIDTH = 4
PERCENT = 80
BANDS = 24
ROWS = 4
PARITY = tuple(f"_p{i}" for i in range(8))
SAME_SET = ("n_shingles", "_set1", "_set2")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle hash) pairs in ascending order."""
    spans = texts.words()
    words = spans.hashes(1, LOWER)
    hashes, first = windows(words, spans.owner, width, 2)
    owner = spans.owner[first]
    counts = spans.counts()
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        heads = np.cumsum(counts) - counts
        total = np.zeros(len(short), dtype=np.uint64)
        for place in range(width - 1):
            has = counts[short] > place
            total[has] = mix(total[has] ^ (words[heads[short[has]] + place] + np.uint64(place + 1)))
        owner = np.concatenate([owner, short])
        hashes = np.concatenate([hashes, mix(total + counts[short].astype(np.uint64))])
    owner, hashes, _ = distinct(owner, hashes)
    return owner, hashes


def super_minhash(owner: np.ndarray, hashes: np.ndarray, n: int, size: int) -> np.ndarray:
    """Signatures of ``n`` sets given as (set, element) pairs; infinite for an empty set."""
    signature = np.full(n * size, np.inf)
    state = mix(hashes + _GOLDEN)
    active = np.arange(len(owner))
    picks: list[np.ndarray] = []
    for rank in range(size):
        if not len(active):
            break
        draw = mix(state + multipliers(rank + 1, 5)[-1])
        place = rank + ((draw >> np.uint64(40)) % np.uint64(size - rank)).astype(np.int64)
        value = rank + (draw & np.uint64((1 << 40) - 1)).astype(np.float64) / float(1 << 40)
        # The place drawn, followed back through the swaps of earlier ranks.
        target = place.copy()
        for earlier in range(rank - 1, -1, -1):
            target[picks[earlier] == target] = earlier
        np.minimum.at(signature, owner[active] * size + target, value)
        picks.append(place)
        missing = np.isinf(signature.reshape(n, size)).any(axis=1)
        going = missing[owner[active]]
        if not going.all():
            active, state = active[going], state[going]
            picks = [p[going] for p in picks]
    return signature.reshape(n, size)


def _band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = mix(signature.view(np.uint64)).reshape(len(signature), bands, rows)
    key = np.zeros((len(signature), bands), dtype=np.uint64)
    for row in range(rows):
        key = mix(key ^ bits[:, :, row]) + np.uint64(row + 1)
    return mix(key + np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN).view(np.int64)


def _parities(owner: np.ndarray, hashes: np.ndarray, n: int) -> list[np.ndarray]:
    """A 512-bit map of each set in eight words: whether a bit's share of the elements is odd in number."""
    place = mix(hashes + np.uint64(4)) >> np.uint64(55)
    word, bit = place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63))
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, dtype=np.int64)
    out = []
    for number in range(len(PARITY)):
        bits = np.zeros(n, dtype=np.uint64)
        if len(heads):
            bits[owner[heads]] = np.bitwise_xor.reduceat(np.where(word == number, bit, np.uint64(0)), heads)
        out.append(bits.view(np.int64))
    return out


def _alike(a: str, b: str, percent: int):
    """Whether two classes can be similar enough, by their sizes and maps; never false for a pair that is.

    Bits that differ are at most as many as the elements that only one set has, and those are at most
    ``(100 - percent) / (100 + percent)`` of both sizes together.
    """
    n_a, n_b = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    apart = reduce(add, [F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in PARITY])
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (
        (100 + percent) * apart <= (100 - percent) * (n_a + n_b))


def _sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    fields = [*[T.StructField(c, T.LongType()) for c in SAME_SET],
              T.StructField("_bands", T.ArrayType(T.LongType())), *[T.StructField(c, T.LongType()) for c in PARITY]]

    def compute():
        def work(texts):
            texts = Texts(texts)
            n = len(texts)
            owner, hashes = shingles(texts, width)
            size, one, two = _digests(owner, hashes, n)
            filled = np.flatnonzero(size)
            number = np.zeros(n, dtype=np.int64)
            number[filled] = np.arange(len(filled))
            signature = super_minhash(number[owner], hashes, len(filled), bands * rows)
            keys = _band_keys(signature, bands, rows)
            bounds = np.concatenate([[0], np.cumsum((size > 0) * bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel()))
            return [size, one, two, lists, *_parities(owner, hashes, n)]

        return work

    return per_text(docs, "_doc", fields, compute, ["_id"])


def _digests(owner: np.ndarray, hashes: np.ndarray, n: int) -> list[np.ndarray]:
    """The size of each set and two sums of hashes over it, which together tell sets apart."""
    sums_of = [sums(owner, mix(h), n).view(np.int64) for h in (hashes + np.uint64(3), hashes ^ _GOLDEN)]
    return [np.bincount(owner, minlength=n), *sums_of]


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def compute():
        def work(texts):
            texts = Texts(texts)
            owner, hashes = shingles(texts, width)
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes.astype(np.int64)))
            return [*_digests(owner, hashes, len(texts)), found]

        return work

    fields = [*[T.StructField(c, T.LongType()) for c in SAME_SET], T.StructField("set", T.ArrayType(T.LongType()))]
    return per_text(docs, "_doc", fields, compute, [])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("_class").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("_class").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def _merge(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after adding links between classes; ``roots`` are those so far."""
    return components(links if roots is None else links.unionByName(roots.select(F.col("node").alias("a"),
                                                                              F.col("root").alias("b"))))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = WIDTH, percent: int = PERCENT,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` (least id reachable by links) and ``kept``."""
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_doc"))
    sketches = save(_sketches(docs, width, bands, rows), "sketches")
    classes = save(
        sketches.filter("n_shingles > 0 AND _id IS NOT NULL").groupBy(*SAME_SET)
        .agg(F.min(F.struct("_id", "_bands", *PARITY)).alias("_first"))
        .select(*SAME_SET, "_first.*", F.monotonically_increasing_id().alias("_class")), "classes")

    members = classes.select("_class", F.explode("_bands").alias("bucket"))
    crowded = save(members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "crowded")
    members = save(members.join(crowded, "bucket"), "members")
    weights = members.groupBy("_class").agg(F.sum("n").alias("weight"))
    weights = weights.join(classes.select("_class", "n_shingles", *PARITY), "_class")
    members, n_members = save_counted(members.drop("n").join(weights, "_class"), "members")
    least = classes.select(*SAME_SET, F.col("_id").alias("component_id"))
    if n_members:
        wanted, n_wanted = save_counted(
            classes.join(members.select("_class").distinct(), "_class", "left_semi")
            .select(*SAME_SET, "_class", "_id"), "wanted")
        # Of each class only the row of its least id is read again, found by a filter on ids.
        likely = bloom.marked(docs, "_id", bloom.build(wanted, "_id", n_wanted), "_hit").filter("_hit").drop("_hit")
        sets = _sets(likely, width).join(wanted.select(*SAME_SET, "_class"), [*SAME_SET])
        sets = save(sets.dropDuplicates([*SAME_SET]).select("_class", "set"), "sets")
        roots = _grouped(members, sets, percent)
        numbered = classes.join(roots, F.col("_class") == F.col("node"), "left").select(
            *SAME_SET, "_id", F.coalesce("root", "_class").alias("_root"))
        components_of = numbered.groupBy("_root").agg(F.min("_id").alias("component_id"))
        least = numbered.join(components_of, "_root").select(*SAME_SET, "component_id")
    out = sketches.select("_id", *SAME_SET).join(least, [*SAME_SET], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("_id"))
    return out.select(
        F.col("_id").alias(id_col), "n_shingles", component.alias("component_id"),
        (F.col("_id").isNull() | (F.col("_id") == component)).alias("kept"),
    )


def _grouped(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rounds of hubs against their buckets until no bucket holds more than one component.

    ``members`` has ``bucket, _class, n_shingles, weight`` and the parity map.
    """
    alone = F.col("_class").alias("component")
    roots, salts, tested = None, 1, None
    rooted = members.select("*", alone, F.lit(None).cast("long").alias("main"))
    while True:
        salt = F.pmod(F.xxhash64("_class"), F.lit(salts))
        hubs = (
            rooted.filter("main IS NULL OR component <> main").groupBy("bucket", salt.alias("salt"))
            .agg(F.max(F.struct("weight", -F.col("_class"), "_class", "n_shingles", "component", *PARITY)).alias("hub"))
            .select("bucket", "hub._class", "hub.n_shingles", "hub.component", *[f"hub.{c}" for c in PARITY])
        )
        hubs = save(hubs, "hubs")
        meets = (F.col("m.component") != F.col("h.component")) & _alike("m", "h", percent)
        ends = F.col("m._class"), F.col("h._class")
        pairs = (
            rooted.alias("m").join(hubs.alias("h"), (F.col("m.bucket") == F.col("h.bucket")) & meets)
            .select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = save(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links, n_links = save_counted(_verified(pairs, sets, percent), "links")
        if n_links or roots is None:
            roots = _merge(roots, links)
        left = rooted.join(hubs.select("bucket", "_class"), ["bucket", "_class"], "left_anti")
        placed = left.drop("component", "main").join(roots, F.col("_class") == F.col("node"), "left").select(
            "bucket", "_class", "n_shingles", "weight", *PARITY, F.coalesce("root", "_class").alias("component"))
        # The largest component of a bucket is met by the others' hubs, never the other way round.
        open_buckets = (
            placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
            .groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("k"))
            .filter("k > 1").select("bucket", "main")
        )
        open_buckets = save(open_buckets, "open")
        rooted, n_members = save_counted(placed.join(open_buckets, "bucket"), "members")
        if not n_members:
            return roots
        salts *= 16
