"""Near duplicates by an LSH forest: sets of word shingles that share a prefix of a MinHash signature order.

Every tree of the forest orders the distinct sets by six values of their MinHash signature.  Sets that share the first
four values are a region of the tree; a region of many sets that aren't linked yet is told apart by five, then by six
values.  Candidates come from the longest common prefixes, in two rounds, and each is confirmed on the full sets:

1. A set and the smallest one among those that share all six values, if that is so in more trees than for others.  This
   links large groups of copies in a star, at a few candidates a set.
2. In the regions that still hold several components: every pair of sets of different components, one of them outside
   the region's main component.  Pairs are compared in the first region where they meet, by size and by a sketch of two bits a value;
   only those that come near the threshold go on.  The sets of regions that are large even at six values are not paired off:
   each is taken as what it differs in from the shingles that most sets around it share.  Sets that differ little are linked
   with the one that differs least; others must share some of their differences, and meet at the rarest of these only.

Two sets of similarity 0.8 miss each other in all 40 trees with a probability of 7e-10 in regions of four values, 1.3e-7 of
five and 5e-6 of six, and the sketch (five standard errors below the threshold) passes over 3e-7 of them; links of
greater similarity are surer, and a component is lost with all its links only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, components, hash_filter, in_tasks, raw_texts, slices, work_dir, written

TREES, DEPTHS = 40, (4, 5, 6)
VALUES = TREES * DEPTHS[-1]
#: Sets of a region that a lesser depth may leave together.
REGION = 64
#: Candidates of a set in the first round.
LEADERS = 3
#: Bytes of text whose shingles are hashed together, and words that a task remembers the hash of.
BLOCK_BYTES, REMEMBERED = 1 << 20, 500_000
#: Shingles whose values are held at once.
CHUNK = 512
SEED = 11
MIX, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(31)
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Numbers of a sketch: two bits a value, 32 values a number.
SKETCH = [f"s{k}" for k in range((2 * VALUES + 63) // 64)]
#: Values of the wider sketch that the sets of large regions get.
WIDE = np.random.default_rng(SEED + 1).integers(0, 1 << 63, 8 * VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD_BITS = 0x5555555555555555
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * MIX
    return x ^ (x >> SHIFT)


class Shingles:
    """Sets of word shingles, as sorted hashes of 64 bits; hashes of words are remembered."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, digest = self.known, xxhash.xxh64_intdigest
        for w in set(words).difference(known):
            known[w] = digest(w, SEED)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def of(self, text: bytes | None) -> np.ndarray:
        """The set of a text: lower-cased (A-Z) words joined in shingles; of fewer words the whole sequence; of none, nothing."""
        words = (text or b"").translate(_LOWER).split()
        if not words:
            return np.empty(0, np.uint64)
        size = min(self.words, len(words))
        own = self._hashes(words)
        out = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            out = _mixed(out * MIX + own[k : len(own) - size + 1 + k])
        return np.unique(out)


def signature(shingles: np.ndarray, factors: np.ndarray = FACTORS) -> np.ndarray:
    """The smallest of all shingles under each of several orders."""
    out, rows = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64), CHUNK * VALUES // len(factors)
    for k in range(0, len(shingles), rows):
        np.minimum(out, (shingles[k : k + rows, None] * factors).min(axis=0), out=out)
    return out


def sketch(values: np.ndarray) -> np.ndarray:
    """Two bits of each value, rows of ``values`` by rows, as signed numbers."""
    n = -(-values.shape[1] // 32)
    two = np.zeros((len(values), 32 * n), np.uint64)
    two[:, : values.shape[1]] = values >> np.uint64(20) & np.uint64(3)
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(two.reshape(len(values), n, 32) << shifts, axis=2).view(np.int64)


def prefixes(values: np.ndarray) -> list[np.ndarray]:
    """A number for the tree and the first values of its order, for each depth; trees side by side, rows of ``values`` by rows."""
    order = values.reshape(len(values), TREES, DEPTHS[-1]).astype(np.uint64)
    now, out = np.broadcast_to(np.arange(TREES, dtype=np.uint64), order.shape[:2]), []
    for depth in range(DEPTHS[-1]):
        now = _mixed(now * MIX + order[:, :, depth])
        if depth + 1 in DEPTHS:
            out.append(now.reshape(-1).view(np.int64))
    return out


def _rows(docs: DataFrame, words: int, id_column: str, text_column: str) -> DataFrame:
    """A row per document: its id, hashes of its text, size and hash of its set, 32 bits of each value, sketch."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in slices(batches, BLOCK_BYTES):
            sets = [shingles.of(t) for t in raw_texts(batch)]
            values = np.stack([signature(s) for s in sets])
            short = (values >> np.uint64(24)).astype("<u4")
            keys = [xxhash.xxh3_64_intdigest(s.tobytes(), SEED) if len(s) else None for s in sets]
            columns = [
                *(batch.column(c) for c in ("doc_id", "h1", "h2")),
                pa.array(list(map(len, sets)), pa.int64()),
                pa.array([k if k is None else k - (1 << 63) for k in keys], pa.int64()),
                pa.array([v.tobytes() for v in short], pa.binary()),
                *map(pa.array, sketch(values).T),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "n", "node", "values", *SKETCH])

    rows = docs.select(column(id_column).alias("doc_id"), *_text_hashes(column(text_column)), column(text_column).alias("text"))
    schema = f"doc_id {kind}, h1 bigint, h2 bigint, n bigint, node bigint, values binary, {', '.join(f'{s} bigint' for s in SKETCH)}"
    return in_tasks(rows, run, schema)


def _text_hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("text"), text).alias("h2")


def _forest(rows: DataFrame) -> DataFrame:
    """A row per set and tree: ``node`` and the prefixes ``p4`` to ``p6``."""
    names = [f"p{d}" for d in DEPTHS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_BYTES, "values"):
            values = np.stack([np.frombuffer(v, "<u4") for v in batch.column("values").to_pylist()])
            node = np.repeat(batch.column("node").to_numpy(), TREES)
            yield pa.RecordBatch.from_arrays([pa.array(node), *map(pa.array, prefixes(values))], ["node", *names])

    return in_tasks(rows.where("n > 0").select("node", "values"), run, "node bigint, " + ", ".join(f"{p} bigint" for p in names))


def _met(forest: DataFrame, path: str) -> DataFrame:
    """The forest's rows in regions of several different sets; copies of a set are one."""
    least = f"p{DEPTHS[0]}"
    several = forest.groupBy(least).agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select(least)
    return written(forest.join(several, least, "left_semi").distinct(), path)


def _stars(met: DataFrame) -> DataFrame:
    """Pairs of a set and the sets that lead most of its regions at the full depth."""
    full = f"p{DEPTHS[-1]}"
    lead = met.groupBy(full).agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1")
    often = met.select(full, "node").join(lead.select(full, "lead"), full).where("node <> lead").groupBy("node", "lead").agg(F.count("*").alias("n"))
    # A set has at most one leader a tree.
    best = F.slice(F.sort_array(F.collect_list(F.struct("n", "lead")), asc=False), 1, LEADERS)
    pairs = often.groupBy("node").agg(best.alias("best")).select("node", F.explode("best.lead").alias("lead"))
    return pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()


def _differing(a: Column, b: Column) -> Column:
    """The number of values that differ, of two numbers of a sketch."""
    bits = a.bitwiseXOR(b)
    return F.bit_count(bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(F.lit(ODD_BITS)))


def _most(percent: int, values: int) -> int:
    """The values of a sketch that may differ: five standard errors more than expected at the threshold."""
    agree = percent / 100 + (1 - percent / 100) / 4
    return int(values * (1 - agree) + 5 * (values * agree * (1 - agree)) ** 0.5) + 1


def _alike(percent: int) -> Column:
    """Whether the sizes and sketches of ``x`` and ``y`` allow so large a similarity."""
    differ = sum((_differing(F.col(f"x.{s}"), F.col(f"y.{s}")) for s in SKETCH), F.lit(0))
    sizes = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    return sizes & (differ <= _most(percent, VALUES))


def _alike_widely(percent: int) -> Column:
    """The same by the wider sketch."""
    differ = F.aggregate(F.zip_with("x.wide", "y.wide", _differing), F.lit(0), lambda n, d: n + d)
    return differ <= _most(percent, len(WIDE))


def _regions(met: DataFrame, roots: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """The sets of regions (``at``) of several components, with their ``group`` and the region's ``main`` one: small regions, and those
    that are large at the full depth."""
    group = F.coalesce("root", "node").alias("group")
    left = written(met.join(roots, "node", "left").select("node", *[f"p{d}" for d in DEPTHS], group), f"{path}/regions")
    small = []
    for depth in DEPTHS:
        at = f"p{depth}"
        by_group = left.groupBy(at, "group").agg(F.count("*").alias("n"))
        main = F.max(F.struct("n", "group"))["group"].alias("main")
        several = by_group.groupBy(at).agg(F.sum("n").alias("members"), F.count("*").alias("groups"), main).where("groups > 1")
        rows = written(left.join(several.select(at, "members", "main"), at), f"{path}/several-{depth}")
        small.append(rows.where(F.col("members") <= REGION).select(F.col(at).alias("at"), "node", "group", "main"))
        left = rows.where(F.col("members") > REGION)
        large = left.select("node", "group", "main")
        left = left.select("node", *[f"p{d}" for d in DEPTHS], "group")
    return reduce(DataFrame.unionAll, small), large


def _families(large: DataFrame, path: str) -> DataFrame:
    """The sets of large regions with their ``group`` and ``family``: groups that meet in such regions, over any number of steps."""
    roots = components(large.select(F.col("group").alias("a"), F.col("main").alias("b")), f"{path}/family-rounds")
    own = large.select("node", "group").distinct().join(roots.withColumnRenamed("node", "group"), "group", "left")
    return written(own.select("node", "group", F.coalesce("root", "group").alias("family")), f"{path}/families")


def _across(small: DataFrame, families: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different components that meet in a small region and look alike, but those of one family."""
    # At most a region a tree; a pair is found in the first of its common ones.
    keys = small.groupBy("node").agg(F.collect_list("at").alias("keys"))
    here = small.join(nodes.select("node", "n", *SKETCH).join(keys, "node"), "node").join(families.drop("group"), "node", "left")
    x, y = here.where("group <> main").alias("x"), here.alias("y")
    # One of each pair stands outside the main component; of two such, the smaller one asks.
    once = (F.col("y.group") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    elsewhere = F.coalesce(F.col("x.family") == F.col("y.family"), F.lit(False))
    met = (F.col("x.at") == F.col("y.at")) & (F.col("x.group") != F.col("y.group")) & once & ~elsewhere & _alike(percent)
    pairs = x.join(y, met & (F.col("x.at") == F.array_min(F.array_intersect("x.keys", "y.keys"))))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def _centres(own: DataFrame, families: DataFrame) -> DataFrame:
    """The shingles (``centre``) that more than half of a family's sets hold: at most twice as many as a set has on average."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_BYTES, "own"):
            own = [np.frombuffer(x, np.int64) for x in batch.column("own").to_pylist()]
            family = np.repeat(batch.column("family").to_numpy(), [len(x) for x in own])
            yield pa.RecordBatch.from_arrays([pa.array(family), pa.array(np.concatenate(own))], ["family", "shingle"])

    each = in_tasks(own.select("family", "own"), run, "family bigint, shingle bigint")
    times = each.groupBy("family", "shingle").agg(F.count("*").alias("times"))
    common = times.join(families.groupBy("family").agg(F.count("*").alias("members")), "family").where("2 * times > members")
    return common.groupBy("family").agg(F.collect_list("shingle").alias("centre"))


def _apart(own: DataFrame, centres: DataFrame) -> DataFrame:
    """What each set differs in from its family's centre: the shingles that only one of the two holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_BYTES, "own"):
            pairs = zip(batch.column("own").to_pylist(), batch.column("centre"), strict=True)
            apart = [np.setxor1d(np.frombuffer(x, np.int64), c.values.to_numpy(), assume_unique=True) for x, c in pairs]
            columns = [batch.column("node"), batch.column("family"), pa.array(apart, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "family", "apart"])

    rows = own.join(centres, "family", "left").withColumn("centre", F.coalesce("centre", F.array().cast("array<bigint>")))
    return in_tasks(rows.select("node", "family", "own", "centre"), run, "node bigint, family bigint, apart array<bigint>")


def _by_differences(families: DataFrame, sets: DataFrame, nodes: DataFrame, percent: int, path: str) -> DataFrame:
    """Pairs of sets of one family, of different components, that their differences from the family's centre don't rule out.

    Where ``d`` shingles tell each of two sets from the centre, and ``o`` of them are the same, the sets differ in
    ``d + d' - 2 * o`` shingles, whatever the centre is.  They are similar enough if that is at most
    ``(100 - percent) * (n + n') / (100 + percent)``, so ``o`` must be at least the sum of what each has in ``excess``, over
    ``2 * (100 + percent)``.  If that takes none, both are similar enough to the set of the least excess: one such pair for
    each component links all of these.  Other pairs must share differences, and if all are ordered alike, rarest first, the
    first one they share is followed by enough others on both sides.
    """

    def widely(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_BYTES, "own"):
            values = np.stack([signature(np.frombuffer(x, np.uint64), WIDE) for x in batch.column("own").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(list(sketch(values)), pa.list_(pa.int64()))], ["node", "wide"])

    def shared(excess: Column) -> Column:
        return F.ceil(excess / (2 * (100 + percent)))

    own = written(sets.join(families, "node"), f"{path}/large")
    apart = written(_apart(own, written(_centres(own, families), f"{path}/centres")), f"{path}/apart")
    excess = ((100 + percent) * F.col("d") - (100 - percent) * F.col("n")).alias("excess")
    facts = own.select("node", "group", "family").join(apart.select("node", F.size("apart").cast("long").alias("d")), "node")
    facts = facts.join(nodes.select("node", "n"), "node").select("node", "group", "family", "d", excess)
    best = facts.groupBy("family").agg(F.min(F.struct("excess", "node", "group")).alias("best"))
    facts = written(facts.join(best, "family").withColumn("near", F.col("excess") + F.col("best.excess") <= 0), f"{path}/facts")

    near = facts.where("near").groupBy("group").agg(F.min("node").alias("node"), F.any_value("best").alias("best"))
    stars = near.where("group <> best.group").select(F.col("node").alias("a"), F.col("best.node").alias("b"))
    joined = near.select("group", F.col("best.group").alias("joined"))
    facts = facts.join(joined, "group", "left").withColumn("group", F.coalesce("joined", "group")).drop("joined", "best", "near")
    sizes = facts.groupBy("family", "group").agg(F.count("*").alias("members"))
    main = sizes.groupBy("family").agg(F.max(F.struct("members", "group"))["group"].alias("main"))
    facts = facts.join(main, "family").withColumn("asks", F.col("group") != F.col("main")).drop("main")
    facts = written(facts, f"{path}/groups")
    # A set outside the main group may meet any other, one of the main group those outside only.
    bounds = facts.groupBy("family").agg(F.min("excess").alias("any"), F.min(F.when(F.col("asks"), F.col("excess"))).alias("outside"))
    bound = F.when(F.col("asks"), F.col("any")).otherwise(F.col("outside"))
    facts = facts.join(bounds.where("outside IS NOT NULL"), "family").withColumn("most", F.col("d") - shared(F.col("excess") + bound))
    wide = in_tasks(own.select("node", "own"), widely, "node bigint, wide array<bigint>")
    facts = facts.drop("any", "outside").where("most >= 0").join(nodes.select("node", "n", *SKETCH), "node").join(wide, "node")

    each = apart.select("node", "family", F.explode("apart").alias("at"))
    each = each.join(each.groupBy("family", "at").agg(F.count("*").alias("times")), ["family", "at"])
    ordered = each.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("times", "at"))).alias("all"))
    ordered = ordered.join(facts, "node").withColumn("first", F.slice("all", F.lit(1), F.col("most").cast("int") + 1))
    # The rarest of a short set go along, so that a pair is found at the first of its common ones.
    head = F.when(F.col("most") <= REGION, F.col("first")["at"]).alias("head")
    first = ordered.select(*facts.columns, head, F.posexplode("first").alias("place", "one")).where("one.times > 1")
    first = written(first.withColumn("at", F.col("one.at")).drop("one", "most"), f"{path}/rarest")
    x, y = first.where("asks").alias("x"), first.alias("y")
    met = (F.col("x.family") == F.col("y.family")) & (F.col("x.at") == F.col("y.at")) & (F.col("x.group") != F.col("y.group"))
    met &= ~F.col("y.asks") | (F.col("x.node") < F.col("y.node"))
    least = shared(F.col("x.excess") + F.col("y.excess"))
    met &= (F.col("x.place") <= F.col("x.d") - least) & (F.col("y.place") <= F.col("y.d") - least) & _alike(percent)
    met &= F.coalesce(F.get(F.array_intersect("x.head", "y.head"), 0) == F.col("x.at"), F.lit(True))
    pairs = x.join(y, met & _alike_widely(percent)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return pairs.unionAll(stars).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _sets(needed: DataFrame, docs: DataFrame, words: int, text_column: str, path: str) -> DataFrame:
    """The full sets (``own``, hashes side by side) of nodes, made anew from one text each (``h1``, ``h2``).

    Other texts are left aside by a bitmap of fixed size on their hash, which lets some of them pass, and then by a join.
    """
    needed = written(needed, f"{path}/needed")
    passes = hash_filter(needed, "h1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            for part in slices([batch.filter(passes(batch.column("h1")))], BLOCK_BYTES):
                own = pa.array([shingles.of(t).tobytes() for t in raw_texts(part)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("h1"), part.column("h2"), own], ["h1", "h2", "own"])

    texts = docs.select(*_text_hashes(column(text_column)), column(text_column).alias("text"))
    sets = in_tasks(texts, run, "h1 bigint, h2 bigint, own binary").groupBy("h1", "h2").agg(F.any_value("own").alias("own"))
    return written(sets.join(needed, ["h1", "h2"]).select("node", "own"), f"{path}/sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, path: str) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a, b = (sets.select(F.col("node").alias(c), F.col("own").alias(f"own_{c}")) for c in "ab")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_BYTES, "own_b"):
            keep = []
            for x, y in zip(batch.column("own_a").to_pylist(), batch.column("own_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return written(in_tasks(pairs.join(a, "a").join(b, "b"), compare, "a bigint, b bigint"), f"{path}/links")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (the size of its set), ``component_id``, ``kept``.

    Documents are linked if ``100 * intersection >= percent * union`` (``percent`` 50 to 100) of their sets of ``words``-word
    shingles; a shingle is known by a hash of 64 bits, and so is a set.  ``component_id`` is the smallest id that links reach and
    ``kept`` tells whether it is the document's own.  A null text, or one without words, has an empty set and is linked with
    nothing: its component is its own id.  A null id is never the smallest, and not kept; a component of null ids only has a null
    ``component_id``.  Rows that repeat an id are rows of their own, each linked by its text.  Other columns are ignored.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    path = work_dir(docs.sparkSession, "forest")
    rows = written(_rows(docs, words, id_column, text_column), f"{path}/rows")
    met = _met(_forest(rows), f"{path}/met")
    found = met.select("node").distinct()
    facts = [F.min(F.struct("h1", "h2")).alias("text"), F.min("n").alias("n"), *[F.min(s).alias(s) for s in SKETCH]]
    nodes = rows.where("n > 0").join(found, "node", "left_semi").groupBy("node").agg(*facts)
    nodes = written(nodes.select("node", "text.h1", "text.h2", "n", *SKETCH), f"{path}/nodes")
    texts = nodes.select("node", "h1", "h2")
    pairs = written(_stars(met), f"{path}/stars")
    sets = _sets(_ends(pairs).distinct().join(texts, "node"), docs, words, text_column, f"{path}/first")
    links = _confirmed(pairs, sets, percent, f"{path}/first")
    roots = written(components(links, f"{path}/first-rounds"), f"{path}/roots")
    small, large = _regions(met, roots, path)
    families = _families(large, path)
    pairs = written(_across(small, families, nodes, percent), f"{path}/across")
    ends = _ends(pairs).unionAll(families.select("node")).distinct()
    sets = _sets(ends.join(texts, "node"), docs, words, text_column, f"{path}/second")
    others = written(_by_differences(families, sets, nodes, percent, f"{path}/second"), f"{path}/differences")
    more = _confirmed(pairs.unionAll(others).distinct(), sets, percent, f"{path}/second")
    roots = written(components(links.unionAll(more), f"{path}/second-rounds"), f"{path}/all-roots")
    least = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    group = least.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    group = group.join(group.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    done = rows.select("doc_id", "n", "node").join(group, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    done = done.select("doc_id", F.col("n").alias("n_shingles"), component)
    return done.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
