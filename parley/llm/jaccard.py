"""N-gram Jaccard join by partitioning the universe of shingles, with exact verification.

Two sets of which the smaller has ``l`` shingles, and whose similarity is at least ``t``, differ in at most
``(1 - t) / t * l`` shingles. Sets are banded by size. In a band, all shingles are hashed to segments; if
the segments' allowances add up to more than the largest possible difference, two similar sets agree in a
segment (allowance 1) or differ by at most one shingle there (allowance 2). So each set is indexed by its
subset in each segment and, where the allowance is 2, by that subset's one-deletion neighbourhood. How many
segments get which allowance is chosen for each band by cost: rows to index against chance agreements.

Sets agree by chance where a segment has one shingle or none. A set of which the segments with two shingles or more
have allowances beyond its own largest difference cannot miss a similar set by these, so it is not indexed by smaller subsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import Words, discard, has, mixed, pieces, written
from parley.llm.components import components

#: Bits of the map that spares rows of which no other set has the signature; it is an aid only.
MAP_BITS = 26
#: Shingles of a subset that sets are indexed by, where their allowances leave it to them.
LEAST = 2
#: Members of a signature's group that are compared with the others in the first rounds: few, as most of a large group
#: of near copies joins by way of any of them. The last round compares all that is left.
HUBS = (1, 32)
#: Members of a group that each other one meets in one task in the last round.
BLOCK = 1024
#: A set's sketch: for each of so many times 64 cells, whether an odd number of shingles falls into it. Texts have
#: sets of hundreds or thousands, which fill fewer cells so evenly that these tell nothing apart.
SKETCH = [f"p{i}" for i in range(16)]
#: Sets whose cells are counted at a time.
SETS_AT_ONCE = 2048


class Bands:
    """Size bands, the segments of each and their allowances."""

    def __init__(self, percent: int, counts: dict[int, int]):
        """``counts``: sets by band, from the corpus."""
        self.percent, self.counts = percent, counts
        t = percent / 100
        self.ratio = 1 / t**2
        self.plans = {b: self._plan(b) for b in {c + d for c in counts for d in (0, -1)} if b >= 0}

    @staticmethod
    def of(sizes: np.ndarray, percent: int) -> np.ndarray:
        """The band of each size (1 or more)."""
        return np.floor(np.log(sizes) / (-2 * math.log(percent / 100)) + 1e-9).astype(np.int64)

    def most(self, band: int) -> int:
        """An upper bound of the sizes of a band."""
        return math.ceil(self.ratio ** (band + 1))

    def _plan(self, band: int) -> tuple[int, int]:
        """Segments, and how many of them (the first ones) have allowance 2.

        The cost of a set is the rows that it is indexed by and the sets that agree with it by chance. That is likely
        where a segment has no shingle, or one of which the neighbourhood is empty; such rows are left out if
        the larger subsets suffice, as they mostly do from a number of segments on.
        """
        differ = (100 - self.percent) * self.most(band) // self.percent
        n, others = self.ratio**band, self.counts.get(band, 0) + self.counts.get(band + 1, 0)
        steps = np.unique(np.linspace(0, (differ + 1) // 2, 100).astype(np.int64))
        double, spare = (x.ravel() for x in np.meshgrid(steps, np.arange(0, 0.6, 0.02)))
        segments = differ + 1 - double + np.floor(spare * differ).astype(np.int64)
        mean = self.most(band) / segments
        none, one, two = np.exp(-mean), mean * np.exp(-mean), mean**2 / 2 * np.exp(-mean)
        single, several = segments - double, 1 - none - one
        enough = single * several + double * (2 * several - two) - np.sqrt(segments) / 2 >= differ + 1
        none = (1 - 1 / segments) ** n
        one = n / segments * (1 - 1 / np.maximum(segments, 2)) ** (n - 1)
        every = segments + double * n / segments + others * (single * none**2 + double * (none + one) ** 2)
        cost = np.where(enough, segments * several + double * mean * several, every)
        best = np.lexsort((segments, cost))[0]
        return int(segments[best]), int(double[best])

    def signatures(self, doc: np.ndarray, shingle: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Set numbers and signatures. A set is indexed in its own band and in the one below, if that has near enough sizes.

        A set's level is the least number of shingles of the subsets that it is indexed by: the largest, up to ``LEAST``, at which
        the allowances of its segments add up to more than its differences from any similar set. Of two similar
        sets the one with the higher level shares a subset of that size with the other, whose level leaves it in.
        """
        sizes = np.bincount(doc, minlength=n)
        band = self.of(np.maximum(sizes, 1), self.percent)
        out_doc, out = [], []
        for step in (0, -1):
            b = band + step
            use = (sizes > 0) & (b >= 0)
            differ = (100 - self.percent) * sizes // self.percent
            if step:  # the largest set of the band below has to be near enough
                most = np.array([self.most(x) for x in range(int(b.max(initial=0)) + 1)] or [0])[np.maximum(b, 0)]
                use &= 100 * most >= self.percent * sizes
                differ = (100 - self.percent) * (most + sizes) // (100 + self.percent)
            plans = np.array([self.plans.get(x, (1, 0)) for x in range(int(b.max(initial=0)) + 1)] or [(1, 0)])
            segments, double = plans[np.maximum(b, 0)].T
            mine = use[doc]
            d, s = doc[mine], shingle[mine]
            # each set has a cell for each segment; sums of the halves of its shingles' hashes tell subsets apart
            sizes_of = np.where(use, segments, 0)
            base = np.cumsum(sizes_of) - sizes_of
            place = ((s >> np.uint64(20)) % segments[d].astype(np.uint64)).astype(np.int64)
            cell = base[d] + place
            mark = mixed(s ^ np.uint64(0x5851F42D4C957F2D))
            low, high = (mark & np.uint64(0xFFFFFFFF)).astype(np.float64), (mark >> np.uint64(32)).astype(np.float64)
            total = int(sizes_of.sum())
            lows, highs = np.bincount(cell, low, total), np.bincount(cell, high, total)
            owner = np.repeat(np.arange(n), sizes_of)
            number = np.arange(total) - base[owner]
            held, twice = np.bincount(cell, minlength=total), number < double[owner]
            level = np.zeros(n, np.int64)
            for least in range(1, LEAST + 1):
                allowed = (held >= least).astype(np.int64) + (twice & (held > least))
                level[np.bincount(owner, allowed, n) > differ] = least
            keep = held >= level[owner]
            out_doc.append(owner[keep])
            out.append(self._signature(b[owner[keep]], number[keep], lows[keep], highs[keep]))
            near = (place < double[d]) & (held[cell] > level[d])
            c = cell[near]
            out_doc.append(d[near])
            out.append(self._signature(b[d[near]], place[near], lows[c] - low[near], highs[c] - high[near]))
        return np.concatenate(out_doc), np.concatenate(out)

    @staticmethod
    def _signature(band: np.ndarray, segment: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        x = mixed(low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + high.astype(np.uint64))
        return mixed(x + (band.astype(np.uint64) << np.uint64(40)) + segment.astype(np.uint64)).view(np.int64)


SETS = "doc_id long, row long, n long, id long"


def identity(doc: np.ndarray, shingle: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each set and a 64-bit name that equal sets share."""
    ends = np.searchsorted(doc, np.arange(n + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(shingle ^ np.uint64(0xD1342543DE82EF95)))))
    return np.diff(ends), mixed(total[ends[1:]] - total[ends[:-1]] + np.diff(ends).astype(np.uint64)).view(np.int64)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, row, n, id``: the size of each document's set and the name of its class, NULL without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                n, name = identity(*Words(texts).shingles(words), len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), pa.array(n.astype(np.int64)), pa.array(name, mask=n == 0)], ["doc_id", "row", "n", "id"]
                )

    return docs.select("doc_id", "row", "text").mapInArrow(run, SETS)


def sketches(doc: np.ndarray, shingle: np.ndarray, n: int, columns: int = len(SKETCH)) -> list[np.ndarray]:
    """So many columns of the sketch of each set, ``doc`` in order. Two sets differ in at least as many shingles as their sketches in bits."""
    cells = 64 * columns
    place = (mixed(shingle ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(cells)).astype(np.int64)
    packed = np.zeros((n, columns), np.int64)
    for low in range(0, n, SETS_AT_ONCE):
        high = min(low + SETS_AT_ONCE, n)
        begin, end = np.searchsorted(doc, (low, high))
        odd = np.bincount((doc[begin:end] - low) * cells + place[begin:end], minlength=(high - low) * cells) & 1
        packed[low:high] = np.packbits(odd.astype(np.uint8).reshape(-1, cells), axis=1).view(np.int64)
    return [np.ascontiguousarray(packed[:, i]) for i in range(columns)]


def may_link(percent: int, sketch: list[str]) -> Column:
    """Whether the sizes and sketches of a set and of a ``hub`` leave it open that they are similar; never wrong about a link."""
    bits = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"hub_{p}"))) for p in sketch), F.lit(0))
    differ = F.greatest(bits.cast("long"), F.abs(F.col("n") - F.col("hub_n")))
    return differ * (100 + percent) <= (F.col("n") + F.col("hub_n")) * (100 - percent)


def bit(known: np.ndarray, value: np.ndarray) -> np.ndarray:
    place = value & ((1 << MAP_BITS) - 1)
    return (known[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def map_of(rows: DataFrame, column: str) -> bytes:
    """A bit for each value, by its low bits; 2 ** MAP_BITS bits whatever the number of rows."""
    low = F.col(column).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    word, one = F.shiftright(low, 6).cast("int"), F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")
    bits = rows.select(word.alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    return out.tobytes()


def signed(docs: DataFrame, words: int, bands: Bands, rows: bytes, present: bytes | None = None) -> DataFrame:
    """``sig`` of the sets in a map of ``rows``; if a map of signatures is given, those alone that it has, with the ``id`` of the set."""
    shared = docs.sparkSession.sparkContext.broadcast((bands, rows, present))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, rows, present = shared.value
        wanted, known = np.frombuffer(rows, np.uint8), np.frombuffer(present, np.uint8) if present else None
        for batch in batches:
            for part, texts in pieces(batch, "text"):
                texts = [x if mine else b"" for x, mine in zip(texts, bit(wanted, part.column("row").to_numpy()).tolist(), strict=True)]
                set_of, shingle = Words(texts).shingles(words)
                doc, sig = bands.signatures(set_of, shingle, len(texts))
                of_set = []
                if known is not None:
                    keep = bit(known, sig)
                    doc, sig = doc[keep], sig[keep]
                    of_set = [identity(set_of, shingle, len(texts))[1]]
                for at in range(0, len(sig), 500_000):
                    mine = doc[at : at + 500_000]
                    yield pa.RecordBatch.from_arrays([pa.array(sig[at : at + 500_000]), *[pa.array(x[mine]) for x in of_set]], columns)

    columns = ["sig", *(["id"] if present else [])]
    return docs.select("row", "text").mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def sketched(docs: DataFrame, words: int, rows: DataFrame) -> DataFrame:
    """``id, n`` and sketch of the classes whose texts a table names by ``row, id``; other texts are passed over."""
    shared = docs.sparkSession.sparkContext.broadcast(map_of(rows, "row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            batch = batch.filter(pa.array(bit(wanted, batch.column("row").to_numpy())))
            for _, texts in pieces(batch, "text"):
                set_of, shingle = Words(texts).shingles(words)
                size, name = identity(set_of, shingle, len(texts))
                of_set = [name, size.astype(np.int64), *sketches(set_of, shingle, len(texts))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in of_set], columns)

    columns = ["id", "n", *SKETCH]
    found = docs.select("row", "text").mapInArrow(run, ", ".join(f"{c} long" for c in columns))
    # texts of one class are equal in all that is taken here
    return found.join(rows.select("id"), "id", "left_semi").dropDuplicates(["id"])


def different(members: DataFrame) -> DataFrame:
    """``members`` without the groups ``sig`` that hold the same sets as another one; near copies share most of theirs.

    Groups are told apart by their size and 128 bits of hashes. ``members`` is a written table without repeated rows.
    """
    held = [F.count("*").alias("c"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y")]
    groups = members.groupBy("sig").agg(*held).filter("c > 1")
    return members.join(groups.groupBy("c", "x", "y").agg(F.min("sig").alias("sig")).select("sig"), "sig", "left_semi")


def _texts(ids: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``id, text``, written: a text of each of these classes; other texts are not shuffled."""
    rows = written(classes.join(ids, "id", "left_semi"), "needed")
    shared = docs.sparkSession.sparkContext.broadcast(map_of(rows, "row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(bit(known, batch.column("row").to_numpy())))

    found = docs.select("row", "text")
    # rows that are equal in id and text are dealt to one partition by the join
    found = found.mapInArrow(run, found.schema).join(rows, "row").groupBy("row", "id").agg(F.any_value("text").alias("text"))
    found = written(found.select("id", "text"), "needed-texts")
    discard(rows)
    return found


def grams(text: bytes, words: int) -> set:
    """The set of a text, plainly: runs of lower-cased words."""
    blank, upper, lower = b"\t\n\v\f\r", bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
    w = [x for x in text.translate(bytes.maketrans(upper + blank, lower + b" " * 5)).split(b" ") if x]
    return set(zip(*[w[j:] for j in range(words)], strict=False)) if len(w) >= words else {tuple(w)} if w else set()


VERIFIED = "a long, b long, common long, total long"


def verified(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``a, b, common, total`` of pairs of classes; ``texts`` has the text of either."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return compared(pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b"), words)


def compared(rows: DataFrame, words: int) -> DataFrame:
    """``a, b, common, total``: exact sizes of intersection and union, from the whole texts ``text_a`` and ``text_b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            out = [[], [], [], []]
            for i in range(len(batch)):  # one pair of texts at a time
                a, b = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if a != last:
                    last, held = a, grams(batch.column(2)[i].as_py().encode(), words)
                other = grams(batch.column(3)[i].as_py().encode(), words)
                common = len(held & other)
                for column, value in zip(out, (a, b, common, len(held) + len(other) - common), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b", "common", "total"])

    return written(rows.mapInArrow(run, VERIFIED), "verified")


def _links(docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Components of the classes: ``id, component`` of those that link with another; None if no two share a signature."""
    count = sets.filter("id IS NOT NULL").groupBy("n").agg(F.count("*").alias("c"))
    band = F.floor(F.log(F.col("n")) / (-2 * math.log(percent / 100)) + 1e-9).cast("int")
    # a row for each band, of which there are about a hundred
    bands = Bands(percent, {r[0]: r[1] for r in count.groupBy(band.alias("band")).agg(F.sum("c")).collect()})
    # copies of a set have all signatures in common, so one of them is enough
    classes = written(sets.filter("id IS NOT NULL").groupBy("id").agg(F.min("row").alias("row")), "classes")
    rows = map_of(classes, "row")
    # nearly every signature is alone, so counting them before they are dealt would only take memory
    found = signed(docs, words, bands, rows).repartition("sig").groupBy("sig").agg(F.count("*").alias("c"))
    shared = written(found.filter("c > 1").select("sig"), "shared")
    if shared.isEmpty():
        discard(shared, classes)
        return None
    found = signed(docs, words, bands, rows, map_of(shared, "sig"))
    found = written(found.join(shared, "sig", "left_semi").distinct(), "found")
    discard(shared)
    groups = written(different(found), "groups")
    discard(found)
    needed = written(classes.join(groups.select("id").distinct(), "id", "left_semi"), "sketched")
    members = written(groups.join(sketched(docs, words, needed), "id").select("sig", "id", "n", *SKETCH), "members")
    discard(groups, needed)

    def verify(pairs: DataFrame) -> DataFrame:
        texts = _texts(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, classes)
        found = verified(pairs, texts, words)
        discard(texts)
        return found

    reached = joined(members, verify, percent)
    discard(classes)
    return reached


def joined(members: DataFrame, verify: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """``id, component`` of the sets that are similar to another one, by way of the groups ``sig`` of ``members``.

    In a group of several components a few members, outside of the largest component, are compared with all members of
    other components, and are then done with; after the rounds of ``HUBS`` all that are left are compared, in blocks. A
    pair is verified unless the sizes and sketches (columns ``p0``, ``p1`` and so on) rule it out, so what is verified
    grows with the links and not with the groups. Each round ties the components that its links join. ``members`` is
    a written table; it and each round's tables are removed as soon as the next ones are written.
    """
    spark = members.sparkSession
    sketch = [c for c in members.columns if c[0] == "p"]
    none = spark.range(0, 0, 1, 1)  # rows of the driver, even none of them, would start further Python workers
    reached, known = none.select("id", F.col("id").alias("component")), none.select(F.col("id").alias("a"), F.col("id").alias("b"))
    left, past = members, [members]
    for turn, most in enumerate((*HUBS, None)):
        now = left.join(reached, "id", "left") if turn else left.withColumn("component", F.col("id"))
        now = now.withColumn("component", F.coalesce("component", "id"))
        size = now.groupBy("sig", "component").agg(F.count("*").alias("m"))
        blocks = F.ceil(F.sum("m") / BLOCK).cast("int").alias("blocks")
        split = size.groupBy("sig").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.count("*").alias("c"), blocks).filter("c > 1")
        left = written(now.join(split.drop("c"), "sig"), "left")
        discard(*past)
        if left.isEmpty():
            discard(left)
            return reached
        past, hubs = [left], left.filter("component <> main")
        if most:
            place = F.row_number().over(Window.partitionBy("sig").orderBy("id"))
            hubs = hubs.withColumn("place", place).filter(F.col("place") <= most)
        hubs = hubs.select("sig", "blocks", *[F.col(c).alias(f"hub_{c}") for c in ("id", "n", *sketch, "component")])
        if most:
            hubs = written(hubs.drop("blocks"), "hubs")
            past.append(hubs)
            pairs = left.join(hubs, "sig")
        else:  # each member meets the blocks of a group one by one; of two hubs one meets the other
            hubs = hubs.withColumn("block", F.pmod(F.xxhash64("hub_id"), "blocks").cast("int")).drop("blocks")
            each = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            pairs = each.join(hubs, ["sig", "block"]).filter("component = main OR id < hub_id")
        pairs = pairs.filter("component <> hub_component").filter(may_link(percent, sketch))
        pairs = pairs.select(
            F.least("id", "hub_id").alias("a"),
            F.greatest("id", "hub_id").alias("b"),
            F.least("component", "hub_component").alias("x"),
            F.greatest("component", "hub_component").alias("y"),
        ).distinct()
        pairs = written(pairs.join(known, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            found = verify(pairs.select("a", "b"))
            known = known.unionAll(found.select("a", "b"))
            old, reached = reached, _tied(reached, pairs.join(found.filter(F.col("common") * 100 >= F.col("total") * percent), ["a", "b"]))
            discard(*([old] if old is not reached else []))
        discard(pairs)
        if most:
            done = hubs.select("sig", F.col("hub_id").alias("id"))
            left = left.drop("component", "main", "blocks").join(done, ["sig", "id"], "left_anti")
    discard(*past)
    return reached


def _tied(reached: DataFrame, links: DataFrame) -> DataFrame:
    """``reached`` after links between its components ``x`` and ``y``; a set that it lacks is a component of its own."""
    ties = written(links.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "ties")
    if ties.isEmpty():
        return reached
    tied = written(components(ties), "tied")
    new = tied.select(F.col("id").alias("component"), F.col("component").alias("new"))
    moved = reached.join(new, "component", "left").select("id", F.coalesce("new", "component").alias("component"))
    out = written(moved.unionAll(tied.join(reached, "id", "left_anti")), "reached")
    discard(ties, tied)
    return out


def linked(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, row, n_shingles, component_id, component`` of each row of ``docs``.

    A set holds the distinct runs of ``words`` words (A-Z lower-cased); a text with fewer words is one
    run; a NULL text or one without words has an empty set and links with nothing. Two documents link
    if ``100 * intersection >= percent * union``; ``component_id`` is the smallest doc_id among the rows that links
    lead to, NULL if none of them has an id. Rows with equal ids are documents of their own, so components
    may share a ``component_id``; ``component`` is the one name of each, NULL for an empty set. An empty
    table gives no rows; further columns are ignored. ``row`` is a hash of id and text.

    Equal sets are one class, so copies never meet as pairs. Classes are told apart by 64-bit hashes
    of their shingles' hashes. Classes that share a signature are compared on their texts, as ``joined``
    says. No group is gathered in one task, and no partner is left out.
    """
    docs = named(docs).select("doc_id", "row", "text")
    sets = written(shingle_sets(docs, words), "sets")
    classes = sets.filter("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("least")).withColumn("component", F.col("id"))
    reached = _links(docs, sets, words, percent)
    if reached is not None:
        classes = classes.drop("component").join(reached, "id", "left").withColumn("component", F.coalesce("component", "id"))
        whole = classes.groupBy("component").agg(F.min("least").alias("least"))
        classes = classes.drop("least").join(whole, "component").select("id", "least", "component")
    rows = sets.join(classes, "id", "left")
    least = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.select("doc_id", "row", F.col("n").alias("n_shingles"), least.alias("component_id"), "component")


def named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``doc_id`` and ``text`` of the right types and ``row``, a hash of both."""
    key, text = has(docs, "doc_id", "long"), has(docs, "text", "string")
    return docs.withColumns({"doc_id": key, "row": F.xxhash64(key, text), "text": F.coalesce(text, F.lit(""))})


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that link, directly or not, with one that stays.

    Of each component the document with the smallest doc_id stays, an empty text always; of rows that
    are equal in id and text, one stays. The columns are those of ``docs``, whatever their names.
    """
    rows = linked(docs, words, percent)
    filled = rows.filter("n_shingles > 0").groupBy("component").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row"))
    keep = filled.select("row").unionAll(rows.filter("n_shingles = 0").select("row")).distinct()
    key, text = has(docs, "doc_id", "long"), has(docs, "text", "string")
    own = [F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(docs.columns)]
    # a row's hash leads to it; id and text, not the hash, tell whether two rows are equal
    stay = docs.select(*own, key.alias("doc_id"), text.alias("text"), F.xxhash64(key, text).alias("row")).join(keep, "row", "left_semi")
    return stay.dropDuplicates(["row", "doc_id", "text"]).select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(docs.columns)])
