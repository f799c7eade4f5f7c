"""MinHash near-duplicates by an inverted join over signature coordinates.

1. Each text becomes the set of its word shingles (64-bit hashes), a digest of that set and a MinHash signature of
   ``COORDINATES`` values, each made of two minima. Texts with equal sets are one class; its smallest id stands for it.
2. A signature is a set of tokens (coordinate, value). Tokens are ordered from rare to frequent by a frequency sketch of
   fixed size. Two signatures that agree in at least ``MATCHES`` coordinates share at least ``COLLISIONS`` of the first
   COORDINATES - MATCHES + COLLISIONS tokens in any common order. So only these prefixes are posted, tokens posted once
   are skipped, and collisions per pair are counted.
3. Pairs with enough collisions are confirmed on their full sets. Before these move, two bitmaps of a few bits a shingle
   are compared, which hold parities: a bit that differs stands for a shingle that only one set has, so pairs with more
   differing bits than the similarity allows are no links, and nearly all others are.

A group of many similar texts is never spelled out in pairs. Leader rounds link members of a posting list to its most
central one, and pairs inside one component are skipped from then on. Texts that still share enough tokens with texts of
other components (counted by pairs in short lists, by rows in long ones) are joined by the rarest shingles of their full sets, first with one leader per shingle, then with all
of other components; this loses no pair of the wanted similarity and lets through few others. A pair of similarity 0.8 agrees in a coordinate with probability 0.64, and in fewer than 6 of
32 with one in a million; unrelated texts hardly ever agree in any.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.llm.graph import components, joined_components
from retailoom.llm.store import Scratch, bitmap, in_bitmap
from retailoom.llm.text import BLACK, U64, grams, mix, signed, text_slices, words

COORDINATES = 32
MATCHES = 6
COLLISIONS = 3
SKETCH_BITS = 18
LEADER_ROUNDS = 1
# pairs are spelled out in posting lists of so many rows at most, where that saves reading sets
SHORT = 16
FILTER_BITS = 1 << 23

_SEEDS = mix(np.arange(1, 4 * COORDINATES + 1, dtype=U64))
_XOR, _ODD = _SEEDS[: 2 * COORDINATES], _SEEDS[2 * COORDINATES :] | U64(1)


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingle hashes of all rows of a slice, where each row's begin)."""
    for first, last, data, offsets in text_slices(column):
        hashes, begins = words(data, offsets, BLACK)
        shingles = grams(hashes, k)
        sets = []
        for i in range(last - first):
            a, b = begins[i], begins[i + 1]
            if b - a >= k:
                sets.append(np.unique(shingles[a : b - k + 1]))
            elif b > a:  # fewer words than a shingle: the whole sequence is one
                sets.append(grams(hashes[a:b], b - a) ^ U64(b - a))
            else:
                sets.append(np.zeros(0, U64))
        bounds = np.zeros(len(sets) + 1, np.int64)
        np.cumsum([len(s) for s in sets], out=bounds[1:])
        yield first, np.concatenate(sets), bounds


def _digests(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit digests per set."""
    sums = np.zeros(len(flat) + 1, U64)
    np.cumsum(mix(flat + U64(0x51)), out=sums[1:])
    other = np.zeros(len(flat) + 1, U64)
    np.cumsum(mix(flat + U64(0xA7)), out=other[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]], other[bounds[1:]] - other[bounds[:-1]]


def _signatures(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, coordinates) of 32-bit hashes of two minima each; rows without shingles hold zeros."""
    rows = len(bounds) - 1
    out = np.zeros((rows, COORDINATES), np.uint32)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    starts = bounds[full]

    def least(n: int) -> np.ndarray:
        x = (flat ^ _XOR[n]) * _ODD[n]
        x ^= x >> U64(29)
        x *= U64(0xBF58476D1CE4E5B9)
        return np.minimum.reduceat(x, starts)

    if len(full):
        for c in range(COORDINATES):
            out[full, c] = (mix(least(2 * c) * U64(3) + least(2 * c + 1)) >> U64(32)).astype(np.uint32)
    return out


def _fixed(values: np.ndarray, width: int) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def profiles(docs: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """(id, n_shingles, d1, d2, signature) of every row."""

    def profile(batches):
        for batch in batches:
            for first, flat, bounds in _sets(batch.column(1), shingle):
                d1, d2 = _digests(flat, bounds)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, len(bounds) - 1),
                        pa.array(np.diff(bounds)),
                        pa.array(signed(d1)),
                        pa.array(signed(d2)),
                        _fixed(_signatures(flat, bounds), 4 * COORDINATES),
                    ],
                    ["id", "n_shingles", "d1", "d2", "signature"],
                )

    frame = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return frame.mapInArrow(profile, "id long, n_shingles long, d1 long, d2 long, signature binary")


def _tokens(column: pa.Array) -> np.ndarray:
    """(rows, coordinates) of tokens of (coordinate, value), five bytes each that move."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES).astype(U64)
    return values + (np.arange(1, COORDINATES + 1, dtype=U64) << U64(32))


def token_sketch(classes: DataFrame, sketch_bits: int) -> np.ndarray:
    """How many signatures hold a token of each of 2**sketch_bits hash buckets: fixed size, over all signatures."""

    def count(batches):
        total = np.zeros(1 << sketch_bits, np.int64)
        for batch in batches:
            if batch.num_rows:
                tokens = _tokens(batch.column(0)).ravel()
                total += np.bincount((mix(tokens) >> U64(64 - sketch_bits)).astype(np.int64), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])

    return _gathered(classes.select("signature").mapInArrow(count, "bucket int, n long"), sketch_bits)


def _gathered(counts: DataFrame, sketch_bits: int) -> np.ndarray:
    """A sketch from the (bucket, n) of all tasks."""
    rows = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << sketch_bits, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def postings(classes: DataFrame, sketch: np.ndarray, sketch_bits: int, prefix: int) -> DataFrame:
    """(token, id, n): the ``prefix`` rarest tokens of each signature."""

    def post(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _tokens(batch.column(2))
            often = sketch[(mix(tokens) >> U64(64 - sketch_bits)).astype(np.int64)].astype(np.int64)
            # by frequency, then by token: the same order for every signature
            order = np.lexsort((tokens, often), axis=1)[:, :prefix]
            rare = np.take_along_axis(tokens, order, 1)
            yield pa.record_batch(
                [
                    pa.array(signed(rare.ravel())),
                    pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), prefix)),
                    pa.array(np.repeat(batch.column(1).to_numpy(zero_copy_only=False), prefix)),
                ],
                ["token", "id", "n"],
            )

    return classes.select("id", "n_shingles", "signature").mapInArrow(post, "token long, id long, n long")


def _alike(n: str, m: str, percent: int) -> Column:
    """Set sizes that can still reach the similarity."""
    return F.expr(f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. A hot id is joined as a skewed join, never grouped."""

    def compare(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                common = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                keep[i] = common and 100 * common >= percent * (len(x) + len(y) - common)
            mask = pa.array(keep)
            yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    ends = bitmap(_ends(pairs), F.xxhash64("id"), FILTER_BITS)

    def needed(batches):
        for batch in batches:
            yield pa.record_batch(batch.columns[:2], ["id", "shingles"]).filter(pa.array(in_bitmap(ends, batch.column(2).to_numpy(zero_copy_only=False))))

    # sets of no pair stay where they are
    sets = sets.select("id", "shingles", F.xxhash64("id").alias("h")).mapInArrow(needed, "id long, shingles binary")
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def bitmaps(sets: DataFrame) -> DataFrame:
    """(id, n, bits): two to four bits for each of the n shingles of a set (64 at least), that hold parities.

    A bit is set if the number of shingles whose hash falls there is odd. So the bits in which two sets differ are the
    parities of the shingles that only one of them has: what they share cancels out, however full the bitmap is.
    """

    def draw(batches):
        for batch in batches:
            sizes, out = [], []
            for raw in batch.column(1).to_pylist():
                x = np.frombuffer(raw, U64)
                width = max(6, int(2 * len(x) - 1).bit_length()) if len(x) else 6
                bits = np.bincount((mix(x) >> U64(64 - width)).astype(np.int64), minlength=1 << width) & 1
                sizes.append(len(x))
                out.append(np.packbits(bits).tobytes())
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], ["id", "n", "bits"])

    return sets.select("id", "shingles").mapInArrow(draw, "id long, n long, bits binary")


def _differing(x: bytes, y: bytes) -> int:
    """Bits that differ between two bitmaps; the finer one is first brought to the width of the other."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):  # places are leading bits of a hash, so neighbours fall together
        a = np.packbits(np.bitwise_xor.reduce(np.unpackbits(a).reshape(len(b) * 8, -1), axis=1))
    return int(np.bitwise_count(a ^ b).sum())


def possible(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps leave it open that the sets reach the similarity; no pair that does is lost.

    Sets of n and m shingles reach it only if at most (n + m) * (100 - percent) / (100 + percent) shingles are in one of
    them alone, and each of these accounts for one differing bit at most.
    """

    def compare(batches):
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            keep = [(100 + percent) * _differing(x, y) <= (100 - percent) * (n + m) for n, x, m, y in zip(*columns, strict=True)]
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    first = bits.select(F.col("id").alias("a"), F.col("n").alias("n"), F.col("bits").alias("x"))
    second = bits.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b")
    return both.select("a", "b", "n", "x", "m", "y").mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    percent: int = 80,
    sketch_bits: int = SKETCH_BITS,
    leader_rounds: int = LEADER_ROUNDS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are runs of other characters than white space (space, \\t to \\r), with A-Z lower-cased; a text's set holds its
    distinct runs of ``shingle`` words (all its words as one, if fewer). Rows are linked if
    100 * intersection >= percent * union, and a component's id is the smallest id reachable.

    Null, empty and blank texts have an empty set and are linked with nothing. Rows that share an id are one node: a link
    of any of them counts. Rows without an id never stand for others; they are kept unless they are copies of a row with
    an id. An empty table gives an empty result. Only the two named columns are read.
    """
    scratch = Scratch(docs.sparkSession, "near")
    prefix = COORDINATES - MATCHES + COLLISIONS
    every = scratch.settle(profiles(docs, id_column, text_column, shingle), "profiles")
    full = every.where("n_shingles > 0 and id is not null")
    classes = full.groupBy("d1", "d2", "n_shingles").agg(
        F.min("id").alias("least"), F.min(F.struct("id", "signature")).alias("one"), F.count(F.lit(1)).alias("copies")
    )
    classes = scratch.settle(
        classes.select(F.col("least").alias("id"), "n_shingles", "d1", "d2", F.col("one.signature").alias("signature"), "copies"),
        "classes",
    )
    # smaller sets reach the similarity only by being equal
    least = -(-percent // max(1, 100 - percent))
    open_ = classes.where(F.col("n_shingles") >= min(least, 1 << 30))
    sketch = token_sketch(open_, sketch_bits)
    posted = scratch.settle(postings(open_, sketch, sketch_bits, prefix), "postings")
    # skip lists of one text; then texts that are left with too few tokens for any pair
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    left = scratch.settle(posted.join(shared, "token"), "shared")
    # how central a text is: one that keeps what its group has in common is in its group's long lists
    able = left.groupBy("id").agg(F.count(F.lit(1)).alias("own"), F.sum("c").alias("central")).where(F.col("own") >= COLLISIONS)
    left = scratch.settle(left.join(able, "id").select("token", "id", "n", "central"), "able")

    # the texts of one id are one node
    several = full.groupBy("id").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).where("lo <> hi").select("id")
    theirs = full.join(several, "id").select(F.col("id").alias("own"), "d1", "d2").join(classes, ["d1", "d2"])
    edges = scratch.settle(theirs.select(F.least("own", "id").alias("a"), F.greatest("own", "id").alias("b")).where("a <> b"), "ids")
    groups = None
    for turn in range(leader_rounds):
        pairs = scratch.settle(_leader_pairs(_with_group(left, groups), turn, percent), f"pairs-{turn}")
        wanted = scratch.settle(classes.join(_ends(pairs), "id").select("id", "d1"), f"wanted-{turn}")
        sets = _shingle_sets(docs, id_column, text_column, shingle, wanted)
        edges = edges.unionByName(scratch.settle(confirmed(pairs, sets, percent), f"links-{turn}"))
        groups = components(edges, scratch, f"groups-{turn}")
    # texts that still share enough tokens with texts of other components
    members = _with_group(left, groups)
    mixed = members.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi")
    ids = scratch.settle(_open(scratch.settle(members.join(mixed.select("token", "c"), "token"), "mixed"), percent), "open-ids")
    wanted = scratch.settle(classes.join(ids, "id").select("id", "d1"), "open")
    sets = scratch.settle(_shingle_sets(docs, id_column, text_column, shingle, wanted), "open-sets")
    bits = scratch.settle(bitmaps(sets), "bitmaps")
    prefixes = scratch.settle(set_prefixes(sets, sketch_bits, percent), "prefixes")
    often = prefixes.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    central = prefixes.join(often, "token").groupBy("id").agg(F.sum("c").alias("central")).join(ids, "id")
    prefixes = scratch.settle(prefixes.join(often, "token").join(central, "id").select("token", "id", "n", "central", "place"), "rare")
    # first to the leaders of rare shingles, which are the roots of groups within groups; then what is left
    for name, candidates in (("leaders", _leader_pairs), ("others", _other_pairs)):
        members = _with_group(prefixes, groups)
        pairs = candidates(members, 0, percent, 1) if name == "leaders" else candidates(members, percent)
        pairs = scratch.settle(possible(scratch.settle(pairs, f"pairs-{name}"), bits, percent), f"possible-{name}")
        links = scratch.settle(confirmed(pairs, sets, percent), f"links-{name}")
        groups = joined_components(groups, links, edges, scratch, f"groups-{name}")
        edges = edges.unionByName(links)

    named = classes.join(groups, "id", "left").select("d1", "d2", "n_shingles", "id", F.coalesce("component", "id").alias("component"), "copies")
    # only classes that don't simply stand for themselves go into the join
    named = named.where("component <> id or copies > 1").select("d1", "d2", F.col("n_shingles").alias("n"), "component")
    joined = every.join(named, (every.d1 == named.d1) & (every.d2 == named.d2) & (every.n_shingles == named.n) & (every.n_shingles > 0), "left")
    return joined.select(
        F.col("id").alias(id_column),
        "n_shingles",
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"),
    )


def _open(members: DataFrame, percent: int) -> DataFrame:
    """Ids that may share enough tokens with one of another component; ``members`` are rows of lists of several, c long.

    Pairs are counted in short lists, which hold nearly all that unrelated texts share by chance, one here, one there. A
    long list counts for each of its members whomever it shares it with, so no pair with enough tokens is lost.
    """
    short = members.where(F.col("c") <= SHORT)
    one = short.select("token", F.col("id").alias("a"), F.col("n").alias("an"), F.col("component").alias("ac"))
    other = short.select("token", F.col("id").alias("b"), F.col("n").alias("bn"), F.col("component").alias("bc"))
    pairs = one.join(other, "token").where("a < b and ac <> bc").where(_alike("an", "bn", percent))
    pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"), "m").groupBy("id").agg(F.max("m").alias("m"))
    long_ = members.where(F.col("c") > SHORT).groupBy("id").agg(F.count(F.lit(1)).alias("m"))
    enough = ends.unionByName(long_).groupBy("id").agg(F.sum("m").alias("m"))
    return enough.where(F.col("m") >= COLLISIONS).select("id")


def _shingle_sets(docs: DataFrame, id_column: str, text_column: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the stored classes (id, d1); texts are read again and filtered where they are, not shuffled.

    Two filters of fixed size, over ids and over ids with their texts' digests, let a few other rows through. Each is a
    set of the row's own id, so a link of it is one of that id; who makes new pairs of them keeps to the wanted ids.
    """
    places = bitmap(wanted, F.xxhash64("id"), FILTER_BITS)
    texts = bitmap(wanted, F.xxhash64("id").bitwiseXOR(F.col("d1")), FILTER_BITS)

    def build(batches):
        for batch in batches:
            h = batch.column(2).to_numpy(zero_copy_only=False)
            mask = in_bitmap(places, h)
            if not mask.any():
                continue
            h, mask = h[mask], pa.array(mask)
            ids = batch.column(0).filter(mask)
            for first, flat, bounds in _sets(batch.column(1).filter(mask), shingle):
                d1, _ = _digests(flat, bounds)
                last = first + len(d1)
                theirs = np.flatnonzero(in_bitmap(texts, h[first:last] ^ signed(d1)))
                sets = [flat[bounds[i] : bounds[i + 1]].tobytes() for i in theirs]
                yield pa.record_batch([ids.slice(first, last - first).take(pa.array(theirs)), pa.array(sets, pa.binary())], ["id", "shingles"])

    own = F.col(id_column).cast("long")
    rows = docs.where(own.isNotNull()).select(own.alias("id"), F.col(text_column).alias("text"), F.xxhash64(own).alias("h"))
    return rows.mapInArrow(build, "id long, shingles binary")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


def _with_group(left: DataFrame, groups: DataFrame | None) -> DataFrame:
    if groups is None:
        return left.withColumn("component", F.col("id"))
    return left.join(groups, "id", "left").select(*left.columns, F.coalesce("component", "id").alias("component"))


def _largest(members: DataFrame, turn: int) -> DataFrame:
    """Per token with several components: the one with most members there, and one member of it as leader."""
    # the most central member leads; in later turns others that are nearly as central get their chance
    share = 1.0 if turn == 0 else F.lit(0.85) + F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(1000)) * 0.00015
    draw = F.struct((F.col("central") * share).alias("central"), F.col("id").alias("id"), F.col("n").alias("n"))
    by_group = members.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"), F.max(draw).alias("one"))
    best = F.max(F.struct("c", F.col("one.central").alias("central"), "component", F.col("one.id").alias("leader"), F.col("one.n").alias("leader_n")))
    per = by_group.groupBy("token").agg(best.alias("best"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    return per.select("token", F.col("best.component").alias("main"), F.col("best.leader").alias("leader"), F.col("best.leader_n").alias("leader_n"))


def _leader_pairs(members: DataFrame, turn: int, percent: int, least: int = COLLISIONS) -> DataFrame:
    """Members outside the largest component of a token with its leader: as many rows as postings at most."""
    rows = members.join(_largest(members, turn), "token").where("component <> main and id <> leader").where(_alike("n", "leader_n", percent))
    pairs = rows.groupBy(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    return pairs.where(F.col("c") >= least).select("a", "b")


def set_prefixes(sets: DataFrame, sketch_bits: int, percent: int) -> DataFrame:
    """(token, id, n, place): the rarest shingles of each set, as many as a pair needs to share one of them.

    Sets that reach the similarity have at least percent / (100 + percent) of their added sizes in common, so the first
    shingle they share, from rare to frequent, comes early in both. Frequencies are a sketch of fixed size.
    """

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw = column.to_pylist()
        return np.frombuffer(b"".join(raw), U64), np.array([len(r) // 8 for r in raw])

    def count(batches):
        total = np.zeros(1 << sketch_bits, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount((mix(flat(batch.column(1))[0]) >> U64(64 - sketch_bits)).astype(np.int64), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])

    sketch = _gathered(sets.select("id", "shingles").mapInArrow(count, "bucket int, n long"), sketch_bits)

    def post(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            shingles, sizes = flat(batch.column(1))
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((shingles, sketch[(mix(shingles) >> U64(64 - sketch_bits)).astype(np.int64)], row))
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = place <= sizes[row] - -(-percent * sizes[row] // 100)
            at = row[keep]
            ids = batch.column(0).to_numpy(zero_copy_only=False)[at]
            yield pa.record_batch(
                [pa.array(signed(shingles[order][keep])), pa.array(ids), pa.array(sizes[at]), pa.array(place[keep])],
                ["token", "id", "n", "place"],
            )

    return sets.select("id", "shingles").mapInArrow(post, "token long, id long, n long, place long")


def _other_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that share a shingle early enough in both sets (members of ``set_prefixes``).

    Members outside the largest component of a shingle meet every other member; two of them meet from the smaller id.
    """
    main = _largest(members, 0).select("token", "main")
    marked = members.join(main, "token")
    minor = marked.where("component <> main").select("token", F.col("id").alias("p"), F.col("n").alias("pn"), F.col("place").alias("pp"), F.col("component").alias("pc"))
    other = marked.select("token", F.col("id").alias("q"), F.col("n").alias("qn"), F.col("place").alias("qp"), F.col("component").alias("qc"), (F.col("component") == F.col("main")).alias("major"))
    # if this is the first shingle they share, what comes after it in either must be enough
    early = F.expr(f"pn - pp >= ({percent} * (pn + qn) + {99 + percent}) div {100 + percent} and qn - qp >= ({percent} * (pn + qn) + {99 + percent}) div {100 + percent}")
    across = F.expr("pc <> qc and (major or p < q)") & _alike("pn", "qn", percent) & early
    rows = minor.join(other, (minor["token"] == other["token"]) & across)
    return rows.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
