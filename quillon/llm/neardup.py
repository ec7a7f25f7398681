"""MinHash near-duplicates with sequential Bayesian verification.

A document's set is its distinct 5-word shingles.  Equal sets form one class
and are linked by that alone.  Classes whose signatures agree in one of 32
bands of 4 minima are candidates; at a similarity of 0.75 a pair misses every
band with a chance of 5e-6.

A candidate pair is compared in batches of 16 signature bytes.  After each the
pair goes if the posterior chance that its similarity reaches the threshold,
from a uniform prior, is under ``Settings.miss``.  What survives is verified on
the full sets.

Only components are asked for, so no group is expanded into all its pairs.
Each class is tried against the smallest class that shares a band with it; what
is then still apart is compared between components only, in each bucket.
Buckets of over ``Settings.small_bucket`` members are compared in blocks of
``Settings.block`` members, or fewer where their sets are long, whatever the
bucket's size: every pair of different components is compared, and those that
survive pruning are listed by member until they are verified; links alone are
given out, and of those only ones that connect.  A pair counts in the first band that it shares only, and
each set goes once to each pair of blocks that needs it, so rows follow the
members of a bucket as long as it fits a block and grow by one copy of each
member for every further block.

Defined results: a null or empty text has no shingle, is linked with nothing
and keeps itself; a text of under five words is one shingle; repeated rows are
in one class; a null ``doc_id`` never becomes a component's name unless all
of its documents have none; an empty table gives an empty result.  Sets are
named by 64-bit hashes: two different ones of n share a name with a chance
of about n**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._words import mix, shingles, words
from quillon.llm.components import components
from quillon.scratch import Scratch

BANDS, ROWS = 32, 4
HASHES = 256
FILTER_BITS, MOST_FILTER_BITS = 1 << 22, 1 << 27
_RNG = np.random.Generator(np.random.PCG64(97))
_A, _B = (_RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1) for _ in range(2))
_BAND = _RNG.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Settings:
    percent: int = 75
    miss: float = 1e-5
    batch: int = 16
    batch_rows: int = 512
    small_bucket: int = 16
    block: int = 2048
    block_shingles: int = 1 << 20


def signature(own: np.ndarray) -> np.ndarray:
    """256 minima over a set of shingle hashes; the first 128 make up the bands."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (own >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(x), 2048):
        v = x[None, lo : lo + 2048] * _A[:, None]
        v ^= v >> np.uint32(15)
        v *= _B[:, None]
        np.minimum(out, v.min(1), out=out)
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, which depends on the band's place too."""
    return mix((minima[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(1, dtype=np.uint64) ^ _BAND[:, 0])


def set_name(own: np.ndarray) -> int:
    """64-bit name of a set."""
    return int(mix(np.array([mix(own ^ np.uint64(0x5BF03635)).sum(dtype=np.uint64) ^ np.uint64(len(own))]))[0].astype(np.int64))


def document_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for w in words(column):
        for lo, hi in zip(w.bounds[:-1], w.bounds[1:]):
            yield np.unique(shingles(w.hashes[lo:hi]))


def fewest_matches(s: Settings) -> dict[int, int]:
    """For each number of compared bytes, the matches under which a pair goes.

    A byte matches by chance once in 256, so similarity j shows as j + (1 - j) / 256.
    The posterior chance of at least t after m of n is that of at most m
    successes in n + 1 trials of chance t.
    """
    t = s.percent / 100
    t += (1 - t) / 256
    out = {}
    for n in range(s.batch, HASHES + 1, s.batch):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= s.miss:
                break
            m += 1
        out[n] = m
    return out


def _signed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep``), ``n``, ``h``, ``bands`` and ``sig`` of each document; ``h`` is null without shingles."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    row_type = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h, sig, bands = [], [], [], []
            for own in document_sets(batch.column(1)):
                n.append(len(own))
                if len(own):
                    minima = signature(own)
                    h.append(set_name(own))
                    sig.append(minima.astype(np.uint8).tobytes())  # the low bytes
                    bands.append(band_keys(minima).view(np.int64))
                else:
                    h.append(None)
                    sig.append(None)
                    bands.append(np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *bands])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h, pa.int64()), lists, pa.array(sig, pa.binary())], ["row", "n", "h", "bands", "sig"])

    return packed.mapInArrow(run, f"row {row_type}, n long, h long, bands array<long>, sig binary")


def prune(pairs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """The pairs ``a``, ``b`` that stay possible after every batch of signature bytes."""
    side = [classes.select(F.col("h").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab"]
    joined = pairs.join(side[0], "a").join(side[1], "b")
    near = joined.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * s.percent).select("a", "b", "sig_a", "sig_b")
    needed = fewest_matches(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (2, 3)]
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for upto, least in needed.items():
                part = slice(upto - s.batch, upto)
                matches = matches + (sig[0][alive, part] == sig[1][alive, part]).sum(1)
                stay = matches >= least
                alive, matches = alive[stay], matches[stay]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], ["a", "b"])

    return near.mapInArrow(run, "a long, b long")


def full_sets(ends: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``h`` and ``own`` (sorted shingle hashes) of the classes in ``ends``, read anew from the texts.

    A bit filter of the wanted documents spares the other texts a second
    shingling.  It has eight bits or more for each of up to ``MOST_FILTER_BITS / 8``
    documents and never takes more than 16 MB; beyond that it lets more texts
    pass, which the join removes.
    """
    named = classes.join(ends, "h").select("doc")
    bits = FILTER_BITS
    wanted = named.count()
    while bits < min(8 * wanted, MOST_FILTER_BITS):
        bits *= 2
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    filled = named.select(bit(F.col("doc")).alias("bit")).groupBy(F.shiftright("bit", 5).alias("at"))
    filled = filled.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).toArrow()
    mask = np.zeros(bits // 32, np.uint32)
    mask[filled["at"].to_numpy()] = filled["bits"].to_numpy()
    mask = docs.sparkSession.sparkContext.broadcast(mask)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, size = [], 0
            bits = batch.column(0).to_numpy()
            hit = (mask.value[bits >> 5] >> (bits & 31).astype(np.uint32)) & 1 > 0
            for own in document_sets(batch.column(1).filter(pa.array(hit))):
                if len(own):
                    kept.append((set_name(own), own.tobytes()))
                    size += own.nbytes
                if size > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*kept), (pa.int64(), pa.binary()))], ["h", "own"])
                    kept, size = [], 0
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*kept), (pa.int64(), pa.binary()))], ["h", "own"])

    texts = docs.select(bit(F.col("doc_id")).alias("bit"), "text")
    return texts.mapInArrow(read, "h long, own binary").join(ends, "h", "left_semi").dropDuplicates(["h"])


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(x) > len(y):
        x, y = y, x
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    ends = pairs.select(F.col("a").alias("h")).unionAll(pairs.select(F.col("b").alias("h"))).distinct()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [[np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(i)] for i in (2, 3)]
            linked = pa.array([similar(x, y, s.percent) for x, y in zip(*sets)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(linked) for i in (0, 1)], ["a", "b"])

    sets = full_sets(ends, classes, docs)
    side = [sets.select(F.col("h").alias(x), F.col("own").alias(f"own_{x}")) for x in "ab"]
    return pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "own_a", "own_b").mapInArrow(compare, "a long, b long")


def verify_blocks(possible: DataFrame, classes: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """Links among the pairs that ``_between_blocks`` gives out, verified block by block on full sets.

    Every set goes once to each pair of blocks that needs it.  Members that are
    connected by then are not compared, so each pair of blocks gives out fewer
    links than it has members.
    """
    sets = full_sets(possible.select("h").distinct(), classes, docs)
    rows = possible.join(sets, "h").select("k", "i", "j", "h", "own", "with")

    def compare(t: pa.Table) -> pa.Table:
        own = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("own")]
        size = np.array([len(v) for v in own])
        _, at = np.unique(np.concatenate(own), return_inverse=True)
        bounds = np.concatenate([[0], np.cumsum(size)])
        place = {h: i for i, h in enumerate(t.column("h").to_pylist())}
        names = np.array(list(place), np.int64)
        mine = np.zeros(int(at.max()) + 1, np.int64)
        links = []
        group = np.arange(len(own))
        for i, others in enumerate(t.column("with").to_pylist()):
            y = np.array([place[x] for x in others or []], np.int64)
            y = y[group[y] != group[i]]
            if not len(y):
                continue
            mine[at[bounds[i] : bounds[i + 1]]] = 1
            parts = np.concatenate([at[bounds[j] : bounds[j + 1]] for j in y])
            common = np.add.reduceat(mine[parts], np.concatenate([[0], np.cumsum(size[y])[:-1]]))
            mine[at[bounds[i] : bounds[i + 1]]] = 0
            for j in y[100 * common >= s.percent * (size[i] + size[y] - common)]:
                if group[j] != group[i]:
                    group[group == group[j]] = group[i]
                    links.append((names[i], names[j]))
        ends = np.sort(np.array(links, np.int64).reshape(-1, 2), axis=1)
        return pa.table([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return rows.groupBy("k", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, keep: list[str], s: Settings = Settings()) -> DataFrame:
    """Columns ``keep`` of every row and ``dup``, a struct of ``n_shingles``,
    ``component_id`` (smallest ``doc_id`` reachable), ``kept`` and ``group``, a
    name of the component that is null for an empty set.

    ``docs`` needs ``doc_id`` and ``text``; ``keep`` must hold ``doc_id``.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.save(_signed(docs, keep), s.batch_rows)
    classes = rows.where("h is not null").groupBy("h")
    classes = scratch.save(classes.agg(F.min("row.doc_id").alias("doc"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    posted = classes.select("h", F.explode("bands").alias("key"))
    shared = posted.groupBy("key").agg(F.min("h").alias("low"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "low")
    members = scratch.save(posted.join(shared, "key"))
    links = _links(members, classes, docs, s, scratch)
    roots = scratch.save(components(links, scratch)) if links is not None else None
    scratch.keep_only(rows, classes, *([roots] if roots is not None else []))
    named = classes.select("h", "doc")
    if roots is not None:
        named = named.join(roots.select(F.col("node").alias("h"), "root"), "h", "left").withColumn("root", F.coalesce("root", "h"))
        smallest = named.groupBy("root").agg(F.min("doc").alias("smallest"))
        named = named.join(smallest, "root").select("h", "smallest", F.col("root").alias("group"))
    else:
        named = named.select("h", F.col("doc").alias("smallest"), F.col("h").alias("group"))
    component = F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("row.doc_id"))
    out = rows.select("row", "n", "h").join(named, "h", "left").withColumn("component_id", component)
    kept = F.col("row.doc_id").eqNullSafe(F.col("component_id"))
    return out.select("row.*", F.struct(F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"), "group").alias("dup"))


def _links(members: DataFrame, classes: DataFrame, docs: DataFrame, s: Settings, scratch: Scratch) -> DataFrame | None:
    """Verified links that connect every component."""
    links: DataFrame | None = None
    mixed = members.select(F.col("key").alias("k"), "h")

    def confirmed(pairs: DataFrame) -> None:
        nonlocal links
        possible = scratch.save(prune(pairs.distinct(), classes, s))
        if not possible.isEmpty():
            found = scratch.save(verify(possible, classes, docs, s), s.batch_rows)
            links = found if links is None else links.unionAll(found)
        scratch.drop(possible)

    def still_mixed() -> bool:
        """Keep the buckets of ``mixed`` that hold several components; whether there are any."""
        nonlocal mixed
        placed = mixed.select("k", "h").withColumn("root", F.col("h"))
        if links is not None:
            roots = components(links, scratch).select(F.col("node").alias("h"), F.col("root").alias("r"))
            placed = mixed.select("k", "h").join(roots, "h", "left").select("k", "h", F.coalesce("r", "h").alias("root"))
        mixed = scratch.save(_apart(scratch.save(placed)))
        return not mixed.isEmpty()

    confirmed(members.where("h <> low").groupBy("h").agg(F.min("low").alias("a")).select("a", F.col("h").alias("b")))
    if not still_mixed():
        return links
    small = mixed.where(F.col("m") <= s.small_bucket)
    x, y = (small.select("k", F.col("h").alias(h), F.col("root").alias(f"root_{h}")) for h in "ab")
    confirmed(x.join(y, "k").where("a < b and root_a <> root_b").select("a", "b"))
    large = mixed.where(F.col("m") > s.small_bucket)
    possible = scratch.save(_between_blocks(large, classes, s), s.batch_rows)
    if not possible.isEmpty():
        found = scratch.save(verify_blocks(possible, classes, docs, s), s.batch_rows)
        links = found if links is None else links.unionAll(found)
    scratch.drop(possible)
    return links


def _apart(placed: DataFrame) -> DataFrame:
    """Members of the buckets ``k`` that hold more than one component, with the bucket's size."""
    several = placed.groupBy("k").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi")
    return placed.join(several.select("k", "m"), "k")


def _between_blocks(mixed: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Pairs in different components that stay possible, compared block by block within each bucket.

    Per pair of blocks (``k``, ``i``, ``j``), one row for each member ``h`` that
    is in such a pair: ``with`` the others; null for a member that is only another's partner.
    """
    rows = mixed.join(classes.select("h", "n", "sig", "bands"), "h")
    shape = mixed.join(classes.select("h", "n"), "h").groupBy("k").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("members") / s.block), F.ceil(F.col("shingles") / s.block_shingles)).cast("int")
    rows = rows.join(shape.select("k", blocks.alias("blocks")), "k")
    rows = rows.withColumn("at", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("k", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), (F.col("at") <= F.col("other")).alias("left"), "h", "root", "n", "sig", "bands")
    needed = fewest_matches(s)

    def compare(t: pa.Table) -> pa.Table:
        k, i, j = (t.column(c)[0].as_py() for c in ("k", "i", "j"))
        h, root, n = (t.column(c).to_numpy() for c in ("h", "root", "n"))
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        left = t.column("left").to_numpy(zero_copy_only=False).astype(bool)
        x, y = (np.arange(len(h)),) * 2 if i == j else (np.flatnonzero(left), np.flatnonzero(~left))
        found: dict[int, list[int] | None] = {}
        for a in x:
            sizes = 100 * np.minimum(n[y], n[a]) >= s.percent * np.maximum(n[y], n[a])
            alive = y[sizes & (root[y] != root[a]) & ((h[y] > h[a]) | (i != j))]
            matches = np.zeros(len(alive), np.int64)
            for upto, least in needed.items():
                part = slice(upto - s.batch, upto)
                matches = matches + (sig[alive, part] == sig[a, part]).sum(1)
                stay = matches >= least
                alive, matches = alive[stay], matches[stay]
                if upto == s.batch and len(alive):
                    first = bands[alive, (bands[alive] == bands[a]).argmax(1)] == k
                    alive, matches = alive[first], matches[first]
                if not len(alive):
                    break
            if len(alive):
                found[a] = h[alive].tolist()
                for b in alive:
                    found.setdefault(b, None)
        out = [(k, i, j, h[a], others) for a, others in found.items()]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        names = ["k", "i", "j", "h", "with"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, kinds)], names)

    schema = "k long, i int, j int, h long, `with` array<long>"
    return rows.groupBy("k", "i", "j").applyInArrow(compare, schema)
