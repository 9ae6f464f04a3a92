"""Operator 2: SimHash near-duplicates by the generalised pigeonhole principle.

64-bit fingerprints that differ in at most ``DISTANCE`` bits are linked. Copies
collapse first: what is joined are the distinct fingerprints.

Layout. On a bounded sample of fingerprints (``SAMPLE``, the smallest hashes)
the 64 bits are grouped into ``PARTS`` partitions of correlated bits, and
dynamic programming allots each partition its own threshold so that the
estimated number of keys and candidates is least while the thresholds sum to
``DISTANCE - PARTS + 1`` (-1: the partition is not probed). Two linked
fingerprints then agree up to its threshold in one partition at least. The
sample decides costs only, never results.

Probe. A fingerprint has one key per probed partition and choice of threshold
bits left out. Keys are counted before anything is grouped: a bucket of at most
``BUCKET`` fingerprints is compared within one task; a larger one is dealt out
anew by the same principle (the bits its key leaves open are cut in
``DISTANCE + 1`` parts, one of which must agree), until it is small. As each
step fixes a third of the open bits, that ends after a few steps, whatever the
data. A bucket yields the edges of a spanning star per local component, not
its pairs.

Verify. An edge joins fingerprints whose distance was computed to be at most
``DISTANCE`` or that are connected by such pairs within the bucket.

Defined results: NULL or empty text: fingerprint zero, linked like any other.
Fewer words than a shingle: the whole sequence. NULL doc_id: takes part;
component_id is the least id that is not NULL (NULL if there is none). Repeated
rows are copies. Empty table: empty result.
"""

from __future__ import annotations

import itertools
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import id_text, map_batches, query, stored, table
from listingmart.llm.components import connected_components

SHINGLE, DISTANCE, SEED = 3, 2, 42
PARTS, SAMPLE, BUCKET = 3, 4096, 256
BITS = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the XXH64 values of the whole text's word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[shingle - 1:]) if len(words) >= shingle else [(0, len(joined) + 1)]
    h = np.array([digest(joined[a:b - 1], SEED) for a, b in spans], np.uint64)
    count = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 16):
        count += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _fingerprints(text_col: str, out_col: str, shingle: int):
    def run(batches):
        for b in batches:
            texts = b.column(b.schema.names.index(text_col)).to_pylist()
            yield b.append_column(out_col, _signed([fingerprint(t, shingle) for t in texts]))
    return run


def _ids_only(batches):
    for b in batches:
        yield b.select(["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    run = _fingerprints("text", "fp", shingle)
    return map_batches(id_text(docs, id_col, text_col), lambda it: _ids_only(run(it)), "doc_id long, fp long")


# -- layout ---------------------------------------------------------------------------------------------


def correlated_parts(sample: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Group the bits: each partition grows from a strongly correlated pair by the bit closest to it."""
    x = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    x -= x.mean(axis=0)
    scale = np.sqrt((x * x).sum(axis=0)) + 1e-9
    corr = np.abs(x.T @ x) / np.outer(scale, scale)
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        free = sorted(left)
        a, b = divmod(int(np.argmax(corr[np.ix_(free, free)])), len(free))
        group = list(dict.fromkeys([free[a], free[b]]))[:size]
        left -= set(group)
        while len(group) < size:
            rest = sorted(left)
            best = rest[int(np.argmax(corr[np.ix_(rest, group)].mean(axis=1)))]
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def estimated_cost(sample: np.ndarray, part: list[int], threshold: int, total: int) -> float:
    """Keys and candidate pairs of a partition with a threshold, scaled from the sample to ``total`` fingerprints."""
    if threshold < 0:
        return 0.0
    pairs, keys = 0, 0
    for out in itertools.combinations(part, threshold):
        _, n = np.unique(sample & np.uint64(_mask(part) & ~_mask(out)), return_counts=True)
        pairs += int((n * (n - 1) // 2).sum())
        keys += 1
    return keys * total + pairs * (total / max(1, len(sample))) ** 2


def allot(costs: list[list[float]], distance: int = DISTANCE) -> list[int]:
    """Thresholds (-1 ..) summing to distance - parts + 1 of least total cost; costs[i][t + 1] for threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, distance + 1):
                new = (cost + row[t + 1], [*chosen, t])
                if total + t not in nxt or new[0] < nxt[total + t][0]:
                    nxt[total + t] = new
        best = nxt
    return best[distance - len(costs) + 1][1]


def probe_masks(sample: np.ndarray, total: int, distance: int = DISTANCE, parts: int = PARTS) -> list[int]:
    """The bit masks whose values are a fingerprint's keys."""
    groups = correlated_parts(sample, parts) if len(sample) else [list(range(i, BITS, parts)) for i in range(parts)]
    costs = [[estimated_cost(sample, g, t, total) for t in range(-1, distance + 1)] for g in groups]
    return [_mask(g) & ~_mask(out) for g, t in zip(groups, allot(costs, distance), strict=True) if t >= 0
            for out in itertools.combinations(g, t)]


def refined(mask: int, distance: int = DISTANCE) -> list[int]:
    """``mask`` with each of distance + 1 parts of its open bits added: linked values agree on one of them."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | _mask(free[i::distance + 1]) for i in range(distance + 1)]


# -- probe and verify -----------------------------------------------------------------------------------


def _local_edges(x: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A star per connected group of a bucket's fingerprints."""
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= distance
    label = np.arange(len(x))
    while True:
        new = np.where(near, label[None, :], len(x)).min(axis=1)
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(x)))
    return list(zip(x[label[at]].view(np.int64).tolist(), x[at].view(np.int64).tolist(), strict=True))


def _bucket_edges(distance: int):
    """Rows sorted by (mask, value): compare within each run; a run may span batches but is at most a bucket."""
    def run(batches):
        held: tuple[np.ndarray, ...] | None = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                cols = tuple(b.column(c).to_numpy() for c in ("mask", "value", "fp"))
                cols = cols if held is None else tuple(map(np.concatenate, zip(held, cols, strict=True)))
            elif held is None:
                return
            else:
                cols = held
            mask, value, fp = cols
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])) + 1
            bounds = np.concatenate([[0], cut, [len(fp)]])
            done = len(bounds) - 1 if b is None else len(bounds) - 2
            held = tuple(c[bounds[done]:] for c in cols) if b is not None else None
            starts, sizes = bounds[:done], np.diff(bounds)[:done]
            fps, edges = fp.view(np.uint64), []
            two = starts[sizes == 2]
            two = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= distance]
            edges += zip(fp[two].tolist(), fp[two + 1].tolist(), strict=True)
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                edges += _local_edges(fps[s:s + n], distance)
            yield pa.record_batch({"a": pa.array([e[0] for e in edges], pa.int64()),
                                   "b": pa.array([e[1] for e in edges], pa.int64())})
    return run


def _long(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _keyed(rows: DataFrame, masks: list[int], at=None, distance: int = DISTANCE) -> DataFrame:
    """One row per fingerprint and mask: (mask number, value, fp); ``at``: the ``distance`` + 1 masks of a row start there."""
    literal = F.array(*[F.lit(_long(m)) for m in masks])
    if at is None:
        return rows.select("fp", F.posexplode(literal).alias("mask", "bits")).select(
            "mask", F.col("bits").bitwiseAND(F.col("fp")).alias("value"), "fp")
    return (rows.select("fp", F.explode(F.sequence(at, at + distance)).alias("mask"))
            .select("mask", F.element_at(literal, F.col("mask") + 1).bitwiseAND(F.col("fp")).alias("value"), "fp"))


def link_fingerprints(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column fp) within ``distance`` bits."""
    spark, total = fps.sparkSession, fps.count()
    # at most SAMPLE fingerprints, for the layout only
    sample = fps.orderBy(F.xxhash64("fp")).limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    masks = probe_masks(sample, total, distance)
    keyed, edges = _keyed(fps, masks), None
    while True:
        keyed = stored(keyed, "simhash-keys")
        shared = stored(keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-counts")
        met = stored(keyed.join(shared, ["mask", "value"]), "simhash-shared")
        found = map_batches(met.filter(F.col("n") <= bucket).select("mask", "value", "fp").repartition("mask", "value")
                            .sortWithinPartitions("mask", "value"), _bucket_edges(distance), "a long, b long")
        found = stored(found.distinct(), "simhash-edges")
        edges = found if edges is None else edges.unionByName(found)
        large = met.filter(F.col("n") > bucket)
        if large.isEmpty():
            return edges
        masks = [m for parent in masks for m in refined(parent, distance)]
        keyed = _keyed(large.select("mask", "fp"), masks, F.col("mask") * (distance + 1), distance)


def classes(hashed: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root) of the distinct fingerprints of ``hashed``: root names the component."""
    fps = stored(hashed.select("fp").distinct(), "simhash-distinct")
    roots = connected_components(link_fingerprints(fps, distance))
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    hashed = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-docs")
    least = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-least")
    rooted = stored(classes(hashed, distance).join(least, "fp"), "simhash-rooted")
    by_root = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-roots")
    known = stored(rooted.join(by_root, "root").select("fp", "component_id"), "simhash-classes")
    return hashed.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """One row of each component, all columns: that of the least id (NULL last), ties by place in the input."""
    fp, tag = "fp", "tag"
    while fp in docs.columns or tag in docs.columns:
        fp, tag = fp + "_", tag + "_"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    tagged = stored(map_batches(docs, _fingerprints(text_col, fp, shingle), f"{fields}, `{fp}` long")
                    .withColumn(tag, F.monotonically_increasing_id()), "simhash-tagged")
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col(tag))
    hashed = tagged.select(F.col(fp).alias("fp"), order.alias("at"))
    first = stored(hashed.groupBy("fp").agg(F.min("at").alias("at")), "simhash-first")
    roots = classes(first, distance).join(first, "fp")
    kept = stored(roots.groupBy("root").agg(F.min(F.struct("at", "fp")).alias("k"))
                  .select(F.col("k.fp").alias(fp), F.col(f"k.at.{tag}").alias(tag)), "simhash-kept")
    return tagged.join(kept, [fp, tag], "left_semi").select(*docs.columns)


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))
