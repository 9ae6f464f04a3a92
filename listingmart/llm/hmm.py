"""Operator 7: hidden Markov language model over words.

Words are emitted through classes (the end token; short words as a whole and
longer ones by their last letters, both hashed to ``CLASSES``): a latent state emits
a class, the class emits the word by its smoothed count in the training text.
The model over states and classes is of bounded size; the word counts are as
large as the corpus and never leave the executors.

1. Encode. Each task numbers the words of a block of documents (a bounded share
   of its input) and writes the documents as numbers, and the block's words as
   64-bit hashes with their training counts, dealt to buckets by hash.
2. Count. Each bucket adds up its words over all blocks and sends every block
   the totals of its words, in the block's own order: one number per word and
   block, whatever the frequency of the word.
3. Train. Baum-Welch: every partition computes expected transition and emission
   counts of its training documents, which are summed; every iteration reads all
   training documents. Documents are worked on in segments of ``SEGMENT`` tokens,
   side by side. What a segment does to any state before it (a matrix of states by
   states) carries the forward and backward messages over the cuts, so the counts
   are those of whole documents, and memory is bounded for texts of any length.
4. Score. The scaled forward recursion runs over whole documents and gives the
   exact log likelihood of the class sequence; to it come the words' shares of
   their classes, smoothed so that a class keeps a share for unseen words.

Defined results: NULL or empty text: the end token alone. NULL doc_id: its
crc32 is that of the empty text. Repeated rows train and are scored each. No
training document: N = V = 0 and a uniform model. Empty table: empty result.
Words of equal 64-bit hash would share their count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import crc_mod, id_text, map_batches, partitions, query, scratch_path, table

STATES, CLASSES, SEGMENT = 8, 1024, 1024
#: Tokens that are worked on at once in training.
BATCH_TOKENS = 400_000
#: Iterations at most, and the relative gain of the training likelihood below which they end.
ITERATIONS, GAIN = 10, 2e-3
#: A block ends at so many distinct words or bytes of text.
BLOCK_WORDS, BLOCK_BYTES = 500_000, 24_000_000
SMOOTH = 0.1
END = b""
_BLOCKS = "kind int, block long, bucket int, doc_id long, held_out boolean, a binary, b binary, c binary"


def word_class(word: bytes) -> int:
    """0: the end token; else a hash of words of up to 4 bytes or of the last 3 bytes of longer ones, which share the classes."""
    if not word:
        return 0
    return 1 + xxhash.xxh32_intdigest(word if len(word) <= 4 else b"~" + word[-3:]) % (CLASSES - 1)


def _encode(buckets: int):
    """Documents (kind 0) and dictionary parts (kind 1) of each block."""
    def run(batches):
        part, blocks = TaskContext.get().partitionId(), 0
        number: dict[bytes, int] = {}
        docs: list[tuple] = []
        size = 0

        def flush():
            nonlocal blocks, size
            block = (part << 32) + blocks
            words = list(number)
            hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
            classes = np.array([word_class(w) for w in words], np.uint16)
            learnt = [ids for _, held, ids in docs if not held]
            train = np.bincount(np.concatenate(learnt) if learnt else np.zeros(0, np.uint32), minlength=len(words))
            bucket = (hashes % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            for i in range(0, len(docs), 256):
                some = docs[i:i + 256]
                yield _rows(0, block, [0] * len(some), [d for d, _, _ in some], [h for _, h, _ in some],
                            [place[x].tobytes() for _, _, x in some], [classes[x].tobytes() for _, _, x in some],
                            [b""] * len(some))
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = [k for k in range(buckets) if bounds[k] < bounds[k + 1]]
            cut = [order[bounds[k]:bounds[k + 1]] for k in used]
            yield _rows(1, block, used, [None] * len(used), [None] * len(used), [hashes[x].tobytes() for x in cut],
                        [classes[x].tobytes() for x in cut], [train[x].tobytes() for x in cut])
            number.clear()
            docs.clear()
            blocks, size = blocks + 1, 0

        for b in batches:
            for doc, held, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
                raw = (text or "").encode().lower()
                words = raw.split()
                words.append(END)
                ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
                docs.append((doc, held, ids.astype(np.uint32)))
                size += len(raw)
                if size >= BLOCK_BYTES or len(number) >= BLOCK_WORDS:
                    yield from flush()
        if docs:
            yield from flush()
    return run


def _rows(kind, block, bucket, doc, held, a, b, c) -> pa.RecordBatch:
    n = len(a)
    return pa.record_batch({
        "kind": pa.array([kind] * n, pa.int32()), "block": pa.array([block] * n, pa.int64()),
        "bucket": pa.array(bucket, pa.int32()), "doc_id": pa.array(doc, pa.int64()), "held_out": pa.array(held, pa.bool_()),
        "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "c": pa.array(c, pa.binary())})


def _count_bucket(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Total training counts of one bucket's words: a part for each block, and the known words per class."""
    hashes = [np.frombuffer(x, np.uint64) for x in pdf["a"]]
    everything = np.concatenate(hashes)
    _, first, inverse = np.unique(everything, return_index=True, return_inverse=True)
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["c"]])
    total = np.zeros(len(first), np.int64)
    np.add.at(total, inverse, counts)
    classes = np.concatenate([np.frombuffer(x, np.uint16) for x in pdf["b"]])[first]
    known = np.bincount(classes[total > 0], minlength=CLASSES)
    ends = np.cumsum([len(x) for x in hashes])
    parts = [total[inverse[e - len(x):e]].tobytes() for x, e in zip(hashes, ends, strict=True)]
    return pd.DataFrame({"block": [*pdf["block"], -1], "bucket": [*pdf["bucket"], int(key[0])], "c": [*parts, known.tobytes()]})


def _summed_vectors(column: str, size: int):
    """Element-wise sums of binary int64 vectors within a partition, as (k, v) rows."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(column).to_pylist():
                total += np.frombuffer(x, np.int64)
        at = np.flatnonzero(total)
        yield pa.record_batch({"k": pa.array(at.astype(np.int32)), "v": pa.array(total[at])})
    return run


def _class_counts(batches):
    """Training tokens per class within a partition."""
    total = np.zeros(CLASSES, np.int64)
    for b in batches:
        for x in b.column("b").to_pylist():
            total += np.bincount(np.frombuffer(x, np.uint16), minlength=CLASSES)
    at = np.flatnonzero(total)
    yield pa.record_batch({"k": pa.array(at.astype(np.int32)), "v": pa.array(total[at])})


def _vector(df: DataFrame, size: int) -> np.ndarray:
    """The sums of (k, v) rows as one dense vector of bounded size."""
    out = np.zeros(size)
    for r in df.groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out


@dataclass
class Model:
    start: np.ndarray  # (states)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (states, classes)


def start_model(tokens: np.ndarray, states: int = STATES) -> Model:
    """Sticky states that emit the classes at their overall rates, each tilted at random."""
    rng = np.random.default_rng(5)
    rate = (tokens + 1.0) / (tokens + 1.0).sum()
    emit = rate * rng.gamma(2.0, 0.5, size=(states, len(tokens)))
    move = np.full((states, states), 0.05 / states) + 0.95 * np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def _by_time(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sequences side by side, longest first: their order, the classes of time 0, 1, ..., where each time
    begins (and, last, the end), and the place of each sequence's last token."""
    sizes = np.array([len(x) for x in parts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    begins = np.concatenate([[0], np.cumsum(np.searchsorted(-sizes, -np.arange(sizes[0])))])
    column = np.repeat(np.arange(len(parts)), sizes)
    time = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    classes = np.empty(len(time), np.uint16)
    classes[begins[time] + column] = np.concatenate([parts[i] for i in order])
    return order, classes, begins, begins[sizes - 1] + np.arange(len(parts))


def _chunks(parts: list[np.ndarray]):
    """Index ranges of about ``BATCH_TOKENS`` tokens."""
    first, size = 0, 0
    for i, x in enumerate(parts):
        size += len(x)
        if size >= BATCH_TOKENS or i == len(parts) - 1:
            yield slice(first, i + 1)
            first, size = i + 1, 0


def _transfers(model: Model, parts: list[np.ndarray]) -> np.ndarray:
    """For each sequence the matrix (state before its first token is emitted, state after its last), up to a factor."""
    states = len(model.start)
    move, emit = model.move.astype(np.float32), np.ascontiguousarray(model.emit.T.astype(np.float32))
    out, ones = np.empty((len(parts), states, states)), np.ones((states, 1), np.float32)
    for chunk in _chunks(parts):
        order, classes, begins, _ = _by_time(parts[chunk])
        done = np.empty((len(order), states, states), np.float32)
        log = np.zeros((len(order), states))
        live = len(order)
        x = np.broadcast_to(np.eye(states, dtype=np.float32), (live, states, states))
        last = len(begins) - 2
        for t in range(last + 1):
            now = int(begins[t + 1] - begins[t])
            if t:
                done[now:live] = x[now:]
                live, x = now, (x[:now].reshape(-1, states) @ move).reshape(now, states, states)
            x = x * emit[classes[begins[t]:begins[t + 1]]][:, None, :]
            if t % 4 == 3:
                scale = (x.reshape(-1, states) @ ones).reshape(live, states, 1)
                x /= scale
                log[:live] += np.log(scale[:, :, 0])
        done[:live] = x
        out[np.arange(len(parts))[chunk][order]] = done * np.exp(log - log.max(axis=1, keepdims=True))[:, :, None]
    return out


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=1, keepdims=True)


def _messages(model: Model, parts: list[np.ndarray], level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each segment: the state's distribution at its first token and at the token before, given what came
    before, and the weight of its last state by what follows. ``level`` numbers the segments of a document."""
    enter = np.tile(model.start, (len(parts), 1))
    before, leave = np.zeros_like(enter), np.ones_like(enter)
    split = level > 0
    split[:-1] |= split[1:]
    at = np.cumsum(split) - 1
    whole = _transfers(model, [x for x, k in zip(parts, split, strict=True) if k]) if split.any() else None
    order = np.argsort(level, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(level[order])) + 1)[1:]
    for now in levels:
        before[now] = _normal(np.einsum("ni,nij->nj", enter[now - 1], whole[at[now - 1]]))
        enter[now] = before[now] @ model.move
    for now in reversed(levels):
        leave[now - 1] = _normal(np.einsum("nij,nj->ni", whole[at[now]], leave[now]) @ model.move.T)
    return enter, before, leave


def expected_counts(model: Model, sequences: list[np.ndarray], length: int = SEGMENT) -> np.ndarray:
    """Baum-Welch expectations of whole sequences (start, move and emit counts in one vector) and, last,
    their log likelihood. The length of the segments does not change them."""
    parts = [s[i:i + length] for s in sequences for i in range(0, len(s), length)]
    level = np.concatenate([np.arange(-(-len(s) // length)) for s in sequences])
    messages = _messages(model, parts, level)
    return sum(_segment_counts(model, parts[c], level[c] == 0, *(m[c] for m in messages)) for c in _chunks(parts))


def _segment_counts(model: Model, parts: list[np.ndarray], begin: np.ndarray, enter: np.ndarray, before: np.ndarray,
                    leave: np.ndarray) -> np.ndarray:
    """Forward and backward within segments, between the messages at their ends."""
    order, classes, begins, lasts = _by_time(parts)
    begin, enter, before, leave = (x[order].astype(x.dtype if x.dtype == bool else np.float32) for x in (begin, enter, before, leave))
    move = model.move.astype(np.float32)
    seen = np.ascontiguousarray(model.emit.T.astype(np.float32))[classes]
    alpha, scale = np.empty_like(seen), np.empty((len(seen), 1), np.float32)
    ones = np.ones((len(move), 1), np.float32)  # a product with it sums up short rows faster
    times, live = range(len(begins) - 1), np.diff(begins)
    for t in times:
        own = slice(begins[t], begins[t + 1])
        a = (alpha[begins[t - 1]:begins[t - 1] + live[t]] @ move if t else enter) * seen[own]
        scale[own] = a @ ones
        np.divide(a, scale[own], out=alpha[own])
    beta = np.empty_like(seen)
    beta[lasts] = leave / (alpha[lasts] * leave).sum(axis=1, keepdims=True)
    seen /= scale  # and, from the end on, times beta
    for t in reversed(times):
        own = slice(begins[t], begins[t + 1])
        seen[own] *= beta[own]
        if t:
            beta[begins[t - 1]:begins[t - 1] + live[t]] = seen[own] @ move.T
    width = live[0]
    previous = np.arange(width, len(seen)) - np.repeat(live[:-1], live[1:])
    moves = (alpha[previous].T @ seen[width:] + before[~begin].T @ seen[:width][~begin]) * model.move
    alpha *= beta
    alpha /= alpha @ ones
    emits = np.stack([np.bincount(classes, alpha[:, k], CLASSES) for k in range(alpha.shape[1])])
    return np.concatenate([alpha[:width][begin].sum(axis=0), moves.ravel(), emits.ravel(), [np.log(scale, dtype=np.float64).sum()]])


def _expectations(model: Model):
    def run(batches):
        total = np.zeros(STATES + STATES * STATES + STATES * CLASSES + 1)
        held, size = [], 0
        for b in batches:
            for x in b.column("b").to_pylist():
                held.append(np.frombuffer(x, np.uint16))
                size += len(held[-1])
                if size >= BATCH_TOKENS:
                    total += expected_counts(model, held)
                    held, size = [], 0
        if held:
            total += expected_counts(model, held)
        yield pa.record_batch({"k": pa.array(np.arange(len(total), dtype=np.int32)), "v": pa.array(total)})
    return run


def baum_welch(docs: DataFrame, model: Model, iterations: int) -> Model:
    """At most ``iterations`` over all rows of ``docs`` (column b: class sequence); counts are summed across partitions.

    Each tells the likelihood of the model that it began with; once an iteration has raised it by less
    than ``GAIN`` of itself, its counts make the last model.
    """
    before, ended = -math.inf, False
    for _ in range(iterations):
        if ended:
            break
        *total, likelihood = _vector(map_batches(docs.select("b"), _expectations(model), "k int, v double"),
                                     STATES + STATES * STATES + STATES * CLASSES + 1)
        before, ended = likelihood, likelihood - before < GAIN * abs(likelihood)
        start, move, emit = np.split(np.array(total), [STATES, STATES + STATES * STATES])
        move, emit = move.reshape(STATES, STATES) + 1e-3, emit.reshape(STATES, CLASSES) + 0.05
        model = Model((start + 1e-3) / (start + 1e-3).sum(), move / move.sum(axis=1, keepdims=True),
                      emit / emit.sum(axis=1, keepdims=True))
    return model


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 likelihood of each whole class sequence by the scaled forward recursion, all sequences at once."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    sizes = np.array([len(sequences[i]) for i in order], np.int64)
    flat = np.concatenate([sequences[i] for i in order])
    starts = np.cumsum(sizes) - sizes
    emit = np.ascontiguousarray(model.emit.T)
    total, live = np.zeros(len(order)), len(order)
    alpha = model.start * emit[flat[starts]]
    for t in range(int(sizes[0])):
        if t:
            while sizes[live - 1] <= t:
                live -= 1
            alpha = (alpha[:live] @ model.move) * emit[flat[starts[:live] + t]]
        scale = alpha.sum(axis=1)
        total[:live] += np.log10(scale)
        alpha /= scale[:, None]
    out = np.empty(len(order))
    out[order] = total
    return out


def _scored(model: Model, class_tokens: np.ndarray, class_words: np.ndarray):
    """Blocks in order: first the block's word counts, then its documents."""
    n, v = class_tokens.sum(), class_words.sum()
    denominator = class_tokens + SMOOTH * (class_words + 1)

    def score(parts, docs):
        count = np.concatenate(parts).astype(float) if parts else np.zeros(0)
        base = np.log10((count + SMOOTH) / (n + SMOOTH * (v + 1)))
        local = [np.frombuffer(a, np.uint32) for _, _, a, _ in docs]
        classes = [np.frombuffer(b, np.uint16) for _, _, _, b in docs]
        forward = log_likelihoods(model, classes)
        base_score = [float(base[x].sum()) for x in local]
        known = [int((count[x] > 0).sum()) for x in local]
        share = [float(np.log10((count[x] + SMOOTH) / denominator[c]).sum()) for x, c in zip(local, classes, strict=True)]
        return pa.record_batch({
            "doc_id": pa.array([d[0] for d in docs], pa.int64()), "held_out": pa.array([d[1] for d in docs], pa.bool_()),
            "n_tokens": pa.array([len(x) for x in local], pa.int64()), "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array([int(n)] * len(docs), pa.int64()), "base_score": pa.array(base_score, pa.float64()),
            "score": pa.array(forward + np.array(share), pa.float64())})

    def run(batches):
        at, parts, docs = None, [], []
        for b in batches:
            for block, doc, held, a, x, c in zip(*(b.column(k).to_pylist() for k in (
                    "block", "doc_id", "held_out", "a", "b", "c")), strict=True):
                if block != at:
                    if docs:
                        yield score(parts, docs)
                    at, parts, docs = block, [], []
                if c:
                    parts.append(np.frombuffer(c, np.int64))
                else:
                    docs.append((doc, held, a, x))
        if docs:
            yield score(parts, docs)
    return run


def score_corpus(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the rows where ``held_out`` (a Column over id ``doc_id``) is false and score every row."""
    spark, buckets, path = docs.sparkSession, max(16, partitions(docs.sparkSession)), scratch_path(docs.sparkSession, "hmm")
    rows = id_text(docs, id_col, text_col).withColumn("held_out", held_out)
    map_batches(rows, _encode(buckets), _BLOCKS).write.partitionBy("kind").parquet(f"{path}/encoded")
    encoded = spark.read.schema(_BLOCKS).parquet(f"{path}/encoded")
    words, texts = encoded.filter("kind = 1"), encoded.filter("kind = 0")
    (words.select("block", "bucket", "a", "b", "c").groupBy("bucket")
     .applyInPandas(_count_bucket, "block long, bucket int, c binary").write.parquet(f"{path}/counts"))
    counts = spark.read.schema("block long, bucket int, c binary").parquet(f"{path}/counts")
    class_words = _vector(map_batches(counts.filter("block = -1").select("c"), _summed_vectors("c", CLASSES), "k int, v long"), CLASSES)
    training = texts.filter("NOT held_out")
    class_tokens = _vector(map_batches(training.select("b"), _class_counts, "k int, v long"), CLASSES)
    model = start_model(class_tokens)
    if class_tokens.any():  # every document has its end token
        model = baum_welch(training, model, ITERATIONS)
    else:
        model = Model(model.start, model.move, np.full((STATES, CLASSES), 1 / CLASSES))
    none = F.lit(None)
    met = (texts.select("block", F.lit(-1).alias("bucket"), "doc_id", "held_out", "a", "b", none.cast("binary").alias("c"))
           .unionByName(counts.filter("block >= 0").select(
               "block", "bucket", none.cast("long").alias("doc_id"), none.cast("boolean").alias("held_out"),
               none.cast("binary").alias("a"), none.cast("binary").alias("b"), "c")))
    dealt = met.repartition("block").sortWithinPartitions("block", F.col("c").isNull(), "bucket")
    return map_batches(dealt, _scored(model, class_tokens, class_words),
                       "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


@query("op7_hmm")
def op7_hmm(spark: SparkSession, sf: str) -> DataFrame:
    return score_corpus(table(spark, sf, "documents"), crc_mod(F.col("doc_id"), 10) == 0)
