"""Operator 4: repeated passages, located with sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words. A word goes if a window that covers it
also starts in a document with a smaller id.

1. Copies. Documents with the same word sequence as a smaller one go whole (if
   they hold a window) and take no further part.
2. Phrases. In every window the ``PHRASE`` consecutive words of least hash are
   its phrase, so equal windows have equal phrases at equal places, and a
   document has few of them. Phrases seen in two documents or more recur.
3. Confirm. Only windows with a recurring phrase are hashed (128 bits); those
   seen in two documents are confirmed, and their home is the least document.
   A passage is a run of confirmed windows of one phrase in their home.
4. Locate. Passages are dealt to shards by phrase; each shard compiles an
   automaton of its phrases and streams through it the stretches of all
   documents that may hold them. Around an occurrence, the windows that the
   passages hold (by 128-bit digest) are repeats of their home. Shards with more than their part
   of the stretches (a passage that very many documents share) are dealt to
   several tasks, each of which compiles the same automaton.

Defined results: NULL or empty text: no words. NULL doc_id: larger than every
id. Rows with equal ids are one document: they never remove each other's words.
Fewer than ``WINDOW`` words: nothing is removed. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingmart.llm.common import map_batches, partitions, query, stored, table

WINDOW, PHRASE = 50, 10
_REACH = WINDOW - PHRASE  # words of a window before or after its phrase at most
_LAST_ID = (1 << 63) - 1
#: Low bits of a phrase hash that give way to its place when the least one of a window is sought.
_PLACE_BITS = 20
#: Words whose hash a worker keeps.
CACHE_WORDS = 500_000
_M = (1 << 64) - 1
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _WordHash()
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """factor ** i and its inverse modulo 2 ** 64 for i up to ``n``."""
    if factor not in _POWERS or len(_POWERS[factor][0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            up, down = (np.cumprod(np.full(size, f, np.uint64)) for f in (factor, pow(factor, -1, 1 << 64)))
        _POWERS[factor] = up, down
    return _POWERS[factor][0][:n], _POWERS[factor][1][:n]


def rolling(h: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A 64-bit hash of ``width`` consecutive word hashes from each place on."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(factor, len(h))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up)])
    x = (sums[width:] - sums[:-width]) * down[:len(h) - width + 1]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Words:
    """A document's words, their phrases and windows."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode().split()
        self.n = len(self.words)

    def hash(self) -> np.ndarray:
        return np.fromiter(map(_HASH.__getitem__, self.words), np.uint64, self.n)

    def phrases(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Phrase hash at each place; and the places that are some window's phrase, each with the first of
        its windows and how many there are (windows of one phrase follow one another)."""
        grams = rolling(h, PHRASE, _FACTORS[0])
        at = least_places(grams)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        return grams, at[first], first, np.diff(np.append(first, len(at)))


def least_places(grams: np.ndarray) -> np.ndarray:
    """For each window, the first place of the least phrase hash (by its bits above ``_PLACE_BITS``).

    Hash and place are one number, so the least of ``_REACH`` + 1 neighbours takes a few steps of doubled width.
    """
    span, low, out = _REACH + 1, np.uint64((1 << _PLACE_BITS) - 1), []
    step = 1 << (_PLACE_BITS - 1)
    for i in range(0, len(grams) - _REACH, step):
        part = grams[i:i + step + _REACH]
        key, width = (part & ~low) | np.arange(len(part), dtype=np.uint64), 1
        while width < span:
            more = min(width, span - width)
            key, width = np.minimum(key[:-more], key[more:]), width + more
        out.append((key & low).astype(np.int64) + i)
    return np.concatenate(out)


def _scan(batches):
    """n_words, a 128-bit key of the word sequence, its sha256 and the document's distinct phrases."""
    for b in batches:
        n, k1, k2, sha, phrases = [], [], [], [], []
        for text in b.column("text").to_pylist():
            w = Words(text)
            joined = b" ".join(w.words)
            key = xxhash.xxh3_128_digest(joined)
            n.append(w.n)
            k1.append(int.from_bytes(key[:8], "little", signed=True))
            k2.append(int.from_bytes(key[8:], "little", signed=True))
            sha.append(hashlib.sha256(joined).hexdigest())
            if w.n >= WINDOW:
                grams, at, *_ = w.phrases(w.hash())
                phrases.append(np.unique(grams[at]).view(np.int64))
            else:
                phrases.append(np.zeros(0, np.int64))
        yield pa.record_batch({"id": b.column("id"), "tie": b.column("tie"), "n_words": pa.array(n, pa.int64()),
                               "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "sha": pa.array(sha, pa.string()),
                               "phrases": pa.array(phrases, pa.list_(pa.int64()))})


def _candidate_windows(w: Words, recurring: np.ndarray):
    """Phrase hashes; of the windows whose phrase recurs: start, place of the phrase, and two 64-bit hashes."""
    h = w.hash()
    grams, at, _, windows = w.phrases(h)
    starts = np.flatnonzero(np.repeat(np.isin(grams[at], recurring), windows))
    return grams, starts, np.repeat(at, windows)[starts], rolling(h, WINDOW, _FACTORS[1])[starts], rolling(h, WINDOW, _FACTORS[2])[starts]


def _windows(batches):
    """(id, h1, h2): the distinct candidate windows of each document."""
    for b in batches:
        ids, first, second = [], [], []
        for i, text, recurring in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("phrases"), strict=True):
            *_, h1, h2 = _candidate_windows(Words(text), recurring.values.to_numpy().view(np.uint64))
            _, at = np.unique(h1, return_index=True)
            ids.append(np.full(len(at), i, np.int64))
            first.append(h1[at].view(np.int64))
            second.append(h2[at].view(np.int64))
        if ids:
            yield pa.record_batch({"id": pa.array(np.concatenate(ids)), "h1": pa.array(np.concatenate(first)),
                                   "h2": pa.array(np.concatenate(second))})


def _text(words: list[bytes]) -> str:
    return b" ".join(words).decode()


def _passages(batches):
    """(phrase, home, place of the phrase, words): runs of a home's confirmed windows around one phrase."""
    for b in batches:
        out = []
        for home, text, recurring, confirmed in zip(b.column("id").to_pylist(), b.column("text").to_pylist(),
                                                    b.column("phrases"), b.column("confirmed"), strict=True):
            w = Words(text)
            grams, starts, at, h1, _ = _candidate_windows(w, recurring.values.to_numpy().view(np.uint64))
            _, first = np.unique(h1, return_index=True)  # a window that repeats within its home is needed once
            first = np.sort(first[np.isin(h1[first], confirmed.values.to_numpy().view(np.uint64))])
            own = starts[first]
            place = at[first]
            breaks = np.flatnonzero((np.diff(own) != 1) | (np.diff(place) != 0)) + 1
            for run in np.split(np.arange(len(own)), breaks):
                if len(run):
                    s, e, p = int(own[run[0]]), int(own[run[-1]]) + WINDOW, int(place[run[0]])
                    out.append((int(grams[p].view(np.int64)), home, p - s, _text(w.words[s:e])))
        cols = list(zip(*out, strict=True)) or [()] * 4
        yield pa.record_batch({"phrase": pa.array(cols[0], pa.int64()), "id": pa.array(cols[1], pa.int64()),
                               "place": pa.array(cols[2], pa.int32()), "words": pa.array(cols[3], pa.string())})


def _stretches(batches):
    """(phrase, id, tie, place of the first word, words): the windows of each recurring phrase of a document, as one text."""
    for b in batches:
        out = []
        for i, tie, text, recurring in zip(b.column("id").to_pylist(), b.column("tie").to_pylist(),
                                           b.column("text").to_pylist(), b.column("phrases"), strict=True):
            w = Words(text)
            grams, at, first, windows = w.phrases(w.hash())
            hit = np.isin(grams[at], recurring.values.to_numpy().view(np.uint64))
            for phrase, s, more in zip(grams[at[hit]].view(np.int64).tolist(), first[hit].tolist(), windows[hit].tolist(), strict=True):
                out.append((phrase, i, tie, s, _text(w.words[s:s + more - 1 + WINDOW])))
                if len(out) >= 5000:
                    yield _stretch_rows(out)
                    out = []
        yield _stretch_rows(out)


def _stretch_rows(out) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) or [()] * 5
    return pa.record_batch({"phrase": pa.array(cols[0], pa.int64()), "id": pa.array(cols[1], pa.int64()),
                            "tie": pa.array(cols[2], pa.int64()), "place": pa.array(cols[3], pa.int32()),
                            "words": pa.array(cols[4], pa.string())})


def _begins(words: list[str]) -> list[int]:
    """Where each word of the space-joined text begins, and one place after the text's end."""
    return [0, *accumulate(len(w) + 1 for w in words)]


def _merged(starts: list[int]) -> list[tuple[int, int]]:
    """The word ranges covered by windows at ascending ``starts``."""
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + WINDOW)
        else:
            out.append((s, s + WINDOW))
    return out


def _locate(batches):
    """One shard's rows, passages first: compile the automaton, stream the stretches, emit repeats (id, tie, start, stop).

    The passages' windows are kept by their 128-bit digest with their home, so the
    work on a stretch does not depend on how many passages share its phrase.
    """
    import ahocorasick
    digest = xxhash.xxh3_128_digest
    auto, phrases, homes, shard = None, set(), {}, None
    memory: dict[str, list[tuple[int, int]]] = {}

    def found(words: str) -> list[tuple[int, int]]:
        """(start, home) of the confirmed windows around the phrases that the automaton finds."""
        own, padded, starts = words.split(" "), f" {words} ", set()
        for last, _ in auto.iter(padded):
            i = padded.count(" ", 0, last) - PHRASE  # the phrase ends with the space after its last word
            starts.update(range(max(0, i - _REACH), min(i, len(own) - WINDOW) + 1))
        at = _begins(own)
        keyed = ((s, homes.get(digest(words[at[s]:at[s + WINDOW] - 1]))) for s in sorted(starts))
        return [(s, home) for s, home in keyed if home is not None]

    for b in batches:
        out = []
        for task, kind, key, place, words, tie in zip(*(b.column(c).to_pylist() for c in (
                "task", "kind", "id", "place", "words", "tie")), strict=True):
            if task != shard:
                auto, phrases, homes, shard = None, set(), {}, task
                memory.clear()
            if kind == 0:
                own = words.split(" ")
                at = _begins(own)
                phrases.add(" ".join(own[place:place + PHRASE]))
                for s in range(len(own) - WINDOW + 1):
                    d = digest(words[at[s]:at[s + WINDOW] - 1])
                    homes[d] = min(key, homes.get(d, key))
                continue
            if not phrases:
                continue
            if auto is None:
                auto = ahocorasick.Automaton()
                for phrase in phrases:
                    auto.add_word(f" {phrase} ", 0)
                auto.make_automaton()
            if words not in memory:
                if len(memory) >= 20_000:
                    memory.clear()
                memory[words] = found(words)
            out += [(key, tie, place + s, place + e) for s, e in _merged([s for s, home in memory[words] if home < key])]
        cols = list(zip(*out, strict=True)) or [()] * 4
        yield pa.record_batch({"id": pa.array(cols[0], pa.int64()), "tie": pa.array(cols[1], pa.int64()),
                               "start": pa.array(cols[2], pa.int32()), "stop": pa.array(cols[3], pa.int32())})


def _sharded(passages: DataFrame, stretches: DataFrame) -> DataFrame:
    """Passages and stretches by task. A shard with more than its part of the stretches has several tasks."""
    n = max(8, partitions(passages.sparkSession))
    shard = F.pmod(F.xxhash64("phrase"), F.lit(n)).cast("int")
    by_shard = {r["shard"]: r["n"] for r in stretches.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()}
    part = max(1, sum(by_shard.values()) // n)
    width = [max(1, -(-by_shard.get(k, 0) // (2 * part))) for k in range(n)]
    first = np.concatenate([[0], np.cumsum(width)]).tolist()
    starts, widths = (F.array(*[F.lit(int(x)) for x in v]) for v in (first[:-1], width))
    base, spread = F.element_at(starts, shard + 1), F.element_at(widths, shard + 1)
    own = passages.select(F.explode(F.sequence(base, base + spread - 1)).alias("task"), F.lit(0).alias("kind"), "id", "place", "words",
                          F.lit(0).cast("long").alias("tie"))
    met = stretches.select((base + F.pmod(F.xxhash64("id", "place"), spread).cast("int")).alias("task"), F.lit(1).alias("kind"),
                           "id", "place", "words", "tie")
    return own.unionByName(met).repartitionById(first[-1], F.col("task")).sortWithinPartitions("task", "kind")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tie, text): NULL ids last; tie tells rows of one id apart by their text."""
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scan, candidates, spans): n_words and sha256 of every row; the texts that may hold repeats; what goes.

    ``spans`` has one row per (id, tie): the array of word ranges (start, stop) that are removed.
    """
    rows = _keyed(docs, id_col, text_col)
    scan = stored(map_batches(rows, _scan, "id long, tie long, n_words long, k1 long, k2 long, sha string, phrases array<long>"),
                  "substring-scan")
    long_rows = scan.filter(F.col("n_words") >= WINDOW)
    firsts = stored(long_rows.groupBy("k1", "k2").agg(F.min("id").alias("least")), "substring-firsts")
    flagged = long_rows.join(firsts, ["k1", "k2"])
    copies = flagged.filter("id > least").select("id", "tie", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop"))
    phrases = flagged.filter("id = least").select("id", "tie", F.explode("phrases").alias("phrase"))
    phrases = stored(phrases, "substring-phrases")
    recurring = stored(phrases.groupBy("phrase").agg(F.min("id").alias("a"), F.max("id").alias("b"))
                       .filter("a < b").select("phrase"), "substring-recurring")
    of_doc = phrases.join(recurring, "phrase").groupBy("id", "tie").agg(F.collect_list("phrase").alias("phrases"))
    candidates = stored(rows.join(of_doc, ["id", "tie"]), "substring-candidates")
    windows = map_batches(candidates.select("id", "text", "phrases"), _windows, "id long, h1 long, h2 long")
    confirmed = (windows.groupBy("h1", "h2").agg(F.min("id").alias("home"), F.max("id").alias("other"))
                 .filter("home < other").groupBy(F.col("home").alias("id")).agg(F.collect_list("h1").alias("confirmed")))
    passages = stored(map_batches(candidates.join(stored(confirmed, "substring-confirmed"), "id").select(
        "id", "text", "phrases", "confirmed"), _passages, "phrase long, id long, place int, words string"), "substring-passages")
    known = stored(passages.select("phrase").distinct(), "substring-known")
    wanted = phrases.join(known, "phrase").groupBy("id", "tie").agg(F.collect_list("phrase").alias("phrases"))
    stretches = stored(map_batches(candidates.drop("phrases").join(wanted, ["id", "tie"]), _stretches,
                                   "phrase long, id long, tie long, place int, words string"), "substring-stretches")
    repeats = stored(map_batches(_sharded(passages, stretches), _locate, "id long, tie long, start int, stop int"), "substring-repeats")
    spans = (repeats.unionByName(copies.distinct()).groupBy("id", "tie")
             .agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    return scan, candidates, stored(spans, "substring-spans")


def _kept_words(text: str | None, spans) -> tuple[int, list[bytes]]:
    words = Words(text).words
    gone = np.zeros(len(words) + 1, np.int64)
    for s in spans or ():
        gone[s["start"]] += 1
        gone[s["stop"]] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return len(words), [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def _digest(batches):
    for b in batches:
        rows = [_kept_words(t, s) for t, s in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True)]
        yield pa.record_batch({"id": b.column("id"), "tie": b.column("tie"),
                               "n_removed": pa.array([n - len(k) for n, k in rows], pa.int64()),
                               "kept_sha256": pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for _, k in rows], pa.string())})


def repeat_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row. Only texts that may hold repeats are read again."""
    scan, candidates, spans = find_repeats(docs, id_col, text_col)
    cut = map_batches(candidates.select("id", "tie", "text").join(spans, ["id", "tie"]), _digest,
                      "id long, tie long, n_removed long, kept_sha256 string").distinct()
    whole = spans.join(candidates.select("id", "tie"), ["id", "tie"], "left_anti").select(
        "id", "tie", F.lit(True).alias("copy"))
    removed = stored(cut.withColumn("copy", F.lit(False)).unionByName(whole, allowMissingColumns=True), "substring-removed")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return scan.select("id", "tie", "n_words", "sha").join(removed, ["id", "tie"], "left").select(
        F.when(F.col("id") != _LAST_ID, F.col("id")).alias("doc_id"), "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def _rewritten(text_col: str, spans_col: str):
    def run(batches):
        for b in batches:
            names = b.schema.names
            out = [t if not s else b" ".join(_kept_words(t, s)[1]).decode()
                   for t, s in zip(b.column(names.index(text_col)).to_pylist(), b.column(names.index(spans_col)).to_pylist(), strict=True)]
            cols = [pa.array(out, pa.string()) if n == text_col else b.column(i) for i, n in enumerate(names) if n != spans_col]
            yield pa.record_batch(cols, names=[n for n in names if n != spans_col])
    return run


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs``, all rows and columns, without the repeats: texts that lose words keep the rest, one space apart."""
    *_, spans = find_repeats(docs, id_col, text_col)
    names = {c: f"_{c}" for c in ("id", "tie", "spans")}
    while set(names.values()) & set(docs.columns):
        names = {k: "_" + v for k, v in names.items()}
    keys = [names["id"], names["tie"]]
    met = (docs.withColumn(names["id"], F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)))
           .withColumn(names["tie"], F.xxhash64(F.col(text_col).cast("string")))
           .join(spans.withColumnsRenamed(names), keys, "left").drop(*keys))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    out = map_batches(met, _rewritten(text_col, names["spans"]), fields)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return out


@query("op4_substrings")
def op4_substrings(spark: SparkSession, sf: str) -> DataFrame:
    return repeat_digest(table(spark, sf, "documents"))
