"""Operator 11: phrase collocations by relational mining of sorted occurrence relations (SETM).

A relation holds the occurrences of phrases of one length, sorted by (piece,
position), in segments: a row has one language's run of whole pieces, the
distinct phrases in it with their counts, and for every occurrence its phrase and
its place. Places number the words through; one number is left out between
pieces, so neighbours in a piece, and only they, have consecutive places.
Relations are persisted to the shared folder. For each length:

1. group-count: the counts of a segment's phrases are summed over all segments;
2. semi-join: phrases below the least count lose their occurrences. Segments send the sorted
   hashes of their distinct phrases with their counts, dealt to buckets of hashes, and get back which of
   them reach the least count (equal hashes only let a phrase through, its exact count decides in the end);
3. extend: the merge-join of the remaining occurrences with themselves at
   consecutive places gives the relation of the next length.

A phrase has at most one entry for each segment, however frequent it is, and no piece
leaves its segment, so the merge-join needs no shuffle of occurrences by phrase. The number of
buckets follows the number of words, so a bucket's size does not grow with the corpus.
Counts, products and scores are exact (decimals of 38 digits).

Defined results: NULL or empty text: no words. NULL lang: ``und``. Repeated rows
count again. NULL ids do not matter, ids are not read. Ties: by smaller
first part, then as the contract orders rows. Very long texts: whole, a piece of any length
stays in one segment. Empty table: empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listingmart.llm.common import map_batches, partitions, query, stored, table

#: Words of all languages that a task holds before it closes its largest segment.
OPEN_WORDS = 1 << 21
#: The contract: longest phrase, least count, share in percent at which a longer phrase hides a shorter, rows of a language.
LONGEST, LEAST, HIDES, TOP = 3, 10, 50, 2000

#: Words of the corpus for one bucket of hashes: a bucket holds at most so many entries on average, and mostly far fewer.
BUCKET_WORDS = 1 << 21
#: Groups that rank their first phrases before a language's are ranked.
RANK_GROUPS = 64

#: ``phrases`` are packed texts, the others packed integers, ``places`` as differences.
RELATION = "seg long, lang string, phrases binary, counts binary, codes binary, places binary"
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\xff" * 10)
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _pack(a: np.ndarray) -> bytes:
    """Integers >= 0, compressed byte by byte of their width (first all lowest bytes, ...)."""
    width = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    planes = a.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
    return len(a).to_bytes(8, "little") + bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n, width = int.from_bytes(packed[:8], "little"), packed[8]
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = pa.decompress(packed[9:], n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<i8").reshape(n)


def _pack_texts(texts: list[str]) -> bytes:
    joined = "\n".join(texts).encode()  # a line end ends a piece, so it stands in no phrase
    return len(joined).to_bytes(8, "little") + pa.compress(joined, codec="zstd", asbytes=True)


def _unpack_texts(packed: bytes) -> list[str]:
    n = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], n, codec="zstd", asbytes=True).decode().split("\n") if n else []


def _occurrences(codes: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
    return _unpack(codes), np.cumsum(_unpack(places))


def _relation_rows(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 6
    return pa.record_batch({"seg": pa.array(cols[0], pa.int64()), "lang": pa.array(cols[1], pa.string()),
                            "phrases": pa.array(map(_pack_texts, cols[2]), pa.binary()), "counts": pa.array(map(_pack, cols[3]), pa.binary()),
                            "codes": pa.array(map(_pack, cols[4]), pa.binary()), "places": pa.array(map(_pack, cols[5]), pa.binary())})


class _Open:
    """An open segment of one language."""

    def __init__(self):
        self.codes, self.runs, self.words = defaultdict(count().__next__), [], 0

    def add(self, tokens: list[bytes]) -> int:
        run = np.fromiter(map(self.codes.__getitem__, tokens), np.int64, len(tokens))
        self.runs.append(run)
        self.words += len(run)
        return len(run)

    def row(self, seg: int, lang: str):
        end = self.codes[b"\xff"]
        tokens = np.concatenate(self.runs)
        places = np.flatnonzero(tokens != end)
        if not len(places):
            return None
        used, codes, counts = np.unique(tokens[places], return_inverse=True, return_counts=True)
        words = list(self.codes)
        return (seg, lang, [words[u].decode() for u in used.tolist()], counts, codes, np.diff(places, prepend=0))


def _segments(batches):
    """The relation of single words."""
    part, n, held, open_ = TaskContext.get().partitionId() << 32, 0, 0, {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            # bytes.lower folds A-Z only; 0xff stands in no UTF-8 text and ends a piece
            tokens = ((text or "").encode().lower().translate(_BREAKS) + b"\xff").replace(b"\xff", b" \xff ").split()
            held += open_.setdefault(lang, _Open()).add(tokens)
            if held >= OPEN_WORDS:
                most = max(open_, key=lambda k: open_[k].words)
                held -= open_[most].words
                if row := open_.pop(most).row(part + n, most):
                    n += 1
                    yield _relation_rows([row])
    for lang, segment in open_.items():
        if row := segment.row(part + n, lang):
            n += 1
            yield _relation_rows([row])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _FACTORS[2]
    return h ^ (h >> np.uint64(29))


def _phrase_hashes(lang: str, phrases: list[str]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in phrases), np.uint64, len(phrases))


def _extended(codes: np.ndarray, places: np.ndarray, keep: np.ndarray):
    """Merge-join of the kept occurrences with themselves one place on: (first phrase, second phrase, groups, places, counts)."""
    sel = keep[codes]
    codes, places = codes[sel], places[sel]
    at = np.flatnonzero(np.diff(places) == 1)
    n = np.int64(len(keep))
    groups, inverse, counts = np.unique(codes[at] * n + codes[at + 1], return_inverse=True, return_counts=True)
    return groups // n, groups % n, inverse, places[at], counts


_SENT = "bucket int, seg long, hashes binary, counts binary"
_HASH_BITS = np.uint64(40)


def _dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the items by (bucket, hash), and with it their buckets and 40-bit hashes."""
    bucket = ((hashes >> _HASH_BITS) % np.uint64(buckets)).astype(np.int64)
    rest = (hashes & ((np.uint64(1) << _HASH_BITS) - np.uint64(1))).astype(np.int64)
    order = np.lexsort((rest, bucket))
    return order, bucket[order], rest[order]


def _sent(seg: int, hashes: np.ndarray, counts: np.ndarray, buckets: int, least: int):
    """A segment's entries, a row for each bucket: sorted hashes, and counts up to ``least``."""
    order, bucket, rest = _dealt(hashes, buckets)
    counts = np.minimum(counts[order], least)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else []
    rows = [(int(bucket[a]), _pack(np.diff(rest[a:b], prepend=0)), _pack(counts[a:b])) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    cols = list(zip(*rows, strict=True)) or [()] * 3
    return pa.record_batch({"bucket": pa.array(cols[0], pa.int32()), "seg": pa.array(np.full(len(rows), seg, np.int64)),
                            "hashes": pa.array(cols[1], pa.binary()), "counts": pa.array(cols[2], pa.binary())})


def _send_words(buckets: int, least: int):
    """The distinct words of every segment."""
    def run(batches):
        for b in batches:
            for seg, lang, phrases, counts in zip(*(b.column(c).to_pylist() for c in ("seg", "lang", "phrases", "counts")), strict=True):
                yield _sent(seg, _phrase_hashes(lang, _unpack_texts(phrases)), _unpack(counts), buckets, least)
    return run


def _reaching(least: int):
    """Of each bucket's entries those whose hash reaches ``least`` in all segments: (seg, bucket, ranks in that row)."""
    def found(bucket, held):
        segs, hashes, counts = zip(*held, strict=True)
        sizes = [len(h) for h in hashes]
        _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        reach = np.bincount(inverse, np.concatenate(counts))[inverse] >= least
        ends = np.cumsum(sizes)
        ranks = [np.flatnonzero(reach[e - n:e]) for e, n in zip(ends, sizes, strict=True)]
        kept = [i for i, r in enumerate(ranks) if len(r)]
        return pa.record_batch({"seg": pa.array([segs[i] for i in kept], pa.int64()), "bucket": pa.array([bucket] * len(kept), pa.int32()),
                                "ranks": pa.array([_pack(np.diff(ranks[i], prepend=0)) for i in kept], pa.binary())})

    def run(batches):
        now, held = None, []
        for b in batches:
            for bucket, seg, hashes, counts in zip(*(b.column(c).to_pylist() for c in ("bucket", "seg", "hashes", "counts")), strict=True):
                if bucket != now and held:
                    yield found(now, held)
                    held = []
                now = bucket
                held.append((seg, np.cumsum(_unpack(hashes)), _unpack(counts)))
        if held:
            yield found(now, held)
    return run


def _kept(hashes: np.ndarray, buckets: int, survivors) -> np.ndarray:
    """Which items survive: ``survivors`` holds (bucket, ranks) for each bucket that keeps some."""
    order, bucket, _ = _dealt(hashes, buckets)
    keep = np.zeros(len(hashes), bool)
    for s in survivors:
        keep[order[np.searchsorted(bucket, s["bucket"]) + np.cumsum(_unpack(s["ranks"]))]] = True
    return keep


def _segments_of(batch, buckets: int):
    """Each segment's row: seg, lang, phrases, their hashes, codes, places, which phrases survive, the row's ``longer``."""
    cols = {c: batch.column(c) for c in batch.schema.names}
    for i in range(batch.num_rows):
        row = {c: v[i].as_py() for c, v in cols.items()}
        phrases = _unpack_texts(row["phrases"])
        h = _phrase_hashes(row["lang"], phrases)
        keep = _kept(h, buckets, row["survivors"]) if "survivors" in row else np.ones(len(h), bool)
        yield row["seg"], row["lang"], phrases, h, *_occurrences(row["codes"], row["places"]), keep, row.get("longer")


def _pair_hashes(h: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(h[first] * _FACTORS[0] + h[second] * _FACTORS[1])


def _send_pairs(buckets: int, least: int):
    """The distinct phrases, one word longer, of every segment."""
    def run(batches):
        for b in batches:
            for seg, _, _, h, codes, places, keep, _ in _segments_of(b, buckets):
                first, second, _, _, counts = _extended(codes, places, keep)
                yield _sent(seg, _pair_hashes(h, first, second), counts, buckets, least)
    return run


def _extend(buckets: int):
    """The relation of phrases one word longer: only those that reach the least count (``longer``)."""
    def run(batches):
        for b in batches:
            for seg, lang, phrases, h, codes, places, keep, longer in _segments_of(b, buckets):
                first, second, inverse, at, counts = _extended(codes, places, keep)
                reached = np.flatnonzero(_kept(_pair_hashes(h, first, second), buckets, longer))
                number = np.full(len(first), -1, np.int64)
                number[reached] = np.arange(len(reached))
                sel = number[inverse] >= 0
                texts = [f"{phrases[p]} {phrases[q].rpartition(' ')[2]}" for p, q in zip(first[reached].tolist(), second[reached].tolist(), strict=True)]
                yield _relation_rows([(seg, lang, texts, counts[reached], number[inverse[sel]], np.diff(at[sel], prepend=0))])
    return run


def occurrences(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The relation of single words."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _segments, RELATION)


def reaching(sent: DataFrame, buckets: int, least: int, name: str) -> DataFrame:
    """(seg, name): per segment the entries whose hash is counted ``least`` times or more in all segments."""
    found = map_batches(sent.repartitionById(buckets, "bucket").sortWithinPartitions("bucket"), _reaching(least),
                        "seg long, bucket int, ranks binary")
    return found.groupBy("seg").agg(F.collect_list(F.struct("bucket", "ranks")).alias(name))  # a segment's own entries at most


def _flat(batches):
    """(lang, phrase, f): the distinct phrases of every segment with their counts."""
    for b in batches:
        for lang, packed, counts in zip(*(b.column(c).to_pylist() for c in ("lang", "phrases", "counts")), strict=True):
            phrases, n = _unpack_texts(packed), _unpack(counts)
            for i in range(0, len(phrases), 100_000):
                part = phrases[i:i + 100_000]
                yield pa.record_batch({"lang": pa.array([lang] * len(part), pa.string()), "phrase": pa.array(part, pa.string()),
                                       "f": pa.array(n[i:i + 100_000])})


def group_counts(relation: DataFrame, least: int = 1) -> DataFrame:
    """(lang, phrase, f): exact counts over all segments."""
    flat = map_batches(relation.select("lang", "phrases", "counts"), _flat, "lang string, phrase string, f long")
    return flat.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> list[DataFrame]:
    """For each length from 1 on: (lang, phrase, f); of more than one word only those with f >= ``least``."""
    relation = stored(occurrences(docs, lang_col, text_col), "setm-1")
    found = [stored(group_counts(relation), "setm-counts-1")]
    words = found[0].agg(F.sum("f")).first()[0] or 0
    buckets = max(partitions(docs.sparkSession), -(-words // BUCKET_WORDS))
    sent = map_batches(relation.select("seg", "lang", "phrases", "counts"), _send_words(buckets, least), _SENT)
    # the side with the survivors is the smaller: hashed, so that the segments need no sort
    met = relation.drop("counts").join(stored(reaching(sent, buckets, least, "survivors"), "setm-survivors").hint("shuffle_hash"), "seg")
    for k in range(2, longest + 1):
        longer = reaching(map_batches(met, _send_pairs(buckets, least), _SENT), buckets, least, "longer")
        relation = stored(map_batches(met.join(longer.hint("shuffle_hash"), "seg"), _extend(buckets), RELATION), f"setm-{k}")
        found.append(stored(group_counts(relation, least), f"setm-counts-{k}"))
        met = relation.drop("counts")  # holds survivors only
    return found


def _scored(known: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut: (lang, phrase, words, a, l, r, score)."""
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumns({"first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - words)")}))
    first = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = {c: f"cast({c} as decimal(15, 0))" for c in ("a", "l", "r")}
    score = F.expr(f"({exact['a']} * {exact['a']} * cast(1000000 as decimal(7, 0))) div ({exact['l']} * {exact['r']})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return (cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).groupBy("lang", "phrase", "words", "a").agg(lowest)
            .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"))


def _visible(candidates: DataFrame, hides: int) -> DataFrame:
    """Candidates that no longer one holds with ``hides`` percent of their count or more."""
    inside = F.expr("""flatten(transform(sequence(2, words - 1), n -> transform(sequence(0, words - n),
                       i -> array_join(slice(split(phrase, ' '), i + 1, n), ' '))))""")
    held = (candidates.filter("words > 2").select("lang", F.explode(inside).alias("phrase"), "a")
            .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    return candidates.join(held, ["lang", "phrase"], "left").filter(
        f"longer is null or 100 * longer < {hides} * a").drop("longer")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, hides: int = HIDES, top: int = TOP,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = mine(docs, longest, least, lang_col, text_col)
    known = counts[0].filter(F.col("f") >= least).withColumn("words", F.lit(1))
    for k, c in enumerate(counts[1:], 2):
        known = known.unionByName(c.withColumn("words", F.lit(k)))
    candidates = known.filter("words > 1").withColumnRenamed("f", "a")
    scored = _scored(known.drop("words"), _visible(candidates, hides))
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    firsts = scored.withColumn("rank", F.row_number().over(W.partitionBy("lang", group).orderBy(*by))).filter(F.col("rank") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= top)
    total = counts[0].groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM lists, (VALUES (1), (2), (3)) t(k))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING k = 1 OR count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
held AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE words = 3) GROUP BY ALL),
seen AS (SELECT c.* FROM c LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
cuts AS (
  SELECT s.lang, s.phrase, s.a, k.k, l.f AS l, r.f AS r,
    CAST(1000000 * s.a::HUGEINT * s.a::HUGEINT // (l.f::HUGEINT * r.f::HUGEINT) AS BIGINT) AS score
  FROM seen s JOIN (VALUES (1), (2)) k(k) ON k.k < s.words
  JOIN f l ON l.lang = s.lang AND l.k = k.k AND l.phrase = array_to_string(s.w[1:k.k], ' ')
  JOIN f r ON r.lang = s.lang AND r.k = s.words - k.k AND r.phrase = array_to_string(s.w[k.k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op11_collocations", SQL)
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))
