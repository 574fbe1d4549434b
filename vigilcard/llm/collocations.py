"""Phrase collocations, counted in HAT-tries whose subtrees spill as sorted runs.

A phrase of ``2`` to ``longest`` words is a candidate if it occurs ``least`` times in its
language. Each candidate is scored by its worst cut into two parts, floor(2000000 a / (l + r)),
phrases that mostly occur inside one longer candidate are dropped, and the best of each
language are returned.

On Spark, level by level:

1. Texts of one language are cut into words together, as arrays; a word is its 64-bit id.
2. A task counts the n-word phrases of its texts, single words first, in a HAT-trie: hash
   containers under a shallow trie over the half bytes of the keys, which are the word ids. A
   container that grows beyond ``BURST`` entries bursts into a node of smaller ones; its table is
   probed for many keys at once. Keys are led by three bytes of the phrase's hash, so that subtrees
   are even in size even for a prefix that is everywhere, and each range of leading bytes is one
   prefix partition.
3. When the tries of a task hold ``ENTRIES`` entries, whole subtrees leave as sorted runs, the
   largest first, until half of them are gone. Runs are shuffled by language and prefix
   partition and merged there; phrases seen ``least`` times stay.
4. A longer phrase is counted only if both phrases of one word less in it may be frequent, which a
   bitmap of fixed size tells; what else falls on a set bit is counted as well and merged away,
   so the result is exact at any size.
5. Cuts, containment and ranks are joins, groupings and windows over the frequent phrases. Ids
   become words again only for rows that can be among the best, by one more look at the texts.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows
count each; ties are broken by score, then count, then the phrase in byte order; a table without
candidates or an empty one gives an empty result; other columns are ignored. Equal 64-bit ids
stand for equal words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilcard.llm.common import documents as read_documents
from vigilcard.llm.common import mix, span_hashes, stage

LEAST, LONGEST, COVERED, TOP, UNKNOWN = 30, 4, 80, 2000, "und"
#: Entries of a container before it bursts, and of a task's tries before subtrees are spilled.
BURST, ENTRIES = 65_536, 500_000
#: Bytes that lead a key, and the words that one prefix partition stands for on average.
LEAD, PARTITION = 3, 2_000_000
#: Bits of a phrase's hash that address the bitmap of frequent phrases (8 MB).
BITMAP = 26
#: Bytes of text that are cut into words together, and distinct words a task remembers as spelled.
TOGETHER, HELD = 3_000_000, 300_000
#: Bytes that a word and what parts it from the next have at a guess, before words are counted.
WORD_BYTES = 6

_BREAK = b"\xff"  # no byte of UTF-8; stands between pieces
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", _BREAK * 10 + b"abcdefghijklmnopqrstuvwxyz")
_C = np.uint64(0xC2B2AE3D27D4EB4F)


def words_and_breaks(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of texts begin, their sizes and ids, and the bytes that they lie in. Between
    pieces and behind each text there are breaks, whose id is 0."""
    cut = b"\n".join((*texts, b"")).translate(_TABLE).replace(_BREAK, b" \xff ")
    joined = b"".join((b" ", cut, b" " * 9))
    raw = np.frombuffer(joined, np.uint8)
    space = (raw == 0x20) | (raw == 0x09)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, size = edges[0::2], edges[1::2] - edges[0::2]
    ids = np.maximum(span_hashes(joined, start, size), np.uint64(1))
    ids[raw[start] == _BREAK[0]] = 0
    return joined, start, size, ids


def word_id(word: bytes) -> int:
    return int(words_and_breaks([word])[-1][0])


def language_id(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed=1))


def prefix_hashes(ids: np.ndarray, lang: np.uint64, n: int) -> np.ndarray:
    """Hash of the n ids from each position on (as many as fit)."""
    found = mix(ids ^ lang)
    for k in range(1, n):
        found = mix(found[:-1] * _C + ids[k:])
    return found


def is_marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITMAP)
    return bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1) == 1


def sorted_order(keys: np.ndarray) -> np.ndarray:
    """The order of keys by their bytes: by the first eight, then by all where those leave it open."""
    head = _eight(keys, 0)
    order = np.argsort(head, kind="stable")  # a merge sort that takes sorted runs as they are
    head = head[order]
    same = head[1:] == head[:-1]
    among = np.flatnonzero(same)
    open_ = among[keys[order[among]] != keys[order[among + 1]]]
    if len(open_):
        group = np.concatenate(([0], np.cumsum(~same)))
        at = np.flatnonzero(np.isin(group, group[open_]))
        order[at] = order[at][np.argsort(keys[order[at]], kind="stable")]
    return order


def _eight(keys: np.ndarray, at: int) -> np.ndarray:
    """Eight bytes of each key from one on, as numbers; behind a key there are zeros."""
    raw = keys.view(np.uint8).reshape(len(keys), keys.itemsize)[:, at : at + 8]
    out = np.zeros((len(keys), 8), np.uint8)
    out[:, : raw.shape[1]] = raw
    return out.view(">u8").ravel().astype(np.uint64)


class Container:
    """A hash table of keys of one length and their counts, probed for many keys at once."""

    def __init__(self, width: int, room: int = 8) -> None:
        self.size = 0
        self.keys, self.counts = np.empty(room, f"S{width}"), np.empty(room, np.int64)
        self.table = np.full(2 * room, -1, np.int32)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        if self.size + len(keys) > len(self.keys):
            held, n = self.entries()
            self.__init__(keys.itemsize, 1 << (self.size + len(keys)).bit_length())
            self.add(held, n)
        mask = len(self.table) - 1
        slot = mix(_eight(keys, 0) * _C + _eight(keys, max(0, keys.itemsize - 8))).astype(np.int64) & mask
        left = np.arange(len(keys))
        while len(left):
            here = slot[left]
            at = self.table[here]
            free = at < 0
            taken, at = left[~free], at[~free]
            same = self.keys[at] == keys[taken]
            np.add.at(self.counts, at[same], counts[taken[same]])
            on = taken[~same]
            slot[on] = slot[on] + 1 & mask
            # Of the keys that meet in a free slot the last one gets it; the others look there again.
            left, here = left[free], here[free]
            self.table[here] = left
            won = self.table[here] == left
            new = left[won]
            end = self.size + len(new)
            self.table[here[won]] = np.arange(self.size, end)
            self.keys[self.size : end], self.counts[self.size : end] = keys[new], counts[new]
            self.size = end
            left = np.concatenate((left[~won], on))

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        return self.keys[: self.size], self.counts[: self.size]


class HatTrie:
    """Counts of keys of one length: a trie over half bytes with hash containers as leaves."""

    def __init__(self, burst: int = BURST) -> None:
        self.burst = burst
        self.slots: list = [None] * 16

    @property
    def size(self) -> int:
        return sum(held.size for held in _containers(self.slots))

    def add(self, keys: np.ndarray | list[bytes], counts: np.ndarray | list[int]) -> None:
        if len(keys):
            keys = keys if isinstance(keys, np.ndarray) else np.array(keys, f"S{len(keys[0])}")
            self._add(self.slots, 0, keys, np.asarray(counts, np.int64))

    def _add(self, slots: list, depth: int, keys: np.ndarray, counts: np.ndarray) -> None:
        """Deals keys out to the children of a node by their half byte at ``depth``."""
        byte = keys.view(np.uint8).reshape(len(keys), keys.itemsize)[:, depth // 2]
        half = byte & 15 if depth % 2 else byte >> 4
        order = np.argsort(half, kind="stable")
        ends = np.searchsorted(half[order], np.arange(17))
        last = depth + 1 == 2 * keys.itemsize
        for k in np.flatnonzero(np.diff(ends)).tolist():
            own = order[ends[k] : ends[k + 1]]
            if slots[k] is None:
                slots[k] = [None] * 16 if len(own) > self.burst and not last else Container(keys.itemsize)
            if isinstance(slots[k], list):
                self._add(slots[k], depth + 1, keys[own], counts[own])
                continue
            slots[k].add(keys[own], counts[own])
            if slots[k].size > self.burst and not last:
                held, slots[k] = slots[k], [None] * 16
                self._add(slots[k], depth + 1, *held.entries())

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes out whole subtrees below the root, the largest first, until ``keep`` entries are
        left; each comes as a sorted run of keys, one per row of bytes, and counts."""
        sizes = {k: sum(held.size for held in _containers(child)) for k, child in enumerate(self.slots) if child is not None}
        left = sum(sizes.values())
        for k in sorted(sizes, key=lambda k: -sizes[k]):
            if left <= keep:
                return
            keys, counts = map(np.concatenate, zip(*(held.entries() for held in _containers(self.slots[k])), strict=True))
            self.slots[k] = None
            left -= len(keys)
            order = sorted_order(keys)
            yield keys[order].view(np.uint8).reshape(len(keys), keys.itemsize), counts[order]


def _containers(child) -> Iterator[Container]:
    if isinstance(child, Container):
        yield child
    elif child is not None:
        for below in child:
            yield from _containers(below)


def phrase_keys(ids: np.ndarray, lang: np.uint64, n: int, bitmap: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the n-word phrases that may be frequent in a run of word ids; single
    words all may."""
    if n == 1:
        at = np.flatnonzero(ids)
        hashes = mix(ids[at] ^ lang)
    else:
        shorter = prefix_hashes(ids, lang, n - 1) if len(ids) >= n else ids[:0]
        may = is_marked(bitmap, shorter)
        for k in range(n - 1):
            may &= ids[k : k + len(may)] != 0
        at = np.flatnonzero(may[:-1] & may[1:])
        hashes = mix(shorter[at] * _C + ids[at + n - 1])
    order = np.argsort(hashes)
    at, hashes = at[order], hashes[order]
    new = np.ones(len(at), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    for k in range(n):
        word = ids[at + k]
        new[1:] |= word[1:] != word[:-1]
    first = np.flatnonzero(new)
    packed = np.empty((len(first), LEAD + 8 * n), np.uint8)
    lead = (hashes[first] >> np.uint64(64 - 8 * LEAD)).astype(">u4")
    packed[:, :LEAD] = lead.view(np.uint8).reshape(-1, 4)[:, 4 - LEAD :]
    for k in range(n):
        packed[:, LEAD + 8 * k : LEAD + 8 * k + 8] = ids[at[first] + k].astype(">u8").view(np.uint8).reshape(-1, 8)
    return packed.view(f"S{LEAD + 8 * n}").ravel(), np.diff(np.append(first, len(at)))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")


def _gathered(batches) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, ``TOGETHER`` bytes at a time."""
    held: dict[str, list[bytes]] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()), strict=True):
            held.setdefault(lang, []).append(text.as_py() or b"")
            total += len(held[lang][-1]) + 1
            if total >= TOGETHER:
                yield from held.items()
                held, total = {}, 0
    yield from held.items()


def spelled_words(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """lang, id, word of all words whose slots are among those of ``wanted``."""
    sent = documents.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def run(batches):
        known: dict[str, np.ndarray] = {}
        for lang, texts in _gathered(batches):
            joined, start, size, ids = words_and_breaks(texts)
            at = np.flatnonzero((ids != 0) & is_marked(sent.value, mix(ids ^ language_id(lang))))
            own, first = np.unique(ids[at], return_index=True)
            before = known.get(lang, own[:0])
            new = ~np.isin(own, before)
            known[lang] = np.concatenate((before[: max(0, HELD - len(own))], own[new]))
            spans = zip(start[at[first[new]]].tolist(), size[at[first[new]]].tolist(), strict=True)
            words = pa.array([joined[a : a + n] for a, n in spans], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(own[new].view(np.int64)), words], names=["lang", "id", "word"])

    found = _texts(documents).mapInArrow(run, "lang string, id long, word string")
    return found.groupBy("lang", "id").agg(F.min("word").alias("word"))


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """Bits at the slots of frequent phrases; at most 2048 slices of 4 KB reach the driver."""
    slices = frequent.groupBy(F.expr("slot DIV 32768").alias("k")).agg(
        F.bitmap_construct_agg(F.expr("slot % 32768")).alias("bits"))
    found = np.zeros((2 ** (BITMAP - 15), 4096), np.uint8)
    for row in slices.collect():
        found[row["k"]] = np.frombuffer(row["bits"], np.uint8)
    return found.ravel()


def count_phrases(documents: DataFrame, n: int, least: int, bitmap: np.ndarray | None, words: int) -> DataFrame:
    """Frequent n-word phrases: lang, ids, f, slot. ``words`` is the size of the corpus. Beside
    single words a row without ids has the count of all words of the language."""
    sent = documents.sparkSession.sparkContext.broadcast(bitmap)
    bits = min(8 * LEAD, max(4, math.ceil(math.log2(words / PARTITION + 1))))
    width = LEAD + 8 * n

    def row(lang: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """A sorted run, cut where prefix partitions end."""
        lead = keys[:, :LEAD].astype(np.int64) @ (256 ** np.arange(LEAD - 1, -1, -1))
        part = lead >> (8 * LEAD - bits)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(counts)]
        pairs = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(pairs), pa.string()), pa.array([int(part[a]) for a, _ in pairs], pa.int32()),
             pa.array([keys[a:b].tobytes() for a, b in pairs], pa.binary()),
             pa.array([counts[a:b].tobytes() for a, b in pairs], pa.binary())], names=["lang", "part", "keys", "counts"])

    def spill(batches):
        tries: dict[str, HatTrie] = {}
        sizes: dict[str, int] = {}
        held = 0
        for lang, texts in _gathered(batches):
            ids = words_and_breaks(texts)[-1]
            sizes[lang] = sizes.get(lang, 0) + np.count_nonzero(ids)
            trie = tries.setdefault(lang, HatTrie())
            before = trie.size
            trie.add(*phrase_keys(ids, language_id(lang), n, sent.value))
            held += trie.size - before
            if held > ENTRIES:
                for name, trie in tries.items():
                    yield from (row(name, *run) for run in trie.spill(trie.size // 2))
                held = sum(trie.size for trie in tries.values())
        for name, trie in tries.items():
            yield from (row(name, *run) for run in trie.spill(0))
        if n == 1:
            for name, size in sizes.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name], pa.string()), pa.array([-1], pa.int32()), pa.array([b""]), pa.array([np.int64(size).tobytes()])],
                    names=["lang", "part", "keys", "counts"])

    def merge(table: pa.Table) -> pa.Table:
        lang = table["lang"][0].as_py()
        counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.int64)
        if table["part"][0].as_py() < 0:
            return pa.table({
                "lang": pa.array([lang], pa.string()), "ids": pa.array([[]], pa.list_(pa.int64())),
                "f": pa.array([counts.sum()], pa.int64()), "slot": pa.array([None], pa.int64())})
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), f"S{width}")
        order = sorted_order(keys)
        keys = keys[order]
        raw = keys.view(np.uint8).reshape(-1, width)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        total = np.add.reduceat(counts[order], first)
        kept = total >= least
        words = raw[first[kept]][:, LEAD:].copy().view(">u8").astype(np.uint64)
        hashes = mix(words[:, 0] ^ language_id(lang))
        for k in range(1, n):
            hashes = mix(hashes * _C + words[:, k])
        return pa.table({
            "lang": pa.array([lang] * len(words), pa.string()),
            "ids": pa.array(words.view(np.int64).tolist(), pa.list_(pa.int64())),
            "f": pa.array(total[kept], pa.int64()),
            "slot": pa.array((hashes >> np.uint64(64 - BITMAP)).astype(np.int64))})

    runs = _texts(documents).mapInArrow(spill, "lang string, part int, keys binary, counts binary")
    return runs.groupBy("lang", "part").applyInArrow(merge, "lang string, ids array<long>, f long, slot long")


def scored_candidates(frequent: DataFrame, covered: int) -> DataFrame:
    """Candidates that no longer one covers: lang, ids, a, l, r, score, from all frequent phrases."""
    parts = frequent.select("lang", "ids", "f")
    long = parts.where("size(ids) >= 2").withColumnRenamed("f", "a")
    cuts = long.withColumn("k", F.explode(F.expr("sequence(1, size(ids) - 1)")))
    cuts = cuts.selectExpr("*", "slice(ids, 1, k) AS head", "slice(ids, k + 1, size(ids)) AS tail")
    cuts = cuts.join(parts.select("lang", F.col("ids").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("ids").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    # Decimals of 38 digits: a product may pass 64 bits, the quotient is at most a million.
    score = "CAST((CAST(a AS DECIMAL(20, 0)) * 2000000) DIV (CAST(l AS DECIMAL(20, 0)) + r) AS LONG) AS score"
    cuts = cuts.selectExpr("lang", "ids", "a", "k", "l", "r", score)
    worst = cuts.groupBy("lang", "ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = long.where("size(ids) >= 3").withColumn("width", F.explode(F.expr("sequence(2, size(ids) - 1)")))
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, size(ids) - width + 1)")))
    inner = inner.selectExpr("lang", "slice(ids, at, width) AS ids", "a").groupBy("lang", "ids").agg(F.max("a").alias("longer"))
    rest = worst.join(inner, ["lang", "ids"], "left").where(
        f"longer IS NULL OR CAST(longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * {int(covered)}")
    return rest.select("lang", "ids", "a", "cut.l", "cut.r", "cut.score")


def mine(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    words = stage(count_phrases(documents, 1, least, None, size // WORD_BYTES), "collocation-1")
    sizes = words.where("size(ids) = 0").select("lang", F.col("f").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    level = frequent = words.where("size(ids) = 1")
    one = level.select("lang", F.col("ids")[0].alias("id"), "slot")
    for n in range(2, longest + 1):
        level = stage(count_phrases(documents, n, least, _bitmap(level), total), f"collocation-{n}")
        frequent = frequent.unionByName(level)
    found = stage(scored_candidates(frequent, covered), "collocation-scores")
    near = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    best = stage(found.withColumn("near", near).where(F.col("near") <= top).drop("near"), "collocation-best")
    spelled = best.select("*", F.posexplode("ids").alias("at", "id"))
    wanted = one.join(spelled.select("lang", "id").distinct(), ["lang", "id"], "left_semi")
    spelled = spelled.join(spelled_words(documents, wanted), ["lang", "id"])
    spelled = spelled.groupBy("lang", "ids", "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = spelled.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: phrases of two to four words seen 30 times, the best 2000 of each language."""
    return mine(read_documents(spark, sf_dir))


ORACLE = rf"""
WITH cut AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0
), runs AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS p FROM placed, range(1, {LONGEST + 1}) lengths(k) WHERE i + k - 1 <= len(w)
), counted AS (
  SELECT lang, p AS phrase, string_split(p, ' ') AS w, f FROM (SELECT lang, p, count(*) AS f FROM runs GROUP BY lang, p HAVING count(*) >= {LEAST})
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), halves AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail
  FROM counted JOIN range(1, {LONGEST}) ks(k) ON k < len(w)
), cuts AS (
  SELECT h.lang, h.phrase, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
  FROM halves h JOIN counted x ON x.lang = h.lang AND x.phrase = h.head JOIN counted y ON y.lang = h.lang AND y.phrase = h.tail
), worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, f, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM counted, range(2, {LONGEST}) sizes_(s), range(1, {LONGEST}) starts(i) WHERE s < len(w) AND i + s - 1 <= len(w)
), longer AS (
  SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY lang, phrase
), kept AS (
  SELECT w.* FROM worst w LEFT JOIN longer y USING (lang, phrase) WHERE coalesce(100::HUGEINT * y.f < {COVERED}::HUGEINT * w.a, true)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""
