"""Phrases that occur together more often than their parts explain, counted in burst tries.

Texts are lower-cased (A to Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at spaces and tabs into words.
Per language, a phrase of two to ``WORDS`` words is a candidate when it occurs ``least`` times or more. Cutting it in two
gives a score; the lowest-scoring cut counts.

* **Tokens.** Texts are read once and written as slices of words and word numbers, with the slice's own word list.
* **Levels.** Which phrases may reach ``least`` is found first, length by length. Phrases of k words are looked at only where their first and last
  k - 1 words may reach it. Tasks turn them into sorted runs of 48-bit hashes with counts, which are merged per range of hashes; what
  reaches ``least`` sets a bit in a map of at most ``MOST_BITS`` bits. Clashes only let phrases through that need not be counted.
* **Tries.** One more reading counts the phrases of all lengths that the maps let through, exactly, in a trie over word numbers: the first word
  leads to a container, a hash table from the rest of the phrase to its count. A container that grows over ``BURST`` entries bursts into one per
  next word, down to ``DEPTH`` words. When a task holds ``MOST_ENTRIES``, its largest subtrees leave as sorted runs until half is
  free, and the same words may come again.
* **Merging.** Runs are dealt by language and first two words, sorted, and the counts of equal phrases added. A
  frequent word is the prefix of many different pairs, so it is spread over tasks.

Defined results for odd rows: a NULL or empty text has no words; a NULL language is ``und``; repeated rows count as often as they occur,
whatever their ids; equal scores go to the higher count, then to the phrase that is first in byte order; an empty table gives no rows.
Columns of the input besides the two named ones are left aside, so their names do not matter. Counts may reach 10^18.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import materialise

WORDS, LEAST, TOP = 5, 100, 2000
SLICE_BYTES = 400_000
#: Bits of the map of frequent phrases: about so many for each, and at most so many (32 MB).
BITS_EACH, MOST_BITS = 32, 1 << 28
BURST, DEPTH, MOST_ENTRIES = 4096, 2, 500_000
#: Hashes a task holds before they leave as runs, and those merged in one range.
HELD_HASHES, RANGE_HASHES = 1 << 20, 2 << 20
#: Bytes of a hash.
HASH_BYTES = 6
#: Rows of a language are ranked in so many parts first.
RANK_PARTS = 256

BREAK = b"."
_TABLE = bytes(ord(BREAK) if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, with :data:`BREAK` between pieces."""
    return text.translate(_TABLE).replace(BREAK, b" . ").split(b" ")


class _Numbers(dict):
    """A new number for every new word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def slices(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between words."""
    at = 0
    while at < len(text):
        end = at + SLICE_BYTES
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c.,;:!?":
            end += 1
        yield text[at:end]
        at = end


_TOKENS = "lang string, n bigint, words binary, hashes binary, tokens binary, carried int"


def tokenise(docs: DataFrame, text: str = "text", lang: str = "lang", words: int = WORDS) -> DataFrame:
    """Slices of texts of one language: the slice's words (joined by spaces) and their hashes, ``n`` words in all, and the word numbers in order (the number after the last one between
    pieces and texts; two bytes each where they suffice).

    The first ``carried`` numbers repeat the end of the slice before, so that phrases across the cut are seen once.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[str, tuple[list[bytes], int]] = {}
            for t, g in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                body = t.as_py()
                if len(body) > SLICE_BYTES:
                    before: list[bytes] = []
                    for part in slices(body):
                        here = words_of(part)
                        yield _slice(g, before + here, len(before))
                        before = [w for w in before + here[-4 * words:] if w][1 - words:] if words > 1 else []
                    continue
                parts, size = held.get(g, ([], 0))
                parts.append(body)
                held[g] = parts, size + len(body)
                if size + len(body) >= SLICE_BYTES:
                    yield _slice(g, words_of(b".".join(held.pop(g)[0])), 0)
            for g, (parts, _) in held.items():
                yield _slice(g, words_of(b".".join(parts)), 0)

    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(body.alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang")).mapInArrow(each, _TOKENS)


def _slice(lang: str, found: list[bytes], carried: int) -> pa.RecordBatch:
    numbers = _Numbers({b"": 0, BREAK: 1})
    ids = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
    words = list(numbers)[2:]
    kept = ids[ids != 0] - 2
    kept[kept < 0] = len(words)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], "<u8")
    return pa.RecordBatch.from_arrays(
        [pa.array([lang]), pa.array([int((kept[carried:] < len(words)).sum())], pa.int64()),
         *(pa.array([x], pa.binary()) for x in (b" ".join(words), hashes.tobytes(), kept.astype("<u2" if len(words) < 1 << 16 else "<u4").tobytes())),
         pa.array([carried], pa.int32())],
        names=["lang", "n", "words", "hashes", "tokens", "carried"])


# ---- counting -----------------------------------------------------------------------------------------------------


class BurstTrie:
    """Counts of phrases of word numbers; the rest of a phrase after its first words is a bytes key of 4-byte numbers."""

    def __init__(self, burst: int = BURST, depth: int = DEPTH) -> None:
        self.root: dict[int, dict] = {}
        self.sizes: dict[int, int] = {}
        self.entries = 0
        self.burst, self.depth = burst, depth

    def add(self, first: int, rests: list[bytes], counts: list[int]) -> None:
        """Add phrases that begin with ``first``."""
        node = self.root.get(first)
        if node is None:
            node = self.root[first] = {}
        new = self._into(node, rests, counts, 1)
        self.sizes[first] = self.sizes.get(first, 0) + new
        self.entries += new
        if len(node) > self.burst and self.depth > 1 and None not in node:
            self.root[first] = self._split(node)

    def _into(self, node: dict, rests: list[bytes], counts: list[int], depth: int) -> int:
        if None not in node:  # a container
            before = len(node)
            get = node.get
            for r, n in zip(rests, counts):
                node[r] = get(r, 0) + n
            return len(node) - before
        new = 0
        for r, n in zip(rests, counts):
            child = node.get(r[:4])
            if child is None:
                child = node[r[:4]] = {}
            new += self._into(child, [r[4:]], [n], depth + 1)
            if depth + 1 < self.depth and len(child) > self.burst and None not in child:
                node[r[:4]] = self._split(child)
        return new

    def _split(self, container: dict) -> dict:
        """A burst container: one container per next word. The key ``None`` marks an inner node."""
        node: dict = {None: None}
        for r, n in container.items():
            child = node.get(r[:4])
            if child is None:
                child = node[r[:4]] = {}
            child[r[4:]] = n
        return node

    def _entries(self, node: dict, prefix: bytes) -> Iterator[tuple[bytes, int]]:
        if None in node:
            for key, child in node.items():
                if key is not None:
                    yield from self._entries(child, prefix + key)
        else:
            for r, n in node.items():
                yield prefix + r, n

    def spill(self, keep: int) -> Iterator[tuple[int, list[bytes], list[int]]]:
        """Take out whole subtrees, the largest first, until ``keep`` entries or fewer are left."""
        for size, first in sorted(((s, f) for f, s in self.sizes.items()), reverse=True):
            if self.entries <= keep and keep:
                return
            rests, counts = [], []
            for r, n in self._entries(self.root.pop(first), b""):
                rests.append(r)
                counts.append(n)
            del self.sizes[first]
            self.entries -= size
            yield first, rests, counts


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def phrase_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from every place on, of ``HASH_BYTES`` bytes."""
    n = max(0, len(word_hashes) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = _mix((h + word_hashes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15))
    return h >> np.uint64(64 - 8 * HASH_BYTES)


def _grouped(rows: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows and how often each occurs; rows of one code are compared, so a clash of codes cannot add up counts."""
    order = np.argsort(code, kind="stable")
    rows, code = rows[order], code[order]
    new = np.ones(len(rows), bool)
    new[1:] = code[1:] != code[:-1]
    if (rows[1:][~new[1:]] != rows[:-1][~new[1:]]).any():
        return np.unique(rows, axis=0, return_counts=True)
    first = np.flatnonzero(new)
    return rows[first], np.diff(np.append(first, len(rows)))


def seed_of(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def _is_set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (bits[(h >> np.uint64(3)) % np.uint64(len(bits))] >> (h & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _slice_hashes(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Word numbers of a slice (-1 between pieces), the hash of each (with its language), and how many were carried over."""
    hashes = np.frombuffer(b.column("hashes")[i].as_py(), "<u8")
    numbers = np.frombuffer(b.column("tokens")[i].as_py(), "<u2" if len(hashes) < 1 << 16 else "<u4").astype(np.int32)
    word = np.append(hashes, np.uint64(0))[numbers] + seed_of(b.column("lang")[i].as_py())
    numbers[numbers == len(hashes)] = -1
    return numbers, word, b.column("carried")[i].as_py()


def _whole(numbers: np.ndarray, k: int, carried: int) -> np.ndarray:
    """Places where k words follow each other in a piece and not all of them were seen with the slice before."""
    ok = np.ones(max(0, len(numbers) - k + 1), bool)
    for i in range(k):
        ok &= numbers[i:i + len(ok)] >= 0
    ok[:max(0, carried - k + 1)] = False
    return ok


def _added(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes in order and the sums of their counts."""
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(n, first) if len(h) else n


_WIDE = 0xFFFFFFFF


def _packed(h: np.ndarray) -> bytes:
    """Hashes in order as their steps: four bytes each, and eight more for the few steps that need them."""
    step = np.diff(h, prepend=np.uint64(0))
    wide = step >= _WIDE
    return np.array([len(h)], "<u4").tobytes() + np.where(wide, np.uint64(_WIDE), step).astype("<u4").tobytes() + step[wide].astype("<u8").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    step = np.frombuffer(data, "<u4", n, 4).astype(np.uint64)
    step[step == _WIDE] = np.frombuffer(data, "<u8", offset=4 + 4 * n)
    return np.cumsum(step, dtype=np.uint64)


def hash_runs(tokens: DataFrame, k: int, bits: np.ndarray | None, ranges: int) -> DataFrame:
    """``range, hashes, counts``: sorted runs of hashes of phrases of k words whose first and last k - 1 words the map lets through."""
    shared = tokens.sparkSession.sparkContext.broadcast(bits)
    edges = np.array([(r << 8 * HASH_BYTES) // ranges for r in range(1, ranges)], np.uint64)

    def runs(h: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = [0, *np.searchsorted(h, edges).tolist(), len(h)]
        full = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([_packed(h[cuts[r]:cuts[r + 1]]) for r in full], pa.binary()),
             pa.array([n[cuts[r]:cuts[r + 1]].astype("<u4").tobytes() for r in full], pa.binary())], names=["range", "hashes", "counts"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        new: list[np.ndarray] = []
        for b in batches:
            for i in range(b.num_rows):
                numbers, word, carried = _slice_hashes(b, i)
                ok = _whole(numbers, k, carried)
                if k > 1 and len(ok):
                    known = _is_set(shared.value, phrase_hashes(word, k - 1))
                    ok &= known[:-1] & known[1:]
                new.append(phrase_hashes(word, k)[ok])
                if sum(map(len, new)) + len(kept) > HELD_HASHES:
                    h = np.concatenate(new)
                    kept, counts = _added(np.concatenate([kept, h]), np.concatenate([counts, np.ones(len(h), np.int64)]))
                    new = []
                    if len(kept) > HELD_HASHES // 2:
                        yield from runs(kept, counts)
                        kept, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        h = np.concatenate([kept, *new])
        yield from runs(*_added(h, np.concatenate([counts, np.ones(len(h) - len(kept), np.int64)])))

    return tokens.select("lang", "hashes", "tokens", "carried").mapInArrow(each, "range int, hashes binary, counts binary")


def frequent_hashes(runs: DataFrame, least: int) -> DataFrame:
    """``h``: hashes whose counts in all runs of their range add up to ``least`` or more."""
    def merge(t: pa.Table) -> pa.Table:
        h = np.concatenate([_unpacked(x) for x in t.column("hashes").to_pylist()])
        h, n = _added(h, np.frombuffer(b"".join(t.column("counts").to_pylist()), "<u4").astype(np.int64))
        return pa.table([pa.array(h[n >= least].view(np.int64))], names=["h"])

    return runs.groupBy("range").applyInArrow(merge, "h bigint")


def bit_map(hashes: DataFrame) -> np.ndarray:
    """Bits of hashes ``h``. At most ``MOST_BITS`` bits reach the driver, however many there are."""
    size = min(MOST_BITS, 1 << max(10, int(hashes.count() * BITS_EACH).bit_length())) // 8

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column("h").to_numpy().view(np.uint64)
            place, bit = (h >> np.uint64(3)) % np.uint64(size), np.left_shift(1, (h & np.uint64(7)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(bit)], names=["place", "bits"])

    bits = np.zeros(size, np.uint8)
    found = hashes.mapInArrow(each, "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits[found.column("place").to_numpy()] = found.column("bits").to_numpy()
    return bits


_RUNS = "lang string, prefix bigint, phrase binary, words int, n bigint"


def count_phrases(tokens: DataFrame, maps: list[np.ndarray]) -> DataFrame:
    """``lang, prefix, phrase, words, n``: sorted runs of counts of phrases that the maps (one per length) let through."""
    shared = tokens.sparkSession.sparkContext.broadcast(maps)
    return tokens.select("lang", "words", "hashes", "tokens", "carried").mapInArrow(lambda batches: counted(batches, shared.value), _RUNS)


class _Counter:
    """The trie of one language in a task, its word numbers, and phrases not yet in it (rows of word numbers, by length)."""

    def __init__(self) -> None:
        self.trie, self.names = BurstTrie(), _Numbers()
        self.waiting: dict[int, list[np.ndarray]] = {}
        self.held = 0

    def take(self, numbers: np.ndarray, word: np.ndarray, carried: int, words: list[bytes], maps: list[np.ndarray]) -> None:
        own = np.full(len(words) + 1, -1, np.int32)
        for k, bits in enumerate(maps, 1):
            at = np.flatnonzero(_whole(numbers, k, carried if k > 1 else 0) & _is_set(bits, phrase_hashes(word, k)))
            if k == 1:  # all words of phrases that are let through, those carried over too
                used = np.unique(numbers[at])
                own[used] = [self.names[words[i]] for i in used.tolist()]
                at = at[at >= carried]
            rows = np.stack([own[numbers[at + j]] for j in range(k)], axis=1)
            rows = rows[(rows >= 0).all(axis=1)]  # a phrase with a word that is not let through cannot be frequent
            if len(rows):
                self.waiting.setdefault(k, []).append(rows)
                self.held += len(rows)

    def flush(self) -> None:
        """Add up the waiting phrases, then put each different one into the trie."""
        for parts in self.waiting.values():
            rows = np.concatenate(parts)
            rows, counts = _grouped(rows, phrase_hashes_of(rows))
            order = np.argsort(rows[:, 0], kind="stable")
            rows, counts = rows[order], counts[order].tolist()
            data, width = np.ascontiguousarray(rows[:, 1:]).tobytes(), 4 * (rows.shape[1] - 1)
            rests = [data[i:i + width] for i in range(0, len(data), width)] if width else [b""] * len(rows)
            edges = np.append(np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0])), len(rows)).tolist()
            first = rows[:, 0].tolist()
            for a, b in zip(edges, edges[1:]):
                self.trie.add(first[a], rests[a:b], counts[a:b])
        self.waiting, self.held = {}, 0


def phrase_hashes_of(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        h = _mix((h + column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    return h


def counted(batches: Iterator[pa.RecordBatch], maps: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Runs of one task."""
    of: dict[str, _Counter] = {}
    for b in batches:
        for i in range(b.num_rows):
            lang = b.column("lang")[i].as_py()
            here = of.setdefault(lang, _Counter())
            here.take(*_slice_hashes(b, i), b.column("words")[i].as_py().split(b" "), maps)
            if sum(c.held for c in of.values()) > HELD_HASHES:
                for c in of.values():
                    c.flush()
                if sum(c.trie.entries for c in of.values()) > MOST_ENTRIES:
                    for g, c in list(of.items()):
                        drop = len(c.names) > MOST_ENTRIES  # names of words no longer needed
                        yield from _run(g, c.trie, list(c.names), 0 if drop else c.trie.entries // 2)
                        if drop:
                            of[g] = _Counter()
    for g, c in of.items():
        c.flush()
        yield from _run(g, c.trie, list(c.names), 0)


def _run(lang: str, trie: BurstTrie, names: list[bytes], keep: int) -> Iterator[pa.RecordBatch]:
    """Subtrees that leave the trie, as sorted rows."""
    out: list[tuple[bytes, int, int, int]] = []

    def rows():
        found = sorted(out)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[0] for x in found], pa.binary()),
             pa.array([x[2] for x in found], pa.int32()), pa.array([x[3] for x in found], pa.int64())],
            names=["lang", "prefix", "phrase", "words", "n"])

    for first, rests, counts in trie.spill(keep):
        head, prefixes = names[first], {}
        words = [names[i] for i in np.frombuffer(b"".join(rests), np.int32).tolist()]
        at = 0
        for rest, n in zip(rests, counts):
            more = len(rest) >> 2
            tail = words[at:at + more]
            at += more
            prefix = prefixes.get(rest[:4])
            if prefix is None:
                prefix = prefixes[rest[:4]] = xxhash.xxh64_intdigest(b" ".join([head, *tail[:1]])) >> 1
            out.append((b" ".join([head, *tail]), prefix, more + 1, n))
        if len(out) > 20_000:
            yield rows()
            out.clear()
    if out:
        yield rows()


def merge_runs(runs: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, words, f``: counts of equal phrases added within the partition of their prefix, from ``least`` on."""
    dealt = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "phrase", "words").agg(F.sum("n").alias("f"))
    return dealt.filter(F.col("f") >= least).select("lang", "phrase", "words", "f")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", words: int = WORDS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of phrases of one to ``words`` words that occur ``least`` times or more, and ``lang, n``: all words."""
    tokens = materialise(tokenise(docs, text, lang, words))
    totals = materialise(tokens.groupBy("lang").agg(F.sum("n").alias("n")))
    ranges = -(-(totals.agg(F.sum("n")).first()[0] or 0) // RANGE_HASHES) or 1
    maps: list[np.ndarray] = []
    for k in range(1, words + 1):
        maps.append(bit_map(materialise(frequent_hashes(hash_runs(tokens, k, maps[-1] if maps else None, ranges), least))))
    return materialise(merge_runs(count_phrases(tokens, maps), least)), totals


# ---- scores -------------------------------------------------------------------------------------------------------


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", words: int = WORDS, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` candidates that no longer one with the same count contains."""
    found, totals = frequent_phrases(docs, text, lang, words, least)
    candidates = found.filter("words > 1")
    # A longer candidate with the same count gives every phrase between the two that count, so one word more is enough.
    inner = candidates.filter("words > 2").select("lang", "f", F.explode(F.array(_cut("first", F.col("words") - 1), _cut("rest", F.lit(1)))).alias("phrase"))
    absorbed = materialise(inner.join(candidates.select("lang", "phrase", "f"), ["lang", "phrase", "f"], "left_semi").select("lang", "phrase").distinct())
    kept = candidates.join(absorbed, ["lang", "phrase"], "left_anti")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "k", _cut("first", F.col("k")).alias("first"), _cut("rest", F.col("k")).alias("rest"))
    cuts = materialise(cuts)
    for part, out in (("first", "l"), ("rest", "r")):
        counts = found.select("lang", F.col("phrase").alias(part), F.col("f").alias(out))
        cuts = cuts.join(counts, ["lang", part])
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    scored = cuts.join(totals, "lang").withColumn("top", F.lit(1000) * (wide("a") * wide("n"))).withColumn("under", wide("l") * wide("r"))
    scored = scored.withColumn("score", F.expr("top div under"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("_cut")).select(
        "lang", "phrase", "_cut.*")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    first = materialise(best).withColumn("_place", F.row_number().over(parts)).filter(F.col("_place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score")


def _cut(side: str, k) -> F.Column:
    """The first k words of a phrase, or the rest."""
    words = F.split(F.col("phrase").cast("string"), " ", -1)
    part = F.slice(words, F.lit(1), k) if side == "first" else F.slice(words, k + 1, F.size(words) - k)
    return F.array_join(part, " ").cast("binary")
