"""Repeated byte strings across documents: suffix arrays per shard, merged across shards.

A byte is repeated when a string of ``length`` bytes that covers it also starts anywhere else, in the
same document or another one. Strings never cross documents, overlaps count, and all strings are judged
on the input.

* **Segments.** Every window of ``length`` bytes is named by its anchor, the smallest hash of the ``GRAM``-byte
  strings in it. Equal windows have equal anchors, whatever surrounds them. A maximal run of windows with one anchor
  is a segment; it is cut at ``MOST_WINDOWS``. Equal segments are counted, one of them stays, and an anchor with a single
  segment is done with: nothing can equal its windows.
* **Shards.** The segments that are left go to shards of about ``SHARD_BYTES`` by their anchor. A shard's suffix
  array is built by Larsson-Sadakane refinement (sort by eight bytes, then double the sorted depth, touching only
  suffixes that are still tied), its common prefixes by Kasai's recurrence, which many stretches of the text follow side by side.
  Neighbours that share ``length`` bytes are repeats.
* **Across shards.** An anchor with more bytes than a shard takes (a passage that a third of all
  documents quote) is dealt to several. What each of them found, one entry per different window of that anchor, is cut at the same
  ranges of window digests, and the sorted runs of a range are merged by binary search.

Texts travel twice: to cut out segments (once per different text) and to remove the repeats.

Defined results for odd rows: a NULL text is the empty string; texts under ``length`` bytes keep everything; equal
texts of ``length`` bytes or more lose everything, whatever their ids; rows with equal or NULL ids stay separate rows;
bytes are cut where the repeat ends, which may be inside a character, so kept bytes are binary; an empty table gives no rows.
Columns of the input besides the two named ones are left aside, so their names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.sketches import _powers
from geoloom.operators.checkpoints import materialise

LENGTH, GRAM = 400, 64
#: Windows of a segment at most, bytes of a shard, and bytes of one anchor in a shard (half of that).
MOST_WINDOWS, SHARD_BYTES = 4096, 2 << 20
#: Windows whose anchors are looked for together, and stretches of text that follow Kasai's recurrence side by side.
BUFFER, LANES = 1 << 19, 4096
#: Digests per range when what shards found is merged.
RANGE_ROWS = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # any odd constant
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SIZE = 1 << 20
_UP, _DOWN = _powers(_SIZE, _BASE), _powers(_SIZE, _INVERSE)


def _mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = h + np.uint64(seed)
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(by)
    h ^= h >> np.uint64(32)
    return h


def _sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any substring follows."""
    global _UP, _DOWN
    if len(data) > len(_UP):
        n = 1 << len(data).bit_length()
        _UP, _DOWN = _powers(n, _BASE), _powers(n, _INVERSE)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice, seed: int = 0) -> np.ndarray:
    at = start if isinstance(start, np.ndarray) else slice(0, len(sums[end]))
    return _mixed((sums[end] - sums[start]) * _DOWN[at], seed)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of every text: number of the text, first window, windows, anchor, hash, and whether its anchor occurs twice in it."""
    found: list[tuple[np.ndarray, ...]] = []
    parts: list[tuple[int, int, int]] = []  # text, first window, windows
    held = 0

    def flush() -> None:
        nonlocal held
        if parts:
            found.append(_segments(texts, parts, length, gram))
        parts.clear()
        held = 0

    for t, text in enumerate(texts):
        windows, at = len(text) - length + 1, 0
        while at < windows:
            take = min(windows - at, BUFFER - held)
            parts.append((t, at, take))
            at, held = at + take, held + take + length
            if held >= BUFFER:
                flush()
    flush()
    if not found:
        return (*(np.zeros(0, np.int64) for _ in range(3)), *(np.zeros(0, np.uint64) for _ in range(2)), np.zeros(0, bool))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _segments(texts: list[bytes], parts: list[tuple[int, int, int]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(texts[t][at:at + n + length - 1] for t, at, n in parts), np.uint8)
    takes = np.array([n for _, _, n in parts])
    ends = np.cumsum(takes + length - 1)
    starts = ends - (takes + length - 1)
    sums = _sums(data)
    grams = _hashes(sums, slice(0, -gram), slice(gram, None))
    # 40 bits of the hash, then the place: the smallest is the leftmost of the smallest hashes.
    order = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
    at = (_least(order, length - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int32)
    window = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, takes, strict=True)])
    at = at[window]
    anchor = grams[at]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(window)))
    if windows.max() > MOST_WINDOWS:
        pieces = -(-windows // MOST_WINDOWS)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, whole = np.repeat(first, pieces) + step * MOST_WINDOWS, np.repeat(first + windows, pieces)
        windows = np.minimum(whole - first, MOST_WINDOWS)
    a = window[first]
    last = first + windows - 1
    part = np.searchsorted(ends, a, side="right")
    of = np.array([t for t, _, _ in parts])[part]
    offset = np.array([p for _, p, _ in parts])[part] + a - starts[part]
    return of, offset, windows, anchor[first], _hashes(sums, a, a + windows + length - 1, 1), at[first] != at[last]


# ---- suffix array of a shard --------------------------------------------------------------------------------------

#: Bytes that go into one number, nine bits each: a byte plus one, or zero after the end.
PACKED = 7


def packed(data: np.ndarray) -> np.ndarray:
    """The seven bytes from every place on as one number in their order."""
    padded = np.zeros(len(data) + PACKED - 1, np.uint64)
    padded[:len(data)] = data
    padded[:len(data)] += np.uint64(1)
    out = np.zeros(len(data), np.uint64)
    for i in range(PACKED):
        out <<= np.uint64(9)
        out |= padded[i:i + len(data)]
    return out


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, the place of each in it, and the packed bytes.

    By Larsson and Sadakane: rank by the first seven bytes, then double the sorted depth for suffixes that are still tied.
    """
    n = len(data)
    key = packed(data)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, n))
    # The number of a group is the place of its last suffix, so splitting a group leaves the other numbers alone.
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(begin + size - 1, size)
    tied, depth = np.flatnonzero(np.repeat(size > 1, size)), PACKED
    while len(tied):
        suffix = order[tied]
        ahead = suffix + depth
        joint = rank[suffix] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        sort = np.argsort(joint, kind="stable")
        suffix, joint = suffix[sort], joint[sort]
        order[tied] = suffix
        new = np.ones(len(tied), bool)
        new[1:] = joint[1:] != joint[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(tied)))
        rank[suffix] = np.repeat(tied[begin + size - 1], size)
        tied = tied[np.repeat(size > 1, size)]
        depth *= 2
    return order, rank, key


def common_prefixes(order: np.ndarray, rank: np.ndarray, key: np.ndarray, most: int) -> np.ndarray:
    """Bytes, up to ``most`` or a little over, that each suffix in order shares with the one before it (0 for the first).

    Kasai's recurrence: the next suffix of the text shares at least one byte less. ``LANES`` stretches of the text follow it side
    by side, each at its own pace; every step compares seven bytes or goes on to the next suffix.
    """
    n = len(order)
    shared = np.zeros(n + 1, np.int32)  # the last place takes what finished lanes write
    if n < 2:
        return shared[:n]
    before = np.empty(n + 1, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = before[n] = n
    words = np.concatenate([key, np.zeros(most + 2 * PACKED, np.uint64)])
    stretch = -(-n // min(LANES, n))
    at = np.arange(0, n, stretch)
    end = np.minimum(at + stretch, n)
    h = np.zeros(len(at), np.int64)
    other = before[at]
    while True:
        differ = words[at + h] ^ words[other + h]
        go = (differ == 0) & (h < most)
        equal = sum((differ < np.uint64(1 << 9 * i)).astype(np.int64) for i in range(1, PACKED)) + (differ == 0)
        total = h + equal
        done = np.flatnonzero(~go)
        shared[at[done]] = total[done]
        h = total
        h[done] -= 1
        np.maximum(h, 0, out=h)
        at[done] += 1
        over = at >= end
        if over.any():
            if over.all():
                break
            keep = ~over
            at, end, h = at[keep], end[keep], h[keep]
        other = before[at]
    shared[order[0]] = 0
    return shared[order]


def repeated_windows(texts: list[bytes], windows: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts whose first ``windows`` windows count: number of the class of equal windows and its size, for every window
    in turn, and where each text's windows begin in these."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.array(windows, np.int64)
    base = np.cumsum(counts) - counts
    sizes = np.array([len(t) for t in texts], np.int64)
    place = np.repeat(np.cumsum(sizes) - sizes - base, counts) + np.arange(counts.sum())
    order, rank, key = suffix_array(data)
    group = np.cumsum(common_prefixes(order, rank, key, length) < length) - 1
    mine = group[rank[place]]
    return mine, np.bincount(mine, minlength=1)[mine], base


# ---- the tables ---------------------------------------------------------------------------------------------------

KEY = ["_k1", "_k2"]
SEGMENT = ["anchor", "segment"]


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Bytes of every text and its 128-bit key."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(body.cast("binary").alias("_body"), F.xxhash64(body).alias("_k1"), F.xxhash64(F.lit(7), body).alias("_k2"))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def segments(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """``_k1, _k2, start, windows, anchor, segment, twice``: the segments of every row of :func:`_keyed`."""
    gram = min(GRAM, length)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in _by_bytes(b.column("_body"), 8 * BUFFER):
                of, start, windows, anchor, segment, twice = segments_of(texts, length, gram)
                rows = pa.array(at + of)
                yield pa.RecordBatch.from_arrays(
                    [b.column("_k1").take(rows), b.column("_k2").take(rows), pa.array(start.astype(np.int64)), pa.array(windows.astype(np.int32)),
                     _signed(anchor), _signed(segment), pa.array(twice)],
                    names=[*KEY, "start", "windows", *SEGMENT, "twice"])

    return keyed.mapInArrow(each, "_k1 bigint, _k2 bigint, start bigint, windows int, anchor bigint, segment bigint, twice boolean")


def _by_bytes(column: pa.Array, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """Values of a binary column in runs of about ``most`` bytes, with the place of the first."""
    texts: list[bytes] = []
    at = held = 0
    for i, value in enumerate(column):
        texts.append(value.as_py())
        held += len(texts[-1])
        if held >= most:
            yield at, texts
            texts, at, held = [], i + 1, 0
    if texts:
        yield at, texts


def _shards(found: DataFrame, length: int) -> DataFrame:
    """Segments that may repeat: ``anchor, segment, n`` (rows that have it), ``whole`` (two or more), ``compare`` (other windows may
    equal its own), ``keeper`` (half of the key of a text that sends it), ``shard`` and ``split`` (its anchor is in several shards)."""
    kinds = materialise(found.groupBy(*SEGMENT).agg(
        F.count(F.lit(1)).alias("n"), F.min("_k1").alias("keeper"), F.max("windows").alias("windows"), F.max("twice").alias("twice")))
    size = F.col("windows") + (length - 1)
    anchors = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max("twice").alias("any_twice"), F.sum(size).alias("bytes"))
    anchors = materialise(anchors.filter("kinds > 1 OR any_twice"))
    total = anchors.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    salts = F.ceil(F.col("bytes") / (SHARD_BYTES // 2))
    dealt = kinds.join(anchors.select("anchor", salts.cast("int").alias("salts")), "anchor", "left").filter("n > 1 OR salts IS NOT NULL")
    return materialise(dealt.select(
        *SEGMENT, "keeper", (F.col("n") > 1).alias("whole"), F.col("salts").isNotNull().alias("compare"), (F.coalesce("salts", F.lit(1)) > 1).alias("split"),
        F.pmod(F.xxhash64("anchor", F.pmod(F.col("segment"), F.coalesce("salts", F.lit(1)))), F.lit(shards)).cast("int").alias("shard")))


def _cut_out(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted segments: ``shard, anchor, segment, windows, split, body``; each different text is opened once."""
    places = wanted.groupBy(*KEY).agg(F.collect_list(F.struct("start", "windows", *SEGMENT, "split", "shard")).alias("_places"))
    once = keyed.groupBy(*KEY).agg(F.first("_body").alias("_body"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                body, here = b.column("_body")[i].as_py(), b.column("_places")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["shard"] for p in here], pa.int32()), *(pa.array([p[c] for p in here], pa.int64()) for c in SEGMENT),
                     pa.array([p["windows"] for p in here], pa.int32()), pa.array([p["split"] for p in here], pa.bool_()),
                     pa.array([body[p["start"]:p["start"] + p["windows"] + length - 1] for p in here], pa.binary())],
                    names=["shard", *SEGMENT, "windows", "split", "body"])

    return once.join(places, KEY).mapInArrow(each, "shard int, anchor bigint, segment bigint, windows int, split boolean, body binary")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2] - 1


#: A shard's different windows of split anchors: digest, check, whose window it is, and whether it is ``single`` so far.
RUN = np.dtype([("digest", "<i8"), ("check", "<i8"), ("anchor", "<i8"), ("segment", "<i8"), ("at", "<i4"), ("single", "?")])
_FOUND = "anchor bigint, segment bigint, first int, last int, range int, run binary"


def _search(cut: DataFrame, length: int, ranges: int) -> DataFrame:
    """What every shard finds: runs of repeated windows of a segment (``first`` to ``last``), and for split anchors its different windows in
    order of their digests, one row (``range``, ``run``) per range of digests."""
    schema = pa.schema([("anchor", pa.int64()), ("segment", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("range", pa.int32()), ("run", pa.binary())])

    def shard(t: pa.Table) -> pa.Table:
        # Equal segments from several texts are one: they are marked whole already.
        t = t.take(pa.array(np.unique(np.stack([t.column(c).to_numpy() for c in SEGMENT]), axis=1, return_index=True)[1]))
        bodies, windows = t.column("body").to_pylist(), t.column("windows").to_pylist()
        group, size, base = repeated_windows(bodies, windows, length)
        known = np.zeros(sum(map(len, bodies)), bool)
        of, first, last, entries = [], [], [], []
        for i, (split, n) in enumerate(zip(t.column("split").to_pylist(), windows, strict=True)):
            here = slice(base[i], base[i] + n)
            a, b = _runs(size[here] > 1)
            of.append(np.full(len(a), i))
            first.append(a)
            last.append(b)
            if split:
                classes, at = np.unique(group[here], return_index=True)
                at = at[~known[classes]]
                known[classes] = True
                digests = b"".join([hashlib.blake2b(bodies[i][p:p + length], digest_size=16).digest() for p in at.tolist()])
                part = np.zeros(len(at), RUN)
                part["digest"], part["check"] = np.frombuffer(digests, "<i8").reshape(-1, 2).T
                part["anchor"], part["segment"] = t.column("anchor")[i].as_py(), t.column("segment")[i].as_py()
                part["at"], part["single"] = at, size[base[i] + at] == 1
                entries.append(part)
        of = pa.array(np.concatenate(of).astype(np.int64))
        found = pa.Table.from_arrays(
            [t.column("anchor").take(of), t.column("segment").take(of), pa.array(np.concatenate(first).astype(np.int32)),
             pa.array(np.concatenate(last).astype(np.int32)), pa.nulls(len(of), pa.int32()), pa.nulls(len(of), pa.binary())], schema=schema)
        if not entries:
            return found
        run = np.concatenate(entries)
        run = run[np.argsort(run["digest"])]
        cuts = np.searchsorted(run["digest"], edges_of(ranges))
        parts = [(r, p) for r, p in enumerate(np.split(run, cuts)) if len(p)]
        return pa.concat_tables([found, pa.Table.from_pylist([{"range": r, "run": p.tobytes()} for r, p in parts], schema=schema)])

    return cut.groupBy("shard").applyInArrow(shard, _FOUND)


def edges_of(ranges: int) -> np.ndarray:
    """Where all but the first of equal ranges of signed 64-bit numbers begin."""
    return np.array([-(1 << 63) + (1 << 64) * r // ranges for r in range(1, ranges)], np.int64)


def merged_runs(runs: list[np.ndarray]) -> np.ndarray:
    """Single entries that another run has too: every run is looked up in the sorted whole by binary search, equal digests then by their checks."""
    run = np.concatenate(runs)
    order = np.sort(run["digest"])
    again = np.searchsorted(order, run["digest"], side="right") - np.searchsorted(order, run["digest"], side="left") > 1
    some = run[again]
    some = some[np.lexsort((some["check"], some["digest"]))]
    same = (some["digest"][1:] == some["digest"][:-1]) & (some["check"][1:] == some["check"][:-1])
    out = np.zeros(len(some), bool)
    out[1:] |= same
    out[:-1] |= same
    return some[out & some["single"]]


def _merge_shards(found: DataFrame) -> DataFrame:
    """Waiting windows that another shard has too: ``anchor, segment, first, last``."""
    def merge(t: pa.Table) -> pa.Table:
        out = merged_runs([np.frombuffer(x, RUN) for x in t.column("run").to_pylist()])
        return pa.table([pa.array(np.ascontiguousarray(out[c])) for c in (*SEGMENT, "at", "at")], names=[*SEGMENT, "first", "last"])

    return found.groupBy("range").applyInArrow(merge, "anchor bigint, segment bigint, first int, last int")


def repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``_k1, _k2, spans``: for every different text with repeats, its maximal repeated runs of bytes (``start``, ``length``) in order."""
    keyed = _keyed(docs, text)
    found = materialise(segments(keyed.filter(F.octet_length("_body") >= length), length))
    plan = _shards(found, length)
    hits = materialise(found.join(plan, SEGMENT).select(
        *KEY, "start", "windows", *SEGMENT, "whole", "compare", "split", "shard", (F.col("_k1") == F.col("keeper")).alias("sends")))
    wanted = hits.filter("compare AND sends").dropDuplicates([*KEY, *SEGMENT])
    entries = wanted.filter("split").agg(F.sum("windows")).first()[0] or 0
    results = materialise(_search(_cut_out(keyed.filter(F.octet_length("_body") >= length), wanted, length), length, -(-entries // RANGE_ROWS) or 1))
    ranges = materialise(results.filter("run IS NULL").select(*SEGMENT, "first", "last").unionByName(
        _merge_shards(results.filter("run IS NOT NULL").select("range", "run"))))
    # Copies of a text have the same runs, so a text's places are taken once.
    slim = hits.select(*KEY, "start", "windows", *SEGMENT, "whole", "compare").dropDuplicates([*KEY, "start"])
    part = slim.filter("compare AND NOT whole").join(ranges, SEGMENT).select(
        *KEY, (F.col("start") + F.col("first")).alias("a"), (F.col("start") + F.col("last") + length).alias("b"))
    whole = slim.filter("whole").select(*KEY, F.col("start").alias("a"), (F.col("start") + F.col("windows") + (length - 1)).alias("b"))
    sorted_runs = F.array_sort(F.collect_list(F.struct("a", "b")))

    # (start, end) runs in order; a run that begins before the last one ends makes that one longer.
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [merged_spans(r) for r in b.column("_all").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("_k1"), b.column("_k2"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))], names=[*KEY, "spans"])

    return part.unionByName(whole).groupBy(*KEY).agg(sorted_runs.alias("_all")).mapInArrow(
        each, "_k1 bigint, _k2 bigint, spans array<struct<start:bigint,length:bigint>>")


def merged_spans(runs: list[dict]) -> list[dict]:
    """Sorted half-open runs ``a`` to ``b``, joined where they touch or overlap."""
    out: list[list[int]] = []
    for r in runs:
        if out and r["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["b"])
        else:
            out.append([r["a"], r["b"]])
    return [{"start": a, "length": b - a} for a, b in out]


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: its maximal repeated runs and the bytes that are left (binary)."""
    found = repeats(docs, text, length)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.cast("binary").alias("_body"), F.xxhash64(body).alias("_k1"), F.xxhash64(F.lit(7), body).alias("_k2"))
    n = F.octet_length("_body")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,length:bigint>>"))
    # Gaps: from the end of one run (or 0) to the start of the next (or the end).
    starts = F.concat(F.transform("spans", lambda s: s["start"]), F.array(n.cast("bigint")))
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["start"] + s["length"]))
    gaps = F.arrays_zip(ends.alias("a"), starts.alias("b"))
    parts = F.transform(gaps, lambda g: F.hex(F.substring(F.col("_body"), (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int"))))
    kept = F.when(F.size("spans") == 0, F.col("_body")).otherwise(F.unhex(F.array_join(parts, "")))
    return rows.join(found, KEY, "left").withColumn("spans", spans).select(
        "doc_id", n.cast("bigint").alias("n_bytes"), "spans", kept.alias("kept"))
