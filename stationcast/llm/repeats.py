"""Suffix-array dedup: removes bytes covered by a string of LENGTH bytes that also
starts in a document with a smaller doc_id.

Sorting all suffixes of all shards against each other would move every byte many
times.  Instead suffix arrays are built where strings can repeat:

1. Anchors.  In every window of LENGTH bytes the GRAM-byte pieces of least hash
   are anchors.  Equal windows have equal anchors at equal places, so a repeated
   string always meets its copy at a common anchor.
2. Each document shard sends its sorted distinct anchor keys to key shards.  There
   the sorted lists are merged by binary search; a bit for each key tells the
   shard whether several documents have it.
3. Around such an anchor a shard cuts the context that holds the windows whose least
   hash it has, folds equal contexts, and sends them to the key's shard.
4. Each key shard builds the suffix array of its contexts by Larsson-Sadakane
   refinement and common prefixes by Kasai's rule.  Neighbours that share LENGTH
   bytes are one string; its smallest doc_id goes back to the contexts.
5. The document shards mark the windows whose string starts in a smaller doc_id.

Shards have bounded size and their number grows with the input.  A shard names a
key once, however many of its documents have it.  A key that more than HOT_SHARDS
shards name is dealt over all key shards by its single windows instead of contexts.
All copying between documents is exact; hashes only decide where strings meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import workers_ready
from stationcast.llm.suffix_arrays import common_prefixes, suffix_array, words8

#: With shorter pieces more of them repeat by chance, and ever more as the input grows.
LENGTH, GRAM = 50, 24
WINDOWS = LENGTH - GRAM + 1
CONTEXT = LENGTH + WINDOWS - 1  # bytes at most
#: Bytes of text in a document shard, of text per key shard, and contexts that one suffix array holds
#: (more only where one key has more).
SHARD_BYTES, KEY_SHARD_BYTES, ARRAY_CONTEXTS = 3 << 20, 8 << 20, 25_000
HOT_SHARDS = 512
#: Bytes of a key that are sent besides those its key shard implies.  Two keys that agree
#: in them are taken as one; that makes a few anchors live for nothing and changes no result.
KEY_BYTES = 4
#: Fills a row behind its context; no byte of UTF-8 text.
OUTSIDE = 0xFF
#: Offset of the anchor of a context that is a single window of a hot key.
SINGLE = 0xFF
_NO_DOC = np.iinfo(np.int64).max
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _slide(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def _gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """Of pieces of GRAM bytes, given by their first, second, ... 8 bytes."""
    h = words[0] * _A
    for w in words[1:]:
        h ^= h >> np.uint64(32)
        h += w
        h *= _B
    h ^= h >> np.uint64(29)
    return h


def _gram_key(h: np.ndarray) -> np.ndarray:
    key = h * _C
    return key ^ (key >> np.uint64(31))


def _window_key(windows: np.ndarray) -> np.ndarray:
    """Of single windows, as rows."""
    mixed = np.zeros(len(windows), np.uint64)
    for c in range(0, LENGTH, 5):
        for b in range(c, c + 5):
            mixed = (mixed ^ windows[:, b]) * _A
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _ramps(count: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _fold(key: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one place of each distinct key and row, in their order; of each place its number there)."""
    order = np.argsort(key)  # equal ones are put in order below
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    several = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
    if len(several):  # only these are told apart by their rows
        own = order[several]
        records = np.concatenate([key[own].astype(">u8").view(np.uint8).reshape(-1, 8), rows[own]], axis=1)
        order[several] = own[np.argsort(records.view(f"V{records.shape[1]}").ravel())]
    new = np.r_[True, ~same][:len(key)]
    again = np.flatnonzero(same) + 1
    new[again] = (rows[order[again]] != rows[order[again - 1]]).any(axis=1)
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class Shard:
    """The documents of a shard, one behind the other, with their anchors."""

    def __init__(self, docs: pa.Table):
        order = np.lexsort((docs.column("n").to_numpy(), docs.column("doc").to_numpy()))
        self.order = docs.take(pa.array(order))
        texts = [t or b"" for t in self.order.column("bytes").to_pylist()]
        self.doc = self.order.column("doc").to_numpy()
        self.size = np.array([len(t) for t in texts], np.int64)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self._anchors()

    def _anchors(self) -> None:
        """pos, key and document number of every anchor; the windows whose least hash it
        has start ``near`` to ``far`` bytes before it."""
        n = len(self.data)
        self.pos, self.key, self.at = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.near, self.far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if n < LENGTH:
            return
        eight = words8(self.data)
        h = _gram_hash([eight[o:n - GRAM + 1 + o] for o in range(0, GRAM, 8)])
        low = _slide(h, WINDOWS, np.minimum)  # of the window that starts here
        owner_end = np.repeat(self.end, self.size)
        low[np.arange(len(low)) + LENGTH > owner_end[:len(low)]] = 0
        padded = np.concatenate([np.zeros(WINDOWS - 1, np.uint64), low, np.zeros(WINDOWS - 1, np.uint64)])
        most = _slide(padded, WINDOWS, np.maximum)
        self.pos = np.flatnonzero((h == most) & (h > 0))
        h = h[self.pos]
        self.key = _gram_key(h)
        self.at = np.searchsorted(self.end, self.pos, side="right")
        # a window with a smaller hash in it is another anchor's; the next smaller one that
        # cuts windows off is the next anchor, or lies behind equal ones and some are kept twice
        gap = np.diff(self.pos)
        self.far = np.minimum(WINDOWS - 1, self.pos - self.start[self.at])
        self.far[1:] = np.where(h[:-1] < h[1:], np.minimum(self.far[1:], gap - 1), self.far[1:])
        self.near = np.maximum(0, self.pos + LENGTH - self.end[self.at])
        self.near[:-1] = np.where(h[1:] < h[:-1], np.maximum(self.near[:-1], WINDOWS - gap), self.near[:-1])

    def distinct_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys with their smallest and largest doc_id."""
        order = np.argsort(self.key)
        keys = self.key[order]
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        doc = self.doc[self.at[order]]
        return (keys[cuts], np.minimum.reduceat(doc, cuts), np.maximum.reduceat(doc, cuts)) if len(keys) else (keys, doc, doc)

    def contexts(self, keys: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the anchors whose key is among the sorted ``keys``: distinct contexts as rows
        of bytes, their sizes, offsets of the anchor and keys, and of each occurrence the
        number of its context, first position and document number."""
        where = np.minimum(np.searchsorted(keys, self.key), max(len(keys) - 1, 0))
        live = np.flatnonzero(keys[where] == self.key) if len(keys) else np.zeros(0, np.int64)
        is_hot = hot[where[live]].astype(bool) if len(live) else np.zeros(0, bool)
        plain, hots = live[~is_hot], live[is_hot]
        base, size, offset = self.pos[plain] - self.far[plain], self.far[plain] - self.near[plain] + LENGTH, self.far[plain]
        at, key = self.at[plain], self.key[plain]
        rows = self._cut(base, size)
        if len(hots):  # every window with a hot anchor by itself
            count = self.far[hots] - self.near[hots] + 1
            starts = np.unique(np.repeat(self.pos[hots] - self.far[hots], count) + _ramps(count))
            sizes = np.full(len(starts), LENGTH)
            cut = self._cut(starts, sizes)
            base, size, offset = np.r_[base, starts], np.r_[size, sizes], np.r_[offset, np.full(len(starts), SINGLE)]
            at, key = np.r_[at, np.searchsorted(self.end, starts, side="right")], np.r_[key, _window_key(cut)]
            rows = np.concatenate([rows, cut])
        places, number = _fold(key, rows)
        return rows[places], size[places], offset[places], key[places], number, base, at

    def _cut(self, base: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows of ``size`` bytes from ``base`` on, filled up."""
        place = base[:, None] + np.arange(CONTEXT)[None, :]
        cut = self.data[np.minimum(place, max(len(self.data) - 1, 0))] if len(self.data) else np.zeros(place.shape, np.uint8)
        cut[np.arange(CONTEXT)[None, :] >= size[:, None]] = OUTSIDE
        return cut

    def live_mask(self, keys: np.ndarray, parts: list[tuple[int, int, int]], told: pa.Table, column: str) -> np.ndarray:
        """The bits that the key shards sent back, for the sorted distinct ``keys``."""
        mask = np.zeros(len(keys), bool)
        place = {c: (a, b) for c, a, b in parts}
        for part, bits in zip(told.column("part").to_pylist(), told.column(column).to_pylist()):
            if bits is not None:
                a, b = place[part]
                mask[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return mask


_ZSTD = pa.Codec("zstd", compression_level=1)


def _packed(*columns: np.ndarray) -> bytes:
    """Arrays as one packed string.  What is shuffled is mostly these, and many: a large
    input has one for each pair of shards, with few numbers in it, so that what each
    array and string has besides its numbers would count.  Of numbers the first bytes
    stand together, then the second ones, and so on: the upper ones are mostly alike."""
    raw = b"".join(len(x).to_bytes(4, "little") + x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in columns)
    return len(raw).to_bytes(4, "little") + _ZSTD.compress(raw, asbytes=True)


def _unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw, at, out = _ZSTD.decompress(blob[4:], int.from_bytes(blob[:4], "little"), asbytes=True), 0, []
    for kind in map(np.dtype, kinds):
        n = int.from_bytes(raw[at:at + 4], "little")
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at + 4).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 4 + n * kind.itemsize
    return out


def _joined(blobs: list[bytes], *kinds: type) -> list[np.ndarray]:
    """The arrays of all strings, each joined."""
    return [np.concatenate(x) for x in zip(*(_unpacked(b, *kinds) for b in blobs))]


def _short(keys: np.ndarray, bits: int) -> bytes:
    """Of sorted keys the KEY_BYTES bytes behind their first ``bits`` bits, which their
    key shard implies, as steps from one to the next."""
    moved = ((keys << np.uint64(bits)) >> np.uint64(64 - 8 * KEY_BYTES)).astype(np.uint32)
    return _packed(np.diff(moved, prepend=np.uint32(0)))


def _long(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob, np.uint32)[0], dtype=np.uint32)


def _slices(sorted_codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(code, from, to) of each run."""
    cuts = np.flatnonzero(np.r_[True, sorted_codes[1:] != sorted_codes[:-1]]) if len(sorted_codes) else np.zeros(0, np.int64)
    return [(int(sorted_codes[a]), int(a), int(b)) for a, b in zip(cuts, [*cuts[1:], len(sorted_codes)])]


def smallest_docs(contexts: np.ndarray, size: np.ndarray, keys: np.ndarray, smallest: np.ndarray, array_contexts: int = ARRAY_CONTEXTS) -> np.ndarray:
    """For each window of every context (rows, sorted by ``keys``), one context behind
    the other, the smallest doc_id whose text has the same string.  One suffix array for
    each run of whole keys."""
    first = np.r_[0, np.cumsum(size - LENGTH + 1)]
    out = np.full(first[-1], _NO_DOC)
    heads = np.array([a for _, a, _ in _slices(keys)] + [len(keys)])
    a = 0
    while a < len(contexts):
        b = int(heads[min(max(np.searchsorted(heads, a + array_contexts, side="right") - 1, np.searchsorted(heads, a, side="right")), len(heads) - 1)])
        part, sizes = contexts[a:b], size[a:b]
        data = part[np.arange(CONTEXT)[None, :] < sizes[:, None]]
        start = np.cumsum(sizes) - sizes
        sa = suffix_array(data)
        prefix = common_prefixes(data, sa, CONTEXT + LENGTH, start)  # right up to LENGTH everywhere
        string = np.cumsum(prefix < LENGTH)
        row = np.repeat(np.arange(len(part)), sizes)[sa]
        offset = sa - start[row]
        good = offset + LENGTH <= sizes[row]
        row, offset, string = row[good], offset[good], string[good]
        cuts = np.flatnonzero(np.r_[True, string[1:] != string[:-1]])
        least = np.minimum.reduceat(smallest[a:b][row], cuts)
        out[first[a + row] + offset] = np.repeat(least, np.diff(np.r_[cuts, len(row)]))
        a = b
    return out


def removal(docs: DataFrame, text: str = "text", key: str = "doc_id", shard_bytes: int = SHARD_BYTES,
            hot_shards: int = HOT_SHARDS, array_contexts: int = ARRAY_CONTEXTS, key_shard_bytes: int = KEY_SHARD_BYTES) -> DataFrame:
    """(doc_id, text, n_bytes, n_removed, n_spans, kept: binary) for every row of ``docs``.

    Null and empty texts have 0 bytes and lose none; texts under 50 bytes lose
    none.  A null doc_id counts as larger than all others.  Rows of one doc_id do
    not remove each other's bytes, as neither is smaller; a string that occurs
    twice in one document stays.  An empty table gives an empty result; other
    columns are not read.  ``text`` of the result is what is left, read as
    UTF-8 with broken characters replaced."""
    spark = docs.sparkSession
    workers_ready(spark)
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long"))).first()[0] or 0
    n_shards = max(1, -(-total // shard_bytes))
    bits = max(0, int(np.ceil(np.log2(max(1, total / key_shard_bytes)))))
    code: Callable[[np.ndarray], np.ndarray] = lambda keys: (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("bytes"))
    d = d.select("doc_id", "bytes", F.coalesce("doc_id", F.lit(_NO_DOC - 1)).alias("doc"), F.coalesce(F.octet_length("bytes"), F.lit(0)).cast("long").alias("n"),
                 F.pmod(F.xxhash64("doc_id", "bytes"), F.lit(n_shards)).alias("shard"))

    def name_keys(docs: pa.Table) -> pa.Table:
        keys, low, high = Shard(docs).distinct_keys()
        rows = _slices(code(keys))
        shard = docs.column("shard")[0].as_py()
        return pa.table({"part": pa.array([c for c, _, _ in rows], pa.int64()), "shard": pa.array([shard] * len(rows), pa.int64()),
                         "keys": pa.array([_short(keys[a:b], bits) for _, a, b in rows], pa.binary()),
                         "several": pa.array([np.packbits(low[a:b] < high[a:b]).tobytes() for _, a, b in rows], pa.binary())})

    def meet(named: pa.Table) -> pa.Table:
        lists = [_long(x) for x in named.column("keys").to_pylist()]
        keys = np.sort(np.concatenate(lists))
        keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
        places = [np.searchsorted(keys, x) for x in lists]  # each sorted list is merged by binary search
        shards, live = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for place, several in zip(places, named.column("several").to_pylist()):
            shards[place] += 1
            live[place] |= np.unpackbits(np.frombuffer(several, np.uint8), count=len(place)).astype(bool)
        live |= shards > 1
        hot = shards > hot_shards
        out = [(s, p, np.packbits(live[x]).tobytes(), np.packbits(hot[x]).tobytes() if hot[x].any() else None)
               for s, p, x in zip(named.column("shard").to_pylist(), named.column("part").to_pylist(), places) if live[x].any()]
        return pa.table({n: pa.array([x[i] for x in out], k) for i, (n, k) in enumerate((("shard", pa.int64()), ("part", pa.int64()), ("live", pa.binary()), ("hot", pa.binary())))})

    def live_contexts(docs: pa.Table, told: pa.Table):
        shard = Shard(docs)
        keys = shard.distinct_keys()[0]
        parts = _slices(code(keys))
        live, hot = (shard.live_mask(keys, parts, told, c) for c in ("live", "hot"))
        return shard, *shard.contexts(keys[live], hot[live])

    def send(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows or not told.num_rows:
            return pa.table({"part": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()), "sent": pa.array([], pa.binary())})
        shard, rows, size, offset, keys, number, _, at = live_contexts(docs, told)
        low, high = np.full(len(rows), _NO_DOC), np.full(len(rows), -_NO_DOC)
        np.minimum.at(low, number, shard.doc[at])
        np.maximum.at(high, number, shard.doc[at])
        runs = _slices(code(keys))
        own = docs.column("shard")[0].as_py()
        inside = np.arange(CONTEXT)[None, :] < size[:, None]
        cols = (low, high - low, size.astype(np.uint8), offset.astype(np.uint8))
        return pa.table({"part": pa.array([c for c, _, _ in runs], pa.int64()), "shard": pa.array([own] * len(runs), pa.int64()),
                         "sent": pa.array([_packed(np.array([a], np.uint32), *[x[a:b] for x in cols], rows[a:b][inside[a:b]]) for _, a, b in runs], pa.binary())})

    def compare(sent: pa.Table) -> pa.Table:
        received = [_unpacked(x, np.uint32, np.int64, np.int64, np.uint8, np.uint8, np.uint8) for x in sent.column("sent").to_pylist()]
        begun, low, more, size, offset, text = (np.concatenate(x) for x in zip(*received))
        sizes, high, size, offset = np.array([len(x[1]) for x in received]), low + more, size.astype(np.int64), offset.astype(np.int64)
        del received
        ids = np.repeat(begun.astype(np.int64), sizes) + _ramps(sizes)
        rows = np.full((len(size), CONTEXT), OUTSIDE, np.uint8)
        rows[np.arange(CONTEXT)[None, :] < size[:, None]] = text
        single, eight, at = offset == SINGLE, words8(text), np.cumsum(size) - size + offset
        keys = np.empty(len(size), np.uint64)
        keys[~single] = _gram_key(_gram_hash([eight[at[~single] + o] for o in range(0, GRAM, 8)]))
        keys[single] = _window_key(rows[single])
        del text, eight, at
        places, number = _fold(keys, rows)
        least = np.full(len(places), _NO_DOC)
        np.minimum.at(least, number, low)
        size = size[places]
        found = smallest_docs(rows[places], size, keys[places], least, array_contexts)
        # runs of windows with one answer
        windows = size - LENGTH + 1
        begin = np.cumsum(windows) - windows
        change = np.r_[True, found[1:] != found[:-1]]
        change[begin] = True
        place = np.flatnonzero(change)
        row = np.repeat(np.arange(len(size)), windows)[place]
        first, last = place - begin[row], np.r_[place[1:], len(found)] - begin[row]
        answer = found[place]
        begin = np.searchsorted(row, np.arange(len(size) + 1))
        count = np.diff(begin)[number]
        pick = np.repeat(begin[number], count) + _ramps(count)
        record = np.repeat(np.arange(len(number)), count)
        use = answer[pick] < high[record]
        pick, record = pick[use], record[use]
        cuts = np.searchsorted(record, np.r_[0, np.cumsum(sizes)])
        own = sent.column("shard").to_pylist()
        out = [(own[i], a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        cols = (ids[record].astype(np.uint32), first[pick].astype(np.uint8), last[pick].astype(np.uint8), answer[pick])
        return pa.table({"shard": pa.array([s for s, _, _ in out], pa.int64()), "told": pa.array([_packed(*[x[a:b] for x in cols]) for _, a, b in out], pa.binary())})

    def remove(docs: pa.Table, known: pa.Table) -> pa.Table:
        names, kinds = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept"), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        if not docs.num_rows:
            return pa.table({n: pa.array([], k) for n, k in zip(names, kinds)})
        live, told = known.filter(known.column("live").is_valid()), known.filter(known.column("told").is_valid())
        if told.num_rows:
            shard, _, _, _, _, number, base, at = live_contexts(docs, live)
            ids, first, last, answer = _joined(told.column("told").to_pylist(), np.uint32, np.uint8, np.uint8, np.int64)
            order = np.argsort(ids, kind="stable")
            ids, first, last, answer = ids[order], first[order].astype(np.int64), last[order].astype(np.int64), answer[order]
            a, b = np.searchsorted(ids, number), np.searchsorted(ids, number, side="right")
            count = b - a
            pick = np.repeat(a, count) + _ramps(count)
            seen = np.repeat(np.arange(len(number)), count)
            use = answer[pick] < shard.doc[at[seen]]
            start, stop = base[seen[use]] + first[pick[use]], base[seen[use]] + last[pick[use]] - 1 + LENGTH
            marks = np.zeros(len(shard.data) + 1, np.int64)
            np.add.at(marks, start, 1)
            np.add.at(marks, stop, -1)
            gone = np.cumsum(marks)[:-1] > 0
        else:
            shard = Shard(docs)
            gone = np.zeros(len(shard.data), bool)
        out = []
        for i, (s, e) in enumerate(zip(shard.start, shard.end)):
            own = gone[s:e]
            out.append((int(own.sum()), int((own & ~np.r_[False, own[:-1]]).sum()), shard.data[s:e][~own].tobytes()))
        return pa.table({"doc_id": shard.order.column("doc_id"), "n_bytes": pa.array(shard.size, pa.int64()), "n_removed": pa.array([x[0] for x in out], pa.int64()),
                         "n_spans": pa.array([x[1] for x in out], pa.int64()), "kept": pa.array([x[2] for x in out], pa.binary())})

    by_shard = d.groupBy("shard")
    named = by_shard.applyInArrow(name_keys, "part long, shard long, keys binary, several binary")
    live = named.groupBy("part").applyInArrow(meet, "shard long, part long, live binary, hot binary")
    sent = by_shard.cogroup(live.groupBy("shard")).applyInArrow(send, "part long, shard long, sent binary")
    told = sent.groupBy("part").applyInArrow(compare, "shard long, told binary")
    known = live.unionByName(told, allowMissingColumns=True)
    return by_shard.cogroup(known.groupBy("shard")).applyInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    return removal(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
