"""Removal of byte strings that repeat across documents: suffix order over a collection, built column by column.

Every ``WIDTH``-byte string of a text belongs to an *anchor*, the
``GRAM``-byte substring of least hash in it (the last of equals), so equal
strings have equal anchors at the same place.  An anchor's *segment* is the
text from ``REACH`` bytes before it to ``WIDTH`` bytes after its start: it
holds all strings of that anchor.

1. Blocks of documents send, once each, the hashes of their distinct (anchor,
   segment) pairs with the smallest document id to buckets of the anchor.  The
   bucket answers: seen whole in an earlier document; nothing to compare; or
   the anchor has other segments.
2. The segments in doubt go to the buckets as bytes.  There the collection's
   suffixes are put in order column by column (:mod:`.bwt`: one symbol of every
   segment each round, the Burrows-Wheeler transform and the common prefixes
   updated); neighbours with a common prefix of ``WIDTH`` or more are equal
   strings, and the least document id among them decides.
3. The answers meet the block's texts, and the covered bytes go.

Ordering whole documents that way would take as many rounds as the longest
document has bytes, each over all of the text; on segments it takes 80.

An anchor with more segments than ``LOCAL_HOT`` in one block or ``HOT`` in all
(the edge of a passage that a third of all documents share) would gather too
much in one bucket: its strings go one by one, by a hash of the whole string,
each once per block, so that they spread over all buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.llm.bwt import earlier_occurrences
from ontime_analytics.llm.common import MESSAGE, drop, message, messages, pack, partitions, release, slices, store, tidy, unpack, utf8

WIDTH, GRAM = 50, 20
REACH = WIDTH - GRAM
BLOCK_BYTES = 8 << 20
LOCAL_HOT, HOT = 64, 4096
SORTED = 200_000                  # hashes sorted at once
BATCH = 2048                      # segments ordered at once, more only if they share an anchor
_CHUNK = 1 << 18
_NO_ID = np.iinfo(np.int64).max   # a null id is larger than any other
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_HOT_MARK = np.uint64((1 << 48) - 1)
NOTHING, COVERED, DOUBT, SPREAD = 0, 1, 2, 3


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(words, n: int, seed: np.uint64) -> np.ndarray:
    """64-bit hashes of ``n`` sequences, given word by word."""
    h = np.full(n, seed, np.uint64)
    for w in words:
        h = (h ^ w) * _B
        h ^= h >> np.uint64(29)
        h *= _A
        h ^= h >> np.uint64(32)
    return _mix(h)


def _hash_rows(matrix: np.ndarray, seed: np.uint64) -> np.ndarray:
    """64-bit hashes of the rows of a byte matrix whose width is a multiple of eight."""
    words = np.ascontiguousarray(matrix).view("<u8")
    return _hash_words((words[:, k] for k in range(words.shape[1])), len(words), seed)


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, segment hash, document, anchor's start, segment's start, segment's end) of a block's texts, joined in ``data``."""
    n = len(data)
    padded = np.concatenate([np.zeros(REACH, np.uint8), data, np.zeros(_CHUNK, np.uint8)])
    inside = np.zeros(n + 1, np.int8)
    long_ = ends - starts >= WIDTH
    np.add.at(inside, starts[long_], 1)
    np.add.at(inside, ends[long_] - WIDTH + 1, -1)
    inside = np.cumsum(inside, dtype=np.int8)[:n].astype(bool)
    low = np.uint64((1 << 20) - 1)
    out = []
    last = -1
    for a in range(0, n, _CHUNK):
        ok = inside[a:a + _CHUNK]
        if not ok.any():
            continue
        m = len(ok)
        size = m + REACH                       # grams that start here
        raw = padded[a:a + REACH + size + WIDTH + 8].tobytes()   # from REACH before the chunk
        raw += b"\0" * (REACH + size + WIDTH + 8 - len(raw))
        loads = np.empty(REACH + size + WIDTH, np.uint64)        # eight bytes from each place on
        for o in range(8):
            part = loads[o::8]
            part[:] = np.frombuffer(raw, "<u8", len(part), o)
        words = loads[REACH:]
        gram = words[:size] * _A
        gram += words[8:size + 8] * _B
        gram += words[GRAM - 8:size + GRAM - 8] * _C
        gram = _mix(gram)
        least = (gram & ~low) | (low - np.arange(size, dtype=np.uint64))
        step = 1
        while 2 * step <= REACH + 1:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        rest = REACH + 1 - step
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        at = (low - (least[:m] & low)).astype(np.int64)[ok]
        at = at[np.concatenate([[a + at[0] != last], at[1:] != at[:-1]])]
        if not len(at):
            continue
        last = a + int(at[-1])
        doc = np.searchsorted(ends, at + a, side="right")
        begin, end = np.maximum(at + a - REACH, starts[doc]), np.minimum(at + a + WIDTH, ends[doc])
        seg = _hash_words((loads[at + 8 * k] for k in range((REACH + WIDTH) // 8)), len(at), _C)
        clipped = np.flatnonzero(end - begin < REACH + WIDTH)
        place = (at + a - REACH)[clipped, None] + np.arange(REACH + WIDTH)
        matrix = padded[place + REACH] * ((place >= begin[clipped, None]) & (place < end[clipped, None]))
        seg[clipped] = _hash_rows(matrix, _C)
        seg = _mix(seg + (at + a - begin).astype(np.uint64) * _A + (end - at - a).astype(np.uint64) * _B)
        out.append((_mix(gram[at] ^ _C), seg, doc, at + a, begin, end))
    if not out:
        return (np.empty(0, np.uint64), np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(4)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal rows starts, in sorted columns."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _sorted_by(key: np.ndarray, then: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The order by three columns; most rows have a first one of their own."""
    order = np.argsort(key)
    k = key[order]
    tied = np.zeros(len(k), bool)
    tied[1:] = k[1:] == k[:-1]
    tied[:-1] |= tied[1:]
    rows = order[tied]
    order[tied] = rows[np.lexsort((last[rows], then[rows], key[rows]))]
    return order


def _by_bucket_and_id(bucket: np.ndarray, ids: np.ndarray) -> np.ndarray:
    if not len(ids):
        return np.empty(0, np.int64)
    low, high = int(ids.min()), int(ids.max())
    if high - low < 1 << 40 and int(bucket.max()) < 1 << 23:
        return np.argsort(bucket << 40 | (ids - low))
    return np.lexsort((ids, bucket))


class Block:
    """A block's texts with what its documents ask in step 1, the same whenever it is built."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], n_buckets: int):
        self.ids = ids
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        anchor, seg, doc, self.gram, self.begin, self.end = anchors(self.data, self.starts, self.ends)
        self.owner = ids[doc]
        bucket = ((anchor >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.int64)
        seg &= _HOT_MARK
        seg[seg == _HOT_MARK] = 0
        order = _sorted_by(anchor, seg, self.owner)
        anchor = anchor & np.uint64((1 << 40) - 1)
        b, a, s, o = bucket[order], anchor[order], seg[order], self.owner[order]
        first = _firsts(a, b, s)
        entry = np.cumsum(first) - 1                 # of each sorted occurrence
        group = np.cumsum(_firsts(a, b)[first]) - 1 if len(a) else np.empty(0, np.int64)
        crowded = (np.bincount(group) > LOCAL_HOT)[group] if len(group) else np.empty(0, bool)
        lead = _firsts(group) if len(group) else crowded
        keep = ~crowded | lead                       # a crowded anchor asks once, without its segments
        renumber = np.cumsum(keep) - 1
        at = np.flatnonzero(first)[keep]
        b, a, s, least = b[at], a[at], np.where(crowded[keep], _HOT_MARK, s[at]), o[at]
        send = _by_bucket_and_id(b, least)
        place = np.empty(len(send), np.int64)
        place[send] = np.arange(len(send))
        self.bucket, self.anchor, self.seg, self.least = b[send], a[send], s[send], least[send]
        self.entry = np.empty(len(order), np.int64)  # of each occurrence, in the order sent
        self.entry[order] = place[renumber[entry]] if len(order) else entry

    def asked(self):
        """(bucket, slice of the entries sent to it)."""
        cuts = np.flatnonzero(np.concatenate([_firsts(self.bucket), [True]])) if len(self.bucket) else []
        for s, e in zip(cuts[:-1], cuts[1:]):
            yield int(self.bucket[s]), slice(int(s), int(e))


def _deltas(sorted_ids: np.ndarray) -> np.ndarray:
    return np.diff(sorted_ids, prepend=np.int64(0)).astype(np.uint64)


def _undelta(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x.astype(np.int64))


def _gather(batches):
    """(digest, ids with null as _NO_ID, nullable ids, texts) of blocks of about ``BLOCK_BYTES``."""
    ids, texts, size, digest = [], [], 0, xxhash.xxh3_128()
    for b in slices(batches, 1 << 20):
        for d, t in zip(b.column("doc_id").to_pylist(), utf8(b.column("text"))):
            digest.update(f"{d} {len(t)} ".encode())
            digest.update(t)
            ids.append(d)
            texts.append(t)
            size += len(t)
        if size >= BLOCK_BYTES:
            yield digest.digest(), ids, texts
            ids, texts, size, digest = [], [], 0, xxhash.xxh3_128()
    if ids:
        yield digest.digest(), ids, texts


def _numbers(ids: list) -> np.ndarray:
    return np.array([_NO_ID if d is None else d for d in ids], np.int64)


def _ask_hashes(n_buckets: int):
    def run(batches):
        for digest, ids, texts in _gather(batches):
            block = Block(_numbers(ids), texts, n_buckets)
            for k, s in block.asked():
                yield message([(digest, 0, k, pack(block.anchor[s], block.seg[s], _deltas(block.least[s])), None)])
            del block
            release()
    return run


def _by_bucket(batches):
    """The rows of a partition sorted by seq, gathered by seq (a bucket holds a fixed share of the hashes)."""
    now, rows = None, []
    for row in messages(batches):
        if row[2] != now and rows:
            yield now, rows
            rows = []
        now = row[2]
        rows.append(row)
    if rows:
        yield now, rows


def judge_hashes(anchor: np.ndarray, seg: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The answer to each (anchor, segment, smallest id) entry of one bucket; about ``SORTED`` entries are sorted at once."""
    out = np.empty(len(anchor), np.uint8)
    runs = np.uint64(len(anchor) // SORTED + 1)
    run = (anchor % runs).astype(np.uint32) if runs > 1 else np.zeros(len(anchor), np.uint32)
    for k in range(int(runs)):
        now = np.flatnonzero(run == k)
        if len(now):
            out[now] = _judge(anchor[now], seg[now], owner[now])
    return out


def _judge(anchor: np.ndarray, seg: np.ndarray, owner: np.ndarray) -> np.ndarray:
    order = np.lexsort((owner, seg, anchor))
    a, s, o = anchor[order], seg[order], owner[order]
    new_a, new_s = _firsts(a), _firsts(a, s)
    group, pair = np.cumsum(new_a) - 1, np.cumsum(new_s) - 1
    n_segs = np.bincount(group[new_s])[group]
    first_a = np.flatnonzero(new_a)
    alone = (np.minimum.reduceat(o, first_a) == np.maximum.reduceat(o, first_a))[group]
    hot = (np.maximum.reduceat(s, first_a) == _HOT_MARK)[group] | (n_segs > HOT)
    seen = o[np.flatnonzero(new_s)][pair] < o
    out = np.where(hot, SPREAD, np.where(seen, COVERED, np.where((n_segs > 1) & ~alone, DOUBT, NOTHING))).astype(np.uint8)
    back = np.empty(len(out), np.uint8)
    back[order] = out
    return back


def _answer_hashes(batches):
    for k, rows in _by_bucket(batches):
        blocks = [r[0] for r in rows]
        parts = [unpack(r[3]) for r in rows]
        rows.clear()
        sizes = [len(p[0]) for p in parts]
        anchor, seg = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        owner = np.concatenate([_undelta(p[2]) for p in parts])
        del parts
        said = judge_hashes(anchor, seg, owner)
        del anchor, seg, owner
        at = 0
        for block, n in zip(blocks, sizes):
            yield message([(block, 0, k, pack(said[at:at + n]), None)])
            at += n
        release()


def _send_texts(batches):
    """A block's texts, in rows of about a megabyte: their sizes, their place in the block, the bytes."""
    for digest, ids, texts in _gather(batches):
        at = base = seq = 0
        while at < len(ids):
            end, size = at, 0
            while end < len(ids) and (end == at or size + len(texts[end]) <= 1 << 20):
                size += len(texts[end])
                end += 1
            yield message([(digest, 9, seq, pack(np.array([base, *map(len, texts[at:end])], np.uint64),
                                                 np.frombuffer(b"".join(texts[at:end]), np.uint8)), ids[at:end])])
            at, base, seq = end, base + size, seq + 1


def _by_block(batches):
    """(block, rows of kind < 9, iterator of the text rows): a block's answers come before its texts."""
    stream = messages(batches)
    row = next(stream, None)
    while row is not None:
        block, answers = row[0], {}
        while row is not None and row[0] == block and row[1] < 9:
            answers[row[1], row[2]] = row[3]
            row = next(stream, None)

        def texts():
            nonlocal row
            while row is not None and row[0] == block:
                yield row
                row = next(stream, None)

        yield block, answers, texts()


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals that overlap or touch."""
    order = np.argsort(begin, kind="stable")
    b, e = begin[order], np.maximum.accumulate(end[order]) if len(order) else end
    new = np.ones(len(b), bool)
    new[1:] = b[1:] > e[:-1]
    at = np.flatnonzero(new)
    return b[at], e[np.concatenate([at[1:] - 1, [len(e) - 1]])] if len(at) else e


def _ask_bytes(n_buckets: int):
    """Step 2, sent: segments in doubt as bytes (kind 0), spread strings as hashes (kind 1), and for the block
    itself what is covered already and which places wait for which answer (kind 2)."""
    def run(batches):
        for digest, answers, texts in _by_block(batches):
            once = {}
            for _, _, seq, payload, ids in texts:
                once[seq] = (payload, ids)
            ids, parts = [], []
            for seq in sorted(once):
                (sizes, data), own = unpack(once[seq][0]), once[seq][1]
                cuts = np.concatenate([[0], np.cumsum(sizes[1:].astype(np.int64))]).tolist()
                raw = data.tobytes()
                parts += [raw[s:e] for s, e in zip(cuts, cuts[1:])]
                ids += own
            block = Block(_numbers(ids), parts, n_buckets)
            said = np.concatenate([np.empty(0, np.uint8), *(unpack(answers[0, k])[0] for k, _ in block.asked() if (0, k) in answers)])
            if len(said) != len(block.anchor):
                raise RuntimeError("a block has no answers: the documents changed between two reads; write them to a table first")
            status, mine = said[block.entry], block.owner == block.least[block.entry]
            covered = (status == COVERED) | ((status != SPREAD) & ~mine)  # in an earlier document, elsewhere or in this block
            cover = [(block.begin[covered], block.end[covered])]

            wait = np.flatnonzero((status == DOUBT) & mine)
            entries, lead, wait_for = np.unique(block.entry[wait], return_index=True, return_inverse=True)
            lead = wait[lead]
            bucket = block.bucket[entries]
            for k in np.unique(bucket).tolist():
                now = lead[bucket == k]
                b, e = block.begin[now], block.end[now]
                data = np.concatenate([block.data[x:y] for x, y in zip(b.tolist(), e.tolist())])
                yield message([(digest, 0, k, pack(block.anchor[entries[bucket == k]], block.owner[now].astype(np.uint64),
                                                   (block.gram[now] - b).astype(np.uint8), (e - b).astype(np.uint8), data), None)])

            spread = np.flatnonzero(status == SPREAD)
            many = np.maximum(block.end[spread] - block.begin[spread] - WIDTH + 1, 0)
            place = np.unique(np.repeat(block.begin[spread] - np.cumsum(many) + many, many) + np.arange(int(many.sum())))
            if len(place):
                owner = block.ids[np.searchsorted(block.ends, place, side="right")]
                h1, h2 = _string_hashes(block.data, place)
                to = (h1 % np.uint64(n_buckets)).astype(np.int64)
                order = np.lexsort((owner, h2, h1, to))
                first = _firsts(to[order], h1[order], h2[order])
                which = np.empty(len(order), np.int64)
                which[order] = np.cumsum(first) - 1
                at = order[first]
                later = owner > owner[at][which]
                cover.append((place[later], place[later] + WIDTH))
                send = np.lexsort((owner[at], to[at]))
                rank = np.empty(len(send), np.int64)
                rank[send] = np.arange(len(send))
                at = at[send]
                cuts = np.flatnonzero(np.concatenate([_firsts(to[at]), [True]]))
                for s, e in zip(cuts[:-1], cuts[1:]):
                    x = at[s:e]
                    yield message([(digest, 1, int(to[x[0]]), pack(h1[x], h2[x].astype(np.uint32), _deltas(owner[x])), None)])
                wait2, wait2_for = place[~later], rank[which[~later]]
            else:
                wait2 = wait2_for = np.empty(0, np.int64)
            b, e = _merged(*(np.concatenate(x) for x in zip(*cover)))
            yield message([(digest, 2, 0, pack(b.astype(np.uint64), (e - b).astype(np.uint32), block.begin[wait].astype(np.uint64),
                                               wait_for.astype(np.uint32), wait2.astype(np.uint64), wait2_for.astype(np.uint32)), None)])
            release()
    return run


def _string_hashes(data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes (64 and 32 bits) of the ``WIDTH``-byte strings that start at the places."""
    wide = -(-WIDTH // 8) * 8
    h1, h2 = np.empty(len(place), np.uint64), np.empty(len(place), np.uint64)
    for a in range(0, len(place), 1 << 16):
        p = place[a:a + (1 << 16)]
        matrix = np.zeros((len(p), wide), np.uint8)
        matrix[:, :WIDTH] = data[p[:, None] + np.arange(WIDTH)]
        h1[a:a + len(p)] = _hash_rows(matrix, _A)
        h2[a:a + len(p)] = _hash_rows(matrix, _B) >> np.uint64(32)
    return h1, h2


def _shared_halves(anchor: np.ndarray, gram: np.ndarray, sizes: np.ndarray, starts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Which segments share with another of their anchor the anchor and 15 bytes before it, or the anchor and 15 after.

    Any string of the anchor holds one of the two, so the others repeat nothing."""
    half = REACH // 2
    out = np.zeros(len(anchor), bool)
    for has, before in ((gram >= half, half), (sizes - gram >= GRAM + half, 0)):
        which = np.flatnonzero(has)
        matrix = np.zeros((len(which), -(-(GRAM + half) // 8) * 8), np.uint8)
        if len(which):
            matrix[:, :GRAM + half] = data[(starts[which] + gram[which] - before)[:, None] + np.arange(GRAM + half)]
        key = _mix(_hash_rows(matrix, _C) + anchor[which] * _A)
        _, back, counts = np.unique(key, return_inverse=True, return_counts=True)
        out[which] |= counts[back] > 1
    return out


def judge_segments(anchor: np.ndarray, owner: np.ndarray, gram: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For each segment a bit mask of the offsets whose string also starts in a segment with a smaller owner.

    Segments that share an anchor are ordered together."""
    out = np.zeros(len(anchor), np.uint32)
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(anchor, kind="stable")
    order = order[_shared_halves(anchor, gram, sizes, starts, data)[order]]
    groups = np.flatnonzero(np.concatenate([_firsts(anchor[order]), [True]]))
    at = 0
    while at + 1 < len(groups):
        to = at + 1
        while to + 1 < len(groups) and groups[to + 1] - groups[at] <= BATCH:
            to += 1
        now = order[groups[at]:groups[to]]
        hits = earlier_occurrences(data, starts[now], sizes[now], owner[now], WIDTH)
        np.bitwise_or.at(out, now[hits[:, 0]], np.uint32(1) << hits[:, 1].astype(np.uint32))
        at = to
    return out


def _answer_bytes(batches):
    for k, rows in _by_bucket(batches):
        for kind in (0, 1):
            mine = [r for r in rows if r[1] == kind]
            if not mine:
                continue
            parts = [unpack(r[3]) for r in mine]
            if kind == 0:
                anchor, owner, gram, sizes, data = (np.concatenate(x) for x in zip(*parts))
                said = judge_segments(anchor, *(x.astype(np.int64) for x in (owner, gram, sizes)), data)
            else:
                h1, h2 = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                owner = np.concatenate([_undelta(p[2]) for p in parts])
                order = np.lexsort((owner, h2, h1))
                first = _firsts(h1[order], h2[order])
                said = np.empty(len(order), np.uint8)
                said[order] = owner[order[first]][np.cumsum(first) - 1] < owner[order]
            at = 0
            for r, p in zip(mine, parts):
                yield message([(r[0], kind, k, pack(said[at:at + len(p[0])]), None)])
                at += len(p[0])


def _cut(batches):
    """Step 3: the documents without what is covered."""
    for _, answers, texts in _by_block(batches):
        if (2, 0) not in answers:
            raise RuntimeError("a block has no answers: the documents changed between two reads; write them to a table first")
        b, size, wait, wait_for, wait2, wait2_for = (x.astype(np.int64) for x in unpack(answers[2, 0]))
        begin, end = [b], [b + size]
        masks = np.concatenate([np.empty(0, np.uint32), *(unpack(answers[key])[0] for key in sorted(answers) if key[0] == 0)])
        mine = masks[wait_for] if len(wait) else np.empty(0, np.uint32)
        for bit in range(REACH + 1):
            hit = wait[(mine >> np.uint32(bit)) & np.uint32(1) == 1] + bit
            begin.append(hit)
            end.append(hit + WIDTH)
        bits = np.concatenate([np.empty(0, np.uint8), *(unpack(answers[key])[0] for key in sorted(answers) if key[0] == 1)])
        hit = wait2[bits[wait2_for] == 1] if len(wait2) else wait2
        begin, end = _merged(np.concatenate([*begin, hit]), np.concatenate([*end, hit + WIDTH]))
        for _, _, _, payload, ids in texts:
            sizes, data = unpack(payload)
            base, sizes = int(sizes[0]), sizes[1:].astype(np.int64)
            x, y = np.searchsorted(end, base, side="right"), np.searchsorted(begin, base + len(data))
            change = np.zeros(len(data) + 1, np.int32)
            np.add.at(change, np.maximum(begin[x:y] - base, 0), 1)
            np.add.at(change, np.minimum(end[x:y] - base, len(data)), -1)
            gone = np.cumsum(change[:-1]) > 0
            rows, s = [], 0
            for n in sizes.tolist():
                g = gone[s:s + n]
                spans = int(np.count_nonzero(g[1:] & ~g[:-1])) + int(n > 0 and bool(g[0]))
                rows.append((n, int(np.count_nonzero(g)), spans, data[s:s + n][~g].tobytes()))
                s += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)),
                 pa.array([r[3] for r in rows], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept``.

    Texts are UTF-8 bytes.  A byte goes if it lies in a 50-byte string that also
    starts in a document with a smaller id; strings lie within one document and
    are judged on the texts as given.  ``n_spans`` counts the maximal removed
    runs, ``kept`` is the rest (bytes; a character may be cut).  Null text counts
    as empty, texts under 50 bytes stay whole.  Rows that repeat an id do not
    remove from each other; a null id is larger than any other.  Other columns
    are ignored; an empty table gives no rows.
    """
    n = partitions(docs.sparkSession)
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    asked = base.mapInArrow(tidy(_ask_hashes(n)), MESSAGE)
    answers, path = store(asked.repartition(n, "seq").sortWithinPartitions("seq", "block").mapInArrow(tidy(_answer_hashes), MESSAGE), "answers")
    met = answers.unionByName(base.mapInArrow(tidy(_send_texts), MESSAGE)).repartition(n, "block").sortWithinPartitions("block", "kind", "seq")
    doubts, _ = store(met.mapInArrow(tidy(_ask_bytes(n)), MESSAGE), "doubts")
    drop(docs.sparkSession, path)
    said, _ = store(doubts.filter("kind < 2").repartition(n, "seq").sortWithinPartitions("seq", "kind", "block")
                    .mapInArrow(tidy(_answer_bytes), MESSAGE), "answers")
    last = doubts.filter("kind = 2").unionByName(said).unionByName(base.mapInArrow(tidy(_send_texts), MESSAGE))
    return last.repartition(n, "block").sortWithinPartitions("block", "kind", "seq").mapInArrow(
        tidy(_cut), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
