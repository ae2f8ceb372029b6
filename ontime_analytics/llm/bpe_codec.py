"""BPE encoding by a distinct-word table, and decoding by an id-to-piece join.

1. Tasks cut texts into units (:mod:`.bpe`) and gather them in blocks of about
   ``BLOCK_BYTES`` of text.  A block sends its distinct units, once each, to
   the buckets of the units' hash.  Blocks fall into regions of about
   ``REGION_BYTES``, which have their own buckets, at most ``BUCKETS`` each: so
   a block sends a bounded number of messages and a bucket gets a bounded share
   of text, however large the input is.
2. A bucket encodes each distinct unit once (so once per region), whichever
   blocks ask for it, and answers every block with ids in the order asked.
3. The block's positions - for each document the numbers of its units - meet
   these answers and become ids.

So what moves is the distinct units of each block and small numbers for the
positions; no text does.  Steps 1 and 3 read the documents once each and must
see the same rows in the same order (a table does; a block without its answers
fails the job).  Decoding joins ids with the vocabulary's pieces, a table as
large as the vocabulary, which is checked and broadcast; :func:`recode` does it
in the same workers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ontime_analytics.llm.bpe import load, pieces
from ontime_analytics.llm.common import MESSAGE, message, messages, pack, partitions, release, slices, tidy, unpack, utf8

BLOCK_BYTES = 4 << 20
REGION_BYTES = 16 << 30
BUCKETS = 64
MAX_VOCABULARY = 1 << 20


class _Codes(dict):
    """Numbers units in the order first seen."""

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        return n


def _blocks(batches, path: str, n_buckets: int):
    """(block, units by bucket, sizes by bucket, chunks) with chunks of (ids of the documents, units per document,
    units' places).  A unit's place counts the block's units bucket by bucket."""
    bpe = load(path)

    def done():
        units = [u.encode() for u in codes]
        bucket = np.fromiter(map(xxhash.xxh64_intdigest, units), np.uint64, len(units)) % np.uint64(n_buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(units), np.uint32)
        place[order] = np.arange(len(units), dtype=np.uint32)
        return (digest.digest(), [units[i] for i in order.tolist()], np.bincount(bucket.astype(np.int64), minlength=n_buckets),
                [(ids, sizes, place[c]) for ids, sizes, c in chunks])

    codes, chunks, size, digest = _Codes(), [], 0, xxhash.xxh3_128()
    for b in slices(batches, 2 << 20):
        texts = [t or "" for t in b.column("text").to_pylist()]
        sizes = np.empty(len(texts), np.uint32)
        parts = []
        for i, t in enumerate(texts):
            units = bpe.units(t)
            sizes[i] = len(units)
            parts.append(np.fromiter(map(codes.__getitem__, units), np.uint32, len(units)))
        ids = b.column("doc_id")
        for d, t in zip(ids.to_pylist(), utf8(b.column("text"))):
            digest.update(f"{d} {len(t)} ".encode())
            digest.update(t)
        chunks.append((ids, sizes, np.concatenate(parts)))
        size += sum(map(len, texts))
        if size >= BLOCK_BYTES:
            yield done()
            codes, chunks, size, digest = _Codes(), [], 0, xxhash.xxh3_128()
            release()
    if chunks:
        yield done()


def _ask(path: str, n_buckets: int, n_regions: int):
    """Step 1: a block's distinct units for each bucket of its region."""
    def run(batches):
        for block, units, counts, _ in _blocks(batches, path, n_buckets):
            at, rows = 0, []
            first = int.from_bytes(block[:6], "little") % n_regions * n_buckets
            for k, n in enumerate(counts.tolist()):
                if n:
                    mine = units[at:at + n]
                    rows.append((block, 0, first + k, pack(np.array([len(u) for u in mine], np.uint32), np.frombuffer(b"".join(mine), np.uint8)), None))
                    at += n
            yield message(rows)
    return run


def _answer(path: str):
    """Step 2: the ids of the units of each (block, bucket), in their order; each distinct unit is encoded once."""
    def run(batches):
        bpe, bucket, known = load(path), None, {}
        small = bpe.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        rows = []
        for block, _, k, payload, _ in messages(batches):
            if k != bucket:
                bucket, known = k, {}
            sizes, data = unpack(payload)
            data, at, lists = data.tobytes(), 0, []
            for n in sizes.tolist():
                unit = data[at:at + n]
                at += n
                ids = known.get(unit)
                if ids is None:
                    ids = known[unit] = np.array(bpe.ids(unit.decode()), np.uint16 if small else np.uint32).tobytes()
                lists.append(ids)
            flat = np.frombuffer(b"".join(lists), np.uint16 if small else np.uint32)
            rows.append((block, 0, k, pack(np.array([len(x) // flat.itemsize for x in lists], np.uint32), flat), None))
            if len(rows) >= 64:
                yield message(rows)
                rows = []
        yield message(rows)
    return run


def _positions(path: str, n_buckets: int):
    """Step 3, sent: a block's documents as places of their units."""
    def run(batches):
        for block, _, _, chunks in _blocks(batches, path, n_buckets):
            for i, (ids, sizes, places) in enumerate(chunks):
                yield message([(block, 1, i, pack(sizes, places), ids.to_pylist())])
    return run


def _spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[w]:starts[w] + sizes[w]]`` for each w in ``which``, joined."""
    n = sizes[which]
    ends = np.cumsum(n)
    at = np.repeat(starts[which] - (ends - n), n)
    at += np.arange(len(at))
    return values[at]


def _join(batches):
    """Step 3, received: a block's answers come first, then its documents."""
    block, answers, table = None, {}, None
    for blk, kind, seq, payload, ids in messages(batches):
        if blk != block:
            block, answers, table = blk, {}, None
        if kind == 0:
            answers[seq] = payload
            continue
        if table is None:
            parts = [unpack(answers[k]) for k in sorted(answers)]
            sizes = np.concatenate([np.empty(0, np.int64), *(p[0].astype(np.int64) for p in parts)])
            table = (np.concatenate([np.empty(0, np.uint32), *(p[1].astype(np.uint32) for p in parts)]), np.cumsum(sizes) - sizes, sizes)
            answers = {}
        per_doc, places = unpack(payload)
        if len(places) and int(places.max()) >= len(table[2]):
            raise RuntimeError("a block has no answers: the documents changed between two reads; write them to a table first")
        places = places.astype(np.int64)
        flat = _spread(*table, places).astype("<u4")
        tokens = np.concatenate([[0], np.cumsum(table[2][places])])
        cuts = tokens[np.concatenate([[0], np.cumsum(per_doc.astype(np.int64))])].tolist()
        data = flat.tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([data[4 * s:4 * e] for s, e in zip(cuts, cuts[1:])], pa.binary())], ["doc_id", "ids"])


def regions(text_bytes: int) -> int:
    return max(1, -(-text_bytes // REGION_BYTES))


def _met(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """Answers and positions of every block together, as :func:`_join` reads them."""
    spark = docs.sparkSession
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    n_regions = regions(base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    tasks, n = partitions(spark), min(partitions(spark), BUCKETS)
    asked = base.mapInArrow(tidy(_ask(path, n, n_regions)), MESSAGE)
    answered = asked.repartition(tasks, "seq").sortWithinPartitions("seq", "block").mapInArrow(tidy(_answer(path)), MESSAGE)
    sent = answered.unionByName(base.mapInArrow(tidy(_positions(path, n)), MESSAGE))
    return sent.repartition(tasks, "block").sortWithinPartitions("block", "kind", "seq")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, ids`` (little-endian unsigned 32-bit integers).

    The ids are those of the tokenizers library for the whole text, without
    added tokens, truncation or padding.  Null text counts as empty (no ids);
    null and repeated ids of documents keep their rows; other columns are
    ignored; an empty table gives no rows."""
    return _met(docs, path, id_col, text_col).mapInArrow(tidy(_join), "doc_id long, ids binary")


def recode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: :func:`encode` and then :func:`decode`, one worker for both."""
    back = _decoder(docs.sparkSession, path)
    return _met(docs, path, id_col, text_col).mapInArrow(tidy(lambda batches: back(_join(batches))), "doc_id long, ids binary, decoded string")


def _decoder(spark, path: str):
    """For tasks: batches with ``ids`` get ``decoded``."""
    table = sorted(pieces(path))
    if len(table) > MAX_VOCABULARY:
        raise ValueError(f"{len(table)} pieces are too many to broadcast")
    if [i for i, _, _ in table] != list(range(len(table))):
        raise ValueError("the vocabulary's ids have gaps")
    sizes = np.array([len(p) for _, p, _ in table], np.int64)
    shared = spark.sparkContext.broadcast((np.frombuffer(b"".join(p for _, p, _ in table), np.uint8), np.cumsum(sizes) - sizes, sizes))

    def run(batches):
        values, starts, sizes = shared.value
        for b in batches:
            at, rows = 0, b.column("ids").to_pylist()
            while at < len(rows):
                end, size = at, 0
                while end < len(rows) and (end == at or size < 2 << 20):
                    size += len(rows[end] or b"")
                    end += 1
                ids = np.frombuffer(b"".join(x or b"" for x in rows[at:end]), "<u4").astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes[ids])])
                cuts = ends[np.concatenate([[0], np.cumsum([len(x or b"") // 4 for x in rows[at:end]])])].tolist()
                data = _spread(values, starts, sizes, ids).tobytes()
                texts = [data[s:e].decode("utf-8", "replace") for s, e in zip(cuts, cuts[1:])]
                part = b.slice(at, end - at)
                names = [n for n in part.schema.names if n != "decoded"]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(texts, pa.string())], [*names, "decoded"])
                at = end

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (with ``ids`` as :func:`encode` gives them) and the ``decoded`` text.

    An id outside the vocabulary fails the job; null ids decode to the empty
    text; a column that is called ``decoded`` is replaced; an empty table gives no rows."""
    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    return encoded.mapInArrow(tidy(_decoder(encoded.sparkSession, path)), StructType([*kept, StructField("decoded", StringType())]))
