"""Secret scan: fixed patterns, and incompressible strings in sensitive context.

The patterns give the base findings.  Beyond them, every token of 16 characters
or more that follows a sensitive word is measured by zstandard: the compressor
is primed with a dictionary of common code identifiers and the text around the
token, and the token's marginal bytes are what it adds to an empty input.  The
bar is a share of what the same characters cost in random order, so it holds
for any length and alphabet.

In tokens without digits, or without letters, words that the corpus uses (or
the dictionary) are one byte each, so that long words, identifiers and paths
come out short; 16 characters or more between them are also measured alone.
A word counts as used from a share of the documents on, so the rule is the
same for any number of documents.  The words that such tokens may hold are
looked up by a join with the corpus's word counts: no list of words is cut off
or broadcast.
Two rules stay: such a token is not reported if the counts of its symbols leave
it fewer than 32 bits (rulers, runs of one character), and a string that the
text around repeats comes out short.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime_analytics.llm.common import slices, store, tidy, utf8

# fixed values: the contract's base patterns, minimum lengths and order of kinds
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is what [0-9a-f]+ finds there
ASSIGN_MIN, ACCESS_MIN = 12, 18
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = ("key", "token", "secret", "passw", "pwd", "auth", "bearer", "credential", "private", "cookie", "session", "signature", "jwt")
_SENSITIVE = re.compile("|".join(SENSITIVE), re.ASCII | re.IGNORECASE)
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

IDENTIFIERS = """
abstract access account action address admin alias allow append apply args array assert async attribute auth await
backend base batch begin binary block body bool boolean bucket buffer build byte bytes cache callback case catch char
class client close code column command commit common config connect connection const constant constructor content
context continue cookie copy count create credential current data database date debug default define delete deploy
description dict directory disable domain double element else email enable encode endpoint enum environment error
event example except exception execute export extends extern false field file filter final float folder format from
function generate get global group handler hash head header host html http https identifier import index init input
insert instance int integer interface internal item iterator javascript json key label lambda length level library
limit line list load local location logger login long main manager map match max message metadata method min mode
model module name namespace network none null number object offset open operator option output package param
parameter parse password path pattern pointer port prefix print private process production project property protected
protocol provider public python query queue random range read record reference region register release remote remove
replace request require reset resource response result return role root route row schema secret security select self
send sequence server service session set setting short signature size socket sort source sql state static status
storage store stream string struct style sum super switch sync system table target task template temp test text this
thread throw time timeout title token true type undefined union unique unsigned update upload url user username utf
util valid value variable vector version view virtual void volatile while width window word write xml yield
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 your_key_here YOUR_API_KEY xxxxxxxxxxxxxxxxxxxxxxxx
the quick brown fox jumps over the lazy dog 0000000000000000 1234567890 2020-01-01T00:00:00 application/json text/plain charset=utf-8 https://www.example.com/
""".strip().encode()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, in code points."""
    data = text.encode("utf-8", "surrogatepass")
    low = data.lower()
    out = []
    if b"passw" in low or b"secret" in low or b"token" in low or b"apikey" in low or b"api_key" in low:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if b"AKIA" in data:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if _HEX_RUN in data.translate(_HEX_TABLE):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


_HEX_TABLE = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = b"x" * 16


_RUNS = bytes(c if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-" else 32 for c in range(256))
_LETTERS = bytes(c | 32 if chr(c).isalpha() and c < 128 else 32 for c in range(256))
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
WORD_MIN, INNER_MIN, WORD_MAX, TOKEN_MIN = 3, 5, 15, 16
BITS_MIN, ORDERS = 32, 4


def own_words(text: bytes) -> set[bytes]:
    """The distinct words of 3 to 15 ASCII letters, lower-cased, outside runs that could be tokens themselves."""
    out = set()
    for run in set(text.translate(_RUNS).split()):
        if len(run) < TOKEN_MIN:
            out.update(w for w in run.translate(_LETTERS).split() if WORD_MIN <= len(w) <= WORD_MAX)
    return out


COMMON = frozenset(w.decode() for w in own_words(IDENTIFIERS))


def possible_words(token: str) -> set[str]:
    """All that :func:`without_words` may look up for the token."""
    out = set()
    for m in _PART.finditer(token):
        part = m.group().lower()
        out.add(part)
        out.update(part[i:i + k] for i in range(len(part)) for k in range(INNER_MIN, min(WORD_MAX, len(part) - i) + 1))
    return {w for w in out if WORD_MIN <= len(w) <= WORD_MAX}


def without_words(token: str, words: frozenset[str]) -> tuple[str, str]:
    """The token with one character above 127 for each known word, and what lies outside the words.

    Known words are whole parts (between other characters and changes of case)
    or, from five letters on, inside a part, the longest first."""
    def code(m):
        part, out, i = m.group().lower(), [], 0
        if part in words:
            return chr(128 + zlib.crc32(part.encode()) % 128)
        while i < len(part):
            n = next((k for k in range(min(WORD_MAX, len(part) - i), INNER_MIN - 1, -1) if part[i:i + k] in words), 0)
            out.append(chr(128 + zlib.crc32(part[i:i + n].encode()) % 128) if n else m.group()[i])
            i += n or 1
        return "".join(out)

    coded = _PART.sub(code, token)
    return coded, re.sub(r"[+/_=-]*[\x80-\xff][+/_=-]*", "", coded)


def marginal_bytes(candidate: str, around: str) -> int:
    """Bytes that the candidate (code points below 256) adds to a zstandard frame primed with the identifiers and its surroundings."""
    return _marginal(around)(candidate)


def _marginal(around: str):
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + around.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    z = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
    empty = len(z.compress(b""))
    return lambda candidate: len(z.compress(candidate.encode("latin-1"))) - empty


def is_mixed(token: str) -> bool:
    """Digits and letters: measured as it is, without words."""
    return any(c.isdigit() for c in token) and any(c.isalpha() for c in token)


def is_plain(token: str) -> bool:
    """The counts of its symbols leave it fewer than ``BITS_MIN`` bits (one that is not mixed)."""
    return sum(n * math.log2(len(token) / n) for n in Counter(token).values()) < BITS_MIN


def novelty(token: str, around: str, words: frozenset[str] = COMMON) -> float:
    """The token's marginal bytes as a share of those of the same characters in random order (of four orders
    the cheapest, and at most a byte a character)."""
    cost = _marginal(around)

    def share(of: str, least: int) -> float:
        chars, r = list(of), random.Random(of)
        random_cost = len(of)
        for _ in range(ORDERS):
            r.shuffle(chars)
            random_cost = min(random_cost, cost("".join(chars)))
        return least / max(1, random_cost)

    if is_mixed(token):
        return share(token, cost(token))
    if is_plain(token):
        return 0.0
    coded, rest = without_words(token, words)
    out = share(token, min(cost(token), cost(coded)))
    return max(out, share(rest, cost(rest))) if rest != token and len(rest) >= TOKEN_MIN else out


def candidates(text: str, taken: list[tuple[str, int, int]], reach: int) -> Iterator[tuple[int, int]]:
    """(start, end) of tokens at most ``reach`` characters after a sensitive word; tokens that meet a base finding are left to it."""
    words = [m.end() for m in _SENSITIVE.finditer(text)]
    w = t = 0
    apart: list[list[int]] = []  # the base findings as spans that do not overlap
    for a, b in sorted((s, e) for _, s, e in taken):
        if apart and a < apart[-1][1]:
            apart[-1][1] = max(apart[-1][1], b)
        else:
            apart.append([a, b])
    for m in _TOKEN.finditer(text) if words else ():
        s, e = m.span()
        while w + 1 < len(words) and words[w + 1] <= s:
            w += 1
        while t < len(apart) and apart[t][1] <= s:
            t += 1
        if 0 <= s - words[w] <= reach and not (t < len(apart) and apart[t][0] < e):
            yield s, e


def novel_spans(text: str, taken: list[tuple[str, int, int]], reach: int, context: int, least: float,
                known: frozenset[str] = COMMON) -> list[tuple[int, int, float]]:
    """(start, end, novelty) of the candidates whose novelty is ``least`` or more, the known words being given."""
    found = ((s, e, novelty(text[s:e], text[max(0, s - context):s] + text[e:e + context], known)) for s, e in candidates(text, taken, reach))
    return [x for x in found if x[2] >= least]


_FINDING = "struct<start:bigint,no:int,end:bigint,novelty:double>"


#: What the one pass over the texts writes: a row per text, and rows (word, n) of the words its task has counted.
_SCANNED = f"doc_id long, found array<{_FINDING}>, waiting array<struct<start:bigint,end:bigint,token:string,around:string>>, word string, n long"


def _scanned(reach: int, context: int, least: float):
    """The base findings and the novel tokens that need no words; the tokens that wait for them, with the text around;
    and in how many of a task's texts each word occurs (:func:`own_words`)."""
    finding = pa.list_(pa.struct([("start", pa.int64()), ("no", pa.int32()), ("end", pa.int64()), ("novelty", pa.float64())]))
    waiting = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("token", pa.string()), ("around", pa.string())]))
    names = ["doc_id", "found", "waiting", "word", "n"]

    def batch(ids, rows, waits, words, counts) -> pa.RecordBatch:
        kinds = (pa.int64(), finding, waiting, pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((ids, rows, waits, words, counts), kinds)], names)

    def counted(seen: Counter) -> pa.RecordBatch:
        none = [None] * len(seen)
        return batch(none, none, none, [w.decode() for w in seen], list(seen.values()))

    def run(batches):
        seen: Counter = Counter()
        for b in slices(batches):
            rows, waits = [], []
            for text, data in zip(b.column("text").to_pylist(), utf8(b.column("text"))):
                text = text or ""
                base = base_spans(text)
                found, wait = [(s, KINDS.index(k), e, None) for k, s, e in base], []
                for s, e in candidates(text, base, reach):
                    token, around = text[s:e], text[max(0, s - context):s] + text[e:e + context]
                    if not is_mixed(token):
                        if not is_plain(token):
                            wait.append({"start": s, "end": e, "token": token, "around": around})
                    elif (v := novelty(token, around)) >= least:
                        found.append((s, 3, e, v))
                rows.append([dict(zip(("start", "no", "end", "novelty"), x)) for x in found])
                waits.append(wait)
                seen.update(own_words(data))
            none = [None] * b.num_rows
            yield batch(b.column("doc_id").to_pylist(), rows, waits, none, none)
            if len(seen) > 200_000:
                yield counted(seen)
                seen = Counter()
        yield counted(seen)

    return run


def _possible(batches):
    for b in batches:
        for t in b.column("token").to_pylist():
            words = sorted(possible_words(t))
            for at in range(0, len(words), 20_000):
                part = words[at:at + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array([t] * len(part), pa.string()), pa.array(part, pa.string())], ["token", "word"])


def _measured(batches):
    for b in batches:
        values = [novelty(t, a or "", COMMON | frozenset(w or ())) for t, a, w in zip(*(b.column(c).to_pylist() for c in ("token", "around", "words")))]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("start"), b.column("end"), pa.array(values, pa.float64())], ["row", "start", "end", "novelty"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 40,
                 context: int = 512, least: float = 0.7, share: float = 1e-4, least_docs: int = 2) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, findings``, an array of (kind, start, end, novelty) by start, then kind.

    Kinds are ``assign``, ``access``, ``hex`` (base patterns, always reported,
    novelty null) and ``novel`` (by the measure).  Words of at least ``share``
    of the rows, and of ``least_docs`` rows, are known; they are counted over all
    rows in the pass that finds the candidates.  Spans are in code points, the end exclusive.
    Null text counts as empty (no findings); null and repeated ids keep their
    rows; texts are read whole; other columns are ignored; an empty table gives
    no rows.
    """
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    stored, _ = store(base.mapInArrow(tidy(_scanned(reach, context, least)), _SCANNED).withColumn("row", F.monotonically_increasing_id()), "scanned")
    scanned = stored.filter("word is null")
    waiting = scanned.filter(F.size("waiting") > 0).select("row", F.inline("waiting"))
    novel = scanned.select("doc_id", "found")
    if not waiting.isEmpty():
        least_n = max(least_docs, math.ceil(share * scanned.count()))
        wanted = waiting.select("token").distinct().mapInArrow(tidy(_possible), "token string, word string")
        used = stored.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n).select("word")
        known = wanted.join(used, "word").groupBy("token").agg(F.collect_set("word").alias("words"))
        judged = waiting.join(known, "token", "left").select("row", "start", "end", "token", "around", "words") \
            .mapInArrow(tidy(_measured), "row long, start long, end long, novelty double").filter(F.col("novelty") >= least)
        more = judged.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(3).alias("no"), "end", "novelty")).alias("more"))
        none = F.array().cast(f"array<{_FINDING}>")
        novel = scanned.join(more, "row", "left").select("doc_id", F.concat("found", F.coalesce("more", none)).alias("found"))
    kinds = F.array(*map(F.lit, KINDS))
    return novel.select("doc_id", F.transform(F.array_sort("found"), lambda x: F.struct(
        kinds[x["no"]].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["novelty"].alias("novelty"))).alias("findings"))
