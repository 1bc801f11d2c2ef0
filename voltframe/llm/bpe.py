"""Byte-level BPE by DuckDB recursive queries, one database per Python worker.

The merge table holds every (left id, right id) whose joined bytes are a token, with that token's id as rank. A
recursive query takes token-position rows of many distinct words at once; each turn joins neighbours with the merge
table and contracts each word's leftmost pair of least rank, and goes on with the words that changed. Long words are cut first where no
token could lie across; of parts that stay long, a turn contracts all pairs that the order of ranks is sure to contract. A second query decodes: the ids' bytes, aggregated in the order
of their positions. Each distinct word is encoded once for a worker's cache, which is bounded in bytes; texts are then
concatenations. No row ever moves between executors.

Null and empty texts give no ids, the hash of nothing, and empty bytes. A long part of n bytes takes n rows, whatever its turns: 400 MB
of a worker's memory up to about a million bytes, and 450 bytes for each byte beyond.
"""

from __future__ import annotations

import base64
import hashlib
import shutil
import tempfile
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, ranges, read, resident, ship, steps, texts

#: A query over short words keeps the rows of all turns: at most so many words, and so many by the sum of their squared
#: lengths. Words of more than LONG bytes are encoded with one row a byte, so many bytes (or one word) a query. A worker's
#: cache of words starts anew at so many bytes. All of these only bound memory.
WORDS, SQUARES, LONG, LONG_BYTES, CACHED = 12_000, 1_200_000, 64, 1 << 20, 32 << 20
#: Bytes of text that are encoded at once.
TEXT_BYTES = 2 << 20
#: DuckDB's memory in a worker, its MB while it encodes parts of more than LONG bytes, and what a byte of a part of over a million bytes takes.
MEMORY, LONG_MEMORY, LONG_ROW = "120MB", 400, 450

#: White space beyond ASCII.
WHITE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

ENCODE = """
WITH RECURSIVE state(turn, wp, tok) AS (
  SELECT 0, wp, tok FROM init
  UNION ALL
  (WITH pairs AS (
     SELECT turn, wp, tok, lead(tok) OVER by_place AS next_tok, lead(wp) OVER by_place AS next_wp, lag(wp) OVER by_place AS prev_wp
     FROM state WINDOW by_place AS (ORDER BY wp)),
   best AS (
     SELECT p.wp >> 32 AS word, min(m.rank_high | (p.wp & 4294967295)) AS least
     FROM pairs p JOIN merges m ON ((p.tok << 32) | p.next_tok) = m.pair
     WHERE (p.next_wp >> 32) = (p.wp >> 32) GROUP BY 1)
   SELECT turn + 1, wp, CASE WHEN (wp & 4294967295) = (least & 4294967295) THEN least >> 32 ELSE tok END
   FROM pairs JOIN best ON (pairs.wp >> 32) = best.word
   WHERE prev_wp IS NULL OR prev_wp <> ((word << 32) | (least & 4294967295)))
)
SELECT s.wp >> 32 AS word, s.wp & 4294967295 AS place, s.tok AS tok
FROM state s JOIN (SELECT wp >> 32 AS word, max(turn) AS turn FROM state GROUP BY 1) last ON (s.wp >> 32) = last.word AND s.turn = last.turn
ORDER BY s.wp
"""
#: For long words. ``state`` is keyed by place, so that it never has more rows than the words have bytes; -1 is a place whose token went
#: into its left neighbour's, -2 (at no byte's place) marks a word with a pair of lower rank than one of its own parts.
_ALIVE = """
  SELECT wp, tok FROM init
  UNION
  (WITH alive AS (SELECT wp, tok, lead(tok) OVER by_place AS next_tok, lead(wp) OVER by_place AS next_wp, lead(wp, 2) OVER by_place AS after FROM recurring.state WHERE tok >= 0 WINDOW by_place AS (ORDER BY wp)),"""
ENCODE_LONG = f"""
WITH RECURSIVE state(wp, tok) USING KEY (wp) AS ({_ALIVE}
   ranked AS (
     SELECT a.wp, a.next_wp, a.after, a.tok, m.rank_high >> 32 AS rank, m.early, a.wp - r.low AS back, greatest(r.high - 1 - a.wp, 0) AS ahead
     FROM alive a JOIN merges m ON ((a.tok << 32) | a.next_tok) = m.pair JOIN reach r ON r.wp = a.next_wp
     WHERE (a.next_wp >> 32) = (a.wp >> 32)),
   judged AS (
     SELECT wp, next_wp, after, tok, rank, rank = min(rank) OVER (ORDER BY wp RANGE BETWEEN back PRECEDING AND ahead FOLLOWING) AS sure,
       coalesce(lag(next_wp) OVER by_place = wp AND lag(rank) OVER by_place = rank, false) AS goes_on
     FROM ranked WINDOW by_place AS (ORDER BY wp)),
   runs AS (SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (ORDER BY wp ROWS UNBOUNDED PRECEDING) AS run FROM judged),
   numbered AS (
     SELECT *, row_number() OVER in_run AS nth, bool_and(sure) OVER in_run AS all_sure
     FROM runs WINDOW in_run AS (PARTITION BY run ORDER BY wp ROWS UNBOUNDED PRECEDING)),
   chosen AS (SELECT wp, next_wp, after, tok, rank FROM numbered WHERE all_sure AND nth % 2 = 1),
   marked AS (
     SELECT wp FROM ranked WHERE early
     UNION ALL SELECT a.wp FROM chosen a JOIN chosen b ON a.after = b.wp AND a.rank = b.rank JOIN merges m ON ((a.rank << 32) | b.tok) = m.pair WHERE m.early)
   SELECT wp, rank FROM chosen UNION ALL SELECT next_wp, -1 FROM chosen
   UNION ALL SELECT DISTINCT wp | 4294967295, -2 FROM marked)
)
SELECT wp >> 32 AS word, wp & 4294967295 AS place, tok FROM state WHERE tok <> -1 ORDER BY wp
"""
#: For marked words: the leftmost pair of least rank of each word, one a turn.
ENCODE_SINGLY = f"""
WITH RECURSIVE state(wp, tok) USING KEY (wp) AS ({_ALIVE}
   ranked AS (
     SELECT a.wp, a.next_wp, m.rank_high | (a.wp & 4294967295) AS least
     FROM alive a JOIN merges m ON ((a.tok << 32) | a.next_tok) = m.pair
     WHERE (a.next_wp >> 32) = (a.wp >> 32)),
   best AS (SELECT wp >> 32 AS word, min(least) AS least FROM ranked GROUP BY 1),
   chosen AS (SELECT wp, next_wp, r.least >> 32 AS rank FROM ranked r JOIN best b ON (r.wp >> 32) = b.word AND r.least = b.least)
   SELECT wp, rank FROM chosen UNION ALL SELECT next_wp, -1 FROM chosen)
)
SELECT wp >> 32 AS word, wp & 4294967295 AS place, tok FROM state WHERE tok >= 0 ORDER BY wp
"""
DECODE = "SELECT string_agg(hex, '' ORDER BY wp) FROM coded JOIN vocabulary USING (tok)"


def load_ranks(path: str) -> bytes:
    """A rank file's content (base64 token, space, rank in each line)."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


class Coder:
    """Encodes and decodes in one in-memory DuckDB with the merge table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        spill = tempfile.mkdtemp(prefix="bpe-")
        weakref.finalize(self, shutil.rmtree, spill, ignore_errors=True)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": spill})
        self.split = regex.compile(pattern).findall
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r << 32, max(ranks[x] if len(x) > 1 else -1 for x in (t[:i], t[i:])) > r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self._table("merges", pair=table[:, 0], rank_high=table[:, 1], early=table[:, 2] > 0)
        #: Whether each beginning of a token is one itself.
        self.beginnings = {t[:i]: False for t in ranks for i in range(1, len(t))} | dict.fromkeys(ranks, True)
        self._table("vocabulary", tok=np.array(list(ranks.values()), np.int64), hex=pa.array([t.hex() for t in ranks]))
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.words = Coded()

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _reach(self, w: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each place: where the longest token that ends before it begins, and where the longest one that begins at it ends."""
        n, known = len(w), self.beginnings.get
        low, high = np.arange(n + 1), np.arange(1, n + 1)
        for s in range(n):
            e = s + 1
            while e <= n and (whole := known(w[s:e])) is not None:
                if whole:
                    high[s] = e
                    if low[e] > s:
                        low[e] = s
                e += 1
        return low[:-1], high

    def _init(self, raw: list[bytes]) -> np.ndarray:
        data, n = np.frombuffer(b"".join(raw), np.uint8), np.fromiter(map(len, raw), np.int64, len(raw))
        place = np.arange(len(data), dtype=np.int64) - np.repeat(np.cumsum(n) - n, n)
        wp = np.repeat(np.arange(len(raw), dtype=np.int64) << 32, n) | place
        self._table("init", wp=wp, tok=self.single[data])
        return wp

    def _encode_words(self, keys: list, raw: list[bytes], into: "Coded") -> None:
        self._init(raw)
        out = self.db.execute(ENCODE).fetchnumpy()
        self._keep(into, keys, np.asarray(out["word"]), np.asarray(out["place"]), np.asarray(out["tok"]))

    def _cut(self, raw: bytes) -> list[bytes]:
        """A word's parts between places that no token of the vocabulary could lie across: no contraction crosses them."""
        _, high = self._reach(raw)
        ends = np.flatnonzero(np.maximum.accumulate(high) == np.arange(1, len(raw) + 1)) + 1
        return [raw[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _encode_cut(self, words: list[str]) -> None:
        """Words of more than LONG bytes, by their parts; only parts that are long themselves need the steps for long words."""
        parts, found = [self._cut(w.encode()) for w in words], Coded()
        todo = list({x for p in parts for x in p})
        for far, encode in ((False, self._encode_words), (True, self._encode_long)):
            some = [(x, len(x)) for x in todo if (len(x) > LONG) == far]
            for part in _parts(some, WORDS, LONG_BYTES if far else SQUARES, 1 if far else 2):
                encode(part, part, found)
        for w, p in zip(words, parts, strict=True):
            number = np.fromiter(map(found.number.__getitem__, p), np.int64, len(p))
            ids, plain = (x.of(number)[0] for x in found.parts)
            self.words.add([w], ids, np.array([len(ids)]), plain, np.array([len(plain)]))

    def _encode_long(self, keys: list, raw: list[bytes], into: "Coded") -> None:
        """A turn joins every pair that no pair of lower rank can come before.

        A neighbour can take a part of a pair only by a token that ends where the left part does, or begins where the
        right one does. So a pair whose rank is the least within reach of such tokens is joined in the order of ranks,
        too, whatever happens elsewhere; of a run of overlapping pairs of one rank it's every other. This holds as long
        as joining makes no pair of lower rank; a word where one turns up is encoded anew, a pair a turn.
        """
        wp = self._init(raw)
        low, high = zip(*map(self._reach, raw), strict=True)
        start = wp & ~4294967295
        self._table("reach", wp=wp, low=start + np.concatenate(low), high=start + np.concatenate(high))
        self.db.execute(f"SET memory_limit = '{max(LONG_MEMORY, LONG_ROW * max(map(len, raw)) >> 20)}MB'")
        out = self.db.execute(ENCODE_LONG).fetchnumpy()
        self.db.execute(f"SET memory_limit = '{MEMORY}'")
        word, place, tok = (np.asarray(out[c]) for c in ("word", "place", "tok"))
        again = np.unique(word[tok == -2])
        if len(again):
            self.db.execute(f"DELETE FROM init WHERE (wp >> 32) NOT IN ({','.join(map(str, again.tolist()))})")
            more = self.db.execute(ENCODE_SINGLY).fetchnumpy()
            keep = ~np.isin(word, again)
            word, place, tok = (np.concatenate([x[keep], np.asarray(more[c])]) for x, c in ((word, "word"), (place, "place"), (tok, "tok")))
            order = np.lexsort((place, word))
            word, place, tok = word[order], place[order], tok[order]
        self._keep(into, keys, word, place, tok)

    def _keep(self, into: "Coded", words: list, word: np.ndarray, place: np.ndarray, tok: np.ndarray) -> None:
        ids = tok.astype(np.int64)
        self._table("coded", wp=word << 32 | place, tok=ids)
        plain = bytes.fromhex(self.db.execute(DECODE).fetchall()[0][0])
        size = np.bincount(word, self.sizes[ids], len(words)).astype(np.int64)
        into.add(words, ids.astype(np.uint32), np.bincount(word, minlength=len(words)), np.frombuffer(plain, np.uint8), size)

    def _matches(self, pieces: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The pattern's matches in each piece, one after the other, and how many each has.

        Pieces that begin with a space and end with something else are cut at once: no match crosses their ends.
        """
        text = [p.decode() for p in pieces]
        joins = np.fromiter((x[0] == " " and not x[-1].isspace() for x in text), bool, len(text))
        count = np.zeros(len(text), np.int64)
        row = self.split("".join(x for x, j in zip(text, joins.tolist(), strict=True) if j))
        size = np.fromiter(map(len, text), np.int64, len(text))
        count[joins] = np.diff(np.searchsorted(np.cumsum(np.fromiter(map(len, row), np.int64, len(row))), np.cumsum(size[joins]), side="right"), prepend=0)
        if joins.all():
            return row, count
        out: list[str] = []
        ends = np.cumsum(count).tolist()
        for i, (x, j) in enumerate(zip(text, joins.tolist(), strict=True)):
            part = row[ends[i - 1] if i else 0 : ends[i]] if j else self.split(x)
            count[i] = len(part)
            out += part
        return out, count

    def encode(self, batch: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, their decoded bytes) of each text."""
        ids, n, plain, m = self.arrays([x.encode() for x in batch])
        codes, plain = ids.astype("<u4").tobytes(), plain.tobytes()
        return [(codes[4 * (e - k) : 4 * e], plain[f - j : f]) for e, k, f, j in zip(np.cumsum(n).tolist(), n.tolist(), np.cumsum(m).tolist(), m.tolist(), strict=True)]

    def arrays(self, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts and how many each has, their decoded bytes and how many each has.

        A single space after a character that is no white space always begins a match of the pattern, so that texts
        are cut there and each distinct piece is matched once.
        """
        if self.words.size > CACHED:
            self.words = Coded()
        data, length = np.frombuffer(b"".join(batch), np.uint8), np.fromiter(map(len, batch), np.int64, len(batch))
        end = np.cumsum(length)
        begins = np.zeros(len(data) + 1, bool)
        space = np.flatnonzero(data[1:] == 32) + 1
        begins[space[~white_before(data, space)]] = True
        begins[end - length] = True
        at = np.flatnonzero(begins[:-1])
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        words, count = self._matches(pieces.dictionary.to_pylist())
        known = self.words.number
        todo = list({w for w in words if w not in known})
        size = [len(w.encode()) for w in todo]
        for part in _parts([x for x in zip(todo, size, strict=True) if x[1] <= LONG], WORDS, SQUARES, 2):
            self._encode_words(part, [w.encode() for w in part], self.words)
        for part in _parts([x for x in zip(todo, size, strict=True) if x[1] > LONG], WORDS, LONG_BYTES, 1):
            self._encode_cut(part)
        number = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        owner, code = np.repeat(np.arange(len(count)), count), pieces.indices.to_numpy()
        doc, out = np.searchsorted(end, at, side="right"), []
        for values, n in (x.of(number) for x in self.words.parts):
            of_piece = np.bincount(owner, n, len(count)).astype(np.int64)
            here = of_piece[code]
            out += [values[ranges((np.cumsum(of_piece) - of_piece)[code], here)], np.bincount(doc, here, len(batch)).astype(np.int64)]
        return tuple(out)


class Coded:
    """Strings, with the ids and decoded bytes of each, in arrays that grow."""

    def __init__(self):
        self.number: dict = {}
        self.parts: tuple[Ragged, Ragged] = Ragged(np.uint32), Ragged(np.uint8)

    @property
    def size(self) -> int:
        """Bytes that it takes, about: a string and its entry take some 150."""
        return 150 * len(self.number) + sum(x.values.nbytes + 2 * x.start.nbytes for x in self.parts)

    def add(self, keys: list, ids: np.ndarray, n_ids: np.ndarray, text: np.ndarray, n_text: np.ndarray) -> None:
        at = len(self.number)
        self.number.update(zip(keys, range(at, at + len(keys)), strict=True))
        self.parts[0].add(ids, n_ids)
        self.parts[1].add(text, n_text)


class Ragged:
    """Sequences of numbers, one after the other, in arrays that double as they grow."""

    def __init__(self, kind: type):
        self.values, self.start, self.count = np.zeros(1024, kind), np.zeros(1025, np.int64), 0

    def add(self, values: np.ndarray, length: np.ndarray) -> None:
        n, used = self.count, int(self.start[self.count])
        self.values = _room(self.values, used + len(values))
        self.start = _room(self.start, n + len(length) + 1)
        self.values[used : used + len(values)] = values
        self.start[n + 1 : n + len(length) + 1] = used + np.cumsum(length)
        self.count += len(length)

    def of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.start[number]
        length = self.start[number + 1] - start
        return self.values[ranges(start, length)], length


def _room(x: np.ndarray, n: int) -> np.ndarray:
    if n <= len(x):
        return x
    out = np.zeros(max(n, 3 * len(x) // 2), x.dtype)
    out[: len(x)] = x
    return out


def white_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character of white space (the patterns' ``\\s``) ends in UTF-8 right before each place."""
    last = data[at - 1]
    out = (last == 32) | (last - np.uint8(9) < 5) | (last - np.uint8(28) < 4)
    far = np.flatnonzero(last >= 128)
    for c in WHITE if len(far) else "":
        raw = c.encode()
        hit = far[at[far] >= len(raw)]
        for i, b in enumerate(raw):
            hit = hit[data[at[hit] - len(raw) + i] == b]
        out[hit] = True
    return out


def _parts(words: list[tuple[str, int]], most: int, size: int, power: int) -> Iterator[list[str]]:
    """The words, in parts of ``most`` at most whose lengths to a power come to ``size`` at most, unless of one word."""
    part, total = [], 0
    for w, n in words:
        if part and (len(part) == most or total + n**power > size):
            yield part
            part, total = [], 0
        part.append(w)
        total += n**power
    if part:
        yield part


def coder(ranks: bytes, pattern: str) -> Coder:
    return resident(("bpe", hashlib.sha256(ranks + pattern.encode()).hexdigest()), lambda: Coder(parse_ranks(ranks), pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of each row, and with ``with_ids`` the ids, with ``with_text`` the decoded text.

    The rank file is of fixed size (under 2 MB for 50,000 tokens) and travels with the tasks.
    """
    ship(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<bigint>" * with_ids + ", decoded string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(ranks.value, pattern)
        for b in steps(batches, text_col, size=TEXT_BYTES):
            ids, n_ids, plain, n_plain = code.arrays(texts(b, text_col))
            codes, plain = ids.astype("<u4").tobytes(), plain.tobytes()
            end, plain_end = 4 * np.cumsum(n_ids), np.cumsum(n_plain)
            decoded = [plain[i:j] for i, j in zip((plain_end - n_plain).tolist(), plain_end.tolist(), strict=True)]
            cols = [b.column(id_col), pa.array(n_ids), pa.array([hashlib.sha256(codes[i:j]).hexdigest() for i, j in zip((end - 4 * n_ids).tolist(), end.tolist(), strict=True)]), pa.array([hashlib.sha256(d).hexdigest() for d in decoded])]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_ids)), pa.int32()), pa.array(ids.astype(np.int64))))
            if with_text:
                cols.append(pa.array([d.decode("utf-8", "replace") for d in decoded]))
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids, *["decoded"] * with_text])

    return arrow_map(docs.select(id_col, text_col), run, schema, resides=True)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
