"""BPE over words with an index of pair occurrences, for tokenizer files of normalised, white-space-free words.

A task collects the distinct words that it hasn't met, lays their symbols side by side, and maps the rank of each
mergeable pair to all positions where the pair stands. Active ranks are then applied in ascending order: each valid
occurrence, from left to right, is contracted, and the two pairs that it forms with its neighbours join the lists of their
ranks. Long lists are contracted at once as arrays, short ones one by one. Contracting never makes a pair of lower rank in
usual files; where a rank might, a word whose pair does waits until the lower one is applied. So each word gets the
contractions that it would get alone, by least rank and leftmost place.

Texts are cut at the file's special tokens, then into normalised words by the usual pattern; where a text has characters
whose class depends on the Unicode version, the file's own normalizer and pre-tokenizer are asked. Each distinct word is
encoded once for a worker's cache. A text is read a stretch at a time; an executor's memory is bounded by the cache and
by its longest word, of which a byte takes about 40 bytes.

Null and empty texts have no ids, the hash of nothing, and decode to the empty text. Each row is a document, whatever its id.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, read, resident, ship, steps, texts

#: Characters of a text that are cut at once (and on to the next white space).
STRETCH = 1 << 20
#: Bytes of new words that are encoded together, and about how many the words that a worker keeps take; longer ones than LONG aren't kept.
TOGETHER, CACHED, LONG = 4 << 20, 128 << 20, 4096
#: Lists of more positions than this are contracted as arrays.
SHORT = 48
#: What special tokens begin with.
SPECIAL = "<|"
WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def byte_letters() -> list[str]:
    """The letter that byte-level files write for each byte: itself where it is printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Merges:
    """A file's merges, and the index that applies them."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.left, self.right = (np.array([vocabulary[p[i]] for p in pairs], np.int32) for i in (0, 1))
        self.made = np.array([vocabulary["".join(p)] for p in pairs], np.int32)
        self.width = max(vocabulary.values()) + 1
        keys = self.left.astype(np.int64) * self.width + self.right
        #: Of a pair that is listed twice, the later place counts.
        self.rank = {k: r for r, k in enumerate(keys.tolist())}
        self.keys = np.array(sorted(self.rank), np.int64)
        self.ranks = np.array([self.rank[k] for k in self.keys.tolist()], np.int32)
        first = np.full(self.width, len(pairs), np.int64)
        for side in (self.left, self.right):
            np.minimum.at(first, side, np.arange(len(pairs)))
        #: Ranks whose token is part of a pair of lower rank.
        self.early = first[self.made] < np.arange(len(pairs))
        letters = byte_letters()
        self.inner = np.array([vocabulary.get(x, -1) for x in letters], np.int32)
        self.final = np.array([vocabulary.get(x + suffix, -1) for x in letters], np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens; -1 for those that don't merge."""
        out = np.full(len(left), -1, np.int32)
        if len(self.keys):
            for s in range(0, len(left), 1 << 18):
                key = left[s : s + (1 << 18)].astype(np.int64) * self.width + right[s : s + (1 << 18)]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                out[s : s + (1 << 18)] = np.where(self.keys[at] == key, self.ranks[at], -1)
        return out

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one after the other; how many each has). A byte that the vocabulary doesn't have gives none."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        ends = np.cumsum(size)[size > 0] - 1
        tok = self.inner[data]
        tok[ends] = self.final[data[ends]]
        if (tok < 0).any():
            word, tok = word[tok >= 0], tok[tok >= 0]
        n = len(tok)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        edge = word[1:] != word[:-1]
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[-1] = -1
        nxt[:-1][edge] = -1
        prv[1:][edge] = -1
        rank = self.find(tok[:-1], tok[1:])
        rank[edge] = -1
        order = np.argsort(rank, kind="stable").astype(np.int32)
        order = order[np.searchsorted(rank[order], 0) :]
        ranks, starts = np.unique(rank[order], return_index=True)
        del rank, edge
        #: The index: positions of each active rank, as found at first and as added since.
        index = dict(zip(ranks.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=False), strict=False))
        added: dict[int, array] = {}
        active = ranks.tolist()
        state = tok, nxt, prv
        views = memoryview(tok), memoryview(nxt), memoryview(prv)
        while active:
            r = heapq.heappop(active)
            s, e = index.pop(r, (0, 0))
            more = added.pop(r, None)
            count = e - s + (len(more) if more else 0)
            if count > SHORT and not self.early[r]:
                places = np.unique(np.concatenate([order[s:e], np.frombuffer(more, np.int32)])) if more else order[s:e]
                self._contract(r, places, state, index, added, active)
            else:
                places = order[s:e].tolist()
                self._contract_singly(r, sorted(places + more.tolist()) if more else places, views, word, index, added, active)
        alive = tok >= 0
        return tok[alive], np.bincount(word[alive], minlength=len(words))

    def _contract(self, r: int, at: np.ndarray, state: tuple, index: dict, added: dict, active: list) -> None:
        tok, nxt, prv = state
        a, b, made = self.left[r], self.right[r], self.made[r]
        at = at[tok[at] == a]
        after = nxt[at]
        fits = (after >= 0) & (tok[after] == b)
        at, after = at[fits], after[fits]
        if a == b and len(at):  # of overlapping pairs, every other from the left
            starts = np.ones(len(at), bool)
            starts[1:] = after[:-1] != at[1:]
            first = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
            take = (np.arange(len(at)) - first) % 2 == 0
            at, after = at[take], after[take]
        if not len(at):
            return
        then = nxt[after]
        tok[at], tok[after], nxt[at] = made, -1, then
        goes_on = then >= 0
        prv[then[goes_on]] = at[goes_on]
        before, then = prv[at], nxt[at]
        places = np.concatenate([before[before >= 0], at[then >= 0]])
        rank = self.find(tok[places], tok[nxt[places]])
        order = np.argsort(rank, kind="stable")
        order = order[np.searchsorted(rank[order], 0) :]
        ranks, starts = np.unique(rank[order], return_index=True)
        for x, s, e in zip(ranks.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=False):
            if x not in added:
                added[x] = array("i")
                if x not in index:
                    heapq.heappush(active, x)
            added[x].frombytes(places[order[s:e]].tobytes())

    def _contract_singly(self, r: int, places: list[int], views: tuple, word: np.ndarray, index: dict, added: dict, active: list) -> None:
        tok, nxt, prv = views
        a, b, made, width, known = int(self.left[r]), int(self.right[r]), int(self.made[r]), self.width, self.rank
        wait = {} if self.early[r] else None

        def add(x: int, i: int) -> None:
            if x not in added:
                added[x] = array("i")
                if x not in index:
                    heapq.heappush(active, x)
            added[x].append(i)

        for i in places:
            if tok[i] != a:
                continue
            j = nxt[i]
            if j < 0 or tok[j] != b:
                continue
            if wait is not None and int(word[i]) in wait:
                add(r, i)
                continue
            tok[i], tok[j] = made, -1
            k = nxt[j]
            nxt[i] = k
            if k >= 0:
                prv[k] = i
                x = known.get(made * width + tok[k])
                if x is not None:
                    add(x, i)
                    if wait is not None and x < r:
                        wait[int(word[i])] = True
            h = prv[i]
            if h >= 0:
                x = known.get(tok[h] * width + made)
                if x is not None:
                    add(x, h)
                    if wait is not None and x < r:
                        wait[int(word[i])] = True


class Coder:
    """Encodes texts by a tokenizer file, and decodes them."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        file = json.loads(content)
        model = file["model"]
        if model["type"] != "BPE" or any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")) or file["decoder"]:
            raise ValueError("a BPE model over bytes without dropout, unknown token, prefix or decoder is asked for")
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        special = {x["content"]: x["id"] for x in file["added_tokens"]}
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in special.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.special = {t: (np.array([i], "<u4").tobytes(), t.encode()) for t, i in special.items()}
        self.special_or_not = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None
        if not all(t.startswith(SPECIAL) for t in special):
            raise ValueError(f"special tokens that begin with {SPECIAL} are asked for")
        library = Tokenizer.from_str(content.decode())
        self.normal = library.normalizer.normalize_str if library.normalizer else str
        self.pre = library.pre_tokenizer.pre_tokenize_str
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.held = 0

    def _cut(self, text: str) -> list[str]:
        """The words of a stretch, normalised."""
        if text.isascii():
            return ASCII_WORDS(text.lower())
        if BEYOND.search(text):
            text = self.normal(text)
            return [text[s:e] for _, (s, e) in self.pre(text)]
        return NEAR_WORDS(unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower())

    def _learn(self, words: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """Encode words that aren't kept yet; those too long to be kept are returned."""
        fresh = list(words - self.words.keys())
        raw = [w.encode() for w in fresh]
        late, names, at = {}, self.names, 0
        while at < len(fresh):
            end, size = at, 0
            while end < len(fresh) and (end == at or size + len(raw[end]) <= TOGETHER):
                size += len(raw[end])
                end += 1
            ids, count = self.merges.encode(raw[at:end])
            data, each, ends = ids.astype("<u4").tobytes(), ids.tolist(), np.cumsum(count).tolist()
            s = 0
            for w, e in zip(fresh[at:end], ends, strict=True):
                made = data[4 * s : 4 * e], b" ".join([names[i] for i in each[s:e]])
                (self.words if len(w) <= LONG else late)[w] = made
                s = e
            self.held += 250 * (end - at) + 2 * size + len(data)
            at = end
        return late

    def stretches(self, text: str) -> Iterator[str]:
        """A text in order: its special tokens, and what lies between in pieces of bounded size that end before white space."""
        for part in self.special_or_not(text) if self.special_or_not and SPECIAL in text else [text]:
            if len(part) <= STRETCH:
                yield part
                continue
            at = 0
            while at < len(part):
                gap = WHITE.search(part, at + STRETCH) if at + STRETCH < len(part) else None
                end = gap.start() if gap else len(part)
                yield part[at:end]
                at = end

    def code(self, texts: list[str], whole: bool = False) -> list[tuple[int, str, str, bytes, bytes]]:
        """(ids, their hash, the hash of the decoded text; with ``whole`` the ids' bytes and the decoded text's) of each text."""
        if self.held > CACHED:
            self.words.clear()
            self.held = 0
        # words of many short texts go through the index together, a long text's stretch by stretch
        cut = [[x if x in self.special else self._cut(x) for x in self.stretches(t)] if len(t) <= STRETCH else None for t in texts]
        late = self._learn({w for c in cut if c for words in c if not isinstance(words, str) for w in words})
        return [self._code(self._long(t) if c is None else ((x, late) for x in c), whole) for t, c in zip(texts, cut, strict=True)]

    def _long(self, text: str) -> Iterator[tuple[str | list[str], dict]]:
        for x in self.stretches(text):
            if x in self.special:
                yield x, {}
            else:
                words = self._cut(x)
                yield words, self._learn(set(words))

    def _code(self, stretches: Iterator[tuple[str | list[str], dict]], whole: bool) -> tuple[int, str, str, bytes, bytes]:
        n, ids, plain, kept, known = 0, hashlib.sha256(), hashlib.sha256(), ([], []), self.words
        for words, late in stretches:
            if isinstance(words, str):
                made = [self.special[words]]
            else:
                made = [known[w] for w in words] if not late else [known.get(w) or late[w] for w in words]
            raw, shown = b"".join([x[0] for x in made]), b" ".join([x[1] for x in made if x[0]])
            if not raw:
                continue
            plain.update(b" " + shown if n else shown)
            ids.update(raw)
            n += len(raw) // 4
            if whole:
                kept[0].append(raw)
                kept[1].append(shown)
        return n, ids.hexdigest(), plain.hexdigest(), b"".join(kept[0]), b" ".join(kept[1])


def _words_of(characters: range):
    """A function that cuts text of these characters into words by the usual pattern; it must be lower case."""
    kinds = {c: unicodedata.category(chr(c))[0] for c in characters}
    white = "\\t-\\r \\x85\\xa0"
    letters, numbers = ("".join(f"\\u{c:04x}" for c in characters if kinds[c] == k) for k in "LN")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{white}{letters}{numbers}]+").findall


#: Beyond these characters, the categories of a character depend on the Unicode version.
BEYOND = re.compile("[^\0-\u052f]")
ASCII_WORDS, NEAR_WORDS = _words_of(range(0x80)), _words_of(range(0x530))


def coder(content: bytes) -> Coder:
    return resident(("word_bpe", hashlib.sha256(content).hexdigest()), lambda: Coder(content))


def encode(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of each row; with ``whole`` also ids (array<int>) and decoded.

    The file is of fixed size and travels with the tasks; each worker builds its tables once. No row moves.
    """
    ship(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(content.value).code
        for b in steps(batches, text_col):
            n, ids, plain, raw, shown = zip(*code([x.decode() for x in texts(b, text_col)], whole), strict=True)
            columns = [b.column(id_col), pa.array(n, pa.int64()), pa.array(ids), pa.array(plain)]
            if whole:
                columns += [pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in raw], pa.list_(pa.int32())), pa.array([x.decode() for x in shown])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if whole else [])]
    more = ", ids array<int>, decoded string" if whole else ""
    return arrow_map(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}", resides=True)


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
