"""Byte-level BPE with vectorised pre-tokenisation (operator 8).

The split pattern is a small automaton. Every code point gets a class from one table (letters, numbers,
other, white space; a look at the next two code points tells an apostrophe that may start a contraction
and the last of a white space run). A class is a transition function on the automaton's states;
functions compose associatively, so blocks of code points are composed side by side, a doubling
scan over the blocks gives the state before each block, and one more sweep gives the state before
each code point. State and class tell whether a piece starts there: no regular expression runs.

Pieces are named by a 64-bit hash; those that a worker has not met are merged once (the tokenizer's own
pair merging) and kept in its cache, which is emptied when it is full. Each id keeps its byte offset,
and decoding looks the ids up in the vocabulary. A tokenizers file's added tokens are cut out of the
texts first, the earliest and then the longest; what lies between them is split as texts of their own.

Edge cases: null and empty texts have no ids; rows are independent of each other, so repeated rows,
ties and further columns change nothing; an empty table gives an empty result; a null doc_id is carried.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronoforge.llm import kernels as K
from chronoforge.llm.common import batch_of, inputs

#: code points in one block of the scan
BLOCK = 64
#: pieces that a worker's cache holds before it starts anew, and its places by hash
CACHE_PIECES = 1_500_000
PLACE_BITS = 21
#: bytes of texts that are encoded at once: a byte takes some 60 bytes of arrays meanwhile
RUN_BYTES = 1 << 20

_LETTER, _NUMBER, _OTHER, _SHORT, _LONG, _SPACE, _LAST, _WHITE, _END = range(9)
_FRESH, _IN_LETTERS, _IN_NUMBERS, _IN_OTHER, _IN_WHITE, _AFTER_SPACE, _TWO_MORE, _ONE_MORE = range(8)
#: fixed values: code points with the White_Space property, and the contractions of the pattern
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """step[class, state] -> state, and starts[class, state]: a piece starts at this code point."""
    step = np.zeros((9, 8), np.uint8)
    starts = np.ones((9, 8), bool)
    for kind, inside in ((_LETTER, _IN_LETTERS), (_NUMBER, _IN_NUMBERS), (_OTHER, _IN_OTHER), (_WHITE, _IN_WHITE)):
        step[kind] = inside
        starts[kind, inside] = False
    for kind, then in ((_SHORT, _ONE_MORE), (_LONG, _TWO_MORE)):  # a contraction only where a piece starts
        step[kind] = then
        for state in (_IN_OTHER, _AFTER_SPACE):
            step[kind, state], starts[kind, state] = _IN_OTHER, False
    starts[[_LETTER, _NUMBER, _OTHER], _AFTER_SPACE] = False
    for state, then in ((_TWO_MORE, _ONE_MORE), (_ONE_MORE, _FRESH)):
        step[_LETTER, state], starts[_LETTER, state] = then, False
    step[_SPACE], step[_LAST], step[_END] = _AFTER_SPACE, _IN_WHITE, _FRESH
    return step, starts


_STEP, _STARTS = _automaton()
_TABLES: dict[str, np.ndarray] = {}


def _classes() -> np.ndarray:
    """Class of every code point."""
    if "class" not in _TABLES:
        kinds = {"L": _LETTER, "N": _NUMBER}
        t = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        t[WHITE] = _WHITE
        _TABLES["class"] = t
    return _TABLES["class"]


#: states that act alike on what follows: any (0), after other (1), in a contraction (2, 3)
_ALIKE = np.array([0, 0, 0, 1, 0, 1, 2, 3], np.uint8)
_FIRST_OF = np.array([_FRESH, _IN_OTHER, _TWO_MORE, _ONE_MORE])


def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A function on the four kinds of states as one byte, two bits for each: the code of each class,
    the composition of any two (first, then), and a function's value on a kind."""
    value = (np.arange(256)[:, None] >> (2 * np.arange(4))) & 3
    pack = lambda v: (v << (2 * np.arange(4))).sum(-1).astype(np.uint8)
    code = pack(_ALIKE[_STEP[:, _FIRST_OF]].astype(np.int64))
    then = value[:, value].transpose(1, 0, 2)  # then[first, second] = second after first
    return code, pack(then).reshape(-1), value.astype(np.uint8).reshape(-1)


_CODE, _THEN, _VALUE_OF = _functions()


def _states(kind: np.ndarray) -> np.ndarray:
    """The state before each code point, by an associative scan over transition functions."""
    n = len(kind)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, _CODE[_END], np.uint8)
    grid[:n] = _CODE[kind]
    grid = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    whole = grid[0]
    for row in grid[1:]:  # each block's own function, all blocks at once
        whole = _THEN[whole.astype(np.uint16) << 8 | row]
    step = 1
    while step < blocks:  # functions of 2, 4, 8, ... blocks up to each block
        whole[step:] = _THEN[whole[:-step].astype(np.uint16) << 8 | whole[step:]]
        step *= 2
    now = np.zeros(blocks, np.uint8)
    now[1:] = _VALUE_OF[whole[:-1].astype(np.uint16) << 2]
    alike = np.empty((BLOCK, blocks), np.uint8)
    for i, row in enumerate(grid):
        alike[i] = now
        now = _VALUE_OF[row.astype(np.uint16) << 2 | now]
    before = _FIRST_OF[alike.T.reshape(-1)[:n - 1]]  # the class then gives the full state
    return np.concatenate([np.zeros(1, np.uint8), _STEP.reshape(-1)[kind[:-1] * np.uint8(8) + before.astype(np.uint8)]])


def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, start and end of each piece in them, and the first piece of each text (n + 1)."""
    joined = "\n".join(texts) + "\n"
    point = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    kind = _classes()[point]
    kind[ends] = _END
    ahead = np.concatenate([kind[1:], np.array([_END], np.uint8)])
    white = kind == _WHITE
    last = white & (ahead != _WHITE) & (ahead != _END)
    kind[last] = np.where(point[last] == 0x20, _SPACE, _LAST)
    mark = np.flatnonzero(point == 0x27)
    if len(mark):
        one = np.minimum(mark + 1, len(point) - 1)
        two = np.minimum(mark + 2, len(point) - 1)
        for c in CONTRACTIONS:
            hit = point[one] == ord(c[0])
            if len(c) > 1:
                hit &= point[two] == ord(c[1])
            kind[mark[hit]] = _SHORT if len(c) == 1 else _LONG
    start = _STARTS.reshape(-1)[kind * np.uint8(8) + _states(kind)]
    width = np.ones(len(point), np.uint8)
    for limit in (0x80, 0x800, 0x10000):
        width += point >= limit
    byte = np.cumsum(width, dtype=np.int64) - width
    edge = np.flatnonzero(start)  # each end of text is an edge too, and ends the piece before it
    is_end = kind[edge] == _END
    begin = edge[~is_end]
    after = np.append(edge[1:], len(point))[~is_end]
    limit = np.append(byte, byte[-1] + 1)
    text_at = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    first = np.append(np.searchsorted(begin, text_at), len(begin))
    return np.frombuffer(joined.encode("utf-8"), np.uint8), byte[begin], limit[after], first


class Cache:
    """Ids of pieces by hash; ``merge`` gives the ids of each of some byte strings. Each hash has one
    place; a piece that another one displaces is simply merged again when it comes back."""

    def __init__(self, merge: Callable[[list[bytes]], list[list[int]]], added: dict[str, int] | None = None):
        self.merge = merge
        self.added = added or {}
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.clear()

    def clear(self) -> None:
        self.key, self.value = np.zeros(1 << PLACE_BITS, np.uint64), np.full(1 << PLACE_BITS, -1, np.int64)
        self.at, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def ids(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some pieces in order, and the number of each piece."""
        h = K.span_hash(buf, start, end, 3)
        if len(self.at) > CACHE_PIECES:
            self.clear()
        place = (h >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
        at = np.where(self.key[place] == h, self.value[place], -1)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            _, where, which = np.unique(h[miss], return_index=True, return_inverse=True)
            one = miss[where]
            raw = buf.tobytes()
            got = self.merge([raw[a:b] for a, b in zip(start[one].tolist(), end[one].tolist())])
            size = np.fromiter(map(len, got), np.int64, len(got))
            new = len(self.at) + np.arange(len(got))
            self.at = np.append(self.at, len(self.flat) + np.cumsum(size) - size)
            self.size = np.append(self.size, size)
            self.flat = np.append(self.flat, np.fromiter((i for g in got for i in g), np.uint32, int(size.sum())))
            at[miss] = new[which]
            self.key[place[one]], self.value[place[one]] = h[one], new
        size = self.size[at]
        flat = np.repeat(self.at[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.flat[flat], size


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable Latin-1 signs stand for
    themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


_MERGERS: dict[str, tuple[Cache, list[bytes]]] = {}


def _read(path: str) -> dict[bytes, int]:
    """Ranks of a file: lines of base64 and rank, or a tokenizers JSON whose ids are in merge order."""
    if not path.endswith(".json"):
        with open(path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    signs = _byte_signs()
    return {bytes(map(signs.__getitem__, k)): v for k, v in vocabulary.items() if all(c in signs for c in k)}


def _added(path: str) -> dict[str, int]:
    """Ids of the added tokens of a tokenizers JSON, which match in the text as they stand."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    tokens = file.get("added_tokens") or []
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or (t["normalized"] and file.get("normalizer")) for t in tokens):
        raise ValueError(f"{path}: added tokens that take in what is around them are not supported")
    return {t["content"]: t["id"] for t in tokens}


def tokenizer(path: str) -> tuple[Cache, list[bytes]]:
    """A worker's cache over a vocabulary file, and the bytes of each id."""
    if path not in _MERGERS:
        import tiktoken

        added = _added(path)
        ranks = {k: v for k, v in _read(path).items() if v not in added.values()}
        core = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        vocabulary = [b""] * (max([*ranks.values(), *added.values()]) + 1)
        for k, v in [*ranks.items(), *((k.encode(), v) for k, v in added.items())]:
            vocabulary[v] = k
        one = core._core_bpe.encode_single_piece
        _MERGERS[path] = Cache(lambda got: [one(x) for x in got], added), vocabulary
    return _MERGERS[path]


def forget(path: str) -> None:
    """Drop a vocabulary file and its cache: a worker outlives its task, and they would stay beside other stages' work."""
    _MERGERS.pop(path, None)


def encode(texts: list[str], cache: Cache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, the first id of each text (n + 1), and how many ids each piece has."""
    if cache.cut and any(cache.cut.search(t) for t in texts):
        return _encode_cut(texts, cache)
    return _encode(texts, cache)


def _encode_cut(texts: list[str], cache: Cache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``encode`` of texts with added tokens; each of them is a piece of one id."""
    parts = [cache.cut.split(t) for t in texts]  # text, token, text, ..., text
    ids, first, size = _encode([x for p in parts for x in p[::2]], cache)
    n_pieces = np.append(0, np.cumsum(size))
    out_ids, out_size, starts, k, reached = [], [], [0], 0, 0
    for p in parts:
        for j in range(0, len(p), 2):
            lo, hi = np.searchsorted(n_pieces, first[k:k + 2])
            out_ids.append(ids[first[k]:first[k + 1]])
            out_size.append(size[lo:hi])
            if j + 1 < len(p):
                out_ids.append(np.array([cache.added[p[j + 1]]], np.uint32))
                out_size.append(np.ones(1, np.int64))
            reached += len(out_ids[-1]) if j + 1 == len(p) else int(first[k + 1] - first[k]) + 1
            k += 1
        starts.append(reached)
    return np.concatenate(out_ids), np.array(starts, np.int64), np.concatenate(out_size)


def _encode(texts: list[str], cache: Cache) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buf, start, end, first = pieces(texts)
    if not len(start):
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64)
    ids, size = cache.ids(buf, start, end)
    return ids, np.append(0, np.cumsum(size))[first], size


def id_offsets(ids: np.ndarray, vocabulary: list[bytes]) -> np.ndarray:
    """Byte offset of each id in its text, and the text's length: ids i to j cover offsets[i]:offsets[j]."""
    return np.append(0, np.cumsum([len(vocabulary[i]) for i in ids.tolist()]))


def decode(ids: np.ndarray, vocabulary: list[bytes]) -> bytes:
    return b"".join(map(vocabulary.__getitem__, ids.tolist()))


def text_runs(column: pa.Array, limit: int = RUN_BYTES):
    """(first row, end row, texts) as Python strings, null as empty."""
    for lo, hi, texts in K.text_slices(column, limit):
        yield lo, hi, [t.decode("utf-8", "replace") for t in texts]


def byte_bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row for each row of ``docs``; with
    ``keep_ids`` also the ids (little-endian unsigned 32 bits)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
                       + [("ids", pa.binary())] * keep_ids)

    def run(batches):
        cache, vocabulary = tokenizer(path)
        for b in batches:
            doc = b.column("doc_id").to_pylist()
            for lo, hi, texts in text_runs(b.column("text")):
                ids, first, _ = encode(texts, cache)
                own = [ids[a:z] for a, z in zip(first[:-1], first[1:])]
                raw = [x.astype("<u4").tobytes() for x in own]
                out = {"doc_id": doc[lo:hi], "n_tokens": np.diff(first),
                       "ids_sha256": [hashlib.sha256(x).hexdigest() for x in raw],
                       "decoded_sha256": [hashlib.sha256(decode(x, vocabulary)).hexdigest() for x in own]}
                yield batch_of(schema, out | {"ids": raw} if keep_ids else out)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return inputs(docs, id_col, text_col).mapInArrow(run, ddl)
